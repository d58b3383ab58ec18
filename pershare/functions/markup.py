"""HTML text -> ordered elements, as an Arrow function.

Spark has no expression for HTML as found in filings (open tags, spans, character references), so
this one step runs in Python: a single pass over the tags of one document that keeps cell text and
the text between block tags. Everything after it stays in Spark expressions.
"""

import html as html_entities
import itertools
import re
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Workers get this module's code with the task, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ELEMENT_TYPE = (
    "array<struct<elem_seq:int,tag:string,n_rows:int,text:string,"
    "col_labels:array<string>,rows:array<array<string>>>>"
)
_ARROW_TYPE = pa.list_(
    pa.struct(
        [
            ("elem_seq", pa.int32()),
            ("tag", pa.string()),
            ("n_rows", pa.int32()),
            ("text", pa.string()),
            ("col_labels", pa.list_(pa.string())),
            ("rows", pa.list_(pa.list_(pa.string()))),
        ]
    )
)

# Comments, declarations and elements without visible text, which leave nothing behind; then tags,
# with quoted attribute values. Splitting by it gives text, tag name, attributes, text, ...
_MARKUP = re.compile(
    r"<(?:!--.*?(?:-->|\Z)"
    r"|[!?][^>]*+>"
    r"|(?i:script\b[^<>]*+>.*?(?:</script\s*+>|\Z))"
    r"|(?i:style\b[^<>]*+>.*?(?:</style\s*+>|\Z))"
    r"|(?i:title\b[^<>]*+>.*?(?:</title\s*+>|\Z))"
    # a quoted value may hold anything; where quotes do not pair, the tag ends at the next ``>``
    r"|(/?[a-zA-Z][^\s<>/]*+)([^<>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^<>\"']*+)*+(?=>)|[^<>]*+)>)",
    re.DOTALL,
)
_COLSPAN = re.compile(r"(?<![\w-])colspan\s*=\s*[\"']?\s*(\d+)", re.IGNORECASE)
_ROWSPAN = re.compile(r"(?<![\w-])rowspan\s*=\s*[\"']?\s*(\d+)", re.IGNORECASE)
_LINE_SPACE = re.compile(r"\s{2,}|[\r\n]")
# A span as long as any table.
_ENDLESS = 10**18
# Columns kept of a stretch in which no cell of the table begins; more of them would say nothing.
_LONGEST_STRETCH = 1000

# Tags that shape a table, and tags that end a run of text.
_TABLE_TAGS = frozenset("td th tr thead tbody tfoot".split())
_BLOCK_TAGS = _TABLE_TAGS | frozenset(
    "address article aside blockquote body center dd div dl dt fieldset footer form h1 h2 h3 h4 h5 "
    "h6 head header hr html li main nav ol p pre section ul".split()
)
_SHAPING = _BLOCK_TAGS | {"br", "table"}
# Table tags as the grid takes them: name and whether it closes.
_SHAPES = {slash + tag: (tag, slash == "/") for tag in _TABLE_TAGS for slash in ("", "/")}
# Whether text after the tag is in a cell of the table.
_IN_CELL = {tag: tag in ("td", "th") for tag in _SHAPES}
# Names kept in mind with their tags; filings hold few different ones.
_MOST_NAMES = 4096


class _Tags(dict):
    """The tag of each name as written."""

    def __missing__(self, name: str | None) -> str | None:
        tag = _tag(name)
        if len(self) < _MOST_NAMES:
            self[name] = tag
        return tag


_TAGS = _Tags()


class _Grid:
    """Rows of the table being read, each as runs: a number of slots and the text in all of them."""

    def __init__(self, fill_spans: bool):
        self.fill_spans = fill_spans
        self.rows: list[tuple[bool, list[tuple[int, str]]]] = []
        self.in_head = self.saw_head = False
        self.row = None
        self.cell = None
        # first slot, slot after the last, rows still to come and text of the cells that reach down, from left to right
        self.spans: list[tuple[int, int, int, str]] = []

    def on_tag(self, name: str, closing: bool, attrs: str):
        if name in ("td", "th"):
            self.close_cell()
            if not closing:
                self.row = self.row if self.row is not None else []
                cols, rows = (_span(_COLSPAN, attrs), _span(_ROWSPAN, attrs)) if attrs else (1, 1)
                self.cell = (name, cols, rows, [])
            return
        self.close_row()
        if name == "tr":
            self.row = None if closing else []
        else:
            self.in_head = name == "thead" and not closing

    def close_cell(self):
        if self.cell is not None:
            name, cols, rows, pieces = self.cell
            self.row.append((name, cols, rows, _cell_text("".join(pieces))))
            self.cell = None

    def close_row(self):
        self.close_cell()
        if self.row:
            all_th = all(name == "th" for name, *_ in self.row)
            leading = not self.saw_head and all(head for head, _ in self.rows)
            is_head = self.in_head or (all_th and leading)
            self.saw_head |= self.in_head
            self.rows.append((is_head, self._unmerge()))
        self.row = None

    def _unmerge(self) -> list[tuple[int, str]]:
        """The row with spanned slots filled in, from cells above and to the left."""
        if not self.spans and all(cols == 1 == rows for _, cols, rows, _ in self.row):
            return [(1, text) for *_, text in self.row]
        out: list[tuple[int, str]] = []
        spans: list[tuple[int, int, int, str]] = []
        above = iter(self.spans)
        place, from_above = 0, next(above, None)

        def take_spans_from_above():
            nonlocal place, from_above
            while from_above is not None and from_above[0] <= place:
                _, end, left, text = from_above
                if end > place:
                    if left > 1:
                        spans.append((place, end, left - 1, text))
                    out.append((end - place, text))
                    place = end
                from_above = next(above, None)

        for _, cols, rows, text in self.row:
            take_spans_from_above()
            again = text if self.fill_spans else ""
            if rows > 1:
                spans.append((place, place + cols, rows - 1, again))
            out.append((1, text))
            if cols > 1:
                out.append((cols - 1, again))
            place += cols
        take_spans_from_above()
        self.spans = spans
        return out

    def finish(self):
        """Column labels, body rows of equal width, and the number of rows in the markup."""
        self.close_row()
        # runs of one slot each need no counting of columns
        if any(slots > 1 for _, runs in self.rows for slots, _ in runs):
            column = _columns([runs for _, runs in self.rows])
            rows = [(head, _expanded(runs, column)) for head, runs in self.rows]
        else:
            rows = [(head, [text for _, text in runs]) for head, runs in self.rows]
        width = max((len(cells) for _, cells in rows), default=0)
        padded = [(head, cells + [""] * (width - len(cells))) for head, cells in rows]
        head = [cells for is_head, cells in padded if is_head]
        labels = [" ".join(filter(None, column)) for column in zip(*head)]
        return labels, [cells for is_head, cells in padded if not is_head], len(padded)


def _columns(rows: list[list[tuple[int, str]]]) -> dict[int, int]:
    """The column kept for each slot at which a run of some row begins or ends."""
    edges = {0}
    for runs in rows:
        edges.update(itertools.accumulate(slots for slots, _ in runs))
    column, last, kept = {}, 0, 0
    for edge in sorted(edges):
        kept += min(edge - last, _LONGEST_STRETCH)
        column[edge], last = kept, edge
    return column


def _expanded(runs: list[tuple[int, str]], column: dict[int, int]) -> list[str]:
    """A text for each column kept."""
    cells: list[str] = []
    place = 0
    for slots, text in runs:
        cells.extend([text] * (column[place + slots] - column[place]))
        place += slots
    return cells


def _span(pattern: re.Pattern, attrs: str, limit: int = _ENDLESS) -> int:
    found = pattern.search(attrs) if "span" in attrs.lower() else None
    if not found:
        return 1
    digits = found[1].lstrip("0")
    if not digits:  # rowspan=0 reaches to the end of the section
        return limit if pattern is _ROWSPAN else 1
    return min(int(digits), limit) if len(digits) < 19 else limit


def _cell_text(raw: str) -> str:
    if "&" in raw:
        raw = html_entities.unescape(raw)
    return _LINE_SPACE.sub(" ", raw.strip())


def _tag(name: str | None) -> str | None:
    """The tag of a name as written, with its slash, if it shapes text or tables."""
    if name is None:
        return None
    tag = name.lower()
    return tag if tag.lstrip("/") in _SHAPING else None


def _table_tree(tags: list) -> list[list[int]]:
    """``[start, end, depth]`` of all tables, by their opening tags; an open table ends with the document.

    A table that opens between two cells of another cannot be in a cell of it: the other one lacks its closing tag and ends
    with the last of its own tags.
    """
    found, open_, in_cell, last = [], [], [], []
    for i, tag in enumerate(tags):
        if tag is None:
            continue
        if tag == "table":
            while open_ and not in_cell[-1]:
                open_.pop()[1] = last.pop()
                in_cell.pop()
            found.append([i, len(tags), len(open_)])
            open_.append(found[-1])
            in_cell.append(False)
            last.append(i)
        elif open_:
            if tag == "/table":
                open_.pop()[1] = i
                in_cell.pop()
                last.pop()
            elif tag in _IN_CELL:
                in_cell[-1], last[-1] = _IN_CELL[tag], i
    return found


def _own_tags(
    names: list, tags: list, attrs: list, texts: list, table: list[int], within: list[list[int]], nested: bool
):
    """Tags, attributes and texts inside a table: those of the tables in its cells left out, or without their shape."""
    start, end, _ = table
    own = tags[start + 1 : end], attrs[start + 1 : end], texts[start + 1 : end]
    if not within:
        return own
    out, at = ([], [], []), 0
    for first, last, _ in within:
        first, last = first - start - 1, min(last, end) - start - 1
        for part, whole in zip(out, own):
            part.extend(whole[at:first])
        # the text after the last tag of a table is in the cell again
        at = last if nested else first
        rest = min(last + 1, len(own[0]))
        out[0].extend("br" if n in ("br", "BR") else None for n in names[start + 1 + at : start + 1 + rest])
        out[1].extend(own[1][at:rest])
        out[2].extend(own[2][at:rest])
        at = rest
    for part, whole in zip(out, own):
        part.extend(whole[at:])
    return out


def _text_runs(first: str, tags: list, texts: list) -> Iterator[str]:
    """Text between block tags, on one line."""
    run = [first]
    for tag, text in zip([*tags, "/body"], [*texts, ""]):
        if tag in ("br", "/br"):
            run.append(" ")
        elif tag is not None:
            line = " ".join(html_entities.unescape("".join(run)).split())
            if line:
                yield line
            run.clear()
        run.append(text)


def _read_table(tags: list, attrs: list, texts: list, fill_spans: bool):
    """Column labels, rows and row count of the table whose own tags are given."""
    grid = _Grid(fill_spans)
    for tag, attr, text in zip(tags, attrs, texts):
        if tag in _SHAPES:
            grid.on_tag(*_SHAPES[tag], attr)
        elif tag in ("br", "/br"):
            text = "\n" + text
        if text and grid.cell is not None:
            grid.cell[3].append(text)
    return grid.finish()


def parse_elements(
    document: str,
    with_text: bool = False,
    fill_spans: bool = False,
    table_filter: re.Pattern | None = None,
    nested: bool = False,
) -> list[dict]:
    """Tables and, if wanted, runs of text between block tags, in document order.

    With ``nested`` a table within a cell is a table of its own, after the one it is in, and its text no part of the cell;
    otherwise only outermost tables count. Tables in whose text ``table_filter`` finds nothing are numbered but left out.
    """
    parts = _MARKUP.split(document)
    names, attrs, texts = parts[1::3], parts[2::3], parts[3::3]
    tags = [_TAGS[name] for name in names]
    elements: list[dict] = []
    seq, position, before = 0, 0, parts[0]
    tree = _table_tree(tags)
    outer = [k for k, (_, _, depth) in enumerate(tree) if depth == 0]

    def add_table(table: list[int], within: list[list[int]]):
        nonlocal seq
        own = _own_tags(names, tags, attrs, texts, table, within, nested)
        if table_filter is None or table_filter.search(
            html_entities.unescape("".join([texts[table[0]], *own[2]]))
        ):
            labels, rows, n_rows = _read_table(*own, fill_spans)
            element = {"tag": "table", "n_rows": n_rows, "col_labels": labels, "rows": rows}
            elements.append({"elem_seq": seq, **element})
        seq += 1

    def add_tables(tables: list[list[int]]):
        """An outermost table and, if they count, those in its cells."""
        above: list[int] = []
        within: list[list] = [[] for _ in tables]
        for k, (_, _, depth) in enumerate(tables):
            del above[depth:]
            if above:
                within[above[-1]].append(tables[k])
            above.append(k)
        for table, inner in zip(tables if nested else tables[:1], within):
            add_table(table, inner)

    for first, next_ in zip([*outer, None], [*outer[1:], len(tree), None]):
        start, end = tree[first][:2] if first is not None else (len(names), None)
        if with_text:
            for run in _text_runs(before, tags[position:start], texts[position:start]):
                elements.append({"elem_seq": seq, "tag": "text", "n_rows": 0, "text": run})
                seq += 1
        if end is None:
            break
        add_tables(tree[first:next_])
        position, before = end + 1, "".join(texts[end : end + 1])
    return elements


def _lists(values: list, kind: Callable[[list], pa.Array]) -> pa.Array:
    """Lists of what ``kind`` makes an array of; a null for each None."""
    ends = itertools.accumulate((0 if v is None else len(v) for v in values), initial=0)
    flat = kind(list(itertools.chain.from_iterable(v for v in values if v is not None)))
    absent = pa.array([v is None for v in values], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=absent)


def _arrow(parsed: list[list[dict] | None]) -> pa.Array:
    """Elements as Arrow has them, a column at a time: far cheaper than one by one."""
    strings = lambda values: _lists(values, lambda flat: pa.array(flat, pa.string()))

    def structs(elements: list[dict]) -> pa.Array:
        column = lambda name: [e.get(name) for e in elements]
        plain = [pa.array(column(f.name), f.type) for f in _ARROW_TYPE.value_type.fields[:4]]
        made = [*plain, strings(column("col_labels")), _lists(column("rows"), strings)]
        return pa.StructArray.from_arrays(made, fields=_ARROW_TYPE.value_type.fields)

    return _lists(parsed, structs).cast(_ARROW_TYPE)


def elements_of(
    html: Column,
    with_text: bool = False,
    fill_spans: bool = False,
    tables_with: str | None = None,
    nested: bool = False,
) -> Column:
    """``html`` -> array of elements; null for null.

    ``fill_spans`` repeats the text of a spanned cell in the slots it covers, which are empty
    otherwise. ``nested`` makes tables within cells tables of their own. With ``tables_with``, a pattern, only tables in whose text it is found are read any
    further: joining the text of a table is cheap beside taking it apart. The function is declared nondeterministic so that the optimizer never copies it
    into a second evaluation.
    """

    @F.arrow_udf(ELEMENT_TYPE)
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table_filter = tables_with and re.compile(tables_with, re.IGNORECASE)
        for batch in batches:
            documents = (value.as_py() for value in batch)
            parsed = [
                None
                if doc is None
                else parse_elements(doc, with_text, fill_spans, table_filter, nested)
                for doc in documents
            ]
            yield _arrow(parsed)

    return parse.asNondeterministic()(html)
