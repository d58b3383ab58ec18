"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host.

A page is a stream of blocks, each with the path of the elements around it. Runs that repeat are folded into repeated groups. The
streams of a host are aligned one after the other: what only one side has becomes optional, what repeats on either
side is repeated, what matches stays; the texts are the slots. Partial wrappers of parts of a host are aligned
in the same way, so a host with very many pages is no single group. A page is matched with its host's wrapper position by
position; what has no place of its own goes to the nearest repeated slot of its path. A text that nearly all different pages which
fill a slot have there (with enough such pages) is template; a slot that varies, and an optional one on the pages that have it, is text.

A page's text are its blocks inside the article (or main, or else the body) that are neither template nor within menus, headers,
footers, forms and the like by their element names. Words of classes, ids and roles only choose between what is left: blocks in
elements with words of sidebars, notices, adverts or comments go if others stay. Words on main or article, or on
what encloses them, count only against another article.

Rules. Null and empty pages have an empty text; pages whose url is null or has no host are one host. Elements that are not closed end
where their parent or the next block that cannot be inside them does; tags and comments that do not end are text to the
end of the page. Pages are different if the longer texts of their main parts are, so copies count once. Where over half of an article
would be template, its pages are copies, and it stays. Character references are decoded, ``br`` and table cells count as white space. Repeated rows count each.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, free_name, stored

#: Parts into which the pages of a host are dealt.
SALTS = 16
#: Different pages that have a text in a slot before it counts as template, and their share of those that fill the slot.
TEMPLATE_PAGES = 20
TEMPLATE_SHARE = 0.9
#: Wrappers, and streams matched with them, that a task keeps at hand.
AT_HAND = 1000
#: Characters of a text that tells different pages apart.
LONG = 40
#: Elements in a block's path.
PATH = 12

#: Element names by what they do to text.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead caption tr ul".split())
RAW = frozenset("script style textarea title noscript iframe template svg math object select button canvas audio video head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACING = frozenset("br td th option".split())
CLOSES_P = BLOCKS - {"html", "body"}
NEVER = frozenset("nav aside footer form menu dialog fieldset".split())
#: Words of classes, ids and roles around text that is not the article.
NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars aside complementary widget comment comments commentlist reply replies respond disqus share sharing social related recommended recommendations newsletter subscribe subscription signup login modal popup overlay toolbar pagination pager copyright contentinfo footer skip paywall".split()
)
OUTER_WORDS = frozenset("header masthead topbar".split())
#: In classes such as with-sidebar or no-comments, what follows these words is not what the element is.
MODIFIERS = frozenset("with has no without show hide is not".split())
#: What speaks against a block: nothing; words on the article or main around it, or outside them; words on another element; an element's name.
CLEAR, AROUND, WORDS, NAMED = range(4)

_TAG = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:\s|["'])hidden(?=[\s=>/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORDS = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z])(?=[A-Z])")


def _tag_end(page: str, at: int) -> int:
    """Place after the ``>`` that ends the tag, quoted values aside; -1 if there is none."""
    end = page.find(">", at)
    if end < 0:
        return -1
    piece = page[at:end]
    if ("=\"" in piece and piece.count('"') % 2) or ("='" in piece and piece.count("'") % 2):
        mark = '"' if "=\"" in piece and piece.count('"') % 2 else "'"
        close = page.find(mark, end)
        further = page.find(">", close) if close > 0 else -1
        if 0 < further and page.find("<", end, close) < 0:
            return further + 1
    return end + 1


def _named_words(value: str) -> Iterator[str]:
    for token in value.split():
        parts = [w.lower() for w in _WORDS.split(token) if w]
        yield from () if parts and parts[0] in MODIFIERS else parts


def blocks(page: str) -> list[tuple[str, str, bool, str]]:
    """(path, text, kept, container) of every block with text in page order, by names and words alone."""
    return [(path, text, doubt < WORDS, where) for path, text, doubt, where in doubted(page)]


def doubted(page: str) -> list[tuple[str, str, int, str]]:
    """(path, text, doubt, container) of every block with text in page order; a path is the innermost ``PATH`` elements."""
    stack: list[tuple[str, str, int, str]] = []  # name, key, doubt, container
    counts: Counter = Counter()
    out: list[tuple[str, str, int, str]] = []
    parts: list[str] = []
    at, n = 0, len(page)

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                top = stack[-1] if stack else ("", "", CLEAR, "")
                out.append(("/".join(s[1] for s in stack[-PATH:]), text, top[2], top[3]))

    lowered = None
    while at < n:
        start = page.find("<", at)
        if start < 0:
            parts.append(page[at:])
            break
        if start > at:
            parts.append(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        found = _TAG.match(page, start + 1)
        if not found:
            end = page.find(">", start) if page[start + 1 : start + 2] in ("!", "?", "/") else -2
            if end == -2:
                parts.append("<")
                at = start + 1
            else:
                at = n if end < 0 else end + 1
            continue
        end = _tag_end(page, found.end())
        if end < 0:
            break
        closing, name, inside = bool(found[1]), found[2].lower(), page[found.end() : end - 1]
        at = end
        if name in RAW and not closing:
            if lowered is None:
                lowered = page.lower()
            if name == "head":
                stops = [x for x in (lowered.find("</head", at), lowered.find("<body", at)) if x >= 0]
                at = min(stops) if stops else at
            elif not inside.endswith("/"):
                stop = lowered.find(f"</{name}", at)
                after = page.find(">", stop) if stop >= 0 else -1
                at = after + 1 if after >= 0 else (n if stop >= 0 or name in ("script", "style") else at)
            continue
        if name in SPACING:
            parts.append(" ")
            continue
        block = name in BLOCKS
        if closing:
            if block and counts[name]:
                flush()
                while counts[name]:
                    gone = stack.pop()[0]
                    counts[gone] -= 1
                    if gone == name:
                        break
            elif block and name == "p":
                flush()
            continue
        if not block:
            continue
        flush()
        if name == "hr":
            continue
        if name in CLOSES_P and stack and stack[-1][0] == "p":
            counts[stack.pop()[0]] -= 1
        if name in ("li", "dd", "dt", "tr") and stack:
            same = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr",)}[name]
            if stack[-1][0] in same:
                counts[stack.pop()[0]] -= 1
        attributes = {a[0].lower(): a[1] or a[2] or a[3] for a in _ATTRIBUTE.findall(inside)}
        words = {w.lower() for value in attributes.values() for w in _WORDS.split(value) if w}
        within = stack[-1][3] if stack else ""
        told = {w for value in attributes.values() for w in _named_words(value)}
        doubt, inner = stack[-1][2] if stack else CLEAR, name == "article" or name == "main" and not within
        if inner and doubt == WORDS and not within:
            doubt = AROUND
        if name in NEVER or _HIDDEN.search(inside) or name == "header" and not within:
            doubt = NAMED
        elif told & NEVER_WORDS or not within and told & OUTER_WORDS and name not in ("article", "main"):
            doubt = max(doubt, AROUND if inner else WORDS)
        key = name + "".join("." + w for w in sorted(words)) if name not in ("html", "body") else name
        if name in ("html", "body"):
            doubt = CLEAR
        if not inside.endswith("/"):
            stack.append((name, key, doubt, name if inner else within))
            counts[name] += 1
    flush()
    return out


def folded(stream: list[str]) -> list[tuple[str, bool]]:
    """The stream with runs of one to three items that repeat folded into repeated items."""
    return folds(stream)[0]


def folds(stream: list[str]) -> tuple[list[tuple[str, bool]], list[int]]:
    """The folded stream, and the place in it of each item."""
    out: list[tuple[str, bool, list[int]]] = []
    for at, item in enumerate(stream):
        out.append((item, False, [at]))
        for period in (1, 2, 3):
            tail, before = out[-period:], out[-2 * period : -period]
            if len(before) == period and [x[0] for x in tail] == [x[0] for x in before]:
                for x, y in zip(before, tail):
                    x[2].extend(y[2])
                out[-2 * period :] = [(x, True, own) for x, _, own in before]
                break
    place = [0] * len(stream)
    for i, (_, _, own) in enumerate(out):
        for at in own:
            place[at] = i
    return [(x, again) for x, again, _ in out], place


def aligned(wrapper: list[list], other: list[list]) -> list[list]:
    """Two wrappers, lists of [path, repeated, optional], as one that fits what either fits."""
    out: list[list] = []
    matcher = SequenceMatcher(None, [w[0] for w in wrapper], [o[0] for o in other], autojunk=False)
    for kind, a, b, c, d in matcher.get_opcodes():
        if kind == "equal":
            out.extend([w[0], w[1] or o[1], w[2] or o[2]] for w, o in zip(wrapper[a:b], other[c:d]))
        else:
            out.extend([*w[:2], True] for w in [*wrapper[a:b], *other[c:d]])
    # what became a run of one item is one repeated item
    merged: list[list] = []
    for item in out:
        if merged and merged[-1][0] == item[0]:
            merged[-1] = [item[0], True, merged[-1][2] and item[2]]
        else:
            merged.append(item)
    return merged


def _matcher(wrapper: list[list]) -> SequenceMatcher:
    return SequenceMatcher(None, [], [w[0] for w in wrapper], autojunk=False)


def matched(wrapper: list[list], paths: list[str], matcher: SequenceMatcher | None = None) -> list[str]:
    """The slot of the wrapper that each path of a folded stream fills; what fits none is a slot by its own path."""
    matcher = matcher or _matcher(wrapper)
    matcher.set_seq1(paths)
    slots: list[int | None] = [None] * len(paths)
    for a, b, n in matcher.get_matching_blocks():
        slots[a : a + n] = range(b, b + n)
    repeated: dict[str, list[int]] = {}
    for i, (path, again, _) in enumerate(wrapper):
        if again:
            repeated.setdefault(path, []).append(i)
    out, last = [], 0
    for path, slot in zip(paths, slots):
        if slot is not None:
            last = slot
        elif path in repeated:
            slot = min(repeated[path], key=lambda i: abs(i - last))
        out.append(path if slot is None else str(slot))
    return out


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _main(found: list[tuple[str, str, int, str]]) -> list[tuple[str, str, int, str]]:
    """Blocks of articles and main, or else all, that no element's name speaks against."""
    some = [x for x in found if x[2] < NAMED]
    return [x for x in some if x[3]] or some


def identity(found: list[tuple[str, str, int, str]]) -> int:
    """Equal for copies of a page: a hash of the main part's different texts, without short ones (dates, counters) if there are long ones."""
    texts = {text for _, text, *_ in _main(found)}
    return _hash("\n".join(sorted({t for t in texts if len(t) >= LONG} or texts)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different folded streams of each host, and for each different page which text is where in its stream."""
    streams: set[tuple] = set()
    facts: set[tuple] = set()

    def rows() -> pa.RecordBatch:
        s, t = sorted(streams), sorted(facts)
        none = [None] * len(s)
        return pa.RecordBatch.from_pydict(
            {
                "host": pa.array([x[0] for x in s] + [x[0] for x in t], pa.string()),
                "stream": pa.array([x[1] for x in s] + [None] * len(t), pa.string()),
                "sid": pa.array([x[2] for x in s] + [x[1] for x in t], pa.int64()),
                "item": pa.array(none + [x[2] for x in t], pa.int32()),
                **{c: pa.array(none + [x[3 + i] for x in t], pa.int64()) for i, c in enumerate(("text", "page"))},
            }
        )

    for batch in batches:
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            found = doubted(page or "")
            items, place = folds([path for path, *_ in found])
            stream = json.dumps([[x, y, False] for x, y in items])
            sid, own = _hash(stream), identity(found)
            streams.add((host, stream, sid))
            facts.update((host, sid, at, _hash(text), own) for at, (_, text, doubt, _) in zip(place, found) if doubt < NAMED)
            if len(streams) + len(facts) > 50_000:
                yield rows()
                streams.clear()
                facts.clear()
    if streams or facts:
        yield rows()


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for each host (and part); rows come sorted, so one wrapper is held at a time."""
    held, wrapper = None, []
    for batch in batches:
        for key, stream in zip(zip(batch.column("host").to_pylist(), batch.column("salt").to_pylist()), batch.column("stream").to_pylist()):
            other = json.loads(stream)
            if key != held and held is not None:
                yield pa.RecordBatch.from_pydict({"host": [held[0]], "stream": [json.dumps(wrapper)]})
            wrapper = aligned(wrapper, other) if key == held else other
            held = key
    if held is not None:
        yield pa.RecordBatch.from_pydict({"host": [held[0]], "stream": [json.dumps(wrapper)]})


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slots of each stream's items by its host's wrapper."""
    known: dict[str, tuple] = {}
    for batch in batches:
        slots = []
        for stream, text in zip(batch.column("stream").to_pylist(), batch.column("wrapper").to_pylist()):
            if text not in known:
                if len(known) >= AT_HAND:
                    known.clear()
                wrapper = json.loads(text)
                known[text] = wrapper, _matcher(wrapper)
            wrapper, matcher = known[text]
            slots.append(matched(wrapper, [x[0] for x in json.loads(stream)], matcher))
        yield pa.RecordBatch.from_pydict({"host": batch.column("host"), "sid": batch.column("sid"), "slots": pa.array(slots, pa.list_(pa.string()))})


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))


def infer(pages: DataFrame) -> DataFrame:
    """(host, wrapper, template) for ``pages`` (host, html): the wrapper as JSON, and as JSON the slots and hashes of template texts."""
    size = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = stored(arrow_map(pages.select("host", "html"), _read, "host string, stream string, sid long, item int, text long, page long"), "streams")
    different = read.where("stream is not null").select("host", "stream", "sid").distinct()
    streams = different.drop("sid")
    parts = streams.withColumn("salt", F.pmod(F.xxhash64("stream"), F.lit(SALTS)).cast("int"))
    for salted in (parts, None):
        rows = salted if salted is not None else streams.withColumn("salt", F.lit(0))
        streams = arrow_map(rows.repartition(size, "host", "salt").sortWithinPartitions("host", "salt", "stream"), _align, "host string, stream string")
    wrappers = stored(streams.withColumnRenamed("stream", "wrapper"), "wrappers")
    dealt = different.withColumn("salt", F.pmod("sid", F.lit(SALTS)).cast("int")).join(_salted(wrappers), ["host", "salt"])
    slots = stored(arrow_map(dealt.select("host", "sid", "stream", "wrapper"), _slots, "host string, sid long, slots array<string>"), "slots")
    facts = read.where("item is not null").withColumn("salt", F.pmod("page", F.lit(SALTS)).cast("int"))
    filled = facts.join(_salted(slots), ["host", "sid", "salt"]).select("host", F.element_at("slots", F.col("item") + 1).alias("slot"), "text", "page").distinct()
    filled = stored(filled, "filled")
    having = filled.groupBy("host", "slot", "text").agg(F.count("*").alias("n")).where(F.col("n") >= TEMPLATE_PAGES)
    whole = filled.select("host", "slot", "page").distinct().groupBy("host", "slot").agg(F.count("*").alias("m")).where(F.col("m") >= TEMPLATE_PAGES)
    fixed = having.join(whole, ["host", "slot"]).where(F.col("n") >= F.lit(TEMPLATE_SHARE) * F.col("m"))
    template = fixed.groupBy("host").agg(F.to_json(F.collect_list(F.struct("slot", "text"))).alias("template"))
    return wrappers.join(template, "host", "left")


def main_text(found: list[tuple[str, str, int, str]], template: list[bool]) -> str:
    """Text of a page's blocks, of which some are template."""
    inside = [(len(text), fixed) for (_, text, doubt, where), fixed in zip(found, template) if where and doubt < NAMED]
    if 2 * sum(n for n, fixed in inside if fixed) > sum(n for n, _ in inside):
        template = [fixed and not where for (*_, where), fixed in zip(found, template)]  # an article of template is one of copies
    left = [(where, doubt, text) for (_, text, doubt, where), fixed in zip(found, template) if doubt < NAMED and not fixed]
    for wanted in (
        lambda where, doubt: where == "article" and doubt == CLEAR,
        lambda where, doubt: where and doubt < WORDS,
        lambda where, doubt: where,
        lambda where, doubt: doubt == CLEAR,
        lambda where, doubt: True,
    ):
        texts = [text for where, doubt, text in left if wanted(where, doubt)]
        if texts:
            return "\n".join(texts)
    return ""


def _extractor(names: tuple[str, ...]):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, tuple] = {}
        placed: dict[tuple, list[str]] = {}
        for batch in batches:
            texts = []
            for page, *own in zip(*(batch.column(c).to_pylist() for c in names)):
                found, key = doubted(page or ""), tuple(own)
                if key not in known:
                    if len(known) >= AT_HAND:
                        known.clear()
                    wrapper = json.loads(own[0] or "[]")
                    known[key] = wrapper, _matcher(wrapper), {(x["slot"], x["text"]) for x in json.loads(own[1] or "[]")}
                wrapper, matcher, fixed = known[key]
                template = [False] * len(found)
                if fixed:
                    items, place = folds([path for path, *_ in found])
                    stream = (own[0], *(x for x, _ in items))
                    if stream not in placed:
                        if len(placed) >= AT_HAND:
                            placed.clear()
                        placed[stream] = matched(wrapper, list(stream[1:]), matcher)
                    slots = placed[stream]
                    template = [(slots[at], _hash(text)) in fixed for at, (_, text, *_) in zip(place, found)]
                texts.append(main_text(found, template))
            columns = {c: batch.column(c) for c in batch.schema.names if c not in names[1:]}
            columns[f"{names[0]}_text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return step


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (url, html) with the main text as ``text``."""
    host, salt, wrapper, template = (free_name(pages, c) for c in ("host", "salt", "wrapper", "template"))
    address = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))
    known = _salted(infer(pages.select(address.alias("host"), "html"))).select("host", "salt", "wrapper", "template").toDF(host, salt, wrapper, template)
    asked = pages.withColumns({host: address, salt: F.pmod(F.xxhash64("url", "html"), F.lit(SALTS)).cast("int")})
    joined = asked.join(known, [host, salt], "left").drop(host, salt)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema)
    made = arrow_map(joined, _extractor(("html", wrapper, template)), f"{schema}, html_text string")
    return made.withColumnRenamed("html_text", free_name(pages, "text"))
