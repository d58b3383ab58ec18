"""The queries in SQL for DuckDB, built from common table expressions."""

from checks.inputs import SENTENCE_TOKENS, TABLE_SPAN, TIMEFRAME


def _amount(n: str) -> str:
    text = f"(({n}) % 500) // 100 || '.' || lpad(cast((({n}) % 500) % 100 as varchar), 2, '0')"
    return f"case when ({n}) % 5 = 0 then '(' || {text} || ')' else '$' || {text} end"


LINES = f"""
lines as (
  select o_custkey as custkey, o_orderkey as k, o_orderstatus = 'F' as head,
         year(o_orderdate) as y
  from orders
),
cells as (
  select custkey, k,
    case when head then case when k % 2 = 0 then 'Earnings per share' else 'Balance sheet' end
         when k % 3 = 0 then 'Basic, net' when k % 3 = 1 then 'Diluted'
         else 'Adjusted EPS (non-GAAP)' end as label,
    case when head and k % 4 = 0 then cast(y as varchar) when head then ''
         else {_amount("k")} end as c1,
    case when head and k % 4 = 0 then cast(case when k % 8 = 0 then y + 1 else y - 1 end as varchar)
         when head or k % 7 = 0 then '' else {_amount("k * 3 + 11")} end as c2
  from lines
)"""

GRID = f"""{LINES},
grid as (
  select 'cust-' || custkey as filename, k // {TABLE_SPAN} as table_seq,
         row_number() over (partition by custkey, k // {TABLE_SPAN} order by k) as row_idx,
         label, c1, c2
  from cells
)"""

LONG = f"""{LINES},
grid as (select 'all' as filename, cast(0 as bigint) as table_seq, k as row_idx, label, c1, c2
         from cells)"""

FACTS = f"""
facts as (
  select *,
    not regexp_matches(label || ' ' || c1 || ' ' || c2, '\\.[0-9]') as is_header,
    instr(label || ' ' || c1 || ' ' || c2, '{TIMEFRAME - 1}') as before_at,
    instr(label || ' ' || c1 || ' ' || c2, '{TIMEFRAME}') as year_at
  from grid
),
starts as (
  select *,
    is_header and not coalesce(lag(is_header) over w and lag(row_idx) over w = row_idx - 1, false)
      as starts,
    bool_or(before_at > 0 and before_at < year_at) over w as reverse
  from facts window w as (partition by filename, table_seq order by row_idx)
),
framed as (
  select *, max(case when starts then row_idx end)
              over (partition by filename, table_seq order by row_idx) as group_start
  from starts
),
headers as (
  select filename, table_seq, group_start, string_agg(label, ' ' order by row_idx) as header
  from framed where is_header group by all
),
grouped as (
  select framed.*, headers.header from framed
  left join headers using (filename, table_seq, group_start)
),
context as (
  select filename, table_seq, row_idx, label, c1, c2, reverse,
         lower(concat_ws(' ', header, label)) as context
  from grouped where not is_header
)"""

VALUE = r"[(-]?\s*[$]?\s*[0-9]+\.[0-9]+"

VALUES = rf"""
tokens as (
  select *, case when reverse
    then coalesce(nullif(regexp_extract(c2, '{VALUE}'), ''), nullif(regexp_extract(c1, '{VALUE}'), ''))
    else coalesce(nullif(regexp_extract(c1, '{VALUE}'), ''), nullif(regexp_extract(c2, '{VALUE}'), ''))
    end as token
  from context
),
signed as (
  select *, value < 0 as is_loss from (
    select *, try_cast(regexp_replace(token, '[($ ]', '', 'g') as double)
              * case when contains(token, '(') then -1.0 else 1.0 end as value
    from tokens where token is not null)
)"""

EPS_CONTEXT = (
    r"(regexp_matches(context, '\b(epss?|e\.p\.ss?)\b')"
    r" or regexp_matches(context, '\b(income|earnings|loss)s?.*?pers?.*?shares?\b'))"
)

CANDIDATES = rf"""
candidates as (
  select filename, 'table' as source, table_seq, row_idx, value,
    case when contains(context, 'basic') then 'basic'
         when contains(context, 'diluted') then 'diluted' end as type,
    regexp_matches(context, '\b(non[- ]?g\.?a\.?a\.?p\.?|adjusted)\b') as is_adjusted,
    is_loss, contains(context, 'net') or contains(context, 'total') as is_net, context
  from signed where {EPS_CONTEXT}
)"""

SCORE = """case type when 'basic' then 100 when 'diluted' then 50 else 0 end
  + case when is_adjusted then 0 else 100 end + case when is_net then 50 else 0 end
  + case when is_loss then 50 else 0 end"""

SCORES = f"""
scores as (select *, cast({SCORE} as bigint) as score from candidates),
ranked as (
  select *, row_number() over (partition by filename
              order by score desc, table_seq, row_idx) as place
  from scores
),
winners as (select filename, value from ranked where place = 1),
filings as (select distinct 'cust-' || o_custkey as filename from orders),
eps as (
  select filename, coalesce(value, 0.0) + 0.0 as EPS from filings left join winners using (filename)
)"""

CONTEXT = f"with {GRID}, {FACTS}"
ALL = f"{CONTEXT}, {VALUES}, {CANDIDATES}, {SCORES}"
KEYS = "filename, table_seq, row_idx"

# Both number columns typed as a whole; the second holds years, gaps and amounts with signs.
NUMBERS = f"""{LINES},
raw as (
  select 'cust-' || custkey as filename, k // {TABLE_SPAN} as table_seq,
         row_number() over (partition by custkey, k // {TABLE_SPAN} order by k) as row_idx, label,
         case custkey % 5
           when 0 then cast(k % 4000 as varchar)
           when 1 then case when k % 3 = 0 then '' else cast(k % 4000 as varchar) end
           when 2 then case when k % 2 = 0 then (k % 500) // 100 || '.' || lpad(cast(k % 100 as varchar), 2, '0')
                            else cast(k % 4000 as varchar) end
           when 3 then case when k % 5 = 0 then 'see note'
                            else (k % 500) // 100 || '.' || lpad(cast(k % 100 as varchar), 2, '0') end
           else case when k % 2 = 0 then 'true' else 'FALSE' end end as c, c2 as d
  from cells
),
flags as (
  select filename, table_seq, max(row_idx) as last_row,
    bool_or(c <> '' and not regexp_full_match(c, '[0-9]+([.][0-9]+)?|true|FALSE')) as words,
    bool_or(c in ('true', 'FALSE')) as truths, bool_or(contains(c, '.')) as points,
    bool_or(regexp_full_match(c, '[0-9]+')) as wholes, bool_or(c = '') as gaps,
    bool_or(d <> '' and not regexp_full_match(d, '[0-9]+')) as words2,
    bool_or(regexp_full_match(d, '[0-9]+')) as wholes2, bool_or(d = '') as gaps2
  from raw group by all
),
types as (
  select *, case when words then 'text' when truths then 'truth'
                 when points or (wholes and gaps) then 'decimal' when wholes then 'whole' else 'empty' end as type,
    case when words2 then 'text' when wholes2 and gaps2 then 'decimal' when wholes2 then 'whole' else 'empty' end as type2
  from flags
),
grid as (
  select filename, table_seq, row_idx, label,
    case when type2 = 'decimal' and d <> '' then cast(cast(d as double) as varchar) else d end as c2,
    case when c = '' or type = 'text' then c when type = 'truth' then upper(c[1]) || lower(c[2:])
         when type = 'decimal' then cast(cast(c as double) as varchar)
         else cast(cast(c as bigint) as varchar) end as c1
  from raw join types using (filename, table_seq)
)"""
NUMBERS_ALL = f"with {NUMBERS}, {FACTS}, {VALUES}, {CANDIDATES}, {SCORES}"


# Each statement table is a document of its own; one of a single row has no table.
def _documents(base: str) -> str:
    return f"""{base},
sizes as (select filename, table_seq, count(*) as n_rows from grid group by all),
named as (select filename || '-' || table_seq || '.html' as doc, * from sizes),
best as (
  select filename, table_seq, value, row_number() over (partition by filename, table_seq
           order by score desc, row_idx) as place
  from scores
)"""
def _document_eps(base: str) -> str:
    return f"""{_documents(base)}
select doc as filename, coalesce(value, 0.0) + 0.0 as EPS
from named left join (select * from best where place = 1) using (filename, table_seq)
where n_rows > 1
union all
select doc, 0.0 from named where n_rows = 1"""


DOCUMENTS = _documents(ALL)
DOCUMENT_EPS = _document_eps(ALL)

# News by order: values by table and by text, and whether the bytes can be read.
NEWS = """
with orders_ as (select o_orderkey as k, o_orderkey % 500 as cents from orders),
news as (
  select k, 'q' || k % 2 || '.html' as filename, k % 13 <> 0 and k % 11 <> 0 as readable,
    case when k % 4 = 0 then case when k % 5 = 0 then -cents / 100.0 else cents / 100.0 end end as by_table,
    case when k % 3 <> 0 then k % 9 + (k % 100) / 100.0
         when k % 2 = 0 and k % 5 <> 0 then cents / 100.0 end as by_text
  from orders_
)"""

PADDED = f"""with {GRID},
padded as (
  select {KEYS}, case when row_idx % 4 = 0 then [null, ' ', ' ', ' ', ' ']
         else ['  ' || label, null, c1 || chr(9) || ' ', ' ', c2] end as cells
  from grid
),
cleaned as (
  select {KEYS}, list_transform(cells, lambda c: trim(coalesce(c, ''), ' ' || chr(9))) as cells
  from padded
)"""

SENTENCES = r"""
protected as (
  select doc_id, regexp_replace(text,
    '(?i)(^|[^\pL\pN_])(approx|co|corp|dr|e\.p\.s|inc|ltd|mr|mrs|ms|no|u\.s|vs)\.',
    '\1\2' || chr(57344), 'g') as text
  from documents
),
pieces as (
  select doc_id, string_split(regexp_replace(text, '([.!?]["'')\]”’]*)\s+',
                                             '\1' || chr(57345), 'g'), chr(57345)) as pieces
  from protected
),
sentences as (
  select doc_id, unnest(range(len(pieces))) as sent_idx,
         trim(replace(unnest(pieces), chr(57344), '.'), chr(32) || chr(10) || chr(9)) as sentence
  from pieces
)"""

VECTORS = f"""
tokens as (
  select vec_id // {SENTENCE_TOKENS} as sid, vec_id % {SENTENCE_TOKENS} as place,
         cast(embedding as double[]) as vec,
         case when vec_id % {SENTENCE_TOKENS} in (3, 8) then cast(label as varchar)
              else (['EPS', 'of', '$', '', '.', '5', 'or', '$', '', '.25', 'eps', '$', '3', 'x',
                     '$', '1.5'])[vec_id % {SENTENCE_TOKENS} + 1] end as tok
  from embeddings
),
dims as (
  select sid, i as dim, avg(vec[i + 1]) as mean
  from tokens, range(64) as dims(i) where contains(lower(tok), 'eps') group by sid, i
),
anchors as (select sid, list(mean order by dim) as anchor from dims group by sid),
runs as (
  select d.sid, d.place as tok_idx, d.vec, string_agg(n.tok, '' order by n.place) as run
  from tokens d join tokens n on d.sid = n.sid and n.place > d.place
  where d.tok = '$' and not exists (
    select 1 from tokens s where s.sid = d.sid and s.place > d.place and s.place <= n.place
      and not regexp_full_match(s.tok, '[0-9]+\\.?[0-9]*|\\.[0-9]+|[.,]'))
  group by all
),
near as (
  select sid, tok_idx, replace(run, ',', '') as num,
         list_cosine_similarity(vec, anchor) as sim
  from runs join anchors using (sid) where contains(run, '.')
),
nearest as (
  select * from (select *, row_number() over (partition by sid order by sim desc, tok_idx) as place
                 from near) where place = 1 and sim > 0
)"""

ORACLES = {
    "eps_final": f"{ALL} select filename, EPS from eps",
    "eps_from_html": DOCUMENT_EPS,
    "stream_filings": DOCUMENT_EPS,
    "eps_with_text": f"""
        select 'news-' || k || '.html' as filename, round(case
          when k % 4 = 0 then case when k % 5 = 0 then -cents / 100.0 else cents / 100.0 end
          when k % 3 <> 0 then k % 9 + (k % 100) / 100.0
          when k % 2 = 0 and k % 5 <> 0 then cents / 100.0
          else 0.0 end, 4) + 0.0 as EPS
        from (select o_orderkey as k, o_orderkey % 500 as cents from orders)""",
    "eps_status": f"""{DOCUMENTS},
        valued as (
          select doc as filename, cast(substr(named.filename, 6) as bigint) as c, value
          from named left join (select * from best where place = 1 and true) b
            on named.filename = b.filename and named.table_seq = b.table_seq and n_rows > 1)
        select filename, case when c % 13 <> 0 and c % 11 <> 0 then coalesce(value, 0.0) + 0.0 end as EPS,
          case when c % 13 = 0 or c % 11 = 0 then 'undecodable' when value is null then 'none'
               else 'table' end as status
        from valued""",
    "eps_audit": f"""{NEWS}
        select 'news-' || k || '.html' as filename, round(coalesce(by_table, by_text, 0.0), 4) + 0.0 as EPS,
          cast(k % 4 = 0 as bigint) as n_unreadable,
          cast(by_table is null and k % 7 = 0 as bigint) as n_unreadable_text
        from news""",
    "eps_same_names": f"""{NEWS}
        select filename, case when readable then round(coalesce(by_table, by_text, 0.0), 4) + 0.0 end as EPS,
          case when not readable then 'undecodable' when by_table is not null then 'table'
               when by_text is not null then 'text' else 'none' end as status
        from news""",
    "eps_same_names_tables": f"""{NEWS}
        select filename, case when readable then round(coalesce(by_table, 0.0), 4) + 0.0 end as EPS,
          case when not readable then 'undecodable' when by_table is not null then 'table'
               else 'none' end as status
        from news""",
    "grid_from_html": f"""{DOCUMENTS}
        select doc as filename, row_idx - 1 as row_idx, concat_ws('|', label, c1, c2) as cells
        from grid join named using (filename, table_seq) where n_rows > 1""",
    "nested_grid": f"""{DOCUMENTS}
        select doc as filename, cast(2 as bigint) as table_seq, row_idx - 1 as row_idx,
          concat_ws('|', label, c1, c2) as cells
        from grid join named using (filename, table_seq) where n_rows > 1
        union all
        select doc, table_seq_, row_idx, cells from named, (values
          (0, 0, 'Contents|1.00'), (0, 1, 'EPS|'), (1, 0, 'Menu|Results' || 'as filed'),
          (1, 1, 'Foot|Page 2')) as frame(table_seq_, row_idx, cells)""",
    "eps_from_layout": DOCUMENT_EPS,
    "table_elements": f"""{DOCUMENTS}
        select doc as filename, cast(1 as bigint) as elem_seq, n_rows from named where n_rows > 1""",
    "page_text_elements": r"""with
        marked as (
          select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
            '(?is)<!--.*?-->|<(script|style|title)[^>]*>.*?</(script|style|title)>', '', 'g'),
            '\s+', ' ', 'g'),
            '(?i)<br[^>]*>', ' ', 'g'),
            '(?i)</?(html|head|body|nav|ul|li|div|article|h1|p|footer)(\s[^>]*)?>', chr(10), 'g') as t
          from pages),
        pieces as (
          select page_id, string_split(regexp_replace(t, '<[^>]*>', '', 'g'), chr(10)) as pieces
          from marked),
        runs as (
          select page_id, unnest(range(len(pieces))) as pos,
            trim(regexp_replace(replace(replace(replace(replace(unnest(pieces), '&copy;', '©'),
              '&middot;', '·'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) as text
          from pieces)
        select cast(page_id as varchar) as filename,
          row_number() over (partition by page_id order by pos) - 1 as elem_seq, text
        from runs where text <> ''""",
    "clean_cells": f"{PADDED} select {KEYS}, array_to_string(cells, '|') as cells from cleaned",
    "drop_empty_rows": f"""{PADDED} select {KEYS}, array_to_string(cells, '|') as cells
        from cleaned where array_to_string(cells, '') <> ''""",
    "drop_empty_columns": f"""{PADDED},
        used as (select filename, table_seq,
                        [bool_or(cells[1] <> ''), bool_or(cells[2] <> ''), bool_or(cells[3] <> ''),
                         bool_or(cells[4] <> ''), bool_or(cells[5] <> '')] as used
                 from cleaned group by all)
        select {KEYS}, array_to_string(list_filter(cells, lambda c, i: used[i]), '|') as cells
        from cleaned join used using (filename, table_seq)""",
    "column_types": f"""with {NUMBERS}
        select filename, table_seq, cast(0 as bigint) as col_idx, 'text' as type, last_row from types
        union all
        select filename, table_seq, 1, type, last_row from types
        union all
        select filename, table_seq, 2, type2, last_row from types""",
    "retyped_columns": f"with {NUMBERS} select {KEYS}, concat_ws('|', label, c1, c2) as cells from grid",
    "eps_typed_columns": f"{NUMBERS_ALL} select filename, EPS from eps",
    "eps_typed_html": _document_eps(NUMBERS_ALL),
    "row_labels": f"""{PADDED} select {KEYS},
        list_filter(cells, lambda c: c <> '')[1] as label from cleaned""",
    "header_rows": f"{CONTEXT} select {KEYS}, is_header from facts",
    "year_order": f"{CONTEXT} select {KEYS}, reverse from starts",
    "header_groups": f"{CONTEXT} select {KEYS}, is_header, group_start, header from grouped",
    "row_context": f"{CONTEXT} select {KEYS}, context, reverse from context",
    "long_table_context": f"with {LONG}, {FACTS} select {KEYS}, context, reverse from context",
    "eps_rows": f"{CONTEXT} select {KEYS}, context from context where {EPS_CONTEXT}",
    "row_values": f"{CONTEXT}, {VALUES} select {KEYS}, token from tokens where token is not null",
    "signed_values": f"{CONTEXT}, {VALUES} select {KEYS}, value + 0.0 as value, is_loss from signed",
    "eps_types": rf"""{CONTEXT} select {KEYS}, concat_ws('|',
          case when contains(context, 'basic') then 'basic' end,
          case when contains(context, 'diluted') then 'diluted' end,
          case when contains(context, 'net') or contains(context, 'total') then 'net' end,
          case when adjusted then 'non-gaap' end,
          case when not adjusted and regexp_matches(context,
            '\b(g\.?a\.?a\.?p\.?|unadjusted|un[- ]?adjusted|non[- ]?adjusted)\b') then 'gaap' end
        ) as labels
        from (select *, regexp_matches(context, '\b(non[- ]?g\.?a\.?a\.?p\.?|adjusted)\b') as adjusted
              from context)""",
    "candidates": f"{ALL} select * replace (value + 0.0 as value) from candidates",
    "scores": f"{ALL} select {KEYS}, score from scores",
    "top_candidate": f"{ALL} select filename, value + 0.0 as value from winners",
    "top_candidate_rows": f"""{ALL} select {KEYS}, value + 0.0 as value, type, score, context
        from ranked where place = 1""",
    "default_zero": f"{ALL} select filename, EPS from eps",
    "fallback": f"""{ALL},
        texts as (
          select 'cust-' || o_custkey as filename, o_totalprice as value, o_orderkey as k,
                 case when o_orderkey % 2 = 0 then 'basic' else 'diluted' end as type,
                 o_orderkey % 3 = 0 as is_adjusted, false as is_loss, o_orderkey % 5 = 0 as is_net
          from orders where o_custkey % 5 < 2),
        by_text as (
          select filename, value as text_value from (
            select *, row_number() over (partition by filename order by {SCORE} desc, k) as place
            from texts) where place = 1),
        by_table as (
          select filename, value as table_value from winners
          where cast(substr(filename, 6) as bigint) % 3 <> 0)
        select filename, coalesce(table_value, text_value, 0.0) + 0.0 as EPS
        from filings left join by_table using (filename) left join by_text using (filename)""",
    "sentences": f"""with {SENTENCES}
        select doc_id, sent_idx, sentence from sentences where sentence <> ''""",
    "sentence_variants": rf"""with {SENTENCES}
        select doc_id, sent_idx, cast(0 as bigint) as variant_idx, 'the' as phrase from sentences
        where regexp_matches(sentence, '(?i)(^|[^\pL\pN_])thes?($|[^\pL\pN_])')
        union all
        select doc_id, sent_idx, 1, 'of the' from sentences
        where regexp_matches(sentence, '(?i)(^|[^\pL\pN_])ofs?[^\n]*?thes?($|[^\pL\pN_])')
        union all
        select doc_id, sent_idx, 2, 'is on' from sentences
        where regexp_matches(sentence, '(?i)(^|[^\pL\pN_])iss?[^\n]*?ons?($|[^\pL\pN_])')""",
    "dollar_numbers": r"""with
        words as (
          select o_orderkey as k, ['EPS', 'of', '$', cast(o_orderkey % 13 as varchar), '.',
            cast(o_orderkey * 7 % 100 as varchar), 'up', 'from', '$',
            cast(o_orderkey * 3 % 9 as varchar), ',', cast(o_orderkey * 11 % 1000 as varchar), '.',
            cast(o_orderkey * 5 % 10 as varchar), '$', cast(o_orderkey * 2 % 50 as varchar),
            'percent', '$', (o_orderkey % 7) || '.' || (o_orderkey % 3),
            cast(o_orderkey % 4 as varchar), 'and', '$'] as w
          from orders),
        signs as (
          select k, w, unnest(list_filter(range(1, len(w) + 1), lambda i: w[i] = '$')) as pos
          from words),
        runs as (
          select k, pos, list_slice(w, pos + 1, list_min(list_filter(range(pos + 1, len(w) + 2),
            lambda i: i > len(w)
              or not regexp_full_match(w[i], '[0-9]+\.?[0-9]*|\.[0-9]+|[.,]'))) - 1) as run
          from signs)
        select k, replace(array_to_string(run, ''), ',', '') as num, pos - 1 as tok_idx
        from runs where contains(array_to_string(run, ''), '.')""",
    "anchor_tokens": """
        select doc_id, array_to_string(list_filter(string_split(text, ' '),
          lambda t: contains(lower(t), 'loss') or contains(lower(t), 'per')
            or contains(lower(t), 'share') or contains(lower(t), 'the')), '|') as anchors
        from documents""",
    "anchor_vectors": f"""with {VECTORS}
        select 's-' || sid as filename, dim, round(mean, 4) + 0.0 as mean from dims""",
    "nearest_number": f"""with {VECTORS}
        select 's-' || sid as filename, num, tok_idx, round(sim, 4) + 0.0 as sim from nearest""",
    "text_candidates": f"""with {VECTORS},
        valued as (select sid, try_cast(num as double) as value from nearest)
        select 's-' || sid as filename, 'text' as source, value,
          case sid % 3 when 0 then 'basic' when 1 then 'diluted' end as type,
          sid % 3 = 1 as is_adjusted, false as is_loss, sid % 3 = 2 as is_net,
          case sid % 3 when 0 then 'Basic EPS' when 1 then 'Diluted non-GAAP EPS'
                       else 'Total EPS' end as context
        from valued where value is not null""",
    "accuracy": f"""{ALL},
        numbered as (select *, cast(substr(filename, 6) as bigint) as c from eps),
        truth as (
          select case when c % 11 = 0 then filename || '-x' else filename end as filename,
                 case when c % 10 = 0 then EPS + 1 else EPS end as true_eps
          from numbered where c % 7 <> 0),
        compared as (
          select e.filename is not null as here, t.filename is not null as there,
                 e.filename is not null and t.filename is not null and EPS = true_eps as same
          from eps e full join truth t on e.filename = t.filename)
        select count(*) as n_filings, count(*) filter (same) as n_equal,
               count(*) filter (not here) as n_missing, count(*) filter (not there) as n_extra,
               round(avg(cast(same as int)), 4) as accuracy
        from compared""",
    "scan_filings": """
        select 'page ' || page_id || '.html' as filename, length(html) as n_chars from pages""",
    "write_results": f"{ALL} select filename, EPS from eps",
}
