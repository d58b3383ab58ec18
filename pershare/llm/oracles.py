"""SQL for the queries that SQL can express."""



def _mixing(docs: str, select: str) -> str:
    """Raking of ``docs`` unrolled; ``select`` takes from the kept rows."""
    margins = {"source": "s", "lang": "l", "topic": "t"}
    steps, last = [], "w0"
    for i in range(8):
        for margin in margins:
            name = f"w{len(steps) + 1}"
            held = f"sum(weight) over (partition by {margin})"
            steps.append(f"{name} as (select * replace (case when {held} > 0 then weight * target_{margin} / {held} else weight end as weight) from {last})")
            last = name
    targets = ", ".join(f"{s} as (select {m}, pow(sum(tokens), 0.5) / sum(pow(sum(tokens), 0.5)) over () * (select sum(tokens) from cells) as target_{m} from cells group by {m})" for m, s in margins.items())
    joins = " ".join(f"join {s} on c.{m} is not distinct from {s}.{m}" for m, s in margins.items())
    caps, factor = [], "0.5"
    for i in range(3):
        caps.append(f"c{i} as (select {factor} * 0.5 * sum(tokens) / sum(least(1.0, {factor} * ratio) * tokens) as c from ratios)")
        factor = f"(select c from c{i})"
    return rf"""
with topics as (
    select *, case when contains(coalesce(text, ''), 'licensed under') then 'legal' when contains(coalesce(text, ''), ' | ') then 'table' when contains(coalesce(text, ''), '$$$') then 'noise'
        when contains(coalesce(text, ''), '!! ') then 'shouting' when contains(coalesce(text, ''), chr(10) || '- ') then 'list' else 'prose' end as topic,
        len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) as n_tokens
    from {docs}
), cells as (select source, lang, topic, sum(n_tokens)::bigint as tokens from topics group by all),
{targets},
w0 as (select c.*, target_source, target_lang, target_topic, c.tokens::double as weight from cells c {joins}),
{", ".join(steps)},
ratios as (select *, case when tokens > 0 then weight / tokens else 0 end as ratio from {last}),
{", ".join(caps)},
kept as (
    select d.*, least(1.0, {factor} * r.ratio) as p from topics d join ratios r
    on d.source is not distinct from r.source and d.lang is not distinct from r.lang and d.topic = r.topic
    where ('0x' || substr(md5(coalesce(d.doc_id::varchar, '')), 1, 12))::bigint::double / 281474976710656.0 < least(1.0, {factor} * r.ratio)
)
{select}
"""


def _components(percent: int, select: str) -> str:
    """Classes of equal shingle sets, their links, and what each reaches; ``select`` takes from the rows."""
    return rf"""
with recursive words as (
    select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), sets as (
    select r, doc_id, case when len(w) >= 5 then list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')))) when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from words
), rows as (
    select r, doc_id, len(s) as n, case when len(s) > 0 then md5(array_to_string(s, chr(10))) else 'none ' || r end as c from sets
), classes as (
    select c, any_value(n) as n, min(doc_id) as least from rows group by c
), items as (
    select distinct md5(array_to_string(s, chr(10))) as c, unnest(s) as item from sets where len(s) > 0
), met as (
    select a.c as a, b.c as b, count(*) as shared from items a join items b on a.item = b.item and a.c < b.c group by all
), links as (
    select a, b from met join classes x on a = x.c join classes y on b = y.c where 100 * shared >= {percent} * (x.n + y.n - shared)
), edges as (
    select a, b from links union all select b, a from links
), reached as (
    select c, c as o from classes
    union
    select h.c, e.b from reached h join edges e on h.o = e.a
), named as (
    select h.c, min(k.least) as component_id from reached h join classes k on h.o = k.c group by h.c
)
{select}
"""


ORACLES = {
    "op5_mixing": _mixing("documents", "select doc_id, topic, n_tokens, round(p, 6) as keep_probability from kept"),
    "op9_line_dedup": r"""
with lines as (
    select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as own from documents
), numbered as (
    select r, doc_id, unnest(own) as line, generate_subscripts(own, 1) as i from lines
), keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from numbered
), frequent as (
    select key from keyed where key <> '' group by key having count(distinct r) >= 10
)
select doc_id, count(*) as n_lines, count(f.key) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by i) filter (where f.key is null), '')) as kept_sha256
from keyed left join frequent f using (key)
group by r, doc_id
""",
    "op11_importance_resampling": r"""
with step as (
    select list_transform(range(256), lambda byte: list_reduce(list_concat([byte], range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) as of
), words as (
    select 'd' as kind, row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
    union all
    select 'b', row_number() over (), null, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark
), features as (
    select kind, r, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) as f from words
), counted as (
    select kind, r, f, count(*) as n from features group by all
), hexes as (
    select f, hex(encode(f)) as h from (select distinct f from counted)
), bytes as (
    select f, list_transform(range(1, len(h), 2), lambda i: (strpos('0123456789ABCDEF', h[i]) - 1) * 16 + strpos('0123456789ABCDEF', h[i + 1]) - 1) as b from hexes
), sums as (
    select f, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, of[(xor(c, x) & 255) + 1])), 4294967295) % 10000 as bucket from bytes, step
), placed as (
    select kind, r, bucket, sum(n)::bigint as n from counted join sums using (f) group by all
), totals as (
    select bucket, coalesce(sum(n) filter (where kind = 'd'), 0)::bigint as s, coalesce(sum(n) filter (where kind = 'b'), 0)::bigint as t from placed group by bucket
), whole as (
    select coalesce(sum(s), 0)::bigint as s_all, coalesce(sum(t), 0)::bigint as t_all from totals
), gain as (
    select bucket, floor(1000 * ln((t + 1)::double * (s_all + 10000)::double / ((s + 1)::double * (t_all + 10000)::double)))::bigint as g from totals, whole
), weights as (
    select r, sum(n)::bigint as n_features, floor(sum(n * g)::double / sum(n)::double)::bigint as weight from placed join gain using (bucket) where kind = 'd' group by r
), scored as (
    select d.r, doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
    from words d left join weights v on d.r = v.r where kind = 'd'
), ordered as (
    select r, row_number() over (order by score desc, doc_id nulls last) as place, count(*) over () * 25 // 100 as drawn from scored where n_words >= 20
)
select doc_id, n_features, weight, score, case when place <= drawn then place end as rank from scored left join ordered using (r)
""",
    "op12_source_divergence": r"""
with docs as (
    select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as own from documents
), found as (
    select r, lang, source, unnest(own) as term from docs
), kept as (
    select lang, term, count(*) as lang_n from found group by lang, term having count(distinct r) >= 30
), langs as (
    select lang, count(*)::hugeint as v, sum(lang_n)::hugeint as n_lang from kept group by lang
), counts as (
    select lang, source, term, count(*) as n from found join kept using (lang, term) group by all
), groups as (
    select lang, source, coalesce(sum(n), 0)::hugeint as n_group from (select distinct lang, source from docs) left join counts using (lang, source) group by all
), shares as (
    select g.lang, g.source, k.term, coalesce(c.n, 0) as n, 1 + 1000000000::hugeint * (coalesce(c.n, 0) + 5) // (g.n_group + 5 * v) as p,
        1 + 1000000000::hugeint * (lang_n + 5) // (n_lang + 5 * v) as q
    from groups g join kept k on g.lang = k.lang join langs l on g.lang = l.lang left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
), sums as (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), pairs as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
), terms as (
    select lang, source, 'term' as part, term as item, (p - q)::bigint as value from shares where n > 0 and p > q
)
select lang, source, part, item, value, row_number() over (partition by lang, source, part order by value desc, item)::integer as rank from pairs
union all
select * from (select lang, source, part, item, value, row_number() over (partition by lang, source, part order by value desc, item)::integer as rank from terms) where rank <= 50
""",
    "op10_jaccard_join": _components(80, "select doc_id, n as n_shingles, component_id from rows join named using (c)"),
    "op13_minhash_dedup": _components(85, "select doc_id, n as n_shingles, component_id, doc_id is not distinct from component_id as kept from rows join named using (c)"),
}
