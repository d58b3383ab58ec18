"""The numbered operators against brute force, on small tables with nulls, empty texts, ties and repeated rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pershare.llm import jaccard_join, language, lm_score
from pershare.llm.collision_search import nearest
from pershare.llm.components import components
from pershare.llm.cuckoo import Cuckoo
from pershare.llm.decontaminate import clean_documents, contaminations
from pershare.llm.jaccard_join import PARITIES, may_be_similar, near_components, one_of_each, parities
from pershare.llm.line_dedup import LineRegistry, dedup_lines
from pershare.llm.mixing import mixed_sample, probabilities
from pershare.llm.oracles import ORACLES
from pershare.llm.quality import posteriors, quality
from pershare.llm.queries import QUERIES
from pershare.llm.suffix_dedup import drop_repeats
from pershare.llm.wrappers import aligned, blocks, extract, folded, matched

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def documents(spark, n=None):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows][:n]


def odd_rows():
    return [(900, None), (901, ""), (902, " \t\n "), (903, "One"), (904, "one"), (905, "x" * 1200), (905, "x" * 1200), (None, "no id here at all, none"), (None, None)]


def test_line_dedup(spark):
    rows = documents(spark) + odd_rows() + [(1000 + i, f"Own {i}\n  Shared LINE \r\n\nshared line") for i in range(10)]
    got = {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in dedup_lines(spark.createDataFrame(rows, SCHEMA), 10).collect()}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").encode().lower()
    counts = collections.Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    want = set()
    for d, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if not key(x) or counts[key(x)] < 10]
        want.add((d, None if t is None else "\n".join(kept), len(own), len(own) - len(kept)))
    assert got == want


def test_line_registry_can_be_undone(spark):
    first = spark.createDataFrame([(i, f"a{i}\ncommon\nother") for i in range(4)], SCHEMA)
    second = spark.createDataFrame([(10 + i, "common\nmore") for i in range(3)], SCHEMA)
    registry = LineRegistry(spark, 5)
    registry.insert(first)
    before = registry.counts().collect()
    registry.insert(second)
    assert {r.text for r in registry.drop_lines(second).collect()} == {"more"}
    registry.delete(second)
    assert sorted(registry.counts().collect()) == sorted(before)
    assert {r.text for r in registry.drop_lines(second).collect()} == {"common\nmore"}


def test_cuckoo_keeps_what_it_was_given():
    keys = np.random.default_rng(1).integers(-(2**62), 2**62, 20_000)
    cuckoo = Cuckoo(len(keys))
    assert cuckoo.insert(keys) and cuckoo.contains(keys).all()
    cuckoo.delete(keys[:5000])
    again = Cuckoo(blob=cuckoo.blob())
    assert again.contains(keys[5000:]).all() and again.contains(keys[:5000]).mean() < 0.01


def brute_repeats(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = collections.Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for d, b in texts:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[: len(b)] > 0
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((str(d), len(b), int(gone.sum()), int((np.diff(np.r_[0, gone]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("length", [100, 400])
def test_suffix_dedup(spark, length):
    rng = random.Random(length)
    pool = ["".join(rng.choice("abcdeé ") for _ in range(rng.choice([50, 200, 300, 700]))) for _ in range(10)]
    rows = []
    for i in range(80):
        text = "".join(rng.choice(pool) if rng.random() < 0.6 else "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(1, 300))) for _ in range(rng.randrange(1, 6)))
        p = rng.randrange(len(text))
        rows.append((i, text[:p] + "#" * (rng.random() < 0.3) + text[p:]))
    rows += odd_rows() + [(150, "ab" * 700), (151, "x" * (length - 1)), rows[3]]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in drop_repeats(spark.createDataFrame(rows, SCHEMA), length).collect())
    assert got == brute_repeats(rows, length)


def test_suffix_dedup_moves_texts_once(spark, tmp_path):
    rng = random.Random(7)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(700))
    rows = [(i, shared[i:] + "".join(rng.choice("abcdefgh ") for _ in range(300))) for i in range(40)] + odd_rows()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = drop_repeats(spark.read.parquet(str(tmp_path / "documents")))
        got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in kept.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == brute_repeats(rows, 400)
    assert re.search(r"ReusedExchange \[[^\]]*\btext#\d+[^\]]*\], Exchange hashpartitioning", kept._jdf.queryExecution().executedPlan().toString())


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").encode().lower())
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted((str(d), len(sets[i]), str(least.get(root(i)))) for i, (d, _) in enumerate(rows))


def near_rows():
    rng = random.Random(1)
    base = [[rng.choice("abcdefghijklmnopqrst") + str(rng.randrange(30)) for _ in range(rng.choice([3, 6, 9, 12, 20, 40, 120]))] for _ in range(30)]
    rows = []
    for i in range(300):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = rng.choice("xyz") + str(rng.randrange(1000))
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words[: rng.randrange(1, len(words) + 1) if rng.random() < 0.2 else None])))
    return rows + odd_rows()


def test_jaccard_join(spark):
    rows = near_rows()
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in near_components(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute_components(rows)


def test_parities_lose_no_similar_pair(spark):
    rng = np.random.default_rng(3)
    rows, similar = [], []
    for _ in range(400):
        n = int(rng.integers(1, 400))
        own = rng.integers(0, 1 << 63, n).astype(np.uint64)
        changed = int(rng.integers(0, n // 3 + 2))
        other = np.unique(np.r_[own[changed // 2 :], rng.integers(0, 1 << 63, changed).astype(np.uint64)])
        both = len(np.intersect1d(own, other))
        similar.append(100 * both >= 80 * (n + len(other) - both))
        rows.append((len(rows), n, len(other), *parities(own).tolist(), *parities(other).tolist()))
    names = ["i", "n_a", "n_b", *(f"{p}_{side}" for side in "ab" for p in PARITIES)]
    kept = {r.i for r in spark.createDataFrame(rows, names).where(may_be_similar()).collect()}
    assert {i for i, s in enumerate(similar) if s} <= kept and 0 < sum(similar) <= len(kept) < len(rows)


def test_one_of_each(spark):
    rows = [(1, "a b c d e f g"), (2, "A b c d e f g"), (3, "other words are in this one"), (3, "other words are in this one"), (4, None), (5, "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", one string")
    assert sorted((r.doc_id, r.one) for r in one_of_each(df).collect()) == [(1, "x"), (3, "x"), (4, "x"), (5, "x")]


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == label


def test_lm_scores(spark):
    rows = documents(spark, 150) + odd_rows()
    train = [zlib.crc32(str(d).encode()) % 5 != 1 for d, _ in rows]
    df = spark.createDataFrame([(*r, t) for r, t in zip(rows, train)], SCHEMA + ", train boolean")
    got = lm_score.score_documents(df).collect()
    words = [WORD.findall((t or "").encode().lower()) + [None] for _, t in rows]
    c = collections.Counter(w for ws, t in zip(words, train) if t for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), len(ws), sum(w in c for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 5)) for (d, _), ws in zip(rows, words))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_language(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(docs.where("doc_id % 4 <> 2"))
    asked = docs.union(spark.createDataFrame([(-1, None, "en"), (-2, "", "en"), (-3, "12 ... !", None), (-4, "12 ... ж", None)], docs.schema))
    rows = language.predict(asked, model).collect()
    held = [r for r in rows if r.doc_id >= 0 and r.doc_id % 4 == 2]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id: r.lang_pred == "und" for r in rows if r.doc_id < 0} == {-1: True, -2: True, -3: True, -4: False}
    nothing = language.fit(docs.where("false"))
    assert {r.lang_pred for r in language.predict(docs.limit(3), nothing).collect()} == {"und"}


def test_nearest(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    odd = [(100_000, None), (100_020, [0.0] * 64), (100_040, [float("nan")] * 64), (100_060, [1.0, None] * 32), (100_080, [1.0]), (rows[1][0] + 200_000, rows[1][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in nearest(df, df.where("vec_id % 20 = 0"), 20, block=128, query_block=16).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    good = rows + odd[-1:]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good], np.float64)
    hits = 0
    queries = [i for i in range(len(ids)) if ids[i] % 20 == 0]
    for q in queries:
        s = x @ x[q]
        order = [i for i in np.lexsort((ids, -s)) if i != q][:20]
        mine = got[int(ids[q])]
        assert [r for r, *_ in mine] == list(range(1, 21)) and [v for *_, v in mine] == sorted((v for *_, v in mine), reverse=True)
        assert all(abs(v - s[list(ids).index(i)]) < 1e-12 for _, i, v in mine)
        hits += len({int(ids[i]) for i in order} & {i for _, i, _ in mine})
    assert set(got) == {int(ids[q]) for q in queries} and hits >= 0.9 * 20 * len(queries)
    few = df.where("vec_id < 5")
    assert nearest(few, few, 20).count() == 20
    assert nearest(df.where("false"), df, 20).count() == 0


def test_decontamination(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    rng = random.Random(3)
    plain = documents(spark)
    fold = lambda t: re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", " ", t.translate({c: c + 32 for c in range(65, 91)})).strip()
    want = {(d, i) for d, t in plain for i, s in items if fold(s) in fold(t)}
    rows, edited = list(plain), set()
    for k in range(40):
        i, s = rng.choice(items)
        words = s.split()
        words[rng.randrange(len(words))] = "zzq"
        rows.append((2000 + k, f"{plain[k][1]} {' , '.join(words).upper() if k % 2 else chr(10).join(words)} {plain[k + 1][1]}"))
        edited.add((2000 + k, i))
    df = spark.createDataFrame(rows + odd_rows(), SCHEMA)
    bench = spark.createDataFrame([*items, (77_777, None), (77_778, "short")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminations(df, bench).collect()}
    assert {x for x in got if x[0] is not None and x[0] < 900} == want
    assert len(edited - got) <= 2
    clean = clean_documents(df, bench)
    assert clean.count() == df.count() - len({d for d, _ in got})
    assert clean_documents(df, bench.where("false")).count() == df.count()


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(0, 30), rng.choice(["a", "a", "a", "b", None]), rng.choice(["x", "y"])) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA + ", source string, lang string")
    target = spark.createDataFrame([("x", 0.5), ("y", 0.5)], "value string, target double")
    out = probabilities(df, ["source", "lang"], share=0.3, targets={"lang": target}).collect()
    assert len(out) == len(rows) and all(0 <= r.keep_probability <= 1 for r in out)
    expected = collections.Counter()
    for r in out:
        expected[r.lang] += r.n_tokens * r.keep_probability
    assert abs(expected["x"] / sum(expected.values()) - 0.5) < 0.02
    assert abs(sum(expected.values()) / sum(r.n_tokens for r in out) - 0.3) < 0.01
    assert mixed_sample(df.where("false"), ["source", "lang"]).count() == 0


def test_weak_labels():
    rng = np.random.default_rng(2)
    truth = rng.random(5000) < 0.8
    votes = np.where(rng.random((5000, 4)) < 0.5, 2, 1)
    for j in range(4):
        votes[~truth & (rng.random(5000) < 0.6), j] = 0
    codes, counts = np.unique(votes @ np.array([27, 9, 3, 1]), return_counts=True)
    label, accuracy, share = posteriors(codes, counts, 4)
    assert np.mean((label[votes @ np.array([27, 9, 3, 1])] > 0.5) == truth) > 0.95
    assert (accuracy[1] > 0.98).all() and abs(share - 0.8) < 0.05


def test_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = quality(docs.union(spark.createDataFrame(odd_rows(), SCHEMA)).withColumn("keep", F.lit("mine"))).collect()
    assert {r.keep for r in rows} == {"mine"}
    known = [(labels[r.doc_id], r) for r in rows if r.doc_id in labels and r.doc_id < 900]
    assert np.mean([(r.score >= 0.5) == bool(q) for (q, _), r in known]) > 0.93
    assert np.mean([r._keep for (q, t), r in known if q and not t]) > 0.95
    assert not any(r._keep for r in rows if not (r.text or "").strip())


PAGE = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><nav><a>x</a></nav><main><article class="post">
<h1>Head &amp; line</h1><p>One <b>two</b>
 three<p>Four <!-- c --> five<br>six<div class="ad-box">AD</div><ul><li>a<li>b</ul><aside>side</aside><script>x("</p>")</script>
<section id="comments"><p>troll</p></section><form><input> name</form></article></main><div class="sidebar">S</div><footer>F</footer>"""


def test_blocks_and_wrappers():
    kept = [text for _, text, good, where in blocks(PAGE) if good and where == "article"]
    assert kept == ["Head & line", "One two three", "Four five six", "a", "b"]
    for junk in ("<a " * 50_000, "<script " * 20_000, "<!-- " * 20_000, "<div>x" * 5000, "</p>" * 20_000):
        blocks(junk)
    assert folded(list("abbbc")) == [("a", False), ("b", True), ("c", False)]
    assert folded(list("xababy")) == [("x", False), ("a", True), ("b", True), ("y", False)]
    one = [["nav", False, False], ["p", True, False], ["foot", False, False]]
    two = [["nav", False, False], ["h1", False, False], ["p", False, False]]
    assert aligned(one, two) == [["nav", False, False], ["h1", False, True], ["p", True, False], ["foot", False, True]]


def test_extraction(spark):
    rows = [(i, f"http://h{i % 2}.example/p", PAGE.replace("three", f"three {i}")) for i in range(6)] + [(7, None, None), (8, "no url", ""), (9, "http://h0.example/q", "bare text")]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Head & line\nOne two three 3\nFour five six\na\nb"
    assert (got[7], got[8], got[9], len(got)) == ("", "", "bare text", 9)
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    import html as codec

    for r in extract(pages).collect():
        inner = re.sub("<br>", " ", re.sub(r"</?(h1|p)>", "\n", r.html[r.html.find("<article>") : r.html.find("</article>")]))
        lines = [" ".join(codec.unescape(x).split()) for x in re.sub("<[^>]*>", "", inner).split("\n")]
        assert r.text == "\n".join(x for x in lines if x)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    ours = QUERIES[name](spark, SF_DIR)
    theirs = con.execute(ORACLES[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in ours.collect()))) == sorted(map(repr, theirs.fetchall()))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert dedup_lines(empty).count() == drop_repeats(empty).count() == near_components(empty).count() == 0
    assert quality(empty).count() == 0 and extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert lm_score.score_documents(spark.createDataFrame([], SCHEMA + ", train boolean")).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, SF_DIR).collect(), docs.schema)
        sizes.append(kept.count())
        if name == "line_dedup":
            lined = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == docs.columns
    least = {c for _, n, c in brute_components(lined) if n} | {d for d, n, _ in brute_components(lined) if not n}
    assert sizes[2] == len(least)
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR).collect()
    assert sorted(r.doc_id for r in whole) == sorted(r.doc_id for r in last) and 0 < len(whole) < sizes[3]


def site(spark, bodies):
    pages = [(i, f"http://site.example/{i}", f"<html><body>{body}</body></html>") for i, body in enumerate(bodies)]
    return {r.page_id: r.text for r in extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}


def test_slots_of_the_wrapper_decide(spark):
    article = lambda i: f"Story {i} of this site with enough words to be told from the others"
    menu = "<div><div>Home</div><div>About us</div></div>"
    got = site(spark, [f"{menu}<div>{article(i)}</div>" + "<p>Buy now</p>" * (i % 2) for i in range(50)])
    assert got == {i: article(i) for i in range(50)}
    got = site(spark, [f"<p>Home</p><div class='page with-sidebar'><main class='sidebar'><p>{article(i)}</p><div class=comments>Nice</div></main></div>" for i in range(3)])
    assert got == {i: article(i) for i in range(3)}
    assert matched([["p", True, False], ["h1", False, True], ["p", False, True]], ["p", "h1", "p", "h2"]) == ["0", "1", "2", "h2"]
    assert matched([["p", True, False], ["h1", False, True]], ["p", "h1", "p"]) == ["0", "1", "0"]


def test_copies_are_no_template(spark):
    story = "<article class=own><h1>Head</h1><p>The only paragraph of the story that many copies have</p></article>"
    table = "<ul class=cells>" + "<li>same cell</li>" * 25 + "</ul>"
    dated = [f"<article class=dated><p>Another paragraph of a story that many near copies have</p><p>Seen {i} times</p></article>" for i in range(30)]
    others = [f"<div><p>Page {i} of the site has a text of its own and of enough length</p></div>" for i in range(30)]
    got = site(spark, [story] * 30 + [table] + dated + others)
    assert all(got[i] == "Head\nThe only paragraph of the story that many copies have" for i in range(30))
    assert got[30] == "\n".join(["same cell"] * 25)
    assert all(got[31 + i] == f"Another paragraph of a story that many near copies have\nSeen {i} times" for i in range(30))
    assert all(got[61 + i].startswith(f"Page {i} of") for i in range(30))


def test_all_links_are_counted(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TOGETHER", 16)
    rng = random.Random(8)
    story = [f"w{i}" for i in range(150)]
    rows = near_rows()
    for i in range(90):
        words = list(story)
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
        rows.append((2000 + i, " ".join(words)))
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").encode().lower())
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    different = set(sets) - {frozenset()}
    similar = {s: sum(o != s and 100 * len(s & o) >= 80 * len(s | o) for o in different) for s in different}
    want = sorted((str(d), similar.get(s, 0)) for (d, _), s in zip(rows, sets))
    got = sorted((str(r.doc_id), r.n_links) for r in near_components(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == want and max(similar.values()) > 40


def test_nearest_of_unequal_lengths(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((2000, 32))
    x /= np.sqrt((x**2).sum(1))[:, None]
    x[7] *= 5
    x[11:400:10] *= 1.4
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in nearest(df, df.where("vec_id % 20 = 0"), 20).collect():
        got[r.query_id].add(r.vec_id)
    hits = sum(len(got[q] & set([i for i in np.argsort(-(x @ x[q])).tolist() if i != q][:20])) for q in range(0, 2000, 20))
    assert hits >= 0.9 * 20 * 100
