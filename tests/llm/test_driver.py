"""What the driver holds: plans of bounded size, and the sample of the language model as bits."""

import contextlib
import io
import random
import tracemalloc

from pershare.llm import components, language


def roots(edges):
    """Smallest vertex that each vertex reaches."""
    root = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    while True:
        changed = False
        for a, b in edges:
            if a in root and b in root and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
        if not changed:
            return root


def test_a_round_of_components_is_planned_in_small_pieces(spark, monkeypatch):
    rng = random.Random(5)
    edges = [(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(70)] + [(1000 + i, 1001 + i) for i in range(9)]
    edges += [(2000, 2000 + i) for i in range(1, 9)] + edges[:5] + [(7777, 7777), (None, 3), (4, None)]
    found, write = [], components.stored

    def stored(df, name):
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            df.explain()
        found.append(plan.getvalue())
        return write(df, name)

    monkeypatch.setattr(components, "stored", stored)
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == sorted(roots(edges).items())
    assert max(plan.count("Exchange") for plan in found) <= 6
    assert max(plan.count("FileScan") for plan in found) <= 3


def test_components_of_no_edges(spark):
    assert components.components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).collect() == []


def test_language_sample_stays_packed(spark):
    rng = random.Random(2)
    rows = [("".join(rng.choices("abcdefg" if lang == "x" else "efghijk", k=60)), lang) for lang in "xy" for _ in range(900)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    tracemalloc.start()
    model = language.fit(docs, per_lang=900)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.langs == ["x", "y"]
    assert peak < 30e6  # 1,800 texts of 8,192 floats are 59 MB
    scored = language.predict(docs, model).groupBy("lang", "lang_pred").count().collect()
    assert sum(r["count"] for r in scored if r["lang"] == r["lang_pred"]) > 1700
