"""What steps leave behind in a worker, and texts that need not be shuffled."""

import contextlib
import io

import pyarrow as pa

from pershare.llm import common, decontaminate

SCHEMA = "doc_id long, text string"


def test_texts_are_marked_in_place(spark, monkeypatch):
    passage = " ".join(f"word{i} of benchmark passage {i * 7}" for i in range(12))
    bench = spark.createDataFrame([(1, passage), (2, passage.replace("of", "in")), (3, None)], "item_id long, text string")
    rows = [(1, f"before {passage} behind"), (2, "nothing"), (None, passage.upper()), (4, None), (2, "nothing"), (5, ""), (1, f"before {passage} behind")]
    docs = spark.createDataFrame(rows, SCHEMA)
    clean = decontaminate.clean_documents(docs, bench)
    want = sorted([(2, "nothing"), (2, "nothing"), (4, None), (5, "")], key=str)
    assert sorted(map(tuple, clean.collect()), key=str) == want
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        clean.explain()
    assert "Exchange" not in plan.getvalue()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1000)
    assert len(list(decontaminate._blocks(bench))) > 1
    assert sorted(map(tuple, decontaminate.clean_documents(docs, bench).collect()), key=str) == want


def test_long_texts_are_searched_in_slices(spark, monkeypatch):
    passage = " ".join(f"word{i} of benchmark passage {i * 7}" for i in range(12))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"{'x y ' * i} {passage if i % 3 == 0 else ''}") for i in range(40)], SCHEMA).coalesce(1)
    whole = sorted(map(tuple, decontaminate.contaminations(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "STEP_BYTES", 300)
    assert sorted(map(tuple, decontaminate.contaminations(docs, bench).collect())) == whole and len(whole) == 14
    assert decontaminate.clean_documents(docs, bench).count() == 26


def test_memory_goes_back_when_a_step_is_done():
    pool = pa.default_memory_pool()
    before, passed = pool.bytes_allocated(), 0
    for batch in common.released(pa.RecordBatch.from_pydict({"x": list(range(1000))}) for _ in range(5)):
        passed += batch.num_rows
        del batch
        assert pool.bytes_allocated() - before < 20_000
    assert passed == 5000
