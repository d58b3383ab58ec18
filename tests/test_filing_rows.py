"""Every filing has a row of its own; grids are walked once; encoders are loaded once."""

import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pershare import eps_from_grid, extract_eps
from pershare.operators import grid, text
from pershare.plans import shared
from pershare.sources.filings import packed_filings, read_filings

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLE = "<table><tr><td>Basic EPS<td>{}</tr><tr><td>Sales<td>9</tr></table>"
NEWS = "<p>Basic EPS was $2.50 this year.</p>"


def encoder():
    def encode(sentences):
        return [(s.replace("$", "$ ").replace(".", " . ").split(), [[1.0]] * len(s.replace("$", "$ ").replace(".", " . ").split())) for s in sentences]

    return encode


@pytest.fixture
def folder(tmp_path):
    held = {"x/a.html": TABLE.format("1.25").encode(), "y/a.html": TABLE.format("7.75").encode(), "x/b.html": NEWS.encode()}
    held |= {"y/b.html": b"<p>nothing</p>", "x/c.html": b"<p>\xff\xfe</p>", "y/c.html": b"<p>\xff\xfe</p>"}
    for name, content in held.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    return str(tmp_path / "*")


def rows(frame):
    return sorted((tuple(r) for r in frame.select("filename", "EPS", "status").collect()), key=repr)


def test_each_file_has_one_row(spark, folder):
    filings = read_filings(spark, folder)
    bad = [("c.html", None, "undecodable")] * 2
    tables = [("a.html", 1.25, "table"), ("a.html", 7.75, "table"), ("b.html", 0.0, "none"), ("b.html", 0.0, "none"), *bad]
    assert rows(extract_eps(filings, status=True)) == sorted(tables, key=repr)
    found = extract_eps(filings, make_encoder=encoder, status=True)
    assert rows(found) == sorted([*tables[:2], ("b.html", 0.0, "none"), ("b.html", 2.5, "text"), *bad], key=repr)
    assert found.select("filing_id").distinct().count() == 6


def test_equal_names_without_an_id(spark):
    filings = spark.createDataFrame([("a.html", NEWS), ("a.html", TABLE.format("3.00")), ("b.html", None)], "filename string, html string")
    found = sorted(tuple(r) for r in extract_eps(filings, make_encoder=encoder).collect())
    assert found == [("a.html", 2.5), ("a.html", 3.0)]


def test_packed_bytes(spark):
    frame = spark.createDataFrame([("a", bytearray(b"<p>\xe9</p>")), ("b", bytearray("é".encode())), ("c", None)], "p string, b binary")
    found = {r.filename: r.html for r in packed_filings(frame, F.lit("n"), F.col("b"), F.col("p")).withColumn("filename", F.col("filing_id")).collect()}
    assert len(found) == 3 and sorted(map(str, found.values())) == ["None", "None", "é"]


def test_frame_of_a_long_table_is_worked_out_once(spark, monkeypatch):
    met = []
    monkeypatch.setattr(grid, "written_once", lambda df, name: met.append(name) or shared.written_once(df, name))
    lines = [("f", 0, i, ["Basic EPS", ""] if i % 50 == 0 else ["of the year", "1.5"]) for i in range(300)]
    frame = spark.createDataFrame(lines, "filename string, table_seq int, row_idx int, cells array<string>")
    found = grid.row_context(frame, 2020, 64)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert met == ["framed"] and "posexplode" not in plan and plan.count("Scan parquet") >= 2 and "ExistingRDD" not in plan
    assert found.count() == 294
    assert eps_from_grid(frame, block_rows=64).first().EPS == eps_from_grid(frame, block_rows=None).first().EPS == 1.5


def test_shared_folder_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(Session())


def test_encoder_is_loaded_once_for_each_worker_and_only_for_sentences(spark, tmp_path):
    log = str(tmp_path / "loads")

    def counted():
        with open(log, "a") as out:
            out.write(f"{os.getpid()}\n")
        return encoder()

    none = spark.createDataFrame([(None,)] * 20, "sentence string").repartition(4)
    assert text.token_vectors(none, counted).where("tokens is not null").count() == 0
    assert not os.path.exists(log)
    some = spark.createDataFrame([(f"EPS of $ {i}.5",) for i in range(64)], "sentence string").repartition(16)
    for _ in range(2):
        assert text.token_vectors(some, counted).where("tokens is not null").count() == 64
    with open(log) as loads:
        workers = loads.read().split()
    assert len(workers) == len(set(workers))
