"""Files in, results out, in batch and as files arrive."""

import os

from fixtures import GRIDS, to_html
from pershare import extract_eps
from pershare.operators import evaluate
from pershare.sources import filings, results
from pershare.streaming.arrivals import stream_eps
from test_text import one_word_encoder


def write(folder, name, content):
    with open(os.path.join(folder, name), "wb") as out:
        out.write(content if isinstance(content, bytes) else content.encode("utf-8"))


def fill(folder, names=("F1", "F2", "F4")):
    for name in names:
        write(folder, f"{name}.html", to_html([*GRIDS[name][0], "End"]))


def test_read_filings(spark, tmp_path):
    fill(tmp_path)
    write(tmp_path, "a b%20é.html", "<p>é</p>")
    write(tmp_path, "bad.html", b"<table>\xff\xfe")
    write(tmp_path, "UPPER.HTML", "x")
    write(tmp_path, "note.txt", "x")
    os.mkdir(tmp_path / "below")
    write(tmp_path / "below", "deep.html", "x")
    read = filings.read_filings(spark, str(tmp_path))
    names = {r.filename for r in read.collect()}
    assert names == {"F1.html", "F2.html", "F4.html", "a b%20é.html", "bad.html"}
    assert [r.filename for r in filings.undecodable(read).collect()] == ["bad.html"]
    found = {tuple(r) for r in extract_eps(read).collect()}
    assert found == {("F1.html", 0.43), ("F2.html", -1.21), ("F4.html", 0.43), ("a b%20é.html", 0.0)}


def test_results_round_trip(spark, tmp_path):
    fill(tmp_path)
    found = extract_eps(filings.read_filings(spark, str(tmp_path)))
    for fmt in ("csv", "parquet"):
        folder = str(tmp_path / fmt)
        results.write_results(found, folder, fmt)
        back = results.read_results(spark, folder, fmt)
        assert {tuple(r) for r in back.collect()} == {tuple(r) for r in found.collect()}
    part = next(p for p in sorted(os.listdir(tmp_path / "csv")) if p.endswith(".csv"))
    with open(tmp_path / "csv" / part, "rb") as file:
        assert file.read().startswith(b"filename,EPS\r\n")


def test_labels_with_either_line_end_and_a_blank_tail(spark, tmp_path):
    write(tmp_path, "lf.csv", "filename,EPS\na.html,-0.03\nb.html,1.0\n \n\n")
    write(tmp_path, "crlf.csv", "filename,EPS\r\na.html,-0.03\r\nb.html,1.0\r\n")
    crlf = results.read_results(spark, str(tmp_path / "crlf.csv"))
    assert [tuple(r) for r in crlf.collect()] == [("a.html", -0.03), ("b.html", 1.0)]
    lf = results.read_results(spark, str(tmp_path / "lf.csv")).filter("EPS is not null")
    assert {tuple(r) for r in lf.collect()} == {tuple(r) for r in crlf.collect()}
    assert evaluate.accuracy(lf, crlf).first().accuracy == 1.0


def test_accuracy_counts(spark):
    schema = "filename string, EPS double"
    ours = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 0.0), ("x", None)], schema)
    truth = spark.createDataFrame([("a", 1.0), ("b", -2.0), ("d", 0.0), ("x", None)], schema)
    row = evaluate.accuracy(ours, truth).first()
    assert row.asDict() == {
        "n_filings": 5, "n_equal": 2, "n_missing": 1, "n_extra": 1, "accuracy": 0.4,
    }
    assert {r.filename for r in evaluate.mismatches(ours, truth).collect()} == {"b", "c", "d"}


def test_filings_as_they_arrive(spark, tmp_path):
    arriving, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    os.mkdir(arriving)

    def run():
        stream = filings.stream_filings(spark, str(arriving), max_files=2)
        stream_eps(stream, out, state).awaitTermination()
        return {tuple(r) for r in results.read_results(spark, out, "parquet").collect()}

    fill(arriving)
    first = run()
    assert first == {("F1.html", 0.43), ("F2.html", -1.21), ("F4.html", 0.43)}
    fill(arriving, ["F5"])
    assert run() == first | {("F5.html", 0.1)}
    assert results.read_results(spark, out, "parquet").count() == 4


def test_filings_as_they_arrive_with_text(spark, tmp_path):
    arriving, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    os.mkdir(arriving)
    fill(arriving)
    write(arriving, "prose.html", "<p>EPS of $0.31 rose</p>")
    stream = filings.stream_filings(spark, str(arriving), max_files=3)
    stream_eps(stream, out, state, make_encoder=one_word_encoder).awaitTermination()
    found = results.read_results(spark, out, "parquet")
    assert {(r.filename, r.EPS) for r in found.collect()} == {
        ("F1.html", 0.43), ("F2.html", -1.21), ("F4.html", 0.43), ("prose.html", 0.31),
    }
    assert sorted(p for p in os.listdir(out) if p.startswith("batch=")) == ["batch=0", "batch=1"]
