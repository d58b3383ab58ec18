"""Streams that start again: with a new checkpoint on the same folder, or with the same one."""

import sys

from pyspark import cloudpickle

from pershare.sources import filings
from pershare.streaming.arrivals import settled_results, stream_eps

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def encoder():
    def encode(sentences):
        words = [s.replace("$", "$ ").split() for s in sentences]
        return [(w, [[1.0]] * len(w)) for w in words]

    return encode


def test_a_new_checkpoint_loses_nothing_and_a_replay_doubles_nothing(spark, tmp_path):
    arriving, out = tmp_path / "in", str(tmp_path / "out")
    arriving.mkdir()

    def run(state):
        stream = filings.stream_filings(spark, str(arriving))
        stream_eps(stream, out, str(tmp_path / state), make_encoder=encoder, status=True).awaitTermination()
        return sorted(tuple(r) for r in settled_results(spark, out).select("filename", "EPS", "status").collect())

    (arriving / "a.html").write_text("<p>EPS of $ 0.31 rose</p>")
    assert run("first") == [("a.html", 0.31, "text")]
    (arriving / "a.html").unlink()
    (arriving / "b.html").write_text("<p>EPS of $ 0.52 rose</p>")
    both = [("a.html", 0.31, "text"), ("b.html", 0.52, "text")]
    assert run("second") == both
    assert run("second") == both
    assert run("third") == both
