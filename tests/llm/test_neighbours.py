"""Neighbour search: recall on the given vectors, and vectors of extreme sizes."""

import collections

import numpy as np
import pytest

from pershare.llm.collision_search import nearest
from pershare.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, score string"


def found(frame):
    got = collections.defaultdict(list)
    for r in frame.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    return got


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_recall_of_the_query(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect() if r.embedding]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    got, hits, n = found(QUERIES["op7_nearest_neighbours"](spark, sf_dir)), 0, 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        best = np.lexsort((ids, -s))[:20]
        mine = got[int(ids[q])]
        assert len(mine) == 20 and all(abs(v - s[list(ids).index(i)]) < 1e-12 for i, v in mine)
        hits, n = hits + len({int(ids[i]) for i in best} & {i for i, _ in mine}), n + 20
    assert hits >= 0.9 * n


def test_extreme_sizes(spark):
    """Squares that a double cannot hold, or that vanish, end neither the search nor a vector's part in it."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((120, 8))
    x[20:40] *= 1e200
    x[40:60] *= 1e-170
    x[60] = [1.7e308] * 8
    x[61] = [5e-324] + [0.0] * 7
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)] + [(200, [float("inf")] * 8, "x"), (220, [0.0] * 8, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(nearest(df, df.where("vec_id % 20 = 0"), 120))
    assert set(got) == set(range(0, 120, 20))
    for q, mine in got.items():
        assert {i for i, _ in mine} == set(range(120)) - {q}
        assert not any(np.isnan(v) for _, v in mine)
        keys = [(-v, i) for i, v in mine]
        assert keys == sorted(keys)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0] if i % 2 else [0.5, 0.5], "x") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(nearest(df, df.where("vec_id = 0"), 5))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5]
