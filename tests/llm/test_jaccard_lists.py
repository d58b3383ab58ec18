"""Inverted lists of the Jaccard join: batches of bounded size that hold every list once."""

import numpy as np
import pytest

from pershare.llm import jaccard_join
from pershare.llm.jaccard_join import ENTRY, _list_rows


def entries(lists):
    rows = [(token, rest, n, sid) for token, sets in enumerate(lists) for sid, n, rest in sets]
    out = np.zeros(len(rows), ENTRY)
    for i, (token, rest, n, sid) in enumerate(rows):
        out[i] = (token, rest, n, sid)
    return out


@pytest.mark.parametrize("block", [3, 64])
def test_every_list_once(monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = np.random.default_rng(block)
    lists = [[(int(s), 10, 10) for s in rng.choice(50, rng.integers(1, 9), replace=False)] for _ in range(200)]
    batches = list(_list_rows([entries(lists)]))
    met = set()
    for batch in batches:
        held = {}
        for name, side, sid in zip(*(batch.column(c).to_pylist() for c in ("list", "side", "sid"))):
            held.setdefault(name, []).append((sid, side))
        for sets in held.values():
            met |= {frozenset((a, b)) for a, x in sets for b, y in sets if a != b and (x == 0 or x != y)}
    assert met == {frozenset((a, b)) for own in lists for a, *_ in own for b, *_ in own if a != b}
    assert max(b.num_rows for b in batches) <= 2 * max(block, 9)


def test_short_lists_are_flushed():
    lists = [[(2 * i, 10, 9), (2 * i + 1, 10, 9)] for i in range(200_000)]
    assert max(b.num_rows for b in _list_rows([entries(lists)])) <= 2 * jaccard_join.BLOCK
