"""Classes of one key compared by bitmaps, against sets compared two by two."""

from __future__ import annotations

import itertools
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from ledgerloom.llm.common import worker_tool
from ledgerloom.llm.jaccard_join import _compared, _merged, parity_bits


def folded(bits: np.ndarray) -> np.ndarray:
    half = len(bits) // 2
    return bits[:half] ^ bits[half:] if half else bits


def classes(seed: int) -> list[tuple[int, int, set[int]]]:
    """Name, component and tokens: edits of two sets around the threshold and others unlike them,
    of sizes on both sides of a bitmap's width."""
    rng = np.random.default_rng(seed)
    found = []
    for base, n in enumerate((62, 130)):
        origin = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(base)
        for k in range(18):
            kept = rng.permutation(origin)[: n - rng.integers(0, n // 5)]
            new = rng.integers(0, 2**63, rng.integers(0, n // 8 + 1), dtype=np.uint64)
            found.append((base * 100 + k - 50, k % 7, {int(t) for t in kept} | {int(t) for t in new}))
    return found


def cells(rows: list[tuple[int, int, set[int]]], blocks: int, keys: int) -> pd.DataFrame:
    out = []
    for key in range(keys):
        for sid, of, tokens in rows:
            bits = folded(parity_bits(np.array(sorted(tokens), dtype=np.uint64)))
            block = sid % blocks
            for other in range(blocks):
                low, high = sorted((block, other))
                out.append((key, low, high, block, len(tokens), of, 2, sid, bits))
    names = ["key", "low", "high", "block", "size", "of", "times", "sid", "bits"]
    return pd.DataFrame(out, columns=names).sort_values(["key", "low", "high"], kind="stable", ignore_index=True)


@pytest.mark.parametrize("blocks", [1, 3])
@pytest.mark.parametrize("batch", [5, 10_000])
def test_cells_lose_no_pair(blocks, batch):
    rows = classes(blocks)
    table = cells(rows, blocks, keys=2)
    batches = [table.iloc[i : i + batch] for i in range(0, len(table), batch)]
    lists = pd.concat(_compared(75, False)(iter(batches)))
    told = Counter()
    for a, b, times in zip(lists["a"], lists["b"], lists["times"], strict=True):
        for partner, t in zip(b, times, strict=True):
            told[int(a), int(partner)] += int(t)
    like, unlike = set(), 0
    for (a, x, s), (b, y, t) in itertools.combinations(rows, 2):
        if x != y and 4 * len(s & t) >= 3 * len(s | t):
            like.add((min(a, b), max(a, b)))
        unlike += x != y
    assert like and like <= set(told)
    assert len(told) < unlike  # the two origins are told apart
    assert set(told.values()) == {4}  # two keys that each stand for two
    of = {sid: component for sid, component, _ in rows}
    assert all(a < b and of[a] != of[b] for a, b in told)


def test_likest_partner_of_each_class():
    rows = classes(5)
    (lists,) = _compared(75, True)(iter([cells(rows, 1, keys=1)]))
    everything = pd.concat(_compared(75, False)(iter([cells(rows, 1, keys=1)])))
    # One among bitmaps of the same length and one among those twice as long.
    assert 0 < sum(map(len, lists["b"])) <= 2 * len(rows) < sum(map(len, everything["b"]))


def test_lists_are_merged_and_counted():
    lists = pd.DataFrame(
        {
            "a": [-3, -3, 1, 4],
            "b": [[5, 7], [5], [9], [9]],
            "n": [[16, 24], [16], [8], [80]],
            "times": [[1, 3], [2], [1], [10]],
        }
    )
    for batches in ([lists], [lists.iloc[:1], lists.iloc[1:]]):
        pairs = pd.concat(_merged(True)(iter(batches)))
        assert pairs.to_numpy().tolist() == [[-3, 5], [1, 9]]  # 3 > 2 and 1 > 0, not 3 > 3 and 10 > 10
        pairs = pd.concat(_merged(False)(iter(batches)))
        assert pairs.to_numpy().tolist() == [[-3, 5], [-3, 7], [1, 9], [4, 9]]


def test_no_rows():
    names = ["key", "low", "high", "block", "size", "of", "times", "sid", "bits"]
    empty = pd.DataFrame({n: [] for n in names})
    assert sum(map(len, _compared(75, False)(iter([empty])))) == 0
    assert sum(map(len, _merged(True)(iter([])))) == 0


def test_a_worker_keeps_one_tool():
    made = []
    for key in ("x", "x", "y", "x"):
        assert worker_tool(("test", key), lambda key=key: made.append(key) or key) == key
    assert made == ["x", "y", "x"]
