"""Pairs of prefix rows: the same in narrow and wide integers, whatever the order of the rows."""

import numpy as np
import pyarrow as pa

from riskmart.llm import line_dedup


def _table(rows: np.ndarray) -> pa.Table:
    packed = b"".join(rows[c].tobytes() for c in line_dedup._COLUMNS)
    return pa.table({"range": pa.array([0], pa.int32()), "words": pa.array([packed], pa.binary())})


def test_narrow_and_wide_rows_give_the_same_pairs(monkeypatch):
    rng = np.random.default_rng(7)
    rows = np.zeros(4000, dtype=line_dedup._WORD)
    rows["key"] = rng.integers(0, 900, 4000)
    rows["h"] = rng.integers(0, 1 << 63, 4000)
    rows["n"], rows["pos"] = rng.integers(5, 12, 4000), rng.integers(0, 3, 4000)
    rows = rng.permutation(np.append(rows, rows[:300]))                       # equal sets of other tasks
    widths, found = [], []
    made = line_dedup._Rows.__init__
    monkeypatch.setattr(line_dedup._Rows, "__init__", lambda self, h, bits, n, pos, *a: (widths.append(n.dtype), made(self, h, bits, n, pos, *a))[1])
    for order, (num, den) in ((rows, (80, 100)), (rows[::-1], (80, 100)), (rows, (80_000_000, 100_000_000))):
        pairs = line_dedup._pairs_of_range(num, den, 16, 10)(_table(order)).to_pylist()
        found.append(sorted(tuple(r.values()) for r in pairs))
    assert widths == [np.int32, np.int32, np.int64]
    assert len(found[0]) > 1000 and found[0] == found[1] == found[2]


def test_pairs_and_crowds_of_lists_of_any_length(monkeypatch):
    """Lists looked at together or by slices give what a look at every pair gives; the length filter comes first."""
    rng = np.random.default_rng(3)
    rows = np.zeros(900, dtype=line_dedup._WORD)
    rows["key"] = np.repeat([1, 2, 3, 4, 5], [500, 200, 120, 60, 20])
    rows["h"] = rng.permutation(900) + 1
    rows["bits"] = np.where(rows["key"] == 2, 255, rng.integers(0, 256, 900))
    rows["n"], rows["pos"] = rng.integers(5, 30, 900), rng.integers(0, 4, 900)
    seen, looked = [], line_dedup._Rows.possible
    monkeypatch.setattr(line_dedup._Rows, "possible", lambda self, x, y: (seen.append((self.n[x] * 5 >= self.n[y] * 4).all()), looked(self, x, y))[1])
    found = {}
    for crowd in (2, 1000):
        expected = []
        for key in range(1, 6):
            some, pairs = [r for r in rows.tolist() if r[1] == key], []
            for i, (_, _, h, bits, n, pos) in enumerate(some):
                for _, _, h2, bits2, n2, pos2 in some[:i]:
                    (n_x, p, b, _), (n_y, q, c, _) = sorted([(n, pos, bits, h), (n2, pos2, bits2, h2)])
                    need = -(-80 * (n_x + n_y) // 180)
                    if (n_x * 100 >= n_y * 80 and p + need <= n_x + 1 and q + need <= n_y + 1
                            and min(p, q) + 1 + min(n_x - p - 1, n_y - q - 1) >= need
                            and n_x - (b & ~c).bit_count() >= need and n_y - (c & ~b).bit_count() >= need):
                        pairs.append((0, min(h, h2), max(h, h2)))
            crowded = len(pairs) > crowd * len(some)
            expected += [(1, key, h) for h in {h for _, a, b in pairs for h in (a, b)}] if crowded else pairs
        for most in (1 << 17, 1 << 10, 64):
            monkeypatch.setattr(line_dedup, "_PAIRS", most)
            rows_out = line_dedup._pairs_of_range(80, 100, crowd, 10)(_table(rows)).to_pylist()
            assert sorted((r["kind"], r["a"], r["b"]) for r in rows_out) == sorted(expected)
        found[crowd] = {kind for kind, _, _ in expected}
    assert found == {2: {0, 1}, 1000: {0}} and all(seen)
