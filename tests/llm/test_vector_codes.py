import hashlib
import math

import numpy as np
import pytest

from pulsevault.llm import vector_codes as V


def brute(rows, parts=4, entries=6, rounds=2):
    """Every part of every vector against every entry, in Python integers. rows: (id, vector, label)."""
    kept = [(i, [math.floor(256 * x) for x in v], g) for i, v, g in rows if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    cut = lambda v: [v[p * len(v) // parts : (p + 1) * len(v) // parts] for p in range(parts)]
    first = sorted((i, v) for i, v, _ in kept if i is not None)[:entries]
    books = [[cut(v)[p] for _, v in first] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda x, book: min(range(len(book)), key=lambda e: (apart(x, book[e]), e))
    for _ in range(rounds):
        for p, book in enumerate(books):
            mine = {}
            for _, v, _ in kept:
                mine.setdefault(nearest(cut(v)[p], book), []).append(cut(v)[p])
            books[p] = [[sum(c) // len(mine[e]) for c in zip(*mine[e], strict=True)] if e in mine else b for e, b in enumerate(book)]
    sha = hashlib.sha256(",".join(str(c) for book in books for b in book for c in b).encode()).hexdigest()
    out = []
    for i, v, g in kept:
        code = [nearest(x, book) for x, book in zip(cut(v), books, strict=True)]
        out.append((i, "".join(f"{c:02x}" for c in code), sum(apart(x, book[c]) for x, book, c in zip(cut(v), books, code, strict=True)), g))
    return sorted(((i, c, e, sum(f for _, _, f, h in out if h == g), sha) for i, c, e, g in out), key=repr)


def found(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<float>, label int, v string, error int")
    got = V.compress(df, **{"parts": 4, "entries": 6} | kw)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def vectors(n, seed=0, width=8, grain=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).astype(np.float32)
    return [[float(c) for c in (np.round(r * grain) / grain if grain else r)] for r in x]


@pytest.mark.parametrize("grain", [None, 2])  # a coarse grain makes ties
def test_equals_brute_force(spark, grain):
    rows = [(i, v, i % 3 if i % 7 else None) for i, v in enumerate(vectors(300, grain=grain))]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = vectors(20, 3)
    rows = [(i, x, 1) for i, x in enumerate(v)] + [(20, None, 1), (21, [nan, *v[0][1:]], 2), (22, [inf, *v[0][1:]], 2), (23, [None, *v[0][1:]], None), (24, [], 1), (None, v[3], None), (5, v[5], 1), (5, v[6], 1), (25, v[0][:6], 1)]
    got = found(spark, rows)
    assert got == brute(rows) and len(got) == 23
    assert found(spark, rows[:3]) == brute(rows[:3])  # fewer vectors than entries
    assert found(spark, rows[20:25]) == [] and found(spark, rows[:0]) == []


def test_vectors_of_another_length_are_dropped(spark):
    rows = [(i, v, 0) for i, v in enumerate(vectors(12, 4))]
    assert found(spark, [*rows, *[(100 + i, v, 0) for i, v in enumerate(vectors(5, 5, width=12))]]) == brute(rows)


def test_huge_components(spark):
    rows = [(i, v, 0) for i, v in enumerate(vectors(12, 6))] + [(50, [3e38] * 4 + [-3e38] * 4, 1)]
    got = {r[0]: r for r in found(spark, rows)}
    assert len(got) == 13 and got[50][2] >= 0


def test_one_vector_in_a_third_of_all_rows(spark):
    v = vectors(400, 7)
    rows = [(i, v[0] if i % 3 == 0 else x, int(i % 3 == 0)) for i, x in enumerate(v)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize(("n", "k", "d", "span"), [(1, 1, 1, 5), (5, 64, 4, 100), (3000, 64, 4, 300), (3000, 64, 2, 6), (1000, 7, 5, 1000), (2000, 64, 3, 1)])
def test_walk_is_exact(n, k, d, span):
    rng = np.random.default_rng(n + k)
    x, e = rng.integers(-span, span + 1, (n, d)), rng.integers(-span, span + 1, (k, d))
    best, counts, sums = V.walk(V.PartTree(x), V.EntryTree(e))
    want = ((x[:, None] - e[None]) ** 2).sum(-1).argmin(1)
    assert (best == want).all() and (counts == np.bincount(want, minlength=k)).all()
    assert all((sums[i] == x[want == i].sum(0)).all() for i in range(k))


def test_the_trees_spare_distances(monkeypatch):
    """Clustered parts are assigned by whole nodes: few of them are left to be compared one by one."""
    rng = np.random.default_rng(1)
    e = rng.integers(-10_000, 10_000, (64, 4))
    x = e[rng.integers(0, 64, 8000)] + rng.integers(-20, 21, (8000, 4))
    parts, seen = V.PartTree(x), []
    plain = V._open_entries
    monkeypatch.setattr(V, "_open_entries", lambda low, *a: seen.append(len(low)) or plain(low, *a))
    V.walk(parts, V.EntryTree(e))
    assert sum(seen) < 8000 / 4


def test_blocks_hold_a_bounded_number_of_rows(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(V, "_BLOCK", 10)
    made = [pa.RecordBatch.from_arrays([pa.array(range(n))], ["x"]) for n in (3, 0, 25, 7, 10)]
    got = [b.column(0).to_pylist() for b in V._blocks(made)]
    assert [x for b in got for x in b] == [*range(3), *range(25), *range(7), *range(10)] and max(map(len, got)) <= 10
