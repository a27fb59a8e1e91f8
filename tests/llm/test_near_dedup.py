import re

import numpy as np
import pytest

from pulsevault.llm import near_dedup as N
from pulsevault.llm.components import components

from .helpers import hashed, ODD, documents, edited, text


def brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets.setdefault(i, frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset())
    comp = {i: i for i in sets if i is not None}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = list(comp)
    for a in ids:
        for b in ids:
            m = len(sets[a] & sets[b])
            if a < b and m and 100 * m >= percent * (len(sets[a]) + len(sets[b]) - m):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return sorted((str(i), len(sets[i]), str(None if i is None else find(i)), True if i is None else find(i) == i) for i, _ in rows)


def family(seed, n, base, first):
    return [(first + i, edited(base, seed * 1000 + i, (i % 9) / 100)) for i in range(n)]


ROWS = [*ODD, *family(1, 40, text(1, 200), 100), *family(2, 25, text(2, 90), 300), *[(400 + i, text(3, 80)) for i in range(30)], *[(500 + i, text(500 + i, 60) + " " + text(9, 60)) for i in range(30)], *[(600 + i, text(i, 3 + i)) for i in range(20)], (700, text(3, 80).upper()), (701, "One"), (702, "a b"), (703, "A  b\n")]


def result(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in df.collect())


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_equals_brute_force(spark, k, percent):
    assert result(N.near_duplicates(documents(spark, ROWS, extra=True), k, percent)) == brute(ROWS, k, percent)


def test_shared_passage_does_not_link(spark):
    rows = [(i, text(1000 + i, 50) + " " + text(9, 80)) for i in range(60)]
    assert result(N.near_duplicates(documents(spark, rows), 3, 85)) == brute(rows, 3, 85)


def test_empty(spark):
    assert N.near_duplicates(documents(spark, [])).count() == 0


def test_deduplicated(spark):
    docs = documents(spark, ROWS, extra=True)
    got = N.deduplicated(docs, 5, 80)
    kept = {r[0] for r in brute(ROWS, 5, 80) if r[3]}
    assert got.columns == docs.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(kept)


def test_min_and_max_estimate_similarity():
    rng = np.random.default_rng(0)
    seeds = N.mixed(np.arange(1, 2001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    a = hashed([b"%d" % i for i in range(300)])
    b = np.concatenate([a[:200], hashed([b"x%d" % i for i in range(100)])])
    s = [N.signature(np.unique(x), seeds[:1000], seeds[1000:] | np.uint64(1)) for x in (a, b)]
    same = s[0] == s[1]
    assert abs(same[:1000].mean() - 0.5) < 0.06 and abs(same[1000:].mean() - 0.5) < 0.06
    assert (1 - 0.85**6) ** N.bands_for(0.85, 6) <= 1e-6 < (1 - 0.85**6) ** (N.bands_for(0.85, 6) - 1)


def test_sketch_bounds_the_difference():
    for n, d in ((50, 3), (400, 40), (5000, 600)):
        a = np.unique(hashed([b"%d" % i for i in range(n)]))
        b = np.unique(np.concatenate([a[d:], hashed([b"y%d" % i for i in range(d)])]))
        bits = [np.bincount((x % np.uint64(2048)).astype(int), minlength=2048) & 1 for x in (a, b)]
        assert (bits[0] != bits[1]).sum() <= len(np.setxor1d(a, b))


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 30)] + [(50, 40), (60, 50), (60, 60), (70, 71), (71, 70), (None, 3)]
    got = {r.u: r.m for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(2, 31)}, 50: 40, 60: 40, 71: 70}
    star = [(9, i) for i in range(10, 300)] + [(i, 9000 + i) for i in range(10, 300)] + [(5, 9299)]  # a hub amid chains
    assert {r.m for r in components(spark.createDataFrame(star, "u long, v long")).collect()} == {5}
