import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pulsevault.llm import sharding as S

from .helpers import ODD, documents, text


def judged(spark, rows, shards=5, extra=False):
    """The result's rows, after the checks that hold for any input; shard -> bytes; text -> its shards."""
    got = S.shard(documents(spark, rows, extra), shards).collect()
    raw = {i: (t or "").encode() for i, t in rows}
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    slots, loads, places = defaultdict(list), Counter(), defaultdict(set)
    for r in got:
        if list(i for i, _ in rows).count(r.doc_id) == 1:
            assert (r.size, r.text_crc32) == (len(raw[r.doc_id]) + 16, zlib.crc32(raw[r.doc_id]))
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
        places[r["size"], r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return got, [loads[s] for s in range(shards)], places


def test_groups_stay_together_and_sizes_are_even(spark):
    rows = [(i, text(i % 40, 20 + i % 40)) for i in range(160)] + [(1000 + i, text(1000 + i, 5 + i % 90)) for i in range(400)]
    _, loads, places = judged(spark, rows)
    assert all(len(s) == 1 for s in places.values())  # every group fits a shard
    assert max(loads) - min(loads) <= 60  # the smallest documents


def test_a_group_of_a_third_of_all_rows_takes_few_shards(spark):
    rows = [(i, text(5, 30) if i % 3 == 0 else text(i, 10 + i % 50)) for i in range(900)]
    _, loads, places = judged(spark, rows, shards=8)
    biggest = max(len(s) for s in places.values())
    share = 300 * (len(text(5, 30)) + 16) / (sum(loads) / 8)
    assert biggest <= np.ceil(share) + 1 and max(loads) - min(loads) <= 80
    assert sum(len(s) > 1 for s in places.values()) <= 1


def test_only_linked_documents(spark):
    rows = [(i, text(i // 2, 10 + (i // 2) % 30)) for i in range(400)]
    _, loads, places = judged(spark, rows)
    assert max(loads) <= 1.02 * sum(loads) / 5 and min(loads) >= 0.95 * sum(loads) / 5
    assert sum(len(s) > 1 for s in places.values()) <= 60  # of 200 pairs, of which a random start cuts 160


def test_one_text_only(spark):
    _, loads, _ = judged(spark, [(i, "the same") for i in range(101)])
    assert max(loads) - min(loads) <= 24


def test_odd_rows(spark):
    judged(spark, ODD, extra=True)
    assert S.shard(documents(spark, [])).count() == 0
    got, loads, _ = judged(spark, [(1, "x" * 1_000_000)] + [(i, text(i, 5)) for i in range(2, 60)])
    big = next(r.shard for r in got if r.doc_id == 1)
    assert sum(r.shard == big for r in got) == 1 and max(loads[s] for s in range(5) if s != big) < 700


def test_any_link_key(spark):
    """Neighbours may have different sizes: what counts is the key."""
    facts = spark.range(600).selectExpr("id AS row_id", "20 + id % 37 AS size", "if(id < 200, id % 20, id) AS k1", "0L AS k2").repartition(3)
    got = S.shard_rows(facts, shards=4).collect()
    loads, places = Counter(), defaultdict(set)
    for r in got:
        loads[r.shard] += r["size"]
        places[r.k1].add(r.shard)
    assert len(got) == 600 and max(loads.values()) - min(loads.values()) <= 40
    assert sum(len(s) > 1 for s in places.values()) == 0


def test_quotas():
    """Least gains go first; what leaves a shard makes room; nothing exceeds the capacity or what was there."""
    offers = [(1, 0, 5, 10.0), (2, 0, 4, 10.0), (2, 0, 1, 5.0)]
    assert S.accepted_shares(offers, np.array([85.0, 90.0, 90.0]), 100).tolist() == [1.0, 0.5, 0.0]
    assert S.accepted_shares([(0, 1, 3, 20.0), (1, 0, 0, 20.0)], np.array([100.0, 100.0]), 100).tolist() == [1.0, 1.0]  # an exchange
    rng = np.random.default_rng(0)
    loads = rng.uniform(80, 110, 6)
    offers = [(a, b, int(g), float(x)) for a, b, g, x in zip(*np.triu_indices(6, 1), rng.integers(0, 9, 15), rng.uniform(1, 30, 15), strict=True)]
    share = S.accepted_shares(offers, loads, 100)
    after = loads.copy()
    for (a, b, _, x), s in zip(offers, share, strict=True):
        after[a], after[b] = after[a] - s * x, after[b] + s * x
    assert (after <= np.maximum(loads, 100) + 1).all() and share.max() == 1


@pytest.mark.parametrize("seed", range(5))
def test_water_level(seed):
    rng = np.random.default_rng(seed)
    loads = rng.integers(0, 3000, 7).astype(float)
    classes = [(c, int(n), int(n) * c) for c, n in zip(rng.choice(np.arange(16, 200), 30, replace=False), rng.integers(1, 90, 30), strict=True)]
    dealt = S.filled(loads, classes)
    assert all(sum(n for c, _, n in dealt if c == own) == count for own, count, _ in classes)
    after = loads.copy()
    for c, s, n in dealt:
        after[s] += c * n
    assert after.max() - after.min() <= 2 * 200
