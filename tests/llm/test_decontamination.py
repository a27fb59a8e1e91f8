import hashlib
import re

import numpy as np
import pytest

from pulsevault.llm import decontamination as D

from .helpers import hashed, ODD, documents, text


def words(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(rows, items, window=13):
    windows = {}
    for item, t in items:
        w = words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                who = windows.get(tuple(w[i : i + n]))
                if who:
                    found |= who
                    hit.update(range(i, i + n))
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((str(doc), len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


ITEMS = [(1, text(1, 40)), (2, text(2, 13)), (3, text(3, 12)), (4, "Short, item"), (5, None), (6, " !! "), (7, text(1, 40)), (8, text(8, 5) + " " + text(1, 40)[:80]), (10, "é"), (20, text(20, 14))]
PARTS = [t for _, t in ITEMS if t]
ROWS = [
    *ODD, (10, PARTS[0]), (11, text(50, 300) + " " + PARTS[0].upper() + " " + text(51, 900)), (12, " ".join(text(50, 30).split() + PARTS[1].split()[:12])), (13, "x " + PARTS[1].replace(" ", ", ") + " y"), (14, PARTS[2] + " " + PARTS[2]),
    (15, "a short ITEM b"), (16, text(60, 500) + " é " + text(61, 20)), (17, text(1, 40).split(" ", 1)[1]), (18, " ".join(PARTS)), (19, text(70, 2000)), (21, ("again " * 30) + PARTS[8]),
]


def result(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


@pytest.mark.parametrize("limit", [5_000_000, -1])
def test_both_routes_equal_brute_force(spark, limit):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert result(D.contamination(documents(spark, ROWS, extra=True), bench, broadcast_words=limit)) == brute(ROWS, ITEMS)


@pytest.mark.parametrize("limit", [5_000_000, -1])
def test_clean_documents(spark, limit):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark, ROWS, extra=True)
    got = D.clean_documents(docs, bench, broadcast_words=limit)
    assert got.columns == docs.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(r[0] for r in brute(ROWS, ITEMS) if not r[-1])


@pytest.mark.parametrize("limit", [5_000_000, -1])
def test_empty_tables(spark, limit):
    none = spark.createDataFrame([], "item_id long, text string")
    assert result(D.contamination(documents(spark, ROWS), none, broadcast_words=limit)) == brute(ROWS, [])
    assert D.contamination(documents(spark, []), spark.createDataFrame(ITEMS, "item_id long, text string"), broadcast_words=limit).count() == 0


def test_every_long_shared_span_shares_a_fingerprint():
    rng = np.random.default_rng(0)
    for _ in range(200):
        span = [b"%d" % x for x in rng.integers(0, 6, 13)]  # few words: many ties
        docs = [[b"%d" % x for x in rng.integers(0, 6, rng.integers(0, 20))] for _ in range(4)]
        prints = []
        for before, after in (docs[:2], docs[2:]):
            g = D.gram_hashes(hashed(before + span + after), 5)
            at = D.winnow(g, 9)
            prints.append({int(g[i]) for i in at if len(before) <= i <= len(before) + 8})
        assert prints[0] & prints[1]
