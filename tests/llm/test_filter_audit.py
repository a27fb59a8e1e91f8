import re
from itertools import permutations

import pytest

from pulsevault.llm import filter_audit as A

from .helpers import ODD, documents, text


def fails(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    return [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t))]


@pytest.mark.parametrize("t", ["", "a", "A" * 3 + "b" * 97, "A" * 4 + "b" * 96, "é" * 96 + "ABCD", "A" * 3 + "é" * 97, " ".join(map(str, range(200))), "x " * 200, "a\x0bb\x1cc\x85d " * 90, "a#", "a|b", "50%", "z" * 300_000])
def test_failures_of_a_text(t):
    assert A.failures(t.encode()) == sum(x << i for i, x in enumerate(fails(t)))


def brute(rows, labels):
    """One document after the other through every order."""
    docs = [(i, t or "", part or "") for i, t, part in rows]
    good, toxic = ({i for i, q, x in labels if i is not None and (q, x)[k] == 1} for k in (0, 1))
    bits = [[*fails(t), i is not None and any(j is not None and j < i and u == t for j, u, _ in docs)] for i, t, _ in docs]
    out, taken = {}, {}
    for part in {p for _, _, p in docs}:
        own = [(i, b) for (i, _, p), b in zip(docs, bits, strict=True) if p == part]
        for order in permutations(range(5)):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[1][f]]
                left = [x for x in left if not x[1][f]]
                taken[part, f] = taken.get((part, f), 0) + len(gone)
                out[part, "".join("ABCDE"[i] for i in order), step] = [
                    len(left), len(gone), sum(b[f] for _, b in own) - len(gone), sum(b[f] and sum(b) == 1 for _, b in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
    return {(p, o, s): (*v, taken[p, "ABCDE".index(o[s - 1])]) for (p, o, s), v in out.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): tuple(r[m] for m in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in df.collect()}


ROWS = (
    [(i, text(i, 150 + 10 * i) + (" $" if i % 3 == 0 else "") + (" LOUD WORDS" * 40 if i % 4 == 0 else ""), ["en", "de", None][i % 3]) for i in range(24)]
    + [(100 + i, text(7, 220), "en") for i in range(6)] + [(90, text(7, 220), "de"), (None, text(7, 220), "de"), (5000, None, ""), (5001, "", "fr"), (5001, "", "fr"), (23, text(23, 380), "de")]
)
LABELS = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 110, 2)] + [(3, 1, None), (3, 0, 1), (None, 1, 1), (777777, 1, 1), (90, None, 1)]


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, p, "clash", 1, 2) for i, t, p in rows], "doc_id long, text string, lang string, part string, bits int, n int")
    return docs, spark.createDataFrame([(*x, "clash") for x in labels], "doc_id long, quality int, toxic int, part string")


def test_equals_brute_force(spark):
    got = found(A.audit(*frames(spark, ROWS, LABELS)))
    assert got == brute(ROWS, LABELS) and len(got) == 4 * 600


def test_empty_tables(spark):
    docs, labels = frames(spark, ROWS, LABELS)
    assert A.audit(docs.limit(0), labels).count() == 0
    assert found(A.audit(docs, labels.limit(0))) == brute(ROWS, [])


def test_odd_rows(spark):
    assert found(A.audit(documents(spark, ODD, extra=True), frames(spark, [], LABELS)[1])) == brute([(i, t, "en") for i, t in ODD], LABELS)


def test_one_text_in_a_third_of_all_rows(spark):
    rows = [(i, "same text" if i % 3 == 0 else text(i, 210), "en") for i in range(300)]
    got = found(A.audit(*frames(spark, rows, [])))
    assert got["en", "EABCD", 1][1] == 99 and got == brute(rows, [])


def test_other_filters(spark):
    counts = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 3, 2, 1, 1)], "part string, bits int, n long, good long, toxic long")
    got = found(A.interactions(counts, "XY"))
    assert got == {("p", "XY", 1): (5, 2, 0, 0, 1, 1, 2), ("p", "XY", 2): (5, 0, 2, 0, 0, 0, 2), ("p", "YX", 1): (5, 2, 0, 0, 1, 1, 2), ("p", "YX", 2): (5, 0, 2, 0, 0, 0, 2)}
