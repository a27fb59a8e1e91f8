import itertools
import math
from collections import Counter

import numpy as np
import pytest

from pulsevault.llm import classifier as C

from .helpers import ODD, documents, text


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_trees_learn_and_flat_walk_equals_nodes():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    t = C.fit(x, y, trees=40, depth=3)
    assert ((t.probability(x) > 0.5) == y).mean() > 0.95
    one = np.full(len(x), t.base)
    for f, th, leaf in zip(t.feature, t.threshold, t.leaf):
        for i in range(len(x)):
            at = 0
            while at < len(f):
                at = 2 * at + 1 + (x[i, f[at]] > th[at])
            one[i] += leaf[at - len(f)]
    assert np.allclose(1 / (1 + np.exp(-one)), t.probability(x))


def test_one_sided_or_no_labels(spark):
    docs = documents(spark, ODD, extra=True)
    for rows in ([], [(1, 1, 0), (2, 1, 0)], [(None, 1, 0), (5, None, 0)]):
        got = C.classify(docs, labels(spark, rows)).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert C.classify(documents(spark, []), labels(spark, [])).count() == 0


def test_held_out_rows_are_not_learnt(spark):
    rows = [(i, text(i, 80) if i % 2 else ("JUNK!! " * 60)) for i in range(300)]
    marks = [(i, i % 2, 0) for i, _ in rows]
    flipped = [(i, 1 - q if C.is_held_out(i) else q, 0) for i, q, _ in marks]
    a, b = (C.classify(documents(spark, rows), labels(spark, m)).orderBy("doc_id").collect() for m in (marks, flipped))
    assert [r.score for r in a] == [r.score for r in b]
    assert all(r.held_out == C.is_held_out(r.doc_id) for r in a)
    assert np.mean([(r.predicted == r.doc_id % 2) for r in a if r.held_out]) > 0.95


def auc(score, label):
    pos, neg = [s for s, y in zip(score, label) if y], [s for s, y in zip(score, label) if not y]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def test_held_out_ranking_on_the_table(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")
    docs, marks = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = C.classify(docs, marks).join(marks, "doc_id").where("held_out and quality is not null").collect()
    assert len(got) > 50 and auc([r.score for r in got], [r.quality for r in got]) >= 0.95


def plain_statistics(t):
    """FEATURES by their names, a character or a word at a time."""
    raw, symbols = t.encode(), "#*$%&|<>"
    words = raw.split()
    if not words:
        return [0.0] * len(C.FEATURES)
    n, size, count = len(words), [len(w) for w in words], Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    runs = [len(list(g)) for _, g in itertools.groupby(words)]
    mean = lambda v: sum(v) / len(v)
    sd = lambda v: math.sqrt(mean([(x - mean(v)) ** 2 for x in v]))
    share = lambda test: mean([bool(test(w)) for w in words])
    chars = lambda test: sum(map(test, t)) / len(t)
    grams = lambda k: len({tuple(words[i : i + k]) for i in range(n - k + 1)}) / (n - k + 1) if n >= k else 1
    got = {
        "log_chars": math.log1p(len(t)), "log_words": math.log1p(n), "mean_word": mean(size), "sd_word": sd(size), "long_words": mean([x > 14 for x in size]), "short_words": mean([x < 3 for x in size]),
        "upper": chars(lambda c: "A" <= c <= "Z"), "digits": chars(lambda c: "0" <= c <= "9"), "symbols": chars(lambda c: c in symbols), "non_ascii": chars(lambda c: ord(c) > 127),
        "punct": chars(lambda c: ord(c) < 128 and not c.isalnum() and not c.isspace() and c not in symbols), "symbol_words": share(lambda w: chr(w[-1]) in symbols), "bang": share(lambda w: w.endswith(b"!")), "pipe": t.count("|") / n,
        "distinct_words": len(count) / n, "top_word": max(count.values()) / n, "equal_next": mean([a == b for a, b in zip(words, words[1:])]) if n > 1 else 0, "distinct_bigrams": grams(2), "distinct_trigrams": grams(3),
        "lines": len(lines) / n, "mean_line": math.log1p(mean(list(map(len, lines)))), "sd_line": math.log1p(sd(list(map(len, lines)))), "distinct_lines": len(set(lines)) / len(lines), "line_end_stop": mean([x.rstrip().endswith(b".") for x in lines]),
        "stops_per_word": share(lambda w: w.endswith(b".")), "upper_words": share(lambda w: w.isupper()), "title_words": share(lambda w: w[:1].isupper()), "log_distinct": math.log1p(len(count)), "mean_run": mean(runs), "max_run": math.log1p(max(runs)),
        "longest_word": math.log1p(max(size)), "chars_per_distinct": len(t) / len(count),
    }
    return [got[f] for f in C.FEATURES]


@pytest.mark.parametrize("t", ["", " \n", "a", "a a", "One. Two!\nONE ONE #x |\n\n One. Two!\n", "é ü 日本語 ß 12 a|b <p> x* end.", "tab\tand\x0bothers\x1c\r\nline.\n" * 3, text(3, 500), "same " * 700])
def test_statistics_by_hand(t):
    assert np.allclose(C.statistics(t), plain_statistics(t), rtol=1e-5, atol=1e-6)


def test_one_boosting_step_is_the_best_split():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)).astype(np.float32)
    y = (x[:, 2] + rng.normal(size=300) > 0.4).astype(float)
    base = math.log(y.mean() / (1 - y.mean()))
    g, h = y - y.mean(), np.full(300, y.mean() * (1 - y.mean()))
    best = None
    for j in range(4):
        for t in np.unique(np.quantile(x[:, j], np.linspace(0, 1, 65)[1:-1]).astype(np.float32)):
            left = x[:, j] <= t
            if 8 <= left.sum() <= 292:
                gain = sum(g[m].sum() ** 2 / (h[m].sum() + 1) for m in (left, ~left))
                if best is None or gain > best[0] + 1e-12:
                    best = gain, j, t, left
    _, j, t, left = best
    tree = C.fit(x, y, trees=1, depth=1)
    assert (tree.base, tree.feature.tolist(), tree.threshold.tolist()) == (pytest.approx(base), [[j]], [[t]])
    assert tree.leaf[0] == pytest.approx([0.1 * g[m].sum() / (h[m].sum() + 1) for m in (left, ~left)])
