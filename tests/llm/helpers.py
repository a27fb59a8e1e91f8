"""Small frames for the operator tests."""

import random

from pulsevault.llm.common import word_hashes

WORDS = [f"w{i}" for i in range(400)]


def text(seed, n, words=WORDS):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(n))


def edited(t, seed, share):
    rng, w = random.Random(seed), t.split(" ")
    for _ in range(int(len(w) * share)):
        w[rng.randrange(len(w))] = f"x{rng.random()}"
    return " ".join(w)


def documents(spark, rows, extra=False):
    """rows of (doc_id, text[, source]); extra: columns whose names the operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        for name in ("length", "key", "n", "host", "score", "keys", "ids"):
            df = df.selectExpr("*", f"'clash' AS {name}")
    return df


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "no id here"), (5, "word " * 50_000), (6, "é ü 日本語 ß\x1c x")]


def hashed(words):
    return word_hashes(b" ".join(words))
