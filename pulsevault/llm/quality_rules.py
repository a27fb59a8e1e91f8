"""Quality rules of documents and of their hosts.

Words, symbols, repeated lines and repeated word windows are counted over every whole text in one pass. Rule failures are
summed by host (here the `source` column), the rates are shrunk with a beta prior fitted by moments to the hosts of at least
`least` documents, and such a host takes its documents with it if its shrunk rate of any rule lies `spreads` deviations of that
prior above its mean (whatever the shape of the prior, at most one in spreads^2 + 1 of its hosts lies there), and by no less
than `margin`, so that where hosts are alike a difference that matters little rejects none; so does one above `host_limit`
whatever the prior. Host totals are an aggregate with map-side
combine and the verdict comes back by a join that may be split, so a host with a third of all rows is no hot task.

Rows: a null text has no words and fails; texts of any length are counted whole; a null host is a host of its own; hosts with
equal rates share their verdict, and a rate at its limit is kept; null or repeated doc_ids give a row each; an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .common import map_rows, materialise, short_batches, unused

SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = ["few_words", "repeats", "symbols", "dup_lines"]


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of `width` words found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(number) == len(words):
        return 0
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    code = ids[:n]
    for i in range(1, width):
        code = code * len(number) + ids[i : i + n]
        if len(number) > 2_000_000:  # a third power would not fit 63 bits
            code = np.unique(code, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    c = code[order]
    same = c[1:] == c[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    hit = np.zeros(len(words), bool)
    for i in range(width):
        hit[i : i + n] |= twice
    return int(hit.sum())


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """COUNTS of a text; a word is a run of characters other than ASCII white space."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    blanks = len(raw) - len(raw.translate(None, b"\x20\x09\x0a\x0b\x0c\x0d"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS.encode()))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated_words(words)


def document_counts(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """doc_id, host and COUNTS of every row."""
    arrow = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), *[(c, pa.int64()) for c in COUNTS]])

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            rows = [text_counts(t) for t in batch.column(2).to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(COUNTS)
            return {"doc_id": batch.column(0), "host": batch.column(1)} | dict(zip(COUNTS, columns, strict=True))

        return work

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col("text").alias("text"))
    return map_rows(rows, make, "doc_id long, host string, " + ", ".join(f"{c} long" for c in COUNTS), arrow)


def rule_failures(counted: DataFrame) -> DataFrame:
    """Adds a boolean for each of RULES and base_failed (either of the first two)."""
    out = counted.withColumns({
        "few_words": F.col("n_words") < 50,
        "repeats": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > 3 * F.col("n_words"),
        "dup_lines": 10 * F.col("n_dup_lines") > F.col("n_words"),
    })
    return out.withColumn("base_failed", F.col("few_words") | F.col("repeats"))


def host_verdicts(failures: DataFrame, host_limit: float = 0.8, margin: float = 0.1, spreads: float = 3.0, least: int = 10) -> DataFrame:
    """host, n and for each rule its failures, the shrunk rate and whether the host is rejected by it (any: host_failed).

    The prior of a rule is the beta distribution whose mean and spread are those of the rates of the hosts with at least `least`
    documents (moments, hosts weighted alike); where hosts differ no more than chance would have it, the prior is worth as many
    documents as a mean host has. Smaller hosts are shrunk alike and never rejected; if there are none but these, rates are
    their own."""
    per_host = failures.groupBy("host").agg(F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES])
    stats = [F.avg("n").alias("docs"), F.avg(1 / F.col("n")).alias("inverse")]
    for r in RULES:
        stats += [F.avg(F.col(r) / F.col("n")).alias(f"{r}_mean"), F.var_pop(F.col(r) / F.col("n")).alias(f"{r}_var")]
    prior = per_host.where(F.col("n") >= least).agg(*stats).na.fill(0.0)
    out = per_host.join(F.broadcast(prior))  # one row
    for r in RULES:
        mean, var = F.col(f"{r}_mean"), F.col(f"{r}_var")
        chance = mean * (1 - mean) * F.col("inverse")  # spread that sampling alone gives
        weight = F.when(var > chance, F.greatest(F.lit(1.0), mean * (1 - mean) / (var - chance) - 1)).otherwise(F.col("docs"))
        weight = F.least(weight, F.col("docs"))
        limit = F.least(F.lit(host_limit), mean + F.greatest(F.lit(margin), spreads * F.sqrt(mean * (1 - mean) / (weight + 1))))
        out = out.withColumn(f"{r}_rate", (F.col(r) + weight * mean) / (F.col("n") + weight)).withColumn(f"{r}_over", (F.col("n") >= least) & (F.col(f"{r}_rate") > limit))
    out = out.withColumn("host_failed", F.greatest(*[F.col(f"{r}_over") for r in RULES]))
    return out.select("host", "n", *RULES, *[f"{r}_rate" for r in RULES], "host_failed")


def judge(docs: DataFrame, host_col: str = "source", host_limit: float = 0.8) -> DataFrame:
    """doc_id, COUNTS, base_failed, host_failed and kept for every row."""
    failures = materialise(rule_failures(document_counts(docs, host_col)), "failures")
    verdict = host_verdicts(failures, host_limit).select(F.col("host").alias("_host"), "host_failed")
    out = failures.join(verdict, F.col("host").eqNullSafe(F.col("_host")), "left")
    return out.select("doc_id", *COUNTS, "base_failed", "host_failed", (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"))


def kept_documents(docs: DataFrame, host_col: str = "source", host_limit: float = 0.8, broadcast_hosts: int = 100_000) -> DataFrame:
    """The rows of docs that neither their own text nor their host fails, in docs' columns. Texts are judged in one pass that
    stores the rows with their verdicts (without the text where it fails), and the failed hosts, whose number is counted first,
    travel to them, so no text is shuffled. If there are more of them than `broadcast_hosts`, rows are dealt by host and a salt,
    so that a large host is many groups. doc_ids may be null or repeated; every row is judged on its own."""
    short_batches(docs.sparkSession)
    mark, name, of, salt = (unused(docs, n) for n in ("_flags", "_host", "_of", "_salt"))
    flags = F.col(mark)
    stored = materialise(docs.withColumn(mark, _flags("text")).withColumn("text", F.when(flags.bitwiseAND(F.lit(3)) == 0, F.col("text"))), "judged", docs.count(), rows_a_task=5_000)
    host = F.col(host_col).cast("string")
    failures = stored.select(host.alias("host"), *[(flags.bitwiseAND(F.lit(1 << i)) != 0).alias(r) for i, r in enumerate(RULES)])
    bad = materialise(host_verdicts(failures, host_limit).where("host_failed").select(F.col("host").alias(name)), "hosts")
    good, same = stored.where(flags.bitwiseAND(F.lit(3)) == 0), host.eqNullSafe(F.col(name))
    if bad.count() <= broadcast_hosts:
        return good.join(F.broadcast(bad), same, "left_anti").select(*docs.columns)
    salts = 64
    bad = bad.withColumn(of, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = good.withColumn(salt, F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    return salted.join(bad, same & (F.col(salt) == F.col(of)), "left_anti").select(*docs.columns)


@F.pandas_udf(IntegerType())
def _flags(text: pd.Series) -> pd.Series:
    """A bit for each of RULES, the first two being the base's."""

    def bits(t: str | None) -> int:
        words, _, symbols, lines, repeats = text_counts(t)
        return (words < 50) + 2 * (100 * repeats > 50 * words) + 4 * (10 * symbols > 3 * words) + 8 * (10 * lines > words)

    return pd.Series([bits(t) for t in text], dtype="int32")
