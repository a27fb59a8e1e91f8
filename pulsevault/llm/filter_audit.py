"""Filter interaction audit: what every filter takes, in every order in which the filters could be applied.

 1. document facts (one Arrow pass over the texts): a bit for each filter that fails, and a digest of the text;
 2. copies: the least id under each digest (aggregate with map-side combine), joined back by digest and id, so that no large
    group of copies meets in a task;
 3. labels by id, one row an id;
 4. documents counted by part and failing bits: 2^k counts a part at most, whatever the corpus holds;
 5. each part's counts reshaped to a 2 x ... x 2 tensor and contracted by einsum: along each axis a step selects pass, fail or
    all.
Only step 4's result meets by part.

Rows: a null text is empty; a null part is the empty string; rows with a null id have no smaller id and never count as
copies; equal rows with one id are no copies of each other, as none has a smaller id; an id with several labels has those that any
of its label rows gives it; labels of unknown ids are ignored; texts of any length are read whole; an empty table gives an empty
result; columns other than those named are ignored."""

from __future__ import annotations

import hashlib
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, materialise

#: Filters in the order of their bits; the last one, copies, needs the whole table.
FILTERS = "ABCDE"
_COPY = len(FILTERS) - 1
_CAPITALS = bytes(range(65, 91))
_SYMBOLS = b"#$%&*|"

#: The three ways in which a contraction may select along an axis whose places are (pass, fail).
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(raw: bytes) -> int:
    """Bits of the filters that a text (UTF-8) fails by itself: A under 200 words, B 100 * distinct words < 50 * words,
    C 100 * [A-Z] > 3 * code points, D any of #$%&*|."""
    words = raw.split()  # at ASCII white space
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    found = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * capitals > 3 * len(raw.decode("utf-8", "replace")), any(s in raw for s in _SYMBOLS))
    return sum(bit << i for i, bit in enumerate(found))


def document_facts(docs: DataFrame, part: str = "lang") -> DataFrame:
    """doc_id, part, bits (failures of the text alone), d1 and d2 (a digest of the text)."""
    arrow = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("bits", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64())])

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            texts = batch.column(2).to_pylist()
            digests = np.array([np.frombuffer(hashlib.blake2b(t, digest_size=16).digest(), np.int64) for t in texts], np.int64).reshape(-1, 2)
            return {"doc_id": batch.column(0), "part": batch.column(1), "bits": [failures(t) for t in texts], "d1": digests[:, 0], "d2": digests[:, 1]}

        return work

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("raw"))
    return map_rows(rows, make, "doc_id long, part string, bits int, d1 long, d2 long", arrow)


def with_copies(facts: DataFrame) -> DataFrame:
    """facts (a stored table) with the copies' bit: set where the text is that of a smaller doc_id anywhere in the table."""
    least = facts.groupBy("d1", "d2").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("first", F.lit(True))
    found = facts.join(least, ["d1", "d2", "doc_id"], "left")
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return found.select("doc_id", "part", F.when(copy, F.col("bits") + (1 << _COPY)).otherwise(F.col("bits")).alias("bits"))


def counted(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """part, bits, n, good, toxic: documents by part and failing bits. Rows of equal id, part and bits meet before the join."""
    rows = facts.groupBy("doc_id", "part", "bits").agg(F.count("*").alias("k"))
    mark = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(c)
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(mark("quality"), mark("toxic"))
    found = rows.join(known, "doc_id", "left")
    total = lambda c: F.sum(F.col("k") * F.coalesce(F.col(c), F.lit(0)))
    return found.groupBy("part", "bits").agg(F.sum("k").alias("n"), total("quality").alias("good"), total("toxic").alias("toxic"))


@cache
def selections(names: str = FILTERS) -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """The (order, step) pairs of all orders, and for each contraction an array (pairs, axes, 2) of what it selects."""
    k, pairs, picks = len(names), [], {"kept": [], "removed": [], "failing": [], "unique": []}
    for order in permutations(range(k)):
        for step, own in enumerate(order):
            before = set(order[:step])
            pairs.append(("".join(names[i] for i in order), step + 1))
            earlier = [PASS if i in before else ALL for i in range(k)]
            picks["kept"].append([PASS if i == own else s for i, s in enumerate(earlier)])
            picks["removed"].append([FAIL if i == own else s for i, s in enumerate(earlier)])
            picks["failing"].append([FAIL if i == own else ALL for i in range(k)])
            picks["unique"].append([FAIL if i == own else PASS for i in range(k)])
    return pairs, {name: np.array(p, np.int64) for name, p in picks.items()}


def contract(tensors: np.ndarray, select: np.ndarray) -> np.ndarray:
    """Sums (parts, pairs) of tensors (parts, 2, ..., 2) over the places that select (pairs, axes, 2) picks."""
    k = select.shape[1]
    axes = "abcdefgh"[:k]
    spec = f"p{axes}," + ",".join(f"s{x}" for x in axes) + "->ps"
    return np.einsum(spec, tensors, *[select[:, i] for i in range(k)], optimize=True)


def measured(n: np.ndarray, good: np.ndarray, toxic: np.ndarray, names: str = FILTERS) -> dict[str, np.ndarray]:
    """The measures (parts, pairs) of count tensors (parts, 2, ..., 2), axis i of which belongs to filter i."""
    pairs, select = selections(names)
    out = {"kept": contract(n, select["kept"]), "removed": contract(n, select["removed"])}
    out["redundant"] = contract(n, select["failing"]) - out["removed"]
    out["unique_fails"] = contract(n, select["unique"])
    out["good_lost"], out["toxic_lost"] = contract(good, select["removed"]), contract(toxic, select["removed"])
    own = np.array([names.index(order[step - 1]) for order, step in pairs])
    sums = np.stack([out["removed"][:, own == i].sum(axis=1) for i in range(len(names))], axis=1)
    out["shapley"] = sums[:, own]
    return out


def interactions(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """part, filter_order, step and the measures, from counts (part, bits, n, good, toxic) with a row a part and bits at
    most: a group has 2^k rows at most."""
    k = len(names)
    pairs, _ = selections(names)
    arrow = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *[(m, pa.int64()) for m in MEASURES]])

    def run(batches):
        orders, steps = pa.array([o for o, _ in pairs]), pa.array([s for _, s in pairs], pa.int32())
        for batch in batches:
            for at in range(batch.num_rows):
                cells = batch.column(1)[at].as_py()
                tensors = np.zeros((3, 2**k), np.int64)
                for c in cells:
                    tensors[:, c["bits"]] = c["n"], c["good"], c["toxic"]
                shaped = tensors.reshape(3, 1, *[2] * k).transpose(0, 1, *range(k + 1, 1, -1))  # bit 0 is the last axis of the reshaped
                got = measured(*shaped, names)
                part = pa.array([batch.column(0)[at].as_py()] * len(pairs), pa.string())
                yield pa.RecordBatch.from_arrays([part, orders, steps, *[pa.array(got[m][0], pa.int64()) for m in MEASURES]], schema=arrow)

    cells = counts.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("cells"))
    return cells.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """A row per part, order of the five filters and step, zeros included."""
    facts = materialise(document_facts(docs, part), "facts")
    return interactions(counted(with_copies(facts), labels))
