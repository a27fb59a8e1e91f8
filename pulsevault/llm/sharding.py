"""Sharding by balanced label propagation.

Documents that share a link key (here: equal texts) are neighbours. Labels are shards. What the rounds move are blocks: so
many documents of one key and size under one label, so that a key held by a third of all rows is a block a label and no hot group.

 1. document facts, stored: size, checksum, two hashes of the text as link key, a salt by row (JVM functions; texts are
    read once and never shuffled);
 2. linked documents start under labels dealt by row; each round joins every block with the labels of its key, weighted by
    bytes, and offers it to a heavier label (a key above the capacity keeps as many labels as it needs); offers are
    accepted by gain, from a histogram of (label, target, gain), as far as what comes and goes leaves every label within its quota,
    large blocks in part; it ends when next to nothing moves;
 3. what a shard holds above the mean is released again;
 4. documents without neighbours, and released ones, cut no edge wherever they go: they fill the shards up by class of size,
    large classes first, so that sizes end within about a small document of each other;
 5. ranks within keys, classes and shards come from counts by salt and a place within the salt; no key, class or shard is gathered.

The driver holds loads by shard, offers by (shard, target, gain bin), and documents by size class (at most `_EXACT` + 64 a doubling).

Rows: a null text is empty, so null and empty texts are neighbours; ids play no part, so null and repeated ids are rows of
their own, and repeated rows are neighbours; texts of any length are one size class among others, and a document larger than the mean
shard stands in one that takes no more; an empty table gives an empty result; columns other than id and text are ignored."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Bytes that a document has besides its text.
OVERHEAD = 16
#: Sizes below this are classes of their own; above it a doubling has 64 classes.
_EXACT = 4096
_KEY = ["k1", "k2"]
_BLOCK = [*_KEY, "size"]


def document_facts(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, size, text_crc32, k1, k2 (the link key: equal for equal texts)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2"),
    )


def salted_starts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, salt, n and first, the rows of the key under smaller salts; from rows that have `salt`. A key has a row a salt at
    most."""
    before = Window.partitionBy(*keys).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys, "salt").agg(F.count("*").alias("n"))
    return counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))


def _place(keys: list[str]):
    """The number of a row within its key and salt, from 0."""
    return F.row_number().over(Window.partitionBy(*keys, "salt").orderBy("row_id")) - 1


def _dealt(deal, rank):
    """The shard whose range (ascending structs of shard and upto) holds the rank; null beyond the last."""
    return F.get(F.filter(deal, lambda d: d["upto"] > rank), F.lit(0))["shard"]


def _ranges(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """keys and deal: per key, shards with the rank that ends their documents; from (keys, shard, n)."""
    grown = F.aggregate(
        F.array_sort(F.collect_list(F.struct("shard", "n"))), F.array().cast("array<struct<shard:int,upto:bigint>>"),
        lambda a, x: F.concat(a, F.array(F.struct(x["shard"].alias("shard"), (F.coalesce(F.get(a, F.size(a) - 1)["upto"], F.lit(0)) + x["n"]).alias("upto")))),
    )
    return blocks.where("n > 0").groupBy(*keys).agg(grown.alias("deal"))


def _loads(blocks: DataFrame, shards: int) -> np.ndarray:
    out = np.zeros(shards)
    for r in blocks.groupBy("shard").agg(F.sum(F.col("n") * F.col("size")).alias("b")).collect():
        out[r.shard] = r.b
    return out


def accepted_shares(offers: list[tuple[int, int, int, float]], loads: np.ndarray, capacity: float, passes: int = 200) -> np.ndarray:
    """The share of each offer (shard, target, gain bin, bytes) to accept, so that no shard ends above the capacity, or above its
    load where that is more: what leaves a shard makes room in it. All are accepted at first; where a shard would end too
    full, offers of the least gain go, until all fit."""
    source, target, gain = (np.array([o[i] for o in offers], np.int64) for i in range(3))
    size, share = np.array([o[3] for o in offers], float), np.ones(len(offers))
    bound, shards = np.maximum(capacity, loads), len(loads)
    into = {j: own[np.argsort(gain[own], kind="stable")] for j in range(shards) if len(own := np.flatnonzero(target == j))}
    for _ in range(passes):
        flow = share * size
        over = loads + np.bincount(target, flow, shards) - np.bincount(source, flow, shards) - bound
        if (over <= 1).all():
            break
        for j in np.flatnonzero(over > 0):
            if (own := into.get(j)) is None:
                continue
            cut = np.clip(over[j] - (np.cumsum(flow[own]) - flow[own]), 0, flow[own])  # taken from the offers in their order
            share[own] -= cut / size[own]
    return np.clip(share, 0, 1)


def offered(blocks: DataFrame, is_open: np.ndarray, capacity: float) -> DataFrame:
    """blocks with `target`, a heavier open label of their key for which they would leave theirs, and the `gain` bin; null where
    they stay."""
    weights = blocks.groupBy(*_KEY, "shard").agg(F.sum(F.col("n") * F.col("size")).alias("w"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("w")).alias("lighter"), F.xxhash64(*_KEY, "shard").alias("tie"), "shard")))
    hubs = weights.groupBy(*_KEY).agg(ordered.alias("labels"), F.sum("w").alias("total")).where(F.size("labels") > 1)
    found = blocks.join(hubs, _KEY, "left")
    may = F.array(*[F.lit(bool(x)) for x in is_open])
    at = F.array_position(F.col("labels.shard"), F.col("shard")).cast("int")
    keep = F.ceil(F.col("total") / F.lit(float(capacity))).cast("int")  # labels that the key needs
    better = F.filter(F.slice("labels", F.lit(1), F.greatest(F.col("at") - 1, F.lit(0))), lambda x: may[x["shard"]])
    found = found.withColumns({"at": at, "keep": keep}).withColumn("better", better)
    to = F.when((F.col("at") > F.col("keep")) & (F.size("better") > 0), F.get("better", F.pmod(F.col("at"), F.least(F.col("keep"), F.size("better")))))
    gain = F.floor(F.log2(1 - to["lighter"] + F.element_at("labels", F.col("at"))["lighter"])).cast("int")
    return found.select(*_BLOCK, "shard", "n", to["shard"].alias("target"), gain.alias("gain"))


def propagate(blocks: DataFrame, shards: int, capacity: float, rounds: int = 16, still: float = 0.0005) -> DataFrame:
    """Blocks (k1, k2, size, shard, n; a stored table) after rounds of moves to their neighbours' labels. It ends with a round
    that moves a share of at most `still` of the linked bytes while no label closes or opens."""
    spark = blocks.sparkSession
    is_open = np.ones(shards, bool)
    for number in range(rounds):
        loads = _loads(blocks, shards)
        offers = materialise(offered(blocks, is_open, capacity), "offers")
        sums = offers.where("target is not null").groupBy("shard", "target", "gain").agg(F.sum(F.col("n") * F.col("size")).cast("double").alias("b"))
        wanted = [tuple(r) for r in sums.collect()]  # 64 rows a pair of shards at most
        if not wanted:
            break
        shares = accepted_shares(wanted, loads, capacity)
        size, target = np.array([w[3] for w in wanted]), np.array([w[1] for w in wanted])
        # a label that turned most offers away is closed until it has room, so that blocks look at the next ones
        asked, got = np.bincount(target, size, shards), np.bincount(target, shares * size, shards)
        after = loads + got - np.bincount([w[0] for w in wanted], shares * size, shards)
        now = (2 * got >= asked) & (asked > 0) | (after < 0.99 * capacity)
        plan = spark.createDataFrame([(*w[:3], float(x)) for w, x in zip(wanted, shares, strict=True)], "shard int, target int, gain int, share double")
        chance = F.pmod(F.xxhash64(*_KEY, "shard", F.lit(number)), F.lit(1 << 20)) / float(1 << 20)
        part = F.least(F.col("n"), F.floor(F.col("share") * F.col("n") + chance))
        moved = F.when(F.col("share") == 1, F.col("n")).when(F.col("share") < 1, part).otherwise(0)
        moves = offers.join(F.broadcast(plan), ["shard", "target", "gain"], "left").withColumn("m", moved)
        ends = F.explode(F.array(F.struct("shard", (F.col("n") - F.col("m")).alias("n")), F.struct(F.col("target").alias("shard"), F.col("m").alias("n"))))
        landed = moves.select(*_BLOCK, ends.alias("e")).select(*_BLOCK, "e.shard", "e.n").where("n > 0")
        blocks = materialise(landed.groupBy(*_BLOCK, "shard").agg(F.sum("n").alias("n")), "blocks")
        if got.sum() <= still * loads.sum() and (now == is_open).all():
            break
        is_open = now
    return blocks


def released(blocks: DataFrame, shards: int, mean: float, passes: int = 8) -> DataFrame:
    """Blocks without the share of documents by which their shard is above the mean; more of them until it is not by more than
    a thousandth."""
    full = left = _loads(blocks, shards)
    gone, kept = np.zeros(shards), blocks
    for _ in range(passes):
        over = left - mean
        if (over <= (0 if kept is blocks else mean / 1000)).all():
            break
        gone += np.where(over > 0, np.maximum(over, mean / 1000) / np.maximum(full, 1), 0)
        share = F.array(*[F.lit(float(min(1.0, x))) for x in gone])[F.col("shard")]
        chance = F.pmod(F.xxhash64(*_KEY, "shard", F.lit("released")), F.lit(1 << 20)) / float(1 << 20)
        kept = blocks.withColumn("n", F.col("n") - F.when(share > 0, F.least(F.col("n"), F.floor(share * F.col("n") + chance))).otherwise(0))
        left = _loads(kept, shards)
    return kept


def filled(loads: np.ndarray, classes: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(class, shard, n): documents of (class, number, bytes), given from the largest size down, dealt to the shards that hold
    least, so that loads end level."""
    loads, out = loads.astype(float).copy(), []
    for c, count, size in sorted(classes, key=lambda x: (-x[2] / x[1], x[0])):
        mean = size / count
        order = np.sort(loads)
        steps = np.arange(1, len(order) + 1) * order - np.cumsum(order)  # bytes that raise all below a load to it
        reach = np.searchsorted(steps, size, "right")  # shards below the water level
        level = (size + order[:reach].sum()) / reach
        give = np.floor(np.maximum(level - loads, 0) / mean + 1e-9).astype(np.int64)
        left = count - int(give.sum())
        loads += give * mean
        if left > 0:
            least = np.argsort(loads, kind="stable")[:left] if left <= len(loads) else np.arange(len(loads))
            share, more = divmod(left, len(least))
            give[least] += share
            give[least[:more]] += 1
            loads[least] += share * mean
            loads[least[:more]] += mean
        elif left < 0:  # by rounding
            for s in np.argsort(-loads * (give > 0), kind="stable")[:-left]:
                give[s] -= 1
                loads[s] -= mean
        out += [(c, int(s), int(give[s])) for s in np.flatnonzero(give)]
    return out


def shard_rows(facts: DataFrame, shards: int = 40, rounds: int = 16, rows_per_salt: int = 50_000) -> DataFrame:
    """facts with shard and slot. facts (row_id, size, k1, k2, and any more columns but those used here) must be a stored table with
    a row_id of its own for every row."""
    n = facts.count()
    names = facts.columns
    # equal salts start under equal labels
    salts = shards * max(2, -(-n // (rows_per_salt * shards)))
    salted = facts.withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(salts)).cast("int"))
    linked = facts.groupBy(*_KEY).agg(F.count("*").alias("docs")).where("docs > 1").select(*_KEY)
    starts = materialise(salted_starts(salted, _BLOCK).join(linked, _KEY), "starts")
    total = facts.agg(F.sum("size")).first()[0] or 0
    mean = total / shards
    first = starts.groupBy(*_BLOCK, F.pmod("salt", F.lit(shards)).alias("shard")).agg(F.sum("n").alias("n"))
    blocks = released(propagate(materialise(first, "blocks"), shards, mean, rounds), shards, mean)
    # linked documents by their rank within key and size
    deals = starts.select(*_BLOCK, "salt", "first").join(_ranges(blocks, _BLOCK), _BLOCK)
    size_class = F.when(F.col("size") < _EXACT, F.col("size")).otherwise(_EXACT + F.floor(64 * F.log2(F.col("size") / float(_EXACT)))).cast("int")
    ranked = salted.join(deals, [*_BLOCK, "salt"], "left").withColumn("rank", F.col("first") + _place(_BLOCK))
    placed = materialise(ranked.select(*names, "salt", size_class.alias("class"), _dealt(F.col("deal"), F.col("rank")).alias("shard")), "placed")
    # the others fill the shards up
    loads = np.zeros(shards)
    for r in placed.where("shard is not null").groupBy("shard").agg(F.sum("size").alias("b")).collect():
        loads[r.shard] = r.b
    free = placed.where("shard is null").drop("shard")
    classes = [tuple(r) for r in free.groupBy("class").agg(F.count("*"), F.sum("size")).collect()]
    fills = facts.sparkSession.createDataFrame(filled(loads, classes), "class int, shard int, n long")
    begun = salted_starts(free, ["class"]).select("class", "salt", "first").join(F.broadcast(_ranges(fills, ["class"])), "class")
    poured = free.join(begun, ["class", "salt"]).withColumn("rank", F.col("first") + _place(["class"]))
    poured = poured.select(*names, "salt", _dealt(F.col("deal"), F.col("rank")).alias("shard"))
    done = materialise(placed.where("shard is not null").select(*poured.columns).unionByName(poured), "sharded")
    # slots
    offsets = salted_starts(done, ["shard"]).select("shard", "salt", "first")
    slot = (F.col("first") + F.col("place")).cast("long")
    return done.withColumn("place", _place(["shard"])).join(offsets, ["shard", "salt"]).select(*names, "shard", slot.alias("slot"))


def shard(docs: DataFrame, shards: int = 40, rounds: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: `bytes` is the law, sizes of the shards are near equal."""
    found = shard_rows(materialise(document_facts(docs), "facts"), shards, rounds)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
