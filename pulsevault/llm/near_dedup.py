"""MinHash near-duplicate detection with min-max signatures.

Each permutation of the shingle hashes gives two signature values, its minimum and its maximum, so a signature needs half as
many hash evaluations; both agree with probability J, and as they are nearly independent the bands over them are unbiased
and vary less. Bands of `rows` values are keys; documents that share a key are candidates, and a candidate link counts only
if the full shingle sets confirm it.

Steps, each a Spark job whose rows are documents or (document, key) pairs:
 1. words -> distinct shingles -> number, 128-bit digest of the set, band keys, parity sketch (Arrow map);
 2. documents with equal sets form one class, the least id represents it (aggregate with map-side combine);
 3. each representative with the least one under each of its keys, where their sketches allow a link; confirmed links ->
    components;
 4. of the keys that still join several components, the documents outside the key's largest component against those of
    other components, confirmed, -> components. Pairs within a component could not change anything.
A large group of near copies thus costs a link or a few per member, and not the square of its size.

The sketch turns pairs away before their sets are made, and does so exactly: bit b of it is the parity of
the number of shingles whose hash falls on b, so two sketches differ in at most as many bits as their sets have shingles that
the other lacks. A pair whose sketches differ in more bits than a link allows can't be one.

No text is shuffled. To confirm pairs, the documents that occur in them are found again in a scan of docs by a bitmap of
their hashed ids, of 16 bits an id and at most `MOST_BITS` bits (32 MB) whatever the corpus holds. A bit that several ids
share lets a set through that no pair asks for; the joins with the pairs drop it, so the bitmap never decides a link.

The only misses are of the banding: a pair at exactly the threshold shares no key with probability below `miss`, more similar
ones far less.

Rows: a null or blank text has no shingles and is linked with nothing; repeated rows are copies of each other, and rows that
share a doc_id are one node; a row whose doc_id is null is never linked, its component_id is null and it is kept; an empty
table gives an empty result; columns other than id and text are ignored."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_WORDS, SLICE_ROWS, gram_hashes, hash_bitmap, in_bitmap, map_rows, materialise, mixed, short_batches, unused, word_hashes
from .components import components, merged

_SKETCH = 32  # longs of the parity sketch
_COLS = 4096  # shingles that are permuted at once


def bands_for(threshold: float, rows: int, miss: float = 1e-6) -> int:
    """Bands needed so that a pair at the threshold shares no key with a probability of at most `miss`."""
    return math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a text; with fewer words, of the whole sequence. Words are
    runs of characters other than ASCII white space, A-Z lower-cased."""
    words = word_hashes((text or "").encode("utf-8", "replace").translate(LOWER_WORDS))
    if not len(words):
        return words
    return np.unique(gram_hashes(words, min(k, len(words))))


def signature(x: np.ndarray, xors: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Minimum and maximum under each permutation x -> (x ^ a) * b, b odd."""
    low = high = None
    for at in range(0, len(x), _COLS):
        h = (x[None, at : at + _COLS] ^ xors[:, None]) * factors[:, None]
        a, b = h.min(axis=1), h.max(axis=1)
        low, high = (a, b) if low is None else (np.minimum(low, a), np.maximum(high, b))
    return np.concatenate([low, high])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n, d1, d2 (digest of the set), keys (a band key each), sketch. No keys where there are no shingles."""
    perms = -(-bands * rows // 2)
    arrow = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("keys", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])

    def make():
        seeds = mixed(np.arange(1, 2 * perms + bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        xors, factors, weights = seeds[:perms], seeds[perms : 2 * perms] | np.uint64(1), seeds[2 * perms :].reshape(bands, rows) | np.uint64(1)
        band_no = np.arange(bands, dtype=np.uint64)

        def work(batch: pa.RecordBatch) -> dict:
            out = {f.name: [] for f in arrow}
            out["doc_id"] = batch.column(0)
            for text in batch.column(1).to_pylist():
                x = shingle_set(text, words)
                out["n"].append(len(x))
                if not len(x):
                    for key, v in (("d1", 0), ("d2", 0), ("keys", None), ("sketch", None)):
                        out[key].append(v)
                    continue
                out["d1"].append(int(signed(x.sum(keepdims=True))[0]))
                out["d2"].append(int(signed(mixed(x ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True))[0]))
                sig = signature(x, xors, factors)
                keys = mixed((mixed(sig[: bands * rows].reshape(bands, rows)) * weights).sum(axis=1) + band_no)
                out["keys"].append(signed(keys))
                parity = np.bincount((x % np.uint64(64 * _SKETCH)).astype(np.int64), minlength=64 * _SKETCH) & 1
                out["sketch"].append(signed(np.packbits(parity.astype(np.uint8)).view(np.uint64)))
            return out

        return work

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, n long, d1 long, d2 long, keys array<long>, sketch array<long>", arrow)


def shingle_sets(docs: DataFrame, words: int, wanted: np.ndarray) -> DataFrame:
    """doc_id, shingles: the full sets, as sorted 64-bit hashes, of the documents whose ids' bits are set in the bitmap."""
    arrow = pa.schema([("doc_id", pa.int64()), ("shingles", pa.list_(pa.int64()))])
    shipped = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        bitmap = shipped.value
        for batch in batches:
            rows = np.flatnonzero(in_bitmap(bitmap, batch.column(2).to_numpy()))
            for i in range(0, len(rows), SLICE_ROWS):
                take = pa.array(rows[i : i + SLICE_ROWS])
                sets = [signed(shingle_set(t, words)) for t in batch.column(1).take(take).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), pa.array(sets, pa.list_(pa.int64()))], schema=arrow)

    short_batches(docs.sparkSession)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    return named.select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInArrow(run, "doc_id long, shingles array<long>")


def _similar(percent: int, inter, n: str, m: str):
    return F.lit(100) * inter >= F.lit(percent) * (F.col(n) + F.col(m) - inter)


def _alike_size(percent: int, n: str, m: str):
    return (F.col(n) * 100 >= F.col(m) * percent) & (F.col(m) * 100 >= F.col(n) * percent)


def _confirmed(pairs: DataFrame, most: int | None, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (u, v, ...), most in number at most if given, whose full sets reach the threshold."""
    pairs = materialise(pairs, "pairs", most)
    if pairs.isEmpty():
        return pairs
    sets = [shingle_sets(docs, words, hash_bitmap(pairs.select(F.xxhash64(c).alias("h")))).select(F.col("doc_id").alias(c), F.col("shingles").alias(f"s{c}")) for c in "uv"]
    both = pairs.join(sets[0], "u").join(sets[1], "v")
    both = both.select(*pairs.columns, F.size("su").alias("nu"), F.size("sv").alias("nv"), F.size(F.array_intersect("su", "sv")).alias("c"))
    return materialise(both.where(_similar(percent, F.col("c"), "nu", "nv")).select(*pairs.columns), "links", pairs.count(), rows_a_task=250)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, rows: int = 6, miss: float = 1e-6) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text). Documents are linked where
    100 * intersection >= percent * union of their shingle sets."""
    bands = bands_for(percent / 100, rows, miss)
    n = docs.count()
    sig = materialise(signatures(docs, words, bands, rows), "signatures", n, rows_a_task=5_000)
    # 2. classes of equal sets
    named = sig.where("n > 0 and doc_id is not null")
    reps = materialise(named.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")), "classes", n, rows_a_task=20_000)
    # documents under each key that has several
    keyed = reps.select(F.col("rep").alias("id"), "n", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("key", "least")
    members = materialise(keyed.join(shared, "key").select("key", "id", "n", "least"), "members", n * bands, rows_a_task=200_000)
    most = members.count()

    # 3. with the least document of each key
    offered = members.where("id != least").select(F.col("id").alias("u"), F.col("least").alias("v")).distinct()
    for end in "uv":
        offered = offered.join(reps.select(F.col("rep").alias(end), F.col("n").alias(f"n_{end}"), F.col("sketch").alias(f"sketch_{end}")), end)
    comp = components(_confirmed(offered.where(_may_link(percent, "_u", "_v")).select("u", "v"), most, docs, words, percent))
    # 4. keys that still join several components
    open_keys = materialise(_open(members, reps, comp), "open", most)
    if not open_keys.isEmpty():
        links = _confirmed(_pairs(open_keys, percent), None, docs, words, percent)
        if not links.isEmpty():
            comp = merged(comp, materialise(links.select(F.col("cu").alias("u"), F.col("cv").alias("v")).distinct(), "links"))
    # classes -> their component, and every document -> that of its class
    of_class = reps.select("n", "d1", "d2", "rep").join(comp.withColumnRenamed("u", "rep"), "rep", "left").select("n", "d1", "d2", F.coalesce("m", "rep").alias("found"))
    linked = sig.select("doc_id", "n", "d1", "d2").join(of_class, ["n", "d1", "d2"], "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("found"))
    return linked.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _open(members: DataFrame, reps: DataFrame, comp: DataFrame) -> DataFrame:
    """The members of keys whose documents lie in more than one component: key, id, n, least, comp, sketch and main, the
    component that most of the key's documents are in."""
    m = members.join(comp.select(F.col("u").alias("id"), "m"), "id", "left").select("key", "id", "n", "least", F.coalesce("m", "id").alias("comp"))
    counted = m.groupBy("key", "comp").agg(F.count("*").alias("k"))
    several = counted.groupBy("key").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.count("*").alias("comps")).where("comps > 1").select("key", "main")
    return m.join(several, "key").join(reps.select(F.col("rep").alias("id"), "sketch"), "id")


def _may_link(percent: int, a: str, b: str):
    """What the sizes and sketches of two documents leave possible: at most so many shingles that one of them lacks."""
    apart = sum(F.bit_count(F.col(f"sketch{a}")[i].bitwiseXOR(F.col(f"sketch{b}")[i])) for i in range(_SKETCH))
    return _alike_size(percent, f"n{a}", f"n{b}") & (apart * (100 + percent) <= (100 - percent) * (F.col(f"n{a}") + F.col(f"n{b}")))


def _pairs(open_keys: DataFrame, percent: int) -> DataFrame:
    """The documents outside their key's main component with those of other components under the same key."""
    sides = [open_keys.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("id", "n", "comp", "sketch")], *["main"] * (side == "a")) for side in "ab"]
    a, b = sides[0].where("comp_a != main"), sides[1]
    once = (F.col("comp_b") == F.col("main")) | (F.col("id_a") > F.col("id_b"))
    joined = a.join(b, (a["key"] == b["key"]) & (F.col("comp_a") != F.col("comp_b")) & once & _may_link(percent, "_a", "_b"))
    return joined.select(F.col("id_a").alias("u"), F.col("id_b").alias("v"), F.col("comp_a").alias("cu"), F.col("comp_b").alias("cv")).distinct()


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs without near duplicates: of each component the row with the least doc_id stays, once even where that row is
    repeated; rows without a doc_id stay."""
    found = near_duplicates(docs, words, percent)
    gone, text_hash = unused(docs, "_gone"), unused(docs, "_text_hash")
    out = found.where("not kept").select(F.col("doc_id").alias(gone)).distinct()
    named = docs.where("doc_id is not null")
    kept = named.join(out, named["doc_id"].cast("long") == F.col(gone), "left_anti")
    once = kept.withColumn(text_hash, F.xxhash64("text")).dropDuplicates(["doc_id", text_hash]).drop(text_hash)
    return once.unionByName(docs.where("doc_id is null"))
