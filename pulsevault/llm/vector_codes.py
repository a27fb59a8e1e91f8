"""Vector code compression: product quantisation whose Lloyd rounds walk two trees at once.

Vectors become integers (floor(256 * x)) and are cut into equal parts; every part position has a codebook. Within a task, blocks of
vectors get a tree over the parts of each position (median splits; a node has its box, its number of vectors and their sum), and the
codebook gets a tree over its entries. Pairs of nodes are walked from both roots: an entry node goes when its least distance from
the box of parts is above another's largest; an entry also goes when another is nearer in every corner of the box. Where one entry is
left the whole node is assigned by its cached sum; leaves where several are left compare integers. All bounds are integers, so ties
go to the lower index exactly.

A round sends a task's sums by entry (parts x entries rows) through one aggregate; codebooks, at most parts x entries x width
integers, are all that the driver holds. Vectors are never shuffled.

Rows: vectors that are null, or hold null or non-finite components, are dropped. So are vectors whose length isn't the table's
most frequent one that the parts divide (the larger of equally frequent ones), as they have no equal parts. Scaled components beyond 2^27
count as 2^27, so that sums of squares fit. A null vec_id is never among the first ids but gets a code; repeated rows count each, and
those of one id start the codebook in the order of their components. Fewer vectors than entries give a smaller codebook; an empty table gives an empty
result. Other columns are ignored."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

PARTS, ENTRIES, ROUNDS = 16, 64, 2
_LIMIT = 1 << 27
_LEAF = 24  # parts in a leaf
_BLOCK = 16_384  # vectors that share a tree
_FAR = np.iinfo(np.int64).max


def box_distances(low: np.ndarray, high: np.ndarray, to_low: np.ndarray, to_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance between boxes (last axis: components)."""
    gap = np.maximum(np.maximum(to_low - high, low - to_high), 0)
    reach = np.maximum(high - to_low, to_high - low)
    return (gap * gap).sum(-1), (reach * reach).sum(-1)


class PartTree:
    """A tree of median splits over the parts of one position. Nodes of a level are runs of `order`."""

    def __init__(self, x: np.ndarray):
        self.x, n = x, len(x)
        self.order = np.arange(n)
        edges = np.array([0, n])
        self.levels = []
        while True:
            sizes = np.diff(edges)
            at = x[self.order]
            low, high = np.minimum.reduceat(at, edges[:-1]), np.maximum.reduceat(at, edges[:-1])
            self.levels.append((edges, low, high, np.add.reduceat(at, edges[:-1])))
            if sizes.max() <= _LEAF:
                return
            axis = (high - low).argmax(axis=1)  # every node is split along its widest component
            node = np.repeat(np.arange(len(sizes)), sizes)
            self.order = self.order[np.lexsort((at[np.arange(n), axis[node]], node))]
            middle = edges[:-1] + sizes // 2
            edges = np.unique(np.concatenate([edges, middle]))

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes of the next level that lie in the given ones, and for each the place of its parent in `nodes`."""
        edges, below = self.levels[level][0], self.levels[level + 1][0]
        first, last = np.searchsorted(below, edges[nodes]), np.searchsorted(below, edges[nodes + 1])
        parent = np.repeat(np.arange(len(nodes)), last - first)
        return np.arange(len(parent)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + first[parent], parent


class EntryTree:
    """A tree of median splits over the entries of one codebook: by level the nodes' members (nodes x entries) and boxes; the
    last level's nodes are single entries."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.levels = entries, []
        nodes = [np.arange(len(entries))]
        while True:
            member = np.zeros((len(nodes), len(entries)), bool)
            for i, g in enumerate(nodes):
                member[i, g] = True
            self.levels.append((member, *(np.stack([f(entries[g], 0) for g in nodes]) for f in (np.min, np.max))))
            if len(nodes) == len(entries):
                return
            halves = []
            for g in nodes:
                e = entries[g]
                g = g[np.argsort(e[:, (e.max(0) - e.min(0)).argmax()], kind="stable")]
                halves += [h for h in (g[: len(g) // 2], g[len(g) // 2 :]) if len(h)]
            nodes = halves


def _open_entries(low: np.ndarray, high: np.ndarray, tree: EntryTree, open_: np.ndarray) -> np.ndarray:
    """open_ (nodes, entries) without entries that are nearest to no point of the nodes' boxes."""
    # pairs of nodes, from the entries' root down: a node of entries goes when it is farther than another ever is
    for member, node_low, node_high in tree.levels[1:]:
        alive = open_ @ member.T
        least, largest = box_distances(low[:, None], high[:, None], node_low[None], node_high[None])
        bound = np.where(alive, largest, _FAR).min(1)
        open_ = open_ & ((alive & (least <= bound[:, None])) @ member)
    least, largest = box_distances(low[:, None], high[:, None], tree.entries[None], tree.entries[None])
    # an entry that is behind the middle plane of the box's likely nearest one: the far corner decides
    best = np.where(open_, least + largest, _FAR).argmin(1)
    b = tree.entries[best][:, None]
    e = tree.entries[None]
    corner = np.where(e > b, high[:, None], low[:, None])  # of the box, the one where e is best against b
    behind = ((corner - e) ** 2).sum(-1) - ((corner - b) ** 2).sum(-1)
    lost = (behind > 0) | ((behind == 0) & (best[:, None] < np.arange(len(tree.entries))[None]))
    return open_ & ~lost


def walk(parts: PartTree, entries: EntryTree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest entry of every part, ties to the lower index; number and sum of the parts by entry)."""
    n, k = len(parts.x), len(entries.entries)
    found = np.zeros(n, np.int64)
    counts, sums = np.zeros(k, np.int64), np.zeros((k, parts.x.shape[1]), np.int64)
    nodes, open_ = np.zeros(1, np.int64), np.ones((1, k), bool)
    for level, (edges, low, high, total) in enumerate(parts.levels):
        open_ = _open_entries(low[nodes], high[nodes], entries, open_)
        sure = open_.sum(1) == 1
        if sure.any():  # whole nodes by their cached sums
            whole, best = nodes[sure], open_[sure].argmax(1)
            sizes = edges[whole + 1] - edges[whole]
            np.add.at(counts, best, sizes)
            np.add.at(sums, best, total[whole])
            rows = np.repeat(edges[whole] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            found[parts.order[rows]] = np.repeat(best, sizes)
        nodes, open_ = nodes[~sure], open_[~sure]
        if not len(nodes):
            break
        if level + 1 < len(parts.levels):
            nodes, parent = parts.children(level, nodes)
            open_ = open_[parent]
            continue
        sizes = edges[nodes + 1] - edges[nodes]  # uncertain leaves
        rows = parts.order[np.repeat(edges[nodes] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
        owner = np.repeat(np.arange(len(nodes)), sizes)
        for at in range(0, len(rows), 4096):
            own = rows[at : at + 4096]
            d = ((parts.x[own][:, None] - entries.entries[None]) ** 2).sum(-1)
            best = np.where(open_[owner[at : at + 4096]], d, _FAR).argmin(1)
            found[own] = best
            np.add.at(counts, best, 1)
            np.add.at(sums, best, parts.x[own])
    return found, counts, sums


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | None = "label", parts: int = PARTS) -> DataFrame:
    """vec_id, label, v (floats or doubles): the rows that can be coded."""
    fine = F.forall("v", lambda x: F.coalesce(F.abs(x) <= 1.7976931348623157e308, F.lit(False)))
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"  # 256 times a float is a float
    kept = F.col(vector) if single else F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), (F.col(label) if label else F.lit(None).cast("int")).alias("label"), kept.alias("v"))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0) & fine)
    width = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.col("count").desc(), F.col("width").desc()).first()  # a row a length
    return rows.where(F.size("v") == (width[0] if width else 0))


def _scaled(flat: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(flat * 256.0), -_LIMIT, _LIMIT).astype(np.int64)


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    """(vectors, parts, width) integers of a list column without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return _scaled(flat).reshape(len(column), parts, -1)


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """(parts, entries, width): the parts of the vectors with the least ids; `entries` rows come to the driver."""
    got = rows.where("vec_id is not null").orderBy("vec_id", "v").limit(entries).select("v").collect()
    return np.stack([_scaled(np.array(r.v)).reshape(parts, -1) for r in got], axis=1) if got else np.zeros((parts, 0, 0), np.int64)


def _blocks(batches):
    """Batches of `_BLOCK` rows at most, from batches of any size."""
    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, _BLOCK):
            piece = batch.slice(at, _BLOCK)
            if n + piece.num_rows > _BLOCK:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
            if piece.num_rows:
                held.append(piece)
                n += piece.num_rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def lloyd_round(rows: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Codebooks after one round: every entry is the floor of the mean of its parts; unused ones stay."""
    parts, entries, width = codebooks.shape

    def run(batches):
        trees = [EntryTree(c) for c in codebooks]
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in _blocks(batches):
            x = _matrix(batch.column(0), parts)
            for p in range(parts):
                _, n, s = walk(PartTree(np.ascontiguousarray(x[:, p])), trees[p])
                counts[p] += n
                sums[p] += s
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))], names=["p", "e", "n", "s"])

    found = rows.select("v").mapInArrow(run, "p int, e int, n long, s array<long>")
    totals = found.groupBy("p", "e").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(width)])
    out = codebooks.copy()
    for r in totals.collect():  # parts x entries rows
        out[r.p, r.e] = [s // r.n for s in r[3:]]
    return out


def assigned(rows: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hex digits a part), error (squared distances, summed)."""
    parts = len(codebooks)
    kind = rows.schema["label"].dataType.simpleString()

    def run(batches):
        trees = [EntryTree(c) for c in codebooks]
        for batch in _blocks(batches):
            x = _matrix(batch.column(2), parts)
            codes, error = np.empty((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p in range(parts):
                own = np.ascontiguousarray(x[:, p])
                best, _, _ = walk(PartTree(own), trees[p])
                codes[:, p] = best
                error += ((own - codebooks[p][best]) ** 2).sum(1)
            digits = codes.tobytes().hex()
            code = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "v").mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all entries' components, by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, width) of usable() rows, after `rounds` rounds over all of them. At most 256 entries."""
    codebooks = first_codebooks(rows, parts, entries)
    for _ in range(rounds if codebooks.size else 0):
        codebooks = lloyd_round(rows, codebooks)
    return codebooks


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | None = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error (errors summed over equal labels, nulls together), codebooks_sha256."""
    rows = usable(vectors, vec_id, vector, label, parts)
    codebooks = train(rows, parts, entries, rounds)
    coded = assigned(rows, codebooks) if codebooks.size else rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
    coded = materialise(coded, "codes")
    by = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(by, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
