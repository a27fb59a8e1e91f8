"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are computed once in an Arrow pass and stored as a narrow table. Trees are grown on a sample
of labelled rows of at most `max_rows` (a documented bound; the rows with the least hash of their id), which is the only
thing that comes to the driver: features are cut into at most 64 bins, a level of a tree is one pass of histogram sums, and
a finished tree is complete and flattened: arrays of features, thresholds and leaf values that numpy walks for a whole batch
at once, a step per level. The same arrays, a few tens of kB, travel to the tasks that score.

Rows: null and empty texts have all statistics zero and are scored like others; null or repeated doc_ids give a row each
(several label rows of an id: the largest label); without labelled rows of both kinds every score is the prior (0.5 without
any); an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, materialise

FEATURES = [
    "log_chars", "log_words", "mean_word", "sd_word", "long_words", "short_words", "upper", "digits", "punct", "symbols", "symbol_words", "bang", "pipe", "non_ascii",
    "distinct_words", "top_word", "equal_next", "distinct_bigrams", "distinct_trigrams", "lines", "mean_line", "sd_line", "distinct_lines", "line_end_stop", "stops_per_word",
    "upper_words", "title_words", "log_distinct", "mean_run", "max_run", "longest_word", "chars_per_distinct",
]
_CLASS = np.zeros(256, np.uint8)  # 1 upper, 2 lower, 3 digit, 4 symbol, 5 other punctuation, 6 blank, 7 non-ASCII lead, 8 continuation
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = 8 if 128 <= _b < 192 else 7 if _b >= 192 else 1 if _c.isupper() else 2 if _c.islower() else 3 if _c.isdigit() else 6 if _c.isspace() else 4 if _c in "#*$%&|<>" else 5


def statistics(text: str | None) -> np.ndarray:
    """FEATURES of a text."""
    out = np.zeros(len(FEATURES), np.float32)
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return out
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=9)
    chars, n = int(kinds[:8].sum()), len(words)
    size = np.fromiter(map(len, words), np.int64, n)
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    d = len(number)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    counts = np.bincount(ids)
    distinct = list(number)
    upper = np.fromiter((w.isupper() for w in distinct), bool, d)
    title = np.fromiter((w[:1].isupper() for w in distinct), bool, d)
    symbol = np.fromiter((w[-1:] in b"#*$%&|<>" for w in distinct), bool, d)
    bang = np.fromiter((w[-1:] == b"!" for w in distinct), bool, d)
    stop = np.fromiter((w[-1:] == b"." for w in distinct), bool, d)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    m = len(lines)
    line_size = np.fromiter(map(len, lines), np.int64, m)
    change = np.flatnonzero(np.diff(ids)) if n > 1 else np.empty(0, np.int64)
    runs = np.diff(np.concatenate([[-1], change, [n - 1]]))
    two = len(np.unique(ids[1:] * d + ids[:-1])) / (n - 1) if n > 1 else 1
    three = len(np.unique((ids[2:] * d + ids[1:-1]) * d + ids[:-2])) / (n - 2) if n > 2 and d < 2_000_000 else 1
    of = lambda mark: float(counts[mark].sum()) / n
    out[:] = (
        np.log1p(chars), np.log1p(n), size.mean(), size.std(), (size > 14).mean(), (size < 3).mean(), kinds[1] / chars, kinds[3] / chars, kinds[5] / chars, kinds[4] / chars, of(symbol), of(bang),
        raw.count(b"|") / n, kinds[7] / chars, d / n, counts.max() / n, 1 - len(change) / max(1, n - 1) if n > 1 else 0, two, three, m / n, np.log1p(line_size.mean()), np.log1p(line_size.std()),
        len(set(lines)) / m, sum(x.rstrip().endswith(b".") for x in lines) / m, of(stop), of(upper), of(title), np.log1p(d), runs.mean(), np.log1p(runs.max()), np.log1p(size.max()), chars / d,
    )
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and x, the FEATURES as array<float>."""
    arrow = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float32()))])

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column(0), "x": [statistics(t) for t in batch.column(1).to_pylist()]}

        return work

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, x array<float>", arrow)


class Trees:
    """A fitted ensemble of complete trees of one depth, as flat arrays."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray):
        self.base, self.feature, self.threshold, self.leaf = base, feature, threshold, leaf

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Rows of FEATURES -> probability of label 1. Every tree takes one vectorised step per level."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1] if self.feature.ndim == 2 else 0
        depth = (inner + 1).bit_length() - 1
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            total += leaf[at - inner]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64, l2: float = 1.0, least: int = 8) -> Trees:
    """Logistic loss, second-order leaf values, histogram splits."""
    n, p = x.shape
    inner = 2**depth - 1
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
    base = float(np.log(mean / (1 - mean)))
    if not n or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, inner + 1)))
    edges = []
    for j in range(p):
        q = np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32))
        edges.append(q[q < x[:, j].max()])
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)  # bin b: x <= edges[b]
    flat = binned + np.arange(p) * bins
    score, out_f, out_t, out_v = np.full(n, base), [], [], []
    for _ in range(trees):
        prob = 1 / (1 + np.exp(-score))
        g, h = y - prob, prob * (1 - prob)
        at = np.zeros(n, np.int64)
        f, t = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        for level in range(depth):
            nodes = 2**level
            slot = (at[:, None] * (p * bins) + flat).ravel()
            sums = [np.bincount(slot, np.repeat(v, p), nodes * p * bins).reshape(nodes, p, bins) for v in (g, h, np.ones(n))]
            left = [s.cumsum(axis=2) for s in sums]
            whole = [s[:, :, -1:] for s in left]
            gain = left[0] ** 2 / (left[1] + l2) + (whole[0] - left[0]) ** 2 / (whole[1] - left[1] + l2) - whole[0] ** 2 / (whole[1] + l2)
            gain[(left[2] < least) | (whole[2] - left[2] < least)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            go = np.zeros(n, bool)
            for k in range(nodes):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-9 and b < len(edges[j]):
                    f[nodes - 1 + k], t[nodes - 1 + k] = j, edges[j][b]
                    mine = at == k
                    go[mine] = binned[mine, j] > b
            at = 2 * at + go
        leaf = rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + l2)
        score = score + leaf[at]
        out_f.append(f)
        out_t.append(t)
        out_v.append(leaf)
    return Trees(base, np.array(out_f), np.array(out_t), np.array(out_v))


def held_out(column: str = "doc_id"):
    """Rows that are kept from learning: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string")), F.lit(5)) == 0, F.lit(False))


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def train(stats: DataFrame, labels: DataFrame, max_rows: int = 20_000, **options) -> Trees:
    """Fits on the rows of stats (doc_id, x) that labels (doc_id, quality) marks and that are not held out, at most max_rows
    of them, chosen by the hash of their id; of a repeated id the row with the least statistics counts."""
    marked = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("y"))
    marked = marked.where(~held_out())
    sample = F.broadcast(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))  # at most max_rows pairs of numbers
    found = stats.join(sample, "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"), F.first("y").alias("y"))
    rows = found.toArrow().sort_by("doc_id")
    x = np.array(rows["x"].to_pylist(), np.float32).reshape(-1, len(FEATURES))
    return fit(x, rows["y"].to_numpy().astype(float), **options)


def score(stats: DataFrame, model: Trees, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    shipped = stats.sparkSession.sparkContext.broadcast((model.base, model.feature, model.threshold, model.leaf))

    def run(batches):
        trees = Trees(*shipped.value)
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(trees.probability(x))], names=["doc_id", "score"])

    scored = stats.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, threshold: float = 0.3) -> DataFrame:
    stats = materialise(document_statistics(docs), "statistics")
    return score(stats, train(stats, labels, max_rows), threshold)
