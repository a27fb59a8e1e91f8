"""Benchmark decontamination by winnowing.

Words are hashed; of the k-word grams in every run of `window - k + 1` consecutive grams the one with the least hash is a
fingerprint, so any shared span of `window` words (13) shares at least one. Items of fewer than `window` words are one short
window; for each such length the grams of that length are looked up whole, which is exact too. Where a fingerprint of a
document is one of an item, the hit is extended to the windows around it and these are compared word by word (as 64-bit word
hashes), so what counts is an occurrence of a whole window.

Two routes with equal results. If the benchmark's words number at most `broadcast_words`, its index (about 100 bytes a word,
so 0.5 GB) travels to the tasks and a document is done in one pass without a shuffle. Beyond that a bitmap of the items'
fingerprints, of 32 MB at most, travels; the windows around a document's fingerprints that it lets through are hashed to 128
bits where the text lies, and these hashes, not texts, are joined with those of the items' windows. The hit intervals are
merged per document.

Rows: null text has no words; an item without words has no window; equal items count each by their item_id; a null item_id is
ignored in the list of items but its windows hit; null or repeated doc_ids give a result row for each row in the one-pass
route; in the join route rows with a null doc_id are matched too (rows carry their own key). An empty benchmark leaves all
clean. Other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from .common import WORDS_ONLY, gram_hashes, hash_bitmap, in_bitmap, map_rows, materialise, mixed, short_batches, unused, word_hashes

RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def item_words(text: str | None) -> np.ndarray:
    """Hashes of the words: lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return word_hashes((text or "").encode("utf-8", "replace").translate(WORDS_ONLY))


def winnow(grams: np.ndarray, run: int) -> np.ndarray:
    """Positions of the least gram (the last of equal ones) of every `run` consecutive grams; of fewer, of all."""
    n = len(grams)
    if n == 0:
        return np.empty(0, np.int64)
    run = min(run, n)
    m = n - run + 1
    best, at = grams[:m].copy(), np.arange(m)
    for i in range(1, run):
        g = grams[i : i + m]
        less = g <= best
        best[less] = g[less]
        at[less] = np.flatnonzero(less) + i
    return np.unique(at)


class Index:
    """Windows and fingerprints of benchmark items, held as sorted arrays."""

    def __init__(self, items: list[tuple], window: int = 13, k: int = 5):
        self.window, self.k, self.ids = window, k, [i for i, _ in items]
        words = [item_words(t) for _, t in items]
        self.short = sorted({len(w) for w in words if 0 < len(w) < window})
        prints = [np.empty(0, np.uint64)]
        for w in words:
            if len(w) >= window:
                g = gram_hashes(w, k)
                prints.append(g[winnow(g, window - k + 1)])
        self.prints = np.unique(np.concatenate(prints))
        # window hash -> items, by length
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in [*self.short, window]:
            h, who, at = [], [], []
            for i, w in enumerate(words):
                if len(w) == length or length == window and len(w) > window:
                    g = gram_hashes(w, length)
                    h.append(g)
                    who.append(np.full(len(g), i))
                    at.append(np.arange(len(g)))
            if h:
                h, who, at = np.concatenate(h), np.concatenate(who), np.concatenate(at)
                order = np.argsort(h, kind="stable")
                self.windows[length] = h[order], who[order], at[order]
        self.words = words

    def _occurrences(self, w: np.ndarray, starts: np.ndarray, length: int, hit: np.ndarray, found: set) -> None:
        """Marks the windows of `length` words that start at `starts` and are an item's, word by word."""
        if length not in self.windows or not len(starts):
            return
        keys, who, at = self.windows[length]
        g = gram_hashes(w, length)[starts]
        lo, hi = np.searchsorted(keys, g, "left"), np.searchsorted(keys, g, "right")
        for s, a, b in zip(starts[hi > lo], lo[hi > lo], hi[hi > lo], strict=True):
            for j in range(a, b):
                i = who[j]
                if np.array_equal(self.words[i][at[j] : at[j] + length], w[s : s + length]):
                    hit[s : s + length] = True
                    found.add(int(i))

    def match(self, w: np.ndarray) -> tuple[np.ndarray, set]:
        """Which words of a document are hit, and by which items (their places)."""
        hit, found = np.zeros(len(w), bool), set()
        n = len(w)
        if n >= self.window and len(self.prints):
            g = gram_hashes(w, self.k)
            at = winnow(g, self.window - self.k + 1)
            at = at[np.isin(g[at], self.prints)]
            if len(at):
                # a window that holds the gram starts up to window - k words before it
                starts = np.unique(np.add.outer(at, -np.arange(self.window - self.k + 1)))
                self._occurrences(w, starts[(starts >= 0) & (starts <= n - self.window)], self.window, hit, found)
        for length in self.short:
            if n >= length:
                self._occurrences(w, np.arange(n - length + 1), length, hit, found)
        return hit, found


def items_digest(ids) -> str:
    return hashlib.sha256(",".join(sorted(str(i) for i in ids if i is not None)).encode()).hexdigest()


def _shared_index(shipped, window: int, k: int) -> Index:
    """The index of a broadcast {"items": ...}. It is kept there, so that the tasks of a worker process build it once."""
    held = shipped.value
    if "index" not in held:
        held["index"] = Index(held["items"], window, k)
    return held["index"]


def _verdict(n_words, n_hit):
    return bool(n_hit > 0 and 20 * n_hit >= n_words)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, k: int = 5, broadcast_words: int = 5_000_000) -> DataFrame:
    """RESULT for every row of docs (doc_id, text) against benchmark (item_id, text)."""
    bench = benchmark.select("item_id", "text")
    size = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    if size <= 2 * broadcast_words:  # a word and what parts it from the next have two characters or more
        return _one_pass(docs, [tuple(r) for r in bench.collect()], window, k)
    return _by_join(docs, bench, window, k)


def _one_pass(docs: DataFrame, items: list[tuple], window: int, k: int) -> DataFrame:
    arrow = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])
    shipped = docs.sparkSession.sparkContext.broadcast({"items": items})

    def make():
        index = _shared_index(shipped, window, k)
        none = items_digest([])

        def work(batch: pa.RecordBatch) -> dict:
            out = {f.name: [] for f in arrow}
            out["doc_id"] = batch.column(0)
            for text in batch.column(1).to_pylist():
                w = item_words(text)
                hit, found = index.match(w)
                n = int(hit.sum())
                for key, v in (("n_words", len(w)), ("n_hit", n), ("n_items", len(found)), ("items_sha256", items_digest(index.ids[i] for i in found) if found else none), ("contaminated", _verdict(len(w), n))):
                    out[key].append(v)
            return out

        return work

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), make, RESULT, arrow)


def _other(w: np.ndarray) -> np.ndarray:
    """A second hash of each word, for the other half of 128 bits."""
    return mixed(w ^ np.uint64(0x5851F42D4C957F2D))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _item_windows(bench: DataFrame, window: int, k: int) -> DataFrame:
    """item (a number of its own), item_id, length, prints, h1, h2: the fingerprints and the windows' hashes of each item."""
    arrow = pa.schema([("item", pa.int64()), ("item_id", pa.string()), ("length", pa.int32()), ("prints", pa.list_(pa.int64())), ("h1", pa.list_(pa.int64())), ("h2", pa.list_(pa.int64()))])

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out = {f.name: [] for f in arrow}
            out["item"], out["item_id"] = batch.column(0), batch.column(1)
            for text in batch.column(2).to_pylist():
                w = item_words(text)
                length = min(window, len(w))
                g = gram_hashes(w, length) if length else w
                if length == window:
                    p = gram_hashes(w, k)
                    p = np.unique(p[winnow(p, window - k + 1)])
                else:
                    p = g + np.uint64(length)
                for key, v in (("length", length), ("prints", _signed(p)), ("h1", _signed(g)), ("h2", _signed(gram_hashes(_other(w), length) if length else w))):
                    out[key].append(v)
            return out

        return work

    rows = bench.select(F.monotonically_increasing_id(), F.col("item_id").cast("string"), "text")
    return map_rows(rows, make, "item long, item_id string, length int, prints array<long>, h1 array<long>, h2 array<long>", arrow)


def _document_windows(docs: DataFrame, prints: np.ndarray, lengths: list[int], window: int, k: int) -> DataFrame:
    """row (a number of its own), doc_id, n_words, w: start, length, h1, h2 of the windows that may be an item's."""
    schema = "row long, doc_id long, n_words long, w array<struct<start: int, length: int, h1: long, h2: long>>"
    part = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])
    arrow = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("w", pa.list_(part))])
    shipped = docs.sparkSession.sparkContext.broadcast(prints)

    def make():
        bitmap = shipped.value

        def known(g: np.ndarray) -> np.ndarray:
            return np.flatnonzero(in_bitmap(bitmap, _signed(g)))

        def work(batch: pa.RecordBatch) -> dict:
            n_words, ends, cols = [], [0], [[], [], [], []]
            for text in batch.column(2).to_pylist():
                w = item_words(text)
                found = {}
                if len(w) >= window:
                    g = gram_hashes(w, k)
                    at = winnow(g, window - k + 1)
                    at = at[known(g[at])]
                    # a window that holds the gram starts up to window - k words before it
                    starts = np.unique(np.add.outer(at, -np.arange(window - k + 1)))
                    found[window] = starts[(starts >= 0) & (starts <= len(w) - window)]
                for length in lengths:
                    if len(w) >= length:
                        found[length] = known(gram_hashes(w, length) + np.uint64(length))
                for length, starts in found.items():
                    if len(starts):
                        cols[0].append(starts.astype(np.int32))
                        cols[1].append(np.full(len(starts), length, np.int32))
                        cols[2].append(_signed(gram_hashes(w, length)[starts]))
                        cols[3].append(_signed(gram_hashes(_other(w), length)[starts]))
                n_words.append(len(w))
                ends.append(ends[-1] + sum(map(len, found.values())))
            flat = [pa.array(np.concatenate(c) if c else [], f.type) for c, f in zip(cols, part, strict=True)]
            rows = pa.StructArray.from_arrays(flat, fields=list(part))
            return {"row": batch.column(0), "doc_id": batch.column(1), "n_words": n_words, "w": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)}

        return work

    return map_rows(docs.select(F.monotonically_increasing_id(), F.col("doc_id").cast("long"), "text"), make, schema, arrow)


def _by_join(docs: DataFrame, bench: DataFrame, window: int, k: int) -> DataFrame:
    items = materialise(_item_windows(bench, window, k), "items")
    lengths = sorted(r[0] for r in items.where(f"length > 0 and length < {int(window)}").select("length").distinct().collect())  # fewer than `window`
    prints = items.select(F.explode("prints").alias("p"))
    bitmap = hash_bitmap(prints)
    found = materialise(_document_windows(docs, bitmap, lengths, window, k), "doc-windows")
    theirs = items.select("item", "length", F.explode(F.arrays_zip("h1", "h2")).alias("h")).select("item", "length", "h.h1", "h.h2").distinct()
    ours = found.select("row", F.explode("w").alias("w")).select("row", "w.*")
    hits = materialise(ours.join(theirs, ["h1", "h2", "length"]).select("row", "item", "start", "length"), "hits")

    spans = hits.select("row", F.col("start").alias("a"), (F.col("start") + F.col("length")).alias("b")).distinct()
    before = Window.partitionBy("row").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    fresh = spans.withColumn("done", F.coalesce(F.max("b").over(before), F.lit(0)))
    n_hit = fresh.groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("b") - F.greatest("a", "done"))).cast("long").alias("n_hit"))
    named = hits.select("row", "item").distinct().join(items.select("item", "item_id"), "item")
    listed = named.groupBy("row").agg(F.count("item").alias("n_items"), F.array_sort(F.collect_list("item_id")).alias("ids"))
    out = found.select("row", "doc_id", "n_words").join(n_hit, "row", "left").join(listed, "row", "left").na.fill({"n_hit": 0, "n_items": 0})
    return out.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 13, k: int = 5, broadcast_words: int = 5_000_000) -> DataFrame:
    """The rows of docs that are not contaminated, in docs' columns. With a small benchmark texts are judged where they lie
    and nothing is shuffled; beyond that contaminated ids are joined away (rows without an id are then judged alone)."""
    bench = benchmark.select("item_id", "text")
    size = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    if size <= 2 * broadcast_words:
        shipped = docs.sparkSession.sparkContext.broadcast({"items": [tuple(r) for r in bench.collect()]})

        short_batches(docs.sparkSession)

        @F.pandas_udf(BooleanType())
        def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            index = _shared_index(shipped, window, k)

            def ok(text: str | None) -> bool:
                w = item_words(text)
                return not _verdict(len(w), int(index.match(w)[0].sum()))

            for part in texts:
                yield pd.Series([ok(t) for t in part], dtype=bool)

        return docs.where(clean("text"))
    row = unused(docs, "_row")
    keyed = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")
    found = _by_join(keyed.select(F.col(row).alias("doc_id"), "text"), bench, window, k)
    gone = found.where("contaminated").select(F.col("doc_id").alias(row))
    return keyed.join(gone, row, "left_anti").select(*docs.columns)
