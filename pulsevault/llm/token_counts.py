"""Separator scan: token counts of the documents in flat token files that have no index.

A flat file is the ids of its documents, two bytes each, every document closed by the end-of-document id. A file is cut into
blocks; in each block numpy finds the separators at once, and what is left at the block's edges is stitched with a prefix
scan over the blocks of a file: the separators before a block number its documents, and the last separator before it is
where its first document began.

Files are written by Spark, a bounded number of documents each, so a file is one row of the reader. The counts find their
documents again by place: the scan that is written from gives each row its task and number, and the writer names files by
task and number of records.

Rows: a null or empty text is a document of no tokens; the separator's string in a text is ordinary text and separates
nothing; an id beyond 16 bits or equal to the end id raises an error; null or repeated doc_ids give a row each; an empty table
or folder gives an empty result; other columns are ignored. Ids after the last separator of a file are a document that isn't
closed and have `closed` false."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_rows, new_path
from .tokens import FlatEncoder, tokenizer_path

END = 50256


def write_flat(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END, docs_per_file: int = 5_000) -> None:
    """Flat token files of docs.text under path; every id must fit 16 bits and none be end_id. Spark's text writer passes the
    bytes of a string as they are, valid UTF-8 or not (a test holds it to that)."""
    vocabulary = tokenizer or tokenizer_path()
    end = int(end_id).to_bytes(2, "little")

    def make():
        encode = FlatEncoder(vocabulary, special=False).encode

        def flat(text: str | None) -> bytes:
            ids = np.frombuffer(encode(text or ""), "<u4")
            if len(ids) and (ids.max() >= 1 << 16 or (ids == end_id).any()):
                raise ValueError(f"ids beyond 16 bits or equal to {end_id}")
            return ids.astype("<u2").tobytes()

        def work(batch: pa.RecordBatch) -> dict:
            return {"ids": [flat(t) for t in batch.column(0).to_pylist()]}

        return work

    ids = map_rows(docs.select("text"), make, "ids binary", pa.schema([("ids", pa.binary())]))
    # the text writer passes bytes as they are and puts the separator after each row
    writer = ids.select(F.col("ids").cast("string").alias("value")).write.option("maxRecordsPerFile", docs_per_file)
    writer.option("encoding", "ISO-8859-1").option("lineSep", end.decode("latin-1")).text(path)


def scan_blocks(spark: SparkSession, path: str, end_id: int = END, block_tokens: int = 1 << 20) -> DataFrame:
    """A row per block: file, block, first (token offset), size, seps (offsets of separators in the block)."""
    arrow = pa.schema([("file", pa.string()), ("block", pa.int64()), ("first", pa.int64()), ("size", pa.int64()), ("seps", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.frombuffer(data.as_buffer(), "<u2", len(data.as_buffer()) // 2)
                for block, at in enumerate(range(0, len(ids), block_tokens)):
                    part = ids[at : at + block_tokens]
                    seps = np.flatnonzero(part == end_id).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block], pa.int64()), pa.array([at], pa.int64()), pa.array([len(part)], pa.int64()), pa.array([seps], pa.list_(pa.int32()))], schema=arrow)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, block long, first long, size long, seps array<int>")


def document_tokens(blocks: DataFrame) -> DataFrame:
    """file, doc_no, start, n_tokens, closed: the documents of each file in order."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("seps") > 0, F.col("first") + F.element_at("seps", -1))
    stitched = blocks.select(
        "*",
        F.coalesce(F.sum(F.size("seps")).over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.max(last).over(before), F.lit(-1)).alias("last_before"),
        F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull().alias("is_last"),
    )
    # edges: the separator before, those of the block, and at a file's end one past it if something is left over
    marks = F.transform("seps", lambda s: F.col("first") + s)
    end = F.col("first") + F.col("size")
    edge = F.coalesce(F.element_at(marks, F.when(F.size("seps") > 0, -1)), F.col("last_before"))
    open_end = F.when(F.col("is_last") & (edge + 1 < end), F.array(end)).otherwise(F.array().cast("array<bigint>"))
    rows = stitched.select("file", "docs_before", "last_before", F.size("seps").alias("closed_here"), F.concat(marks, open_end).alias("ends"))

    def document(stop, i):
        start = F.when(i == 0, F.col("last_before")).otherwise(F.element_at("ends", F.greatest(i, F.lit(1)))) + 1
        return F.struct((F.col("docs_before") + i).alias("doc_no"), start.alias("start"), (stop - start).alias("n_tokens"), (i < F.col("closed_here")).alias("closed"))

    return rows.select("file", F.explode(F.transform("ends", document)).alias("d")).select("file", "d.*")


def token_counts(docs: DataFrame, tokenizer: str | None = None, end_id: int = END, block_tokens: int = 1 << 20, docs_per_file: int = 5_000) -> DataFrame:
    """Writes docs as flat files in the shared folder, scans them, and counts: doc_id, file, doc_no, start, n_tokens, closed.
    docs is scanned twice, the second time without texts, and must give the same rows in the same tasks, as scans of files do;
    store it first if it is the result of a shuffle."""
    spark = docs.sparkSession
    path = new_path(spark, "tokens")
    write_flat(docs, path, tokenizer, end_id, docs_per_file)
    counts = document_tokens(scan_blocks(spark, path, end_id, block_tokens))
    name = F.element_at(F.split("file", "/"), -1)
    task, part = (F.regexp_extract(name, p, 1).cast("long") for p in (r"^part-(\d+)-", r"-c(\d+)\."))
    row = F.shiftleft(task, 33) + part * docs_per_file + F.col("doc_no")
    placed = counts.select(row.alias("row"), F.concat_ws("-", F.lit("part"), task, part).alias("file"), "doc_no", "start", "n_tokens", "closed")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"))  # task << 33 | row
    return named.join(placed, "row").select("doc_id", "file", "doc_no", "start", "n_tokens", "closed")
