"""Sources: sample text, catalogs, archives, logs, summaries, manifests."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base_name
from ..operators.logs import file_kind
from ..operators.merge import union_promote
from ..operators.records import SHAPES
from .shared import stored


_RAW = "value string, src string, block long, seq long"


def raw_lines(text: DataFrame) -> DataFrame:
    """value, src, block of a text source or stream: the file and where its split begins."""
    return text.select("value", F.col("_metadata.file_path").alias("src"), F.col("_metadata.file_block_start").alias("block"))


def in_order(raw: DataFrame) -> DataFrame:
    """raw_lines() with seq, the order within the split."""
    return raw.withColumn("seq", F.monotonically_increasing_id())


def header_lines(raw: DataFrame) -> DataFrame:
    """A row per file with lines: src, pv, t0, nval (null where its header lacks them) and blocks, where its last split begins."""
    head = lambda key: F.max(F.when(F.col("value").startswith(f"# {key} "), F.trim(F.substring("value", len(key) + 3, 10**6))))
    rows = raw.where(F.trim("value") != "")
    return rows.groupBy("src").agg(head("PV name").alias("pv"), head("t0").try_cast("long").alias("t0"), head("Nval").try_cast("int").alias("nval"), F.max("block").alias("blocks"))


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Raw lines with the header fields that stand above them in their split; header lines and blank ones are left out. A scan
    gives the lines of a split one after the other, so what is kept is one header."""
    at, head = None, {}
    for batch in batches:
        value, src, block = batch.column(0), batch.column(1), batch.column(2)
        marks = pc.fill_null(pc.starts_with(value, "#"), False).to_numpy(zero_copy_only=False)
        blank = pc.fill_null(pc.equal(pc.utf8_trim(value, " "), ""), True).to_numpy(zero_copy_only=False)
        files = pc.dictionary_encode(src).indices.to_numpy(zero_copy_only=False)
        where = block.to_numpy(zero_copy_only=False)
        new = np.flatnonzero((files[1:] != files[:-1]) | (where[1:] != where[:-1])) + 1
        stops = np.unique(np.concatenate([[0], new, np.flatnonzero(marks), np.flatnonzero(marks) + 1, [batch.num_rows]]))
        keys, fields = ("PV name", "t0", "Nval"), ([], [], [])
        for a, b in itertools.pairwise(stops.tolist()):
            if (place := (src[a].as_py(), int(where[a]))) != at:
                at, head = place, {}
            if marks[a]:
                line = value[a].as_py()
                for k in keys:
                    if line.startswith(f"# {k} "):
                        head[k] = line[len(k) + 3 :].strip(" ")
            for out, k in zip(fields, keys, strict=True):
                out.append((head.get(k), b - a))
        keep = pa.array(~marks & ~blank)
        spread = [pa.array(np.repeat(np.array([v for v, _ in f], object), [n for _, n in f]), pa.string()) for f in fields]
        yield pa.RecordBatch.from_arrays([*batch.columns, *spread], names=["value", "src", "block", "seq", "pv", "t0", "nval"]).filter(keep)


def sample_lines(raw: DataFrame, files: DataFrame, first_t0: int | None, first_nval: int | None) -> DataFrame:
    """src, pv, t0, nval, block, seq, line of raw lines. A file's header stands at its top, and so above the lines of its first
    split; lines of later splits take it from files (as header_lines() gives them), of which only those with several splits are
    broadcast, one for every split's bytes of input at most. t0 and nval that a file lacks are the given ones; lines without a
    PV name or t0 are left out. No line is shuffled."""
    long = files.where("blocks > 0").select(F.col("src").alias("_src"), F.col("pv").alias("_pv"), F.col("t0").alias("_t0"), F.col("nval").alias("_nval"))
    rows = raw.mapInArrow(_carried, f"{_RAW}, pv string, t0 string, nval string").join(F.broadcast(long), F.col("src") == F.col("_src"), "left")
    t0, nval = F.coalesce(F.col("t0").try_cast("long"), "_t0", F.lit(first_t0).cast("long")), F.coalesce(F.col("nval").try_cast("int"), "_nval", F.lit(first_nval).cast("int"))
    lines = rows.select("src", F.coalesce("pv", "_pv").alias("pv"), t0.alias("t0"), nval.alias("nval"), "block", "seq", F.col("value").alias("line"))
    return lines.where("pv is not null and t0 is not null")


def first_headers(files: DataFrame) -> tuple[int | None, int | None]:
    """t0 and nval of the first file, by name, that has them."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("src")))
    r = files.agg(first("t0").alias("t0"), first("nval").alias("nval")).first()
    return r.t0, r.nval


def read_samples(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(lines, rejects) of decoded sample files. lines: src, pv, t0, nval, block, seq, line; the order of arrival in a file is
    that of (block, seq), however its file is split. A file's header is its `# key value` lines; t0 and Nval that it lacks are
    those of the first file in the set that has them. Files without PV name, or without t0 anywhere, go to rejects (src,
    reason)."""
    raw = in_order(raw_lines(spark.read.text(path)))
    files = stored(header_lines(raw), "headers")
    t0, nval = first_headers(files)
    missing = F.when(F.col("pv").isNull(), "no PV name").when(F.coalesce("t0", F.lit(t0).cast("long")).isNull(), "no t0")
    return sample_lines(raw, files, t0, nval), files.select("src", missing.alias("reason")).where("reason is not null")


def scan_catalog(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path, size, mtime of all files below root; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def read_shape(spark: SparkSession, path: str, shape: str) -> DataFrame | None:
    """The records of one shape below path (folders date=.../shape=...), with the schema of that shape's own files and the
    columns date and shape; None without such folders. A filter on date leaves out folders. Files that can't be read are left out."""
    reader = spark.read.option("ignoreCorruptFiles", "true").option("basePath", path)
    try:
        return reader.parquet(f"{path}/date=*/shape={shape}")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_archive(spark: SparkSession, path: str, shapes: tuple[str, ...] = SHAPES) -> DataFrame:
    """A Parquet archive whose folders are date=.../shape=...: a scan per shape, each with its own schema, put together with the
    promoted type of every column. Files that can't be read are left out."""
    found = [f for f in (read_shape(spark, path, s) for s in shapes) if f is not None]
    if not found:
        raise FileNotFoundError(path)
    return union_promote(found)


def unreadable_files(spark: SparkSession, path: str, shapes: tuple[str, ...] = SHAPES) -> DataFrame:
    """path, size of the files below path of which read_archive() gets no row: damaged, or empty."""
    found = [f for f in (read_shape(spark, path, s) for s in shapes) if f is not None]
    files = scan_catalog(spark, path, "*.{parquet,txt}").select("path", "size")
    for f in found:
        files = files.join(f.select(F.col("_metadata.file_path").alias("path")).distinct(), "path", "left_anti")
    return files


def read_job_logs(spark: SparkSession, root: str) -> DataFrame:
    """submission (the folder), file, kind, line_no, line."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{log,txt}").text(root)
    rows = raw.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))
    return rows.select(F.element_at(F.split("p", "/"), -2).alias("submission"), "file", file_kind(F.col("file")).alias("kind"), "line_no", "line")


SUMMARY_SCHEMA = "timestamp string, small_pb_count long, big_pb_count long, saved_files long, input_bytes long, job_count long, wall_seconds long, peak_gb double"


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """Summary JSON files: file, event_ts (the file's time if its own is bad) and numbers, 0 where missing."""
    raw = spark.read.schema(SUMMARY_SCHEMA).option("multiLine", "true").option("recursiveFileLookup", "true").json(path)
    numbers = [f.split()[0] for f in SUMMARY_SCHEMA.split(", ")[1:]]
    stamp = F.coalesce(F.col("timestamp").try_cast("timestamp"), F.col("_metadata.file_modification_time"))
    return raw.select(F.col("_metadata.file_name").alias("file"), stamp.alias("event_ts"), *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in numbers])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """path, base: one path per line, blank lines left out."""
    lines = spark.read.text(path).select(F.trim("value").alias("path")).where("path != ''")
    return lines.withColumn("base", base_name(F.col("path")))
