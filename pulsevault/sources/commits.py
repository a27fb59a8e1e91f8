"""Tables that change by commits.

Data are written to new folders first; a commit then adds one file to the table's log, which names the folders that hold each part
from now on and the inputs that went into them. That file appears as a whole or not at all, so a run that fails before it leaves the
table as it was, and its folders are never read; one that comes after it finds the same inputs done. Readers take the
folders of a part's last commit. There is one writer at a time."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.merge import changed_inputs, last_by, union_promote
from ..operators.records import SHAPES
from .readers import read_shape, scan_catalog

_LOG = "version long, kind string, part string, folder string, schema string"
_INPUTS = "path string, size long, mtime timestamp"


def _log(spark: SparkSession, root: str) -> DataFrame:
    """version, kind (replace, append or inputs), part, folder, schema (as JSON): a row for every part that a commit changed."""
    try:
        return spark.read.schema(_LOG).json(f"{root}/log")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], _LOG)
        raise


def commit(spark: SparkSession, root: str, rows: list[tuple[str, str, str, str]]) -> int:
    """Adds a commit with rows (kind, part, folder, schema) and returns its version."""
    version = (_log(spark, root).agg(F.max("version")).first()[0] or 0) + 1
    spark.createDataFrame([(version, *r) for r in rows], _LOG).coalesce(1).write.mode("append").json(f"{root}/log")
    return version


def _live(spark: SparkSession, root: str) -> list:
    """part, folder, schema of every part: of its last replacement and what was appended since. Parts are days of a calendar or
    the like; their list comes to the driver."""
    log = _log(spark, root).where("kind != 'inputs'")
    base = log.where("kind = 'replace'").groupBy("part").agg(F.max("version").alias("base"))
    live = log.join(base, "part", "left").where("base is null or version >= base")
    return live.select("part", "folder", "schema", "version").orderBy("part", "version").collect()


def folders(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The folders that hold each part now."""
    out: dict[str, list[str]] = {}
    for r in _live(spark, root):
        out.setdefault(r.part, []).append(r.folder)
    return out


def read_table(spark: SparkSession, root: str, parts: list[str] | None = None) -> DataFrame | None:
    """The rows of all parts, or of some, with the promoted type of every column; None if there are none. Every schema is one
    scan; schemas come from the log, so no file is opened for them."""
    by_schema: dict[str, list[str]] = {}
    for r in _live(spark, root):
        if (parts is None or r.part in parts) and r.folder not in by_schema.setdefault(r.schema, []):
            by_schema[r.schema].append(r.folder)
    frames = [spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*own) for schema, own in by_schema.items() if own]
    return union_promote(frames) if frames else None


def _staged(df: DataFrame, root: str, kind: str) -> str:
    folder = f"{root}/{kind}/{uuid.uuid4().hex}"
    df.write.option("compression", "snappy").parquet(folder)
    return folder


def append_promoted(df: DataFrame, root: str, part: str = "all") -> int:
    """Appends df to a part of the table. Nothing that is there is read or written again: readers promote types."""
    return commit(df.sparkSession, root, [("append", part, _staged(df, root, "data"), df.schema.json())])


def replace_part(df: DataFrame, root: str, part: str = "all") -> int:
    """df instead of a part of the table."""
    return commit(df.sparkSession, root, [("replace", part, _staged(df, root, "data"), df.schema.json())])


def done_inputs(spark: SparkSession, root: str) -> DataFrame:
    """path, size, mtime of the inputs of all commits, the last of each path."""
    named = [(r.version, r.folder) for r in _log(spark, root).where("kind = 'inputs'").select("version", "folder").collect()]
    if not named:
        return spark.createDataFrame([], _INPUTS)
    order = F.create_map(*[F.lit(x) for v, f in named for x in (f.rstrip("/").rpartition("/")[2], v)])
    rows = spark.read.schema(_INPUTS).parquet(*[f for _, f in named]).withColumn("_v", order[F.element_at(F.split("_metadata.file_path", "/"), -2)])
    return last_by(rows, ["path"], ["_v"]).drop("_v")


def _last_records(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """last_by() of rows with large columns: rows are sorted by their keys and not put into a struct each."""
    by = [*order, *[c for c in rows.columns if c not in keys and c not in order]]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in by]))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def merge_days(spark: SparkSession, source: str, root: str, key: str = "pv", shapes: tuple[str, ...] = SHAPES) -> list[str]:
    """Merges the records of all shapes under `source` (folders date=.../shape=...) into the day archive `root` and returns the
    days that changed. Only files whose size or time isn't that of their last merge count, only days that have such files are read
    and written; a record replaces the day's older one of the same key, of several new ones that of the last file by name stays.
    A part of the archive is a day's records of one shape. Which keys come more than once is told by the keys alone; a part that gets no
    record and loses none is neither read whole nor written. Days and the fingerprints of their inputs are committed together."""
    changed = changed_inputs(scan_catalog(spark, source, "*.parquet").select("path", "size", F.col("mtime").cast("timestamp").alias("mtime")), done_inputs(spark, root))
    named = lambda c: F.regexp_extract("path", f"/{c}=([^/]*)/", 1).alias(c)
    inputs = _staged(changed.select("*", named("date"), named("shape")), root, "inputs")
    changed = spark.read.parquet(inputs)
    came = [tuple(r) for r in changed.select("date", "shape").distinct().collect()]  # of a calendar times shapes
    days = sorted({day for day, _ in came})
    if not days:
        return []
    there = {part for part in folders(spark, root) if part.split("/")[0] in days}
    fresh = []
    for shape in shapes:
        found = read_shape(spark, source, shape)
        if found is not None:
            found = found.where(F.col("date").isin(days)).withColumns({"_new": F.lit(1), "_file": F.col("_metadata.file_path")})
            fresh.append(found.join(F.broadcast(changed.select(F.col("path").alias("_file"))), "_file", "left_semi"))
    touched = {f"{day}/{shape}" for day, shape in came} | {part for part in there if "/" not in part}
    heads = [f.select("date", key, F.lit(None).cast("string").alias("old")) for f in fresh]
    if there:
        heads.append(read_table(spark, root, sorted(there)).select("date", key, F.col("shape").alias("old")))
    kinds = sorted({part.split("/")[1] for part in there if "/" in part})
    seen = reduce(DataFrame.unionByName, heads).groupBy("date", key).agg(F.count("*").alias("n"), *[F.max(F.when(F.col("old") == k, 1)).alias(f"_{k}") for k in kinds])
    several = seen.where("n > 1").groupBy("date").agg(*[F.max(f"_{k}").alias(f"_{k}") for k in kinds] or [F.count("*").alias("n")]).collect()  # a row a day
    touched |= {f"{r.date}/{k}" for r in several for k in kinds if r[f"_{k}"]}
    old = read_table(spark, root, sorted(there & touched)) if there & touched else None
    merged = union_promote([*([] if old is None else [old.where(F.col("date").isin(days)).withColumns({"_new": F.lit(0), "_file": F.lit("")})]), *fresh])
    merged = (_last_records(merged, ["date", key], ["_new", "_file"]) if several else merged).drop("_new", "_file")
    data, none = f"{root}/data/{uuid.uuid4().hex}", f"{root}/data/{uuid.uuid4().hex}"
    merged.withColumns({"day": F.col("date"), "kind": F.col("shape")}).hint("rebalance", "day", "kind").write.option("compression", "snappy").partitionBy("day", "kind").parquet(data)
    written = spark.read.schema("day string, kind string").parquet(data).distinct()
    parts = {f"{r.day}/{r.kind}": f"{data}/day={r.day}/kind={r.kind}" for r in written.collect()}
    if gone := sorted((there & touched) - set(parts)):  # all of their records are replaced by such of another shape
        merged.limit(0).write.parquet(none)
        parts |= dict.fromkeys(gone, none)
    commit(spark, root, [*[("replace", part, folder, merged.schema.json()) for part, folder in sorted(parts.items())], ("inputs", "", inputs, "")])
    return days
