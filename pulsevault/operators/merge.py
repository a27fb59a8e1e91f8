"""Merging of chunks, of archives with different shapes, and keep-last upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, LongType, NumericType, StringType

from ..functions.text import chunk_base, chunk_index, date_token
from .samples import by_component


def merge_chunks(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks (keys, chunk, length, times, vals) -> a row per key: arrays joined in order of chunk, lengths summed."""
    parts = F.array_sort(F.collect_list(F.struct("chunk", "times", "vals")))
    out = chunks.groupBy(*keys).agg(F.sum("length").alias("length"), parts.alias("_p"))
    return out.select(*keys, "length", F.flatten("_p.times").alias("times"), F.flatten("_p.vals").alias("vals"))


def check_headers(records: DataFrame, key: str | list[str], fields: list[str]) -> DataFrame:
    """The keys whose records disagree in a field or lack one: key, n_headers, missing."""
    out = records.groupBy(key).agg(F.count_distinct(F.struct(*fields)).alias("n_headers"), F.sum(F.when(reduce(lambda a, b: a | b, [F.col(f).isNull() for f in fields]), 1).otherwise(0)).alias("missing"))
    return out.where((F.col("n_headers") > 1) | (F.col("missing") > 0))


def payload(by_comp: Column, matrix: Column, width: Column) -> Column:
    """Payload by component: as stored, else the row matrix transposed; null (an error to its reader) if neither is there."""
    return F.coalesce(by_comp, F.when(matrix.isNotNull(), by_component(matrix, width)))


def reconcile_names(records: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """pv (or keys, which include it), component_names: those of the records if all agree and are nval wide, else pv[0] and so
    on."""
    keys = keys or ["pv"]
    seen = records.groupBy(*keys).agg(F.count_distinct("component_names").alias("kinds"), F.count_if(F.col("component_names").isNull()).alias("none"), F.min("component_names").alias("names"), F.max("nval").alias("nval"))
    good = (F.col("kinds") == 1) & (F.col("none") == 0) & (F.size("names") == F.col("nval"))
    made = F.transform(F.sequence(F.lit(0), F.col("nval") - 1), lambda i: F.format_string("%s[%d]", F.col("pv"), i))
    return seen.select(*keys, F.when(good, F.col("names")).otherwise(made).alias("component_names"))


def is_vector(nval: Column, *vector_columns: Column) -> Column:
    return reduce(lambda a, b: a | b, [c.isNotNull() for c in vector_columns], nval > 1)


def _rank(t: DataType) -> int:
    if isinstance(t, ArrayType):
        return 0 if isinstance(t.elementType, NumericType) else 2 if isinstance(t.elementType, StringType) else 4
    return 1 if isinstance(t, NumericType) else 3 if isinstance(t, StringType) else 4


_TARGETS = [ArrayType(DoubleType()), DoubleType(), ArrayType(StringType()), StringType()]


def promoted_type(types: list[DataType], promote_ints: bool = False) -> DataType:
    """Target of a column over several shapes: list of doubles, double, list of text, text, else the first seen. Whole
    numbers stay whole unless promote_ints or a wider type is among them."""
    best = min(map(_rank, types))
    if best == 1 and not promote_ints and all(isinstance(t, NumericType) and not isinstance(t, DoubleType) for t in types if _rank(t) == 1) and all(_rank(t) == 1 for t in types):
        return LongType()
    return _TARGETS[best] if best < 4 else types[0]


def _to(c: Column, have: DataType, want: DataType) -> Column:
    if have == want:
        return c
    if isinstance(want, ArrayType):
        element = want.elementType
        if isinstance(have, ArrayType):
            return F.transform(c, lambda v: v.try_cast(element))
        one = c.try_cast(element)
        return F.when(one.isNotNull(), F.array(one))
    if isinstance(have, ArrayType):
        return F.lit(None).cast(want)
    return c.try_cast(want)


def union_promote(frames: list[DataFrame], promote_ints: bool = False) -> DataFrame:
    """Union by name of frames with different schemas (one frame per shape): every column takes its promoted type, scalars
    become one-element lists where a list is wanted, what can't be cast or is missing is null."""
    names = list(dict.fromkeys(c for f in frames for c in f.columns))
    target = {n: promoted_type([f.schema[n].dataType for f in frames if n in f.columns], promote_ints) for n in names}
    shaped = [f.select(*[(_to(F.col(n), f.schema[n].dataType, target[n]) if n in f.columns else F.lit(None).cast(target[n])).alias(n) for n in names]) for f in frames]
    return reduce(DataFrame.unionByName, shaped)


def last_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by order: an aggregate with map-side combine, so that a key with very many rows is no sort.
    Rows that tie in order are told apart by their other columns; maps can't be compared and are no columns of such rows."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *[F.col(c) for c in rest])).alias("_r")
    return rows.groupBy(*keys).agg(best).select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in rows.columns])


def dedupe_keep_last(rows: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The last row of each key by order."""
    return last_by(rows, [key] if isinstance(key, str) else list(key), order)


def upsert_day(existing: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Existing rows, replaced by new ones of the same key; of several new ones the last by order."""
    both = union_promote([existing.withColumn("_src", F.lit(0)), new.withColumn("_src", F.lit(1))])
    return last_by(both, [key], ["_src", *order]).drop("_src")


def changed_inputs(files: DataFrame, seen: DataFrame) -> DataFrame:
    """Files whose path, size or time isn't what was stored for them."""
    return files.join(seen.select("path", "size", "mtime"), ["path", "size", "mtime"], "left_anti")


def files_by_date(files: DataFrame) -> DataFrame:
    """date, paths (sorted): the files without chunk index by the first date in their name."""
    plain = files.where(chunk_index(F.col("path")).isNull()).withColumn("date", date_token(F.col("path"))).where("date is not null")
    return plain.groupBy("date").agg(F.array_sort(F.collect_list("path")).alias("paths"))


def files_by_final(files: DataFrame) -> DataFrame:
    """base, paths: chunk files by the file that they make up, in order of index."""
    c = files.withColumn("i", chunk_index(F.col("path"))).where("i is not null").withColumn("base", chunk_base(F.col("path")))
    return c.groupBy("base").agg(F.array_sort(F.collect_list(F.struct("i", "path"))).alias("p")).select("base", F.col("p.path").alias("paths"))


def skip_existing(groups: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    return groups.join(outputs.select(key), key, "left_anti")
