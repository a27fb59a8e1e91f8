"""From parsed lines to typed samples: value types, widths, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import line_numbers, line_offset, line_tokens
from ..functions.time import T0


def parse_lines(lines: DataFrame, compat_tokens: bool = False) -> DataFrame:
    """Lines (pv, seq, line, ...) -> offset_ms, nums, toks; rows whose offset is malformed are dropped."""
    out = lines.withColumns({"offset_ms": line_offset(F.col("line")), "nums": line_numbers(F.col("line")), "toks": line_tokens(F.col("line"), compat_tokens)})
    return out.where("offset_ms is not null").drop("line")


def _is_numeric(nval: Column) -> Column:
    good = F.size(F.filter("nums", lambda x: x.isNotNull()))
    return good >= F.greatest(F.coalesce(nval, F.lit(1)), F.lit(1))


def infer_value_type(parsed: DataFrame) -> DataFrame:
    """pv, value_type: numeric if every row of the PV has as many numbers as the header's nval asks for, else text. One
    misfit demotes the whole PV."""
    numeric = F.bool_and(_is_numeric(F.col("nval")) & (F.size("nums") == F.size("toks")))
    return parsed.groupBy("pv").agg(F.when(numeric, "numeric").otherwise("text").alias("value_type"))


def signal_shapes(parsed: DataFrame) -> DataFrame:
    """pv, value_type as infer_value_type() has it, and nval: the header's if positive, else the widest row of that type, at
    least 1. One aggregate."""
    numeric = F.bool_and(_is_numeric(F.col("nval")) & (F.size("nums") == F.size("toks")))
    seen = parsed.groupBy("pv").agg(numeric.alias("numeric"), F.max("nval").alias("h"), F.max(F.size("nums")).alias("wn"), F.max(F.size("toks")).alias("wt"))
    width = F.greatest(F.lit(1), F.when(F.col("numeric"), F.col("wn")).otherwise(F.col("wt")))
    return seen.select("pv", F.when(F.col("numeric"), "numeric").otherwise("text").alias("value_type"), F.when(F.col("h") > 0, F.col("h")).otherwise(width).cast("int").alias("nval"))


def _typed(rows: DataFrame) -> DataFrame:
    numeric = F.col("value_type") == "numeric"
    return rows.withColumns({"vals": F.when(numeric, F.col("nums")), "txts": F.when(~numeric, F.col("toks"))}).drop("nums", "toks")


def demote_to_text(parsed: DataFrame) -> DataFrame:
    """Rows with value_type, vals (numbers of numeric PVs) and txts (tokens of text PVs, numbers as they were written)."""
    return _typed(parsed.join(infer_value_type(parsed), "pv"))


def shaped(parsed: DataFrame) -> DataFrame:
    """demote_to_text() and fit_width() in one: rows of parsed lines typed and as wide as their PV, by one aggregate and one
    join."""
    return _fitted(_typed(parsed.drop("nval").join(signal_shapes(parsed), "pv")))


def resolve_nval(samples: DataFrame) -> DataFrame:
    """pv, nval: the header's if positive, else the widest row, at least 1."""
    width = F.greatest(F.coalesce(F.size("vals"), F.lit(0)), F.coalesce(F.size("txts"), F.lit(0)))
    seen = samples.groupBy("pv").agg(F.max("nval").alias("h"), F.max(width).alias("w"))
    return seen.select("pv", F.when(F.col("h") > 0, F.col("h")).otherwise(F.greatest(F.lit(1), F.col("w"))).cast("int").alias("nval"))


def fit_numbers(vals: Column, nval: Column) -> Column:
    """Exactly nval numbers: short rows are filled with NaN, long ones cut."""
    return F.concat(F.slice(vals, 1, F.least(F.size(vals), nval)), F.array_repeat(F.lit(float("nan")), F.greatest(nval - F.size(vals), F.lit(0))))


def fit_tokens(txts: Column, nval: Column) -> Column:
    return F.concat(F.slice(txts, 1, F.least(F.size(txts), nval)), F.array_repeat(F.lit(""), F.greatest(nval - F.size(txts), F.lit(0))))


def _fitted(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"vals": fit_numbers(F.col("vals"), F.col("nval")), "txts": fit_tokens(F.col("txts"), F.col("nval"))})


def fit_width(samples: DataFrame) -> DataFrame:
    """Every row as wide as its PV's nval."""
    return _fitted(samples.drop("nval").join(resolve_nval(samples), "pv"))


def explode_components(samples: DataFrame) -> DataFrame:
    """A row per component: comp from 0, x, and the component's name pv[comp]."""
    out = samples.select(*[c for c in samples.columns if c != "vals"], F.posexplode("vals").alias("comp", "x"))
    return out.withColumn("component", F.format_string("%s[%d]", "pv", "comp"))


def by_component(matrix: Column, width: Column) -> Column:
    """Rows of components -> components of rows."""
    return F.transform(F.sequence(F.lit(0), width - 1), lambda j: F.transform(matrix, lambda row: row[j]))


def samples_from_events(events: DataFrame, pv: str = "user_id", nan_each: int = 11, more: tuple[Column, ...] = ()) -> DataFrame:
    """The driver's events table as scalar samples: pv, seq, t0, offset_ms, x, and `more`; every nan_each-th value is NaN."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    x = F.when(F.col("event_id") % nan_each == 0, F.lit(float("nan"))).otherwise(F.col("value")) if nan_each else F.col("value")
    return events.select(F.col(pv).cast("string").alias("pv"), F.col("event_id").alias("seq"), F.lit(T0).alias("t0"), (ms - T0).cast("double").alias("offset_ms"), x.alias("x"), *more)


def samples_from_embeddings(embeddings: DataFrame) -> DataFrame:
    """The driver's embeddings as vector samples, one a minute: pv, seq, t0, offset_ms, nval, vals."""
    vals = F.transform("embedding", lambda v: v.cast("double"))
    return embeddings.select(F.col("label").cast("string").alias("pv"), F.col("vec_id").alias("seq"), F.lit(T0).alias("t0"), (F.col("vec_id") * 60000).cast("double").alias("offset_ms"), F.size("embedding").alias("nval"), vals.alias("vals"))
