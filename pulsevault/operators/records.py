"""Archive records: a row per signal and bucket with its payload as arrays, its statistics and its timing, in four shapes.

Samples are long rows (pv, t0, bucket, seq, offset_ms, nval, value_type, vals, txts), as shaped() and bucketize() give them.
records_of() makes the records of one shape from samples; samples_of() takes records apart again, so that merging chunks is the same
job as making records, statistics included. A record is one row and holds at most `most` values: a longer bucket is several
chunks, which only merging with a larger bound joins.

Arrays come out of the aggregate that computes the statistics: a scalar shape costs one exchange, a vector shape one by component
and one that puts the components together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .merge import check_headers, payload, reconcile_names
from .samples import by_component
from .stats import TIME_STATS, VALUE_STATS, pack_vector, scalar_stats, vector_stats

SHAPES = ("numeric_scalar", "numeric_vector", "text_scalar", "text_vector")

#: The payload column of each shape, and the row-major form in which older archives may have it.
PAYLOAD = {"numeric_scalar": "values", "numeric_vector": "values_by_component", "text_scalar": "values_text", "text_vector": "values_text_by_component"}
MATRIX = {"numeric_vector": "values_matrix", "text_vector": "values_text_matrix"}

_HEAD = ["value_type", "pv", "date", "chunk", "t0", "Nval", "times", "length"]
_KEYS = ["pv", "bucket", "chunk"]

#: Values that a record holds at most: 512 MB of doubles.
MOST_VALUES = 1 << 26


def shape_of(value_type: Column, nval: Column) -> Column:
    return F.concat_ws("_", value_type, F.when(nval > 1, "vector").otherwise("scalar"))


def in_chunks(samples: DataFrame, most: int = MOST_VALUES, order: tuple[str, ...] = ("seq",), block: int = 1_000_000) -> DataFrame:
    """Adds chunk, from 1 within (pv, bucket), so that none holds more than `most` values. Where all samples together are no more, or all
    buckets are small enough, which one aggregate tells, that is all; else ranks come from counts by block of the first column of `order` and places within the block,
    so that a long bucket is many groups."""
    width = F.max(F.greatest(F.col("nval"), F.lit(1)))
    whole = samples.agg(F.count("*").alias("n"), width.alias("w")).first()
    if whole.n * (whole.w or 1) <= most:
        return samples.withColumn("chunk", F.lit(1))
    sizes = samples.groupBy("pv", "bucket").agg(F.count("*").alias("_n"), width.alias("_w")).where(F.col("_n") * F.col("_w") > most)
    if sizes.isEmpty():
        return samples.withColumn("chunk", F.lit(1))
    inside = samples.withColumn("_block", F.floor(F.col(order[0]) / block))
    before = Window.partitionBy("pv", "bucket").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = inside.groupBy("pv", "bucket", "_block").agg(F.count("*").alias("_n"))
    starts = starts.select("pv", "bucket", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rows = F.greatest(F.lit(1), F.floor(F.lit(most) / F.col("_w")))
    starts = starts.join(sizes.select("pv", "bucket", rows.alias("_rows")), ["pv", "bucket"], "left")
    place = F.row_number().over(Window.partitionBy("pv", "bucket", "_block").orderBy(*order))
    placed = inside.join(starts, ["pv", "bucket", "_block"]).withColumn("_rank", F.col("_before") + place - 1)
    chunk = F.when(F.col("_rows").isNull(), 1).otherwise(F.floor(F.col("_rank") / F.col("_rows")) + 1)
    return placed.select(*samples.columns, chunk.cast("int").alias("chunk"))


def _listed(order: tuple[str, ...], *columns: Column, where: Column | None = None) -> Column:
    """The columns of a group's rows, or of those that `where` picks, as structs in order."""
    row = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *columns)
    return F.sort_array(F.collect_list(row if where is None else F.when(where, row)))


def _seconds(ms: Column) -> Column:
    return F.transform(ms, lambda t: t / 1000.0)


def component_names(pv: Column, nval: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), nval - 1), lambda i: F.format_string("%s[%d]", pv, i))


def records_of(samples: DataFrame, shape: str, order: tuple[str, ...] = ("seq",), most: int = MOST_VALUES) -> DataFrame:
    """Records of one shape from the samples that have it; others are left out. `order` is the order of the arrays and of the
    statistics that depend on one: ("seq",) that of arrival, ("offset_ms", "seq") that of time."""
    rows = in_chunks(samples.where(shape_of(F.col("value_type"), F.col("nval")) == shape), most, order)
    own = [F.min("t0").alias("t0"), F.max("nval").cast("long").alias("Nval")]
    if shape == "numeric_scalar":
        listed = _listed(order, F.col("offset_ms"), F.col("x"))
        out = scalar_stats(rows.withColumn("x", F.get("vals", F.lit(0))), ["chunk"], order, [*own, listed.alias("_r")])
        out = out.withColumns({"times": _seconds(F.col("_r.offset_ms")), "values": F.col("_r.x")}).drop("nan_count")
        stats = [*VALUE_STATS, *TIME_STATS]
    elif shape == "numeric_vector":
        comps = rows.select("pv", "bucket", "chunk", "t0", "nval", "offset_ms", *[c for c in order if c != "offset_ms"], F.posexplode("vals").alias("comp", "x"))
        # only the first component carries the times
        more = [*own, _listed(order, F.col("x"))["x"].alias("_x"), _listed(order, F.col("offset_ms").alias("ms"), where=F.col("comp") == 0)["ms"].alias("_ms")]
        found = vector_stats(comps, ["chunk"], order, more)
        out = pack_vector(found, ["chunk"], ["_x"], [F.max("t0").alias("t0"), F.max("Nval").alias("Nval"), F.max(F.when(F.col("comp") == 0, F.col("_ms"))).alias("_ms")])
        out = out.withColumns({"times": _seconds(F.col("_ms")), "values_by_component": F.col("_x"), "component_names": component_names(F.col("pv"), F.col("Nval").cast("int"))})
        out = out.withColumnRenamed("nan_count", "nan_counts")
        stats = ["component_names", *VALUE_STATS, "nan_counts", *TIME_STATS]
    else:
        listed = _listed(order, F.col("offset_ms"), F.col("txts"))
        out = rows.groupBy(*_KEYS).agg(*own, F.count("*").alias("length"), listed.alias("_r")).withColumn("times", _seconds(F.col("_r.offset_ms")))
        if shape == "text_scalar":
            out = out.withColumn("values_text", F.transform("_r.txts", lambda t: F.coalesce(F.get(t, F.lit(0)), F.lit(""))))
            stats = []
        else:
            out = out.withColumns({"values_text_by_component": by_component(F.col("_r.txts"), F.col("Nval").cast("int")), "component_names": component_names(F.col("pv"), F.col("Nval").cast("int"))})
            stats = ["component_names"]
    out = out.withColumn("value_type", F.lit(shape.split("_")[0])).withColumnRenamed("bucket", "date")
    return out.select(*_HEAD, PAYLOAD[shape], *stats)


def records(samples: DataFrame, order: tuple[str, ...] = ("seq",), most: int = MOST_VALUES) -> dict[str, DataFrame]:
    """The records of every shape, each with the columns of its shape."""
    return {shape: records_of(samples, shape, order, most) for shape in SHAPES}


def samples_of(found: DataFrame, shape: str) -> DataFrame:
    """Records of one shape as samples again. seq counts on from chunk to chunk; payload by component is read as stored, else
    from the row-major form; places that a component lacks are NaN or empty."""
    column = F.col(PAYLOAD[shape])
    if shape in MATRIX:
        width = F.col("Nval").cast("int")
        stored = column if PAYLOAD[shape] in found.columns else F.lit(None)
        column = payload(stored, F.col(MATRIX[shape]), width) if MATRIX[shape] in found.columns else column
    text = shape.startswith("text")
    filler = F.lit("") if text else F.lit(float("nan"))
    flat = found.select("pv", F.col("date").alias("bucket"), "chunk", "t0", "Nval", column.alias("_p"), F.posexplode("times").alias("_i", "_t"))
    if shape.endswith("vector"):
        row = F.transform(F.sequence(F.lit(0), F.col("Nval").cast("int") - 1), lambda j: F.coalesce(F.get(F.get("_p", j), F.col("_i")), filler))
    else:
        row = F.array(F.coalesce(F.get("_p", F.col("_i")), filler))
    nothing = F.lit(None)
    return flat.select(
        "pv", "t0", "bucket", (F.shiftleft(F.col("chunk").cast("long"), 40) + F.col("_i")).alias("seq"), (F.col("_t") * 1000.0).alias("offset_ms"), F.col("Nval").cast("int").alias("nval"),
        F.lit(shape.split("_")[0]).alias("value_type"), (nothing.cast("array<double>") if text else row).alias("vals"), (row if text else nothing.cast("array<string>")).alias("txts"),
    )


def merge_records(chunks: DataFrame, shape: str, by_time: bool = True, most: int = MOST_VALUES) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of chunk records of one shape: chunks of a (pv, date) in order of chunk, or of time with ties in that
    order, with all statistics computed anew. (pv, date) whose chunks disagree in t0, Nval or type, or lack one, are rejects
    (pv, date, n_headers, missing). Component names that all chunks agree on stay, others are made anew."""
    keys = ["pv", "date"]
    rejects = check_headers(chunks, keys, ["t0", "Nval", "value_type"])
    good = chunks.join(rejects.select(*keys), keys, "left_anti")
    out = records_of(samples_of(good, shape), shape, ("offset_ms", "seq") if by_time else ("seq",), most)
    if "component_names" not in chunks.columns or not shape.endswith("vector"):
        return out, rejects
    names = reconcile_names(good.select(*keys, F.col("Nval").cast("int").alias("nval"), "component_names"), keys)
    return out.drop("component_names").join(names, keys).select(*out.columns), rejects
