"""Selection and routing of inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import base_name, dir_name
from ..sources.shared import stored


def normalised(path: Column) -> Column:
    """Forward slashes, none repeated, none at the end."""
    return F.regexp_replace(F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), "/+", "/"), "(?<=.)/$", "")


def _grams(rows: DataFrame, text: str, n: int) -> DataFrame:
    """The rows with _h, a hash of 64 bits, for each part of n characters of the column `text`; none for a shorter one."""
    at = F.explode(F.sequence(F.lit(1), F.length(text) - n + 1)).alias("_at")
    return rows.where(F.length(text) >= n).select("*", at).select(*rows.columns, F.xxhash64(F.substring(F.col(text), F.col("_at"), F.lit(n))).alias("_h"))


def exclude(files: DataFrame, tokens: DataFrame, few: int = 200, gram: int = 8) -> DataFrame:
    """Files whose normalised path holds none of the tokens (token; blank ones and those after # don't count). Up to `few`
    tokens are looked for where the path lies, and so are up to `few` that are shorter than `gram`. More are found by an index: every
    token is entered under one of its parts of `gram` characters (all of it, if it is shorter), the one that paths hold least often; paths
    meet tokens on that part, and those that hold the token go. A token with a part that no path holds is not looked for. Parts and
    paths are hashes there, so that what is sorted are pairs of numbers; whether a path holds a token is told by their texts."""
    wanted = tokens.select(F.trim("token").alias("token")).where("token != '' and not startswith(token, '#')").distinct()
    path = normalised(F.col("path"))
    without = lambda left, own: left.where(~F.coalesce(F.exists(F.lit(own), lambda t: F.contains(path, t)), F.lit(False))) if own else left
    first = [r[0] for r in wanted.limit(few + 1).collect()]
    if len(first) <= few:
        return files.where(~F.exists(F.lit(first), lambda t: F.contains(path, t))) if first else files
    short = [r[0] for r in wanted.where(F.length("token") < gram).limit(few + 1).collect()]
    if len(short) <= few:
        files, wanted, lengths = without(files, short), wanted.where(F.length("token") >= gram), [gram]
    else:
        lengths = list(range(1, gram + 1))
    own = [_grams(wanted if n == gram else wanted.where(F.length("token") == n), "token", n) for n in lengths]
    parts = stored(reduce(DataFrame.unionByName, own), "parts")
    paths = files.select(path.alias("_p")).where("_p is not null").select("_p", F.xxhash64("_p").alias("_id"))
    held = reduce(DataFrame.unionByName, [_grams(paths, "_p", n).select("_id", "_h") for n in lengths])
    held = stored(held.join(parts.select("_h").distinct(), "_h", "left_semi"), "held")
    rare = held.groupBy("_h").agg(F.count("*").alias("n"))
    entry = parts.join(rare, "_h", "left").groupBy("token").agg(F.min(F.coalesce("n", F.lit(0))).alias("n"), F.min_by("_h", F.coalesce("n", F.lit(0))).alias("_h")).where("n > 0")
    met = held.join(entry.select("token", "_h"), "_h").select("_id", "token").distinct()
    return files.join(met, (F.xxhash64(path) == F.col("_id")) & F.contains(path, F.col("token")), "left_anti")


def under_root(files: DataFrame, root: str) -> DataFrame:
    return files.where(F.startswith(normalised(F.col("path")), F.lit(root.rstrip("/") + "/")))


def classify_schema(archive: DataFrame) -> Column:
    """numeric, text or unknown x scalar or vector, from which payload columns of a row are filled."""
    has = lambda n: F.col(n).isNotNull() if n in archive.columns else F.lit(False)
    return (
        F.when(has("values_by_component") | has("values_matrix"), "numeric_vector")
        .when(has("values_text_by_component") | has("values_text_matrix"), "text_vector")
        .when(has("values"), "numeric_scalar")
        .when(has("values_text"), "text_scalar")
        .otherwise("unknown")
    )


def route_by_size(path: Column, size: Column, big: int, most: int, forced: list[str] | None = None) -> Column:
    """too_large over `most` bytes; big from `big` bytes on or with a forced token in the path; else small."""
    force = F.lit(False)
    for t in forced or []:
        force = force | F.contains(path, F.lit(t))
    return F.when(size > most, "too_large").when(force | (size >= big), "big").otherwise("small")


#: A date in a file name (fixed by the archive's naming).
DATED = r"(19|20)\d{2}[-_/]?\d{2}[-_/]?\d{2}"


def decide_split(files: DataFrame, mode: str = "auto", root: str = "", unsplit: tuple[str, ...] = ("/2024c/",), probe: int = 200) -> DataFrame:
    """One row, split: by mode on or off; auto doesn't split under a root with one of the `unsplit` parts, and else splits if
    less than half of the first `probe` names hold a date."""
    if mode != "auto" or any(part in root.rstrip("/") + "/" for part in unsplit):
        return files.sparkSession.range(1).select(F.lit(mode == "on").alias("split"))
    first = files.select("path").orderBy("path").limit(probe)
    return first.agg((F.coalesce(F.avg(base_name(F.col("path")).rlike(DATED).cast("double")), F.lit(0.0)) < 0.5).alias("split"))


def basename_index(files: DataFrame, root: str) -> DataFrame:
    """base, path: one path per file name, one under root if there is, else the first."""
    rows = files.select(base_name(F.col("path")).alias("base"), F.struct((~F.startswith(F.col("path"), F.lit(root.rstrip("/") + "/"))).alias("out"), "path").alias("p"))
    return rows.groupBy("base").agg(F.min("p").alias("p")).select("base", "p.path")


def _colon_at(name: Column, sep: str) -> Column:
    """The name with a colon for the last of the separators in sep (a character class); unchanged where there is none."""
    return F.regexp_replace(name, f"^(.*)[{sep}]([^{sep}]*)$", "$1:$2")


def input_names(out: Column, naming: str = "dated", ext: str = ".pb") -> Column:
    """Names that the input of an output may have, the likeliest first: an output's name without chunk number has a dash or
    underscore where the input has its colon. With yearly naming, or if a bare year stands before it, a day, month or week at
    the end is no part of the name."""
    base = base_name(out)
    name = F.regexp_replace(base, r"\.[^.]*$", "")
    name = F.when(F.endswith(base, F.lit(".parquet")), F.regexp_replace(name, r"_chunk\d{4}$", "")).otherwise(name)
    prefix = F.regexp_replace(name, r"[-_](\d{4}_\d{2}_\d{2}|\d{4}_\d{2}|\d{4}_W\d{2})$", "")
    core = prefix if naming == "yearly" else F.when(prefix.rlike(r"[-_](?:19|20)\d{2}$"), prefix).otherwise(name)
    both = F.contains(core, F.lit("-")) & F.contains(core, F.lit("_"))
    found = F.array(_colon_at(core, "_-"), F.when(both, _colon_at(core, "_")), F.when(both, _colon_at(core, "-")))
    return F.transform(F.array_distinct(F.filter(found, lambda n: n.isNotNull())), lambda n: F.concat(n, F.lit(ext)))


def resolve_outputs(outputs: DataFrame, inputs: DataFrame, out_root: str, in_root: str, naming: str = "dated", ext: str = ".pb") -> DataFrame:
    """out, path: the input of each output, null if there is none. An output that is an input is its own; else each of
    input_names() is looked up in the mirrored folder, then by name alone anywhere."""
    targets = outputs.select("out").distinct()
    own = targets.join(inputs.select("path"), F.col("out") == F.col("path")).where(F.endswith("out", F.lit(ext))).select("out", F.struct(F.lit(-1).alias("step"), F.lit(0).alias("rank"), "path").alias("p"))
    under = F.startswith(F.col("out"), F.lit(out_root.rstrip("/") + "/"))
    folder = F.when(under, F.concat(F.lit(in_root.rstrip("/")), F.substring(dir_name(F.col("out")), len(out_root.rstrip("/")) + 1, 10**6)))
    tried = targets.select("out", folder.alias("folder"), F.posexplode(input_names(F.col("out"), naming, ext)).alias("rank", "base"))
    mirrored = tried.where("folder is not null").withColumn("at", F.concat_ws("/", "folder", "base"))
    exact = mirrored.join(inputs.select("path"), F.col("at") == F.col("path")).select("out", F.struct(F.lit(0).alias("step"), "rank", "path").alias("p"))
    loose = tried.join(basename_index(inputs, in_root), "base").select("out", F.struct(F.lit(1).alias("step"), "rank", "path").alias("p"))
    best = own.unionByName(exact).unionByName(loose).groupBy("out").agg(F.min("p").alias("p"))
    return outputs.select("out").join(best, "out", "left").select("out", F.col("p.path").alias("path"))


def prefer_final(finals: DataFrame, chunks: DataFrame) -> DataFrame:
    """base, path: the final file if there is one, else the first chunk. finals (base, path), chunks (base, i, path)."""
    rows = finals.select("base", F.struct(F.lit(-1).alias("i"), "path").alias("p")).unionByName(chunks.select("base", F.struct(F.col("i").cast("int").alias("i"), "path").alias("p")))
    return rows.groupBy("base").agg(F.min("p").alias("p")).select("base", "p.path")
