"""Parsing of decoded sample lines and log lines, paths and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A double-quoted token with backslash escapes, or a run without blanks (fixed grammar of the decoder's text).
TOKEN = r'"((?:[^"\\]|\\.)*)"|(\S+)'


def line_offset(line: Column) -> Column:
    """The first field as a number of ms; null if it is none."""
    return F.split(F.trim(line), r"\s+", 2)[0].try_cast("double")


def line_numbers(line: Column) -> Column:
    """The fields after the first as doubles; NaN and Infinity count, other text is null."""
    parts = F.split(F.trim(line), r"\s+")
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p.try_cast("double"))


def line_tokens(line: Column, compat: bool = False) -> Column:
    """The fields after the first as text. Quoted tokens keep their blanks and lose their quotes; compat=True splits at
    blanks and keeps quotes, as older archives hold them."""
    rest = F.coalesce(F.split(F.trim(line), r"\s+", 2)[1], F.lit(""))
    if compat:
        return F.filter(F.split(rest, r"\s+"), lambda p: p != "")
    found = F.regexp_extract_all(rest, F.lit(r'("(?:[^"\\]|\\.)*"|\S+)'), 1)
    return F.transform(found, lambda t: F.when(t.startswith('"') & t.endswith('"') & (F.length(t) > 1), F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t))


def escape_text(text: Column) -> Column:
    """Tab, line feed and carriage return as escapes; null as empty."""
    out = F.coalesce(text, F.lit(""))
    for raw, shown in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(raw), F.lit(shown))
    return out


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dir_name(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")


def safe_name(name: Column, big: bool = False) -> Column:
    """A PV's name as a file name: ":" becomes "-", and "_" on the route of big inputs."""
    return F.replace(name, F.lit(":"), F.lit("_" if big else "-"))


def date_token(path: Column) -> Column:
    """First YYYY_MM_DD of the file name, else null."""
    found = F.regexp_extract(base_name(path), r"(\d{4}_\d{2}_\d{2})", 1)
    return F.when(found != "", found)


def without_date(name: Column) -> Column:
    """The name without a trailing YYYY_MM_DD or YYYY-MM-DD and the dashes and underscores before it."""
    return F.regexp_replace(name, r"[-_]*(19|20)\d{2}[_-]\d{2}[_-]\d{2}$", "")


def chunk_base(path: Column) -> Column:
    """Path without `_chunkNNNN` and extension."""
    return F.regexp_replace(path, r"(_chunk\d+)?\.[^./]*$", "")


def chunk_index(path: Column) -> Column:
    """NNNN of `_chunkNNNN`, else null."""
    return F.regexp_extract(path, r"_chunk(\d+)\.[^./]*$", 1).try_cast("int")


def format_size(size: Column) -> Column:
    """Decimal megabytes below one gigabyte, else gigabytes; two digits."""
    return F.when(size < 1_000_000_000, F.format_string("%.2f MB", size / 1e6)).otherwise(F.format_string("%.2f GB", size / 1e9))


def parse_size(text: Column) -> Column:
    """Bytes of a text like `1.5 GB` in any case; binary units, a bare number is in MB, all else is 0."""
    s = F.upper(F.trim(text))
    unit = F.regexp_extract(s, "(GB|MB|KB|B)$", 1)
    factor = F.when(unit == "GB", 1024.0**3).when(unit == "KB", 1024.0).when(unit == "B", 1.0).otherwise(1024.0**2)
    number = F.trim(F.regexp_replace(s, "(GB|MB|KB|B)$", "")).try_cast("double")
    return F.coalesce(F.round(number * factor).try_cast("long"), F.lit(0).cast("long"))


def parse_rss(line: Column) -> Column:
    """GB of `rss=1.23 GB`, `mem≈1.23 GB` or `mem=1.23 GB` in any case, else null."""
    return F.regexp_extract(line, r"(?i)(?:rss\s*=\s*|mem[≈=]\s*)([0-9]+(?:\.[0-9]+)?)\s*GB", 1).try_cast("double")


def parquet_path(line: Column) -> Column:
    """The first absolute .parquet path of a line, else null."""
    found = F.regexp_extract(line, r"(/[^()\s\"']+\.parquet)", 1)
    return F.when(found != "", found)


def after_colon(line: Column) -> Column:
    """What follows the first colon, trimmed; null without one."""
    return F.when(F.contains(line, F.lit(":")), F.trim(F.regexp_replace(line, "^[^:]*:", "")))
