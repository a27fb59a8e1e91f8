"""URL filters: explicit host and path rules, and a path-template tree for all else.

The tree of a host is built level by level on aggregates. Rows are first reduced to (host, shape), where a shape is the path
as lower-case segments; labels are counted there. At each level a branch becomes a wildcard if it is a variable segment (its
parent has many children of which it is a rare one, or it has fewer than `least` rows beside siblings), or if its labelled
rate doesn't differ from that of its siblings together (a two-proportion z test over the labelled rows, asked only where both
sides have `least` of them), in which case the similar branches merge. A larger branch without enough labels keeps its name.
A template is rejected if its labelled purity, smoothed with a symmetric beta prior, reaches `reject_at`; without evidence it
stays.

All grouping is by host and prefix with map-side sums. What is joined back to rows are stored tables with a row a key, so
that adaptive execution can split the rows of a host or template that has very many; a host is never one group. Segments
beyond `depth` count as one last segment, so no path is left out.

Rows: a url that is null or lacks `://` has an empty host and path, fits no rule, and its template is that of the empty host;
null or repeated page_ids give a row each; an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from .common import materialise, short_batches
from .quality_rules import text_counts

_HIDDEN = re.compile(r"<(script|style)\b", re.I)
_ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style")}
_BREAK = re.compile(r"<(?:/?(?:p|div|li|h[1-6]|article|nav|footer|ul|tr)\b[^>]*|br\s*/?)>", re.I)

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The text between the first :// and the next /, ? or # (A-Z lower-cased), and what follows up to ? or #."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"\A[^?#]*", 0)
    return F.translate(host, _UP, _LOW), path


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (like "example.net/en/") that fits, nulls where none does. A rule fits its host
    and all subdomains if the path starts with the rule's."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + rest))
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return (F.lit(None).cast("string"), F.lit(None).cast("string")) if rule is None else (rule, verdict)


def shape(path: Column, depth: int) -> Column:
    """The lower-case segments of a path, at most depth of them; the last one holds all that follows."""
    parts = F.filter(F.split(F.translate(path, _UP, _LOW), "/"), lambda s: s != "")
    tail = F.array(F.array_join(F.slice(parts, depth, F.greatest(F.size(parts), F.lit(1))), "/"))
    return F.when(F.size(parts) <= depth, parts).otherwise(F.concat(F.slice(parts, 1, depth - 1), tail))


def templates(labelled: DataFrame, depth: int = 4, max_children: int = 30, rare: float = 0.02, z: float = 1.96, least: int = 5) -> DataFrame:
    """host, shape, template, n, bad, good of rows (host, shape, bad, good; the last two 0 or 1)."""
    level = materialise(labelled.groupBy("host", "shape").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"), F.sum("good").alias("good")).withColumn("template", F.lit("")), "shapes")
    for d in range(depth):
        here = level.withColumn("seg", F.when(F.size("shape") > d, F.col("shape")[d]))
        branch = here.where("seg is not null").groupBy("host", "template", "seg").agg(F.sum("n").alias("bn"), F.sum("bad").alias("bb"), F.sum(F.col("bad") + F.col("good")).alias("bl"))
        branch = materialise(branch, "branches")
        node = materialise(branch.groupBy("host", "template").agg(F.count("*").alias("children"), F.sum("bn").alias("pn"), F.sum("bb").alias("pb"), F.sum("bl").alias("pl")), "nodes")
        both = branch.join(node, ["host", "template"])
        rest_l, rest_b = F.col("pl") - F.col("bl"), F.col("pb") - F.col("bb")
        variable = (F.col("bn") < least) | (F.col("children") > max_children) & (F.col("bn") < rare * F.col("pn"))
        pooled = F.try_divide("pb", "pl")
        spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), "bl") + F.try_divide(F.lit(1), rest_l)))
        apart = F.abs(F.try_divide("bb", "bl") - F.try_divide(rest_b, rest_l)) > z * spread
        similar = (F.col("bl") >= least) & (rest_l >= least) & ~apart
        merged = (F.col("children") > 1) & (variable | F.coalesce(similar, F.lit(False)))
        named = both.select("host", "template", "seg", F.when(merged, "*").otherwise(F.col("seg")).alias("as"))
        found = here.join(named, ["host", "template", "seg"], "left")
        grown = F.when(F.col("as").isNotNull(), F.concat("template", F.lit("/"), "as")).otherwise(F.col("template"))
        level = materialise(found.select("host", "shape", "n", "bad", "good", grown.alias("template")), "templates")
        if level.where(F.size("shape") > d + 1).isEmpty():
            break
    return level


def rejected(found: DataFrame, prior: float = 1.0, reject_at: float = 0.8) -> DataFrame:
    """host, shape, template, purity (smoothed share of bad among the labelled of the template), reject."""
    sums = materialise(found.groupBy("host", "template").agg(F.sum("bad").alias("b"), F.sum("good").alias("g")), "sums")
    purity = (F.col("b") + prior) / (F.col("b") + F.col("g") + 2 * prior)
    return found.join(sums.withColumn("purity", purity), ["host", "template"]).select("host", "shape", "template", "purity", (F.col("purity") >= reject_at).alias("reject"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], bad: Column | None = None, good: Column | None = None, depth: int = 4) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity for every row of pages (page_id, url). bad and good: boolean
    columns of pages that label rows for the tree, of which those without a rule count; without them the explicit rules do."""
    host, path = host_and_path(F.col("url"))
    extra = [c.alias(n) for c, n in ((bad, "_bad"), (good, "_good")) if c is not None]
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), *extra)
    rule, by_rule = rule_columns(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("by_rule", by_rule).withColumn("shape", shape(F.col("path"), depth))
    is_bad = F.col("_bad") & F.col("by_rule").isNull() if bad is not None else F.col("by_rule") == "block"
    is_good = F.col("_good") & F.col("by_rule").isNull() if good is not None else F.col("by_rule") == "allow"
    marked = rows.select("host", "shape", *[F.coalesce(c.cast("long"), F.lit(0)).alias(n) for c, n in ((is_bad, "bad"), (is_good, "good"))])
    tree = materialise(rejected(templates(marked, depth)), "tree")
    out = rows.join(tree, ["host", "shape"], "left")
    verdict = F.coalesce("by_rule", F.when(F.col("reject"), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")


def _without_tags(page: str) -> Iterator[str]:
    """The parts of a page that are text, and line ends for blocks, in one pass: what has no end anywhere behind is looked for
    once."""
    at, endless = 0, set()
    while (start := page.find("<", at)) >= 0:
        yield page[at:start]
        if page.startswith("<!--", start) and "comment" not in endless:
            if (end := page.find("-->", start + 4)) >= 0:
                at = end + 3
                continue
            endless.add("comment")
        if (hidden := _HIDDEN.match(page, start)) and (tag := hidden[1].lower()) not in endless:
            if end := _ENDS[tag].search(page, hidden.end()):
                at = end.end()
                continue
            endless.add(tag)
        if (end := page.find(">", start)) < 0:
            at = start
            break
        at = end + 1
        if _BREAK.fullmatch(page, start, at):
            yield "\n"
    yield page[at:]


def visible_text(page: str | None) -> str:
    """The text of a page without scripts, styles, comments and tags; blocks are lines. Comments and scripts without an end are
    tags like others."""
    return html.unescape("".join(_without_tags(page or "")))


@F.pandas_udf(BooleanType())
def _fails(pages: pd.Series) -> pd.Series:
    def fails(page: str | None) -> bool:
        words, _, symbols, dup_lines, repeats = text_counts(visible_text(page))
        return words < 50 or 100 * repeats > 50 * words or 10 * symbols > 3 * words or 10 * dup_lines > words

    return pd.Series([fails(p) for p in pages], dtype=bool)


def judge_pages(pages: DataFrame, rules: list[tuple[str, str]], depth: int = 4, labelled: Column | None = None) -> DataFrame:
    """judge() of pages (page_id, url, html) where each page that no rule fits is labelled by its own text: bad if it fails any
    of the quality rules of documents, else good. Of pages for which the boolean column `labelled` isn't true nothing is read but
    the url, and they get the verdict of their template."""
    short_batches(pages.sparkSession)
    known = F.lit(True) if labelled is None else F.coalesce(labelled, F.lit(False))
    marked = pages.select("page_id", "url", known.alias("known"), _fails(F.when(known, F.col("html"))).alias("failed"))
    return judge(marked, rules, F.col("known") & F.col("failed"), F.col("known") & ~F.col("failed"), depth)


def held_out_purity(judged: DataFrame, pages: DataFrame, held_out: Column) -> DataFrame:
    """How the tree does on pages that it had no label of: host, template, purity, verdict, held_out (pages without a rule for which
    the boolean column `held_out` of pages is true) and held_out_bad (those whose own text fails), a row a template with such
    pages. `judged` is judge_pages() of the same pages; page_ids must be distinct, rows with null ones are left aside."""
    short_batches(pages.sparkSession)
    texts = pages.where(held_out).select("page_id", _fails("html").cast("long").alias("bad"))
    return judged.where("rule is null").join(texts, "page_id").groupBy("host", "template", "purity", "verdict").agg(F.count("*").alias("held_out"), F.sum("bad").alias("held_out_bad"))
