"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on all rows that its predecessor kept, is written as Parquet and read again as the next one's documents.
All but the last return the columns of documents.

Rows, in every stage: an empty table gives an empty result; columns beyond those of documents stay, whatever their names, up
to the last stage, which has its own; texts of any length are worked on whole; other columns may be null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsevault.llm import decontamination, near_dedup, packing, quality_rules, secrets
from pulsevault.llm.common import new_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that fail the base rules, or whose host does. Null texts have no words and go; a null source is a host of
    its own; rows with null or repeated ids are judged each on its own."""
    return quality_rules.kept_documents(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the least id (five-word shingles, similarity 0.8). Rows without
    an id and texts without words are linked with nothing and stay; a repeated row stays once, and so does each of the texts
    that share an id which stays."""
    return near_dedup.deduplicated(docs, words=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go. Null texts have no words and stay; rows with null or repeated ids are judged each on its own;
    an empty benchmark leaves all."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays. Null texts stay null; ids play no part."""
    return secrets.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences. Null texts are an end token alone; rows with null
    or repeated ids are packed each."""
    return packing.pack(docs, capacity=1024, end_id=2)


STAGES = [
    ("quality rules", quality_stage),
    ("near-dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secret scan", secrets_stage),
    ("packing", packing_stage),
]

#: Near-copy links and token ids are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = new_path(spark, f"stage-{i}")
            out.write.parquet(path)
            docs = spark.read.parquet(path)
    return out
