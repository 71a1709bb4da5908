"""A training corpus from raw documents: language, near duplicates, secrets, mix, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborflow.llm import language, mixing, neardup, packing, secrets
from arborflow.llm.common import keep, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or far from every language that is learnt here, go."""
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    return language.identify(docs.select(*COLUMNS), model).where("not rejected").select(*COLUMNS)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one of smallest id, nulls last.

    Rows are judged by a key of their own, so rows that repeat an id are documents each and a null id is one like any
    other. Documents without words are not compared and stay.
    """
    rows = keep(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    groups = neardup.link(rows.select("row", "text"), doc_id="row").select(F.col("doc_id").alias("row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    kept = groups.join(rows.select("row", "doc_id"), "row").groupBy("component_id").agg(first).select("first.row")
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    found = secrets.scan(docs.select(*COLUMNS))
    return found.select("doc_id", F.col("clean_text").alias("text"), "lang", "source", F.length("clean_text").cast("long").alias("n_chars"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(docs, weights=(5, 2, 1), most=3.0, carry=("text", "lang", "n_chars"))
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of the mix."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("near duplicates", neardup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
#: Model training, decoding and tokenising are not SQL: tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents`; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "_"), "zstd")
    return docs
