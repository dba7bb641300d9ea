"""The pN_ queries on texts, with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import encode, packing, reading
from tidemark.session import materialized, spread, table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.token_ids(_documents(spark, sf_dir))


def p8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.token_spans(_documents(spark, sf_dir))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = materialized(encode.token_counts(_documents(spark, sf_dir)))
    return packing.fill_containers(sizes, table(spark, sf_dir, "token_containers"))


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    return reading.reading_levels(documents, reading.fit_scale(documents, table(spark, sf_dir, "reading_labels")))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _levels(spark, sf_dir).where("top").select("doc_id")


def p10_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _levels(spark, sf_dir).select("doc_id", "english", "n_words", F.round("level", 6).alias("level"), "band")


QUERIES = {
    "p8_ids": p8_ids,
    "p8_spans": p8_spans,
    "p9_containers": p9_containers,
    "p10_found": p10_found,
    "p10_levels": p10_levels,
}

#: None of these can be expressed in SQL; the tests hold them against other implementations and held-out ratings.
ORACLE_SQL: dict[str, str] = {}
