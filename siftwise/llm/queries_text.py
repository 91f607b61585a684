"""opN_ queries of the text operators (2, 8); SQL cannot express them, tests use fixtures and held-out accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwise.llm import html_extract, toxicity
from siftwise.plans.stages import table


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


QUERIES = {"op2_html_extraction": op2_html_extraction, "op8_toxicity": op8_toxicity}
SQL: dict[str, str] = {}
