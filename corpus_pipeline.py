"""A cleaning pipeline over `documents`: each stage's rows are written and reread as the next one's input.

Defined results: null and empty texts pass all stages and end with no ids; rows with
null or repeated ids are rows of their own (of linked ones the first stays, in order
of id, nulls last, and text); texts of any length are read whole; columns beyond those
of `documents` are carried up to the last stage; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmata.llm.bpe import token_rows
from lemmata.llm.common import fresh_path, read, remove
from lemmata.llm.decontaminate import drop_contaminated
from lemmata.llm.jaccard import keep_first
from lemmata.llm.queries import vocabulary
from lemmata.llm.secrets import mask_secrets
from lemmata.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the least id stays."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with windows of two benchmark items or more go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of secrets are masked; n_chars, where there is one, follows the text."""
    out = mask_secrets(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, with digests of the ids and of what they decode to."""
    return token_rows(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: A trained classifier has no SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
