"""Ingestion, identity, duplicates and run bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def validate(size: Column, limit: int, error: Column, pages: Column) -> Column:
    """ok, empty, too_large, encrypted or corrupt."""
    return (
        F.when(F.coalesce(size, F.lit(0)) == 0, "empty")
        .when(size > limit, "too_large")
        .when(F.coalesce(error.rlike("(?i)password|encrypt"), F.lit(False)), "encrypted")
        .when(error.isNotNull() | (pages <= 0), "corrupt")
        .otherwise("ok")
    )


def normal_text(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def normal_values(x: Column) -> Column:
    """Distinct values of a multi-value string, sorted."""
    parts = F.transform(F.split(x, r"\s*[;,/&]\s*|\s+and\s+"), lambda p: F.trim(p))
    return F.array_sort(F.array_distinct(F.filter(parts, lambda p: p != "")))


def logical_id(title: Column, author: Column, publisher: Column) -> Column:
    text = F.lower(F.concat_ws("\x1f", normal_text(title), F.array_join(normal_values(author), "; "), publisher))
    return F.sha2(text.cast("binary"), 256)


def duplicate_lookup(docs: DataFrame) -> DataFrame:
    """(doc_id, duplicate_type, original): an earlier document of equal content, else of equal identity.

    First ids come from aggregates, whose map-side halves fold hot keys, and are joined back.
    """
    f = docs.groupBy("fingerprint").agg(F.min("doc_id").alias("f"))
    i = docs.groupBy("logical_id").agg(F.min("doc_id").alias("l"))
    t = docs.join(f, "fingerprint").join(i, "logical_id")
    kind = F.when(F.col("f") < F.col("doc_id"), "binary").when(F.col("l") < F.col("doc_id"), "logical")
    return t.select("doc_id", kind.alias("duplicate_type"), F.when(kind == "binary", F.col("f")).when(kind == "logical", F.col("l")).alias("original"))


def not_processed(docs: DataFrame, ledger: DataFrame) -> DataFrame:
    return docs.join(ledger.select("fingerprint").distinct(), "fingerprint", "left_anti")


def document_status(status: Column, retries: Column, last: int = 4) -> Column:
    """Aggregate over a document's stages."""
    return F.when(F.count_if((status == "failed") & (retries >= last)) > 0, "aborted").when(F.count_if(status == "failed") > 0, "failed").otherwise("completed")


def backoff(attempt: Column, base: float, factor: float, longest: float) -> Column:
    return F.least(F.lit(longest), base * F.pow(F.lit(factor), attempt - 1))


def ground_truth_lines(df: DataFrame, key: str) -> DataFrame:
    """One number a line; comments and blank lines go."""
    t = df.select(key, F.explode(F.split("text", "\n")).alias("x")).select(key, F.trim("x").alias("number"))
    return t.where((F.col("number") != "") & ~F.col("number").startswith("#"))
