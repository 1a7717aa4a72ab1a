"""Set comparison, arbitration and first-wins operators over label tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lemmata.functions.labels import chapter


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; order columns must settle ties."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def compare_sets(detected: DataFrame, expected: DataFrame, doc: str = "doc_id", value: str = "number") -> DataFrame:
    """(doc, value, outcome): matched, missed or spurious, for distinct values, in one full join."""
    d = detected.select(doc, value).distinct().withColumn("__d", F.lit(1))
    e = expected.select(doc, value).distinct().withColumn("__e", F.lit(1))
    outcome = F.when(F.col("__d").isNull(), "missed").when(F.col("__e").isNull(), "spurious").otherwise("matched")
    return d.join(e, [doc, value], "full").select(doc, value, outcome.alias("outcome"))


def rates(outcomes: DataFrame, by: list[str]) -> DataFrame:
    """tp, expected, detected, recall, precision and f1 of outcomes; by nothing: the micro-average."""
    n = lambda *o: F.count_if(F.col("outcome").isin(*o))
    t = outcomes.groupBy(*by).agg(n("matched").alias("tp"), n("matched", "missed").alias("n_expected"), n("matched", "spurious").alias("n_detected"))
    recall = F.when(F.col("n_expected") > 0, F.col("tp") / F.col("n_expected")).otherwise(0.0)
    precision = F.when(F.col("n_detected") > 0, F.col("tp") / F.col("n_detected")).otherwise(0.0)
    out = t.withColumn("recall", recall).withColumn("precision", precision)
    f1 = F.when(F.col("recall") + F.col("precision") > 0, 2 * F.col("recall") * F.col("precision") / (F.col("recall") + F.col("precision")))
    return out.withColumn("f1", F.coalesce(f1, F.lit(0.0)))


def arbitrate(labels: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Non-explicit labels (doc, label) that a document's conventions allow; ``labels`` has (doc, label, explicit).

    None where three or more explicit labels are at least as many; else those whose chapter has two or more.
    """
    distinct = labels.select(doc, "label", "explicit").distinct()
    counts = distinct.groupBy(doc).agg(F.count_if("explicit").alias("n_explicit"), F.count_if(~F.col("explicit")).alias("n_other"))
    other = distinct.where(~F.col("explicit")).withColumn("chapter", chapter(F.col("label")))
    per_chapter = Window.partitionBy(doc, "chapter")
    kept = other.withColumn("n_chapter", F.count("*").over(per_chapter)).where("n_chapter >= 2")
    ruled = counts.where("n_explicit >= 3 AND n_explicit >= n_other").select(doc)
    return kept.join(ruled, doc, "left_anti").select(doc, "label")


def multiset_match(extracted: DataFrame, expected: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, label, matched): each extracted label uses up one equal expected label, else one whose stem it is.

    Duplicates are numbered on both sides, so both passes are equi-joins.
    """
    number = lambda df, key, name: df.withColumn(name, F.row_number().over(Window.partitionBy(doc, key).orderBy("__id")))
    tag = lambda df: df.select(doc, "label").withColumn("__id", F.row_number().over(Window.partitionBy(doc).orderBy("label")))
    x, e = number(tag(extracted), "label", "rn"), number(tag(expected), "label", "rn")
    exact = e.join(x.select(doc, "label", "rn", F.col("__id").alias("xid")), [doc, "label", "rn"], "left")
    left_x = x.join(exact.where("xid is not null").select(doc, F.col("xid").alias("__id")), [doc, "__id"], "left_anti").drop("rn")
    left_e = exact.where("xid is null").select(doc, "label", "__id")
    stem = left_e.where(F.col("label").contains("(")).withColumn("stem", F.trim(F.substring_index("label", "(", 1)))
    by_stem = number(stem, "stem", "rn").join(
        number(left_x, "label", "rn").select(doc, F.col("label").alias("stem"), "rn").withColumn("hit", F.lit(True)), [doc, "stem", "rn"], "left_semi"
    )
    hits = by_stem.select(doc, "__id").withColumn("by_stem", F.lit(True))
    return exact.join(hits, [doc, "__id"], "left").select(doc, "label", (F.col("xid").isNotNull() | F.coalesce("by_stem", F.lit(False))).alias("matched"))


def order_violations(df: DataFrame, keys: list[str], seq: str, position: str) -> DataFrame:
    """``violates`` where a position is below the largest before it."""
    w = Window.partitionBy(*keys).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("violates", F.coalesce(F.col(position) < F.max(position).over(w), F.lit(False)))


def duplicates(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``duplicated`` where a non-empty value occurs more than once under the keys.

    Counted by an aggregate and joined back, so a hot value is folded before it moves.
    """
    t = df.withColumn("__v", F.nullif(F.trim(value), F.lit("")))
    many = t.where("__v is not null").groupBy(*keys, "__v").count().where(F.col("count") > 1).select(*keys, "__v", F.lit(True).alias("duplicated"))
    return t.join(many, [*keys, "__v"], "left").withColumn("duplicated", F.coalesce("duplicated", F.lit(False))).drop("__v")
