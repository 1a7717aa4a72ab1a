"""Column functions over equation records and their flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flags(**conditions: Column) -> Column:
    """array<string> of the names whose condition holds, in the order given."""
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]), lambda x: x.isNotNull())


def page_outcome(latex: Column, flag: Column) -> Column:
    """Aggregate: empty, degraded, partial or extracted."""
    none = F.count_if(F.trim(latex) != "") == 0
    return (
        F.when(none, "empty").when(F.count_if(flag == "invalid_latex") > 1, "degraded").when(F.count_if(F.trim(latex) == "") > 0, "partial").otherwise("extracted")
    )


def acceptance(crop_valid: Column, score: Column, least: float = 0.7) -> Column:
    """struct<accepted, score>; without a score the judge counts as unavailable, which accepts at one half."""
    return F.struct(F.when(score.isNull(), True).otherwise(crop_valid & (score >= least)).alias("accepted"), F.coalesce(score, F.lit(0.5)).alias("score"))


def select_provider(category: Column, defaults: dict[str, str], overrides: str, otherwise: str) -> Column:
    """Provider of a category: ``overrides`` ("a=x,b=y") before defaults."""
    table = defaults | dict(x.split("=", 1) for x in overrides.split(",") if "=" in x)
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), category) if pairs else F.lit(None), F.lit(otherwise))


def table_quality(cells: Column, filled: Column, caption: Column) -> list[Column]:
    """Structure, text share and completeness of a table, each at most 100."""
    return [
        F.least(F.lit(100), 60 + 2 * F.least(cells, F.lit(20))).alias("structure"),
        (100.0 * filled / cells).alias("text_share"),
        F.least(F.lit(100), 50 + F.when(caption, 20).otherwise(0) + F.least(F.lit(20), 5 * filled) + 10).alias("completeness"),
    ]


def dedup_lines(lines: Column) -> Column:
    """Lines whose trimmed form has not come before."""
    trimmed = F.transform(lines, lambda x: F.trim(x))
    return F.filter(lines, lambda x, i: F.array_position(trimmed, F.trim(x)) == i + 1)
