"""Column functions and small operators over pages and documents."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """``island``: number of the run of equal values that a row is in."""
    w = Window.partitionBy(*keys).orderBy(order)
    fresh = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)), 0).otherwise(1)
    return df.withColumn("__fresh", fresh).withColumn("island", F.sum("__fresh").over(w)).drop("__fresh")


def modality_by_chars(n: Column) -> Column:
    return F.when(n >= 20, "digital").when(n <= 5, "scanned").otherwise("hybrid")


def page_modality(words: Column, fonts: Column, coverage: Column, similarity: Column) -> Column:
    """struct<modality, confidence> of a page's signals."""
    of = lambda m, c: F.struct((F.lit(m) if isinstance(m, str) else m).alias("modality"), F.lit(c).alias("confidence"))
    rendered = F.when(similarity > 0.85, "digital").when(similarity < 0.5, "scanned").otherwise("hybrid")
    return (
        F.when((words > 20) & ~fonts, of("hybrid", 0.75))
        .when((words > 20) & (coverage < 0.3), of("digital", 0.95))
        .when((words > 20) & (coverage <= 0.7), of(rendered, 0.65))
        .when(coverage >= 0.7, of("scanned", 0.92))
        .otherwise(of("scanned", 0.70))
    )


def document_modality(scanned: Column, digital: Column, least: float = 0.7) -> Column:
    of = lambda m, c: F.struct(F.lit(m).alias("modality"), c.alias("confidence"))
    return (
        F.when(scanned >= least, of("scanned", scanned)).when(digital >= least, of("digital", digital)).otherwise(of("hybrid", 1 - F.abs(digital - scanned)))
    )


def banded_modality(digital: Column, scanned: Column, n: Column, least: float = 0.85) -> Column:
    """struct<modality, confidence> of the shares of a document's pages; a document without pages counts as scanned."""
    of = lambda m, c: F.struct(F.lit(m).alias("modality"), c.alias("confidence"))
    return (
        F.when(n == 0, of("scanned", F.lit(0.0))).when(digital >= least, of("digital", digital)).when(scanned >= least, of("scanned", scanned))
        .otherwise(of("hybrid", F.round(1 - F.greatest(digital, scanned), 6)))
    )


def complexity(density: Column, multi_column: Column, moderate: float = 0.15, complex_: float = 0.35) -> Column:
    """struct<level, confidence> of the highest density of tables, figures and equations."""
    of = lambda m, c: F.struct(F.lit(m).alias("level"), F.round(F.least(F.lit(1.0), c), 6).alias("confidence"))
    return (
        F.when((density >= complex_) | (multi_column & (density >= moderate)), of("complex", 0.6 + density))
        .when(multi_column | (density >= moderate), of("moderate", 0.5 + density))
        .otherwise(of("simple", 0.7 + (moderate - density)))
    )


#: What ends a line of text, and the characters of a line that tell of numbers and of mathematics: fixed values.
LINE_END = "[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\u2028\u2029]"
NUMERIC, MATHS = "[0-9]", "[=±∑∫∂√≤≥≈×÷∞°µ]"
PROSE_CHARS = 4000


def line_densities(text: Column) -> Column:
    """struct<numeric, maths>: shares of the lines with three digits or more, and with a sign of mathematics."""
    lines = F.filter(F.split(text, LINE_END), lambda x: x.rlike(r"\S"))
    n = F.greatest(F.size(lines), F.lit(1))
    numeric = F.size(F.filter(lines, lambda x: F.regexp_count(x, F.lit(NUMERIC)) >= 3)) / n
    return F.struct(numeric.alias("numeric"), (F.size(F.filter(lines, lambda x: x.rlike(MATHS))) / n).alias("maths"))


def even_sample(n: Column, size: int = 10) -> Column:
    """All of n page indexes up to ``size``, else floor(i n / size)."""
    full = F.sequence(F.lit(0).cast("bigint"), F.greatest(n.cast("bigint") - 1, F.lit(0)))
    return F.when(n <= size, full).otherwise(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.floor(i * n / size)))


def stratified_sample(n: Column, cap: int) -> Column:
    """At most ``cap`` indexes with the first and the last, rounded half to even."""
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(cap - 1)), lambda i: F.rint(i * (n - 1) / (cap - 1)).cast("bigint")))


#: Words of a title that tell a category: fixed values.
CATEGORY_WORDS = {
    "textbook": ("textbook", "introduction to", "lecture", "edition"),
    "reference_handbook": ("handbook", "reference", "encyclopedia", "manual"),
    "journal_article": ("journal", "doi", "abstract", "vol."),
    "conference_paper": ("proceedings", "conference", "symposium", "workshop"),
    "technical_report": ("report", "technical memorandum", "white paper"),
    "standard_specification": ("standard", "specification", "iso ", "astm", "ansi", "ieee std"),
    "datasheet": ("datasheet", "data sheet", "product specification"),
    "patent": ("patent", "claims", "united states patent", "application no"),
}


def category_scores(title: Column, pages: Column, multi_column: Column, table: Column, figure: Column, equation: Column) -> dict[str, Column]:
    """A score for each category: 2.5 for each word of the title, and what the document's shape adds."""
    either = lambda c, yes, no: F.when(c, F.lit(yes)).otherwise(F.lit(no))
    shape = {
        "textbook": either(pages >= 150, 1.0, 0.2) + either(equation >= 0.05, 0.4, 0.0),
        "reference_handbook": either((pages >= 200) & (table >= 0.15), 1.0, 0.2),
        "journal_article": either((pages <= 40) & multi_column, 1.0, 0.1),
        "conference_paper": either((pages <= 30) & multi_column, 0.9, 0.1) + either(figure >= 0.1, 0.3, 0.0),
        "technical_report": either(pages.between(20, 200), 0.6, 0.2),
        "standard_specification": either(table >= 0.1, 0.5, 0.1),
        "datasheet": either((pages <= 20) & (table >= 0.25), 1.0, 0.1),
        "patent": F.lit(0.4),
    }
    low = F.lower(title)
    return {k: 2.5 * reduce(add, [low.contains(w).cast("int") for w in words]) + shape[k] for k, words in CATEGORY_WORDS.items()}


def select_category(scores: dict[str, Column], threshold: float = 0.5, margin: float = 0.1) -> Column:
    """struct<category, confidence, reason>: the category with the largest share of all scores, if it is large and far enough ahead."""
    total = reduce(add, scores.values())
    ranked = F.array_sort(F.array(*[F.struct((-F.round(c / total, 6)).alias("s"), F.lit(k).alias("c")) for k, c in scores.items()]))
    first, second = -ranked[0]["s"], -ranked[1]["s"]
    of = lambda c, r: F.struct(c.alias("category"), first.alias("confidence"), F.lit(r).cast("string").alias("reason"))
    return (
        F.when(first < threshold, of(F.lit("unknown"), "below_threshold"))
        .when(first - second < margin, of(F.lit("unknown"), "below_margin"))
        .otherwise(of(ranked[0]["c"], None))
    )


#: What each modality is read with: fixed values.
STRATEGIES = {"digital": "digital_text_first", "scanned": "ocr_first", "hybrid": "hybrid_per_page_routed"}


def recommend_strategy(modality: Column, category: Column, layout: Column, named: dict[str, str], otherwise: str) -> Column:
    """The strategy named for modality, category and layout, else for the modality, else the modality's own, else ``otherwise``."""
    look = lambda d, k: F.element_at(F.create_map(*[F.lit(x) for kv in d.items() for x in kv]), k) if d else F.lit(None).cast("string")
    return F.coalesce(look(named, F.concat_ws("|", modality, category, layout)), look(named, modality), look(STRATEGIES, modality), F.lit(otherwise))
