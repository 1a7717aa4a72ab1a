"""What follows a first extraction: repair, recovery of missed equations, clean-up, reports, label anchors and prompts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lemmata.functions.latex import is_valid

from .geometry import iou

#: Words before an equation that are no part of it: fixed values.
LEADING_WORDS = "or and where for thus hence so then with if when use".split()


def repaired(equations: DataFrame, judge: Callable[[Column], tuple[Column, Column, Column]]) -> DataFrame:
    """``equations`` (latex, confidence, provider, accepted, crop_valid, corrected, ...) after one attempt at repair.

    Where a judge refused the reading of a sound crop and gave its own, that is
    judged once more: ``judge`` makes (accepted, score, model) of it. It replaces the
    reading only if it is accepted, with a confidence just above both.
    """
    fix = F.trim(F.coalesce("corrected", F.lit("")))
    tried = ~F.col("accepted") & F.col("crop_valid") & (fix != "") & (fix != F.trim("latex"))
    again, score, model = judge(fix)
    t = equations.withColumn("__fix", fix).withColumn("repaired", F.coalesce(tried & again, F.lit(False)))
    better = F.least(F.lit(0.99), F.greatest(F.col("confidence"), F.coalesce(score, F.lit(0.0))) + 0.01)
    return t.withColumns(
        {
            "latex": F.when(F.col("repaired"), F.col("__fix")).otherwise(F.col("latex")),
            "confidence": F.when(F.col("repaired"), better).otherwise(F.col("confidence")),
            "provider": F.when(F.col("repaired"), F.coalesce(model, F.lit("judge_repair"))).otherwise(F.col("provider")),
            "accepted": F.col("accepted") | F.col("repaired"),
        }
    ).drop("__fix", "corrected")


def recovered(incomplete: DataFrame, known: DataFrame, seeds: DataFrame, limit: float = 0.7) -> DataFrame:
    """``known`` boxes and the ``seeds`` of incomplete pages that are new, in one pass.

    All are (doc_id, page_no, box_seq, x0, y0, x1, y1); seeds have a text too. A seed
    without text, or over a known box by ``limit`` of both areas, is none.
    """
    page = ["doc_id", "page_no"]
    new = seeds.where(F.trim("text") != "").join(incomplete.select(*page).distinct(), page, "left_semi")
    box = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    other = known.select(*page, *[c.alias(f"k{k}") for k, c in enumerate(box)])
    covered = new.join(other, page).where(iou(tuple(box), tuple(F.col(f"k{k}") for k in range(4))) >= limit).select(*page, "box_seq").distinct()
    new = new.join(covered, [*page, "box_seq"], "left_anti")
    own = known.select(*page, "box_seq", F.lit(None).cast("double").alias("confidence"), F.lit("first_pass").alias("source"))
    return own.unionByName(new.select(*page, "box_seq", F.lit(0.75).alias("confidence"), F.lit("vlm_page_extract").alias("source")))


def cleaned(equations: DataFrame, trivial: Column) -> tuple[DataFrame, DataFrame]:
    """(pages, documents) after trivial inline equations went; ``equations`` (doc_id, page_no, is_inline, latex, confidence, flag, failed, ...).

    Pages and documents left without any equation stay, as empty.
    """
    gone = F.col("is_inline") & trivial
    page = equations.groupBy("doc_id", "page_no").agg(
        F.count("*").alias("n_before"), F.count_if(~gone).alias("n_kept"), F.bool_or("failed").alias("failed"), F.count_if(~gone & (F.col("flag") == "unsupported_category")).alias("n_partial")
    )
    outcome = F.when(F.col("failed"), "degraded").when(F.col("n_kept") == 0, "empty").when(F.col("n_partial") > 0, "partial").otherwise("extracted")
    pages = page.select("doc_id", "page_no", "n_before", "n_kept", outcome.alias("outcome"))
    kept = equations.where(~gone).groupBy("doc_id").agg(
        F.count_if((F.trim("latex") != "") & (F.col("flag") != "invalid_latex")).alias("n_latex_valid"), F.count_if(F.col("confidence") < 0.5).alias("n_low"), F.count_if(F.col("flag") != "").alias("n_flagged")
    )
    docs = pages.groupBy("doc_id").agg(F.sum("n_before").alias("n_before"), F.sum("n_kept").alias("n_kept"), F.count_if(F.col("outcome") == "degraded").alias("n_failures"))
    state = F.when(F.col("n_failures") > 0, "degraded").when(F.col("n_kept") == 0, "empty").otherwise("extracted")
    filled = docs.join(kept, "doc_id", "left").na.fill(0, ["n_latex_valid", "n_low", "n_flagged"])
    return pages, filled.withColumn("outcome", state)


def bakeoff(kept: DataFrame, gold: DataFrame, detector: list[str]) -> DataFrame:
    """Per document: crops, recall of gold labels, and how many came by the detector or by the fallback alone.

    ``kept`` (doc_id, label, source), ``gold`` (doc_id, label); documents without gold labels have no recall.
    """
    crops = kept.groupBy("doc_id").agg(F.count("*").alias("n_crops"), F.count_if(F.col("source").isin(detector)).alias("n_detector"))
    labels = kept.groupBy("doc_id", "label").agg(F.bool_or(F.col("source").isin(detector)).alias("detected"))
    per_gold = gold.distinct().join(labels, ["doc_id", "label"], "left").groupBy("doc_id").agg(
        F.count("*").alias("n_gold"), F.count("detected").alias("n_hit"), F.count_if("detected").alias("n_via_detector")
    )
    t = crops.join(per_gold, "doc_id", "full").na.fill(0, ["n_crops", "n_detector", "n_gold", "n_hit", "n_via_detector"])
    return t.withColumn("n_via_fallback", F.col("n_hit") - F.col("n_via_detector")).withColumn("recall", F.when(F.col("n_gold") > 0, F.round(F.col("n_hit") / F.col("n_gold"), 4)))


def envelope(equations: DataFrame) -> DataFrame:
    """A sidecar for each document: version, outcome, equations, statistics, providers, config hash and notes."""
    item = F.struct("seq", "equation_id", "page_no", "latex", "confidence", "category")
    return equations.groupBy("doc_id").agg(
        F.lit("1.0").alias("version"),
        F.lit("success").alias("outcome"),
        F.array_sort(F.collect_list(item)).alias("equations"),
        F.struct(F.countDistinct("page_no").alias("total_pages"), F.count("*").alias("total_equations"), F.count_if(is_valid(F.col("latex"))).alias("latex_valid")).alias("statistics"),
        F.lit("eq_label_extractor_v1").alias("config_hash"),
        F.lit(None).cast("string").alias("failure_reason"),
    )


def label_anchors(boxes: DataFrame, lines: DataFrame) -> DataFrame:
    """``boxes`` (doc_id, page_no, box_seq, label, x0, y0, x1, y1) with the box of the first of their ``lines`` that carries the label, else their own.

    ``lines`` (doc_id, page_no, box_seq, line_no, label, x0, y0, x1, y1): labels as normalised.
    """
    key = ["doc_id", "page_no", "box_seq", "label"]
    box = F.struct("x0", "y0", "x1", "y1")
    found = lines.groupBy(*key).agg(F.min_by(box, "line_no").alias("line"))
    t = boxes.join(found, key, "left")
    return t.select(*key, F.col("line").isNotNull().alias("by_line"), *[F.coalesce(F.col("line")[c], F.col(c)).alias(c) for c in ("x0", "y0", "x1", "y1")])


def text_start(text: Column, x0: Column, glyph: float) -> Column:
    """Left edge behind a leading word of prose, in a line of glyphs of one width; null where there is none."""
    word = F.regexp_extract(text, r"^\s*(\S+)\s+\S", 1)
    before = F.length(F.regexp_extract(text, r"^(\s*\S+\s+)\S", 1))
    return F.when(F.lower(word).isin(LEADING_WORDS), x0 + before * glyph)


def prompt_for(category: Column, prompts: dict[str, str], strict_prompts: dict[str, str], strict: Column) -> Column:
    """The prompt of a category, its strict one where asked for and there is one, else that of ``unknown``."""
    table = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    named = F.coalesce(F.element_at(table(prompts), category), F.lit(prompts["unknown"]))
    return F.coalesce(F.when(strict, F.element_at(table(strict_prompts), category)), named) if strict_prompts else named
