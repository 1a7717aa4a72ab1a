"""Boxes: column functions on x0, y0, x1, y1, and joins between labels and boxes of a page.

All joins have document and page as equi keys, the ranges being residual filters, so
no page meets another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE = ["doc_id", "page_no"]


def area(x0, y0, x1, y1) -> Column:
    return F.greatest(x1 - x0, F.lit(0.0)) * F.greatest(y1 - y0, F.lit(0.0))


def is_box(x0, y0, x1, y1) -> Column:
    return (x1 > x0) & (y1 > y0) & (x0 >= 0) & (y0 >= 0)


def iou(a: tuple, b: tuple) -> Column:
    inter = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0)) * F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    union = area(*a) + area(*b) - inter
    return F.when(union > 0, inter / union).otherwise(0.0)


def vertical_overlap(a0, a1, b0, b1) -> Column:
    """Share of the shorter of two spans that both cover."""
    shorter = F.least(a1 - a0, b1 - b0)
    return F.when(shorter > 0, F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0.0)) / shorter).otherwise(0.0)


def gap(a0, a1, b0, b1) -> Column:
    return F.greatest(F.greatest(a0, b0) - F.least(a1, b1), F.lit(0.0))


def padded(x0, y0, x1, y1, w: float, h: float, left: float = 0.15, other: float = 0.08) -> list[Column]:
    """A box grown by fractions of its size, within the page."""
    bw, bh = x1 - x0, y1 - y0
    return [
        F.greatest(F.lit(0.0), x0 - left * bw),
        F.greatest(F.lit(0.0), y0 - other * bh),
        F.least(F.lit(w), x1 + other * bw),
        F.least(F.lit(h), y1 + other * bh),
    ]


def pixel_window(x0, y0, x1, y1, w: float, h: float, dpi: int = 216, fraction: float = 0.05, least: float = 4.0) -> list[Column]:
    """Pixels of a crop: padded points scaled, cut to whole pixels and to the page."""
    pad_x, pad_y = (F.greatest(F.lit(least), fraction * d) for d in (x1 - x0, y1 - y0))
    scale = dpi / 72.0
    px = lambda v, top: F.floor(F.greatest(F.lit(0.0), F.least(F.lit(top), v)) * scale).cast("long")
    return [px(x0 - pad_x, w), px(y0 - pad_y, h), px(x1 + pad_x, w), px(y1 + pad_y, h)]


def fallback_box(x0, y0, x1, y1) -> list[Column]:
    """Where the formula of an image-only label should be: left of it, 24 % of its place to its edge."""
    height = y1 - y0
    return [0.24 * x0, y0 - 0.75 * height, x0 - 12.0, y1 + 2.0 * height]


def label_formula(labels: DataFrame, boxes: DataFrame) -> DataFrame:
    """Per label the union of boxes to its left in its row, capped at three label heights above and below."""
    b = boxes.select(*PAGE, *[F.col(c).alias(f"b{c}") for c in ("x0", "y0", "x1", "y1")])
    h = F.col("y1") - F.col("y0")
    near = F.abs((F.col("by0") + F.col("by1")) / 2 - (F.col("y0") + F.col("y1")) / 2) <= 2 * h
    overlap = F.least("y1", "by1") - F.greatest("y0", "by0") > 0
    met = labels.join(b, PAGE).where(overlap & (F.col("bx0") < F.col("x0")) & (F.col("bx1") <= F.col("x0") + 8) & near)
    return met.groupBy(*PAGE, "label").agg(
        F.min("bx0").alias("fx0"),
        F.greatest(F.min("by0"), F.first("y0") - 3 * F.first(h)).alias("fy0"),
        F.max("bx1").alias("fx1"),
        F.least(F.max("by1"), F.first("y1") + 3 * F.first(h)).alias("fy1"),
        F.count("*").alias("n_boxes"),
    )


def nearest_box(labels: DataFrame, boxes: DataFrame, band: float = 2.5) -> DataFrame:
    """Per label the nearest box to its left within ``band`` label heights, by horizontal gap, then order."""
    b = boxes.select(*PAGE, "box_seq", F.col("x1").alias("bx1"), F.col("y0").alias("by0"), F.col("y1").alias("by1"))
    h = F.col("y1") - F.col("y0")
    met = labels.join(b, PAGE).where(
        (F.col("bx1") <= F.col("x0")) & (F.abs((F.col("by0") + F.col("by1")) / 2 - (F.col("y0") + F.col("y1")) / 2) <= band * h)
    )
    best = met.groupBy(*PAGE, "label").agg(F.min(F.struct((F.col("x0") - F.col("bx1")).alias("gap"), "box_seq")).alias("b"))
    return best.select(*PAGE, "label", F.col("b.box_seq").alias("box_seq"), F.col("b.gap").alias("gap"))


def shared_splits(labels: DataFrame, boxes: DataFrame) -> DataFrame:
    """Boxes that several labels share are cut half-way between neighbouring label centres: (label, box_seq, lo, hi)."""
    b = boxes.select(*PAGE, "box_seq", F.col("x0").alias("bx0"), F.col("y0").alias("by0"), F.col("y1").alias("by1"))
    h, c = F.col("y1") - F.col("y0"), (F.col("y0") + F.col("y1")) / 2
    met = labels.join(b, PAGE).where((F.col("bx0") < F.col("x0") + h) & (c >= F.col("by0") - 1.5 * h) & (c <= F.col("by1") + 1.5 * h)).withColumn("c", c)
    w = Window.partitionBy(*PAGE, "box_seq").orderBy("c", "label")
    lo, hi = (F.lag("c").over(w) + F.col("c")) / 2, (F.lead("c").over(w) + F.col("c")) / 2
    return met.select(*PAGE, "label", "box_seq", F.greatest("by0", F.coalesce(lo, "by0")).alias("lo"), F.least("by1", F.coalesce(hi, "by1")).alias("hi"))


def median_filter(boxes: DataFrame) -> DataFrame:
    """Boxes of a page not below .6 of its upper-median height or .3 of its width; all where none is left."""
    h, w = F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")
    upper = lambda c: F.get(F.sort_array(F.collect_list(c)), F.floor(F.count("*") / 2).cast("int"))
    medians = boxes.groupBy(*PAGE).agg(upper(h).alias("mh"), upper(w).alias("mw"))
    t = boxes.join(medians, PAGE).withColumn("ok", (h >= 0.6 * F.col("mh")) & (w >= 0.3 * F.col("mw")))
    n_ok = F.count_if("ok").over(Window.partitionBy(*PAGE))
    return t.withColumn("n_ok", n_ok).where(F.col("ok") | (F.col("n_ok") == 0)).drop("mh", "mw", "ok", "n_ok")


def greedy_dedup(boxes: DataFrame, limit: float = 0.7) -> DataFrame:
    """Boxes of a page kept in order if they overlap no box kept before by ``limit`` or more (a fold, not a self join)."""
    item = F.struct("box_seq", "x0", "y0", "x1", "y1")
    lists = boxes.groupBy(*PAGE).agg(F.array_sort(F.collect_list(item)).alias("all"))
    of = lambda s: (s["x0"], s["y0"], s["x1"], s["y1"])
    kept = F.aggregate(
        "all",
        F.filter("all", lambda x: F.lit(False)),
        lambda acc, x: F.when(F.exists(acc, lambda k: iou(of(k), of(x)) >= limit), acc).otherwise(F.concat(acc, F.array(x))),
    )
    return lists.select(*PAGE, F.explode(kept).alias("k")).select(*PAGE, "k.*")


def unmatched(boxes: DataFrame, known: DataFrame, least: float = 0.5) -> DataFrame:
    """Boxes that overlap no known box of their page vertically by ``least`` of the shorter."""
    k = known.select(*PAGE, F.col("y0").alias("ky0"), F.col("y1").alias("ky1"))
    cond = (boxes["doc_id"] == k["doc_id"]) & (boxes["page_no"] == k["page_no"]) & (vertical_overlap(boxes["y0"], boxes["y1"], k["ky0"], k["ky1"]) >= least)
    return boxes.join(k, cond, "left_anti")
