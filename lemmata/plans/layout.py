"""Queries over boxes, pages and document classes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lemmata.functions import documents as D
from lemmata.operators import geometry as G

from .registry import query

C = F.col
BOX = ("x0", "y0", "x1", "y1")
KEY = ["doc_id", "page_no", "box_seq"]
cols = lambda names=BOX, p="": tuple(C(p + n) for n in names)


@query("box_validity", "v_box", "SELECT doc_id, page_no, box_seq, x1 > x0 AND y1 > y0 AND x0 >= 0 AND y0 >= 0 AS valid, greatest(x1 - x0, 0) * greatest(y1 - y0, 0) AS area FROM v_box")
def _(v):
    return v.v_box.select(*KEY, G.is_box(*cols()).alias("valid"), G.area(*cols()).alias("area"))


@query(
    "box_xywh", "v_box",
    "SELECT doc_id, page_no, box_seq, round(x0, 2) AS x, round(y0, 2) AS y, round(x1 - x0, 2) AS width, round(y1 - y0, 2) AS height FROM v_box",
)
def _(v):
    return v.v_box.select(*KEY, *[F.round(c, 2).alias(n) for c, n in ((C("x0"), "x"), (C("y0"), "y"), (C("x1") - C("x0"), "width"), (C("y1") - C("y0"), "height"))])


NEXT = "lead(x0) OVER w AS n0, lead(y0) OVER w AS n1, lead(x1) OVER w AS n2, lead(y1) OVER w AS n3"


@query(
    "box_neighbours", "v_box",
    f"""SELECT doc_id, page_no, box_seq, i / nullif((x1 - x0) * (y1 - y0) + (n2 - n0) * (n3 - n1) - i, 0) AS iou,
    greatest(least(y1, n3) - greatest(y0, n1), 0) / least(y1 - y0, n3 - n1) AS vertical, greatest(greatest(y0, n1) - least(y1, n3), 0) AS gap,
    greatest(least(x1, n2) - greatest(x0, n0), 0) / least(x1 - x0, n2 - n0) AS horizontal, least(x0, n0) AS ux0, greatest(y1, n3) AS uy1
    FROM (SELECT *, greatest(least(x1, n2) - greatest(x0, n0), 0) * greatest(least(y1, n3) - greatest(y0, n1), 0) AS i FROM (SELECT *, {NEXT} FROM v_box WINDOW w AS (PARTITION BY doc_id, page_no ORDER BY box_seq)) WHERE n0 IS NOT NULL)""",
)
def _(v):
    w = Window.partitionBy(*G.PAGE).orderBy("box_seq")
    t = v.v_box.select(*KEY, *BOX, *[F.lead(b).over(w).alias(f"n{k}") for k, b in enumerate(BOX)]).where("n0 is not null")
    n = tuple(C(f"n{k}") for k in range(4))
    return t.select(
        *KEY,
        G.iou(cols(), n).alias("iou"),
        G.vertical_overlap(C("y0"), C("y1"), n[1], n[3]).alias("vertical"),
        G.gap(C("y0"), C("y1"), n[1], n[3]).alias("gap"),
        G.vertical_overlap(C("x0"), C("x1"), n[0], n[2]).alias("horizontal"),
        F.least(C("x0"), n[0]).alias("ux0"),
        F.greatest(C("y1"), n[3]).alias("uy1"),
    )


@query(
    "crop_boxes", "v_box",
    """SELECT doc_id, page_no, box_seq, greatest(0, x0 - 0.15 * (x1 - x0)) AS px0, greatest(0, y0 - 0.08 * (y1 - y0)) AS py0, least(612, x1 + 0.08 * (x1 - x0)) AS px1, least(792, y1 + 0.08 * (y1 - y0)) AS py1,
    CAST(floor(greatest(0, least(612, x0 - greatest(4, 0.05 * (x1 - x0)))) * 3) AS BIGINT) AS wx0, CAST(floor(greatest(0, least(792, y1 + greatest(4, 0.05 * (y1 - y0)))) * 3) AS BIGINT) AS wy1 FROM v_box""",
)
def _(v):
    p, w = G.padded(*cols(), 612.0, 792.0), G.pixel_window(*cols(), 612.0, 792.0)
    return v.v_box.select(*KEY, *[c.alias(f"p{n}") for c, n in zip(p, BOX)], w[0].alias("wx0"), w[3].alias("wy1"))


@query("label_fallback_boxes", "v_label_box", "SELECT doc_id, page_no, label, 0.24 * x0 AS fx0, y0 - 0.75 * (y1 - y0) AS fy0, x0 - 12 AS fx1, y1 + 2 * (y1 - y0) AS fy1 FROM v_label_box")
def _(v):
    return v.v_label_box.select(*G.PAGE, "label", *[c.alias(f"f{n}") for c, n in zip(G.fallback_box(*cols()), BOX)])


@query(
    "label_formula_union", "v_label_box v_box",
    """SELECT l.doc_id, l.page_no, l.label, min(b.x0) AS fx0, greatest(min(b.y0), min(l.y0) - 3 * 10) AS fy0, max(b.x1) AS fx1, least(max(b.y1), min(l.y1) + 3 * 10) AS fy1, count(*) AS n_boxes
    FROM v_label_box l JOIN v_box b ON l.doc_id = b.doc_id AND l.page_no = b.page_no WHERE least(l.y1, b.y1) > greatest(l.y0, b.y0) AND b.x0 < l.x0 AND b.x1 <= l.x0 + 8
    AND abs((b.y0 + b.y1) / 2 - (l.y0 + l.y1) / 2) <= 20 GROUP BY ALL""",
)
def _(v):
    return G.label_formula(v.v_label_box, v.v_box)


@query(
    "label_nearest_box", "v_label_box v_box",
    """SELECT doc_id, page_no, label, box_seq, gap FROM (SELECT l.doc_id, l.page_no, l.label, b.box_seq, l.x0 - b.x1 AS gap, row_number() OVER (PARTITION BY l.doc_id, l.page_no, l.label ORDER BY l.x0 - b.x1, b.box_seq) AS rn
    FROM v_label_box l JOIN v_box b ON l.doc_id = b.doc_id AND l.page_no = b.page_no WHERE b.x1 <= l.x0 AND abs((b.y0 + b.y1) / 2 - (l.y0 + l.y1) / 2) <= 25) WHERE rn = 1""",
)
def _(v):
    return G.nearest_box(v.v_label_box, v.v_box)


@query(
    "label_shared_splits", "v_label_box v_box",
    """SELECT doc_id, page_no, label, box_seq, greatest(by0, coalesce((lag(c) OVER w + c) / 2, by0)) AS lo, least(by1, coalesce((lead(c) OVER w + c) / 2, by1)) AS hi FROM (
    SELECT l.doc_id, l.page_no, l.label, b.box_seq, b.y0 AS by0, b.y1 AS by1, (l.y0 + l.y1) / 2 AS c FROM v_label_box l JOIN v_box b ON l.doc_id = b.doc_id AND l.page_no = b.page_no
    WHERE b.x0 < l.x0 + 10 AND (l.y0 + l.y1) / 2 BETWEEN b.y0 - 15 AND b.y1 + 15) WINDOW w AS (PARTITION BY doc_id, page_no, box_seq ORDER BY c, label)""",
)
def _(v):
    return G.shared_splits(v.v_label_box, v.v_box)


@query(
    "box_median_filter", "v_box",
    """, m AS (SELECT doc_id, page_no, list_sort(list(y1 - y0))[len(list(y1 - y0)) // 2 + 1] AS mh, list_sort(list(x1 - x0))[len(list(x1 - x0)) // 2 + 1] AS mw FROM v_box GROUP BY ALL),
    t AS (SELECT b.doc_id, b.page_no, box_seq, y1 - y0 >= 0.6 * mh AND x1 - x0 >= 0.3 * mw AS ok FROM v_box b JOIN m ON b.doc_id = m.doc_id AND b.page_no = m.page_no)
    SELECT doc_id, page_no, box_seq FROM (SELECT *, count(*) FILTER (ok) OVER (PARTITION BY doc_id, page_no) AS n FROM t) WHERE ok OR n = 0""",
)
def _(v):
    return G.median_filter(v.v_box).select(*KEY)


@query("box_greedy_dedup")
def _(v):
    return G.greedy_dedup(v.v_box, 0.3)


@query(
    "box_unmatched", "v_box v_label_box",
    """SELECT doc_id, page_no, box_seq FROM v_box b WHERE NOT EXISTS (SELECT 1 FROM v_label_box l WHERE l.doc_id = b.doc_id AND l.page_no = b.page_no
    AND greatest(least(l.y1, b.y1) - greatest(l.y0, b.y0), 0) / least(l.y1 - l.y0, b.y1 - b.y0) >= 0.5)""",
)
def _(v):
    return G.unmatched(v.v_box, v.v_label_box).select(*KEY)


@query(
    "text_in_region", "v_box",
    """SELECT r.doc_id, r.page_no, r.box_seq, count(*) AS n_spans, string_agg(CAST(s.box_seq AS VARCHAR), ' ' ORDER BY s.y0, s.x0, s.box_seq) AS spans FROM v_box r JOIN v_box s
    ON r.doc_id = s.doc_id AND r.page_no = s.page_no AND r.kind = 0 AND s.kind > 0 AND (s.x0 + s.x1) / 2 BETWEEN r.x0 AND r.x1 AND (s.y0 + s.y1) / 2 BETWEEN r.y0 AND r.y1 GROUP BY ALL""",
)
def _(v):
    r = v.v_box.where("kind = 0")
    s = v.v_box.where("kind > 0").select(*G.PAGE, C("box_seq").alias("s"), C("x0").alias("sx"), C("y0").alias("sy"), ((C("x0") + C("x1")) / 2).alias("cx"), ((C("y0") + C("y1")) / 2).alias("cy"))
    met = r.join(s, G.PAGE).where(C("cx").between(C("x0"), C("x1")) & C("cy").between(C("y0"), C("y1")))
    spans = F.array_sort(F.collect_list(F.struct("sy", "sx", "s")))
    return met.groupBy(*KEY).agg(F.count("*").alias("n_spans"), F.array_join(F.transform(spans, lambda x: x["s"].cast("string")), " ").alias("spans"))


@query(
    "label_previous", "v_label_box",
    "SELECT doc_id, page_no, label, y0, max(y0) OVER (PARTITION BY doc_id, page_no ORDER BY y0, label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM v_label_box",
)
def _(v):
    w = Window.partitionBy(*G.PAGE).orderBy("y0", "label").rowsBetween(Window.unboundedPreceding, -1)
    return v.v_label_box.select(*G.PAGE, "label", "y0", F.max("y0").over(w).alias("previous"))


@query(
    "label_preceding_box", "v_label_box v_box",
    """, l AS (SELECT *, coalesce(max(y0) OVER (PARTITION BY doc_id, page_no ORDER BY y0, label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS lo FROM v_label_box)
    SELECT l.doc_id, l.page_no, l.label, max_by(b.box_seq, b.y0 * 1000 + b.box_seq) AS box_seq FROM l JOIN v_box b ON l.doc_id = b.doc_id AND l.page_no = b.page_no
    AND b.y0 > l.lo AND b.y0 <= l.y0 AND l.y0 - b.y0 <= 120 GROUP BY ALL""",
)
def _(v):
    w = Window.partitionBy(*G.PAGE).orderBy("y0", "label").rowsBetween(Window.unboundedPreceding, -1)
    labels = v.v_label_box.withColumn("lo", F.coalesce(F.max("y0").over(w), F.lit(-1.0)))
    b = v.v_box.select(*G.PAGE, "box_seq", C("y0").alias("by0"))
    met = labels.join(b, G.PAGE).where((C("by0") > C("lo")) & (C("by0") <= C("y0")) & (C("y0") - C("by0") <= 120))
    return met.groupBy(*G.PAGE, "label").agg(F.max_by("box_seq", C("by0") * 1000 + C("box_seq")).alias("box_seq"))


@query(
    "span_islands", "v_box",
    """, f AS (SELECT *, CASE WHEN kind = lag(kind) OVER (PARTITION BY doc_id, page_no ORDER BY box_seq) THEN 0 ELSE 1 END AS fresh FROM v_box),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, page_no ORDER BY box_seq) AS island FROM f)
    SELECT doc_id, page_no, CAST(island AS BIGINT) AS island, kind, count(*) AS n, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM g GROUP BY ALL""",
)
def _(v):
    return D.islands(v.dealt("v_box"), G.PAGE, "box_seq", "kind").groupBy(*G.PAGE, "island", "kind").agg(
        F.count("*").alias("n"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")
    )


@query(
    "page_modality", "v_page",
    """SELECT doc_id, page_no, CASE WHEN char_count >= 20 THEN 'digital' WHEN char_count <= 5 THEN 'scanned' ELSE 'hybrid' END AS by_chars,
    CASE WHEN word_count > 20 AND NOT has_real_fonts THEN 'hybrid' WHEN word_count > 20 AND image_coverage < 0.3 THEN 'digital' WHEN word_count > 20 AND image_coverage <= 0.7 THEN
      CASE WHEN similarity > 0.85 THEN 'digital' WHEN similarity < 0.5 THEN 'scanned' ELSE 'hybrid' END WHEN image_coverage >= 0.7 THEN 'scanned' ELSE 'scanned' END AS by_signals,
    CASE WHEN word_count > 20 AND NOT has_real_fonts THEN 0.75 WHEN word_count > 20 AND image_coverage < 0.3 THEN 0.95 WHEN word_count > 20 AND image_coverage <= 0.7 THEN 0.65
      WHEN image_coverage >= 0.7 THEN 0.92 ELSE 0.7 END AS confidence FROM v_page""",
)
def _(v):
    got = D.page_modality(C("word_count"), C("has_real_fonts"), C("image_coverage"), C("similarity"))
    return v.v_page.select("doc_id", "page_no", D.modality_by_chars(C("char_count")).alias("by_chars"), got["modality"].alias("by_signals"), got["confidence"].alias("confidence"))


SQL_SHARES = """, s AS (SELECT doc_id, avg(CASE WHEN char_count >= 200 THEN 1.0 ELSE 0 END) AS digital, avg(CASE WHEN char_count <= 100 THEN 1.0 ELSE 0 END) AS scanned, count(*) AS n_pages FROM v_page GROUP BY doc_id)"""


@query(
    "document_modality", "v_page",
    SQL_SHARES + """SELECT doc_id, n_pages, CASE WHEN scanned >= 0.7 THEN 'scanned' WHEN digital >= 0.7 THEN 'digital' ELSE 'hybrid' END AS modality,
    round(CASE WHEN scanned >= 0.7 THEN scanned WHEN digital >= 0.7 THEN digital ELSE 1 - abs(digital - scanned) END, 6) AS confidence FROM s""",
)
def _(v):
    t = v.v_page.groupBy("doc_id").agg(
        F.avg(F.when(C("char_count") >= 200, 1.0).otherwise(0.0)).alias("digital"), F.avg(F.when(C("char_count") <= 100, 1.0).otherwise(0.0)).alias("scanned"), F.count("*").alias("n_pages")
    )
    got = D.document_modality(C("scanned"), C("digital"))
    return t.select("doc_id", "n_pages", got["modality"].alias("modality"), F.round(got["confidence"], 6).alias("confidence"))


@query(
    "dense_image_pages", "v_page",
    """, d AS (SELECT *, count(*) FILTER (char_count > 20) OVER w AS content, count(*) FILTER (image_count >= 6) OVER w AS dense FROM v_page WINDOW w AS (PARTITION BY doc_id))
    SELECT doc_id, page_no FROM d WHERE image_count >= 6 AND content > 0 AND dense / content >= 0.3""",
)
def _(v):
    w = Window.partitionBy("doc_id")
    t = v.v_page.withColumn("content", F.count_if(C("char_count") > 20).over(w)).withColumn("dense", F.count_if(C("image_count") >= 6).over(w))
    return t.where("image_count >= 6 AND content > 0 AND dense / content >= 0.3").select("doc_id", "page_no")


@query(
    "document_columns", "v_box",
    """, c AS (SELECT doc_id, page_no, count(*) AS n, count(*) FILTER ((x0 + x1) / 2 < 306) AS l FROM v_box GROUP BY ALL) SELECT doc_id, page_no, CAST(CASE WHEN n >= 4 AND least(l, n - l) / n >= 0.25 THEN 2 ELSE 1 END AS INT) AS columns FROM c""",
)
def _(v):
    t = v.v_box.groupBy(*G.PAGE).agg(F.count("*").alias("n"), F.count_if((C("x0") + C("x1")) / 2 < 306).alias("l"))
    return t.select(*G.PAGE, F.when((C("n") >= 4) & (F.least(C("l"), C("n") - C("l")) / C("n") >= 0.25), 2).otherwise(1).alias("columns"))


@query("even_page_sample", "v_page", ", n AS (SELECT doc_id, count(*) + 18 AS n FROM v_page GROUP BY doc_id) SELECT doc_id, CAST(unnest(CASE WHEN n <= 10 THEN range(0, n) ELSE list_transform(range(0, 10), lambda i: i * n // 10) END) AS BIGINT) AS page FROM n")
def _(v):
    n = v.v_page.groupBy("doc_id").agg((F.count("*") + 18).alias("n"))
    return n.select("doc_id", F.explode(D.even_sample(C("n"))).alias("page"))


@query("stratified_page_sample", "v_page", ", n AS (SELECT doc_id, 5 * count(*) + 40 AS n FROM v_page GROUP BY doc_id) SELECT DISTINCT doc_id, CAST(round_even(i * (n - 1) / 39, 0) AS BIGINT) AS page FROM n, range(0, 40) AS r(i)")
def _(v):
    n = v.v_page.groupBy("doc_id").agg((5 * F.count("*") + 40).alias("n"))
    return n.select("doc_id", F.explode(D.stratified_sample(C("n"), 40)).alias("page"))


@query(
    "pages_with_equations_gate", "v_page v_equation",
    """, p AS (SELECT doc_id, count(*) AS n_pages FROM v_page GROUP BY 1), e AS (SELECT doc_id, count(DISTINCT page_no) AS n_with FROM v_equation WHERE is_inline GROUP BY 1)
    SELECT p.doc_id, n_pages >= 7 AND coalesce(n_with, 0) <= 5 AS at_risk FROM p LEFT JOIN e ON p.doc_id = e.doc_id""",
)
def _(v):
    p = v.v_page.groupBy("doc_id").agg(F.count("*").alias("n_pages"))
    e = v.v_equation.where("is_inline").groupBy("doc_id").agg(F.countDistinct("page_no").alias("n_with"))
    return p.join(e, "doc_id", "left").select("doc_id", ((C("n_pages") >= 7) & (F.coalesce("n_with", F.lit(0)) <= 5)).alias("at_risk"))
