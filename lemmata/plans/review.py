"""Queries over repair, recovery, clean-up, bake-off, sidecars, label anchors and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lemmata.functions import responses as R
from lemmata.operators import review as V

from .labels_and_latex import SQL_EXPECTED, SQL_NUMBERS, SQL_VALID, numbers
from .registry import query

C = F.col
KEY = ["doc_id", "seq"]


@query(
    "judge_repair", "v_equation",
    """, t AS (SELECT *, confidence >= 0.7 AS accepted, seq % 7 <> 0 AS crop_valid, CASE seq % 3 WHEN 0 THEN latex WHEN 1 THEN concat(' ', latex, ' = 0 ') ELSE '' END AS corrected FROM v_equation),
    r AS (SELECT *, NOT accepted AND crop_valid AND trim(corrected) <> '' AND trim(corrected) <> trim(latex) AND seq % 5 <> 0 AS repaired FROM t)
    SELECT doc_id, seq, CASE WHEN repaired THEN trim(corrected) ELSE latex END AS latex, round(CASE WHEN repaired THEN least(0.99, greatest(confidence, seq % 100 / 100) + 0.01) ELSE confidence END, 6) AS confidence,
    CASE WHEN repaired THEN CASE WHEN seq % 2 = 0 THEN 'judge_a' ELSE 'judge_repair' END ELSE provider END AS provider, accepted OR repaired AS accepted, repaired FROM r""",
)
def _(v):
    corrected = F.when(C("seq") % 3 == 0, C("latex")).when(C("seq") % 3 == 1, F.concat(F.lit(" "), "latex", F.lit(" = 0 "))).otherwise("")
    t = v.v_equation.select(*KEY, "latex", "confidence", "provider", (C("confidence") >= 0.7).alias("accepted"), (C("seq") % 7 != 0).alias("crop_valid"), corrected.alias("corrected"))
    judge = lambda _: (C("seq") % 5 != 0, C("seq") % 100 / 100, F.when(C("seq") % 2 == 0, "judge_a"))
    return V.repaired(t, judge).select(*KEY, "latex", F.round("confidence", 6).alias("confidence"), "provider", "accepted", "repaired")


@query(
    "reextract_union", "v_box v_page",
    """, k AS (SELECT * FROM v_box WHERE kind = 0), s AS (SELECT b.* FROM v_box b SEMI JOIN (SELECT doc_id, page_no FROM v_page WHERE char_count % 3 = 0) p ON b.doc_id = p.doc_id AND b.page_no = p.page_no WHERE kind = 1 AND box_seq % 4 <> 0),
    c AS (SELECT DISTINCT s.doc_id, s.page_no, s.box_seq FROM s JOIN k ON s.doc_id = k.doc_id AND s.page_no = k.page_no WHERE greatest(least(s.x1, k.x1) - greatest(s.x0, k.x0), 0) * greatest(least(s.y1, k.y1) - greatest(s.y0, k.y0), 0)
      >= 0.1 * ((s.x1 - s.x0) * (s.y1 - s.y0) + (k.x1 - k.x0) * (k.y1 - k.y0) - greatest(least(s.x1, k.x1) - greatest(s.x0, k.x0), 0) * greatest(least(s.y1, k.y1) - greatest(s.y0, k.y0), 0)))
    SELECT doc_id, page_no, box_seq, CAST(NULL AS DOUBLE) AS confidence, 'first_pass' AS source FROM k UNION ALL
    SELECT s.doc_id, s.page_no, s.box_seq, 0.75, 'vlm_page_extract' FROM s ANTI JOIN c ON s.doc_id = c.doc_id AND s.page_no = c.page_no AND s.box_seq = c.box_seq""",
)
def _(v):
    seeds = v.v_box.where("kind = 1").withColumn("text", F.when(C("box_seq") % 4 == 0, " ").otherwise("x = 1"))
    return V.recovered(v.v_page.where("char_count % 3 = 0"), v.v_box.where("kind = 0"), seeds, 0.1)


_T = f"regexp_matches(plain_text, '{R.TRIVIAL.replace(chr(39), chr(39) * 2)}')"
SQL_CLEANED = f""", e AS (SELECT *, is_inline AND {_T} AS gone, seq % 97 = 0 AS failed, CASE WHEN seq % 13 = 0 THEN 'unsupported_category' ELSE flag END AS own_flag FROM v_equation),
    p AS (SELECT doc_id, page_no, count(*) AS n_before, count(*) FILTER (NOT gone) AS n_kept, CASE WHEN bool_or(failed) THEN 'degraded' WHEN count(*) FILTER (NOT gone) = 0 THEN 'empty'
      WHEN count(*) FILTER (NOT gone AND own_flag = 'unsupported_category') > 0 THEN 'partial' ELSE 'extracted' END AS outcome FROM e GROUP BY ALL)"""


def sidecars(v):
    t = v.v_equation.withColumn("failed", C("seq") % 97 == 0).withColumn("flag", F.when(C("seq") % 13 == 0, "unsupported_category").otherwise(C("flag")))
    return V.cleaned(t, R.is_trivial(C("plain_text")))


@query("sidecar_pages_cleaned", "v_equation", SQL_CLEANED + " SELECT doc_id, page_no, n_before, n_kept, outcome FROM p")
def _(v):
    return sidecars(v)[0]


@query(
    "sidecar_documents_cleaned", "v_equation",
    SQL_CLEANED + """, k AS (SELECT doc_id, count(*) FILTER (trim(latex) <> '' AND own_flag <> 'invalid_latex') AS n_latex_valid, count(*) FILTER (confidence < 0.5) AS n_low, count(*) FILTER (own_flag <> '') AS n_flagged FROM e WHERE NOT gone GROUP BY doc_id),
    d AS (SELECT doc_id, CAST(sum(n_before) AS BIGINT) AS n_before, CAST(sum(n_kept) AS BIGINT) AS n_kept, count(*) FILTER (outcome = 'degraded') AS n_failures FROM p GROUP BY doc_id)
    SELECT d.doc_id, n_before, n_kept, n_failures, coalesce(n_latex_valid, 0) AS n_latex_valid, coalesce(n_low, 0) AS n_low, coalesce(n_flagged, 0) AS n_flagged,
    CASE WHEN n_failures > 0 THEN 'degraded' WHEN n_kept = 0 THEN 'empty' ELSE 'extracted' END AS outcome FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
)
def _(v):
    return sidecars(v)[1]


@query(
    "detector_bakeoff", "v_equation v_expected",
    f""", {SQL_NUMBERS}, {SQL_EXPECTED}, kept AS (SELECT doc_id, number, seq % 3 <> 0 AS det FROM detected), c AS (SELECT doc_id, count(*) AS n_crops, count(*) FILTER (det) AS n_detector FROM kept GROUP BY doc_id),
    l AS (SELECT doc_id, number, bool_or(det) AS det FROM kept GROUP BY ALL), g AS (SELECT x.doc_id, count(*) AS n_gold, count(det) AS n_hit, count(*) FILTER (det) AS n_via_detector
      FROM (SELECT DISTINCT doc_id, number FROM expected) x LEFT JOIN l ON x.doc_id = l.doc_id AND x.number = l.number GROUP BY x.doc_id)
    SELECT coalesce(c.doc_id, g.doc_id) AS doc_id, coalesce(n_crops, 0) AS n_crops, coalesce(n_detector, 0) AS n_detector, coalesce(n_gold, 0) AS n_gold, coalesce(n_hit, 0) AS n_hit, coalesce(n_via_detector, 0) AS n_via_detector,
    coalesce(n_hit, 0) - coalesce(n_via_detector, 0) AS n_via_fallback, CASE WHEN n_gold > 0 THEN round(n_hit / n_gold, 4) END AS recall FROM c FULL JOIN g ON c.doc_id = g.doc_id""",
)
def _(v):
    from lemmata.functions import labels as L

    kept = numbers(v).select("doc_id", C("number").alias("label"), F.when(C("seq") % 3 != 0, "detector").otherwise("label_fallback").alias("source"))
    return V.bakeoff(kept, v.v_expected.select("doc_id", L.normalise_number(C("label_raw")).alias("label")), ["detector"])


@query(
    "sidecar_envelope", "v_equation",
    f"""SELECT doc_id, '1.0' AS version, 'success' AS outcome, count(*) AS n_items, arg_min(equation_id, seq) AS first_id, count(DISTINCT page_no) AS total_pages,
    count(*) FILTER ({SQL_VALID}) AS latex_valid, 'eq_label_extractor_v1' AS config_hash FROM v_equation GROUP BY doc_id""",
)
def _(v):
    t = V.envelope(v.v_equation)
    items = F.size("equations").cast("long").alias("n_items")
    return t.select("doc_id", "version", "outcome", items, C("equations")[0]["equation_id"].alias("first_id"), "statistics.total_pages", "statistics.latex_valid", "config_hash")


@query(
    "label_anchor", "v_box",
    """, b AS (SELECT doc_id, page_no, box_seq, concat(page_no, '.', box_seq % 9) AS label, x0, y0, x1, y1, kind FROM v_box),
    l AS (SELECT doc_id, page_no, box_seq, unnest(range(0, 3)) AS line_no, label, x0, y0, x1, y1, kind FROM b),
    f AS (SELECT doc_id, page_no, box_seq, min(line_no) AS k FROM l WHERE line_no >= 1 AND kind <> 3 GROUP BY ALL)
    SELECT b.doc_id, b.page_no, b.box_seq, label, k IS NOT NULL AS by_line, CASE WHEN k IS NULL THEN x0 ELSE x0 + 5 * k END AS x0, CASE WHEN k IS NULL THEN y0 ELSE y0 + (y1 - y0) / 3 * k END AS y0, x1,
    CASE WHEN k IS NULL THEN y1 ELSE y0 + (y1 - y0) / 3 * (k + 1) END AS y1 FROM b LEFT JOIN f ON b.doc_id = f.doc_id AND b.page_no = f.page_no AND b.box_seq = f.box_seq""",
)
def _(v):
    box = v.v_box.select("doc_id", "page_no", "box_seq", F.concat("page_no", F.lit("."), C("box_seq") % 9).alias("label"), "x0", "y0", "x1", "y1", "kind")
    third, k = (C("y1") - C("y0")) / 3, C("line_no")
    lines = box.withColumn("line_no", F.explode(F.array(*map(F.lit, range(3))))).withColumn("label", F.when((k >= 1) & (C("kind") != 3), C("label")).otherwise("other"))
    lines = lines.select("doc_id", "page_no", "box_seq", "line_no", "label", (C("x0") + 5 * k).alias("x0"), (C("y0") + third * k).alias("y0"), "x1", (C("y0") + third * (k + 1)).alias("y1"))
    return V.label_anchors(box.drop("kind"), lines)


@query(
    "leading_words", "v_equation",
    """SELECT doc_id, seq, CASE WHEN seq % 3 <> 2 AND plain_text <> '' AND plain_text <> ' ' THEN 100.0 + CASE seq % 3 WHEN 0 THEN 6 ELSE 6 END * 4.5 END AS x0 FROM v_equation""",
)
def _(v):
    word = F.when(C("seq") % 3 == 0, "Where ").when(C("seq") % 3 == 1, "hence ").otherwise("F = ")
    return v.v_equation.select(*KEY, V.text_start(F.concat(word, "plain_text"), F.lit(100.0), 4.5).alias("x0"))


@query(
    "prompt_selection", "v_equation",
    """SELECT doc_id, seq, CASE WHEN is_inline AND category = 'chemical_equation' THEN 'strict chemistry' WHEN category = 'chemical_equation' THEN 'chemistry' WHEN category = 'mathematical_equation' THEN 'maths' ELSE 'any' END AS prompt FROM v_equation""",
)
def _(v):
    prompts = {"mathematical_equation": "maths", "chemical_equation": "chemistry", "unknown": "any"}
    return v.v_equation.select(*KEY, V.prompt_for(C("category"), prompts, {"chemical_equation": "strict chemistry"}, C("is_inline")).alias("prompt"))
