"""Queries over references, responses, visual regions and assembled blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lemmata.functions import responses as R
from lemmata.functions import scores as S
from lemmata.functions.latex import is_valid
from lemmata.operators import assembly as A

from .labels_and_latex import SQL_VALID
from .registry import query

C = F.col
KEY = ["doc_id", "seq"]


def quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


@query(
    "cross_references", "v_equation",
    rf"""SELECT doc_id, seq, len(regexp_extract_all(plain_text, '{R.REFERENCE_PROSE}')) >= 2 OR len(regexp_extract_all(latex, '{R.REFERENCE_PROSE}')) >= 2 OR regexp_matches(trim(latex), '^[a-z]{{2,}}\b')
    OR lower(regexp_extract(trim(plain_text), '^([A-Za-z]+)', 1)) IN ({quoted(R.INTRODUCES)}) AS reference FROM v_equation""",
)
def _(v):
    return v.v_equation.select(*KEY, R.is_cross_reference(C("plain_text"), C("latex")).alias("reference"))


@query("trivial_fragments", "v_equation", f"SELECT doc_id, seq, regexp_matches(plain_text, '{R.TRIVIAL.replace(chr(39), chr(39) * 2)}') AS trivial FROM v_equation")
def _(v):
    return v.v_equation.select(*KEY, R.is_trivial(C("plain_text")).alias("trivial"))


@query("mixed_blocks")
def _(v):
    block = F.concat_ws("\n", "label_raw", "plain_text", F.lit("where a is b"), "latex")
    got = R.mixed_block(block)
    return v.v_equation.select(*KEY, got["label"].alias("label"), got["formula"].alias("formula"))


@query("ocr_cut", "v_equation", r"SELECT doc_id, seq, trim(regexp_replace(plain_text, '(?i)\bEq(?:uation)?\.?\s*\d+(?:\.\d+)+', '', 'g')) AS text FROM v_equation")
def _(v):
    return v.v_equation.select(*KEY, R.clean_ocr(F.concat("plain_text", F.lit(" where: x is y"))).alias("text"))


@query(
    "representations", "v_equation",
    f"""SELECT doc_id, seq, CASE WHEN category <> 'chemical_equation' THEN latex END AS latex, trim(CASE WHEN instr(t, '=') > 0 THEN substring(t, 1, instr(t, '=') - 1) ELSE t END) AS lhs,
    CASE WHEN category <> 'chemical_equation' AND NOT ({SQL_VALID}) THEN 'invalid_latex' ELSE '' END AS flags FROM (SELECT *, CASE WHEN category = 'chemical_equation' THEN plain_text ELSE latex END AS t FROM v_equation)""",
)
def _(v):
    got = R.representation(C("latex"), C("plain_text"), C("category"), is_valid(C("latex")))
    return v.v_equation.select(*KEY, got["latex"].alias("latex"), got["lhs"].alias("lhs"), got["flags"].alias("flags"))


@query("mathml_validity")
def _(v):
    t = v.v_equation.select(*KEY, F.when(C("seq") % 3 == 0, F.concat(F.lit("<math><mi>"), "page_no", F.lit("</mi></math>"))).otherwise(C("latex")).alias("m"))
    return t.select(*KEY, R.is_mathml("m").alias("valid"))


@query("region_text", "v_equation", "SELECT doc_id, seq, coalesce(nullif(trim(plain_text), ''), nullif(trim(latex), ''), nullif(trim(label_raw), ''), '') AS text FROM v_equation")
def _(v):
    return v.v_equation.select(*KEY, R.region_text(C("plain_text"), C("latex"), C("label_raw")).alias("text"))


@query("judge_responses")
def _(v):
    accepted = F.when(C("seq") % 2 == 0, "true").otherwise("false")
    said = (
        F.when(C("seq") % 4 == 0, F.concat(F.lit('```json {"accepted": '), accepted, F.lit(', "score": 0.4, "why": "\\alpha"} ```')))
        .when(C("seq") % 4 == 1, F.concat(F.lit("It is "), accepted, F.lit(" at 0.35")))
        .otherwise(F.concat(F.lit("looks "), accepted))
    )
    got = R.verdict(said)
    return v.v_equation.select(*KEY, got["accepted"].alias("accepted"), got["score"].alias("score"))


@query(
    "quads_to_boxes", "v_box",
    "SELECT doc_id, page_no, box_seq, least(x0, x1 + 2) AS qx0, least(y0, y1 - 1) AS qy0, greatest(x1, x0 + 1, x1 + 2) AS qx1, greatest(y1, y0) AS qy1 FROM v_box",
)
def _(v):
    corner = lambda x, y: F.array(x, y)
    quad = F.array(corner(C("x0"), C("y0")), corner(C("x1") + 2, C("y1") - 1), corner(C("x1"), C("y1")), corner(C("x0") + 1, C("y1")))
    return v.v_box.select("doc_id", "page_no", "box_seq", R.quad_box(quad).alias("q")).select("doc_id", "page_no", "box_seq", *[C(f"q.{c}").alias(f"q{c}") for c in ("x0", "y0", "x1", "y1")])


VISUAL_CASE = " ".join(f"WHEN regexp_matches(h, '{cue}') THEN '{name}'" for name, cue in R.VISUAL_CUES)
CAPTION = "CASE seq % 9 WHEN 0 THEN 'Bar chart of flow' WHEN 1 THEN 'wiring of a resistor' WHEN 2 THEN 'Location map' WHEN 3 THEN 'SEM image of a specimen' WHEN 4 THEN 'block diagram' WHEN 5 THEN 'exploded view' WHEN 6 THEN '' ELSE 'Figure 3' END"


@query(
    "visual_category", "v_equation",
    f"""SELECT doc_id, seq, CASE WHEN seq % 13 = 0 THEN 'composite_figure' WHEN seq % 17 = 0 THEN 'map' {VISUAL_CASE} WHEN is_inline THEN 'photograph' ELSE 'figure' END AS visual,
    CASE WHEN seq % 13 = 0 THEN 0.85 WHEN seq % 17 = 0 THEN 0.9 WHEN {' OR '.join(f"regexp_matches(h, '{c}')" for _, c in R.VISUAL_CUES)} THEN 0.8 WHEN is_inline THEN 0.6 ELSE 0.55 END AS confidence
    FROM (SELECT *, concat({CAPTION}, chr(10), plain_text) AS h FROM v_equation)""",
)
def _(v):
    got = R.visual_category(F.expr(CAPTION), C("plain_text"), F.when(C("seq") % 17 == 0, "map"), C("seq") % 13 == 0, C("is_inline"))
    return v.v_equation.select(*KEY, got["category"].alias("visual"), got["confidence"].alias("confidence"))


@query("report_quality")
def _(v):
    t = v.v_equation.select(*KEY, R.report_quality(C("latex")).alias("score"))
    return t.withColumn("grade", F.when(C("score") >= 0.75, "good").when(C("score") >= 0.5, "warn").otherwise("fail"))


@query(
    "worker_confidence", "v_equation",
    r"SELECT doc_id, seq, CASE WHEN trim(latex) = '' THEN 0.0 WHEN regexp_matches(lower(latex), 'mathrm|mathsf|mathtt|text\{|mbox\{|hbox\{') THEN 0.3 WHEN regexp_matches(latex, '[\\{}_^]|frac|sum|int|sqrt|lim|cdot') THEN 0.9 ELSE 0.6 END AS confidence FROM v_equation",
)
def _(v):
    return v.v_equation.select(*KEY, R.worker_confidence(C("latex")).alias("confidence"))


@query(
    "older_status", "v_equation",
    """SELECT doc_id, seq, CASE WHEN flag = 'duplicate' THEN 'PARTIAL' WHEN trim(latex) = '' THEN 'FAILED' WHEN confidence < 0.5 THEN 'LOW_CONFIDENCE' ELSE 'SUCCESS' END AS status,
    CASE WHEN flag = 'invalid_latex' THEN 'FAIL' WHEN seq % 5 = 0 THEN 'WARNING' ELSE 'PASS' END AS crop FROM v_equation""",
)
def _(v):
    flags = F.array(F.when(C("flag") == "duplicate", "broken_multiline").when(C("flag") == "invalid_latex", "invalid_bbox").otherwise("none"))
    notes = F.array(F.when(F.trim("latex") == "", "recognition_failed: empty").otherwise(""), F.when(C("seq") % 5 == 0, "crop_touch:left").otherwise(""))
    return v.v_equation.select(*KEY, R.older_status(flags, notes, C("confidence")).alias("status"), R.crop_status(flags, notes).alias("crop"))


@query(
    "image_dimensions", "v_box",
    """SELECT doc_id, page_no, box_seq, CAST(greatest(1, floor((x1 - x0) * 20 * least(1.0, 1600 / greatest((x1 - x0) * 20, (y1 - y0) * 20)))) AS BIGINT) AS w, CAST(greatest(1, floor((y1 - y0) * 20 * least(1.0, 1600 / greatest((x1 - x0) * 20, (y1 - y0) * 20)))) AS BIGINT) AS h,
    CASE WHEN x1 - x0 > y1 - y0 THEN 'landscape' WHEN x1 - x0 < y1 - y0 THEN 'portrait' ELSE 'square' END AS orientation FROM v_box""",
)
def _(v):
    w, h = (C("x1") - C("x0")) * 20, (C("y1") - C("y0")) * 20
    sw, sh = R.scaled_size(w, h)
    return v.v_box.select("doc_id", "page_no", "box_seq", sw.alias("w"), sh.alias("h"), R.orientation(w, h).alias("orientation"))


@query("row_fragments_merged")
def _(v):
    return A.merge_rows(v.v_box)


@query("grown_regions")
def _(v):
    text = F.when(C("kind") == 0, "x = 1").otherwise("y + 2")
    return A.grow(v.v_box.withColumn("text", text).withColumn("is_seed", C("kind") == 0).drop("kind"))


@query("inline_spans")
def _(v):
    t = v.dealt("v_equation").select(*KEY, F.concat_ws(" ", F.lit("we have"), "plain_text", F.lit("so that"), "latex").alias("text"))
    return A.inline_spans(t, "text", S.INLINE + r"|[=+^_\\]", S.PROSE).select(*KEY, "span_no", "span")
