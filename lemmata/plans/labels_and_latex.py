"""Queries over labels, LaTeX text and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from lemmata.functions import labels as L
from lemmata.functions import latex as X
from lemmata.functions import scores as S
from lemmata.operators import evaluation as E

from .registry import query

C = F.col
KEY = ["doc_id", "seq"]
#: Oracle form of the label normaliser.
NORM = "translate(regexp_replace(label_raw, '\\s+', '', 'g'), 'lIO', '110')"
NUMBER = r"lower(replace(regexp_replace(regexp_replace({}, '(\d\.)l', '\11', 'g'), '^[()\[\]{{}} \t]+|[()\[\]{{}} \t]+$', '', 'g'), ' ', ''))"


def numbers(v):
    plain = F.regexp_replace(L.normalise_label("label_raw"), r"(?i)^Eq\.?", "")
    return v.v_equation.where("label_raw <> ''").select(*KEY, "page_no", L.normalise_number(plain).alias("number"))


SQL_NUMBERS = f"detected AS (SELECT doc_id, seq, page_no, {NUMBER.format('regexp_replace(' + NORM + chr(44) + chr(39) + '(?i)^Eq' + chr(92) + '.?' + chr(39) + chr(44) + chr(39) * 2 + ')')} AS number FROM v_equation WHERE label_raw <> '')"
SQL_EXPECTED = f"expected AS (SELECT doc_id, {NUMBER.format('label_raw')} AS number FROM v_expected)"


@query("label_normalise", "v_equation", f"SELECT doc_id, seq, {NORM} AS label FROM v_equation")
def _(v):
    return v.v_equation.select(*KEY, L.normalise_label(C("label_raw")).alias("label"))


@query("number_normalise", "v_expected", f"SELECT doc_id, label_raw, {NUMBER.format('label_raw')} AS number FROM v_expected")
def _(v):
    return v.v_expected.select("doc_id", "label_raw", L.normalise_number(C("label_raw")).alias("number"))


def outcomes(v):
    expected = v.v_expected.select("doc_id", L.normalise_number(C("label_raw")).alias("number"))
    return E.compare_sets(numbers(v), expected)


SQL_OUTCOMES = f""", {SQL_NUMBERS}, {SQL_EXPECTED}, o AS (
SELECT coalesce(d.doc_id, e.doc_id) AS doc_id, coalesce(d.number, e.number) AS number,
  CASE WHEN d.number IS NULL THEN 'missed' WHEN e.number IS NULL THEN 'spurious' ELSE 'matched' END AS outcome
FROM (SELECT DISTINCT doc_id, number FROM detected) d FULL JOIN (SELECT DISTINCT doc_id, number FROM expected) e ON d.doc_id = e.doc_id AND d.number = e.number)"""
SQL_RATES = """, r AS (SELECT {by} count(*) FILTER (outcome = 'matched') AS tp, count(*) FILTER (outcome <> 'spurious') AS n_expected,
  count(*) FILTER (outcome <> 'missed') AS n_detected FROM o {group}), p AS (
  SELECT *, CASE WHEN n_expected > 0 THEN tp / n_expected ELSE 0.0 END AS recall, CASE WHEN n_detected > 0 THEN tp / n_detected ELSE 0.0 END AS precision FROM r)
SELECT *, CASE WHEN recall + precision > 0 THEN 2 * recall * precision / (recall + precision) ELSE 0.0 END AS f1 FROM p"""


@query("evaluation_by_document", "v_equation v_expected", SQL_OUTCOMES + SQL_RATES.format(by="doc_id,", group="GROUP BY doc_id"))
def evaluation(v):
    return E.rates(outcomes(v), ["doc_id"])


@query("evaluation_micro_average", "v_equation v_expected", SQL_OUTCOMES + SQL_RATES.format(by="", group=""))
def _(v):
    return E.rates(outcomes(v), [])


@query("evaluation_outcomes", "v_equation v_expected", SQL_OUTCOMES + " SELECT * FROM o")
def _(v):
    return outcomes(v)


@query("labels_intersect", "v_equation v_expected", f", {SQL_NUMBERS}, {SQL_EXPECTED} SELECT doc_id, number FROM detected INTERSECT SELECT doc_id, number FROM expected")
def _(v):
    return numbers(v).select("doc_id", "number").intersect(v.v_expected.select("doc_id", L.normalise_number(C("label_raw")).alias("number")))


@query("labels_except", "v_equation v_expected", f", {SQL_NUMBERS}, {SQL_EXPECTED} SELECT doc_id, number FROM expected EXCEPT SELECT doc_id, number FROM detected")
def _(v):
    return v.v_expected.select("doc_id", L.normalise_number(C("label_raw")).alias("number")).subtract(numbers(v).select("doc_id", "number"))


@query("label_first_wins", "v_equation", f", {SQL_NUMBERS} SELECT doc_id, number, min(seq) AS seq, arg_min(page_no, seq) AS page_no FROM detected GROUP BY doc_id, number")
def _(v):
    return E.first_wins(numbers(v), ["doc_id", "number"], ["seq"]).select("doc_id", "number", "seq", "page_no")


@query("equation_ids", "v_equation", "SELECT doc_id, seq, concat_ws('_', 'eq', CAST(seq - 1 AS VARCHAR), CAST(page_no AS VARCHAR), nullif(regexp_replace(label_raw, '[^A-Za-z0-9_.-]+', '_', 'g'), '')) AS id FROM v_equation")
def _(v):
    label = F.nullif(L.safe_id(C("label_raw")), F.lit(""))
    return v.v_equation.select(*KEY, F.concat_ws("_", F.lit("eq"), (C("seq") - 1).cast("string"), C("page_no").cast("string"), label).alias("id"))


@query(
    "label_arbitration", "v_equation",
    f""", {SQL_NUMBERS}, d AS (SELECT DISTINCT doc_id, number AS label, page_no % 4 = 0 AS explicit FROM detected),
    n AS (SELECT doc_id, count(*) FILTER (explicit) AS ne, count(*) FILTER (NOT explicit) AS no FROM d GROUP BY doc_id),
    c AS (SELECT doc_id, label, count(*) OVER (PARTITION BY doc_id, regexp_extract(label, '^([^.\\-]*)', 1)) AS k FROM d WHERE NOT explicit)
    SELECT c.doc_id, label FROM c JOIN n ON c.doc_id = n.doc_id WHERE k >= 2 AND NOT (ne >= 3 AND ne >= no)""",
)
def _(v):
    return E.arbitrate(numbers(v).select("doc_id", C("number").alias("label"), (C("page_no") % 4 == 0).alias("explicit")))


@query("label_multiset_match")
def _(v):
    x = numbers(v).select("doc_id", C("number").alias("label"))
    e = v.v_expected.select("doc_id", F.regexp_replace("label_raw", r"^\(|\)$", "").alias("label"))
    return E.multiset_match(x, e).groupBy("doc_id").agg(F.count("*").alias("n_expected"), F.count_if("matched").alias("n_matched"))


@query("label_definitions")
def _(v):
    text = F.concat("latex", F.lit("  "), "label_raw")
    found = v.v_equation.select(*KEY, F.explode(L.label_matches(text)).alias("m"))
    return found.select(*KEY, "m.label", "m.explicit")


@query(
    "label_pages", "v_equation",
    f", {SQL_NUMBERS} SELECT doc_id, number, min(page_no) AS first_page, count(DISTINCT page_no) AS n_pages FROM detected GROUP BY doc_id, number",
)
def _(v):
    return numbers(v).groupBy("doc_id", "number").agg(F.min("page_no").alias("first_page"), F.countDistinct("page_no").alias("n_pages"))


BOX_TEXT = "CASE seq % 4 WHEN 0 THEN concat('[', page_no, '.', seq % 9 + 1, ']') WHEN 1 THEN concat(' (', page_no, '.', seq % 9 + 1, ') ') WHEN 2 THEN concat(page_no, '.5') ELSE 'x = 1' END"


@query(
    "label_whole_box", "v_equation",
    f"""SELECT doc_id, seq, coalesce(nullif(regexp_extract(t, '{L.PAREN_BOX}', 1), ''), nullif(regexp_extract(t, '{L.BRACKET_BOX}', 1), '')) AS label,
    coalesce(nullif(regexp_extract(t, '{L.PAREN_BOX}', 1), ''), nullif(regexp_extract(t, '{L.BRACKET_BOX}', 1), ''), nullif(regexp_extract(t, '{L.BARE_BOX}', 1), '')) AS with_bare
    FROM (SELECT doc_id, seq, {BOX_TEXT} AS t FROM v_equation)""",
)
def _(v):
    t = v.v_equation.select(*KEY, F.expr(BOX_TEXT).alias("t"))
    return t.select(*KEY, L.box_label(C("t")).alias("label"), L.box_label(C("t"), True).alias("with_bare"))


@query(
    "label_number_with_letter", "v_equation",
    r"""SELECT doc_id, seq, CASE WHEN regexp_extract(label_raw, '(\d+(?:\.\d+)+)', 1) = '' THEN NULL ELSE
    concat(regexp_extract(label_raw, '(\d+(?:\.\d+)+)', 1), regexp_extract(label_raw, '\d+(?:\.\d+)+\s*\(\s*([a-z])\s*\)', 1)) END AS number FROM v_equation""",
)
def _(v):
    return v.v_equation.select(*KEY, L.label_number(C("label_raw")).alias("number"))


def sql_replace(x: str, steps) -> str:
    for p, by in steps:
        x = f"regexp_replace({x}, '{p}', '{by.replace('$', chr(92))}', 'g')"
    return x


SQL_NORMAL = "regexp_replace(" + sql_replace("coalesce({}, '')", X.NORMALISE).replace("{", "{{").replace("}", "}}").replace("{{}}", "{}", 1) + r", '([_^])\{{([A-Za-z0-9])\}}', '\1\2', 'g')"
SQL_LATEX = SQL_NORMAL.format("latex")


@query("latex_normalise", "v_equation", f"SELECT doc_id, seq, {SQL_LATEX} AS latex FROM v_equation")
def _(v):
    return v.v_equation.select(*KEY, X.normalise(C("latex")).alias("latex"))


@query(
    "latex_tokens", "v_equation",
    f"SELECT doc_id, seq, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens FROM (SELECT doc_id, seq, regexp_extract_all({SQL_LATEX}, '{X.TOKEN}') AS t FROM v_equation)",
)
def _(v):
    t = v.v_equation.select(*KEY, X.tokens(C("latex")).alias("t"))
    return t.select(*KEY, F.size("t").cast("long").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query(
    "latex_similarity", "v_equation",
    f"""SELECT doc_id, seq, CASE WHEN a = b THEN 1.0 ELSE 0.0 END AS exact,
    CASE WHEN greatest(length(a), length(b)) = 0 THEN 1.0 ELSE 1.0 - levenshtein(a, b) / greatest(length(a), length(b)) END AS similarity
    FROM (SELECT doc_id, seq, {SQL_LATEX} AS a, {SQL_NORMAL.format("plain_text")} AS b FROM v_equation)""",
)
def _(v):
    return v.v_equation.select(*KEY, X.exact_match(C("latex"), C("plain_text")).alias("exact"), X.edit_similarity(C("latex"), C("plain_text")).alias("similarity"))


def sql_count(what: str) -> str:
    return f"(length(latex) - length(replace(latex, '{what}', ''))) / {len(what)}"


SQL_VALID = f"trim(latex) <> '' AND {sql_count('{')} = {sql_count('}')} AND {sql_count(chr(92) + 'begin{')} = {sql_count(chr(92) + 'end{')}"


@query("latex_validity", "v_equation", f"SELECT doc_id, seq, {SQL_VALID} AS valid FROM v_equation")
def _(v):
    return v.v_equation.select(*KEY, X.is_valid(C("latex")).alias("valid"))


@query(
    "latex_structured_form", "v_equation",
    """SELECT doc_id, seq, trim(CASE WHEN instr(latex, '=') > 0 THEN substring(latex, 1, instr(latex, '=') - 1) ELSE latex END) AS lhs,
    CASE WHEN instr(latex, '=') > 0 THEN trim(substring(latex, instr(latex, '=') + 1)) END AS rhs FROM v_equation""",
)
def _(v):
    return v.v_equation.select(*KEY, X.structured_form(C("latex")).alias("f")).select(*KEY, "f.lhs", "f.rhs")


SQL_CLEAN = sql_replace(
    "latex",
    [(r"```(?:latex|tex)?", ""), (r"\\begin\{(?:equation|displaymath|align|gather)\*?\}|\\end\{(?:equation|displaymath|align|gather)\*?\}", ""), (r"\$\$", ""), (r"\\\[|\\\]", "\n"), (r"\n{3,}", "\n\n"), (r"^\s+|\s+$", "")],
)


@query("latex_clean", "v_equation", rf"SELECT doc_id, seq, CASE WHEN regexp_matches(y, '^\$[^$]*\$$') THEN regexp_replace(y, '^\$|\$$', '', 'g') ELSE y END AS latex FROM (SELECT doc_id, seq, {SQL_CLEAN} AS y FROM v_equation)")
def _(v):
    return v.v_equation.select(*KEY, X.clean(C("latex")).alias("latex"))


@query(
    "latex_unwrap", "v_equation",
    r"""SELECT doc_id, seq, coalesce(nullif(trim(regexp_extract(latex, '(?s)\$\$(.+?)\$\$', 1)), ''), nullif(trim(regexp_extract(latex, '(?s)\$(.+?)\$', 1)), ''), trim(latex)) AS latex FROM v_equation""",
)
def _(v):
    return v.v_equation.select(*KEY, X.unwrap(C("latex")).alias("latex"))


@query("latex_postprocess")
def _(v):
    return v.v_equation.select(*KEY, X.postprocess(F.concat("plain_text", F.lit(" sqrt(x) Eq. 1.2"))).alias("latex"))


@query(
    "meaningful_text", "v_equation",
    r"SELECT doc_id, seq, contains(trim(plain_text), chr(10)) OR regexp_matches(trim(plain_text), '[=<>+*/^_]|->|\\(?:frac|sum|int|sqrt)') OR regexp_matches(trim(plain_text), '\S\s+\S') AS meaningful FROM v_equation",
)
def _(v):
    return v.v_equation.select(*KEY, X.is_meaningful(C("plain_text")).alias("meaningful"))


def sql_n(x: str, p: str) -> str:
    return f"len(regexp_extract_all({x}, '{p}'))"


MATHS = "category IN ('mathematical_equation', 'engineering_formula', 'statistical_expression')"
SQL_QUALITY = rf"""
, t AS (SELECT *, trim(latex) AS t, {MATHS} AS m FROM v_equation),
u AS (SELECT *, m AND {sql_n('t', S.QUALITY_PROSE)} >= 2 AND NOT regexp_matches(t, '{S.RELATION}') AS prose, trim(regexp_replace(t, '\\tag\s*\{{[^}}]*\}}', '', 'g')) AS body FROM t),
c AS (SELECT *, m AND NOT prose AND len(list_filter(regexp_extract_all(t, '\\text\{{([^}}]*)\}}', 1), lambda b: {sql_n('b', S.CONNECTIVE)} >= 2)) > 0 AS in_text,
  length(regexp_replace(t, '\\[a-zA-Z]+|\s', '', 'g')) < 3 AS short, {sql_n('t', chr(92) * 2 + 'tag' + chr(92) + 'b')} >= 2 AS tags, regexp_matches(body, '^\s*(?:\\[a-zA-Z]+\s*)?=') AS clipped FROM u)
SELECT doc_id, seq, CASE WHEN category = 'chemical_equation' THEN CASE WHEN trim(plain_text) <> '' THEN 0.85 ELSE 0.0 END
  WHEN t = '' THEN 0.1 WHEN m AND regexp_matches(t, '{S.SPACED}') THEN 0.1 WHEN regexp_matches(t, '{S.LABEL_ONLY}') THEN 0.1
  ELSE least(0.85, CASE WHEN prose THEN 0.2 ELSE 1 END, CASE WHEN in_text OR short THEN 0.3 ELSE 1 END, CASE WHEN tags OR clipped THEN 0.35 ELSE 1 END,
    CASE WHEN m AND NOT clipped AND NOT regexp_matches(body, '{S.RELATION}') THEN 0.45 ELSE 1 END) END AS score FROM c"""


def quality(v):
    return S.recognition_quality(C("latex"), C("plain_text"), C("category"))


@query("recognition_quality", "v_equation", SQL_QUALITY)
def _(v):
    return v.v_equation.select(*KEY, quality(v)["score"].alias("score"))


@query("recognition_quality_notes")
def _(v):
    t = v.v_equation.select(*KEY, F.explode(quality(v)["notes"]).alias("note"))
    retry = ["label_only", "prose_contamination", "prose_in_text_block", "spaced_text", "multiple_tags", "multiple_equations"]
    return t.groupBy("note").agg(F.count("*").alias("n")).withColumn("forces_retry", C("note").isin(*[f"quality:{x}" for x in retry]))


SQL_TEXT_RATIO = f"{sql_n('latex', S.TEXT_BLOCK)} / greatest({sql_n('latex', S.ANY_TOKEN)}, 1)"


@query(
    "recognition_confidence", "v_equation",
    rf"""SELECT doc_id, seq, CASE WHEN trim(latex) = '' THEN 0.1 ELSE greatest(0.0, least(1.0, 0.85 - CASE WHEN {SQL_TEXT_RATIO} > 0.5 THEN 0.2 ELSE 0 END
    - CASE WHEN NOT regexp_matches(latex, '\\[a-zA-Z]') THEN 0.25 ELSE 0 END - CASE WHEN length(trim(latex)) > 4 AND NOT regexp_matches(latex, '{S.RELATION}') THEN 0.15 ELSE 0 END
    - CASE WHEN regexp_matches(latex, '^\s*.\s*$') THEN 0.3 ELSE 0 END)) END AS confidence FROM v_equation""",
)
def _(v):
    return v.v_equation.select(*KEY, F.round(S.recognition_confidence(C("latex")), 6).alias("confidence"))


@query(
    "confidence_from_logprobs", "",
    """SELECT vec_id, greatest(0, least(1, 0.5 * exp(list_sum(l) / len(l)) + 0.3 * (1 - len(list_filter(l, lambda x: exp(x) < 0.4)) / len(l)) + 0.2 * least(exp(list_min(l)) / 0.3, 1.0))) AS confidence
    FROM (SELECT vec_id, list_transform(embedding, lambda x: -abs(CAST(x AS DOUBLE))) AS l FROM embeddings)""",
)
def _(v):
    t = v.embeddings.select("vec_id", F.transform("embedding", lambda x: -F.abs(x.cast("double"))).alias("l"))
    return t.select("vec_id", S.confidence_from_logprobs(C("l")).alias("confidence"))


SQL_OCR = r""", t AS (SELECT doc_id, seq, latex, regexp_extract_all(latex, '\\[a-zA-Z]+|\S') AS toks, regexp_extract_all(latex, '\\text\{[^}]*\}') AS blocks FROM v_equation),
    u AS (SELECT *, len(list_filter(regexp_extract_all(latex, '\\[a-zA-Z]+'), lambda x: NOT starts_with(x, '\text'))) > 0 AS commands, len(blocks) / greatest(len(toks), 1) AS ratio FROM t),
    k AS (SELECT doc_id, seq, latex, [CASE WHEN len(blocks) > 0 AND NOT commands THEN 'ALL_TEXT_NO_MATH' END, CASE WHEN regexp_matches(latex, '^\s*=') THEN 'STARTS_WITH_EQUALS' END,
      CASE WHEN regexp_matches(latex, '(?:^|[^\\a-zA-Z])[+\-*/]{2,}') THEN 'REPEATED_OPERATOR' END, CASE WHEN regexp_matches(latex, '(?:\\times|\\cdot|\\div|\\pm|[+\-*/])\s*$') THEN 'DANGLING_OPERATOR' END,
      CASE WHEN len(list_filter(range(1, len(toks) - 1), lambda i: toks[i] = toks[i + 1] AND toks[i] = toks[i + 2] AND regexp_matches(toks[i], '^\\[a-zA-Z]'))) > 0 THEN 'REPEATED_SYMBOL' END,
      CASE WHEN regexp_matches(latex, '[×÷∑∏∫√≤≥≠≈∞∂∇]') THEN 'UNICODE_LEAKAGE' END, CASE WHEN regexp_matches(latex, '^\s*[\d.,]+\s*$') THEN 'ISOLATED_NUMBER' END,
      CASE WHEN regexp_matches(latex, '(\\cdots|\\ldots)\s*$') THEN 'INCOMPLETE_EXPRESSION' END, CASE WHEN ratio > 0.5 THEN 'HIGH_TEXT_RATIO' END,
      CASE WHEN NOT commands AND NOT regexp_matches(latex, '[=<>+\-*/^_]') THEN 'NO_MATH_COMMANDS' END] AS fired FROM u),
    e AS (SELECT doc_id, seq, latex, unnest(list_filter(fired, lambda x: x IS NOT NULL)) AS "check" FROM k WHERE trim(latex) <> '')"""


@query(
    "ocr_quality", "v_equation",
    SQL_OCR + """, c AS (SELECT doc_id, seq, sum(CASE "check" WHEN 'ALL_TEXT_NO_MATH' THEN 0.4 WHEN 'UNICODE_LEAKAGE' THEN 0.05 WHEN 'ISOLATED_NUMBER' THEN 0.05 ELSE 0.15 END) AS lost FROM e GROUP BY ALL)
    SELECT k.doc_id, k.seq, CAST(CASE WHEN trim(latex) = '' THEN 0.0 ELSE round(greatest(0.0, 1.0 - coalesce(lost, 0.0)), 6) END AS DOUBLE) AS score FROM k LEFT JOIN c ON k.doc_id = c.doc_id AND k.seq = c.seq""",
)
def _(v):
    return v.v_equation.select(*KEY, F.round(S.ocr_quality(C("latex")), 6).alias("score"))


@query("ocr_quality_checks", "v_equation", SQL_OCR + """ SELECT "check", count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM e GROUP BY 1""")
def _(v):
    fired = F.array(*[F.when(c, F.lit(n)) for n, c, _ in S.ocr_checks(C("latex"))])
    t = v.v_equation.where("trim(latex) <> ''").select(*KEY, F.explode(F.filter(fired, lambda x: x.isNotNull())).alias("check"))
    return t.groupBy("check").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"))


SQL_MATHS_RE2 = S.MATH_OPS


@query(
    "equation_category", "v_equation",
    rf"""SELECT doc_id, seq, CASE WHEN rx OR (mo AND st > 0 AND NOT ma) OR (st >= 2 AND NOT ma) THEN 'chemical_equation' WHEN sh OR (mo AND NOT ma AND NOT sa) THEN 'chemical_structure'
    WHEN sa THEN 'statistical_expression' WHEN un THEN 'engineering_formula' WHEN ma THEN 'mathematical_equation' WHEN is_inline THEN 'mathematical_equation' ELSE 'unknown' END AS found,
    CASE WHEN rx OR (mo AND st > 0 AND NOT ma) OR (st >= 2 AND NOT ma) THEN 0.85 WHEN sh OR (mo AND NOT ma AND NOT sa) THEN 0.75
    WHEN sa OR un THEN 0.7 WHEN ma THEN 0.8 WHEN is_inline THEN 0.55 ELSE 0.3 END AS confidence
    FROM (SELECT *, regexp_matches(plain_text, '{S.REACTION}') AS rx, regexp_matches(plain_text, '{S.MOLECULE}') AS mo, {sql_n('plain_text', S.STOICH)} AS st, regexp_matches(plain_text, '{S.MATH_OPS}') AS ma,
    regexp_matches(plain_text, '{S.STRUCTURE}') AS sh, regexp_matches(plain_text, '{S.STATISTIC}') AS sa, regexp_matches(plain_text, '{S.UNIT}') OR regexp_matches(latex, '{S.CONTEXT}') AS un FROM v_equation)""",
)
def _(v):
    got = S.category(C("plain_text"), C("latex"), F.lit(""), C("is_inline"))
    return v.v_equation.select(*KEY, got["category"].alias("found"), got["confidence"].alias("confidence"))


@query(
    "labelled_category", "v_equation",
    rf"""SELECT doc_id, seq, CASE WHEN trim(plain_text) = '' THEN 'mathematical_equation' WHEN regexp_matches(plain_text, '{S.UNIT}') THEN 'engineering_formula'
    WHEN regexp_matches(plain_text, '{S.REACTION}') AND regexp_matches(plain_text, '[A-Z][a-z]?\d') THEN 'chemical_equation' ELSE 'mathematical_equation' END AS found FROM v_equation""",
)
def _(v):
    return v.v_equation.select(*KEY, S.labelled_category(C("plain_text"))["category"].alias("found"))


@query("formula_score")
def _(v):
    t = v.dealt("v_equation").withColumn("distance", (C("seq") % 120).cast("double"))
    t = t.select(*KEY, S.formula_score(C("plain_text"), None, C("distance")).alias("got"))
    return t.select(*KEY, F.round("got.score", 6).alias("score"), "got.is_formula", "got.needs_review")


def parts():
    return {
        "recognition": C("confidence"),
        "layout": F.when(C("seq") % 3 != 0, (C("seq") % 10) / 10.0),
        "syntax": F.when(C("seq") % 5 != 0, F.lit(0.9)),
        "ocr": F.when(C("seq") % 7 != 0, (C("seq") % 4) / 4.0),
    }


SQL_PARTS = """, p AS (SELECT doc_id, seq, confidence AS a, CASE WHEN seq % 3 <> 0 THEN (seq % 10) / 10 END AS b, CASE WHEN seq % 5 <> 0 THEN 0.9 END AS c, CASE WHEN seq % 7 <> 0 THEN (seq % 4) / 4 END AS d FROM v_equation),
w AS (SELECT *, 0.35 + CASE WHEN b IS NULL THEN 0 ELSE 0.15 END + CASE WHEN c IS NULL THEN 0 ELSE 0.30 END + CASE WHEN d IS NULL THEN 0 ELSE 0.20 END AS w FROM p)"""


@query(
    "confidence_aggregate", "v_equation",
    SQL_PARTS + """ SELECT doc_id, seq, round((0.35 * a + coalesce(0.15 * b, 0) + coalesce(0.3 * c, 0) + coalesce(0.2 * d, 0)) / w, 6) AS weighted,
    round(exp((0.35 * ln(greatest(a, 1e-9)) + CASE WHEN b IS NULL THEN 0 ELSE 0.15 * ln(greatest(b, 1e-9)) END + coalesce(0.3 * ln(c), 0) + CASE WHEN d IS NULL THEN 0 ELSE 0.2 * ln(greatest(d, 1e-9)) END) / w), 6) AS geometric,
    least(a, b, c, d) AS lowest FROM w""",
)
def _(v):
    return v.v_equation.select(
        *KEY,
        F.round(S.aggregate_confidence(parts()), 6).alias("weighted"),
        F.round(S.aggregate_confidence(parts(), "geometric"), 6).alias("geometric"),
        S.aggregate_confidence(parts(), "min").cast("double").alias("lowest"),
    )


@query(
    "final_fields", "v_equation v_verdict",
    """SELECT e.doc_id, seq, CASE WHEN NOT coalesce(accepted, true) THEN 'REJECTED' WHEN f < 0.65 THEN 'UNCERTAIN' ELSE 'SUCCESS' END AS status, round(f, 6) AS final_confidence FROM (
    SELECT e.*, v.accepted, coalesce((greatest(e.confidence, e.seq % 10 / 10) + v.score) / 2, greatest(e.confidence, e.seq % 10 / 10)) AS f FROM v_equation e LEFT JOIN v_verdict v ON e.doc_id = v.doc_id) e""",
)
def _(v):
    best = F.greatest(C("confidence"), (C("seq") % 10) / 10.0)
    t = v.v_equation.join(v.v_verdict.select("doc_id", "accepted", "score"), "doc_id", "left")
    t = t.withColumn("f", F.coalesce((best + C("score")) / 2, best))
    return t.select(*KEY, S.status(F.coalesce("accepted", F.lit(True)), C("f")).alias("status"), F.round("f", 6).alias("final_confidence"))


@query(
    "status_summary", "v_verdict",
    "SELECT category, count(*) AS total, count(*) FILTER (accepted AND coalesce(score, 0) >= 0.65) AS success, count(*) FILTER (accepted AND coalesce(score, 0) < 0.65) AS uncertain, count(*) FILTER (NOT accepted) AS rejected FROM v_verdict GROUP BY category",
)
def _(v):
    s = S.status(C("accepted"), F.coalesce("score", F.lit(0.0)))
    t = v.v_verdict.withColumn("s", s)
    return t.groupBy("category").agg(F.count("*").alias("total"), *[F.count_if(C("s") == n).alias(n.lower()) for n in ("SUCCESS", "UNCERTAIN", "REJECTED")])


@query(
    "coverage_verdict", "v_equation v_expected",
    f""", {SQL_NUMBERS}, {SQL_EXPECTED}, n AS (SELECT doc_id, count(DISTINCT number) AS n_labels FROM expected GROUP BY 1), x AS (SELECT doc_id, count(DISTINCT number) AS n_found FROM detected GROUP BY 1)
    SELECT n.doc_id, n_labels, coalesce(n_found, 0) AS n_found, CASE WHEN 100.0 * coalesce(n_found, 0) / n_labels >= 95 THEN 'complete' WHEN 100.0 * coalesce(n_found, 0) / n_labels >= 70 THEN 'partial' ELSE 'incomplete' END AS verdict FROM n LEFT JOIN x ON n.doc_id = x.doc_id""",
)
def _(v):
    n = v.v_expected.groupBy("doc_id").agg(F.countDistinct(L.normalise_number(C("label_raw"))).alias("n_labels"))
    x = numbers(v).groupBy("doc_id").agg(F.countDistinct("number").alias("n_found"))
    t = n.join(x, "doc_id", "left").withColumn("n_found", F.coalesce("n_found", F.lit(0)))
    return t.withColumn("verdict", S.coverage_verdict(100.0 * C("n_found") / C("n_labels")))
