"""Queries over text blocks, crops, similarity and providers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lemmata.functions import latex as X
from lemmata.functions import text as T
from lemmata.operators import pixels as P
from lemmata.sources import files, providers

from .registry import query

C = F.col
KEY = ["doc_id", "seq"]


def _marks(o, c):
    return f"list_transform(regexp_extract_all(latex, '[\\{o}\\{c}]'), lambda m: CASE WHEN m = '{o}' THEN 1 ELSE -1 END)"


def _sums(marks):
    return f"list_transform(range(1, len({marks}) + 1), lambda i: list_sum({marks}[1:i]))"


def _even(marks):
    return f"(len({marks}) = 0 OR (list_sum({marks}) = 0 AND list_min({_sums(marks)}) >= 0))"


def _q(pattern):
    return "'" + pattern.replace("'", "''") + "'"


_GOOD = "'\\\\(?:d|t|c)?frac *\\x01 *\\x01'"
_COUNT = lambda p: f"len(regexp_extract_all(latex, {_q(p)}))"
SQL_SYNTAX = rf""", m AS (SELECT doc_id, seq, latex, {_marks("{", "}")} AS br, {_marks("[", "]")} AS sq, {_marks("(", ")")} AS pa FROM v_equation),
    f AS (SELECT *, regexp_replace(list_reduce(list_prepend(latex, list_transform(range(0, len(br) // 2 + 1), lambda i: '')), lambda x, y:
      regexp_replace(regexp_replace(regexp_replace(x, {_GOOD}, '', 'g'), {_q(T.BAD_GROUP)}, chr(2), 'g'), {_q(T.GROUP)}, chr(1), 'g')), {_GOOD}, '', 'g') AS bare FROM m),
    c AS (SELECT doc_id, seq, latex, {_even("br")} AS balanced_braces, {_even("sq")} AS balanced_brackets, {_even("pa")} AS balanced_parens,
      {_COUNT(T.LEFT)} = {_COUNT(T.RIGHT)} AS left_right_matched,
      regexp_extract_all(latex, '\\begin\{{([^}}]+)\}}', 1) = regexp_extract_all(latex, '\\end\{{([^}}]+)\}}', 1) AS environments_closed,
      NOT contains(bare, chr(2)) AND NOT regexp_matches(bare, {_q(T.FRACTION)}) AS frac_has_two_args, NOT regexp_matches(latex, {_q(T.BARE_SCRIPT)}) AS scripts_have_args,
      len(list_filter(regexp_extract_all(latex, '\\([a-zA-Z]+)', 1), lambda x: NOT list_contains([{", ".join(map(_q, T.KNOWN))}], x))) = 0 AS commands_are_known,
      coalesce(list_max({_sums("br")}), 0) <= 12 AS depth_within_limit FROM f)"""
CHECKS = "balanced_braces balanced_brackets balanced_parens left_right_matched environments_closed frac_has_two_args scripts_have_args commands_are_known depth_within_limit".split()


@query(
    "syntax_confidence", "v_equation",
    SQL_SYNTAX + f" SELECT doc_id, seq, CASE WHEN trim(latex) = '' THEN 0.0 ELSE round(({' + '.join(f'CAST({c} AS INT)' for c in CHECKS)}) / 9, 6) END AS score FROM c",
)
def _(v):
    return v.v_equation.select(*KEY, F.round(T.syntax_confidence(C("latex")), 6).alias("score"))


@query(
    "syntax_issues", "v_equation",
    SQL_SYNTAX + f" SELECT issue, count(*) AS n FROM (SELECT unnest(list_filter([{', '.join(f'CASE WHEN NOT {c} THEN {_q(c)} END' for c in CHECKS)}], lambda x: x IS NOT NULL)) AS issue FROM c WHERE trim(latex) <> '') GROUP BY issue",
)
def _(v):
    checks = T.syntax_checks(C("latex"))
    issues = F.filter(F.array(*[F.when(~c, F.lit(n)) for n, c in checks.items()]), lambda x: x.isNotNull())
    return v.v_equation.where("trim(latex) <> ''").select(F.explode(issues).alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))


@query(
    "refused_answers", "v_equation",
    f"""SELECT doc_id, seq, regexp_matches(trim(a), {_q(X.PROSE_ANSWER)}) AS refusal, regexp_matches(trim(a), {_q(X.STRUCTURE)}) AS structural
    FROM (SELECT doc_id, seq, CASE seq % 5 WHEN 0 THEN concat(' It is ', latex) WHEN 1 THEN concat(chr(92), 'label{{x}} ', latex) WHEN 2 THEN concat('Nothing', plain_text) WHEN 3 THEN plain_text ELSE latex END AS a FROM v_equation)""",
)
def _(v):
    k = C("seq") % 5
    a = F.when(k == 0, F.concat(F.lit(" It is "), "latex")).when(k == 1, F.concat(F.lit("\\label{x} "), "latex")).when(k == 2, F.concat(F.lit("Nothing"), "plain_text"))
    a = a.when(k == 3, C("plain_text")).otherwise(C("latex"))
    return v.v_equation.select(*KEY, X.is_refusal(a).alias("refusal"), X.is_structural(a).alias("structural"))


@query(
    "balanced_brackets", "v_equation",
    r"""SELECT doc_id, seq, CASE WHEN len(l) = 0 THEN true ELSE list_sum(l) = 0 AND list_min(list_transform(range(1, len(l) + 1), lambda i: list_sum(l[1:i]))) >= 0 END AS balanced
    FROM (SELECT doc_id, seq, list_transform(regexp_extract_all(latex, '[{}]'), lambda c: CASE WHEN c = '{' THEN 1 ELSE -1 END) AS l FROM v_equation)""",
)
def _(v):
    return v.v_equation.select(*KEY, T.balanced(C("latex"), "{", "}").alias("balanced"))


@query("similarity_of_variants")
def _(v):
    pairs = v.v_equation.select("latex", "plain_text").distinct()
    return pairs.select("latex", "plain_text", F.round(T.char_similarity(C("latex"), C("plain_text")), 4).alias("char"), F.round(T.token_similarity(C("latex"), C("plain_text")), 4).alias("token"))


@query("text_normalise")
def _(v):
    kinds = F.when(C("doc_id") % 11 == 0, "code").otherwise("paragraph")
    return v.documents.select("doc_id", F.sha2(T.normalise_block(T.nfc("text"), T.text_role(kinds)).cast("binary"), 256).alias("text_sha256"), T.needs_ocr(C("text")).alias("needs_ocr"))


@query(
    "text_roles", "v_box",
    "SELECT CASE kind WHEN 0 THEN 'title' WHEN 1 THEN 'caption' WHEN 2 THEN 'text_block' ELSE 'code_block' END AS role, count(*) AS n, bool_and(kind <> 2) AS textual FROM v_box GROUP BY 1",
)
def _(v):
    kind = F.element_at(F.array(*map(F.lit, ("title", "caption", "table", "code"))), C("kind") + 1)
    return v.v_box.groupBy(T.text_role(kind).alias("role")).agg(F.count("*").alias("n"), F.bool_and(T.is_text(kind)).alias("textual"))


@query("ocr_fixes")
def _(v):
    return v.v_equation.select(*KEY, T.ocr_fixes(F.concat(F.lit("Eq. 3.4 ð"), "plain_text", F.lit("Þ ¼ l.5 ; 2l3"))).alias("text"))


@query("language_detection")
def _(v):
    got = providers.language(C("text"))
    t = v.documents.select("lang", got["language"].alias("detected"))
    return t.groupBy("lang", "detected").agg(F.count("*").alias("n"))


@query("recogniser_passthrough", "v_equation", "SELECT doc_id, seq, nullif(trim(plain_text), '') AS latex, CASE WHEN trim(plain_text) = '' THEN 0.0 ELSE 0.2 END AS confidence FROM v_equation")
def _(v):
    return v.v_equation.select(*KEY, *providers.passthrough(C("plain_text")))


@query("recogniser_by_registry")
def _(v):
    t = v.v_equation.select(*KEY, C("plain_text").alias("text"))
    return providers.recognise(t, "plain_text").groupBy("confidence").agg(F.count("*").alias("n"), F.count("error").alias("n_errors"))


@query(
    "ink_bands", "v_box",
    """, r AS (SELECT doc_id, page_no, CAST(unnest(range(CAST(y0 AS BIGINT), CAST(y1 AS BIGINT))) AS BIGINT) AS row, x1 - x0 AS w FROM v_box), s AS (SELECT doc_id, page_no, row, sum(w) AS ink FROM r GROUP BY ALL HAVING sum(w) > 60),
    i AS (SELECT *, row - row_number() OVER (PARTITION BY doc_id, page_no ORDER BY row) AS k FROM s) SELECT doc_id, page_no, min(row) AS first, max(row) AS last, sum(ink) AS ink FROM i GROUP BY doc_id, page_no, k""",
)
def _(v):
    boxes = v.dealt("v_box").select("doc_id", "page_no", C("y0").cast("long").alias("start"), C("y1").cast("long").alias("end"), (C("x1") - C("x0")).alias("w"))
    return P.ink_bands(boxes, ["doc_id", "page_no"], 60.0)


def crops(v):
    # a crop is a thousand times its row of `part`: rows are dealt out before they are drawn
    cores = v.spark.sparkContext.defaultParallelism
    dealt = v.part.select("p_partkey", "p_size").repartition(max(4 * cores, int(v.spark.conf.get("spark.sql.shuffle.partitions"))), "p_partkey")
    dark, light = (lambda n: F.array_repeat(F.lit(0), n)), (lambda n: F.array_repeat(F.lit(255), n))
    white, inked = light(F.lit(100)), F.slice(F.concat(light(F.lit(4)), dark(F.lit(36) + C("p_size")), light(F.lit(100))), 1, 100)
    lines = F.concat(*[F.array_repeat(x, n) for x, n in ((white, 5), (inked, 9), (white, 17), (inked, 11))], F.array_repeat(white, C("p_size")))
    return dealt.select("p_partkey", F.slice(lines, F.lit(1), F.greatest(F.lit(31) + C("p_size"), F.lit(0))).alias("gray"), (60 + C("p_size") * 3).alias("dpi"))


@query(
    "crop_quality", "",
    """WITH r AS (SELECT p_partkey, p_size, unnest(range(0, 31 + p_size)) AS r FROM part),
    px AS (SELECT p_partkey, p_size, r, c, CASE WHEN (r > 4 AND r < 14 OR r > 30 AND r < 42) AND c > 3 AND c < 40 + p_size THEN 0 ELSE 255 END AS g FROM r, range(0, 100) AS x(c)),
    rows AS (SELECT p_partkey, r, avg(g) AS mean FROM px GROUP BY ALL), isl AS (SELECT *, r - row_number() OVER (PARTITION BY p_partkey ORDER BY r) AS k FROM rows WHERE mean > 240),
    white AS (SELECT p_partkey, max(r) AS last FROM isl GROUP BY p_partkey, k HAVING count(*) >= 8),
    s AS (SELECT p_partkey, 31 + p_size AS h, 60 + p_size * 3 AS dpi, avg(CASE WHEN g < 128 THEN 1.0 ELSE 0 END) AS ink, avg(g) FILTER (c < 3) AS l, avg(g) FILTER (c >= 97) AS rt,
      avg(g) FILTER (r < 3) AS t, avg(g) FILTER (r >= 28 + p_size) AS b, avg(CASE WHEN g < 128 THEN 1.0 ELSE 0 END) FILTER (r = 0) AS e0, avg(CASE WHEN g < 128 THEN 1.0 ELSE 0 END) FILTER (r = 30 + p_size) AS e1,
      avg(CASE WHEN g < 128 THEN 1.0 ELSE 0 END) FILTER (c = 0) AS e2, avg(CASE WHEN g < 128 THEN 1.0 ELSE 0 END) FILTER (c = 99) AS e3 FROM px GROUP BY p_partkey, p_size),
    a AS (SELECT *, 1.0 - CASE WHEN l < 240 THEN 0.25 ELSE 0 END - CASE WHEN rt < 240 THEN 0.25 ELSE 0 END - CASE WHEN t < 240 THEN 0.1 ELSE 0 END - CASE WHEN b < 240 THEN 0.1 ELSE 0 END AS s0 FROM s),
    d AS (SELECT *, CASE WHEN dpi < 72 THEN least(s0, 0.2) WHEN dpi < 150 THEN s0 - (1.0 - dpi / 150) * 0.3 ELSE s0 END - CASE WHEN 100 / h < 1.5 THEN 0.15 WHEN 100 / h > 20 THEN 0.1 ELSE 0 END
      - CASE WHEN EXISTS (SELECT 1 FROM white w WHERE w.p_partkey = a.p_partkey AND w.last < a.h - 1) THEN 0.35 ELSE 0 END AS s1 FROM a)
    SELECT p_partkey, round(ink, 6) AS ink, ink < 0.002 AS blank, h < 40 AS sliver, greatest(e0, e1, e2, e3) > 0.1 AS clipped,
    round(greatest(0.0, least(1.0, s1 * least(least(l, rt, t, b) / 255 * 3 / 8, 1.0))), 6) AS layout FROM d""",
)
def _(v):
    return P.crop_quality(crops(v)).select("p_partkey", F.round("ink", 6).alias("ink"), "blank", "sliver", "clipped", F.round("layout", 6).alias("layout"))


@query("crop_parts")
def _(v):
    return P.crop_quality(crops(v)).select("p_partkey", F.round("sharpness", 6).alias("sharpness"), "n_parts")


@query(
    "equation_dump", "v_equation",
    """SELECT doc_id, CAST(length(md) AS INT) AS n_chars, sha256(md) AS sha256 FROM (SELECT doc_id, string_agg(concat('- **', CASE WHEN label_raw = '' THEN equation_id ELSE label_raw END, '** `', latex, '`'), chr(10) ORDER BY seq) AS md FROM v_equation GROUP BY doc_id)""",
)
def _(v):
    return files.markdown(v.v_equation).select("doc_id", F.length("markdown").alias("n_chars"), F.sha2(C("markdown").cast("binary"), 256).alias("sha256"))
