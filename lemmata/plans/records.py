"""Queries over equation records, verdicts, runs, identities and reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lemmata.functions import records as R
from lemmata.functions.latex import is_valid
from lemmata.operators import evaluation as E
from lemmata.operators import runs as N

from .labels_and_latex import SQL_VALID
from .registry import query

C = F.col
KEY = ["doc_id", "seq"]
n_if = lambda c, name: F.count_if(c).alias(name)

METRICS = {
    "n_equations": "true", "n_inline": "is_inline", "n_display": "NOT is_inline", "n_latex": "trim(latex) <> ''", "n_high_confidence": "confidence >= 0.5",
    "n_conf_0": "confidence < 0.25", "n_conf_1": "confidence >= 0.25 AND confidence < 0.5", "n_conf_2": "confidence >= 0.5 AND confidence < 0.75", "n_conf_3": "confidence >= 0.75",
    "n_math": "category = 'mathematical_equation'", "n_chemical": "category = 'chemical_equation'", "n_engineering": "category = 'engineering_formula'", "n_uncategorised": "category = ''",
    "n_good": "confidence >= 0.75 AND flag = ''", "n_warn": "confidence >= 0.5 AND flag <> ''", "n_review": "confidence < 0.6", "n_flagged": "flag <> ''", "n_numbered": "label_raw <> ''",
}


@query(
    "metrics_block", "v_equation",
    "SELECT doc_id, " + ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in METRICS.items()) + f", count(*) FILTER ({SQL_VALID}) AS n_valid, count(DISTINCT page_no) AS n_pages, round(avg(confidence), 6) AS mean_confidence FROM v_equation GROUP BY doc_id",
)
def _(v):
    aggs = [n_if(F.expr(c), n) for n, c in METRICS.items()]
    return v.v_equation.groupBy("doc_id").agg(*aggs, n_if(is_valid(C("latex")), "n_valid"), F.countDistinct("page_no").alias("n_pages"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


@query("flag_histogram", "v_equation", "SELECT flag, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM v_equation WHERE flag <> '' GROUP BY flag")
def _(v):
    flags = v.v_equation.select("doc_id", F.explode(F.filter(F.array("flag"), lambda x: x != "")).alias("flag"))
    return flags.groupBy("flag").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"))


@query(
    "page_and_document_rollup", "v_equation",
    "SELECT doc_id, page_no, provider, count(*) AS n, count(*) FILTER (confidence < 0.5) AS n_low FROM v_equation GROUP BY GROUPING SETS ((doc_id, page_no), (doc_id, provider), (doc_id), ())",
)
def _(v):
    t = v.v_equation.groupingSets([["doc_id", "page_no"], ["doc_id", "provider"], ["doc_id"], []], "doc_id", "page_no", "provider")
    return t.agg(F.count("*").alias("n"), n_if(C("confidence") < 0.5, "n_low"))


@query(
    "page_outcomes", "v_equation",
    """SELECT doc_id, page_no, count(*) AS n, CASE WHEN count(*) FILTER (trim(latex) <> '') = 0 THEN 'empty' WHEN count(*) FILTER (flag = 'invalid_latex') > 1 THEN 'degraded' WHEN count(*) FILTER (trim(latex) = '') > 0 THEN 'partial' ELSE 'extracted' END AS outcome FROM v_equation GROUP BY ALL""",
)
def _(v):
    return v.v_equation.groupBy("doc_id", "page_no").agg(F.count("*").alias("n"), R.page_outcome(C("latex"), C("flag")).alias("outcome"))


@query(
    "order_violations", "v_equation",
    "SELECT doc_id, seq, coalesce(page_no < max(page_no) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS violates FROM v_equation",
)
def _(v):
    return E.order_violations(v.v_equation, ["doc_id"], "seq", "page_no").select(*KEY, "violates")


@query("duplicate_equations", "v_equation", "SELECT doc_id, seq, trim(latex) <> '' AND count(*) OVER (PARTITION BY doc_id, trim(latex)) > 1 AS duplicated FROM v_equation")
def _(v):
    return E.duplicates(v.v_equation, ["doc_id"], "latex").select(*KEY, "duplicated")


@query(
    "validation_flags", "v_equation",
    f"""SELECT doc_id, seq, concat_ws('|', CASE WHEN NOT ({SQL_VALID}) THEN 'invalid_latex' END, CASE WHEN confidence < 0.5 THEN 'low_confidence' END, CASE WHEN label_raw = '' THEN 'missing_number' END,
    CASE WHEN regexp_matches(plain_text, '^\\s*\\([0-9.]+\\)\\s*$') THEN 'label_only' END, nullif(flag, '')) AS flags FROM v_equation""",
)
def _(v):
    flags = R.flags(
        invalid_latex=~is_valid(C("latex")), low_confidence=C("confidence") < 0.5, missing_number=C("label_raw") == "", label_only=C("plain_text").rlike(r"^\s*\([0-9.]+\)\s*$")
    )
    return v.v_equation.select(*KEY, F.concat_ws("|", flags, F.nullif("flag", F.lit(""))).alias("flags"))


@query(
    "judge_acceptance", "v_verdict",
    "SELECT doc_id, CASE WHEN score IS NULL THEN true ELSE accepted AND score >= 0.7 END AS accepted, coalesce(score, 0.5) AS score FROM v_verdict",
)
def _(v):
    got = R.acceptance(C("accepted"), C("score"))
    return v.v_verdict.select("doc_id", got["accepted"].alias("accepted"), got["score"].alias("score"))


@query(
    "judge_rollup", "v_verdict",
    """SELECT category, count(*) FILTER (score IS NOT NULL) AS n_available, count(*) FILTER (accepted) AS n_accepted, round(avg(score), 6) AS mean_score,
    round(avg(score) FILTER (accepted), 6) AS mean_accepted, count(*) FILTER (accepted AND score >= 0.5) / nullif(count(*) FILTER (accepted), 0) AS accept_precision FROM v_verdict GROUP BY category""",
)
def _(v):
    t = v.v_verdict.groupBy("category").agg(
        n_if(C("score").isNotNull(), "n_available"), n_if(C("accepted"), "n_accepted"), F.round(F.avg("score"), 6).alias("mean_score"),
        F.round(F.avg(F.when(C("accepted"), C("score"))), 6).alias("mean_accepted"), n_if(C("accepted") & (C("score") >= 0.5), "both"),
    )
    return t.withColumn("accept_precision", C("both") / F.nullif("n_accepted", F.lit(0))).drop("both")


@query(
    "provider_selection", "v_equation",
    "SELECT category, CASE category WHEN 'chemical_equation' THEN 'layout' WHEN 'engineering_formula' THEN 'plain_text' ELSE 'vision' END AS provider, count(*) AS n FROM v_equation GROUP BY ALL",
)
def _(v):
    chosen = R.select_provider(C("category"), {"mathematical_equation": "vision", "chemical_equation": "vision"}, "chemical_equation=layout,engineering_formula=plain_text", "vision")
    return v.v_equation.groupBy("category", chosen.alias("provider")).agg(F.count("*").alias("n"))


@query(
    "retry_candidates", "v_equation",
    "SELECT doc_id, seq, CASE WHEN confidence < 0.6 AND trim(latex) <> '' THEN greatest(confidence, (seq % 8) / 10) ELSE confidence END AS confidence, confidence < 0.6 AND trim(latex) <> '' AS retried FROM v_equation",
)
def _(v):
    retry = (C("confidence") < 0.6) & (F.trim("latex") != "")
    return v.v_equation.select(*KEY, F.when(retry, F.greatest(C("confidence"), (C("seq") % 8) / 10)).otherwise(C("confidence")).alias("confidence"), retry.alias("retried"))


@query("seed_adoption", "v_equation", "SELECT doc_id, seq, CASE WHEN flag = '' AND trim(latex) <> '' AND seq % 3 = 0 THEN 0.75 ELSE confidence END AS confidence FROM v_equation")
def _(v):
    seeded = (C("flag") == "") & (F.trim("latex") != "") & (C("seq") % 3 == 0)
    return v.v_equation.select(*KEY, F.when(seeded, 0.75).otherwise(C("confidence")).alias("confidence"))


@query("verdict_cache", "v_equation", "SELECT latex, category, min(doc_id) AS first_doc, count(*) AS n_served FROM v_equation GROUP BY latex, category")
def _(v):
    return v.v_equation.groupBy("latex", "category").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n_served"))


@query(
    "equations_csv", "v_equation v_verdict",
    """SELECT concat(e.doc_id, '-', equation_id) AS equation_id, page_no AS page_number, nullif(label_raw, '') AS equation_number, latex, confidence, nullif(e.category, '') AS category FROM v_equation e JOIN v_verdict v ON e.doc_id = v.doc_id""",
)
def _(v):
    t = v.v_equation.join(v.v_verdict.select("doc_id"), "doc_id")
    return t.select(F.concat_ws("-", "doc_id", "equation_id").alias("equation_id"), C("page_no").alias("page_number"), F.nullif("label_raw", F.lit("")).alias("equation_number"), "latex", "confidence", F.nullif("category", F.lit("")).alias("category"))


@query(
    "gold_template", "v_equation",
    "SELECT doc_id, equation_id, coalesce(nullif(label_raw, ''), equation_id) AS label, page_no, '' AS gold_latex, false AS verified, bool_or(label_raw <> '') OVER (PARTITION BY doc_id) AS by_label FROM v_equation",
)
def _(v):
    mode = v.v_equation.groupBy("doc_id").agg(F.bool_or(C("label_raw") != "").alias("by_label"))
    t = v.v_equation.join(mode, "doc_id")
    return t.select("doc_id", "equation_id", F.coalesce(F.nullif("label_raw", F.lit("")), C("equation_id")).alias("label"), "page_no", F.lit("").alias("gold_latex"), F.lit(False).alias("verified"), "by_label")


@query(
    "document_assembly", "v_equation v_page",
    """, p AS (SELECT doc_id, count(*) AS n_pages, sum(char_count) AS chars FROM v_page GROUP BY 1), e AS (SELECT doc_id, count(*) AS n_equations, string_agg(equation_id, ' ' ORDER BY seq) FILTER (seq <= 5) AS head FROM v_equation GROUP BY 1)
    SELECT p.doc_id, n_pages, CAST(chars AS BIGINT) AS chars, n_equations, head FROM p LEFT JOIN e ON p.doc_id = e.doc_id""",
)
def _(v):
    p = v.v_page.groupBy("doc_id").agg(F.count("*").alias("n_pages"), F.sum("char_count").alias("chars"))
    head = F.array_sort(F.collect_list(F.when(C("seq") <= 5, F.struct("seq", "equation_id"))))
    e = v.v_equation.groupBy("doc_id").agg(F.count("*").alias("n_equations"), F.array_join(F.transform(head, lambda x: x["equation_id"]), " ").alias("head"))
    return p.join(e, "doc_id", "left")


@query(
    "first_page_join", "v_equation v_page",
    "SELECT e.doc_id, e.seq, p.char_count, coalesce(nullif(e.label_raw, ''), CAST(p.page_no AS VARCHAR)) AS number FROM v_equation e LEFT JOIN v_page p ON e.doc_id = p.doc_id AND e.page_no = p.page_no AND p.has_real_fonts",
)
def _(v):
    p = v.v_page.where("has_real_fonts").select("doc_id", "page_no", "char_count", C("page_no").alias("p"))
    t = v.v_equation.join(p, ["doc_id", "page_no"], "left")
    return t.select(*KEY, "char_count", F.coalesce(F.nullif("label_raw", F.lit("")), C("p").cast("string")).alias("number"))


@query(
    "last_block_wins", "v_box v_label_box",
    """, b AS (SELECT doc_id, page_no, kind, arg_max(box_seq, box_seq) AS box_seq FROM v_box GROUP BY ALL) SELECT l.doc_id, l.page_no, l.label, b.box_seq FROM v_label_box l LEFT JOIN b ON l.doc_id = b.doc_id AND l.page_no = b.page_no AND b.kind = 0""",
)
def _(v):
    b = v.v_box.where("kind = 0").groupBy("doc_id", "page_no").agg(F.max("box_seq").alias("box_seq"))
    return v.v_label_box.join(b, ["doc_id", "page_no"], "left").select("doc_id", "page_no", "label", "box_seq")


@query(
    "association_edges", "v_box",
    """, e AS (SELECT doc_id, page_no, box_seq, kind, unnest([box_seq + 1, box_seq + 2]) AS target FROM v_box WHERE kind > 0)
    SELECT doc_id, page_no, target, arg_max(box_seq, box_seq) FILTER (kind = 1) AS number_of, arg_min(box_seq, box_seq) FILTER (kind = 2) AS caption_of, arg_min(box_seq, box_seq) FILTER (kind = 3) AS continues FROM e GROUP BY ALL""",
)
def _(v):
    e = v.v_box.where("kind > 0").select("doc_id", "page_no", "box_seq", "kind", F.explode(F.array(C("box_seq") + 1, C("box_seq") + 2)).alias("target"))
    of = lambda k: F.when(C("kind") == k, C("box_seq"))
    return e.groupBy("doc_id", "page_no", "target").agg(F.max(of(1)).alias("number_of"), F.min(of(2)).alias("caption_of"), F.min(of(3)).alias("continues"))


@query(
    "invalid_parents", "v_box",
    """, a AS MATERIALIZED (SELECT doc_id, page_no, box_seq, box_seq + 3 - 5 * (kind % 2) AS parent FROM v_box)
    SELECT a.doc_id, a.page_no, a.box_seq FROM a ANTI JOIN (SELECT doc_id, page_no, box_seq AS parent FROM a) b ON a.doc_id = b.doc_id AND a.page_no = b.page_no AND a.parent = b.parent""",
)
def _(v):
    a = v.v_box.select("doc_id", "page_no", "box_seq", (C("box_seq") + 3 - 5 * (C("kind") % 2)).alias("parent"))
    b = v.v_box.select("doc_id", "page_no", C("box_seq").alias("parent"))
    return a.join(b, ["doc_id", "page_no", "parent"], "left_anti").select("doc_id", "page_no", "box_seq")


@query(
    "detector_fall_through", "v_box",
    "SELECT doc_id, page_no, box_seq, kind FROM (SELECT *, min(CASE WHEN kind > 0 OR doc_id % 3 = 0 THEN kind END) OVER (PARTITION BY doc_id) AS best FROM v_box) WHERE kind = best",
)
def _(v):
    best = v.v_box.where("kind > 0 OR doc_id % 3 = 0").groupBy("doc_id").agg(F.min("kind").alias("kind"))
    return v.v_box.join(best, ["doc_id", "kind"]).select("doc_id", "page_no", "box_seq", "kind")


@query("four_pass_union", "v_equation", "SELECT doc_id, seq, CASE WHEN category <> '' THEN 1 WHEN label_raw <> '' THEN 2 WHEN regexp_matches(latex, '=') THEN 3 ELSE 4 END AS pass_no FROM v_equation WHERE category <> '' OR label_raw <> '' OR regexp_matches(latex, '=') OR regexp_matches(plain_text, '->')")
def _(v):
    passes = [C("category") != "", C("label_raw") != "", C("latex").contains("="), C("plain_text").contains("->")]
    union = None
    for k, cond in enumerate(passes):
        part = v.v_equation.where(cond).select(*KEY, F.lit(k + 1).alias("pass_no"))
        union = part if union is None else union.unionByName(part)
    return union.groupBy(*KEY).agg(F.min("pass_no").alias("pass_no"))


@query("worst_first", "v_equation", "SELECT doc_id, seq, rn FROM (SELECT doc_id, seq, row_number() OVER (PARTITION BY doc_id ORDER BY (CASE WHEN trim(latex) = '' THEN 3 ELSE 0 END) + (CASE WHEN flag <> '' THEN 2 ELSE 0 END) + (CASE WHEN is_inline THEN 1 ELSE 0 END) DESC, confidence, seq) AS rn FROM v_equation) WHERE rn <= 20")
def _(v):
    badness = F.when(F.trim("latex") == "", 3).otherwise(0) + F.when(C("flag") != "", 2).otherwise(0) + C("is_inline").cast("int")
    rn = F.row_number().over(Window.partitionBy("doc_id").orderBy(badness.desc(), "confidence", "seq"))
    return v.v_equation.select(*KEY, rn.cast("long").alias("rn")).where("rn <= 20")


@query("file_fingerprints", "", "SELECT doc_id, sha256(text) AS fingerprint, CASE WHEN length(text) = 0 THEN 'empty' WHEN length(text) > 20000 THEN 'too_large' WHEN contains(text, 'password') THEN 'encrypted' ELSE 'ok' END AS verdict FROM documents")
def _(v):
    verdict = N.validate(F.length("text"), 20000, F.when(C("text").contains("password"), "file is encrypted"), F.lit(1))
    return v.documents.select("doc_id", F.sha2(C("text").cast("binary"), 256).alias("fingerprint"), verdict.alias("verdict"))


@query(
    "duplicate_index", "v_duplicate",
    """, a AS (SELECT *, min(doc_id) OVER (PARTITION BY fingerprint) AS f, min(doc_id) OVER (PARTITION BY logical_id) AS l FROM v_duplicate)
    SELECT doc_id, CASE WHEN f < doc_id THEN 'binary' WHEN l < doc_id THEN 'logical' END AS duplicate_type, CASE WHEN f < doc_id THEN f WHEN l < doc_id THEN l END AS original FROM a""",
)
def _(v):
    return N.duplicate_lookup(v.v_duplicate)


@query("incremental_filter", "v_duplicate", "SELECT doc_id FROM v_duplicate WHERE fingerprint NOT IN (SELECT fingerprint FROM v_duplicate WHERE doc_id % 4 = 0)")
def _(v):
    return N.not_processed(v.v_duplicate, v.v_duplicate.where("doc_id % 4 = 0")).select("doc_id")


@query(
    "metadata_normalise", "v_metadata",
    r"""SELECT doc_id, trim(regexp_replace(title, '\s+', ' ', 'g')) AS title, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split_regex(author, '\s*[;,/&]\s*|\s+and\s+'), lambda x: trim(x)), lambda x: x <> ''))), '; ') AS authors FROM v_metadata""",
)
def _(v):
    return v.v_metadata.select("doc_id", N.normal_text(C("title")).alias("title"), F.array_join(N.normal_values(C("author")), "; ").alias("authors"))


@query(
    "logical_identity", "v_metadata",
    r"""SELECT doc_id, sha256(lower(concat_ws(chr(31), trim(regexp_replace(title, '\s+', ' ', 'g')), array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split_regex(author, '\s*[;,/&]\s*|\s+and\s+'), lambda x: trim(x)), lambda x: x <> ''))), '; '), publisher))) AS logical_id FROM v_metadata""",
)
def _(v):
    return v.v_metadata.select("doc_id", N.logical_id(C("title"), C("author"), C("publisher")).alias("logical_id"))


@query(
    "run_summary", "v_stage_run",
    """SELECT stage, count(*) AS n, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped,
    round(sum(duration), 4) AS total_duration, round(max(duration), 6) AS longest, count(DISTINCT doc_id) AS n_docs FROM v_stage_run GROUP BY stage""",
)
def _(v):
    of = lambda s: n_if(C("status") == s, s)
    return v.v_stage_run.groupBy("stage").agg(F.count("*").alias("n"), of("completed"), of("failed"), of("skipped"), F.round(F.sum("duration"), 4).alias("total_duration"), F.round(F.max("duration"), 6).alias("longest"), F.countDistinct("doc_id").alias("n_docs"))


@query(
    "document_run_status", "v_stage_run",
    "SELECT doc_id, CASE WHEN count(*) FILTER (status = 'failed' AND retry_count >= 4) > 0 THEN 'aborted' WHEN count(*) FILTER (status = 'failed') > 0 THEN 'failed' ELSE 'completed' END AS status, count(*) AS n FROM v_stage_run GROUP BY doc_id",
)
def _(v):
    return v.v_stage_run.groupBy("doc_id").agg(N.document_status(C("status"), C("retry_count")).alias("status"), F.count("*").alias("n"))


@query("open_failures", "v_stage_run", "SELECT event_id, doc_id, stage, retry_count, least(30.0, 1.0 * power(2.0, retry_count)) AS delay FROM v_stage_run WHERE status = 'failed' AND retry_count < 3")
def _(v):
    t = v.v_stage_run.where("status = 'failed' AND retry_count < 3")
    return t.select("event_id", "doc_id", "stage", "retry_count", N.backoff(C("retry_count") + 1, 1.0, 2.0, 30.0).alias("delay"))


@query(
    "ledger_merge", "v_stage_run",
    "SELECT doc_id, stage, arg_max(status, event_id) AS status, max(event_id) AS event_id FROM v_stage_run GROUP BY doc_id, stage",
)
def _(v):
    return v.v_stage_run.groupBy("doc_id", "stage").agg(F.max_by("status", "event_id").alias("status"), F.max("event_id").alias("event_id"))


@query(
    "stage_status_synthesis", "v_stage_run",
    """, p AS (SELECT d.doc_id, s.stage FROM (SELECT DISTINCT doc_id FROM v_stage_run) d, (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS stage) s), f AS (SELECT DISTINCT doc_id, stage FROM v_stage_run WHERE status = 'failed')
    SELECT p.doc_id, p.stage, CASE WHEN f.doc_id IS NULL THEN 'completed' ELSE 'failed' END AS status FROM p LEFT JOIN f ON p.doc_id = f.doc_id AND p.stage = f.stage""",
)
def _(v):
    stages = F.array(*[F.lit(s) for s in ("click", "error", "purchase", "signup", "view")])
    plan = v.v_stage_run.select("doc_id").distinct().select("doc_id", F.explode(stages).alias("stage"))
    failed = v.v_stage_run.where("status = 'failed'").select("doc_id", "stage").distinct().withColumn("status", F.lit("failed"))
    return plan.join(failed, ["doc_id", "stage"], "left").withColumn("status", F.coalesce("status", F.lit("completed")))


@query(
    "table_quality", "v_box",
    """, c AS (SELECT doc_id, page_no, count(*) AS cells, count(*) FILTER (kind > 0) AS filled, bool_or(kind = 2) AS caption FROM v_box GROUP BY ALL)
    SELECT doc_id, page_no, least(100, 60 + 2 * least(cells, 20)) AS structure, 100.0 * filled / cells AS text_share, least(100, 50 + (CASE WHEN caption THEN 20 ELSE 0 END) + least(20, 5 * filled) + 10) AS completeness FROM c""",
)
def _(v):
    t = v.v_box.groupBy("doc_id", "page_no").agg(F.count("*").alias("cells"), n_if(C("kind") > 0, "filled"), F.bool_or(C("kind") == 2).alias("caption"))
    return t.select("doc_id", "page_no", *R.table_quality(C("cells"), C("filled"), C("caption")))


@query(
    "text_lines_dedup", "",
    r"""SELECT doc_id, count(*) AS n_lines, count(DISTINCT trim(line)) AS n_kept FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE trim(line) <> '' GROUP BY doc_id""",
)
def _(v):
    t = v.documents.select("doc_id", F.split("text", "\n").alias("l")).select("doc_id", F.filter("l", lambda x: F.trim(x) != "").alias("l")).where(F.size("l") > 0)
    return t.select("doc_id", F.size("l").cast("long").alias("n_lines"), F.size(R.dedup_lines(C("l"))).cast("long").alias("n_kept"))


@query(
    "text_statistics", "",
    r"""SELECT lang, count(*) AS n, CAST(sum(len(regexp_extract_all(text, '[0-9]{3,}'))) AS BIGINT) AS numeric_runs, count(*) FILTER (regexp_matches(text, '[=<>]')) AS with_math, count(*) FILTER (length(text) < 100) AS short FROM documents GROUP BY lang""",
)
def _(v):
    return v.documents.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.regexp_count("text", F.lit("[0-9]{3,}"))).alias("numeric_runs"), n_if(C("text").rlike("[=<>]"), "with_math"), n_if(F.length("text") < 100, "short"))


@query("ground_truth_lines", "", "SELECT item_id, trim(x) AS number FROM (SELECT item_id, unnest(string_split(replace(text, ' ', chr(10)), chr(10))) AS x FROM benchmark) WHERE trim(x) <> '' AND trim(x) NOT LIKE '#%'")
def _(v):
    return N.ground_truth_lines(v.benchmark.select("item_id", F.replace("text", F.lit(" "), F.lit("\n")).alias("text")), "item_id")


@query("crop_report", "v_box", "SELECT doc_id, count(*) AS n, list_sort(list(x1 - x0))[len(list(x1 - x0)) // 2 + 1] AS median_w, list_sort(list(y1 - y0))[len(list(y1 - y0)) // 2 + 1] AS median_h, count(*) FILTER (y1 - y0 < 12) AS slivers FROM v_box GROUP BY doc_id")
def _(v):
    upper = lambda c: F.get(F.sort_array(F.collect_list(c)), F.floor(F.count("*") / 2).cast("int"))
    return v.v_box.groupBy("doc_id").agg(F.count("*").alias("n"), upper(C("x1") - C("x0")).alias("median_w"), upper(C("y1") - C("y0")).alias("median_h"), n_if(C("y1") - C("y0") < 12, "slivers"))
