"""Queries that classify documents: signals, modality, layout, category and strategy."""

from __future__ import annotations

from pyspark.sql import functions as F

from lemmata.functions import documents as D
from lemmata.operators import geometry as G

from .registry import query

C = F.col
#: Strategies that a run names, beside those of each modality.
NAMED = {"digital|journal_article|complex": "columns_first", "scanned": "ocr_only"}

_LINES = f"list_filter(string_split_regex(coalesce(text, ''), '{D.LINE_END}'), lambda x: regexp_matches(x, '\\S'))"
SQL_SIGNALS = f""", kinds AS (SELECT *, CASE WHEN word_count > 20 AND NOT has_real_fonts THEN 'hybrid' WHEN word_count > 20 AND image_coverage < 0.3 THEN 'digital' WHEN word_count > 20 AND image_coverage <= 0.7 THEN
      CASE WHEN similarity > 0.85 THEN 'digital' WHEN similarity < 0.5 THEN 'scanned' ELSE 'hybrid' END ELSE 'scanned' END AS kind FROM v_page),
    p AS (SELECT doc_id, count(*) AS n_pages, round(count(*) FILTER (kind = 'digital') / count(*), 6) AS digital, round(count(*) FILTER (kind = 'scanned') / count(*), 6) AS scanned,
      bool_or(word_count > 0 AND has_real_fonts) AS any_text_layer, round(avg(word_count), 6) AS mean_words, round(avg(image_coverage), 6) AS figures FROM kinds GROUP BY doc_id),
    cols AS (SELECT doc_id, page_no, count(*) AS n, count(*) FILTER ((x0 + x1) / 2 < 306) AS l FROM v_box GROUP BY ALL),
    m AS (SELECT doc_id, bool_or(n >= 4 AND least(l, n - l) / n >= 0.25) AS multi FROM cols GROUP BY doc_id),
    t AS (SELECT doc_id, length(left(text, {D.PROSE_CHARS})) AS n_prose, {_LINES} AS ls FROM documents),
    d AS (SELECT doc_id, n_prose, round(len(list_filter(ls, lambda x: len(regexp_extract_all(x, '{D.NUMERIC}')) >= 3)) / greatest(len(ls), 1), 6) AS numbers,
      round(len(list_filter(ls, lambda x: regexp_matches(x, '{D.MATHS}'))) / greatest(len(ls), 1), 6) AS maths FROM t),
    signals AS (SELECT p.*, coalesce(multi, false) AS multi, coalesce(n_prose, 0) AS n_prose, coalesce(numbers, 0.0) AS numbers, coalesce(maths, 0.0) AS maths, lower(coalesce(title, '')) AS title
      FROM p LEFT JOIN m USING (doc_id) LEFT JOIN d USING (doc_id) LEFT JOIN v_metadata USING (doc_id))"""
VIEWS = "v_page v_box v_metadata"


def signals(v):
    """One row a document: page shares, columns, densities of numbers, figures and mathematics, title."""
    kind = D.page_modality(C("word_count"), C("has_real_fonts"), C("image_coverage"), C("similarity"))["modality"]
    share = lambda k: F.round(F.count_if(C("kind") == k) / F.count("*"), 6)
    p = v.v_page.withColumn("kind", kind).groupBy("doc_id").agg(
        F.count("*").alias("n_pages"), share("digital").alias("digital"), share("scanned").alias("scanned"),
        F.bool_or((C("word_count") > 0) & C("has_real_fonts")).alias("any_text_layer"), F.round(F.avg("word_count"), 6).alias("mean_words"),
        F.round(F.avg("image_coverage"), 6).alias("figures"),
    )
    halves = v.v_box.groupBy(*G.PAGE).agg(F.count("*").alias("n"), F.count_if((C("x0") + C("x1")) / 2 < 306).alias("l"))
    m = halves.groupBy("doc_id").agg(F.bool_or((C("n") >= 4) & (F.least(C("l"), C("n") - C("l")) / C("n") >= 0.25)).alias("multi"))
    got = D.line_densities(F.coalesce("text", F.lit("")))
    d = v.documents.select("doc_id", F.length(F.left("text", F.lit(D.PROSE_CHARS))).cast("long").alias("n_prose"), F.round(got["numeric"], 6).alias("numbers"), F.round(got["maths"], 6).alias("maths"))
    t = p.join(m, "doc_id", "left").join(d, "doc_id", "left").join(v.v_metadata.select("doc_id", "title"), "doc_id", "left")
    fill = {"multi": F.lit(False), "n_prose": F.lit(0), "numbers": F.lit(0.0), "maths": F.lit(0.0), "title": F.lit("")}
    return t.withColumns({k: F.coalesce(k, f) for k, f in fill.items()}).withColumn("title", F.lower("title"))


@query(
    "document_signals", VIEWS,
    SQL_SIGNALS + """ SELECT doc_id, n_pages, any_text_layer, mean_words, figures, multi, CAST(n_prose AS BIGINT) AS n_prose, numbers, maths, digital, scanned,
    CASE WHEN digital >= 0.85 THEN 'digital' WHEN scanned >= 0.85 THEN 'scanned' ELSE 'hybrid' END AS modality,
    CASE WHEN digital >= 0.85 THEN digital WHEN scanned >= 0.85 THEN scanned ELSE round(1 - greatest(digital, scanned), 6) END AS confidence FROM signals""",
)
def _(v):
    got = D.banded_modality(C("digital"), C("scanned"), C("n_pages"))
    keep = "doc_id n_pages any_text_layer mean_words figures multi n_prose numbers maths digital scanned".split()
    return signals(v).select(*keep, got["modality"].alias("modality"), got["confidence"].alias("confidence"))


SQL_LEVEL = "CASE WHEN top >= 0.35 OR (multi AND top >= 0.15) THEN 'complex' WHEN multi OR top >= 0.15 THEN 'moderate' ELSE 'simple' END"


@query(
    "layout_complexity", VIEWS,
    SQL_SIGNALS + f""", x AS (SELECT *, greatest(numbers, figures, maths) AS top FROM signals) SELECT doc_id, {SQL_LEVEL} AS level,
    round(least(1.0, CASE {SQL_LEVEL} WHEN 'complex' THEN 0.6 + top WHEN 'moderate' THEN 0.5 + top ELSE 0.7 + (0.15 - top) END), 6) AS confidence FROM x""",
)
def _(v):
    got = D.complexity(F.greatest("numbers", "figures", "maths"), C("multi"))
    return signals(v).select("doc_id", got["level"].alias("level"), got["confidence"].alias("confidence"))


_SHAPE = {
    "textbook": "CASE WHEN n_pages >= 150 THEN 1.0 ELSE 0.2 END + CASE WHEN maths >= 0.05 THEN 0.4 ELSE 0 END",
    "reference_handbook": "CASE WHEN n_pages >= 200 AND numbers >= 0.15 THEN 1.0 ELSE 0.2 END",
    "journal_article": "CASE WHEN n_pages <= 40 AND multi THEN 1.0 ELSE 0.1 END",
    "conference_paper": "CASE WHEN n_pages <= 30 AND multi THEN 0.9 ELSE 0.1 END + CASE WHEN figures >= 0.1 THEN 0.3 ELSE 0 END",
    "technical_report": "CASE WHEN n_pages BETWEEN 20 AND 200 THEN 0.6 ELSE 0.2 END",
    "standard_specification": "CASE WHEN numbers >= 0.1 THEN 0.5 ELSE 0.1 END",
    "datasheet": "CASE WHEN n_pages <= 20 AND numbers >= 0.25 THEN 1.0 ELSE 0.1 END",
    "patent": "0.4",
}
_HITS = {k: " + ".join(f"CAST(contains(title, '{w}') AS INT)" for w in words) for k, words in D.CATEGORY_WORDS.items()}
SQL_CATEGORY = SQL_SIGNALS + f""", raw AS (SELECT doc_id, unnest([{", ".join(f"{{'c': '{k}', 's': CAST(2.5 * ({_HITS[k]}) + {_SHAPE[k]} AS DOUBLE)}}" for k in _SHAPE)}]) AS x FROM signals),
    share AS (SELECT doc_id, x.c AS c, round(x.s / sum(x.s) OVER (PARTITION BY doc_id), 6) AS s FROM raw),
    ranked AS (SELECT *, row_number() OVER w AS rn, lead(s) OVER w AS runner_up FROM share WINDOW w AS (PARTITION BY doc_id ORDER BY s DESC, c)),
    picked AS (SELECT doc_id, CASE WHEN s < 0.5 OR s - runner_up < 0.1 THEN 'unknown' ELSE c END AS category, s AS confidence,
      CASE WHEN s < 0.5 THEN 'below_threshold' WHEN s - runner_up < 0.1 THEN 'below_margin' END AS reason FROM ranked WHERE rn = 1)"""


def category(t):
    scores = D.category_scores(C("title"), C("n_pages"), C("multi"), C("numbers"), C("figures"), C("maths"))
    return D.select_category(scores)


@query("document_category", VIEWS, SQL_CATEGORY + " SELECT doc_id, category, confidence, reason FROM picked")
def _(v):
    t = signals(v)
    return t.select("doc_id", category(t).alias("g")).select("doc_id", "g.category", "g.confidence", "g.reason")


@query(
    "strategy_recommendation", VIEWS,
    SQL_CATEGORY + f""", x AS (SELECT doc_id, category, CASE WHEN digital >= 0.85 THEN 'digital' WHEN scanned >= 0.85 THEN 'scanned' ELSE 'hybrid' END AS modality,
      {SQL_LEVEL} AS layout FROM (SELECT *, greatest(numbers, figures, maths) AS top FROM signals) JOIN picked USING (doc_id))
    SELECT doc_id, modality, layout, CASE WHEN modality = 'digital' AND category = 'journal_article' AND layout = 'complex' THEN 'columns_first' WHEN modality = 'scanned' THEN 'ocr_only'
      WHEN modality = 'digital' THEN 'digital_text_first' ELSE 'hybrid_per_page_routed' END AS strategy FROM x""",
)
def _(v):
    t = signals(v)
    modality = D.banded_modality(C("digital"), C("scanned"), C("n_pages"))["modality"]
    t = t.select("doc_id", modality.alias("modality"), category(t)["category"].alias("category"), D.complexity(F.greatest("numbers", "figures", "maths"), C("multi"))["level"].alias("layout"))
    return t.select("doc_id", "modality", "layout", D.recommend_strategy(C("modality"), C("category"), C("layout"), NAMED, "digital_text_first").alias("strategy"))
