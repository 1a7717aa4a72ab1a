"""Tables of a data folder, and views that derive document-extraction records from them.

The views' SQL is one text for both engines, so that a comparison starts from equal
rows: `@` stands for a backslash, which string literals of the engines treat apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

_DOC = "CAST(floor(l_orderkey / 25.0) AS BIGINT)"
_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"

SQL: dict[str, str] = {
    "v_equation": f"""
SELECT doc_id, page_no, seq, concat('eq_', CAST(seq AS STRING)) AS equation_id, label_raw, replace(latex, '@', chr(92)) AS latex, plain_text,
       confidence, provider, is_inline, category, flag
FROM (SELECT {_DOC} AS doc_id, CAST(l_linenumber AS INT) AS page_no,
  CAST(row_number() OVER (PARTITION BY {_DOC} ORDER BY {_ORDER}) AS BIGINT) AS seq,
  CASE WHEN l_partkey % 6 = 0 THEN '' ELSE concat(CASE WHEN l_suppkey % 2 = 0 THEN 'Eq. ' ELSE 'Eq.' END, CAST(l_partkey % 9 + 1 AS STRING),
    CASE WHEN l_partkey % 11 = 0 THEN '. ' ELSE '.' END,
    CASE WHEN l_suppkey % 7 = 0 THEN 'l' WHEN l_suppkey % 7 = 6 THEN 'I0' ELSE CAST(l_suppkey % 7 + 1 AS STRING) END,
    CASE WHEN l_partkey % 5 = 0 THEN '(a)' WHEN l_partkey % 5 = 1 THEN ' (b)' ELSE '' END) END AS label_raw,
  CASE l_partkey % 16
    WHEN 0 THEN concat('@frac{{a}}{{', CAST(l_linenumber AS STRING), '}} = x_{{e}}')
    WHEN 1 THEN concat('= @sqrt{{', CAST(l_suppkey AS STRING), '}}')
    WHEN 2 THEN 'Eq. 3.9.1'
    WHEN 3 THEN 'the value which follows from this equation'
    WHEN 4 THEN concat('a = b @tag{{', CAST(l_suppkey % 5 AS STRING), '}} @tag{{2}}')
    WHEN 5 THEN '@left( x_{{e}} @right) @tag{{2-4}}'
    WHEN 6 THEN '' WHEN 7 THEN 'x + y'
    WHEN 8 THEN concat('$$ E = m c^{{2}} @quad (', CAST(l_suppkey % 9 + 1 AS STRING), '.2) $$')
    WHEN 9 THEN '@text{{for all of the values}} y @leq 4'
    WHEN 10 THEN '@begin{{aligned}} a &= b @end{{aligned'
    WHEN 11 THEN concat('f(x) = ', CAST(l_linenumber AS STRING), ' x -') WHEN 12 THEN '42'
    WHEN 13 THEN '@dfrac{{@alpha}}{{@beta}} @cdots' WHEN 14 THEN '2H2 + O2 -> 2H2O'
    ELSE 'k = 3 ++ 4' END AS latex,
  CASE l_suppkey % 12 WHEN 0 THEN 'x = 1' WHEN 1 THEN '2H2 + O2 -> 2H2O' WHEN 2 THEN 'the benzene ring structure' WHEN 3 THEN 'F = 12 kN'
    WHEN 4 THEN 'mean variance of the distribution' WHEN 5 THEN 'p = rho g h' WHEN 6 THEN 'where this is shown by the table' WHEN 7 THEN ''
    WHEN 8 THEN concat('a_', CAST(l_linenumber AS STRING), ' + b^2 = c') WHEN 9 THEN 'E [ X ] and P ( A )' WHEN 10 THEN '(3.2)' ELSE 'sin(x) + cos(y)' END AS plain_text,
  l_discount * 10 AS confidence, CASE l_returnflag WHEN 'A' THEN 'vision' WHEN 'N' THEN 'plain_text' ELSE 'layout' END AS provider,
  l_linestatus = 'F' AS is_inline,
  CASE l_suppkey % 4 WHEN 0 THEN 'mathematical_equation' WHEN 1 THEN 'engineering_formula' WHEN 2 THEN 'chemical_equation' ELSE '' END AS category,
  CASE WHEN l_tax >= 0.06 THEN 'invalid_latex' WHEN l_tax >= 0.04 THEN 'low_confidence' WHEN l_tax >= 0.03 THEN 'duplicate' ELSE '' END AS flag
  FROM {{lineitem}}) AS e""",
    "v_expected": """
SELECT DISTINCT CAST(floor(o_orderkey / 25.0) AS BIGINT) AS doc_id, concat('(', CAST(o_custkey % 9 + 1 AS STRING), '.', CAST(o_orderkey % 7 + 1 AS STRING),
  CASE WHEN o_custkey % 3 = 0 THEN '(a)' ELSE '' END, ')') AS label_raw FROM {orders}""",
    "v_box": f"""
SELECT {_DOC} AS doc_id, CAST(l_linenumber AS INT) AS page_no, CAST(row_number() OVER (PARTITION BY {_DOC}, l_linenumber ORDER BY {_ORDER}) AS BIGINT) AS box_seq,
  CAST(l_partkey * 7 % 400 AS DOUBLE) AS x0, CAST(l_suppkey * 11 % 700 AS DOUBLE) AS y0,
  CAST(l_partkey * 7 % 400 + l_quantity * 4 + 5 AS DOUBLE) AS x1, CAST(l_suppkey * 11 % 700 + floor(l_tax * 400) + 8 AS DOUBLE) AS y1,
  CAST(l_partkey % 4 AS INT) AS kind FROM {{lineitem}}""",
    "v_label_box": """
SELECT doc_id, page_no, concat(CAST(page_no AS STRING), '.', CAST(row_number() OVER (PARTITION BY doc_id, page_no ORDER BY o_orderkey) AS STRING)) AS label,
  x0, y0, x0 + 40.0 AS x1, y0 + 10.0 AS y1 FROM (
  SELECT CAST(floor(o_orderkey / 25.0) AS BIGINT) AS doc_id, CAST(o_orderkey % 7 + 1 AS INT) AS page_no, o_orderkey,
    CAST(380 + o_custkey % 60 AS DOUBLE) AS x0, CAST(o_custkey * 13 % 690 AS DOUBLE) AS y0 FROM {orders}) AS o""",
    "v_page": f"""
SELECT {_DOC} AS doc_id, CAST(l_linenumber AS INT) AS page_no, CAST(sum(floor(l_quantity)) AS BIGINT) AS char_count,
  CAST(sum(floor(l_quantity / 3)) AS BIGINT) AS word_count, sum(CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END) AS image_count,
  CAST(sum(l_suppkey) % 100 AS DOUBLE) / 100.0 AS image_coverage, max(l_partkey) % 4 <> 0 AS has_real_fonts, CAST(sum(l_partkey) % 100 AS DOUBLE) / 100.0 AS similarity
  FROM {{lineitem}} GROUP BY {_DOC}, l_linenumber""",
    "v_duplicate": "SELECT doc_id, sha256_text AS fingerprint, concat(lang, ':', source) AS logical_id FROM (SELECT doc_id, lang, source, md5(text) AS sha256_text FROM {documents}) AS d",
    "v_verdict": """
SELECT l.doc_id, l.quality = 1 AS accepted, CASE WHEN l.toxic = 1 THEN NULL ELSE CAST(d.n_chars % 100 AS DOUBLE) / 100.0 END AS score, d.lang AS category
  FROM {labels} AS l JOIN {documents} AS d ON l.doc_id = d.doc_id""",
    "v_stage_run": """
SELECT event_id, user_id AS doc_id, event_type AS stage, CASE WHEN event_type = 'error' THEN 'failed' WHEN event_id % 13 = 0 THEN 'skipped' ELSE 'completed' END AS status,
  value AS duration, ts, CAST(event_id % 5 AS INT) AS retry_count FROM {events}""",
    "v_metadata": """
SELECT p.p_partkey AS doc_id, concat('  ', p.p_name, '   Vol. ', CAST(p.p_size AS STRING)) AS title,
  concat(s.s_name, CASE p.p_partkey % 3 WHEN 0 THEN '; ' WHEN 1 THEN ' & ' ELSE ' / ' END, p.p_brand, ' ; ', s.s_name) AS author, p.p_type AS publisher
  FROM {part} AS p JOIN {supplier} AS s ON p.p_partkey % 10 = s.s_suppkey""",
    "v_line": "SELECT doc_id, lang, source, n_chars, text FROM {documents}",
}
#: Tables behind each view.
_BEHIND = {k: [t for t in TABLES if "{" + t + "}" in v] for k, v in SQL.items()}

#: What the rows of a view over `lineitem` are numbered by, and the rows of `lineitem` in a partition of a view dealt out:
#: so many that 216 million rows make under 200 partitions, above which the writers of a shuffle hold and sort its rows.
_NUMBERED_BY = {"v_equation": [_DOC], "v_box": [_DOC, "l_linenumber"]}
PART_ROWS = 1_250_000


def view_sql(name: str, table=lambda t: t) -> str:
    text = SQL[name]
    for t in _BEHIND[name]:
        text = text.replace("{" + t + "}", table(t))
    return text


def oracle_prefix(names: list[str]) -> str:
    return "WITH " + ", ".join(f"{n} AS ({view_sql(n)})" for n in names) + "\n" if names else ""


class Views:
    """Tables and views of one data folder, read lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        if name not in SQL:
            raise AttributeError(name)
        return self._view(name, {t: self.table(t) for t in _BEHIND[name]})

    def dealt(self, name: str) -> DataFrame:
        """The view over `lineitem` dealt out by what its rows are numbered by, about PART_ROWS to a task however large the table."""
        lines = self.lineitem
        n = max(self.spark.sparkContext.defaultParallelism, -(-lines.count() // PART_ROWS))
        return self._view(name, {"lineitem": lines.repartition(n, *map(F.expr, _NUMBERED_BY[name]))})

    def _view(self, name: str, tables: dict[str, DataFrame]) -> DataFrame:
        behind = {f"t_{t}": df for t, df in tables.items()}
        # braces of LaTeX must pass the formatter that binds the tables
        text = view_sql(name, lambda t: f"\x03t_{t}\x04").replace("{", "{{").replace("}", "}}").replace("\x03", "{").replace("\x04", "}")
        return self.spark.sql(text, **behind)
