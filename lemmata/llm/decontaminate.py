"""Operator 5: benchmark decontamination, in DataFrame functions only.

Test items become windows of up to eight normalised words, hashed into one set.
That set is broadcast once a count shows that it is small, else joined by
shuffle. Texts are cut into words once; every token window is hashed word by word
inside generated code and looked up, and a hit is verified against the window that
it should equal. The scan leaves one row for each document and one for each hit.

Defined results: null texts have no words; an item without words has no window;
an item of fewer words than a window is one window; repeated items count once an
id, those of a null id as none; rows of ``docs`` with a null or repeated id are
documents of their own; an empty benchmark hits nothing; empty documents give an
empty table; texts of any length are read whole, and what is gathered for a
document are the items that it holds; other columns are not carried, but by
``drop_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, materialize, numbered, small_side, with_row

WINDOW = 8
#: What separates words, in Java's syntax: ASCII but letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str | Column) -> Column:
    """Words of the text, A-Z in lower case."""
    low = F.translate(F.coalesce((F.col(text) if isinstance(text, str) else text).cast("string"), F.lit("")), UPPER, LOWER)
    # one separator at most stands at either end, so nothing empty is left after the trim
    bare = F.trim(F.regexp_replace(low, BETWEEN, " "))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " "))


def key_of(w: str, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(w, at + k) for k in range(size)])


def item_windows(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item_id, size, key, window) of the items."""
    items = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), words(F.col(f"`{text_col}`")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    at = items.select("item_id", "w", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("w") - size)).alias("i"))
    key = F.coalesce(*[F.when(F.col("size") == k, key_of("w", F.col("i"), k)) for k in range(1, window + 1)])
    joined = F.array_join(F.slice("w", F.col("i") + 1, F.col("size")), " ")
    return materialize(at.select("item_id", "size", joined.alias("window"), key.alias("key")).distinct(), "windows")


def window_hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(row, id, n_words, at, size, window) of ``docs`` (row, id, text).

    A row with at = -1 for each document, and one for each verified occurrence of a
    window, at being its first word's index from 0.
    """
    keys = windows.select("size", "key", "window").distinct()
    sizes = sorted(r["size"] for r in keys.select("size").distinct().collect())  # 1 to WINDOW: bounded
    base = docs.select("row", "id", words("text").alias("w"))
    spot = base.select("row", "id", "w", F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("at"))
    at = F.col("at")
    # a document's own row has a size that no window has, and a key that few others have
    own = F.struct(F.lit(0).alias("size"), F.when(at < 0, F.col("row")).alias("key"))
    made = [F.struct(F.lit(k).alias("size"), F.when((at >= 0) & (at + k <= F.size("w")), key_of("w", at, k)).alias("key")) for k in sizes]
    seen = spot.select("row", "id", "w", "at", F.explode(F.array(own, *made)).alias("s")).select("row", "id", "w", "at", "s.size", "s.key")
    seen = seen.where("key is not null").alias("l")
    found = small_side(keys).alias("r")
    text = F.array_join(F.slice("l.w", F.col("l.at") + 1, F.col("l.size")), " ")
    # equality as two conditions that are no join keys, so that the text is made for hits only
    same = F.startswith(F.col("r.window"), text) & F.startswith(text, F.col("r.window"))
    both = seen.join(found, (F.col("l.size") == F.col("r.size")) & (F.col("l.key") == F.col("r.key")) & same, "left")
    return both.where("l.at < 0 or r.window is not null").select("l.row", "l.id", F.size("l.w").cast("long").alias("n_words"), "l.at", "l.size", "r.window")


def hit_words(hits: DataFrame) -> DataFrame:
    """Distinct (row, word) that occurrences cover."""
    return hits.where("at >= 0").select("row", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)).alias("word")).distinct()


def held_items(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """Distinct (row, item) of items with occurring windows."""
    owners = small_side(windows.where("item_id is not null").select("window", "item_id").distinct())
    return hits.where("at >= 0").select("row", "window").distinct().join(owners, "window").select("row", F.col("item_id").cast("string").alias("item")).distinct()


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_items: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256 and contaminated."""
    windows = item_windows(benchmark, window)
    hits = materialize(window_hits(with_row(docs, id_col, text_col), windows), "hits")
    # a document's words and items are folded by the map-side halves of these aggregates before they move
    n_hit = hit_words(hits).groupBy("row").agg(F.count("*").alias("n_hit"))
    joined = F.array_join(F.sort_array(F.collect_list("item")), ",")
    n_items = held_items(hits, windows).groupBy("row").agg(F.count("*").alias("n_items"), F.sha2(joined.cast("binary"), 256).alias("items_sha256"))
    out = hits.where("at < 0").select("row", "id", "n_words").join(n_hit.join(n_items, "row", "full"), "row", "left")
    n = F.coalesce("n_items", F.lit(0))
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        n.cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        (n >= least_items).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_items: int = 2, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs``, columns unchanged, that hold windows of fewer than ``least_items`` items."""
    windows, own = item_windows(benchmark, window), numbered(docs, id_col)
    hits = window_hits(own.select(F.col(ROW).alias("row"), F.lit(None).cast("long").alias("id"), "text"), windows).where("at >= 0")
    bad = held_items(hits, windows).groupBy("row").count().where(F.col("count") >= least_items)
    bad = materialize(bad.select(F.col("row").alias(ROW)), "contaminated")  # else the scan runs once more to be counted
    return own.join(small_side(bad), ROW, "left_anti").select(docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` as (id, text): normalised words without those that a window hits."""
    rows = with_row(docs, id_col, text_col)
    gone = hit_words(window_hits(rows, item_windows(benchmark, window))).groupBy("row").agg(F.collect_list("word").alias("gone"))
    base = rows.select("row", "id", words("text").alias("w")).join(gone, "row", "left")
    marks = F.map_from_arrays("gone", F.transform("gone", lambda _: F.lit(True)))
    kept = F.when(F.col("gone").isNull(), F.col("w")).otherwise(F.filter("w", lambda _, i: F.element_at(marks, i).isNull()))
    return base.select(F.col("id").alias(id_col), F.array_join(kept, " ").alias(text_col))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, size, list_aggregate(w[i + 1:i + size], 'string_agg', ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 8) AS size, unnest(range(0, len(w) - least(len(w), 8) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, pos, size, list_aggregate(w[pos + 1:pos + size], 'string_agg', ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(0, len(w) - size + 1)) AS pos FROM d, sizes WHERE len(w) >= size)),
h AS (SELECT doc_id, pos, dw.size, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
nh AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM h) GROUP BY 1),
ni AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS s
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(s, sha256('')) AS items_sha256,
       coalesce(n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN nh USING (doc_id) LEFT JOIN ni USING (doc_id)
"""
