"""Folds over the blocks of a page whose state depends on what was taken before."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE = ["doc_id", "page_no"]


def merge_rows(boxes: DataFrame, share: float = 0.5) -> DataFrame:
    """Fragments of a row merged into boxes: in order of (y0, x0), into the first group that overlaps by ``share`` of the lower height."""
    item = F.struct("y0", "x0", "y1", "x1")
    start = F.filter(F.transform(F.collect_list(item), lambda b: b), lambda b: F.lit(False))
    lists = boxes.groupBy(*PAGE).agg(F.array_sort(F.collect_list(item)).alias("all"), start.alias("none"))

    def step(groups, b):
        over = lambda g: F.least(g["y1"], b["y1"]) - F.greatest(g["y0"], b["y0"]) >= share * F.least(g["y1"] - g["y0"], b["y1"] - b["y0"])
        first = F.array_position(F.transform(groups, over), True)
        joined = lambda g: F.struct(
            F.least(g["y0"], b["y0"]).alias("y0"), F.least(g["x0"], b["x0"]).alias("x0"), F.greatest(g["y1"], b["y1"]).alias("y1"), F.greatest(g["x1"], b["x1"]).alias("x1")
        )
        return F.when(first > 0, F.transform(groups, lambda g, i: F.when(i + 1 == first, joined(g)).otherwise(g))).otherwise(F.concat(groups, F.array(b)))

    merged = lists.select(*PAGE, F.posexplode(F.aggregate("all", "none", step)).alias("group", "g"))
    return merged.select(*PAGE, F.col("group").cast("long").alias("group"), "g.x0", "g.y0", "g.x1", "g.y1")


def grow(blocks: DataFrame) -> DataFrame:
    """Formula blocks grown by neighbours up and down until one can't be joined; ``blocks`` (page, box_seq, box, text, is_seed).

    Pages come sorted, one after the other; a page is a bounded group, and is handled whole.
    """
    def joins(a, b) -> bool:
        height = max(a["y1"] - a["y0"], b["y1"] - b["y0"])
        gap = max(0.0, max(a["y0"], b["y0"]) - min(a["y1"], b["y1"]))
        across = min(a["x1"], b["x1"]) - max(a["x0"], b["x0"])
        narrow = max(1e-9, min(a["x1"] - a["x0"], b["x1"] - b["x0"]))
        centre = abs((a["x0"] + a["x1"]) / 2 - (b["x0"] + b["x1"]) / 2) / 612.0
        second = "=" in a["text"] and "=" in b["text"] and gap > 3
        return gap <= max(18.0, 0.75 * height) and (across / narrow >= 0.2 or centre <= 0.18 or -across <= 8) and not second

    def page(rows: list[dict]) -> list[tuple]:
        taken: set[int] = set()
        out = []
        for k, seed in enumerate(rows):
            if not seed["is_seed"] or k in taken:
                continue
            taken.add(k)
            whole, n = dict(seed), 1
            for steps in (range(k - 1, -1, -1), range(k + 1, len(rows))):
                for j in steps:
                    if j in taken or not joins(whole, rows[j]):
                        break
                    taken.add(j)
                    b = rows[j]
                    n += 1
                    whole |= {"x0": min(whole["x0"], b["x0"]), "y0": min(whole["y0"], b["y0"]), "x1": max(whole["x1"], b["x1"]), "y1": max(whole["y1"], b["y1"]), "text": whole["text"] + " " + b["text"]}
            out.append((seed["doc_id"], seed["page_no"], seed["box_seq"], n, whole["x0"], whole["y0"], whole["x1"], whole["y1"]))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "page_no", "seed", "n", "x0", "y0", "x1", "y1"]
        key, rows = None, []  # of the page now read, which may begin in one batch and end in another
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                if (row["doc_id"], row["page_no"]) != key:
                    out += page(rows)
                    key, rows = (row["doc_id"], row["page_no"]), []
                rows.append(row)
            yield pd.DataFrame(out, columns=names)
        yield pd.DataFrame(page(rows), columns=names)

    dealt = blocks.repartition(*PAGE).sortWithinPartitions(*PAGE, "y0", "x0", "box_seq")
    return dealt.mapInPandas(run, "doc_id long, page_no int, seed long, n long, x0 double, y0 double, x1 double, y1 double")


def inline_spans(df: DataFrame, text: str, maths: str, prose: str) -> DataFrame:
    """Spans of words that hold mathematics, joined over single words between them that are no prose: gaps and islands of words."""
    words = df.withColumn("__w", F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    marked = words.withColumn("__m", F.transform("__w", lambda w: w.rlike(maths)))
    at = lambda i: F.coalesce(F.get("__m", i), F.lit(False))
    kept = F.transform("__w", lambda w, i: F.when(at(i) | (at(i - 1) & at(i + 1) & ~w.rlike(prose)), w).otherwise("\x1f"))
    runs = F.split(F.array_join(kept, " "), r"\s*\x1f\s*")
    return marked.select(*df.columns, F.posexplode(F.filter(runs, lambda r: F.trim(r) != "")).alias("span_no", "span")).withColumn("span", F.trim("span"))
