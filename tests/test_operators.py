"""Operators on small tables, the files they read and write, streams, and the registry."""

import json

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F

from lemmata import plans
from lemmata.operators import analytics as A
from lemmata.operators import evaluation as E
from lemmata.operators import geometry as G
from lemmata.operators import runs as N
from lemmata.sources import files, providers
from lemmata.streaming import events

SF = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(plans.ORACLES) <= set(plans.QUERIES) and len(plans.QUERIES) >= 100
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_evaluation_golden(spark):
    detected = spark.createDataFrame([(1, "12.2.1"), (1, "12.2.2"), (1, "12.2.2")], "doc_id int, number string")
    expected = spark.createDataFrame([(1, "12.2.1"), (1, "12.2.3")], "doc_id int, number string")
    out = E.compare_sets(detected, expected)
    got = E.rates(out, ["doc_id"]).first()
    assert (got["tp"], got["recall"], got["precision"], got["f1"]) == (1, 0.5, 0.5, 0.5)
    assert {r["number"] for r in out.where("outcome = 'missed'").collect()} == {"12.2.3"}


def test_arbitration_golden(spark):
    rows = [(1, x, True) for x in ("1.1", "1.2", "1.3")] + [(1, x, False) for x in ("5.2", "5.3")] + [(2, x, False) for x in ("5.2", "5.3", "94.39")]
    got = E.arbitrate(spark.createDataFrame(rows, "doc_id int, label string, explicit boolean"))
    assert sorted((r["doc_id"], r["label"]) for r in got.collect()) == [(2, "5.2"), (2, "5.3")]


def test_collapsed_label_uses_up_one_sub_label(spark):
    x = spark.createDataFrame([(1, "3.9.1"), (2, "1"), (2, "1")], "doc_id int, label string")
    e = spark.createDataFrame([(1, "3.9.1(a)"), (1, "3.9.1(b)"), (2, "1"), (2, "2")], "doc_id int, label string")
    got = E.multiset_match(x, e)
    assert sorted(r["label"] for r in got.where("matched").collect()) == ["1", "3.9.1(a)"]
    assert got.where("doc_id = 1 AND NOT matched").first()["label"] == "3.9.1(b)"


def test_order_violation(spark):
    df = spark.createDataFrame([(1, i, p) for i, p in enumerate((0, 3, 1, 4))], "doc int, seq int, pos int")
    assert [r["violates"] for r in E.order_violations(df, ["doc"], "seq", "pos").orderBy("seq").collect()] == [False, False, True, False]


BOX = "doc_id int, page_no int, box_seq long, x0 double, y0 double, x1 double, y1 double"


def test_greedy_dedup_keeps_the_ends_of_a_chain(spark):
    df = spark.createDataFrame([(1, 1, k, 0.0, 1.5 * k, 10.0, 10.0 + 1.5 * k) for k in range(3)], BOX)
    assert sorted(r["box_seq"] for r in G.greedy_dedup(df, 0.7).collect()) == [0, 2]


def test_label_formula_union(spark):
    label = spark.createDataFrame([(1, 1, "a", 378.5, 596.65, 418.18, 607.15)], "doc_id int, page_no int, label string, x0 double, y0 double, x1 double, y1 double")
    boxes = spark.createDataFrame([(1, 1, 1, 92.6, 596.45, 128.23, 606.95), (1, 1, 2, 123.8, 588.77, 140.71, 613.84), (1, 1, 3, 35.5, 563.47, 91.97, 575.27)], BOX)
    got = G.label_formula(label, boxes).first()
    assert (got["fx0"], got["fy0"], got["fy1"], got["n_boxes"]) == (92.6, 588.77, 613.84, 2)


def test_as_of_and_ranges(spark):
    left = spark.createDataFrame([(1, 5, "x"), (1, 1, "y"), (2, 9, "z")], "k int, t int, name string")
    right = spark.createDataFrame([(1, 2, 20), (1, 5, 50), (2, 10, 1)], "k int, t int, v int")
    assert {r["name"]: r["v"] for r in A.as_of(left, right, ["k"], "t", ["v"]).collect()} == {"x": 50, "y": None, "z": None}
    ranges = spark.createDataFrame([("a", 0.0, 3.0), ("b", 2.0, 9.0)], "r string, lo double, hi double")
    points = spark.createDataFrame([(0.0,), (2.5,), (9.0,)], "p double")
    got = sorted((r["p"], r["r"]) for r in A.range_join(points, ranges, "p", "lo", "hi", 2.0).collect())
    assert got == [(0.0, "a"), (2.5, "a"), (2.5, "b")]


def test_validation_and_duplicates(spark):
    verdicts = spark.createDataFrame([(0, None), (9, None), (200, None), (9, "needs password"), (9, "bad")], "n int, e string")
    got = [r["v"] for r in verdicts.select(N.validate(F.col("n"), 100, F.col("e"), F.lit(1)).alias("v")).collect()]
    assert got == ["empty", "ok", "too_large", "encrypted", "corrupt"]
    docs = spark.createDataFrame([(1, "f", "a"), (2, "f", "b"), (3, "g", "a")], "doc_id int, fingerprint string, logical_id string")
    assert {r["doc_id"]: (r["duplicate_type"], r["original"]) for r in N.duplicate_lookup(docs).collect()} == {1: (None, None), 2: ("binary", 1), 3: ("logical", 1)}


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(b"%PDF")
    assert files.documents(spark, str(tmp_path / "in")).first()["length"] == 4
    (tmp_path / "s.json").write_text(json.dumps({"context": {"equations": [{"equation_id": "e1", "latex": "x", "odd": 1}]}}))
    assert files.sidecars(spark, str(tmp_path / "s.json")).first()["equation_id"] == "e1"
    for name, text in (("t1.txt", "# c\n1.1\n\n1.2\n"), ("t2.json", '["2.1"]'), ("t3.json", '{"equation_numbers": ["3.1", "3.2"]}')):
        (tmp_path / name).write_text(text)
    assert sorted(r["number"] for r in files.ground_truth(spark, f"{tmp_path}/t*").collect()) == ["1.1", "1.2", "2.1", "3.1", "3.2"]
    files.write_csv(spark.createDataFrame([(1, ["a", "b"])], "x int, f array<string>"), f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").first()["f"] == "a|b"
    files.append_failures(spark.createDataFrame([("b", "ocr", 1), ("b", "ocr", 3)], "book_id string, stage string, retry_count int"), f"{tmp_path}/fail")
    assert files.failures(spark, f"{tmp_path}/fail").count() == 1


def test_provider_errors_become_rows(spark):
    def factory():
        def client(row):
            if row["text"] == "bad":
                raise RuntimeError("no")
            return {"latex": row["text"], "confidence": 0.9}

        return client

    providers.register("test", factory)
    got = {r["id"]: r for r in providers.recognise(spark.createDataFrame([(1, "x"), (2, "bad")], "id int, text string"), "test").collect()}
    assert got[1]["latex"] == "x" and got[2]["error"] == "RuntimeError: no"
    with pytest.raises(KeyError):
        providers.resolve("nobody")


def test_streams_agree_with_batch(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/events.parquet").schema.simpleString()[len("struct<") : -1]
    src = tmp_path / "src"
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(str(src))
    stream = events.event_stream(spark, str(src), ", ".join(x.replace(":", " ", 1) for x in schema.split(",")))
    events.run_available(events.tumbling_counts(stream, late="3650 days"), f"{tmp_path}/out", f"{tmp_path}/chk", "append")
    total = spark.read.parquet(f"{SF}/events.parquet").count()
    seen = events.event_stream(spark, str(src), ", ".join(x.replace(":", " ", 1) for x in schema.split(","))).groupBy("event_type").count()
    q = seen.writeStream.outputMode("complete").format("memory").queryName("seen").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(count) from seen").first()[0] == total


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query_matches_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(plans.ORACLES[name]).df()
    got = plans.QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)

    def plain(df):
        df = df[sorted(df.columns)].astype(object)
        df = df.where(df.notna(), None)
        return sorted([tuple(f"{x:.6f}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x) for x in row) for row in df.values.tolist()])

    assert plain(got) == plain(want)


def one(spark, make, **values):
    """``make`` of columns of one row."""
    return spark.range(1).select(*[F.lit(x).alias(k) for k, x in values.items()]).select(make(*[F.col(k) for k in values]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "latex, failing",
    [
        (r"\frac{a}{b}", set()), (r"\frac12", {"frac_has_two_args"}), (r"\frac{\frac{a}{b}}{c}", set()), (r"\frac{\frac{a}}{c}", {"frac_has_two_args"}), (r"\dfrac {a} {b}", set()),
        ("x^(2)", {"scripts_have_args"}), ("x^ {2}_i", set()), ("x_", {"scripts_have_args"}), (r"\vec{x} + \hat{y} \in \mathbb{R} \Delta", set()), (r"\unheard", {"commands_are_known"}),
        (r"\left[ x \right]", {"left_right_matched"}), (r"\left( x \right)", set()), ("{" * 13 + "}" * 13, {"depth_within_limit"}), (")(", {"balanced_parens"}),
    ],
)
def test_syntax_checks(spark, latex, failing):
    from lemmata.functions import text

    checks = text.syntax_checks(F.col("x"))
    got = spark.createDataFrame([(latex,)], "x string").select(*[c.alias(n) for n, c in checks.items()]).first().asDict()
    assert {n for n, ok in got.items() if not ok} == failing


@pytest.mark.parametrize(
    "latex, check, fires",
    [("a +- b", "REPEATED_OPERATOR", True), ("a // b", "REPEATED_OPERATOR", True), ("a = = b", "REPEATED_OPERATOR", False), ("x--", "REPEATED_OPERATOR", False), (r"\textbf{x}", "NO_MATH_COMMANDS", True), (r"\sum x", "NO_MATH_COMMANDS", False)],
)
def test_ocr_checks(spark, latex, check, fires):
    from lemmata.functions import scores

    made = {n: c for n, c, _ in scores.ocr_checks(F.col("x"))}
    assert spark.createDataFrame([(latex,)], "x string").select(made[check]).first()[0] is fires


def test_layout_confidence():
    import numpy as np
    from lemmata.operators import pixels

    page = np.full((40, 100), 255.0)
    page[10:14, 20:60] = 0
    assert pixels.layout_confidence(page, 300) == pytest.approx((1 - 0.35) * 3 / 8)  # ten white rows above the ink are a band
    page[:9] = page[9] = 255
    page[2:10, 20:99] = 0
    dark = pixels.layout_confidence(page, 100)
    top, right = page[:3].mean(), page[:, -3:].mean()
    want = 1 - (0.10 if top < 240 else 0) - (0.25 if right < 240 else 0) - (1 - 100 / 150) * 0.30
    assert dark == pytest.approx(want * min(top, right, 255) / 255 * 3 / 8)
    assert pixels.layout_confidence(np.full((50, 60), 255.0), 60) == pytest.approx((0.20 - 0.15) * 3 / 8)
    assert pixels.layout_confidence(np.zeros((0, 0)), 300) is None


def test_documents_are_classified(spark):
    from lemmata.functions import documents as D

    def category(title, pages, multi, table=0.0, figure=0.0, equation=0.0):
        t = spark.createDataFrame([(title, pages, multi, table, figure, equation)], "t string, p int, m boolean, a double, b double, c double")
        got = D.select_category(D.category_scores(*[F.col(x) for x in "tpmabc"])).alias("g")
        return tuple(t.select(got).first()["g"])

    assert category("Steel Handbook and Reference Manual", 300, False, 0.2)[0] == "reference_handbook"
    assert category("", 12, True)[2] == "below_threshold"
    # two categories with one word each: neither is far enough ahead
    assert category("Patent Report", 60, False)[0] == "unknown"
    got = one(spark, D.banded_modality, d=0.5, s=0.3, n=10)
    assert (got["modality"], got["confidence"]) == ("hybrid", 0.5)
    assert one(spark, D.banded_modality, d=0.0, s=0.0, n=0)["modality"] == "scanned" and one(spark, D.banded_modality, d=0.85, s=0.1, n=9)["modality"] == "digital"
    got = one(spark, D.complexity, d=0.2, m=True)
    assert (got["level"], got["confidence"]) == ("complex", 0.8)
    got = one(spark, D.complexity, d=0.05, m=False)
    assert (got["level"], got["confidence"]) == ("simple", 0.8)
    named = {"digital|patent|simple": "a", "scanned": "b"}
    pick = lambda m, c, x: one(spark, lambda *k: D.recommend_strategy(*k, named, "z"), m=m, c=c, x=x)
    assert [pick("digital", "patent", "simple"), pick("digital", "patent", "complex"), pick("scanned", "patent", "simple"), pick("odd", "x", "y")] == ["a", "digital_text_first", "b", "z"]


def test_repair_needs_a_second_verdict(spark):
    from lemmata.operators import review

    rows = [("x", 0.4, False, True, "y"), ("x", 0.4, False, True, " x "), ("x", 0.4, False, False, "y"), ("x", 0.4, True, True, "y"), ("x", 0.4, False, True, None)]
    t = spark.createDataFrame(rows, "latex string, confidence double, accepted boolean, crop_valid boolean, corrected string").withColumn("provider", F.lit("p"))
    yes = review.repaired(t, lambda fix: (F.lit(True), F.lit(0.995), F.lit(None).cast("string"))).collect()
    assert [(r["latex"], r["confidence"], r["provider"]) for r in yes] == [("y", 0.99, "judge_repair")] + [("x", 0.4, "p")] * 4
    no = review.repaired(t, lambda fix: (F.lit(False), F.lit(0.9), F.lit("j"))).collect()
    assert not any(r["repaired"] for r in no)


def test_crops_of_all_shapes_are_measured_each_as_itself(spark):
    import numpy as np
    from lemmata.operators import pixels

    made = np.random.default_rng(5)
    drawn = [made.integers(0, 256, (h, w)) for h, w in ((34, 60), (2, 9), (34, 60), (50, 1), (40, 100))]
    drawn[0][:] = 255
    stacked = np.full((100, 200), 255)
    stacked[8:30, 20:175] = stacked[68:92, 25:170] = 0
    drawn += [stacked, stacked.T, np.zeros((0, 0), int), None]
    dpi = [300.0, 60.0, 100.0, None, 149.0, 200.0, 72.0, 90.0, 90.0]
    rows = [(i, None if g is None else g.tolist(), x) for i, (g, x) in enumerate(zip(drawn, dpi))]
    t = spark.createDataFrame(rows, "id int, gray array<array<int>>, dpi double")
    got = {r["id"]: r for r in pixels.crop_quality(t.coalesce(1)).collect()}
    for i, g in enumerate(drawn):
        g = np.zeros((0, 0)) if g is None else g.astype(float)
        want = pixels.metrics(g) | {"layout": pixels.layout_confidence(g, dpi[i]), "n_parts": len(pixels.split_stacked(g)) if g.size else 0}
        assert {k: got[i][k] for k in want} == {k: x if x is None else pytest.approx(x) for k, x in want.items()}
    assert got[5]["n_parts"] == 2 and got[7]["layout"] is None


def test_crops_of_one_file_are_drawn_in_many_tasks(spark):
    from lemmata.plans import content
    from lemmata.sources.views import Views

    crops = content.crops(Views(spark, SF))
    assert crops.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    size = {r["p_partkey"]: r["p_size"] for r in Views(spark, SF).part.collect()}
    for r in crops.limit(20).collect():
        n = size[r["p_partkey"]]
        ink = lambda y, x: (4 < y < 14 or 30 < y < 42) and 3 < x < 40 + n
        assert r["gray"] == [[0 if ink(y, x) else 255 for x in range(100)] for y in range(31 + n)]


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("view", ["v_box", "v_equation"])
def test_dealt_views_have_tasks_by_their_rows(spark, monkeypatch, view):
    from lemmata.sources import views

    monkeypatch.setattr(views, "PART_ROWS", 500)
    v = views.Views(spark, SF)
    dealt = v.dealt(view)
    assert shuffles(dealt) == 1 and dealt.rdd.getNumPartitions() == -(-v.lineitem.count() // 500)
    assert dealt.exceptAll(getattr(v, view)).count() == 0 and dealt.count() == v.lineitem.count()


def test_span_islands_take_one_shuffle_of_many_parts(spark, monkeypatch):
    from lemmata.sources import views

    monkeypatch.setattr(views, "PART_ROWS", 500)
    df = plans.QUERIES["span_islands"](spark, SF)
    assert shuffles(df) == 1 and df.rdd.getNumPartitions() >= 12


def test_ink_bands_of_tall_boxes(spark):
    from lemmata.operators import pixels

    # tall boxes, boxes that touch, fractions that cancel out, and boxes without rows
    rows = [(1, 0, 2_000_000_000, 40.0), (1, 5, 10, 30.0), (1, 10, 12, 20.5), (1, 12, 20, 10.0), (1, 30, 31, 20.0), (1, 50, 51, 21.0), (1, 60, 60, 99.0), (1, 70, 60, 99.0)]
    rows += [(2, 0, 3, 0.1), (2, 0, 1, 0.2), (2, 0, 3, 59.9), (3, 0, 4, 61.0), (3, 2, 3, None), (3, None, 9, 70.0), (4, 3, 5, 61.0), (4, 5, 7, 62.0), (4, 8, 9, 70.0)]
    boxes = spark.createDataFrame(rows, "page int, start long, end long, w double")
    got = sorted((r["page"], r["first"], r["last"], round(r["ink"], 6)) for r in pixels.ink_bands(boxes, ["page"], 60.0).collect())
    assert got == [(1, 5, 11, 471.0), (1, 50, 50, 61.0), (2, 0, 0, 60.2), (3, 0, 3, 244.0), (4, 3, 6, 246.0), (4, 8, 8, 70.0)]


def test_ink_bands_shuffle_boxes_once(spark):
    assert shuffles(plans.QUERIES["ink_bands"](spark, SF)) == 1


def test_inline_spans_of_words(spark):
    from lemmata.functions import scores
    from lemmata.operators import assembly

    texts = ["we have x = 1 so that a_1 plus b^2 the c=d", "no maths here", "", None, "αx", "Δt →", "x\t=\n1"]
    t = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    df = assembly.inline_spans(t, "text", scores.INLINE + r"|[=+^_\\]", scores.PROSE)
    got = sorted((r["id"], r["span_no"], r["span"]) for r in df.collect())
    # a word between two of mathematics joins them unless it is prose
    assert got == [(0, 0, "="), (0, 1, "a_1 plus b^2"), (0, 2, "c=d"), (4, 0, "αx"), (5, 0, "Δt →"), (6, 0, "=")]


def test_patterns_matched_in_lambdas_are_short_to_decode(spark):
    from lemmata.functions import scores

    assert all(p.isascii() for p in (scores.INLINE, scores.ARROW, scores.RELATIONAL))
    signs = "αςωΑΩδ∑¼≈×→⟶∃é"
    got = spark.createDataFrame([(c,) for c in signs], "c string").select("c", *[F.col("c").rlike(p) for p in (scores.INLINE, scores.ARROW, scores.RELATIONAL)]).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {c: (c not in "ς¼é", c in "→⟶", c in "¼≈") for c in signs}


def test_inline_spans_take_one_shuffle_of_many_parts(spark, monkeypatch):
    from lemmata.sources import views

    monkeypatch.setattr(views, "PART_ROWS", 500)
    for name in ("inline_spans", "formula_score"):
        df = plans.QUERIES[name](spark, SF)
        assert shuffles(df) == 1 and df.rdd.getNumPartitions() == 12


def test_crop_quality_runs_in_many_tasks(spark):
    assert plans.QUERIES["crop_quality"](spark, SF).rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
