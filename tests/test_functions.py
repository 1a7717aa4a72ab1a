"""Golden cases of the column functions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lemmata.functions import documents as D
from lemmata.functions import labels as L
from lemmata.functions import latex as X
from lemmata.functions import records as R
from lemmata.functions import scores as S
from lemmata.functions import text as T
from lemmata.operators import pixels as P
from lemmata.operators import stages as G
from lemmata.sources import providers


def one(spark, fn, *values):
    cols = [F.lit(v) for v in values]
    return spark.range(1).select(fn(*cols).alias("x")).first()["x"]


@pytest.mark.parametrize("raw,want", [("3.9.l(a)", "3.9.1(a)"), ("3.9.l(b)", "3.9.1(b)"), ("1O. I", "10.1"), ("", "")])
def test_label_normalise(spark, raw, want):
    assert one(spark, L.normalise_label, raw) == want


def test_label_matches(spark):
    got = one(spark, L.label_matches, "From Eq. 3.9.l(a) on\ny = mx  (5.2)\nz [1.1]\n0.5(2.3)\nw (2-30) end")
    assert {(r["label"], r["explicit"]) for r in got} == {("3.9.1(a)", True), ("2-30", True), ("5.2", False), ("1.1", False)}


@pytest.mark.parametrize("raw,want", [("(12.2.1)", "12.2.1"), (" [ 3.4A ] ", "3.4a"), ("2.l", "2.1"), ("{7}", "7")])
def test_number_normalise(spark, raw, want):
    assert one(spark, L.normalise_number, raw) == want


@pytest.mark.parametrize(
    "raw,want",
    [(r"\left( x_{e} \right) \tag{2-4}", "(x_e)"), (r"$$\dfrac{a}{b}$$", r"\frac{a}{b}"), (r"\[ a \quad b \]", "ab"), ("x (2-4)", "x"), ("", "")],
)
def test_latex_normalise(spark, raw, want):
    assert one(spark, X.normalise, raw) == want


@pytest.mark.parametrize(
    "latex,score,notes",
    [
        ("", 0.10, ["quality:empty_latex"]),
        (r"= \frac{a}{b}", 0.35, ["quality:lhs_clipped"]),
        ("Eq. 3.9.1", 0.10, ["quality:label_only"]),
        ("a b c d e f g", 0.10, ["quality:spaced_text"]),
        (r"a = b \tag{1} \tag{2}", 0.35, ["quality:multiple_tags"]),
        ("x^2 + y = z", 0.85, []),
    ],
)
def test_recognition_quality(spark, latex, score, notes):
    got = one(spark, S.recognition_quality, latex, "", "mathematical_equation")
    assert got["score"] == pytest.approx(score) and got["notes"] == notes


def test_formula_score(spark):
    got = one(spark, S.formula_score, "x = 1")
    assert got["score"] == pytest.approx(0.78) and got["is_formula"]
    assert one(spark, S.formula_score, "")["score"] == 0
    prose = one(spark, S.formula_score, "the value of this is shown by the table which was for all")
    assert not prose["is_formula"]


@pytest.mark.parametrize("text,want", [("2H2 + O2 -> 2H2O", "chemical_equation"), ("the benzene ring", "chemical_structure"), ("a = b", "mathematical_equation"), ("plain", "unknown")])
def test_category(spark, text, want):
    assert one(spark, S.category, text, "", "", False)["category"] == want


def test_ocr_quality_and_syntax(spark):
    assert one(spark, S.ocr_quality, "42") == pytest.approx(0.80)
    assert one(spark, S.ocr_quality, "") == 0
    assert one(spark, T.syntax_confidence, r"\frac{a}{b}") == pytest.approx(1.0)
    assert one(spark, T.syntax_confidence, "") == 0
    assert one(spark, T.syntax_confidence, r"\frac{a} \nosuch }") < 0.8
    assert one(spark, lambda x: T.balanced(x, "{", "}"), "}{") is False


def test_weights_without_layout(spark):
    got = one(spark, lambda a, b, c: S.aggregate_confidence({"recognition": a, "layout": F.lit(None).cast("double"), "syntax": b, "ocr": c}), 1.0, 0.0, 0.0)
    assert got == pytest.approx(0.35 / 0.85)
    with pytest.raises(ValueError):
        S.aggregate_confidence({"ocr": F.lit(1.0)}, "loudest")


@pytest.mark.parametrize("scanned,digital,want", [(0.7, 0.3, ("scanned", 0.7)), (0.5, 0.5, ("hybrid", 1.0))])
def test_document_modality(spark, scanned, digital, want):
    got = one(spark, D.document_modality, scanned, digital)
    assert (got["modality"], got["confidence"]) == want


def test_page_sample(spark):
    assert one(spark, D.even_sample, 25) == [0, 2, 5, 7, 10, 12, 15, 17, 20, 22]
    assert one(spark, D.even_sample, 3) == [0, 1, 2]


def test_similarity(spark):
    assert one(spark, T.char_similarity, "", "") == 1.0
    assert one(spark, T.char_similarity, "a", "") == 0.0
    assert one(spark, T.token_similarity, r"\frac{a}{b}", r"\dfrac{a}{b}") == 1.0
    assert one(spark, X.edit_similarity, "abcd", "abcx") == 0.75


def test_text_clean_up(spark):
    assert one(spark, T.normalise_block, "a hyphen-\nated  word\nand\n\nnext", "text_block") == "a hyphenated word and\n\nnext"
    assert one(spark, T.normalise_block, "x  =\n 1\n", "code_block") == "x  =\n 1"
    assert one(spark, T.ocr_fixes, "ða ¼ l.5Þ ; b") == "(a = 1.5) b"
    assert spark.sql("select array('a', ' a', 'b') x").select(R.dedup_lines(F.col("x")).alias("y")).first()["y"] == ["a", "b"]
    assert one(spark, providers.language, "the cat and the dog of that house is in it")["language"] == "en"


def test_stacked_split():
    def page(h, *boxes):
        g = np.full((h, 200), 255.0)
        for x0, y0, x1, y1 in boxes:
            g[y0:y1, x0:x1] = 0
        return g

    assert len(P.split_stacked(page(90, (20, 10, 175, 35), (92, 65, 105, 80)))) == 1
    assert len(P.split_stacked(page(100, (20, 8, 175, 30), (25, 68, 170, 92)))) == 2
    assert P.skew_to_angle(89.9) == pytest.approx(-0.1)
    assert P.layout_confidence(np.zeros((0, 0)), 300) is None
    assert P.metrics(np.full((50, 50), 255.0))["blank"]


def test_stage_plan():
    assert G.execution_order(G.EDGES, list(G.ORDER)) == G.ORDER
    assert G.restart_from(set(G.ORDER), "layout") == {"ingestion", "classification", "preprocessing"}
    with pytest.raises(G.PlanError):
        G.execution_order(G.EDGES, ["layout"])
    values, source = G.layered({"a": {"b": 1}, "c": True}, {"a": {"b": 2}}, overrides=["c=false"])
    assert values == {"a.b": 2, "c": False} and source == {"a.b": "file", "c": "override"}
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return 7

    assert G.retrying(flaky, sleep=lambda s: None)() == 7


def test_formula_score_looks_for_each_pattern_once(spark):
    score = lambda *c: S.formula_score(F.col("t"), F.col("k"), F.col("d"), F.col("w"), F.col("o"))
    rows = [("x = 1\n \n3.2", "text", 10.0, 0.3, 0.1), (None, "text", 10.0, 0.3, 0.1), ("x", "text", 10.0, 0.3, 0.1), ("the", "formula", None, None, None), ("(cid:1) (cid:2) (cid:3)", None, 40.0, None, None)]
    got = spark.createDataFrame(rows, "t string, k string, d double, w double, o double").select(score().alias("x"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert all(plan.count(p) == 1 for p in (S.ARROW, S.STOICH_RUN, S.INLINE, S.PROSE, S.VERB))
    want = [(1.0, True, False), (0.55, False, True), (0.0, False, False), (1.0, True, False), None]
    for r, w in zip(got.collect(), want):
        assert w is None or (pytest.approx(r["x"]["score"]), *r["x"][1:]) == w
    assert got.collect()[4]["x"]["score"] == pytest.approx(0.25 + 0.08 + 0.15)
