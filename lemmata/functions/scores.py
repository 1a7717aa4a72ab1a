"""Column functions that score and classify candidates and recognised equations."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from .latex import RELATION

GREEK = "αβγδεζηθικλμνξοπρστυφχψωΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"


def ascii_only(pattern: str) -> str:
    """``pattern`` with escapes for other characters: inside lambdas, the engine decodes a pattern anew for every match."""
    return "".join(c if c < "\x80" else f"\\u{ord(c):04x}" for c in pattern)


# Fixed word lists and patterns.
PROSE = (
    r"(?i)\b(?:the|a(?:n|nd)?|is|are|was|were|be|been|have|has|had|do|does|did|will|would|shall|should|may|might|must|can|could|"
    r"but|or|for|yet|so|because|since|although|while|where|when|which|this|these|those|by|in|on|at|to|of|with|from|into|between)\b"
)
VERB = r"(?i)\b(?:is|are|was|were|have|has|do|does|did|will|would|shall|should|may|might|must|can|could)\b"
ARROW = ascii_only(r"[→⇌⇒⇄↔⟶]|--\+|(?<![<\-])->(?!-)")
STOICH_RUN = r"(?<![A-Za-z0-9])\d{1,3}(?:\.\d{1,3})?[ \t]*[A-Z][a-z]?[A-Za-z0-9,]*"
RELATIONAL = ascii_only(r"[=¼≈≠≤≥]")
MATH_CHARS = f"{GREEK}∑∫∂√∞±×÷≤≥≠≈→↔⇒⇄⇌⟶∇∆∈∉∩∪⊂⊃∀∃=+*^_|¼"
# The lookahead spares ASCII, which nearly all characters are, a walk along the class.
INLINE = ascii_only(
    rf"(?![\x00-\x7f])[{GREEK}∑∫∂√∞±×÷≤≥≠≈→↔⇒⇄⇌⟶∇∆∈∉∩∪⊂⊃∀∃]"
    r"|[a-zA-Z0-9\)\]\.]\s*[=≈<>≤≥]\s*[a-zA-Z0-9\(\[\-]|[a-zA-Z]\s*_\s*[a-zA-Z0-9{]|[a-zA-Z]\s*\^\s*[a-zA-Z0-9{]"
    r"|[0-9]\s*[eE][+-]?[0-9]|[A-Z]\s*/\s*[A-Z]|\bΔ[A-Za-z]|\bδ[A-Za-z]|\b(?:sin|cos|tan|log|ln|exp|lim|max|min)\s*[\(\[]"
    r"|--\+|(?<![<\-])->(?!-)|(?<![A-Za-z])\d+\.?\d*\s*[A-Z][a-z]?[A-Za-z0-9,]+|[A-Z][a-z]?\d*[A-Z][a-z]?\d"
)
MATH_OPS = rf"[{GREEK}∑∫∂√∞±×÷≤≥≠≈∇∆]|[=^_]|\b(sin|cos|tan|log|ln|exp|lim)\b"
REACTION = r"[→⇌⇒⇄↔⟶]|-+>|<-+|=+>|--\+"
MOLECULE = r"\b(?:[A-Z][a-z]?\d*){2,}\b"
STOICH = r"(?:^|[\s+])\d+\.?\d*\s*[A-Z][a-z]?"
STRUCTURE = r"(?i)\b(benzene|ring|bond|aromatic|cyclo|structure)\b"
STATISTIC = r"\b(Var|Cov|Pr|SD|std|mean|median|variance|distribution|regression|correlation)\b|[μσ]|\bP\s*\(|\bE\s*\["
UNIT = r"\b\d+(?:\.\d+)?\s*(?:kN|kPa|MPa|GPa|Pa|kg|kW|MW|Hz|kHz|mm|cm|km|m/s|rad|psi|ft|lb|J|kJ|N|W|K)\b"
CONTEXT = r"(?i)\b(?:stress|strain|load|beam|flow|pressure|engine|thermal|heat|fluid|voltage|current)\b"
LABEL_ONLY = (
    r"(?i)^\s*(?:Eq(?:uation)?[.:]?\s*\d+(?:\.\d+){1,4}|\(\s*\d+(?:[-.]\d+){1,4}\s*\)|\[\s*\d+(?:[-.]\d+){1,4}\s*\]"
    r"|\\left\s*\(\s*\d+(?:\s*[-–]\s*\d+){1,4}\s*\\right\s*\))\s*$"
)
SPACED = r"\b([A-Za-z]\s){4,}[A-Za-z]\b"
QUALITY_PROSE = (
    r"(?i)\b(?:where|which|from|then|becomes|therefore|the|this|that|these|those|for|with|into|using|equation|factor|value|note)\b"
)
CONNECTIVE = r"(?i)\b(?:or|and|the|for|with|at|of|in|is|are|to|by)\b"
MATH_CATEGORIES = ("mathematical_equation", "engineering_formula", "statistical_expression")
TEXT_BLOCK = r"\\text\{[^}]*\}"
ANY_TOKEN = r"\\[a-zA-Z]+|\S"


def case(cond: Column, value: float) -> Column:
    return F.when(cond, F.lit(value)).otherwise(F.lit(0.0))


def n_of(x: Column, pattern: str) -> Column:
    return F.regexp_count(x, F.lit(pattern))


def bound(make: Callable[[Column], Column], **values: Column) -> Column:
    """``make`` of a struct of ``values``, each of which is worked out once however often ``make`` names it."""
    return F.get(F.transform(F.array(F.struct(*[c.alias(k) for k, c in values.items()])), make), F.lit(0))


def fraction_layout(text: Column) -> Column:
    def short(lines: Column) -> Column:
        return F.size(lines).between(2, 4) & ~F.exists(lines, lambda x: F.length(x) > 80) & ~text.rlike(VERB) & ~F.get(lines, F.lit(0)).rlike(r"^\d[\d\.]*\.?$")

    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return text.contains("\n") & bound(lambda x: short(x["lines"]), lines=lines)


def formula_score(text: Column, typed: Column | None = None, distance: Column | None = None, width_ratio: Column | None = None, offset: Column | None = None) -> Column:
    """struct<score, is_formula, needs_review> of a candidate block.

    ``distance`` in points to the label, ``width_ratio`` to the page, ``offset`` of the centre; nulls are unknown.
    """
    of = lambda score, formula, review: F.struct(score.alias("score"), formula.alias("is_formula"), review.alias("needs_review"))
    no = F.lit(False)
    d, w, o = (F.lit(None).cast("double") if x is None else x for x in (distance, width_ratio, offset))

    def signs(t: Column) -> dict[str, Column]:
        steps = lambda n, *least: bound(lambda x: reduce(lambda c, k: c.when(x["n"] >= k[0], k[1]), least, F).otherwise(0.0), n=n)
        maths = [
            case(t.rlike(ARROW), 0.40),
            steps(n_of(t, STOICH_RUN), (3, 0.25), (2, 0.15)),
            case(t.rlike(RELATIONAL), 0.40),
            steps(F.length(t) - F.length(F.translate(t, MATH_CHARS, "")), (6, 0.30), (3, 0.20), (1, 0.10)),
            F.when(t.contains("(cid:"), steps(n_of(t, r"\(cid:\d+\)"), (3, 0.25), (1, 0.12))).otherwise(0.0),
            case(t.rlike(INLINE), 0.20),
        ]
        return {"maths": reduce(add, maths), "layout": case(fraction_layout(t), 0.28), "short": F.length(t) < 80, "prose": n_of(t, PROSE), "d": d, "w": w, "o": o}

    def added(x: Column) -> Column:
        positive = x["maths"] + x["layout"] + case(x["short"], 0.08)
        positive = positive + F.when(x["d"] < 30, 0.30).when(x["d"] < 80, 0.15).otherwise(0.0)
        return positive + case(x["w"] < 0.55, 0.15) + case(x["o"] < 0.20, 0.10)

    def judged(x: Column, y: Column) -> Column:
        none = (x["maths"] == 0) & (x["layout"] == 0)
        c = y["clamped"]
        return F.when(none, of(c, no, F.coalesce((x["d"] < 30) & (y["positive"] >= 0.25), no))).otherwise(of(c, c >= 0.45, (c >= 0.25) & (c < 0.45)))

    def scored(x: Column) -> Column:
        lost = F.when(x["prose"] >= 5, 0.50).when((x["prose"] >= 3) & (x["maths"] == 0), 0.25).otherwise(0.0)
        clamped = lambda positive: F.greatest(F.lit(0.0), F.least(F.lit(1.0), positive - case(x["w"] > 0.88, 0.20) - lost))
        return bound(lambda y: bound(lambda z: judged(x, z), positive=y["positive"], clamped=clamped(y["positive"])), positive=added(x))

    def out(t: Column) -> Column:
        return F.when((F.length(t) <= 1) | (F.length(t) > 250), of(F.lit(0.0), no, no)).otherwise(bound(scored, **signs(t)))

    got = bound(lambda x: out(x["t"]), t=F.trim(text))
    if typed is None:
        return got
    return F.when(typed.isin("equation", "formula"), of(F.lit(1.0), F.lit(True), no)).otherwise(got)


def category(text: Column, context: Column, region_type: Column, is_inline: Column) -> Column:
    """struct<category, confidence>; the first rule that holds decides."""
    maths, molecule, stat = text.rlike(MATH_OPS), text.rlike(MOLECULE), text.rlike(STATISTIC)
    stoich = n_of(text, STOICH)
    rules = [
        (text.rlike(REACTION) | (molecule & (stoich > 0) & ~maths) | ((stoich >= 2) & ~maths), "chemical_equation", 0.85),
        (text.rlike(STRUCTURE) | (molecule & ~maths & ~stat), "chemical_structure", 0.75),
        (stat, "statistical_expression", 0.70),
        (text.rlike(UNIT) | context.rlike(CONTEXT), "engineering_formula", 0.70),
        (maths, "mathematical_equation", 0.80),
        (region_type != "", "mathematical_equation", 0.60),
        (is_inline, "mathematical_equation", 0.55),
    ]
    out = F.when(F.lit(False), F.struct(F.lit("").alias("category"), F.lit(0.0).alias("confidence")))
    for cond, name, c in rules:
        out = out.when(cond, F.struct(F.lit(name).alias("category"), F.lit(c).alias("confidence")))
    return out.otherwise(F.struct(F.lit("unknown").alias("category"), F.lit(0.3).alias("confidence")))


def labelled_category(text: Column) -> Column:
    return (
        F.when(F.trim(text) == "", F.struct(F.lit("mathematical_equation").alias("category"), F.lit(0.50).alias("confidence")))
        .when(text.rlike(UNIT), F.struct(F.lit("engineering_formula").alias("category"), F.lit(0.75).alias("confidence")))
        .when(text.rlike(REACTION) & text.rlike(r"[A-Z][a-z]?\d"), F.struct(F.lit("chemical_equation").alias("category"), F.lit(0.65).alias("confidence")))
        .otherwise(F.struct(F.lit("mathematical_equation").alias("category"), F.lit(0.70).alias("confidence")))
    )


def recognition_quality(latex: Column, plain: Column, cat: Column) -> Column:
    """struct<score, notes>; notes name every cap that applied."""
    t = F.trim(F.coalesce(latex, F.lit("")))
    is_math = F.coalesce(cat.isin(*MATH_CATEGORIES), F.lit(False))
    prose = is_math & (n_of(t, QUALITY_PROSE) >= 2) & ~t.rlike(RELATION)
    blocks = F.regexp_extract_all(t, F.lit(r"\\text\{([^}]*)\}"), F.lit(1))
    in_text = is_math & ~prose & F.exists(blocks, lambda b: F.regexp_count(b, F.lit(CONNECTIVE)) >= 2)
    short = F.length(F.regexp_replace(t, r"\\[a-zA-Z]+|\s", "")) < 3
    tags = n_of(t, r"\\tag\b") >= 2
    lines = is_math & ~tags & (F.size(F.filter(F.split(t, "\n"), lambda x: x.rlike(RELATION))) >= 2)
    body = F.trim(F.regexp_replace(t, r"\\tag\s*\{[^}]*\}", ""))
    clipped = body.rlike(r"^\s*(?:\\[a-zA-Z]+\s*)?=")
    no_relation = is_math & ~clipped & ~body.rlike(RELATION)
    caps = [
        (prose, 0.20, "prose_contamination"), (in_text, 0.30, "prose_in_text_block"), (short, 0.30, "suspiciously_short"), (tags, 0.35, "multiple_tags"),
        (lines, 0.45, "multiple_equations"), (clipped, 0.35, "lhs_clipped"), (no_relation, 0.45, "no_relational_operator"),
    ]
    score = F.least(F.lit(0.85), *[F.when(c, F.lit(v)).otherwise(F.lit(0.85)) for c, v, _ in caps])
    notes = F.filter(F.array(*[F.when(c, F.lit(f"quality:{n}")) for c, _, n in caps]), lambda x: x.isNotNull())
    only = lambda s, n: F.struct(F.lit(s).alias("score"), (F.array(F.lit(n)) if n else F.array().cast("array<string>")).alias("notes"))
    chemistry = cat.isin("chemical_structure", "chemical_equation")
    return (
        F.when(chemistry & (F.trim(F.coalesce(plain, F.lit(""))) != ""), only(0.85, ""))
        .when(chemistry, only(0.0, ""))
        .when(t == "", only(0.10, "quality:empty_latex"))
        .when(is_math & t.rlike(SPACED), only(0.10, "quality:spaced_text"))
        .when(t.rlike(LABEL_ONLY), only(0.10, "quality:label_only"))
        .otherwise(F.struct(score.alias("score"), notes.alias("notes")))
    )


def recognition_confidence(latex: Column, high_text: float = 0.5) -> Column:
    """From proxies, where the model gave no probabilities."""
    ratio = n_of(latex, TEXT_BLOCK) / F.greatest(n_of(latex, ANY_TOKEN), F.lit(1))
    score = (
        F.lit(0.85)
        - case(ratio > high_text, 0.20)
        - case(~latex.rlike(r"\\[a-zA-Z]"), 0.25)
        - case((F.length(F.trim(latex)) > 4) & ~latex.rlike(RELATION), 0.15)
        - case(latex.rlike(r"^\s*.\s*$"), 0.30)
    )
    return F.when(F.coalesce(F.trim(latex), F.lit("")) == "", 0.10).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


def confidence_from_logprobs(logprobs: Column, uncertain: float = 0.4, normaliser: float = 0.3) -> Column:
    n = F.size(logprobs)
    total = F.aggregate(logprobs, F.lit(0.0), lambda s, x: s + x)
    low = F.size(F.filter(logprobs, lambda x: F.exp(x) < uncertain))
    score = 0.5 * F.exp(total / n) + 0.3 * (1 - low / n) + 0.2 * F.least(F.exp(F.array_min(logprobs)) / normaliser, F.lit(1.0))
    return F.when(n > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


#: Checks of OCR quality: severity weights are error .40, warning .15, info .05.
def ocr_checks(x: Column, high_text: float = 0.5) -> list[tuple[str, Column, float]]:
    commands = n_of(x, r"\\(?!text)[a-zA-Z]+") > 0
    ratio = n_of(x, TEXT_BLOCK) / F.greatest(n_of(x, ANY_TOKEN), F.lit(1))
    return [
        ("ALL_TEXT_NO_MATH", x.rlike(TEXT_BLOCK) & ~commands, 0.40),
        ("STARTS_WITH_EQUALS", x.rlike(r"^\s*="), 0.15),
        ("REPEATED_OPERATOR", x.rlike(r"(?:^|[^\\a-zA-Z])[+\-*/]{2,}"), 0.15),
        ("DANGLING_OPERATOR", x.rlike(r"(?:\\times|\\cdot|\\div|\\pm|[+\-*/])\s*$"), 0.15),
        ("REPEATED_SYMBOL", x.rlike(r"(\\[a-zA-Z]+)\s*\1\s*\1"), 0.15),
        ("UNICODE_LEAKAGE", x.rlike(r"[×÷∑∏∫√≤≥≠≈∞∂∇]"), 0.05),
        ("ISOLATED_NUMBER", x.rlike(r"^\s*[\d.,]+\s*$"), 0.05),
        ("INCOMPLETE_EXPRESSION", x.rlike(r"(\\cdots|\\ldots)\s*$"), 0.15),
        ("HIGH_TEXT_RATIO", ratio > high_text, 0.15),
        ("NO_MATH_COMMANDS", ~commands & ~x.rlike(r"[=<>+\-*/^_]"), 0.15),
    ]


def ocr_quality(x: Column) -> Column:
    lost = reduce(add, [case(c, w) for _, c, w in ocr_checks(x)])
    return F.when(F.coalesce(F.trim(x), F.lit("")) == "", 0.0).otherwise(F.greatest(F.lit(0.0), 1.0 - lost))


WEIGHTS = {"recognition": 0.35, "layout": 0.15, "syntax": 0.30, "ocr": 0.20}


def aggregate_confidence(parts: dict[str, Column], strategy: str = "weighted") -> Column:
    """Mean of the components that are there, their weights scaled to one; null if none is."""
    if strategy not in ("weighted", "geometric", "min", "harmonic"):
        raise ValueError(strategy)
    there = {k: c.isNotNull() for k, c in parts.items()}
    weight = reduce(add, [case(there[k], WEIGHTS[k]) for k in parts])
    if strategy == "min":
        return F.least(*parts.values())
    term = {
        "weighted": lambda c: c,
        "geometric": lambda c: F.ln(F.greatest(c, F.lit(1e-9))),
        "harmonic": lambda c: 1.0 / F.greatest(c, F.lit(1e-9)),
    }[strategy]
    total = reduce(add, [F.when(there[k], WEIGHTS[k] * term(c)).otherwise(0.0) for k, c in parts.items()]) / weight
    out = {"weighted": total, "geometric": F.exp(total), "harmonic": 1.0 / total}[strategy]
    return F.when(weight > 0, out)


def status(accepted: Column, confidence: Column, uncertain: float = 0.65) -> Column:
    return F.when(~accepted, "REJECTED").when(confidence < uncertain, "UNCERTAIN").otherwise("SUCCESS")


def coverage_verdict(percent: Column) -> Column:
    return F.when(percent.isNull(), "unknown").when(percent >= 95, "complete").when(percent >= 70, "partial").otherwise("incomplete")
