"""Column functions over references, fragments, model responses and visual regions."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from .latex import RELATION, count_of, structured_form
from .scores import GREEK, PROSE

# Fixed word lists and patterns.
REFERENCE_PROSE = PROSE[: -len(r")\b")] + r"|shows?|given|see|above|below|follows?|use|using|if|let|equation|equations|satisfies?|according|apply|applies)\b"
INTRODUCES = (
    "from see using use substituting substitute recall combining comparing applying apply consider putting equating integrating "
    "differentiating solving dividing multiplying rearranging"
).split()
TRIVIAL = (
    r"""^[.,;:\s()\[\]{}'"]*(?:"""
    + f"[{GREEK}][a-zA-Z0-9{GREEK}]{{0,6}}"
    + r"""|[a-z][a-zA-Z0-9]{0,4}|[A-Z][a-z]{1,4}|[+\-×÷±≤≥≠≈<>·∞∝→↔⇒∇∆∈∉∩∪⊂⊃∀∃∑∫∂√=]+)[.,;:\s()\[\]{}'"]*$"""
)
#: Cues of visual categories, the first that is met deciding.
VISUAL_CUES = [
    ("chemical_structure", r"(?i)\b(scheme|chemical structure|reaction|compound|moiety|SMILES)\b"),
    ("circuit_diagram", r"(?i)\b(circuit|schematic diagram|wiring|resistor|capacitor|transistor)\b"),
    ("flowchart", r"(?i)\b(flow\s*chart|flow diagram|process flow|workflow|decision tree)\b"),
    ("cad_drawing", r"(?i)\b(CAD|assembly drawing|exploded view|isometric|orthographic)\b"),
    ("engineering_drawing", r"(?i)\b(engineering drawing|schematic|blueprint|cross[- ]section|elevation|cutaway)\b"),
    ("map", r"(?i)\b(map|geographic|topograph|cartograph|region map|location map)\b"),
    ("screenshot", r"(?i)\b(screenshot|screen capture|user interface|UI|dialog box|window)\b"),
    ("chart", r"(?i)\b(bar chart|pie chart|histogram|chart)\b"),
    ("graph", r"(?i)\b(graph|plot|scatter|line graph|curve|axis|axes)\b"),
    ("photograph", r"(?i)\b(photo(graph)?|micrograph|microscopy|SEM|TEM|image of|specimen)\b"),
    ("diagram", r"(?i)\b(diagram|block diagram|illustration|schematic of)\b"),
]
VISUAL_PROVIDERS = {
    "graph": "opencv", "chart": "opencv", "chemical_structure": "chemical", "diagram": "generic", "flowchart": "generic", "engineering_drawing": "generic",
    "cad_drawing": "generic", "circuit_diagram": "generic", "map": "generic", "screenshot": "generic", "figure": "docling", "photograph": "docling", "composite_figure": "docling",
}


def is_cross_reference(before: Column, after: Column) -> Column:
    """Whether a label, given the text before and after it on its line, is mentioned rather than set."""
    prose = lambda x: F.regexp_count(x, F.lit(REFERENCE_PROSE)) >= 2
    first = F.lower(F.regexp_extract(F.trim(before), "^([A-Za-z]+)", 1))
    return prose(before) | prose(after) | F.trim(after).rlike(r"^[a-z]{2,}\b") | first.isin(*INTRODUCES)


def is_trivial(x: Column) -> Column:
    return x.rlike(TRIVIAL)


def mixed_block(x: Column) -> Column:
    """struct<label, formula>: the first line that is a label, and the other lines up to a description; too much prose gives no formula."""
    label = r"(?i)^\s*(?:Eq(?:uation)?[.:]?\s*)?[\(\[]?\d+(?:[.\-]\d+)+[\)\]]?\s*$"
    lines = F.filter(F.transform(F.split(x, "\n"), lambda s: F.trim(s)), lambda s: s != "")
    labels = F.filter(lines, lambda s: s.rlike(label))
    rest = F.filter(lines, lambda s: ~s.rlike(label))
    stop = F.array_position(F.transform(rest, lambda s: s.rlike(r"(?i)^(?:where|note|with)\b")), True)
    kept = F.when(stop > 0, F.slice(rest, 1, F.greatest(stop.cast("int") - 1, F.lit(0)))).otherwise(rest)
    text = F.array_join(F.array_distinct(kept), "\n")
    return F.struct(F.get(labels, F.lit(0)).alias("label"), F.when(F.regexp_count(text, F.lit(PROSE)) > 6, "").otherwise(text).alias("formula"))


def clean_ocr(x: Column) -> Column:
    """Cut at where: and note:, label references dropped."""
    return F.trim(F.regexp_replace(F.element_at(F.split(x, r"(?i)\b(?:where|note)\s*:"), 1), r"(?i)\bEq(?:uation)?\.?\s*\d+(?:\.\d+)+", ""))


@F.pandas_udf(BooleanType())
def is_mathml(x: pd.Series) -> pd.Series:
    def one(t):
        if not t:
            return False
        try:
            return ET.fromstring(t).tag.rpartition("}")[2] == "math"
        except ET.ParseError:
            return False

    return x.map(one)


def representation(latex: Column, plain: Column, category: Column, valid: Column) -> Column:
    """struct<plain_text, latex, lhs, rhs, flags> as the category asks for."""
    chemical = category.isin("chemical_equation", "chemical_structure")
    form = structured_form(F.when(chemical, plain).otherwise(latex))
    flags = F.filter(F.array(F.when(~chemical & ~valid, F.lit("invalid_latex"))), lambda f: f.isNotNull())
    return F.struct(plain.alias("plain_text"), F.when(~chemical, latex).alias("latex"), form["lhs"].alias("lhs"), form["rhs"].alias("rhs"), F.array_join(flags, "|").alias("flags"))


def region_text(block: Column, value: Column, text: Column) -> Column:
    pick = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(pick(block), pick(value), pick(text), F.lit(""))


def repaired_json(x: Column) -> Column:
    """The first object of a response, fences off, lone back-slashes doubled."""
    bare = F.regexp_replace(x, r"```(?:json)?", "")
    return F.regexp_replace(F.regexp_extract(bare, r"(?s)(\{.*\})", 1), r'\\(?!["\\/bfnrtu])', r"\\\\")


def verdict(x: Column) -> Column:
    """struct<accepted, score> of a judge's response: JSON, or else the words and first number in it."""
    parsed = F.from_json(repaired_json(x), "accepted boolean, score double")
    low = F.lower(x)
    accepted = F.coalesce(parsed["accepted"], low.contains("true") & ~low.contains("false"))
    number = F.regexp_extract(x, r"\b(0?\.\d+|1\.0)\b", 1)
    return F.struct(accepted.alias("accepted"), F.coalesce(parsed["score"], F.when(number != "", number.cast("double")), F.when(accepted, 0.8).otherwise(0.2)).alias("score"))


def quad_box(quad: Column) -> Column:
    """struct<x0, y0, x1, y1> of four corners."""
    xs, ys = F.transform(quad, lambda p: p[0]), F.transform(quad, lambda p: p[1])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def visual_category(caption: Column, text: Column, subtype: Column, composite: Column, photo: Column, least: float = 0.5) -> Column:
    """struct<category, confidence, provider> of a visual region."""
    of = lambda name, c: F.struct((F.lit(name) if isinstance(name, str) else name).alias("category"), F.lit(c).alias("confidence"))
    hay = F.concat_ws("\n", caption, text)
    known = [n for n, _ in VISUAL_CUES] + ["figure", "composite_figure", "unknown"]
    out = F.when(composite, of("composite_figure", 0.85)).when(subtype.isin(*known), of(subtype, 0.9))
    for name, cue in VISUAL_CUES:
        out = out.when(hay.rlike(cue), of(name, 0.8))
    out = out.when(photo, of("photograph", 0.6)).when(~photo, of("figure", 0.55)).when(F.trim(hay) != "", of("figure", max(least, 0.5))).otherwise(of("unknown", 0.3))
    pairs = [F.lit(v) for kv in VISUAL_PROVIDERS.items() for v in kv]
    provider = F.coalesce(F.try_element_at(F.create_map(*pairs), out["category"]), F.lit("default"))
    return F.struct(out["category"].alias("category"), out["confidence"].alias("confidence"), provider.alias("provider"))


def report_quality(x: Column) -> Column:
    """Score of a display equation's LaTeX for reports: one less a penalty for each way a model fails."""
    t = F.trim(F.coalesce(x, F.lit("")))
    n = lambda p: F.regexp_count(t, F.lit(p))
    cost = lambda c, v: F.when(c, F.lit(v)).otherwise(0.0)
    label = r"(?i)^\s*[\(\[]?\s*(?:Eq(?:uation)?\.?\s*)?\d+(?:[.\-]\d+)+\s*[\)\]]?\s*$"
    words = F.regexp_count(F.regexp_replace(t, r"\\[a-zA-Z]+(?:\{[^}]*\})?", " "), F.lit(r"\b[a-zA-Z]{4,}\b"))
    unicode_hits = n("[×÷∑∏∫√≤≥≠≈∞∂∇]")
    relation = t.rlike(RELATION)
    prose = (n(r"(?i)\b(?:where|which|from|then|therefore|the|this|that|these|those|for|with|into|using|equation|value)\b") >= 2) & ~relation
    blocks = F.regexp_extract_all(t, F.lit(r"\\text\{([^}]*)\}"), F.lit(1))
    in_text = F.exists(blocks, lambda b: F.regexp_count(b, F.lit(r"(?i)\b(?:or|and|the|for|with|at|of|in|is|are|to|by)\b")) >= 2)
    lost = (
        cost(t.rlike(r"(?i)Eq(?:uation)?\.?\s*\d+\.\d+"), 0.6)
        + cost((count_of(t, "\\begin{") > 0) & (words > 5), 0.5)
        + F.when(unicode_hits >= 2, F.least(F.lit(0.35), unicode_hits * 0.08)).otherwise(0.0)
        + cost(prose, 0.4)
        + cost(in_text & ~prose, 0.35)
        + cost(~relation & ~prose, 0.25)
        + cost(F.size(F.filter(F.split(t, "\n"), lambda s: s.rlike(RELATION))) >= 2, 0.2)
        + cost(F.length(F.regexp_replace(t, r"\\[a-zA-Z]+|\s", "")) < 3, 0.5)
    )
    return F.when(t == "", 0.0).when(t.rlike(label), 0.2).otherwise(F.greatest(F.lit(0.0), F.round(1.0 - lost, 2)))


def worker_confidence(x: Column) -> Column:
    prose = F.lower(x).rlike(r"mathrm|mathsf|mathtt|text\{|mbox\{|hbox\{")
    return F.when(F.coalesce(F.trim(x), F.lit("")) == "", 0.0).when(prose, 0.3).when(x.rlike(r"[\\{}_^]|frac|sum|int|sqrt|lim|cdot"), 0.9).otherwise(0.6)


def older_status(flags: Column, notes: Column, confidence: Column) -> Column:
    """PARTIAL, FAILED, LOW_CONFIDENCE or SUCCESS."""
    return (
        F.when(F.arrays_overlap(flags, F.array(F.lit("unsupported_category"), F.lit("broken_multiline"))), "PARTIAL")
        .when(F.exists(notes, lambda n: n.startswith("recognition_failed")), "FAILED")
        .when(F.coalesce(confidence, F.lit(0.0)) < 0.5, "LOW_CONFIDENCE")
        .otherwise("SUCCESS")
    )


def crop_status(flags: Column, notes: Column) -> Column:
    return F.when(F.array_contains(flags, "invalid_bbox"), "FAIL").when(F.exists(notes, lambda n: n.startswith("crop_touch:")), "WARNING").otherwise("PASS")


def scaled_size(width: Column, height: Column, longest: int = 1600) -> list[Column]:
    """Dimensions that keep the longer side within ``longest``."""
    f = F.least(F.lit(1.0), longest / F.greatest(width, height))
    return [F.greatest(F.lit(1), F.floor(d * f)).cast("long") for d in (width, height)]


def orientation(width: Column, height: Column) -> Column:
    return F.when(width > height, "landscape").when(width < height, "portrait").otherwise("square")
