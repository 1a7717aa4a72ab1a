"""Text clean-up, syntax checks and similarity; Python only where no built-in has the semantics."""

from __future__ import annotations

import difflib
import unicodedata
from functools import reduce
from operator import add

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from .latex import TOKEN, normalise

#: Substitutions for glyphs that OCR misreads, in order: a fixed list.
OCR_FIXES = [
    (r"¼", "="), (r"\(cid:2\)", "×"), (r"\(cid:\d+\)", ""), (r"[ﬃﬀﬁﬂ]{3,}", "√"), (r"ð", "("), (r"Þ", ")"),
    (r"\b([lI])\.(\d)", "1.$2"), (r"(?<=[\d.])[lI](?=[\d])", "1"), (r"(?<=[=(\[{+\-*/\s])([lI])(?=[.\d])", "1"), (r"\s*;\s*", " "),
]
#: Text roles by region type; any other type is a text block.
ROLES = {"title": "title", "heading": "heading", "caption": "caption", "footnote": "footnote", "list_item": "list_item", "code": "code_block", "header": "page_header", "footer": "page_footer"}
NOT_TEXT = ("table", "figure", "image", "equation", "formula", "chart", "separator")


def ocr_fixes(x: Column) -> Column:
    x = F.regexp_replace(F.regexp_replace(x, "\n", " "), r"(?i)\bEq(?:uation)?[.:]?\s*\d[\d.]*", "")
    for pattern, by in OCR_FIXES:
        x = F.regexp_replace(x, pattern, by)
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def dehyphenate(x: Column) -> Column:
    """Words split at a line end are joined where they go on in lower case."""
    return F.regexp_replace(x, r"(\w)-\n(\p{Ll}+)(?=\W|$)", "$1$2")


def merge_soft_breaks(x: Column) -> Column:
    """Single line breaks become spaces; blank lines still part paragraphs."""
    paragraphs = F.transform(F.split(x, r"\n\s*\n"), lambda p: F.trim(F.regexp_replace(p, r"\s*\n\s*", " ")))
    return F.array_join(F.filter(paragraphs, lambda p: p != ""), "\n\n")


def normalise_block(x: Column, role: Column) -> Column:
    """Code stays as it is; other text is de-hyphenated, its soft breaks merged and its spaces collapsed."""
    y = merge_soft_breaks(dehyphenate(x))
    return F.when(role == "code_block", F.regexp_replace(x, r"\n+$", "")).otherwise(F.trim(F.regexp_replace(y, r"[ \t]+", " ")))


def text_role(kind: Column) -> Column:
    pairs = [F.lit(v) for kv in ROLES.items() for v in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), kind), F.lit("text_block"))


def is_text(kind: Column) -> Column:
    return ~kind.isin(*NOT_TEXT)


def printable_ratio(x: Column) -> Column:
    n = F.length(x)
    return F.when(n == 0, 1.0).otherwise(F.regexp_count(x, F.lit(r"[^\p{Cc}\p{Cn}\p{Co}\p{Cs}]|[\n\t]")) / n)


def needs_ocr(x: Column, least: float = 0.60) -> Column:
    return (F.trim(F.coalesce(x, F.lit(""))) == "") | x.contains("�") | (printable_ratio(x) < least)


@F.pandas_udf(StringType())
def nfc(x: pd.Series) -> pd.Series:
    return x.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(DoubleType())
def _block_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    def one(p, q):
        p, q = list(p), list(q)
        return 1.0 if not p and not q else 0.0 if not p or not q else difflib.SequenceMatcher(None, p, q).ratio()

    return pd.Series([one(p, q) for p, q in zip(a, b)], dtype="float64")


def char_similarity(a: Column, b: Column) -> Column:
    """Twice the matching blocks over both lengths (not an edit distance); equal texts need no Python."""
    return _block_ratio(F.split(normalise(a), ""), F.split(normalise(b), ""))


def token_similarity(a: Column, b: Column) -> Column:
    tokens = lambda x: F.regexp_extract_all(normalise(x), F.lit(TOKEN), F.lit(0))
    return _block_ratio(tokens(a), tokens(b))


def balanced(x: Column, opening: str, closing: str) -> Column:
    """No closing bracket before its opening one, none left open: a fold over the characters."""
    marks = F.regexp_extract_all(x, F.lit(rf"[\{opening}\{closing}]"), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit(True).alias("ok"))
    def step(s, c):
        depth = s["depth"] + F.when(c == opening, 1).otherwise(-1)
        return F.struct(depth.alias("depth"), (s["ok"] & (depth >= 0)).alias("ok"))

    end = F.aggregate(marks, start, step)
    return end["ok"] & (end["depth"] == 0)


def nesting(x: Column) -> Column:
    marks = F.regexp_extract_all(x, F.lit(r"[{}]"), F.lit(0))
    start = F.struct(F.lit(0).alias("d"), F.lit(0).alias("top"))
    def step(s, c):
        d = s["d"] + F.when(c == "{", 1).otherwise(-1)
        return F.struct(d.alias("d"), F.greatest(s["top"], d).alias("top"))

    return F.aggregate(marks, start, step)["top"]


def known_commands() -> list[str]:
    """Commands that count as known: fixed values, families of them by rule."""
    greek = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau upsilon phi chi psi omega".split()
    variants = ["var" + g for g in "epsilon theta pi rho sigma phi".split()]
    capitals = [g.capitalize() for g in "gamma delta theta lambda xi pi sigma upsilon phi psi omega".split()]
    fractions = [p + "frac" for p in ("", "d", "t", "c")] + [p + "binom" for p in ("", "d", "t")]
    sizes = [b + side for b in ("big", "Big", "bigg", "Bigg") for side in ("", "l", "r")]
    ways = [w + "arrow" for w in ("left", "right", "Left", "Right", "leftright", "Leftright", "longleft", "longright", "Longleft", "Longright", "xleft", "xright")]
    functions = "lim inf sup max min sin cos tan cot sec csc log ln exp det dim ker gcd hom arg deg Pr sinh cosh tanh"
    operators = (
        "sqrt sum prod int oint iint iiint left right partial nabla infty pm mp times div cdot cdots ldots vdots ddots ast star circ bullet dagger ddagger "
        "oplus ominus otimes oslash odot boxplus over above atop choose underset overset stackrel pmod bmod limits nolimits mathop"
    )
    relations = (
        "leq geq neq approx sim simeq cong equiv propto ll gg subset supset subseteq supseteq in notin cup cap wedge vee neg forall exists to mapsto "
        "rightleftharpoons leftrightarrows perp parallel nmid mid not ne le ge therefore because"
    )
    accents = "hat bar dot ddot tilde vec overline underline overbrace underbrace widehat widetilde overrightarrow"
    styles = (
        "text mathrm mathit mathbf mathsf mathbb mathcal mathfrak boldsymbol operatorname mbox begin end label ref tag notag quad qquad hspace vspace space "
        "enspace displaystyle textstyle scriptstyle scriptscriptstyle"
    )
    symbols = (
        "angle measuredangle vert Vert langle rangle lfloor rfloor lceil rceil Re Im wp ell hbar imath jmath triangle square lozenge clubsuit diamondsuit "
        "heartsuit spadesuit sharp flat natural checkmark maltese qed"
    )
    words = " ".join((functions, operators, relations, accents, styles, symbols)).split()
    return greek + variants + capitals + fractions + sizes + ways + words


KNOWN = known_commands()
#: A fraction whose arguments are the marks of whole groups; a group that holds another fraction; any innermost group.
GOOD_FRACTION, BAD_GROUP, GROUP = "\\\\(?:d|t|c)?frac *\x01 *\x01", r"\{[^{}]*\\(?:d|t|c)?frac[^{}]*\}", r"\{[^{}]*\}"
FRACTION = r"\\(?:d|t|c)?frac"
#: A script mark without braces, command, letter or digit behind it.
BARE_SCRIPT = r"[_^] *(?:\z|[^ {\\\p{L}\p{N}])"
LEFT, RIGHT = r"\\left\s*(?:[({\[|.]|\\[a-zA-Z]+)", r"\\right\s*(?:[)}\[|.]|\\[a-zA-Z]+)"


def fractions_complete(x: Column) -> Column:
    """Every fraction has two groups in braces behind it: groups become marks from the innermost out, and complete fractions go."""
    def step(t, _):
        t = F.regexp_replace(t, GOOD_FRACTION, "")
        return F.regexp_replace(F.regexp_replace(t, BAD_GROUP, "\x02"), GROUP, "\x01")

    left = F.regexp_replace(F.aggregate(F.sequence(F.lit(0), nesting(x)), x, step), GOOD_FRACTION, "")
    return F.when(x.contains("frac"), ~left.contains("\x02") & ~left.rlike(FRACTION)).otherwise(True)


def syntax_checks(x: Column, deepest: int = 12, known: list[str] = KNOWN) -> dict[str, Column]:
    n = lambda p: F.regexp_count(x, F.lit(p))
    names = lambda p: F.regexp_extract_all(x, F.lit(p), F.lit(1))
    return {
        "balanced_braces": balanced(x, "{", "}"),
        "balanced_brackets": balanced(x, "[", "]"),
        "balanced_parens": balanced(x, "(", ")"),
        "left_right_matched": n(LEFT) == n(RIGHT),
        "environments_closed": names(r"\\begin\{([^}]+)\}") == names(r"\\end\{([^}]+)\}"),
        "frac_has_two_args": fractions_complete(x),
        "scripts_have_args": ~x.rlike(BARE_SCRIPT),
        "commands_are_known": F.size(F.array_except(names(r"\\([a-zA-Z]+)"), F.array(*map(F.lit, known)))) == 0,
        "depth_within_limit": nesting(x) <= deepest,
    }


def syntax_confidence(x: Column, deepest: int = 12) -> Column:
    checks = syntax_checks(x, deepest)
    passed = reduce(add, [c.cast("int") for c in checks.values()])
    return F.when(F.coalesce(F.trim(x), F.lit("")) == "", 0.0).otherwise(passed / len(checks))
