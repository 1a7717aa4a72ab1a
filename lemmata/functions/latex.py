"""Column functions over LaTeX strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns.
RELATION = (
    r"(=|\\leq|\\geq|\\neq|\\approx|\\equiv|\\propto|\\sim|\\simeq|\\cong|\\subset|\\subseteq|\\supset|\\supseteq|\\in|\\notin"
    r"|\\rightarrow|\\to|\\Rightarrow|\\Leftrightarrow|[<>])"
)
TOKEN = r"\\[a-zA-Z]+|\\.|[{}]|[^\s]"
#: Replacements that make equivalent transcriptions equal, in order.
NORMALISE = [
    (r"^\s+|\s+$", ""), (r"\\tag\*?\{[^{}]*\}", ""), (r"\(\s*\d{1,3}[.\-]\d{1,3}(?:\.\d{1,3})?\s*\)\s*$", ""),
    (r"^\s*\$\$", ""), (r"\$\$\s*$", ""), (r"^\s*\\\[", ""), (r"\\\]\s*$", ""), (r"^\s*\\\(", ""), (r"\\\)\s*$", ""),
    (r"^\s*\$", ""), (r"\$\s*$", ""), (r"\\(?:dfrac|tfrac|cfrac)\b", r"\\frac"), (r"\\left\b|\\right\b", ""),
    (r"\\[,;:!>]|\\quad|\\qquad|\\ |~", ""), (r"\s+", ""),
]
FUNCTIONS = "sin|cos|tan|log|ln|exp|lim|max|min|sinh|cosh|tanh"


def replace_all(x: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, by in steps:
        x = F.regexp_replace(x, pattern, by)
    return x


def normalise(x: Column) -> Column:
    x = replace_all(F.coalesce(x, F.lit("")), NORMALISE)
    return F.regexp_replace(x, r"([_^])\{([A-Za-z0-9])\}", "$1$2")


def tokens(x: Column) -> Column:
    return F.regexp_extract_all(normalise(x), F.lit(TOKEN), F.lit(0))


def exact_match(a: Column, b: Column) -> Column:
    return F.when(normalise(a) == normalise(b), 1.0).otherwise(0.0)


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance over the longer length of the normalised strings; two empty strings are alike."""
    x, y = normalise(a), normalise(b)
    longer = F.greatest(F.length(x), F.length(y))
    return F.when(longer == 0, 1.0).otherwise(1.0 - F.levenshtein(x, y) / longer)


def count_of(x: Column, text: str) -> Column:
    return (F.length(x) - F.length(F.replace(x, F.lit(text), F.lit("")))) / len(text)


def is_valid(x: Column) -> Column:
    """Braces and environments are balanced in number."""
    return (
        x.isNotNull()
        & (F.trim(x) != "")
        & (count_of(x, "{") == count_of(x, "}"))
        & (count_of(x, "\\begin{") == count_of(x, "\\end{"))
    )


def structured_form(x: Column) -> Column:
    """struct<lhs, rhs> split at the first equals sign; a bare expression has no rhs."""
    at = F.instr(x, "=")
    return F.struct(
        F.trim(F.when(at > 0, F.substring(x, F.lit(1), at - 1)).otherwise(x)).alias("lhs"),
        F.when(at > 0, F.trim(F.substring(x, at + 1, F.length(x)))).alias("rhs"),
    )


def clean(x: Column) -> Column:
    """Fences, display wrappers, delimiters and blank runs removed."""
    steps = [
        (r"```(?:latex|tex)?", ""), (r"\\begin\{(?:equation|displaymath|align|gather)\*?\}|\\end\{(?:equation|displaymath|align|gather)\*?\}", ""),
        (r"\$\$", ""), (r"\\\[|\\\]", "\n"), (r"\n{3,}", "\n\n"), (r"^\s+|\s+$", ""),
    ]
    y = replace_all(x, steps)
    return F.when(y.rlike(r"^\$[^$]*\$$"), F.regexp_replace(y, r"^\$|\$$", "")).otherwise(y)


def unwrap(x: Column) -> Column:
    """The content of $$…$$, else of $…$, else the text."""
    pick = lambda p: F.nullif(F.trim(F.regexp_extract(x, p, 1)), F.lit(""))
    return F.coalesce(pick(r"(?s)\$\$(.+?)\$\$"), pick(r"(?s)\$(.+?)\$"), F.trim(x))


def postprocess(x: Column) -> Column:
    y = F.regexp_replace(x, r"(?i)\s*Eq(?:uation)?\.?\s*\d+(?:\.\d+)+\s*$", "")
    y = F.regexp_replace(y, r"(^|[^\\A-Za-z])sqrt\(([^()]*)\)", r"$1\\sqrt{$2}")
    y = F.regexp_replace(y, rf"(^|[^\\A-Za-z])({FUNCTIONS})([^A-Za-z]|$)", r"$1\\$2$3")
    return F.trim(F.regexp_replace(y, r"^\$+|\$+$", ""))


def is_meaningful(x: Column) -> Column:
    """More than one line, an operator, an arrow or construct, or white space inside."""
    t = F.trim(x)
    return t.contains("\n") | t.rlike(r"[=<>+*/^_]|->|\\(?:frac|sum|int|sqrt)") | t.rlike(r"\S\s+\S")


#: Openings of answers in prose: a fixed pattern.
PROSE_ANSWER = (
    r"(?i)^(?:nothing\b|it\s|the\s+(?:expression|equation|instruction|formula|given|notation|request|text|image)|i\s|certainly|please|note\s|you\s|based\s"
    r"|as\s+provided|this\s+(?:expression|equation|notation|text)|there\s+(?:is|are|was|were|might|seem)|sorry|unfortunately)"
)
#: Commands of document structure that no formula begins with: a fixed pattern.
STRUCTURE = (
    r"(?i)^\\(?:section|subsection|subsubsection|chapter|part|paragraph|subparagraph|newcommand|renewcommand|def|let|providecommand|begin\{document\}"
    r"|end\{document\}|documentclass|usepackage|maketitle|label|ref|cite|bibliography|bibitem|footnote|caption)\b"
)


def is_refusal(x: Column) -> Column:
    return F.trim(x).rlike(PROSE_ANSWER)


def is_structural(x: Column) -> Column:
    return F.trim(x).rlike(STRUCTURE)
