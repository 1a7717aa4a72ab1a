"""Column functions over equation labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns of label conventions (Java and RE2 read them alike).
EXPLICIT = r"(?i)Eq(?:uation)?[.:]?\s*((?:\d|[lI])+(?:\.\s*(?:\d|[lI])+)+(?:\s*\(\s*[a-z]\s*\))?)"
DASH = r"\(\s*((?:\d|[lI]){1,3}\s*-\s*(?:\d|[lI]){1,3})\s*\)"
PAREN_EOL = r"(?m)(?:^|[^\d.])\(\s*([1-9](?:\d|[lI]){0,2}\.(?:\d|[lI]){1,3})\s*\)[ \t]*$"
BRACKET_EOL = r"(?m)(?:^|[^\d.])\[\s*([1-9](?:\d|[lI]){0,2}\.(?:\d|[lI]){1,3})\s*\][ \t]*$"
BRACKET_BOX = r"^\s*\[\s*([1-9]\d{0,2}(?:\.\d{1,3}){1,3})\s*\]\s*$"
BARE_BOX = r"^\s*([1-9]\d{0,2}(?:\.\d{1,3}){1,3})\s*$"
PAREN_BOX = r"^\s*\(\s*([1-9]\d{0,2}(?:\.\d{1,3}){1,3})\s*\)\s*$"


def normalise_label(raw: Column) -> Column:
    """White space dropped; l and I read as 1, O as 0."""
    return F.translate(F.regexp_replace(raw, r"\s+", ""), "lIO", "110")


def normalise_number(raw: Column) -> Column:
    """A number for evaluation: OCR's l after a digit and a dot is 1, brackets at the ends and spaces go, lower case."""
    fixed = F.regexp_replace(raw, r"(\d\.)l", "$11")
    return F.lower(F.replace(F.regexp_replace(fixed, r"^[()\[\]{} \t]+|[()\[\]{} \t]+$", ""), F.lit(" "), F.lit("")))


def label_matches(text: Column) -> Column:
    """array<struct<label, explicit>> of all definition labels in a text."""
    def of(pattern: str, explicit: bool) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        return F.transform(found, lambda x: F.struct(normalise_label(x).alias("label"), F.lit(explicit).alias("explicit")))

    found = [of(EXPLICIT, True), of(DASH, True), of(PAREN_EOL, False), of(BRACKET_EOL, False)]
    return F.concat(*found)


def box_label(text: Column, bare: bool = False) -> Column:
    """The label that a whole box is, or null."""
    forms = [PAREN_BOX, BRACKET_BOX] + ([BARE_BOX] if bare else [])
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in forms])


def chapter(label: Column) -> Column:
    return F.regexp_extract(label, r"^([^.\-]*)", 1)


def label_number(text: Column) -> Column:
    """Number of a label with its sub-letter: Eq. 3.9.2(a) gives 3.9.2a."""
    number = F.regexp_extract(text, r"(\d+(?:\.\d+)+)", 1)
    letter = F.regexp_extract(text, r"\d+(?:\.\d+)+\s*\(\s*([a-z])\s*\)", 1)
    return F.when(number == "", F.lit(None)).otherwise(F.concat(number, letter))


def safe_id(text: Column) -> Column:
    return F.regexp_replace(text, r"[^A-Za-z0-9_.-]+", "_")
