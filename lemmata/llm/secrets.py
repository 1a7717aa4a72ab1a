"""Operator 9: secret scans.

Base detectors find assignments, access keys and hex runs. The method adds
candidates: runs of key-like characters over which a window slides; its Shannon
entropy is kept up to date by adding one count and dropping one per step, with a
limit for each character class. A candidate with a window that reaches its limit
is a span as a whole. An allow list suppresses candidates only, never base spans.

Defined results: null and empty texts have no spans; repeated rows and ids each get
a row, null ids are carried; spans that begin at one place are ordered by kind, then
end, and may overlap; texts are scanned whole at any length; ``mask_secrets`` carries
other columns and keeps null texts, ``scan_secrets`` carries none; an empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_arrow, map_texts, text_slices

KINDS = ("assign", "access", "hex", "entropy")
WORD = re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
#: Longest runs, so the minimum length can stand in the pattern: 4 + 14 and 16 characters.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Window, and least entropy in bits a character, by class of the window's characters; 20 characters have 4.32 at most, 20 digits 3.28.
#: Of random windows, 95 % reach 3.68 (letters of both cases) and 2.65 (digits); words are told by the allow list.
WINDOW = 20
LIMITS = {"digits": 2.6, "hex": 3.1, "letters": 3.7, "alnum": 3.7, "base64": 3.9}
#: A word in one case, or words joined by capitals, each with two small letters or more behind it.
NAME = r"(?:[A-Z]?[a-z]+(?:[A-Z][a-z]{2,})*|[A-Z]+)"
#: Candidates that are no secrets: fixed patterns of the allow list.
ALLOW = tuple(
    re.compile(p)
    for p in (
        r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",  # UUIDs
        rf"{NAME}(?:[-_/]{NAME})*",  # words joined by dashes
        r"[-=_+/]+",  # rules
        r"[0-9]{1,15}(?:[-/][0-9]{1,15})*",  # dates, numbers in parts
        rf"(?i:example|sample|dummy|placeholder|changeme|your|x{{4,}})(?:[-_/=](?:{NAME}|[xX]+|[0-9]{{1,6}}))*",  # stand-ins, in words
    )
)


def classify(n_digit: int, n_hex: int, n_alpha: int, n_other: int) -> str:
    if n_other:
        return "base64"
    if not n_alpha:
        return "digits"
    if n_hex == n_digit + n_alpha:
        return "hex"
    return "alnum" if n_digit else "letters"


def entropy_spans(run: str, window: int = WINDOW, limits: dict[str, float] = LIMITS) -> list[tuple[int, int]]:
    """Joined windows of ``run`` whose entropy reaches the limit of their class."""
    if len(run) < window:
        return []
    log = [0.0] + [k * math.log2(k) for k in range(1, window + 1)]
    counts: dict[str, int] = {}
    kinds = [0, 0, 0, 0]  # digits, hex characters, letters, others
    total, spans = 0.0, []
    top = math.log2(window)

    def shift(c: str, by: int) -> float:
        k = counts.get(c, 0)
        counts[c] = k + by
        digit, letter = "0" <= c <= "9", c.isalpha()
        kinds[0] += by * digit
        kinds[1] += by * (digit or c in "abcdefABCDEF")
        kinds[2] += by * letter
        kinds[3] += by * (not digit and not letter)
        return log[k + by] - log[k]

    for i, c in enumerate(run):
        if i >= window:
            total += shift(run[i - window], -1)
        total += shift(c, 1)
        if i >= window - 1 and top - total / window >= limits[classify(*kinds)] - 1e-12:
            a, b = i - window + 1, i + 1
            if spans and a <= spans[-1][1]:
                spans[-1] = (spans[-1][0], b)
            else:
                spans.append((a, b))
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end) of the base detectors, in order."""
    out = []
    if WORD.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def all_spans(text: str) -> tuple[list, list]:
    base = base_spans(text)
    more = []
    for m in CANDIDATE.finditer(text):
        if not any(p.fullmatch(m[0]) for p in ALLOW):
            more += [(m.start(), 3, m.end())] * bool(entropy_spans(m[0]))
    return base, sorted(base + more)


def show(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts of the base kinds, digest of base spans, all spans as text."""

    def run(texts):
        made = [all_spans(t) for t in texts]
        n = lambda kind: pa.array([sum(k == kind for _, k, _ in b) for b, _ in made], pa.int64())
        return {
            "n_assign": n(0),
            "n_access": n(1),
            "n_hex": n(2),
            "base_sha256": [hashlib.sha256(show(b).encode()).hexdigest() for b, _ in made],
            "spans": [show(a) for _, a in made],
        }

    return map_texts(df, run, "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string", (id_col,), text_col)


def mask(text: str, fill: str = "[secret]") -> str:
    """The text with every span, overlaps joined, replaced."""
    out, at = [], 0
    joined: list[list[int]] = []
    for a, _, b in all_spans(text)[1]:
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    for a, b in joined:
        out += [text[at:a], fill]
        at = b
    return "".join([*out, text[at:]])


def mask_secrets(df: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``df``, with the spans of the text replaced; null texts stay null."""
    cols, schema = df.columns, df.schema
    at = cols.index(text_col)

    def run(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch.column(at)):
                part = batch.slice(a, b - a)
                masked = pa.array([mask(t) if ok else None for t, ok in zip(texts, part.column(at).is_valid().to_pylist())], batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays([masked if i == at else c for i, c in enumerate(part.columns)], schema=batch.schema)

    return in_arrow(df, run, schema)
