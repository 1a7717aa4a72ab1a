"""Operator 8: BPE encoding and decoding.

The merge order of a pre-token comes from a segment tree over the ranks of its
adjacent pairs. The root yields the leftmost pair of lowest rank; a merge makes
three point updates, each logarithmic, until no pair can be merged.

Defined results: null and empty texts have no ids and decode to the empty
string; repeated rows each get their own row; an empty table gives an empty
table; other columns are not carried.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Layered, Memo, map_texts

NONE = 1 << 60


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, extra = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + extra)
            extra += 1
    return [table[b] for b in range(256)]


class WordBpe:
    """A byte-level BPE with word ends, read from a tokenizer file; lower case, white space dropped."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        #: pair of ids -> (rank, id of the merged symbol)
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            if a in self.ids and b in self.ids and a + b in self.ids:
                self.pairs.setdefault((self.ids[a], self.ids[b]), (rank, self.ids[a + b]))
        order = sorted((a << 32 | b, *v) for (a, b), v in self.pairs.items())
        self.keys = np.array([k for k, _, _ in order], np.int64)
        self.key_rank = np.array([r for _, r, _ in order], np.int64)
        self.merged_id = np.zeros(len(merges), np.int64)
        self.merged_id[self.key_rank] = [m for _, _, m in order]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.bytes = byte_symbols()
        #: id of each byte inside a pre-token and at its end; -1 where the vocabulary lacks one
        self.inside = np.array([self.ids.get(b, -1) for b in self.bytes], np.int64)
        self.at_end = np.array([self.ids.get(b + self.suffix, -1) for b in self.bytes], np.int64)
        self.split_special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")

    def word(self, word: str) -> list[int]:
        """Ids of one normalised pre-token."""
        names = self.bytes
        symbols = [names[b] for b in word.encode("utf-8")]
        symbols[-1] += self.suffix
        known = self.ids
        ids = [known[s] for s in symbols if s in known]
        n = len(ids)
        if n < 2:
            return ids
        # A leaf of the tree holds rank * n + position, so that ties go to the left.
        get, none = self.pairs.get, NONE
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [none] * (2 * size)
        i = size
        for pair in zip(ids, ids[1:]):
            if (p := get(pair)) is not None:
                tree[i] = p[0] * n + i - size
            i += 1
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        if tree[1] == none:
            return ids
        left, right = [*range(-1, n - 1)], [*range(1, n + 1)]
        while (low := tree[1]) < none:
            i = low % n
            j = right[i]
            ids[i] = here = get((ids[i], ids[j]))[1]
            ids[j] = -1
            after = right[i] = right[j]
            changed = [(j, none), (i, none)] if after < n else [(i, none)]
            if after < n:
                left[after] = i
                if (p := get((here, ids[after]))) is not None:
                    changed[1] = (i, p[0] * n + i)
            if (before := left[i]) >= 0:
                p = get((ids[before], here))
                changed.append((before, none if p is None else p[0] * n + before))
            for k, value in changed:
                k += size
                if k >= 2 * size or tree[k] == value:
                    continue
                tree[k] = value
                while k > 1:
                    other = tree[k ^ 1]
                    if other < value:
                        value = other
                    k >>= 1
                    if tree[k] == value:
                        break
                    tree[k] = value
        return [x for x in ids if x >= 0]

    def many(self, words: list[str]) -> list[list[int]]:
        """As ``word`` for each, with the trees of words of like length side by side in arrays."""
        if min(self.inside.min(), self.at_end.min()) < 0:
            return list(map(self.word, words))
        raw = [w.encode("utf-8") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        out: list = [None] * len(words)
        size = 1
        while size <= 64:  # longer ones have a tree each
            members = np.nonzero((sizes > size // 2) & (sizes <= size))[0].tolist()
            for at in range(0, len(members), 8192):
                part = members[at : at + 8192]
                for k, ids in zip(part, self._merged([raw[k] for k in part], size)):
                    out[k] = ids
            size *= 2
        for k in np.nonzero(sizes > 64)[0].tolist():
            out[k] = self.word(words[k])
        return out

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, NONE where a pair isn't mergeable."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_rank[at], NONE)

    def _merged(self, rows: list[bytes], size: int) -> list[list[int]]:
        n_rows = len(rows)
        n = np.fromiter(map(len, rows), np.int64, n_rows)
        ids = np.full((n_rows, size + 1), -1, np.int64)
        held = np.arange(size + 1) < n[:, None]
        flat, last = np.frombuffer(b"".join(rows), np.uint8), np.cumsum(n) - 1
        symbols = self.inside[flat]
        symbols[last] = self.at_end[flat[last]]
        ids[held] = symbols
        tree = np.full((n_rows, 2 * size), NONE, np.int64)
        r, c = np.nonzero(held[:, 1:])
        rank = self._ranks(ids[r, c], ids[r, c + 1])
        tree[r, size + c] = np.where(rank < NONE, rank * size + c, NONE)
        width = size
        while width > 1:
            half = width // 2
            level = tree[:, width : 2 * width]
            np.minimum(level[:, 0::2], level[:, 1::2], out=tree[:, half:width])
            width = half
        left = np.tile(np.arange(-1, size), (n_rows, 1))
        right = np.tile(np.arange(1, size + 2), (n_rows, 1))
        live = np.nonzero(tree[:, 1] < NONE)[0]
        while len(live):
            low = tree[live, 1]
            i, here = low % size, self.merged_id[low // size]
            j = right[live, i]
            after, before = right[live, j], left[live, i]
            ids[live, i], ids[live, j] = here, -1
            right[live, i] = after
            inside = after < n[live]
            ra, aa, ia = live[inside], after[inside], i[inside]
            left[ra, aa] = ia
            tree[live, size + i] = NONE
            tree[live, size + np.minimum(j, size - 1)] = NONE
            rank = self._ranks(here[inside], ids[ra, aa])
            tree[ra, size + ia] = np.where(rank < NONE, rank * size + ia, NONE)
            inside = before >= 0
            rb, bb = live[inside], before[inside]
            rank = self._ranks(ids[rb, bb], here[inside])
            tree[rb, size + bb] = np.where(rank < NONE, rank * size + bb, NONE)
            where = [size + i, size + np.minimum(j, size - 1), size + np.maximum(before, 0)]
            while size > 1 and where[0][0] > 1:
                where = [k >> 1 for k in where]
                for k in where:
                    tree[live, k] = np.minimum(tree[live, 2 * k], tree[live, 2 * k + 1])
            live = live[tree[live, 1] < NONE]
        kept = ids >= 0
        flat, ends = ids[kept].tolist(), np.cumsum(kept.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]


#: Pre-tokens of the word vocabulary: a fixed pattern of its file.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+", regex.V0)
#: Controls that str.split() takes for white space and the tokenizer for symbols.
ODD_SPACE = re.compile("[\x1c-\x1f]")
ODD_SPLIT = re.compile(r"[^ \t\n\v\f\r\x85\xa0  -     　]+")


def normalise(text: str) -> str:
    """NFC, then lower case character by character (no final-sigma rule)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def chunks(text: str) -> list[str]:
    """White-space separated pieces; no pre-token crosses white space."""
    return ODD_SPLIT.findall(text) if ODD_SPACE.search(text) else text.split()


class Coder:
    """Text-level encoder and decoder: a chunk memo in front of the merges."""

    def __init__(self, path: str):
        self.bpe = WordBpe(path)
        self.memo = Memo(self._chunks, 150_000)
        names = self.bpe.names
        self.digits = {i: str(i).encode() for i in names}
        self.shown = {i: t.encode() for i, t in names.items()}
        self.special = {t: (self.digits[i], self.shown[i]) for t, i in self.bpe.special.items()}

    def _chunks(self, chunks: list[str]) -> list[tuple[bytes, bytes]]:
        """Decimal ids of each chunk and the names of those ids, joined by spaces."""
        words = [[c] if c.isascii() and c.isalpha() else PRE_TOKEN.findall(c) for c in chunks]
        unique = list({w for ws in words for w in ws})
        ids = dict(zip(unique, self.bpe.many(unique)))
        digit, show, out = self.digits.__getitem__, self.shown.__getitem__, []
        for ws in words:
            found = ids[ws[0]] if len(ws) == 1 else [i for w in ws for i in ids[w]]
            out.append((b" ".join(map(digit, found)), b" ".join(map(show, found))))
        return out

    def _pieces(self, text: str) -> list:
        """Chunks of a text; special strings, which stay whole, as one-tuples."""
        if "<|" not in text or not self.bpe.split_special.search(text):
            return chunks(normalise(text))
        parts, at = [], 0
        for m in self.bpe.split_special.finditer(text):
            parts += chunks(normalise(text[at : m.start()]))
            parts.append((m[0],))
            at = m.end()
        return parts + chunks(normalise(text[at:]))

    def digests(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its decimal ids and the decoded text, as bytes."""
        pieces = [self._pieces(t) for t in texts]
        unique = set().union(*pieces)
        marks = {p for p in unique if isinstance(p, tuple)}
        table = self.memo.table(unique - marks)
        if marks:
            table = Layered(table, {p: self.special[p[0]] for p in marks})
        out = []
        for ps in pieces:
            got = list(map(table.__getitem__, ps))
            out.append((b" ".join([a for a, _ in got if a]), b" ".join([b for _, b in got if b])))
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [[int(x) for x in a.split()] for a, _ in self.digests(texts)]

    def decode(self, ids: list[int]) -> str:
        """Names of the ids joined by a space: the file names no decoder."""
        return " ".join(map(self.bpe.names.__getitem__, ids))


@functools.lru_cache(2)
def coder(path: str) -> Coder:
    return Coder(path)


def encode_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df`` as (id, ids array<int>, decoded string)."""

    def run(texts):
        c = coder(path)
        ids = c.encode(texts)
        return {"ids": pa.array(ids, pa.list_(pa.int32())), "decoded": pa.array([c.decode(x) for x in ids], pa.string())}

    return map_texts(df, run, "ids array<int>, decoded string", (id_col,), text_col)


def bpe_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, and SHA-256 of the ids and of what they decode to."""

    def run(texts):
        made = coder(path).digests(texts)
        return {
            "n_tokens": pa.array([a.count(b" ") + 1 if a else 0 for a, _ in made], pa.int64()),
            "ids_sha256": [hashlib.sha256(a).hexdigest() for a, _ in made],
            "decoded_sha256": [hashlib.sha256(b).hexdigest() for _, b in made],
        }

    return map_texts(df, run, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", (id_col,), text_col)


def token_rows(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids array<int>, n_tokens, and SHA-256 of the ids and of what they decode to."""

    def run(texts):
        made = coder(path).digests(texts)
        flat = np.fromstring(b" ".join([a for a, _ in made if a]).decode(), np.int32, sep=" ") if any(a for a, _ in made) else np.zeros(0, np.int32)
        n = np.array([a.count(b" ") + 1 if a else 0 for a, _ in made], np.int64)
        ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        return {
            "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            "n_tokens": pa.array(n),
            "ids_sha256": [hashlib.sha256(a).hexdigest() for a, _ in made],
            "decoded_sha256": [hashlib.sha256(b).hexdigest() for _, b in made],
        }

    return map_texts(df, run, "ids array<int>, n_tokens bigint, ids_sha256 string, decoded_sha256 string", (id_col,), text_col)
