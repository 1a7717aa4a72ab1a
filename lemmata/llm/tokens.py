"""Operator 3: token counts by a two-tier lookup on the map side.

Tier one is a compact hash table of frequent pre-token lengths, built once on
the driver from the vocabulary (so its size is bounded by the vocabulary, not
by the data) and broadcast as arrays: open addressing by a 64-bit hash, and the
keys themselves to settle it. The space-delimited pieces of a slice of texts are
looked up there side by side. What the table lacks goes to the worker's cache, and
what that lacks is encoded by the tokenizer: a short piece as it is, a long one
pre-token by pre-token, so that no call holds a long text's tokens. No pre-token is
shuffled.

Defined results: null and empty texts have 0 bytes and 0 tokens; special strings
inside a text count as the tokenizer's default has it; repeated rows and ids each
get a row, null ids are carried; texts are read whole at any length; other columns
are not carried; an empty table gives an empty table.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_symbols
from .common import Memo, map_texts

#: Entries of the broadcast table, at most.
TABLE_ENTRIES = 50_000
#: Bytes of texts whose different pieces are looked up at once.
SLICE = 2_000_000
#: Missing pieces of more characters are cut into pre-tokens before they are encoded.
SHORT_PIECE = 64
#: Pre-tokens of byte-level vocabularies: a fixed public pattern.
PRE_TOKEN = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: A text with one of these isn't cut at each space and line end, but between non-spaces only.
UNEVEN = re.compile(r"  | \n|\n |\n\n|[^\S \n]|[\x1c-\x1f]")
CUT = re.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])")


def load(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class LengthTable:
    """Token counts of keys by open addressing over 64-bit hashes; the keys themselves settle collisions."""

    def __init__(self, keys: list[str], lengths: list[int]):
        raw = [k.encode() for k in keys]
        self.blob = b"".join(raw)
        size = 1 << max(4, (2 * len(raw)).bit_length())
        self.hashes = np.zeros(size, np.uint64)
        self.ends = np.zeros(size, np.uint32)
        self.sizes = np.zeros(size, np.uint16)
        self.lengths = np.zeros(size, np.uint8)  # 0: an empty slot
        at = 0
        for k, n in zip(raw, lengths):
            h = xxhash.xxh3_64_intdigest(k)
            slot = h & (size - 1)
            while self.lengths[slot]:
                slot = (slot + 1) & (size - 1)
            at += len(k)
            self.hashes[slot], self.ends[slot], self.sizes[slot], self.lengths[slot] = h, at, len(k), n
        self.n = len(raw)

    def find(self, keys: list[bytes]) -> list[int]:
        """The token count of each key, 0 where the table lacks it."""
        mask = np.uint64(len(self.hashes) - 1)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
        slot = h & mask
        out = np.zeros(len(keys), np.int64)
        live = np.arange(len(keys))
        blob = self.blob
        while len(live):
            s = slot[live]
            full = self.lengths[s] > 0
            live, s = live[full], s[full]
            same = self.hashes[s] == h[live]
            hit, hs = live[same], s[same]
            ends, sizes = self.ends[hs].tolist(), self.sizes[hs].tolist()
            equal = np.fromiter((blob[e - z : e] == keys[k] for k, e, z in zip(hit.tolist(), ends, sizes)), bool, len(hit))
            out[hit[equal]] = self.lengths[hs[equal]]
            settled = np.zeros(len(live), bool)
            settled[np.nonzero(same)[0][equal]] = True
            live = live[~settled]
            slot[live] = (slot[live] + np.uint64(1)) & mask
        return out.tolist()


def frequent_lengths(path: str, entries: int = TABLE_ENTRIES) -> LengthTable:
    """Vocabulary entries that are whole pre-tokens, earliest merges (most frequent) first."""
    tok = load(path)
    back = {s: b for b, s in enumerate(byte_symbols())}
    keys = []
    for name, _ in sorted(tok.get_vocab(with_added_tokens=False).items(), key=lambda kv: kv[1]):
        if all(c in back for c in name):
            try:
                word = bytes(back[c] for c in name).decode()
            except UnicodeDecodeError:
                continue
            if PRE_TOKEN.findall(word) == [word]:
                keys.append(word)
        if len(keys) >= entries:
            break
    lengths = [len(e.ids) for e in tok.encode_batch(keys, add_special_tokens=False)]
    return LengthTable(keys, lengths)


class Counter:
    def __init__(self, path: str, table: LengthTable):
        self.tok = load(path)
        self.tier1 = table
        self.memo = Memo(self._lengths)
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values()) or "(?!)")

    def _encoded(self, words: list[str]) -> list[int]:
        return list(map(len, self.tok.encode_batch_fast(words, add_special_tokens=False)))

    def _lengths(self, pieces: list[str]) -> list[int]:
        """A piece that begins with a line end stands for itself, another for a space and itself."""
        words = [p if p[:1] == "\n" else p[1:] if p[:1] == "\0" else " " + p for p in pieces]
        long = [i for i, w in enumerate(words) if len(w) > SHORT_PIECE]
        cut = [PRE_TOKEN.findall(words[i]) for i in long]
        for i in long:
            words[i] = ""
        out = self._encoded(words)
        parts = list({w for ws in cut for w in ws})
        found = dict(zip(parts, self.tier1.find([w.encode("utf-8", "surrogatepass") for w in parts])))
        unknown = [w for w, n in found.items() if not n]
        found.update(zip(unknown, self._encoded(unknown)))
        for i, ws in zip(long, cut):
            out[i] = sum(map(found.__getitem__, ws))
        return out

    def _table(self, pieces: set[str]) -> dict[str, int]:
        """Tier one for the pieces that are one frequent pre-token, the worker's cache for the others."""
        names = list(pieces)
        keys = [(p[1:] if p[:1] == "\0" else p if p[:1] == "\n" else " " + p).encode("utf-8", "surrogatepass") for p in names]
        found = {p: n for p, n in zip(names, self.tier1.find(keys)) if n}
        missing = pieces - found.keys()
        cached = self.memo.table(missing)
        found.update((p, cached[p]) for p in missing)
        return found

    def _pieces(self, text: str) -> list[str]:
        """Pieces of a text without NUL and uneven white space; the first follows no space, which a leading NUL says."""
        if not text:
            return []
        parts = text.replace("\n", " \n").split(" ")
        parts[0] = "\0" + parts[0]
        return parts

    def count(self, texts: list[str]) -> list[int]:
        pieces, extra = [], []
        for t in texts:
            if "<|" in t and (hits := len(self.special.findall(t))):
                made = [self._whole(x) for x in self.special.split(t) if x]
                extra.append(hits + sum(made))
                pieces.append([])
            elif "\0" in t or UNEVEN.search(t):
                extra.append(self._whole(t))
                pieces.append([])
            else:
                extra.append(0)
                pieces.append(self._pieces(t))
        table = self._table(set().union(*pieces))
        return [e + sum(map(table.__getitem__, ps)) for e, ps in zip(extra, pieces)]

    def _whole(self, text: str) -> int:
        """Texts with runs of white space: cut only at single spaces between non-spaces."""
        parts = CUT.split(text)
        keyed = ["\0" + parts[0], *("\0 " + p for p in parts[1:])]
        table = self._table(set(keyed))
        return sum(map(table.__getitem__, keyed))


_counters: dict = {}


def count_tokens(df: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit)."""
    table = df.sparkSession.sparkContext.broadcast(frequent_lengths(path))

    def run(texts):
        if path not in _counters:
            _counters[path] = Counter(path, table.value)
        n = _counters[path].count(texts)
        return {"n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()), "n_tokens": pa.array(n, pa.int64())}

    out = map_texts(df, run, "n_bytes bigint, n_tokens bigint", (id_col,), text_col, SLICE)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
