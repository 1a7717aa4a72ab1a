"""Operator 6: token ids in a compressed binary format.

Ids get canonical Huffman codes of bounded length from counts over the whole
corpus. A file holds blocks; each block stands alone: ids of its documents, their
token counts, a checkpoint (bit offset) for every STRIDE tokens of a document,
and the bits. Decoding goes through one table lookup a token, for all
checkpoints of a block side by side.

Blocks are rows of Parquet files in ascending order of document ids, so the
engine's committers make writing safe against lost tasks, and code lengths are a
small table beside them.

Defined results: null and empty texts hold the end id alone; rows with repeated
ids come in order of their texts' digests, those with a null id behind all others;
a document of more tokens than a block has one of its own; other columns are not
carried; an empty table gives empty files.
"""

from __future__ import annotations

import functools
import itertools
import re
import string
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import ODD_SPLIT
from .common import Memo, fresh_path, in_arrow, is_id, remove, text_slices, with_row
from .tokens import load

#: Bytes of texts whose different pieces are looked up at once.
SLICE = 4_000_000
#: Longest code, and so the width of the decoding table.
MAX_BITS = 18
#: Tokens between two checkpoints of a document.
STRIDE = 256
#: Tokens of a block, where one document alone has no more.
BLOCK_TOKENS = 1_000_000
#: Bytes of coded ids that one output file is meant to hold: so many while there are few files, and never more than the second.
FILE_BYTES, MOST_FILE_BYTES = 16_000_000, 256_000_000
#: Files up to this number are kept small; beyond it they grow, and then their number.
FEW_FILES = 10_000


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by package-merge; 0 for ids that don't occur."""
    used = np.nonzero(counts)[0]
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n < 2:
        out[used] = 1
        return out
    if n > 1 << limit:
        raise ValueError(f"{n} ids need codes of more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    weights, is_leaf, levels = leaves, np.ones(n, bool), []
    for _ in range(limit):
        levels.append(is_leaf)
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        weights, is_leaf = both[by], by < n
    take = 2 * n - 2
    for is_leaf in reversed(levels):
        n_leaf = int(is_leaf[:take].sum())
        out[order[:n_leaf]] += 1
        take = 2 * (take - n_leaf)
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), np.uint32)
    code = last = 0
    for i in order.tolist():
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For each value of the next ``width`` bits the id, and in the top byte the length of its code."""
    width = max(1, int(lengths.max(initial=0)))
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    repeat = 1 << (width - lengths[order].astype(np.int64))
    ids, bits = np.repeat(order, repeat), np.repeat(lengths[order], repeat)
    pad = (1 << width) - len(ids)
    ids, bits = np.pad(ids, (0, pad)), np.pad(bits, (0, pad), constant_values=1)
    return ids.astype(np.uint32) | bits.astype(np.uint32) << np.uint32(24), width


def encode_ids(docs: list[np.ndarray], lengths: np.ndarray, codes: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
    """For each document its bits, filled up to a byte, and bit offsets of every STRIDE-th token."""
    sizes = np.array([len(d) for d in docs], np.int64)
    flat = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    bits = lengths[flat].astype(np.int64)
    ends = np.cumsum(bits)
    firsts = np.cumsum(sizes) - sizes
    doc_bits = np.add.reduceat(np.append(bits, 0), firsts) * (sizes > 0) if len(docs) else sizes
    doc_bytes = (doc_bits + 7) >> 3
    byte_at = np.cumsum(doc_bytes) - doc_bytes
    before = np.concatenate([[0], ends])[firsts]
    offset = ends - bits + np.repeat((byte_at << 3) - before, sizes)
    out = np.zeros(int(doc_bytes.sum()) + 4, np.uint8)
    if len(flat):
        value = codes[flat] << (32 - bits - (offset & 7)).astype(np.uint32)
        byte = offset >> 3
        first = np.nonzero(np.concatenate([[True], byte[1:] != byte[:-1]]))[0]
        # codes that begin in one byte share no bit, so their sum joins them
        words, byte = np.add.reduceat(value, first), byte[first]
        for k in range(4):
            out[byte + k] += (words >> np.uint32(24 - 8 * k)).astype(np.uint8)
    coded, marks = [], []
    for a, n, at, f in zip(byte_at.tolist(), doc_bytes.tolist(), firsts.tolist(), sizes.tolist()):
        coded.append(out[a : a + n].tobytes())
        marks.append((offset[at : at + f : STRIDE] - (a << 3)).astype(np.uint32))
    return coded, marks


def decode_block(payload: bytes, counts: np.ndarray, marks: np.ndarray, table) -> np.ndarray:
    """Ids of all documents of a block, one after the other."""
    packed, width = table
    raw = np.frombuffer(payload + b"\0\0\0\0", np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    lanes = -(-counts // STRIDE)
    first = np.cumsum(counts) - counts
    index = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    left = np.minimum(STRIDE, np.repeat(counts, lanes) - index * STRIDE)
    start = np.repeat(first, lanes) + index * STRIDE
    order = np.argsort(-left, kind="stable")
    at, left, start = marks[order].astype(np.int64), left[order], start[order]
    out = np.zeros(int(counts.sum()), np.uint32)
    live = np.searchsorted(-left, -np.arange(STRIDE), side="left")  # lanes with more tokens than k
    mask = np.uint32((1 << width) - 1)
    for k in range(STRIDE):
        n = int(live[k])
        if not n:
            break
        here = at[:n]
        peek = window[here >> 3] >> (np.uint32(32 - width) - (here & 7).astype(np.uint32)) & mask
        got = packed[peek]
        out[start[:n] + k] = got & np.uint32(0xFFFFFF)
        here += got >> np.uint32(24)
    return out


#: Characters a run of which is a pre-token of its own behind a letter or digit; behind any other character they join its pre-token.
MARKS = string.punctuation


def ends_apart(chunk: str) -> bool:
    """Whether marks behind ``chunk`` are a pre-token of their own: the chunk, as normalized, ends in a letter or digit."""
    last = chunk[-1:]
    if last > "\xff":  # some letters end in a combining mark once normalized, none of Latin-1
        last = unicodedata.normalize("NFC", chunk).lower()[-1]
    return last.isalnum()


class LibraryCoder:
    """Ids of whole texts by the tokenizers library, with a memo of white-space separated chunks in front."""

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tok = load(path)
        self.memo = Memo(self._chunks, 900_000)
        vocabulary = self.tok.get_vocab(with_added_tokens=True)
        self.kind = "<u2" if max(*vocabulary.values(), end_id) < 1 << 16 else "<u4"
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        # one model behind leaner steps: words of lower-case letters of Latin-1 stay as they are, and whole
        self.latin, self.ascii = Tokenizer(self.tok.model), Tokenizer(self.tok.model)
        self.latin.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ascii.pre_tokenizer = WhitespaceSplit()
        # specials and the end id are pieces that begin with a space, as no other does
        special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.fixed = {" " + t: np.array([i], self.kind).tobytes() for t, i in (special | {"": end_id}).items()}
        self.pattern = re.compile("|".join(map(re.escape, special)) or "(?!)")

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Words are encoded many to a text, and told apart by the ids that end one; marks behind a letter or digit are looked up."""
        ascii_, latin, words, odd = set(), set(), set(), set()
        cut, heads, ends, kept = [], [], [], []
        seen = self.memo.known
        for c in chunks:
            if not c.isalpha():
                w = c.rstrip(MARKS)
                if len(w) == len(c) or not ends_apart(w):
                    odd.add(c)
                    continue
                tail, ids = c[len(w) :], seen.get(w)
                cut.append(c)
                heads.append(w)
                ends.append(tail)
                kept.append(ids)
                odd.add(tail)
                if ids is not None:
                    continue
                if not w.isalpha():
                    odd.add(w)
                    continue
                c = w
            if c.isascii():
                (ascii_ if c.islower() else words).add(c)
            elif max(c) < "\u0100":
                (latin if c.islower() else words).add(c)
            else:
                (words if unicodedata.is_normalized("NFC", c) else odd).add(c)
        made = self._words(list(ascii_), self.ascii) | self._words(list(latin), self.latin) | self._words(list(words), self.tok)
        rest = list(odd)
        made.update(zip(rest, self._whole(rest)))
        for c, w, tail, ids in zip(cut, heads, ends, kept):
            if ids is None:
                ids = made[w]
                if len(w) <= 64:
                    seen[w] = ids  # kept for other marks that will come behind it
            made[c] = ids + made[tail]
        return list(map(made.__getitem__, chunks))

    def _words(self, words: list[str], tok) -> dict[str, bytes]:
        texts = [" ".join(words[k : k + 500]) for k in range(0, len(words), 500)]
        out: dict[str, bytes] = {}
        for at in range(0, len(texts), 40):
            own = words[at * 500 : (at + 40) * 500]
            lists = [e.ids for e in tok.encode_batch_fast(texts[at : at + 40], add_special_tokens=False)]
            flat = np.fromiter(itertools.chain.from_iterable(lists), np.uint32, sum(map(len, lists)))
            ends = np.nonzero(self.ends[flat])[0] + 1
            if len(ends) != len(own):  # a word that is more than one pre-token: take each by itself
                out.update(zip(own, self._whole(own)))
                continue
            raw, cuts = flat.astype(self.kind).tobytes(), (np.dtype(self.kind).itemsize * ends).tolist()
            out.update(zip(own, map(raw.__getitem__, map(slice, [0, *cuts], cuts))))
        return out

    def _whole(self, chunks: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(chunks), 20_000):
            out += [np.array(e.ids, self.kind).tobytes() for e in self.tok.encode_batch_fast(chunks[at : at + 20_000], add_special_tokens=False)]
        return out

    def _plain(self, text: str) -> list[str]:
        try:  # no character of Latin-1 changes under NFC, before or after it is put in lower case
            text.encode("latin-1")
            if "<|" not in text:  # a special in capitals is none, and must not become one
                text = text.lower()
        except UnicodeEncodeError:
            pass
        return ODD_SPLIT.findall(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()

    def _pieces(self, text: str) -> list[str]:
        if "<|" not in text or not self.pattern.search(text):
            return [*self._plain(text), " "]
        out, at = [], 0
        for m in self.pattern.finditer(text):
            out += [*self._plain(text[at : m.start()]), " " + m[0]]
            at = m.end()
        return [*out, *self._plain(text[at:]), " "]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with the end id, as little-endian integers of ``kind``."""
        if not texts:
            return []
        pieces = [self._pieces(t) for t in texts]
        ends = np.cumsum([0, *map(len, pieces)])
        coded = pa.array(list(itertools.chain.from_iterable(pieces)), pa.large_string()).dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.memo.known.get, names))
        at = [k for k, v in enumerate(ids) if v is None]
        fixed = [k for k in at if names[k][0] == " "]
        for k in fixed:
            ids[k] = self.fixed[names[k]]
        if len(at) > len(fixed):
            at = [k for k in at if ids[k] is None]
            for k, v in zip(at, self.memo.add([names[k] for k in at])):
                ids[k] = v
        _, offsets, data = pa.array(ids, pa.large_binary()).take(coded.indices).buffers()
        data, cuts = memoryview(data), np.frombuffer(offsets, np.int64)[ends].tolist()
        return [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])]


@functools.lru_cache(2)
def library_coder(path: str, end_id: int) -> LibraryCoder:
    return LibraryCoder(path, end_id)


def write_tokens(docs: DataFrame, path: str, out: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` under ``out``, in order of integer ids without nulls (``common.numbered`` gives such): folders blocks and lengths."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    coder = library_coder(path, end_id)
    n_vocab, small = len(coder.ends), coder.kind

    def to_ids(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1), SLICE):
                ids = library_coder(path, end_id).encode(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(ids, pa.binary())], names=["id", "ids"])

    at = fresh_path(spark, "ids")
    in_arrow(base, to_ids, "id bigint, ids binary").write.option("compression", "zstd").parquet(at)
    ids = spark.read.schema("id bigint, ids binary").parquet(at)

    def tally(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column(0).to_pylist()), small)
            more = np.bincount(flat, minlength=len(total))
            more[: len(total)] += total
            total = more
        held = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], names=["token", "count"])

    counted = in_arrow(ids.select("ids"), tally, "token int, count bigint").groupBy("token").agg(F.sum("count").alias("count")).toArrow()
    counts = np.zeros(max(n_vocab, end_id + 1), np.int64)  # the vocabulary bounds what comes to the driver
    counts[counted["token"].to_numpy()] = counted["count"].to_numpy()
    lengths = code_lengths(counts)
    codes = canonical_codes(lengths)
    spark.createDataFrame(pa.table({"length": pa.array([lengths.tobytes()], pa.binary())})).write.parquet(f"{out}/lengths")
    shared = spark.sparkContext.broadcast((lengths, codes))
    n_bytes = int((counts * lengths).sum()) // 8
    n_files = max(1, min(FEW_FILES, -(-n_bytes // FILE_BYTES)), -(-n_bytes // MOST_FILE_BYTES))
    # A number for each file is what the driver holds of the files here, and some ten while they are found. Bounds of the files' id ranges from the ids alone; a range exchange would run the encoder twice to find them.
    shares = [k / n_files for k in range(1, n_files)]
    bounds = np.unique(np.array(ids.select("id").approxQuantile("id", shares, 0.1 / n_files), np.float64)) if shares else np.zeros(0)

    def to_bits(batches):
        own, own_codes = shared.value
        for batch in batches:
            raw = batch.column(1).to_pylist()
            begin = 0
            while begin < len(raw):
                end, total = begin, 0
                while end < len(raw) and (end == begin or total + len(raw[end]) < 2_000_000):
                    total += len(raw[end])
                    end += 1
                arrays = [np.frombuffer(x, small) for x in raw[begin:end]]
                coded, marks = encode_ids(arrays, own, own_codes)
                own_ids = batch.column(0).slice(begin, end - begin)
                part = np.searchsorted(bounds, own_ids.to_numpy(zero_copy_only=False), side="left")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), own_ids, pa.array([len(x) for x in arrays], pa.int64()), pa.array([m.tobytes() for m in marks], pa.binary()), pa.array(coded, pa.binary())],
                    names=["part", "id", "n", "marks", "bits"],
                )
                begin = end

    coded = in_arrow(ids, to_bits, "part int, id bigint, n bigint, marks binary, bits binary")
    ordered = coded.repartitionById(n_files, "part").sortWithinPartitions("id")

    def to_blocks(batches):
        part, number, offset = 0, 0, 0
        rows: list = []
        held = 0

        def block():
            ids_, n, marks, bits = zip(*rows)
            sizes = np.array([len(b) for b in bits], np.int64)
            shift = (np.cumsum(sizes) - sizes) * 8
            moved = [np.frombuffer(m, np.uint32).astype(np.int64) + s for m, s in zip(marks, shift.tolist())]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([offset], pa.int64()),
                    pa.array([held], pa.int64()),
                    pa.array([ids_[0]], pa.int64()),
                    pa.array([np.array(ids_, "<i8").tobytes()], pa.binary()),
                    pa.array([np.array(n, "<u4").tobytes()], pa.binary()),
                    pa.array([np.concatenate(moved).astype("<u8").tobytes() if moved else b""], pa.binary()),
                    pa.array([b"".join(bits)], pa.binary()),
                ],
                names=["part", "block", "offset", "n_tokens", "first_id", "ids", "counts", "marks", "bits"],
            )

        for batch in batches:
            for part, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and held + row[1] > BLOCK_TOKENS:
                    yield block()
                    number, offset, rows, held = number + 1, offset + held, [], 0
                rows.append(row)
                held += row[1]
        if rows:
            yield block()

    schema = "part int, block int, offset bigint, n_tokens bigint, first_id bigint, ids binary, counts binary, marks binary, bits binary"
    in_arrow(ordered, to_blocks, schema).write.option("compression", "none").parquet(f"{out}/blocks")
    remove(spark, at)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, ids array<int>, n_tokens) of every document in the files under ``path``, in order of the blocks."""
    return _decoded(spark, path, "ids array<int>", lambda arrays: pa.array([a.astype(np.int32) for a in arrays], pa.list_(pa.int32())))


def _decoded(spark: SparkSession, path: str, column: str, make) -> DataFrame:
    lengths = np.frombuffer(spark.read.parquet(f"{path}/lengths").first()["length"], np.uint8)  # bounded by the vocabulary
    shared = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.parquet(f"{path}/blocks")
    # one row for each file: what all before it hold
    per_part = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"), F.min("first_id").alias("first")).toArrow()
    order = np.argsort(per_part["first"].to_numpy(), kind="stable")
    n = per_part["n"].to_numpy()[order]
    before = dict(zip(per_part["part"].to_numpy()[order].tolist(), (np.cumsum(n) - n).tolist()))
    offsets = spark.sparkContext.broadcast(before)
    name = column.split()[0]

    def run(batches):
        table = decoding_table(shared.value)
        for batch in batches:
            for part, offset, ids, counts, marks, bits in zip(*(batch.column(c).to_pylist() for c in ("part", "offset", "ids", "counts", "marks", "bits"))):
                n = np.frombuffer(counts, "<u4").astype(np.int64)
                tokens = decode_block(bits, n, np.frombuffer(marks, "<u8"), table)
                ends = np.cumsum(n)
                for a in range(0, len(n), 2_000):
                    b = min(a + 2_000, len(n))
                    arrays = [tokens[e - k : e] for e, k in zip(ends[a:b].tolist(), n[a:b].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.frombuffer(ids, "<i8")[a:b]), pa.array(offsets.value[part] + offset + (ends - n)[a:b]), pa.array(n[a:b]), make(arrays)],
                        names=["id", "start", "n_tokens", name],
                    )

    return in_arrow(blocks.select("part", "offset", "ids", "counts", "marks", "bits"), run, f"id bigint, start bigint, n_tokens bigint, {column}")


def token_files(docs: DataFrame, path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files, read them back; per document: id, start, n_tokens and ids_crc32."""
    out = fresh_path(docs.sparkSession, "tokens")
    rows = with_row(docs, id_col, text_col)
    write_tokens(rows, path, out, end_id, "row", "text")
    crc = lambda arrays: pa.array([zlib.crc32(a.astype("<u4").tobytes()) for a in arrays], pa.int64())
    read = _decoded(docs.sparkSession, out, "ids_crc32 bigint", crc).withColumnRenamed("id", "row")
    ids = rows.select("row", "id")
    read = read.withColumnRenamed("row", "id") if is_id(ids) else read.join(ids, "row")
    return read.select(F.col("id").alias(id_col), "start", "n_tokens", "ids_crc32")
