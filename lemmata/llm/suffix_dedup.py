"""Operator 7: removal of repeated 100-byte strings, by column-wise suffix sorting.

Inserting one symbol per document each round, as in the column-wise construction
of a collection's Burrows-Wheeler transform, takes as many rounds as the longest
document has bytes, each over the whole collection. So the collection is first
cut into aligned segments of bounded length:

1. Every window of ``length`` bytes has a seed, the least hash among its 32-byte
   strings. Equal windows have equal seeds at equal places. Seeds go to buckets
   by a digest of all bytes that any window around them can hold, so that no
   bucket is hot because of a common seed; equal ones of a slice of texts are
   folded before they move.
2. Of seeds with equal surroundings all but the first repeat every window around
   them. The first of each kind is looked at further if its seed has other
   surroundings too.
3. Those are the collection: one segment of 168 bytes each, aligned at the seed,
   in a table in the shared folder. A round inserts one symbol of each segment,
   from the last column to the first, and updates their order (the transform is
   the column read in that order) and the common prefixes of neighbours.
   Neighbours with a common prefix of ``length`` hold equal windows there.
4. All windows but the first of equal ones give byte ranges, joined by document.

Groups of over ``HOT`` segments are dealt out in parts; what stays unflagged in a
part is compared across parts. Within a part bytes are compared. Surroundings, and
windows of different parts, are equal where 128 bits of their BLAKE2b digests are.

Defined results: null texts have no bytes; texts shorter than ``length`` lose
nothing; repeated documents lose all but the first; rows with a null or repeated id
are documents of their own, behind those of smaller ids, null ids last, in order of
their digests; what a task gathers of a document (places and ranges) is bounded by
its length, and a text of any length is read in pieces; other columns are not
carried; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, materialize, small_side, with_row

SEED = 32
#: Segments of one seed that one task takes.
HOT = 40_000
BUCKET_ENTRIES = 1_500_000
PAD = 256
_rng = np.random.default_rng(20240601)
SYMBOLS = _rng.integers(1, 1 << 63, 257, np.uint64) | np.uint64(1)
C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

ENTRY = np.dtype([("h", "<u8"), ("c1", "<u8"), ("c2", "<u8"), ("pos", "<u4"), ("doc", "<u2")])
DOC = np.dtype([("id", "<i8"), ("size", "<u4")])
SPAN = np.dtype([("a", "<u4"), ("b", "<u4")])


def doubled(x: np.ndarray, step: int) -> np.ndarray:
    """Hashes of strings twice as long, from those of ``step`` symbols."""
    y = x[:-step] * C1
    y += x[step:]
    y ^= y >> np.uint64(29)
    y *= C2
    return y


def laid_out(texts: list[bytes], margin: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts with ``margin`` pads before, between and behind; where each begins."""
    starts, at = [], margin
    for t in texts:
        starts.append(at)
        at += len(t) + margin
    codes = np.full(at + 64, PAD, np.uint16)
    for t, a in zip(texts, starts):
        codes[a : a + len(t)] = np.frombuffer(t, np.uint8)
    return codes, np.array(starts, np.int64)


def seeds(texts: list[bytes], length: int, ranges: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash) of each seed."""
    margin = length - SEED
    codes, starts = laid_out(texts, margin)
    h, step = SYMBOLS[codes], 1
    while step < SEED:
        h = doubled(h, step)
        step *= 2
    # least of the strings that a window holds; the place in the low bits lets the leftmost win
    v = (h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
    span, m = 1, v
    want = margin + 1
    while 2 * span <= want:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if span < want:
        m = np.minimum(m[: len(m) - (want - span)], m[want - span :])
    valid = np.zeros(len(m) + 1, np.int32)
    lo, hi = np.array(ranges, np.int64).T
    np.add.at(valid, starts + lo, 1)
    np.add.at(valid, starts + hi, -1)
    m = m[np.cumsum(valid[:-1]) > 0] & np.uint64((1 << 24) - 1)
    place = np.unique(m).astype(np.int64)
    text = np.searchsorted(starts, place, side="right") - 1
    return text, place - starts[text], h[place]


def surroundings(texts: list[bytes], text: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """128-bit digests, as rows of two integers, of the bytes that windows around each seed can hold."""
    margin, made = length - SEED, []
    for k, p in zip(text.tolist(), place.tolist()):
        a = p - margin if p > margin else 0
        # the number of bytes before the seed tells where the text begins
        made.append(hashlib.blake2b(texts[k][a : p + length], digest_size=16, salt=(p - a).to_bytes(2, "little")).digest())
    return np.frombuffer(b"".join(made), "<u8").reshape(-1, 2)


def split_repeats(c1, c2, doc, pos, size, length):
    """Order of the entries; which begin a kind of surroundings; (doc, begin, end) of what the others repeat."""
    margin = length - SEED
    order = np.lexsort((pos, doc, c2, c1))
    c1, c2, doc, pos, size = (x[order] for x in (c1, c2, doc, pos, size))
    new = np.ones(len(c1), bool)
    new[1:] = (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])
    doc, pos, size = doc[~new], pos[~new].astype(np.int64), size[~new].astype(np.int64)
    return order, new, (doc, np.maximum(pos - margin, 0), np.minimum(pos, size - length) + length)


SEEDS = ["bucket", "docs", "entries", "id", "spans"]


def span_rows(owners, spans, names, bucket=0):
    """Batches of (owner, spans), other columns null."""
    for at in range(0, len(owners), 50_000):
        x = pa.array(np.asarray(owners[at : at + 50_000], np.int64))
        cols = {"id": x, "spans": pa.array(spans[at : at + 50_000], pa.binary()), "bucket": pa.array(np.asarray(owners[at : at + 50_000], np.int64) % max(1, bucket), pa.int32())}
        kinds = {"docs": pa.binary(), "entries": pa.binary(), "key": pa.int64(), "pos": pa.int32(), "w1": pa.int64(), "w2": pa.int64(), "start": pa.int32()}
        yield pa.RecordBatch.from_arrays([cols[c] if c in cols else pa.nulls(len(x), kinds[c]) for c in names], names=names)


def seed_entries(docs: DataFrame, n_buckets: int, length: int) -> DataFrame:
    """``docs`` (id, raw) to packed seeds (bucket, docs, entries), and to (bucket, id, spans) of repeats within a slice."""

    def run(batches):
        for batch in batches:
            ids, raws = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(ids):
                end, total = at, 0
                while end < len(ids) and end - at < 60_000 and (end == at or total + len(raws[end]) < 2_000_000):
                    total += len(raws[end]) + 80
                    end += 1
                keep = [k for k in range(at, end) if len(raws[k]) >= length]
                at = end
                for part_ids, part_raws, shifts, sizes, ranges in parts([ids[k] for k in keep], [raws[k] for k in keep], length):
                    text, place, h = seeds(part_raws, length, ranges)
                    c = surroundings(part_raws, text, place, length)
                    own = np.empty(len(part_ids), DOC)
                    own["id"], own["size"] = part_ids, sizes
                    order, new, again = split_repeats(c[:, 0], c[:, 1], own["id"][text], place + shifts[text], own["size"][text], length)
                    yield from span_rows(*merged_spans(*again), SEEDS, n_buckets)
                    i = order[new]
                    text, pos, h, c = text[i], (place + shifts[text])[i], h[i], c[i]
                    bucket = (c[:, 0] % np.uint64(n_buckets)).astype(np.int64)
                    by = np.argsort(bucket, kind="stable")
                    edges = np.searchsorted(bucket[by], np.arange(n_buckets + 1))
                    out = []
                    for k in np.nonzero(np.diff(edges))[0].tolist():
                        i = by[edges[k] : edges[k + 1]]
                        used, local = np.unique(text[i], return_inverse=True)
                        e = np.empty(len(i), ENTRY)
                        e["h"], e["c1"], e["c2"], e["pos"], e["doc"] = h[i], c[i, 0], c[i, 1], pos[i], local
                        out.append((k, own[used].tobytes(), e.tobytes()))
                    if out:
                        ks, ds, es = zip(*out)
                        none = pa.nulls(len(ks))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ks, pa.int32()), pa.array(ds, pa.binary()), pa.array(es, pa.binary()), none.cast(pa.int64()), none.cast(pa.binary())], names=SEEDS
                        )

    return in_arrow(docs, run, "bucket int, docs binary, entries binary, id bigint, spans binary")


#: A text of more bytes is read in pieces, so that places fit the low bits of the compared numbers.
PART = 8_000_000


def parts(ids: list, raws: list[bytes], length: int):
    """Groups of (ids, texts, shifts, whole sizes, ranges of window starts).

    A piece of a long text answers for PART window starts, and holds the bytes around
    them that surroundings of their seeds can reach.
    """
    short = [k for k, r in enumerate(raws) if len(r) <= PART]
    if short:
        sizes = [len(raws[k]) for k in short]
        yield [ids[k] for k in short], [raws[k] for k in short], np.zeros(len(short), np.int64), sizes, [(0, n - length + 1) for n in sizes]
    margin = length - SEED
    for k, r in enumerate(raws):
        for at in range(0, len(r) - length + 1, PART) if len(r) > PART else ():
            shift = max(0, at - margin)
            end = min(at + PART, len(r) - length + 1)
            yield [ids[k]], [r[shift : end + 2 * length]], np.array([shift]), [len(r)], [(at - shift, end - shift)]


def merged_spans(doc: np.ndarray, a: np.ndarray, b: np.ndarray):
    """(doc, packed spans) with overlapping and touching spans of a document joined."""
    order = np.lexsort((a, doc))
    doc, a, b = doc[order], a[order], b[order]
    if not len(doc):
        return [], []
    fresh = np.concatenate([[True], doc[1:] != doc[:-1]])
    group = np.cumsum(fresh) - 1
    # running maximum of ends within a document: documents are shifted apart
    base = group.astype(np.int64) << 33
    reach = np.maximum.accumulate(b.astype(np.int64) + base)
    begins = fresh.copy()
    begins[1:] |= (a[1:].astype(np.int64) + base[1:]) > reach[:-1]
    first = np.nonzero(begins)[0]
    last = np.append(first[1:], len(doc)) - 1
    spans = np.empty(len(first), SPAN)
    spans["a"], spans["b"] = a[first], reach[last] - base[last]
    owners = doc[first]
    cut = np.nonzero(np.concatenate([[True], owners[1:] != owners[:-1]]))[0]
    ends = np.append(cut[1:], len(owners))
    return owners[cut], [spans[x:y].tobytes() for x, y in zip(cut.tolist(), ends.tolist())]


FIRSTS = ["id", "spans", "key", "pos"]


def first_repeats(entries: DataFrame, n_buckets: int, length: int) -> DataFrame:
    """Mixed rows: (id, spans), and (id, key, pos): the first seed of each kind of surroundings, by the hash of the seed."""

    def made(rows):
        docs = [np.frombuffer(d, DOC) for d, _ in rows]
        es = [np.frombuffer(e, ENTRY) for _, e in rows]
        doc, size = (np.concatenate([d[k][e["doc"]] for d, e in zip(docs, es)]) for k in ("id", "size"))
        h, c1, c2, pos = (np.concatenate([e[k] for e in es]) for k in ("h", "c1", "c2", "pos"))
        order, new, again = split_repeats(c1, c2, doc, pos, size, length)
        yield from span_rows(*merged_spans(*again), FIRSTS)
        first = order[new]
        for at in range(0, len(first), 200_000):
            i = first[at : at + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(doc[i]), pa.nulls(len(i), pa.binary()), pa.array(h[i].view(np.int64)), pa.array(pos[i].astype(np.int32))], names=FIRSTS)

    def run(batches):
        bucket, rows = None, []
        for batch in batches:
            own = batch.column(4).is_valid()
            through = batch.filter(own)
            if through.num_rows:  # repeats that were found before
                none = pa.nulls(through.num_rows)
                yield pa.RecordBatch.from_arrays([through.column(3), through.column(4), none.cast(pa.int64()), none.cast(pa.int32())], names=FIRSTS)
            batch = batch.filter(pc.invert(own))
            for k, d, e in ([batch.column(c)[i].as_py() for c in range(3)] for i in range(batch.num_rows)):
                if k != bucket and rows:
                    yield from made(rows)
                    rows = []
                bucket = k
                rows.append((d, e))
        if rows:
            yield from made(rows)

    dealt = entries.repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
    return in_arrow(dealt, run, "id bigint, spans binary, key bigint, pos int")


def segments(docs: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """(key, part, id, pos, size, segment) for ``asked`` (id, asks array<struct<key, part, pos>>)."""
    margin = length - SEED
    with_text = docs.join(small_side(asked.select("id")), "id", "left_semi").join(asked, "id").select("id", "raw", "asks")

    def run(batches):
        names = ["key", "part", "id", "pos", "size", "segment"]
        for batch in batches:
            for i, raw, asks in zip(*(c.to_pylist() for c in batch.columns)):
                for at in range(0, len(asks), 5_000):
                    some = asks[at : at + 5_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([x["key"] for x in some], pa.int64()),
                            pa.array([x["part"] for x in some], pa.int32()),
                            pa.array([i] * len(some), pa.int64()),
                            pa.array([x["pos"] for x in some], pa.int32()),
                            pa.array([len(raw)] * len(some), pa.int32()),
                            pa.array([raw[max(0, x["pos"] - margin) : x["pos"] + length] for x in some], pa.binary()),
                        ],
                        names=names,
                    )

    return in_arrow(with_text, run, "key bigint, part int, id bigint, pos int, size int, segment binary")


def least_between(lcp: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of lcp[lo + 1 .. hi] for each pair, lo < hi, by a sparse table."""
    width = hi - lo
    level = np.zeros(len(width), np.int64)
    top = int(width.max())
    tables, span = [lcp], 1
    while 2 * span <= top:
        t = tables[-1]
        tables.append(np.minimum(t[:-span], t[span:]))
        span *= 2
    level = np.floor(np.log2(width)).astype(np.int64)
    out = np.empty(len(width), lcp.dtype)
    for k, t in enumerate(tables):
        own = level == k
        if own.any():
            out[own] = np.minimum(t[lo[own] + 1], t[hi[own] + 1 - (1 << k)])
    return out


def column_rounds(symbols: np.ndarray, group: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """Which windows repeat: flags [segment, first column of the window].

    ``symbols`` [segment, column], ``group`` the seed of each (sorted), ``rank`` the
    order of segments by document and place. A round inserts a column, from the
    last to the first: a stable sort by its symbols within each group turns the
    order of the suffixes behind it into that of the suffixes from it on.
    """
    n, columns = symbols.shape
    order = np.arange(n)
    fresh = np.concatenate([[True], group[1:] != group[:-1]])
    number = np.cumsum(fresh) - 1
    lcp = np.zeros(n, np.int32)  # of a suffix and the one before it
    flags = np.zeros((n, columns - length + 1), bool)
    for c in range(columns - 1, -1, -1):
        bwt = symbols[order, c]
        differs = np.concatenate([[False], bwt[1:] != bwt[:-1]]) & ~fresh
        if differs.any():
            mixed = np.bincount(number, weights=differs)[number] > 0
            same = ~mixed & ~fresh
            lcp[same] += 1
            at = np.nonzero(mixed)[0]
            key = number[at].astype(np.int64) * 512 + bwt[at]
            by = np.argsort(key, kind="stable")
            key = key[by]
            equal = np.concatenate([[False], key[1:] == key[:-1]])
            old = lcp[at]
            new = np.zeros(len(at), np.int32)
            if equal.any():
                e = np.nonzero(equal)[0]
                new[e] = least_between(old, by[e - 1], by[e]) + 1
            order[at] = order[at][by]
            lcp[at] = new
        else:
            lcp[~fresh] += 1
        if c < flags.shape[1]:
            starts = np.nonzero(fresh | (lcp < length))[0]
            least = np.minimum.reduceat(rank[order], starts)
            sizes = np.diff(np.append(starts, n))
            flags[order, c] = rank[order] != np.repeat(least, sizes)
    return flags


WINDOW_BATCH = 60_000


def compare_segments(table: DataFrame, n_parts: int, length: int) -> DataFrame:
    """Mixed rows: (id, spans), and for parted groups (id, w1, w2, start): windows left unflagged and their digests."""
    margin = length - SEED
    columns = margin + length
    names = ["id", "spans", "w1", "w2", "start"]

    def made(rows):
        key = np.array([r[0] for r in rows], np.int64)
        part = np.array([r[1] for r in rows], np.int64)
        doc, pos, size = (np.array([r[k] for r in rows], np.int64) for k in (2, 3, 4))
        symbols = np.full((len(rows), columns), PAD, np.uint16)
        for k, r in enumerate(rows):
            a = max(0, margin - r[3])
            symbols[k, a : a + len(r[5])] = np.frombuffer(r[5], np.uint8)
        order = np.lexsort((part, key))
        key, part, doc, pos, size, symbols = key[order], part[order], doc[order], pos[order], size[order], symbols[order]
        group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (part[1:] != part[:-1]))])
        by = np.lexsort((pos, doc))
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        flags = column_rounds(symbols, group, rank, length)
        start = pos[:, None] - margin + np.arange(flags.shape[1])
        valid = (start >= 0) & (start + length <= size[:, None])
        hit = flags & valid
        edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        ra, ca = np.nonzero(edge == 1)
        rb, cb = np.nonzero(edge == -1)
        owners, spans = merged_spans(doc[ra], pos[ra] - margin + ca, pos[rb] - margin + cb - 1 + length)
        yield from span_rows(owners, spans, names)
        left = np.argwhere(valid & ~hit & (part >= 0)[:, None])
        for at in range(0, len(left), WINDOW_BATCH):
            r, c = left[at : at + WINDOW_BATCH].T
            raw = symbols[r[:, None], c[:, None] + np.arange(length)].astype(np.uint8)
            digest = np.frombuffer(b"".join(hashlib.blake2b(w.tobytes(), digest_size=16).digest() for w in raw), "<i8").reshape(-1, 2)
            own = [pa.array(doc[r]), pa.nulls(len(r), pa.binary()), *(pa.array(np.ascontiguousarray(digest[:, k])) for k in (0, 1))]
            yield pa.RecordBatch.from_arrays([*own, pa.array((pos[r] - margin + c).astype(np.int32))], names=names)

    def run(batches):
        # whole groups are gathered up to a bound, so that a round's arrays are long enough
        rows: list = []
        key = None
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if (r[0], r[1]) != key:
                    if len(rows) >= 60_000:
                        yield from made(rows)
                        rows = []
                    key = (r[0], r[1])
                rows.append(r)
        if rows:
            yield from made(rows)

    dealt = table.repartition(n_parts, "key", "part").sortWithinPartitions("key", "part")
    return in_arrow(dealt, run, "id bigint, spans binary, w1 bigint, w2 bigint, start int")


def removal_spans(docs: DataFrame, length: int = 100) -> DataFrame:
    """(id, list of packed spans) of ``docs`` (id bigint, raw binary), not yet joined across sources."""
    n_bytes = docs.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    n_buckets = max(4, int(n_bytes / 36 / BUCKET_ENTRIES) + 1)
    found = materialize(first_repeats(seed_entries(docs, n_buckets, length), n_buckets, length), "repeats")
    firsts = found.where("key is not null").select("id", "key", "pos")
    # kinds of surroundings of each seed: counts are folded before they move, and a hot seed's rows can be split by the engine
    kinds = firsts.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1").select("key")
    asks = materialize(firsts.join(small_side(materialize(kinds, "kinds")), "key"), "firsts")
    many = asks.groupBy("key").count().where(F.col("count") > HOT).select("key", F.ceil(F.col("count") / HOT).cast("int").alias("n_parts"))
    asks = asks.join(small_side(materialize(many, "hot")), "key", "left").withColumn(
        "part", F.when(F.col("n_parts").isNull(), -1).otherwise(F.pmod(F.xxhash64("id", "pos"), F.col("n_parts")).cast("int"))
    )
    asked = materialize(asks.groupBy("id").agg(F.collect_list(F.struct("key", "part", "pos")).alias("asks")), "asks")
    n_asks = asked.agg(F.sum(F.size("asks"))).first()[0] or 0
    table = segments(docs, asked, length)
    compared = materialize(compare_segments(table, max(4, int(n_asks // 60_000) + 1), length), "compared")
    spans = found.where("spans is not null").select("id", "spans").unionByName(compared.where("spans is not null").select("id", "spans"))
    windows = compared.where("w1 is not null").select("id", "w1", "w2", "start")
    least = windows.groupBy("w1", "w2").agg(F.min(F.struct("id", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    late = windows.join(least, ["w1", "w2"]).where(F.struct("id", "start") > F.col("first")).select("id", "start")
    return spans.unionByName(late.select("id", pack_le(length).alias("spans"))) if not windows.isEmpty() else spans


def pack_le(length: int):
    """Two little-endian unsigned 32-bit integers: start and start + length."""
    byte = lambda v, k: F.lpad(F.hex(F.shiftright(v, 8 * k).bitwiseAND(255)), 2, "0")
    a, b = F.col("start"), F.col("start") + length
    return F.unhex(F.concat(*[byte(a, k) for k in range(4)], *[byte(b, k) for k in range(4)]))


def joined(spans: list[bytes]) -> list[tuple[int, int]]:
    every = sorted((int(a), int(b)) for s in spans for a, b in np.frombuffer(s, SPAN))
    out: list[list[int]] = []
    for a, b in every:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, raw, kept (both binary) and spans array<struct<a, b>> of removed bytes."""
    raw = F.coalesce("text", F.lit("")).cast("binary").alias("raw")
    rows = with_row(docs, id_col, text_col).select(F.col("row").alias("place"), "id", raw)
    base = rows.select(F.col("place").alias("id"), "raw")
    spans = removal_spans(base, length).groupBy(F.col("id").alias("place")).agg(F.collect_list("spans").alias("spans"))
    spans = materialize(spans, "spans")
    places = small_side(spans.select("place"))
    untouched = rows.join(places, "place", "left_anti").select("id", "raw", F.lit(None).cast("array<binary>").alias("spans"))
    touched = rows.join(places, "place", "left_semi").join(spans, "place").select("id", "raw", "spans")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            raws, spans = (batch.column(c).to_pylist() for c in (1, 2))
            gone = [joined(s or []) for s in spans]
            kept = []
            for raw, cut in zip(raws, gone):
                ends = [0, *(b for _, b in cut)]
                kept.append(b"".join(raw[x:a] for x, a in zip(ends, [*(a for a, _ in cut), len(raw)])))
            ranges = pa.array([[{"a": a, "b": b} for a, b in c] for c in gone], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kept, pa.binary()), ranges], names=["id", "raw", "kept", "spans"])

    return in_arrow(untouched.unionByName(touched), run, f"id {kind}, raw binary, kept binary, spans array<struct<a: bigint, b: bigint>>")


def repeat_report(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans and kept_sha256."""
    out = without_repeats(docs, length, id_col, text_col)
    return out.select(
        F.col("id").alias(id_col),
        F.octet_length("raw").cast("long").alias("n_bytes"),
        (F.octet_length("raw") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
