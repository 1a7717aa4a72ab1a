"""Operator 1: chroma audio fingerprints of a media column.

A recording (16-bit WAV) is mixed to frames of energy in the twelve pitch classes.
Sums over rectangles of that image come from its integral image; each of sixteen
filters compares such sums and is quantised to two bits, so that a frame position
gives one 32-bit integer. Two recordings are aligned by a histogram of offsets:
wherever integers of theirs agree on either half of their bits, that offset gets a
vote. Each offset with a vote is judged by its share of wrong bits, and the best
one is kept.

The search takes the queries in blocks of bounded size, each broadcast, and reads
the table of fingerprints once for each. Votes are counted where a recording is
read and never move, so a code that many recordings have, such as silence, is
spread over all tasks; runs of one code vote as one interval of offsets.

Defined results: null, empty and unreadable media have an empty fingerprint, as
have recordings too short for one filter, and match nothing; repeated rows and ids
each get a row, null ids are carried; among offsets of equal error the one nearest
to 0 is kept, then the negative one; an empty table gives an empty table; other
columns are not carried; a very long recording is worked on a few frames at a time,
and makes a block of its own where it is a query.
"""

from __future__ import annotations

import functools
import io
import uuid
import wave

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import cuts, fresh_path, in_arrow, remove

RATE, FRAME, HOP = 5512, 2048, 512
#: Frequencies that count, from the A below the staff to the highest useful octave.
LOW, HIGH = 110.0, 1760.0
#: Frames that the widest filter spans.
SPAN = 16
#: (kind, first pitch class, number of classes, frames); all are quantised at QUANTILES.
#: Kinds: 0 part against whole, 1 upper against lower half, 2 first against second half, 3 checkerboard, 4 middle third in pitch, 5 middle third in time.
FILTERS = [
    (kind, first, height, width)
    for kind, first, height, width in (
        (0, 0, 4, 6), (1, 0, 12, 8), (1, 2, 8, 14), (2, 0, 6, 12), (2, 6, 6, 12), (3, 0, 12, 8), (3, 3, 6, 16), (4, 0, 9, 8),
        (4, 3, 9, 16), (5, 0, 6, 15), (5, 6, 6, 15), (1, 4, 4, 10), (2, 3, 4, 16), (3, 6, 6, 10), (0, 8, 4, 10), (4, 0, 12, 4),
    )
]
#: Differences of logarithms that divide a filter's answers into four levels.
QUANTILES = (-0.18, 0.0, 0.18)
#: Frames that are transformed at a time.
FRAMES = 16
#: Recordings that a worker renders or reads at a time.
MEDIA_ROWS = 64
#: An integer votes for an offset by each of its disjoint groups of so many bits that agrees.
VOTE_BITS = 16
#: Integers of the queries of one block, where one query alone has no more.
BLOCK_CODES = 250_000
#: Pairs of integers that are compared at once.
AT_ONCE = 100_000
#: Integers of an alignment that are compared before it is judged again; eight words of 64 bits.
STRETCH = 16


def decode_wav(raw: bytes | None) -> np.ndarray:
    if not raw:
        return np.zeros(0)
    try:
        with wave.open(io.BytesIO(raw)) as w:
            if w.getsampwidth() != 2:
                return np.zeros(0)
            x = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(np.float64) / 32768
            x = x[: len(x) // w.getnchannels() * w.getnchannels()].reshape(-1, w.getnchannels()).mean(axis=1)
            rate = w.getframerate()
    except (wave.Error, EOFError, ValueError):
        return np.zeros(0)
    if rate != RATE and len(x):
        x = np.interp(np.arange(0, len(x), rate / RATE), np.arange(len(x)), x)
    return x


def encode_wav(x: np.ndarray, rate: int = RATE) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


_freq = np.fft.rfftfreq(FRAME, 1 / RATE)
_use = np.nonzero((_freq >= LOW) & (_freq <= HIGH))[0]
_class = np.round(12 * np.log2(_freq[_use] / 440.0)).astype(int) % 12
_fold = (np.arange(12)[:, None] == _class).astype(np.float64)
_taper = np.hamming(FRAME)


def chroma(x: np.ndarray) -> np.ndarray:
    """Frames of twelve energies, smoothed over five frames, each of unit length (silence stays 0)."""
    n = (len(x) - FRAME) // HOP + 1
    if n < 1:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP][:n]
    energy = np.empty((n, 12))
    for at in range(0, n, FRAMES):
        part = np.fft.rfft(frames[at : at + FRAMES] * _taper, axis=1)[:, _use[0] : _use[-1] + 1]
        energy[at : at + FRAMES] = (part.real**2 + part.imag**2) @ _fold.T
    padded = np.pad(energy, ((2, 2), (0, 0)), mode="edge")
    smooth = sum(w * padded[k : k + n] for k, w in enumerate((0.25, 0.75, 1.0, 0.75, 0.25)))
    norm = np.linalg.norm(smooth, axis=1, keepdims=True)
    return np.where(norm > 1e-6, smooth / np.maximum(norm, 1e-12), 0.0)


def fingerprint(x: np.ndarray) -> np.ndarray:
    """One unsigned 32-bit integer for each position of the filters."""
    image = chroma(x)
    n = len(image) - SPAN + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    integral = np.pad(image.cumsum(axis=0).cumsum(axis=1), ((1, 0), (1, 0)))
    at = np.arange(n)

    def area(t0, t1, p0, p1):
        return integral[at + t1, p1] - integral[at + t0, p1] - integral[at + t1, p0] + integral[at + t0, p0]

    out = np.zeros(n, np.uint32)
    for kind, p, h, w in FILTERS:
        whole = area(0, w, p, p + h)
        if kind == 0:
            plus, minus = whole, area(0, w, 0, 12) * h / 12
        elif kind == 1:
            plus = area(0, w, p + h // 2, p + h)
            minus = whole - plus
        elif kind == 2:
            plus = area(w // 2, w, p, p + h)
            minus = whole - plus
        elif kind == 3:
            plus = area(0, w // 2, p, p + h // 2) + area(w // 2, w, p + h // 2, p + h)
            minus = whole - plus
        elif kind == 4:
            plus = area(0, w, p + h // 3, p + 2 * h // 3) * 2
            minus = whole - plus / 2
        else:
            plus = area(w // 3, 2 * w // 3, p, p + h) * 2
            minus = whole - plus / 2
        level = np.digitize(np.log1p(np.maximum(plus, 0)) - np.log1p(np.maximum(minus, 0)), QUANTILES)
        gray = level ^ (level >> 1)  # neighbouring levels differ in one bit
        out = out << np.uint32(2) | gray.astype(np.uint32)
    return out


def fingerprints(media: DataFrame, id_col: str, media_col: str, read=decode_wav) -> DataFrame:
    """Per row: id, codes array<bigint>. ``read`` makes samples at RATE from a value of the media column."""
    base = media.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{media_col}`").alias("media"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, MEDIA_ROWS):
                part = batch.slice(at, MEDIA_ROWS)
                codes = [fingerprint(read(v.as_py())).astype(np.int64) for v in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(codes, pa.list_(pa.int64()))], names=["id", "codes"])

    kind = base.schema["id"].dataType.simpleString()
    return in_arrow(base, run, f"id {kind}, codes array<bigint>")


def runs(codes: np.ndarray, group: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, first, end) of the runs of equal values of a group of bits."""
    value = codes >> np.uint32(group * VOTE_BITS) & np.uint32((1 << VOTE_BITS) - 1)
    first = np.nonzero(np.concatenate([[True], value[1:] != value[:-1]]))[0]
    return value[first], first, np.append(first[1:], len(codes))


def stretches(codes: np.ndarray) -> np.ndarray:
    """For each place the STRETCH integers from there on as one item, over the same memory; zeros follow the end."""
    padded = np.concatenate([codes.astype("<u4"), np.zeros(STRETCH, "<u4")])
    return np.ndarray(len(codes) + 1, f"V{4 * STRETCH}", padded, strides=(4,))


#: Bits of the first k integers of a stretch.
KEPT = np.tril(np.full((STRETCH, STRETCH), 0xFFFFFFFF, "<u4"), -1).view("<u8")
_BYTES, _ADD, _EIGHT, _TOP = (np.uint64(x) for x in (0x00FF00FF00FF00FF, 0x0001000100010001, 8, 48))


def close(mine: np.ndarray, other: np.ndarray, i: np.ndarray, j: np.ndarray, overlap: np.ndarray, max_error: float) -> tuple[np.ndarray, np.ndarray]:
    """(places, bit errors) of the alignments that have at most ``max_error``, in order.

    An alignment sets ``overlap`` integers from ``i`` on (``mine``, as stretches) beside
    those from ``j`` on. One is let go as soon as its wrong bits alone are too many.
    """
    # like overlaps side by side; exactly so up to 65,535, which sort faster
    order = np.argsort(np.minimum(overlap, 0xFFFF).astype(np.uint16), kind="stable")
    most = np.floor(max_error * 32 * overlap).astype(np.int64) + 1  # one more, so that rounding lets none go
    found, bits_wrong = [], []
    for at in range(0, len(order), AT_ONCE // STRETCH):
        live = order[at : at + AT_ONCE // STRETCH]
        a, b, left, allowed = i[live], j[live], overlap[live], most[live]
        while len(live):
            bits = mine[a].view("<u8")
            bits ^= other[b].view("<u8")
            short = np.nonzero(left < STRETCH)[0]
            if len(short):
                bits = bits.reshape(-1, STRETCH // 2)
                bits[short] &= KEPT[left[short]]
            # eight counts of at most 64 each in one integer, added up in it
            eight = np.bitwise_count(bits).reshape(-1).view("<u8")
            allowed -= ((((eight & _BYTES) + (eight >> _EIGHT & _BYTES)) * _ADD) >> _TOP).view(np.int64)
            keep = allowed >= 0
            ended = left <= STRETCH
            if ended.any():
                done = np.nonzero(keep & ended)[0]
                found.append(live[done])
                bits_wrong.append(most[live[done]] - allowed[done])
                keep &= ~ended
            if not keep.all():
                on = np.nonzero(keep)[0]
                live, a, b, left, allowed = live[on], a[on], b[on], left[on], allowed[on]
            a += STRETCH
            b += STRETCH
            left -= STRETCH
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    found = np.concatenate(found)
    error = np.concatenate(bits_wrong) / (32.0 * overlap[found])
    good = np.nonzero(error <= max_error)[0]
    good = good[np.argsort(found[good])]
    return found[good], error[good]


class Block:
    """The queries of a block, ready to be met by any recording."""

    def __init__(self, sizes: np.ndarray, codes: np.ndarray):
        self.sizes, self.codes = sizes.astype(np.int64), stretches(codes)
        self.start = np.cumsum(self.sizes) - self.sizes
        self.groups = []
        for g in range(32 // VOTE_BITS):
            found = [(k, *runs(codes[a : a + n], g)) for k, (a, n) in enumerate(zip(self.start.tolist(), sizes.tolist()))]
            value = np.concatenate([v for _, v, _, _ in found]).astype(np.int64)
            owner = np.concatenate([np.full(len(v), k) for k, v, _, _ in found])
            first, end = (np.concatenate([x[i] for x in found]) for i in (2, 3))
            by = np.argsort(value, kind="stable")
            index = np.searchsorted(value[by], np.arange((1 << VOTE_BITS) + 1))
            # offsets from the place of the bin of offset 0 with n = 0: to the farthest and behind the nearest end of a run
            far = (self.start + self.sizes)[owner] - end
            self.groups.append((index, owner[by], far[by], (far + end - first)[by]))

    def voted(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, offset) of the bins of the histogram that hold a vote of ``codes``."""
        n = len(codes)
        # the bins of a query: offsets 1 - size to n - 1, and one that ends the last
        base = self.start + n * np.arange(len(self.sizes))
        bins, one = np.zeros(int((self.sizes + n).sum()) + 1, np.int32), np.int32(1)  # of one type: np.add.at is fast then
        for g, (index, owner, far, near) in enumerate(self.groups):
            value, a, b = runs(codes, g)
            count = index[value + 1] - index[value]
            for x, y in cuts(count, AT_ONCE):
                c = count[x:y]
                own = np.repeat(np.arange(x, y), c)
                hit = np.arange(len(own)) + np.repeat(index[value[x:y]] - (np.cumsum(c) - c), c)
                # runs that agree give every offset from their farthest to their nearest ends
                shift = owner[hit] * n
                np.add.at(bins, shift + far[hit] + a[own], one)
                np.subtract.at(bins, shift + near[hit] + b[own] - 1, one)
        # votes change at few bins: from each of these on to the next all hold as many
        at = np.nonzero(bins != 0)[0]
        wide = np.diff(at, append=len(bins)) * (np.cumsum(bins[at]) > 0)
        held = np.arange(int(wide.sum())) + np.repeat(at - (np.cumsum(wide) - wide), wide)
        query = np.repeat(np.arange(len(base)), np.diff(np.searchsorted(held, base), append=len(held)))
        return query, held - base[query] - self.sizes[query] + 1

    def matches(self, codes: np.ndarray, max_error: float, least_overlap: int):
        """(query, offset, overlap, bit error) of the best offset of each query that matches ``codes``."""
        n = len(codes)
        query, offset = self.voted(codes)
        first = np.maximum(0, -offset)
        overlap = np.minimum(self.sizes[query] - first, n - offset - first)
        ok = overlap >= least_overlap
        query, offset, first, overlap = query[ok], offset[ok], first[ok], overlap[ok]
        i, j = self.start[query] + first, first + offset
        good, error = close(self.codes, stretches(codes), i, j, overlap, max_error)
        query, offset, overlap = query[good], offset[good], overlap[good]
        order = np.lexsort((offset, np.abs(offset), error, query))
        best = order[np.concatenate([[True], query[order][1:] != query[order][:-1]])] if len(order) else order
        return query[best], offset[best], overlap[best], error[best]


def align(queries: DataFrame, recordings: DataFrame, max_error: float = 0.25, least_overlap: int = 12) -> DataFrame:
    """Alignments (query, id, offset, overlap, bit_error) of fingerprint tables (id, codes): the best offset of each pair.

    Every offset with a vote and enough overlap is judged. ``recordings`` is read
    once for each block of queries.
    """

    def rows(met):
        cols = [[], [], [], [], []]
        for name, ids, _, (q, *rest) in met:
            for to, v in zip(cols, ([ids[k] for k in q.tolist()], [name] * len(q), *(r.tolist() for r in rest))):
                to.extend(v)
        return cols

    kinds = [x.schema["id"].dataType for x in (queries, recordings)]
    return _search(queries.withColumn("weight", F.lit(1)), recordings, max_error, least_overlap, rows, [("query", kinds[0]), ("id", kinds[1]), *RESULT])


def answers(queries: DataFrame, recordings: DataFrame, max_error: float = 0.25, least_overlap: int = 12) -> DataFrame:
    """Per recording that any query matches: (id, n_matches, query, offset, overlap, bit_error) of the best, equal ones by query id.

    ``queries`` (id, codes, weight): a query counts for as many as its weight. As
    ``align``, but pairs are folded where they are found, so that a row for each
    recording and block of queries is all that leaves a task.
    """

    def rows(met):
        cols = [[], [], [], [], [], []]
        for name, ids, weights, (q, offset, overlap, error) in met:
            if len(q):
                near = np.nonzero(error == error.min())[0].tolist()
                k = min(near, key=lambda i: ids[q[i]])
                own = (name, int(weights[q].sum()), ids[q[k]], int(offset[k]), int(overlap[k]), float(error[k]))
                for to, v in zip(cols, own):
                    to.append(v)
        return cols

    kinds = [x.schema["id"].dataType for x in (queries, recordings)]
    found = _search(queries, recordings, max_error, least_overlap, rows, [("id", kinds[1]), ("n_matches", T.LongType()), ("query", kinds[0]), *RESULT])
    best = F.min(F.struct("bit_error", "query", "offset", "overlap")).alias("b")
    t = found.groupBy("id").agg(F.sum("n_matches").alias("n_matches"), best)
    return t.select("id", "n_matches", "b.query", "b.offset", "b.overlap", "b.bit_error")


RESULT = [("offset", T.IntegerType()), ("overlap", T.IntegerType()), ("bit_error", T.DoubleType())]


def _search(queries: DataFrame, recordings: DataFrame, max_error: float, least_overlap: int, rows, fields: list[tuple[str, T.DataType]]) -> DataFrame:
    """What ``rows`` makes of (recording, ids and weights of a block's queries, matches), in columns named by ``fields``."""
    spark = queries.sparkSession
    id_kind = queries.schema["id"].dataType.simpleString()
    names, types = [n for n, _ in fields], [to_arrow_type(t) for _, t in fields]
    schema = ", ".join(f"{n} {t.simpleString()}" for n, t in fields)
    asked = queries.select("id", "codes", F.col("weight").cast("bigint")).where(F.size("codes") >= least_overlap)
    n_codes = asked.agg(F.sum(F.size("codes"))).first()[0] or 0
    n_blocks = int(n_codes // (BLOCK_CODES // 2)) + 1

    def pack(batches):
        # a task's queries in blocks; a block is a row, so that one is read at a time
        ids, weights, sizes, codes, held = [], [], [], [], 0

        def block():
            cols = [pa.array([uuid.uuid4().hex]), pa.array([ids], pa.list_(id_type))]
            cols += [pa.array([np.array(x, "<i8").tobytes()], pa.binary()) for x in (weights, sizes)]
            return pa.RecordBatch.from_arrays([*cols, pa.array([np.concatenate(codes).tobytes()], pa.binary())], names=["name", "ids", "weights", "sizes", "codes"])

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, c, w in zip(*batch.columns):
                own = c.values.to_numpy().astype("<u4")
                if ids and held + len(own) > BLOCK_CODES:
                    yield block()
                    ids, weights, sizes, codes, held = [], [], [], [], 0
                ids.append(i.as_py())
                weights.append(w.as_py())
                sizes.append(len(own))
                codes.append(own)
                held += len(own)
        if ids:
            yield block()

    path = fresh_path(spark, "queries")
    in_arrow(asked.repartition(n_blocks), pack, f"name string, ids array<{id_kind}>, weights binary, sizes binary, codes binary").write.parquet(path)
    blocks = spark.read.parquet(path)
    out = fresh_path(spark, "aligned")
    spark.createDataFrame([], schema).write.parquet(out)
    own = recordings.select("id", "codes").where(F.size("codes") >= least_overlap)
    for name in [r["name"] for r in blocks.select("name").collect()]:  # one for each block
        row = blocks.where(F.col("name") == name).first()  # BLOCK_CODES integers, or one recording's
        shared = spark.sparkContext.broadcast((row["ids"], *(bytes(row[c]) for c in ("weights", "sizes", "codes"))))

        def search(batches, shared=shared):
            ids, weights, sizes, codes = shared.value
            block, weights = Block(np.frombuffer(sizes, "<i8"), np.frombuffer(codes, "<u4")), np.frombuffer(weights, "<i8")
            for batch in batches:
                for x in range(0, batch.num_rows, MEDIA_ROWS):
                    part = batch.slice(x, MEDIA_ROWS)
                    met = ((i.as_py(), ids, weights, block.matches(c.values.to_numpy().astype(np.uint32), max_error, least_overlap)) for i, c in zip(*part.columns))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows(met), types)], names=names)

        in_arrow(own, search, schema).write.mode("append").parquet(out)
        shared.unpersist()
    remove(spark, path)
    return spark.read.schema(schema).parquet(out)


@functools.lru_cache(4)
def tones(seconds: float) -> np.ndarray:
    """A tone of 36 pitches each, three octaves from the C below the staff."""
    t = np.arange(int(RATE * seconds)) / RATE
    envelope = np.minimum(1, np.minimum(t, t[::-1]) * 50)
    f = 130.81 * 2 ** (np.arange(36)[:, None] / 12)
    return envelope * (0.5 * np.sin(2 * np.pi * f * t) + 0.2 * np.sin(4 * np.pi * f * t))


def render(vector: list[float] | None, notes: int | None = None, seconds: float = 0.2) -> bytes | None:
    """A melody from a vector, as WAV: a note for each value, sign included. The test tables hold no media."""
    if not vector:
        return None
    v = np.resize(np.nan_to_num(np.asarray(vector, np.float64)), notes or len(vector))
    pitch = np.floor(v * 97).astype(int) % 36  # v and -v never have one pitch class
    return encode_wav(tones(seconds)[pitch].ravel())


def rendered(vector: list[float] | None) -> np.ndarray:
    """Samples of the recording of a vector, through its WAV."""
    return decode_wav(render(vector))
