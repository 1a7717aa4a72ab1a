"""Operator 4: a convolutional text classifier for toxicity.

Words are hashed (whole word, and its first four and five characters) into one
embedding table. Filters of widths 1, 2 and 3 run over the summed embeddings,
each is max-pooled over the whole text, and a logistic layer scores the pools.
It is trained here, in numpy, on a bounded sample of labelled rows; thresholds
are calibrated for each language, which is told from function words of the text
itself, and scores are rescaled so that a threshold stands at 0.7. Neither
labels nor lang, source or id columns enter a score.

Defined results: null and empty texts get the score of a text without words;
without labelled rows of both kinds every score is 0; repeated rows and ids each get
a row, null ids are carried and held out by no fold; an id with both labels counts as
toxic, and texts of one id are all learnt; equal scores of a threshold go together;
texts are read whole at any length; other columns are carried by ``drop_toxic`` alone;
an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Memo, in_arrow, map_texts, settle, text_slices

WORD_BITS, SHORT_BITS, LONG_BITS = 17, 13, 14
OFFSETS = (1, 1 + (1 << WORD_BITS), 1 + (1 << WORD_BITS) + (1 << SHORT_BITS))
ROWS = OFFSETS[2] + (1 << LONG_BITS)
WIDTHS, FILTERS, DIM = (1, 2, 3), 8, 8
#: (width, tap) -> first column among the projected columns.
COLUMNS = {wt: k * FILTERS for k, wt in enumerate((w, t) for w in WIDTHS for t in range(w))}
N_COLUMNS = FILTERS * len(COLUMNS)
PREDICT_AT = 0.7
#: Bounds of the training sample: rows of label 0 and of label 1, and bytes of encoded words of each.
PER_CLASS, CLASS_BYTES = (5_000, 3_000), 40_000_000
#: Parts that the sample is cut into to calibrate thresholds.
FOLDS = 3

#: Function words that tell a language: fixed lists.
LANGUAGES = {
    "en": "the of and to in is that it for with was are this be not from at by on or which they have".split(),
    "fr": "le la les de des du et est une un pour dans que qui sur pas avec par au plus ce ne".split(),
    "de": "der die das und ist ein eine nicht mit den von zu sich auf für dem des auch als es im".split(),
    "es": "el los las y del que en una un por con para no su al lo como más pero sus o se".split(),
}
CODES = ("", *LANGUAGES)
_VOTES = {}
for _i, _lang in enumerate(LANGUAGES):
    for _w in LANGUAGES[_lang]:
        _VOTES[_w] = 0 if _w in _VOTES else _i + 1
NOT_WORD = re.compile(r"[\W_]+")


def pack(chunk: str) -> int:
    """The three table rows of a chunk and its language vote, in one integer; 0 if it has no letter or digit."""
    word = NOT_WORD.sub("", chunk.lower())
    if not word:
        return 0
    raw = word.encode()
    rows = (
        OFFSETS[0] + (zlib.crc32(raw) & ((1 << WORD_BITS) - 1)),
        OFFSETS[1] + (zlib.crc32(b"4" + word[:4].encode()) & ((1 << SHORT_BITS) - 1)),
        OFFSETS[2] + (zlib.crc32(b"5" + word[:5].encode()) & ((1 << LONG_BITS) - 1)),
    )
    return rows[0] | rows[1] << 20 | rows[2] << 40 | _VOTES.get(word, 0) << 60


_memo = Memo(lambda chunks: list(map(pack, chunks)), 200_000)


def encode(texts: list[str]) -> list[np.ndarray]:
    pieces = [t.split() for t in texts]
    table = _memo.table(set().union(*pieces))
    return [np.fromiter(map(table.__getitem__, p), np.int64, len(p)) for p in pieces]


def unpack(packed: np.ndarray) -> np.ndarray:
    mask = (1 << 20) - 1
    return np.stack([packed & mask, packed >> 20 & mask, packed >> 40 & mask], axis=1)


def language(packed: np.ndarray) -> int:
    """Index in CODES of the language with most votes; 0 where none has any."""
    votes = np.bincount(packed >> 60, minlength=len(CODES))[: len(CODES)]
    votes[0] = 0
    return int(votes.argmax()) if votes.any() else 0


def laid_out(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of all texts, each with two empty rows behind it; starts; and which rows a window may start at."""
    sizes = np.array([max(1, len(d)) for d in docs])
    starts = np.concatenate([[0], np.cumsum(sizes + 2)])
    packed = np.zeros(starts[-1], np.int64)
    may = np.zeros(starts[-1], bool)
    for d, a, n in zip(docs, starts.tolist(), sizes.tolist()):
        packed[a : a + len(d)] = d
        may[a : a + n] = True
    return unpack(packed), starts, may


@dataclass
class Model:
    table: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    top: np.ndarray
    top_bias: float
    thresholds: dict[int, float] = field(default_factory=dict)
    projected: np.ndarray | None = None

    def responses(self, rows: np.ndarray, may: np.ndarray, projected: np.ndarray) -> np.ndarray:
        taps = projected[rows[:, 0]]
        taps += projected[rows[:, 1]]
        taps += projected[rows[:, 2]]
        out = np.empty((len(rows), FILTERS * len(WIDTHS)), np.float32)
        for k, w in enumerate(WIDTHS):
            part = taps[:, COLUMNS[w, 0] : COLUMNS[w, 0] + FILTERS].copy()
            for t in range(1, w):
                part[:-t] += taps[t:, COLUMNS[w, t] : COLUMNS[w, t] + FILTERS]
            out[:, k * FILTERS : (k + 1) * FILTERS] = part
        out[~may] = -1e9
        return out

    def raw(self, docs: list[np.ndarray]) -> np.ndarray:
        if self.projected is None:
            self.projected = (self.table @ self.kernel).astype(np.float32)
        out = []
        at = 0
        while at < len(docs):
            end, total = at, 0
            while end < len(docs) and (end == at or total + len(docs[end]) < 60_000):
                total += len(docs[end])
                end += 1
            rows, starts, may = laid_out(docs[at:end])
            pooled = np.maximum.reduceat(self.responses(rows, may, self.projected), starts[:-1], axis=0)
            hidden = np.maximum(pooled + self.bias, 0)
            out.append(1 / (1 + np.exp(-(hidden @ self.top + self.top_bias).astype(np.float64))))
            at = end
        return np.concatenate(out) if out else np.zeros(0)

    def scores(self, docs: list[np.ndarray]) -> np.ndarray:
        raw = self.raw(docs)
        cut = np.array([self.thresholds.get(language(d), self.thresholds.get(0, 0.5)) for d in docs]) if docs else raw
        low = PREDICT_AT * raw / cut
        high = PREDICT_AT + (1 - PREDICT_AT) * (raw - cut) / np.maximum(1 - cut, 1e-9)
        return np.clip(np.where(raw >= cut, np.maximum(high, PREDICT_AT), np.minimum(low, np.nextafter(PREDICT_AT, 0))), 0, 1)


def train(docs: list[np.ndarray], y: np.ndarray, epochs: int | None = None, rate: float = 0.15, batch: int = 32, seed: int = 7) -> Model:
    """Adagrad over batches; without ``epochs``, as many (4 to 16) as see 32,000 rows."""
    epochs = epochs or int(np.clip(32_000 // max(1, len(docs)), 4, 16))
    rng = np.random.default_rng(seed)
    m = Model(
        (rng.standard_normal((ROWS, DIM)) * 0.05).astype(np.float32),
        (rng.standard_normal((DIM, N_COLUMNS)) * 0.5).astype(np.float32),
        np.zeros(FILTERS * len(WIDTHS), np.float32),
        (rng.standard_normal(FILTERS * len(WIDTHS)) * 0.3).astype(np.float32),
        0.0,
    )
    m.table[0] = 0
    squares = {k: np.full(getattr(m, k).shape, 1e-3, np.float32) for k in ("table", "kernel", "bias", "top")}
    seen_bias = 1e-3

    def step(name, grad):
        squares[name] += grad * grad
        getattr(m, name)[...] -= rate * grad / np.sqrt(squares[name])

    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            rows, starts, may = laid_out([docs[i] for i in part])
            used, where = np.unique(rows, return_inverse=True)
            where = where.reshape(rows.shape)
            embedded = m.table[used]
            found = m.responses(where, may, embedded @ m.kernel)
            best = np.stack([a + found[a:b].argmax(axis=0) for a, b in zip(starts, starts[1:])])
            pooled = np.take_along_axis(found, best, axis=0) + m.bias
            hidden = np.maximum(pooled, 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ m.top + m.top_bias, -30, 30)))
            error = ((p - y[part]) / len(part)).astype(np.float32)
            back = error[:, None] * m.top * (pooled > 0)
            table_grad, kernel_grad = np.zeros_like(embedded), np.zeros_like(m.kernel.T)
            for k, w in enumerate(WIDTHS):
                g = back[:, k * FILTERS : (k + 1) * FILTERS].ravel()
                spot = best[:, k * FILTERS : (k + 1) * FILTERS].ravel()
                for t in range(w):
                    col = np.tile(np.arange(COLUMNS[w, t], COLUMNS[w, t] + FILTERS), len(part))
                    three = where[spot + t]
                    np.add.at(kernel_grad, col, g[:, None] * embedded[three].sum(axis=1))
                    np.add.at(table_grad, three.ravel(), np.repeat(g[:, None] * m.kernel.T[col], 3, axis=0))
            step("top", hidden.T @ error)
            step("bias", back.sum(axis=0))
            seen_bias += float(error.sum()) ** 2
            m.top_bias -= rate * float(error.sum()) / seen_bias**0.5
            step("kernel", kernel_grad.T)
            squares["table"][used] += table_grad * table_grad
            m.table[used] -= rate * table_grad / np.sqrt(squares["table"][used])
            m.table[0] = 0
    return m


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Middle of the widest gap beside the cut of highest F1."""
    order = np.argsort(-p, kind="stable")
    p, y, weight = p[order], y[order], weight[order]
    hit, total = np.cumsum(weight * y), np.cumsum(weight)
    f1 = 2 * hit / (total + (weight * y).sum())
    k = int(f1.argmax())
    below = p[k + 1] if k + 1 < len(p) else 0.0
    return float(np.clip((p[k] + below) / 2, 0.02, 0.98))


def fit(docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, least: int = 25) -> Model:
    """Train on all; calibrate a threshold for each language on scores of models that didn't see the text.

    The models of the folds see a third as many rows in all as the last one, so that
    calibration costs as much as training.
    """
    fold = np.arange(len(docs)) % FOLDS
    p = np.zeros(len(docs))
    rows = int(np.clip(32_000 // max(1, len(docs)), 4, 16))
    for k in range(FOLDS):
        own = fold == k
        if own.any() and len(set(y[~own].tolist())) == 2:
            m = train([d for d, o in zip(docs, own) if not o], y[~own], max(2, rows * 2 // 3))
            p[own] = m.raw([d for d, o in zip(docs, own) if o])
    m = train(docs, y, rows)
    langs = np.array([language(d) for d in docs])
    m.thresholds[0] = best_threshold(p, y, weight)
    for code in range(1, len(CODES)):
        own = langs == code
        if y[own].sum() >= least and (1 - y[own]).sum() >= least:
            m.thresholds[code] = best_threshold(p[own], y[own], weight[own])
    m.projected = None
    return m


def training_sample(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int]) -> tuple[list, np.ndarray, np.ndarray]:
    """Encoded texts, labels and weights of at most ``per_class`` (label 0, label 1) rows, picked by hash of the id.

    Of each class no more come to the driver than fill CLASS_BYTES, and one text. Rows whose crc32(id) mod 3 is 1 never enter. The weights restore the share of
    each class among all labelled rows.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    ).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    picked = None
    for label, limit in enumerate(per_class):
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
        picked = part if picked is None else picked.unionByName(part)
    # per_class bounds the rows, so this side is small at every size of the input
    chosen = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def run(texts):
        return {"packed": pa.array([d.tobytes() for d in encode(texts)], pa.binary())}

    coded = map_texts(chosen, run, "packed binary", ("doc_id", "toxic"))
    before = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    held = F.coalesce(F.sum(F.octet_length("packed")).over(before), F.lit(0))  # over the sample, whose rows are bounded
    rows = coded.withColumn("held", held).where(F.col("held") < CLASS_BYTES).drop("held").toArrow()
    order = np.argsort([zlib.crc32(str(i).encode()) for i in rows["doc_id"].to_pylist()], kind="stable")
    packed = rows["packed"].to_pylist()
    y = np.array(rows["toxic"].to_pylist(), np.float32)[order]
    have = {k: max(1, int((y == k).sum())) for k in (0, 1)}
    weight = np.array([counts.get(int(k), 0) / have[int(k)] for k in y])
    return [np.frombuffer(packed[i], np.int64) for i in order], y, weight


def toxicity_model(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS) -> Model | None:
    """``per_class`` bounds the training sample (rows of label 0, of label 1)."""
    sample, y, weight = training_sample(docs, labels, per_class)
    model = fit(sample, y, weight) if len(set(y.tolist())) == 2 else None
    sample.clear()
    settle(docs.sparkSession)
    return model


def score_toxicity(
    docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: id, held_out, score and predicted."""
    model = docs.sparkSession.sparkContext.broadcast(toxicity_model(docs, labels, per_class))

    def run(texts):
        m = model.value
        if m is None:
            return {"score": pa.array([0.0] * len(texts), pa.float64())}
        return {"score": pa.array(m.scores(encode(texts)), pa.float64())}

    scored = map_texts(docs, run, "score double", (id_col,), text_col)
    return scored.select(
        id_col,
        (F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3, F.lit(0)) == 1).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that the classifier doesn't reject."""
    model = docs.sparkSession.sparkContext.broadcast(toxicity_model(docs, labels, per_class))
    at = docs.columns.index("text")

    def run(batches):
        m = model.value
        for batch in batches:
            for a, b, texts in text_slices(batch.column(at)):
                part = batch.slice(a, b - a)
                yield part if m is None else part.filter(pa.array(m.scores(encode(texts)) < PREDICT_AT))

    return in_arrow(docs, run, docs.schema)
