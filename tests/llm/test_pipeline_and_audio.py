"""The pipeline against plain versions of its stages, and alignment of planted recordings."""

import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from lemmata.llm import audio, secrets, toxicity  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from .test_operators import plain_components, plain_contamination, words_doc  # noqa: E402


def test_pipeline(spark, tmp_path):
    rng = random.Random(8)
    texts = [words_doc(rng, 40, 3000) + (" vileword" if i % 4 == 0 else "") for i in range(400)]
    texts[9] = texts[7] + " tail"
    items = [(k, words_doc(rng, 12, 9999)) for k in range(3)]
    texts[13] += " " + items[0][1] + " " + items[1][1]
    texts[17] += ' token = "0123456789abcdef0123"'
    docs = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(400, None, "en", "s", 0), (401, "", "en", "s", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    table, labels = spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")
    left = {r["doc_id"] for r in toxicity.score_toxicity(table, labels).collect() if not r["predicted"]}
    ids = sorted(left)
    text = {i: t for i, t, *_ in docs}
    comp = plain_components([text[i] for i in ids])
    left = [i for k, i in enumerate(ids) if comp[k][1] == k]
    dirty = plain_contamination([text[i] for i in left], items)
    left = [i for i, d in zip(left, dirty) if not d[4]]
    assert sorted(got) == left and 9 not in got and 13 not in got and 17 in got
    assert got[17]["n_tokens"] > 0 and len(got[17]["ids"]) == got[17]["n_tokens"]
    assert "[secret]" in secrets.mask(text[17])


def test_alignment_of_a_cut(spark):
    rng = np.random.default_rng(3)
    waves = [audio.decode_wav(audio.render(rng.normal(size=64).tolist(), 60)) for _ in range(4)]
    cut = waves[2][10 * audio.HOP :] + rng.normal(scale=0.002, size=len(waves[2]) - 10 * audio.HOP)
    rows = [(i, audio.encode_wav(w)) for i, w in enumerate(waves)] + [(9, audio.encode_wav(cut)), (10, None), (11, b""), (12, b"junk")]
    codes = audio.fingerprints(spark.createDataFrame(rows, "rec long, wav binary"), "rec", "wav")
    assert {r["id"]: len(r["codes"]) for r in codes.collect()}[10] == 0
    found = {(r["query"], r["id"]): r for r in audio.align(codes.where(F.col("id") == 9), codes).collect()}
    assert (9, 2) in found and found[9, 2]["offset"] == 10 and found[9, 2]["bit_error"] < 0.1
    assert all(k[1] in (2, 9) for k in found)
    pairs = audio.align(codes.where("id < 3"), codes).collect()
    folded = {r["id"]: r for r in audio.answers(codes.where("id < 3").withColumn("weight", F.col("id") + 1), codes).collect()}
    assert set(folded) == {r["id"] for r in pairs}
    for i, r in folded.items():
        own = [p for p in pairs if p["id"] == i]
        assert r["n_matches"] == sum(p["query"] + 1 for p in own)
        assert (r["bit_error"], r["query"], r["offset"]) == min((p["bit_error"], p["query"], p["offset"]) for p in own)


def test_audio_of_empty_and_odd_tables(spark):
    table = spark.createDataFrame([], "rec long, wav binary, id string")
    codes = audio.fingerprints(table, "rec", "wav")
    assert codes.count() == 0 and audio.align(codes, codes).count() == 0
    wav = audio.encode_wav(audio.tones(0.2)[:30].ravel())
    odd = audio.fingerprints(spark.createDataFrame([(1, wav, "x"), (1, wav, "y"), (None, wav, "z")], table.schema), "rec", "wav")
    assert sorted((r["id"] or 9, len(r["codes"])) for r in odd.collect()) == [(1, 46), (1, 46), (9, 46)]
    assert all(r["bit_error"] == 0 and r["offset"] == 0 for r in audio.align(odd, odd).collect()) and audio.align(odd, odd).count() == 9


def plain_codes(image):
    """Filters as plain sums over the image."""
    out = []
    for t in range(len(image) - audio.SPAN + 1):
        code = 0
        for kind, p, h, w in audio.FILTERS:
            area = lambda t0, t1, p0, p1: image[t + t0 : t + t1, p0:p1].sum()
            whole = area(0, w, p, p + h)
            plus = [
                lambda: whole, lambda: area(0, w, p + h // 2, p + h), lambda: area(w // 2, w, p, p + h),
                lambda: area(0, w // 2, p, p + h // 2) + area(w // 2, w, p + h // 2, p + h),
                lambda: 2 * area(0, w, p + h // 3, p + 2 * h // 3), lambda: 2 * area(w // 3, 2 * w // 3, p, p + h),
            ][kind]()
            minus = area(0, w, 0, 12) * h / 12 if kind == 0 else whole - plus if kind < 4 else whole - plus / 2
            level = sum(np.log1p(max(plus, 0)) - np.log1p(max(minus, 0)) >= q for q in audio.QUANTILES)
            code = code << 2 | int(level) ^ int(level) >> 1
        out.append(code)
    return out


def test_recall_against_brute_force(spark):
    """Cuts of recordings as long as the registered query's, their bits wrong at random."""
    rng = np.random.default_rng(5)
    recordings = [audio.fingerprint(audio.decode_wav(audio.render(rng.normal(scale=0.2, size=64).tolist()))) for _ in range(30)]
    asked = []
    for error in (0.05, 0.1, 0.15, 0.2, 0.25):
        for k in range(30):
            cut = recordings[k][rng.integers(0, 20) :]
            wrong = rng.random((len(cut), 32)) < error
            asked.append(cut ^ (wrong << np.arange(32)).sum(axis=1).astype(np.uint32))
    want = {}
    for q, a in enumerate(asked):
        for r, b in enumerate(recordings):
            errors = []
            for offset in range(12 - len(a), len(b) - 11):
                x, y = a[max(0, -offset) :], b[max(0, offset) :]
                n = min(len(x), len(y))
                errors.append(int(np.bitwise_count(x[:n] ^ y[:n]).sum()) / (32 * n))
            if min(errors) <= 0.25:
                want[q, r] = min(errors)
    frame = lambda codes: spark.createDataFrame([(k, c.tolist()) for k, c in enumerate(codes)], "id long, codes array<bigint>")
    got = {(r["query"], r["id"]): r["bit_error"] for r in audio.align(frame(asked), frame(recordings)).collect()}
    found = [k for k in want if k in got]
    print(f"recall {len(found)} of {len(want)}, at the least error {sum(got[k] == want[k] for k in found)}")
    assert len(want) > 120 and set(got) <= set(want) and len(found) >= 0.9 * len(want)


def plain_matches(asked, codes, max_error, least_overlap):
    """The best of all offsets at which either half of two integers agrees."""
    out = {}
    for q, a in enumerate(asked):
        best = []
        for offset in range(1 - len(a), len(codes)):
            x, y = a[max(0, -offset) :], codes[max(0, offset) :]
            wrong = x[: min(len(x), len(y))] ^ y[: min(len(x), len(y))]
            error = int(np.bitwise_count(wrong).sum()) / (32.0 * len(wrong))
            if len(wrong) >= least_overlap and error <= max_error and ((wrong & 0xFFFF == 0) | (wrong >> 16 == 0)).any():
                best.append((error, abs(offset), offset, len(wrong)))
        if best:
            error, _, offset, overlap = min(best)
            out[q] = (offset, overlap, error)
    return out


def test_alignments_are_let_go_early_and_none_is_lost(monkeypatch):
    rng = np.random.default_rng(9)
    source = rng.integers(0, 1 << 32, 400, dtype=np.uint32)
    asked = []
    for size in (1, 2, 15, 16, 17, 31, 32, 33, 90, 150):
        cut = source[int(rng.integers(0, 200)) :][:size]
        asked.append(cut ^ (1 << rng.integers(0, 16, size)).astype(np.uint32))
        asked.append(np.repeat(rng.integers(0, 1 << 32, 10, dtype=np.uint32), -(-size // 10))[:size])  # runs
    same = (rng.integers(0, 1 << 16, 300) << 16 | 7).astype(np.uint32)  # every offset gets a vote
    asked += [same[50:170], same[::2]]
    block = audio.Block(np.array([len(a) for a in asked]), np.concatenate(asked))
    counted = []
    count = np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: counted.append(x.nbytes) or count(x))
    for codes in (source, same, source[:1], source[3:20]):
        for max_error, least in ((0.25, 12), (0.25, 1), (0.1, 5), (0.0, 1), (1.0, 1)):
            q, offset, overlap, error = block.matches(codes, max_error, least)
            got = dict(zip(q.tolist(), zip(offset.tolist(), overlap.tolist(), error.tolist())))
            assert got == plain_matches(asked, codes, max_error, least)
    counted.clear()
    block.matches(same, 0.1, 12)
    voted, offset = block.voted(same)
    first = np.maximum(0, -offset)
    overlap = np.minimum(block.sizes[voted] - first, len(same) - offset - first)
    assert sum(counted) < 0.6 * 4 * int(overlap[overlap >= 12].sum())


def test_every_value_and_sign_reaches_the_fingerprint():
    rng = np.random.default_rng(4)
    v = rng.normal(scale=0.2, size=64)
    own = audio.fingerprint(audio.decode_wav(audio.render(v.tolist())))
    for k in range(64):
        turned = v.copy()
        turned[k] = -v[k]
        other = audio.fingerprint(audio.decode_wav(audio.render(turned.tolist())))
        assert len(other) == len(own) and (other != own).any(), k


def test_integral_image_gives_plain_sums():
    x = audio.decode_wav(audio.render(np.linspace(-1, 1, 64).tolist()))
    image = audio.chroma(x)
    assert image.shape[1] == 12 and np.allclose(np.linalg.norm(image, axis=1), 1)
    got, want = audio.fingerprint(x).tolist(), plain_codes(image)
    assert len(got) == len(image) - audio.SPAN + 1
    # sums in another order may stand on the other side of a threshold
    assert sum(bin(a ^ b).count("1") for a, b in zip(got, want)) <= len(got) * 32 * 0.002
