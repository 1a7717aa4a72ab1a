"""Each operator against a plain version, on odd and small inputs."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from lemmata.llm import bpe, decontaminate, html, huffman, jaccard, secrets, suffix_dedup, tokens, toxicity  # noqa: E402

ODD = [
    None, "", " ", "\n\n\nBar", "a  b", "foo \nbar", "don't 'S 'LL 12345 it's", "ΑΣ ΟΔΟΣ Σ", "İstanbul ﬁ é ½²x",
    "a<|endoftext|>b <|startoftext|>", "x\x1cy\x1f z\x85w", "=" * 500, "ab" * 400, "日本語 １２", "🙂👍🏽 ok_ok", "a\x00b \x00c\x00", "same text", "same text",
]


def words_doc(rng, n, vocab=60):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def frame(spark, texts, **extra):
    """A documents table with columns whose names clash with the operators' own."""
    rows = [(i, t, None, "s", len(t or ""), 1, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens int, id string")


def rows(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def word_tok():
    return tokens.load(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe(spark, word_tok):
    got = rows(bpe.bpe_digests(frame(spark, ODD), public_tokenizers.path("word_bpe_49k.json")))
    for i, t in enumerate(ODD):
        e = word_tok.encode(t or "", add_special_tokens=False)
        assert got[i]["n_tokens"] == len(e.ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, e.ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(word_tok.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.bpe_digests(frame(spark, []), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_merges_side_by_side():
    b = bpe.coder(public_tokenizers.path("word_bpe_49k.json")).bpe
    rng = random.Random(3)
    words = ["".join(rng.choice("abehinortuéß") for _ in range(rng.randrange(1, 90))) for _ in range(300)]
    assert b.many(words) == [b.word(w) for w in words]


def test_token_counts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = tokens.load(path)
    got = rows(tokens.count_tokens(frame(spark, ODD), path))
    for i, t in enumerate(ODD):
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((t or "").encode()), n > 512)


def test_token_counts_of_long_and_repeated_pieces(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = tokens.load(path)
    rng = random.Random(22)
    texts = ["".join(rng.choice("abé9,$日 \n") for _ in range(rng.randrange(1, 400))) for _ in range(200)]
    texts += ["x" * 63, "x" * 64, "x" * 65, "ab,9" * 5000, "a " * 300 + "q" * 70 + "\n" * 90 + "end", "wort", "wort"]
    got = rows(tokens.count_tokens(frame(spark, texts), path))
    want = [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert [got[i]["n_tokens"] for i in range(len(texts))] == want


def test_length_table_settles_collisions(monkeypatch):
    rng = random.Random(21)
    keys = list({"".join(rng.choice("abcdé ") for _ in range(rng.randrange(1, 9))) for _ in range(900)})
    real = tokens.xxhash.xxh3_64_intdigest
    for digest in (real, lambda b: real(b) % 5):
        monkeypatch.setattr(tokens.xxhash, "xxh3_64_intdigest", digest)
        table = tokens.LengthTable(keys[:500], [1 + k % 200 for k in range(500)])
        want = {k: 1 + i % 200 for i, k in enumerate(keys[:500])}
        assert table.find([k.encode() for k in keys]) == [want.get(k, 0) for k in keys]


def test_token_files(spark, word_tok):
    docs = frame(spark, ODD + ["long " * 3000])
    got = rows(huffman.token_files(docs, public_tokenizers.path("word_bpe_49k.json")))
    at = 0
    for i, t in enumerate(ODD + ["long " * 3000]):
        ids = np.array(word_tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert huffman.token_files(frame(spark, []), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_marks_join_a_pre_token_of_marks(word_tok):
    coder = huffman.LibraryCoder(public_tokenizers.path("word_bpe_49k.json"), 1)
    for text in ("what? (foo) wait.. \"foo\" \u0130 x\u00b2 \ufb1d", "what?! (foo), wait... \"foo\". \u0130! x\u00b2, \ufb1d. foo, foo?"):  # the second call has marks behind what the first one kept
        got = np.frombuffer(coder.encode([text])[0], coder.kind).tolist()
        assert got == word_tok.encode(text, add_special_tokens=False).ids + [1]


def test_ids_of_odd_pieces_are_the_library_s(word_tok):
    """Words, marks, specials and white space of many kinds, in texts that share pieces and with a small memo."""
    rng = random.Random(11)
    parts = ["word", "Word", "stra\u00dfe", "\u00c9t\u00e9", "\u0130", "e\u0301", "\ufb1d", "\u03a3\u03a3", "x\u00b2", "\u00aa", "\u00b5", "7", "42", "\u4e2d\u6587", "it's", "y" * 70, "\0", "\u0338"]
    parts += [",", "?!", "$$$", "'", "'s", "(", ")", "<", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "\u2026", "\u0301"]
    parts += [" ", "  ", "\n", "\t", "\x1c", "\x85", "\u00a0", "\u2028", " ", " "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(1500)]
    coder = huffman.LibraryCoder(public_tokenizers.path("word_bpe_49k.json"), 1)
    coder.memo.limit = 900
    for at in range(0, len(texts), 100):
        for t, got in zip(texts[at : at + 100], coder.encode(texts[at : at + 100])):
            assert np.frombuffer(got, coder.kind).tolist() == word_tok.encode(t, add_special_tokens=False).ids + [1], t


def test_marks_cost_no_call_for_each_word(word_tok):
    """A run of marks behind a word is encoded once, not with every word, and a word by the lean tokenizers."""
    coder = huffman.LibraryCoder(public_tokenizers.path("word_bpe_49k.json"), 1)
    calls, whole = [], coder._whole
    coder._whole = lambda chunks: calls.extend(chunks) or whole(chunks)
    names = ["".join(random.Random(k).choices("abcdefgh\u00e9", k=9)) for k in range(300)]
    text = " ".join(n + m for n in names for m in ("", "$$$", "?!", ".%%%"))
    assert np.frombuffer(coder.encode([text])[0], coder.kind).tolist() == word_tok.encode(text, add_special_tokens=False).ids + [1]
    assert sorted(calls) == ["$$$", ".%%%", "?!"]


def test_code_lengths_are_limited_and_complete():
    counts = np.array([2**k for k in range(30)] + [0, 5])
    lengths = huffman.code_lengths(counts, 8)
    assert lengths.max() <= 8 and lengths[30] == 0
    assert sum(2.0 ** -int(x) for x in lengths if x) == 1.0
    assert huffman.code_lengths(np.array([0, 7]))[1] == 1


def test_secrets(spark):
    texts = ["", None, 'Password: "abcDEF123456" x', "AKIA" + "A" * 20, "k = deadbeefdeadbeef00", "token=short", "see q9Zk2LmX0vB7nR4tY8wP1sD6 end", "TOKEN = " + "ab" * 20]
    got = rows(secrets.scan_secrets(frame(spark, texts)))
    assert got[0]["spans"] == got[1]["spans"] == ""
    assert got[2]["spans"] == "assign:0:23"
    assert (got[3]["n_access"], got[3]["n_hex"]) == (1, 0)
    assert got[4]["spans"].startswith("hex:4:22")
    assert got[5]["n_assign"] == 0
    assert "entropy:4:28" in got[6]["spans"]
    assert (got[7]["n_assign"], got[7]["n_hex"]) == (1, 1)
    assert "[secret]" in secrets.mask(texts[6]) and "q9Zk" not in secrets.mask(texts[6])


def test_secrets_of_letters_or_digits_and_whole_keys():
    key = "qZkXmLvBtRnYwPsDhGjFcKqVxNzTbW"
    for secret in (key, key + "7", "kQzXvBnMwRtYpLsDgHjF", "83019462750183926475", "aaaaaaaaaaaa" + key):
        text = f"see {secret} end"
        assert f"entropy:4:{4 + len(secret)}" in secrets.show(secrets.all_spans(text)[1])
        assert secrets.mask(text) == "see [secret] end"
    for clean in ("internationalOrganisationForStandards", "a-well-known-and-very-long-slug", "SOME_CONSTANT_NAME_OF_CAPITALS", "path/to/MyClassName/anotherPartOfIt", "2024-01-01/2024-12-31"):
        assert secrets.all_spans(f"see {clean} end")[1] == []
    assert secrets.all_spans("see example_key_xxxxxxxx_1234 end")[1] == [] and secrets.all_spans(f"see sample{key}7 end")[1]
    for kind, limit in secrets.LIMITS.items():
        assert limit < np.log2(10 if kind == "digits" else secrets.WINDOW), kind


def test_entropy_counts_match_a_fresh_sum():
    import math

    rng = random.Random(5)
    run = "".join(rng.choice("abcdef0123456789XYZ/+") for _ in range(120))
    want = set()
    for i in range(len(run) - secrets.WINDOW + 1):
        w = run[i : i + secrets.WINDOW]
        e = -sum(w.count(c) / len(w) * math.log2(w.count(c) / len(w)) for c in set(w))
        digit, alpha = sum(c.isdigit() for c in w), sum(c.isalpha() for c in w)
        hexa = sum(c in "0123456789abcdefABCDEF" for c in w)
        if e >= secrets.LIMITS[secrets.classify(digit, hexa, alpha, len(w) - digit - alpha)] - 1e-12:
            want |= set(range(i, i + secrets.WINDOW))
    assert {k for a, b in secrets.entropy_spans(run) for k in range(a, b)} == want


def test_main_text(spark):
    page = (
        "<html><head><title>T</title></head><body><nav><a href=x>Menu</a></nav><div class='ad'>Buy</div><article><h1>Head&amp;line</h1>"
        "<p>One  two\nthree.<p>Ok.</p><aside>Side</aside><p>Last &eacute;</p></article><div id=comments><p>Nice</p></div><footer>F</footer></body></html>"
    )
    loose = "<body><header>Site</header><div><p>Long paragraph of text that goes on for a while.</p><p>Short.</p></div><form>Mail</form><footer>f</footer>"
    table = spark.createDataFrame([(1, "u", page, 5), (2, None, None, 5), (3, "u", "", 5), (4, "u", loose, 5), (5, "u", "<p>cut &am", 5)], "page_id long, url string, html string, text int")
    got = rows(html.extract_main_text(table), "page_id")
    assert got[1]["text"] == "Head&line\nOne two three.\nOk.\nLast é"
    assert got[2]["text"] == got[3]["text"] == ""
    assert got[4]["text"] == "Long paragraph of text that goes on for a while.\nShort."
    assert got[5]["n_chars"] == len(got[5]["text"]) > 0


def test_main_text_of_an_unmarked_article_in_pieces():
    body = "".join(f"<p>Paragraph {k} {'of the body ' * 40}</p>" for k in range(10))
    ad, form = "<div class='ad'>Buy</div>", "<form class=newsletter>Mail</form>"
    links = "<p><a href=a>A source of the article</a></p>"
    site, tail = "<div class=blurb><p>About us</p></div><nav>Menu</nav>", "<footer>F</footer><div class=blurb><p>Made by us</p></div>"
    pieces = [f"<h1>Title</h1><p>Intro {'x ' * 100}</p>", ad, body, links, ad, "<p>Short middle.</p>", ad, body, form, f"<p>Short end.</p>{links}"]
    want = [html.lines_of(p)[0].texts for p in pieces if p not in (ad, form)]
    want = [t for lines in want for t in lines if t]
    inner = "".join(pieces)
    assert html.main_text(f"<body>{site}<div class=text>{inner}</div>{tail}").split("\n") == want
    split = "".join(p if p in (ad, form) else f"<div class=part>{p}</div>" for p in pieces)
    assert html.main_text(f"<body>{site}<div id=w>{split}</div>{tail}").split("\n") == want
    bare = html.main_text(f"<body><ul><li><a href=h>Home</a></li></ul><nav>Menu</nav>{inner}").split("\n")
    assert bare == want[:-1]  # links before or behind the article are no part of it where nothing holds it together


def test_no_page_is_lost_to_its_markup():
    text = "A paragraph of real text that is long enough to be one of an article, and goes on."
    for page in (
        f"<html><head><title>T</title><body><article><p>{text}</p></article>",
        f'<script>var a="<!-- x";</script><article><p>{text}</p></article>',
        f"<!-- <script> --><article><p>{text}</p></article>",
        f'<div class="layout has-sidebar"><article><p>{text}</p></article><div class=sidebar>Side</div></div>',
        f'<div class="sidebar-right"><nav>Menu</nav><article><p>{text}</p></article><div class=sidebar>Side</div></div>',
        f'<p class="ad">Buy<p>{text}',
        f'<ul><li class="share">x<li>{text}</ul>',
        f"<svg><p>{text}</p>",
        f"<div>Home</div><div>About</div><div>Contact</div><p>{text}</p>",
    ):
        assert html.main_text(page) == text, page
    assert html.main_text(f"<article><p>{text}<br>And <math><mi>x</mi></math> more</p></article>") == f"{text} And x more"
    assert html.main_text(f"<article><p>{text}</p></article><div id=comments><article class=comment><p>{text * 9}</p></article></div>") == text
    menu = "<div>Home</div><div>About</div><div>Contact</div>"
    assert html.main_text(f"<body>{menu}<p>{text}</p><p>Short.</p><p>{text}</p><p>{text}</p>").split("\n") == [text, "Short.", text, text]


def test_regions_are_windows_over_the_threshold():
    rng = random.Random(13)
    for _ in range(300):
        w = np.array([rng.choice([0, 0, 5, 40, 200]) for _ in range(rng.randrange(1, 30))])
        n = len(w)
        sums = [int(w[i : i + 3].sum()) for i in range(n)]
        level = max(1, min(80, max(sums) // 2))
        full = [x >= level for x in sums]
        held = [full[i] and (i + 1 == n or full[i + 1] or (i > 0 and full[i - 1])) for i in range(n)]
        held = held if any(held) else full
        lines = {j for i in range(n) if held[i] for j in range(i, min(n, i + 3)) if w[j]}
        got = html.regions(w)
        assert lines == {j for a, b in got for j in range(a, b) if w[j]} if w.any() else got == []
        assert all(w[a] and w[b - 1] for a, b in got) and all(x[1] < y[0] for x, y in zip(got, got[1:]))


def test_toxicity_learns_and_handles_odd_rows(spark):
    rng = random.Random(1)
    texts = [words_doc(rng, 40) + (" vileword" if i % 3 == 0 else "") for i in range(600)] + [None, ""]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = rows(toxicity.score_toxicity(frame(spark, texts), labels))
    assert len(got) == 602 and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [i for i, r in got.items() if r["held_out"] and i < 600]
    assert sum(got[i]["predicted"] == (i % 3 == 0) for i in held) >= 0.95 * len(held)
    none = toxicity.score_toxicity(frame(spark, ["a"]), spark.createDataFrame([], "doc_id long, toxic int")).first()
    assert none["score"] == 0.0


def plain_contamination(docs, items):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))
    windows = {}
    for k, t in items:
        w = words(t)
        for i in range(max(0, len(w) - 7) or min(1, len(w))):
            windows.setdefault(tuple(w[i : i + 8]), set()).add(str(k))
    out = []
    for t in docs:
        w, hit, found = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if (own := windows.get(tuple(w[i : i + size]))) is not None:
                    hit |= set(range(i, i + size))
                    found |= own
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(found) >= 2))
    return out


def test_contamination(spark):
    rng = random.Random(2)
    items = [(k, words_doc(rng, rng.choice([3, 8, 20]))) for k in range(12)] + [(50, "Lone"), (51, ""), (52, None), (53, "Lone")]
    docs = [words_doc(rng, 30) + " " + (items[i % 12][1] or "").upper() + "; " + items[(i + 1) % 12][1] for i in range(20)] + [None, "", "...", "a lone b"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(decontaminate.contamination(frame(spark, docs), bench))
    for i, want in enumerate(plain_contamination(docs, items)):
        assert tuple(got[i][c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == want
    empty = rows(decontaminate.contamination(frame(spark, ["a b"]), spark.createDataFrame([], "item_id long, text string")))
    assert empty[0]["n_hit"] == 0


def test_null_and_repeated_ids_in_contamination_and_files(spark, word_tok):
    items = spark.createDataFrame([(1, "p q r s t u v w"), (2, "a b c"), (None, "x y z")], "item_id long, text string")
    docs = spark.createDataFrame([(5, "a b c p q r s t u v w"), (5, "a b c"), (None, "x y z a b c"), (None, None), (2, "none")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 9, r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in decontaminate.contamination(docs, items).collect())
    assert got == [(2, 1, 0, 0, False), (5, 3, 3, 1, False), (5, 11, 11, 2, True), (9, 0, 0, 0, False), (9, 6, 6, 1, False)]
    assert sorted(r["doc_id"] or 9 for r in decontaminate.drop_contaminated(docs, items).collect()) == [2, 5, 9, 9]
    got = [(r["start"], r["doc_id"], r["n_tokens"]) for r in huffman.token_files(docs, public_tokenizers.path("word_bpe_49k.json")).collect()]
    place = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, hashlib.sha256((r["text"] or "").encode()).hexdigest())
    at, want = 0, []
    for r in sorted(docs.collect(), key=place):
        n = len(word_tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        want.append((at, r["doc_id"], n))
        at += n
    assert sorted(got, key=lambda x: x[0]) == want


def near_copies(rng):
    docs = []
    for _ in range(6):
        base = [f"v{rng.randrange(400)}" for _ in range(rng.randrange(20, 120))]
        for _ in range(rng.choice([1, 2, 15])):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
            docs.append(" ".join(w))
    shared = " ".join(f"s{k}" for k in range(55))
    docs += [f"{words_doc(rng, 30, 5000)} {shared} {words_doc(rng, 30, 5000)}" for _ in range(12)]
    return docs + docs[:3] + [None, "", "  ", "one two", "ONE  two", "a b c d e", "a b c d e"]


def plain_components(texts, n=5):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    own = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = own[i], own[j]
                own = [min(a, b) if x in (a, b) else x for x in own]
    return [(len(s), c) for s, c in zip(sets, own)]


@pytest.mark.parametrize("change", ["none", "lists of three", "shared signatures", "equal hashes"])
def test_jaccard_components(spark, monkeypatch, change):
    texts = near_copies(random.Random(4))
    if change == "lists of three":
        monkeypatch.setattr(jaccard, "LIST_PART", 3)
        monkeypatch.setattr(jaccard, "SHORT_LIST", 2)
    elif change == "shared signatures":
        whole = jaccard.digest
        monkeypatch.setattr(jaccard, "digest", lambda s: (whole(s)[0] % 7, whole(s)[1]))
    elif change == "equal hashes":  # of elements: only more candidates may come of them
        whole_sets = jaccard.shingle_sets
        monkeypatch.setattr(jaccard, "shingle_sets", lambda texts, n=5: [np.where(s % 9 == 0, s & np.uint64(~0xFFFFFFF000000000 & (2**64 - 1)), s) for s in whole_sets(texts, n)])
    got = rows(jaccard.jaccard_components(frame(spark, texts)))
    assert [(got[i]["n_shingles"], got[i]["component_id"]) for i in range(len(texts))] == plain_components(texts)


def test_words_settle_a_link():
    rng = random.Random(11)
    for _ in range(200):
        a = [f"w{rng.randrange(30)}" for _ in range(rng.randrange(5, 60))]
        b = list(a)
        for _ in range(rng.randrange(0, 3)):
            b[rng.randrange(len(b))] = "new"
        x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
        assert jaccard.linked(" ".join(a), " ".join(b), 5, (3, 4)) == (100 * len(x & y) >= 75 * len(x | y))


def test_null_and_repeated_ids_are_rows_of_their_own(spark):
    texts = ["one two three four five six", "seven eight nine ten eleven twelve", "one two three four five six", None, "one two three four five six"]
    docs = spark.createDataFrame(list(zip([4, 4, None, None, 2], texts, [1, 2, 3, 4, 5])), "doc_id long, text string, __id int")
    got = sorted((r["doc_id"] or 99, r["n_shingles"], r["component_id"] or 99, r["is_first"]) for r in jaccard.jaccard_components(docs).collect())
    assert got == [(2, 2, 2, True), (4, 2, 2, False), (4, 2, 4, True), (99, 0, 99, True), (99, 2, 2, False)]
    assert sorted(r["__id"] for r in jaccard.keep_first(docs).collect()) == [2, 4, 5]


def test_components_that_are_not_stable_raise(spark):
    from lemmata.llm.components import components

    with pytest.raises(RuntimeError, match="not stable"):
        components(spark.createDataFrame([(k, k + 1) for k in range(20)], "a long, b long"), max_rounds=1)


def test_bitmap_bound_never_rules_out_a_link():
    rng = np.random.default_rng(0)
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, rng.integers(4, 400), np.uint64)
        a, b = (np.unique(pool[rng.random(len(pool)) < 0.93]) for _ in "ab")
        o = len(np.intersect1d(a, b))
        if len(a) and len(b) and 7 * o >= 3 * (len(a) + len(b)):
            small, large = sorted((a, b), key=lambda s: len(jaccard.bitmap(s)))
            maps = [np.frombuffer(jaccard.bitmap(s), np.uint8)[None] for s in (small, large)]
            assert jaccard.may_link(maps[0], np.array([len(small)]), maps[1], np.array([len(large)]), (3, 4)).all()


def plain_repeats(texts, length=100):
    seen, out = set(), []
    for t in texts:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats(spark, monkeypatch):
    rng = random.Random(6)
    passage, other = words_doc(rng, 60, 9999), words_doc(rng, 40, 9999)
    texts = [words_doc(rng, 30, 9999) + passage + words_doc(rng, 20, 9999) + other[: rng.randrange(60, 200)] for _ in range(15)]
    texts += [texts[0], "a" * 300, "a" * 150 + "b" * 99, None, "", "ab" * 200, "x" * 99, "é" * 120, passage]
    for hot in (40_000, 3):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        got = rows(suffix_dedup.repeat_report(frame(spark, texts)))
        assert [tuple(got[i][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for i in range(len(texts))] == plain_repeats(texts)


def test_repeats_with_null_and_repeated_ids(spark):
    rng = random.Random(9)
    passage = words_doc(rng, 60, 9999)
    texts = [f"{c} {passage} {c * 3}" for c in "abcde"] + [None]
    ids = [3, None, 3, 1, None, None]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = sorted((r["doc_id"] or 9, r["n_bytes"], r["n_removed"]) for r in suffix_dedup.repeat_report(docs).collect())
    order = sorted(range(6), key=lambda i: (ids[i] is None, ids[i] or 0, hashlib.sha256((texts[i] or "").encode()).hexdigest()))
    want = [(ids[i] or 9, n, gone) for i, (n, gone, *_) in zip(order, plain_repeats([texts[i] for i in order]))]
    assert got == sorted(want)


def test_seeds_of_pieces(monkeypatch):
    rng = random.Random(7)
    raw = words_doc(rng, 3000, 50).encode()

    def found():
        out = set()
        for _, raws, shifts, _, ranges in suffix_dedup.parts([1], [raw], 100):
            text, pos, h = suffix_dedup.seeds(raws, 100, ranges)
            ctx = suffix_dedup.surroundings(raws, text, pos, 100)
            out |= set(zip((pos + shifts[text]).tolist(), h.tolist(), ctx[:, 0].tolist(), ctx[:, 1].tolist()))
        return out

    whole = found()
    monkeypatch.setattr(suffix_dedup, "PART", 1000)
    assert found() == whole


def test_empty_tables(spark):
    none = frame(spark, [])
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert secrets.scan_secrets(none).count() == 0 and secrets.mask_secrets(none).count() == 0
    assert jaccard.jaccard_components(none).count() == 0 and jaccard.keep_first(none).count() == 0
    assert suffix_dedup.repeat_report(none).count() == 0
    assert decontaminate.contamination(none, items).count() == 0 and decontaminate.drop_contaminated(none, items).count() == 0
    assert toxicity.score_toxicity(none, labels).count() == 0 and toxicity.drop_toxic(none, labels).count() == 0
    assert html.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_spans_are_removed(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string")
    got = rows(decontaminate.remove_spans(frame(spark, ["Start ONE, two three four five six seven eight. End", None, "plain"]), items))
    assert [got[i]["text"] for i in range(3)] == ["start end", "", "plain"]
