"""Operators 3, 6, 7, 8 and 10: round trips, brute force, held-out accuracy."""

import functools
import random
import string
import zlib
from collections import Counter

import brute
import corpus
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracelode.llm import fingerprints, language, licenses, packing, toxicity, words
from tracelode.llm.queries import QUERIES
from tracelode.llm.tables import held_out, stored

SF_DIR = "/root/testdata/sf0.01"


def test_words_of_chunks(monkeypatch):
    monkeypatch.setattr(words, "CHUNK", 20)
    texts = [t for _, t in corpus.documents(1)]
    got = []
    for _, _, offsets, data in words.chunks(pa.array(texts)[:]):
        starts, ends, counts = words.split(data, offsets)
        own = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
        at = np.cumsum(counts) - counts
        got += [own[a : a + n] for a, n in zip(at, counts)]
    assert got == [brute.WORD.findall(t or "") for t in texts]


def test_window_hashes_do_not_depend_on_the_place():
    a = np.arange(50, dtype=np.uint64)
    b = np.concatenate([np.arange(900, 917, dtype=np.uint64), a])
    for n in (1, 3, 35, 50):
        assert (words.windows(a, n) == words.windows(b, n)[17:]).all()
    assert len(np.unique(words.windows(b, 3))) == len(b) - 2


# Packing


def check_pieces(docs, pieces, sequence, tokenizer):
    at = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == at.get(p["sequence_id"], 0)
        at[p["sequence_id"]] = p["offset"] + p["length"]
    assert sorted(at) == list(range(len(at)))
    assert all(n == sequence for n in [at[s] for s in sorted(at)][:-1])
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
    assert set(by_doc) == {d for d, _ in docs}
    for doc, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        upto = 0
        for p in sorted(by_doc[doc], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (upto, len(ids))
            upto += p["length"]
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : upto].tobytes())
            assert p["ids"] == ids[p["start"] : upto].tolist()
        assert upto == len(ids)


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    docs = corpus.documents(4) + [
        (1, "Don't STOP, it's <|endoftext|> Mixed<|ENDOFTEXT|>Case we'LL e.g. 3.14 a--b (x) İstanbul ΣΣ J̌x Kelvin"),
        (2, "café, café. naïve! straße? Über; 'é' l'été... !!'s 'RE it'S"),
        (5, "a b c\x1fd\x85e ́f g̸= x̸"),
    ]
    rng = random.Random(0)
    alphabet = "ab Z'.,<|>=éÉ̸s\t\nİΣ1あ -"
    docs += [(10_000 + i, "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))) for i in range(200)]
    pieces = packing.packed(corpus.frame(spark, docs), sequence=256, with_ids=True).collect()
    check_pieces(docs, pieces, 256, Tokenizer.from_file(packing.tokenizer_path()))


def _alphabets():
    """Letters, marks and others of every block of 128 code points, and all letters that composition takes apart."""
    import unicodedata

    blocks = []
    for start in range(0, 0x20000, 128):
        own = [chr(c) for c in range(start, start + 128) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
        if own and not 0x3500 < start < 0x4D00 and not 0x4E80 < start < 0x9F00 and not 0xAD00 < start < 0xD700:
            blocks.append(own)
    apart = [chr(c) for c in range(0x80, 0x20000) if not 0xD800 <= c < 0xE000 and len(unicodedata.normalize("NFC", chr(c))) > 1]
    return blocks, apart


def test_token_ids_of_every_script():
    """Words of each block with punctuation in and after them, words of letters that composition takes apart, and mixtures: 10^5 texts."""
    from tokenizers import Tokenizer

    whole, ids_of = Tokenizer.from_file(packing.tokenizer_path()), packing.WordTokens(packing.tokenizer_path())
    rng = random.Random(11)
    blocks, apart = _alphabets()
    assert len(blocks) > 250 and len(apart) > 60
    ends = [*".,;:!?-_)(\"'|*/", "'s", "...", "?!", " ", "\n", "\t", "a", "Z", "9", "\u0301", "<|"]

    def word(letters):
        return "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))

    texts = ["এটা হয়, তাই", "বড়. ছোট", "लड़का पढ़, और", "שׁ, בּ. וֹ!", "K. Å, Ω;"]
    for c in apart:
        texts += [f"{c}{e} a" for e in ends] + [f"x{c}{e}b {c}{c}{e}" for e in ends]
    while len(texts) < 100_000:
        kind = rng.random()
        own = rng.choice(blocks) if kind < 0.7 else rng.choice(blocks) + apart if kind < 0.85 else [rng.choice(rng.choice(blocks)) for _ in range(12)] + apart
        texts.append("".join(word(own) + rng.choice(ends) + rng.choice(["", " "]) for _ in range(rng.randint(1, 3))))
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    wrong = [t for t, ids in zip(texts, want) if ids_of(t.encode()).tolist() != ids]
    assert not wrong, wrong[:5]


def test_packing_with_a_small_cache():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    ids_of = packing.WordTokens(packing.tokenizer_path(), limit=50)
    for _, text in corpus.documents(2):
        assert ids_of((text or "").encode()).tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_packing_of_repeated_rows_and_nothing(spark):
    docs = corpus.frame(spark, [(1, "a b"), (1, "a b"), (None, None)])
    got = packing.packed(docs, sequence=4).collect()
    assert sum(p["length"] for p in got) == 7
    assert packing.packed(corpus.frame(spark, [])).count() == 0


# Fingerprints


def jaccard(a, b):
    a, b = brute_shingles(a), brute_shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_shingles(text):
    own = brute.WORD.findall(text or "")
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)} if len(own) >= 5 else {tuple(own)} if own else set()


def test_fingerprints(spark):
    import hashlib

    docs = corpus.documents(6)
    got = {r["doc_id"]: r for r in fingerprints.neighbours(corpus.frame(spark, docs)).collect()}
    ring = sorted(docs, key=lambda d: -d[0])
    assert len(got) == len(docs)
    off = []
    by_text = {}
    for (doc, text), (_, after) in zip(ring, ring[1:] + ring[:1]):
        text, after, r = text or "", after or "", got[doc]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert len(r["fingerprint"]) == (2 * fingerprints.BINS if brute.WORD.search(text) else 0)
        for near, other in ((r["near_edited"], edited), (r["near_next"], after)):
            true = jaccard(text, other)
            off.append(abs(near - true))
            if brute_shingles(text) == brute_shingles(other):
                assert near == 1.0
    assert np.mean(off) < 0.04 and max(off) < 0.3


def test_fingerprints_stay_in_the_engine(spark):
    plan = fingerprints.neighbours(corpus.frame(spark, corpus.documents(1)[:5]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def plain_neighbours(docs):
    """(doc_id, edited text, next text) of every row: descending ids, null last, one id's documents by a hash of their text."""
    import hashlib
    import xxhash

    key = lambda t: np.int64(np.uint64(xxhash.xxh64_intdigest((t or "").encode(), 42)).astype(np.int64))
    ring = sorted(((d, t or "") for d, t in docs), key=lambda d: (d[0] is None, -(d[0] or 0), key(d[1])))
    out = []
    for (doc, text), (_, after) in zip(ring, ring[1:] + ring[:1]):
        half = len(text) // 2
        out.append((doc, len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("range_bytes", [1, 300, 1 << 27])
def test_neighbours_over_the_borders_of_ranges(spark, range_bytes):
    """Ids that come twice, copies, null ids, the least and largest ids: as one ring, whatever the ranges."""
    docs = corpus.documents(3)[:40] + [(2**63 - 1, "high a b c"), (-(2**63), "low d e f"), (-5, "minus"), (0, "")]
    docs += [(1003, f"another text {i}") for i in range(6)] + [(None, f"no id {i}") for i in range(6)] + [(None, None), (1006, "x y")]
    docs += [(1, "copy of one")] * 7 + [(None, "no id 3")] * 4 + [(0, None)]
    got = fingerprints.neighbours(corpus.frame(spark, docs), range_bytes).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=repr) == plain_neighbours(docs)
    copies = [r["near_next"] for r in got if r["doc_id"] == 1]
    assert len(copies) == 7 and copies.count(1.0) >= 6


def test_ranges_grow_with_the_bytes(spark):
    rows = spark.range(2000).selectExpr("id AS doc_id", "0L AS none", "~id AS down", "id AS text_key", "1000L AS bytes")
    few, many = fingerprints._ranges(rows, 1 << 20), fingerprints._ranges(rows, 20_000)
    assert 1 < len(few.bounds) <= 8 and 80 <= len(many.bounds) <= 100
    assert many.bounds == sorted(many.bounds) and many.bounds[0][1] == ~1999


def test_fingerprints_of_repeated_rows_and_null_ids(spark):
    docs = [(4, "a b c d e f"), (4, "a b c d e f"), (4, "z"), (None, "q"), (None, None), (9, "")]
    got = fingerprints.neighbours(corpus.frame(spark, docs))
    assert got.count() == len(docs)
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in got.collect()) == sorted((str(d), len(t or "")) for d, t in docs)
    alone = fingerprints.neighbours(corpus.frame(spark, [(1, "a b")])).first()
    assert (alone["near_next"], alone["near_edited"]) == (1.0, 0.0)
    assert fingerprints.neighbours(corpus.frame(spark, [])).count() == 0


# Toxicity


def test_non_negative_risk_ignores_labels_of_the_unlabelled():
    """Positives carry feature 0; a fifth of the unlabelled do as well, and still score high."""
    rng = np.random.default_rng(0)
    n = 4000
    positive = np.arange(n) < 800
    has = np.where(positive, True, rng.random(n) < 0.2)
    rows = np.concatenate([np.flatnonzero(has), np.arange(n)])
    found = np.concatenate([np.zeros(has.sum(), int), rng.integers(1, 50, n)])
    w, b = toxicity.fit(positive, rows, found, 50, prior=0.2)
    p = 1 / (1 + np.exp(-(w[0] + b)))
    assert p > 0.7 and 1 / (1 + np.exp(-b)) < 0.1


def test_held_out_toxicity(spark):
    """On the larger table: the smaller one has 38 toxic documents in four languages to learn from."""
    folder = "/root/testdata/sf0.1"
    got = stored(QUERIES["op7_toxicity"](spark, folder), "scores")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert got.count() == docs.count()
    r = got.join(labels, "doc_id").filter("held_out").agg(
        F.sum(F.expr("int(toxic = 1 and predicted = 1)")).alias("hit"), F.sum("toxic").alias("toxic"), F.sum("predicted").alias("said")
    ).first()
    assert r["hit"] >= 0.85 * r["toxic"] and r["hit"] >= 0.75 * r["said"], r
    assert got.filter("score < 0 or score > 1 or predicted != int(score >= 0.3)").isEmpty()


@pytest.mark.parametrize("n", [2400, 6000])
def test_rare_cues_and_languages_are_learnt_from_any_number_of_labels(spark, n):
    """0.8 % of the toxic texts hold only a rare cue, 0.8 % are in a language of their own."""
    rng = random.Random(6)
    docs, labels, kinds = [], [], {}
    for i in range(8 * n):
        text = [f"w{rng.randrange(300)}" for _ in range(12)]
        if i < n:
            kind = "rare" if i % 125 == 0 else "minority" if i % 125 == 1 else "common"
            if kind == "minority":
                text = [f"жш{rng.randrange(100)}" for _ in range(12)]
            text[rng.randrange(12)] = {"rare": "qrare", "minority": "грубо", "common": f"vile{rng.randrange(3)}"}[kind]
            labels.append((i, 0, 1))
            kinds[i] = kind
        elif i % 125 == 1:
            text = [f"жш{rng.randrange(100)}" for _ in range(12)]
        docs.append((i, " ".join(text)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.learn(docs, labels, prior=0.125))
    scores = {r["doc_id"]: r["score"] for r in got.filter(held_out()).collect()}
    for kind in ("rare", "minority", "common"):
        own = [s >= toxicity.THRESHOLD for i, s in scores.items() if kinds.get(i) == kind]
        assert own and sum(own) >= 0.8 * len(own), kind
    clean = [s >= toxicity.THRESHOLD for i, s in scores.items() if i not in kinds]
    assert sum(clean) <= 0.02 * len(clean)


def test_toxicity_without_labels_or_texts(spark):
    docs = corpus.frame(spark, corpus.documents(1))
    for rows in ([], [(None, 1, 1), (1000, None, None)], [(1000, 0, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        got = toxicity.score(docs, toxicity.learn(docs, labels))
        assert got.filter("score = 0").count() == docs.count()
    labels = spark.createDataFrame([(1000 + 3 * i, 0, i % 2) for i in range(40)] * 2, "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.learn(docs, labels))
    assert got.count() == docs.count() and got.filter("score is null").isEmpty()
    empty = corpus.frame(spark, [])
    assert toxicity.score(empty, toxicity.learn(empty, labels)).count() == 0


# Licenses


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases(spark, seed):
    rng = random.Random(seed)
    pieces = ["cc", "by", "CC-BY", "general", "Public", "license", "all", "rights", "reserved", "é", "x9", ".", "\n", "cc by cc by", "ALL RIGHTS reserved"]
    docs = [(i, " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 40)))) for i in range(80)] + [(99, None)]
    got = {r["doc_id"]: r for r in licenses.scan(corpus.frame(spark, docs)).collect()}
    for doc, text in docs:
        r = got[doc]
        assert (r["n_words"], sorted((p["word"], p["label"]) for p in r["places"])) == brute.phrase_places(text, licenses.PHRASES)


def _edits(a, b):
    """Levenshtein distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != y))
    return row[-1]


def fewest_edits(notice, text):
    """Over all runs of words of a text that hold the marked words as they are, in order: the fewest edits of what lies between them. None without one."""
    own, parts = text.split(), []
    for w in notice.split():
        if w.startswith("*") or not parts or parts[-1].startswith("*"):
            parts.append(w)
        else:
            parts[-1] += f" {w}"

    @functools.cache
    def from_here(part, at):
        if part == len(parts):
            return 0
        if parts[part].startswith("*"):
            return from_here(part + 1, at + 1) if at < len(own) and own[at] == parts[part][1:] else None
        wanted = parts[part]
        costs = []
        for end in range(at + 1, min(len(own), at + len(wanted.split()) + 6) + 1):
            rest = from_here(part + 1, end)
            if rest is not None:
                costs.append(rest + _edits(wanted, " ".join(own[at:end])))
        return min(costs, default=None)

    found = [c for at in range(len(own)) if not (at and own[at - 1] in licenses.NEGATIONS) and (c := from_here(0, at)) is not None]
    return min(found, default=None)


def test_notices_against_edit_distance():
    """Notices with none to too many edits, in marked words too, among other words and each other: the same labels as by dynamic programming."""
    rng = random.Random(3)
    notices = list(licenses.NOTICES.items())
    hits = 0
    for i in range(480):
        notice, label = notices[i % len(notices)]
        text, most = list(licenses.plain(notice)), licenses.allowed(notice)
        for _ in range(rng.randint(0, most + 2)):
            at, kind = rng.randrange(len(text)), rng.random()
            if kind < 0.4:
                text[at] = rng.choice("abcxyz")
            elif kind < 0.7:
                del text[at]
            else:
                text.insert(at, rng.choice("abcxyz "))
        other = licenses.plain(rng.choice(notices)[0]) if rng.random() < 0.3 else ""
        line = " ".join(f"{rng.choice(['one two', 'is'])} {''.join(text)} three {other}".split())
        _, _, found = licenses.scan_text(line.encode())
        for name, own in (notices[i % len(notices)], *rng.sample(notices, 4)):
            want = fewest_edits(name, line)
            got = [f for f in found if f[2] == own]
            if want is not None and want <= licenses.allowed(name):
                hits += 1
                assert got and min(f[3] for f in got) <= want, (name, line, want)
        for first, end, own, edits, likeness in found:
            words = " ".join(line.split()[first:end])
            assert any(fewest_edits(n, words) is not None and fewest_edits(n, words) <= edits <= licenses.allowed(n) for n, x in notices if x == own)
            assert 0 < likeness <= 1
    assert hits > 150


NOT_LICENSED = [
    "CC BY-SA 4.0", "the MPL license", "released under the mpl license", "unreleased under the mit license", "Relicensed under the MIT License",
    "not licensed under the MIT license", "never released under the MIT license", "released under the limit license", "mit und der license",
    "al rights reserved", "small rights reserved", "Licensed under the Apache License, Version 1.1", "licensed under the gnu public license",
    "licensed under cc by nc", "a license to kill", "under the license", "permission is hereby denied free of charge to any person",
    "subject to the terms of the mozilla foundation", "nothing of the kind is said in these words at all", "released under the mit", "",
]


def test_texts_that_are_no_notices():
    for text in NOT_LICENSED:
        assert licenses.scan_text(text.encode())[2] == [], text
    own = {"Licensed under CC BY-SA 4.0.": "cc-by-sa", "licensed under CC BY-NC-ND 4.0": "cc-by-nc-nd", "Released undr the  MIT\nlicence!": "mit"}
    for text, label in own.items():
        assert {f[2] for f in licenses.scan_text(text.encode())[2]} == {label}


def test_long_texts_of_hits_take_time_in_proportion():
    import time

    for text, per_hit in ((b"cc by ", 20e-6), (b"released under the mit license ", 1e-3), (b"all rights ", 1e-3), (b"licensed under the ", 2e-3)):
        n = 200_000 if per_hit < 1e-4 else 8_000
        start = time.perf_counter()
        size, places, found = licenses.scan_text(text * n)
        assert size == n * len(text.split()) and time.perf_counter() - start < per_hit * n
        assert len(places) in (0, n) and len(found) in (0, n)


def test_license_query(spark):
    got = QUERIES["op8_license_scan"](spark, SF_DIR)
    assert got.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert got.filter("n_base = 0 and (first_word is not null or base_labels != '')").isEmpty()
    assert got.filter("n_base > 0 and (first_word > last_word or score != 1 or not contains(labels, split(base_labels, ',')[0]))").isEmpty()


# Language


def test_code_lengths_are_exact():
    """In every context the 256 bytes' probabilities sum to one, for every language."""
    texts = {"en": b"the cat sat on the mat and the dog sat too " * 3, "fr": "le chat était là et le chien aussi ".encode() * 3}
    grams = {}
    for lang, text in texts.items():
        wide = np.frombuffer(b"\n\n\n" + text, np.uint8).astype(np.int64)
        grams[lang] = np.unique((wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:], return_counts=True)
    for room in (1 << 24, 1 << 16):
        model = language.Model(["en", "fr"], grams, room)
        for prefix in (b"", b"t", b"the", b"zq!", b"la "):
            ends = [prefix + bytes([b]) for b in range(256)]
            offsets = np.cumsum([0, *map(len, ends)])
            bits = model.bits(offsets, np.frombuffer(b"".join(ends), np.uint8))
            before = model.bits(np.array([0, len(prefix)]), np.frombuffer(prefix, np.uint8))
            assert np.allclose(np.exp2(before - bits).sum(0), 1, atol=1e-4)


def _grams(text):
    wide = np.frombuffer(b"\n\n\n" + text, np.uint8).astype(np.int64)
    return np.unique((wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:], return_counts=True)


def test_all_contexts_of_three_bytes_are_kept_for_many_languages_and_scripts():
    """Twelve languages over the same pairs of letters, told apart by what follows three of them; one is Cyrillic, one Chinese.

    With the printable characters the bytes are as many kinds as in ordinary corpora.
    """
    rng = random.Random(8)
    texts = {}
    for i in range(9):
        own = random.Random(i)
        shift = {b + c: own.randrange(8) for b in "abcdefgh" for c in "abcdefgh"}  # any two letters are followed by all alike
        follows = {(a, b, c): "abcdefgh"[(ord(a) + shift[b + c]) % 8] for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"}

        def line(size, follows=follows):
            out = [rng.choice("abcdefgh") for _ in range(3)]
            while len(out) < size:
                out.append(follows[tuple(out[-3:])] if rng.random() < 0.6 else rng.choice("abcdefgh"))
            return "".join(out)

        texts[f"l{i:02}"] = (line(30_000), [line(200) for _ in range(20)])
    for lang, letters in (("ascii", string.printable), ("ru", "абвгдежзийклмнопрстуфхцчшщъыьэюя"), ("zh", "".join(map(chr, range(0x4E00, 0x4F40))))):
        texts[lang] = ("".join(rng.choice(letters) for _ in range(8000)), ["".join(rng.choice(letters) for _ in range(40))])
    langs = sorted(texts)
    model = language.Model(langs, {lang: _grams(texts[lang][0].encode()) for lang in langs})
    right = []
    for lang, (_, lines) in texts.items():
        data = [x.encode() for x in lines]
        bits = model.bits(np.cumsum([0, *map(len, data)]), np.frombuffer(b"".join(data), np.uint8))
        right += [langs[k] == lang for k in bits.argmin(1)]
    assert np.mean(right) > 0.98


def test_code_lengths_follow_method_c():
    """Against a plain recursion over the contexts."""
    text = "the cat sat on the mat, дом и кот ".encode() * 2
    padded = b"\n\n\n" + text

    def p(context, byte):
        longer = p(context[1:], byte) if context else 1 / 256
        after = Counter(padded[i] for i in range(3, len(padded)) if padded[i - len(context) : i] == context)
        if not after:
            return longer
        if byte in after:
            return after[byte] / (sum(after.values()) + len(after))
        rest = sum(p(context[1:], b) if context else 1 / 256 for b in range(256) if b not in after)
        return len(after) / (sum(after.values()) + len(after)) * longer / rest

    p = functools.cache(p)
    model = language.Model(["x"], {"x": _grams(text)})
    for sample in (b"the dog", "кит z".encode(), b"\xff\x00a"):
        whole = b"\n\n\n" + sample
        want = -sum(np.log2(p(whole[i - 3 : i], whole[i])) for i in range(3, len(whole)))
        assert np.isclose(model.bits(np.array([0, len(sample)]), np.frombuffer(sample, np.uint8))[0, 0], want)


def test_blocks_do_not_change_code_lengths(monkeypatch):
    wide = np.frombuffer(b"\n\n\n" + b"abracadabra " * 40, np.uint8).astype(np.int64)
    grams = {"x": np.unique((wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:], return_counts=True)}
    model = language.Model(["x"], grams)
    text = np.frombuffer(b"cadabra abra" * 30, np.uint8)
    offsets = np.array([0, 0, 5, 6, 100, len(text), len(text)])
    whole = model.bits(offsets, text)
    monkeypatch.setattr(language, "_BLOCK", 7)
    assert np.allclose(whole, model.bits(offsets, text))


def test_held_out_language(spark):
    got = QUERIES["op10_language"](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert got.count() == docs.count()
    r = got.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").agg(F.avg(F.expr("int(lang = lang_pred)"))).first()[0]
    assert r > 0.98
    ids = [r["doc_id"] for r in got.filter("held_out").collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 4 == 2 for i in ids)


def test_one_short_document_teaches_a_language_and_null_ids_stay_within_the_sample(spark):
    docs = [(None, f"the cat {i} sat on the mat", "en") for i in range(3000)] + [(1, "кот и дом", "ru")] + [(None, "the cat", "en")] * 50
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    seen = []
    real = language.gram_counts
    try:
        language.gram_counts = lambda sample: seen.append(sample.count()) or real(sample)
        model = language.learn(frame, docs_per_language=300)
    finally:
        language.gram_counts = real
    assert model.langs == ["en", "ru"] and 200 < seen[0] < 420
    got = {r["text"]: r["lang_pred"] for r in language.predict(frame.limit(3).union(frame.filter("lang = 'ru'")), model).collect()}
    assert got["кот и дом"] == "ru" and set(got.values()) == {"en", "ru"}


def test_language_of_odd_texts(spark):
    docs = corpus.frame(spark, corpus.documents(2) + [(1, "123 456 ..."), (2, "Ж")])
    got = language.predict(docs, language.learn(docs))
    und = {r["doc_id"] for r in got.filter("lang_pred = 'und'").collect()}
    assert und == {r["doc_id"] for r in docs.collect() if not any(c.isalpha() for c in r["text"] or "")}
    kept = language.keep_recognised(docs)
    assert kept.columns == docs.columns and not und & {r["doc_id"] for r in kept.collect()}
    untaught = docs.withColumn("lang", F.lit(None).cast("string"))
    assert language.predict(untaught, language.learn(untaught)).filter("lang_pred != 'und' or score != 0").isEmpty()
    empty = corpus.frame(spark, [])
    assert language.predict(empty, language.learn(empty)).count() == 0
