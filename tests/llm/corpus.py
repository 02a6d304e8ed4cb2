"""Small corpora with copies, near copies, shared passages, nulls and odd texts."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, as extra columns of their input.
CLASHING = {"row": "'x'", "text_key": "1L", "same": "'s'", "length": "2", "score": "0.5D", "kept": "true", "part": "3",
            "position": "7L", "Lang_Pred": "'q'", "k": "1", "_key": "'y'", "_copy": "9", "document": "'z'", "key": "8", "at": "'w'", "copy": "2",
            "stays": "false", "_stays": "1", "_position": "3", "_at": "4", "bits_per_byte": "99D", "text key": "'odd'", "range": "5"}
ODD = [None, "", "   \t\n", "one", "Two words", "a a a a a a a a a a", "... !!! ???", "été ÉTÉ straße", "x" * 3000,
       "tab\tand\x0bvertical\x0cfeed no break", "日本語 テキスト"]


def words(rng, n, vocabulary=400):
    return [f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n)]


def documents(seed=0, groups=6, singles=25):
    """(doc_id, text): groups of exact and near copies, a passage many share, one long text, odd texts."""
    rng = random.Random(seed)
    texts = list(ODD)
    passage = words(rng, 60)
    for g in range(groups):
        base = words(rng, rng.randint(30, 160))
        for c in range(rng.randint(2, 7)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(own) // 25, len(own) // 8])):
                own[rng.randrange(len(own))] = f"e{g}x{c}x{rng.random():.6f}"
            text = " ".join(own)
            texts.append(text if rng.random() < 0.6 else text.replace(" ", "  ").upper() if rng.random() < 0.5 else text + "\n")
    for i in range(singles):
        own = words(rng, rng.randint(5, 120))
        if i % 3 == 0:
            at = rng.randrange(len(own))
            own[at:at] = passage[rng.randint(0, 20) : rng.randint(40, 60)]
        texts.append(" ".join(own))
    long = words(rng, 6000)
    texts += [" ".join(long), " ".join(long[:2500] + ["new"] + long[2600:])]
    twice = words(rng, 45)
    texts.append(" ".join(twice + words(rng, 3) + twice))
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(1000 + 3 * i, texts[k]) for i, k in enumerate(order)]


def frame(spark, docs, clashing=True):
    """A documents table of (doc_id, text) pairs, with extra columns that operators use inside."""
    rows = [(d, t, ("en", "fr", None)[i % 3], (None, "", "a", "b")[i % 4], len(t or "")) for i, (d, t) in enumerate(docs)]
    out = spark.createDataFrame(rows, SCHEMA)
    return out.selectExpr("*", *[f"{v} AS `{k}`" for k, v in CLASHING.items()]) if clashing else out
