"""Phrase mining against brute force: counts, cuts, containment, odd separators, nulls, empty and long texts."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidepool.llm import phrases


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def brute(rows, min_count, top, share=80):
    out = []
    for lang in {x or "und" if x is None else x for x, _ in rows}:
        f, n = Counter(), 0
        for own, text in rows:
            if (own if own is not None else "und") == lang:
                for w in words_of(text):
                    n += len(w)
                    f.update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
        f = {p: c for p, c in f.items() if c >= min_count}
        found = []
        for p, a in f.items():
            inside = any(len(q) > len(p) and 100 * c >= share * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for q, c in f.items())
            if len(p) > 1 and not inside:
                score, cut = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["Der", "DER", "ÄRA", "a b", "l’été", "x-y", "\x00", "#"]
    marks = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r\n", "!? "]
    out = []
    for i in range(120):
        text = "".join(w + rng.choice(marks) for w in rng.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=60))
        out.append((rng.choice(["en", "de", None, ""]), text))
    out += [("en", "new york city hall " * 40), ("en", None), ("de", ""), (None, " . \t"), ("fr", "one")]
    out += [("es", "uno dos tres, " * 50)] * 2
    return out


def test_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(7).withColumns(
        {c: F.lit("clash") for c in ("phrase", "k", "f", "a", "n", "w", "cut", "shard", "bucket")})
    got = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
                 for r in phrases.collocations(df, min_count=10, top=40).collect())
    want = brute(rows, 10, 40)
    assert got == want and {r[0] for r in got} >= {"en", "de", "und", "", "es"}


def test_frequent_phrases_are_complete(spark, rows):
    """Each of very many shards holds too little of a phrase; the union must still have it."""
    df = spark.createDataFrame(rows, "lang string, text string").repartition(60)
    frequent, _ = phrases.frequent_phrases(df, 30)
    f = Counter()
    for lang, text in rows:
        for w in words_of(text):
            f.update((lang if lang is not None else "und", " ".join(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    assert {(r.lang, r.phrase): r.f for r in frequent.collect()} == {p: c for p, c in f.items() if c >= 30}


def test_empty(spark):
    df = spark.createDataFrame([("en", "a b")], "lang string, text string")
    assert phrases.collocations(df.where("false")).count() == 0
    assert phrases.collocations(df).count() == 0
    assert phrases.collocations(df.withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_chunks_cut_no_piece(rows, monkeypatch):
    texts = pa.array([t or "" for _, t in rows] + ["long " * 400])

    def counts():
        out = Counter()
        for chunk in phrases.chunks(texts):
            for n in range(1, 5):
                found, counts = chunk.counted(n, chunk.places(n)) if len(chunk.places(n)) else ([], [])
                out.update(dict(zip([x.as_py() for x in found], counts.tolist() if len(counts) else [], strict=True)))
        return out

    whole = counts()
    monkeypatch.setattr(phrases, "CHUNK", 100)
    assert counts() == whole and whole[b"long long long long"] == 397


def test_blocks():
    import numpy as np

    keys, counts = np.array([5, 2**39 + 7, 2**40 - 1], np.uint64), np.array([1, 2**31, 3], np.uint32)
    assert [x.tolist() for x in phrases.unpacked(phrases.packed(keys, counts))] == [keys.tolist(), counts.tolist()]
