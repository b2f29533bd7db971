"""Alignment of two tokenizers against a plain version: byte ranges compared one by one, counts in a dictionary."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidepool.llm import token_align
from tidepool.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "  two  blanks\n\n", "▁marked ▁ text", "<|endoftext|> and <s> </s> <unk> <0x41>", "emoji 😀 é ＡＢＣ ﬁ", "\x00\x01 controls \x7f",
       "x" * 5000, " nbsp line", "a", "ein Wörterbuch über Straßen", "\t", "数据 データ", "same same same"] + ["same same same"] * 3


def tokens(texts):
    """Of each text both lists of (id, bytes), or None."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    shown = {c: i for i, c in enumerate(bytes_to_characters())}
    out = []
    for text in texts:
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        xs = [(i, bytes(shown[c] for c in a.id_to_token(i))) for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        ys = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in zip(ids_b, pieces, strict=True)]
        whole = (" " + (text or "")).encode()
        good = text and b"".join(x for _, x in xs) == whole == b"".join(y for _, y in ys)
        out.append((xs, ys) if good else None)
    assert decoders.ByteLevel().decode(["Ġa"]) == " a"
    return out


def bytes_to_characters():
    out, extra = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


def brute(rows):
    ranged, counts = [], Counter()
    for found in tokens([t for _, t in rows]):
        links, groups = [], []
        if found is not None:
            spans = []
            for side in found:
                at, out = 0, []
                for i, x in side:
                    out.append((i, at, at + len(x)))
                    at += len(x)
                spans.append(out)
            j = 0
            for i, s, e in spans[0]:
                while spans[1][j][2] <= s:
                    j += 1
                k = j
                while k < len(spans[1]) and spans[1][k][1] < e:
                    links.append((spans[1][k][0], i))
                    k += 1
            cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
            for begin, end in zip([0, *cuts], cuts, strict=False):
                groups.append("|".join(",".join(str(i) for i, s, e in side if begin < e <= end) for side in spans))
            counts.update(links)
        ranged.append((found, links, groups))
    best = defaultdict(int)
    for (b, _), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for (doc, _), (found, links, groups) in zip(rows, ranged, strict=True):
        text = ";".join(groups)
        out.append((doc, *(map(len, found) if found else (0, 0)), len(groups), len(links), sum(counts[x] == best[x[0]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if found else ""))
    return sorted(out, key=str), counts


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def rows():
    return [*enumerate(ODD), (None, "no id at all"), (3, "a repeated id")]


def test_odd_texts(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns(
        {c: F.lit("clash") for c in ("run", "no", "part", "pair", "n", "best", "groups", "n_a", "salt")})
    got = token_align.align_documents(df, A, B, with_groups=True)
    assert got.columns == [*COLUMNS, "groups"]
    found = got.collect()
    want, counts = brute(rows)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in found), key=str) == want
    for r in found:
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "")
    assert any(r.n_a == 0 for r in found if r.doc_id == 4)  # a text with the blank's own mark does not come back
    pairs = {(r.b_id, r.a_id): (r.n, r.best) for r in token_align.pair_counts(df, A, B).collect()}
    assert {p: n for p, (n, _) in pairs.items()} == counts
    assert all(top == (n == max(m for (c, _), (m, _) in pairs.items() if c == b)) for (b, _), (n, top) in pairs.items())


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_token_alignment"](spark, SF)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)[0]


def test_many_runs_and_groups(spark, rows, monkeypatch):
    """The merge of runs in several groups gives the same counts."""
    df = spark.createDataFrame(rows * 3, "doc_id long, text string").repartition(24)
    monkeypatch.setattr(token_align, "FAN_IN", 2)
    got = token_align.align_documents(df, A, B).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows * 3)[0]


def test_empty(spark):
    df = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in token_align.align_documents(df, A, B).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]
    assert token_align.align_documents(df.where("false"), A, B).count() == 0


def test_quick_coder_equals_the_tokenizer():
    import random

    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        pair = token_align.Pair(f.read(), g.read())
    assert pair.quick is not None
    rng = random.Random(2)
    characters = "abcdeimnoprstuSTEA  '.,-0123é\n\tßü<|>  \x85²"
    texts = [t for t in ODD if t] + ["".join(rng.choices(characters, k=rng.randint(1, 60))) for _ in range(5000)]
    texts += [b.decode("utf-8", "ignore") for b in pair.bytes_a]
    assert pair.encoded_a(texts) == [e.ids for e in pair.a.encode_batch(texts, add_special_tokens=False)]
    assert any(token_align.UNSETTLED.search(t) for t in texts)
