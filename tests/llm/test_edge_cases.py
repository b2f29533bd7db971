"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidepool.llm import (bpe, decontaminate, html_extract, ngram_join, pii, quality, substring, urlfilter, warc,
                          wordpiece)

PROSE = " ".join(f"word{i * 7919 % 1000}" for i in range(120))
ROWS = [
    (1, PROSE, "en"), (2, PROSE, "en"), (2, PROSE, "en"), (3, "", "en"), (4, None, None), (None, PROSE, "de"),
    (5, "mail jo.doe7@mail.example.com today", None), (6, PROSE + " " + "x" * 300_000, "en"), (7, " \t\n", "fr"),
]
#: Names that the operators use inside.
CLASHES = ["_seen", "_id", "_w", "_k", "first", "kept", "stratum", "node", "size", "ids", "_doc", "_text", "_q", "_row", "place", "words", "templates", "host"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="module")
def no_docs(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, 1), (None, 0), (3, None)], "doc_id long, quality int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(10, PROSE[:150].rsplit(" ", 1)[0]), (11, None), (12, ""), (None, "no such words here at all")],
                                 "item_id long, text string")


def ids(df):
    return sorted((r.doc_id for r in df.collect()), key=lambda x: (x is None, x))


ALL_IDS = [1, 2, 2, 3, 4, 5, 6, 7, None]


def test_bpe(docs, no_docs):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, with_ids=True).collect()
    assert sorted((r.doc_id for r in rows), key=lambda x: (x is None, x)) == ALL_IDS
    empty = hashlib.sha256(b"").hexdigest()
    for r in rows:
        assert r.n_tokens == len(r.ids)
        if r.doc_id in (3, 4):
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (0, empty, empty)
    assert bpe.encode_documents(no_docs, ranks, public_tokenizers.PATTERN).count() == 0


def test_token_counts(docs, no_docs):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = wordpiece.token_counts(docs, path).collect()
    assert sorted((r.doc_id for r in rows), key=lambda x: (x is None, x)) == ALL_IDS
    assert all((r.n_words, r.n_tokens) == (0, 0) for r in rows if r.doc_id in (3, 4, 7))
    assert wordpiece.token_counts(no_docs, path).count() == 0


def test_pii(docs, no_docs):
    rows = pii.pseudonymize(docs).collect()
    assert sorted((r.doc_id for r in rows), key=lambda x: (x is None, x)) == ALL_IDS
    by_id = {r.doc_id: r for r in rows}
    assert by_id[4].text is None and by_id[3].text == "" and by_id[1].text == PROSE
    assert by_id[5].n_values == 1 and "jo.doe7" not in by_id[5].text
    assert pii.pseudonymized(docs).columns == docs.columns
    assert pii.pseudonymized(docs).count() == len(ROWS) and pii.pseudonymize(no_docs).count() == 0


def test_decontamination(spark, docs, no_docs, items):
    rows = decontaminate.contaminated_pairs(docs, items).collect()
    assert sorted(((r.doc_id, r.item_id, r.distance, r.word_start) for r in rows), key=str) == sorted(
        [(1, 10, 0, 0), (2, 10, 0, 0), (2, 10, 0, 0), (6, 10, 0, 0), (None, 10, 0, 0)], key=str)
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and ids(kept) == [3, 4, 5, 7]
    assert decontaminate.contaminated_pairs(no_docs, items).count() == 0
    assert ids(decontaminate.clean(docs, items.where("false"))) == ALL_IDS


def test_ngram_join(docs, no_docs):
    rows = ngram_join.linked_documents(docs).collect()
    assert sorted((r.doc_id for r in rows), key=lambda x: (x is None, x)) == ALL_IDS
    by_id = {r.doc_id: (r.class_id, r.n_links, r.group_id) for r in rows}
    assert by_id[1] == (1, 3, 1) and by_id[2] == (1, 3, 1)  # the two rows of id 2 count as documents
    assert by_id[6] == (6, 3, 1)
    assert by_id[3] == (3, 0, 3) and by_id[7] == (7, 0, 7) and by_id[None] == (None, 0, None)
    kept = ngram_join.one_of_each_group(docs)
    assert kept.columns == docs.columns and ids(kept) == [1, 3, 4, 5, 7, None]
    assert ngram_join.linked_documents(no_docs).count() == 0 and ngram_join.one_of_each_group(no_docs).count() == 0


def test_substring(docs, no_docs):
    rows = substring.repeated_passages(docs).collect()
    assert {(r.doc_id, r.other_id) for r in rows} == {(1, 2), (2, 1), (1, 6), (6, 1)}
    assert all(r.similarity >= 0.8 and r.word_end - r.word_start >= 50 for r in rows)
    assert substring.repeated_passages(no_docs).count() == 0


def test_quality(docs, no_docs, labels):
    rows = quality.judge(docs, labels).collect()
    assert sorted((r.doc_id for r in rows), key=lambda x: (x is None, x)) == ALL_IDS
    by_id = {r.doc_id: r for r in rows}
    assert by_id[4].n_words == 0 and by_id[4].base_failed and not by_id[4].kept
    assert by_id[1].n_words == 120 and by_id[1].kept and by_id[6].word_chars == len(PROSE.replace(" ", "")) + 300_000
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns and ids(kept) == [1, 2, 2, 6, None]
    assert quality.judge(no_docs, labels).count() == 0 and quality.keep(docs, labels.where("false")).count() == 5


@pytest.fixture(scope="module")
def pages(spark):
    body = "<html><body><nav>Menu</nav><article><h1>T</h1><p>A &amp; b\n c</p></article></body></html>"
    rows = [(1, "http://www.Example.org/es/1?q", body), (2, "https://a.org", body), (2, "https://a.org", body),
            (3, None, None), (None, "no scheme", ""), (4, "x://example.com/de/" + "y" * 50_000, "<p>" + "z " * 100_000),
            (5, "http://h.net#f", "<p>a<p>WARC/1.1\r\n\r\n<b>b")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({c: F.lit("clash") for c in ["host", "path", "rule", "token", "payload", "templates", "text"]})


def test_url_filters(pages):
    rows = urlfilter.judge_pages(pages).collect()
    assert len(rows) == 7
    got = {(r.page_id, r.host, r.path[:9], r.rule, r.verdict) for r in rows}
    assert got == {(1, "www.example.org", "/es/1", "example.org/es/", "block"), (2, "a.org", "", None, "allow"),
                   (3, "", "", None, "allow"), (None, "", "", None, "allow"),
                   (4, "example.com", "/de/yyyyy", "com/de/", "block"), (5, "h.net", "", None, "allow")}
    assert urlfilter.judge_pages(pages.where("false")).count() == 0


def test_html(pages):
    rows = {r.page_id: r for r in html_extract.extract_text(pages).collect()}
    assert rows[1].text == "T A & b c" and rows[3].text == "" and rows[None].text == "" and rows[5].text == "a WARC/1.1 b"
    assert rows[4].n_chars == 199_999
    assert html_extract.extract_text(pages).count() == 7 and html_extract.extract_text(pages.where("false")).count() == 0


def test_warc(spark, pages, tmp_path):
    rows = warc.archive_round_trip(pages).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(7))
    assert [r.url_key for r in rows] == sorted(r.url_key for r in rows)
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in rows), key=str)
    size = len(pages.where("page_id = 1").first().html.encode())
    assert got == sorted([(1, size, "response", None), (2, size, "revisit", 1), (2, size, "revisit", 1),
                          (3, 0, "response", None), (None, 0, "revisit", 3), (4, 200_003, "response", None),
                          (5, 23, "response", None)], key=str)
    assert warc.archive_round_trip(pages.where("false")).count() == 0


def _words(name, n):
    return [f"{name}{i}" for i in range(n)]


def test_substring_passages_from_earlier_documents(spark):
    """Two documents that share a passage meet, also if others hold its parts before and between them."""
    rows, n = [], 0
    for parts in (2, 3):
        for size in (60, 80, 96, 400):
            passage = _words(f"p{n}x", size)
            cuts = [size * k // parts for k in range(parts + 1)]
            pieces = [passage[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            for k, own in enumerate([*pieces, passage, *pieces, passage]):
                rows.append((n + k, " ".join(_words(f"a{n + k}x", 70) + own + _words(f"z{n + k}x", 70))))
            n += 100
    found = {(r.doc_id, r.other_id): r for r in substring.repeated_passages(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    n = 0
    for parts in (2, 3):
        for size in (60, 80, 96, 400):
            r = found[n + parts, n + 2 * parts + 1]
            assert (r.word_start, r.word_end, r.other_start, r.other_end, r.edits) == (70, 70 + size, 70, 70 + size, 0)
            n += 100


def test_substring_repeated_lines(spark):
    """A line of 3-20 words repeated to 200 words in two documents, at different places."""
    rows = []
    for period in range(3, 21):
        lines = (_words(f"l{period}x", period) * 80)[:200]
        rows += [(period, " ".join(_words(f"a{period}x", 30) + lines + _words(f"b{period}x", 30))),
                 (100 + period, " ".join(_words(f"c{period}x", 77) + lines + _words(f"d{period}x", 5)))]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    whole = {r.doc_id for r in found if (r.word_start, r.word_end, r.other_start, r.other_end, r.edits) == (30, 230, 77, 277, 0)}
    assert whole >= set(range(3, 21))
    assert len(found) <= 4 * 18


def test_substring_holders_by_chance_hide_no_passage(spark):
    """Documents 1 and 3 hold each seed of the passage in 8 of its words, with other words around; 2 and 4 hold the passage."""
    passage = [f"w{i * i}" for i in range(70)]

    def pieces(name):
        return " ".join(f"{name}a{i} {name}b{i} {name}c{i} {' '.join(passage[i:i + 8])} {name}d{i} {name}e{i} {name}f{i}" for i in range(63))

    def around(name):
        return f"{' '.join(f'{name}{i}' for i in range(30))} {' '.join(passage)} {' '.join(f'{name}{i}' for i in range(30, 60))}"

    rows = [(1, pieces("x")), (2, around("y")), (3, pieces("z")), (4, around("v"))]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.word_start, r.word_end, r.other_id) for r in found} == {(2, 30, 100, 4), (4, 30, 100, 2)}
