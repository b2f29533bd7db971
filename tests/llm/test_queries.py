"""The registered queries on the small tables: against DuckDB, or a brute-force version."""

import itertools
import os
import re
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from tidepool.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in ("documents", "pages", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def rows(columns, data):
    return sorted((tuple(r[columns.index(c)] for c in sorted(columns)) for r in data), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, tables, name):
    got = QUERIES[name](spark, SF)
    want = tables.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, map(tuple, got.collect())) == rows(want.columns, want.fetchall())


@pytest.fixture(scope="module")
def words(tables):
    data = tables.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()
    return {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in data}


def linked(words):
    sets = {i: frozenset(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset() for i, w in words.items()}
    holders, common, links = defaultdict(list), Counter(), defaultdict(set)
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)
    for found in holders.values():
        common.update(itertools.combinations(found, 2))
    for (a, b), n in common.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a].add(b)
            links[b].add(a)
    return links


def groups(links, ids):
    out = {}
    for i in sorted(ids):
        stack = [i]
        while stack:
            j = stack.pop()
            if j not in out:
                out[j] = i
                stack += links[j]
    return out


def test_ngram_join(spark, words):
    links = linked(words)
    group = groups(links, words)
    got = QUERIES["op7_ngram_join"](spark, SF).collect()
    assert {(r.doc_id, r.n_links, r.group_id) for r in got} == {(i, len(links[i]), group[i]) for i in words}
    assert sum(map(len, links.values())) > 0


def test_substring(spark, words):
    holders = defaultdict(set)
    for i, w in words.items():
        for j in range(len(w) - 49):
            holders[tuple(w[j:j + 50])].add(i)
    exact = set().union(*(x for x in holders.values() if len(x) > 1))
    got = QUERIES["op8_substring_dedup"](spark, SF).collect()
    assert exact <= {r.doc_id for r in got}
    for r in got:
        a, b = words[r.doc_id][r.word_start:r.word_end], words[r.other_id][r.other_start:r.other_end]
        assert min(len(a), len(b)) >= 50 and r.doc_id != r.other_id
        assert (r.edits == 0) == (a == b)


def test_decontamination(spark, tables):
    split = lambda t: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    items = {i: split(t) for i, t in tables.sql("SELECT * FROM benchmark").fetchall()}
    exact = set()
    for doc, text in tables.sql("SELECT doc_id, text FROM documents").fetchall():
        joined = f" {' '.join(split(text))} "
        exact |= {(doc, i) for i, w in items.items() if f" {' '.join(w)} " in joined}
    got = {(r.doc_id, r.item_id): r.distance for r in QUERIES["op1_decontamination"](spark, SF).collect()}
    assert exact == {k for k, d in got.items() if d == 0} and exact


def test_html(spark, tables):
    """The generated pages keep their article in one element."""
    import html

    got = {r.page_id: r.text for r in QUERIES["op5_html_text"](spark, SF).collect()}
    for page_id, page in tables.sql("SELECT page_id, html FROM pages").fetchall():
        article = re.search(r"<article>(.*)</article>", page, re.S)
        if article:
            plain = html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", article[1])))
            assert got[page_id] == " ".join(plain.split())


def test_pipeline(spark, tables, words):
    stages, kept = dict(corpus_pipeline.STAGES), {}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        kept[name] = {r.doc_id: r for r in docs.collect()}
        assert name == "tokens" or docs.columns == first
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    judged = {r.doc_id for r in QUERIES["op10_quality_rules"](spark, SF).collect() if r.kept}
    assert set(kept["quality_rules"]) == judged
    own = {i: words[i] for i in judged}
    group = groups(linked(own), own)
    assert set(kept["near_duplicates"]) == {i for i, g in group.items() if i == g}
    leaks = {r.doc_id for r in QUERIES["op1_decontamination"](spark, SF).collect()}
    assert set(kept["decontamination"]) == set(kept["near_duplicates"]) - leaks
    assert set(kept["pseudonyms"]) == set(kept["tokens"]) == set(kept["decontamination"])
    assert all(r.n_chars == len(r.text) for r in kept["pseudonyms"].values())
    assert all(re.sub(r"\S*[0-9@]\S*", "", r.text) == re.sub(r"\S*[0-9@]\S*", "", kept["decontamination"][i].text)
               for i, r in kept["pseudonyms"].items())
    run = {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()}
    assert run == {tuple(r) for r in kept["tokens"].values()}
    assert len(stages) == 5 and not os.path.exists("spark-warehouse")
