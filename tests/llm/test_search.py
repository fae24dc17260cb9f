"""KD-tree search, every query against its SQL, and the pipeline."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe

import corpus_pipeline
from checks.compare import canonical, connect
from loyalspan.llm import kdtree, toxicity
from loyalspan.llm.oracles import ORACLES
from loyalspan.llm.queries import QUERIES
from loyalspan.session import materialise
from test_forest import brute
from test_text import brute_print, components

FOLDER = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the document tables")


def brute_top(points, queries, k):
    best = []
    for q, v in queries.items():
        scores = []
        for p, w in points.items():
            if p != q:
                scores.append((-sum(a * b for a, b in zip(v, w)), p))
        best += [(q, rank + 1, p, -s) for rank, (s, p) in enumerate(sorted(scores)[:k])]
    return sorted(best)


def found(frame, query, k=5):
    points = materialise(kdtree.prepare(frame, "vec_id", "embedding"))
    rows = kdtree.top_k(kdtree.build(points), points.where(query), k).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in rows)


VECTORS = "vec_id long, embedding array<float>, score string"


def test_search_over_shards_and_blocks_with_ties(spark, monkeypatch):
    for name, value in (("SHARD_ROWS", 40), ("BLOCK", 7), ("LEAF", 6)):
        monkeypatch.setattr(kdtree, name, value)
    draw = random.Random(7)
    rows = [(i, [draw.choice([-1.0, 0.0, 0.25, 1.5]) for _ in range(5)], "") for i in range(300)]
    rows += [(i, [1.0, 1.0, 0.0, 0.0, 0.0], "") for i in range(300, 380)]  # equal vectors
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v, _ in rows}
    queries = {i: v for i, v in whole.items() if i % 10 == 0}
    assert found(spark.createDataFrame(rows, VECTORS), "vec_id % 10 = 0") == brute_top(whole, queries, 5)


def test_unusable_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], ""),
        (1, None, ""),
        (2, [1.0, nan], ""),
        (3, [inf, 1.0], ""),
        (4, [1.0, None], ""),
        (None, [9.0, 9.0], ""),
        (5, [1.0], ""),
        (6, [], ""),
        (7, [3e30, 1.0], ""),
        (8, [1.0, 2.0], ""),
        (8, [1.0, 2.0], ""),
    ]
    got = found(spark.createDataFrame(rows, VECTORS), "vec_id % 50 = 0")
    assert [(r, i) for _, r, i, _ in got] == [(1, 7), (2, 8), (3, 8), (4, 5), (5, 6)]
    assert got[1][3] == 256 * 256 + 512 * 512
    assert found(spark.createDataFrame([], VECTORS), "vec_id % 50 = 0") == []


def test_rows_that_repeat_an_id(spark):
    rows = [(7, [1.0, 0.0], ""), (7, [0.0, 2.0], ""), (7, [1.0, 0.0], ""), (8, [3.0, 1.0], "")]
    got = found(spark.createDataFrame(rows, VECTORS), "vec_id = 7", k=3)
    one, two, three = 256 * 256, 2 * 256 * 256, 3 * 256 * 256
    assert got == sorted(
        [(7, 1, 8, two), (7, 2, 7, 0), (7, 3, 7, 0)] + 2 * [(7, 1, 8, three), (7, 2, 7, one), (7, 3, 7, 0)]
    )


@tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    ours = QUERIES[name](spark, FOLDER).toPandas()
    theirs = connect(FOLDER).execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


@tables
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op13_near_vectors"}))
def test_other_queries_return_every_document(spark, name):
    rows = QUERIES[name](spark, FOLDER)
    ids = {r.doc_id for r in rows.select("doc_id").collect()}
    assert ids == {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@tables
def test_bpe_query_against_another_encoder(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    other = tiktoken.Encoding(
        "other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={}
    )
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op2_byte_bpe"](spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for row in rows:
        ids = other.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


@tables
def test_vector_query_against_all_pairs(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    wanted = brute([(r.vec_id, list(r.embedding), r.label) for r in rows])
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op13_near_vectors"](spark, FOLDER).collect()}
    assert got == {rows[i].vec_id: value for i, value in wanted.items()}


@tables
def test_simhash_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas()
    prints = {i: brute_print(t) for i, t in zip(docs.doc_id, docs.text)}
    wanted = components(prints)
    for row in QUERIES["op8_simhash"](spark, FOLDER).collect():
        assert row.fingerprint == f"{prints[row.doc_id]:016x}"
        assert row.component_id == wanted[row.doc_id]


@tables
def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    clean = toxicity.score(docs, model).where("score < 0.5").toPandas()

    def lowered(text):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    clean["key"] = clean.text.map(lowered)
    single = clean.sort_values("doc_id").groupby("key").tail(1)
    wanted = components({i: brute_print(t) for i, t in zip(single.doc_id, single.text)})
    left = single[[wanted[i] == i for i in single.doc_id]]
    words = left.assign(size=left.text.str.split().str.len()).groupby("source")["size"].sum()
    rows = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert set(rows.doc_id) <= set(left.doc_id)
    texts = dict(zip(left.doc_id, left.text))
    taken = Counter()
    for row in rows.itertuples():
        assert texts[row.doc_id].startswith(row.text)
        assert row.n_tokens == len(row.tokens)
        assert row.decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, row.tokens)).encode()).hexdigest()
        taken[row.source] += len(row.text.split())
    weight = {s: n % 3 + 1 for n, s in enumerate(sorted(words.index))}
    share = words.sum() / sum(weight.values())
    if all(share * weight[s] <= 3 * words[s] for s in words.index):
        for source in words.index:
            assert taken[source] == pytest.approx(share * weight[source], rel=0.02)
    assert pd.Series(taken).sum() == pytest.approx(words.sum(), rel=0.02)
