"""One query per operator, over whole tables; each takes (spark, folder of the tables)."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspan.llm import bpe, chat, exact_dedup, forest, kdtree, licenses, mixing, phrases, pii, repeats, sharding, simhash, toxicity
from loyalspan.llm.tables import documents
from loyalspan.session import materialise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    tree = sharding.HashTree.even(regions=2, racks=2, shards=2)
    return sharding.shard_table(documents(spark, folder), tree, tree.with_region())


@query
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    texts = documents(spark, folder).select("doc_id", "text")
    digests = bpe.digests(bpe.round_trip(texts, vocabulary, public_tokenizers.PATTERN))
    return digests.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op3_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    points = materialise(kdtree.prepare(vectors, "vec_id", "embedding", factor=256))
    queries = points.where(F.col("vec_id") % 50 == 0)
    return kdtree.top_k(kdtree.build(points), queries, k=5)


@query
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.decisions(documents(spark, folder))


@query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.take_words(documents(spark, folder))


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op6_chat_rotation(spark: SparkSession, folder: str) -> DataFrame:
    rows = chat.rotate(spark.read.parquet(f"{folder}/conversations.parquet"))
    spans = F.transform("masks", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string")))
    return rows.withColumn("masks", F.array_join(spans, ","))


@query
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(documents(spark, folder))
    spans = F.transform(
        "licenses",
        lambda n: F.concat_ws(":", n["license"], n["start"].cast("string"), n["end"].cast("string")),
    )
    names = F.array_sort(F.array_distinct(F.transform("licenses", lambda n: n["license"])))
    return found.select(
        "doc_id", F.array_join(names, ",").alias("names"), F.array_join(spans, ",").alias("spans")
    )


@query
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, folder), shingle=3)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", digits, "component_id")


@query
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(documents(spark, folder), pii.fit(pii.labelled_table(spark)))
    kinds = F.transform("base", lambda s: s["kind"])
    return found.select(
        "doc_id",
        *[
            (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
            for kind in pii.KINDS
        ],
        F.sha2(pii.joined("base"), 256).alias("base_sha256"),
        pii.joined("spans").alias("spans"),
    )


def planted_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """In one document of ten, by the digest of its id, the words from some place on are periodic."""
    digest = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    size = len(words)
    if digest % 10 or not size:
        return words
    first = digest // 10 % size
    period = 1 + (size - first) // (3 + digest // 10 % 8)
    times, rest = divmod(size - first, period)
    block = words[first : first + period]
    return words[:first] + block * times + block[:rest]


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.find_runs(documents(spark, folder), rewrite=planted_repeats)
    line = F.transform(
        "runs", lambda r: F.concat_ws(",", *[r[name].cast("string") for name in ("start", "length", "period")])
    )
    text = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    longest = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")),
        )
    )
    best = found.withColumn("best", longest)
    length, period = F.col("best")["length"], -F.col("best")["period"]
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best")["start"]).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    found = phrases.best(documents(spark, folder))
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


@query
def op13_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return forest.near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))
