"""SimHash near-duplicates by Golay-code fuzzy hashing.

Documents get a 64-bit fingerprint of their word shingles; documents whose fingerprints differ in at
most two bits are linked, and linked documents form a component.

Only distinct fingerprints are compared, so exact copies cost nothing. A fingerprint is cut into
three segments, each padded to a word of the Golay code. Of two differing bits at most two segments
are touched, so, in cyclic order, one of three pairs has an equal first and an at most one-bit
different second segment. The equal segment together with a Golay index of the other is the key:
about 35 bits, and about sixteen keys a fingerprint. Fingerprints that share a key are joined and
verified on all 64 bits.

Keys shared by more than ``CROWD`` fingerprints are not joined pair by pair. There the links are found
through their midpoints: fingerprints within one bit of the same word are linked to each other, two
linked ones have such a word, and a word has at most 65 of them, which are tied to their smallest
instead of to each other. That is exact, and its work grows with the number of fingerprints.

Components come from alternating large-star and small-star steps on written tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loyalspan.llm import golay
from loyalspan.llm.ship import let_go, ship
from loyalspan.session import materialise

SHINGLE = 3
DISTANCE = 2
SEED = 42
CROWD = 16
CUTS = ((0, 22), (22, 21), (43, 21))  # first bit and width of the segments
CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a UTF-8 text."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII white-space bytes
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
        total = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        total = len(words) - shingle + 1
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for begin in range(0, total, CHUNK):
        size = min(CHUNK, total - begin)
        hashes = np.fromiter((digest(next(grams), SEED) for _ in range(size)), np.uint64, size)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            texts = batch.column("__text")
            values = np.fromiter(
                (fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts)
            )
            column = pa.array(values.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column], ["doc_id", "fp"])

    return run


def fingerprints(df: DataFrame, shingle: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, fp): one row per row of ``df``, the fingerprint as a signed long."""
    return df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("__text")
    ).mapInArrow(_fingerprints(shingle), "doc_id long, fp long")


def segment_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row number, key) of every distinct key of the fingerprints ``values`` (unsigned)."""
    rows, found = [], []
    segments = [
        (values >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64)
        for low, width in CUTS
    ]
    for pair in range(len(CUTS)):
        index = np.sort(golay.keys(segments[(pair + 1) % len(CUTS)]), axis=1)
        new = np.ones_like(index, dtype=bool)
        new[:, 1:] = index[:, 1:] != index[:, :-1]
        row, column = np.nonzero(new)
        rows.append(row)
        equal = (np.int64(pair) << 22 | segments[pair]) << golay.DATA
        found.append(equal[row] | index[row, column])
    return np.concatenate(rows), np.concatenate(found)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column("fp").to_numpy(zero_copy_only=False)
        row, key = segment_keys(values.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(values[row])], ["key", "fp"])


def _emit_midpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.array([0, *(1 << i for i in range(64))], dtype=np.uint64)
    for batch in batches:
        values = batch.column("fp").to_numpy(zero_copy_only=False)
        for begin in range(0, len(values), 4096):
            part = values[begin : begin + 4096]
            words = (part.view(np.uint64)[:, None] ^ flips[None, :]).reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(np.repeat(part, len(flips)))],
                ["middle", "fp"],
            )


def links(nodes: DataFrame) -> DataFrame:
    """Links (a, b), a > b, that join what is within two bits: every pair outside crowded keys,
    and enough pairs to connect the same fingerprints inside them. ``nodes``: distinct ``fp``.
    """
    keyed = materialise(nodes.select("fp").mapInArrow(_emit_keys, "key long, fp long"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = materialise(keyed.join(shared, "key"))
    few = shared.where(F.col("members") <= CROWD)
    left = few.select("key", F.col("fp").alias("a"))
    right = few.select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE
    pairs = left.join(right, "key").where((F.col("a") > F.col("b")) & near).select("a", "b")

    crowded = shared.where(F.col("members") > CROWD).select("fp").distinct()
    middles = crowded.mapInArrow(_emit_midpoints, "middle long, fp long")
    balls = middles.groupBy("middle").agg(F.collect_set("fp").alias("ball"))  # 65 at most
    ties = (
        balls.where(F.size("ball") > 1)
        .select(F.array_min("ball").alias("b"), F.explode("ball").alias("a"))
        .where("a > b")
        .select("a", "b")
    )
    return pairs.unionByName(ties).distinct()


def star_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b; a > b) but the roots: root is the smallest
    node that can be reached. Each step writes its table, so none depends on lost executors.
    """

    def state(table: DataFrame):
        mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
        return table.agg(F.count("*"), F.sum(mixed)).first()

    edges = materialise(edges)
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = materialise(large.where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = materialise(small.unionByName(least.select("a", F.col("low").alias("b"))).distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def labelled(df: DataFrame, shingle: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, fp, root, component_id): see :func:`near_duplicates`; ``root`` names the component."""
    ship(df.sparkSession)
    prints = materialise(fingerprints(df, shingle, doc_id, text))
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    stars = materialise(star_components(links(nodes)))
    rooted = nodes.join(stars, nodes["fp"] == stars["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = materialise(rooted)
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(firsts, "root").select("fp", "root", "component_id")
    return prints.join(labels, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicates(
    df: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``df``: doc_id, fp (the fingerprint as a signed long), component_id.

    ``component_id`` is the smallest id that links lead to, the row's own included. Texts without
    words (null, empty, white space) have fingerprint zero and are linked like any other; texts of
    fewer than ``shingle`` words are one shingle. Rows without an id count for links and get the
    component's smallest id, null where the whole component has none. Repeated rows repeat their
    result. Other columns are not looked at.
    """
    return labelled(df, shingle, doc_id, text).select("doc_id", "fp", "component_id")


def dedup(
    df: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One document of each component, with the columns of ``df``: that with the smallest id.

    Where several rows of a component have that id, one of them stays (of the smallest fingerprint). An
    id that stands for texts of different components keeps a row in each of those it is the first of.
    A component of rows without any id keeps one row.
    """
    found = materialise(labelled(df, shingle, doc_id, text))
    firsts = found.where("doc_id = component_id").groupBy("root", F.col("doc_id").alias("__keep"))
    firsts = materialise(firsts.agg(F.min("fp").alias("__print")).drop("root"))
    # Ids are nearly always unique; only for the others the fingerprint has to tell the rows apart.
    shared = found.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__keep")).count().where("count > 1")
    shared = materialise(firsts.join(shared, "__keep", "left_semi"))
    single = firsts.join(shared, "__keep", "left_anti")
    kept = df.join(single, df[doc_id] == F.col("__keep"), "left_semi")
    if shared.take(1):
        several = _with_print(df.join(shared, df[doc_id] == F.col("__keep"), "left_semi"), shingle, text)
        several = several.join(shared, (several[doc_id] == shared["__keep"]) & (several["__fp"] == shared["__print"]))
        once = Window.partitionBy("__keep", "__print").orderBy(*_order(df, doc_id))
        several = several.withColumn("__rank", F.row_number().over(once)).where("__rank = 1")
        kept = kept.select(*df.columns).unionByName(several.select(*df.columns))

    # Components without any id: their fingerprints, one row each.
    nameless = found.where(F.col("component_id").isNull()).select("fp").distinct()
    if not nameless.take(1):
        return kept.select(*df.columns)
    nodes = materialise(nameless)
    stars = star_components(links(nodes))
    heads = nodes.join(stars, nodes["fp"] == stars["node"], "left_anti")
    loose = _with_print(df.where(F.col(doc_id).isNull()), shingle, text)
    loose = loose.join(heads.select(F.col("fp").alias("__fp")), "__fp")
    first = Window.partitionBy("__fp").orderBy(*_order(df, doc_id))
    loose = loose.withColumn("__rank", F.row_number().over(first)).where("__rank = 1")
    return kept.select(*df.columns).unionByName(loose.select(*df.columns))


def _order(df: DataFrame, doc_id: str) -> list:
    names = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType) and f.name != doc_id]
    return [F.col(c) for c in names] or [F.lit(1)]


def _with_print(df: DataFrame, shingle: int, text: str) -> DataFrame:
    """``df`` with its fingerprint as ``__fp``."""

    @F.arrow_udf("long")
    def value(texts: pa.Array) -> pa.Array:
        prints = [fingerprint(t.as_py() or b"", shingle) for t in texts]
        return pa.array(np.array(prints, dtype=np.uint64).view(np.int64))

    return df.withColumn("__fp", value(F.col(text).cast("binary")))
