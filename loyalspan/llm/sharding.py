"""Sharding by a hierarchical weighted hash tree.

Regions hold racks and racks hold shards; the weight of an inner node is the sum of its shards'.
A row descends from the root: at each level every child draws ``-ln(u) / weight``, ``u`` hashed from
the row's key and the child's name, and the smallest draw wins. A child is so taken in proportion to
its weight, and a draw depends on nothing but key, name and weight. When weights change, only rows
whose winner changes at some level move, and they move into subtrees whose weight grew or out of
subtrees whose weight fell; inside a subtree without changes nothing moves. A new shard that opens a
region of its own takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyalspan.llm.tables import fraction, hex_bucket, row_key
from loyalspan.session import materialise

SLOT_DIGITS = 2


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


@dataclass(frozen=True)
class HashTree:
    leaves: tuple[Leaf, ...]

    @classmethod
    def even(cls, regions: int = 2, racks: int = 2, shards: int = 2) -> HashTree:
        """``regions * racks * shards`` shards of weight 1, numbered through."""
        places = [(g, r) for g in range(regions) for r in range(racks) for _ in range(shards)]
        return cls(tuple(Leaf(g, r, i) for i, (g, r) in enumerate(places)))

    def with_region(self, weight: float = 1.0) -> HashTree:
        """One more shard, in a region of its own."""
        region = max((leaf.region for leaf in self.leaves), default=-1) + 1
        shard = max((leaf.shard for leaf in self.leaves), default=-1) + 1
        return HashTree((*self.leaves, Leaf(region, 0, shard, weight)))

    def with_weight(self, shard: int, weight: float) -> HashTree:
        return HashTree(
            tuple(
                Leaf(x.region, x.rack, x.shard, weight if x.shard == shard else x.weight)
                for x in self.leaves
            )
        )

    def shard_of(self, key: Column) -> Column:
        """The shard of a non-null string key."""
        return self._descend(key, self.leaves, 0)

    def _descend(self, key: Column, leaves: tuple[Leaf, ...], level: int) -> Column:
        if level == 3:
            return F.lit(leaves[0].shard)
        children: dict[str, list[Leaf]] = {}
        for leaf in leaves:
            path = (leaf.region, leaf.rack, leaf.shard)[: level + 1]
            children.setdefault("/".join(map(str, path)), []).append(leaf)
        if len(children) == 1:
            return self._descend(key, leaves, level + 1)
        draws = [
            F.struct(
                (-F.log(fraction(name, key)) / F.lit(sum(x.weight for x in below))).alias("draw"),
                F.lit(number).alias("child"),
            )
            for number, (name, below) in enumerate(children.items())
        ]
        winner = F.least(*draws)["child"]
        chosen = None
        for number, below in enumerate(children.values()):
            inner = self._descend(key, tuple(below), level + 1)
            test = winner == number
            chosen = F.when(test, inner) if chosen is None else chosen.when(test, inner)
        return chosen


def place(
    df: DataFrame, tree: HashTree, to: str = "shard", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Adds the shard of every row; a column of that name is replaced.

    The id and the tree decide. Rows without an id are placed by their text (null as empty), so
    that many of them still spread. Texts of any length and empty tables need no special case.
    """
    return df.withColumn(to, tree.shard_of(row_key(F.col(doc_id), F.col(text))))


def number_slots(
    df: DataFrame, shard: str, bucket: str, order: list[str], to: str = "slot"
) -> DataFrame:
    """Numbers the rows of each shard from 0 without gaps.

    A shard is numbered in many tasks: rows are numbered within (shard, bucket), and each bucket
    begins where the counts of the shard's earlier buckets end. ``df`` is read twice. Rows that are
    equal in ``order`` may swap their numbers.
    """
    counts = df.groupBy(shard, bucket).agg(F.count("*").alias("__rows"))
    before = Window.partitionBy(shard).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    starts = counts.select(
        shard, bucket, (F.sum("__rows").over(before) - F.col("__rows")).alias("__start")
    )
    inner = Window.partitionBy(shard, bucket).orderBy(*order)
    numbered = df.withColumn("__rank", F.row_number().over(inner)).join(starts, [shard, bucket])
    return numbered.withColumn(to, F.col("__start") + F.col("__rank") - 1).drop(
        "__start", "__rank"
    )


def shard_table(
    df: DataFrame, tree: HashTree, grown: HashTree, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``df``: its shard, its slot there, and its shard in a grown tree.

    Columns: doc_id, size (UTF-8 bytes plus one; a null text has none), text_crc32 (a null text as
    an empty one), law, shard, slot, grown_shard. Repeated rows each get a slot of their own.
    """
    key = row_key(F.col(doc_id), F.col(text))
    narrow = df.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
        F.lit("key").alias("law"),
        key.alias("__key"),
    )
    placed = materialise(
        narrow.withColumn("shard", tree.shard_of(F.col("__key")))
        .withColumn("grown_shard", grown.shard_of(F.col("__key")))
        .withColumn("__bucket", hex_bucket("slot", F.col("__key"), SLOT_DIGITS))
        .drop("__key")
    )
    order = ["doc_id", "text_crc32", "size"]
    return number_slots(placed, "shard", "__bucket", order).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
