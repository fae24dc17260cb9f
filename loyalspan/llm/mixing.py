"""Mixing sources to target weights by Sainte-Laguë apportionment.

1. Every source gets a target in words: its share of all words by weight, at most ``LIMIT`` times
   its own size, the excess shared out again by weight (water-filling, solved in closed form from
   sources sorted by the level at which they fill up).
2. The words are dealt in blocks of ``BLOCK`` words. The blocks go to the sources by the highest
   quotients ``target / (2 s + 1)``, and each source's words to its shards by the same rule with
   the shards' sizes: integer quotas per shard. Who reaches ``LIMIT`` times its own size takes a
   smaller last block and leaves the rest to those with room, so no word of a target is lost.
3. A shard's documents are laid out in seeded order. A quota is taken as whole passes over the
   shard and the first blocks of one more pass.

Highest quotients are found without dealing block by block: what a party gets is off by at most half
a block from its share at the same rate, so only the next few quotients of each party are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyalspan.llm.tables import WORD, hex_bucket, row_key
from loyalspan.session import materialise

BLOCK = 16
LIMIT = 3
SHARD_DIGITS = 2
WEIGHTS = (1, 2, 3)


def deal(
    parties: DataFrame,
    group: list[str],
    weight: str,
    cap: str,
    amount: str,
    order: list[str],
    to: str,
    block: int = BLOCK,
) -> DataFrame:
    """Adds ``to``: the ``amount`` of each group, repeated on every row, dealt to its rows in blocks.

    The next block goes to the highest quotient ``weight / (2 s + 1)`` of the rows that are below
    their ``cap``; it is smaller where the cap or the end of the amount cuts it. So the whole amount
    is dealt, as far as the caps allow. Ties go to the first by ``order``, which has to be numeric
    and, like ``group``, without nulls. A row without weight gets nothing.
    """
    everyone = Window.partitionBy(*group)
    half = block / 2.0
    counts = F.col(weight) > 0
    rated = (
        parties.withColumn("__weight", F.col(weight).cast("double"))
        .withColumn("__cap", F.when(counts, F.col(cap)).otherwise(0).cast("long"))
        .withColumn("__counts", counts.cast("int"))
    )
    # At a rate of r blocks per unit of weight a row has the blocks whose quotient is at least
    # 1 / (2 r): its cap, or weight * r * block within half a block. The rate that deals the amount
    # lies between the rates that would do so with half a block more and half a block less a row.
    rated = rated.withColumn(
        "__low",
        F.try_divide(
            F.col(amount) - half * F.sum("__counts").over(everyone),
            block * F.sum("__weight").over(everyone),
        ),
    ).withColumn("__full", F.try_divide(F.col("__cap") + half, block * F.col("__weight")))
    rising = [F.col("__full").asc_nulls_first(), *[F.col(c).asc() for c in order]]
    falling = [F.col("__full").desc_nulls_last(), *[F.col(c).desc() for c in order]]
    earlier = everyone.orderBy(*rising).rowsBetween(Window.unboundedPreceding, -1)
    later = everyone.orderBy(*falling).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rated = rated.withColumn(
        "__rate",
        F.try_divide(
            F.col(amount)
            - F.coalesce(F.sum("__cap").over(earlier), F.lit(0))
            + half * F.sum("__counts").over(later),
            block * F.sum("__weight").over(later),
        ),
    )
    high = F.max(F.when(F.col("__full") >= F.col("__rate"), F.col("__rate"))).over(everyone)
    # One block more on either side, for rounding. Between them lie a few blocks a row.
    most = F.when(counts, F.ceil(F.col("__cap") / float(block))).otherwise(0).cast("long")
    below = F.floor(F.col("__weight") * F.col("__low") + 0.5).cast("long") - 1
    above = F.floor(F.col("__weight") * F.col("__high") + 0.5).cast("long") + 1
    rated = (
        rated.withColumn("__high", high)
        .withColumn("__most", most)
        .withColumn("__from", F.greatest(F.lit(0), F.least(F.coalesce(below, F.lit(0)), "__most")))
        .withColumn("__to", F.least("__most", F.coalesce(above, "__most")))
        .withColumn("__sure", F.least("__cap", F.col("__from") * block))
        .withColumn("__rest", F.col(amount) - F.sum("__sure").over(everyone))
    )
    tries = rated.where(F.col("__to") > F.col("__from")).withColumn(
        "__block", F.explode(F.sequence(F.col("__from") + 1, F.col("__to")))
    )
    tries = tries.withColumn(
        "__width", F.least(F.lit(block), F.col("__cap") - (F.col("__block") - 1) * block)
    ).withColumn("__quotient", F.col("__weight") / (2.0 * F.col("__block") - 1.0))
    best = everyone.orderBy(F.col("__quotient").desc(), *[F.col(c).asc() for c in order])
    best = best.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.col("__rest") - (F.sum("__width").over(best) - F.col("__width"))
    won = (
        tries.withColumn("__got", F.greatest(F.lit(0), F.least("__width", left)))
        .groupBy(*group, *order)
        .agg(F.sum("__got").cast("long").alias("__won"))
    )
    return rated.join(won, [*group, *order], "left").select(
        *parties.columns, (F.col("__sure") + F.coalesce("__won", F.lit(0))).alias(to)
    )


def sainte_lague(
    parties: DataFrame, group: list[str], weight: str, total: str, seats: str, order: list[str]
) -> DataFrame:
    """Adds ``seats_won``: ``seats`` of each group dealt to its rows by highest quotients, without
    caps. ``total`` is the sum of ``weight`` in the group."""
    return deal(parties, group, weight, seats, seats, order, "seats_won", block=1)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """From (source, source_size): number of the source, weight, total of all sizes, and target.

    Sources are numbered by code point, null last, and weigh ``weights`` in turn. One row per
    source: this is the only step that sorts all sources together.
    """
    by_name = Window.partitionBy("__all").orderBy(F.col("source").asc_nulls_last())
    numbered = (
        sizes.withColumn("__all", F.lit(0))
        .withColumn("number", F.row_number().over(by_name))
        .withColumn(
            "weight",
            F.element_at(
                F.array(*[F.lit(w) for w in weights]),
                ((F.col("number") - 1) % len(weights) + 1).cast("int"),
            ),
        )
        .withColumn("total", F.sum("source_size").over(Window.partitionBy("__all")))
    )
    # A source is full once the level (words per unit of weight) reaches this.
    numbered = numbered.withColumn(
        "__full", LIMIT * F.col("source_size") / F.col("weight").cast("double")
    )
    by_full = Window.partitionBy("__all").orderBy("__full", "number")
    earlier = by_full.rowsBetween(Window.unboundedPreceding, -1)
    later = by_full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = numbered.withColumn(
        "__level",
        (F.col("total") - LIMIT * F.coalesce(F.sum("source_size").over(earlier), F.lit(0)))
        / F.sum("weight").over(later),
    )
    level = F.min(F.when(F.col("__full") >= F.col("__level"), F.struct("__full", "number", "__level")))
    levels = levels.withColumn("__level", level.over(Window.partitionBy("__all"))["__level"])
    target = F.least(
        (LIMIT * F.col("source_size")).cast("double"), F.col("__level") * F.col("weight")
    )
    return levels.select("source", "source_size", "number", "weight", "total", target.alias("target"))


def take_words(
    df: DataFrame,
    seed: str = "mix",
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """How many words the mix takes of every document: one row per row of ``df``.

    Columns: doc_id, size (words; a null text has none), source, source_size, target, taken, and
    those of ``carry``. ``taken`` is at most three times ``size``: whole passes over the document
    and, at the edge of a shard's last block, its first words once more. A null source is a source
    of its own. Documents without an id are ordered by their text; equal rows may swap what is
    taken of them. Without any words nothing is taken.
    """
    key = row_key(F.col(doc_id), F.col(text))
    words = materialise(
        df.select(
            F.col(doc_id).alias("doc_id"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.col(source).alias("source"),
            hex_bucket(f"{seed}/shard", key, SHARD_DIGITS).alias("__shard"),
            F.md5(F.concat(F.lit(f"{seed}/order:"), key)).alias("__order"),
            *carry,
        )
    )
    by_shard = materialise(words.groupBy("source", "__shard").agg(F.sum("size").alias("shard_size")))
    sizes = by_shard.groupBy("source").agg(F.sum("shard_size").alias("source_size"))
    targets = source_targets(sizes)
    blocks = F.floor(F.col("total") / float(BLOCK) + 0.5).cast("long")
    targets = (
        targets.withColumn("__words", blocks * BLOCK)
        .withColumn("__cap_of", LIMIT * F.col("source_size"))
        .withColumn("__all", F.lit(0))
    )
    dealt = deal(targets, ["__all"], "target", "__cap_of", "__words", ["number"], "share")
    dealt = materialise(dealt.drop("__all", "__words", "__cap_of"))
    shards = by_shard.join(
        dealt.withColumnRenamed("source", "__name"), F.col("source").eqNullSafe(F.col("__name"))
    ).drop("__name")
    shards = shards.withColumn("__cap_of", LIMIT * F.col("shard_size"))
    shards = deal(shards, ["number"], "shard_size", "__cap_of", "share", ["__shard"], "quota")
    quotas = shards.select(
        F.col("source").alias("__name"),
        F.col("__shard").alias("__of"),
        "shard_size",
        "source_size",
        "target",
        "quota",
    )
    line = (
        Window.partitionBy("source", "__shard")
        .orderBy("__order", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    laid = words.withColumn("__before", F.sum("size").over(line) - F.col("size"))
    rows = laid.join(
        quotas, F.col("source").eqNullSafe(F.col("__name")) & (F.col("__shard") == F.col("__of"))
    )
    passes = F.when(F.col("shard_size") > 0, F.floor(F.col("quota") / F.col("shard_size"))).otherwise(0)
    rest = F.col("quota") - passes * F.col("shard_size")
    once_more = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("__before")))
    taken = (passes * F.col("size") + once_more).cast("long")
    return rows.select("doc_id", "size", "source", "source_size", "target", taken.alias("taken"), *carry)


def first_words(text: Column, count: Column) -> Column:
    """The beginning of ``text`` up to and with its ``count``-th word, white space as it stands."""
    space = r"[\x20\x09-\x0D]+"
    leads = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    rest = F.element_at(F.split(text, space, (count + leads + 1).cast("int")), -1)
    cut = F.substring(text, F.lit(1), (F.length(text) - F.length(rest)).cast("int"))
    return F.regexp_replace(cut, space + "$", "")


def mix(df: DataFrame, seed: str = "mix") -> DataFrame:
    """The mixed corpus, with the columns of ``df``: a document is repeated once per whole pass,
    and cut after its first words in the last one. Documents of which nothing is taken go.
    """
    columns = df.columns
    held = tuple(c for c in columns if c not in ("doc_id", "source"))
    renamed = df.select(*[F.col(c).alias(c if c in ("doc_id", "source") else f"__in_{c}") for c in columns])
    rows = take_words(
        renamed, seed=seed, text="__in_text", carry=tuple(f"__in_{c}" for c in held)
    ).where("taken > 0")
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    part = (F.col("taken") % F.col("size")).cast("int")
    ends = F.concat(F.array_repeat(F.col("size").cast("int"), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    rows = rows.withColumn("__end", F.explode(ends))
    text = F.when(F.col("__end") == F.col("size"), F.col("__in_text")).otherwise(
        first_words(F.col("__in_text"), F.col("__end"))
    )
    if "n_chars" in held:
        rows = rows.withColumn("__in_n_chars", F.length(text).cast(df.schema["n_chars"].dataType))
    rows = rows.withColumn("__text", text)
    return rows.select(
        *[
            F.col("__text" if c == "text" else c if c in ("doc_id", "source") else f"__in_{c}").alias(c)
            for c in columns
        ]
    )
