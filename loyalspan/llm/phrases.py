"""Phrase collocations by the stripes pattern.

Each prefix (nothing, one, two or three words) keys a stripe: a counter of the words that follow it.
Tasks count their own stripes, stripes of one prefix are merged elementwise, and the merged table gives
all there is to know: its frequent entries are the phrases, the entry of a shorter phrase is the total
of a prefix, and the greatest entries that hold a phrase tell whether a longer one subsumes it.

Texts are read once for each number of words, and a phrase is counted only where both phrases that are
one word shorter are frequent. Which ones are is told by bitmaps of ``SLOTS`` bits by CRC-32, whose
size does not depend on the data. Two phrases that share a bit only let more be counted than needed:
what counts in the end is the exact number of each phrase.

Stripes travel in blocks: a task sends one row for each of ``PARTS`` parts of a language, with all its
stripes of that part, so the rows of a task do not grow with the phrases it meets. The part is told by
the prefix; stripes of prefixes that are met ``HOT`` times or more, and the one without a prefix, are
cut by their next word, so no task has to hold a whole one. Counters of a task are sent on when they
reach ``HELD_ENTRIES`` entries or ``HELD_WORDS`` words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyalspan.llm.ship import let_go, ship
from loyalspan.session import materialise

LEAST = 30
LONGEST = 4
SHARE = 80
TOP = 2000
SLOTS = 1 << 25
BITMAP = 1 << 15  # bits of one row of Spark's bitmap aggregate
STEP = 1_000_003
HOT = 1 << 20
PARTS = 1024
HELD_ENTRIES = 1 << 21
HELD_WORDS = 1 << 20
CHUNK_BYTES = 1 << 21
SENT_ENTRIES = 1 << 18

# What ends a piece, and a byte that no UTF-8 text has.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
END = b"\xff"
TO_END = bytes.maketrans(PIECE_ENDS, END * len(PIECE_ENDS))

BLOCK = "lang string, part int, prefixes array<string>, heads array<int>, nexts array<string>, counts array<long>"


def has_bit(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)


class Numbers(dict):
    """Words by number; number 0 is the end of a piece."""

    def __init__(self):
        super().__init__({END: 0})
        self.words = [END]

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        return number


class Counter:
    """Stripes of one language in one task, for phrases of ``size`` words.

    ``bits`` are the bitmaps (frequent, hot) of the phrases of 1, 2, ... ``size - 1`` words.
    """

    def __init__(self, lang: str, size: int, bits: list[tuple[np.ndarray, np.ndarray]]):
        self.lang, self.size, self.bits = lang, size, bits
        self.start()

    def start(self) -> None:
        self.numbers = Numbers()
        self.crc = np.zeros(1, dtype=np.int64)
        self.frequent = np.zeros(1, dtype=bool)
        self.total = [np.zeros(0, dtype=np.int64)]
        self.seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, text: bytes) -> None:
        tokens = text.lower().translate(TO_END).replace(END, b" \xff ").split()
        ids = np.fromiter(map(self.numbers.__getitem__, tokens), np.int64, len(tokens))
        known = len(self.crc)
        if known < len(self.numbers.words):
            seed = zlib.crc32(self.lang.encode() + b"\0")
            fresh = np.array([zlib.crc32(word, seed) for word in self.numbers.words[known:]], dtype=np.int64)
            self.crc = np.append(self.crc, fresh)
            if self.size > 1:
                self.frequent = np.append(self.frequent, has_bit(self.bits[0][0], fresh % SLOTS))
        if self.size == 1:
            self.total.append(np.bincount(ids, minlength=len(self.numbers.words)))
            if len(self.total) > 16:
                self.total = [self.counts()]
            return
        at = np.flatnonzero(self.frequent[ids])
        for width in range(1, self.size):
            # Places where a frequent phrase of this width starts, and another one at the next word.
            at = at[:-1][at[1:] == at[:-1] + 1]
            if width + 1 < self.size:
                slots = self.slots([ids[at + i] for i in range(width + 1)])
                at = at[has_bit(self.bits[width][0], slots)]
        words = [ids[at + i] if i < self.size else np.zeros_like(at) for i in range(4)]
        self.seen.append((words[0] << 32 | words[1], words[2] << 32 | words[3], np.ones_like(at)))
        self.held += len(at)
        if self.held > 3 * HELD_ENTRIES // 2:
            self.merge()

    def slots(self, words: list[np.ndarray]) -> np.ndarray:
        """The bit of each phrase, given the numbers of its words."""
        slot = np.zeros_like(words[0])
        for word in words:
            slot = (slot * STEP + self.crc[word]) % SLOTS
        return slot

    def counts(self) -> np.ndarray:
        total = np.zeros(len(self.numbers.words), dtype=np.int64)
        for part in self.total:
            total[: len(part)] += part
        return total

    def merge(self) -> None:
        if not self.seen:
            return
        high, low, times = (np.concatenate(column) for column in zip(*self.seen))
        order = np.argsort(high, kind="stable") if self.size <= 2 else np.lexsort((low, high))
        high, low, times = high[order], low[order], times[order]
        new = (np.diff(high, prepend=-1) != 0) | (np.diff(low, prepend=-1) != 0)
        starts = np.flatnonzero(new)
        times = np.add.reduceat(times, starts) if len(starts) else times
        self.seen = [(high[starts], low[starts], times)]
        self.held = len(starts)

    def full(self) -> bool:
        if self.held > HELD_ENTRIES:
            self.merge()
        return self.held > HELD_ENTRIES or len(self.numbers.words) > HELD_WORDS

    def stripes(self) -> Iterator[pa.RecordBatch]:
        """What was counted, as stripes ordered by part; then counting starts again."""
        names = pa.array(self.numbers.words, pa.binary())
        if self.size == 1:
            counts = self.counts()
            nexts = np.flatnonzero(counts)
            nexts = nexts[nexts > 0]
            yield from self._rows(names, np.zeros((len(nexts), 3), np.int64), nexts, counts[nexts])
        else:
            self.merge()
            for high, low, times in self.seen:
                words = [high >> 32, high & 0xFFFFFFFF, low >> 32, low & 0xFFFFFFFF]
                prefix = np.stack([x if i < self.size - 1 else np.zeros_like(x) for i, x in enumerate(words[:3])], axis=1)
                yield from self._rows(names, prefix, words[self.size - 1], times)
        self.start()

    def _parts(self, prefix: np.ndarray, nexts: np.ndarray) -> np.ndarray:
        parts = (self.crc % PARTS).astype(np.int32)[nexts]
        if self.size > 1:
            slots = self.slots(list(prefix.T[: self.size - 1]))
            cold = ~has_bit(self.bits[-1][1], slots)
            parts[cold] = slots[cold] % PARTS
        return parts

    def _rows(self, words: pa.Array, prefix: np.ndarray, nexts: np.ndarray, times: np.ndarray):
        part = self._parts(prefix, nexts)
        order = np.argsort(part, kind="stable")  # by prefix they are in order already
        prefix, part, nexts, times = prefix[order], part[order], nexts[order], times[order]
        new = np.diff(part, prepend=-1) != 0
        for column in prefix.T:
            new |= np.diff(column, prepend=-1) != 0
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(part))
        first = 0
        while first < len(starts):
            last = max(first + 1, int(np.searchsorted(ends, starts[first] + SENT_ENTRIES, "right")))
            begin, end = starts[first], ends[last - 1]
            offsets = pa.array(np.append(starts[first:last], end) - begin, pa.int32())
            spelled = words.take(pa.array(nexts[begin:end])).cast(pa.string())
            heads = prefix[starts[first:last]].tolist()
            names = self.numbers.words
            text = [b" ".join(names[i] for i in head if i).decode() for head in heads]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([self.lang] * (last - first)),
                    pa.array(text, pa.string()),
                    pa.array(part[starts[first:last]]),
                    pa.ListArray.from_arrays(offsets, spelled),
                    pa.ListArray.from_arrays(offsets, pa.array(times[begin:end])),
                ],
                ["lang", "prefix", "part", "nexts", "counts"],
            )
            first = last


def in_blocks(stripes: pa.RecordBatch) -> pa.RecordBatch:
    """Stripes of one language, ordered by part, as one row a part; ``heads`` number an entry's prefix."""
    part = stripes.column("part").to_numpy()
    first = np.flatnonzero(np.diff(part, prepend=-1))
    block = np.append(first, len(part))
    ends = stripes.column("nexts").offsets.to_numpy()
    within = np.arange(len(part)) - np.repeat(first, np.diff(block))
    held = {
        "prefixes": (block, stripes.column("prefix")),
        "heads": (ends[block], pa.array(np.repeat(within, np.diff(ends)), pa.int32())),
        "nexts": (ends[block], stripes.column("nexts").values),
        "counts": (ends[block], stripes.column("counts").values),
    }
    lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), values) for at, values in held.values()]
    keys = [stripes.column(name).take(pa.array(first)) for name in ("lang", "part")]
    return pa.RecordBatch.from_arrays([*keys, *lists], ["lang", "part", *held])


def _count(size: int, shared: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        bits = [tuple(np.frombuffer(x, np.uint8) for x in pair.value) for pair in shared]
        counters: dict[str, Counter] = {}
        for batch in batches:
            waiting: dict[str, tuple[list[bytes], int]] = {}
            rows = zip(batch.column("__lang"), batch.column("__text"))
            for lang, text in (*((x.as_py(), y.as_py()) for x, y in rows), *((None, None),)):
                ready = []
                if lang is None:  # the end of the batch
                    ready = [(name, texts) for name, (texts, _) in waiting.items()]
                elif text:
                    texts, held = waiting.get(lang, ([], 0))
                    texts.append(text)
                    waiting[lang] = texts, held + len(text)
                    if held + len(text) >= CHUNK_BYTES:
                        ready = [(lang, texts)]
                        del waiting[lang]
                for name, texts in ready:
                    if name not in counters:
                        counters[name] = Counter(name, size, bits)
                    counters[name].add(END.join(texts) + END)
                    if counters[name].full():
                        yield from map(in_blocks, counters[name].stripes())
        for counter in counters.values():
            yield from map(in_blocks, counter.stripes())

    return run


def merged(texts: DataFrame, size: int, shared: list) -> DataFrame:
    """(lang, prefix, next, f): the entries of all stripes of one pass over (__lang, __text)."""
    blocks = texts.mapInArrow(_count(size, shared), BLOCK)
    # Dealt as blocks, so a prefix travels once; their entries are then added up where they are.
    placed = blocks.repartition("lang", "part")
    entries = placed.select("lang", "part", "prefixes", F.inline(F.arrays_zip("heads", "nexts", "counts")))
    entries = entries.select(
        "lang", "part", F.get("prefixes", "heads").alias("prefix"), F.col("nexts").alias("next"), "counts"
    )
    return entries.groupBy("lang", "part", "prefix", "next").agg(F.sum("counts").alias("f")).drop("part")


def _bits(rows: DataFrame) -> bytes:
    """A bitmap of ``SLOTS`` bits for the phrases of ``rows``; 4 MB at most reach the driver."""

    def fold(slot: Column, word: Column) -> Column:
        crc = F.crc32(F.concat(F.col("lang"), F.lit("\0"), word).cast("binary"))
        return (slot * STEP + crc) % SLOTS

    slots = rows.select(F.aggregate(F.split("phrase", " "), F.lit(0).cast("long"), fold).alias("slot"))
    maps = slots.groupBy(F.expr(f"slot div {BITMAP}").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("slot") % BITMAP).alias("bits")
    )
    whole = bytearray(SLOTS // 8)
    for row in maps.collect():
        begin = row.bucket * BITMAP // 8
        whole[begin : begin + BITMAP // 8] = row.bits
    return bytes(whole)


def frequent_phrases(
    df: DataFrame, least: int = LEAST, longest: int = LONGEST, lang: str = "lang", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of phrases met ``least`` times or more, and (lang, n): all words.

    Phrases have one to ``longest`` (2 to 4) words, joined by one space, within a piece.
    """
    if not 2 <= longest <= 4:
        raise ValueError("phrases have two to four words")
    spark = df.sparkSession
    ship(spark)
    texts = df.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("__lang"), F.col(text).cast("binary").alias("__text")
    )
    words = materialise(merged(texts, 1, []).select("lang", F.col("next").alias("phrase"), "f"))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    level = words.where(F.col("f") >= least)
    found, shared = level.withColumn("size", F.lit(1)), []
    for size in range(2, longest + 1):
        hot = level.where(F.col("f") >= HOT)
        shared.append(spark.sparkContext.broadcast((_bits(level), _bits(hot))))
        entries = merged(texts, size, list(shared)).where(F.col("f") >= least)
        level = materialise(entries.select("lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), "f"))
        found = found.unionByName(level.withColumn("size", F.lit(size)))
    return found, totals


def collocations(
    df: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    share: int = SHARE,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words or more that stand for themselves.

    Texts are lower-cased (A-Z only) and cut into pieces at ``. , ; : ! ?`` and line ends, and these into
    words at blanks and tabs. a, l and r count the phrase and both sides of its weakest cut, all
    occurrences included; ``score = floor(2000000 a / (l + r))`` is the least over all cuts, the first
    of equal ones. A phrase is left out if a longer frequent one around it has ``share`` per cent of
    its occurrences or more.

    A null text is empty, a null language is ``und``. Repeated rows count as often as they occur; other
    columns, and ids, are not looked at. A table without frequent phrases gives an empty result.
    """
    found, totals = frequent_phrases(df, least, longest, lang, text)
    known = materialise(found)
    phrases = known.where("size > 1").withColumn("words", F.split("phrase", " "))

    # Both sides of every cut, and all that lies inside a longer phrase, are frequent themselves.
    cuts = phrases.select("lang", "phrase", "f", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    sides = cuts.select(
        "lang", "phrase", "f", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("rest"),
    )
    left = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = sides.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr("cast(2000000 as decimal(8,0)) * cast(f as decimal(20,0)) div (cast(l as decimal(20,0)) + r)")
    weakest = scored.groupBy("lang", "phrase", F.col("f").alias("a")).agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    )

    places = phrases.where("size > 2").select(
        "lang", "f", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("width")
    )
    places = places.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)).alias("at"))
    inside = places.select(
        "lang", F.array_join(F.slice("words", F.col("at"), F.col("width")), " ").alias("phrase"), "f"
    )
    around = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    subsumed = F.coalesce(100 * F.col("longer") >= share * F.col("a"), F.lit(False))
    free = weakest.join(around, ["lang", "phrase"], "left").where(~subsumed)
    return free.join(totals, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def best(df: DataFrame, top: int = TOP, **options) -> DataFrame:
    """The ``top`` collocations of each language, with their rank: by score, count, phrase (bytes)."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = collocations(df, **options).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
