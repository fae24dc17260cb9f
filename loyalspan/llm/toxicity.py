"""Toxicity scores by gradient-boosted trees over dense features.

The features are densities of two lexicons (a fixed one, and one learned from labelled rows), how
near the hits are to a second-person word, and rates of capitals, punctuation and obfuscated words.
The margin of the trees is calibrated by isotonic regression on labelled rows the trees did not see.

The model is fitted on a bounded sample of labelled rows: at most ``TOXIC_ROWS`` and ``CLEAN_ROWS``,
those whose ids hash lowest. Its learned lexicon is cross-fitted: the terms used on one half of the
sample are counted on the other, so that the trees see hits as they are on new texts. A term counts
once per group of near copies. Scoring reads every whole text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loyalspan.llm.boosting import BoostedTrees, Isotonic
from loyalspan.llm.ship import let_go, ship
from loyalspan.session import materialise, spread

TOXIC_ROWS = 2000
CLEAN_ROWS = 6000
TERMS = 20_000
FOLDS = 5
LEAST_GROUPS = 3
LEAST_ODDS = 2.0
ROWS = 256
WORDS_KEPT = 300_000

# Common insults and second-person words of the four languages.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers pathetic worthless trash scum clown "
    "disgusting garbage imbecile fool filthy "
    "dumm dummkopf trottel abschaum wertlos ekelhaft versager arschloch "
    "idiote stupide imbécile connard ordure minable débile "
    "idiota estúpido estúpida imbécil basura inútil asqueroso payaso".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre "
    "tú ti usted ustedes vosotros tus".split()
)
LEET = str.maketrans("013457@$", "oieastas", "*._-")
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "@$") + "¿¡«»“”„’…"
STEMS = (4, 5, 6)
FEATURES = 15


def clean_word(token: str) -> str:
    """Lower case, without punctuation around it and with look-alike characters undone."""
    word = token.strip(EDGES).lower()
    return word if word.isalpha() or not any(map(str.isalpha, word)) else word.translate(LEET)


def terms_of(word: str) -> list[str]:
    """The terms that a word can hit: itself, and its beginnings."""
    if len(word) < 3 or not word.isalpha():
        return []
    return [word, *[word[:n] + "*" for n in STEMS if len(word) > n]]


@dataclass
class Model:
    """Terms with their weights (of the whole sample, and of each half), trees, calibration."""

    terms: dict[str, float] = field(default_factory=dict)
    half: tuple[dict[str, float], dict[str, float]] = field(default_factory=lambda: ({}, {}))
    trees: BoostedTrees = field(default_factory=BoostedTrees)
    calibration: Isotonic | None = None
    constant: float = 0.0  # the score where labels of both kinds are missing


class Reader:
    """Features of texts; keeps the weights of words it has met."""

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.known: dict[str, tuple[float, bool, bool]] = {}

    def _look(self, token: str) -> tuple[float, bool, bool]:
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        word = clean_word(token)
        weight = max([0.0, *(self.terms.get(t, 0.0) for t in terms_of(word))])
        found = (weight, word in INSULTS, word in SECOND_PERSON)
        self.known[token] = found if any(found) else None
        return self.known[token]

    def features(self, text: str) -> list[float]:
        tokens = text.split()
        known, look = self.known, self._look
        hits, fixed, second, weights = [], 0, [], {}
        for i, token in enumerate(tokens):
            found = known[token] if token in known else look(token)
            if found:
                weight, insult, person = found
                if weight:
                    weights[token] = weight
                if weight or insult:
                    hits.append(i)
                fixed += insult
                if person:
                    second.append(i)
        near = 0.0
        if hits and second:
            a, b = np.array(hits), np.array(second)
            at = np.searchsorted(b, a)
            gap = np.minimum(np.abs(a - b[np.maximum(at - 1, 0)]), np.abs(a - b[np.minimum(at, len(b) - 1)]))
            near = float((1.0 / (1.0 + gap)).sum())
        words = len(tokens) or 1
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        counts = np.bincount(raw, minlength=256) if len(raw) else np.zeros(256)
        chars = max(len(raw), 1)
        upper = counts[65:91].sum()
        letters = upper + counts[97:123].sum() + 1
        odd = sum(1 for t in set(tokens) if not t.isalpha() and clean_word(t).isalpha() and not t.strip(EDGES).isalpha())
        marks = counts[[33, 63]].sum()
        strongest = sorted(weights.values())[-3:]
        return [
            len(hits) / words,
            sum(weights.values()) / words,
            sum(weights.values()),
            strongest[-1] if strongest else 0.0,
            sum(strongest),
            float(len(weights)),
            fixed / words,
            near / words,
            near,
            len(second) / words,
            upper / letters,
            marks / chars,
            (counts[33:48].sum() + counts[58:65].sum()) / chars,
            odd / words,
            float(np.log1p(words)),
        ]


def group_of(words: set[str]) -> int:
    """The three smallest hashes of the longer words: mostly the same for near copies, different for
    other texts."""
    long = [w for w in words if len(w) > 5] or words
    low = sorted(zlib.crc32(w.encode()) for w in long)[:3]
    return zlib.crc32(repr(low).encode())


def held_out(doc_id: Column) -> Column:
    """Rows that never teach: CRC-32 of the id as text is a multiple of ``FOLDS``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, part): the bounded sample of labelled rows that may teach.

    An id with several labels has the highest, one with several texts the text that hashes lowest.
    ``part`` 0 and 1 are the halves that teach the trees, 2 the rows for calibration.
    """
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = None
    for toxic, most in ((1, TOXIC_ROWS), (0, CLEAN_ROWS)):
        rows = marks.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        drawn = rows if drawn is None else drawn.unionByName(rows)
    part = F.element_at(
        F.array(*map(F.lit, (0, 0, 1, 1, 2))), (F.pmod(F.xxhash64("__id", F.lit("part")), F.lit(5)) + 1).cast("int")
    )
    drawn = drawn.select(F.col("doc_id").alias("__id"), "toxic", part.alias("part"))
    # At most TOXIC_ROWS + CLEAN_ROWS rows of three numbers are broadcast.
    texts = docs.select(F.col("doc_id").cast("long").alias("__doc"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(F.broadcast(drawn), F.col("__doc") == F.col("__id"))
    # Of an id that repeats one text stays, or the sample would have no bound.
    one = F.min_by("text", F.struct(F.xxhash64("text"), "text"))
    return texts.groupBy("__id", "toxic", "part").agg(one.alias("text")).select("text", "toxic", "part")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sample rows with ``copies``, the number of their group of near copies."""
    let_go()
    for batch in batches:
        groups = [group_of({clean_word(t) for t in text.as_py().split()}) for text in batch.column("text")]
        columns = [*map(batch.column, ("text", "toxic", "part")), pa.array(groups, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["text", "toxic", "part", "copies"])


def _count_terms(wanted: frozenset[str] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        counts: Counter[tuple[str, int]] = Counter()
        for batch in batches:
            for text, part in zip(batch.column("text"), batch.column("part").to_pylist()):
                words = {clean_word(t) for t in text.as_py().split()}
                terms = {t for w in words for t in terms_of(w)}
                counts.update((t, part) for t in (terms if wanted is None else terms & wanted))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.int32()),
                pa.array([counts[k] for k in keys], pa.int64()),
            ],
            ["term", "part", "texts"],
        )

    return run


def _counted(rows: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    counted = rows.select("text", "part").mapInArrow(_count_terms(wanted), "term string, part int, texts long")
    return counted.groupBy("term").agg(
        *[F.sum(F.when(F.col("part") == p, F.col("texts")).otherwise(0)).alias(f"n{p}") for p in (0, 1)]
    )


def _weights(toxic: dict, clean: dict, sizes, parts) -> dict[str, float]:
    """Log odds of the terms that mark toxic texts in these parts, times the root of their support."""
    n1, n0 = (sum(s[p] for p in parts) for s in sizes)
    chosen = {}
    for term, row in toxic.items():
        a = sum(row[p] for p in parts)
        c = sum(clean.get(term, (0, 0))[p] for p in parts)
        odds = np.log((a + 0.5) / (n1 + 1.0)) - np.log((c + 0.5) / (n0 + 1.0))
        if a >= LEAST_GROUPS and odds >= LEAST_ODDS:
            chosen[term] = float(odds * np.sqrt(a))
    return chosen


def _features(halves: tuple[dict[str, float], ...]):
    """Features of sample rows: each part is read with the terms counted on the other parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        readers = [Reader(terms) for terms in halves]
        for batch in batches:
            parts = batch.column("part").to_pylist()
            rows = [readers[p].features(t.as_py()) for t, p in zip(batch.column("text"), parts)]
            column = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [column, batch.column("toxic"), batch.column("part")], ["x", "toxic", "part"]
            )

    return run


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model; without rows of both labels it scores every text the share of toxic labels."""
    ship(docs.sparkSession)
    sample = labelled_sample(docs, labels).select(
        "text", F.col("toxic").cast("int").alias("toxic"), F.col("part").cast("int").alias("part")
    )
    # The sample is bounded: cheap to deal out evenly, whatever tasks it was found in.
    sample = materialise(
        spread(sample).mapInArrow(_grouped, "text string, toxic int, part int, copies long")
    )
    sizes = {(r["toxic"], r["part"]): r["count"] for r in sample.groupBy("toxic", "part").count().collect()}
    of = [[sizes.get((label, p), 0) for p in (0, 1)] for label in (1, 0)]
    if min(sum(of[0]), sum(of[1])) == 0:
        return Model(constant=float(sum(of[0]) > 0))
    one = F.min_by("text", F.struct(F.xxhash64("text"), "text"))
    teachers = sample.where("part < 2").groupBy("toxic", "part", "copies").agg(one.alias("text"))
    candidates = (
        _counted(teachers.where("toxic = 1"), None)
        .where(F.col("n0") + F.col("n1") >= LEAST_GROUPS)
        .orderBy(F.desc(F.col("n0") + F.col("n1")), "term")
        .limit(TERMS)
    )
    toxic = {r["term"]: (r["n0"], r["n1"]) for r in candidates.collect()}
    clean = _counted(teachers.where("toxic = 0"), frozenset(toxic)).collect()
    clean = {r["term"]: (r["n0"], r["n1"]) for r in clean}
    # Parts 0 and 1 are read with each other's terms, the calibration rows with all.
    weights = [_weights(toxic, clean, of, parts) for parts in ((1,), (0,), (0, 1))]
    # Half the support: bring the halves' weights to the scale of the whole.
    halves = tuple({t: w * np.sqrt(2.0) for t, w in half.items()} for half in weights[:2])
    rows = sample.mapInArrow(_features((*halves, weights[2])), "x array<double>, toxic int, part int").collect()
    x = np.array([r["x"] for r in rows])
    y = np.array([r["toxic"] for r in rows], dtype=float)
    part = np.array([r["part"] for r in rows])
    order = np.lexsort((*x.T[::-1], y, part))  # the rows come in any order
    x, y, part = x[order], y[order], part[order]
    trees = BoostedTrees().fit(x[part < 2], y[part < 2])
    # Too few rows to calibrate on: use all.
    last = part == 2 if min((y[part == 2] == v).sum() for v in (0, 1)) >= 5 else part >= 0
    calibration = Isotonic.fit(trees.margin(x[last]), y[last])
    return Model(weights[2], halves, trees, calibration)


def score(df: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """Adds the score (0 to 1) of every row; a column of that name is replaced.

    A null or empty text is scored like any other, from its zero features.
    """
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most TERMS terms and the trees
    kept = [f for f in df.schema if f.name.lower() != to.lower()]
    schema = T.StructType([*kept, T.StructField(to, T.DoubleType())])
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        fitted = shared.value
        reader = Reader(fitted.terms)
        for whole in batches:
            for begin in range(0, whole.num_rows, ROWS):
                batch = whole.slice(begin, ROWS)
                if fitted.calibration is None:
                    values = np.full(batch.num_rows, fitted.constant)
                else:
                    x = np.array([reader.features(t.as_py() or "") for t in batch.column(text)])
                    values = fitted.calibration(fitted.trees.margin(x.reshape(-1, FEATURES)))
                yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(values)], schema.names)

    return df.mapInArrow(run, schema)


def keep_clean(df: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows that score below ``threshold``, with the columns of ``df``."""
    return score(df, model, to="__score").where(F.col("__score") < threshold).drop("__score")
