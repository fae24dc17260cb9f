"""Runs of repeated words, by an enhanced suffix array.

A run is a stretch of words with smallest period q that is at least ``exponent`` periods long and that
no neighbouring word extends. Documents are searched in chunks of words; no suffix of one document
equals a suffix of another, so one array serves a chunk.

1. Suffixes are ranked by prefix doubling. A class of fewer than ``exponent`` suffixes holds no run and
   is not refined; such a class never straddles an interval that matters, since suffixes that share a
   prefix stay together for as long as they are at least ``exponent``.
2. The ranks of each round give the common prefix (LCP) of neighbours in the array; one pass with a
   stack gives the LCP intervals, without building a tree.
3. In an interval of depth d all suffixes but those of its largest child are tested: if i + d or i - d
   lies in the interval too (by the inverse array), under another child, there is a square of period d
   that cannot be shifted to the right: every run ends with exactly one of them.
4. Squares are rotated to the left as far as the words repeat, and squares of the same run merge.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalspan.llm.ship import let_go, ship

EXPONENT = 4
SHORTEST = 6
CHUNK_WORDS = 200_000
BREAK = 0  # the symbol that ends a document

Rewrite = Callable[[object, list[bytes]], list[bytes]]
RUN = "struct<start:long,length:long,period:long>"
RUN_TYPE = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))


def rank_suffixes(symbols: np.ndarray, owner: np.ndarray, least: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and the rank of every suffix by its first 1, 2, 4, ... symbols.

    The rank is the place of the first suffix of the class. Classes below ``least`` stay unsorted.
    """
    size = len(symbols)
    key = owner * (symbols.max() + 1) + symbols
    order = np.argsort(key, kind="stable")
    active = np.arange(size)
    sorted_key = key[order]
    rank = np.zeros(size, dtype=np.int32)
    levels: list[np.ndarray] = []
    width = 1
    while True:
        new = np.empty(len(active), dtype=bool)
        new[:1] = True
        np.not_equal(sorted_key[1:], sorted_key[:-1], out=new[1:])
        starts = np.flatnonzero(new)
        members = np.diff(starts, append=len(active))
        rank = rank.copy()
        rank[order[active]] = np.repeat(active[starts], members)
        levels.append(rank)
        active = active[np.repeat(members >= least, members)]
        if not len(active):
            return order, levels
        suffix = order[active]
        key = rank[suffix].astype(np.int64) * size + rank[suffix + width]
        place = np.argsort(key, kind="stable")
        order[active] = suffix[place]
        sorted_key = key[place]
        width *= 2


def boundaries(order: np.ndarray, levels: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, LCP with the place before) where classes meet; LCP 0 opens a group of one first word."""
    first, last = levels[0][order], levels[-1][order]
    head = np.flatnonzero(np.diff(first, prepend=-1))
    large = np.repeat(np.diff(head, append=len(order)) >= least, np.diff(head, append=len(order)))
    places = np.flatnonzero((np.diff(last, prepend=-1) != 0) & large)
    # A small group between two large ones must end the intervals of the first.
    ends = np.flatnonzero(large[:-1] & ~large[1:]) + 1
    places = np.union1d(places, ends)
    before, after = order[places - 1], order[places]
    common = np.zeros(len(places), dtype=np.int64)
    same = places > 0
    for level in range(len(levels) - 1, -1, -1):
        rank = levels[level]
        left, right = before[same] + common[same], after[same] + common[same]
        common[same] += (rank[left] == rank[right]).astype(np.int64) << level
    return places, common


def intervals(places: np.ndarray, common: np.ndarray, size: int):
    """LCP intervals (first, last place, depth) and the interval that each boundary divides."""
    first, last, depth, owner = [], [], [], []
    open_depth, open_number = [0], [-1]
    before = 0
    for place, shared in zip([*places.tolist(), size], [*common.tolist(), 0]):
        left = before
        while open_depth[-1] > shared:
            open_depth.pop()
            number = open_number.pop()
            last[number] = place - 1
            left = first[number]
        if open_depth[-1] < shared:
            open_depth.append(shared)
            open_number.append(len(first))
            first.append(left)
            last.append(left)
            depth.append(shared)
        owner.append(open_number[-1])
        before = place
    as_array = [np.array(x, dtype=np.int64) for x in (first, last, depth)]
    return (*as_array, np.array(owner[:-1], dtype=np.int64))


def squares(symbols: np.ndarray, owner: np.ndarray, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the last square of every run of at least ``exponent`` periods."""
    nothing = np.zeros(0, dtype=np.int64)
    order, levels = rank_suffixes(symbols, owner, exponent)
    size = len(order)
    places, common = boundaries(order, levels, exponent)
    del levels
    first, last, depth, divided = intervals(places, common, size)
    if not len(first):
        return nothing, nothing
    place_of = np.empty(size, dtype=np.int64)
    place_of[order] = np.arange(size)

    inner = divided >= 0
    number = np.concatenate([np.arange(len(first)), divided[inner]])
    start = np.concatenate([first, places[inner]])
    by_interval = np.lexsort((start, number))
    number, start = number[by_interval], start[by_interval]
    heads = np.flatnonzero(np.diff(number, prepend=-1))
    end = np.append(start[1:], 0)
    end[np.append(heads[1:], len(number)) - 1] = last + 1
    members = end - start
    largest = np.repeat(np.maximum.reduceat(members, heads), np.diff(heads, append=len(number)))
    hits = np.flatnonzero(members == largest)
    spared = hits[np.unique(number[hits], return_index=True)[1]]  # one largest child of each interval
    tested = (last - first + 1 >= exponent)[number]
    tested[spared] = False
    number, start, end, members = (x[tested] for x in (number, start, end, members))
    if not len(number):
        return nothing, nothing
    child = np.repeat(np.arange(len(number)), members)
    step = np.arange(len(child)) - np.repeat(np.cumsum(members) - members, members)
    suffix = order[start[child] + step]
    number, start, end = number[child], start[child], end[child]
    period, low, high = depth[number], first[number], last[number]

    def inside(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        place = np.where(at >= 0, place_of[np.maximum(at, 0)], -1)
        return (place >= low) & (place <= high)

    found = []
    for other, begin in ((suffix + period, suffix), (suffix - period, suffix - period)):
        hit = np.flatnonzero(inside(other, low, high) & ~inside(other, start, end - 1))
        for back in range(1, exponent - 1):
            hit = hit[inside(begin[hit] - back * period[hit], low[hit], high[hit])]
        found.append(np.stack([begin[hit], period[hit]]))
    begin, period = np.unique(np.concatenate(found, axis=1), axis=1)
    return begin, period


def merge_runs(
    symbols: np.ndarray, begin: np.ndarray, period: np.ndarray, exponent: int, shortest: int
) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs that end with these squares, in order."""
    found: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for last, step in sorted(zip((begin + 2 * period).tolist(), period.tolist())):
        start = last - exponent * step
        if any(step % q == 0 and s <= start for s, q in found[last]):
            continue  # several periods of a run that is known
        block = 16
        while start:
            low = max(0, start - block)
            same = symbols[low:start] == symbols[low + step : start + step]
            if same.all():
                start, block = low, 2 * block
                continue
            start = low + int(np.flatnonzero(~same)[-1]) + 1
            break
        found[last].append((start, step))
    runs = [(s, last - s, q) for last, known in found.items() for s, q in known]
    return sorted(run for run in runs if run[1] >= shortest)


def word_runs(
    texts: list[list[bytes]], exponent: int = EXPONENT, shortest: int = SHORTEST
) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words, as (start, length, period) by start, then period."""
    number: defaultdict[bytes, int] = defaultdict(count(BREAK + 1).__next__)
    lengths = np.array([len(words) + 1 for words in texts], dtype=np.int64)
    ends = np.cumsum(lengths)
    symbols = np.full(int(ends[-1]) if len(ends) else 0, BREAK, dtype=np.int64)
    for words, end in zip(texts, ends):
        symbols[end - len(words) - 1 : end - 1] = np.fromiter(
            map(number.__getitem__, words), np.int64, len(words)
        )
    result: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(number) and len(symbols) >= shortest:
        owner = np.repeat(np.arange(len(texts)), lengths)
        begin, period = squares(symbols, owner, exponent)
        for start, length, q in merge_runs(symbols, begin, period, exponent, shortest):
            text = int(owner[start])
            result[text].append((int(start - (ends[text] - lengths[text])), int(length), int(q)))
    for runs in result:
        runs.sort(key=lambda run: (run[0], run[2]))
    return result


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by one space, without what repeats: of each run its first period stays."""
    if runs:
        kept = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words)


def _scan(exponent: int, shortest: int, rewrite: Rewrite | None):
    def chunks(batch: pa.RecordBatch) -> Iterator[list[tuple[object, list[bytes]]]]:
        rows, size = [], 0
        for key, text in zip(batch.column("doc_id"), batch.column("__text")):
            words = (text.as_py() or b"").split()  # of bytes: the six ASCII white-space bytes
            if rewrite:
                words = rewrite(key.as_py(), words)
            rows.append((key, words))
            size += len(words)
            if size >= CHUNK_WORDS:
                yield rows
                rows, size = [], 0
        if rows:
            yield rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for rows in chunks(batch):
                texts = [words for _, words in rows]
                found = word_runs(texts, exponent, shortest)
                short = [collapse(words, runs) for words, runs in zip(texts, found)]
                names = ("start", "length", "period")
                structs = [[dict(zip(names, run)) for run in runs] for runs in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key.as_py() for key, _ in rows], pa.int64()),
                        pa.array([len(words) for words in texts], pa.int64()),
                        pa.array(structs, RUN_TYPE),
                        pa.array(short, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def find_runs(
    df: DataFrame,
    exponent: int = EXPONENT,
    shortest: int = SHORTEST,
    doc_id: str = "doc_id",
    text: str = "text",
    rewrite: Rewrite | None = None,
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_words, runs and the collapsed text.

    Words are stretches without ASCII white space. ``runs`` are (start, length, period) in words, by
    start, then period, of at least ``exponent`` (2 or more) periods and ``shortest`` words.
    ``collapsed`` drops the words of each run after its first period and joins the others by one space.
    ``rewrite`` may replace the words of a text, given the id and the words.

    A null or empty text has no words, no runs and an empty collapsed text. Null and repeated ids are
    kept as they are; repeated rows repeat their result. Other columns are not looked at. Memory grows
    with the longest text (some hundred bytes a word); an empty table gives an empty result.
    """
    if exponent < 2:
        raise ValueError("a run has at least two periods")
    ship(df.sparkSession)
    return df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("__text")
    ).mapInArrow(
        _scan(exponent, shortest, rewrite),
        f"doc_id long, n_words long, runs array<{RUN}>, collapsed string",
    )
