"""Near-duplicate vectors by a forest of random-projection trees.

Equal vectors are first counted together. Every vector then goes down ``TREES`` trees of its label. A node
of more than ``LEAF`` vectors is split along a random direction drawn from its number; what lies within
a margin of the cut goes to both sides (spill), so near vectors are seldom parted. Cuts are fitted on a
sample of about ``SAMPLE`` vectors a node, up to ``DEPTH`` levels a round; rounds go on until every node
is a leaf, so the sample bounds memory and not the depth. A node that no direction can split, because
most of it is one cluster, is a leaf as well, whatever its size.

Within leaves all vectors are compared by cosine, in blocks of at most ``BLOCK`` rows: a larger leaf is
dealt into blocks and each pair of blocks is one group. A pair that meets in several leaves counts in the
first of them by tree and node, since each row knows its other leaves. So groups return a number of links
and one tie to the smallest member of the local component per row, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyalspan.llm.ship import let_go, ship
from loyalspan.llm.simhash import star_components
from loyalspan.session import materialise, spread

SIMILAR = 0.93
TREES = 4
LEAF = 512
SAMPLE = 2048
DEPTH = 6
TRIES = 4
SPILL = 0.35  # half the width of the margin, in deviations of what parts two vectors at the limit
LARGER = 0.7  # a split must leave no more than this share on one side
BLOCK = 2048
SEED = 13

KEY = ["space", "tree", "node"]
DENSE, OPEN = -1, -2
MASK = (1 << 64) - 1


def unit_rows(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of length one; all vectors have the same number of components."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def direction(tree: int, node: int, place: int, attempt: int, width: int) -> np.ndarray:
    drawn = np.random.default_rng([SEED, tree, node & MASK, place, attempt]).standard_normal(width)
    return drawn / np.sqrt((drawn * drawn).sum())


def margin(width: int, similar: float) -> float:
    return SPILL * math.sqrt(max(0.0, 2 - 2 * similar) / width)


def child_node(node: int, place: int) -> int:
    """The number of the ``place``-th node below ``node``: mixed, so that it fits a long at any depth."""
    mixed = ((node & MASK) * 0x9E3779B97F4A7C15 + (place + 1) * 0xD1B54A32D192ED03) & MASK
    for shift in (30, 27):
        mixed = ((mixed ^ mixed >> shift) * 0xBF58476D1CE4E5B9) & MASK
    mixed ^= mixed >> 31
    return mixed - (1 << 64) if mixed >> 63 else mixed


def fit_cuts(rows: np.ndarray, tree: int, node: int, size: int, similar: float) -> tuple[list, list]:
    """(cut, attempt) of each place of a subtree, in heap order from 1, learnt from sampled ``rows``.

    The attempt is ``OPEN`` where the subtree ends and ``DENSE`` where nothing splits the vectors.
    """
    places = 1 << DEPTH
    cuts, attempts = [0.0] * places, [OPEN] * places
    spill = margin(rows.shape[1], similar)
    each = size / max(1, len(rows))
    waiting = [(1, np.arange(len(rows)))]
    while waiting:
        place, part = waiting.pop()
        if place >= places or len(part) * each <= LEAF or len(part) < 8:
            continue
        best = (LARGER * len(part) + 1, 0.0, DENSE)
        for attempt in range(TRIES):
            shadow = np.sort(rows[part] @ direction(tree, node, place, attempt, rows.shape[1]))
            tried = shadow[(np.linspace(0.35, 0.65, 13) * (len(part) - 1)).astype(int)]
            left = np.searchsorted(shadow, tried + spill, "left")
            right = len(part) - np.searchsorted(shadow, tried - spill, "left")
            larger = np.maximum(left, right)
            chosen = int(np.argmin(left + right + np.maximum(0, larger - LARGER * len(part)) * len(part)))
            if larger[chosen] < best[0]:
                best = (larger[chosen], float(tried[chosen]), attempt)
        _, cuts[place], attempts[place] = best
        if attempts[place] >= 0:
            shadow = rows[part] @ direction(tree, node, place, attempts[place], rows.shape[1])
            waiting.append((2 * place, part[shadow < cuts[place] + spill]))
            waiting.append((2 * place + 1, part[shadow >= cuts[place] - spill]))
    return cuts, attempts


def _fit(similar: float):
    def fit(key: tuple, table: pa.Table) -> pa.Table:
        let_go()
        space, tree, node = (x.as_py() for x in key)
        order = np.argsort(table["pid"].to_numpy())
        rows = unit_rows(table["vector"])[order]
        cuts, attempts = fit_cuts(rows, tree, node, table["size"][0].as_py(), similar)
        return pa.table(
            {
                "space": [space],
                "tree": pa.array([tree], pa.int32()),
                "node": [node],
                "cuts": [cuts],
                "attempts": pa.array([attempts], pa.list_(pa.int32())),
            }
        )

    return fit


def descend(rows: np.ndarray, tree: int, node: int, cuts: list, attempts: list, similar: float):
    """(row numbers, place, whether that place is a dense leaf) where the rows arrive."""
    spill = margin(rows.shape[1], similar)
    waiting = [(1, np.arange(len(rows)))]
    while waiting:
        place, part = waiting.pop()
        attempt = attempts[place] if place < len(attempts) else OPEN
        if attempt < 0:
            if len(part):
                yield part, place, attempt == DENSE
            continue
        shadow = rows[part] @ direction(tree, node, place, attempt, rows.shape[1])
        waiting.append((2 * place, part[shadow < cuts[place] + spill]))
        waiting.append((2 * place + 1, part[shadow >= cuts[place] - spill]))


def _route(similar: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            groups: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(batch.column(name).to_pylist() for name in KEY))):
                groups.setdefault(key, []).append(i)
            for (space, tree, node), members in groups.items():
                part = batch.take(pa.array(members))
                cuts, attempts = (part.column(name)[0].as_py() for name in ("cuts", "attempts"))
                rows = unit_rows(part.column("vector"))
                for found, place, dense in descend(rows, tree, node, cuts, attempts, similar):
                    here = part.take(pa.array(found))
                    size = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            here.column("pid"),
                            here.column("space"),
                            here.column("tree"),
                            pa.array([child_node(node, place)] * size, pa.int64()),
                            here.column("vector"),
                            pa.array([dense] * size),
                        ],
                        ["pid", *KEY, "vector", "dense"],
                    )

    return run


def grow(points: DataFrame, trees: int, similar: float) -> DataFrame:
    """(pid, space, tree, node): the leaves of every point (pid, space, vector), one or more per tree."""
    every = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    state = points.select("pid", "space", "vector").withColumn("tree", every).withColumn("node", F.lit(0).cast("long"))
    leaves = []
    while True:
        sizes = state.groupBy(*KEY).agg(F.count("*").alias("size"))
        large = materialise(sizes.where(F.col("size") > LEAF))
        leaves.append(state.join(large, KEY, "left_anti").select("pid", *KEY))
        if not large.take(1):
            break
        share = F.pmod(F.xxhash64("pid", "tree", F.lit(SEED)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        sample = state.join(large, KEY).where(share * F.col("size") < SAMPLE)
        fits = sample.groupBy(*KEY).applyInArrow(
            _fit(similar), "space string, tree int, node long, cuts array<double>, attempts array<int>"
        )
        routed = state.join(materialise(fits), KEY).select("pid", *KEY, "vector", "cuts", "attempts")
        schema = "pid long, space string, tree int, node long, vector array<double>, dense boolean"
        routed = materialise(routed.mapInArrow(_route(similar), schema))
        leaves.append(routed.where("dense").select("pid", *KEY))
        state = routed.where("not dense").drop("dense")
    result = leaves[0]
    for more in leaves[1:]:
        result = result.unionByName(more)
    return materialise(result)


def compare(
    units: np.ndarray, weight: np.ndarray, block: np.ndarray, earlier: list[np.ndarray], similar: float
) -> tuple[np.ndarray, np.ndarray]:
    """(weight of the linked rows, smallest row of the local component) of every row of one group.

    Rows of different blocks are compared, or all where there is one. Pairs that share an ``earlier`` leaf
    tie their rows, but do not count.
    """
    size = len(units)
    _, number = np.unique(np.concatenate(earlier), return_inverse=True)
    often = np.bincount(number) > 1 if len(number) else np.zeros(0, bool)
    column = np.cumsum(often) - 1
    met = np.zeros((size, int(often.sum())), dtype=np.float32)
    row = np.repeat(np.arange(size), [len(x) for x in earlier])
    kept = often[number]
    met[row[kept], column[number[kept]]] = 1
    single = block.min() == block.max()
    links = np.zeros(size, dtype=np.int64)
    near = np.zeros((size, size), dtype=bool)
    for begin in range(0, size, 512):
        part = slice(begin, begin + 512)
        linked = units[part] @ units.T >= similar
        if not single:
            linked &= block[part, None] != block[None, :]
        linked[np.arange(len(linked)), np.arange(begin, begin + len(linked))] = False
        near[part] = linked
        rows = np.flatnonzero(linked.any(axis=1))
        fresh = linked[rows]
        if met.shape[1]:
            fresh &= met[begin + rows] @ met.T == 0
        links[begin + rows] = fresh @ weight
    low = np.arange(size)
    rows = np.flatnonzero(near.any(axis=1))
    while len(rows):
        new = low.copy()
        for begin in range(0, len(rows), 512):
            some = rows[begin : begin + 512]
            new[some] = np.minimum(low[some], np.where(near[some], low[None, :], size).min(axis=1))
        new = new[new]
        if (new == low).all():
            break
        low = new
    return links, low


def _leaf(similar: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        let_go()
        order = np.argsort(table["pid"].to_numpy())
        pid = table["pid"].to_numpy()[order]
        result = (np.zeros(0, np.int64),) * 3
        if len(pid) > 1:
            table = table.take(pa.array(order))
            earlier = [np.array(x, dtype=np.int64) for x in table["earlier"].to_pylist()]
            block = table["block"].to_numpy()
            if key[-1].as_py() == key[-2].as_py():
                block = np.zeros_like(block)
            links, low = compare(unit_rows(table["vector"]), table["weight"].to_numpy(), block, earlier, similar)
            told = (links > 0) | (low != np.arange(len(low)))
            result = (pid[told], links[told], pid[low[told]])
        return pa.table(dict(zip(("pid", "links", "low"), result)))

    return run


def usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def near_vectors(
    df: DataFrame,
    similar: float = SIMILAR,
    trees: int = TREES,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept.

    Vectors of one label link at a cosine of ``similar`` or more; ``n_links`` counts the rows linked
    directly, equal vectors included. ``component_id`` is the smallest id that links lead to, the row's
    own included, and ``kept`` tells where that is the row's own. Links below the limit are never made;
    a pair may be missed if all trees part it.

    Rows whose label is null, or whose vector is null, empty, all zero or holds a null or non-finite
    component, link with nothing, and neither do vectors of different lengths. Rows that repeat an id
    are vectors of their own. Rows without an id link; a component without any has a null id and its
    rows are kept. Other columns are not looked at; an empty table gives an empty result.
    """
    spark = df.sparkSession
    ship(spark)
    # Adding zero makes -0.0 and 0.0 one value.
    numbers = F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0))
    good = F.col(label).isNotNull() & usable(F.col(vector))
    rows = df.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.when(good, F.concat_ws(":", F.size(vector).cast("string"), F.col(label).cast("string"))).alias("space"),
        F.when(good, numbers).alias("vector"),
    )
    points = rows.where("space IS NOT NULL").groupBy("space", "vector").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("first_id")
    )
    points = materialise(spread(points).withColumn("pid", F.monotonically_increasing_id()))
    leaves = grow(points, trees, similar)

    homes = leaves.groupBy("pid").agg(F.collect_list(F.struct("tree", "node")).alias("homes"))
    blocks = F.ceil(F.col("size") / F.lit(float(BLOCK))).cast("int").alias("blocks")
    large = leaves.groupBy(*KEY).agg(F.count("*").alias("size")).where(F.col("size") > BLOCK).select(*KEY, blocks)
    members = points.join(homes, "pid").select("pid", "space", "vector", "weight", "homes", F.inline("homes"))
    here = F.struct("tree", "node")
    earlier = F.transform(F.filter("homes", lambda h: h < here), lambda h: F.xxhash64(h["tree"], h["node"]))
    members = members.join(large, KEY, "left").select(
        "pid", *KEY, "vector", "weight", earlier.alias("earlier"), F.coalesce("blocks", F.lit(1)).alias("blocks")
    )
    members = members.withColumn("block", F.pmod(F.xxhash64("pid"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other").alias("low_block"), F.greatest("block", "other").alias("high_block")
    members = members.select("pid", *KEY, "vector", "weight", "earlier", "block", low, high)
    told = members.groupBy(*KEY, "low_block", "high_block").applyInArrow(
        _leaf(similar), "pid long, links long, low long"
    )
    told = materialise(told)
    linked = told.groupBy("pid").agg(F.sum("links").alias("links"))
    ties = told.where("pid > low").select(F.col("pid").alias("a"), F.col("low").alias("b")).distinct()
    stars = star_components(ties)
    found = points.join(linked, "pid", "left").join(stars, points["pid"] == stars["node"], "left").select(
        "space",
        "vector",
        "first_id",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("root", "pid").alias("root"),
    )
    found = materialise(found)
    first = found.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = found.join(first, "root").select("space", "vector", "n_links", "component_id")
    single = F.col("space").isNull()
    joined = rows.join(labels, ["space", "vector"], "left")
    component = F.when(single, F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
