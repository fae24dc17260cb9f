"""Near-duplicate vectors against comparing all pairs."""

import random

import numpy as np
import pytest

from loyalspan.llm import forest

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, tree int"


def brute(rows, similar=forest.SIMILAR):
    """{row number: (links, component)} with links of equal labels and usable vectors."""
    good = [
        i for i, (_, v, label) in enumerate(rows)
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    linked = {i: set() for i in range(len(rows))}
    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in good}
    for i in good:
        for j in good:
            if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= similar:
                linked[i].add(j)
                linked[j].add(i)
    result, seen = {}, set()
    for i in linked:
        if i in seen:
            continue
        group, waiting = {i}, [i]
        while waiting:
            for j in linked[waiting.pop()] - group:
                group.add(j)
                waiting.append(j)
        seen |= group
        first = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        result.update({j: (len(linked[j]), first) for j in group})
    return result


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, [float(x) if x is not None else None for x in v] if v is not None else None, label, "x", 1) for i, v, label in rows], SCHEMA)
    return forest.near_vectors(df, **options).collect()


def clusters(seed, count, width, spread):
    draw = np.random.default_rng(seed)
    vectors = []
    for size in count:
        middle = draw.standard_normal(width)
        middle /= np.linalg.norm(middle)
        vectors += list(middle + spread * draw.standard_normal((size, width)) / np.sqrt(width))
    return [np.float32(v).tolist() for v in vectors]


def test_clusters_and_copies(spark):
    vectors = clusters(1, [200, 60, 9, 9, 2] + [1] * 500, 32, 0.22)
    draw = random.Random(1)
    rows = [(i, v, draw.choice([0, 0, 0, 1])) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(0, 300, 3)]  # equal vectors
    rows += [(2000 + i, [2 * x for x in rows[i][1]], rows[i][2]) for i in range(0, 90, 9)]  # same direction
    wanted = {rows[i][0]: value for i, value in brute(rows).items()}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found(spark, rows)}
    assert set(got) == set(wanted)
    assert all(got[i][0] <= wanted[i][0] for i in got)  # no link below the limit, none counted twice
    assert sum(n for n, _, _ in got.values()) >= 0.99 * sum(n for n, _ in wanted.values())
    assert sum(got[i][1] == wanted[i][1] for i in got) >= 0.99 * len(got)
    assert all(kept == (i == component) for i, (_, component, kept) in got.items())


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0),
        (2, [1.0, -0.0], 0),
        (3, [1.0, 0.1], 0),
        (4, [1.0, 0.0], 1),
        (5, [1.0, 0.0], None),
        (6, None, 0),
        (7, [], 0),
        (8, [0.0, 0.0], 0),
        (9, [1.0, nan], 0),
        (10, [inf, 0.0], 0),
        (11, [1.0, None], 0),
        (12, [1.0, 0.0, 0.0], 0),
        (13, [3e38, 0.0], 0),
        (14, [0.0, 1.0], 0),
        (14, [0.0, 1.0], 0),
        (14, [-1.0, 0.0], 0),
        (None, [0.0, 2.0], 0),
        (None, [5.0, 5.0], 7),
        (None, None, None),
    ]
    wanted = sorted(((rows[i][0] or 0, *value) for i, value in brute(rows).items()), key=repr)
    got = found(spark, rows)
    assert sorted(((r.vec_id or 0, r.n_links, r.component_id) for r in got), key=repr) == wanted
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert forest.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_cluster_larger_than_a_block(spark):
    vectors = clusters(3, [forest.BLOCK + 300] + [1] * 300, 16, 0.1)
    units = np.array(vectors, float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    links = (units @ units.T >= forest.SIMILAR).sum(axis=1) - 1
    got = {r.vec_id: r for r in found(spark, [(i, v, 0) for i, v in enumerate(vectors)], trees=2)}
    assert all(got[i].n_links <= links[i] for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.99 * links.sum()
    assert {got[i].component_id for i in range(forest.BLOCK + 300)} == {0}


@pytest.mark.parametrize("blocks", [1, 2])
def test_pairs_met_before_do_not_count(blocks):
    draw = np.random.default_rng(blocks)
    units = draw.standard_normal((90, 4))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    weight = draw.integers(1, 5, 90)
    block = draw.integers(0, blocks, 90)
    earlier = [draw.choice(40, draw.integers(0, 4), replace=False).astype(np.int64) for _ in range(90)]
    links, low = forest.compare(units, weight, block, earlier, 0.7)
    near = units @ units.T >= 0.7
    np.fill_diagonal(near, False)
    if blocks > 1:
        near &= block[:, None] != block[None, :]
    met = np.array([[bool(set(a) & set(b)) for b in earlier] for a in earlier])
    assert links.tolist() == ((near & ~met) @ weight).tolist()
    names = np.arange(90)
    for _ in range(90):
        names = np.minimum(names, np.where(near, names[None, :], 90).min(axis=1))
    assert low.tolist() == names.tolist()
