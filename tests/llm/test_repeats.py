"""Runs of repeated words against a search that tries every period."""

import random

import pytest

from loyalspan.llm import repeats
from loyalspan.llm.queries import planted_repeats


def brute_runs(words, exponent=repeats.EXPONENT, shortest=repeats.SHORTEST):
    found = {}
    for period in range(1, len(words) // exponent + 1):
        first = 0
        while first + period < len(words):
            last = first
            while last + period < len(words) and words[last] == words[last + period]:
                last += 1
            length = last - first + period
            if last > first and length >= max(shortest, exponent * period):
                found.setdefault((first, length), period)
            first = last + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda run: (run[0], run[2]))


def random_words(draw):
    size = draw.choice([0, 1, 5, 20, 60])
    words = [bytes([97 + draw.randrange(draw.choice([1, 2, 3, 6]))]) for _ in range(size)]
    if size > 10 and draw.random() < 0.6:
        first = draw.randrange(size)
        period = 1 + (size - first) // draw.randint(3, 9)
        words = [words[i if i < first else first + (i - first) % period] for i in range(size)]
    return words


@pytest.mark.parametrize("exponent, shortest", [(2, 1), (3, 2), (4, 6)])
def test_runs_against_all_periods(exponent, shortest):
    draw = random.Random(exponent)
    for _ in range(300):
        texts = [random_words(draw) for _ in range(draw.randint(1, 5))]
        found = repeats.word_runs(texts, exponent, shortest)
        assert found == [brute_runs(words, exponent, shortest) for words in texts]


def test_nested_and_touching_runs():
    words = (b"a a a a a a b " * 5 + b"c d " * 4).split()
    runs = repeats.word_runs([words])[0]
    assert runs == brute_runs(words)
    assert (0, 35, 7) in runs and (35, 8, 2) in runs and (0, 6, 1) in runs
    assert repeats.collapse(words, runs) == b"a b c d"


def test_long_periodic_texts_stay_quick():
    words = [b"x"] * 50_000
    assert repeats.word_runs([words, words[:5], words[:6]]) == [[(0, 50_000, 1)], [], [(0, 6, 1)]]
    block = [str(i).encode() for i in range(9_000)]
    assert repeats.word_runs([block * 4 + block[:10]]) == [[(0, 36_010, 9_000)]]


def test_fibonacci_words():
    one, two = [b"a"], [b"a", b"b"]
    while len(two) < 400:
        one, two = two, two + one
    assert repeats.word_runs([two], 2, 2)[0] == brute_runs(two, 2, 2)


SCHEMA = "doc_id long, text string, runs string, collapsed int"


def test_odd_rows(spark):
    rows = [
        (1, None, "x", 1),
        (2, "", None, None),
        (3, " \t\n", None, None),
        (4, "no no no no no no", None, 4),
        (4, "no no no no no no", None, 4),
        (4, "other", None, 4),
        (None, "é\u00a0x " * 8 + "end", None, None),
    ]
    found = repeats.find_runs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    plain = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found)
    assert plain == [
        (0, 9, [(0, 8, 1)], "é\u00a0x end"),
        (1, 0, [], ""),
        (2, 0, [], ""),
        (3, 0, [], ""),
        (4, 1, [], "other"),
        (4, 6, [(0, 6, 1)], "no"),
        (4, 6, [(0, 6, 1)], "no"),
    ]
    assert repeats.find_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_run_needs_two_periods(spark):
    with pytest.raises(ValueError):
        repeats.find_runs(spark.createDataFrame([], SCHEMA), exponent=1)


def test_planted_repeats():
    words = [str(i).encode() for i in range(100)]
    changed = [i for i in range(200) if planted_repeats(i, words) != words]
    assert 10 <= len(changed) <= 30
    for i in changed:
        new = planted_repeats(i, words)
        assert len(new) == 100
        runs = repeats.word_runs([new])[0]
        assert runs == brute_runs(new)
    assert planted_repeats(None, words) == words and planted_repeats(changed[0], []) == []
