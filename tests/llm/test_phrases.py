"""Phrase collocations against counting everything."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from loyalspan.llm import phrases

SCHEMA = "doc_id long, text string, lang string, n int, score string"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least, longest=4, share=80, top=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] = counts.get((lang, tuple(words[i : i + size])), 0) + 1
    found = {key: f for key, f in counts.items() if len(key[1]) > 1 and f >= least}
    lists = {}
    for (lang, words), a in found.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        inside = any(
            other == lang and len(longer) > len(words) and 100 * f >= share * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), f in found.items()
        )
        if not inside:
            lists.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank + 1, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, entries in lists.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(entries)[:top])
    )


def random_rows(draw, count):
    words = ["a", "B", "b", "É", "é", "c-d", "\x00", "x\x1cy", " "]
    ends = [" ", " ", " ", " ", "\t", ". ", ", ", "\n", "\x0b", "?!"]
    for _ in range(count):
        size = draw.choice([0, 1, 3, 30])
        text = "".join(draw.choice(words) + draw.choice(ends) for _ in range(size))
        if draw.random() < 0.3:
            text += "of the same kind " * 3
        yield text, draw.choice(["en", "en", "de", None, "und"])


@pytest.mark.parametrize("longest, share, top", [(4, 80, 2000), (3, 50, 5), (2, 80, 3)])
def test_against_counting_everything(spark, longest, share, top):
    rows = [*random_rows(random.Random(longest), 150), (None, "en"), ("", None), ("a b " * 20_000, "de")]
    rows += rows[:20]  # repeated rows count again
    df = spark.createDataFrame([(i, t, lang, 1, "x") for i, (t, lang) in enumerate(rows)], SCHEMA)
    found = phrases.best(df.repartition(3), top, least=5, longest=longest, share=share).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 5, longest, share, top)


def test_nothing_is_frequent(spark):
    assert phrases.best(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(None, "just one text", None, None, None)], SCHEMA)
    assert phrases.best(one).collect() == []
    with pytest.raises(ValueError):
        phrases.collocations(one, longest=5)


def entries(counter, texts):
    got = Counter()

    def take():
        for batch in counter.stripes():
            for row in batch.to_pylist():
                for following, times in zip(row["nexts"], row["counts"]):
                    got[row["prefix"], following] += times

    for text in texts:
        counter.add(text.encode() + phrases.END)
        if counter.full():
            take()
    take()
    return got


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_counters_that_overflow_lose_nothing(monkeypatch, size):
    for name, value in (("HELD_ENTRIES", 8), ("HELD_WORDS", 6), ("SENT_ENTRIES", 3)):
        monkeypatch.setattr(phrases, name, value)
    draw = random.Random(size)
    texts = [" ".join(draw.choice("abcdefgh") for _ in range(12)) for _ in range(60)]
    all_bits = (np.full(phrases.SLOTS // 8, 255, np.uint8),) * 2  # everything is frequent, and hot
    got = entries(phrases.Counter("en", size, [all_bits] * (size - 1)), texts)
    wanted = Counter()
    for words in map(str.split, texts):
        for i in range(len(words) - size + 1):
            wanted[" ".join(words[i : i + size - 1]), words[i + size - 1]] += 1
    assert got == wanted


def test_rows_of_a_task_do_not_grow_with_the_phrases(monkeypatch):
    """A task sends one row a part, and its blocks hold all its stripes."""
    monkeypatch.setattr(phrases, "PARTS", 4)
    draw = random.Random(5)
    bits = (np.full(phrases.SLOTS // 8, 255, np.uint8), np.zeros(phrases.SLOTS // 8, np.uint8))
    counter = phrases.Counter("en", 3, [bits] * 2)
    texts = [" ".join(str(draw.randrange(200)) for _ in range(30)) for _ in range(100)]
    wanted = Counter()
    for words in map(str.split, texts):
        counter.add(" ".join(words).encode() + phrases.END)
        wanted.update(zip(words, words[1:], words[2:]))
    rows = [row for batch in map(phrases.in_blocks, counter.stripes()) for row in batch.to_pylist()]
    assert len(rows) == len({row["part"] for row in rows}) == 4
    got = Counter()
    for row in rows:
        for head, following, times in zip(row["heads"], row["nexts"], row["counts"], strict=True):
            got[*row["prefixes"][head].split(), following] += times
    assert got == wanted
