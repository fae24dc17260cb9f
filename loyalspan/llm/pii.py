"""Personal data: fixed patterns, and what a conditional random field finds besides.

The field labels the words of every text by their shapes and their neighbours' shapes. It is trained
from a small labelled table that is built by rule, and decoded by Viterbi over batches of words. Its
spans are added where they overlap no span of the patterns and have the digits of their kind.

Every pattern is searched in time linear in the text, however long its words are.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspan.llm import crf
from loyalspan.llm.ship import let_go, ship

KINDS = ("email", "ip", "card", "phone")
LINES = 400
SEED = 5
ROWS = 128

# The patterns. Possessive where a shorter run could not match either.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMERIC = re.compile(r"[0-9][0-9. -]*")
NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def digits(text: str) -> str:
    return NOT_DIGIT.sub("", text)


def luhn(number: str) -> bool:
    total = 0
    for i, char in enumerate(reversed(number)):
        value = int(char) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """A match has one "@": the allowed characters before it, back to the last match, and a domain."""
    end, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > end and text[start - 1] in LOCAL:
                start -= 1
        if domain and start < at:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def is_ip(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))


def is_card(found: str) -> bool:
    number = digits(found)
    return 13 <= len(number) <= 19 and luhn(number)


def is_phone(found: str) -> bool:
    return 9 <= len(digits(found)) <= 15


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns, by kind and start; matches that fail their test are dropped."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    found["email"] += emails(text)
    for run in NUMERIC.finditer(text):
        begin, end = run.span()
        if end - begin < 7:
            continue
        for kind, pattern, test in (("ip", IP, is_ip), ("card", CARD, is_card)):
            for match in pattern.finditer(text, begin, end):
                if test(match.group()):
                    found[kind].append(match.span())
    if "+" in text:
        found["phone"] += [m.span() for m in PHONE.finditer(text) if is_phone(m.group())]
    return [(kind, start, end) for kind in KINDS for start, end in found[kind]]


def labelled_lines(count: int = LINES, seed: int = SEED) -> list[list[tuple[str, str]]]:
    """The small labelled table, built by rule: lines of (word, label)."""
    draw = random.Random(seed)

    def number(n: int) -> str:
        return "".join(draw.choice("0123456789") for _ in range(n))

    def letters(low: int, high: int) -> str:
        return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(low, high)))

    def plain() -> str:
        word = letters(1, 14)
        word = draw.choice([word, word, word, word.capitalize(), word.upper() if len(word) < 6 else word])
        return word + draw.choice(["", "", "", "", ",", ".", ":", "?"])

    def nothing() -> list[str]:
        """What looks a little like personal data and is none."""
        return draw.choice(
            [
                lambda: [number(draw.randint(1, 8))],
                lambda: [number(1) + "." + number(1) + "." + number(1)],
                lambda: [number(4) + "-" + number(2) + "-" + number(2)],
                lambda: [number(4), "-", number(4)],
                lambda: [number(2), number(2), number(2)],
                lambda: [number(3) + "," + number(3)],
                lambda: ["$" + number(3) + "." + number(2)],
                lambda: [number(2) + ":" + number(2)],
                lambda: ["https://" + letters(3, 9) + ".org/" + letters(2, 8)],
                lambda: ["@" + letters(3, 10)],
                lambda: [letters(3, 9) + "=" + letters(1, 3) + number(9) + letters(2, 5) + number(4)],
                lambda: [letters(4, 4).upper() + number(6) + letters(8, 8).upper() + number(2)],
                lambda: [number(24)],
                lambda: ["(" + letters(3, 8) + ")"],
                lambda: ["(" + number(1) + ")"],
                lambda: [letters(3, 9) + "-" + letters(3, 9)],
                lambda: [letters(3, 9) + "." + letters(2, 3)],
            ]
        )()

    def personal() -> tuple[str, list[str]]:
        a, b, c = number(3), number(3), number(4)
        host = letters(3, 9) + draw.choice([".com", ".org", ".co.uk", number(1) + ".example.com"])
        return draw.choice(
            [
                lambda: ("email", [letters(2, 9) + draw.choice(["", ".", "_", "+"]) + number(draw.randint(0, 3)) + "@" + host]),
                lambda: ("email", [draw.choice("<(") + letters(3, 9) + "@" + host + ">"]),
                lambda: ("email", [letters(2, 9) + "@" + letters(4, 9)]),
                lambda: ("ip", [".".join(str(draw.randint(0, 255)) for _ in range(4))]),
                lambda: ("ip", [".".join(str(draw.randint(0, 255)) for _ in range(4)) + draw.choice([":8080", "/24"])]),
                lambda: ("card", [number(16)]),
                lambda: ("card", [number(4), number(4), number(4), number(4)]),
                lambda: ("card", ["-".join(number(4) for _ in range(4))]),
                lambda: ("card", [".".join(number(4) for _ in range(4))]),
                lambda: ("phone", ["+" + number(1), "(" + a + ")", b + "-" + c]),
                lambda: ("phone", ["+" + number(2), a, b, c]),
                lambda: ("phone", ["+" + number(11)]),
                lambda: ("phone", ["(" + a + ")", b + "-" + c]),
                lambda: ("phone", [a + "-" + b + "-" + c]),
                lambda: ("phone", [a + "." + b + "." + c]),
            ]
        )()

    lines = []
    for _ in range(count):
        line: list[tuple[str, str]] = []
        for _ in range(draw.randint(1, 3)):
            line += [(plain(), "O") for _ in range(draw.randint(1, 5))]
            if draw.random() < 0.45:
                line += [(word, "O") for word in nothing()]
            elif draw.random() < 0.7:
                kind, words = personal()
                words[-1] += draw.choice(["", "", "", ".", ","])
                line += [(word, kind) for word in words]
        line += [(plain(), "O") for _ in range(draw.randint(0, 3))]
        lines.append(line)
    return lines


def labelled_table(spark: SparkSession) -> DataFrame:
    """The labelled table as (line, position, word, label)."""
    rows = [
        (i, j, word, label)
        for i, line in enumerate(labelled_lines())
        for j, (word, label) in enumerate(line)
    ]
    return spark.createDataFrame(rows, "line int, position int, word string, label string")


def fit(labelled: DataFrame) -> crf.Field:
    """Trains the field from a labelled table; it is small by contract and read on the driver."""
    lines: dict[int, list[tuple[str, str]]] = {}
    for row in labelled.orderBy("line", "position").collect():
        lines.setdefault(row["line"], []).append((row["word"], row["label"]))
    examples = []
    for line in lines.values():
        points = code_points(" ".join(word for word, _ in line))
        rows = crf.shapes(*crf.words_of(points))
        examples.append((rows, np.array([crf.LABELS.index(label) for _, label in line])))
    return crf.train(examples)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def plausible(kind: str, found: str) -> bool:
    """Whether what the field found has the parts of its kind."""
    if kind == "email":
        name, _, host = found.partition("@")
        return found.count("@") == 1 and name[-1:].isalnum() and host[:1].isalnum() and not digits(host) == host
    if kind == "ip":
        return found.count(".") == 3 and all(p.isdecimal() for p in found.split(".")) and is_ip(found)
    if kind == "card":
        return is_card(found)
    parts = [p for p in NOT_DIGIT.split(found) if p]
    return 10 <= sum(map(len, parts)) <= 15 and len(parts) >= 3 and parts[-1:] == [p for p in parts[-1:] if len(p) >= 4]


def field_spans(texts: list[str], field: crf.Field) -> list[list[Span]]:
    """The spans that the field finds in each text."""
    found: list[list[Span]] = [[] for _ in texts]
    points = code_points("\n".join(texts))
    starts, ends, kinds = crf.words_of(points)
    if not len(starts):
        return found
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    owner = np.searchsorted(offsets, starts, side="right") - 1
    breaks = np.concatenate([[True], owner[1:] != owner[:-1]])
    labels = field.decode(field.emissions(crf.shapes(starts, ends, kinds), breaks), breaks)
    marked = np.nonzero(labels)[0]
    if not len(marked):
        return found
    new = np.concatenate(
        [[True], (np.diff(marked) > 1) | (np.diff(labels[marked]) != 0) | (np.diff(owner[marked]) != 0)]
    )
    firsts = marked[new]
    lasts = np.concatenate([marked[np.nonzero(new)[0][1:] - 1], marked[-1:]])
    for first, last in zip(firsts.tolist(), lasts.tolist()):
        doc = int(owner[first])
        text, shift = texts[doc], int(offsets[doc])
        a, b = int(starts[first]) - shift, int(ends[last]) - shift
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while b > a and not text[b - 1].isalnum():
            b -= 1
        kind = crf.LABELS[int(labels[first])]
        if plausible(kind, text[a:b]):
            found[doc].append((kind, a, b))
    return found


def all_spans(base: list[Span], more: list[Span]) -> list[Span]:
    """Base spans and those of ``more`` that overlap none of them, by kind and start."""
    edges = sorted((a, b) for _, a, b in base)
    tops = np.maximum.accumulate([b for _, b in edges]) if edges else np.empty(0)
    begins = np.array([a for a, _ in edges])
    added = []
    for span in more:
        before = int(np.searchsorted(begins, span[2]))  # base spans that begin before its end
        if not before or tops[before - 1] <= span[1]:
            added.append(span)
    return sorted([*base, *added], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"


def find(
    df: DataFrame, field: crf.Field, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, base, spans): one row per row of ``df``.

    ``base`` are the spans of the patterns, ``spans`` these and those of the field, each by kind and
    start, in code points with exclusive ends. A null or empty text has none. Repeated rows repeat
    their result; other columns are not looked at.
    """
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(field)  # some thousand weights
    struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def column(rows: list[list[Span]]) -> pa.Array:
        return pa.array([[dict(zip(("kind", "start", "end"), s)) for s in r] for r in rows], struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        model = shared.value
        for whole in batches:
            for begin in range(0, whole.num_rows, ROWS):
                batch = whole.slice(begin, ROWS)
                texts = [t.as_py() or "" for t in batch.column("text")]
                base = [base_spans(t) for t in texts]
                spans = [all_spans(b, m) for b, m in zip(base, field_spans(texts, model))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), column(base), column(spans)], ["doc_id", "base", "spans"]
                )

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, base {SPAN_TYPE}, spans {SPAN_TYPE}")


def joined(spans: str):
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
