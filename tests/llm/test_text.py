"""BPE, SimHash, licenses, PII and toxicity: edge tables and brute force."""

import random
import re
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from loyalspan.llm import bpe, boosting, crf, golay, licenses, pii, simhash, toxicity

SCHEMA = "doc_id long, text string, tokens string, score string, spans string, fp string"
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LONG = "lorem ipsum dolor " * 20_000
TEXTS = [
    (1, "Hello  world, it's 2024!\n\n x"),
    (2, None),
    (3, ""),
    (4, LONG),
    (5, "a" * 3000),
    (5, "a" * 3000),
    (None, "é 漢字 \U0001f600\x1c z"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# --- BPE -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    with open(VOCABULARY, "rb") as file:
        return bpe.read_ranks(file.read())


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_ids_are_those_of_the_library(ranks, reference):
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    draw = random.Random(1)
    letters = "ab cdE\n\t  \x85\xa0 éß漢字😀\x1c'sdll123½Ⅷ_,.!́‍ "
    for _ in range(3000):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(40)))
        assert encoder.encode(text).tolist() == reference.encode_ordinary(text)


def test_tokens_of_several_white_space_bytes():
    tokens = [bytes([b]) for b in range(256)] + [b"\n ", b" \n", b"\n \n", b"\t "]
    ranks = {token: i for i, token in enumerate(tokens)}
    own = tiktoken.Encoding(
        "spaces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    draw = random.Random(3)
    texts = ["a\n \nb", "a\n ", *("".join(draw.choice("ab \n\t\r") for _ in range(draw.randrange(9))) for _ in range(2000))]
    for text in texts:
        assert encoder.encode(text).tolist() == own.encode_ordinary(text)


def test_transducer_survives_forgetting(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "MOVES_KEPT", 20)
    monkeypatch.setattr(bpe, "WORDS_KEPT", 5)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    text = "internationalization of unbelievable thermodynamics " * 3 + "zxcvbnm" * 30
    assert encoder.encode(text).tolist() == reference.encode_ordinary(text)


def test_rare_words_are_encoded_together(spark, ranks, reference, monkeypatch):
    """New words of a block run in step, with the same ids; few are left to run one by one."""
    draw = random.Random(5)
    syllables = "an er tion ly the and oub ß é ñó ção 漢 x zq".split()
    words = sorted({"".join(draw.choice(syllables) for _ in range(draw.randrange(3, 9))) for _ in range(20_000)})
    texts = [" ".join(words[i : i + 100]) for i in range(0, len(words), 100)]
    runs = []
    one_by_one = bpe.Transducer._run
    monkeypatch.setattr(bpe.Transducer, "_run", lambda self, piece: runs.append(piece) or one_by_one(self, piece))
    # The function that the tasks run, in this process.
    rows = spark.createDataFrame(enumerate(texts), "doc_id long, text string")
    monkeypatch.setattr(type(rows), "mapInArrow", lambda df, run, schema: run)
    run = bpe.round_trip(rows, VOCABULARY, public_tokenizers.PATTERN)
    batch = pa.record_batch({"doc_id": range(len(texts)), "text": texts})
    got = [row for block in run(iter([batch])) for row in block.to_pylist()]
    assert [row["tokens"] for row in got] == reference.encode_ordinary_batch(texts)
    assert [row["decoded"] for row in got] == texts
    assert len(words) > 10_000 and len(runs) < 200


@pytest.mark.parametrize("seed", range(6))
def test_pieces_in_step_follow_the_definition(seed):
    """Random vocabularies, also those in which a part outranks its whole or a token is never made."""
    draw = random.Random(seed)
    tokens = {bytes([byte]): rank for rank, byte in enumerate(b"abc")}
    while len(tokens) < 60:
        if seed % 2:
            token = draw.choice(list(tokens)) + draw.choice(list(tokens))
        else:
            token = bytes(draw.choice(b"abc") for _ in range(draw.randrange(2, 6)))
        tokens.setdefault(token, len(tokens))
    transducer = bpe.Transducer(tokens)
    pieces = [bytes(draw.choice(b"abc") for _ in range(draw.randrange(1, 30))) for _ in range(600)]
    pieces += [b"ab" * 3000, b""]
    # As in the library, a piece that is a token is that token, made or not.
    wanted = [[tokens[p] for p in ([piece] if piece in tokens else transducer.merge(piece))] for piece in pieces[:-2]]
    for _ in range(3):
        got = [np.frombuffer(ids, dtype=np.int32).tolist() for ids in transducer.encode_all(pieces)]
        assert got[:-2] == wanted
        assert got[-2] == bpe.Transducer(tokens).encode(pieces[-2]) and got[-1] == []
    with pytest.raises(ValueError, match="no token"):
        bpe.Transducer(tokens).encode_all([b"abd" * 3] * 100)


def test_decoder_of_unfinished_characters(ranks):
    decoder = bpe.Decoder(ranks)
    odd = np.flatnonzero(decoder.odd).tolist()
    draw = random.Random(6)
    for _ in range(3000):
        ids = [draw.choice(odd if draw.random() < 0.5 else range(len(ranks))) for _ in range(draw.randrange(9))]
        data = b"".join(decoder.bytes_of[token] for token in ids)
        assert decoder.decode(np.array(ids, dtype=np.int32)) == data.decode("utf-8", "replace")
        assert "".join(decoder.stream(ids)) == data.decode("utf-8", "replace")


def test_pairs_follow_the_definition(ranks):
    transducer = bpe.Transducer(ranks)
    draw = random.Random(2)
    tokens = draw.sample(sorted(ranks.values()), 400)
    for left, right in zip(tokens, tokens[1:]):
        one, other = transducer.bytes_of[left], transducer.bytes_of[right]
        assert transducer.fits(left, right) == (transducer.merge(one + other) == [one, other])
    assert transducer.regular


def test_utf8_machine_in_pieces():
    draw = random.Random(3)
    pool = [65, 0x80, 0xBF, 0xC3, 0xE0, 0xA0, 0xED, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xFF]
    for _ in range(3000):
        data = bytes(draw.choice(pool) for _ in range(draw.randrange(12)))
        text, pending = "", b""
        for i in range(0, len(data), 2):
            more, pending = bpe.Utf8Machine.feed(pending, data[i : i + 2])
            text += more
        assert text + ("�" if pending else "") == data.decode("utf-8", "replace")


def test_round_trip_of_edge_rows(edges, nothing, reference):
    once = bpe.round_trip(edges, VOCABULARY, public_tokenizers.PATTERN).collect()
    coded = bpe.decode(bpe.encode(edges, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY)
    rows = coded.collect()
    assert once == rows
    assert len(rows) == len(TEXTS)
    for row in rows:
        assert row.decoded == (row.text or "")
        assert row.tokens == reference.encode_ordinary(row.text or "")
    assert bpe.encode(nothing, VOCABULARY, public_tokenizers.PATTERN).collect() == []
    digests = bpe.digests(coded).where("doc_id = 3").first()
    assert digests.n_tokens == 0 and digests.ids_sha256 == digests.decoded_sha256


# --- SimHash -------------------------------------------------------------------------------------


def brute_print(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)]
    grams = grams or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_golay_words_within_two_bits_share_a_key():
    draw = np.random.default_rng(1)
    words = draw.integers(0, 1 << 23, 3000)
    flips = (1 << draw.integers(0, 23, 3000)) ^ (1 << draw.integers(0, 23, 3000))
    for one, other in zip(golay.keys(words), golay.keys(words ^ flips)):
        assert set(one) & set(other) and len(set(one)) in (1, 6)
    # Perfect: every word within three bits of its codeword.
    syndromes, errors = golay.tables()
    assert sorted({bin(e).count("1") for e in errors.tolist()}) == [0, 1, 2, 3]
    assert len(set(errors.tolist())) == 1 << 11


def test_fingerprints():
    for text in ("", "  \n", "One", "One two", "A b C d e", "é É x y", "w " * 70_000 + "end"):
        assert simhash.fingerprint(text.encode()) == brute_print(text)


def components(prints):
    ids, parent = list(prints), {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_components_of_chains_and_crowds(spark):
    draw = random.Random(4)
    base = [draw.getrandbits(64) for _ in range(6)]
    prints = []
    for number, start in enumerate(base):
        value = start
        for _ in range((1, 3, 60, 8, 120, 2)[number]):  # chains, and crowds around one word
            value = (start if number in (2, 4) else value) ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64)
            prints.append(value)
    prints = dict(enumerate(dict.fromkeys([*base, *prints])))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    nodes = spark.createDataFrame([(signed(v),) for v in prints.values()], "fp long")
    stars = {r.node: r.root for r in simhash.star_components(simhash.links(nodes)).collect()}
    groups = {}
    for i, part in components(prints).items():
        groups.setdefault(part, set()).add(stars.get(signed(prints[i]), signed(prints[i])))
    assert all(len(roots) == 1 for roots in groups.values())
    assert len({next(iter(r)) for r in groups.values()}) == len(groups)


def test_near_duplicates_of_edge_rows(spark, edges, nothing):
    rows = simhash.near_duplicates(edges).collect()
    assert len(rows) == len(TEXTS)
    prints = {i: brute_print(t) for i, t in TEXTS if i is not None}
    wanted = components(prints)
    for row in rows:
        if row.doc_id is not None:
            assert row.fp % (1 << 64) == prints[row.doc_id]
            assert row.component_id == wanted[row.doc_id]
    kept = simhash.dedup(edges)
    assert kept.columns == edges.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 4, 5]
    assert simhash.near_duplicates(nothing).collect() == []
    assert simhash.dedup(nothing).collect() == []


def test_an_id_on_two_texts_loses_no_component(spark):
    one, other = "a first text of some words", "quite another text with other words"
    rows = [(1, one), (1, other), (1, other), (2, other), (3, other), (4, "a third text all alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.dedup(df).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(1, one), (1, other), rows[5]])


# --- licenses ------------------------------------------------------------------------------------


def test_rules_over_sentences(edges, nothing):
    scanner = licenses.Scanner(licenses.SENTENCES, licenses.RULES)
    mit = "\n".join(
        [
            "Permission is hereby granted, free of charge, to any person obtaining a copy",
            "of this software and associated documentation files (the Software), to deal.",
            "",
            "The above copyright notice and this permission notice shall be included in all",
            "copies or substantial portions of the Software.",
        ]
    )
    assert scanner.licenses(mit) == [("MIT", 0, len(mit) - 1)]
    short = "é bla.\nLICENSED under the Apache License, Version 2.0.\nReleased under the MIT License. x"
    assert [n[0] for n in scanner.licenses(short)] == ["Apache-2.0", "MIT"]
    start = short.index("LICENSED")
    assert scanner.licenses(short)[0][1:] == (start, short.index(".\nReleased"))
    for text in ("not licensed under the Apache License, Version 2.0", "Licensed under CC BY-NC 4.05", "", "Released"):
        assert scanner.licenses(text) == []
    swapped = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    assert scanner.licenses(swapped) == []
    assert len(scanner.licenses("Licensed under CC BY-NC 4.0.\n" * 500)) == 500
    wide = "\n".join(" * " + " " * 300 + line for line in mit.split("\n"))
    assert [n[0] for n in scanner.licenses(wide)] == ["MIT"]
    apart = mit.replace("\n\n", "\n" + "Other words stand here. " * 500 + "\n")
    assert scanner.licenses(apart) == [("MIT", 0, len(apart) - 1)]
    begin, end = mit.split("\n\n")
    twice = f"{begin}\n\n{begin}\n\n{end}"
    assert scanner.licenses(twice) == [("MIT", len(begin) + 2, len(twice) - 1)]
    started = time.process_time()
    stars = "* " * 200_000
    assert [n[0] for n in scanner.licenses(stars + "Released under the MIT License. " + stars)] == ["MIT"]
    assert scanner.licenses("x" + stars + "- ! " + stars + "Released under") == []
    assert time.process_time() - started < 10
    assert {len(r.licenses) for r in licenses.scan(edges).collect()} == {0}
    assert licenses.scan(nothing).collect() == []


# --- PII -----------------------------------------------------------------------------------------


def brute_spans(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if pii.is_card(m.group()):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_patterns_against_brute_force():
    draw = random.Random(5)
    for _ in range(20_000):
        pool = "0123456789..--  +()@aB%_é\n" if draw.random() < 0.5 else "0123 4.5-"
        text = "".join(draw.choice(pool) for _ in range(draw.randrange(60)))
        assert pii.base_spans(text) == brute_spans(text)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


@pytest.fixture(scope="module")
def trained(spark):
    return pii.fit(pii.labelled_table(spark))


def examples(lines):
    for line in lines:
        rows = crf.shapes(*crf.words_of(pii.code_points(" ".join(w for w, _ in line))))
        yield rows, np.array([crf.LABELS.index(label) for _, label in line])


def test_the_field_labels_new_lines_and_decodes_exactly(trained):
    right = total = 0
    for rows, gold in examples(pii.labelled_lines(200, seed=99)):
        breaks = np.arange(len(gold)) == 0
        scores = trained.emissions(rows, breaks)
        path = trained.decode(scores, breaks)
        best, back = trained.moves[0] + scores[0], []
        for step in range(1, len(gold)):
            ways = best[:, None] + trained.moves
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + scores[step]
        whole = [int((best + trained.moves[:, 0]).argmax())]
        for step in reversed(back):
            whole.append(int(step[whole[-1]]))
        assert whole[::-1] == path.tolist()
        right, total = right + (path == gold).sum(), total + len(gold)
    assert right / total > 0.98


def test_found_spans(edges, nothing, trained, spark):
    texts = [
        (1, "mail joe@example.com now"),
        (2, "call (555) 123-4567 now"),
        (3, "both +1 (269) 555-3296 4111111111111111 here"),
        (4, "in 2024 we sold 12,000 of 3.5 kg"),
    ]
    rows = {r.doc_id: r for r in pii.find(spark.createDataFrame(texts, "doc_id long, text string"), trained).collect()}
    assert [tuple(s) for s in rows[1].spans] == [("email", 5, 20)] == [tuple(s) for s in rows[1].base]
    assert rows[2].base == [] and [tuple(s) for s in rows[2].spans] == [("phone", 5, 19)]
    assert {s.kind for s in rows[3].spans} == {"card", "phone"} and rows[3].base == []
    assert rows[4].spans == []
    for row in pii.find(edges, trained).collect():
        assert row.base == row.spans == []
    assert pii.find(nothing, trained).collect() == []


def test_base_spans_stay():
    base = [("email", 5, 20), ("phone", 30, 40)]
    more = [("email", 0, 6), ("card", 20, 30), ("ip", 39, 50), ("phone", 50, 60)]
    assert pii.all_spans(base, more) == [("email", 5, 20), ("card", 20, 30), ("phone", 30, 40), ("phone", 50, 60)]


# --- toxicity ------------------------------------------------------------------------------------


def test_boosted_trees_and_isotonic():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = boosting.BoostedTrees(trees=40).fit(x, y)
    new = draw.normal(size=(500, 4))
    truth = (new[:, 0] > 0) ^ (new[:, 1] > 0.5)
    assert ((trees.margin(new) > 0) == truth).mean() > 0.95
    curve = boosting.Isotonic.fit(trees.margin(x), y)
    values = curve(np.linspace(-20, 20, 200))
    assert (np.diff(values) >= 0).all() and 0 <= values.min() and values.max() <= 1


def toxic_tables(spark, size=800):
    draw = random.Random(6)
    syllables = ["ka", "lo", "mi", "tu", "re", "sa", "no", "vi", "pe", "du"]
    rows, labels = [], []
    for i in range(size):
        words = ["".join(draw.choice(syllables) for _ in range(draw.randint(1, 4))) for _ in range(60)]
        bad = i % 7 == 0
        if bad:
            for _ in range(3):
                words[draw.randrange(60)] = "zzorg" + draw.choice(syllables)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_learned_words_carry_over_to_held_out_rows(spark):
    docs, labels, truth = toxic_tables(spark)
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    held = [(r.score, truth[r.doc_id]) for r in scored if r.held]
    assert len(held) > 100 and all(0 <= s <= 1 for s, _ in held)
    assert sum((s >= 0.5) == bool(y) for s, y in held) / len(held) > 0.97
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns
    assert clean.count() == sum(r.score < 0.5 for r in scored)


def test_edge_rows_are_scored(spark, edges, nothing):
    docs, labels, _ = toxic_tables(spark, 300)
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(edges, model).collect()
    assert len(rows) == len(TEXTS) and all(r.score < 0.5 for r in rows)
    assert toxicity.score(nothing, model).collect() == []
    alone = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score(edges, alone).collect()} == {0.0}
    assert toxicity.fit(nothing, labels).constant == 0.0


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    docs, labels, _ = toxic_tables(spark, 300)
    drawn = toxicity.labelled_sample(docs, labels)
    repeated = docs.unionByName(docs.withColumn("text", F.concat("text", F.lit(" more")))).unionByName(docs)
    sample = toxicity.labelled_sample(repeated, labels)
    assert sample.count() == drawn.count() > 0
    again = toxicity.labelled_sample(repeated.repartition(7), labels)
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, again.collect()))


def test_copies_teach_once_however_they_are_spread(spark):
    docs, labels, _ = toxic_tables(spark, 300)
    # Forty labelled copies of one insult, their only words.
    copies = [(10_000 + i, "zebrafish quartzite marmalade") for i in range(40)]
    docs = docs.unionByName(spark.createDataFrame(copies, "doc_id long, text string"))
    labels = labels.unionByName(spark.createDataFrame([(i, 1) for i, _ in copies], "doc_id long, toxic int"))
    spread, together = (toxicity.fit(docs.repartition(n, "doc_id"), labels) for n in (16, 1))
    assert "zebrafish" not in spread.terms
    assert spread.terms == together.terms
