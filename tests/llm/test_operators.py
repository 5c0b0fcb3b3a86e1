"""The corpus operators against plain versions, on a whole small table and on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eocube.llm import (
    decontamination, fingerprints, licenses, line_dedup, near_duplicates, packing, quality, queries, suffix_dedup,
    token_counts, token_files,
)
from eocube.llm.encode import encoder
from eocube.llm.spans import units
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


BASE = prose(1, 120)
NEAR = BASE.split()
NEAR[60] = "changed"
ODD = [
    (1, None), (2, ""), (3, " \n\t \x0b"), (4, "one two"), (5, "one  TWO"), (6, BASE), (7, BASE), (8, BASE.upper()),
    (9, " ".join(NEAR)), (9, "another text of the same document id"), (9, "another text of the same document id"),
    (None, BASE), (None, "no id"), (10, "x" * 70_000), (11, (prose(2, 3000) + "\n") * 4), (12, prose(3, 50) + " naïve café — 漢字   x"),
    (13, "a line that three documents hold\nother\nA line that three documents HOLD  \n"),
    (14, "a line that three documents hold"), (15, "\ta line that three documents hold\n\nkept"),
    (16, "ab<|endoftext|> cd <|endoftext|>"), (17, "it's we'll 'S don't  1234  ...!!\r\n\r\n  z"), (-4, "negative id"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows in a table with extra columns whose names the operators use themselves."""
    extra = ["row", "h", "pos", "line", "part", "node", "_stats", "_kept", "words", "bucket"]
    df = spark.createDataFrame(ODD, "doc_id bigint, text string").repartition(3)
    return df.select(F.lit("x").alias("lang"), *(F.lit(i).alias(c) for i, c in enumerate(extra)), "text", "doc_id")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("1 = 0")


@pytest.fixture(scope="module")
def whole(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


def rows(df):
    return [tuple(r) for r in df.collect()]


def ordered(values):
    return sorted(values, key=lambda r: tuple((x is not None, x) for x in r))


# 1 -----------------------------------------------------------------------


def test_repeats_on_a_table(spark, whole):
    got = {r[0]: r[1:] for r in rows(queries.op1_suffix_dedup(spark, FOLDER))}
    assert got == dict(zip((i for i, _ in whole), brute.remove_repeats([t for _, t in whole], 200)))


@pytest.mark.parametrize("length, gram", [(200, 32), (40, 16), (33, 8)])
def test_repeats_on_odd_rows(odd, length, gram):
    got = rows(suffix_dedup.remove_repeats(odd, length=length, gram=gram).drop("spans"))
    want = [(i, *r) for (i, _), r in zip(ODD, brute.remove_repeats([t for _, t in ODD], length))]
    assert ordered(got) == ordered(want)


def test_crowded_anchors_give_the_same(odd, monkeypatch):
    want = ordered(rows(suffix_dedup.remove_repeats(odd, length=40, gram=16).drop("spans")))
    monkeypatch.setattr(suffix_dedup, "SHARE_CONTEXTS", 1)
    assert ordered(rows(suffix_dedup.remove_repeats(odd, length=40, gram=16).drop("spans"))) == want


@pytest.mark.parametrize("text", ["abracadabra", "aaaaaaaaaaaa", "mississippi" * 9, "ab" * 30 + "c"])
def test_suffix_array(text):
    s = np.frombuffer(text.encode(), np.uint8).astype(np.int64)
    depth = len(text) + 1
    assert suffix_dedup.suffix_array(s, depth).tolist() == sorted(range(len(s)), key=lambda i: text[i:])
    short = suffix_dedup.suffix_array(s, 4)
    assert [text[i : i + 4] for i in short] == sorted(text[i : i + 4] for i in range(len(s)))


def test_repeats_of_long_pieces(spark, monkeypatch):
    """A text longer than a piece is cut with an overlap."""
    monkeypatch.setattr(suffix_dedup, "PIECE", 500)
    texts = [prose(4, 400), prose(5, 100) + prose(4, 400)[700:1500], "y" * 900]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [r[1:] for r in sorted(rows(suffix_dedup.remove_repeats(df).drop("spans")))]
    assert got == brute.remove_repeats(texts, 200)


# 2 and 5 -----------------------------------------------------------------


def test_token_files_on_a_table(spark, whole):
    want, at = [], 0
    for i, t in whole:
        ids = brute.encode(t) + [2]
        want.append((i, at, len(ids), brute.crc(ids)))
        at += len(ids)
    assert sorted(rows(queries.op2_token_files(spark, FOLDER))) == want


def test_token_files_of_odd_rows(spark, odd, tmp_path):
    manifest = token_files.write_token_files(odd, str(tmp_path / "t"), brute.PATH, end_id=2, width=16, batch=3)
    got = rows(token_files.read_documents(manifest))
    sizes = Counter((i, len(brute.encode(t)) + 1, brute.crc(brute.encode(t) + [2])) for i, t in ODD)
    assert Counter((i, n, c) for i, _, n, c in got) == sizes
    by_start = sorted(got, key=lambda r: r[1])
    assert [r[1] for r in by_start] == [0, *itertools.accumulate(r[2] for r in by_start)][:-1]
    assert [r[0] for r in by_start] == sorted((r[0] for r in got), key=lambda i: (i is not None, i))
    # random access: every sequence by its number, the masked ids are the stream
    for m in manifest.collect():
        count = -(-m.n_ids // 16)
        parts = [token_files.sequence(m.seq_file, k, 3) for k in range(count)]
        assert all(len(ids) == len(mask) == 16 for ids, mask in parts)
        flat = np.concatenate([ids[mask] for ids, mask in parts])
        assert len(flat) == m.n_ids
        source = pa.ipc.open_file(pa.memory_map(m.seq_file))
        assert {source.get_batch(k).num_rows for k in range(source.num_record_batches - 1)} <= {3}


def test_empty_tables(spark, empty, tmp_path):
    bench = spark.createDataFrame([(1, BASE)], "item_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    manifest = token_files.write_token_files(empty, str(tmp_path / "t"), brute.PATH, end_id=2)
    results = [
        suffix_dedup.remove_repeats(empty), token_files.read_documents(manifest), quality.quality_scores(empty, labels),
        near_duplicates.near_duplicates(empty), token_counts.token_counts(empty, brute.PATH), fingerprints.fingerprints(empty),
        licenses.license_matches(empty, licenses.notices(spark)), decontamination.benchmark_passages(empty, bench),
        packing.best_fit_packing(empty, brute.PATH), line_dedup.line_dedup(empty),
    ]
    for df in results:
        assert df.collect() == []
    for df in (
        quality.drop_low_quality(empty, labels), line_dedup.drop_repeated_lines(empty),
        near_duplicates.drop_near_duplicates(empty), decontamination.drop_contaminated(empty, bench),
    ):
        assert df.columns == empty.columns and df.count() == 0


@pytest.mark.parametrize("chunk", [7, 65_536])
def test_token_counts_of_odd_rows(odd, chunk):
    got = rows(token_counts.token_counts(odd, brute.PATH, chunk_chars=chunk) if chunk > 100 else token_counts.token_counts(
        odd.where("length(text) < 5000 or text is null"), brute.PATH, chunk_chars=chunk))
    want = []
    for i, t in ODD:
        if chunk > 100 or t is None or len(t) < 5000:
            n = len(brute.encode(t))
            want.append((i, len((t or "").encode()), n, n > 512))
    assert ordered(got) == ordered(want)


def test_token_counts_on_a_table(spark, whole):
    want = [(i, len(t.encode()), n := len(brute.encode(t)), n > 512) for i, t in whole]
    assert sorted(rows(queries.op5_token_counts(spark, FOLDER))) == want


def test_transducer_on_random_strings():
    machine = token_counts.Transducer(brute.PATH)
    rng = random.Random(3)
    alphabet = "abcdefthe ing'sll \t\n0129.,!éü漢— 　ß🙂"
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        assert machine.count(text) == len(brute.encode(text)), text


def test_chunk_summaries_compose_in_any_grouping():
    machine = token_counts.Transducer(brute.PATH)
    count = lambda b: machine.count(b.decode())
    one, two, three = (b"ab", 3, b" cd"), (b"ef", 0, None), (b"gh", 2, b" i")
    joined = (one[0], one[1], one[2] + two[0])  # a chunk without a boundary extends its neighbour
    assert token_counts.compose([one, two, three], count) == token_counts.compose([joined, three], count)


def test_units_encode_one_by_one(whole):
    enc = encoder(brute.PATH)
    texts = [t for _, t in whole[:40]] + [t for _, t in ODD]
    column = pa.array(texts, pa.string())
    got = {}
    for i, ids, offsets in enc.encode(column, 2):
        for k in range(len(offsets) - 1):
            got[i + k] = ids[offsets[k] : offsets[k + 1]].tolist()
    assert got == {k: brute.encode(t) + [2] for k, t in enumerate(texts)}
    buf = np.frombuffer("a b  c\n\nd".encode(), np.uint8)
    start, end, _ = units(buf, np.array([0, len(buf)]))
    assert [buf[s:e].tobytes().decode() for s, e in zip(start, end)] == ["a", " b  c", "\n\nd"]


# 3 -----------------------------------------------------------------------


def test_quality_is_learnt_from_open_rows_only(spark):
    got = queries.op3_quality_rules(spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert got.count() == docs.count()
    assert got.where("score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0
    assert got.where("held_out <> (crc32(cast(doc_id as string)) % 5 = 0)").count() == 0
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.quality_scores(docs, flipped)
    assert sorted(rows(got)) == sorted(rows(again))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op3_quality_rules(spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    pairs = [(r.score, r.quality, r.predicted) for r in got.collect()]
    good, bad = [s for s, q, _ in pairs if q == 1], [s for s, q, _ in pairs if q == 0]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.9 and sum(q == p for _, q, p in pairs) / len(pairs) > 0.93


def test_rules_equal_their_columns(spark):
    text = """
  Tree 0 (weight 1.0):
    If (feature 3 <= 0.5)
     If (feature 0 <= 2.0)
      Predict: 0.0
     Else (feature 0 > 2.0)
      Predict: 1.0
    Else (feature 3 > 0.5)
     Predict: 1.0"""
    found = quality.tree_rules(text)
    assert found == {((3, False, 0.5),), ((3, True, 0.5),), ((0, False, 2.0), (3, False, 0.5)), ((0, True, 2.0), (3, False, 0.5))}


def test_quality_without_labels_is_constant(spark, odd):
    labels = spark.createDataFrame([(4, 1), (6, None), (None, 0)], "doc_id bigint, quality int")
    got = rows(quality.quality_scores(odd, labels))
    assert len(got) == len(ODD) and len({r[2] for r in got}) == 1
    assert quality.drop_low_quality(odd, labels).columns == odd.columns


def test_statistics_of_plain_texts():
    texts = ["", "aa aa bb\nCC", "x | y | z", "WORD!! WORD!!"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    got = {n: c for n, c in zip(quality.STATISTICS, quality.statistics(np.frombuffer(data, np.uint8), offsets).T)}
    assert got["repeated_next"].tolist() == [0, 0.25, 0, 0.5]
    assert got["distinct_words"].tolist() == [0, 0.75, 0.8, 0.5]
    assert got["marked_words"].tolist() == [0, 0, 0, 1]
    assert got["bare_words"].tolist() == [0, 0, 0.4, 0]
    assert got["distinct_lines"].tolist() == [0, 1, 1, 1]


# 4 -----------------------------------------------------------------------


def test_components_on_a_table(spark, whole):
    want = brute.components(whole)
    got = rows(queries.op4_near_duplicates(spark, FOLDER))
    assert sorted(got) == [(i, len(brute.shingles(t)), want[i], want[i] == i) for i, t in whole]


def test_components_of_odd_rows(odd):
    want = brute.components(ODD)
    got = rows(near_duplicates.near_duplicates(odd))
    rule = [(i, len(brute.shingles(t)), None if i is None else want[i], i is None or want[i] == i) for i, t in ODD]
    assert ordered(got) == ordered(rule)
    kept = near_duplicates.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    stay = [i for i, _ in rows(kept.select("doc_id", "text"))]
    assert sorted(i for i in stay if i is not None) == sorted({i for i in want if want[i] == i}) and stay.count(None) == 2


@pytest.mark.parametrize("rounds", [0, 2])
def test_a_group_whose_pairs_lie_around_the_limit(spark, monkeypatch, rounds):
    """Also without hubs, blocks of three rows find every link between components."""
    monkeypatch.setattr(near_duplicates, "HUB_ROUNDS", rounds)
    monkeypatch.setattr(near_duplicates, "BLOCK_ROWS", 3)
    rng = random.Random(5)
    base, docs = prose(6, 200).split(), []
    for i in range(40):
        w = list(base)
        for _ in range(rng.randrange(1, 9)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    want = brute.components(docs)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r[0]: r[2] for r in rows(near_duplicates.near_duplicates(df))} == want


def test_star_rounds(spark):
    edges = [(k, k + 1) for k in range(30)] + [(40, 41), (50, 45), (45, 41), (60, 60)]
    got = dict(rows(near_duplicates.components(spark.createDataFrame(edges, "u bigint, v bigint"))))
    assert got == {**{k: 0 for k in range(31)}, 40: 40, 41: 40, 45: 40, 50: 40}


def test_shared_counts():
    one = [np.array(sorted(s), np.int64) for s in ({1, 2, 3}, {5}, set())]
    two = [np.array(sorted(s), np.int64) for s in ({2, 3, 9}, {7, 5})]
    assert near_duplicates.shared_counts(one, two)[0].tolist() == [[2, 0], [0, 1], [0, 0]]


# 6 -----------------------------------------------------------------------


def check_fingerprints(got, docs):
    """``docs`` in descending order; the next of the last is the first."""
    errors = []
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        n, sha, own, other, near, following = got[i]
        assert (n, sha) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        bags = [Counter(x.encode().split() or [b""]) for x in (text, changed, after)]
        like = lambda a, b: sum((a & b).values()) / sum((a | b).values())
        errors += [near - like(bags[0], bags[1]), following - like(bags[0], bags[2])]
        if bags[0] == bags[2]:
            assert following == 1
    return errors


def test_fingerprints_on_a_table(spark, whole):
    got = {r[0]: r[1:] for r in rows(queries.op6_fingerprints(spark, FOLDER))}
    errors = check_fingerprints(got, whole[::-1])
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.1
    by_text = defaultdict(set)
    for i, t in whole:
        by_text[t].add(got[i][2])
    assert all(len(v) == 1 for v in by_text.values())


def test_fingerprints_of_odd_rows(spark, odd):
    got = rows(fingerprints.fingerprints(odd))
    assert ordered(r[:2] for r in got) == ordered((i, len(t or "")) for i, t in ODD)
    single = spark.createDataFrame([(7, "just one text")], "doc_id bigint, text string")
    one = rows(fingerprints.fingerprints(single))[0]
    assert one[6] == 1.0 and one[2] == hashlib.sha256(b"just onjust o").hexdigest()
    unique = [(i, t or "") for i, t in ODD if i not in (9, None)]
    df = spark.createDataFrame(unique, "doc_id bigint, text string")
    check_fingerprints({r[0]: r[1:] for r in rows(fingerprints.fingerprints(df))}, sorted(unique, reverse=True))


# 7 -----------------------------------------------------------------------


def test_licenses_on_a_table(spark, whole):
    got = {(r.doc_id, r.license_id) for r in queries.op7_license_scan(spark, FOLDER).collect()}
    lines = {
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "MIT": "Released under the MIT License.",
    }
    assert got == {(i, k) for i, t in whole for k, x in lines.items() if x in t}


def test_licenses_with_changes(spark, odd):
    notice = licenses.NOTICES[1][1]
    words = notice.split()
    one = " ".join([words[0], "CHANGED", *words[2:]])
    texts = ["", None, notice.upper(), f"{prose(1, 31)}\n{notice}\n{prose(2, 9)}", one, " ".join(words[:9]), prose(9, 300),
             " ".join(words[::-1])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    templates = spark.createDataFrame([("A", notice), ("B", "too short"), ("C", None), ("D", "Released under the MIT License.")], "license_id string, text string")
    got = {r.doc_id: (r.license_id, r.percent) for r in licenses.license_matches(df, templates).collect()}

    def containment(text):
        split = lambda t: [w for w in "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()]
        grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        must = grams(split(notice))
        return 100 * len(must & grams(split(text))) // len(must)

    assert got == {i: ("A", containment(t)) for i, t in enumerate(texts) if containment(t) >= 75}
    assert set(got) == {2, 3, 4}
    assert licenses.license_matches(odd, templates).count() == 0


FREE = """This program is free software: you can redistribute it and/or modify it under the terms of the {} as published
by the Free Software Foundation, either version {} of the License, or (at your option) any later version."""
OTHERS = [
    (FREE.format("GNU General Public License", "2"), "GPL-2.0"), (FREE.format("GNU General Public License", "3"), "GPL-3.0"),
    (FREE.format("GNU Lesser General Public License", "3"), "LGPL-3.0"), (FREE.format("GNU Affero General Public License", "3"), "AGPL-3.0"),
    (FREE.format("GNU Lesser General Public License", "2.1").replace("program", "library"), "LGPL-2.1"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("It is distributed under the GNU Lesser General Public License v2.1.", "LGPL-2.1"), ("Licensed under the GNU GPL v3.", "GPL-3.0"),
    ("Licensed under the MIT License.", "MIT"), ("This may be used under the terms of the MIT license.", "MIT"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("Licensed under CC BY-SA 3.0.", "CC-BY-SA-3.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 3.0 Unported License.", "CC-BY-NC-3.0"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "ISC"),
    ("Released under the BSD 3-Clause License.", "BSD-3-Clause"), ("Released under the Simplified BSD License.", "BSD-2-Clause"),
    ("Released under CC0 1.0.", "CC0-1.0"), ("Released under the Mozilla Public License 1.1.", "MPL-1.1"),
    ("SPDX-License-Identifier: LGPL-2.1-only", "LGPL-2.1"), ("Licensed under the Apache License 2.0.", "Apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 7.", None), ("Licensed under CC BY-XY 4.0.", None),
]


@pytest.mark.parametrize("broadcast_words", [200_000, 0])
def test_licenses_of_notices_outside_the_tables(spark, monkeypatch, broadcast_words):
    monkeypatch.setattr(licenses, "BROADCAST_WORDS", broadcast_words)
    texts = [f"{prose(30 + k, k)}\n{t}\n{prose(70 + k, 120)}" for k, (t, _) in enumerate(OTHERS)]
    pair = (len(texts), f"{OTHERS[0][0]}\n{prose(3, 200)}\n{OTHERS[3][0]}")
    df = spark.createDataFrame([*enumerate(texts), pair], "doc_id bigint, text string")
    got = {(r.doc_id, r.license_id) for r in licenses.license_matches(df, licenses.notices(spark)).collect()}
    assert got == {(k, i) for k, (_, i) in enumerate(OTHERS) if i} | {(pair[0], "GPL-2.0"), (pair[0], "AGPL-3.0")}


def test_the_best_contained_license_counts(spark):
    one = "this text may be passed on under the rules of the green book"
    templates = spark.createDataFrame([("green", one), ("red", one.replace("green book", "red book"))], "license_id string, text string")
    df = spark.createDataFrame([(1, one), (2, one.replace("green", "red"))], "doc_id bigint, text string")
    assert {(r.doc_id, r.license_id) for r in licenses.license_matches(df, templates).collect()} == {(1, "green"), (2, "red")}


def test_licenses_without_broadcast(spark, whole, monkeypatch):
    want = sorted(rows(queries.op7_license_scan(spark, FOLDER)))
    monkeypatch.setattr(licenses, "BROADCAST_WORDS", 0)
    assert sorted(rows(queries.op7_license_scan(spark, FOLDER))) == want


# 8 -----------------------------------------------------------------------


def test_masks_find_every_window():
    """Whatever two of thirteen words are substituted, some mask lies on equal words alone."""
    n, span = decontamination.SUBSTITUTIONS, decontamination.SPAN
    for wrong in itertools.combinations(range(span), n):
        assert any(
            all(not (c == "1" and at + k in wrong) for k, c in enumerate(mask))
            for mask in decontamination.MASKS for at in range(span - len(mask) + 1)
        ), wrong


def test_passages_on_a_table(spark, whole):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id) for r in queries.op8_decontamination(spark, FOLDER).collect()}
    docs = whole[:60] + [d for d in whole if any(i == d[0] for i, _ in got)]
    ids = {i for i, _ in docs}
    assert brute.passages(docs, items) == {p for p in got if p[0] in ids}


@pytest.mark.parametrize("block_words", [1_000_000, 5])
def test_passages_with_substitutions(spark, odd, monkeypatch, block_words):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block_words)
    item, short = prose(21, 30), "five words as a whole"
    w = item.split()
    edits = lambda *at: " ".join("wrong" if k in at else x for k, x in enumerate(w))
    texts = [
        f"{prose(22, 40)} {item.upper()}, {prose(23, 20)}", edits(3, 9, 16, 22, 29), edits(*range(0, 30, 3)), " ".join(w[8:21]),
        " ".join(w[8:20]), f"so: Five words, as a whole!", "five words as a", None, "", " ".join([*w[:15], "in", "between", *w[15:]]),
    ]
    docs = list(enumerate(texts))
    items = [(1, item), (2, short), (3, "too short"), (4, None), (5, ""), (6, item)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.benchmark_passages(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute.passages(docs, items)
    first = next(r for r in got if (r.doc_id, r.item_id) == (0, 1))
    assert (first.doc_word, first.item_word, first.n_words, first.n_equal) == (40, 0, 30, 30)
    clean = {r.doc_id for r in decontamination.drop_contaminated(df, bench).collect()}
    assert clean == {i for i, _ in docs} - {r.doc_id for r in got}
    left = decontamination.drop_contaminated(odd, bench)
    assert left.columns == odd.columns and left.count() == len(ODD)


# 9 -----------------------------------------------------------------------


def check_packing(got, docs, capacity=2048):
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    want = defaultdict(Counter)
    for i, t in docs:
        ids = brute.encode(t) + [0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i][k, a, b - a, brute.crc(ids[a:b])] += 1
    assert {i: Counter((r.piece, r.start, r.length, r.ids_crc32) for r in v) for i, v in pieces.items()} == want
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(filled), -(-sum(r.length for r in got) // capacity)


def test_packing_on_a_table(spark, whole):
    bins, least = check_packing(queries.op9_best_fit_packing(spark, FOLDER).collect(), whole)
    assert bins <= least + 2


def test_packing_of_odd_rows(odd):
    check_packing(packing.best_fit_packing(odd, brute.PATH).collect(), ODD)


def test_packing_in_many_small_blocks(spark):
    rng = random.Random(2)
    items = [(k, rng.randrange(1, 1200)) for k in range(900)]
    df = spark.createDataFrame(items, "item bigint, length bigint")
    got = packing.pack(df, capacity=2048, block=100).collect()
    assert sorted(r.item for r in got) == list(range(900))
    room = defaultdict(int)
    for r in got:
        room[r.sequence_id] += items[r.item][1]
    assert max(room.values()) <= 2048 and len(room) <= -(-sum(n for _, n in items) // 2048) * 1.01 + 1


def test_crossover_keeps_every_item():
    rng = np.random.default_rng(1)
    packer = packing.Packer(rng.integers(1, 900, 300).tolist(), 2048, 4)
    one, two = packer.start(), packer.start()
    for _ in range(10):
        child = packer.cross(one, two)
        assert sorted(i for b in child for i in b) == list(range(300))
        assert packer.fullness(child).max() <= 1
        one, two = two, child


# 10 ----------------------------------------------------------------------


def test_lines_match_sql(spark):
    con = connect(FOLDER)
    assert compare(queries.op10_line_dedup(spark, FOLDER), con, queries.ORACLE_SQL["op10_line_dedup"]) == []


def test_lines_of_odd_rows(odd):
    got = rows(line_dedup.line_dedup(odd).drop("keep_map"))
    assert ordered(got) == ordered(brute.line_dedup(ODD))
    first = line_dedup.line_dedup(odd, keep="first").where("n_dropped > 0")
    assert {r.doc_id for r in first.collect()} == {6, 7, 8, 14, 15}
    kept = line_dedup.drop_repeated_lines(odd)
    assert kept.columns == odd.columns
    by_id = {r.doc_id: r.text for r in kept.where("doc_id > 12").collect()}
    assert by_id[13] == "other\n" and by_id[14] == "" and by_id[15] == dict(ODD)[15]


def test_first_occurrences_follow_the_order(spark, odd, monkeypatch):
    """The plan that counts documents sorts by document and position within the ranges, and shuffles once before."""
    plans, write = {}, line_dedup.written

    def recorded(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(line_dedup, "written", recorded)
    line_dedup.dropped_lines(odd)
    before, ranges = plans["repeated-lines"].split("rangepartitioning")
    assert "pos" in ranges.split("FileScan")[1].split("]")[0]
    assert "row_number() windowspecdefinition(h" in before and "Sort [h" in before
    assert before.count("Exchange") == 2 and "hashpartitioning(h" in before


def test_bitmaps(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d", "e"], [0, 2, 3])], "lines array<string>, at array<int>")
    coded = "unhex('000000000000000100000000')"
    out = df.select(
        line_dedup.dropped_gaps(F.expr(coded)).alias("gaps"),
        line_dedup.kept_text(F.array_join("lines", "\n"), F.expr(coded)).alias("kept"),
    ).first()
    assert out.gaps == [0, 1, 0] and out.kept == "b\ne"
