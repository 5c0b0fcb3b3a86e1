"""Clustering, ranked search and sentence pieces against plain versions; hashes that must not collide."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from test_operators import FOLDER, ODD, empty, odd, ordered, prose, rows  # noqa: F401

from eocube.llm import (
    clustering, decontamination, fingerprints, lexical_search, licenses, line_dedup, near_duplicates, packing, quality, queries, sentence_pieces, suffix_dedup, token_counts,
    token_files,
)
from eocube.llm.encode import UnitTable
from oracle import compare, connect

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


# 11 ----------------------------------------------------------------------


def plain_clusters(vectors, clusters=8, rounds=10, scale=1024, seed=3):
    """``(id, cluster, distance, cluster_inertia, inertia, hash)`` of ``(id, list)`` in Python integers."""
    v = [(i, [math.floor(scale * float(np.float32(x))) for x in e]) for i, e in vectors]
    digest = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    first = sorted(v, key=lambda r: (r[0] is None, digest(r[0]) if r[0] is not None else "", r[1]))
    centroids = [x for _, x in first[:clusters]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        member = [nearest(x)[1] for _, x in v]
        for k in range(len(centroids)):
            own = [x for (_, x), m in zip(v, member) if m == k]
            if own:
                centroids[k] = [sum(c) // len(own) for c in zip(*own)]
    placed = [(i, *nearest(x)[::-1]) for i, x in v]
    inertia = Counter()
    for _, k, d in placed:
        inertia[k] += d
    name = lambda k: hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()
    return [(i, k, d, inertia[k], sum(inertia.values()), name(k)) for i, k, d in placed]


def test_clusters_match_sql(spark):
    con = connect(FOLDER)
    assert compare(queries.op11_centroid_clusters(spark, FOLDER), con, queries.ORACLE_SQL["op11_centroid_clusters"]) == []


@pytest.mark.parametrize("clusters, rounds", [(3, 4), (8, 10), (40, 2)])
def test_clusters_of_odd_vectors(spark, clusters, rounds):
    rng = random.Random(5)
    good = [(i, [rng.uniform(-2, 2) for _ in range(4)]) for i in range(20)]
    good += [(20, good[0][1]), (20, good[0][1]), (None, [0.0] * 4), (None, [1.0, -1.0, 0.5, 0.0]), (21, [0.0, -0.0, 1e-30, -1e-30])]
    bad = [(30, None), (31, []), (32, [1.0] * 3), (33, [1.0] * 5), (34, [1.0, None, 0.0, 0.0]), (35, [float("nan")] * 4), (36, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(good + bad, "vec_id bigint, embedding array<float>").withColumn("v", F.lit(1)).withColumn("x", F.lit(1))
    got = rows(clustering.cluster_vectors(df, clusters=clusters, rounds=rounds, size=4))
    assert ordered(got) == ordered(plain_clusters(good, clusters, rounds))
    nothing = clustering.cluster_vectors(df.where("vec_id > 29"), size=4)
    assert rows(nothing) == [] and nothing.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_too_large_components_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e30])], "vec_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="too large"):
        clustering.cluster_vectors(df, size=1).collect()


# 12 ----------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_search(docs, items, limit=10):
    terms = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n_docs, n_terms = sum(bool(t) for t in terms), sum(map(len, terms))
    tf = [Counter(t) for t in terms]
    df = Counter(w for t in tf for w in t)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    out = []
    for item, words in asked.items():
        scored = []
        for (doc_id, _), t, n in zip(docs, tf, map(len, terms)):
            m = 100 - 90 + (90 * n * n_docs) // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * t[w]) // (1000 * t[w] + 8 * m)) for w in words if t[w])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:limit])]
    return out


def test_search_matches_sql(spark):
    assert compare(queries.op12_ranked_search(spark, FOLDER), connect(FOLDER), queries.ORACLE_SQL["op12_ranked_search"]) == []


ITEMS = [(1, "theta iota alpha3"), (2, None), (3, "the the NAÏVE café — 漢字"), (4, "nothing-of-this occurs"), (None, "one two"), (1, "changed TWO"), (5, ""), (6, prose(2, 200)), (7, "x" * 70_000)]


@pytest.mark.parametrize("shard_bytes, pairs", [(16 << 20, 200_000), (1, 3), (5_000, 40)])
def test_search_of_odd_rows(spark, odd, monkeypatch, shard_bytes, pairs):  # noqa: F811
    monkeypatch.setattr(lexical_search, "BLOCK_PAIRS", pairs)
    monkeypatch.setattr(lexical_search, "BLOCK", 2 if shard_bytes == 5_000 else 128)
    monkeypatch.setattr(lexical_search, "PIECE_BYTES", 1_000)
    index = lexical_search.build_index(odd, shard_bytes=shard_bytes)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("item", F.lit(0)).withColumn("term", F.lit("x"))
    for limit in (1, 3, 10):
        assert ordered(rows(lexical_search.search(index, items, limit=limit))) == ordered(plain_search(ODD, ITEMS, limit))


def test_search_of_empty_tables(spark, odd, empty):  # noqa: F811
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert rows(lexical_search.search(lexical_search.build_index(empty), items)) == []
    index = lexical_search.build_index(odd.where("text is null"))
    assert rows(lexical_search.search(index, items)) == []
    assert rows(lexical_search.search(lexical_search.build_index(odd), items.where("1 = 0"))) == []


def test_bounds_reject_blocks_unopened():
    """A common term's blocks that cannot reach the best score stay compressed, and nothing is lost."""
    builder = lexical_search.ShardBuilder()
    texts = ["common " * (40 if i % 900 == 0 else 1) + "filler " * 30 + ("rare common" if i % 900 == 0 else "") for i in range(20_000)]
    column = pa.array(texts)
    for i, j, buf, offsets in lexical_search.pieces(column):
        builder.add(pa.array(range(i, j)), buf, offsets)
    frame = pa.Table.from_batches(list(builder.rows(0))).to_pandas()
    docs = frame[frame["term"].isna()].iloc[0]
    frame["weight"] = [{"rare": 9000, "common": 300}.get(t, 0) for t in frame["term"]]
    frame["items"] = [[7]] * len(frame)
    frame = frame[frame["term"].isna() | frame["term"].isin(["rare", "common"])]
    shard = lexical_search.Shard(frame, int(docs["n_docs"]), int(docs["n_terms"]))
    ((item, lists),) = shard.items
    found, score = shard.best(lists, 10)
    m = shard.m
    total = {d: sum(w * (10**9 * n // (1000 * n + 8 * int(m[d]))) for w, n in ((9000, texts[d].count("rare")), (300, texts[d].count("common"))) if n) for d in range(0, 20_000)}
    want = sorted(total.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert list(zip(found.tolist(), score.tolist())) == want
    opened = {k: int(x[0].sum()) for k, x in shard.open.items()}
    common = int(np.argmax(shard.df))
    assert opened[common] < len(shard.heads[common][0]) / 3


# 13 ----------------------------------------------------------------------

SYMBOLS = ["a", "b", "the", " ", "  ", "\n", "é", "日本", "▁", "<s>", "\x00", "\t", "😀", "é", "</s>", "<0x41>", "１", "ﬁ", "Ⅳ", "　", "ｶﾞ", "​", "½", "\xa0", "ﷺ", "A", "́", "\r", "가"]


def random_texts(seed, n):
    rng = random.Random(seed)
    return ["", None, " ", "  ", "▁", " a", "a ", *("".join(rng.choices(SYMBOLS, k=rng.randint(1, 40))) for _ in range(n))]


def field(number, payload):
    out, size = bytearray([number << 3 | 2]), len(payload)
    while size > 0x7F:
        out.append(size & 0x7F | 0x80)
        size >>= 7
    return bytes([*out, size]) + payload


@pytest.fixture(scope="module")
def mapped_models(tmp_path_factory):
    """The given vocabulary under the rules of NFKC, with every setting of blanks."""
    rules = dict(sentence_pieces.fields(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()))[3]
    out = []
    with open(MODEL, "rb") as f:
        base = f.read()
    for dummy, strip in ((1, 1), (0, 1), (1, 0), (0, 0)):
        path = tmp_path_factory.mktemp("models") / "nfkc.model"
        path.write_bytes(base + field(3, rules + bytes([3 << 3, dummy, 4 << 3, strip])))
        out.append(str(path))
    return out


def check_pieces(model, texts):
    for i, ids, ends, first in model.encode_batch(pa.array(texts, pa.string())):
        for r in range(len(first) - 1):
            text = texts[i + r] or ""
            got, span = ids[first[r] : first[r + 1]].tolist(), ends[first[r] : first[r + 1]].tolist()
            found = model.library.encode(text, return_type="offset_mapping", return_bytes=True)
            assert got == found["ids"], text
            ends_there = [z for _, z in found["offsets"]]
            whole = [not model.library.is_byte(x) for x in got]
            assert [a for a, w in zip(span, whole) if w] == [b for b, w in zip(ends_there, whole) if w], text


def test_pieces_of_random_texts():
    check_pieces(sentence_pieces.PieceModel(MODEL), random_texts(1, 2000))


def test_pieces_through_a_character_map(mapped_models):
    for k, path in enumerate(mapped_models):
        check_pieces(sentence_pieces.PieceModel(path), random_texts(k, 800))


def test_long_texts_go_in_stretches(monkeypatch, mapped_models):
    monkeypatch.setattr(sentence_pieces, "PIECE_BYTES", 50)
    for path in (MODEL, mapped_models[0]):
        check_pieces(sentence_pieces.PieceModel(path), ["".join(t or "" for t in random_texts(9, 60)), "x" * 500, " " * 300, "ab   " * 90])


def test_pieces_on_a_table(spark):
    want = {}
    for i, t in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        ids = LIBRARY.encode(t or "")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), LIBRARY.decode(ids))]
        want[i] = (len(ids), *digests, len((t or "").encode()))
    assert {r[0]: r[1:] for r in rows(queries.op13_sentence_pieces(spark, FOLDER))} == want


def test_pieces_of_odd_rows(odd, empty):  # noqa: F811
    encoded = sentence_pieces.encode_pieces(odd, MODEL)
    got = [(r[0], r[1]) for r in rows(encoded)]
    assert sorted(got, key=repr) == sorted(((i, LIBRARY.encode(t or "")) for i, t in ODD), key=repr)
    for doc_id, ids, ends, text in rows(sentence_pieces.decode_pieces(encoded, MODEL)):
        assert text == LIBRARY.decode(ids) and len(ends) == len(ids) and ends == sorted(ends)
    assert rows(sentence_pieces.piece_digests(empty, MODEL)) == []


# 8: repeated words -------------------------------------------------------


def found_passages(docs, items):
    block = decontamination.Benchmark(list(range(len(items))), items)
    return [
        (hit[0] + i, *hit[1:])
        for i, _, buf, offsets in decontamination.pieces(pa.array(docs, pa.string()))
        for hit in block.passages(*decontamination.word_hashes(buf, offsets))
    ]


def test_repeated_words_are_one_stretch():
    assert found_passages(["the " * 100_000], ["the " * 100]) == [(0, 0, 0, 0, 100_000, 100_000)]


def test_passages_of_few_words_against_brute_force():
    rng = random.Random(1)
    for words in (2, 3, 200):
        letters = [f"w{k}" for k in range(words)]
        for _ in range(60):
            items = [" ".join(rng.choices(letters, k=rng.randint(3, 30))) for _ in range(3)]
            docs = [" ".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(4)]
            docs.append(" ".join(w if rng.random() > 0.1 else "other" for w in (items[0] + " " + items[1]).split()))
            got = {(d, i) for d, i, *_ in found_passages(docs, items)}
            assert got == brute.passages(list(enumerate(docs)), list(enumerate(items)))


def test_the_benchmark_comes_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 20)
    items = spark.createDataFrame([(k, prose(30 + k % 5, 40)) for k in range(50)], "item_id bigint, text string")
    texts, members = decontamination.numbered_texts(items)
    assert texts.count() == 5 and members.count() == 50
    assert iter(decontamination.blocks(texts)) and sum(len(b.ids) for b in decontamination.blocks(texts)) == 5
    docs = spark.createDataFrame([(1, prose(32, 40))], "doc_id bigint, text string")
    got = decontamination.benchmark_passages(docs, items).collect()
    assert sorted(r.item_id for r in got) == [k for k in range(50) if k % 5 == 2]


# hashes, numbering and rare labels ---------------------------------------


def doubled(a, b, size):
    """Two texts whose linear byte hashes are equal whatever the base."""
    swap, text = str.maketrans(a + b, b + a), a
    while len(text) < size:
        text += text.translate(swap)
    return text, text.translate(swap)


DOUBLED = [(k, t) for k, t in enumerate(t for n in (1024, 2048, 4096) for a, b in ("ab", "th") for t in doubled(a, b, n))]


@pytest.fixture(scope="module")
def doubled_rows(spark):
    return spark.createDataFrame(DOUBLED, "doc_id bigint, text string").repartition(1)


def test_doubled_texts_keep_their_ids(spark, doubled_rows, tmp_path):
    files = token_files.write_token_files(doubled_rows, str(tmp_path / "t"), brute.PATH, end_id=2)
    assert {r[0]: r[3] for r in rows(token_files.read_documents(files))} == {i: brute.crc([*brute.encode(t), 2]) for i, t in DOUBLED}
    counts = token_counts.token_counts(doubled_rows, brute.PATH)
    assert {r[0]: r[2] for r in rows(counts)} == {i: len(brute.encode(t)) for i, t in DOUBLED}
    parts = rows(packing.best_fit_packing(doubled_rows, brute.PATH))
    single = {p[0]: p[4] for p in parts if p[1] == 0 and p[3] == len(brute.encode(DOUBLED[p[0]][1])) + 1}
    assert single and all(crc == brute.crc([*brute.encode(DOUBLED[i][1]), 0]) for i, crc in single.items())


def test_doubled_texts_stay_apart(doubled_rows):
    assert all(r[0] == r[2] and r[3] for r in rows(near_duplicates.near_duplicates(doubled_rows)))


def test_units_with_one_hash_keep_their_numbers(monkeypatch):
    """A hash that collides in every way it can: only the seed tells ranges apart."""
    from eocube.llm import encode

    real = encode.range_hashes
    monkeypatch.setattr(encode, "range_hashes", lambda buf, s, e, seed=0: real(buf, s, e, seed) % np.uint64(7 if seed < 3 else 2**63))
    buf = np.frombuffer(b"".join(b"%03d" % i for i in [*range(50), *range(50)]), np.uint8)
    start = np.arange(0, len(buf), 3)
    table = UnitTable(1000)
    numbers, new, emptied = table.number(buf, start, start + 3)
    assert emptied and len(new) == 50 and numbers.tolist() == [*range(50), *range(50)]
    again, new, emptied = table.number(buf[:30], start[:10], start[:10] + 3)
    assert again.tolist() == list(range(10)) and not len(new) and not emptied


def test_repeats_when_the_cores_change(spark, tmp_path):
    """Splits depend on the cores; the rows keep their numbers."""
    docs = spark.createDataFrame([(i, prose(i % 40, 60)) for i in range(400)], "doc_id bigint, text string")
    path = str(tmp_path / "docs")
    docs.repartition(24).write.parquet(path)
    want = sorted(rows(suffix_dedup.remove_repeats(spark.read.parquet(path)).drop("spans")))
    spark.conf.set("spark.sql.files.minPartitionNum", 24)
    try:
        lazy = suffix_dedup.remove_repeats(spark.read.parquet(path)).drop("spans")
        spark.conf.set("spark.sql.files.minPartitionNum", 2)
        assert sorted(rows(lazy)) == want
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    plain = brute.remove_repeats([prose(i % 40, 60) for i in range(400)], 200)
    assert want == [(i, *plain[i]) for i in range(400)]


def test_rare_labels_give_a_constant_score(spark):
    docs = spark.createDataFrame([(i, prose(i, 5)) for i in range(6000)], "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 1000 != 7).cast("int").alias("quality"))
    scores = {r.score for r in quality.quality_scores(docs, labels).select("score").distinct().collect()}
    assert all(0 <= s <= 1 for s in scores)
    assert quality.drop_low_quality(docs, labels).count() == 6000


# 3: a score by hand ------------------------------------------------------


def test_scores_are_the_weighted_rules(spark):
    """The compiled column equals the rules applied one by one to the statistics in Python."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    stats = quality.with_statistics(docs.select("doc_id", "text"))
    model = quality.fit_rules(quality.learning_rows(stats, labels, "quality", 20_000))
    assert model.rules
    got = {r.doc_id: r.score for r in stats.select("doc_id", model.score().alias("score")).collect()}
    for r in stats.select("doc_id", "text").collect():
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        row = quality.statistics(data, np.array([0, len(data)]))[0]
        hold = lambda rule: all((row[i] > t) == above for i, above, t in rule)
        logit = model.intercept + sum(w for w, rule in model.rules if hold(rule))
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-logit)), rel=1e-9)


# long texts and odd tables through everything ----------------------------


def test_texts_beyond_a_piece(spark):
    """Texts of more than 2 MB, one of them without white space, through every operator on documents."""
    words = prose(77, 40_000)
    long = [(1, words * 8), (2, "".join(words.split()) * 9), (3, words[:300])]
    df = spark.createDataFrame(long, "doc_id bigint, text string").repartition(2)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id bigint, quality int")
    ids = {i: brute.encode(t) for i, t in long}
    assert {r[0]: r[2] for r in rows(token_counts.token_counts(df, brute.PATH))} == {i: len(x) for i, x in ids.items()}
    files = token_files.write_token_files(df, token_files_folder(spark), brute.PATH, end_id=2)
    assert {r[0]: r[3] for r in rows(token_files.read_documents(files))} == {i: brute.crc([*x, 2]) for i, x in ids.items()}
    assert sum(r.length for r in packing.best_fit_packing(df, brute.PATH).collect()) == sum(len(x) + 1 for x in ids.values())
    assert {r[0]: r[1] for r in rows(sentence_pieces.piece_digests(df, MODEL))} == {i: len(LIBRARY.encode(t)) for i, t in long}
    removed = {r[0]: r[1:3] for r in rows(suffix_dedup.remove_repeats(df).drop("spans"))}
    assert removed[1][0] == removed[1][1] and removed[2][0] == removed[2][1] and removed[3] == (300, 300)
    assert all(r[3] for r in rows(near_duplicates.near_duplicates(df)))
    assert quality.quality_scores(df, labels).count() == 3
    assert rows(line_dedup.line_dedup(df).select("doc_id", "n_lines", "n_dropped").orderBy("doc_id")) == [(i, 1, 0) for i in (1, 2, 3)]
    assert rows(decontamination.benchmark_passages(df, spark.createDataFrame([(9, words[:200])], "item_id bigint, text string")).select("doc_id").distinct().orderBy("doc_id")) == [(1,), (3,)]
    assert fingerprints.fingerprints(df).count() == 3
    assert licenses.license_matches(df, licenses.notices(spark)).count() == 0
    found = rows(lexical_search.search(lexical_search.build_index(df), spark.createDataFrame([(1, words[:50])], "item_id bigint, text string")))
    assert {r[2] for r in found} == {1, 3}


def token_files_folder(spark):
    from eocube.sources.store import workspace

    return workspace(spark, "long-tokens")


def test_memory_of_sentence_pieces_is_bounded(monkeypatch):
    import tracemalloc

    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    words = [bytes(w).decode() for w in letters[rng.integers(0, 26, (400_000, 9))]]
    column = pa.array([" ".join(words[i : i + 200]) for i in range(0, len(words), 200)])
    model = sentence_pieces.PieceModel(MODEL)
    tracemalloc.start()
    for _ in model.encode_batch(column):
        assert len(model.table.keys) <= sentence_pieces.KEPT_UNITS and len(model.begin) <= sentence_pieces.KEPT_UNITS
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20, peak >> 20
    monkeypatch.setattr(sentence_pieces, "_models", {})
    monkeypatch.setattr(sentence_pieces, "_decoders", {})
    assert sentence_pieces.decoder(MODEL).decode([5, 6]) == LIBRARY.decode([5, 6])
    assert not sentence_pieces._models  # decoding needs no tables of the encoder


def test_a_full_table_of_units_gives_the_same_pieces(monkeypatch):
    texts = ["".join(t or "" for t in random_texts(k, 60)) for k in range(6)]
    want = [LIBRARY.encode(t) for t in texts]
    for name, value in (("KEPT_UNITS", 40), ("KEPT_BYTES", 500), ("ROW_BYTES", 300), ("ENCODED_UNITS", 7)):
        monkeypatch.setattr(sentence_pieces, name, value)
    model = sentence_pieces.PieceModel(MODEL)
    got = {}
    for i, ids, ends, first in model.encode_batch(pa.array(texts)):
        got |= {i + k: ids[a:z].tolist() for k, (a, z) in enumerate(zip(first, first[1:]))}
    assert [got[k] for k in range(len(texts))] == want
