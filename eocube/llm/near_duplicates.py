"""MinHash near-dedup: universal hash minima, bands, verification, components by star rounds.

Every document becomes its set of five-word shingles (64-bit hashes), a signature of
``4 * BANDS`` minima under universal multiply-shift hashes, and a digest of the set.
Documents with equal sets are one node from the start, so groups of copies cost one row a
copy and no pairs. Nodes that agree on four minima of a band share a bucket.

Pairs are never listed within a bucket. In each round every bucket names a hub and every
node is compared with the hub that it meets most often, first by signature, then on the
full sets; links found merge components. Buckets whose members are all in one component are
done. What is still apart after the hub rounds is compared on full sets in blocks of bounded
size, only across components; a block returns the links that join components, so no link
between groups is lost by the hubs and no list of pairs is made.

With four minima a band, two sets of similarity 0.75 miss all ``BANDS`` = 40 bands with
probability (1 - 0.75**4)**40 = 2.5e-7, and less when they are closer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eocube.llm.spans import U, mix, pieces, range_hashes, words
from eocube.llm.tables import free_name, written

SHINGLE_WORDS = 5
BAND_ROWS = 4
BANDS = 40
HASHES = BAND_ROWS * BANDS
HUB_ROUNDS = 2
BLOCK_ROWS = 256
# six standard deviations below the expected number of equal minima at similarity 0.75
LEAST_EQUAL = int(HASHES * 0.75 - 6 * (HASHES * 0.75 * 0.25) ** 0.5)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_n = np.arange(1, HASHES + 1, dtype=U)
FACTOR = mix(_n * U(0x9E3779B97F4A7C15)) | U(1)
OFFSET = mix(_n * U(0xC2B2AE3D27D4EB4F))
PLACE = mix(np.arange(1, SHINGLE_WORDS + 1, dtype=U) * U(0x165667B19E3779F9)) | U(1)

SHORT = np.arange(SHINGLE_WORDS, dtype=U) * U(0x27D4EB2F165667C5)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a string column.

    Words are runs without ASCII white space, A-Z lower-cased; fewer than five words are
    one shingle, no words an empty set.
    """
    k = SHINGLE_WORDS
    for i, j, buf, offsets in pieces(column):
        buf = LOWER[buf]
        start, end, first = words(buf, offsets)
        word = range_hashes(buf, start, end)
        n = len(word)
        joined = np.zeros(max(0, n - k + 1), U)
        for p in range(k):
            joined += word[p : n - k + 1 + p] * PLACE[p] if n >= k else U(0)
        joined = mix(joined)
        bounds = first.tolist()
        for r in range(j - i):
            a, z = bounds[r], bounds[r + 1]
            if z - a >= k:
                yield np.unique(joined[a : z - k + 1])
            elif z > a:
                short = (word[a:z] * PLACE[: z - a]).sum(dtype=U, keepdims=True)
                yield mix(short + SHORT[z - a])
            else:
                yield np.zeros(0, U)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of every universal hash over a set, its upper 32 bits."""
    low = np.full(HASHES, ~U(0), U)
    for s in range(0, len(shingles), 512):
        block = FACTOR[:, None] * shingles[None, s : s + 512]
        block += OFFSET[:, None]
        np.minimum(low, block.min(axis=1), out=low)
    return (low >> U(32)).astype(np.uint32).view(np.int32)


SIGNED = "doc_id bigint, row bigint, n_shingles bigint, set_a bigint, set_b bigint, sig array<int>"


def signed(docs: DataFrame) -> DataFrame:
    """Per row of ``(doc_id, text)`` the size, digest and signature of its shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 36
        for b in batches:
            if b.num_rows == 0:
                continue
            sets = [(len(s), mix(s).sum(dtype=U), mix(s ^ U(0x5DEECE66D)).sum(dtype=U), signature(s)) for s in shingle_sets(b.column("text"))]
            size, one, two, sig = zip(*sets)
            flat = pa.array(np.concatenate(sig))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, HASHES, dtype=np.int32)), flat)
            yield pa.record_batch(
                [
                    b.column("doc_id"), pa.array(row + np.arange(len(size))), pa.array(np.array(size, np.int64)),
                    pa.array(np.array(one, U).view(np.int64)), pa.array(np.array(two, U).view(np.int64)), lists,
                ],
                names=[x.split()[0] for x in SIGNED.split(", ")],
            )
            row += len(size)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SIGNED)


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, shingles)`` of the documents whose id is a node, read again from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = list(shingle_sets(b.column("text")))
            flat = np.concatenate([np.zeros(0, U), *sets]).view(np.int64)
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            yield pa.record_batch(
                [b.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["node", "shingles"]
            )

    wanted = docs.select(F.col("doc_id").cast("bigint").alias("node"), F.col("text").cast("string").alias("text"))
    return wanted.join(nodes, "node", "left_semi").mapInArrow(run, "node bigint, shingles array<bigint>")


def similar(a: Column, b: Column, percent: int) -> Column:
    """Whether two sets given as arrays reach a Jaccard similarity, in whole numbers."""
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= percent * (F.size(a) + F.size(b) - both)


def confirmed(pairs: DataFrame, sigs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` that are links: by size and signature first, then on full sets."""
    a = sigs.select(F.col("node").alias("u"), F.col("n_shingles").alias("n_u"), F.col("sig").alias("sig_u"))
    b = sigs.select(F.col("node").alias("v"), F.col("n_shingles").alias("n_v"), F.col("sig").alias("sig_v"))
    equal = F.size(F.filter(F.zip_with("sig_u", "sig_v", lambda x, y: x == y), lambda x: x))
    close = (
        pairs.join(a, "u")
        .join(b, "v")
        .where((100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v")) & (equal >= LEAST_EQUAL))
        .select("u", "v")
        .distinct()
    )
    one = sets.select(F.col("node").alias("u"), F.col("shingles").alias("set_u"))
    two = sets.select(F.col("node").alias("v"), F.col("shingles").alias("set_v"))
    return close.join(one, "u").join(two, "v").where(similar(F.col("set_u"), F.col("set_v"), percent)).select("u", "v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of the nodes of ``(u, v)``: the smallest node that each one reaches.

    Large-star and small-star rounds alternate until the edges stand still; each round is
    written, so a lost executor costs one round at most. Null ends and loops are left out.
    """
    now = written(edges.select("u", "v").where(F.col("u") != F.col("v")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if tuple(state) == before or state["n"] == 0:
            break
        before = tuple(state)
        both = now.select("u", "v").union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
        down = written(down, "large-star")
        smallest = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        now = written(moved.union(smallest.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v")).distinct()


def _with_component(rows: DataFrame, parts: DataFrame, node: str, name: str) -> DataFrame:
    found = parts.select(F.col("node").alias(node), F.col("component").alias("_c"))
    return rows.join(found, node, "left").withColumn(name, F.coalesce("_c", node)).drop("_c")


def _open_buckets(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members ``(bucket, node, part)`` of the buckets that hold more than one component."""
    placed = _with_component(members, parts, "node", "part")
    split = placed.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo != hi")
    return placed.join(written(split.select("bucket"), "split-buckets"), "bucket", "left_semi")


def _hub_pairs(members: DataFrame, salt: int) -> DataFrame:
    """For every node of an open bucket the hub of another component that it shares most buckets with.

    The hub of a bucket is at first the node with the largest buckets, which is near the
    middle of its group; in later rounds it is drawn by a hash.
    """
    if salt == 0:
        sizes = members.groupBy("bucket").agg(F.count("*").alias("size"))
        known = members.join(sizes, "bucket").groupBy("node").agg(F.sum("size").alias("size"))
        members, rank = members.join(known, "node"), -F.col("size")
    else:
        rank = F.xxhash64("node", F.lit(salt))
    hubs = members.groupBy("bucket").agg(F.min_by(F.struct("node", "part"), F.struct(rank, F.col("node"))).alias("hub"))
    met = members.join(written(hubs, "hubs"), "bucket").where(F.col("part") != F.col("hub.part"))
    often = met.groupBy("node", F.col("hub.node").alias("hub")).agg(F.count("*").alias("n"))
    best = often.groupBy("node").agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("hub"))
    return best.select(F.least("node", "hub").alias("u"), F.greatest("node", "hub").alias("v")).distinct()


def _clustered(members: DataFrame) -> DataFrame:
    """``(node, part, cluster, left, lefts, rights)`` of the nodes of open buckets.

    Nodes that share a bucket, or are joined by a chain of them, are one cluster; ``left``
    says whether a node is outside the largest component of its cluster. Small clusters are
    put together until they fill a block.
    """
    hubs = members.groupBy("bucket").agg(F.min("node").alias("v"))
    stars = members.join(hubs, "bucket").select(F.col("node").alias("u"), "v").distinct()
    nodes = members.select("node", "part").distinct()
    placed = written(_with_component(nodes, components(stars), "node", "cluster"), "clusters")
    sizes = placed.groupBy("cluster", "part").agg(F.count("*").alias("n"))
    whole = sizes.groupBy("cluster").agg(
        F.sum("n").alias("n_all"), F.max("n").alias("n_most"), F.max_by("part", F.struct("n", "part")).alias("most")
    )
    small = whole.where(F.col("n_all") < BLOCK_ROWS).agg(F.coalesce(F.sum("n_all"), F.lit(0))).first()[0]
    bins = max(1, -(-small // BLOCK_ROWS))
    joint = F.when(F.col("n_all") < BLOCK_ROWS, -1 - F.pmod(F.xxhash64("cluster"), F.lit(bins))).otherwise(F.col("cluster"))
    blocks = lambda n: F.when(F.col("n_all") < BLOCK_ROWS, 1).otherwise(F.ceil(n / BLOCK_ROWS)).cast("int")
    return placed.join(whole, "cluster").select(
        "node", "part", joint.alias("cluster"), (F.col("part") != F.col("most")).alias("left"),
        blocks(F.col("n_all") - F.col("n_most")).alias("lefts"), blocks(F.col("n_all")).alias("rights"),
    )


def _block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that share an open bucket, on full sets, block by block.

    Only nodes outside the largest component of a cluster are compared with the others; a
    block returns the links that join components, not all pairs it finds.
    """
    rows = _clustered(members).join(sets, "node")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    columns = ["cluster", "lo", "hi", "node", "part", "shingles"]
    left = rows.where("left").select("*", own("lefts").alias("lo"), every("rights").alias("hi")).select(*columns)
    right = rows.select("*", every("lefts").alias("lo"), own("rights").alias("hi")).select(
        *(F.col(c).alias(f"{c}_r") for c in columns)
    )

    def compare(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        links: list[tuple[int, int]] = []
        if len(one) and len(two):
            two = two.rename(columns=lambda c: c.removesuffix("_r"))
            shared, n_one, n_two = shared_counts(one["shingles"].to_list(), two["shingles"].to_list())
            close = 100 * shared >= percent * (n_one[:, None] + n_two[None, :] - shared)
            close &= one["part"].to_numpy()[:, None] != two["part"].to_numpy()[None, :]
            root: dict[int, int] = {}

            def find(x: int) -> int:
                while root.setdefault(x, x) != x:
                    root[x] = x = root[root[x]]
                return x

            names, parts = (one["node"].tolist(), two["node"].tolist()), (one["part"].tolist(), two["part"].tolist())
            for i, j in np.argwhere(close).tolist():
                a, b = find(parts[0][i]), find(parts[1][j])
                if a != b:
                    root[a] = b
                    links.append((names[0][i], names[1][j]))
        return pd.DataFrame(links, columns=["u", "v"]).astype("int64")

    keys = ["cluster", "lo", "hi"]
    return left.groupBy(*keys).cogroup(right.groupBy(*(f"{k}_r" for k in keys))).applyInPandas(compare, "u bigint, v bigint").distinct()


def shared_counts(one: list[np.ndarray], two: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the intersections of two lists of sets, and the sizes of the sets."""
    n_one, n_two = (np.array([len(x) for x in side], np.int64) for side in (one, two))
    a, b = np.concatenate(one), np.concatenate(two)
    known = np.intersect1d(a, b)
    out = np.zeros((len(one), len(two)), np.int64)
    sides = []
    for flat, n in ((a, n_one), (b, n_two)):
        at = np.searchsorted(known, flat) if len(known) else np.zeros(len(flat), np.int64)
        hit = (known[np.minimum(at, len(known) - 1)] == flat) if len(known) else np.zeros(len(flat), bool)
        sides.append((np.repeat(np.arange(len(n)), n)[hit], at[hit]))
    for lo in range(0, len(known), 4096):  # dense 0/1 matrices over a stretch of the shingles they have in common
        parts = []
        for (row, at), n in zip(sides, (n_one, n_two)):
            here = (at >= lo) & (at < lo + 4096)
            m = np.zeros((len(n), min(4096, len(known) - lo)), np.float32)
            m[row[here], at[here] - lo] = 1
            parts.append(m)
        out += np.rint(parts[0] @ parts[1].T).astype(np.int64)
    return out, n_one, n_two


def near_duplicates(docs: DataFrame, *, percent: int = 75) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row of ``(doc_id, text)``.

    Documents are linked where ``100 * intersection >= percent * union`` on their shingle
    sets (``percent`` at least 75); a component is named by its smallest ``doc_id``, which
    is kept. Null and empty texts have an empty set and stand alone. Rows of one ``doc_id``
    are one document, with the links of all of them; a row without ``doc_id`` stands alone,
    has no component and is kept. Other columns are ignored, an empty table stays empty. Texts
    of any length enter with all their shingles; one set is held at a time.
    """
    if percent < 75:
        raise ValueError("the bands are made for a similarity of 0.75 and more")
    docs = docs.select("doc_id", "text")
    table = written(signed(docs), "signatures")
    worded = table.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    key = ["set_a", "set_b", "n_shingles"]
    reps = worded.groupBy(*key).agg(F.min(F.struct("doc_id", "row")).alias("rep"), F.count("*").alias("copies"))
    reps = written(reps.select(*key, F.col("rep.doc_id").alias("node"), F.col("rep.row").alias("rep_row")), "sets")
    nodes = worded.join(reps.select(F.col("rep_row").alias("row"), "node"), "row").select("node", "n_shingles", "sig")
    member = written(worded.select("doc_id", *key).join(reps.select(*key, "node"), key).select("doc_id", "node").distinct(), "members")

    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    banded = nodes.select("node", "sig", band).select(
        "node", F.xxhash64(F.slice("sig", F.col("band") * BAND_ROWS + 1, F.lit(BAND_ROWS)), "band").alias("bucket")
    )
    shared = banded.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi")
    members = written(banded.join(written(shared.select("bucket"), "shared-buckets"), "bucket", "left_semi"), "buckets")
    involved = written(members.select("node").distinct(), "involved")
    sigs = written(nodes.join(involved, "node", "left_semi"), "involved-signatures")
    sets = written(full_sets(docs, involved), "full-sets")

    # a doc_id whose rows have different sets ties these sets together
    spread = member.groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi")
    ties = member.join(spread.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    links = ties
    parts = written(components(links), "parts")
    for r in range(HUB_ROUNDS + 1):
        open_now = written(_open_buckets(members, parts), "open-buckets")
        if open_now.isEmpty():
            break
        if r < HUB_ROUNDS:
            found = confirmed(_hub_pairs(open_now, r), sigs, sets, percent)
        else:
            found = _block_links(open_now, sets, percent)
        found = written(found, "links")
        links = parts.select(F.col("node").alias("u"), F.col("component").alias("v")).union(found)
        parts = written(components(links), "parts")
    of_doc = _with_component(member, parts, "node", "part").groupBy("doc_id").agg(F.min("part").alias("part"))
    rows = table.select("doc_id", "n_shingles").join(of_doc, "doc_id", "left")
    component = F.coalesce(F.least("part", "doc_id"), F.col("doc_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, **rule) -> DataFrame:
    """All columns of one row per group of near duplicates, that of its smallest ``doc_id``.

    Of several rows of that id the one with the longest text stays, ties by the text; rows
    without ``doc_id`` all stay, and so do null and empty texts; an empty table stays empty.
    """
    node, turn = free_name(docs, "_kept"), free_name(docs, "_turn")
    kept = near_duplicates(docs, **rule).where("kept and doc_id is not null").select(F.col("doc_id").alias(node)).distinct()
    found = docs.join(kept, docs["doc_id"] == kept[node], "left_semi")
    order = Window.partitionBy("doc_id").orderBy(F.length("text").desc_nulls_last(), F.col("text"))
    one = found.withColumn(turn, F.row_number().over(order)).where(F.col(turn) == 1).drop(turn)
    return one.unionByName(docs.where(F.col("doc_id").isNull()))
