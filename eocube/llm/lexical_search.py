"""Ranked lexical search by Block-Max MaxScore over shards of an inverted index.

Every task turns the documents it reads into shards of bounded size. A shard has one row of
document ids and lengths and one row per term: its postings in blocks of ``BLOCK``, gaps and
counts in as few bytes as they need, and beside them the bounds of every block, from which the
largest score of a posting follows once the corpus statistics are known.

A search joins the terms of all items with the index, so that a shard meets only the lists and
items it needs. Per shard and item the lists are ordered by the largest score they can add.
Those that together cannot lift a document to the tenth best score are non-essential: candidates
come from the other lists alone. For each non-essential list, from the strongest down, the
bound of the block a candidate would lie in rejects candidates before the block is decompressed.
The best documents of the shards are merged per item.

Terms are the runs of digits, letters and non-ASCII characters, A-Z lower-cased. Scores are
sums of integers, so results do not depend on the order of summation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eocube.llm.encode import UnitTable
from eocube.llm.spans import PIECE_BYTES, pieces, words
from eocube.llm.tables import written

BLOCK = 128
SHARD_BYTES = 16 << 20
ROWS_BYTES = 1 << 20
#: Pairs of item and term of one block of items; a shard is searched for one block at a time.
BLOCK_PAIRS = 200_000
BROADCAST_BYTES = 8 << 20

#: Every byte as it enters a term: lower-cased, or a blank where it separates terms.
TERM_BYTE = np.full(256, 32, np.uint8)
TERM_BYTE[0x30:0x3A] = np.arange(0x30, 0x3A)
TERM_BYTE[0x41:0x5B] = TERM_BYTE[0x61:0x7B] = np.arange(0x61, 0x7B)
TERM_BYTE[0x80:] = np.arange(0x80, 0x100)


def term_stretches(text: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in stretches that end where a term does."""
    at = 0
    while len(text) - at > PIECE_BYTES:
        gap = np.flatnonzero(text[at + PIECE_BYTES :] == 32)
        end = at + PIECE_BYTES + int(gap[0]) if len(gap) else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


class ShardBuilder:
    """Collects documents and makes the rows of one shard."""

    def __init__(self):
        self.terms = UnitTable(1 << 40, 1 << 40)
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.lengths: list[int] = []
        self.ids: list[pa.Array] = []
        self.size = 0

    def add(self, doc_id: pa.Array, buf: np.ndarray, offsets: np.ndarray) -> None:
        first = len(self.lengths)
        length = np.zeros(len(offsets) - 1, np.int64)
        text = TERM_BYTE[buf]
        if len(offsets) == 2:
            parts = ((part, np.array([0, len(part)])) for part in term_stretches(text))
        else:
            parts = iter([(text, offsets)])
        for part, edges in parts:
            start, end, bound = words(part, edges)
            number, _, _ = self.terms.number(part, start, end)
            row = np.repeat(np.arange(len(edges) - 1), np.diff(bound))
            length += np.diff(bound)
            key, count = np.unique(number << 32 | (first + row), return_counts=True)
            self.keys.append(key)
            self.counts.append(count)
        self.lengths += length.tolist()
        self.ids.append(doc_id)
        self.size += len(buf)

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        ids = pa.concat_arrays(self.ids)
        valid = ids.is_valid().to_numpy(zero_copy_only=False)
        number = ids.fill_null(0).to_numpy()
        order = np.lexsort((number, ~valid))  # ascending ids, null last
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        length = np.array(self.lengths, np.int64)[order]
        key = np.concatenate(self.keys)
        count = np.concatenate(self.counts)
        key = key >> 32 << 32 | place[key & 0xFFFFFFFF]
        by = np.argsort(key)
        key, count = key[by], count[by]
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        key, count = key[new], np.add.reduceat(count, new) if len(new) else count
        docs = {"n_docs": int((length > 0).sum()), "n_terms": int(length.sum()), "valid": valid[order].astype(np.uint8).tobytes()}
        row = {"shard": shard, **docs, "ids": number[order].tobytes(), "lengths": length.tobytes()}
        yield pa.RecordBatch.from_pylist([row], schema=INDEX)
        if not len(key):
            return
        lists = posting_lists(key >> 32, key & 0xFFFFFFFF, count, length)
        # terms were numbered in the order of the lists
        names = pa.Array.from_buffers(
            pa.large_string(), len(lists[0]), [None, pa.py_buffer(self.terms.bounds), pa.py_buffer(self.terms.data)]
        )
        batch = list_rows(shard, names, *lists)
        weight = np.cumsum(np.diff(self.terms.bounds) + 5 * lists[0] + 64)
        cuts = np.searchsorted(weight, np.arange(1, int(weight[-1]) // ROWS_BYTES + 1) * ROWS_BYTES)
        for x, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(lists[0])]):
            if z > x:
                yield batch.slice(x, z - x)


def packed(values: np.ndarray, width: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Integers in as many bytes as ``width`` says, little-endian, each at its place of ``size`` bytes."""
    out = np.zeros(size, np.uint8)
    for w in (1, 2, 4):
        of = width == w
        value, place = values[of], at[of]
        for k in range(w):
            out[place + k] = (value >> 8 * k) & 0xFF
    return out


def posting_lists(term: np.ndarray, doc: np.ndarray, tf: np.ndarray, length: np.ndarray) -> tuple:
    """All lists of a shard at once: ``df``, then offsets and bytes of block bounds, gaps and counts.

    The score of a posting falls with ``m / tf``, which is at least ``9 / tf`` plus a constant
    times ``length / tf``; the largest ``tf`` and the smallest ``length // tf`` of a block bound
    both without knowing the corpus.
    """
    first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    df = np.diff(np.append(first, len(term)))
    owner = np.repeat(np.arange(len(df)), df)
    place = np.arange(len(term)) - first[owner]
    head = np.flatnonzero(place % BLOCK == 0)
    last = np.append(head[1:], len(term)) - 1
    ratio = np.minimum(length[doc] // tf, 2**31 - 1)
    bounds = np.stack([doc[head], doc[last], np.maximum.reduceat(tf, head), np.minimum.reduceat(ratio, head)], axis=1).astype("<i4")
    gap = np.diff(doc, prepend=0)
    gap[head] = 0
    blocks = np.searchsorted(head, np.append(first, len(term)))
    out = [df, 16 * blocks, bounds.tobytes()]
    for values in (gap, tf):
        top = np.maximum.reduceat(values, first)
        width = np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, 4))
        offsets = np.concatenate([[0], np.cumsum(df * width)])
        wide = width[owner]
        out += [offsets, packed(values, wide, offsets[owner] + place * wide, int(offsets[-1])).tobytes()]
    return tuple(out)


def list_rows(shard: int, names: pa.Array, df: np.ndarray, *parts) -> pa.RecordBatch:
    n = len(df)
    binary = [
        pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(o.astype(np.int64)), pa.py_buffer(x)])
        for o, x in zip(parts[::2], parts[1::2])
    ]
    columns = {"shard": pa.array(np.full(n, shard)), "term": names, "df": pa.array(df), **dict(zip(("heads", "gaps", "counts"), binary))}
    return pa.record_batch([columns.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in INDEX], schema=INDEX)


INDEX = pa.schema(
    [("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("heads", pa.binary()), ("gaps", pa.binary()),
     ("counts", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("ids", pa.binary()), ("valid", pa.binary()),
     ("lengths", pa.binary())]
)
INDEX_SQL = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'binary' if f.type == pa.binary() else 'bigint'}" for f in INDEX)


def build_index(docs: DataFrame, *, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of every row of ``(doc_id, text)``, written below ``spark.checkpoint.dir``.

    A shard holds the documents of one task up to ``shard_bytes``, at least one. A null text
    has no terms; rows with one ``doc_id`` are documents of their own, a null id is one that
    comes after all others among equal scores; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 24
        builder = ShardBuilder()
        for b in batches:
            for i, j, buf, offsets in pieces(b.column("text")):
                builder.add(b.column("doc_id").slice(i, j - i), buf, offsets)
                if builder.size >= shard_bytes:
                    yield from builder.rows(shard)
                    builder, shard = ShardBuilder(), shard + 1
        if builder.ids:
            yield from builder.rows(shard)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(run, INDEX_SQL), "lexical-index")


def item_terms(items: DataFrame) -> DataFrame:
    """``(item, item_id, term)``: each term of the texts of ``(item_id, text)`` once per id, ids numbered; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, _, buf, offsets in pieces(b.column("text")):
                text = TERM_BYTE[buf]
                start, end, first = words(text, offsets)
                row = np.repeat(np.arange(len(first) - 1), np.diff(first))
                data = text.tobytes()
                found = [data[s:e].decode("utf-8", "replace") for s, e in zip(start.tolist(), end.tolist())]
                yield pa.record_batch([b.column("item_id").take(pa.array(i + row)), pa.array(found, pa.string())], names=["item_id", "term"])

    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    pairs = written(rows.mapInArrow(run, "item_id bigint, term string").distinct(), "item-terms")
    # a null id is an item like any other
    numbered = written(pairs.select("item_id").distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    return written(pairs.join(numbered, pairs["item_id"].eqNullSafe(numbered["item_id"])).select("item", pairs["item_id"], "term"), "item-terms")


class Shard:
    """The lists of a shard that a block of items needs, decompressed block by block and kept."""

    def __init__(self, frame: pd.DataFrame, n_docs: int, n_terms: int):
        docs = frame[frame["ids"].notna()].iloc[0]
        self.ids = np.frombuffer(docs["ids"], np.int64)
        self.valid = np.frombuffer(docs["valid"], np.uint8).astype(bool)
        # Python integers: 90 * length * documents may pass 64 bits
        self.m = np.array([10 + 90 * x * n_docs // max(n_terms, 1) for x in np.frombuffer(docs["lengths"], np.int64).tolist()], np.int64)
        lists = frame[frame["term"].notna()]
        self.weight = lists["weight"].to_numpy(np.int64)
        self.df = lists["df"].to_numpy(np.int64)
        self.raw = list(zip(lists["gaps"], lists["counts"]))
        self.heads = [np.frombuffer(x, "<i4").reshape(-1, 4).T.astype(np.int64) for x in lists["heads"]]
        slope = 90 * n_docs / max(n_terms, 1)
        self.bounds = [
            w * (1 + np.floor(1e9 / (1000 + 8 * (9 / h[2] + slope * h[3]))).astype(np.int64)) for w, h in zip(self.weight.tolist(), self.heads)
        ]
        self.top = np.array([int(b.max()) for b in self.bounds], np.int64)
        self.open: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        of, item = [], []
        for k, x in enumerate(lists["items"]):
            item.append(np.asarray(x, np.int64))
            of.append(np.full(len(x), k))
        item, of = np.concatenate(item or [np.zeros(0, np.int64)]), np.concatenate(of or [np.zeros(0, np.int64)])
        order = np.argsort(item, kind="stable")
        item, of = item[order], of[order]
        edges = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.zeros(0, np.int64)
        self.items = list(zip(item[edges].tolist(), np.split(of, edges[1:]))) if len(item) else []

    def postings(self, k: int, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of some blocks of a list, in ascending order; blocks open once per shard."""
        n = len(self.heads[k][0])
        if k not in self.open:
            self.open[k] = np.zeros(n, bool), np.full(n * BLOCK, -1, np.int32), np.zeros(n * BLOCK, np.int64)
        known, doc, score = self.open[k]
        closed = blocks[~known[blocks]]
        if len(closed):
            df = int(self.df[k])
            gaps, counts = (np.frombuffer(x, f"<u{len(x) // df}") for x in self.raw[k])
            place = closed[:, None] * BLOCK + np.arange(BLOCK)
            inside = place < df
            place = np.minimum(place, df - 1)
            docs = np.cumsum(np.where(inside, gaps[place], 0), axis=1, dtype=np.int64) + self.heads[k][0][closed][:, None]
            tf = counts[place].astype(np.int64)
            value = self.weight[k] * ((1_000_000_000 * tf) // (1000 * tf + 8 * self.m[docs]))
            doc.reshape(n, BLOCK)[closed] = np.where(inside, docs, -1)
            score.reshape(n, BLOCK)[closed] = value
            known[closed] = True
        if len(blocks) == n:
            df = int(self.df[k])
            return doc[:df], score[:df]
        found, value = doc.reshape(n, BLOCK)[blocks].ravel(), score.reshape(n, BLOCK)[blocks].ravel()
        inside = found >= 0
        return found[inside], value[inside]

    def add(self, k: int, cand: np.ndarray, total: np.ndarray, least: int, rest: int) -> np.ndarray:
        """Add a list's scores to the candidates; those whose block bound cannot reach ``least`` go first."""
        head = self.heads[k]
        block = np.searchsorted(head[1], cand)
        inside = block < len(head[1])
        block = np.minimum(block, len(head[1]) - 1)
        inside &= cand >= head[0][block]
        bound = np.where(inside, self.bounds[k][block], 0)
        alive = total[cand] + bound + rest >= least
        cand, block, inside = cand[alive], block[alive], inside[alive]
        if inside.any():
            docs, score = self.postings(k, np.unique(block[inside]))
            at = np.minimum(np.searchsorted(docs, cand), len(docs) - 1)
            hit = docs[at] == cand
            total[cand[hit]] += score[at[hit]]
        return cand

    def seed(self, lists: np.ndarray, limit: int) -> int:
        """A score that ``limit`` documents reach: of the best blocks of the strongest list, fully scored."""
        strong = int(lists[-1])
        best = np.sort(np.argsort(-self.bounds[strong], kind="stable")[:2])
        cand = self.postings(strong, best)[0].astype(np.int64)
        if len(cand) < limit:
            return 1
        total = np.zeros(len(self.ids), np.int64)
        for k in lists[::-1].tolist():
            self.add(k, cand, total, 0, 0)
        return max(1, int(np.partition(total[cand], -limit)[-limit]))

    def best(self, lists: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents with the highest scores above 0 for the lists of one item, best first."""
        lists = lists[np.argsort(self.top[lists], kind="stable")]
        reach = np.cumsum(self.top[lists])
        least = self.seed(lists, limit)
        weak = int(np.searchsorted(reach, least))  # these together stay below
        total = np.zeros(len(self.ids), np.int64)
        for k in lists[weak:].tolist():
            others = int(reach[-1]) - int(self.top[k])
            blocks = np.flatnonzero(self.bounds[k] + others >= least)
            if len(blocks):
                docs, score = self.postings(k, blocks)
                total[docs] += score
        cand = np.flatnonzero(total)
        for at in range(weak, -1, -1):
            rest = int(reach[at - 1]) if at else 0
            if len(cand) >= limit:  # sums so far are reached for certain
                least = max(least, int(np.partition(total[cand], -limit)[-limit]))
            cand = cand[total[cand] + rest >= least]
            if at == 0 or not len(cand):
                break
            cand = self.add(int(lists[at - 1]), cand, total, least, int(reach[at - 2]) if at > 1 else 0)
        chosen = cand[np.lexsort((cand, -total[cand]))][:limit]
        return chosen, total[chosen]


def search(index: DataFrame, items: DataFrame, *, limit: int = 10) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``limit`` best documents of an index for every item.

    ``items`` is ``(item_id, text)``; rows of one id, null included, are one item with the
    terms of all their texts, each once. Only scores above 0 count, equal ones rank by ascending
    ``doc_id``, null last; an item without a match has no row. An empty index or table of
    items gives an empty result; other columns are ignored.
    """
    terms = item_terms(items)
    pairs = terms.count()
    blocks = max(1, -(-pairs // BLOCK_PAIRS))
    n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    wanted = terms.select("term").distinct()
    text_bytes = wanted.agg(F.coalesce(F.sum(F.octet_length("term") + 40), F.lit(0))).first()[0]
    small = F.broadcast if text_bytes + 16 * pairs < BROADCAST_BYTES else (lambda df: df)
    found = index.where("term is not null").select("term", "df").join(small(wanted), "term").groupBy("term").agg(F.sum("df").alias("all_df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("all_df") + 1).cast("double"))).cast("bigint")
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    listed = terms.groupBy("term", block.alias("block")).agg(F.collect_list("item").alias("items"))
    asked = written(listed.join(found.select("term", weight.alias("weight")).where("weight > 0"), "term"), "asked-terms")
    columns = ["shard", "block", "term", "weight", "items", "df", "heads", "gaps", "counts", "ids", "valid", "lengths"]
    lists = index.where("term is not null").select("shard", "term", "df", "heads", "gaps", "counts").join(small(asked), "term")
    shards = index.where("term is null").select(
        "shard", "ids", "valid", "lengths", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block")
    )
    both = lists.unionByName(shards, allowMissingColumns=True).select(columns)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(frame, n_docs, n_terms)
        out = []
        for item, its in shard.items:
            docs, score = shard.best(its, limit)
            ids = pd.array(shard.ids[docs], dtype="Int64")
            ids[~shard.valid[docs]] = pd.NA
            out.append(pd.DataFrame({"item": np.full(len(docs), item), "doc_id": ids, "score": score}))
        empty = pd.DataFrame({"item": pd.array([], "int64"), "doc_id": pd.array([], "Int64"), "score": pd.array([], "int64")})
        return pd.concat(out) if out else empty

    heaps = both.groupBy("shard", "block").applyInPandas(run, "item bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    names = terms.select("item", "item_id").distinct()
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")


#: The ranking in SQL, by scoring every document.
SEARCH_SQL = r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents
), tf as (select doc_id, term, count(*) as tf from words group by 1, 2
), len as (select doc_id, sum(tf)::bigint as n from tf group by 1
), all_docs as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from len
), df as (select term, count(*)::bigint as df from tf group by 1
), asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
), scored as (
  select item_id, doc_id,
    sum(floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint
      * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::bigint as score
  from asked join df using (term) join tf using (term) join len using (doc_id) cross join all_docs
  group by 1, 2
), ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
  from scored where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""
