"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt at random into
blocks of bounded size; every block is evolved on several islands, each a population of
packings of the block. A crossover injects whole well-filled bins of one parent into the
other, takes out the bins that now hold a document twice, and puts their displaced
documents back by best fit, longest first. Between epochs the best packing of each island
migrates to the next island of its block. Documents of poorly filled bins of all blocks
are dealt anew and packed again, in fewer blocks, until one block is left or nothing more
is gained.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eocube.llm.encode import encoder
from eocube.llm.tables import written

PIECES = "item bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
BLOCK = 4096
FILLED = 0.985


def token_pieces(docs: DataFrame, tokenizer: str, *, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """The pieces of every row of ``(doc_id, text)``, one task pass; ``item`` is unique.

    A null text is empty and becomes its end id alone. Only documents longer than
    ``capacity`` are cut, at multiples of it counted from their end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, item = encoder(tokenizer), TaskContext.get().partitionId() << 36
        for b in batches:
            doc_id = b.column("doc_id")
            for i, ids, offsets in enc.encode(b.column("text"), end_id):
                size = np.diff(offsets)
                count = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                rest = size - (count - 1) * capacity
                start = np.where(piece == 0, 0, rest[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, rest[row], capacity)
                at = offsets[row] + start
                wire = ids.astype("<u4")
                sums = [zlib.crc32(wire[s:e]) for s, e in zip(at.tolist(), (at + length).tolist())]
                columns = [
                    pa.array(item + np.arange(len(row))), doc_id.slice(i, len(size)).take(pa.array(row)),
                    pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(sums, pa.int64()),
                ]
                item += len(row)
                yield pa.record_batch(columns, names=[x.split()[0] for x in PIECES.split(", ")])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


class Packer:
    """Packings of one block: lists of bins, a bin a list of places in ``length``."""

    def __init__(self, length: list[int], capacity: int, seed: int):
        self.length, self.capacity = length, capacity
        self.rng = np.random.default_rng(seed)
        self.least = -(-sum(length) // capacity)

    def best_fit(self, bins: list[list[int]], items: list[int]) -> list[list[int]]:
        """Put items, in the given order, each into the fullest bin with room for it."""
        length = self.length
        bins = [list(b) for b in bins]
        room = sorted((self.capacity - sum(length[i] for i in b), k) for k, b in enumerate(bins))
        for i in items:
            n = length[i]
            at = bisect_left(room, (n, -1))
            if at < len(room):
                free, k = room.pop(at)
                bins[k].append(i)
            else:
                free, k = self.capacity, len(bins)
                bins.append([i])
            if free > n:
                insort(room, (free - n, k))
        return bins

    def start(self) -> list[list[int]]:
        """Best fit, longest first, with the order blurred a little by chance."""
        blur = 1 + 0.05 * self.rng.random(len(self.length))
        return self.best_fit([], np.argsort(-np.array(self.length) * blur, kind="stable").tolist())

    def fullness(self, bins: list[list[int]]) -> np.ndarray:
        length = self.length
        return np.array([sum(length[i] for i in b) for b in bins]) / self.capacity

    def fitness(self, bins: list[list[int]]) -> tuple[int, float]:
        """Fewer bins first, then the more unequal filling, which leaves more room in one place."""
        return -len(bins), float((self.fullness(bins) ** 2).mean())

    def cross(self, into: list[list[int]], donor: list[list[int]]) -> list[list[int]]:
        full = self.fullness(donor)
        good = np.flatnonzero(full >= min(FILLED, float(np.quantile(full, 0.75))))
        chosen = [donor[k] for k in self.rng.permutation(good)[: max(1, int(len(good) * self.rng.uniform(0.3, 0.9)))]]
        taken = {i for b in chosen for i in b}
        keep, displaced = [], []
        own = self.fullness(into)
        for b, f in zip(into, own.tolist()):
            if taken.isdisjoint(b) and (f >= 0.97 or self.rng.random() < 0.5):
                keep.append(b)
            else:
                displaced += [i for i in b if i not in taken]
        displaced.sort(key=lambda i: -self.length[i])
        return self.best_fit(chosen + keep, displaced)

    def evolve(self, people: list[list[list[int]]], size: int, generations: int) -> list[list[list[int]]]:
        """Grow to ``size`` packings and cross them, the worst making place; best first."""
        while len(people) < size:
            people.append(self.start())
        people.sort(key=self.fitness, reverse=True)
        for _ in range(generations):
            if len(people[0]) <= self.least:
                break
            a, b = self.rng.choice(len(people), 2, replace=False)
            child = self.cross(people[min(a, b)], people[max(a, b)])
            if self.fitness(child) > self.fitness(people[-1]):
                people[-1] = child
                people.sort(key=self.fitness, reverse=True)
        return people


def _as_bins(values: np.ndarray) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for i, k in enumerate(values.tolist()):
        bins.setdefault(k, []).append(i)
    return list(bins.values())


def _bin_of(bins: list[list[int]], n: int) -> np.ndarray:
    out = np.empty(n, np.int64)
    for k, b in enumerate(bins):
        out[b] = k
    return out


def pack_blocks(
    items: DataFrame, *, capacity: int, block: int, islands: int, epochs: int, population: int, generations: int, seed: int
) -> DataFrame:
    """``(item, length, blk, bin)``: every block of ``(item, length)`` packed; ``bin`` counts within the block."""
    blocks = max(1, -(-items.count() // block))
    dealt = items.select("item", "length", F.pmod(F.xxhash64("item", F.lit(seed)), F.lit(blocks)).alias("blk"))
    state = dealt.withColumn("island", F.explode(F.array(*(F.lit(i) for i in range(islands))))).withColumn(
        "guest", F.lit(None).cast("bigint")
    ).withColumn("bin", F.lit(None).cast("bigint"))
    kinds = "item bigint, length bigint, blk bigint, island int, guest bigint, bin bigint, bins bigint"

    def evolve(epoch: int):
        def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values(["length", "item"], ascending=[False, True], ignore_index=True)
            packer = Packer(frame["length"].tolist(), capacity, hash((seed, epoch, int(key[0]), int(key[1]))) & 0x7FFFFFFF)
            people = [_as_bins(frame[c].to_numpy(np.int64)) for c in ("bin", "guest") if frame[c].notna().all()]
            if not people:
                everyone = list(range(len(frame)))
                people = [packer.best_fit([], everyone)]  # rows are sorted longest first
            best = packer.evolve(people, population, generations)[0]
            return frame.assign(bin=_bin_of(best, len(frame)), bins=len(best))

        return run

    for epoch in range(epochs):
        state = written(state.groupBy("blk", "island").applyInPandas(evolve(epoch), kinds), "islands")
        if epoch + 1 < epochs and islands > 1:
            moved = state.select(
                "item", ((F.col("island") + 1) % islands).alias("island"), F.col("bin").alias("guest")
            )
            state = state.drop("guest", "bins").join(moved, ["item", "island"])
        elif epoch + 1 < epochs:
            state = state.drop("bins")
    best = state.groupBy("blk").agg(F.min_by("island", F.struct("bins", "island")).alias("island"))
    return state.join(best, ["blk", "island"]).select("item", "length", "blk", "bin")


def pack(
    pieces: DataFrame, *, capacity: int = 2048, block: int = BLOCK, islands: int = 2, epochs: int = 2,
    population: int = 6, generations: int = 24, rounds: int = 4, seed: int = 1,
) -> DataFrame:
    """Pack ``(item, length)``: returns ``(item, sequence_id, offset)``.

    Pieces of ``capacity`` tokens are a sequence each. The others go through rounds of
    :func:`pack_blocks`; bins filled to 98.5 % are final after each round, the documents
    of the rest enter the next, which has fewer blocks, until one block holds them all or
    ``rounds`` are done; the last round keeps all its bins. No piece is left out.
    """
    done = [pieces.where(F.col("length") >= capacity).select("item", "length", (2 * F.col("item") + 1).alias("sequence_id"))]
    rest = pieces.where(F.col("length") < capacity).select("item", "length")
    for r in range(rounds):
        packed = written(
            pack_blocks(
                rest, capacity=capacity, block=block, islands=islands, epochs=epochs,
                population=population, generations=generations, seed=seed * 1000 + r,
            ),
            "packed",
        )
        # even numbers by block, bin and round; odd ones by the piece that fills a sequence alone
        named = packed.withColumn("sequence_id", 2 * ((F.col("blk") * block + F.col("bin")) * rounds + r))
        if r + 1 == rounds or packed.select("blk").distinct().limit(2).count() < 2:
            done.append(named.select("item", "length", "sequence_id"))
            break
        full = packed.groupBy("blk", "bin").agg((F.sum("length") >= FILLED * capacity).alias("full"))
        split = written(named.join(full, ["blk", "bin"]).select("item", "length", "sequence_id", "full"), "filled")
        done.append(split.where("full").select("item", "length", "sequence_id"))
        rest = split.where(~F.col("full")).select("item", "length")
    everything = done[0]
    for part in done[1:]:
        everything = everything.unionByName(part)
    within = Window.partitionBy("sequence_id").orderBy("item")
    return everything.select(
        "item", "sequence_id", (F.sum("length").over(within) - F.col("length")).cast("bigint").alias("offset")
    )


def best_fit_packing(docs: DataFrame, tokenizer: str, *, end_id: int = 0, capacity: int = 2048, **search) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece of ``(doc_id, text)``.

    Rows are packed one by one, so repeated rows and null ids keep their own pieces; an
    empty table gives an empty result; other columns are ignored. A null text is empty and packs
    its end id; a long one is cut into pieces of ``capacity`` after its shorter first piece.
    """
    pieces = written(token_pieces(docs, tokenizer, end_id=end_id, capacity=capacity), "pieces")
    placed = pack(pieces, capacity=capacity, **search)
    return pieces.join(placed, "item").drop("item")
