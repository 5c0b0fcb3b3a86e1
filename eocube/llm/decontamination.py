"""Benchmark decontamination by spaced-seed hashing.

Words are runs of bytes other than ASCII white space and punctuation, A-Z lower-cased. A
document holds a passage of a benchmark item where, on one alignment of their words, a
window of ``SPAN`` words has at least ``SPAN - SUBSTITUTIONS`` equal ones. Seeds are fixed
masks over the words: the word hashes at the set positions of a mask are combined to one
value, the others are ignored. Every window with that many substitutions agrees on some
mask at some place (a test proves it by listing all of them), so joining the seeds of
documents and benchmark finds all alignments; the words around a hit then decide.

Equal texts of the benchmark are one. They are dealt into blocks of about ``BLOCK_WORDS`` words,
each block goes to the tasks as arrays and is joined with the seeds of all documents as
they are read. Documents are never shuffled, a larger benchmark means more blocks, and the
driver holds one of them at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.llm.near_duplicates import LOWER
from eocube.llm.spans import IS_SPACE, U, mix, pieces, range_hashes, words
from eocube.llm.tables import written

SPAN = 13
SUBSTITUTIONS = 2
# Masks: 1 keeps the word, 0 ignores it.
MASKS = ("11101011", "110100111")
SHORTEST = 5
BLOCK_WORDS = 1_000_000

APART = IS_SPACE.copy()
for _a, _z in ((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)):
    APART[_a:_z] = True
PLACE = mix(np.arange(1, 65, dtype=U) * U(0x9FB21C651E98DF25)) | U(1)


def word_hashes(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word and, per row, the index of its first word."""
    low = LOWER[buf]
    # separators become blanks, so that words() finds the runs between them
    blank = np.where(APART[low], np.uint8(32), low)
    start, end, first = words(blank, offsets)
    return range_hashes(blank, start, end), first


def seeds(word: np.ndarray, mask: str) -> np.ndarray:
    """The value of a mask at each word that has enough words behind it."""
    n = len(word) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.zeros(n, U)
    for p, kept in enumerate(mask):
        if kept == "1":
            out += word[p : p + n] * PLACE[p]
    return mix(out + U(len(mask)))


#: Words to either side that decide which windows around a seed are passages.
AROUND = SPAN - 1
DOC_END, ITEM_END = U(0x9E3779B97F4A7C15), U(0xD1B54A32D192ED03)


def spread(word: np.ndarray, first: np.ndarray, end: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with ``AROUND`` end marks between rows, the place of each in that array, and its row."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(len(word)) + AROUND * (row + 1)
    out = np.full(len(word) + AROUND * len(first), end, U)
    out[at] = word
    return out, at, row


def surroundings(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One hash of the words around each place, end marks included."""
    out = np.zeros(len(at), U)
    for k in range(-AROUND, AROUND + 1):
        out = mix(out ^ words[at + k])
    return out


class Benchmark:
    """The seeds of one block of benchmark texts, ready to be looked up.

    Places of a text with equal surroundings decide the same windows, so a seed keeps one of
    them; documents are looked up the same way.  A passage of repeated words thus costs no
    pairs of its repetitions.
    """

    def __init__(self, ids: list[int], texts: list[str]):
        parts, bounds = [], [np.zeros(1, np.int64)]
        at = 0
        for _, _, buf, offsets in pieces(pa.array(texts, pa.string())):
            word, first = word_hashes(buf, offsets)
            parts.append(word)
            bounds.append(first[1:] + at)
            at += len(word)
        self.ids = np.array(ids, np.int64)
        word = np.concatenate([np.zeros(0, U), *parts])
        self.first = np.concatenate(bounds)
        length = np.diff(self.first)
        self.word, self.at, self.item = spread(word, self.first, ITEM_END)
        masks = {m: length >= SPAN for m in MASKS}
        for n in range(SHORTEST, SPAN):  # an item shorter than a window matches as a whole
            if (length == n).any():
                masks["1" * n] = length == n
        self.tables = []
        for mask, used in masks.items():
            value = seeds(word, mask)
            at = np.arange(len(value))
            item = self.item[: len(value)]
            inside = (item == self.item[len(mask) - 1 :]) & used[item] if len(value) else np.zeros(0, bool)
            value, at, item = value[inside], at[inside], item[inside]
            _, one = np.unique(mix(surroundings(self.word, self.at[at]) ^ item.astype(U)), return_index=True)
            order = one[np.argsort(value[one], kind="stable")]
            value, at = value[order], at[order]
            maybe = np.zeros(1 << 20, bool)
            maybe[(value >> U(44)).astype(np.int64)] = True
            self.tables.append((mask, value, at, maybe))

    def _found(self, mask: str, doc: np.ndarray, place: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of pairs of places in document and block: which have a passage, its first and last word, and the equal words as bits."""
        span = min(SPAN, len(mask)) if mask not in MASKS else SPAN
        least = SPAN - SUBSTITUTIONS if mask in MASKS else len(mask)
        behind = span - len(mask)  # a window begins up to so many words before the seed
        theirs = self.at[at]
        k = np.arange(-behind, span)
        mine, other = doc[place[:, None] + k], self.word[theirs[:, None] + k]
        inside = (mine != DOC_END) & (other != ITEM_END)
        equal = (mine == other) & inside
        sums = np.cumsum(np.pad(equal.astype(np.int8), ((0, 0), (1, 0))), axis=1, dtype=np.int16)
        whole = np.cumsum(np.pad(inside.astype(np.int8), ((0, 0), (1, 0))), axis=1, dtype=np.int16)
        good = (sums[:, span:] - sums[:, :-span] >= least) & (whole[:, span:] - whole[:, :-span] == span)
        hit = np.flatnonzero(good.any(axis=1))
        good, equal = good[hit], equal[hit]
        low = good.argmax(axis=1)
        high = good.shape[1] - 1 - good[:, ::-1].argmax(axis=1) + span - 1
        column = np.arange(len(k))
        covered = (column >= low[:, None]) & (column <= high[:, None])
        bits = ((equal & covered).astype(np.int64) << (column - behind + AROUND)).sum(axis=1)
        return hit, low - behind, high - behind, bits

    def passages(self, word: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
        """``(row, text, word in the row, word in the text, words, equal words)`` of the stretches found."""
        doc, spot, row = spread(word, first, DOC_END)
        runs = []  # columns: row, item, first and last covered word, begin of the run, its length, bits, word in the item
        for mask, value, theirs, maybe in self.tables:
            found = seeds(word, mask)
            place = np.flatnonzero(maybe[(found >> U(44)).astype(np.int64)])
            place = place[row[place] == row[place + len(mask) - 1]]
            lo = np.searchsorted(value, found[place], side="left")
            n = np.searchsorted(value, found[place], side="right") - lo
            place, lo, n = place[n > 0], lo[n > 0], n[n > 0]
            if not len(place):
                continue
            _, one, of = np.unique(surroundings(doc, spot[place]), return_index=True, return_inverse=True)
            mine = np.repeat(np.arange(len(one)), n[one])
            at = theirs[np.repeat(lo[one], n[one]) + np.arange(len(mine)) - np.repeat(np.cumsum(n[one]) - n[one], n[one])]
            kept = []
            for a in range(0, len(mine), 1 << 16):
                hit, low, high, bits = self._found(mask, doc, spot[place[one[mine[a : a + (1 << 16)]]]], at[a : a + (1 << 16)])
                kept.append(np.stack([mine[a + hit], self.item[at[a + hit]], low, high, bits, at[a + hit] - self.first[self.item[at[a + hit]]] + low]))
            which, item, low, high, bits, their_word = np.concatenate(kept, axis=1)
            # of several places of one item all that is covered counts
            order = np.lexsort((their_word, low, item, which))
            which, item, low, high, bits, their_word = (x[order] for x in (which, item, low, high, bits, their_word))
            if not len(which):
                continue
            new = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (item[1:] != item[:-1])])
            high, bits = np.maximum.reduceat(high, new), np.bitwise_or.reduceat(bits, new)
            which, item, low, their_word = which[new], item[new], low[new], their_word[new]
            # places one behind the other with equal surroundings are one run
            begins = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (place[1:] != place[:-1] + 1) | (row[place[1:]] != row[place[:-1]])])
            size = np.diff(np.append(begins, len(place)))
            lo = np.searchsorted(which, of[begins], side="left")
            n = np.searchsorted(which, of[begins], side="right") - lo
            run = np.repeat(np.arange(len(begins)), n)
            pick = np.repeat(lo, n) + np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
            start = place[begins[run]]
            runs.append(np.stack([row[start], item[pick], start + low[pick], start + size[run] - 1 + high[pick], start, size[run], bits[pick], their_word[pick]]))
        if not runs:
            return []
        table = np.concatenate(runs, axis=1)
        table = table[:, np.lexsort((table[3], table[2], table[1], table[0]))]
        out = []
        key = table[0] * len(self.ids) + table[1]
        base = np.cumsum(np.r_[0, key[1:] != key[:-1]]) * (len(word) + 1) if table.shape[1] else table[0]
        reach = np.maximum.accumulate(table[3] + base) - base
        opens = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (table[2][1:] > reach[:-1] + 1)]) if table.shape[1] else []
        for a, z in zip(opens, [*opens[1:], table.shape[1]]):
            r, i, begin, their_word = (int(table[c][a]) for c in (0, 1, 2, 7))
            equal = np.zeros(int(reach[z - 1]) + 1 - begin, bool)
            for _, _, _, _, start, size, bits, _ in table[:, a:z].T.tolist():
                for k in range(-AROUND, AROUND + 1):
                    if bits >> (k + AROUND) & 1:
                        equal[start + k - begin : start + k - begin + size] = True
            out.append((r, i, begin - int(first[r]), their_word, len(equal), int(equal.sum())))
        return out


def numbered_texts(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(number, text)`` of the distinct texts and ``(number, item_id)`` of the items that have them; written."""
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    texts = written(items.select("text").distinct().withColumn("number", F.monotonically_increasing_id()), "benchmark-texts")
    return texts, written(items.join(texts, "text").select("number", "item_id"), "benchmark-items")


def blocks(texts: DataFrame) -> Iterator[Benchmark]:
    """The texts as blocks of bounded size; the driver holds one at a time."""
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-size // (BLOCK_WORDS * 4)))
    for k in range(n):
        part = texts.where(F.pmod(F.xxhash64("number"), F.lit(n)) == k).orderBy("number").collect()
        yield Benchmark([r["number"] for r in part], [r["text"] for r in part])


FOUND = "doc_id bigint, number bigint, doc_word bigint, item_word bigint, n_words bigint, n_equal bigint"
PASSAGES = "doc_id bigint, item_id bigint, doc_word bigint, item_word bigint, n_words bigint, n_equal bigint"


def benchmark_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Passages of benchmark items ``(item_id, text)`` in documents ``(doc_id, text)``.

    One row per document, item and stretch of the document that windows of the item cover, on
    whatever alignments: its place and length in words, the word of the item at its begin, and how
    many of its words are equal there.  Items of 5 to 12 words match only as a whole and
    without substitution; shorter, empty and null ones match nothing.  Repeated rows and
    items are reported each; null ids are reported as null; an empty table on either side gives
    an empty result; other columns are ignored.  Long texts are read whole, one at a time.
    """
    found = None
    texts, items = numbered_texts(benchmark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for block in blocks(texts):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for b in batches:
                for i, j, buf, offsets in pieces(b.column("text")):
                    hits = block.passages(*word_hashes(buf, offsets))
                    if hits:
                        row, item, *rest = map(np.array, zip(*hits))
                        yield pa.record_batch(
                            [b.column("doc_id").take(pa.array(row + i)), pa.array(block.ids[item]), *map(pa.array, rest)],
                            names=[x.split()[0] for x in FOUND.split(", ")],
                        )

        part = rows.mapInArrow(run, FOUND)
        found = part if found is None else found.unionByName(part)
    names = [x.split()[0] for x in PASSAGES.split(", ")]
    return found.join(items, "number").select(*names)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no benchmark passage; nothing is shuffled.

    Null and empty texts, repeated rows and an empty table on either side stay as they are.
    """
    for block in blocks(numbered_texts(benchmark)[0]):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for b in batches:
                clean = np.ones(b.num_rows, bool)
                for i, j, buf, offsets in pieces(b.column("text")):
                    for hit in block.passages(*word_hashes(buf, offsets)):
                        clean[i + hit[0]] = False
                yield b.filter(pc.fill_null(pa.array(clean), False))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
