"""Suffix-array dedup: every byte covered by a string of ``LENGTH`` bytes that starts twice.

The suffixes are dealt to tasks by content. Each window of ``LENGTH`` bytes names an
anchor, the smallest hash among its grams of ``GRAM`` bytes (the last of equal ones), so
equal windows name equal anchors and lie in the same share. Neighbouring windows with one
anchor form a context, the text that holds them all. Three exact reductions leave little to
sort: an anchor that occurs once repeats nothing; contexts that are equal as a whole repeat
all their windows; and of equal contexts one is enough.

The remaining contexts are sorted in shares of bounded size by the difference-cover method:
triples at the positions 1 and 2 modulo 3 are sorted and named, the names are sorted by
recursion, the remaining suffixes are merged in, and windows adjacent in the suffix array
are compared over their prefixes. The recursion ends once a name covers ``LENGTH`` bytes.

An anchor with more distinct contexts than a share holds is not sorted in one task: its
windows are counted one by one, by hashes of 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.llm.spans import Hasher, U, mix, pieces
from eocube.llm.tables import numbered, written

LENGTH = 200
GRAM = 32
PIECE = 1 << 20
SHARE_BYTES = 1 << 20
SHARE_CONTEXTS = 3_000
_LOW = U((1 << 21) - 1)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` values."""
    n, have = len(values) - width + 1, 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    if have < width:
        values = np.minimum(values[:n], values[width - have : width - have + n])
    return values


def contexts(buf: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Contexts of the texts in a buffer of at most two million bytes.

    Returns the hash of the anchor, the hash of the context, the text's number, and first
    window and number of windows of each context, places relative to the text.
    """
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return none.astype(U), none.astype(U), none, none, none
    hasher = Hasher(buf)
    grams = hasher.windows(gram)
    key = (grams & ~_LOW) | (_LOW - np.arange(len(grams), dtype=U))
    anchor = (_LOW - (sliding_min(key, length - gram + 1) & _LOW)).astype(np.int64)
    change = np.zeros(len(anchor) + 1, np.int8)
    fit = np.flatnonzero(np.diff(offsets) >= length)
    change[offsets[fit]] = 1
    change[offsets[fit + 1] - length + 1] -= 1
    valid = np.cumsum(change[:-1], dtype=np.int8) > 0
    same = np.zeros(len(anchor), bool)
    same[1:] = (anchor[1:] == anchor[:-1]) & valid[:-1]
    # the first window of a text never continues the context before it
    same[offsets[fit]] = False
    first = np.flatnonzero(valid & ~same)
    goes_on = np.zeros(len(anchor), bool)
    goes_on[:-1] = same[1:] & valid[1:]
    last = np.flatnonzero(valid & ~goes_on)
    text = np.searchsorted(offsets, first, side="right") - 1
    return (
        grams[anchor[first]], hasher.ranges(first, last + length), text, first - offsets[text], last - first + 1,
    )


ANCHORS = "row bigint, h bigint, c bigint, start bigint, n int"


def anchors(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """The contexts of every row of ``(row, text)``; long texts are read in overlapping pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row = b.column("row").to_numpy()
            for i, _, buf, offsets in pieces(b.column("text"), PIECE):
                for at in range(0, max(len(buf) - length + 1, 1), PIECE) if len(offsets) == 2 else (0,):
                    part = buf[at : at + PIECE + length - 1] if len(offsets) == 2 else buf
                    edges = np.array([0, len(part)]) if len(offsets) == 2 else offsets
                    h, c, text, start, n = contexts(part, edges, length, gram)
                    columns = [row[i + text], h.view(np.int64), c.view(np.int64), start + at, n.astype(np.int32)]
                    yield pa.record_batch([pa.array(x) for x in columns], names=[x.split()[0] for x in ANCHORS.split(", ")])

    return rows.mapInArrow(run, ANCHORS)


def _names(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of 64-bit keys from 1, equal ones alike, and how many there are."""
    order = np.argsort(keys)
    ordered = keys[order]
    step = np.ones(len(keys), np.int64)
    step[1:] = ordered[1:] != ordered[:-1]
    rank = np.cumsum(step)
    out = np.empty(len(keys), np.int64)
    out[order] = rank
    return out, int(rank[-1])


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of ``s`` in order of their first ``depth`` symbols at least, by difference cover.

    ``s`` holds positive integers below 2**21 and is shorter than that, so that a triple
    fits 64 bits.
    """
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate([s.astype(np.int64), np.zeros(3, np.int64)])
    # sort the sampled triples and name them; a last sample at n stands for the end
    ones = np.arange(1, n + (n % 3 == 1), 3)
    twos = np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    triple = (t[sample] << 42) | (t[sample + 1] << 21) | t[sample + 2]
    name, count = _names(triple)
    if depth > 3 and count < len(sample):
        # recurse on the names, first those at 1, then those at 2 modulo 3
        order = suffix_array(name, -(-depth // 3))
        rank = np.empty(len(sample), np.int64)
        rank[order] = np.arange(1, len(sample) + 1)
    else:
        order = np.argsort(name, kind="stable")
        rank = name if count == len(sample) else np.empty(len(sample), np.int64)
        if count < len(sample):
            rank[order] = np.arange(1, len(sample) + 1)
    at = np.zeros(n + 3, np.int64)
    at[sample] = rank
    sorted_sample = sample[order]
    sorted_sample = sorted_sample[sorted_sample < n]
    # sort the remaining suffixes by their symbol and the rank behind it
    rest = np.arange(0, n, 3)
    pair = (t[rest] << 21) | at[rest + 1]
    by_pair = np.argsort(pair, kind="stable")
    rest, pair = rest[by_pair], pair[by_pair]
    # merge: how many samples come before each of them
    in_one = sorted_sample[sorted_sample % 3 == 1]
    in_two = sorted_sample[sorted_sample % 3 == 2]
    before = np.searchsorted((t[in_one] << 21) | at[in_one + 1], pair)
    deep = (t[rest] << 42) | (t[rest + 1] << 21) | at[rest + 2]
    # of equal symbols and tied ranks the order is free, so the search keeps the order of the pairs
    before = before + np.searchsorted((t[in_two] << 42) | (t[in_two + 1] << 21) | at[in_two + 2], deep)
    before = np.maximum.accumulate(before) + np.arange(len(rest))
    out = np.empty(n, np.int64)
    taken = np.zeros(n, bool)
    out[before] = rest
    taken[before] = True
    out[~taken] = sorted_sample
    return out


def repeated_windows(text: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """For each window start whether an equal window starts elsewhere among them."""
    repeated = np.zeros(len(start), bool)
    if len(start) < 2:
        return repeated
    of = np.full(len(text), -1, np.int64)
    of[start] = np.arange(len(start))
    order = of[suffix_array(text.astype(np.int64) + 1, length)]
    order = order[order >= 0]
    words = np.lib.stride_tricks.as_strided(
        np.concatenate([text, np.zeros(8, np.uint8)]), (len(text), 8), (1, 1)
    )
    a, b = start[order[:-1]], start[order[1:]]
    for p in (*range(0, length - 7, 8), *((length - 8,) if length % 8 else ())):
        same = (words[a + p] == words[b + p]).all(axis=1)
        keep = np.flatnonzero(same)
        a, b = a[keep], b[keep]
        order_a = keep if p == 0 else order_a[keep]
    repeated[order[:-1][order_a]] = True
    repeated[order[1:][order_a]] = True
    return repeated


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


MARKS = "row bigint, start bigint, end bigint"


def _sort_shares(texts: DataFrame, length: int) -> DataFrame:
    """Marked byte ranges of the contexts ``(h, row, start, n, copies, text)``, sorted share by share."""

    def flush(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(parts).combine_chunks()
        n = table.column("n").to_numpy().astype(np.int64)
        column = table.column("text").combine_chunks()
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        text = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        owner = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        flags = repeated_windows(text, offsets[owner] + place, length)
        flags &= (table.column("copies").to_numpy() == 1)[owner]  # all others are known to repeat
        # a gap between contexts, so that no run crosses them
        gapped = np.zeros(len(flags) + len(n), bool)
        gapped[np.arange(len(flags)) + owner] = flags
        first, end = runs(gapped)
        if not len(first):
            return None
        ctx = np.searchsorted(np.cumsum(n + 1), first, side="right")
        base = (np.cumsum(n + 1) - (n + 1))[ctx]
        row, start = table.column("row").to_numpy()[ctx], table.column("start").to_numpy()[ctx]
        columns = [row, start + first - base, start + end - 1 - base + length]
        return pa.record_batch([pa.array(x) for x in columns], names=["row", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            if b.num_rows == 0:
                continue
            h = b.column("h").to_numpy()
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            if held and held[-1].column("h")[-1].as_py() == h[0]:
                first = first[1:]
            ends = np.cumsum(b.column("n").to_numpy().astype(np.int64) + length - 1)
            at = 0
            for cut in first.tolist():  # a share may end where an anchor begins
                grown = size + int(ends[cut - 1] - (ends[at - 1] if at else 0)) if cut > at else size
                if grown >= SHARE_BYTES:
                    if cut > at:
                        held.append(b.slice(at, cut - at))
                    if held and (out := flush(held)) is not None:
                        yield out
                    held, size, at = [], 0, cut
            if at < b.num_rows:
                held.append(b.slice(at))
                size += int(ends[-1] - (ends[at - 1] if at else 0))
        if held and (out := flush(held)) is not None:
            yield out

    # doc_id rides along, so that the texts move by row once, for these contexts and for the result
    dealt = texts.drop("k").repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, MARKS)


def _count_windows(texts: DataFrame, length: int) -> DataFrame:
    """Marked ranges of the contexts of crowded anchors, their windows counted by hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, start, n, copies, text in zip(*(b.column(c).to_pylist() for c in ("row", "start", "n", "copies", "text"))):
                found = Hasher(np.frombuffer(text, np.uint8)).windows(length)
                other = Hasher(np.frombuffer(text, np.uint8) ^ np.uint8(0xA5)).windows(length)
                columns = [found.view(np.int64), mix(other ^ U(0x5DEECE66D)).view(np.int64), np.full(n, row), start + np.arange(n), np.full(n, copies)]
                yield pa.record_batch([pa.array(x) for x in columns], names=["one", "two", "row", "start", "copies"])

    windows = texts.select("row", "doc_id", "start", "n", "copies", "text").mapInArrow(
        run, "one bigint, two bigint, row bigint, start bigint, copies bigint"
    )
    twice = windows.groupBy("one", "two").agg(F.count("*").alias("k")).where("k > 1").select("one", "two")
    return windows.where("copies = 1").join(twice, ["one", "two"]).select(
        "row", "start", (F.col("start") + length).alias("end")
    )


def repeated_ranges(rows: DataFrame, *, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``(row, start, end)``: byte ranges of ``(row, doc_id, text)`` covered by repeated strings; ranges may overlap."""
    found = anchors(rows.select("row", "text"), length, gram)
    again = written(found.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h"), "repeated-anchors")
    kept = written(found.join(again, "h"), "anchors")
    distinct = kept.groupBy("h", "c").agg(
        F.count("*").alias("copies"), F.first("row").alias("row"), F.first("start").alias("start"), F.first("n").alias("n")
    )
    distinct = written(distinct, "contexts")
    whole = distinct.where("copies > 1").select("h", "c")
    marks = kept.join(whole, ["h", "c"]).select("row", "start", (F.col("start") + F.col("n") - 1 + length).alias("end"))

    per_anchor = distinct.groupBy("h").agg(F.count("*").alias("k"), F.min("copies").alias("least"))
    mixed = distinct.join(written(per_anchor.where("k > 1 and least = 1").select("h", "k"), "mixed-anchors"), "h")
    span = F.substring(F.col("text").cast("binary"), (F.col("start") + 1).cast("int"), F.col("n") + (length - 1))
    texts = mixed.join(rows.select("row", "doc_id", "text"), "row").select("h", "k", "row", "doc_id", "start", "n", "copies", span.alias("text"))
    few = _sort_shares(texts.where(F.col("k") <= SHARE_CONTEXTS), length)
    crowded = _count_windows(texts.where(F.col("k") > SHARE_CONTEXTS), length)
    return marks.unionByName(few).unionByName(crowded)


def merge_marks(marks: DataFrame) -> DataFrame:
    """Overlapping and touching ranges of a row joined, as the sorted marks stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), np.int64)  # the range that may go on
        for b in batches:
            if b.num_rows == 0:
                continue
            row, start, end = np.concatenate([held.T, np.stack([b.column(c).to_numpy() for c in ("row", "start", "end")])], axis=1)
            of = np.cumsum(np.r_[0, row[1:] != row[:-1]])
            # a reach per row: each row's ends lie above all of the rows before it
            base = of * (int(end.max()) + 1)
            reach = np.maximum.accumulate(end + base) - base
            first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (start[1:] > reach[:-1])])
            done = np.stack([row[first], start[first], reach[np.append(first[1:], len(row)) - 1]], axis=1)
            held = done[-1:]
            if len(done) > 1:
                yield pa.record_batch([pa.array(x) for x in done[:-1].T], names=["row", "start", "end"])
        if len(held):
            yield pa.record_batch([pa.array(x) for x in held.T], names=["row", "start", "end"])

    return marks.repartition("row").sortWithinPartitions("row", "start").mapInArrow(run, MARKS)


REMOVED = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<bigint>"


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)`` of every row of ``(doc_id, text)``.

    Texts count as UTF-8 bytes, a null text as an empty one. Each byte in a string of
    ``length`` bytes that also starts anywhere else goes, matches never cross texts;
    ``spans`` holds start and end of every maximal removed run. Rows are texts of their own,
    also equal ones and those without id; an empty table stays empty. Other columns are
    ignored. Rows keep their numbers when the cores, and with them the splits, change between
    the passes (:func:`eocube.llm.tables.numbered`).
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = numbered(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")))
    marks = repeated_ranges(rows, length=length, gram=gram)
    per_row = merge_marks(marks).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("marks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[] for _ in range(5)]
            marks = b.column("marks")
            texts = b.column("text")
            for r in range(b.num_rows):
                data = texts[r].as_py().encode("utf-8")
                spans = np.zeros((0, 2), np.int64)
                if marks[r].is_valid:
                    value = marks[r].values
                    start, end = value.field("start").to_numpy(), value.field("end").to_numpy()
                    spans = merged(start, end)
                kept, at = hashlib.sha256(), 0
                for s, e in spans.tolist():
                    kept.update(data[at:s])
                    at = e
                kept.update(data[at:])
                for column, x in zip(out, (len(data), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), kept.hexdigest(), spans.ravel().tolist())):
                    column.append(x)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
            yield pa.record_batch(
                [b.column("doc_id"), *(pa.array(x, k) for x, k in zip(out, kinds))],
                names=[x.split()[0] for x in REMOVED.split(", ")],
            )

    return rows.join(per_row, "row", "left").select("row", "doc_id", "text", "marks").mapInArrow(cut, REMOVED)


def merged(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Overlapping and touching ranges joined, in order."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    opens = np.ones(len(start), bool)
    opens[1:] = start[1:] > reach[:-1]
    first = np.flatnonzero(opens)
    return np.stack([start[first], reach[np.append(first[1:], len(start)) - 1]], axis=1)
