"""Token ids of batches of texts, by the tokenizers library, each distinct unit encoded once."""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

from eocube.llm.spans import U, pieces, range_hashes, same_ranges, units

KEPT_UNITS = 1_500_000
_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """One encoder per Python worker and tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def first_places(codes: np.ndarray, count: int) -> np.ndarray:
    """For each code the index of its first occurrence."""
    first = np.empty(count, np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return first


class UnitTable:
    """Numbers distinct byte strings from 0, and forgets all of them once it is full.

    Strings meet by a 64-bit hash and are compared byte by byte, those of a buffer among
    themselves and with the ones known before. Two strings with one hash, should they ever
    occur, change the seed and empty the table, so numbers never mix strings up.
    """

    def __init__(self, limit: int, limit_bytes: int = 64 << 20):
        self.limit, self.limit_bytes, self.seed = limit, limit_bytes, 0
        self.clear()

    def clear(self) -> None:
        self.keys, self.numbers = np.zeros(0, U), np.zeros(0, np.int64)
        self.data, self.bounds = np.zeros(1 << 16, np.uint8), np.zeros(1, np.int64)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of hashes, and which of them are known."""
        if not len(self.keys):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        order = np.argsort(hashes)  # a sorted search walks the keys in order
        at = np.empty(len(hashes), np.int64)
        at[order] = np.minimum(np.searchsorted(self.keys, hashes[order]), len(self.keys) - 1)
        return self.numbers[at], self.keys[at] == hashes

    def _add(self, hashes: np.ndarray, numbers: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        order = np.argsort(hashes)
        keys = np.concatenate([self.keys, hashes[order]])
        values = np.concatenate([self.numbers, numbers[order]])
        merge = np.argsort(keys, kind="stable")  # two sorted runs
        self.keys, self.numbers = keys[merge], values[merge]
        size, used = end - start, int(self.bounds[-1])
        bounds = used + np.cumsum(size)
        if len(size) and bounds[-1] > len(self.data):
            self.data = np.concatenate([self.data[:used], np.zeros(2 * int(bounds[-1]) - used, np.uint8)])
        flat = np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)
        self.data[used : used + len(flat)] = buf[flat]
        self.bounds = np.concatenate([self.bounds, bounds])

    def number(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
        """The number of each range, an occurrence of each string that is new, and whether all numbers begin anew.

        New strings get the next numbers in the order of the second array.
        """
        emptied = False
        while True:
            codes, hashes = pd.factorize(range_hashes(buf, start, end, self.seed))
            at = first_places(codes, len(hashes))
            if len(self.keys) + len(hashes) > self.limit or self.bounds[-1] > self.limit_bytes:
                self.clear()
                emptied = True
            numbers, hit = self._find(hashes)
            old, known = at[hit], numbers[hit]
            if same_ranges(buf, start, end, buf, start[at][codes], end[at][codes]) and same_ranges(
                buf, start[old], end[old], self.data, self.bounds[known], self.bounds[known + 1]
            ):
                break
            self.seed += 1
            self.clear()
            emptied = True
        new = np.flatnonzero(~hit)
        numbers[new] = len(self.bounds) - 1 + np.arange(len(new))
        fresh = at[new]
        self._add(hashes[new], numbers[new], buf, start[fresh], end[fresh])
        return numbers[codes] if len(codes) else np.zeros(0, np.int64), fresh, emptied


class Encoder:
    """Encodes texts unit by unit; the ids of distinct units are kept."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.table = UnitTable(KEPT_UNITS)
        self._clear()

    def _clear(self) -> None:
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encode_units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum())), size

    def _slots(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        slots, new, emptied = self.table.number(buf, start, end)
        if emptied:
            self._clear()
        if len(new):
            data = buf.tobytes()
            texts = [data[s:e].decode("utf-8") for s, e in zip(start[new].tolist(), end[new].tolist())]
            ids, size = self._encode_units(texts)
            if self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat[: self.used], np.zeros(self.used + 2 * len(ids), np.uint32)])
            self.flat[self.used : self.used + len(ids)] = ids
            self.begin = np.concatenate([self.begin, self.used + np.cumsum(size) - size])
            self.length = np.concatenate([self.length, size])
            self.used += len(ids)
        return slots

    def encode(self, column: pa.Array, end_id: int):
        """Runs of rows: first row, ids of all rows one after the other, offsets; each row ends with ``end_id``."""
        for i, j, buf, offsets in pieces(column):
            start, stop, first = units(buf, offsets)
            slots = self._slots(buf, start, stop)
            begin, counts = self.begin[slots], self.length[slots]
            total = np.concatenate([[0], np.cumsum(counts)])
            row_start = total[first] + np.arange(len(offsets))
            out = np.full(int(row_start[-1]), end_id, np.uint32)
            inside = np.ones(len(out), bool)
            inside[row_start[1:] - 1] = False  # a row's last place is its end id
            out[inside] = self.flat[np.arange(int(total[-1])) + np.repeat(begin - total[:-1], counts)]
            yield i, out, row_start
