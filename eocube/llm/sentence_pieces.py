"""SentencePiece encoding with byte spans, and decoding.

A text is normalised by the model's own rules: its compiled character map (a double-array trie
of byte strings, each with a replacement) is applied by longest prefix from left to right, then
blanks are stripped, put in front and written as U+2581 as the model asks. Beside every
normalised byte stands the byte of the source it comes from, so each piece has its span of the
original text. Between a symbol and a following blank no piece of the vocabulary reaches over,
so the normalised text is cut there; the library encodes each distinct unit of the text once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.llm.encode import UnitTable
from eocube.llm.spans import PIECE_BYTES, pieces

# Fixed values of the format: the sign for a blank, field numbers, and the bits of a trie unit.
BLANK = "▁".encode()
NORMALIZER, CHARSMAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 3, 2, 3, 4, 5
TRAINER, SUFFIX_BLANK, DENORMALIZER = 2, 24, 5
# A worker serves tasks of both steps in turn, so what it keeps counts twice per core: the units
# that are kept, their bytes, the bytes of rows taken at a time, and the units given to the library at once.
KEPT_UNITS = 200_000
KEPT_BYTES = 16 << 20
ROW_BYTES = 512 << 10
ENCODED_UNITS = 20_000
_models: dict[str, "PieceModel"] = {}
_decoders: dict = {}


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a serialized message; fixed-width values come as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(message):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
            yield tag >> 3, message[at : at + size]
            at += size


def plain_rules(model: bytes) -> bytes:
    """The model with rules that leave a text as it is: later fields of a message take precedence."""
    rules = bytes([CHARSMAP << 3 | 2, 0, DUMMY_PREFIX << 3, 0, REMOVE_EXTRA << 3, 0, ESCAPE << 3, 0])
    return model + bytes([NORMALIZER << 3 | 2, len(rules)]) + rules


class CharacterMap:
    """A compiled character map: replacements of byte strings, found by their longest prefix."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64)
        self.replacements = blob[4 + size :]
        base = self._base(0)
        self.first = self._children(np.array([base]))[0]  # nodes after one byte, or -1
        self.pairs = np.zeros(1 << 16, bool)  # first two bytes of keys; all second bytes where one byte is a key
        for a in np.flatnonzero(self.first >= 0).tolist():
            after = self._children(np.array([self._base(int(self.first[a]))]))[0] >= 0
            self.pairs[a << 8 : (a + 1) << 8] = after | bool(self.units[self.first[a]] >> 8 & 1)
        self.mapped = (self.first >= 0) & (self.units[np.maximum(self.first, 0)] >> 8 & 1 > 0)  # keys of one byte
        self.blank_inside = self._blank_inside(base)

    def _base(self, node):
        unit = self.units[node]
        return node ^ ((unit >> 10) << ((unit & 512) >> 6))

    def _children(self, base: np.ndarray) -> np.ndarray:
        """For each base the node of every next byte, -1 where there is none."""
        byte = np.arange(256)
        node = base[:, None] ^ byte
        inside = node < len(self.units)
        unit = self.units[np.where(inside, node, 0)]
        return np.where(inside & ((unit & 0x800000FF) == byte), node, -1)

    def _blank_inside(self, base: int) -> bool:
        """Whether a blank occurs in a key behind its first byte."""
        level = self.first[self.first >= 0]
        while len(level):
            found = np.concatenate([self._children(self._base(part)) for part in np.array_split(level, len(level) // 4096 + 1)])
            found[:, 0] = -1  # a value's unit looks like a child of byte 0
            if (found[:, 32] >= 0).any():
                return True
            level = found[found >= 0]
        return False

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """The end of the longest key that starts at a place, and its replacement."""
        best, base = None, int(self._base(0))
        for end in range(at, len(data)):
            node = base ^ data[end]
            if node >= len(self.units) or int(self.units[node]) & 0x800000FF != data[end]:
                break
            base = int(self._base(node))
            if self.units[node] >> 8 & 1:
                start = int(self.units[base]) & 0x7FFFFFFF
                best = end + 1, self.replacements[start : self.replacements.index(0, start)]
        return best

    def apply(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The mapped bytes, and for each of them and for the end its place in ``buf``."""
        after = np.append(buf[1:], 0).astype(np.int64)
        starts = np.flatnonzero(((buf & 0xC0) != 0x80) & self.pairs[buf.astype(np.int64) << 8 | after])
        data, out, origin, done = buf.tobytes(), [], [], 0
        for at in starts.tolist():
            if at < done or (found := self.longest(data, at)) is None:
                continue
            end, new = found
            out += [data[done:at], new]
            origin += [np.arange(done, at), np.full(len(new), at)]
            done = end
        out.append(data[done:])
        origin.append(np.arange(done, len(data) + 1))
        return np.frombuffer(b"".join(out), np.uint8), np.concatenate(origin)


class PieceModel:
    """A model file: its rules by this module, its vocabulary and merges by the library."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            model = f.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.core = sentencepiece.SentencePieceProcessor(model_proto=plain_rules(model))
        rules = {DUMMY_PREFIX: 1, REMOVE_EXTRA: 1, ESCAPE: 1, CHARSMAP: b""}
        for number, value in fields(model):
            if number == NORMALIZER:
                rules |= dict(fields(value))
            if number == TRAINER and dict(fields(value)).get(SUFFIX_BLANK):
                raise ValueError("models that write blanks as suffixes are not supported")
        self.dummy, self.strip, self.escape = (bool(rules[k]) for k in (DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE))
        self.map = CharacterMap(rules[CHARSMAP]) if rules[CHARSMAP] else None
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        # how many normalised bytes an id stands for; -1: it has to be looked up
        self.size = np.array([1 if self.library.is_byte(i) else len(x.encode()) for i, x in enumerate(names)])
        self.size[[i for i in range(len(names)) if self.library.is_unknown(i)]] = -1
        sign = BLANK.decode()
        crossing = any(sign in x.lstrip(sign) for x in names)
        self.cuts = self.escape and not crossing and not (self.map and self.map.blank_inside)
        self.table = UnitTable(KEPT_UNITS, KEPT_BYTES)
        self._clear()

    def _clear(self) -> None:
        self.flat, self.width = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def normalise(self, buf: np.ndarray, first: bool, last: bool) -> tuple[np.ndarray, np.ndarray]:
        """A stretch of a text by the model's rules, and the place in ``buf`` of every byte and of the end.

        ``first`` and ``last``: the stretch begins and ends its text.
        """
        out, origin = (buf, np.arange(len(buf) + 1)) if self.map is None else self.map.apply(buf)
        blank = out == 32
        if self.strip and blank.any():
            keep = np.ones(len(out), bool)
            keep[1:] = ~(blank[1:] & blank[:-1])
            solid = np.flatnonzero(~blank)
            lead = int(solid[0]) if len(solid) else len(out)
            if first:
                keep[:lead] = False
            tail = int(solid[-1]) + 1 if len(solid) else 0
            if last:
                keep[tail:] = False
            ends = origin[tail if last else -1]
            out, origin, blank = out[keep], np.append(origin[:-1][keep], ends), blank[keep]
        if self.dummy and first and len(out):
            out, origin, blank = np.append(np.uint8(32), out), np.append(origin[0], origin), np.append(True, blank)
        if self.escape:
            size = np.where(blank, 3, 1)
            at = np.cumsum(size) - size
            origin = np.append(np.repeat(origin[:-1], size), origin[-1])
            out = np.repeat(out, size)
            for k, byte in enumerate(BLANK):
                out[at[blank] + k] = byte
        return out, origin

    def units(self, out: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where units of normalised texts start: at the texts' edges and at blanks behind other symbols."""
        cut = np.zeros(len(out) + 1, bool)
        if self.cuts and len(out) > 2:
            sign = np.zeros(len(out) + 1, bool)
            sign[: len(out) - 2] = (out[:-2] == BLANK[0]) & (out[1:-1] == BLANK[1]) & (out[2:] == BLANK[2])
            cut[3:] = sign[3:] & ~sign[:-3]
            cut[:3] = sign[:3]
        cut[edges[:-1]] = True
        cut[len(out)] = False
        return np.flatnonzero(cut)

    def encode(self, out: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of normalised texts, ends of their pieces in ``out``, and per text the index of its first piece."""
        start = self.units(out, edges)
        end = np.append(start[1:], len(out))[: len(start)]
        numbers, new, emptied = self.table.number(out, start, end)
        if emptied:
            self._clear()
        if len(new):
            made = [self._look_up(out, start[part], end[part]) for part in np.split(new, range(ENCODED_UNITS, len(new), ENCODED_UNITS))]
            flat, width, count = (np.concatenate(x) for x in zip(*made))
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.flat, self.width = np.concatenate([self.flat, flat]), np.concatenate([self.width, width])
        count = self.count[numbers]
        total = np.concatenate([[0], np.cumsum(count)])
        at = np.arange(int(total[-1])) + np.repeat(self.begin[numbers] - total[:-1], count)
        return self.flat[at], np.cumsum(self.width[at]), total[np.searchsorted(start, edges)]

    def _look_up(self, out: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The library's ids of units one after the other, the bytes each id stands for, and how many a unit has."""
        texts = [out[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(start.tolist(), end.tolist())]
        ids = self.core.encode(texts, num_threads=1)
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for one in ids for x in one), np.int32, int(count.sum()))
        width = self.size[flat].astype(np.int32)
        where = np.cumsum(count) - count
        for k in np.unique(np.searchsorted(where, np.flatnonzero(width < 0), side="right") - 1).tolist():
            found = self.core.encode(texts[k], return_type="offset_mapping", return_bytes=True)
            width[where[k] : where[k] + count[k]] = [z - a for a, z in found["offsets"]]
        return flat, width, count

    def stretches(self, buf: np.ndarray) -> Iterator[tuple[int, int]]:
        """A long text in stretches that begin with a blank behind another symbol."""
        at = 0
        while at < len(buf):
            end = len(buf)
            if self.cuts and end - at > PIECE_BYTES:
                window = buf[at + PIECE_BYTES :]
                if self.map is None:
                    solid = window != 32
                    solid[2:] &= (window[:-2] != BLANK[0]) | (window[1:-1] != BLANK[1]) | (window[2:] != BLANK[2])
                    solid[:2] = False
                else:  # other bytes may end a symbol that becomes a blank
                    solid = (window > 32) & (window < 127) & ~self.map.mapped[window]
                found = np.flatnonzero((window[1:] == 32) & solid[:-1])
                end = at + PIECE_BYTES + 1 + int(found[0]) if len(found) else end
            yield at, end
            at = end

    def encode_batch(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Runs of rows: first row, ids, bounds of the pieces in their text (one more than ids), first id per row."""
        for i, j, buf, offsets in pieces(column, ROW_BYTES):
            parts = []  # stretches: row, bytes, place in the row, begins and ends its text
            for r in range(j - i):
                text = buf[offsets[r] : offsets[r + 1]]
                parts += [(r, text[a:z], a, z == len(text)) for a, z in self.stretches(text)]
            ids, ends, counts, row_of = [], [], [], []
            for group in _groups(parts):
                made = [self.normalise(text, a == 0, last) for _, text, a, last in group]
                out = np.concatenate([o for o, _ in made])
                edges = np.concatenate([[0], np.cumsum([len(o) for o, _ in made])])
                found, end, first = self.encode(out, edges)
                for k, ((r, _, a, _), (_, origin)) in enumerate(zip(group, made)):
                    x, z = first[k], first[k + 1]
                    ids.append(found[x:z])
                    ends.append(origin[end[x:z] - edges[k]] + a)
                    counts.append(z - x)
                    row_of.append(r)
            per_row = np.zeros(j - i, np.int64)
            np.add.at(per_row, np.array(row_of, np.int64), np.array(counts, np.int64))
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
            yield i, flat, end, np.concatenate([[0], np.cumsum(per_row)])


def _groups(parts: list) -> Iterator[list]:
    """Stretches in runs of about the size of one piece."""
    held, size = [], 0
    for p in parts:
        held.append(p)
        size += len(p[1])
        if size >= PIECE_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def piece_model(path: str) -> PieceModel:
    """One model per Python worker and file."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def decoder(path: str):
    """One processor of the library per Python worker and file."""
    import sentencepiece

    if path not in _decoders:
        _decoders[path] = _models[path].library if path in _models else sentencepiece.SentencePieceProcessor(model_file=path)
    return _decoders[path]


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids, ends)``: the piece ids of every row of ``(doc_id, text)`` and where each piece ends.

    Piece ``k`` covers the UTF-8 bytes from ``ends[k - 1]`` (0 for the first) up to ``ends[k]``
    of the original text, of a character encoded byte by byte each piece its own byte. Bytes that
    normalisation drops belong to the piece before them, at the beginning to the first piece,
    at the end to none. No begin or end ids. A null text is an empty one, and an
    empty text has no ids; long texts go in stretches, a text without blanks in one. Rows with
    one id or one text each have their row, null ids stay null, an empty table stays empty,
    other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = piece_model(model)
        for b in batches:
            for i, ids, ends, first in made.encode_batch(b.column("text")):
                offsets = pa.array(first.astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (ids, ends)]
                yield pa.record_batch([b.column("doc_id").slice(i, len(first) - 1), *lists], names=["doc_id", "ids", "ends"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, ends array<int>")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of ``(doc_id, ids, ends)`` with ``text``, the library's decoding of the ids; null ids are an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = decoder(model)
        for b in batches:
            column = b.column("ids")
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = [library.decode(x or []) for x in column.slice(at, 256).to_pylist()]
                yield pa.record_batch([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "text"])

    return encoded.mapInArrow(run, "doc_id bigint, ids array<int>, ends array<int>, text string")


def piece_digests(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes)`` of every row of ``(doc_id, text)``.

    The hashes are over the decimal ids joined by commas and over the decoded text;
    ``n_bytes`` is where the last span ends.
    """
    decoded = decode_pieces(encode_pieces(docs, model), model)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("bigint").alias("n_bytes"),
    )
