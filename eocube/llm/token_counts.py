"""Token counts by a transducer compiled from a byte-level BPE file.

:class:`Transducer` is a deterministic transducer over bytes, compiled on demand. It reads
one pre-token from the start state; each transition carries the number of tokens emitted
by it, and the sum along the path is the token count of the pre-token. A state holds what
the next steps can depend on: for the byte strings that may still grow into a vocabulary
entry, the last token and the token count of the encoding up to their start, relative to
the current count. That is enough because the BPE encoding of a prefix is the encoding of
a shorter prefix plus its last token.

Texts are cut into chunks. The summary of a chunk is its map of entry to exit state in the
form that all entry states share: bytes before the first sure boundary, the count between
the first and the last one, bytes after it. Summaries compose associatively, so chunks of a
long text are counted in parallel and combined by a scan.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.llm.encode import UnitTable
from eocube.llm.spans import pieces, units
from eocube.llm.tables import written

# Fixed value: the pre-token pattern of the byte-level scheme.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK_CHARS = 65_536
KEPT_UNITS = 1_000_000
KEPT_STATES = 60_000
KEPT_PAIRS = 100_000
_compiled: dict[str, "Transducer"] = {}


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """The compiled counter of one tokenizer file of BPE over bytes.

    Tokens are numbered by their merge, single bytes first, so that the smaller of two
    merges runs first.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._require(spec)
        symbols = byte_symbols()
        number = {bytes([b]): b for b in range(256)}
        self.pairs: dict[tuple[int, int], int] = {}
        self.halves: list[tuple[int, int]] = [(b, b) for b in range(256)]
        for m in spec["model"]["merges"]:
            left, right = (bytes(symbols[c] for c in s) for s in (m if isinstance(m, list) else m.split(" ")))
            if left + right in number:
                raise ValueError("a token is made by two merges")
            self.pairs[number[left], number[right]] = number[left + right] = len(self.halves)
            self.halves.append((number[left], number[right]))
        # the trie of all tokens: children by node and byte, and each node's token
        self.child: dict[int, int] = {}
        self.token_at = [-1]
        for data, token in number.items():
            node = 0
            for b in data:
                step = node << 8 | b
                if step not in self.child:
                    self.child[step] = len(self.token_at)
                    self.token_at.append(-1)
                node = self.child[step]
            self.token_at[node] = token
        inner = {step >> 8 for step in self.child}
        self.grows = [n in inner for n in range(len(self.token_at))]
        # tokens that their own bytes encode to
        for token, (left, right) in enumerate(self.halves):
            if token >= 256 and not self._joins(left, right, token):
                raise ValueError("a token does not encode to itself")
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.pretoken = regex.compile(PRETOKEN)
        self.splits = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.fits: dict[int, bool] = {}
        self.table, self.counts = UnitTable(KEPT_UNITS), np.zeros(0, np.int64)
        self._reset_states()

    @staticmethod
    def _require(spec: dict) -> None:
        """Refuse files with features that this compiler doesn't know."""
        pre, model = spec["pre_tokenizer"], spec["model"]
        plain = (
            model["type"] == "BPE" and pre["type"] == "ByteLevel" and pre.get("use_regex", True)
            and not pre["add_prefix_space"] and spec["normalizer"] is None and not model.get("ignore_merges")
            and not model.get("dropout") and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        )
        if not plain:
            raise ValueError("only plain byte-level BPE files can be compiled")

    def _reset_states(self) -> None:
        # a state: for each byte string still open its trie node, and the last token and the count before
        # it; -1 is no token, counts are relative to the current one
        begin = (0, -1, 0)
        self.names: dict[tuple, int] = {begin: 0}
        self.states: list[tuple] = [begin]
        self.moves: dict[int, int] = {}

    def _joins(self, left: int, right: int, limit: int) -> bool:
        """Whether two tokens stay apart until merge ``limit``, that is, no merge across their border runs before it.

        Merges run by number. Undoing the later of the last merges of both sides shows what
        stood at the border when each merge ran; a pair there with a smaller number than the
        merge undone last would have merged across.
        """
        pairs, halves = self.pairs, self.halves
        while True:
            across = pairs.get((left, right))
            if across is not None and across < limit:
                return False
            if left < 256 and right < 256:
                return True
            if left > right:  # the left one was merged later
                limit, left = min(limit, left), halves[left][1]
            else:  # of the same merge the left one ran first, so a tie lets the border pair go
                limit, right = min(limit, right + 1), halves[right][0]

    def _follows(self, left: int, right: int) -> bool:
        """Whether two tokens side by side encode as themselves."""
        key = left << 32 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > KEPT_PAIRS:
                self.fits.clear()
            known = self.fits[key] = self._joins(left, right, len(self.halves))
        return known

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        """The transition of a state by a byte: next state and tokens emitted."""
        token, emitted, grown = -1, 0, []
        open_now = self.states[state]
        for k in range(0, len(open_now), 3):
            last = open_now[k + 1]
            node = self.child.get(open_now[k] << 8 | byte)
            if node is None:
                continue
            if token < 0:
                found = self.token_at[node]
                if found >= 0 and (last < 0 or self._follows(last, found)):
                    token, emitted = found, open_now[k + 2] + 1
            if self.grows[node]:
                grown.append((node, last, open_now[k + 2]))
        entries = (*(x for n, t, c in grown for x in (n, t, c - emitted)), 0, token, 0)
        if entries not in self.names:
            self.names[entries] = len(self.states)
            self.states.append(entries)
        return self.names[entries], emitted

    def pretoken_count(self, data: bytes) -> int:
        if len(self.states) > KEPT_STATES:
            self._reset_states()
        state = total = 0
        moves = self.moves
        for b in data:
            hop = moves.get(state << 8 | b)
            if hop is None:
                after, emitted = self._step(state, b)
                hop = moves[state << 8 | b] = after << 12 | emitted + 2048
            state = hop >> 12
            total += (hop & 4095) - 2048
        return total

    def count(self, text: str) -> int:
        """Tokens of a text, special strings included, by running the transducer over its pre-tokens."""
        parts = self.splits.split(text) if self.splits else [text]
        total = 0
        for i, part in enumerate(parts):
            total += 1 if i % 2 else sum(self.pretoken_count(w.encode()) for w in self.pretoken.findall(part))
        return total

    def unit_counts(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The count of every unit; a unit known from before is not counted again."""
        numbers, new, emptied = self.table.number(buf, start, end)
        if emptied:
            self.counts = np.zeros(0, np.int64)
        if len(new):
            data = buf.tobytes()
            found = [self.count(data[s:e].decode("utf-8")) for s, e in zip(start[new].tolist(), end[new].tolist())]
            self.counts = np.concatenate([self.counts, np.array(found, np.int64)])
        return self.counts[numbers]


def transducer(path: str) -> Transducer:
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


SUMMARY = "row_id bigint, chunk int, doc_id bigint, n_bytes bigint, whole boolean, head binary, inner_count bigint, tail binary"


def chunk_summaries(rows: DataFrame, tokenizer: str) -> DataFrame:
    """The summary of every chunk ``(row_id, chunk, doc_id, part, last)``.

    Where a text is one chunk, ``inner_count`` is its count; otherwise ``head`` and ``tail``
    are the bytes outside the sure boundaries, or ``tail`` is null and ``head`` everything.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer)
        for b in batches:
            for i, j, buf, offsets in pieces(b.column("part")):
                start, end, first = units(buf, offsets)
                per_unit = machine.unit_counts(buf, start, end)
                sums = np.concatenate([[0], np.cumsum(per_unit)])
                whole = np.asarray(b.column("whole").slice(i, j - i).to_numpy(zero_copy_only=False), bool)
                inner = sums[first[1:]] - sums[first[:-1]]
                heads: list[bytes | None] = [None] * (j - i)
                tails: list[bytes | None] = [None] * (j - i)
                for r in np.flatnonzero(~whole).tolist():
                    a, z = int(first[r]), int(first[r + 1])
                    if z - a < 2:
                        heads[r], inner[r] = buf[offsets[r] : offsets[r + 1]].tobytes(), 0
                    else:
                        heads[r] = buf[start[a] : end[a]].tobytes()
                        tails[r] = buf[start[z - 1] : end[z - 1]].tobytes()
                        inner[r] = sums[z - 1] - sums[a + 1]
                yield pa.record_batch(
                    [
                        *(b.column(c).slice(i, j - i) for c in ("row_id", "chunk", "doc_id")),
                        pa.array(np.diff(offsets)), b.column("whole").slice(i, j - i),
                        pa.array(heads, pa.binary()), pa.array(inner), pa.array(tails, pa.binary()),
                    ],
                    names=[x.split()[0] for x in SUMMARY.split(", ")],
                )

    return rows.mapInArrow(run, SUMMARY)


Summary = tuple[bytes, int, bytes | None]


def join_summaries(a: Summary, b: Summary, count) -> Summary:
    """The summary of two neighbouring stretches; ``count`` counts the bytes between their boundaries.

    ``(h1, n1, t1) (h2, n2, t2) = (h1, n1 + count(t1 h2) + n2, t2)``; a stretch without a
    boundary is all head, and only extends its neighbour.
    """
    if a[2] is None:
        return a[0] + b[0], b[1], b[2]
    if b[2] is None:
        return a[0], a[1], a[2] + b[0]
    return a[0], a[1] + count(a[2] + b[0]) + b[1], b[2]


def total(summary: Summary, count) -> int:
    """The token count of a whole text from its summary."""
    head, inner, tail = summary
    return count(head) + inner + (count(tail) if tail is not None else 0)


def compose(summaries: list[Summary], count) -> int:
    """The token count of a text from the summaries of its chunks, in order."""
    return total(reduce(lambda a, b: join_summaries(a, b, count), summaries), count)


def token_counts(docs: DataFrame, tokenizer: str, *, limit: int = 512, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row of ``(doc_id, text)``.

    A null or empty text has no bytes and no tokens; repeated rows and null ids are
    counted row by row; other columns are ignored; an empty table gives an empty result. Texts
    of more than ``chunk_chars`` characters are counted in chunks; one without any white space
    behind an ASCII or Latin character has no boundary and is counted whole in the last round.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")
    )
    n = F.greatest(F.ceil(F.length("text") / chunk_chars), F.lit(1)).cast("int")
    chunks = rows.select("row_id", "doc_id", "text", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk"))
    part = F.when(F.col("n") == 1, F.col("text")).otherwise(
        F.substring(F.col("text"), F.col("chunk") * chunk_chars + 1, F.lit(chunk_chars))
    )
    parts = chunks.select("row_id", "chunk", "doc_id", part.alias("part"), (F.col("n") == 1).alias("whole"))
    found = chunk_summaries(parts, tokenizer)
    return combined(found, tokenizer).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def combined(found: DataFrame, tokenizer: str) -> DataFrame:
    """One row per text from its chunk summaries; only texts of several chunks are shuffled.

    Neighbours are joined pairwise, round by round, so a text of ``n`` chunks takes ``log2(n)``
    rounds and the borders of a round are counted in parallel.
    """
    found = written(found, "token-summaries")
    single = found.where("whole").select("doc_id", "n_bytes", F.col("inner_count").alias("n_tokens"))
    several = found.where(~F.col("whole")).drop("whole")
    last = several.agg(F.max("chunk")).first()[0] or 0

    def pair(frame: pd.DataFrame) -> pd.DataFrame:
        machine = transducer(tokenizer)
        count = lambda data: machine.count(data.decode("utf-8"))
        parts = frame.sort_values("place")
        summaries = list(zip(parts["head"], parts["inner_count"].tolist(), parts["tail"]))
        head, inner, tail = reduce(lambda a, b: join_summaries(a, b, count), summaries)
        one = {"n_bytes": int(parts["n_bytes"].sum()), "head": head, "inner_count": inner, "tail": tail}
        return parts.iloc[:1].assign(**{k: [v] for k, v in one.items()}).drop(columns="place")

    for _ in range(last.bit_length()):
        near = several.select("*", F.col("chunk").alias("place")).withColumn("chunk", F.shiftright("chunk", 1))
        several = near.groupBy("row_id", "chunk").applyInPandas(pair, several.schema)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer)
        count = lambda data: machine.count(data.decode("utf-8"))
        for b in batches:
            summaries = zip(*(b.column(c).to_pylist() for c in ("head", "inner_count", "tail")))
            counts = pa.array([total(x, count) for x in summaries], pa.int64())
            yield pa.record_batch([b.column("doc_id"), b.column("n_bytes"), counts], names=["doc_id", "n_bytes", "n_tokens"])

    return single.unionByName(several.mapInArrow(close, "doc_id bigint, n_bytes bigint, n_tokens bigint"))
