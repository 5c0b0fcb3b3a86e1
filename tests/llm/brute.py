"""Plain versions of the corpus operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
_tokenizer = Tokenizer.from_file(PATH)


def encode(text):
    return _tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def remove_repeats(texts, length):
    """Per text: bytes, removed bytes, spans and hash of the rest."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + length] for b in data for p in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = (b"\0" + bytes(gone)).count(b"\0\1")
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def components(docs):
    """``doc_id`` to the smallest id it reaches; rows of one id are one document."""
    sets = [(i, shingles(t)) for i, t in docs if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        shared = Counter(j for g in s for j in where[g])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j][1]) - n):
                a, b = find(sets[k][0]), find(sets[j][0])
                parent[max(a, b)] = min(a, b)
        for g in s:
            where[g].append(k)
    return {i: find(i) for i in parent}


def passages(docs, items, span=13, least=11):
    """Pairs ``(doc_id, item_id)`` with an aligned window of enough equal words."""
    split = lambda t: re.findall(rb"[^\x00-\x20!-/:-@\[-`{-~]+|[\x00-\x08\x0e-\x1f]+", (t or "").encode().lower())
    found = set()
    for d, text in docs:
        w = split(text)
        for k, item in items:
            q = split(item)
            size = min(span, len(q))
            need = least if len(q) >= span else len(q)
            if len(q) < 5:
                continue
            for shift in range(-len(q), len(w)):
                same = [0 <= shift + j < len(w) and w[shift + j] == q[j] for j in range(len(q))]
                if any(sum(same[j : j + size]) >= need and 0 <= shift + j and shift + j + size <= len(w) for j in range(len(q) - size + 1)):
                    found.add((d, k))
                    break
    return found


def line_dedup(docs, min_chars=20, min_docs=3):
    """Per row: lines, dropped lines and hash of the rest."""
    blanks = " \t\n\x0b\x0c\r"
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(blanks))
    rank = lambda i: (i is not None, i or 0)
    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    places = defaultdict(set)  # rows of one document lose a line at a place together
    for i, t in docs:
        for p, line in enumerate((t or "").split("\n")):
            k = key(line)
            if len(k) >= min_chars and len(holders[k]) >= min_docs and i != max(holders[k], key=rank):
                places[i].add(p)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for p, x in enumerate(lines) if p not in places[i]]
        out.append((i, len(lines), len(places[i]), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out
