"""Periodic run detection by Baier grouping.

A run of a word sequence is a stretch with smallest period q and at least 2q words
that cannot be extended keeping q. Every run holds a Lyndon word of q words that is
the longest one from its place under the order of words or under its reverse
(Bannai et al.), so the Lyndon arrays under both orders give all runs:

1. :func:`lyndon` is phase one of Baier's suffix sorter. Places are grouped by their
   word; groups are taken from the highest down, each place of a group lengthens the
   nearest lower place to its left, and places lengthened equally often move to
   a new group above their old one. The lengths are the Lyndon array; nothing is
   sorted after that. A union-find jumps over places that are done.
2. :class:`Lce` answers how far two places agree to the right or the left, for all
   places at once: prefix hashes under two primes and a binary search.
3. :func:`runs_of` extends each Lyndon root both ways; what reaches 2q is a run.

Only words inside a stretch of repeated six-word windows can lie in a run of
``MIN_LENGTH`` words or more (a run of length L and period q repeats at least
max(6, L - q) words at distance q, so all but at most five of its windows in a row
are repeated); :func:`stretches` finds these, and the steps above run on each.
The rule drops no run, as the test against brute force shows.

Texts stay where they lie: one Arrow pass, a document after the other, memory
proportional to the longest text.

Defined cases: a null or empty text has no words; a null id changes nothing (see
:func:`periodic`); repeated rows are answered each; any byte other than the six
ASCII spaces belongs to a word. An empty table gives an empty table. Extra columns
are dropped, whatever their names.
"""

from __future__ import annotations

import zlib
from typing import Callable, Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, mix64, utf8_list

MIN_LENGTH, WINDOW = 12, 6
PRIMES = ((2147483647, 1103515245), (2147483629, 1812433253))


def lyndon(word: list[int]) -> list[int]:
    """The length of the longest Lyndon word from each place (a prefix is smaller)."""
    values = sorted(set(word))
    at = {v: g for g, v in enumerate(values)}
    group = [at[v] for v in word]
    size = [1] * len(word)
    members: list[list[int]] = [[] for _ in values]
    for i, g in enumerate(group):
        members[g].append(i)
    # groups in order, as a doubly linked list: -1 is below the lowest and above the highest
    below, above = list(range(-1, len(values) - 1)), [*range(1, len(values)), -1]
    left = list(range(len(word) + 1))  # union-find over places + 1; 0 is the edge
    g = len(values) - 1
    while g >= 0:
        mine = [i for i in members[g] if group[i] == g]
        members[g] = []
        for i in mine:
            left[i + 1] = i
        times: dict[int, int] = {}
        for i in mine:
            root = i
            while left[root] != root:
                root = left[root]
            while left[i] != root:
                left[i], i = root, left[i]
            if root:
                times[root - 1] = times.get(root - 1, 0) + 1
        width = size[mine[0]] if mine else 0
        moved: dict[tuple[int, int], int] = {}
        for j, k in sorted(times.items(), key=lambda x: -x[1]) if len(times) > 1 else times.items():
            old = group[j]
            new = moved.get((old, k))
            if new is None:  # right above the old group, below those lengthened more often
                new = moved[old, k] = len(members)
                members.append([])
                up = above[old]
                below.append(old)
                above.append(up)
                above[old] = new
                if up >= 0:
                    below[up] = new
            group[j] = new
            size[j] += k * width
            members[new].append(j)
        g = below[g]
    return size


class Lce:
    """How far two places of a sequence agree: prefix hashes under two primes (a wrong
    answer has a chance of about 2^-60 a comparison)."""

    def __init__(self, word: np.ndarray):
        self.n = len(word)
        self.sums = []
        for p, base in PRIMES:
            power = np.ones(self.n + 1, np.uint64)
            k, f = 1, base
            while k <= self.n:
                power[k : 2 * k] = power[:k][: self.n + 1 - k] * np.uint64(f) % np.uint64(p)
                f, k = f * f % p, 2 * k
            terms = (word.astype(np.uint64) + np.uint64(1)) % np.uint64(p) * power[: self.n] % np.uint64(p)
            total = np.zeros(self.n + 1, np.uint64)
            np.cumsum(terms, out=total[1:])
            self.sums.append((total % np.uint64(p), power, np.uint64(p)))

    def same(self, i, j, size) -> np.ndarray:
        """Whether ``size`` words from ``i`` equal those from ``j`` (``j >= i``)."""
        out = np.ones(len(i), bool)
        for total, power, p in self.sums:
            a = (total[i + size] + p - total[i]) % p * power[j - i] % p
            out &= a == (total[j + size] + p - total[j]) % p
        return out

    def extent(self, i, j, limit, step: int) -> np.ndarray:
        """Words alike from ``i`` and ``j`` to the right (step 1) or before them (step -1)."""
        low, high = np.zeros_like(limit), limit.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            back = mid if step < 0 else 0
            ok = self.same(i - back, j - back, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low


def runs_of(word: np.ndarray, min_length: int = MIN_LENGTH) -> set[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of at least ``min_length`` words."""
    lce, out, n = Lce(word), set(), len(word)
    i = np.arange(n)
    for order in (word, -word):
        period = np.array(lyndon(order.tolist()), np.int64)
        j = i + period
        ahead = lce.extent(i, j, n - j, 1)
        back = lce.extent(i, j, i.copy(), -1)
        length = back + period + ahead
        good = np.flatnonzero((length >= 2 * period) & (length >= min_length))
        out.update(zip((i - back)[good].tolist(), length[good].tolist(), period[good].tolist()))
    return out


def stretches(word: np.ndarray) -> list[tuple[int, int]]:
    """The parts of a sequence in which runs of ``MIN_LENGTH`` or more can lie: first
    and last word of windows that occur twice or more and follow each other closely."""
    n = len(word) - WINDOW + 1
    if n < 2:
        return []
    mixed, key = mix64(word.astype(np.uint64) + np.uint64(1)), np.zeros(n, np.uint64)
    for k in range(WINDOW):
        key = key * np.uint64(0x9E3779B97F4A7C15) + mixed[k : k + n]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[inverse] > 1)
    if not len(twice):
        return []
    cut = np.flatnonzero(np.diff(twice) > WINDOW)
    first, last = twice[np.concatenate(([0], cut + 1))], twice[np.concatenate((cut, [len(twice) - 1]))]
    return list(zip(first.tolist(), (last + WINDOW).tolist()))


def document_runs(word: np.ndarray) -> list[tuple[int, int, int]]:
    """The runs of a whole text's words, by start, then period."""
    return sorted((a + s, length, q) for a, b in stretches(word) for s, length, q in runs_of(word[a:b]))


def periodic(doc_id: Optional[int], n: int) -> Optional[np.ndarray]:
    """Which word stands at each place of a text of ``n`` words: for a tenth of the
    ids, what follows a place repeats from there. None: all as they are."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g, i = h // 10, np.arange(n)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.where(i < a, i, a + (i - a) % p)


SCHEMA = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Optional[Callable] = None) -> DataFrame:
    """Per row: the id, ``n_words``, its ``runs`` by start and period, and the text
    ``collapsed``: words joined by one space, without what a run repeats after its
    first period. ``rewrite(id, n)`` may name other words of the text to stand at its places."""
    bounded_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            counts, found, texts = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8_list(batch.column(1))):
                words, ids = text.split(), {}
                word = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
                other = rewrite(doc_id, len(words)) if rewrite else None
                if other is not None:
                    word, words = word[other], [words[k] for k in other.tolist()]
                runs = document_runs(word)
                if runs:
                    edge = np.zeros(len(words) + 1, np.int64)
                    for s, length, q in runs:
                        edge[s + q] += 1
                        edge[s + length] -= 1
                    words = [w for w, covered in zip(words, np.cumsum(edge)[:-1].tolist()) if not covered]
                counts.append(len(word))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                texts.append(b" ".join(words).decode())
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(found, kind), pa.array(texts, pa.string())], ["id", "n_words", "runs", "collapsed"])

    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, {SCHEMA}")
    return out.withColumnRenamed("id", id_col)
