"""Near-duplicates by DartMinHash signatures and banded joining.

A document is the multiset of its ``width``-word shingles (white-space words,
A-Z lower-cased; a shorter text is one shingle). Every occurrence is a weighted
region; darts are thrown into it by hashing: a Poisson process of arrival
times, so equal regions get equal darts in every document. A document keeps, of
the darts that arrive before ``t / total weight``, the earliest for each of
``k`` coordinates; about ``t = k (ln k + 3)`` darts fall whatever the length of
the text. Two signatures agree in a coordinate with probability the weighted
Jaccard similarity of the multisets.

Signatures are cut into ``bands`` bands whose hashes are the join keys. Work
after that is linear in the bucket sizes:

- equal texts are one node, found by a hash of the text (no text is shuffled);
- buckets with the same members are one bucket;
- in every round each bucket has one centre, the least node by a hash that changes
  with the round. In the first round each member is paired with it, later one
  member of each class that is not the centre's, never all with all;
- the exact weighted Jaccard of each new pair decides (``similarity`` or more);
- the classes grow by connected components (alternating star contractions);
- a bucket that holds several classes stays open while a round changes them, and the
  rounds end when few of their pairs are links (``SHARE``);
- what the rounds leave is decided exactly: of the nodes of all buckets of three
  or more that still hold several classes, every pair that can reach
  ``similarity`` is found by prefixes. In an order of all shingles (frequent ones
  last) two such multisets share one among the first few; those are join keys,
  with bounds on lengths and positions, and each pair of different classes that
  meets is compared. Members of a large group of near copies meet there without
  being links; a bound on what two multisets do not share, from the parities of
  their shingles in ``BITMAP`` cells, drops such pairs inside the join and never
  one that reaches ``similarity``. No pair that shares a band is left undecided.

Result: one row per input row with ``class_id``, the least id of its class.
Null texts are in no class but their own; empty texts, and texts without words,
are alike only if equal. Repeated rows share a class. Empty tables give an
empty result. Extra columns are ignored.

Recall: with 27 bands of 8 rows a pair at 0.8 shares a band with probability
0.993, a pair at 0.85 with more than 0.9998.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, bounded_batches, mix64, stage, text_blocks, token_hashes, utf8_list

SIMILARITY, WIDTH, BANDS, ROWS = 0.8, 5, 27, 8
#: So many node names (24 bytes each) are broadcast at most.
BROADCAST_NODES = 1 << 20
#: Rounds go on while so many of the pairs that one compares are links.
SHARE = 0.05
#: Cells (bits) in which the parities of a text's shingles are kept.
BITMAP = 512
PARITIES = [f"b{i}" for i in range(BITMAP // 64)]


def shingles(buf: np.ndarray, starts: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts that begin at ``starts`` in ``buf``, and each one's text."""
    tokens, at = token_hashes(buf)
    first = np.searchsorted(at, starts)
    n = np.diff(np.append(first, len(tokens)))
    run = np.zeros(len(tokens), np.uint64)
    padded = np.concatenate([tokens, np.zeros(width, np.uint64)])
    owner = np.repeat(np.arange(len(starts)), n)
    nth = np.arange(len(tokens)) - first[owner]
    left = n[owner] - nth
    for j in range(width):  # words past the end of the text count as none
        run = mix64(run * U64(0x9E3779B97F4A7C15) + np.where(j < left, padded[j : j + len(tokens)], U64(0)))
    whole = (nth + width <= n[owner]) | (nth == 0)
    return run[whole], owner[whole]


def regions(buf: np.ndarray, starts: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One 64-bit seed for every occurrence of a shingle, grouped by text; the
    text of each; and the texts' totals. Two texts share a seed for each
    occurrence they have in common, so multisets compare as sets of seeds."""
    x, owner = shingles(buf, starts, width)
    total = np.bincount(owner, minlength=len(starts))
    # one sort groups equal shingles of a text; the n-th occurrence is a region of its own
    key = np.sort((owner.astype(np.uint64) << U64(40)) | (x >> U64(24)))
    first = np.append(True, key[1:] != key[:-1]) if len(key) else np.empty(0, bool)
    index = np.arange(len(key))
    occurrence = index - np.maximum.accumulate(np.where(first, index, 0)) if len(key) else index
    seed = mix64((key & U64((1 << 40) - 1)) * U64(0xD6E8FEB86659FD93) + occurrence.astype(np.uint64))
    return seed, (key >> U64(40)).astype(np.int64), total


def signatures(buf: np.ndarray, starts: np.ndarray, k: int, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(texts, k) earliest darts, and each text's number of shingles."""
    seed, owner, total = regions(buf, starts, width)
    until = (k * (math.log(k) + 3) / np.maximum(1, total))[owner]
    best = np.full(len(starts) * k, np.iinfo(np.uint64).max, np.uint64)
    time = np.zeros(len(seed))
    while len(seed):
        seed = mix64(seed + U64(0xA0761D6478BD642F))
        time = time - np.log(((seed >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        alive = time < until
        seed, time, until, owner = seed[alive], time[alive], until[alive], owner[alive]
        dart = mix64(seed ^ U64(0xE7037ED1A0B428DB))
        # arrival time first (bits of a positive float keep its order), then the dart's name
        value = (time.astype(np.float32).view(np.uint32).astype(np.uint64) << U64(32)) | (dart & U64(0xFFFFFFFF))
        np.minimum.at(best, owner * k + ((dart >> U64(32)) % U64(k)).astype(np.int64), value)
    return best.reshape(len(starts), k), total


def similarities(left: list[bytes], right: list[bytes], width: int = WIDTH, limit: int = 4 << 20) -> np.ndarray:
    """Exact weighted Jaccard of each pair's shingle multisets."""
    out, i = np.zeros(len(left)), 0
    while i < len(left):
        j, size, number = i, 0, {}
        while j < len(left) and (j == i or size < limit) and j - i < 1 << 16:
            size += sum(len(t) for t in (left[j], right[j]))
            for t in (left[j], right[j]):
                number.setdefault(t, len(number))
            j += 1
        texts = list(number)
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        seed, _, total = regions(np.frombuffer(b"\n".join(texts), np.uint8), starts, width)
        first = np.cumsum(total) - total
        a, b = (np.array([number[t] for t in side[i:j]]) for side in (left, right))
        both = np.concatenate([a, b])
        n = total[both]
        pair = np.repeat(np.tile(np.arange(j - i), 2), n)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[both], n)
        key = np.sort((pair.astype(np.uint64) << U64(44)) | (seed[at] >> U64(20)))
        shared = np.bincount((key[1:][key[1:] == key[:-1]] >> U64(44)).astype(np.int64), minlength=j - i)
        out[i:j] = shared / np.maximum(1, total[a] + total[b] - shared)
        i = j
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    odd = np.random.default_rng(5).integers(1, 2**62, (bands, rows), dtype=np.uint64) * U64(2) + U64(1)
    s = mix64(signature.reshape(-1, bands, rows))
    return mix64((s * odd).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)).view(np.int64)


def banded(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, width: int) -> DataFrame:
    """node (16-byte hash of the text), id, n (shingles), keys (empty if the text has no word)."""
    rows_in = docs.filter(F.col(text_col).isNotNull()).select(F.unhex(F.md5(F.col(text_col))).alias("node"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            texts = utf8_list(batch.column(2))
            for i, j, buf, starts in text_blocks(texts):
                best, total = signatures(buf, starts, bands * rows, width)
                keys = band_keys(best, bands, rows)
                has = total > 0
                ends = np.concatenate(([0], np.cumsum(has * bands))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[has].ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(total), lists], names=["node", "id", "n", "keys"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows_in.mapInArrow(run, f"node binary, id {kind}, n bigint, keys array<bigint>")


def verified(pairs: DataFrame, texts: DataFrame, least: float, width: int) -> DataFrame:
    """The pairs (a, b) whose exact similarity is at least ``least``."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches):
        for batch in batches:
            keep = similarities(utf8_list(batch.column(2)), utf8_list(batch.column(3)), width) >= least
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.mapInArrow(run, "a binary, b binary")


def common_seeds(texts: DataFrame, width: int, sample: int = 8192, most: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Seeds that several of a sample of ``texts`` hold (sorted), and how many do.

    They only shape the order in which prefixes are taken; any order is right.
    """

    def run(batches):
        for batch in batches:
            for _, _, buf, starts in text_blocks(utf8_list(batch.column(0))):
                yield pa.RecordBatch.from_arrays([pa.array(regions(buf, starts, width)[0].view(np.int64))], names=["seed"])

    n = texts.count()
    drawn = texts.select("node", "text").filter(F.pmod(F.xxhash64("node"), F.lit(max(1, -(-n // sample)))) == 0)
    counts = drawn.select("text").mapInArrow(run, "seed bigint").groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
    rows = sorted((r["seed"], r["n"]) for r in counts.filter("n > 2").orderBy(F.desc("n"), "seed").limit(most).collect())
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)


def parities(seed: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """(texts, words) bits: the parity of each text's seeds in every cell. Where two
    texts differ in a cell, a seed lies there that only one of them has."""
    cell = (seed.view(np.uint64) % U64(BITMAP)).astype(np.int64)
    odd = (np.bincount(owner * BITMAP + cell, minlength=texts * BITMAP) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(texts, BITMAP), axis=1).view(np.int64)


def prefixes(texts: DataFrame, common: tuple[np.ndarray, np.ndarray], least: float, width: int) -> DataFrame:
    """node, label, n, seeds and parities: of every text the first seeds, common ones
    last, of which it shares one with any text at ``least`` or more."""
    names, counts = common

    def run(batches):
        for batch in batches:
            for i, j, buf, starts in text_blocks(utf8_list(batch.column(2))):
                seed, owner, total = regions(buf, starts, width)
                seed = seed.view(np.int64)
                count = np.zeros(len(seed), np.int64)
                if len(names):
                    at = np.minimum(np.searchsorted(names, seed), len(names) - 1)
                    count = np.where(names[at] == seed, counts[at], 0)
                order = np.lexsort((seed, count, owner))
                nth = np.arange(len(seed)) - np.repeat(np.cumsum(total) - total, total)
                size = np.minimum(total, total - np.ceil(least * total - 1e-6).astype(np.int64) + 1)
                ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(seed[order][nth < np.repeat(size, total)]))
                bits = [pa.array(np.ascontiguousarray(b)) for b in parities(seed, owner, j - i).T]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(total), lists, *bits], names=["node", "label", "n", "seeds", *PARITIES])

    return texts.select("node", "label", "text").mapInArrow(run, ", ".join(["node binary, label binary, n bigint, seeds array<bigint>", *(f"{b} bigint" for b in PARITIES)]))


def prefix_pairs(texts: DataFrame, least: float, width: int) -> DataFrame:
    """The pairs (a, b) of ``texts`` (node, label, text) with different labels
    that may reach ``least``: none that does is missing."""
    first = stage(prefixes(texts, common_seeds(texts, width), least, width), "dart-prefixes")
    at = first.select("node", "label", "n", F.posexplode("seeds").alias("nth", "seed"))
    # the class with most members at a seed is never joined with itself
    size = at.groupBy("seed", "label").agg(F.count(F.lit(1)).alias("c"))
    tops = size.groupBy("seed").agg(F.max(F.struct("c", "label")).alias("top"), F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    at = at.join(tops.select("seed", F.col("top.label").alias("top")), "seed").withColumn("top", F.col("label") == F.col("top"))
    at = stage(at.join(first.select("node", *PARITIES), "node"), "dart-shared")
    # the shorter text of a pair needs the shorter prefix, as the longer one has at least as many
    short = at.filter(F.col("nth") < F.col("n") - F.ceil(2 * least / (1 + least) * F.col("n") - 1e-6) + 1).alias("x")
    long = at.alias("y")
    apart = " + ".join(f"bit_count(x.{b} ^ y.{b})" for b in PARITIES)  # so many seeds at least are in one of them only
    where = F.expr(
        f"x.seed = y.seed and x.label <> y.label and (x.n < y.n or x.n = y.n and x.node < y.node) and x.n >= {least!r} * y.n - 1e-6"
        f" and least(x.n - x.nth, y.n - y.nth) >= {least / (1 + least)!r} * (x.n + y.n) - 1e-6"
        f" and {apart} <= {(1 - least) / (1 + least)!r} * (x.n + y.n) + 1e-6"
    )
    pairs = [s.join(l, where).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")) for s, l in ((short.filter("not x.top"), long), (short.filter("x.top"), long.filter("not y.top")))]
    return pairs[0].union(pairs[1]).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, label (the least node of its component) for the nodes of ``edges``
    (a, b), by alternating large-star and small-star contractions."""
    at = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while True:
        # done when all stars: every u has one v, and no v is a u
        many = at.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("u")
        deep = at.select(F.col("v").alias("u")).join(at.select("u"), "u", "left_semi")
        if many.union(deep).isEmpty():
            return at.select(F.col("u").alias("node"), F.col("v").alias("label"))
        both = at.union(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        at = stage(small.distinct(), name)


def joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """The labels after ``links`` between classes: contract them, then relabel."""
    if labels is None:
        return components(links)
    between = links.join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left").join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left")
    moved = components(between.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    old = labels.join(moved.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    new = moved.join(labels.select("node"), "node", "left_anti").select("node", "label")
    return stage(old.union(new).distinct(), "dart-labels")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """``id_col``, ``class_id``, ``class_size``, ``node`` (hash of the text) and
    ``label`` (the class's least node) for every row of ``docs``."""
    bounded_batches(docs.sparkSession)
    signed = stage(banded(docs, id_col, text_col, bands, rows, width), "dart-bands")
    nodes = signed.groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    keyed = nodes.select("node", "id", "n", F.explode("keys").alias("key"))
    sets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"))
    shared = sets.filter("c > 1").groupBy("c", "x", "y").agg(F.min("key").alias("key")).select("key")
    members = stage(keyed.join(shared, "key"), "dart-buckets")
    wanted = stage(members.select("node", F.col("id").alias("_id")).distinct(), "dart-wanted")
    if wanted.count() <= BROADCAST_NODES:  # else the texts are shuffled once
        wanted = F.broadcast(wanted)
    # each wanted node's text once: from the rows that carry its least id
    texts = docs.filter(F.col(text_col).isNotNull()).select(F.unhex(F.md5(F.col(text_col))).alias("node"), F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    texts = texts.join(wanted.withColumnRenamed("node", "_n"), (F.col("node") == F.col("_n")) & texts["_id"].eqNullSafe(wanted["_id"]), "left_semi")
    texts = stage(texts.groupBy("node").agg(F.first("text").alias("text")), "dart-texts")

    labels, turn, seen = None, 0, None
    while True:
        at = members.select("key", "node", "n")
        at = at.withColumn("label", F.col("node")) if labels is None else at.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        draw = F.struct(F.xxhash64(F.lit(1000 * turn), "node").alias("h"), "node", "label", "n")
        state = F.bit_xor(F.xxhash64("node", "label")).alias("state")
        open_ = at.groupBy("key").agg(F.min(draw).alias("c"), F.min("label").alias("x"), F.max("label").alias("y"), state).filter("x <> y").select("key", "c", "state")
        if turn:  # a bucket stays open while its classes change; a class in it is met through one node
            if seen is not None:
                open_ = open_.join(seen.withColumnRenamed("state", "was"), "key").filter("state <> was").drop("was")
            open_ = stage(open_, "dart-centres")
            seen = open_.select("key", "state")
            own = F.struct(F.xxhash64(F.lit(1000 * turn + 1), "node").alias("h"), "node", "n")
            at = at.join(seen.select("key"), "key", "left_semi").groupBy("key", "label").agg(F.min(own).alias("m")).select("key", "label", "m.node", "m.n")
        centre = open_.select("key", "c.*").toDF("key", "h", "a", "la", "na").drop("h")
        # no more can be shared than the smaller multiset holds
        fits = F.least("n", "na") >= least * F.greatest("n", "na") - 1e-6
        pairs = at.alias("m").join(centre.alias("c"), (F.col("m.key") == F.col("c.key")) & (F.col("label") != F.col("la")) & fits)
        pairs = stage(pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct(), "dart-pairs")
        links = stage(verified(pairs, texts, least, width), "dart-links")
        compared, found = pairs.count(), links.count()
        if found:
            labels = joined(labels, links)
        if found < SHARE * compared or not found:
            break
        turn += 1
    # what the rounds leave: buckets of two are decided, of the others every pair of different classes
    at = members.select("key", "node") if labels is None else members.select("key", "node").join(labels, "node", "left")
    at = at.withColumn("label", F.col("node") if labels is None else F.coalesce("label", "node"))
    rest = at.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("label").alias("x"), F.max("label").alias("y")).filter("c > 2 and x <> y").select("key")
    rest = stage(at.join(rest, "key").select("node", "label").distinct().join(texts, "node"), "dart-rest")
    links = stage(verified(prefix_pairs(rest, least, width), texts, least, width), "dart-links")
    if not links.isEmpty():
        labels = joined(labels, links)

    at = signed.select("node", "id")
    at = at.withColumn("label", F.col("node")) if labels is None else at.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    classes = at.groupBy("label").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    out = at.join(classes, "label").select(F.col("id").alias(id_col), "class_id", "class_size", "node", "label")
    alone = docs.filter(F.col(text_col).isNull()).select(id_col, F.col(id_col).alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(None).cast("binary").alias("node"), F.lit(None).cast("binary").alias("label"))
    return out.unionByName(alone)
