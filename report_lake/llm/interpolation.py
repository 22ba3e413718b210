"""Language-model scores by deleted interpolation.

The model mixes n-gram maximum-likelihood estimates (orders 1 to ``order``) and
the uniform distribution over the vocabulary plus one unknown word. The mixture
weights depend on the frequency bucket (power of two) of the context and are
learned by expectation-maximisation: the estimates are taken without a held-out
part of the training texts, the weights fit the held-out part's counts.

Counts cover the whole corpus. N-grams are 64-bit hashes throughout; a *part*
is a bounded run of rows of one input partition:

1. each part sends its distinct n-grams, with its own counts, to the hash range
   they belong to (a frequent n-gram is one entry a part, so no range is hot);
2. each hash range sums its n-grams' counts and answers every part with the
   totals in the order asked. These answers are written to the shared folder;
3. the held-out texts meet their parts' answers; their events, binned by
   context bucket and by the ratios of the estimates, give a table of bounded
   size, on which the EM runs;
4. all texts meet their parts' answers and are scored.

So nothing that grows with the vocabulary is broadcast or collected. Parts are
recomputed in steps 3 and 4 from the same input; that they hold the same rows
is checked, so the input must be a table or a checkpoint, not a plan whose
row order may change.

Null texts count as empty: the end token alone. Repeated ids and rows are
scored each on their own. Without training texts all counts are 0 and both
scores follow their formulas. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, bounded_batches, mix64, stage, text_blocks, token_hashes, utf8_list

START, END = U64(0x51A7B2C3D4E5F607), U64(0xE2D1C0B3A4958677)
NOT_TRAINING, TRAINING, HELD = 0, 1, 2
BUCKETS = 48


def streams(texts: list[bytes]):
    """Per block of texts: (first text, last text, token hashes, owner), each
    text as START, its words, END."""
    for i, j, buf, starts in text_blocks(texts):
        words, at = token_hashes(buf)
        n = np.diff(np.append(np.searchsorted(at, starts), len(words))) + 2
        ends = np.cumsum(n)
        tokens = np.empty(int(ends[-1]), np.uint64)
        inner = np.ones(len(tokens), bool)
        inner[ends - n] = inner[ends - 1] = False
        tokens[inner], tokens[ends - n], tokens[ends - 1] = words, START, END
        yield i, j, tokens, np.repeat(np.arange(j - i), n)


def grams(tokens: np.ndarray, owner: np.ndarray, order: int) -> list[np.ndarray]:
    """Keys of the n-grams that end at each position, by order; near a text's
    start the longer ones are those that begin at START."""
    out = [tokens]
    for _ in range(1, order):
        key = out[-1].copy()
        inside = np.flatnonzero(owner[1:] == owner[:-1]) + 1
        key[inside] = mix64(out[-1][inside - 1] * U64(0x9E3779B97F4A7C15) + tokens[inside])
        out.append(key)
    return out


def ranges(keys: np.ndarray, n: int) -> np.ndarray:
    """The hash range of each key; grows with the key."""
    return (((keys >> U64(32)) * U64(n)) >> U64(32)).astype(np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, int)
    return keys[first], (np.add.reduceat(counts[order], first) if len(first) else counts[:0])


def parted(docs: DataFrame, id_col: str, text_col: str, training, held, part_rows: int) -> DataFrame:
    role = F.when(~F.coalesce(training, F.lit(False)), NOT_TRAINING).when(held, HELD).otherwise(TRAINING)
    number = F.monotonically_increasing_id()
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), role.alias("role"), number.alias("number"))
        .withColumn("part", F.expr(f"((shiftright(number, 33) << 24) + (number % {1 << 33}) div {part_rows}) * 2 + cast(role = {HELD} as int)"))
        .drop("number")
    )


def requests(rows: DataFrame, order: int, n_ranges: int) -> DataFrame:
    """(part, gram, range): the part's distinct keys of one order in one hash
    range, ascending, with its training counts and its row count."""

    def emit(part: int, got: list, n_rows: int):
        for gram in range(order):
            keys = np.concatenate([k for k, _ in got[gram]])
            keys, counts = _summed(keys, np.concatenate([c for _, c in got[gram]]))
            got[gram] = None
            cut = np.searchsorted(ranges(keys, n_ranges), np.arange(n_ranges + 1))
            some = np.flatnonzero(np.diff(cut))
            offsets = pa.array(np.append(cut[some], cut[-1]), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64)))
            counted = pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32)))
            n = len(some)
            whole = pa.RecordBatch.from_arrays([pa.array(np.full(n, part)), pa.array(np.full(n, gram, np.int32)), pa.array(some.astype(np.int32)), lists, counted, pa.array(np.full(n, n_rows))], names=["part", "gram", "range", "keys", "counts", "n_rows"])
            for i in range(0, n, 64):  # small batches: little memory on the other side
                yield whole.slice(i, 64)

    def run(batches):
        state: dict[tuple[int, bool], list] = {}

        def flush():
            for part in {p for p, _ in state}:
                both = [state.pop((part, t), None) for t in (True, False)]
                n_rows = sum(s[0] for s in both if s)
                got = [[x for s, t in zip(both, (1, 0)) if s for x in ((k, c * t) for k, c in s[1][g])] for g in range(order)]
                yield from emit(part, got, n_rows)

        last = None
        for batch in batches:
            texts = utf8_list(batch.column(1))
            role = batch.column(2).to_numpy(zero_copy_only=False)
            part = batch.column(3).to_numpy(zero_copy_only=False)
            for p in np.unique(part):
                if last is not None and p >> 1 != last >> 1:
                    yield from flush()
                last = int(p)
                for t in (True, False):
                    rows_ = np.flatnonzero((part == p) & ((role != NOT_TRAINING) == t))
                    if not len(rows_):
                        continue
                    s = state.setdefault((int(p), t), [0, [[] for _ in range(order)]])
                    s[0] += len(rows_)
                    for _, _, tokens, owner in streams([texts[i] for i in rows_]):
                        for g, keys in enumerate(grams(tokens, owner, order)):
                            s[1][g].append(_summed(keys, np.ones(len(keys), np.int64)))
        yield from flush()

    return rows.mapInArrow(run, "part bigint, gram int, range int, keys array<bigint>, counts array<int>, n_rows bigint")


def answers(asked: DataFrame) -> DataFrame:
    """Each request's totals: ``whole`` (all training texts) and ``held``; and a
    row with part -1 for each range: tokens, held-out tokens, distinct tokens."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        part = table.column("part").to_numpy()
        gram = table.column("gram").to_numpy()
        at = int(table.column("range")[0].as_py())
        for g in np.unique(gram):
            t = table.filter(pa.array(gram == g)).combine_chunks()
            lists, counts = t.column("keys").chunk(0), t.column("counts").chunk(0)
            keys = lists.flatten().to_numpy().view(np.uint64)
            n = counts.flatten().to_numpy()
            own = part[gram == g]
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            from_held = np.repeat(own % 2 == 1, size)
            unique, inverse = np.unique(keys, return_inverse=True)
            whole = np.bincount(inverse, n, len(unique)).astype(np.int64)
            held = np.bincount(inverse, n * from_held, len(unique)).astype(np.int64)
            offsets = pa.array(np.append(0, np.cumsum(size)), pa.int32())
            out.append(pa.table([pa.array(own), t.column("gram"), t.column("range"), pa.ListArray.from_arrays(offsets, pa.array(whole[inverse])), pa.ListArray.from_arrays(offsets, pa.array(held[inverse])), t.column("n_rows")], names=["part", "gram", "range", "whole", "held", "n_rows"]))
            if g == 0:
                real = unique != START
                stats = [int(whole[real].sum()), int(held[real].sum()), int((whole[real] > 0).sum())]
                out.append(pa.table([pa.array([-1]), pa.array([0], pa.int32()), pa.array([at], pa.int32()), pa.array([stats], pa.list_(pa.int64())), pa.array([[]], pa.list_(pa.int64())), pa.array([0])], names=["part", "gram", "range", "whole", "held", "n_rows"]))
        return pa.concat_tables(out)

    return asked.groupBy("range").applyInArrow(run, "part bigint, gram int, range int, whole array<bigint>, held array<bigint>, n_rows bigint")


def _events(docs: pa.Table, answer: pa.Table, order: int, held: bool):
    """Blocks of one part with, for every position, the count of each order's
    n-gram; the answers are in ascending order of the part's keys."""
    texts = utf8_list(docs.column("text").combine_chunks())
    told = answer.column("n_rows")[0].as_py() if answer.num_rows else None
    if told != len(texts):
        raise RuntimeError(f"a part had {told} rows when its n-grams were counted and has {len(texts)} now: the input changes between reads; checkpoint it first")
    answer = answer.sort_by([("gram", "ascending"), ("range", "ascending")])
    gram = answer.column("gram").to_numpy()
    blocks = list(streams(texts))
    keyed = [grams(tokens, owner, order) for _, _, tokens, owner in blocks]
    counts = []
    for g in range(order):
        unique, inverse = np.unique(np.concatenate([k[g] for k in keyed]), return_inverse=True)
        mine = answer.filter(pa.array(gram == g))
        flat = lambda name: mine.column(name).combine_chunks().flatten().to_numpy()
        whole = flat("whole")
        if len(whole) != len(unique):
            raise RuntimeError("a part's n-grams differ from those counted: checkpoint the input first")
        counts.append((whole - flat("held") if held else whole)[inverse].astype(np.float64))
    at = 0
    for (i, j, tokens, owner) in blocks:
        yield i, j, tokens, owner, [c[at : at + len(tokens)] for c in counts]
        at += len(tokens)


def estimates(counts: list[np.ndarray], real: np.ndarray, total: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Context bucket and maximum-likelihood estimates (orders 1..) at the real positions."""
    f = [counts[0][real] / max(total, 1.0)]
    context = np.zeros(len(f[0]))
    for g in range(1, len(counts)):
        context = counts[g - 1][real - 1]
        f.append(np.divide(counts[g][real], context, out=np.zeros(len(real)), where=context > 0))
    bucket = np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0).astype(np.int64)
    return np.minimum(bucket, BUCKETS - 1), f


def expectation_maximisation(table: pd.DataFrame, order: int, rounds: int = 60) -> np.ndarray:
    """(BUCKETS, order + 1) weights of the uniform and the order 1.. estimates.

    ``table``: bucket, n, and per order the mean ratio r of its estimate to the
    uniform one. A pseudo-count keeps every weight above zero; contexts never
    seen give the highest order no weight.
    """
    weights = np.full((BUCKETS, order + 1), np.nan)
    ratio = np.column_stack([np.ones(len(table)), *(table[f"r{g}"] for g in range(order))])
    for b in np.unique(table["bucket"]):
        here = (table["bucket"] == b).to_numpy()
        x, n = ratio[here], table["n"].to_numpy(float)[here]
        allowed = np.ones(order + 1)
        if b == 0 and order > 1:
            allowed[-1] = 0
        w = allowed / allowed.sum()
        for _ in range(rounds):
            share = x * w
            share /= share.sum(axis=1, keepdims=True)
            w = (share * n[:, None]).sum(axis=0) + allowed
            w /= w.sum()
        weights[b] = w
    known = np.flatnonzero(~np.isnan(weights[:, 0]))
    if not len(known):
        weights[:] = 1 / (order + 1)
    for b in range(BUCKETS if len(known) else 0):  # buckets without events: the nearest one's weights
        weights[b] = weights[known[np.abs(known - b).argmin()]]
    if order > 1:
        weights[0, :-1] += weights[0, -1] / order
        weights[0, -1] = 0
    return weights


def score(
    docs: DataFrame, training, held=None, id_col: str = "doc_id", text_col: str = "text", order: int = 2, part_rows: int = 1 << 11, n_ranges: int | None = None,
) -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``training`` and ``held`` are conditions on ``docs``: the texts to learn
    from, and those of them that are held out for the weights (default: a tenth
    by a hash of the id).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    if held is None:
        held = F.pmod(F.xxhash64(F.lit(3), id_col), F.lit(10)) == 0
    rows = parted(docs, id_col, text_col, training, F.coalesce(held, F.lit(False)), part_rows)
    # a few ranges a shuffle partition: a range is one group in one task's memory
    n_ranges = n_ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    told = stage(answers(requests(rows, order, n_ranges)), "ngram-answers")
    got = told.filter("part = -1").agg(*(F.coalesce(F.sum(F.col("whole")[i]), F.lit(0)) for i in range(3))).first()
    total, total_held, distinct = map(int, got)
    uniform = 1.0 / (distinct + 1)

    def binned(docs_: pa.Table, answer: pa.Table) -> pa.Table:
        frames = []
        for _, _, tokens, owner, counts in _events(docs_, answer, order, True):
            real = np.flatnonzero(tokens != START)
            bucket, f = estimates(counts, real, total - total_held)
            frame = {"bucket": bucket}
            for g, x in enumerate(f):
                frame[f"r{g}"] = x / uniform
                frame[f"b{g}"] = np.where(x > 0, np.floor(4 * np.log2(np.maximum(x / uniform, 1e-12))), -1000).astype(np.int64)
            by = ["bucket", *(f"b{g}" for g in range(order))]
            frames.append(pd.DataFrame(frame).groupby(by, as_index=False).agg(n=("bucket", "size"), **{f"r{g}": (f"r{g}", "sum") for g in range(order)}))
        out = pd.concat(frames)[["bucket", *(f"b{g}" for g in range(order)), "n", *(f"r{g}" for g in range(order))]]
        return pa.Table.from_pandas(out, preserve_index=False)

    tags = ", ".join(f"b{g} bigint" for g in range(order))
    sums = ", ".join(f"r{g} double" for g in range(order))
    events = rows.filter(F.col("role") == HELD).groupBy("part").cogroup(told.filter("part >= 0 and part % 2 = 1").groupBy("part")).applyInArrow(binned, f"bucket bigint, {tags}, n bigint, {sums}")
    # at most buckets x bins rows, however large the corpus
    table = events.groupBy("bucket", *(f"b{g}" for g in range(order))).agg(F.sum("n").alias("n"), *(F.sum(f"r{g}").alias(f"r{g}") for g in range(order)))
    table = pd.DataFrame([r.asDict() for r in table.collect()], columns=["bucket", "n", *(f"r{g}" for g in range(order))])
    for g in range(order):
        table[f"r{g}"] = table[f"r{g}"] / table["n"]
    weights = expectation_maximisation(table, order)
    if not total:  # nothing learned: the uniform distribution alone
        weights[:] = np.eye(order + 1)[0]

    def scored(docs_: pa.Table, answer: pa.Table) -> pa.Table:
        out = []
        ids = docs_.column("id").combine_chunks()
        floor = np.log10(total + 0.5 * (distinct + 1))
        for i, j, tokens, owner, counts in _events(docs_, answer, order, False):
            real = np.flatnonzero(tokens != START)
            bucket, f = estimates(counts, real, total)
            w = weights[bucket]
            p = w[:, 0] * uniform + sum(w[:, g + 1] * x for g, x in enumerate(f))
            own, c = owner[real], counts[0][real]
            per = lambda x: np.bincount(own, x, j - i)
            n = np.bincount(own, minlength=j - i)
            out.append(pa.table([ids.slice(i, j - i), pa.array(n), pa.array(per(c > 0).astype(np.int64)), pa.array(per(np.log10(c + 0.5) - floor)), pa.array(per(np.log10(p)))], names=["id", "n_tokens", "n_known", "base_score", "score"]))
        return pa.concat_tables(out)

    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.groupBy("part").cogroup(told.filter("part >= 0").groupBy("part")).applyInArrow(scored, f"id {kind}, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
