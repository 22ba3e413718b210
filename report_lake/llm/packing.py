"""Packing by concatenate and cut.

All documents, each followed by an end id, form one stream of token ids that is
cut into fixed windows; only the last window is padded. The stream is never
gathered. Two passes of prefix sums give every document its place in it:

1. each task tokenises its rows once, sums their lengths, and writes ids,
   length and offset within the task's part to the shared folder;
2. the parts' totals (one small row a part) are summed in order to the parts'
   global offsets; each document then knows its global start, and is cut at the
   window boundaries it crosses. Every piece is a boundary record: which
   document ids [start, start + length) lie at which offset of which window.

A window that spans two parts gets pieces from both without any exchange of
ids. The stream's order is that of the input's partitions and rows; with
``runs`` = (file column, row number column) given, a part is a run of one
file's rows and the parts are ordered by file and row, whatever tasks read them.

Null texts count as empty: the end id alone. Empty tables give no pieces.
Equal rows each have their own pieces. Extra columns are ignored, except those
named in ``keep``. Special-token strings in a text are ordinary text.
"""

from __future__ import annotations

import base64
import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, stage, utf8_list

WINDOW = 1024
END_ID = 0


def vocabulary(name: str = "byte_bpe_50k") -> dict[str, str]:
    """Paths of a public byte-level BPE vocabulary in its two file forms."""
    import public_tokenizers as p

    return {"json": p.path(f"{name}.json"), "ranks": p.path(f"{name}.tiktoken"), "pattern": p.PATTERN}


def added_tokens(paths: dict[str, str]) -> list[str]:
    with open(paths["json"], encoding="utf-8") as f:
        return [t["content"] for t in json.load(f).get("added_tokens", [])]


def id_type(paths: dict[str, str]) -> str:
    """The stored form of an id: 16 bits where the vocabulary's ids fit, else 32."""
    with open(paths["json"], encoding="utf-8") as f:
        form = json.load(f)
    vocab = form["model"]["vocab"]
    ids = vocab.values() if isinstance(vocab, dict) else range(len(vocab))
    return "<u2" if max([*ids, *(t["id"] for t in form.get("added_tokens", []))], default=0) < 1 << 16 else "<u4"


class Encoder:
    """Ids of whole texts. The rank form of the vocabulary is encoded several
    times faster than the JSON form and gives the same ids (a test holds them
    against each other); texts its regular expression cannot take (millions of
    white-space characters in a row), and texts that spell one of the vocabulary's
    added tokens (which the JSON form takes as such), go to the JSON form."""

    def __init__(self, paths: dict[str, str]):
        import tiktoken

        with open(paths["ranks"], "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=paths["pattern"], mergeable_ranks=ranks, special_tokens={})
        self.paths, self.slow = paths, None
        self.added = added_tokens(paths)
        self.long_space = re.compile(rb"[\x09-\x0d\x20]{200000}")

    def __call__(self, data: bytes) -> np.ndarray:
        text = data.decode()
        plain = not any(t in text for t in self.added)
        if plain and (len(data) < 200_000 or not self.long_space.search(data)):
            try:
                return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), np.uint32)
            except BaseException as e:  # the library raises its panics outside Exception
                if type(e).__name__ != "PanicException":
                    raise
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.paths["json"])
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def tokenise(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), paths: dict[str, str] | None = None, runs: tuple[str, str] | None = None) -> DataFrame:
    """The staged first pass: file and part (the part's place in the stream), first
    (offset in the part), n, ids (binary, see ``id_type``) and the kept columns."""
    paths = paths or vocabulary()
    kind = id_type(paths)
    bounded_batches(docs.sparkSession)
    place = [F.col(runs[0]).cast("string"), F.col(runs[1]).cast("long")] if runs else [F.lit(""), F.lit(0).cast("long")]
    rows = docs.select(F.col(text).alias("_text"), place[0].alias("_file"), place[1].alias("_row"), *(F.col(k).alias(f"_{i}") for i, k in enumerate(keep)))
    names = ["file", "part", "first", "n", "ids", *(f"_{i}" for i in range(len(keep)))]

    def run(batches):
        encode, now, part, at = Encoder(paths), None, 0, 0
        for batch in batches:
            files, numbers = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            ids = [np.append(encode(t), np.uint32(END_ID)) for t in utf8_list(batch.column(0))]
            parts, first = [], []
            for file, number, x in zip(files, numbers, ids):
                if file != now:
                    now, part, at = file, number if runs else TaskContext.get().partitionId(), 0
                parts.append(part)
                first.append(at)
                at += len(x)
            arrays = [batch.column(1), pa.array(parts, pa.int64()), pa.array(first, pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype(kind).tobytes() for x in ids], pa.binary())]
            yield pa.RecordBatch.from_arrays([*arrays, *(batch.column(3 + i) for i in range(len(keep)))], names=names)

    kept = ", ".join(f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(rows.schema[3:]))
    return stage(rows.mapInArrow(run, f"file string, part bigint, first bigint, n bigint, ids binary, {kept}"), "packed-ids")


def pack(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW, payload: str = "ids",
    paths: dict[str, str] | None = None, runs: tuple[str, str] | None = None, broadcast_parts: int = 200_000,
) -> DataFrame:
    """One row per piece: the kept columns, start, length, doc_tokens,
    sequence_id, offset, and the piece's ``ids`` (payload "ids", array<int>) or
    their ``ids_crc32`` (payload "crc32")."""
    paths = paths or vocabulary()
    stored = id_type(paths)
    staged = tokenise(docs, text, keep, paths, runs)
    # one row a part (task), so this window is over as many rows as there were tasks
    before = W.orderBy("file", "part").rowsBetween(W.unboundedPreceding, -1)
    parts = staged.groupBy("file", "part").agg(F.sum("n").alias("total")).select("file", "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # a few bytes a task, so it is broadcast; beyond a checked size the join shuffles instead
    parts = stage(parts, "packed-parts")
    parts = F.broadcast(parts) if parts.count() <= broadcast_parts else parts
    placed = staged.join(parts, ["file", "part"]).select((F.col("base") + F.col("first")).alias("at"), "n", "ids", *(f"_{i}" for i in range(len(keep))))

    def run(batches):
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            if not len(n):
                continue
            pieces = (at + n - 1) // window - at // window + 1
            row = np.repeat(np.arange(len(n)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = at[row] // window + nth
            begin = np.maximum(at[row], sequence * window)
            end = np.minimum((at + n)[row], (sequence + 1) * window)
            flat = np.frombuffer(b"".join(batch.column(2).to_pylist()), stored).astype("<u4")
            from_ = (np.cumsum(n) - n)[row] + begin - at[row]
            if payload == "crc32":
                raw = memoryview(flat.tobytes())
                out = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(from_, from_ + end - begin)], pa.int64())
            else:
                out = pa.ListArray.from_arrays(pa.array(np.append(from_, len(flat)), pa.int32()), pa.array(flat.astype(np.int32)))
            take = pa.array(row)
            arrays = [batch.column(3 + i).take(take) for i in range(len(keep))]
            arrays += [pa.array(x.astype(np.int64)) for x in (begin - at[row], end - begin, n[row], sequence, begin - sequence * window)]
            yield pa.RecordBatch.from_arrays([*arrays, out], names=[*(f"_{i}" for i in range(len(keep))), "start", "length", "doc_tokens", "sequence_id", "offset", "payload"])

    kept = ", ".join(f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(placed.schema[3:]))
    kind = "bigint" if payload == "crc32" else "array<int>"
    out = placed.mapInArrow(run, f"{kept}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, payload {kind}")
    return out.select(*(F.col(f"_{i}").alias(k) for i, k in enumerate(keep)), "start", "length", F.col("payload").alias("ids_crc32" if payload == "crc32" else "ids"), "doc_tokens", "sequence_id", "offset")
