"""Column expressions for positional report text.

All but one are built-in Spark expressions (JVM side, whole-stage codegen);
:func:`ruler_boundaries` works on Arrow batches. No Python runs per row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters removed by a Unicode-aware trim (the White_Space
# property): U+0009-000D, U+0020, U+0085, U+00A0, U+1680, U+2000-200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
UNICODE_WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def trim_ws(c) -> Column:
    """Trim Unicode whitespace from both ends (plain ``trim`` only strips U+0020).

    The padding of positional fields goes by plain ``trim`` first: it compares bytes,
    where a trim by a set looks up every character it takes off."""
    return F.btrim(F.trim(as_col(c)), F.lit(UNICODE_WHITESPACE))


def with_trimmed(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the text column ``name`` trimmed as by :func:`trim_ws`.

    A trim by a set of characters first lists every character of the line. Lines that
    begin and end with printable ASCII once a carriage return and plain padding are off
    have nothing left to trim, and only the others go through it. A carriage return that
    follows the first byte of a broken character stays, as it does there."""
    text = F.col(name)
    head = F.substr(text.cast("binary"), F.lit(1), F.octet_length(text) - 1).cast("string")
    df = df.withColumn(name, F.trim(F.when(text.endswith("\r") & F.is_valid_utf8(text), head).otherwise(text)))
    first, last = (F.substr(text.cast("binary"), at, F.lit(1)).cast("string") for at in (F.lit(1), F.octet_length(text)))
    bare = first.between("!", "~") & last.between("!", "~")
    return df.withColumn(name, F.when(bare, text).otherwise(F.btrim(text, F.lit(UNICODE_WHITESPACE))))


def contains_any(c, words) -> Column:
    c = as_col(c)
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def contains_all(c, words) -> Column:
    c = as_col(c)
    out = F.lit(True)
    for w in words:
        out = out & c.contains(w)
    return out


def byte_slice_or_null(line, start, end=None) -> Column:
    """The byte range [start, end) of ``line`` as text; ``end=None`` = to end of line.

    NULL when the range runs past the line or cuts a UTF-8 character, which is when
    a byte-indexed ``str.get(a..b)`` gives nothing. The text is named once, so that
    the code generated for many fields stays small enough to be compiled.
    """
    line = as_col(line)
    start = as_lit(start)
    nbytes = F.octet_length(line)
    raw = line.cast("binary")  # the bytes as they are; encode() would decode the line first
    if end is None:
        sub = F.substr(raw, start + 1, F.greatest(nbytes - start, F.lit(0)))
        fits = nbytes >= start
    else:
        end = as_lit(end)
        sub = F.substr(raw, start + 1, end - start)
        fits = (nbytes >= end) & (end >= start)
    return F.when(fits, F.try_validate_utf8(sub.cast("string")))


def byte_slice(line, start, end=None, trim: bool = True) -> Column:
    """Bytes [start, end) of ``line`` as text, trimmed; ``''`` when the range is
    past the end of the line or cuts a character (never a truncated value)."""
    text = byte_slice_or_null(line, start, end)
    return F.coalesce(trim_ws(text) if trim else text, F.lit(""))


def with_slices(df: DataFrame, keep, slices) -> DataFrame:
    """The columns ``keep`` and one :func:`byte_slice` for each ``(name, line column,
    start, end)`` of ``slices``.

    Plain padding is trimmed from every field; the trim by the set of Unicode white
    space only follows in rows that hold more than printable ASCII, found once a row.
    That test is a lambda, so Spark generates a function a field for the projection
    with the slices instead of one method for all: the JVM does not compile methods of
    8,000 bytes or more, and interprets them several times slower.
    """
    lines = F.array(*dict.fromkeys(line for _, line, _, _ in slices))
    cut = df.select(
        *keep,
        (~F.exists(lines, lambda line: line.rlike("[^ -~]"))).alias("_plain"),
        *[F.trim(byte_slice_or_null(line, start, end)).alias(name) for name, line, start, end in slices],
    )
    kept, rest = cut.columns[: len(keep)], F.lit(UNICODE_WHITESPACE)
    trimmed = [F.when(F.col("_plain"), F.col(name)).otherwise(F.btrim(name, rest)) for name, *_ in slices]
    return cut.select(*kept, *[F.coalesce(t, F.lit("")).alias(name) for t, (name, *_) in zip(trimmed, slices)])


def parse_day_month_year(text) -> Column:
    """``'02 January 2024'`` / ``'2 jan 2024'`` -> DATE, NULL when not a date.

    Whitespace runs are collapsed first; full and abbreviated month names are
    accepted in any case; trailing text, two-digit years and impossible days
    give NULL (``try_to_date`` never raises under ANSI mode).
    """
    s = F.regexp_replace(trim_ws(text), r"\s+", " ")
    return F.coalesce(F.try_to_date(s, "d MMMM yyyy"), F.try_to_date(s, "d MMM yyyy"))


#: The same characters as one regular-expression class (``\\s`` alone is ASCII only).
WHITESPACE_CLASS = "[" + "".join(f"\\x{{{ord(c):04x}}}" for c in UNICODE_WHITESPACE) + "]"


def words_slice(text, skip: int, take: int) -> Column:
    """Tokens ``skip .. skip+take`` between runs of Unicode whitespace, joined by one space."""
    toks = F.split(trim_ws(text), WHITESPACE_CLASS + "+")
    return F.array_join(F.slice(toks, skip + 1, take), " ")


def _whitespace_bytes(b: np.ndarray) -> np.ndarray:
    """Marks the bytes of ``b`` (UTF-8) that belong to a Unicode whitespace character."""
    out = np.zeros(len(b) + 2, bool)
    padded = np.concatenate([b, np.zeros(2, np.uint8)])
    for char in UNICODE_WHITESPACE:
        code = char.encode()
        at = np.flatnonzero(padded[: len(b)] == code[0])
        for j in range(1, len(code)):
            at = at[padded[at + j] == code[j]]
        for j in range(len(code)):
            out[at + j] = True
    return out[: len(b)]


def _boundaries(rulers: pa.Array) -> pa.Array:
    lines = rulers.cast(pa.large_binary())
    n, bufs = len(lines), lines.buffers()
    at = np.frombuffer(bufs[1], np.int64)[lines.offset : lines.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[at[0] : at[-1]] if bufs[2] else np.empty(0, np.uint8)
    at = at - at[0]
    space, size = _whitespace_bytes(data), np.diff(at)
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before, after = np.concatenate([[True], space[:-1]]), np.concatenate([space[1:], [True]])
    begin = np.flatnonzero(~space & (edge[:-1] | before[: len(space)]))
    end = np.flatnonzero(~space & (edge[1:] | after[: len(space)])) + 1
    line = np.searchsorted(at, begin, side="right") - 1
    null = np.asarray(lines.is_null())
    blank = ~null  # the run that ends the line is empty
    some = size > 0
    blank[some] &= space[at[1:][some] - 1]
    ends = np.concatenate([[0], np.cumsum(np.bincount(line, minlength=n) + blank)])
    values = np.empty((2, ends[-1]), np.int32)
    run = np.ones(ends[-1], bool)
    run[ends[1:][blank] - 1] = False
    values[:, run] = begin - at[line], end - at[line]
    values[:, ~run] = size[blank]
    bounds = pa.StructArray.from_arrays([pa.array(values[0]), pa.array(values[1])], names=["start", "end"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), bounds, mask=pa.array(null))


def ruler_boundaries(ruler) -> Column:
    """``'--  -'`` -> ``[{start:0,end:2},{start:4,end:5}]``: byte ranges of the
    runs of non-whitespace (any Unicode whitespace separates).

    The run that ends the line is always given, also when it is empty. A batch of
    lines is cut in one pass over its bytes, so a line of many runs costs no more
    than as many lines of one.
    """
    return F.arrow_udf(_boundaries, "array<struct<start:int,end:int>>")(as_col(ruler))


def plain_path(uri) -> Column:
    """A file path as listings give it, from the escaped form of ``_metadata.file_path``.

    Every row of a file carries its path; only those with an escape are decoded."""
    uri = as_col(uri)
    return F.when(uri.contains("%"), F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))).otherwise(uri)


def file_name(path) -> Column:
    return F.regexp_extract(as_col(path), r"([^/]*)$", 1)


def file_stem(path) -> Column:
    name = file_name(path)
    return F.when(name.contains("."), F.regexp_extract(name, r"^(.*)\.[^.]*$", 1)).otherwise(name)


def file_extension(path) -> Column:
    """Extension without the dot, NULL when there is none."""
    name = file_name(path)
    ext = F.regexp_extract(name, r"\.([^.]*)$", 1)
    return F.when(name.rlike(r"^.+\.[^.]*$"), ext)
