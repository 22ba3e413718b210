"""Parse positional reports from a line relation.

Input everywhere is a *line relation* ``(path STRING[, blk BIGINT], pos BIGINT,
line STRING[, bad BOOLEAN])``: one row per raw line. ``blk`` orders the blocks of
a file and ``pos`` the lines inside a block; without ``blk``, ``pos`` orders the
whole file and is cut into blocks. ``bad`` marks lines that are not valid text.
Sources produce it (``sources.files``), and so do the renderers in ``plans``.

Output of :func:`parse_reports`:

* ``records`` - ``path, record_no`` + the spec's columns (all strings, ``''``
  for absent fields, ``date`` as ISO text), one row per record, only for files
  whose status is ``ok``;
* ``status`` - one row per file: ``path, report_type, report_date, status,
  error, recoverable, records, short_lines_dropped``.

How: the trimmed lines are written once, bucketed by ``(path, blk)``, each with
its rank among the non-empty lines of its block. A line's number in its file is
then the block's offset plus that rank, and offsets come from block counts, one
small row a block. Anchors, ends and ruler state are small aggregates on these
numbers. Two small staged tables result: *blocks* (where each block's data lies)
and *sections* (how many record lines it has). Records read the lines once more
through them; the status reads the small tables alone. No window or group ever
spans a whole file.

Lines that a scan gives in order (``in_order``) are written as they come: a number
counted along the task stands for the rank, the tables of one row a block are
broadcast, and only the lines of records that are asked for are ever shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Optional

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scan import prior_blocks, with_block
from ..functions.text import (
    byte_slice_or_null,
    contains_all,
    contains_any,
    parse_day_month_year,
    ruler_boundaries,
    trim_ws,
    with_slices,
    with_trimmed,
    words_slice,
)
from ..session import bucket_count, stage, stage_bucketed
from ..spec import ReportSpec, get_spec

# Status codes and error messages of a file that cannot be parsed.
STATUS_OK = "ok"
STATUS_IO = "io_error"
STATUS_DATE = "date_parse"
STATUS_SECTION = "missing_section"
STATUS_RANGE = "out_of_range"
STATUS_FILE_FORMAT = "file_format"
RECOVERABLE_STATUSES = ("field_format", STATUS_FILE_FORMAT)
MSG_NO_DATE_LINE = "No date line found in file"
MSG_NO_DATE_TEXT = "Could not extract date string from line"
MSG_NO_DATE_LINE_TOKENS = "Date line not found"
MSG_BAD_DATE = "Failed to parse date: "
MSG_MISSING_SECTION = "Missing required section: "
MSG_BAD_UTF8 = "stream did not contain valid UTF-8"

KEY = ["path", "blk"]

# In-order lines: at most so many blocks, whose tables (some 300 bytes a block) are broadcast.
BROADCAST_BLOCKS = 100_000


@dataclass
class Parsed:
    records: DataFrame
    status: DataFrame
    section: DataFrame  # the kept data lines: path, record or line index, line
    facts: DataFrame  # one row per file that has at least one line
    chunks: Optional[DataFrame] = None  # chunked layout: path, record_no, date, line0..


def spec_flags(spec: ReportSpec) -> dict:
    """The spec's line predicates, evaluated once when the lines are staged, so
    later scans read a few booleans instead of the line text."""
    line = F.col("line")
    if spec.layout == "chunked":
        # words of both lists come first in both, where Spark looks for them once a line
        both = [w for w in spec.terminators if w in spec.row_excludes]
        terminators, excludes = ([*both, *(w for w in words if w not in both)] for words in (spec.terminators, spec.row_excludes))
        return {
            "f_date": line.contains(spec.date_marker),
            "f_anchor": contains_all(line, spec.anchor_words),
            "f_term": contains_any(line, terminators),
            "f_data": ~contains_any(line, excludes),
            "nbytes": F.octet_length(line),
        }
    if spec.layout != "ruler":
        raise ValueError(f"unknown layout {spec.layout!r}")
    ruler, header = line.contains(spec.ruler_marker), contains_all(line, spec.header_words)
    footer = contains_any(line, spec.footer_words)
    return {
        "f_ruler": ruler,
        "toggle": F.when(ruler, F.lit(True)).when(header, F.lit(None).cast("boolean")).when(footer, F.lit(False)),
        "f_data": ~ruler & ~header & ~footer & ~contains_any(line, spec.skip_words),
        "nbytes": F.octet_length(line),
    }


def in_block(order: str) -> Window:
    return Window.partitionBy(*KEY).orderBy(order)


def _flagged(lines: DataFrame, flags: Optional[dict] = None) -> DataFrame:
    """Trimmed lines with their block, ``keep`` and the flags."""
    bad = F.col("bad") if "bad" in lines.columns else F.lit(False)
    blk = ["blk"] if "blk" in lines.columns else []
    t = with_trimmed(lines.select("path", *blk, F.col("pos").cast("long").alias("pos"), "line", bad.alias("bad")), "line")
    t = (t if blk else with_block(t)).withColumn("keep", F.col("line") != "")
    return t.select("*", *[c.alias(n) for n, c in flags.items()]) if flags else t


def staged_in_order(lines: DataFrame, flags: dict) -> DataFrame:
    """Lines of which each block lies together and in order in one task, written without
    a shuffle: like :func:`staged_lines`, but ``rk`` counts the lines of the whole task,
    so it is a line's rank in its block plus the least ``rk`` there. Empty lines are left
    out, and lines that are no text stay (their file fails, whatever their numbers)."""
    t = _flagged(lines, flags).where("keep or bad").drop("pos")
    return stage(t.withColumn("rk", F.monotonically_increasing_id()), "lines", droppable=True)


def staged_lines(lines: DataFrame, flags: Optional[dict] = None, input_bytes: Optional[int] = None) -> DataFrame:
    """The line relation written once, bucketed by ``(path, blk)``: trimmed lines
    with ``keep`` (non-empty), ``rk`` (rank among the kept lines of the block),
    the flags, and for ruler layouts ``before`` (the last toggle above the line
    in its block).

    Empty lines travel along only so that a file of blank lines has a status row.
    """
    t = _flagged(lines, flags)
    t = t.repartition(bucket_count(lines.sparkSession, input_bytes), *KEY)
    so_far = in_block("pos").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("rk", F.sum(F.col("keep").cast("long")).over(so_far) - 1)
    if flags and "toggle" in flags:
        above = in_block("pos").rowsBetween(Window.unboundedPreceding, -1)
        t = t.withColumn("before", F.last(F.when(F.col("keep"), F.col("toggle")), ignorenulls=True).over(above))
    return stage_bucketed(t, KEY, "lines", input_bytes)


def with_offsets(counts: DataFrame, count: str, out: str) -> DataFrame:
    """Adds to a block table the sum of ``count`` over the file's earlier blocks."""
    return counts.withColumn(out, F.coalesce(F.sum(count).over(prior_blocks()), F.lit(0)).cast("long"))


def report_lines(lines: DataFrame) -> DataFrame:
    """Normalised lines renumbered densely from 0: ``path, line_no, line``."""
    k = staged_lines(lines)
    blocks = with_offsets(k.groupBy(*KEY).agg(F.count_if("keep").alias("cnt")), "cnt", "off")
    return k.where("keep").join(blocks, KEY).select("path", (F.col("off") + F.col("rk")).alias("line_no"), "line")


def _date_from_marker(spec: ReportSpec, date_line):
    """(report_date, error) for the 'first line containing the marker' rule."""
    text = byte_slice_or_null(trim_ws(date_line), spec.date_offset)
    parsed = parse_day_month_year(text)
    error = (
        F.when(date_line.isNull(), F.lit(MSG_NO_DATE_LINE))
        .when(text.isNull(), F.lit(MSG_NO_DATE_TEXT))
        .when(parsed.isNull(), F.concat(F.lit(MSG_BAD_DATE), text))
    )
    return parsed, error


def _date_from_tokens(spec: ReportSpec, date_line):
    text = words_slice(date_line, spec.date_skip, spec.date_take)
    parsed = parse_day_month_year(text)
    error = (
        F.when(date_line.isNull(), F.lit(MSG_NO_DATE_LINE_TOKENS))
        .when(parsed.isNull(), F.concat(F.lit(MSG_BAD_DATE), text))
    )
    return parsed, error


def _one_line(candidates: DataFrame, out: str, first: bool) -> DataFrame:
    """First (or last) line of each file among a few candidate lines (date lines,
    rulers); only these pass the aggregate."""
    pick = F.min_by if first else F.max_by
    return candidates.groupBy("path").agg(pick("line", F.struct("blk", "rk")).alias(out))


def _section_counts(blocks: DataFrame, data: DataFrame, min_bytes: int) -> DataFrame:
    """The staged *sections* table: each block with its record lines counted and
    the number of those in earlier blocks (``before_block``)."""
    long_enough = F.col("nbytes") > min_bytes
    n = data.groupBy(*KEY).agg(F.count_if(long_enough).alias("n_long"), F.count_if(~long_enough).alias("n_short"))
    return stage(with_offsets(blocks.join(n, KEY), "n_long", "before_block"), "sections")


def _chunked(k: DataFrame, spec: ReportSpec, in_order: bool = False, input_bytes: Optional[int] = None, wanted=None):
    small = F.broadcast if in_order else (lambda table: table)  # the caller has counted the blocks
    counts = k.groupBy(*KEY).agg(
        F.count_if("keep").alias("cnt"), F.max("bad").alias("bad"), F.min(F.when(F.col("keep"), F.col("rk"))).alias("rk0"),
        F.min(F.when(F.col("keep") & F.col("f_anchor"), F.col("rk"))).alias("anchor"),
    )
    dates = _one_line(k.where("keep and f_date"), "date_line", first=True)
    blocks = with_offsets(counts, "cnt", "off").withColumn("off", F.col("off") - F.coalesce("rk0", F.lit(0)))
    facts = blocks.groupBy("path").agg(F.max("bad").alias("bad"), F.min(F.col("off") + F.col("anchor")).alias("anchor")).join(dates, "path", "left")
    day, error = _date_from_marker(spec, F.col("date_line"))
    facts = stage(facts.select("path", "bad", day.alias("report_date"), error.alias("date_error"), F.col("anchor").isNotNull().alias("has_section"), (F.col("anchor") + spec.data_offset).alias("first")), "facts")
    good = facts.where("report_date is not null and has_section and not bad").select("path", F.date_format("report_date", "yyyy-MM-dd").alias("date"), "first")
    blocks = stage(blocks.select(*KEY, "off", "rk0").join(good, "path"), "blocks")

    n = F.col("off") + F.col("rk")
    ends = k.where("keep and f_term").join(small(blocks), KEY).where(n >= F.col("first")).groupBy("path").agg(F.min(n).alias("end"))
    blocks = blocks.join(ends, "path", "left")
    here = (n >= F.col("first")) & (F.col("end").isNull() | (n < F.col("end")))
    sections = _section_counts(blocks, k.where("keep and f_data").join(small(blocks), KEY).where(here), spec.min_row_bytes)
    totals = sections.groupBy("path").agg(F.expr(f"sum(n_long) div {spec.lines_per_record}").alias("records"), F.sum("n_short").alias("short_lines_dropped"))
    sections = sections if wanted is None else sections.where(wanted)

    lpr = spec.lines_per_record
    w = Window.partitionBy("rk0").orderBy("rk") if in_order else in_block("rk")
    names = [f"line{i}" for i in range(lpr)]
    following = [F.lead("line", i).over(w).alias(names[i]) for i in range(1, lpr)]

    def numbered(sections):
        data = k.where("keep and f_data").where(F.col("nbytes") > spec.min_row_bytes).join(small(sections), KEY).where(here)
        if in_order:  # a block is known by its first number: what is shuffled are the lines, without their path
            data = data.select("rk0", "rk", "line").repartition(bucket_count(k.sparkSession, input_bytes), "rk0")
            data = data.select("rk0", F.row_number().over(w).alias("i"), "line", *following)
            data = data.join(small(sections.select("rk0", "path", "date", "before_block", "n_long")), "rk0")
            return data.withColumn("r", F.col("before_block") + F.col("i") - 1).select("path", "date", "line", "r", "before_block", "n_long", *names[1:])
        return data.withColumn("r", F.col("before_block") + F.row_number().over(w) - 1).select("path", "date", "line", "r", "before_block", "n_long", *following)

    rows = numbered(sections)
    record = F.expr(f"r div {lpr}")
    head = record * lpr
    inside = (head >= F.col("before_block")) & (head + lpr <= F.col("before_block") + F.col("n_long"))
    whole = rows.where(inside & (F.col("r") == head)).select("path", record.alias("record_no"), "date", F.col("line").alias("line0"), *names[1:])
    # only lines of records that cross a block edge (fewer than lpr at either end) are shuffled,
    # and only blocks that begin or end inside a record are read for them
    split = sections.where(f"before_block % {lpr} != 0 or (before_block + n_long) % {lpr} != 0")
    edge = numbered(split).where(~inside).groupBy("path", record.alias("record_no")).agg(
        F.max("date").alias("date"), *(F.max(F.when(F.col("r") == head + i, F.col("line"))).alias(f"line{i}") for i in range(lpr))
    )
    edge = edge.where(F.col(names[-1]).isNotNull())
    chunks = whole.unionByName(edge)
    records = with_slices(chunks, ["path", "record_no", "date"], [(s.name, f"line{s.line}", s.start, s.end) for s in spec.slices])
    return records, facts, totals, rows.select("path", "r", "line"), chunks


def _ruler(k: DataFrame, spec: ReportSpec, wanted=None):
    toggled = F.when(F.col("keep") & F.col("toggle").isNotNull(), F.col("rk"))
    counts = k.groupBy(*KEY).agg(F.count_if("keep").alias("cnt"), F.max("bad").alias("bad"), F.max_by("toggle", toggled).alias("last_toggle"))
    blocks = with_offsets(counts, "cnt", "off").withColumn("carry", F.last("last_toggle", ignorenulls=True).over(prior_blocks()))
    rulers = _one_line(k.where("keep and f_ruler"), "ruler", first=False)
    early = k.where(F.col("keep") & (F.col("rk") <= spec.date_line)).select(*KEY, "rk", "line")
    dates = early.join(blocks.select(*KEY, "off"), KEY).where(F.col("off") + F.col("rk") == spec.date_line).select("path", F.col("line").alias("date_line"))
    facts = blocks.groupBy("path").agg(F.max("bad").alias("bad")).join(rulers, "path", "left").join(dates, "path", "left")
    day, error = _date_from_tokens(spec, F.col("date_line"))
    has = F.col("ruler").isNotNull()
    facts = stage(facts.select("path", "bad", day.alias("report_date"), error.alias("date_error"), has.alias("has_section"), F.when(has, ruler_boundaries("ruler")).alias("bounds")), "facts")
    good = facts.where("report_date is not null and has_section and not bad").select("path", F.date_format("report_date", "yyyy-MM-dd").alias("date"), "bounds")
    blocks = blocks.select(*KEY, "off", "carry").join(good, "path")

    def data(blocks):
        inside = F.coalesce("before", "carry", F.lit(False))
        return k.where("keep and f_data").where(F.col("nbytes") > spec.min_row_bytes).join(blocks, KEY).where(inside)

    sections = _section_counts(blocks, data(blocks), spec.min_row_bytes)
    totals = sections.groupBy("path").agg(F.sum("n_long").alias("records"), F.lit(0).cast("long").alias("short_lines_dropped"))
    rows = data(sections if wanted is None else sections.where(wanted)).withColumn("record_no", F.col("before_block") + F.row_number().over(in_block("rk")) - 1)
    b = F.col("bounds")
    # a run that the ruler lacks has no bounds, and its field is empty
    fields = [(name, "line", F.get(b, i)["start"], F.get(b, i)["end"]) for i, name in enumerate(spec.ruler_fields)]
    rest = F.coalesce(F.get(b, spec.rest_after)["end"], F.octet_length("line"))
    records = with_slices(rows, ["path", "record_no", "date"], [*fields, (spec.rest_field, "line", rest, None)])
    return records, facts, totals, rows.select("path", "record_no", "line"), None


def parse_reports(lines: DataFrame, report_type, files: Optional[DataFrame] = None, input_bytes: Optional[int] = None,
                  in_order: bool = False, wanted=None) -> Parsed:
    """Parse a line relation with a report spec.

    ``files``: optional ``(path)`` list of all input files, so that files without
    any line still get a status row. Defaults to the paths of ``lines``.
    ``input_bytes`` sizes the staged table. ``in_order``: each block of ``lines`` lies
    together and in order in one task, as a scan of distinct files gives it, there are no
    more than ``BROADCAST_BLOCKS`` of them, and ``files`` is given. ``wanted``: a condition
    on the ``date`` (ISO text) of the files whose records are wanted; the status has all.
    """
    spec = get_spec(report_type)
    if spec.layout == "chunked" and in_order:
        k = staged_in_order(lines, spec_flags(spec))
        records, facts, totals, section, chunks = _chunked(k, spec, True, input_bytes, wanted)
    else:  # the state of a ruler is found by windows over the lines
        k = staged_lines(lines, spec_flags(spec), input_bytes)
        records, facts, totals, section, chunks = (_chunked if spec.layout == "chunked" else _ruler)(k, spec, wanted=wanted)

    st = facts if files is None else files.select("path").join(facts, "path", "left")
    st = st.join(totals, "path", "left")
    bad = F.coalesce(F.col("bad"), F.lit(False))
    no_date, no_section = F.col("report_date").isNull(), ~F.coalesce(F.col("has_section"), F.lit(False))
    status = F.when(bad, STATUS_IO).when(no_date, STATUS_DATE).when(no_section, STATUS_SECTION).otherwise(STATUS_OK)
    # a file without lines has no date line
    no_line = MSG_NO_DATE_LINE if spec.date_rule == "marker" else MSG_NO_DATE_LINE_TOKENS
    error = (
        F.when(bad, F.lit(MSG_BAD_UTF8))
        .when(no_date, F.coalesce("date_error", F.lit(no_line)))
        .when(no_section, F.lit(MSG_MISSING_SECTION + spec.section_name))
    )
    status_df = st.select(
        "path",
        F.lit(spec.name).alias("report_type"),
        F.when(~bad, F.col("report_date")).alias("report_date"),
        status.alias("status"),
        error.alias("error"),
        status.isin(*RECOVERABLE_STATUSES).alias("recoverable"),
        F.coalesce(F.col("records"), F.lit(0)).cast("long").alias("records"),
        F.coalesce(F.col("short_lines_dropped"), F.lit(0)).cast("long").alias("short_lines_dropped"),
    )
    return Parsed(records=records, status=status_df, section=section, facts=facts, chunks=chunks)
