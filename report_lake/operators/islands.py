"""Records of varying length: a header line opens a record, detail lines follow.

The third way to assemble records (beside fixed chunks and ruler rows), for
reports whose records have any number of lines. Lines are numbered as in
:mod:`.parse`: written once, bucketed by ``(path, blk)``, ranked inside their
block. Which record a line belongs to is the number of headers up to it, a
running count inside the block plus the headers of earlier blocks; the header of
a record that goes on across block edges comes from the block table as well. So
nothing is grouped by record: a record with a third of all lines is spread over as
many tasks as it has blocks, and no line is shuffled after the first write.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Optional

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scan import prior_blocks
from ..functions.text import byte_slice
from .parse import KEY, in_block, staged_lines, with_offsets


@dataclass(frozen=True)
class IslandSpec:
    """``opens`` is the word a header line begins with, ``ends`` one a line begins with
    that belongs to no record and closes the one above; fields are ``(name, start,
    end)`` byte slices of the header and of each detail line."""

    opens: str
    header_fields: tuple
    detail_fields: tuple
    ends: Optional[str] = None


def island_rows(lines: DataFrame, opens: Column, ends: Optional[Column] = None, input_bytes: Optional[int] = None) -> DataFrame:
    """Line relation -> ``path, record_no, part_no, header, line``: every line that
    belongs to a record, its header line and its place below it (0: the header
    itself). Lines above the first header, and from an ``ends`` line to the next
    header, belong to none. Empty lines count for nothing."""
    ends = F.lit(False) if ends is None else ends
    k = staged_lines(lines, {"f_open": opens, "f_end": ends & ~opens}, input_bytes).where("keep")
    mark = F.when(F.col("f_open") | F.col("f_end"), F.struct("rk", "f_open", "line"))
    blocks = k.groupBy(*KEY).agg(F.count(F.lit(1)).alias("cnt"), F.count_if("f_open").alias("heads"), F.max(mark).alias("last"))
    blocks = with_offsets(with_offsets(blocks, "cnt", "off"), "heads", "before")
    # the last header or end line above the block, with its number in the file
    last = F.when(F.col("last").isNotNull(), F.struct((F.col("off") + F.col("last.rk")).alias("n"), F.col("last.f_open").alias("open"), F.col("last.line").alias("line")))
    blocks = blocks.withColumn("above", F.last(last, ignorenulls=True).over(prior_blocks())).select(*KEY, "off", "before", "above")
    upto = in_block("rk").rowsBetween(Window.unboundedPreceding, 0)
    rows = k.join(blocks, KEY).withColumn("n", F.col("off") + F.col("rk"))
    here = F.when(F.col("f_open") | F.col("f_end"), F.struct("n", F.col("f_open").alias("open"), "line"))
    rows = rows.withColumn("mark", F.coalesce(F.last(here, ignorenulls=True).over(upto), F.col("above")))
    rows = rows.withColumn("record_no", F.col("before") + F.sum(F.col("f_open").cast("long")).over(upto) - 1)
    return rows.where("mark.open").select("path", "record_no", (F.col("n") - F.col("mark.n")).alias("part_no"), F.col("mark.line").alias("header"), "line")


def parse_islands(lines: DataFrame, spec: IslandSpec, input_bytes: Optional[int] = None) -> DataFrame:
    """``path, record_no, part_no`` with the header's and the detail line's fields, one
    row a detail line; a record without details has one row, part 0, with empty details."""
    line = F.col("line")
    rows = island_rows(lines, line.startswith(spec.opens), line.startswith(spec.ends) if spec.ends else None, input_bytes)
    details = [F.when(F.col("part_no") > 0, byte_slice(line, a, b)).otherwise(F.lit("")).alias(n) for n, a, b in spec.detail_fields]
    out = rows.select("path", "record_no", "part_no", *[byte_slice(F.col("header"), a, b).alias(n) for n, a, b in spec.header_fields], *details)
    # a header stands for itself only where nothing follows it
    alone = out.where("part_no = 0").join(out.where("part_no = 1").select("path", "record_no"), ["path", "record_no"], "left_anti")
    return out.where("part_no > 0").unionByName(alone)
