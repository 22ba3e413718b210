"""Skew-safe ordered scans over line relations.

Line order inside a file is state the reports depend on (renumbering after
dropping empty lines, "the sixth line after the anchor", "inside a ruler block").
A window partitioned by file would put a whole file into one task, and a file
may hold a large share of all lines. Instead every scan is split in two levels:

1. rows are grouped into blocks (file splits, or position blocks
   ``blk = pos >> BLOCK_BITS``); a partial (map-side combined) aggregate
   summarises each ``(path, blk)``;
2. a window over the *block summaries* (one row per block, tiny) carries state
   from earlier blocks; the summary is joined back on ``(path, blk)`` and a
   window partitioned by ``(path, blk)`` finishes the scan inside each block.

No group is larger than one block, so a hot file is spread over many tasks,
and the join back is on a key that does not skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Positions per block: 2^20, so a block holds at most 1,048,576 lines (the
# largest group any window or aggregate of the parse ever sees).
BLOCK_BITS = 20


def with_block(df: DataFrame, pos: str = "pos", bits: int | None = None) -> DataFrame:
    bits = BLOCK_BITS if bits is None else bits
    return df.withColumn("blk", F.shiftright(F.col(pos), bits))


def prior_blocks(key: str = "path") -> Window:
    """Frame over the blocks strictly before the current one of the same key."""
    return Window.partitionBy(key).orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
