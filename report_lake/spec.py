"""Declarative report specifications.

A report type is data, not code: where its data section starts and ends, which
lines belong to it, how lines group into records, and where each field sits.
The parse operators interpret a spec into Column expressions, so adding a report
type means adding a spec.

Two layouts exist:

* ``chunked`` - a section found by an anchor line, a fixed number of header
  lines, terminator lines; records are ``lines_per_record`` consecutive lines and
  fields are byte slices of those lines.
* ``ruler`` - data blocks opened by a dashed ruler line; one record per line,
  fields bounded by the runs of the last ruler of the file.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Optional

from pyspark.sql import types as T


@dataclass(frozen=True)
class Slice:
    """Field ``name`` = bytes [start, end) of line ``line`` of the record; end None = rest."""

    name: str
    line: int
    start: int
    end: Optional[int]


@dataclass(frozen=True)
class ReportSpec:
    name: str
    prefix: str  # CSV/table prefix, also the word a load candidate's name contains
    extensions: tuple  # accepted report file extensions; the first is the one the remote side uses
    columns: tuple  # stored column order; the first column is always ``date``
    layout: str  # 'chunked' | 'ruler'
    # date rule
    date_rule: str  # 'marker' (first line containing marker, bytes from offset) | 'tokens'
    date_marker: str = ""
    date_offset: int = 0
    date_line: int = 1
    date_skip: int = 2
    date_take: int = 3
    # chunked layout
    anchor_words: tuple = ()
    data_offset: int = 0
    terminators: tuple = ()
    row_excludes: tuple = ()
    min_row_bytes: int = 0  # a row line must be longer than this many bytes
    lines_per_record: int = 1
    slices: tuple = ()
    section_name: str = ""
    # ruler layout
    ruler_marker: str = ""
    header_words: tuple = ()
    footer_words: tuple = ()
    skip_words: tuple = ()
    ruler_fields: tuple = ()  # field names by boundary index
    rest_field: str = ""  # field taken from the end of boundary ``rest_after`` to end of line
    rest_after: int = 0
    extra: dict = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])

    @property
    def field_names(self) -> tuple:
        return self.columns[1:]


# ST1 (daily well licences) stored columns, in table order.
ST1_COLUMNS = (
    "date", "well_name", "licence_number", "mineral_rights", "ground_elevation",
    "unique_identifier", "surface_coordinates", "aer_field_centre", "projected_depth",
    "aer_classification", "field", "terminating_zone", "drilling_operation", "well_purpose",
    "well_type", "substance", "licensee", "surface_location",
)

# ST49 (daily spud activity) stored columns, in table order.
ST49_COLUMNS = (
    "date", "well_id", "well_name", "licence", "contractor_ba_id", "contractor_name",
    "rig_number", "activity_date", "field_centre", "ba_id", "licensee",
    "new_projected_total_depth", "activity_type",
)

# ST1 layout. Section anchor words, header offset, terminators,
# row exclusions, minimum row length, and the byte slices of the five record lines.
ST1 = ReportSpec(
    name="st1",
    prefix="WELLS",
    extensions=("TXT", "txt"),
    columns=ST1_COLUMNS,
    layout="chunked",
    date_rule="marker",
    date_marker="DATE",
    date_offset=6,
    anchor_words=("WELL NAME", "LICENCE NUMBER"),
    data_offset=6,
    terminators=(
        "WELL LICENCES UPDATED",
        "WELL LICENCES CANCELLED",
        "AMENDMENTS OF WELL LICENCES",
        "END OF WELL LICENCES DAILY LIST",
        "TOTAL",
        "PAGE",
        "WELL NAME AND U.I.D.",
    ),
    row_excludes=(
        "-" * 92,
        "TOTAL",
        "PAGE",
        "WELL NAME AND U.I.D.",
        "END OF WELL LICENCES DAILY LIST",
    ),
    min_row_bytes=20,
    lines_per_record=5,
    slices=(
        Slice("well_name", 0, 0, 37),
        Slice("licence_number", 0, 37, 47),
        Slice("mineral_rights", 0, 47, 68),
        Slice("ground_elevation", 0, 68, None),
        Slice("unique_identifier", 1, 0, 37),
        Slice("surface_coordinates", 1, 37, 47),
        Slice("aer_field_centre", 1, 47, 68),
        Slice("projected_depth", 1, 68, None),
        Slice("aer_classification", 2, 0, 37),
        Slice("field", 2, 37, 68),
        Slice("terminating_zone", 2, 68, None),
        Slice("drilling_operation", 3, 0, 37),
        Slice("well_purpose", 3, 37, 47),
        Slice("well_type", 3, 47, 68),
        Slice("substance", 3, 68, None),
        Slice("licensee", 4, 0, 68),
        Slice("surface_location", 4, 68, None),
    ),
    section_name="WELL LICENCES ISSUED",
)

# ST49 layout. Ruler marker, in-block header words (all present),
# footer words (any present), skipped title, minimum row length, fields by ruler run.
ST49 = ReportSpec(
    name="st49",
    prefix="SPUD",
    extensions=("txt", "TXT"),
    columns=ST49_COLUMNS,
    layout="ruler",
    date_rule="tokens",
    date_line=1,
    date_skip=2,
    date_take=3,
    ruler_marker="------",
    header_words=("BA ID", "NAME", "NUMBER"),
    footer_words=(
        "Report Number:",
        "Run Date:",
        "For the Notification Period",
        "TOTAL  -",
        "WELL ID",
        "PAGE",
    ),
    skip_words=("AER DAILY SPUD REPORT",),
    min_row_bytes=10,
    ruler_fields=(
        "well_id", "well_name", "licence", "contractor_ba_id", "contractor_name",
        "rig_number", "activity_date", "field_centre", "ba_id", "licensee",
        "new_projected_total_depth",
    ),
    rest_field="activity_type",
    rest_after=10,
    section_name="separator line",
)

SPECS = {"st1": ST1, "st49": ST49}


def get_spec(report_type) -> ReportSpec:
    """Report type by name, case-insensitive; a spec passes through."""
    if isinstance(report_type, ReportSpec):
        return report_type
    key = str(report_type).strip().lower()
    if key not in SPECS:
        raise ValueError(f"Invalid report type: {report_type}")
    return SPECS[key]

