"""Render positional reports from the driver tables, on Spark.

The driver's tables hold no report text, so test reports are rendered from
``orders ⋈ customer ⋈ nation``: one report per order date, one record per
order. Rendering produces a *line relation* ``(path, pos, line)`` directly:

* record lines come from a narrow ``explode`` of each order row, at position
  ``base + stride * o_orderkey + j`` (ordered by order key, sparse);
* header, page-break and footer lines come from one partial aggregate per date.

Nothing is collected per report, so a date holding a large share of all orders
is not a hot group here. Where reports are written as files, the order rows are put
in order and the lines are made after that (:class:`Reports`). The same rules are
written in SQL by the oracles in :mod:`report_lake.plans.oracles`, which compute the
expected fields straight from the tables.

Rendering rules by order date ``d`` (also the hazards exercised):

* day of month 13: the date text is an impossible day -> ``date_parse``;
* day of month 17: no section anchor (ST1) / no ruler (ST49) -> ``missing_section``;
* day of year % 7 == 3: abbreviated month; day of year % 11 == 5: lower-case month;
* even day of month: CRLF line ends (the ``\\r`` is trimmed);
* priority ``5-LOW``: ST1 terminating zone empty, so the trimmed line ends
  inside the ``field`` slice, which then reads ``''``;
* priority ``1-URGENT``: licensee contains ``|`` and ``"`` (CSV quoting);
* status ``P``: a blank line follows the record (dropped by normalisation).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import ST1, ST49, ReportSpec, Slice

# Position layout of a rendered report (sparse; only the order matters):
# header lines, then record lines by order key, then the footer right after the
# day's last record.
HEADER_BASE = 0
RECORD_BASE = 100
FOOTER_GAP = 16

# ST49 ruler run widths, field 0..10; the activity type follows the last run.
ST49_WIDTHS = (20, 36, 8, 6, 32, 6, 24, 16, 6, 34, 8)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@dataclass
class Reports:
    """Rendered reports before their lines are made.

    ``orders`` has one row an order (with its day ``d``), ``headers`` the header, page
    and footer lines ``(d, pos, line)``, ``values`` adds the field values to order rows and
    ``items`` are the ``(pos, line)`` made of them. A *slot* is a range of 2^slot_bits
    positions: those of one order, and of the header lines that lie between them."""

    orders: DataFrame
    headers: DataFrame
    path: Callable[[Column], Column]
    values: Callable[[DataFrame], DataFrame]
    items: list
    slot_bits: int

    def relation(self) -> DataFrame:
        """All lines as a relation ``(path, pos, line)``, in no order."""
        # hash-spread the order rows so the text rendering (explode, padding) runs on
        # every core, not only on as many tasks as the orders file has splits; the
        # name is made once an order, below the explode, not once a line
        rows = self.values(self.orders.repartition("o_orderkey")).withColumn("path", self.path(F.col("d")))
        records = rows.select("path", _line_rows(F.col("path"), F.col("d"), self.items).alias("x")).select("path", "x.pos", "x.line")
        return records.unionByName(self.headers.select(self.path(F.col("d")).alias("path"), "pos", "line"))

    def by_slot(self) -> DataFrame:
        """Order rows and header lines in one relation with ``d`` and ``slot``. Slots do not
        overlap, so rows dealt out by range of both make lines by range of ``d`` and ``pos``."""
        orders = self.orders.withColumn("slot", F.col("o_orderkey").cast("long")).withColumn("header", F.lit(False))
        headers = self.headers.withColumn("slot", F.shiftright(F.col("pos") - RECORD_BASE, self.slot_bits)).withColumn("header", F.lit(True))
        return orders.unionByName(headers, allowMissingColumns=True)

    def lines(self, rows: DataFrame) -> DataFrame:
        """The line relation of rows as :meth:`by_slot` gives them."""
        line = F.struct(F.col("pos").alias("pos"), F.col("line").alias("line"))
        made = F.when(F.col("header"), F.array(line)).otherwise(_line_array(F.col("d"), self.items))
        made = self.values(rows).select(self.path(F.col("d")).alias("path"), made.alias("lines"))
        return made.select("path", F.explode("lines").alias("x")).select("path", "x.pos", "x.line")


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the customer and nation columns the reports use."""
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .withColumn("d", F.to_date("o_orderdate"))
    )


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys and dates alone: the day lists need no join."""
    return load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))


def _money(c: Column) -> Column:
    return F.col(c).cast("decimal(18,2)").cast("string") if isinstance(c, str) else c.cast("decimal(18,2)").cast("string")


def date_text(d: Column) -> Column:
    """Header date text of the report for day ``d`` (see the module rules)."""
    return (
        F.when(F.dayofmonth(d) == 13, F.concat(F.lit("31 February "), F.year(d).cast("string")))
        .when(F.dayofyear(d) % 7 == 3, F.date_format(d, "dd MMM yyyy"))
        .when(F.dayofyear(d) % 11 == 5, F.lower(F.date_format(d, "dd MMMM yyyy")))
        .otherwise(F.date_format(d, "dd MMMM yyyy"))
    )


def _eol(d: Column, line: Column) -> Column:
    return F.when(F.dayofmonth(d) % 2 == 0, F.concat(line, F.lit("\r"))).otherwise(line)


def st1_values(r: DataFrame) -> DataFrame:
    """Expected ST1 field values per order (before any line-level hazard)."""
    low = F.col("o_orderpriority").startswith("5")
    urgent = F.col("o_orderpriority").startswith("1")
    return r.select(
        "*",
        F.concat_ws(" ", "c_name", "o_orderpriority").alias("well_name"),
        F.lpad(F.col("o_orderkey").cast("string"), 7, "0").alias("licence_number"),
        F.when(F.col("o_orderstatus") == "F", "FREEHOLD").when(F.col("o_orderstatus") == "O", "CROWN")
        .otherwise("BOTH").alias("mineral_rights"),
        F.concat(_money("o_totalprice"), F.lit("M")).alias("ground_elevation"),
        F.concat(F.lit("100/"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"), F.lit("/00")).alias("unique_identifier"),
        F.concat(F.lit("N "), F.col("c_nationkey").cast("string")).alias("surface_coordinates"),
        F.col("c_mktsegment").alias("aer_field_centre"),
        F.concat(_money("c_acctbal"), F.lit("M")).alias("projected_depth"),
        F.when(F.col("o_orderstatus") == "F", "DEV (NC)").when(F.col("o_orderstatus") == "O", "XPL (C)")
        .otherwise("DEV (C)").alias("aer_classification"),
        F.col("n_name").alias("field_value"),
        F.when(low, F.lit("")).otherwise(F.concat(F.col("c_mktsegment"), F.lit(" FM"))).alias("terminating_zone"),
        F.when(F.col("o_orderstatus") == "O", "VERTICAL").otherwise("HORIZONTAL").alias("drilling_operation"),
        F.lit("NEW").alias("well_purpose"),
        F.lit("PRODUCTION").alias("well_type"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "GAS").otherwise("CRUDE OIL").alias("substance"),
        F.when(urgent, F.concat(F.upper("c_name"), F.lit(' "PIPE|LINE" LTD.')))
        .otherwise(F.concat(F.upper("c_name"), F.lit(" LTD."))).alias("licensee"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("-"), F.lpad(F.col("o_custkey").cast("string"), 6, "0"),
                 F.lit("W4")).alias("surface_location"),
    )


def st1_path(d: Column) -> Column:
    return F.concat(F.lit(ST1.prefix), F.date_format(d, "MMddyyyy"), F.lit(".TXT"))


def st49_path(d: Column) -> Column:
    return F.concat(F.lit(ST49.prefix), F.date_format(d, "MMddyyyy"), F.lit(".txt"))


def _line_array(d: Column, items) -> Column:
    """array(struct(pos, line)...) with the report's line end."""
    return F.array(*[F.struct(p.cast("long").alias("pos"), _eol(d, l).alias("line")) for p, l in items])


def _line_rows(path: Column, d: Column, items) -> Column:
    """explode(array(struct(pos, line)...)) with the report's line end."""
    return F.explode(_line_array(d, items))


def st1_reports(spark: SparkSession, sf_dir: str) -> Reports:
    """ST1 reports, one per order date."""
    k = F.col("o_orderkey") * 8 + RECORD_BASE
    rp = F.rpad
    l0 = F.concat(rp("well_name", 37, " "), rp("licence_number", 10, " "), rp("mineral_rights", 21, " "), F.col("ground_elevation"))
    l1 = F.concat(rp("unique_identifier", 37, " "), rp("surface_coordinates", 10, " "), rp("aer_field_centre", 21, " "), F.col("projected_depth"))
    l2 = F.concat(rp("aer_classification", 37, " "), rp("field_value", 31, " "), F.col("terminating_zone"))
    l3 = F.concat(rp("drilling_operation", 37, " "), rp("well_purpose", 10, " "), rp("well_type", 21, " "), F.col("substance"))
    l4 = F.concat(rp("licensee", 68, " "), F.col("surface_location"))
    blank = F.when(F.col("o_orderstatus") == "P", F.lit("   ")).otherwise(F.lit(""))
    items = [(k, l0), (k + 1, l1), (k + 2, l2), (k + 3, l3), (k + 4, l4), (k + 5, blank)]

    days = order_days(spark, sf_dir).groupBy("d").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_orderkey").alias("last_key")
    )
    d = F.col("d")
    footer = F.col("last_key") * 8 + RECORD_BASE + FOOTER_GAP
    ruler = F.lit("-" * 92)
    anchor = F.when(
        F.dayofmonth(d) != 17,
        F.lit("WELL NAME".ljust(37) + "LICENCE NUMBER".ljust(31) + "GROUND ELEVATION"),
    ).otherwise(F.lit("NO LICENCES LISTED"))
    head = [
        (F.lit(HEADER_BASE), F.lit("DAILY WELL LICENCE LIST")),
        (F.lit(HEADER_BASE + 1), F.concat(F.lit("DATE: "), date_text(d))),
        (F.lit(HEADER_BASE + 2), F.lit("")),
        (F.lit(HEADER_BASE + 3), F.lit("WELL LICENCES ISSUED")),
        (F.lit(HEADER_BASE + 4), ruler),
        (F.lit(HEADER_BASE + 5), anchor),
        (F.lit(HEADER_BASE + 6), F.lit("UNIQUE IDENTIFIER".ljust(37) + "SURFACE COORDINATES".ljust(31) + "PROJECTED DEPTH")),
        (F.lit(HEADER_BASE + 7), F.lit("CLASSIFICATION".ljust(37) + "FIELD".ljust(31) + "TERMINATING ZONE")),
        (F.lit(HEADER_BASE + 8), F.lit("DRILLING OPERATION".ljust(37) + "WELL PURPOSE".ljust(31) + "SUBSTANCE")),
        (F.lit(HEADER_BASE + 9), F.lit("LICENSEE".ljust(68) + "SURFACE LOCATION")),
        (F.lit(HEADER_BASE + 10), ruler),
        (footer, ruler),
        (footer + 1, F.lit("END OF WELL LICENCES DAILY LIST")),
    ]
    headers = days.select("d", _line_rows(None, d, head).alias("x")).select("d", "x.pos", "x.line")
    return Reports(order_rows(spark, sf_dir), headers, st1_path, st1_values, items, slot_bits=3)


def render_st1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1 reports as a line relation ``(path, pos, line)``, one report per order date."""
    return st1_reports(spark, sf_dir).relation()


def st49_values(r: DataFrame) -> DataFrame:
    """Expected ST49 field values per order."""
    act = F.timestamp_add("HOUR", F.col("o_orderkey") % 24, F.col("o_orderdate"))
    act = F.when(F.col("o_orderstatus") == "P", F.timestamp_add("DAY", F.lit(-1), act)).otherwise(act)
    pr = F.col("o_orderpriority")
    return r.select(
        "*",
        F.concat(F.lit("00/"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"), F.lit("/0")).alias("well_id"),
        F.concat(F.col("c_name"), F.lit(" HZ "), F.col("o_orderstatus")).alias("well_name"),
        F.lpad(F.col("o_orderkey").cast("string"), 7, "0").alias("licence"),
        F.concat(F.lit("A"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0")).alias("contractor_ba_id"),
        F.concat(F.col("n_name"), F.lit(" DRILLING CORP.")).alias("contractor_name"),
        F.col("c_nationkey").cast("string").alias("rig_number"),
        F.date_format(act, "dd MMM yyyy hh:mm:ss a").alias("activity_date"),
        F.col("c_mktsegment").alias("field_centre"),
        F.concat(F.lit("B"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0")).alias("ba_id"),
        F.concat(F.col("c_name"), F.lit(" Ltd.")).alias("licensee"),
        F.when(pr.startswith("1"), _money("c_acctbal")).otherwise(F.lit("")).alias("new_projected_total_depth"),
        F.when(pr == "1-URGENT", "Drill To LD").when(pr == "2-HIGH", "Set Surface")
        .when(pr == "3-MEDIUM", "Resumption").otherwise("Drill To TD").alias("activity_type"),
    )


def st49_ruler() -> str:
    return "  ".join("-" * w for w in ST49_WIDTHS)


def st49_reports(spark: SparkSession, sf_dir: str) -> Reports:
    """ST49 reports: two pages per report, one record per line."""
    parts = []
    for name, w in zip(ST49.ruler_fields, ST49_WIDTHS):
        parts += [F.rpad(name, w, " "), F.lit("  ")]
    data_line = F.concat(*parts, F.col("activity_type"))
    k = F.col("o_orderkey") * 4 + RECORD_BASE

    days = order_days(spark, sf_dir).groupBy("d").agg(
        F.count(F.lit(1)).alias("n_orders"),
        ((F.min("o_orderkey") + F.max("o_orderkey")) / 2).cast("long").alias("mid"),
        F.max("o_orderkey").alias("last_key"),
    )
    footer = F.col("last_key") * 4 + RECORD_BASE + FOOTER_GAP
    d = F.col("d")
    has_ruler = F.dayofmonth(d) != 17
    ruler = F.when(has_ruler, F.lit(st49_ruler())).otherwise(F.lit(""))
    header = F.lit("WELL ID".ljust(22) + "WELL NAME".ljust(38) + "LICENCE   CONTRACTOR BA ID  NAME  RIG NUMBER  ACTIVITY DATE")
    brk = F.col("mid") * 4 + RECORD_BASE
    head = [
        (F.lit(HEADER_BASE), F.lit("DAILY SPUD REPORT")),
        (F.lit(HEADER_BASE + 1), F.concat(F.lit("REPORT DATE "), date_text(d))),
        (F.lit(HEADER_BASE + 2), header),
        (F.lit(HEADER_BASE + 3), ruler),
        (F.lit(HEADER_BASE + 4), F.lit("FIELD CENTRE  CONTRACTOR BA ID  NAME  RIG NUMBER")),
        (brk + 1, F.concat(F.lit("PAGE 1 OF 2 "), F.col("n_orders").cast("string"))),
        (brk + 2, header),
        (brk + 3, ruler),
        (footer, F.concat(F.lit("TOTAL  - "), F.col("n_orders").cast("string"))),
        (footer + 1, F.lit("END OF REPORT")),
    ]
    headers = days.select("d", _line_rows(None, d, head).alias("x")).select("d", "x.pos", "x.line")
    return Reports(order_rows(spark, sf_dir), headers, st49_path, st49_values, [(k, data_line)], slot_bits=2)


def render_st49(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST49 reports as a line relation ``(path, pos, line)``."""
    return st49_reports(spark, sf_dir).relation()


# An invented third report type, to show that a new report is a new spec: a
# daily event log with two-line records, rendered from ``events``.
EVENTS_COLUMNS = ("date", "event_id", "user_id", "event_type", "value", "ts", "props")
EVENTS_SPEC = ReportSpec(
    name="events",
    prefix="EVENTS",
    extensions=("LOG",),
    columns=EVENTS_COLUMNS,
    layout="chunked",
    date_rule="marker",
    date_marker="LOG DATE",
    date_offset=10,
    anchor_words=("EVENT ID", "USER ID"),
    data_offset=2,
    terminators=("END OF EVENT LOG",),
    row_excludes=("=" * 40,),
    min_row_bytes=12,
    lines_per_record=2,
    slices=(
        Slice("event_id", 0, 0, 12),
        Slice("user_id", 0, 12, 24),
        Slice("event_type", 0, 24, 40),
        Slice("value", 0, 40, None),
        Slice("ts", 1, 0, 30),
        Slice("props", 1, 30, None),
    ),
    section_name="EVENT LOG",
)


def events_path(d: Column) -> Column:
    return F.concat(F.lit(EVENTS_SPEC.prefix), F.date_format(d, "yyyyMMdd"), F.lit(".LOG"))


def render_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily event logs from ``events`` as a line relation (two lines per event)."""
    ev = load(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props", F.to_date("ts").alias("d")
    )
    k = F.col("event_id") * 4 + RECORD_BASE
    l0 = F.concat(
        F.rpad(F.col("event_id").cast("string"), 12, " "), F.rpad(F.col("user_id").cast("string"), 12, " "),
        F.rpad("event_type", 16, " "), _money("value"),
    )
    l1 = F.concat(F.rpad(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), 30, " "), F.col("props"))
    d = F.col("d")
    records = ev.select(events_path(d).alias("path"), _line_rows(None, d, [(k, l0), (k + 1, l1)]).alias("x"))
    days = ev.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_key"))
    footer = F.col("last_key") * 4 + RECORD_BASE + FOOTER_GAP
    head = [
        (F.lit(HEADER_BASE), F.lit("EVENT LOG")),
        (F.lit(HEADER_BASE + 1), F.concat(F.lit("LOG DATE: "), F.date_format(d, "dd MMMM yyyy"))),
        (F.lit(HEADER_BASE + 2), F.lit("EVENT ID    USER ID     TYPE            VALUE")),
        (F.lit(HEADER_BASE + 3), F.lit("TIMESTAMP                     PROPERTIES")),
        (footer, F.lit("=" * 40)),
        (footer + 1, F.lit("END OF EVENT LOG")),
    ]
    headers = days.select(events_path(d).alias("path"), _line_rows(None, d, head).alias("x"))
    return records.unionByName(headers).select("path", "x.pos", "x.line")
