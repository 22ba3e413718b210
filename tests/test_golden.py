"""Golden rows: rendered into report text with the documented layout, parsed
back, they must come out unchanged."""

from conftest import lines_df
from report_lake.operators.parse import parse_reports
from report_lake.spec import ST1, ST49

# The golden ST1 rows (report date 2025-01-02), in column order.
ST1_GOLDEN = [
    ("2025-01-02", "TXNE 4B-30 HZ WAYNE 7-36-26-18", "0516990", "FREEHOLD", "931.70M",
     "100/07-36-026-18W4/00  N  120.0M  E", "155.2M", "MEDICINE HAT", "3950.0M", "DEV (NC)", "WAYNE-ROSEDALE",
     "BASAL QUARTZ SD", "HORIZONTAL", "NEW", "PRODUCTION", "CRUDE OIL", "TORXEN ENERGY LTD.", "04-30-026-17W4"),
    ("2025-01-02", "HWN SIMON 9-32-61-25", "0516991", "ALBERTA CROWN", "1089.20M",
     "100/09-32-061-25W5/00  S  674.6M  W", "481.6M", "GRANDE PRAIRIE", "6200.0M", "XPL (C)", "SIMONETTE",
     "MONTNEY FM", "HORIZONTAL", "NEW", "PRODUCTION", "CRUDE OIL", "HWN ENERGY LTD.", "10-36-061-26W5"),
    ("2025-01-02", "ASTARA ENERGY LEDUC-WB 4-3-50-1", "0516992", "BOTH", "731.90M",
     "100/04-03-050-01W5/00  N  744.7M  E", "85.3M", "DRAYTON VALLEY", "4174.0M", "DEV (C)", "LEDUC-WOODBEND",
     "UPPER MANNVILLE FM", "HORIZONTAL", "NEW", "PRODUCTION", "CRUDE OIL", "ASTARA ENERGY CORP.", "05-27-049-01W5"),
]

# The golden ST49 rows (report date 2025-01-01), in column order.
ST49_GOLDEN = [
    ("2025-01-01", "00/05-15-050-22W5/0", "TOURMALINE HZ LAMBERT 5-15-50-22", "0515496", "A978", "Bear Drilling Corp.",
     "1", "01 Jan 2025 12:30:00 PM", "Drayton Valley", "A573", "Tourmaline Oil Corp.", "", "Drill To LD"),
    ("2025-01-01", "00/04-02-052-11W5/0", "TEL HZ CARROT 4-2-52-11", "0510153", "0Z41", "Ensign Drilling Inc.",
     "449", "01 Jan 2025 04:00:00 AM", "Drayton Valley", "A5L8", "Teine Energy Ltd.", "", "Drill To LD"),
    ("2025-01-01", "00/12-21-059-26W5/0", "TOURMALINE HZ LELAND 12-21-59-26", "0516480", "A08C",
     "Savanna Drilling Corp.", "803", "01 Jan 2025 11:45:00 AM", "Drayton Valley", "A573", "Tourmaline Oil Corp.", "",
     "Resumption"),
    ("2025-01-01", "07/02-28-064-03W4/0", "IMP 24 V13B-PSW ETHELLK 2-28-64-3", "0513871", "0Y52",
     "Precision Drilling Corporation", "204", "01 Jan 2025 08:00:00 AM", "Bonnyville", "0007",
     "Imperial Oil Resources Limited", "", "Drill To LD"),
    ("2025-01-01", "04/04-03-071-08W6/0", "OVV HZ 104 ELM 4-3-71-8", "0508628", "0Y52",
     "Precision Drilling Corporation", "520", "01 Jan 2025 11:50:00 AM", "Grande Prairie", "0026", "Ovintiv Canada ULC",
     "", "Drill To LD"),
    ("2025-01-01", "00/05-33-078-11W6/0", "BIRCHCLIFF HZ PCOUPES 5-33-78-11", "0516740", "0Y52",
     "Precision Drilling Corporation", "226", "01 Jan 2025 11:09:00 AM", "Grande Prairie", "A12R",
     "Birchcliff Energy Ltd.", "", "Set Surface"),
    ("2025-01-01", "02/02-10-083-16W5/0", "HWX 102 HZ SEAL 2-10-83-16", "0516087", "A2CL", "Komat Drilling Ltd.", "4",
     "31 Dec 2024 06:30:00 PM", "St. Albert", "A8DL", "Headwater Exploration Inc.", "", "Set Surface"),
]


def render_st1_report(rows):
    out = ["DAILY WELL LICENCES LIST", "DATE: 02 January 2025", "", "WELL LICENCES ISSUED", "-" * 92,
           "WELL NAME".ljust(37) + "LICENCE NUMBER", "UNIQUE IDENTIFIER", "CLASSIFICATION", "DRILLING OPERATION",
           "LICENSEE", "-" * 92]
    layout = {}
    for s in ST1.slices:
        layout.setdefault(s.line, []).append(s)
    for row in rows:
        values = dict(zip(ST1.columns, row))
        for i in range(ST1.lines_per_record):
            line = ""
            for s in layout[i]:
                v = values[s.name]
                line += v if s.end is None else v.ljust(s.end - s.start)
            out.append(line)
    out += ["-" * 92, "END OF WELL LICENCES DAILY LIST"]
    return "\n".join(out)


WIDTHS = (20, 34, 8, 6, 32, 5, 24, 16, 6, 32, 8)


def render_st49_report(rows):
    ruler = "  ".join("-" * w for w in WIDTHS)
    out = ["AER DAILY SPUD REPORT", "Report for 01 January 2025", "WELL ID  WELL NAME  BA ID  NAME  NUMBER", ruler]
    for row in rows:
        values = dict(zip(ST49.columns, row))
        out.append("".join(values[n].ljust(w) + "  " for n, w in zip(ST49.ruler_fields, WIDTHS)) + values["activity_type"])
    out += ["Report Number: ST-49", "TOTAL  - 7"]
    return "\n".join(out)


def parsed(spark, text, spec):
    p = parse_reports(lines_df(spark, {"golden": text}), spec)
    return [tuple(r[c] for c in spec.columns) for r in p.records.orderBy("record_no").collect()]


def test_st1_golden_round_trip(spark):
    assert parsed(spark, render_st1_report(ST1_GOLDEN), ST1) == ST1_GOLDEN


def test_st49_golden_round_trip(spark):
    assert parsed(spark, render_st49_report(ST49_GOLDEN), ST49) == ST49_GOLDEN
