import random

import pytest

import model
from conftest import lines_df
from report_lake.functions import scan
from report_lake.operators.parse import parse_reports, report_lines
from report_lake.spec import ST1, ST49

ST1_HEAD = [
    "DAILY WELL LICENCE LIST",
    "DATE: 02 January 2025",
    "",
    "WELL LICENCES ISSUED",
    "-" * 92,
    "WELL NAME".ljust(37) + "LICENCE NUMBER".ljust(31) + "GROUND ELEVATION",
    "UNIQUE IDENTIFIER",
    "CLASSIFICATION",
    "DRILLING OPERATION",
    "LICENSEE".ljust(68) + "SURFACE LOCATION",
    "-" * 92,
]


def rec(i, name="WELL"):
    return [
        f"{name} {i}".ljust(37) + f"{i:07d}".ljust(10) + "COMMONS".ljust(21) + "12.34M",
        f"777/11-22-033-44X5/0{i}".ljust(37) + "N 5 E 9".ljust(10) + "SAMPLETON".ljust(21) + "88.5M",
        "TEST (X)".ljust(37) + "NORTH FIELD".ljust(31) + "UPPER ZONE",
        "SLANTED".ljust(37) + "NEW".ljust(10) + "PRODUCTION".ljust(21) + "WATER",
        "EXAMPLE WELLS INC.".ljust(68) + "01-02-003-04X5",
    ]


def st1_text(body, tail=("-" * 92, "END OF WELL LICENCES DAILY LIST")):
    return "\n".join(ST1_HEAD + body + list(tail))


def run(spark, reports, spec):
    p = parse_reports(lines_df(spark, reports), spec)
    recs = {}
    for r in p.records.collect():
        recs.setdefault(r["path"], []).append((r["record_no"], tuple(r[c] for c in spec.field_names)))
    status = {r["path"]: r for r in p.status.collect()}
    return {k: [t for _, t in sorted(v)] for k, v in recs.items()}, status


def check_against_model(spark, reports, spec):
    recs, status = run(spark, reports, spec)
    fn = model.st1 if spec is ST1 else model.st49
    for path, text in reports.items():
        m_status, m_date, m_recs = fn(text)
        assert status[path]["status"] == m_status, (path, status[path], text)
        if m_status != "date_parse":
            assert status[path]["report_date"] == m_date
        assert recs.get(path, []) == m_recs, (path, text)


def test_st1_two_records_and_hazards(spark):
    short_last = rec(3)
    short_last[0] = "SHORT 3".ljust(37) + "0000003"  # ends inside the mineral-rights slice
    reports = {
        "a": st1_text(rec(1) + rec(2)),
        "short": st1_text(short_last),
        # H7: a line of <= 20 bytes is dropped and shifts later records
        "dropped": st1_text(rec(4)[:2] + ["TINY LINE"] + rec(4)[2:] + rec(5)),
        # H5: a company name containing TOTAL ends the block
        "total": st1_text(rec(6) + rec(7, name="TOTAL OIL")),
        # H4: 'DATE' inside 'UPDATED' comes first
        "updated": "WELL LICENCES UPDATED\n" + st1_text(rec(8)),
        "crlf": st1_text(rec(9)).replace("\n", "\r\n"),
        "blank_first": st1_text([" " * 37 + "0000010"] + rec(10)[1:]),
        "empty": "",
        "no_date": "some other text\nand nothing more",
        "bad_date": "ALBERTA\nDATE: 31 February 2024\n",
        "no_section": "a list\nDATE: 02 January 2024\n\nwithout any rows",
        "multibyte": st1_text([rec(11)[0].replace("WELL 11", "WÉLL 11")] + rec(11)[1:]),
    }
    check_against_model(spark, reports, ST1)
    recs, status = run(spark, reports, ST1)
    assert recs["a"][0][:4] == ("WELL 1", "0000001", "COMMONS", "12.34M")
    assert recs["short"][0][2:4] == ("", "")
    assert status["empty"]["status"] == "date_parse" and status["empty"]["error"] == "No date line found in file"
    assert status["no_section"]["error"] == "Missing required section: WELL LICENCES ISSUED"
    assert status["updated"]["status"] == "date_parse"
    assert recs["total"] == [recs["total"][0]]
    assert status["dropped"]["short_lines_dropped"] == 1


def st49_text(rows, ruler="------  ----------  -------", date="REPORT DATE 01 January 2025", extra=()):
    return "\n".join(["DAILY SPUD REPORT", date, "WELL ID  WELL NAME  BA ID  NAME  NUMBER", ruler, *rows, *extra,
                      "TOTAL  - 2"])


def test_st49_rulers(spark):
    row = "W00001  NAME A      0123456  DRILLER  7  01 Jan 2025 12:30:00 PM"
    wide = "  ".join("-" * 6 for _ in range(11))
    reports = {
        "solid": st49_text([row], ruler="-" * 40),  # H19: one boundary, other fields ''
        "narrow": st49_text([row]),
        "two_rulers": st49_text([row], extra=["PAGE 2", wide, row + "  tail"]),  # last ruler applies to all rows
        "header_kept": st49_text(["FIELD CENTRE BA ID LICENSEE ONLY", row]),  # H18: lacks NUMBER -> data
        "ten": st49_text(["0123456789", "0123456789A"]),  # length > 10 only
        "no_ruler": "DAILY\nREPORT DATE 01 January 2025\nrow one is long enough",
        "bad_date": st49_text([row], date="REPORT DATE not a day"),
        "one_line": "a title alone",
    }
    check_against_model(spark, reports, ST49)
    recs, status = run(spark, reports, ST49)
    assert recs["solid"][0][0] == row[:40].strip()
    assert all(v == "" for v in recs["solid"][0][1:11])
    assert len(recs["two_rulers"]) == 2
    assert status["no_ruler"]["status"] == "missing_section"
    assert status["one_line"]["error"] == "Date line not found"


def test_records_across_block_edges(spark, monkeypatch):
    """Records that begin in one block and end in the next, or span several."""
    for bits in (0, 1, 2, 3):
        monkeypatch.setattr(scan, "BLOCK_BITS", bits)
        check_against_model(spark, {"a": st1_text(sum((rec(i) for i in range(9)), [])), "b": st1_text(rec(1)[:4])}, ST1)


WORDS = ["WELL", "NAME", "LICENCE", "NUMBER", "DATE:", "TOTAL", "PAGE", "BA", "ID", "é", "ü", "Report", "Number:",
         "------", "x", "yy", "zzz", "02", "January", "2024", "feb", "31", "AER", "DAILY", "SPUD", "REPORT"]


def random_report(rng: random.Random, kind: str) -> str:
    lines = []
    for _ in range(rng.randint(0, 40)):
        r = rng.random()
        if r < 0.1:
            lines.append("")
        elif r < 0.15:
            lines.append("DATE: " + rng.choice(["02 January 2024", "2 feb 2024", "31 February 2024", "x"]))
        elif r < 0.2:
            lines.append("REPORT DATE " + rng.choice(["02 January 2024", "bad date here"]))
        elif r < 0.25:
            lines.append("WELL NAME".ljust(37) + "LICENCE NUMBER")
        elif r < 0.32:
            sep = rng.choice(["  ", " ", "\u00a0", " \u3000"])
            lines.append(rng.choice(["", "é", "日"]) + sep.join("-" * rng.randint(1, 9) for _ in range(rng.randint(1, 13))))
        elif r < 0.37:
            lines.append(rng.choice(ST49.footer_words + ST1.terminators) + " " + str(rng.randint(0, 9)))
        elif r < 0.42:
            lines.append("BA ID  NAME  NUMBER " * rng.randint(1, 2))
        else:
            n = rng.randint(1, 14)
            sep = rng.choice([" ", "  ", "     "])
            lines.append(sep.join(rng.choice(WORDS) for _ in range(n)) + " " * rng.randint(0, 3))
    return "\n".join(lines)


@pytest.mark.parametrize("bits", [2, 16])
def test_random_reports_match_model(spark, monkeypatch, bits):
    """Random reports, parsed with tiny blocks (4 lines) so that every scan
    crosses block boundaries, must equal the line-by-line model."""
    monkeypatch.setattr(scan, "BLOCK_BITS", bits)
    rng = random.Random(7 + bits)
    st1 = {f"r{i}": random_report(rng, "st1") for i in range(60)}
    st1.update({f"v{i}": st1_text(sum((rec(j) for j in range(rng.randint(0, 4))), [])) for i in range(10)})
    check_against_model(spark, st1, ST1)
    st49 = {f"s{i}": random_report(rng, "st49") for i in range(60)}
    check_against_model(spark, st49, ST49)


def test_report_lines_renumbers(spark, monkeypatch):
    monkeypatch.setattr(scan, "BLOCK_BITS", 1)
    text = "\n".join(["", " a ", "", "b", " ", "c\r", *[f"l{i}" for i in range(9)]])
    got = report_lines(lines_df(spark, {"p": text})).orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in got] == list(enumerate(model.norm(text)))
