import random

from pyspark.sql import functions as F

from report_lake.operators import islands as I

SCHEMA = "path string, blk long, pos long, line string"


def model(lines):
    """(record_no, part_no, header, line) of one file's lines, read one by one."""
    out, no, part, header = [], -1, 0, None
    for line in (x.strip() for x in lines):
        if not line:
            continue
        if line.startswith("H"):
            no, part, header = no + 1, 0, line
        elif line.startswith("END"):
            header = None
        elif header is not None:
            part += 1
        if header is not None:
            out.append((no, part, header, line))
    return out


def test_against_a_line_by_line_model(spark):
    rng, rows, want = random.Random(2), [], []
    for f in range(12):
        lines = [rng.choice(["H" + str(i), "d" + str(i), "d" + str(i), "  d é  ", "", "END x"] if f % 3 else ["d", "H1", "d"]) for i in range(rng.choice([0, 1, 7, 40]))]
        if f == 5:
            lines = ["H0"] + ["d"] * 60  # one record over very many blocks
        size = rng.choice([1, 2, 5])
        rows += [(f"f{f}", 100 * (i // size), i % size, x) for i, x in enumerate(lines)]
        want += [(f"f{f}", *x) for x in model(lines)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = I.island_rows(df, F.col("line").startswith("H"), F.col("line").startswith("END"))
    got = [tuple(r) for r in out.select("path", "record_no", "part_no", "header", "line").collect()]
    assert sorted(got) == sorted(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(record_no" not in plan and "collect_list" not in plan


def test_headers_alone_and_empty(spark):
    spec = I.IslandSpec("H", (("id", 1, 3),), (("a", 0, 2), ("b", 2, None)), ends="END")
    lines = ["x", "H01", "aabb", "H02", "END", "aacc", "H03", "a", "aaé"]
    df = spark.createDataFrame([("f", 0, i, x) for i, x in enumerate(lines)], SCHEMA)
    got = sorted(tuple(r) for r in I.parse_islands(df, spec).collect())
    assert got == [("f", 0, 1, "01", "aa", "bb"), ("f", 1, 0, "02", "", ""), ("f", 2, 1, "03", "", ""), ("f", 2, 2, "03", "aa", "é")]
    assert I.parse_islands(df.limit(0), spec).count() == 0
