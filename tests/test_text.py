import datetime as dt

from pyspark.sql import functions as F

from report_lake.functions.text import (
    byte_slice,
    file_extension,
    file_stem,
    parse_day_month_year,
    plain_path,
    ruler_boundaries,
    trim_ws,
    with_slices,
    words_slice,
)


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_trim_unicode_whitespace(spark):
    assert one(spark, trim_ws("v"), " \t x y 　\r") == "x y"


def test_byte_slice_inside_and_beyond(spark):
    line = "WELL 1" + " " * 31 + "0516990   FREEHOLD"
    assert one(spark, byte_slice("v", 0, 37), line) == "WELL 1"
    assert one(spark, byte_slice("v", 37, 47), line) == "0516990"
    # end past the line: '' (not a truncated value)
    assert one(spark, byte_slice("v", 47, 68), line) == ""
    assert one(spark, byte_slice("v", 68), line) == ""
    assert one(spark, byte_slice("v", 47), line) == "FREEHOLD"


def test_byte_slice_exact_length_and_open_end(spark):
    assert one(spark, byte_slice("v", 0, 5), "abcde") == "abcde"
    assert one(spark, byte_slice("v", 5), "abcde") == ""
    assert one(spark, byte_slice("v", 6), "abcde") == ""


def test_byte_slice_cutting_a_character(spark):
    # 'é' is two bytes: a slice ending inside it gives ''
    assert one(spark, byte_slice("v", 0, 2), "aé") == ""
    assert one(spark, byte_slice("v", 0, 3), "aé") == "aé"
    assert one(spark, byte_slice("v", 2, 3), "aé") == ""


def test_padded_fields_are_cut_from_the_bytes(spark):
    """Padding goes by plain trim, and the line is not decoded again for every field."""
    mixed = "\u3000 \t  é x \u00a0  \r" + " " * 40
    assert one(spark, trim_ws("v"), mixed) == "é x"
    assert one(spark, byte_slice("v", 0, 10), mixed) == "é"
    assert one(spark, byte_slice("v", 0, 8), mixed) == ""
    assert one(spark, byte_slice("v", 0, len(mixed.encode())), mixed) == "é x"
    plan = spark.range(1).select(F.col("id").cast("string").alias("v")).select(byte_slice("v", 0, 5))._jdf.queryExecution().optimizedPlan().toString()
    assert "encode(" not in plan and "as binary" in plan


def test_dates(spark):
    f = parse_day_month_year("v")
    assert one(spark, f, "02 January 2024") == dt.date(2024, 1, 2)
    assert one(spark, f, "2 jan 2024") == dt.date(2024, 1, 2)
    assert one(spark, f, "02  JANUARY   2024") == dt.date(2024, 1, 2)
    assert one(spark, f, "31 February 2024") is None
    assert one(spark, f, "02 January 24") is None
    assert one(spark, f, "02 January 2024 extra") is None
    assert one(spark, f, "INVALID DATE") is None


def test_words_slice(spark):
    assert one(spark, words_slice("v", 2, 3), "REPORT DATE 02 January 2024 x") == "02 January 2024"


def test_ruler_boundaries(spark):
    def of(ruler):
        return [(b["start"], b["end"]) for b in one(spark, ruler_boundaries("v"), ruler)]

    assert of("---  -- ----") == [(0, 3), (5, 7), (8, 12)]
    assert of("-" * 17) == [(0, 17)]
    assert of("--  -- ") == [(0, 2), (4, 6), (7, 7)]
    assert of("  --") == [(2, 4)]
    assert of("") == [(0, 0)] and of("  ") == [(2, 2)]
    # offsets are bytes, and any Unicode white space separates
    assert of("é-----  ------") == [(0, 7), (9, 15)]
    assert of("---\u00a0----\u3000-") == [(0, 3), (5, 9), (12, 13)]


def test_words_slice_unicode_space(spark):
    assert one(spark, words_slice("v", 1, 2), "a\u00a0b \u2003c d") == "b c"


def test_plain_path(spark):
    assert one(spark, plain_path("v"), "file:/a%20b/c+d%2Be/x%C3%A9.csv") == "file:/a b/c+d+e/xé.csv"


def test_name_parts(spark):
    df = spark.createDataFrame([("/a/b/WELLS0102.TXT",), ("/a/README",), ("x.tar.gz",)], "p string")
    got = df.select(file_stem("p").alias("s"), file_extension("p").alias("e")).collect()
    assert [(r.s, r.e) for r in got] == [("WELLS0102", "TXT"), ("README", None), ("x.tar", "gz")]


def test_ruler_of_very_many_runs(spark):
    """A line of 60,000 runs, next to short ones: the cost follows the bytes."""
    lines = ["ab é　漢 " * 20_000, "", " ", "--  -", None]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, ruler string").coalesce(1)
    got = {r["i"]: [(b["start"], b["end"]) for b in r["b"]] if r["b"] is not None else None for r in df.select("i", ruler_boundaries("ruler").alias("b")).collect()}
    want, size = [], len("ab é　漢 ".encode())
    for k in range(20_000):
        want += [(k * size, k * size + 2), (k * size + 3, k * size + 5), (k * size + 8, k * size + 11)]
    assert got == {0: [*want, (20_000 * size, 20_000 * size)], 1: [(0, 0)], 2: [(1, 1)], 3: [(0, 2), (4, 5)], 4: None}


def test_with_slices_gives_byte_slices(spark):
    """Fields cut together are those cut one by one, also where only some lines are plain."""
    lines = [
        ("ab  cd  ef", "  x"), ("ab\u3000 cd", "\u2003x\t"), ("\u00e9\u00e9 cd", "plain"), ("a\tb", None), ("", ""),
        ("ab \x1f cd", " \u00a0 "),
    ]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(lines)], "id int, l0 string, l1 string")
    cuts = [("a", "l0", 0, 3), ("b", "l0", 2, 6), ("c", "l0", 4, None), ("d", "l1", 0, None), ("e", "l1", 1, 4)]
    got = with_slices(df, ["id"], cuts).orderBy("id").collect()
    want = df.select("id", *[byte_slice(F.col(l), s, e).alias(n) for n, l, s, e in cuts]).orderBy("id").collect()
    assert got == want and got[1]["d"] == "x" and got[3]["d"] == ""


def test_lines_are_trimmed_alike(spark):
    """Lines that need no trim by the set of white space skip it, with the same result."""
    from pyspark.sql import types as T

    from report_lake.functions.text import UNICODE_WHITESPACE, with_trimmed

    edges = ["", " ", "\r", " \r", "\r ", "\r\r", "\t", "\x1f", "\x7f", "é", "~", "!", "　 \r", *UNICODE_WHITESPACE]
    lines = [None, *(a + x + b for a in edges for x in ("", "x", "a b", "é x y") for b in edges)]
    df = spark.createDataFrame([(x,) for x in lines], T.StructType([T.StructField("v", T.StringType())])).withColumn("t", trim_ws("v"))
    raw = spark.sql("SELECT cast(unhex(h) AS string) AS v FROM VALUES ('20E241'), ('FF20'), ('41C30D'), ('E280'), ('20E28041200D') AS x(h)").withColumn("t", trim_ws("v"))
    got = with_trimmed(df.union(raw), "v")
    assert got.count() == len(lines) + 5 and got.where(~F.col("v").cast("binary").eqNullSafe(F.col("t").cast("binary"))).count() == 0
