import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from report_lake.session import local_session, shared_dir

    s = local_session("*", shuffle_partitions=8, app="report_lake_tests")
    shared_dir(s)
    yield s


@pytest.fixture
def tmp_shared(spark):
    from report_lake.session import scratch_path

    return lambda name="t": scratch_path(spark, name)


def lines_df(spark, reports: dict):
    """{path: text} -> line relation (path, pos, line) split on \\n."""
    from report_lake.sources.files import text_lines

    df = spark.createDataFrame(list(reports.items()), "path string, text string")
    return text_lines(df, "path", "text")
