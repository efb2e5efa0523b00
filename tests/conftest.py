import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tsforge.session import local_session

    s = local_session(4, shuffle_partitions=4, app="tsforge-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def multi_long(spark):
    """Cleaned hourly 4-variable fixture as a long frame on its hourly grid."""
    from pyspark.sql import functions as F

    from fixture_data import MULTI_CLEANED, MULTI_COLUMNS
    from tsforge.sources.csv import to_long

    pdf_rows = [tuple([r[0]] + list(r[1:])) for r in MULTI_CLEANED]
    schema = "timestamp string, " + ", ".join(f"{c} double" for c in MULTI_COLUMNS[1:])
    df = spark.createDataFrame(pdf_rows, schema)
    from tsforge.operators import calendar

    long = to_long(df, "timestamp", MULTI_COLUMNS[1:], series_id="multi")
    return calendar.regularize(long, "H").withColumn("value", F.col("value")).cache()
