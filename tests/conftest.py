import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from innflow.session import local_session

    s = local_session(4, shuffle_partitions=4, app="innflow-tests")
    yield s
    s.stop()


@pytest.fixture()
def rows_df(spark):
    """Build an all-text DataFrame from dicts, adding ``_seq`` in list order."""
    from pyspark.sql import types as T

    def make(rows, columns):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]
                              + [T.StructField("_seq", T.LongType())])
        data = [tuple(r.get(c) for c in columns) + (i,) for i, r in enumerate(rows)]
        return spark.createDataFrame(data, schema)

    return make
