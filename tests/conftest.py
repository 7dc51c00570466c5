import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import connect, local_session  # noqa: E402
from tidemark.session import configure  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(warehouse=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def duck():
    return connect(SMALL)


def rows(df):
    """Rows as sorted tuples, nulls last."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture
def frame(spark):
    return lambda data, schema: spark.createDataFrame(data, schema)


def struct(text):
    """Schema from ``name type, ...`` without a session."""
    kinds = {
        "string": T.StringType(),
        "int": T.IntegerType(),
        "long": T.LongType(),
        "double": T.DoubleType(),
        "boolean": T.BooleanType(),
        "date": T.DateType(),
        "timestamp": T.TimestampType(),
    }
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (f.split() for f in text.split(","))])
