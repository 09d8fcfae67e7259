import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="tessera-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path(tmp_path):
    return str(tmp_path)


def raw_df(spark, name, rows, ingestion_ts=None, batch_id=None):
    """A raw (all-string) table from dicts; missing columns are NULL."""
    from pyspark.sql import functions as F

    from tessera.sources.schemas import RAW_COLUMNS, RAW_SCHEMAS

    cols = RAW_COLUMNS[name]
    data = [tuple(None if r.get(c) is None else str(r.get(c)) for c in cols) for r in rows]
    df = spark.createDataFrame(data, RAW_SCHEMAS[name])
    if ingestion_ts is not None:
        df = df.withColumn("ingestion_ts", F.lit(datetime.fromisoformat(ingestion_ts)).cast("timestamp"))
        df = df.withColumn("batch_id", F.lit(batch_id or ingestion_ts))
    return df
