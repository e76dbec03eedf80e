import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from pulseloom.session import local_session  # noqa: E402
from pulseloom.sources.raw import RAW_SCHEMA  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="6g", partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def messages(spark):
    """Raw messages from payload objects or texts, all arriving at one moment."""

    def build(*payloads, received="2025-01-01 00:00:00"):
        rows = [(i, received, p if isinstance(p, str) or p is None else json.dumps(p))
                for i, p in enumerate(payloads)]
        return spark.createDataFrame(rows, "msg_id bigint, received_ts string, payload string").withColumn(
            "received_ts", __import__("pyspark.sql.functions", fromlist=["x"]).to_timestamp("received_ts")
        ).to(spark.createDataFrame([], RAW_SCHEMA).schema)

    return build
