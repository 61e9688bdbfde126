import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("toxiscope-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # tests own their checkpoint folder only when the session has none
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="toxiscope-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def six_labels(spark):
    from toxiscope.schema import COMMENT_SCHEMA

    rows = [
        ("a", "good edit thanks", 0, 0, 0, 0, 0, 0),
        ("b", "bad bad rude words", 1, 1, 1, 0, 1, 0),
        ("c", "rude threat here", 1, 0, 0, 1, 1, 0),
        ("d", "see the talk page", 0, 0, 0, 0, 0, 0),
    ]
    return spark.createDataFrame(rows, COMMENT_SCHEMA)
