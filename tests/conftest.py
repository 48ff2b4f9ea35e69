import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = (SparkSession.builder.master("local[4]").appName("scorewatch-tests")
               .config("spark.sql.shuffle.partitions", "2")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "4g")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", str(warehouse))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["one_cell", "cells", "salted"])
def plan(request, monkeypatch):
    """Run a test with groups in one cell, in a hierarchy of small cells, and with salted lookups."""
    from scorewatch.plans import lookup, running
    if request.param != "one_cell":
        monkeypatch.setattr(lookup, "CELL_ROWS", 60)
        monkeypatch.setattr(running, "DRAWN", 4)
    if request.param == "salted":
        monkeypatch.setattr(lookup, "MAX_BROADCAST_BYTES", 1)
        monkeypatch.setattr(lookup, "SALTS", 4)
    return request.param


def rows_by(df, *keys):
    """Collected rows keyed by one or more columns."""
    out = {}
    for row in df.collect():
        key = row[keys[0]] if len(keys) == 1 else tuple(row[k] for k in keys)
        assert key not in out, f"duplicate key {key}"
        out[key] = row
    return out
