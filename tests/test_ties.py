"""Queries and their SQL on sessions in which several rows share a time: copies of the events with other ids, as larger tables are made."""

from __future__ import annotations

import os

import duckdb
import pytest
from compare import difference, oracle
from conftest import SF

from chronoweave.plans.registry import ORACLE_SQL, QUERIES

#: Queries by the finding they were named in.
NAMES = ["a11_hold_by_distance", "b10_mandatory_streams", "b11_behavior_table", "b11_behavior_table_bucketed", "b12_runtime_table", "b12_runtime_table_bucketed",
    "b18_experiment_dataset"]


@pytest.fixture(scope="module")
def tied(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tied"))
    for file in os.listdir(SF):
        if file.endswith(".parquet") and file != "events.parquet":
            os.symlink(f"{SF}/{file}", f"{folder}/{file}")
    duckdb.connect().execute(f"COPY (SELECT * REPLACE (event_id + r * 1000000 AS event_id) FROM '{SF}/events.parquet', range(3) q(r)) "
        f"TO '{folder}/events.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_rows_of_one_time(spark, tied, name):
    assert not difference(QUERIES[name](spark, tied).toPandas(), oracle(ORACLE_SQL[name], tied))


def test_equal_sums_are_equal(spark, tmp_path):
    """0.1 + 0.2 of a trial and 0.3 of the encoder are one distance."""
    rows = [(1, 1, "signup", 0.1), (2, 2, "signup", 0.2), (3, 3, "purchase", 0.3)]
    values = ", ".join(f"({i}, make_timestamp({t} * 1000000), 7, '{kind}', CAST({v} AS DOUBLE))" for i, t, kind, v in rows)
    duckdb.connect().execute(f"COPY (SELECT * FROM (VALUES {values}) v(event_id, ts, user_id, event_type, value)) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    found = QUERIES["a11_hold_by_distance"](spark, str(tmp_path)).toPandas()
    assert found["trial"].tolist() == [2]
    assert not difference(found, oracle(ORACLE_SQL["a11_hold_by_distance"], str(tmp_path)))
