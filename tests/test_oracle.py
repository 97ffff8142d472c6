"""Every registered query against its SQL oracle."""

from datetime import datetime

import duckdb
import pytest

from validation.check import connect, difference
from validation.oracles import ORACLES
from validation.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    assert difference(spark, duck, SF, name) is None


def test_hex_order_of_wide_keys(spark, tmp_path):
    """Keys wider than 20 and 13 bits, hours, line numbers of two digits, negative and missing keys."""
    day, hour = datetime(1996, 3, 1), datetime(1996, 3, 1, 5)
    orders = [
        [(day, 1, 2**20, 0), (day, 2, 5, 0)], [(day, 1, 7, 2**13), (day, 1, 8, 0)], [(hour, 1, 1, 1), (day, 2, 1, 1)],
        [(day, 9, 1, 1), (datetime(1996, 3, 2), 1, 1, 1)], [(day, 1, -4, 1), (day, 1, 3, 1)],
        [(day, 1, 2**40, 1), (day, 2, 2**40 - 1, 1)], [(day, 1, None, 9), (day, 1, 0, 1)], [(datetime(1970, 1, 1), 1, 2, 3), (None, 8, 9, 9)],
    ]
    flags = ["N", "R"]
    # Each pair twice, with the later change in either batch.
    rows = [
        (2 * order + turn, *change, flags[(place + turn) % 2], f"{place}")
        for order, changes in enumerate(orders) for turn in (0, 1) for place, change in enumerate(changes)
    ]
    columns = "l_orderkey bigint, l_shipdate timestamp_ntz, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string"
    spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    assert difference(spark, duck, str(tmp_path), "merge_load_hex_order") is None
