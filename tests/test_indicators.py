"""Counts of bands apart, held against SQL on all pairs."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
from compare import duckdb_rows, rows_of

from sheafwork import registry
from sheafwork.plans import catalog_queries  # noqa: F401


def same_as_sql(spark, folder, rows):
    folder.mkdir()
    keys, nations, balances = zip(*rows)
    pq.write_table(pa.table({"s_suppkey": pa.array(keys, pa.int64()), "s_nationkey": pa.array(nations, pa.int32()), "s_acctbal": pa.array(balances, pa.float64())}), f"{folder}/supplier.parquet")
    got = rows_of(registry.QUERIES["bands_apart"](spark, str(folder)).toPandas())
    assert got == duckdb_rows(registry.ORACLES["bands_apart"], str(folder))


def test_bands_that_rounding_decides(spark, tmp_path):
    cents = random.Random(7).sample(range(-99_999, 800_000), 300)
    # cents that are 2000.00 apart: the difference of the doubles is 2000 or a little more or less
    same_as_sql(spark, tmp_path / "close", [(i, i % 3, (cents[i // 6] + 200_000 * (i // 3 % 2)) / 100) for i in range(1800)])


def test_bands_of_odd_rows(spark, tmp_path):
    odd = [(1, 0, None), (2, None, 5.0), (None, 0, 9000.0), (3, 0, 100.0), (4, 0, 2100.0), (5, 0, 2100.01), (5, 0, -50.0), (5, 0, 9000.0), (6, 0, float("inf")), (7, 0, float("nan")), (8, 1, 0.0), (9, 2, 1.0), (9, 2, 5000.0), (5, 2, 9000.0)]
    same_as_sql(spark, tmp_path / "odd", odd)
    same_as_sql(spark, tmp_path / "none", [(1, 0, None)])
    same_as_sql(spark, tmp_path / "zero", [(1, 0, 0.0), (2, 0, -0.0), (3, 0, float("-inf"))])
