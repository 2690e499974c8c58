import datetime
import re

import pytest

from checks import views as V


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders and customers with nulls, repeated keys and repeated rows."""
    at = str(tmp_path_factory.mktemp("tables"))
    day = datetime.datetime(1997, 3, 4)
    orders = [(k, k % 7 + 1, "O", 100.25 * k, day, "1-URGENT") for k in range(1, 400)]
    orders += [orders[2], (53, 3, "O", 1.5, day, "5-LOW"), (None, 2, "O", 7.0, day, None), (103, None, "F", 8.0, None, "5-LOW"), (203, 4, None, None, None, None)]
    customers = [(k, f"c{k}", k * 3, 1.0, "BUILDING") for k in range(1, 7)] + [(7, None, None, None, None), (3, "again", 3, 2.0, "MACHINERY"), (None, "n", 1, 1.0, "X")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{at}/customer.parquet")
    return at


@pytest.mark.parametrize("options", [{}, {"copies": False, "clean": True}])
def test_flat_view_has_the_rows_of_its_sql(spark, tables, options):
    want = spark.sql(V.flat_sql(**options), orders=V.table(spark, tables, "orders"), customer=V.table(spark, tables, "customer"))
    rows = sorted(map(repr, map(tuple, want.collect())))
    in_order = V.flat_in_order(spark, tables, **options)
    for found in (V._flat(spark, tables, **options), in_order, V.flat(spark, tables, **options)):
        assert [t for _, t in found.dtypes] == [t for _, t in want.dtypes]
        assert sorted(map(repr, map(tuple, found.collect()))) == rows
    places = [r["src_pos"] for r in in_order.collect()]
    assert places == sorted(places, key=lambda p: (p is not None, p))


def test_flat_view_grows_in_pieces_and_shuffles_source_columns_only(spark, tables, monkeypatch):
    monkeypatch.setattr(V, "PIECE_ROWS", 20)
    monkeypatch.setattr(V, "_WRITTEN", {})
    for found in (V._flat(spark, tables), V.flat_in_order(spark, tables)):
        assert found.rdd.getNumPartitions() == 21
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        dealt = re.search(r"Repartition.*\n((?:.*\n)*)", plan).group(1)
        # the computed columns stand above what is dealt out
        assert "months_as_customer" in plan and "months_as_customer" not in dealt
    assert len(V.flat(spark, tables).inputFiles()) > 12
