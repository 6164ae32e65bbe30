"""Lookups keep one row per fact row on unique keys; JDBC read options (no connection made)."""

import pytest

from haulstat.operators.lookup import key_is_unique, lookup
from haulstat.sources.jdbc import SOURCE_TABLES, jdbc_options


def test_left_lookup_preserves_rows_and_null_keys_do_not_match(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz")], "id int, k string")
    dim = spark.createDataFrame([("a", 10), ("b", 20), (None, 99)], "k string, v int")
    assert key_is_unique(dim, ["k"]).first()[0] == 0
    out = {r["id"]: r["v"] for r in lookup(facts, dim, "k").collect()}
    assert out == {1: 10, 2: 20, 3: None, 4: None}


def test_lookup_rename_and_clash(spark):
    facts = spark.createDataFrame([(1, "t1")], "id int, truck_id string")
    drivers = spark.createDataFrame([("t1", "d1")], "vehicle_no string, driver_id string")
    assert lookup(facts, drivers, "truck_id", rename={"vehicle_no": "truck_id"}).first()["driver_id"] == "d1"
    with pytest.raises(ValueError):
        lookup(facts, spark.createDataFrame([("t1", 5)], "truck_id string, id int"), "truck_id")


def test_trip_lookups_keep_one_row_per_trip(spark):
    from haulstat.plans import bindings as B
    from haulstat.plans import queries as Q
    sf = "/root/testdata/sf0.001"
    assert Q.QUERIES["lookup_join"](spark, sf).count() == B.trips(spark, sf).count()


def test_jdbc_partitioned_options():
    opts = jdbc_options({"url": "jdbc:postgresql://db/x", "user": "u"}, "routes_weather",
                        partition_column="route_id", lower_bound=0, upper_bound=1000, num_partitions=16)
    assert opts["dbtable"] == "routes_weather" and opts["numPartitions"] == "16"
    assert opts["partitionColumn"] == "route_id" and opts["fetchsize"] == "10000"
    with pytest.raises(ValueError):
        jdbc_options({"url": "x"}, "t", partition_column="id")
    assert SOURCE_TABLES["drivers"] == ("mysql", "drivers_details")
