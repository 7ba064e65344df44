"""What no plan of a registered query may hold."""

from pathlib import Path

import pytest

import __spark_entry__  # noqa: F401  registers all queries
from catalogue.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")

FORBIDDEN = (
    "CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "Window", "collect_list", "collect_set",
)


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert [word for word in FORBIDDEN if word in plan] == []


def test_one_partition_is_read(spark):
    from catalogue.sources import partition_pruning

    plan = pushed(spark, partition_pruning(spark, SF_DIR))
    assert "PartitionFilters: [isnotnull(order_year" in plan and "(order_year" in plan.split("PartitionFilters")[1]


def pushed(spark, df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    from lakeloom.plans.trips_lakehouse import TRIPS, ml_duracion_recorridos, station_pairs, trip_activity

    path = str(tmp_path / "trips")
    spark.createDataFrame([], TRIPS).write.parquet(path)
    trips = spark.read.schema(TRIPS).parquet(path)
    plan = pushed(spark, ml_duracion_recorridos(trips))
    assert "GreaterThan(duracion_seg,60), LessThan(duracion_seg,7200)" in plan
    assert "IsNotNull(lat_estacion_destino)" in plan
    assert "Exchange" not in plan and "genero_usuario" not in plan and "nombre_estacion" not in plan
    plan = pushed(spark, station_pairs(trips))
    assert "lat_" not in plan and "duracion" not in plan
    # The text maxima sort what the hashed distinct leaves, not the scan's rows.
    assert plan.index("SortAggregate") < plan.index("HashAggregate") < plan.index("FileScan")
    users = spark.createDataFrame([(1, "F", 20)], "id_usuario bigint, genero_usuario string, edad_usuario int")
    segments = spark.createDataFrame([(1, None, "Desconocido")], "id bigint, genero string, rango_etario string")
    plan = pushed(spark, trip_activity(trips, users, segments))
    assert "GreaterThan(duracion_seg,0)" in plan and "IsNotNull(id_estacion_origen)" in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
