"""The whole build on hand-made dirty CSV files with literal expected tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeloom.__main__ import main
from lakeloom.operators.quality import ChecksFailed, NotNull, RowCount, Share
from lakeloom.plans import trips_lakehouse as plan
from lakeloom.sources.layers import RAW, Lake

ENDS = ["fecha_origen_recorrido", "fecha_destino_recorrido"]


def station_headers(role):
    return [f"{c}_estacion_{role}" for c in ("id", "nombre", "direccion", "lat", "long")]


A = ("1", "Alpha, north", "Street 1", "-34.60", "-58.40")
B = ("2", "Beta", "Street 2", "-34.61", "-58.41")
B_RENAMED = ("2", "Beta II", "Street 2", "-34.61", "-58.41")
NOWHERE = ("", "", "", "", "")


def with_token(station):
    return (station[0] and station[0] + plan.ID_TOKEN, *station[1:])


def csv_line(values):
    return ",".join('"' + v.replace('"', '""') + '"' if any(c in v for c in ',"\n') else v for v in values) + "\n"


def csv_file(headers, rows):
    return csv_line(headers) + "".join(csv_line(r) for r in rows)


@pytest.fixture(scope="module")
def sources():
    t = plan.ID_TOKEN
    middle = [*ENDS, *station_headers("origen"), *station_headers("destino"), "modelo_bicicleta"]
    old = ["Id_recorrido", "id_usuario", "duracion_recorrido", *middle]
    new = ["id_recorrido", "id_usuario", "duracion_recorrido", *middle]
    day, end = "2022-01-01 08:30:00", "2022-01-01 08:47:00"
    trips_2022 = [
        ("1", "1", f"101{t}", f"10{t}", "1,020", day, end, *with_token(A), *with_token(B), "FIT", "FEMALE"),
        ("2", "2", f"102{t}", f"10{t}", "1,140", day, end, *with_token(A), *with_token(B_RENAMED), "FIT", "FEMALE"),
        ("3", "3", f"103{t}", f"99{t}", "90", day, end, *with_token(B), *with_token(A), "ICONIC", ""),
        ("4", "4", f"104{t}", f"11{t}", "n/a", day, end, *with_token(A), *with_token(B), "FIT", "MALE"),
    ]
    trips_2023 = [
        ("1", f"201{t}", f"11{t}", "7,200", "2023-07-02 23:59:59", "2023-07-03 02:00:00", *with_token(A), *with_token(B),
         "ICONIC", "MALE"),
        ("2", f"202{t}", f"12{t}", "7,199", "2023-07-02 00:00:00", "not a time", *with_token(A), *NOWHERE, "FIT", "OTHER"),
        ("3", f"203{t}", f"13{t}", "60", "2023-07-02 00:00:00", "2023-07-02 00:01:00", *with_token(A), *with_token(A),
         "FIT", "OTHER"),
    ]
    same = ("301", "14.0", "61", "2024-12-31 18:00:00", "2024-12-31 18:01:01", *A, *A, "FIT", "FEMALE")
    trips_2024 = [same, same, ("302", "14.0", "0", "2024-12-31 23:50:00", "", *A, *B, "FIT", "FEMALE")]
    dni = "Customer.Has.Dni..Yes...No."
    users_old = ["ID_usuario", "genero_usuario", "edad_usuario", "fecha_alta", "hora_alta", dni]
    return {
        "trips_2022": csv_file(["", "X", *old, "Género"], trips_2022),
        "trips_2023": csv_file(["", *old, "género"], trips_2023),
        "badata_ecobici_recorridos_realizados_2024": "﻿" + csv_file([*new, "genero"], trips_2024),
        "usuarios_ecobici_2022": csv_file(
            users_old,
            [("10", "FEMALE", "25", "2022-01-01", "07:00:01", "Yes"), ("11", "MALE", "1,019", "2022-02-01", "23:59:59", "No")],
        ),
        "usuarios_ecobici_2023": csv_file(
            users_old,
            [("12", "OTHER", "16", "2023-01-01", "00:00:00", ""), ("13", "OTHER", "101", "2023-01-01", "12:00:00", "maybe")],
        ),
        "usuarios_ecobici_2024": csv_file(
            [h for h in ["id_usuario", *users_old[1:-1]]], [("14", "FEMALE", "66", "2024-01-01", "01:02:03")]
        ),
    }


def lay(root, sources):
    (root / "source").mkdir()
    for name, text in sources.items():
        (root / "source" / f"{name}.csv").write_text(text, newline="")
    return Lake(str(root))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory, sources):
    lake = lay(tmp_path_factory.mktemp("lake"), sources)
    build = plan.Build(spark, lake, numbering="ordered")
    build.run(stop_on_failure=False)
    return build


def test_raw_is_the_csv(spark, built, rows):
    raw = built.lake.read(spark, RAW, "raw_recorridos_2022")
    assert raw.columns[:3] == ["_c0", "X", "Id_recorrido"] and raw.columns[-1] == "Género"
    assert {kind for _, kind in raw.dtypes} == {"string"}
    assert raw.count() == 4
    assert rows(raw.select("duracion_recorrido", "nombre_estacion_origen"))[0] == ("1,020", "Alpha, north")


def test_silver_trips(built, rows):
    trips = built.table("stg_recorridos")
    got = rows(trips.select("id_recorrido", "id_usuario", "duracion_seg", "id_estacion_destino", "genero_usuario", "anio_archivo"))
    assert got == [
        (101, 10, 1020, 2, "FEMALE", 2022), (102, 10, 1140, 2, "FEMALE", 2022), (103, 99, 90, 1, None, 2022),
        (104, 11, None, 2, "MALE", 2022), (201, 11, 7200, 2, "MALE", 2023), (202, 12, 7199, None, "OTHER", 2023),
        (203, 13, 60, 1, "OTHER", 2023), (301, 14, 61, 1, "FEMALE", 2024), (302, 14, 0, 2, "FEMALE", 2024),
    ]
    ends = {r.id_recorrido: r.fecha_destino for r in trips.collect()}
    assert ends[101] == dt.datetime(2022, 1, 1, 8, 47) and ends[202] is None and ends[302] is None
    assert built.table("stg_recorridos_2024").count() == 3


def test_silver_users(built, rows):
    noon = dt.time
    assert rows(built.table("stg_usuarios")) == [
        (10, "FEMALE", 25, dt.date(2022, 1, 1), noon(7, 0, 1), True, 2022),
        (11, "MALE", None, dt.date(2022, 2, 1), noon(23, 59, 59), False, 2022),
        (12, "OTHER", 16, dt.date(2023, 1, 1), noon(0, 0), None, 2023),
        (13, "OTHER", None, dt.date(2023, 1, 1), noon(12, 0), None, 2023),
        (14, "FEMALE", 66, dt.date(2024, 1, 1), noon(1, 2, 3), None, 2024),
    ]


def test_dimensions(built, rows):
    assert rows(built.table("dim_estacion")) == [(1, "Alpha, north"), (2, "Beta II")]
    assert rows(built.table("dim_fecha")) == [
        (20220101, 1, 1, 52, 2022, dt.date(2022, 1, 1)),
        (20230702, 2, 7, 26, 2023, dt.date(2023, 7, 2)),
        (20241231, 31, 12, 1, 2024, dt.date(2024, 12, 31)),
    ]
    assert rows(built.table("dim_demografia")) == [
        (1, "FEMALE", "16-25"), (2, "FEMALE", "66+"), (3, "MALE", "Desconocido"), (4, "OTHER", "16-25"),
        (5, "OTHER", "Desconocido"), (6, None, "Desconocido"),
    ]
    assert rows(built.table("dim_recorrido")) == [
        (1, 1, 1, "Alpha, north → Alpha, north"),
        (2, 1, 2, "Alpha, north → Beta II"),
        (3, 2, 1, "Beta → Alpha, north"),
    ]


def test_facts(built, rows):
    assert rows(built.table("fct_viajes")) == [
        (1, 20220101, 1, 2, 2, 18), (2, 20220101, 6, 3, 1, 2), (3, 20230702, 3, 2, 1, 120), (4, 20230702, 5, 1, 1, 1),
        (5, 20241231, 2, 1, 1, 1),
    ]
    assert rows(built.table("fact_actividad")) == [
        (1, 20220101, 1, 1, 2), (2, 20220101, 6, 2, 1), (3, 20230702, 3, 1, 1), (4, 20230702, 4, 1, 1),
        (5, 20230702, 5, 1, 1), (6, 20241231, 2, 1, 1),
    ]


def test_features(built, rows):
    got = rows(built.table("ml_duracion_recorridos").withColumn("distancia_km", F.round("distancia_km", 3)))
    assert got == [
        (101, 1020, 1.44, 8, 6, 1, 1, "FIT"), (102, 1140, 1.44, 8, 6, 1, 1, "FIT"),
        (103, 90, 1.44, 8, 6, 1, 1, "ICONIC"), (301, 61, 0.0, 18, 2, 0, 12, "FIT"),
    ]


def test_declared_checks(built):
    results = built.checks().collect()
    assert len(results) == sum(len(c) for c in plan.CHECKS.values()) == 74
    failed = {(r.table_name, r.check_name) for r in results if not r.passed}
    # A small lake has few rows, and these files hold bad values on purpose.
    assert failed == {
        ("stg_recorridos", "row_count"), ("stg_recorridos", "valid_duration"),
        ("stg_usuarios", "row_count"), ("stg_usuarios", "known_age"),
    }
    assert built.checks(skip=(RowCount, Share)).where(~F.col("passed")).count() == 0


def test_partitioned_and_unordered_build_agrees(spark, tmp_path, sources, built, rows):
    build = plan.Build(spark, lay(tmp_path, sources), partition_years=True)
    build.run(stop_on_failure=False)
    assert (tmp_path / "stg" / "stg_recorridos" / "anio_archivo=2023").is_dir()
    for name in ("stg_recorridos", "stg_usuarios", *plan.GOLD, "ml_duracion_recorridos"):
        left, right = build.table(name), built.table(name)
        if name in ("fct_viajes", "fact_actividad"):
            assert sorted(r.id for r in left.collect()) == sorted(r.id for r in right.collect())
            left, right = left.drop("id"), right.drop("id")
        assert left.dtypes == right.dtypes and rows(left) == rows(right)


def test_failed_checks_stop_the_build(spark, tmp_path, sources):
    build = plan.Build(spark, lay(tmp_path, sources))
    with pytest.raises(ChecksFailed, match="row_count"):
        build.run()
    assert not (tmp_path / "mart_bi").exists()


def test_command_line(spark, tmp_path, sources, capsys):
    lay(tmp_path, sources)
    root = str(tmp_path)
    assert main([root]) == 1  # too few rows for the declared range
    assert "row_count" in capsys.readouterr().out and not (tmp_path / "mart_bi").exists()
    assert main([root, "gold_bi", "gold_ml", "check=fct_viajes", "check=dim_estacion"]) == 0
    assert (tmp_path / "mart_ml" / "ml_duracion_recorridos.parquet").is_dir()
    assert main([root, "check"]) == 1
    with pytest.raises(SystemExit):
        main([root, "bronze"])


def test_bad_id_fails_the_load(spark, tmp_path, sources):
    bad = dict(sources, usuarios_ecobici_2024=sources["usuarios_ecobici_2024"] + "x1,FEMALE,30,2024-01-01,01:02:03\n")
    build = plan.Build(spark, lay(tmp_path, bad))
    with pytest.raises(Exception, match="cannot read as bigint"):
        build.run(stop_on_failure=False)


def test_check_counts_by_kind():
    kinds = [type(c).__name__ for checks in plan.CHECKS.values() for c in checks]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "NotNull": 41, "Unique": 13, "Accepted": 8, "Reference": 8, "RowCount": 2, "Share": 2,
    }
    assert NotNull("id_usuario") in plan.CHECKS["stg_recorridos"]
