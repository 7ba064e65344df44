"""The bike-share lakehouse: six CSV sources to star schema and feature table.

Names, headers, codes and bounds are data of the sources and of the tables
built from them.  The work is done by the operators.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import derive
from lakeloom.functions.cleaning import (
    grouped_int,
    map_values,
    null_outside,
    strict,
    strip_text,
    time_of_day,
    tolerant,
)
from lakeloom.operators.dims import calendar_dim, node_dim, pair_dim, pair_names, segment_dim
from lakeloom.operators.facts import Lookup, activity, build_fact, coarsen, enrich_with_key
from lakeloom.operators.harmonize import Field, drop_copies, harmonize, literal, take, union_vintages
from lakeloom.operators.quality import (
    Accepted,
    NotNull,
    Reference,
    RowCount,
    Share,
    Unique,
    require_passed,
    run_checks,
)
from lakeloom.operators.training import FeatureNames, TripColumns, feature_table
from lakeloom.session import materialize
from lakeloom.sources.layers import GOLD_BI, GOLD_ML, RAW, SILVER, Lake

# ---- Fixed values -----------------------------------------------------------

# Raw table -> source name.
SOURCES = {
    "raw_recorridos_2022": "trips_2022",
    "raw_recorridos_2023": "trips_2023",
    "raw_recorridos_2024": "badata_ecobici_recorridos_realizados_2024",
    "raw_usuarios_2022": "usuarios_ecobici_2022",
    "raw_usuarios_2023": "usuarios_ecobici_2023",
    "raw_usuarios_2024": "usuarios_ecobici_2024",
}
YEARS = (2022, 2023, 2024)
ID_TOKEN = "BAEcobici"
FLOAT_ARTIFACT = ".0"
DNI_CODES = {"Yes": True, "No": False}
AGE_RANGE = (16, 100)
BAND_EDGES = (16, 26, 36, 51, 66)
BAND_LABELS = ("16-25", "26-35", "36-50", "51-65", "66+")
UNKNOWN_BAND = "Desconocido"
ROUTE_SEPARATOR = " → "
GENDERS = ("MALE", "FEMALE", "OTHER")
BIKE_MODELS = ("FIT", "ICONIC")
TRIP_ROWS = (8_000_000, 10_000_000)
USER_ROWS = (400_000, 500_000)
VALID_SHARE = 0.99
LONGEST_DURATION = 24 * 3600

# ---- Schemas: fixed table names, column names and types ---------------------

TRIPS = (
    "id_recorrido bigint, id_usuario bigint, duracion_seg int, fecha_origen timestamp_ntz, fecha_destino timestamp_ntz, "
    "id_estacion_origen smallint, nombre_estacion_origen string, direccion_estacion_origen string, "
    "lat_estacion_origen double, long_estacion_origen double, "
    "id_estacion_destino smallint, nombre_estacion_destino string, direccion_estacion_destino string, "
    "lat_estacion_destino double, long_estacion_destino double, "
    "modelo_bicicleta string, genero_usuario string, anio_archivo smallint"
)
USERS = (
    "id_usuario bigint, genero_usuario string, edad_usuario int, fecha_alta date, hora_alta {time}, "
    "tiene_dni boolean, anio_archivo smallint"
)
GOLD = {
    "dim_estacion": "id smallint, nombre string",
    "dim_fecha": "id int, dia int, mes int, semana int, anio int, fecha_completa date",
    "dim_demografia": "id bigint, genero string, rango_etario string",
    "dim_recorrido": "id bigint, id_estacion_origen smallint, id_estacion_destino smallint, ruta string",
    "fct_viajes": "id bigint, id_fecha int, id_demografia bigint, id_recorrido bigint, cantidad bigint, minutos int",
    "fact_actividad": "id bigint, id_fecha int, id_demografia bigint, id_estacion smallint, cantidad bigint",
}
FEATURES = (
    "id_recorrido bigint, duracion_seg int, distancia_km double, hora_origen bigint, dia_semana bigint, "
    "es_fin_de_semana int, mes bigint, modelo_bicicleta string"
)


def native_time(spark: SparkSession) -> bool:
    """Whether the session has the TIME type."""
    return spark.conf.get("spark.sql.timeType.enabled", "false") == "true"


def users_schema(spark: SparkSession) -> str:
    return USERS.format(time="time" if native_time(spark) else "string")


# ---- Vintages ---------------------------------------------------------------


def trip_fields(year: int) -> dict[str, Field]:
    """How a year's trip headers and formats map to the silver columns."""
    tokens = year < 2024  # ids carry a token and durations a thousands separator
    token = (strip_text(ID_TOKEN),) if tokens else ()
    user_step = strip_text(ID_TOKEN if tokens else FLOAT_ARTIFACT)
    duration = grouped_int() if tokens else tolerant("int")
    gender = {2022: "Género", 2023: "género", 2024: "genero"}[year]

    def station(role: str) -> dict[str, Field]:
        return {
            f"id_estacion_{role}": take(f"id_estacion_{role}", *token, strict("smallint")),
            f"nombre_estacion_{role}": take(f"nombre_estacion_{role}"),
            f"direccion_estacion_{role}": take(f"direccion_estacion_{role}"),
            f"lat_estacion_{role}": take(f"lat_estacion_{role}", tolerant("double")),
            f"long_estacion_{role}": take(f"long_estacion_{role}", tolerant("double")),
        }

    return {
        "id_recorrido": take("Id_recorrido" if tokens else "id_recorrido", *token, strict("bigint")),
        "id_usuario": take("id_usuario", user_step, strict("bigint")),
        "duracion_seg": take("duracion_recorrido", duration),
        "fecha_origen": take("fecha_origen_recorrido", strict("timestamp_ntz")),
        "fecha_destino": take("fecha_destino_recorrido", tolerant("timestamp_ntz")),
        **station("origen"),
        **station("destino"),
        "modelo_bicicleta": take("modelo_bicicleta"),
        "genero_usuario": take(gender),
        "anio_archivo": literal(year, "smallint"),
    }


def user_fields(year: int, native: bool) -> dict[str, Field]:
    """How a year's user headers and formats map to the silver columns."""
    if year < 2024:
        dni = take("Customer.Has.Dni..Yes...No.", map_values(DNI_CODES, "boolean"))
    else:
        dni = literal(None, "boolean")  # not provided that year
    return {
        "id_usuario": take("ID_usuario" if year < 2024 else "id_usuario", strict("bigint")),
        "genero_usuario": take("genero_usuario"),
        "edad_usuario": take("edad_usuario", grouped_int(), null_outside(*AGE_RANGE)),
        "fecha_alta": take("fecha_alta", strict("date")),
        "hora_alta": take("hora_alta", time_of_day(native)),
        "tiene_dni": dni,
        "anio_archivo": literal(year, "smallint"),
    }


# ---- Tables -----------------------------------------------------------------


def age_band():
    return derive.band(F.col("edad_usuario"), BAND_EDGES, BAND_LABELS, UNKNOWN_BAND)


def dim_estacion(pairs: DataFrame) -> DataFrame:
    """Stations of either role; takes trips, or the pairs made of them."""
    roles = [(f"id_estacion_{r}", f"nombre_estacion_{r}") for r in ("origen", "destino")]
    return node_dim(pairs, roles, "id", "nombre")


def dim_fecha(trips: DataFrame) -> DataFrame:
    names = {"day": "dia", "month": "mes", "week": "semana", "year": "anio"}
    return calendar_dim(trips, "fecha_origen", names, "fecha_completa")


def dim_demografia(users: DataFrame) -> DataFrame:
    return segment_dim(users, F.col("genero_usuario"), age_band(), "genero", "rango_etario", UNKNOWN_BAND)


def station_pairs(trips: DataFrame) -> DataFrame:
    return pair_names(
        trips, "id_estacion_origen", "id_estacion_destino", "nombre_estacion_origen", "nombre_estacion_destino"
    )


def dim_recorrido(pairs: DataFrame) -> DataFrame:
    """Routes; takes trips, or the pairs made of them."""
    return pair_dim(
        pairs,
        "id_estacion_origen",
        "id_estacion_destino",
        "nombre_estacion_origen",
        "nombre_estacion_destino",
        "ruta",
        ROUTE_SEPARATOR,
    )


def trip_activity(trips: DataFrame, users: DataFrame, demografia: DataFrame) -> DataFrame:
    """Closed trips from a known station per day, segment and station pair: both facts sum from it.

    The destination may be NULL here; the users are joined once for both facts.
    """
    closed = trips.where((F.col("duracion_seg") > 0) & F.col("id_estacion_origen").isNotNull()).select(
        "id_usuario",
        derive.date_key(F.col("fecha_origen")).alias("id_fecha"),
        "id_estacion_origen",
        "id_estacion_destino",
        "duracion_seg",
    )
    segments = Lookup(demografia, ("genero", "rango_etario"), "id_demografia", null_safe=("genero",))
    attributes = {"genero": F.col("genero_usuario"), "rango_etario": age_band()}
    keyed = enrich_with_key(closed, users, "id_usuario", attributes, segments, {"rango_etario": UNKNOWN_BAND})
    return activity(
        keyed, ["id_fecha", "id_demografia", "id_estacion_origen", "id_estacion_destino"], "duracion_seg"
    )


def fct_viajes(totals: DataFrame, recorrido: DataFrame, numbering: str = "dense") -> DataFrame:
    return build_fact(
        totals.where(F.col("id_estacion_destino").isNotNull()),
        [Lookup(recorrido, ("id_estacion_origen", "id_estacion_destino"), "id_recorrido")],
        ["id_fecha", "id_demografia", "id_recorrido"],
        "cantidad",
        "minutos",
        complete=True,
        numbering=numbering,
    )


def fact_actividad(totals: DataFrame, numbering: str = "dense") -> DataFrame:
    keys = ["id_fecha", "id_demografia", "id_estacion"]
    per_node = coarsen(totals.withColumnRenamed("id_estacion_origen", "id_estacion"), keys)
    return build_fact(per_node, [], keys, "cantidad", numbering=numbering)


def ml_duracion_recorridos(trips: DataFrame) -> DataFrame:
    columns = TripColumns(
        id="id_recorrido",
        duration="duracion_seg",
        start="fecha_origen",
        start_lat="lat_estacion_origen",
        start_lon="long_estacion_origen",
        end_lat="lat_estacion_destino",
        end_lon="long_estacion_destino",
        category="modelo_bicicleta",
    )
    names = FeatureNames("distancia_km", "hora_origen", "dia_semana", "es_fin_de_semana", "mes")
    return feature_table(trips, columns, names)


# ---- Declared checks: fixed, what each table promises -----------------------

_KEYED = (NotNull("id"), Unique("id"))


def _foreign(column: str, parent: str) -> tuple:
    return (NotNull(column), Reference(column, parent, "id"))


CHECKS = {
    "stg_recorridos_2022": (NotNull("id_recorrido"), Unique("id_recorrido")),
    "stg_recorridos_2023": (NotNull("id_recorrido"), Unique("id_recorrido")),
    "stg_recorridos": (
        NotNull("id_recorrido"),
        Unique("id_recorrido"),
        NotNull("id_usuario"),
        NotNull("fecha_origen"),
        NotNull("id_estacion_origen"),
        NotNull("modelo_bicicleta"),
        Accepted("modelo_bicicleta", BIKE_MODELS),
        Accepted("genero_usuario", GENDERS, where="genero_usuario is not null"),
        NotNull("anio_archivo"),
        Accepted("anio_archivo", YEARS),
        RowCount(*TRIP_ROWS),
        Share("valid_duration", f"duracion_seg between 1 and {LONGEST_DURATION}", VALID_SHARE, "duracion_seg"),
    ),
    "stg_usuarios_2022": (NotNull("id_usuario"), Unique("id_usuario")),
    "stg_usuarios_2023": (NotNull("id_usuario"), Unique("id_usuario")),
    "stg_usuarios_2024": (NotNull("id_usuario"), Unique("id_usuario")),
    "stg_usuarios": (
        NotNull("id_usuario"),
        Unique("id_usuario"),
        NotNull("genero_usuario"),
        Accepted("genero_usuario", GENDERS),
        NotNull("fecha_alta"),
        NotNull("hora_alta"),
        NotNull("anio_archivo"),
        Accepted("anio_archivo", YEARS),
        RowCount(*USER_ROWS),
        Share("known_age", "edad_usuario is not null", VALID_SHARE, "edad_usuario"),
    ),
    "dim_estacion": (*_KEYED, NotNull("nombre")),
    "dim_fecha": (
        *_KEYED,
        NotNull("dia"),
        NotNull("mes"),
        NotNull("semana"),
        NotNull("anio"),
        Accepted("anio", YEARS),
        NotNull("fecha_completa"),
    ),
    "dim_demografia": (
        *_KEYED,
        Accepted("genero", GENDERS, where="genero is not null"),
        NotNull("rango_etario"),
        Accepted("rango_etario", (*BAND_LABELS, UNKNOWN_BAND)),
    ),
    "dim_recorrido": (
        *_KEYED,
        *_foreign("id_estacion_origen", "dim_estacion"),
        *_foreign("id_estacion_destino", "dim_estacion"),
        NotNull("ruta"),
    ),
    "fct_viajes": (
        *_KEYED,
        *_foreign("id_fecha", "dim_fecha"),
        *_foreign("id_demografia", "dim_demografia"),
        *_foreign("id_recorrido", "dim_recorrido"),
        NotNull("cantidad"),
        NotNull("minutos"),
    ),
    "fact_actividad": (
        *_KEYED,
        *_foreign("id_fecha", "dim_fecha"),
        *_foreign("id_demografia", "dim_demografia"),
        *_foreign("id_estacion", "dim_estacion"),
        NotNull("cantidad"),
    ),
}


# ---- Build ------------------------------------------------------------------


class Build:
    """Builds the lake layer by layer, each table read back from its Parquet files."""

    def __init__(
        self, spark: SparkSession, lake: Lake, numbering: str = "dense", partition_years: bool = False
    ):
        """``partition_years`` stores the silver unions as one partition per file year."""
        self.spark = spark
        self.lake = lake
        self.numbering = numbering
        self.partition_by = ("anio_archivo",) if partition_years else ()

    def table(self, name: str) -> DataFrame:
        """A stored table of any layer but raw, with its declared schema."""
        if name in GOLD:
            return self.lake.read(self.spark, GOLD_BI, name, GOLD[name])
        if name == "ml_duracion_recorridos":
            return self.lake.read(self.spark, GOLD_ML, name, FEATURES)
        schema = TRIPS if name.startswith("stg_recorridos") else users_schema(self.spark)
        union = name in ("stg_recorridos", "stg_usuarios")
        return self.lake.read(self.spark, SILVER, name, schema, partitioned=union and bool(self.partition_by))

    def raw(self, multiline: bool | None = None) -> None:
        for table, source in SOURCES.items():
            self.lake.mirror(self.spark, source, table, multiline)

    def silver(self) -> None:
        """Per-year tables and their unions; the unions read the per-year tables."""
        lake, spark = self.lake, self.spark
        users_as = users_schema(spark)
        for year in YEARS:
            trips = lake.read(spark, RAW, f"raw_recorridos_{year}")
            lake.write(harmonize(trips, trip_fields(year)), SILVER, f"stg_recorridos_{year}", TRIPS)
            users = lake.read(spark, RAW, f"raw_usuarios_{year}")
            fields = user_fields(year, native_time(spark))
            lake.write(harmonize(users, fields), SILVER, f"stg_usuarios_{year}", users_as)
        # Rows of two years differ in their year: copies are looked for within each.
        trips = union_vintages([drop_copies(self.table(f"stg_recorridos_{y}"), key="id_recorrido") for y in YEARS])
        lake.write(trips, SILVER, "stg_recorridos", TRIPS, self.partition_by)
        users = union_vintages([self.table(f"stg_usuarios_{y}") for y in YEARS])
        lake.write(users, SILVER, "stg_usuarios", users_as, self.partition_by)

    def gold_bi(self) -> None:
        """Dimensions first; the facts look their keys up in the stored dimensions."""
        trips, users = self.table("stg_recorridos"), self.table("stg_usuarios")
        pairs = materialize(station_pairs(trips), "pairs")
        self._write_gold("dim_estacion", dim_estacion(pairs))
        self._write_gold("dim_fecha", dim_fecha(trips))
        self._write_gold("dim_demografia", dim_demografia(users))
        self._write_gold("dim_recorrido", dim_recorrido(pairs))
        totals = materialize(trip_activity(trips, users, self.table("dim_demografia")), "activity")
        self._write_gold("fct_viajes", fct_viajes(totals, self.table("dim_recorrido"), self.numbering))
        self._write_gold("fact_actividad", fact_actividad(totals, self.numbering))

    def gold_ml(self) -> None:
        features = ml_duracion_recorridos(self.table("stg_recorridos"))
        self.lake.write(features, GOLD_ML, "ml_duracion_recorridos", FEATURES)

    def _write_gold(self, name: str, df: DataFrame) -> None:
        self.lake.write(df, GOLD_BI, name, GOLD[name])

    def checks(self, tables: tuple[str, ...] | None = None, skip: tuple[type, ...] = ()) -> DataFrame:
        """Results of the declared checks of the stored tables."""
        names = tuple(CHECKS) if tables is None else tables
        needed = {c.parent for name in names for c in CHECKS[name] if isinstance(c, Reference)}
        parents = {name: self.table(name) for name in needed}
        results = []
        for name in names:
            declared = [c for c in CHECKS[name] if not isinstance(c, skip)]
            results.append(run_checks(self.table(name), name, declared, parents))
        return reduce(DataFrame.unionByName, results)

    def run(self, stop_on_failure: bool = True, multiline: bool | None = None) -> None:
        """The whole build; with ``stop_on_failure`` a layer's failed checks end it before the next layer."""
        self.raw(multiline)
        self.silver()
        if stop_on_failure:
            require_passed(self.checks(tuple(t for t in CHECKS if t.startswith("stg_"))))
        self.gold_bi()
        self.gold_ml()
        if stop_on_failure:
            require_passed(self.checks(tuple(GOLD)))
