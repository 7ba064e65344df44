"""The bike-share build from CSV to gold, on source files written from the supplied tables.

All orders become trips and all customers become users, written as six CSV sources with the headers, tokens and number
formats of their years.  The oracles compute every table from the orders and
customers directly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.checks import (
    accepted_sql, null_sql, reference_sql, row_count_sql, share_sql, union, unique_sql,
)
from catalogue.registry import query
from catalogue.sources import fresh_lake
from catalogue.views import SQL_USER, sql, table, trip_user
from lakeloom.operators import report
from lakeloom.plans import trips_lakehouse as plan
from lakeloom.sources.csv_text import write_text_csv
from lakeloom.sources.layers import GOLD_BI, RAW, Lake, sql_over_files

FIRST_DAY = "2022-01-01"
DAYS = 1096

# ---- source files -----------------------------------------------------------


def start_of_trip() -> Column:
    days = F.date_diff("o_orderdate", F.lit("1995-01-01").cast("date")) % DAYS
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), days).cast("timestamp_ntz")
    return day + F.make_dt_interval(secs=(F.col("o_orderkey") * 37 % 86400).cast("decimal(18,6)"))


def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.when(F.col("o_orderstatus") == "P", 0).otherwise((F.floor("o_totalprice") % 9000).cast("int"))
    price = F.col("o_totalprice")
    return (
        table(spark, sf_dir, "orders")
        .withColumns({"start": start_of_trip(), "seconds": seconds})
        .select(
            F.col("o_orderkey").alias("trip"),
            trip_user().alias("user"),
            F.when(price >= 5000, F.col("seconds")).alias("seconds"),
            "start",
            F.when(
                F.col("o_orderstatus") != "P",
                F.col("start") + F.make_dt_interval(secs=F.col("seconds").cast("decimal(18,6)")),
            ).alias("end"),
            (F.col("o_orderkey") % 25).alias("origin"),
            F.when(price < 490000, (F.col("o_orderkey") * 7 + F.col("o_custkey")) % 25).alias("dest"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "FIT").otherwise("ICONIC").alias("model"),
            F.when(F.col("o_orderstatus") == "F", "FEMALE").when(F.col("o_orderstatus") == "O", "MALE").alias("gender"),
            F.year("start").alias("year"),
        )
    )


def station_columns(role: str, node: str, token: str) -> list[Column]:
    key = F.col(node).cast("string")
    return [
        F.concat(key, F.lit(token)).alias(f"id_estacion_{role}"),
        F.concat(F.lit("NATION_"), key).alias(f"nombre_estacion_{role}"),
        F.concat(F.lit("Street "), key, F.lit(", \"corner\"")).alias(f"direccion_estacion_{role}"),
        (F.lit(-34.5) - F.col(node) / 100.0).cast("string").alias(f"lat_estacion_{role}"),
        (F.lit(-58.3) - F.col(node) / 90.0).cast("string").alias(f"long_estacion_{role}"),
    ]


def trip_file(trips: DataFrame, year: int) -> DataFrame:
    """One year's trips under that year's headers; some lines of 2024 come twice."""
    old = year < 2024
    token = plan.ID_TOKEN if old else ""
    user_suffix = plan.ID_TOKEN if old else plan.FLOAT_ARTIFACT
    seconds = F.format_number("seconds", 0) if old else F.col("seconds").cast("string")
    of_year = trips.where(F.col("year") == year)
    if year == 2024:
        of_year = of_year.unionByName(of_year.where("gender = 'FEMALE'"))
    junk = {2022: ["column00", "X"], 2023: ["column00"], 2024: []}[year]
    return of_year.select(
        *[F.col("trip").alias(name) for name in junk],
        F.concat(F.col("trip").cast("string"), F.lit(token)).alias("Id_recorrido" if old else "id_recorrido"),
        F.concat(F.col("user").cast("string"), F.lit(user_suffix)).alias("id_usuario"),
        F.coalesce(seconds, F.lit("n/a")).alias("duracion_recorrido"),
        F.col("start").alias("fecha_origen_recorrido"),
        F.col("end").alias("fecha_destino_recorrido"),
        *station_columns("origen", "origin", token),
        *station_columns("destino", "dest", token),
        F.col("model").alias("modelo_bicicleta"),
        F.col("gender").alias({2022: "Género", 2023: "género", 2024: "genero"}[year]),
    )


def clean_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    age = 10 + key % 95
    seconds = key * 41 % 86400
    clock = [(seconds / unit).cast("bigint") % top for unit, top in ((3600, 24), (60, 60), (1, 60))]
    signed = F.date_add(F.lit(FIRST_DAY).cast("date"), (key % DAYS).cast("int"))
    gender = F.when(segment == "BUILDING", "FEMALE").when(segment == "MACHINERY", "MALE").otherwise("OTHER")
    return (
        table(spark, sf_dir, "customer")
        .select(
            key.alias("user"),
            gender.alias("gender"),
            F.when(segment == "HOUSEHOLD", F.format_number(1000 + age, 0)).otherwise(age.cast("string")).alias("age"),
            signed.alias("signed"),
            F.format_string("%02d:%02d:%02d", *clock).alias("clock"),
            F.when(F.col("c_nationkey") < 10, "Yes").when(F.col("c_nationkey") < 20, "No").alias("dni"),
            F.year(signed).alias("year"),
        )
    )


def user_file(users: DataFrame, year: int) -> DataFrame:
    old = year < 2024
    columns = [
        F.col("user").alias("ID_usuario" if old else "id_usuario"),
        F.col("gender").alias("genero_usuario"),
        F.col("age").alias("edad_usuario"),
        F.col("signed").alias("fecha_alta"),
        F.col("clock").alias("hora_alta"),
    ]
    if old:
        columns.append(F.col("dni").alias("Customer.Has.Dni..Yes...No."))
    return users.where(F.col("year") == year).select(*columns)


def write_sources(spark: SparkSession, sf_dir: str, lake: Lake) -> None:
    trips, users = clean_trips(spark, sf_dir), clean_users(spark, sf_dir)
    for raw, source in plan.SOURCES.items():
        year = int(raw[-4:])
        file = trip_file(trips, year) if "recorridos" in raw else user_file(users, year)
        write_text_csv(file, lake.source_path(source))


_BUILT: dict[tuple[str, str], plan.Build] = {}


def built(spark: SparkSession, sf_dir: str) -> plan.Build:
    """The finished lake of a scale factor, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        lake = fresh_lake(spark, "lake")
        write_sources(spark, sf_dir, lake)
        build = plan.Build(spark, lake)
        build.run(stop_on_failure=False)
        _BUILT[key] = build
    return _BUILT[key]


# ---- the same in SQL --------------------------------------------------------

SQL_T0 = f"""
t0 as (
  select *, date '{FIRST_DAY}' + cast(date_diff('day', date '1995-01-01', cast(o_orderdate as date)) % {DAYS} as integer)
              + to_seconds(o_orderkey * 37 % 86400) as start_at,
         case when o_orderstatus = 'P' then 0 else cast(cast(floor(o_totalprice) as bigint) % 9000 as integer) end as secs
  from orders)"""

SQL_LAKE_TRIPS = f"""
lake_trips as (
  select o_orderkey as id_recorrido, {SQL_USER} as id_usuario, case when o_totalprice >= 5000 then secs end as duracion_seg,
         start_at as fecha_origen, case when o_orderstatus <> 'P' then start_at + to_seconds(secs) end as fecha_destino,
         cast(o_orderkey % 25 as smallint) as o,
         cast(case when o_totalprice < 490000 then (o_orderkey * 7 + o_custkey) % 25 end as smallint) as d,
         case when left(o_orderpriority, 1) in ('1', '2') then 'FIT' else 'ICONIC' end as modelo_bicicleta,
         (map {{'F': 'FEMALE', 'O': 'MALE'}})[o_orderstatus] as genero_usuario,
         cast(year(start_at) as smallint) as anio_archivo
  from t0)"""

SQL_LAKE_USERS = f"""
lake_users as (
  select c_custkey as id_usuario,
         coalesce((map {{'BUILDING': 'FEMALE', 'MACHINERY': 'MALE'}})[c_mktsegment], 'OTHER') as genero_usuario,
         case when c_mktsegment <> 'HOUSEHOLD' and c_custkey % 95 >= 6 and c_custkey % 95 <= 90
              then cast(10 + c_custkey % 95 as integer) end as edad_usuario,
         date '{FIRST_DAY}' + cast(c_custkey % {DAYS} as integer) as fecha_alta,
         strftime(timestamp '2000-01-01' + to_seconds(c_custkey * 41 % 86400), '%H:%M:%S') as hora_alta, c_nationkey
  from customer)"""

SQL_LAKE_STAR = """
lake_bands(lo, hi, label) as (
  values (16, 25, '16-25'), (26, 35, '26-35'), (36, 50, '36-50'), (51, 65, '51-65'), (66, 100, '66+')),
lake_banded as (
  select u.id_usuario, u.genero_usuario as genero, coalesce(b.label, 'Desconocido') as rango_etario
  from lake_users u left join lake_bands b on u.edad_usuario >= b.lo and u.edad_usuario <= b.hi),
lake_segments as (
  select dense_rank() over (order by genero nulls last, rango_etario) as id, genero, rango_etario
  from (select distinct genero, rango_etario from lake_banded union all select null, 'Desconocido')),
lake_routes as (
  select dense_rank() over (order by o, d) as id, o, d from (select distinct o, d from lake_trips where d is not null)),
lake_closed as (
  select cast(strftime(t.fecha_origen, '%Y%m%d') as integer) as id_fecha, s.id as id_demografia, t.o, t.d, t.duracion_seg
  from lake_trips t left join lake_banded b on b.id_usuario = t.id_usuario
  join lake_segments s on s.genero is not distinct from b.genero
                      and s.rango_etario = coalesce(b.rango_etario, 'Desconocido')
  where t.duracion_seg > 0),
lake_fct as (
  select c.id_fecha, c.id_demografia, r.id as id_recorrido, count(*) as cantidad,
         cast(round_even(sum(c.duracion_seg) / cast(count(*) as double) / 60, 0) as integer) as minutos
  from lake_closed c join lake_routes r on r.o = c.o and r.d = c.d group by all),
lake_act as (
  select id_fecha, id_demografia, o as id_estacion, count(*) as cantidad from lake_closed group by all)"""

LAKE = (SQL_T0, SQL_LAKE_TRIPS, SQL_LAKE_USERS, SQL_LAKE_STAR)


# The raw tables' texts, as the sources write them.
SQL_RAW = """
raw_trips as (
  select anio_archivo as y, id_recorrido || case when anio_archivo < 2024 then 'BAEcobici' else '' end as key,
         id_usuario || case when anio_archivo < 2024 then 'BAEcobici' else '.0' end as id_usuario,
         case when duracion_seg is null then 'n/a' when anio_archivo = 2024 then cast(duracion_seg as varchar)
              else format('{:,}', duracion_seg) end as amount,
         modelo_bicicleta as kind, genero_usuario as gender
  from lake_trips
  union all
  select anio_archivo, cast(id_recorrido as varchar), id_usuario || '.0',
         coalesce(cast(duracion_seg as varchar), 'n/a'), modelo_bicicleta, genero_usuario
  from lake_trips where anio_archivo = 2024 and genero_usuario = 'FEMALE'),
raw_users as (
  select year(fecha_alta) as y, cast(id_usuario as varchar) as key, hora_alta,
         case when household then format('{:,}', 1000 + 10 + id_usuario % 95)
              else cast(10 + id_usuario % 95 as varchar) end as amount,
         case when year(fecha_alta) < 2024 then case when c_nationkey < 10 then 'Yes' when c_nationkey < 20 then 'No' end
         end as kind, genero_usuario as gender
  from (select u.*, c.c_mktsegment = 'HOUSEHOLD' as household from lake_users u join customer c on c_custkey = id_usuario))"""


@query(sql("""
select 'raw_recorridos_' || y as table_name, key, id_usuario as other, amount, kind, gender, count(*) as n_rows
from raw_trips group by all
union all select 'raw_usuarios_' || y, key, hora_alta, amount, kind, gender, count(*) from raw_users group by all""",
SQL_T0, SQL_LAKE_TRIPS, SQL_LAKE_USERS, SQL_RAW))
def lake_raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of all six mirrored files, with how often a row occurs: copies are still in."""
    lake = built(spark, sf_dir).lake
    parts = []
    for year in plan.YEARS:
        old = year < 2024
        trips = lake.read(spark, RAW, f"raw_recorridos_{year}")
        users = lake.read(spark, RAW, f"raw_usuarios_{year}")
        gender = {2022: "Género", 2023: "género", 2024: "genero"}[year]
        kind = F.col("`Customer.Has.Dni..Yes...No.`") if old else F.lit(None).cast("string")
        columns = {
            f"raw_recorridos_{year}": (
                trips, "Id_recorrido" if old else "id_recorrido", "id_usuario", "duracion_recorrido",
                F.col("modelo_bicicleta"), gender,
            ),
            f"raw_usuarios_{year}": (
                users, "ID_usuario" if old else "id_usuario", "hora_alta", "edad_usuario", kind, "genero_usuario",
            ),
        }
        for name, (raw, key, other, amount, own, sex) in columns.items():
            row = raw.select(
                F.lit(name).alias("table_name"), F.col(key).alias("key"), F.col(other).alias("other"),
                F.col(amount).alias("amount"), own.alias("kind"), F.col(sex).alias("gender"),
            )
            parts.append(row)
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy(*every.columns).agg(F.count("*").alias("n_rows"))


def station_sql(role: str, node: str) -> str:
    return (
        f"{node} as id_estacion_{role}, 'NATION_' || {node} as nombre_estacion_{role}, "
        f"'Street ' || {node} || ', \"corner\"' as direccion_estacion_{role}, "
        f"round(-34.5e0 - {node} / 100e0, 6) as lat_estacion_{role}, "
        f"round(-58.3e0 - {node} / 90e0, 6) as long_estacion_{role}"
    )


@query(sql(f"""
select id_recorrido, id_usuario, duracion_seg, fecha_origen, fecha_destino, {station_sql("origen", "o")},
       {station_sql("destino", "d")}, modelo_bicicleta, genero_usuario, anio_archivo
from lake_trips""", SQL_T0, SQL_LAKE_TRIPS))
def lake_silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips in the canonical schema, copies removed."""
    trips = built(spark, sf_dir).table("stg_recorridos")
    places = [c for c in trips.columns if c.startswith(("lat_", "long_"))]
    return trips.withColumns({c: F.round(c, 6) for c in places})


@query(sql("""
select id_usuario, genero_usuario, edad_usuario, fecha_alta, hora_alta,
       case when year(fecha_alta) = 2024 or c_nationkey >= 20 then null else c_nationkey < 10 end as tiene_dni,
       cast(year(fecha_alta) as smallint) as anio_archivo from lake_users""", SQL_LAKE_USERS))
def lake_silver_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All users in the canonical schema."""
    return built(spark, sf_dir).table("stg_usuarios").withColumn("hora_alta", F.col("hora_alta").cast("string"))


@query(sql("""
select distinct o as id, 'NATION_' || o as nombre from lake_trips""", SQL_T0, SQL_LAKE_TRIPS))
def lake_dim_estacion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations."""
    return built(spark, sf_dir).table("dim_estacion")


@query(sql("""
select distinct cast(strftime(fecha_origen, '%Y%m%d') as integer) as id, cast(day(fecha_origen) as integer) as dia,
       cast(month(fecha_origen) as integer) as mes, cast(weekofyear(fecha_origen) as integer) as semana,
       cast(year(fecha_origen) as integer) as anio, cast(fecha_origen as date) as fecha_completa
from lake_trips""", SQL_T0, SQL_LAKE_TRIPS))
def lake_dim_fecha(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days."""
    return built(spark, sf_dir).table("dim_fecha")


@query(sql("select * from lake_segments", *LAKE))
def lake_dim_demografia(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments."""
    return built(spark, sf_dir).table("dim_demografia")


@query(sql("""
select id, o as id_estacion_origen, d as id_estacion_destino, 'NATION_' || o || ' → NATION_' || d as ruta
from lake_routes""", *LAKE))
def lake_dim_recorrido(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes."""
    return built(spark, sf_dir).table("dim_recorrido")


@query(sql("select * from lake_fct", *LAKE))
def lake_fct_viajes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route fact; its own key is checked by ``lake_fact_keys``."""
    return built(spark, sf_dir).table("fct_viajes").drop("id")


@query(sql("select * from lake_act", *LAKE))
def lake_fact_actividad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The node fact; its own key is checked by ``lake_fact_keys``."""
    return built(spark, sf_dir).table("fact_actividad").drop("id")


@query(sql("""
select 'fct_viajes' as fact, cast(1 as bigint) as first_id, count(*) as last_id, count(*) as n_ids from lake_fct
union all select 'fact_actividad', 1, count(*), count(*) from lake_act""", *LAKE))
def lake_fact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts' own keys run 1..n, each once."""
    build = built(spark, sf_dir)

    def summary(fact: str) -> DataFrame:
        ids = build.table(fact).groupBy("id").agg(F.count("*").alias("rows")).where(F.col("rows") == 1)
        return ids.agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count("*").alias("n_ids")).select(
            F.lit(fact).alias("fact"), "*"
        )

    return summary("fct_viajes").unionByName(summary("fact_actividad"))


@query(sql("""
select id_recorrido, duracion_seg,
       round(2 * 6371e0 * atan2(sqrt(h), sqrt(1e0 - h)), 6) as distancia_km, hour(fecha_origen) as hora_origen,
       isodow(fecha_origen) as dia_semana, cast(isodow(fecha_origen) > 5 as integer) as es_fin_de_semana,
       month(fecha_origen) as mes, modelo_bicicleta
from (select *, pow(sin(radians((-34.5e0 - d / 100e0) - (-34.5e0 - o / 100e0)) / 2), 2)
             + cos(radians(-34.5e0 - o / 100e0)) * cos(radians(-34.5e0 - d / 100e0))
             * pow(sin(radians((-58.3e0 - d / 90e0) - (-58.3e0 - o / 90e0)) / 2), 2) as h
      from lake_trips where duracion_seg > 60 and duracion_seg < 7200 and d is not null)""", SQL_T0, SQL_LAKE_TRIPS))
def lake_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training table."""
    features = built(spark, sf_dir).table("ml_duracion_recorridos")
    return features.withColumn("distancia_km", F.round("distancia_km", 6))


@query(sql("""
select f.anio, f.mes, cast(sum(v.cantidad) as bigint) as total_viajes, round(avg(v.minutos), 6) as minutos_prom
from lake_fct v join (select distinct cast(strftime(fecha_origen, '%Y%m%d') as integer) as id,
       cast(year(fecha_origen) as integer) as anio, cast(month(fecha_origen) as integer) as mes from lake_trips) f
  on f.id = v.id_fecha group by all""", *LAKE))
def lake_report_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and mean minutes per month out of the gold tables."""
    build = built(spark, sf_dir)
    totals = report.rollup(
        build.table("fct_viajes"),
        [report.Join(build.table("dim_fecha"), "id_fecha", {"anio": "anio", "mes": "mes"})],
        ["anio", "mes"],
        report.Measures("cantidad", "total_viajes", "minutos", "minutos_prom"),
    )
    return report.ordered(totals.withColumn("minutos_prom", F.round("minutos_prom", 6)), ["anio", "mes"])


def gold_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """SQL in which ``{table}`` stands for a gold table's path."""
    lake = built(spark, sf_dir).lake
    return sql_over_files(spark, text, **{table: lake.table_path(GOLD_BI, table) for table in plan.GOLD})


@query(sql("""
select 'NATION_' || id_estacion as nombre, cast(sum(cantidad) as bigint) as total_viajes from lake_act
group by all order by total_viajes desc, nombre limit 10""", *LAKE))
def lake_sql_top_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten busiest stations, as SQL over the gold files."""
    return gold_sql(
        spark,
        sf_dir,
        """
        select e.nombre, sum(a.cantidad) as total_viajes
        from {fact_actividad} a inner join {dim_estacion} e on a.id_estacion = e.id
        group by e.nombre order by 2 desc, 1 limit 10""",
    )


@query(sql("""
select s.rango_etario, cast(sum(f.cantidad) as bigint) as total_viajes
from lake_fct f, lake_segments s where s.id = f.id_demografia group by all""", *LAKE))
def lake_sql_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per age band, as SQL over the gold files."""
    return gold_sql(
        spark,
        sf_dir,
        """
        select d.rango_etario, sum(f.cantidad) as total_viajes
        from {fct_viajes} f inner join {dim_demografia} d on f.id_demografia = d.id
        group by d.rango_etario order by 2 desc""",
    )


@query(sql("""
select o.nombre as origen, d.nombre as destino, cast(sum(f.cantidad) as bigint) as total_viajes
from lake_fct f join lake_routes r on r.id = f.id_recorrido
join (select distinct o as id, 'NATION_' || o as nombre from lake_trips) o on o.id = r.o
join (select distinct d as id, 'NATION_' || d as nombre from lake_trips) d on d.id = r.d group by all""", *LAKE))
def lake_sql_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per pair of stations, the station dimension joined in two roles."""
    return gold_sql(
        spark,
        sf_dir,
        """
        select o.nombre as origen, d.nombre as destino, sum(f.cantidad) as total_viajes
        from {fct_viajes} f
        inner join {dim_recorrido} r on f.id_recorrido = r.id
        inner join {dim_estacion} o on r.id_estacion_origen = o.id
        inner join {dim_estacion} d on r.id_estacion_destino = d.id
        group by o.nombre, d.nombre""",
    )


# The checked tables under their own names.
SQL_TABLES = """
stg_recorridos as (select *, o as id_estacion_origen from lake_trips),
stg_recorridos_2022 as (select * from lake_trips where anio_archivo = 2022),
stg_recorridos_2023 as (select * from lake_trips where anio_archivo = 2023),
stg_usuarios as (select *, cast(year(fecha_alta) as smallint) as anio_archivo from lake_users),
stg_usuarios_2022 as (select * from stg_usuarios where anio_archivo = 2022),
stg_usuarios_2023 as (select * from stg_usuarios where anio_archivo = 2023),
stg_usuarios_2024 as (select * from stg_usuarios where anio_archivo = 2024),
dim_estacion as (select distinct o as id, 'NATION_' || o as nombre from lake_trips),
dim_fecha as (
  select distinct cast(strftime(fecha_origen, '%Y%m%d') as integer) as id, day(fecha_origen) as dia,
         month(fecha_origen) as mes, weekofyear(fecha_origen) as semana, year(fecha_origen) as anio,
         cast(fecha_origen as date) as fecha_completa
  from lake_trips),
dim_demografia as (select * from lake_segments),
dim_recorrido as (select id, o as id_estacion_origen, d as id_estacion_destino, o || '-' || d as ruta from lake_routes),
fct_viajes as (select row_number() over () as id, * from lake_fct),
fact_actividad as (select row_number() over () as id, * from lake_act)"""

YEAR_LIST = "2022, 2023, 2024"
GENDER_LIST = "'MALE', 'FEMALE', 'OTHER'"


def keyed_sql(name: str, column: str = "id") -> list[str]:
    return [null_sql(name, column), unique_sql(name, column)]


def foreign_sql(name: str, column: str, parent: str) -> list[str]:
    return [null_sql(name, column), reference_sql(name, column, parent, "id")]


CHECKED = [
    *[part for t in ("stg_recorridos_2022", "stg_recorridos_2023", "stg_recorridos") for part in keyed_sql(t, "id_recorrido")],
    *[null_sql("stg_recorridos", c) for c in ("id_usuario", "fecha_origen", "id_estacion_origen", "modelo_bicicleta")],
    accepted_sql("stg_recorridos", "modelo_bicicleta", "'FIT', 'ICONIC'"),
    accepted_sql("stg_recorridos", "genero_usuario", GENDER_LIST, "genero_usuario is not null"),
    null_sql("stg_recorridos", "anio_archivo"), accepted_sql("stg_recorridos", "anio_archivo", YEAR_LIST),
    row_count_sql("stg_recorridos", 8000000, 10000000),
    share_sql("valid_duration", "stg_recorridos", "duracion_seg", "duracion_seg >= 1 and duracion_seg <= 86400", 0.99),
    *[part for y in ("_2022", "_2023", "_2024", "") for part in keyed_sql(f"stg_usuarios{y}", "id_usuario")],
    *[null_sql("stg_usuarios", c) for c in ("genero_usuario", "fecha_alta", "hora_alta", "anio_archivo")],
    accepted_sql("stg_usuarios", "genero_usuario", GENDER_LIST), accepted_sql("stg_usuarios", "anio_archivo", YEAR_LIST),
    row_count_sql("stg_usuarios", 400000, 500000),
    share_sql("known_age", "stg_usuarios", "edad_usuario", "edad_usuario is not null", 0.99),
    *keyed_sql("dim_estacion"), null_sql("dim_estacion", "nombre"), *keyed_sql("dim_fecha"),
    *[null_sql("dim_fecha", c) for c in ("dia", "mes", "semana", "anio", "fecha_completa")],
    accepted_sql("dim_fecha", "anio", YEAR_LIST), *keyed_sql("dim_demografia"),
    accepted_sql("dim_demografia", "genero", GENDER_LIST, "genero is not null"), null_sql("dim_demografia", "rango_etario"),
    accepted_sql("dim_demografia", "rango_etario", "'16-25', '26-35', '36-50', '51-65', '66+', 'Desconocido'"),
    *keyed_sql("dim_recorrido"), *foreign_sql("dim_recorrido", "id_estacion_origen", "dim_estacion"),
    *foreign_sql("dim_recorrido", "id_estacion_destino", "dim_estacion"), null_sql("dim_recorrido", "ruta"),
    *[part for t in ("fct_viajes", "fact_actividad") for part in (
        *keyed_sql(t), *foreign_sql(t, "id_fecha", "dim_fecha"), *foreign_sql(t, "id_demografia", "dim_demografia"),
        null_sql(t, "cantidad"))],
    *foreign_sql("fct_viajes", "id_recorrido", "dim_recorrido"), null_sql("fct_viajes", "minutos"),
    *foreign_sql("fact_actividad", "id_estacion", "dim_estacion"),
]


@query(sql(union(*CHECKED), *LAKE, SQL_TABLES))
def lake_checks_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdicts of all declared checks on the finished lake, with what they counted."""
    return built(spark, sf_dir).checks()


@query(sql("""
select 'row_count' as check_name, 'stg_recorridos' as table_name, cast(null as varchar) as column_name,
       cast(1 as bigint) as n_bad, count(*) as n_rows from lake_trips
  having not (count(*) >= 8000000 and count(*) <= 10000000)
union all select 'valid_duration', 'stg_recorridos', 'duracion_seg',
       count(*) - count(*) filter (where duracion_seg >= 1 and duracion_seg <= 86400), count(*) from lake_trips
  having count(*) filter (where duracion_seg >= 1 and duracion_seg <= 86400) < 0.99 * count(*)
union all select 'row_count', 'stg_usuarios', null, 1, count(*) from lake_users
  having not (count(*) >= 400000 and count(*) <= 500000)
union all select 'known_age', 'stg_usuarios', 'edad_usuario', count(*) - count(edad_usuario), count(*) from lake_users
  having count(edad_usuario) < 0.99 * count(*)""", SQL_T0, SQL_LAKE_TRIPS, SQL_LAKE_USERS))
def lake_checks_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks the finished lake fails, with their counts."""
    return built(spark, sf_dir).checks().where(~F.col("passed")).drop("passed")
