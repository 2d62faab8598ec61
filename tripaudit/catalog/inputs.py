"""Trip-order inputs derived from the given tables (see ``FIXTURES.md`` §2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripaudit.operators.filters import pure_zero, valid_trips
from tripaudit.operators.joins import attach_versions, latest_ext, valid_with_latest_ext
from tripaudit.operators.rows import ID

FIRST_DAY, LAST_DAY = 20170320, 20170329
DAYS = list(range(FIRST_DAY, LAST_DAY + 1))
SUSP_DAY = 20170327
E0 = 1489939200  # 2017-03-20 00:00 Asia/Shanghai

# Order of versions of one order; update time alone has ties.
ORDER = ("update_time", "l_linenumber", "l_extendedprice")


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up in the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _day_number(col: str) -> str:
    return f"datediff(cast({col} as date), date'1970-01-01')"


def fx_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lines = table(spark, sf_dir, "lineitem")
    joined = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    )
    start = (
        f"{E0} + cast(datediff(cast(l_shipdate as date), date'1995-01-01') as bigint) % 10 * 86400"
        " + (l_orderkey * 7919 + l_partkey * 104729) % 86400"
    )
    first = joined.selectExpr(
        "l_orderkey as service_order_id",
        "n_name as city",
        "if(l_linestatus = 'F', 7, 8) as status",
        "concat('p', l_partkey, if(l_linenumber = 7, '测试', '')) as passenger_name",
        "l_suppkey as driver_id",
        f"{start} as start_time",
        "116.0D + (l_partkey % 100) / 1000 as start_longitude",
        "39.9D + (l_suppkey % 100) / 1000 as start_latitude",
        "cast(if(l_returnflag = 'N', 1 + l_orderkey % 50, int(l_quantity)) as int) as actual_time_length",
        "greatest(int(round(l_tax * 100)) - 2, 0) * 750 as dependable_distance",
        "greatest(int(round(l_discount * 100)) - 2, 0) * 500 as system_distance",
        f"cast({_day_number('l_shipdate')} as bigint) * 86400 + l_linenumber as update_time",
        "l_partkey",
        "l_linenumber",
        "l_extendedprice",
        "int(l_quantity) as _minutes",
    )
    return first.selectExpr(
        *[c for c in first.columns if not c.startswith("_") and c != "l_partkey"],
        "start_time - l_partkey % 1500 as arrival_time",
        "start_time + (_minutes - 1) * 60 + l_partkey % 60 as end_time",
        "start_longitude + (l_linenumber - 1) * 0.01D as expect_start_longitude",
        "start_latitude + (_minutes % 10) * 0.005D as expect_start_latitude",
        "start_longitude + (l_linenumber - 1) * 0.03D as expect_end_longitude",
        f"cast({FIRST_DAY} + (start_time - {E0}) div 86400 as int) as dt",
    )


def fx_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = table(spark, sf_dir, "orders").withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
    app = "o_custkey % 5"
    suffix = "if(v = 1 and o_custkey % 3 = 0, '_b', '')"
    return versions.selectExpr(
        "o_orderkey as service_order_id",
        f"""case substring(o_orderpriority, 1, 1)
              when '1' then ''
              when '2' then concat({app}, '_1', {suffix})
              when '3' then concat({app}, '_2', {suffix})
              when '4' then concat({app}, '_9', {suffix})
              else concat('v', {app}, {suffix}) end as driver_version""",
        "cast(1 + o_orderkey % 50 as int) as runtime",
        """if(o_custkey % 17 = 0, 'not json',
              concat('{"distance":"', cast(floor(o_totalprice / 50) as bigint), '"}')) as estimate_snap""",
        f"cast({_day_number('o_orderdate')} as bigint) * 86400 + v as update_time",
        f"cast(case when v = 0 then {FIRST_DAY} + (o_orderkey + o_custkey) % 10 when o_custkey % 2 = 0 then {LAST_DAY}"
        " else 20170310 end as int) as dt",
    )


def fx_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All labels; the codes of the last five nations are other ones, so their orders have none."""
    code = "if(n_nationkey < 20, n_name, concat('old ', n_name)) as code"
    return table(spark, sf_dir, "nation").selectExpr(code, "concat('CITY_', n_nationkey) as label")


def _micros(col: str) -> str:
    return f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {col})"


def fx_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as device_id",
        "user_id",
        "if(event_type = 'error', 0, 1) as status",
        "if(event_id % 4 = 0, 'PA', 'DR') as user_type",
        f"{_micros('ts')} as update_time",
        "get_json_object(props, '$.k') as app_version",
        "event_type as os_type",
        "concat('v', event_id % 7) as os_version",
        "concat('os ', event_type) as os_name",
        "concat('type ', event_id % 3) as device_type",
    )


def fx_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as service_order_id",
        "if(o_custkey % 10 = 0, 'T', 'F') as is_rc",
        "cast(20170315 + o_orderkey % 15 as int) as dt",
    )


def fx_distance_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    km = "cast(floor(o_totalprice) as bigint) div 1000"
    parts = [
        "'a'", "'b'", "cast(o_orderkey as string)", "'c'",
        f"if(o_custkey % 7 = 0, 'NULL', cast({km} as string))", "'d'",
        f"cast({km} + 1 as string)", "'e'", f"cast({km} + 2 as string)", f"cast({km} + 3 as string)",
        "'f'", "'g'", "'h'",
        "case o_custkey % 3 when 0 then '1' when 1 then '0' else 'x' end",
    ]
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(20170320 + o_orderkey % 10 as int) as log_day", f"concat_ws('\\t', {', '.join(parts)}) as value"
    )


def fx_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    sized = users.selectExpr(
        "user_id", "cast(2592000 / case user_id % 3 when 0 then 720 when 1 then 4320 else 1440 end as bigint) as span"
    )
    timed = sized.selectExpr(
        "user_id",
        f"{E0} + cast(floor(span * 0.1D) as bigint) as start_time",
        f"{E0} + cast(floor(span * 0.9D) as bigint) as end_time",
    )
    return timed.selectExpr(
        "user_id as service_order_id",
        "start_time - (user_id % 20) * 60 as arrival_time",
        "start_time",
        "end_time",
        "if(user_id % 11 = 0, 0L, 1000 + user_id * 100) as predict_distance",
        "(user_id % 13) / 10D * (1 + user_id * 0.1D) as system_distance",
    )


def fx_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fixes."""
    div = "case user_id % 3 when 0 then 720 when 1 then 4320 else 1440 end"
    fixes = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id as service_order_id",
        f"{E0} + cast(floor(({_micros('ts')} / 1000000D - 1704067200) / {div}) as bigint) as t",
        "39.9D + value / 1000 as latitude",
        "116.0D + cast(get_json_object(props, '$.k') as int) / 1000D as longitude",
    )
    return fixes.select("event_id", ID, "t", "latitude", "longitude")


def fx_point_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixes that arrive: every fifth track loses its middle, which the rules are about."""
    div = "case service_order_id % 3 when 0 then 720 when 1 then 4320 else 1440 end"
    fixes = fx_point(spark, sf_dir).selectExpr("*", f"cast(2592000 / {div} as bigint) as span")
    # Trip ends follow from the user alone; recomputed here instead of joined.
    begin, end = f"({E0} + floor(span * 0.1D))", f"({E0} + floor(span * 0.9D))"
    lost = (
        f"service_order_id % 5 = 0 and t > {begin} + 0.2D * ({end} - {begin})"
        f" and t < {begin} + 0.8D * ({end} - {begin})"
    )
    return fixes.where(f"not ({lost})").select("event_id", ID, "t", "latitude", "longitude")


def fx_order_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six fixes along every order version."""
    step = F.explode(F.sequence(F.lit(0), F.lit(5))).alias("i")
    along = fx_order(spark, sf_dir).select(ID, "start_time", "end_time", "start_latitude", "start_longitude", step)
    return along.selectExpr(
        ID,
        "start_time + i * ((end_time - start_time) div 5) as t",
        "start_latitude + i * 0.001D as latitude",
        "start_longitude as longitude",
    )


def fx_track_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw replies of up to 50 fixes each, some of them broken, empty or missing."""
    fix = F.struct(
        (F.col("t") * 1000 + F.col("event_id") % 1000).alias("timestamp"),
        F.lit("gps").alias("provider"),
        (F.col("event_id") % 30).cast("double").alias("accuracy"),
        "latitude",
        "longitude",
    )
    page = F.expr("event_id div 50").alias("page")
    pages = fx_point(spark, sf_dir).groupBy(ID, page).agg(F.collect_list(fix).alias("results"))
    reply = F.to_json(F.struct("results"))
    body = (
        F.when(F.col("page") % 20 == 3, F.lit(None))
        .when(F.col("page") % 20 == 7, F.lit("502 bad gateway"))
        .when(F.col("page") % 20 == 11, F.lit('{"results":[]}'))
        .otherwise(reply)
    )
    return pages.select(ID, "page", body.alias("body"))


def fx_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their newest extension row, after the basic filter."""
    return valid_with_latest_ext(fx_order(spark, sf_dir), latest_ext(fx_ext(spark, sf_dir)))


def fx_driver_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver history before the last day; drivers without an earlier zero trip have none."""
    past = fx_valid(spark, sf_dir).where(F.col("dt") < LAST_DAY)
    counts = past.groupBy("dt", "driver_id").agg(
        F.count_if((F.col("system_distance") == 0) & (F.col("dependable_distance") == 0)).alias("zero_cnt"),
        F.count("*").alias("total_cnt"),
    )
    return counts.where("zero_cnt > 0")


def fx_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both-zero trips of all days, once per app version of the order."""
    return pure_zero(valid_trips(attach_versions(fx_order(spark, sf_dir), fx_ext(spark, sf_dir))))
