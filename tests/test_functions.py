from pyspark.sql import functions as F

from tripaudit.functions import numbers, text, times
from tripaudit.operators.stats import DISTANCE_EDGES, DISTANCE_LABELS, DURATION_EDGES, DURATION_LABELS
from tripaudit.schemas import declared_columns, schema_from_ddl


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


def test_version_label(spark):
    cases = {
        "": "other", "5": "other", "5_1": "And5", "5_2": "iOS5", "5_2_x": "iOS5", "5_9": "other",
        "5_12": "other", "_1": "And", None: "other",
    }
    got = values(spark, [(v,) for v in cases], "v string", text.version_label(F.col("v")))
    assert got == list(cases.values())


def test_json_distance(spark):
    cases = {
        '{"distance":"12"}': 12, '{"distance":"12.7"}': 12, '{"distance":5}': 5, "not json": None,
        '{"other":1}': None, None: None, '{"distance":"x"}': None,
    }
    got = values(spark, [(v,) for v in cases], "v string", text.json_distance(F.col("v")))
    assert got == list(cases.values())


def test_epoch_text_and_day(spark):
    rows = [(1490720399,), (1490720400,), (0,), (None,)]
    assert values(spark, rows, "t long", times.epoch_text(F.col("t"))) == [
        "2017-03-29 00:59:59", "2017-03-29 01:00:00", "", "",
    ]
    assert values(spark, [(10**16,), (-(10**16),)], "t long", times.epoch_text(F.col("t"))) == ["", ""]
    assert values(spark, [("x",), ("1490720400",)], "t string", times.epoch_text(F.col("t"))) == [
        "", "2017-03-29 01:00:00",
    ]
    midnight = [(1490716799,), (1490716800,)]
    assert values(spark, midnight, "t long", times.epoch_day(F.col("t"))) == [20170328, 20170329]
    assert values(spark, midnight, "t long", times.epoch_hour(F.col("t"))) == [23, 0]


def test_epoch_text_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(spark, [(1490720400,)], "t long", times.epoch_text(F.col("t"))) == ["2017-03-29 01:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_days():
    assert times.last_days(20170302, 3) == [20170228, 20170301, 20170302]
    assert times.days_between(20170330, 20170401) == [20170330, 20170331, 20170401]
    assert times.days_between(20170402, 20170401) == []
    assert times.day_bounds(20170320) == (1489939200, 1489939200 + 86399)


def test_date_columns(spark):
    assert values(spark, [(20170329,)], "d int", times.dash_date(F.col("d"))) == ["2017-03-29"]
    assert values(spark, [(20170302,)], "d int", times.day_window(F.col("d"), 3)) == [
        [20170228, 20170301, 20170302]
    ]


def test_right_closed_bins(spark):
    cases = [(0.0, None), (0.1, "0.2"), (0.2, "0.2"), (0.3, "0.5"), (10.0, "10"), (10.1, "10+"), (-1.0, None),
             (None, None), (float("nan"), None), (1e8, None)]
    ordinals = values(
        spark, [(v,) for v, _ in cases], "x double", numbers.right_closed_bin(F.col("x"), DISTANCE_EDGES)
    )
    assert [None if i is None else DISTANCE_LABELS[i] for i in ordinals] == [label for _, label in cases]
    cases = [(0.0, None), (0.5, "1"), (1.0, "1"), (19.5, "20"), (20.0, "20"), (20.01, "20+")]
    ordinals = values(
        spark, [(v,) for v, _ in cases], "x double", numbers.right_closed_bin(F.col("x"), DURATION_EDGES)
    )
    assert [None if i is None else DURATION_LABELS[i] for i in ordinals] == [label for _, label in cases]


def test_rates(spark):
    rows = [(1, 3), (1, 0), (1, 8)]
    assert values(spark, rows, "a int, b int", numbers.per_mille(F.col("a"), F.col("b"))) == [333.3, None, 125.0]
    pct = numbers.percent_of(F.col("a"), F.col("b"))
    assert values(spark, rows, "a int, b int", numbers.percent_text(pct)) == ["33.0%", None, "13.0%"]


def test_safe_casts(spark):
    rows = [("12.5",), ("NULL",), ("",), ("7",)]
    assert values(spark, rows, "v string", numbers.safe_double(F.col("v"))) == [12.5, None, None, 7.0]
    assert values(spark, rows, "v string", numbers.safe_double(F.col("v"), 0.0)) == [12.5, 0.0, 0.0, 7.0]
    assert values(spark, [("1",), ("+1",), ("x",), ("",)], "v string", numbers.digits_or_zero(F.col("v"))) == [
        1, 0, 0, 0,
    ]


def test_haversine(spark):
    metres = numbers.haversine_m(*[F.col(c) for c in "abcd"])
    got = values(spark, [(116.0, 39.9, 116.0, 40.9), (116.0, 39.9, 116.0, 39.9)], "a double, b double, c double, d double", metres)
    assert round(got[0]) == 111195
    assert got[1] == 0


def test_schema_text(spark):
    declared = """
        a   bigint   ignored words

        b decimal(8,2)
        c   int
    """
    assert declared_columns(declared) == [("a", "bigint"), ("b", "decimal(8,2)"), ("c", "int")]
    assert schema_from_ddl(declared).simpleString() == "struct<a:bigint,b:decimal(8,2),c:int>"
