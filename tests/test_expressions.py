from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import functions as X

NS = 1_552_186_800_123_456_789  # 2019-03-10 03:00:00.123456, in New York's missing hour's wake


def times(spark, *pairs):
    return spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")


def test_minute_diff_counts_boundaries(spark, zone):
    df = times(
        spark,
        (datetime(2019, 1, 1, 10, 0, 59), datetime(2019, 1, 1, 10, 1, 1)),
        (datetime(2019, 1, 1, 10, 1, 1), datetime(2019, 1, 1, 10, 0, 59)),
        (datetime(2019, 3, 10, 1, 59, 0), datetime(2019, 3, 10, 3, 1, 0)),
        (datetime(2019, 1, 31, 23, 59, 59), datetime(2019, 2, 1, 0, 0, 0)),
    )
    got = df.select(X.minute_diff(F.col("a"), F.col("b")).alias("m"))
    assert got.schema["m"].dataType == T.LongType()
    assert [r.m for r in got.collect()] == [1, -1, 62, 1]


def test_nanoseconds_are_zone_free(spark, zone):
    df = spark.createDataFrame([(NS,), (-1_000_000_000,), (None,)], "ns bigint")
    kind = T.LongType()
    got = df.select(
        X.as_ntz("ns", kind), X.as_date("ns", kind), X.as_epoch_minute("ns", kind)
    ).collect()
    assert tuple(got[0]) == (
        datetime(2019, 3, 10, 3, 0, 0, 123456),
        date(2019, 3, 10),
        NS // 60_000_000_000,
    )
    assert tuple(got[1]) == (datetime(1969, 12, 31, 23, 59, 59), date(1969, 12, 31), -1)
    assert tuple(got[2]) == (None, None, None)


def test_raw_times_of_all_kinds_agree(spark, zone):
    at = datetime(2019, 3, 10, 2, 30, 5)  # does not exist on New York's clocks
    micros = 1_552_185_005_000_000
    df = spark.createDataFrame([(at, micros)], "ntz timestamp_ntz, us bigint").select(
        "ntz", (F.col("us") * 1000).alias("ns"), F.timestamp_micros("us").alias("ltz")
    )
    for name in ("ntz", "ns", "ltz"):
        kind = df.schema[name].dataType
        got = df.select(
            X.as_ntz(name, kind), X.as_date(name, kind), X.as_epoch_minute(name, kind)
        ).first()
        assert tuple(got) == (at, at.date(), micros // 60_000_000), name


def test_initcap_starts_words_at_punctuation_but_not_apostrophes(spark):
    texts = {
        "N/A": "N/A",
        "governor's island/ellis": "Governor's Island/Ellis",
        "EAST-side (north)": "East-Side (North)",
        "EWR": "Ewr",
        "a|b\\c": "A|B\\C",
        None: None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(X.initcap_words(F.col("t"))).collect()]
    assert got == list(texts.values())


def test_casts_to_int_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.7,), (2.5,), (-2.5,), (0.4,), (None,)], "x double")
    got = [r[0] for r in df.select(X.round_to_int("x", T.DoubleType())).collect()]
    assert got == [3, 3, -3, 0, None]
    assert df.select(F.lit(7).alias("x")).select(X.round_to_int("x", T.LongType())).first()[0] == 7


def test_ratios_are_guarded_and_in_double(spark):
    df = spark.createDataFrame([(2.0, 1), (2.0, 0), (2.0, -5), (None, 3)], "d double, m bigint")
    assert [r[0] for r in df.select(X.speed_mph(F.col("d"), F.col("m"))).collect()] == [
        120.0,
        None,
        None,
        None,
    ]
    tips = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (1.0, -1.0)], "t double, f double")
    got = [r[0] for r in tips.select(X.percent_of(F.col("t"), F.col("f"))).collect()]
    assert got == [25.0, None, None]


def test_iso_weekday(spark):
    df = spark.createDataFrame([(date(2019, 1, 7),), (date(2019, 1, 13),)], "d date")
    assert [r[0] for r in df.select(X.iso_weekday(F.col("d"))).collect()] == [1, 7]
