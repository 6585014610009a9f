from decimal import Decimal

from pyspark.sql import functions as F

from coursemill.functions import columns as c


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make("x").alias("y")).first()["y"]


def test_labels_have_a_default_also_for_null(spark):
    def make(x):
        return c.label(x, c.REGISTER_SOURCES, c.REGISTER_SOURCE_OTHER)

    assert [one(spark, v, make) for v in ("1", "2", "3", "4", "5", None)] == [
        "PC", "Mobile", "App", "WeChat", "other", "other",
    ]
    assert one(spark, "2", lambda x: c.label(x, c.APP_PLATFORMS, c.APP_PLATFORM_OTHER)) == "APP"


def test_masks_accept_null_and_short_text(spark):
    assert [one(spark, v, c.mask_name) for v in ("Wang", "W", None)] == ["Wxx", "Wxx", None]
    assert one(spark, "13012345678", c.mask_phone) == "130*****5678"
    assert one(spark, "12", c.mask_phone) == "12*****"
    assert one(spark, None, c.mask_phone) is None


def test_integers_of_logs(spark):
    cases = {"12": 12, " 7 ": 7, "-3": -3, "12.9": 12, "-0.5": 0, "1e2": 100, "abc": 0, "": 0, "99999999999": 0, "12.x": 0, "00000000000012": 12, "1.5e+003": 1500, "1e-400": 0, "1e999999999": 0, "1e": 0}
    assert {v: one(spark, v, c.int_or_zero) for v in cases} == cases
    assert one(spark, None, c.int_or_zero) == 0


def test_scores_round_half_up_from_text(spark):
    cases = {"12.25": "12.3", "12.35": "12.4", "0.05": "0.1", "-0.25": "-0.3", "7": "7.0", "bad": "0.0"}
    assert {v: str(one(spark, v, c.score_1dp)) for v in cases} == cases
    assert one(spark, None, c.score_1dp) == Decimal("0.0")


def test_money_and_dates(spark):
    assert one(spark, "100.12345", c.money) == Decimal("100.1235")
    assert one(spark, "free", c.money) is None
    assert one(spark, "20190722", c.dashed_date) == "2019-07-22"
    assert one(spark, 1563352128131, c.day_of_millis, "long") == "20190717"
    stamp = spark.range(1).select(c.now_text().alias("t")).first()["t"]
    assert len(stamp) == 19 and stamp[4] == "-" and stamp[13] == ":"


def test_score_bands(spark):
    cases = {
        "-1.0": None, "0.0": "0-20", "20.0": "0-20", "20.1": "20-40", "40.0": "20-40", "60.0": "40-60",
        "60.1": "60-80", "100.0": "80-100", "100.1": None,
    }
    got = {v: one(spark, Decimal(v), c.score_band, "decimal(5,1)") for v in cases}
    assert got == cases
    assert one(spark, None, c.score_band, "decimal(5,1)") is None


def test_ratio_and_percent(spark):
    df = spark.createDataFrame([(57, 200), (1, 3), (0, 0)], "a long, b long")
    assert [r[0] for r in df.select(c.ratio("a", "b")).collect()] == [Decimal("0.29"), Decimal("0.33"), None]
    df = spark.createDataFrame([(1, 8), (27, 200), (5, 0), (3, 1)], "a long, b long")
    assert [r[0] for r in df.select(c.percent_text("a", "b")).collect()] == ["12%", "14%", "0%", "300%"]


def test_watch_seconds_cut_towards_zero(spark):
    df = spark.createDataFrame([(0, 1999), (1999, 0), (1563352128131, 1563352144131)], "ts long, te long")
    assert [r[0] for r in df.select(c.watch_seconds("ts", "te")).collect()] == [1, -1, 16]


def test_text_rules(spark):
    assert one(spark, "12.3abc..d4", c.clean_text) == "3abcd4"
    assert one(spark, "a  b  ", c.tokens) == ["a", "", "b"]
    assert [one(spark, v, c.tokens) for v in ("  ", "", " a")] == [[], [""], ["", "a"]]
    assert one(spark, "country|0|Shanghai|city|isp", c.region_province) == "Shanghai"
    assert one(spark, "country", c.region_province) is None


def test_ipv4_numbers(spark):
    cases = {"0.0.0.1": 1, "1.2.3.4": 16909060, "255.255.255.255": 4294967295, "1.2.3": None, "1.2.3.256": None, "x": None}
    assert {v: one(spark, v, c.ipv4_number) for v in cases} == cases


def test_whole_div_has_null_for_zero(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (1, 0)], "a long, b long")
    assert [r[0] for r in df.select(c.whole_div("a", F.col("b"))).collect()] == [3, -3, None]
