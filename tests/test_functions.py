from pyspark.sql import functions as F

from aeroperf.functions import numbers, text, time


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


def test_clean_strips_tabs_and_blanks(spark):
    assert one(spark, "\t a b \r\n", text.clean) == "a b"
    assert one(spark, " \t", text.clean) is None
    assert one(spark, None, text.clean) is None


def test_duration(spark):
    assert abs(one(spark, "0:13:48", time.duration_minutes) - 13.8) < 1e-9
    assert abs(one(spark, "-0:03:20.5", time.duration_minutes) + 3.3416666666) < 1e-6
    for bad in ("13:48", "", None, "x"):
        assert one(spark, bad, time.duration_minutes) is None


def test_sector_group(spark):
    got = {x: one(spark, x, numbers.sector_group) for x in ("0", "60", "360", "60.7", "-10", "", "x")}
    assert got == {"0": "S000", "60": "S060", "360": "S000", "60.7": "S060", "-10": "S350", "": None, "x": None}


def test_stamps(spark):
    for said in ("2025-01-01 00:03:00", "2025-01-01T00:03:00", "01/01/2025 00:03:00", "01-01-2025 00:03:00", "2025-01-01 00:03"):
        assert str(one(spark, said, time.parse_stamp)) == "2025-01-01 00:03:00"
    assert one(spark, "never", time.parse_stamp) is None
    assert one(spark, "1970-01-01 00:00:00", lambda c: time.no_sentinel(time.parse_stamp(c))) is None


def test_written_clock(spark):
    got = one(spark, "2025-12-31 23:59:40", lambda c: time.written_clock(c.cast("timestamp"), "Europe/Paris"))
    assert str(got) == "2026-01-01 00:59:40"


def test_lists(spark):
    assert one(spark, "b| a,b||", text.canonical_list) == "a|b"
    assert one(spark, " | ,", text.canonical_list) is None
    assert one(spark, None, text.canonical_list) is None
    assert one(spark, [], lambda c: text.flat_array(c), "array<string>") is None


def test_first_filled_takes_order_and_skips_blanks(spark):
    df = spark.createDataFrame([(1, None), (2, " "), (3, "x"), (4, "y")], "o int, v string")
    assert df.agg(text.first_filled(F.col("v"), F.col("o"))).first()[0] == "x"


def test_truth_words(spark):
    assert [one(spark, x, text.truth) for x in ("t", "SIM", "0", "n", "N", "", None, "?")] == ["TRUE", "TRUE", "FALSE", "FALSE", "FALSE", None, None, "?"]


def test_scope(spark):
    df = spark.createDataFrame([("SBGR", "SBSP"), ("SBGR", "EGLL"), ("ZZZZ", "SBSP"), (None, "SBSP")], "a string, b string")
    assert [r[0] for r in df.select(text.scope_class(F.col("a"), F.col("b"))).collect()] == ["domestic", "international", "none", "none"]


def test_col_or_null_ignores_case_and_underscores(spark):
    df = spark.createDataFrame([("v",)], "DH_VRA string")
    assert df.select(text.col_or_null(df, "dhvra"), text.col_or_null(df, "nothing")).first()[:] == ("v", None)


def test_sums_over_nothing_are_zero(spark):
    assert spark.range(0).agg(numbers.total(F.col("id").cast("double"))).first()[0] == 0.0
