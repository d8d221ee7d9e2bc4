"""Normalisers: the traps in which similar functions differ."""

from pyspark.sql import functions as F

from canvass.functions import nested
from canvass.functions import normalize as N


def values(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["v"] for r in df.select("i", expr(F.col("t")).alias("v")).orderBy("i").collect()]


def test_codes_differ_on_purpose(spark):
    texts = ["10", "10.0", "0010", "12-34", "", None, "nan", "000"]
    assert values(spark, texts, N.digits_code) == ["10", "100", "10", "1234", "", "", "", "0"]
    assert values(spark, texts, N.decimal_code) == ["10", "10", "10", "1234", "", "", "", "0"]


def test_numbers(spark):
    assert values(spark, ["3.9", "1,234", "-7x", "", None, "abc"], N.int_value) == [3, 1234, -7, 0, 0, 0]
    assert values(spark, ["0.5", "1.5", "2.5", "x", None], N.banker_int) == [0, 2, 2, 0, 0]
    assert values(spark, ["1.10", "1.1", "3.0", "61", "", None, "x"], N.number_text) == ["1.1", "1.1", "3", "61", "", "", ""]
    assert values(spark, ["1.10", "1,5", "no 990 x", "12.0", "100", None], N.ballot_text) == ["1.1", "1.5", "990", "12", "100", ""]
    assert values(spark, ["5.00", "5.10", None], N.drop_zero_fraction) == ["5", "5.10", ""]


def test_ballot_base(spark):
    assert values(spark, ["61", "615"], lambda c: N.ballot_base(c, F.lit(True))) == [6, 61]
    assert values(spark, ["61.2", "7", ""], lambda c: N.ballot_base(c, F.lit(False))) == [61, 7, None]


def test_names(spark):
    assert values(spark, [" a  b\n", "x y", None], N.spaces) == ["a b", "x y", ""]
    assert values(spark, ["Tel-Aviv [5000]", "שדה \"בוקר\"", None], N.name_key) == ["telaviv", "שדהבוקר", ""]
    assert values(spark, ["Name [12]", "Name", None], N.bracket_code) == ["12", "", ""]
    assert values(spark, ["Name [12]", "Name"], N.bracket_name) == ["Name", "Name"]
    assert values(spark, ["ﬁn—x‏y", "a b-c", None], N.nfkc_name) == ["fin-xy", "ab-c", ""]
    assert values(spark, ["A b/C", "--", None], N.slug) == ["a_b_c", "", ""]


def test_lists_and_flags(spark):
    assert values(spark, ["a| b|a||", "", None], N.pipe_list) == [["a", "b"], [], []]
    assert values(spark, [" TRUE ", "1", "Yes", "no", "", None], N.truthy) == [True, True, True, False, False, False]
    assert values(spark, ["https://a.b/c", "http://a.b", "https:///x", None], N.https_url) == ["https://a.b/c", None, None, None]


def test_first_present(spark):
    df = spark.createDataFrame([(" ", None, "c"), ("a", "b", "c"), (None, None, None)], "x string, y string, z string")
    assert [r[0] for r in df.select(N.first_present(F.col("x"), F.col("y"), F.col("z"))).collect()] == ["c", "a", ""]


def test_hue_matches_plain_python(spark):
    def hue(text):
        h = 2166136261
        for ch in text:
            h = ((h ^ ord(ch)) * 16777619) % 2**32
        return abs(h - 2**32 if h >= 2**31 else h) % 360

    texts = ["a", "", "מחל", "NATION_7"]
    assert values(spark, texts, N.stable_hue) == [hue(t) for t in texts]


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.1234565,), (0.5,)], "x double")
    assert [r[0] for r in df.select(N.round6(F.col("x"))).collect()] == [0.123456, 0.5]


def test_votes_array_ties_keep_column_order(spark):
    df = spark.createDataFrame([(3, 5, 5), (0, 0, 0)], "`b.x` long, a long, c long")
    got = df.select(nested.votes_array(["b.x", "a", "c"])[0]["party"].alias("w")).collect()
    assert [r["w"] for r in got] == ["a", "b.x"]


def test_ring_area(spark):
    df = spark.createDataFrame([([0.0, 0.0, 2.0, 0.0, 2.0, 3.0, 0.0, 3.0],)], "c array<double>")
    assert df.select(nested.ring_area(nested.pairs_of(F.col("c")))).first()[0] == 6.0
