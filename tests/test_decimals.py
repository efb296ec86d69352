import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from clearspark.functions import clock, decimals

# Texts that are numbers, with what they are worth, and texts that are none.
PARSED = {
    "1": "1",
    "0": "0",
    "-1": "-1",
    "+2": "2",
    "0.0001": "0.0001",
    "1.": "1",
    ".5": "0.5",
    "1e3": "1000",
    "1E-8": "0.00000001",
    "100e-10": "0.00000001",
    "0.1234567800000": "0.12345678",
    "9999999999.99999999": "9999999999.99999999",
    "1e-9": "0.000000001",
    "0.123456789": "0.123456789",
    "12345678901": "12345678901",
    "0.12345678000000000000000000000000001": "0.12345678000000000000000000000000001",
    "1234567890" * 5 + "." + "0123456789" * 5: "1234567890" * 5 + "." + "0123456789" * 5,
    "-000.000e5": "0",
    "1e000000000000002": "100",
}
NOT_NUMBERS = ["abc", "", ".", " 1", "1 ", "1\n", "1e", "0x10", "1_000", "--1", "NaN", "1,5", "1e2147483648", "1e-2147483649"]
FAR_POWERS = ["1e1000000000", "1e-1000000000", "25e2147483640"]


def column(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


def fraction(text):
    mantissa, _, power = text.lower().partition("e")
    return Fraction(mantissa.rstrip(".") if mantissa[-1:] == "." else mantissa) * Fraction(10) ** int(power or 0)


def shown(value):
    """Shortest plain text of a fraction with a power of ten below the line."""
    places = 0
    while value.denominator != 1:
        value, places = value * 10, places + 1
    digits = str(abs(value.numerator)).rjust(places + 1, "0")
    text = f"{digits[: len(digits) - places]}.{digits[len(digits) - places :]}" if places else digits
    return "-" * (value < 0) + (text.rstrip("0").rstrip(".") if places else text)


def test_parse_keeps_exact_values(spark):
    rows = column(spark, PARSED).select("text", decimals.plain_text(decimals.parse_decimal(F.col("text"))).alias("d")).collect()
    assert {r.text: r.d for r in rows} == PARSED


def test_what_is_no_number(spark):
    text = F.col("text")
    number = decimals.is_number(text).alias("n"), decimals.parse_decimal(text).isNotNull().alias("p")
    assert [tuple(r) for r in column(spark, NOT_NUMBERS).select(*number).collect()] == [(False, False)] * len(NOT_NUMBERS)
    assert [tuple(r) for r in column(spark, [*PARSED, *FAR_POWERS]).select(*number).collect()] == [(True, True)] * (len(PARSED) + len(FAR_POWERS))


def test_far_powers_are_compared_and_keep_their_power(spark):
    df = spark.createDataFrame([("1e1000000000", "10e999999999"), ("1e1000000000", "1e1000000001"), ("1e-1000000000", "0")], "a string, b string")
    shown_ = df.select(decimals.decimals_equal(F.col("a"), F.col("b")).alias("e"), decimals.is_positive(F.col("a")).alias("p"),
                       decimals.notional(F.col("a"), F.lit("-2.50")).alias("n")).collect()
    assert [r.e for r in shown_] == [True, False, False] and all(r.p for r in shown_)
    assert [r.n for r in shown_] == ["-25e999999999", "-25e999999999", "-25e-1000000001"]


def test_positive(spark):
    texts = ["1", "0", "-1", "0.0001", "abc", "0.0000012345", "1e-9", "12345678901", "0e5", "-1e-30", "00.00", "+.5e-900", "1e0000000000000", "0e0000000000000"]
    rows = column(spark, texts).select(decimals.is_positive(F.col("text")).alias("p")).collect()
    assert [r.p for r in rows] == [True, False, False, True, False, True, True, True, False, False, False, True, True, False]


def test_notional_and_canonical_text(spark):
    df = spark.createDataFrame([("65000.5", "0.01"), ("63351.0", "0.00137"), ("x", "1"), (None, "1"), ("-0", "1e40")], "p string, s string")
    worth = decimals.notional(F.col("p"), F.col("s"))
    assert [r[0] for r in df.select(worth).collect()] == ["650.005", "86.79087", None, None, "0"]


def random_text(rng):
    whole = "".join(rng.choices("0123456789", k=rng.choice([0, 1, 3, 9, 10, 18, 40])))
    part = "".join(rng.choices("0099123", k=rng.choice([0, 0, 2, 8, 9, 27, 45])))
    text = rng.choice(["", "-", "+"]) + (whole or "0" * (not part)) + ("." + part if part else rng.choice(["", "."]))
    return text + rng.choice(["", "", "", "e5", "E-7", "e+30", "e-31"])


def test_products_sums_and_equality_of_any_size(spark):
    rng = random.Random(7)
    rows = [(i, random_text(rng), random_text(rng), [random_text(rng) for _ in range(rng.randrange(6))]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a string, b string, texts array<string>")
    found = df.select("id", decimals.notional(F.col("a"), F.col("b")).alias("worth"), decimals.exact_array_sum(F.col("texts")).alias("total"),
                      decimals.is_positive(F.col("a")).alias("positive"),
                      decimals.decimals_equal(F.col("a"), F.concat(F.col("a"), F.lit("e0"))).alias("odd")).collect()
    for r in found:
        _, a, b, texts = rows[r.id]
        assert r.worth == shown(fraction(a) * fraction(b)), (a, b)
        assert r.total == shown(sum(map(fraction, texts), Fraction(0))), texts
        assert r.positive == (fraction(a) > 0)
    same = spark.createDataFrame([(a, shown(fraction(a))) for _, a, _, _ in rows], "a string, b string")
    assert all(r[0] for r in same.select(decimals.decimals_equal(F.col("a"), F.col("b"))).collect())


def test_totals_by_key_of_any_size(spark):
    rng = random.Random(8)
    rows = [(i % 5, random_text(rng) if i % 3 else f"{rng.randrange(10**6)}.{rng.randrange(100):02d}") for i in range(600)]
    rows += [(7, "9" * 12 + ".5")] * 50 + [(8, "1"), (8, "x"), (9, "-5"), (9, "5.0"), (10, None)]
    df = spark.createDataFrame(rows, "k int, text string")
    found = {r.k: (r.n, r.total, r.twice) for r in decimals.exact_totals(df, ["k"], F.col("text"), sums={"twice": F.lit(2)}).collect()}
    for k in range(11):
        own = [t for key, t in rows if key == k]
        if own:
            bad = any(t in ("x", None) for t in own)
            assert found[k] == (len(own), None if bad else shown(sum(map(fraction, own), Fraction(0))), 2 * len(own)), k
    whole = decimals.exact_totals(df.filter("k < 0"), [], F.col("text")).collect()
    assert [tuple(r) for r in whole] == [(0, "0")]


def test_equal_is_numeric(spark):
    df = spark.createDataFrame([("1.0", "1"), ("1", "2"), ("a", "a"), ("650.0050", "650.005"), (None, "1"), ("-0", "0e7")], "a string, b string")
    equal = decimals.decimals_equal(F.col("a"), F.col("b"))
    assert [r[0] for r in df.select(equal).collect()] == [True, False, False, True, False, True]


def test_array_sums_keep_the_last_place(spark):
    cases = {
        ("0.0000000000000001", "0.0000000000000002"): "0.0000000000000003",
        ("-0.3", "0.1"): "-0.2",
        ("-1.25", "-2.75", "0.5"): "-3.5",
        ("9999999999999999999.9999999999999999", "0.0000000000000001"): "10000000000000000000",
        ("0.9999999999999999", "0.0000000000000002"): "1.0000000000000001",
        ("-1", "0.0000000000000001"): "-0.9999999999999999",
        ("1e60", "-1e60", "1e-60"): "0." + "0" * 59 + "1",
        ("-1e60", "1e60"): "0",
        (): "0",
        ("1", "x"): None,
        ("20", "20.0"): "40",
        ("650.005", "1.1", "0.895"): "652",
        ("1e900000", "1"): None,
    }
    rows = spark.createDataFrame([(list(c),) for c in cases], "texts array<string>")
    found = rows.select(decimals.exact_array_sum(F.col("texts"))).collect()
    assert [r[0] for r in found] == list(cases.values())


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_canonical_text(spark, ansi):
    values = ["40.0000", "100", "0.0", "86.790870", "0.0000000000000001", "-1.50"]
    values += ["-0.0000000000000203", "1234567890123456789012"]
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        df = column(spark, values).select(F.col("text").cast("decimal(38,16)").alias("d"))
        shown = [r[0] for r in df.select(decimals.canonical_text(F.col("d"))).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert shown == [
        "40",
        "100",
        "0",
        "86.79087",
        "0.0000000000000001",
        "-1.5",
        "-0.0000000000000203",
        "1234567890123456789012",
    ]


def test_backoff(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 2, 3, 4, 10, 5000)], "n bigint")
    small = [r[0] for r in df.select(clock.backoff_ms(F.col("n"), 100, 5000)).collect()]
    assert small == [100, 100, 200, 400, 800, 5000, 5000]
    capped = [r[0] for r in df.select(clock.backoff_ms(F.col("n"), 1000, 4000)).collect()]
    assert capped[-2:] == [4000, 4000]


def test_jitter_is_bounded_and_repeatable(spark):
    df = spark.range(1000).select("id", clock.jitter_ms(F.lit(1000), F.col("id")).alias("j"))
    first, again = df.collect(), df.collect()
    assert first == again
    assert all(0 <= r.j <= 1000 for r in first) and len({r.j for r in first}) > 400
    zero = spark.range(3).select(clock.jitter_ms(F.lit(0), F.col("id")))
    assert [r[0] for r in zero.collect()] == [0, 0, 0]


def test_wall_micros_ignores_the_session_zone(spark):
    df = spark.sql("select timestamp_ntz'2024-03-31 02:30:07.179575' t")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(clock.wall_micros(F.col("t"))).first()[0] == 1711852207179575
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
