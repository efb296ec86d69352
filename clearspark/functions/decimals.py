"""Exact decimal column functions (D1-D5), for numbers of any size.

Money travels as text. Plain text of usual length is computed with Spark's decimals. Any
other decimal text is taken apart into its digits and a power of ten, and computed with in
limbs of nine digits, so nothing is ever rounded or out of range.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Digits of a price or size, and of an amount to be summed, that Spark's decimals hold with room for
#: a product and for the sum of ten billion rows.
PRICE = (18, 8)
MONEY = (28, 16)
TOTAL = "decimal(38,16)"

# What counts as decimal text, with a power of ten that a 32-bit number holds.
# \z, as $ would let a trailing newline pass.
DECIMAL_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\z"
LOWEST_POWER, HIGHEST_POWER = -(2**31), 2**31 - 1

# Text of which no power needs to be looked at, and such text above zero.
_SHORT_POWER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,9})?\z"
_SHORT_POSITIVE = r"^[+]?(?=[0-9.]*[1-9])([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,9})?\z"
_LIMB = 9
_WIDE = "decimal(38,0)"
#: Zeros that plain text spells out; beyond them a number is written with its power of ten.
SPELLED = 100_000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once a row and only if the result is asked for."""
    return F.get(F.transform(F.array(value), use), 0)


def plain_decimal(text: Column, spec: tuple[int, int] = PRICE) -> Column:
    """The value of plain digits that fit `spec` by their length; NULL for all other text."""
    precision, scale = spec
    plain = rf"^[+-]?[0-9]{{1,{precision - scale}}}([.][0-9]{{1,{scale}}})?\z"
    return F.when(text.rlike(plain), text.try_cast(f"decimal({precision},{scale})"))


def parse_decimal(text: Column) -> Column:
    """The number in `text` as (negative, digits, power), NULL when it is none.

    Its value is digits * 10^power; digits have no zeros on either side, and zero has none
    at all, so equal numbers are equal structs whatever their spelling.
    """
    part = lambda k: F.regexp_extract(text, r"^[+-]?([0-9]*)[.]?([0-9]*)", k)
    raised = F.regexp_extract(text, r"[eE]([+-]?[0-9]+)\z", 1)
    power = F.when(raised == "", F.lit(0)).otherwise(raised.try_cast("int")).cast("bigint")
    lowest = power - F.length(part(2))

    def shaped(bare: Column) -> Column:
        digits = F.rtrim(bare, F.lit("0"))
        raised = lowest + F.length(bare) - F.length(digits)
        return F.struct(
            (text.startswith("-") & (digits != "")).alias("negative"),
            digits.alias("digits"),
            F.when(digits == "", F.lit(0).cast("bigint")).otherwise(raised).alias("power"),
        )

    number = text.rlike(DECIMAL_TEXT) & lowest.between(LOWEST_POWER, HIGHEST_POWER)
    return F.when(number, let(F.ltrim(F.concat(part(1), part(2)), F.lit("0")), shaped))


def is_number(text: Column) -> Column:
    """Whether `text` is a decimal number."""
    return F.when(text.rlike(_SHORT_POWER), F.lit(True)).otherwise(parse_decimal(text).isNotNull())


def is_positive(text: Column) -> Column:
    """D3: true only for text that parses to a value above zero."""
    wide = F.coalesce(let(parse_decimal(text), lambda n: ~n["negative"] & (n["digits"] != "")), F.lit(False))
    return F.when(text.rlike(_SHORT_POSITIVE), F.lit(True)).when(text.rlike(_SHORT_POWER), F.lit(False)).otherwise(wide)


def decimals_equal(left: Column, right: Column) -> Column:
    """Numeric equality of two decimal texts; unparseable text equals nothing."""
    same = F.coalesce((left == right) & left.rlike(_SHORT_POWER), F.lit(False))
    return F.when(same, F.lit(True)).otherwise(F.coalesce(parse_decimal(left) == parse_decimal(right), F.lit(False)))


def product(price: Column, size: Column) -> Column:
    """Exact product of two plain decimals as decimal(38,16)."""
    # decimal(18,8) * decimal(18,8) is decimal(37,16), so nothing is lost.
    return (price * size).cast(TOTAL)


def notional(price: Column, size: Column) -> Column:
    """The exact product of two decimal texts in shortest form; NULL when either does not parse."""
    quick = canonical_text(product(plain_decimal(price), plain_decimal(size)))
    return F.coalesce(quick, let(F.struct(parse_decimal(price).alias("a"), parse_decimal(size).alias("b")), _parsed_product))


def _parsed_product(pair: Column) -> Column:
    """The text of the product of two parsed numbers, NULL when one is NULL; in limbs only where digits are many."""
    digits = 18
    a, b = pair["a"], pair["b"]
    # Digits without their powers: decimal(18,0) * decimal(18,0) is decimal(37,0), so nothing is lost.
    short = (F.length(a["digits"]) <= digits) & (F.length(b["digits"]) <= digits)
    whole = lambda number: number["digits"].try_cast(f"decimal({digits},0)")

    def shaped(text: Column) -> Column:
        bare = F.rtrim(text, F.lit("0"))
        power = a["power"] + b["power"] + F.length(text) - F.length(bare)
        negative = (a["negative"] != b["negative"]) & (bare != "")
        return plain_text(F.struct(negative.alias("negative"), bare.alias("digits"), power.alias("power")))

    # A number without digits is zero.
    text = F.coalesce((whole(a) * whole(b)).cast(_WIDE), F.lit(0).cast(_WIDE)).cast("string")
    return F.when(short, let(text, shaped)).otherwise(_wide_product(pair))


def _spelled_out(value: Column) -> Column:
    """Plain digits of a decimal whose text came in scientific notation."""
    digits = 16
    whole = F.floor(F.abs(value))
    # A remainder, as a difference of this width would be rounded.
    rest = (F.abs(value) % F.lit(1).cast("decimal(1,0)")).cast(f"decimal({digits},{digits})")
    scaled = (rest * F.lit(10**digits).cast("decimal(17,0)")).cast(f"decimal({digits},0)")
    sign = F.when(value < 0, "-").otherwise("")
    return F.concat(
        sign,
        whole.cast("string"),
        F.lit("."),
        F.lpad(scaled.cast("string"), digits, "0"),
    )


def canonical_text(value: Column) -> Column:
    """Shortest plain text of a decimal column: no trailing zeros, no bare point."""
    text = value.cast("string")
    # Outside ANSI mode tiny values, zero among them, are shown with an exponent.
    plain = F.when(text.contains("E"), _spelled_out(value)).otherwise(text)
    shown = F.regexp_replace(plain, r"([.][0-9]*?)0+$", "$1")
    return F.regexp_replace(shown, r"[.]$", "")


def plain_text(number: Column) -> Column:
    """D5 of a parsed number. With more than SPELLED zeros beside its digits it keeps a power of ten."""
    return let(number, _shown)


def _shown(number: Column) -> Column:
    digits, power = number["digits"], number["power"]
    size = F.length(digits)
    zeros = lambda n: F.repeat(F.lit("0"), n.cast("int"))
    inner = F.concat(F.substring(digits, F.lit(1), (size + power).cast("int")), F.lit("."), F.substring(digits, (size + power + 1).cast("int"), size))
    shown = (
        F.when(digits == "", "0")
        .when((power > SPELLED) | (power < -SPELLED - size), F.concat(digits, F.lit("e"), power.cast("string")))
        .when(power >= 0, F.concat(digits, zeros(F.greatest(power, F.lit(0)))))
        .when(size + power > 0, inner)
        .otherwise(F.concat(F.lit("0."), zeros(F.greatest(-power - size, F.lit(0))), digits))
    )
    return F.when(number.isNotNull(), F.concat(F.when(number["negative"], "-").otherwise(""), shown))


def limbs(number: Column) -> Column:
    """(negative, limbs, place): nine digits each, lowest first, of which the first counts 10^(9*place); none for zero."""

    def cut(own: Column) -> Column:
        n = F.ceil(F.length(own["text"]) / _LIMB).cast("int")
        padded = F.lpad(own["text"], n * _LIMB, F.lit("0"))
        return let(F.struct(padded.alias("text"), n.alias("n")), lambda p: F.transform(
            F.sequence(F.lit(1), p["n"]), lambda i: F.substring(p["text"], (p["n"] - i) * _LIMB + 1, F.lit(_LIMB)).cast("bigint")
        ))

    extra = F.pmod(number["power"], F.lit(_LIMB))
    text = F.concat(number["digits"], F.repeat(F.lit("0"), extra.cast("int")))
    return F.struct(
        number["negative"].alias("negative"),
        F.when(number["digits"] == "", F.array().cast("array<bigint>")).otherwise(let(F.struct(text.alias("text")), cut)).alias("limbs"),
        F.floor(number["power"] / _LIMB).cast("bigint").alias("place"),
    )


def _wide_product(pair: Column) -> Column:
    """The text of the product of two parsed numbers, NULL when one is NULL."""

    def multiplied(own: Column) -> Column:
        a, b = own["a"]["limbs"], own["b"]["limbs"]
        sums = F.transform(F.sequence(F.lit(0), F.size(a) + F.size(b) - 2), lambda k: F.aggregate(
            F.sequence(F.greatest(F.lit(0), k - F.size(b) + 1), F.least(k, F.size(a) - 1)),
            F.lit(0).cast(_WIDE),
            lambda total, i: (total + (F.get(a, i) * F.get(b, k - i)).cast(_WIDE)).cast(_WIDE),
        ))
        differ = own["a"]["negative"] != own["b"]["negative"]
        spelled = let(F.struct(sums.alias("sums"), (own["a"]["place"] + own["b"]["place"]).alias("place")), lambda s: _carried(s["sums"], s["place"], differ))
        return F.when((F.size(a) == 0) | (F.size(b) == 0), "0").otherwise(spelled)

    both = pair["a"].isNotNull() & pair["b"].isNotNull()
    return F.when(both, let(F.struct(limbs(pair["a"]).alias("a"), limbs(pair["b"]).alias("b")), multiplied))


def _carried(sums: Column, place: Column, negative: Column) -> Column:
    """The text of limb sums at or above zero, lowest first: what a limb cannot hold moves up."""
    base = F.lit(10**_LIMB).cast("decimal(10,0)")

    def step(own: Column, limb: Column) -> Column:
        total = (own["carry"] + limb).cast(_WIDE)
        low = F.pmod(total, base)
        return F.struct(
            ((total - low) / base).cast(_WIDE).alias("carry"),
            F.concat(F.lpad(low.cast("decimal(9,0)").cast("string"), _LIMB, "0"), own["text"]).alias("text"),
        )

    start = F.struct(F.lit(0).cast(_WIDE).alias("carry"), F.lit("").alias("text"))
    digits = F.ltrim(F.aggregate(sums, start, step, lambda own: F.concat(own["carry"].cast("string"), own["text"])), F.lit("0"))

    def shaped(own: Column) -> Column:
        bare = F.rtrim(own["digits"], F.lit("0"))
        power = own["place"] * _LIMB + F.length(own["digits"]) - F.length(bare)
        return plain_text(F.struct(own["negative"].alias("negative"), bare.alias("digits"), power.alias("power")))

    return let(F.struct(digits.alias("digits"), place.alias("place"), negative.alias("negative")), shaped)


def _signed(sums: Column, place: Column) -> Column:
    """The text of limb sums of either sign, lowest first."""
    base = F.lit(10**_LIMB).cast("decimal(10,0)")
    # What is left above all limbs has the sign of the whole.
    over = F.aggregate(sums, F.lit(0).cast(_WIDE), lambda own, limb: (
        ((own + limb).cast(_WIDE) - F.pmod((own + limb).cast(_WIDE), base)) / base
    ).cast(_WIDE))
    turned = F.transform(sums, lambda limb: (-limb).cast(_WIDE))
    return let(
        F.struct(over.alias("over"), sums.alias("sums"), turned.alias("turned"), place.alias("place")),
        lambda own: F.when(own["over"] < 0, _carried(own["turned"], own["place"], F.lit(True))).otherwise(
            _carried(own["sums"], own["place"], F.lit(False))
        ),
    )


def _spread_too_far(low: Column, high: Column) -> Column:
    """Summands so far apart that their sum has more digits than are spelled."""
    return (high - low) * _LIMB > 2 * SPELLED


def exact_array_sum(texts: Column) -> Column:
    """D2 within a row: the sum of an array of decimal texts in shortest form, NULL if one is unparseable.

    "0" for none. Summands more than 200,000 places apart have no sum that is spelled out: NULL.
    """
    quick = F.transform(texts, lambda text: plain_decimal(text, MONEY))
    # One digit less than Spark's widest decimal, to which + would not keep the last place.
    room = "decimal(37,16)"
    # NULL propagates through +, so one item that is not plain leaves the work to the limbs.
    total = F.aggregate(quick, F.lit(0).cast(room), lambda own, item: (own + item).cast(room), canonical_text)

    def wide(numbers: Column) -> Column:
        held = F.filter(F.transform(numbers, limbs), lambda n: F.size(n["limbs"]) > 0)

        def summed(items: Column) -> Column:
            low = F.array_min(F.transform(items, lambda n: n["place"]))
            high = F.array_max(F.transform(items, lambda n: n["place"] + F.size(n["limbs"]) - 1))
            return let(F.struct(items.alias("items"), low.alias("low"), high.alias("high")), lambda own: F.when(
                ~_spread_too_far(own["low"], own["high"]), _signed(_columns(own), own["low"])
            ))

        return F.when(F.exists(numbers, lambda n: n.isNull()), F.lit(None).cast("string")).otherwise(
            let(held, lambda items: F.when(F.size(items) == 0, "0").otherwise(summed(items)))
        )

    return F.coalesce(total, let(F.transform(texts, parse_decimal), wide))


def _columns(own: Column) -> Column:
    """The sum of all items' limbs at each place from low to high."""

    def at(place: Column) -> Column:
        limb = lambda n: F.coalesce(F.get(n["limbs"], (place - n["place"]).cast("int")), F.lit(0).cast("bigint"))
        return F.aggregate(own["items"], F.lit(0).cast(_WIDE), lambda total, n: (total + F.when(n["negative"], -limb(n)).otherwise(limb(n)).cast(_WIDE)).cast(_WIDE))

    return F.transform(F.sequence(own["low"], own["high"]), at)


def exact_totals(
    rows: DataFrame, keys: list[str], text: Column, into: str = "total", count: str = "n", sums: dict[str, Column] | None = None
) -> DataFrame:
    """D2 over rows: keys, the number of rows, `sums` of integers and the exact sum of decimal texts of any size for each key.

    The sum is in shortest form; NULL as soon as one text is unparseable or NULL, or when
    summands are too far apart to be spelled out. Plain numbers are summed as decimals, the
    limbs of others by their place; both fold in the tasks before the shuffle, so a key may
    hold any share of the rows. Without keys one row comes out, of no rows "0".
    """
    narrow = "decimal(28,16)"
    part = "struct<place:bigint,limb:decimal(28,16),bad:boolean,first:boolean>"
    plain = F.array(F.struct(F.lit(None).cast("bigint"), F.col("_quick"), F.lit(False), F.lit(True)).cast(part))
    bad = F.array(F.struct(F.lit(None).cast("bigint"), F.lit(0).cast(narrow), F.lit(True), F.lit(True)).cast(part))

    def places(own: Column) -> Column:
        items = F.transform(own["limbs"], lambda limb, i: F.struct(
            own["place"] + i, F.when(own["negative"], -limb).otherwise(limb).cast(narrow), F.lit(False), i == 0
        ).cast(part))
        nothing = F.array(F.struct(F.lit(None).cast("bigint"), F.lit(0).cast(narrow), F.lit(False), F.lit(True)).cast(part))
        return F.when(F.size(items) == 0, nothing).otherwise(items)

    number = parse_decimal(F.col("_text"))
    pieces = F.when(F.col("_quick").isNotNull(), plain).otherwise(
        let(number, lambda n: F.when(n.isNull(), bad).otherwise(let(limbs(n), places)))
    )
    sums = sums or {}
    each = rows.select(*keys, *[v.alias(n) for n, v in sums.items()], text.alias("_text"))
    each = each.withColumn("_quick", plain_decimal(F.col("_text"), MONEY))
    each = each.select(*keys, *sums, F.explode(pieces).alias("_part"))
    folded = each.groupBy(*keys, F.col("_part.place").alias("_place")).agg(
        F.sum("_part.limb").cast(TOTAL).alias("_sum"), F.bool_or("_part.bad").alias("_bad"), F.count_if("_part.first").alias("_n"),
        *[F.sum(F.when(F.col("_part.first"), F.col(n))).alias(n) for n in sums],
    )
    wide = F.collect_list(F.when(F.col("_place").isNotNull(), F.struct(F.col("_place").alias("place"), F.col("_sum").cast(_WIDE).alias("sum"))))
    met = folded.groupBy(*keys).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias(count),
        *[F.sum(n).alias(n) for n in sums],
        F.coalesce(F.bool_or("_bad"), F.lit(False)).alias("_bad"),
        F.coalesce(F.max(F.when(F.col("_place").isNull(), F.col("_sum"))), F.lit(0).cast(TOTAL)).alias("_plain"),
        wide.alias("_wide"),
    )
    total = F.when(~F.col("_bad"), F.when(F.size("_wide") == 0, canonical_text(F.col("_plain"))).otherwise(let(
        F.struct(F.col("_wide").alias("wide"), parse_decimal(canonical_text(F.col("_plain"))).alias("plain")), _met
    )))
    return met.select(*keys, count, *sums, total.alias(into))


def _met(own: Column) -> Column:
    """The text of sums by place together with a plain number."""
    more = limbs(own["plain"])
    added = F.transform(more["limbs"], lambda limb, i: F.struct(
        (more["place"] + i).alias("place"), F.when(more["negative"], -limb).otherwise(limb).cast(_WIDE).alias("sum")
    ))

    def summed(all_: Column) -> Column:
        low = F.array_min(F.transform(all_, lambda x: x["place"]))
        high = F.array_max(F.transform(all_, lambda x: x["place"]))

        def at(bounds: Column) -> Column:
            sums = F.transform(F.sequence(bounds["low"], bounds["high"]), lambda k: F.aggregate(
                F.filter(bounds["all"], lambda x: x["place"] == k), F.lit(0).cast(_WIDE), lambda total, x: (total + x["sum"]).cast(_WIDE)
            ))
            return F.when(~_spread_too_far(bounds["low"], bounds["high"]), _signed(sums, bounds["low"]))

        return let(F.struct(all_.alias("all"), low.alias("low"), high.alias("high")), at)

    return let(F.concat(own["wide"], added), summed)
