"""Clocks and retry timing."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_micros(ts: Column) -> Column:
    """Epoch microseconds of a zone-less timestamp read as UTC, whatever the session zone."""
    day = F.unix_date(ts.cast("date")).cast("bigint") * F.lit(86_400_000_000)
    clock = F.hour(ts).cast("bigint") * 3600 + F.minute(ts).cast("bigint") * 60
    seconds = F.extract(F.lit("SECOND"), ts) * 1_000_000
    return day + clock * 1_000_000 + seconds.cast("bigint")


def millis_of_micros(micros: Column) -> Column:
    return F.unix_millis(F.timestamp_micros(micros))


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def backoff_ms(attempt: Column, base_ms: int, max_ms: int) -> Column:
    """T4: base doubled per attempt after the first, never above the cap."""
    # As doubles, so a large attempt number saturates instead of overflowing.
    steps = F.greatest(attempt, F.lit(1)).cast("double") - 1
    return F.least(F.lit(float(base_ms)) * F.pow(F.lit(2.0), steps), F.lit(float(max_ms))).cast(
        "bigint"
    )


def jitter_ms(delay_ms: Column, *seed: Column) -> Column:
    """T5: a draw from [0, delay], the same whenever a lost task is run again."""
    draw = F.pmod(F.xxhash64(*seed), delay_ms + 1)
    return F.when(delay_ms > 0, draw).otherwise(F.lit(0)).cast("bigint")
