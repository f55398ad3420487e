"""Column expressions shared by the plans. All are built-in, JVM-side expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderlake.schemas import struct

# Separator of composite keys, rating bands and their labels.
KEY_SEPARATOR = "~"
ELO_BANDS = (
    (600, "600 or less"),
    (800, "600-800"),
    (1000, "800-1000"),
    (1200, "1000-1200"),
    (1400, "1200-1400"),
    (1600, "1400-1600"),
    (1800, "1600-1800"),
)
ELO_ABOVE = "1801 or more"
ELO_MISSING = "unknown"

NANOS_PER_SECOND = 1_000_000_000


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- keys ------------------------------------------------------------------
def composite_key(*parts: str | Column) -> Column:
    """md5 over the text of the parts. A null part is left out of the text, so the
    key itself is never null: gate the parts, not the key."""
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[as_column(p).cast("string") for p in parts]))


def single_key(part: str | Column) -> Column:
    """md5 of one column; null stays null."""
    return F.md5(as_column(part).cast("string"))


def packed_text(c: str | Column) -> Column:
    """Text as bytes, half as many for lower-case hex digits such as keys are made of.

    A leading byte says which of the two it is, so equal bytes are equal texts and
    `unpacked_text` gives back every text; null stays null.
    """
    text = as_column(c)
    is_hex = F.lower(F.hex(F.unhex(text))) == text
    plain = F.concat(F.lit(b"\x00"), text.cast("binary"))
    return F.when(is_hex, F.unhex(F.concat(F.lit("01"), text))).otherwise(plain)


def unpacked_text(c: str | Column) -> Column:
    packed = as_column(c)
    rest = F.substring(packed, 2, 0x7FFFFFFF)
    is_hex = F.substring(packed, 1, 1) == F.lit(b"\x01")
    return F.when(is_hex, F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def date_key(day: str | Column) -> Column:
    return F.date_format(as_column(day), "yyyyMMdd").cast("int")


# ---- measures --------------------------------------------------------------
def elo_bucket(rating: str | Column) -> Column:
    rating = as_column(rating)
    bands = reduce(
        lambda chain, band: chain.when(rating <= band[0], band[1]),
        ELO_BANDS[1:],
        F.when(rating <= ELO_BANDS[0][0], ELO_BANDS[0][1]),
    )
    return bands.when(rating > ELO_BANDS[-1][0], ELO_ABOVE).otherwise(ELO_MISSING)


def win_flag(winner: str | Column) -> Column:
    """1 for a win; a loss and an unknown outcome both count 0."""
    return F.when(as_column(winner), 1).otherwise(0)


def percentage(part: str | Column, whole: str | Column) -> Column:
    """Share in percent, two decimals; 0 where the whole is 0."""
    part, whole = as_column(part), as_column(whole)
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.round(part / whole * 100, 2))


def percentage_or_null(part: str | Column, whole: str | Column) -> Column:
    """Share in percent, two decimals; null where the whole is 0."""
    return F.round(F.try_divide(as_column(part), as_column(whole)) * 100, 2)


# ---- time ------------------------------------------------------------------
def nanos_to_secs(nanos: str | Column) -> Column:
    """Whole seconds of a nanosecond duration, cut off toward zero."""
    return (as_column(nanos) / NANOS_PER_SECOND).cast("int")


def nanos_to_timestamp(nanos: str | Column) -> Column:
    """Instant of an epoch-nanosecond count, to the microsecond Spark keeps."""
    return F.timestamp_micros(F.floor(as_column(nanos).cast("decimal(20,0)") / 1000).cast("bigint"))


def week_start(day: str | Column) -> Column:
    """Monday of the week, as a date."""
    return F.to_date(F.date_trunc("week", as_column(day)))


def file_date_of(file_name: str | Column) -> Column:
    """Date a file is named by (`2024-01-07.parquet`, in any folder); null for other names."""
    last = F.element_at(F.split(as_column(file_name), "/"), -1)
    stem = F.split_part(last, F.lit("."), F.lit(1))
    return F.to_date(F.try_to_timestamp(stem, F.lit("yyyy-MM-dd")))


# ---- audit -----------------------------------------------------------------
def load_date(as_of: Column | None = None) -> Column:
    """Date of the load: today, unless a run pins it."""
    return F.current_date() if as_of is None else as_of


def load_time(as_of: Column | None = None) -> Column:
    """Time of the load: now, unless a run pins it."""
    return F.current_timestamp() if as_of is None else as_of


# ---- whole-frame projections -----------------------------------------------
def conform(df: DataFrame, ddl_or_struct) -> DataFrame:
    """Project onto a declared layout: its columns, its order, its types.

    Extra columns go, a missing one is an analysis error, and a value that does not fit its
    type fails the job, in ANSI mode or not.
    """
    layout = struct(ddl_or_struct) if isinstance(ddl_or_struct, str) else ddl_or_struct
    given = {f.name: f.dataType for f in df.schema}
    return df.select([_fitted(f.name, f.dataType, given.get(f.name)).alias(f.name) for f in layout])


def _fitted(name: str, kind, given) -> Column:
    raw = F.col(name)
    if given == kind or given is None:
        return raw
    # A value that was given and comes out null did not fit.
    unfit = F.raise_error(F.concat(F.lit(f"{name} is no {kind.simpleString()}: "), raw.cast("string")))
    value = raw.try_cast(kind)
    return F.coalesce(value, F.when(raw.isNotNull(), unfit.cast(kind)))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])
