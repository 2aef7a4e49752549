"""Column expressions used by the models. All are built-in Spark functions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import AMOUNT, RATE, USD, WATERMARK_SENTINEL


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_bigint(c: str | Column) -> Column:
    """Text -> BIGINT; under ANSI mode bad input raises instead of turning NULL."""
    return _c(c).cast(T.LongType())


def as_date(c: str | Column) -> Column:
    """ISO text -> DATE. A plain cast would accept '2024' as 2024-01-01; the pattern does not."""
    return F.to_date(_c(c), "yyyy-MM-dd")


def as_amount(c: str | Column) -> Column:
    return _c(c).cast(AMOUNT)


def as_rate(c: str | Column) -> Column:
    return _c(c).cast(RATE)


def loses_digits(c: str | Column, kind: T.DecimalType) -> Column:
    """Whether a number's text has decimals (other than zeros) beyond the scale of ``kind``, which a cast rounds away."""
    plain = F.regexp_extract(_c(c), rf"^\s*[+-]?[0-9]*\.[0-9]{{{kind.scale}}}([0-9]*)\s*$", 1).rlike("[1-9]")
    # with an exponent, digits tell nothing: compare with a wider value
    wide = _c(c).try_cast(T.DecimalType(38, 2 * kind.scale))
    return plain | (_c(c).rlike("[eE]") & (wide != _c(c).try_cast(kind)))


def code(c: str | Column) -> Column:
    """Codes such as currency or country: spaces trimmed, upper case."""
    return F.upper(F.trim(_c(c)))


def clean_text(c: str | Column) -> Column:
    """Names: spaces trimmed, case kept."""
    return F.trim(_c(c))


def to_usd(amount: str | Column, units_per_usd: str | Column) -> Column:
    """The rate is currency units per USD, so divide; a zero rate gives NULL, not an error."""
    return (_c(amount) / F.nullif(_c(units_per_usd), F.lit(0).cast(RATE))).cast(USD)


def zero_usd() -> Column:
    return F.lit(0).cast(USD)


def month_start(c: str | Column) -> Column:
    return F.trunc(_c(c), "month")


PERIOD_UNITS = ("day", "week", "month", "quarter", "year")


def period_start(c: str | Column, unit: str) -> Column:
    if unit not in PERIOD_UNITS:
        raise ValueError(f"unknown period unit {unit!r}; expected one of {PERIOD_UNITS}")
    if unit == "day":
        return _c(c)
    return F.trunc(_c(c), unit)


def freshest(*cols: str | Column) -> Column:
    """Latest of several load times; NULL inputs are skipped (a missing rate keeps the row)."""
    return F.greatest(*[_c(c) for c in cols])


def watermark_or_sentinel(c: str | Column) -> Column:
    return F.coalesce(F.max(_c(c)), F.lit(WATERMARK_SENTINEL).cast(T.TimestampType()))


def reportable(df: DataFrame) -> DataFrame:
    """Presentation form: decimals as DOUBLE and instants as wall-clock UTC timestamps.

    Stored tables keep exact decimals; this is only applied to returned results.
    """
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f.name).cast(T.DoubleType()).alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            out.append(F.col(f.name).cast(T.TimestampNTZType()).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
