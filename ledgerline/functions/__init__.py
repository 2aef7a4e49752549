from ledgerline.functions.scalar import (
    as_bigint,
    as_date,
    as_amount,
    as_rate,
    loses_digits,
    code,
    clean_text,
    to_usd,
    zero_usd,
    month_start,
    period_start,
    freshest,
    watermark_or_sentinel,
    reportable,
)

__all__ = [
    "as_bigint",
    "as_date",
    "as_amount",
    "as_rate",
    "loses_digits",
    "code",
    "clean_text",
    "to_usd",
    "zero_usd",
    "month_start",
    "period_start",
    "freshest",
    "watermark_or_sentinel",
    "reportable",
]
