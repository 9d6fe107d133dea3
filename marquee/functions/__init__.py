"""Scalar column functions (all native Spark expressions)."""

from marquee.functions.dates import (
    date_key, decade, epoch_to_timestamp, iso_day_of_week, is_weekend, month_name,
    month_start, parse_mixed_date,
)
from marquee.functions.numeric import (
    bool_or_false, clip, log10_or_null, pct_change, profit, rint_bigint, roi,
    roi_pct, round_dec, to_number, to_positive_number, try_cast, zero_to_null,
)
from marquee.functions.text import (
    comma_spacing, literal_names_array, literal_names_text, normalize_title,
    split_csv_list, surrogate_key,
)

__all__ = [
    "bool_or_false", "clip", "comma_spacing", "date_key", "decade", "epoch_to_timestamp",
    "iso_day_of_week", "is_weekend", "literal_names_array", "literal_names_text",
    "log10_or_null", "month_name", "month_start", "normalize_title",
    "parse_mixed_date", "pct_change", "profit", "rint_bigint", "roi", "roi_pct",
    "round_dec", "split_csv_list", "surrogate_key", "to_number",
    "to_positive_number", "try_cast", "zero_to_null",
]
