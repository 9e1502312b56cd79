from lakemart.functions.dates import (
    calendar_day,
    month_label,
    month_start,
    parse_yyyymmdd,
    whole_months,
    whole_years,
    year_start,
)
from lakemart.functions.numbers import int_div, percent_text, ratio, wide_ratio
from lakemart.functions.text import concat_skip_null, map_codes, strip_prefix

__all__ = [
    "calendar_day",
    "concat_skip_null",
    "int_div",
    "map_codes",
    "month_label",
    "month_start",
    "parse_yyyymmdd",
    "percent_text",
    "ratio",
    "strip_prefix",
    "whole_months",
    "whole_years",
    "wide_ratio",
    "year_start",
]
