"""Column-level building blocks (all JVM-side expressions, no Python UDF)."""

from spendlens.functions.codes import (has_any_code, has_code, replace_codes,
                                       split_codes, words_all_present)
from spendlens.functions.fiscal import (fiscal_year, fiscal_year_as_coded,
                                        fy_axis_date, fy_delivery_date)
from spendlens.functions.money import million_label, money, money_out, share
from spendlens.functions.text import city_label, geocoder_query, r_paste, r_paste0

__all__ = [
    "has_any_code", "has_code", "replace_codes", "split_codes", "words_all_present",
    "fiscal_year", "fiscal_year_as_coded", "fy_axis_date", "fy_delivery_date",
    "million_label", "money", "money_out", "share",
    "city_label", "geocoder_query", "r_paste", "r_paste0",
]
