"""Transaction filters: city-government recipients and place of performance.

The reference builds two row sets and binds them (UNION ALL): recipients with
the local-government code and none of the exclusion codes, plus excluded
recipients that are consolidated city-counties. Both come from one scan here:
a Boolean ``is_city_gov`` and a ``reason`` column, then one filter.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.functions.codes import has_any_code, has_code, replace_codes, words_all_present

# Fixed values of the reference method (code meanings from the code list):
# 12 = U.S. Local Government; C7 = County; 2F = U.S. State Government;
# OH = State Controlled Institution of Higher Learning.
INCLUDE_CODE = "12"
EXCLUDE_CODES = ("C7", "2F", "OH")
NEVER_CODES = ("OH",)
RECOVER_WORDS = ("City", "County")

# UEIs of recipients the method never counts as city governments
# (authorities, districts, state offices and firms whose codes look like a
# consolidated city-county), in the order the method lists them.
NEVER_CITY_UEIS = (
    "EG8WAM315LZ5", "T81MLLAMG4K9", "KRN3EHZL2VC3", "EP6MLJ21L3G3", "DTNMMPBN5715",
    "WVPXXNGJHNN5", "MLB7RPN9DK25", "W8S7DA41BTV3", "C8F3CY5MLJE8", "Y6DVFRLRR2D7",
    "CDEZZSTCZTR5", "L666V7ZW6CG3", "Z3LULQHD94B9", "GGZZKEZLFZT1", "ND9STDVJND49",
    "MUP2NS4H1MV7", "GVC3E8KNC8N3", "C234L4APDQ89", "GJ14HLKXRNR5",
)


def flag_city_gov(df: DataFrame, biz: str = "bus_type_string", uei: str = "recipient_uei",
                  code_map: Mapping[str, str] | None = None,
                  blacklist: DataFrame | Iterable[str] | None = None,
                  blacklist_key: str | None = None,
                  include: str = INCLUDE_CODE, exclude: Iterable[str] = EXCLUDE_CODES,
                  never: Iterable[str] = NEVER_CODES, words: Iterable[str] = RECOVER_WORDS,
                  mode: str = "token", names_col: str = "names") -> DataFrame:
    """Add ``names``, ``is_city_gov`` and ``reason`` ('include' / 'recovered').

    * include: has ``include`` and none of ``exclude``;
    * recovered: has ``include`` and some of ``exclude`` but none of ``never``,
      the code *names* hold every word of ``words`` and the UEI is not in the
      blacklist.
    """
    exclude, never, words = list(exclude), list(never), list(words)
    out = df.withColumn(names_col, replace_codes(biz, code_map or {}))
    if blacklist is None:
        listed = F.lit(False)
    elif isinstance(blacklist, DataFrame):
        key = blacklist_key or uei
        bl = blacklist.select(F.col(key).alias("__bl_uei")).distinct().withColumn("__bl", F.lit(True))
        out = out.join(bl, out[uei] == bl["__bl_uei"], "left").drop("__bl_uei")
        listed = F.coalesce(F.col("__bl"), F.lit(False))
    else:
        keys = list(blacklist)
        listed = F.coalesce(F.col(uei).isin(keys), F.lit(False)) if keys else F.lit(False)
    inc = has_code(biz, include, mode=mode)
    exc = has_any_code(biz, exclude, mode=mode)
    nev = has_any_code(biz, never, mode=mode)
    recovered = inc & exc & ~nev & words_all_present(names_col, words) & ~listed
    reason = F.when(inc & ~exc, F.lit("include")).when(recovered, F.lit("recovered"))
    out = out.withColumn("reason", reason).withColumn("is_city_gov", reason.isNotNull())
    return out.drop("__bl") if "__bl" in out.columns else out


def city_gov_filter(df: DataFrame, **kw) -> DataFrame:
    """Rows of city-government recipients (D2 without the amount/place steps)."""
    return flag_city_gov(df, **kw).filter(F.col("is_city_gov"))


def nonzero_amount(df: DataFrame, amount: str = "amount") -> DataFrame:
    """``filter(x != 0)``: drops zero and NULL amounts."""
    return df.filter(F.col(amount) != 0)


def match_place_of_performance(df: DataFrame, pop: str = "pop_state", state: str = "state",
                               state_code: str = "state_code") -> DataFrame:
    """Keep rows performed in the recipient's state (name, code) or unknown."""
    p = f"`{pop}`"
    return df.filter(f"{p} = upper(`{state}`) OR {p} = `{state_code}` OR {p} IS NULL")
