"""``~``-delimited business-type code lists.

The reference tests codes with substring regexes (``grepl('12', s)``); that is
the same as a token test only while every code has two characters. The token
test is the default here, the substring test is kept as ``mode='substring'``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sql_str(text: str) -> str:
    """A Spark SQL string literal holding ``text`` exactly."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def split_codes(c, sep: str = "~") -> Column:
    """``strsplit(s, sep)`` as ARRAY<STRING> (the separator is literal text)."""
    return F.split(_col(c), re.escape(sep))


def has_code(c, code: str, sep: str = "~", mode: str = "token") -> Column:
    """TRUE when ``code`` is in the list; NULL lists give FALSE like ``grepl``."""
    if mode == "substring":
        hit = _col(c).contains(code)
    else:
        hit = F.array_contains(split_codes(c, sep), code)
    return F.coalesce(hit, F.lit(False))


def has_any_code(c, codes: Iterable[str], sep: str = "~", mode: str = "token") -> Column:
    """TRUE when any of ``codes`` is in the list; NULL lists give FALSE."""
    codes = list(codes)
    if mode == "substring":
        hit = _col(c).rlike("|".join(re.escape(x) for x in codes))
    else:
        hit = F.arrays_overlap(split_codes(c, sep), F.array(*[F.lit(x) for x in codes]))
    return F.coalesce(hit, F.lit(False))


def replace_codes(c, code_map: Mapping[str, str], sep: str = "~") -> Column:
    """Map every code to its name, keep unknown codes, join again with ``sep``.

    ``code_map`` is a small bounded lookup (see ``sources.business_types``);
    it becomes a MAP literal, so the lookup runs inside generated code with no
    join or shuffle. NULL lists stay NULL.
    """
    if not code_map:
        return _col(c)
    if isinstance(c, str):
        pairs = ", ".join(f"{_sql_str(k)}, {_sql_str(v)}" for k, v in code_map.items())
        col = "`" + c.replace("`", "``") + "`"
        return F.expr(f"CASE WHEN {col} IS NOT NULL THEN array_join(transform(split({col}, {_sql_str(re.escape(sep))}), "
                      f"t -> coalesce(element_at(map({pairs}), t), t)), {_sql_str(sep)}) END")
    m = F.create_map(*[x for k, v in code_map.items() for x in (F.lit(k), F.lit(v))])
    names = F.transform(split_codes(c, sep), lambda t: F.coalesce(F.element_at(m, t), t))
    return F.when(_col(c).isNotNull(), F.array_join(names, sep))


def words_all_present(c, words: Iterable[str], ignore_case: bool = True) -> Column:
    """Every word occurs somewhere in the text, in any order.

    Same rows as the look-ahead regex ``(?=.*City)(?=.*County)``; written as
    a conjunction of substring tests so it stays a simple generated predicate.
    NULL text gives FALSE.
    """
    x = F.lower(_col(c)) if ignore_case else _col(c)
    cond = None
    for w in words:
        w = w.lower() if ignore_case else w
        t = x.contains(w)
        cond = t if cond is None else (cond & t)
    return F.coalesce(cond, F.lit(False))
