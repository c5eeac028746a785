"""Scalar column functions used across the job.

Timestamps travel as ISO text; a day is the first 10 characters and a second
the first 19, so text comparison orders them correctly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(c: Column | str) -> Column:
    """``yyyy-MM-dd`` prefix of an ISO timestamp text."""
    return F.substring(_col(c), 1, 10)


def second_of(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` prefix of an ISO timestamp text."""
    return F.substring(_col(c), 1, 19)


def blank_to(c: Column | str, sentinel: str, otherwise: Column | None = None) -> Column:
    """Empty text becomes ``sentinel``; NULL stays NULL; anything else is
    ``otherwise`` (default: the value itself)."""
    col = _col(c)
    return F.when(col == F.lit(""), F.lit(sentinel)).otherwise(col if otherwise is None else otherwise)


def strip_city_suffix(c: Column | str) -> Column:
    """Remove every occurrence of the city suffix character."""
    return F.replace(_col(c), F.lit("市"), F.lit(""))


def tolerant_cast(c: Column | str, to: str) -> Column:
    """Cast that yields NULL on text that does not parse or on overflow,
    instead of failing the job (ANSI mode stays on elsewhere)."""
    return _col(c).try_cast(to)


def sorted_set_text(c: Column | str, sep: str = ",") -> Column:
    """Distinct non-NULL values, sorted, joined by ``sep`` (``''`` if none).

    Use inside ``agg``. Sorting makes the text independent of task order.
    """
    return F.array_join(F.array_sort(F.collect_set(_col(c))), sep)


def default_rowkey(user_col: str = "user_id", merchant_col: str = "merchant_num") -> Column:
    """Hex prefix of the key hash, then tenant and user, of their raw texts.

    Different (tenant, user) pairs have different keys: NULL is ``\\N``, a
    backslash is doubled, and an underscore of the tenant gets one before it.
    """
    text = lambda c: F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\"))
    u = F.coalesce(text(user_col), F.lit("\\N"))
    m = F.coalesce(F.replace(text(merchant_col), F.lit("_"), F.lit("\\_")), F.lit("\\N"))
    return F.concat(F.substring(F.md5(F.concat(u, F.lit("_"), m)), 1, 8), F.lit("_"), m, F.lit("_"), u)


def render_value(c: Column | str, data_type: DataType) -> Column:
    """Cell text of a value: arrays, maps and structs as JSON, anything else
    as its string form; NULL stays NULL (the cell is then dropped)."""
    col = _col(c)
    if isinstance(data_type, (ArrayType, MapType, StructType)):
        return F.to_json(col)
    return col.cast("string")
