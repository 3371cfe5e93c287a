"""Years, ranges and coordinates in texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _int(text: Column) -> Column:
    return F.nullif(text, F.lit("")).try_cast("int")


def year_of_date(c: Column) -> Column:
    """The first signed run of three or four digits."""
    return _int(F.regexp_extract(c, "([+\\-]?[0-9]{3,4})", 1))


_RANGE = "(?s)^(.*?)[(\\uFF08]\\s*([+\\-]?[0-9]{1,4})\\s*[~\\uFF5E\\-\\u2013]\\s*([+\\-]?[0-9]{1,4})\\s*[)\\uFF09]"


def year_range(c: Column) -> Column:
    """(from, to) of the first bracketed range; none if it belongs to a monk's name."""
    before = F.regexp_extract(c, _RANGE, 1)
    ok = ~F.rtrim(before).rlike("[尼僧師]$")
    return F.struct(F.when(ok, _int(F.regexp_extract(c, _RANGE, 2))).alias("start"), F.when(ok, _int(F.regexp_extract(c, _RANGE, 3))).alias("end"))


def claim_year(time: Column) -> Column:
    n = _int(F.regexp_extract(time, "^([+\\-])([0-9]+)-", 2))
    return F.when(time.startswith("-"), -n).otherwise(n)


def leading_year(c: Column) -> Column:
    return _int(F.regexp_extract(c, "^(-?[0-9]{1,4})", 1))


def int_prefix(c: Column) -> Column:
    return _int(F.regexp_extract(c, "^\\s*([+\\-]?[0-9]+)", 1))


def number_prefix(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "^\\s*([+\\-]?(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)(?:[eE][+\\-]?[0-9]+)?)", 1), F.lit("")).try_cast("double")


def before(last: int, birth: Column, death: Column) -> Column:
    """Lived by the year `last`: died by it, or born by it if the death is not known."""
    return F.coalesce((death <= last) | (death.isNull() & (birth <= last)), F.lit(False))
