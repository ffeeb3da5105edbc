"""Strict text-to-number conversion."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_number(
    value: Column, data_type: str = "double", missing: Collection[str] = ()
) -> Column:
    """Parse text as ``data_type``; blank text is null, other bad text fails the job.

    Texts in ``missing`` are null as well. A decimal that would have to be rounded is bad text.
    The failure does not depend on the
    session's ANSI setting.
    """
    text = value.cast("string")
    target = _parsed(data_type)
    number = text.try_cast(data_type)
    if isinstance(target, T.DecimalType):
        # The same text with all digits that it can have behind the point.
        whole = text.try_cast(T.DecimalType(38, 38 - target.precision + target.scale))
        number = F.when(number == whole, number)
    if data_type in ("double", "float"):
        # A cast takes "12d" and "12f" for numbers, but "inf" is one.
        endings = [F.rtrim(text).endswith(letter) for letter in "dDfF"]
        suffixed = reduce(lambda a, b: a | b, endings)
        number = F.when(~suffixed | (F.abs(number) == float("inf")), number)
        if missing:
            number = F.when(~F.isnan(number), number)
    is_bad = F.trim(text) != ""
    if missing:
        is_bad = is_bad & ~text.isin(*missing)
    return F.coalesce(number, F.when(is_bad, _complaint(text, data_type)))


def _parsed(data_type: str) -> T.DataType:
    return T.StructType.fromDDL(f"x {data_type}")["x"].dataType


def _complaint(value: Column, data_type: str) -> Column:
    told = F.concat(F.lit(f"not a {data_type}: "), value.cast("string"))
    return F.raise_error(told).cast(data_type)


# Fixed value: the types that hold all values of an integer type.
_WIDER = {
    "tinyint": ("smallint", "int", "bigint"),
    "smallint": ("int", "bigint"),
    "int": ("bigint",),
}


def convert_number(value: Column, given: T.NumericType, data_type: str) -> Column:
    """Cast a number to another type, failing where that changes its value.

    Floating-point types take any number, as nearly as they can. A cast that cannot fail is left
    plain, so that filters on it reach the scan.
    """
    target = _parsed(data_type)
    if target == given:
        return value
    wider = target.simpleString() in _WIDER.get(given.simpleString(), ())
    if isinstance(given, T.DecimalType) and isinstance(target, T.DecimalType):
        room = target.precision - target.scale - (given.precision - given.scale)
        wider = room >= 0 and target.scale >= given.scale
    if wider or isinstance(target, (T.FloatType, T.DoubleType)):
        return value.cast(target)
    number = value.try_cast(target)
    same = number.cast(given) == value
    return F.when(value.isNotNull(), F.when(same, number).otherwise(_complaint(value, data_type)))
