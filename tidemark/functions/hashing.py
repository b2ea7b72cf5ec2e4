"""Content hashes of a row, used to notice changed rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BARE = (
    T.NumericType,
    T.BooleanType,
    T.DateType,
    T.TimestampNTZType,
    T.DayTimeIntervalType,
    T.YearMonthIntervalType,
)

# Full precision for timestamps inside nested values.
_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_MICROS = _NTZ + "XXX"


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the columns joined by dots; NULLs are left out of the text."""
    return F.sha2(F.concat_ws(".", *[F.col(f"`{c}`") for c in columns]), 256)


def row_fingerprint(fields: Iterable[T.StructField]) -> Column:
    """SHA-256 of a text that differs for any two different rows of one schema.

    NULL has a mark of its own, and text is written with its length in front, so
    neither a NULL nor a separator inside a value can pass for something else.
    Instants are written as such, so the session's time zone plays no part.
    Columns are taken in name order: reordering the columns of a source is not a
    change.
    """
    ordered = sorted(fields, key=lambda f: f.name.lower())
    return F.sha2(F.concat_ws("|", *[_framed(f) for f in ordered]), 256)


def _framed(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BinaryType):
        text = F.hex(value)
    elif isinstance(field.dataType, T.TimestampType):
        text = F.unix_micros(value).cast("string")
    elif isinstance(field.dataType, _BARE):
        # Written out, these never hold the separator or the mark.
        text = value.cast("string")
    else:
        text = value if isinstance(field.dataType, T.StringType) else _nested(value)
        text = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(text, F.lit("~"))


def _nested(value: Column) -> Column:
    options = {
        "ignoreNullFields": "false",
        "timeZone": "UTC",
        "timestampFormat": _MICROS,
        "timestampNTZFormat": _NTZ,
    }
    return F.to_json(value, options)
