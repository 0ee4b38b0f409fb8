"""Join keys that stay balanced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN = (T.StringType, T.IntegralType, T.FractionalType)
_SPREAD = 4096

#: Helper columns begin with this, so that they clash with no column of the user.
RESERVED = "_vx_"


def plain_columns(df: DataFrame) -> list[str]:
    """Names of the text and number columns."""
    return [f"`{f.name}`" for f in df.schema.fields if isinstance(f.dataType, _PLAIN)]


def spread_nulls(key: Column, *columns) -> Column:
    """A text join key whose nulls are spread over values that match nothing.

    In a shuffled left join all null keys would otherwise meet in one task. The
    spread comes from other columns of the row, so a repeated task repeats it.
    """
    filler = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*columns), F.lit(_SPREAD)))
    return F.coalesce(key, filler)
