"""Column expressions for transaction records."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The numeric code of each transaction type; any other type is 0.
TYPE_CODES = {"CASH_IN": 1.0, "CASH_OUT": 2.0, "DEBIT": 3.0, "PAYMENT": 4.0, "TRANSFER": 5.0}


def type_code(column: Column) -> Column:
    code = F.lit(0.0)
    for name, value in TYPE_CODES.items():
        code = F.when(column == name, F.lit(value)).otherwise(code)
    return code


def drop_first(column: Column) -> Column:
    """The text without its first character."""
    return F.substring(column, 2, 2_147_483_647)


def mismatch(left: Column, right: Column) -> Column:
    """0.0 where the two are equal, else 1.0."""
    return F.when(left == right, 0.0).otherwise(1.0)


def gap(left: Column, right: Column) -> Column:
    return F.abs(left - right)


def record_line(columns: Sequence[str], sep: str = ",", null: str = "") -> Column:
    """The fields of a row as one delimited text; a missing field keeps its place, as the text `null`."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit(null)) for c in columns])


def fields(line: Column, sep: str = ",", limit: int = -1) -> Column:
    """A delimited text as an array; `limit` as in `split`."""
    return F.split(line, re.escape(sep) if sep != "," else sep, limit)


def hash_bucket(key: Column, seed: int, buckets: int) -> Column:
    """A repeatable pseudo-random bucket in `0 .. buckets - 1` from the MD5 of seed and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets
