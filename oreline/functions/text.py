"""Hashing and string parsing expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_MODES = ("compat", "safe")


def row_hash(columns: Sequence[str], mode: str = "safe") -> Column:
    """SHA-256 over the string form of ``columns``.

    ``compat`` joins the values with ``|`` and skips NULLs, so some different
    rows share a hash (``('a', NULL, 'b')`` and ``('a', 'b')``).  ``safe`` puts
    each value's length in front of it and writes NULL as ``~``.
    """
    if mode not in HASH_MODES:
        raise ValueError(f"hash mode must be one of {HASH_MODES}, not {mode!r}")
    texts = [F.col(c).cast("string") for c in columns]
    if mode == "safe":
        texts = [
            F.coalesce(
                F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")
            )
            for t in texts
        ]
    return F.sha2(F.concat_ws("|", *texts), 256)


# A plain decimal number: the only text with a point that an integer column takes.
_PLAIN_DECIMAL = r"^\s*[+-]?(?:[0-9]+\.[0-9]*|\.[0-9]+)\s*$"
# A clock time followed by a zone offset or zone letter.
_ZONED_TIME = r":[0-9]{2}.*(?:[zZ]|[+-][0-9:]+)\s*$"


def parse_text(raw: Column, target: T.DataType) -> Column:
    """Type one raw text value; text that does not parse becomes NULL.

    Integers accept and truncate a decimal fraction.  A timestamp that carries
    a zone is moved to UTC; one without is taken as it stands.
    """
    if isinstance(target, T.StringType):
        return raw
    if isinstance(target, (T.LongType, T.IntegerType, T.ShortType)):
        truncated = raw.try_cast(T.DecimalType(38, 18))
        # ``rlike`` runs only on values that hold a point.
        has_fraction = raw.contains(".") & raw.rlike(_PLAIN_DECIMAL)
        toward_zero = F.when(truncated < 0, F.ceil(truncated)).otherwise(
            F.floor(truncated)
        )
        return F.when(has_fraction, toward_zero.try_cast(target)).otherwise(
            raw.try_cast(target)
        )
    if isinstance(target, T.TimestampNTZType):
        epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
        in_utc = F.timestamp_add(
            "MICROSECOND", F.unix_micros(raw.try_cast("timestamp")), epoch
        )
        return F.when(raw.rlike(_ZONED_TIME), in_utc).otherwise(raw.try_cast(target))
    return raw.try_cast(target)
