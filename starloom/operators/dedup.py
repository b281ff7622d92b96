"""Exact de-duplication and reduction to the latest version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.functions.keys import fingerprint


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct. Copies collapse in the map-side aggregate before the shuffle."""
    return df.dropDuplicates()


def distinct_by_fingerprint(
    df: DataFrame, mode: str = "strict", name: str = "HASH", packed: bool = False
) -> DataFrame:
    """Add the fingerprint and keep one row per fingerprint.

    ``strict`` shuffles on one 64-character key instead of every column, and what follows by
    that key needs no further shuffle. ``compat`` fingerprints may collide, so there the whole
    row decides, as in a first load.

    ``packed`` is for extracts that are only written: rows of one strict fingerprint are equal,
    so each row is packed into one text, and distinct texts are fingerprinted after the shuffle.
    A text takes a third to half of the room there, as a digest does not compress. Columns that
    cannot be packed are shuffled as they are.
    """
    columns = df.columns
    if mode == "compat":
        return df.dropDuplicates().withColumn(name, fingerprint(columns, mode))
    if packed and mode == "strict" and _packable(df, name):
        rows = _unpacked(df.select(_packed(df).alias(_PACKED)).distinct(), df.schema)
        return rows.withColumn(name, fingerprint(columns, mode))
    return df.withColumn(name, fingerprint(columns, mode)).dropDuplicates([name])


_PACKED, _BETWEEN, _MARK = "_packed", "\x1f", "\x01"
#: what a value may hold, and what stands for it in a packed row; a mark alone is NULL
_ESCAPES = [(_MARK, f"{_MARK}\x02"), (_BETWEEN, f"{_MARK}\x03")]
#: before the hexadecimal digits of bytes that are no text
_BYTES = f"{_MARK}\x04"
#: types that come back from a text as they were
_PLAIN = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType, T.DateType)


def _packable(df: DataFrame, name: str) -> bool:
    """Whether every value comes back from its text. An instant does where no hour comes twice."""
    columns, zone = df.columns, df.sparkSession.conf.get("spark.sql.session.timeZone")
    instants = any(isinstance(f.dataType, T.TimestampType) for f in df.schema)
    return (
        len(set(map(str.lower, columns))) == len(columns) and name.lower() not in map(str.lower, columns)
        and all(isinstance(f.dataType, (*_PLAIN, T.TimestampType)) or f.dataType == T.StringType() for f in df.schema)
        and not (instants and zone not in ("UTC", "Etc/UTC", "GMT", "Z"))
    )


def _packed(df: DataFrame) -> Column:
    parts = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.unix_date(c)
        elif isinstance(f.dataType, T.TimestampType):
            c = F.unix_micros(c)
        text = c.cast("string")
        if isinstance(f.dataType, T.StringType):
            for plain, escaped in _ESCAPES:
                text = F.replace(text, F.lit(plain), F.lit(escaped))
            text = F.when(F.is_valid_utf8(c), text).otherwise(F.concat(F.lit(_BYTES), F.hex(c)))
        parts.append(F.coalesce(text, F.lit(_MARK)))
    return F.concat_ws(_BETWEEN, *parts)


def _unpacked(rows: DataFrame, schema: T.StructType) -> DataFrame:
    rows = rows.select(F.split(_PACKED, _BETWEEN).alias(_PACKED))
    out = []
    for i, f in enumerate(schema):
        text = F.nullif(F.col(_PACKED)[i], F.lit(_MARK))
        if isinstance(f.dataType, T.StringType):
            value = text
            for plain, escaped in reversed(_ESCAPES):
                value = F.replace(value, F.lit(escaped), F.lit(plain))
            raw = F.unhex(F.substring(text, len(_BYTES) + 1, 2**31 - 1)).cast("string")
            value = F.when(text.startswith(_BYTES), raw).otherwise(value)
        elif isinstance(f.dataType, T.DateType):
            value = F.date_from_unix_date(text.cast("int"))
        elif isinstance(f.dataType, T.TimestampType):
            value = F.timestamp_micros(text.cast("bigint"))
        else:
            value = text.cast(f.dataType)
        out.append(value.alias(f.name, metadata=f.metadata) if f.metadata else value.alias(f.name))
    return rows.select(*out)


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The greatest row per key in ``order``.

    Written as an aggregate rather than a ranking window: every map task first keeps only
    its own best row per key, so a key that owns a third of all rows costs one row per task
    in the shuffle. ``order`` should end in a unique column to make ties repeatable.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return (
        df.groupBy(*keys)
        .agg(best)
        .select(*keys, *[F.col("_best")[c].alias(c) for c in rest])
        .select(*df.columns)
    )
