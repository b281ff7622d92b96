"""Row fingerprints, surrogate keys, group keys and unknown-member keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# The unknown member's surrogate key and natural id.
UNKNOWN_KEY = "0" * 64
UNKNOWN_ID = "00000000-0000-0000-0000-000000000000"

SEPARATOR = "|"
_NULL_MARK = "~"


def _cols(columns: Iterable) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def fingerprint(columns: Iterable, mode: str = "strict") -> Column:
    """Identity of a raw row.

    ``compat`` is the plain joined text, which skips NULL and therefore lets
    ``(a, NULL, b)`` collide with ``(a, b, NULL)``. ``strict`` marks NULLs, writes the
    length of every value in front of it, and digests the text, so distinct rows never
    share a fingerprint and the merge key stays 64 characters wide.
    """
    cols = _cols(columns)
    if mode == "compat":
        return F.concat_ws(SEPARATOR, *cols)
    if mode != "strict":
        raise ValueError(f"unknown fingerprint mode {mode!r}")
    parts = []
    for c in cols:
        text = c.cast("string")
        parts.append(
            F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(_NULL_MARK))
        )
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def joined_text(columns: Iterable) -> Column:
    columns = list(columns)
    if all(isinstance(c, str) for c in columns):
        return F.expr(f"concat_ws('{SEPARATOR}', {', '.join(f'`{c}`' for c in columns)})")
    return F.concat_ws(SEPARATOR, *_cols(columns))


def surrogate_key(columns: Iterable) -> Column:
    """64 lower-case hex digits over null-defaulted attributes, in the given order.

    The joined text is never NULL; saying so to Catalyst keeps it from pushing a null check
    with dozens of aliased inputs through every join on the key.
    """
    return F.coalesce(F.sha2(joined_text(columns), 256), unknown_key())


def md5_key(columns: Iterable) -> Column:
    """32 upper-case hex digits, the key style of the SQL-model twin of the star."""
    return F.coalesce(F.upper(F.md5(joined_text(columns))), unknown_key())


def group_key(encounter_id) -> Column:
    """Key shared by all ten groups of one encounter."""
    return F.sha2(_cols([encounter_id])[0].cast("string"), 256)


def unknown_key() -> Column:
    return F.lit(UNKNOWN_KEY)
