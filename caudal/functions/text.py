"""Text normalisation, code tables and stable keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from caudal.functions.numeric import column

# Codes of the residence types.
RESIDENCE_CODES = {"total": "TOT", "urban": "URB", "rural": "RUR"}
UNKNOWN_RESIDENCE = "UNK"


def clean_text(value: Column | str) -> Column:
    return F.lower(F.trim(column(value)))


def lookup(value: Column | str, table: Mapping[str, str]) -> Column:
    """Entry of a small constant table, NULL when the value has none."""
    entries = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in table.items()))
    return F.when(column(value).isNotNull(), F.try_element_at(entries, column(value)))


def code_of(value: Column | str, table: Mapping[str, str], default: str) -> Column:
    return F.coalesce(lookup(value, table), F.lit(default))


def label_of(code: Column | str, table: Mapping[str, str]) -> Column:
    """Friendly label, or the code itself when the table has none."""
    return F.coalesce(lookup(code, table), column(code))


def joined_label(parts: Sequence[Column | str], separator: str = " – ") -> Column:
    """Parts joined by a dash; NULL when any part is."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(separator))
        pieces.append(column(part))
    return F.concat(*pieces)


def key_from_path(path: Column | str, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(column(path), pattern, group)


def stable_key(*natural: Column | str) -> Column:
    """60-bit key that depends on the natural key only.

    The same entity gets the same key in every run and on every layout, so facts
    written earlier keep pointing at it. Two of a million entities share a key with
    probability below 1e-6; the refresh checks it when it writes a dimension.
    """
    return F.conv(F.substring(wide_key(*natural), 1, 15), 16, 10).cast("bigint")


def wide_key(*natural: Column | str) -> Column:
    """128-bit key as hexadecimal text, for tables of any number of rows. NULL is not the empty text."""
    return F.md5(F.concat_ws("\u001f", *[F.coalesce(column(c).cast("string"), F.lit("\u001e")) for c in natural]))
