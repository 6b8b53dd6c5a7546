"""Pseudonymisation (HSH-1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventsieve.functions.text import col_of, strip_ws

PSEUDONYM_PREFIX = "usr_"
PSEUDONYM_HEX_CHARS = 10


def pseudonymize(c: str | Column, salt: str) -> Column:
    """``usr_`` + the first 10 hex digits of SHA-256(``salt:id``).

    Blank ids and the text ``nan`` map to ``''``.  The salt is a required
    argument: a literal salt in code lets anyone enumerate short ids.
    """
    if not salt:
        raise ValueError("pseudonymize needs a non-empty salt")
    text = F.coalesce(strip_ws(col_of(c).cast("string")), F.lit(""))
    digest = F.sha2(F.concat(F.lit(salt + ":"), text), 256)
    return F.when((text == "") | (F.lower(text) == "nan"), F.lit("")).otherwise(
        F.concat(F.lit(PSEUDONYM_PREFIX), F.substring(digest, 1, PSEUDONYM_HEX_CHARS))
    )
