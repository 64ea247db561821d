"""Person keys and row hashes, all SHA-256.

Stored as 32 binary bytes: half the shuffle and storage of the hex text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sha256(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def person_key(email: Column, charset: str = "UTF-8") -> Column:
    """Hash of the lower-case e-mail.

    ``charset`` must be ``UTF-16LE`` when the other side hashed wide-character
    text; the two encodings never give equal keys.
    """
    return _sha256(F.encode(F.lower(email), charset))


def row_hash_delimited(*columns: Column) -> Column:
    """Trimmed, upper-case values joined by ``|``; NULL counts as empty."""
    parts = [F.coalesce(F.upper(F.trim(c.cast("string"))), F.lit("")) for c in columns]
    return _sha256(F.concat_ws("|", *parts))


def row_hash_plain(*columns: Column) -> Column:
    """Values joined without delimiter; NULL is spelled ``None``."""
    return _sha256(F.concat(*[F.coalesce(c.cast("string"), F.lit("None")) for c in columns]))


def row_hash_strict(*columns: Column) -> Column:
    """Values joined without delimiter; any NULL makes the hash NULL."""
    return _sha256(F.concat(*[c.cast("string") for c in columns]))
