"""Identifiers, timestamps as text, and hash buckets of a stable key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of generated identifiers and timestamps.
USER_PREFIX = "User_"
USER_DIGITS = 4
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TRANSACTION_PREFIX = "TXN"


def user_id(number: Column) -> Column:
    """``User_0042``: zero-padded to four digits, longer numbers in full.

    Padding runs several times faster than ``format_string``.
    """
    digits = number.cast("string")
    width = F.greatest(F.length(digits), F.lit(USER_DIGITS))
    return F.concat(F.lit(USER_PREFIX), F.lpad(digits, width, F.lit("0")))


def iso_text(timestamp: Column) -> Column:
    return F.date_format(timestamp, ISO_FORMAT)


def transaction_id(timestamp: Column, key: Column) -> Column:
    """``TXN_<epoch ms>_<key>``: repeatable, and unique if the key is."""
    return F.concat_ws(
        "_", F.lit(TRANSACTION_PREFIX), F.unix_millis(timestamp).cast("string"), key.cast("string")
    )


def key_digest(key: Column) -> Column:
    return F.md5(key.cast("string").cast("binary"))


def digest_bucket(digest: Column, word: int, buckets: int) -> Column:
    """Bucket 0..buckets-1 from the ``word``-th 32 bits of a hex digest.

    Different words of one digest act as independent draws, so a row is hashed once.
    """
    hex_word = F.substring(digest, 1 + 8 * word, 8)
    return F.conv(hex_word, 16, 10).cast("bigint") % F.lit(buckets)
