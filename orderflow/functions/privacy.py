"""Encryption of personal values and the ids derived from them.

The key and the initialisation vector are always arguments; neither is stored
here. Set ``spark.redaction.string.regex`` on the cluster so that literals do
not show in plans and event logs.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_IV_BYTES = 16


def encrypt(text: Column, key: str, iv: str | None) -> Column:
    """AES-CBC, PKCS7, base64. Null and empty text give ``''``.

    With a fixed ``iv`` equal text gives equal output, which joins on encrypted
    numbers need. ``iv=None`` draws a random one per value and keeps it in front.
    """
    if iv is None:
        sealed = F.base64(F.aes_encrypt(text, F.lit(key), F.lit("CBC"), F.lit("PKCS")))
    else:
        with_iv = F.aes_encrypt(text, F.lit(key), F.lit("CBC"), F.lit("PKCS"), F.lit(iv.encode()))
        sealed = F.base64(F.substr(with_iv, F.lit(_IV_BYTES + 1)))
    return F.when(text.isNull() | (text == ""), F.lit("")).otherwise(sealed)


def decrypt(text: Column, key: str, iv: str | None) -> Column:
    """Reverse of ``encrypt``; null where the value cannot be read, which includes ``''``."""
    sealed = F.try_to_binary(F.nullif(text, F.lit("")), F.lit("base64"))
    if iv is not None:
        sealed = F.concat(F.lit(iv.encode()), sealed)
    return F.try_aes_decrypt(sealed, F.lit(key), F.lit("CBC"), F.lit("PKCS")).cast("string")


def stable_id(text: Column) -> Column:
    """MD5 of the text written as a UUID."""
    digest = F.md5(text)
    piece = lambda start, size: F.substring(digest, start, size)
    parts = [piece(1, 8), piece(9, 4), piece(13, 4), piece(17, 4), piece(21, 12)]
    return F.when(text.isNotNull(), F.concat_ws("-", *parts))
