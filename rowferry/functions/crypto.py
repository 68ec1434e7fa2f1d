"""AES-256-GCM on columns through Spark's own ``aes_encrypt``.

The data key is looked up once on the driver by its reference. Spark carries
it in the plan as a literal; :func:`rowferry.session.configure` hides it from
plan text.
"""

from __future__ import annotations

import base64

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowferry.config import resolve_secret
from rowferry.errors import ConfigError


def data_key(key_ref: str) -> bytes:
    """Fetch the key named by ``key_ref`` (``env:NAME`` or the value), base64 text of 32 bytes."""
    try:
        key = base64.b64decode(resolve_secret(key_ref), validate=True)
    except ValueError:
        raise ConfigError("the data key is not base64 text") from None
    if len(key) != 32:
        raise ConfigError("AES-256 needs a key of 32 bytes")
    return key


def encrypt_value(col: Column, key: bytes, aad: str = "") -> Column:
    """Base64 text of a random IV, the cipher text and the tag."""
    sealed = F.aes_encrypt(
        col.cast("string"), F.lit(key), F.lit("GCM"), F.lit("DEFAULT"), F.lit(""), F.lit(aad)
    )
    return F.base64(sealed)


def decrypt_value(col: Column, key: bytes, aad: str = "") -> Column:
    """The clear text, or null where the key, the tag or the text is wrong."""
    sealed = F.try_to_binary(col, F.lit("base64"))
    opened = F.try_aes_decrypt(sealed, F.lit(key), F.lit("GCM"), F.lit("DEFAULT"), F.lit(aad))
    return opened.cast("string")
