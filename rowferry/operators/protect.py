"""Masking and encryption of whole columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.functions import crypto, masking
from rowferry.functions.records import name
from rowferry.operators.mapping import add_errors


def mask_hash(df: DataFrame, columns: Iterable[str], salt: str | None = None) -> DataFrame:
    return df.withColumns({c: masking.sha256_hex(name(c), salt) for c in columns})


def mask_redact(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: masking.redact(name(c)) for c in columns})


def mask_partial(df: DataFrame, columns: Iterable[str], keep: int = 4) -> DataFrame:
    return df.withColumns({c: masking.keep_last(name(c), keep) for c in columns})


def encrypt(df: DataFrame, columns: Iterable[str], key_ref: str, aad: str = "") -> DataFrame:
    """AES-256-GCM with a fresh IV per value, as base64 text."""
    key = crypto.data_key(key_ref)
    return df.withColumns({c: crypto.encrypt_value(name(c), key, aad) for c in columns})


def decrypt(df: DataFrame, columns: Iterable[str], key_ref: str, aad: str = "") -> DataFrame:
    """The reverse; a wrong key, tag or text gives null and ``decrypt:<column>`` in ``_errors``."""
    key = crypto.data_key(key_ref)
    columns = list(columns)
    opened = df.withColumns({f"_clear_{c}": crypto.decrypt_value(name(c), key, aad) for c in columns})
    refused = [
        F.when(name(c).isNotNull() & name(f"_clear_{c}").isNull(), F.lit(f"decrypt:{c}")) for c in columns
    ]
    marked = add_errors(opened, refused)
    clear = marked.withColumns({c: name(f"_clear_{c}") for c in columns})
    return clear.drop(*[f"_clear_{c}" for c in columns])
