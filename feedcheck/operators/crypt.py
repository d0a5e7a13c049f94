"""Encryption and decryption of columns and file contents with per-feed keys."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import codes


def normalise_passphrase(text: str | None) -> str | None:
    return None if text is None else unicodedata.normalize("NFC", text)


def decrypt_col(col: Column, key: Column | str) -> Column:
    """Text of an encrypted configuration column; key of 16, 24 or 32 bytes."""
    key = F.lit(key) if isinstance(key, str) else key
    return F.aes_decrypt(col, key, F.lit("ECB"), F.lit("PKCS")).cast("string")


def passphrase_code(key: Column) -> Column:
    return F.when(key.isNull(), F.lit(codes.PASSPHRASE_NULL)).when(F.length(key) == 0, F.lit(codes.PASSPHRASE_EMPTY))


@F.pandas_udf(StringType())
def _composed(text: pd.Series) -> pd.Series:
    return text.map(normalise_passphrase, na_action="ignore")


def one_spelling(key: Column) -> Column:
    """A passphrase in composed form (NFC), so that both spellings of a letter with an accent are one key.
    Spark has no such function: a batch of passphrases goes through Python, the contents do not."""
    return F.when(key.rlike(r"\A\p{ASCII}*\z"), key).otherwise(_composed(key))


def _usable(key: Column) -> Column:
    return F.when(passphrase_code(key).isNull(), F.sha2(one_spelling(key), 256))


def _key(key: Column) -> Column:
    """32 bytes from a passphrase of any length."""
    return F.unhex(_usable(key))


def encrypt_content(df: DataFrame, content: str, key: str, into: str = "encrypted", armor: bool = False) -> DataFrame:
    """Encrypt a binary column with each row's own passphrase; ``<into>_code`` says why not."""
    value = F.aes_encrypt(F.col(content), _key(F.col(key)), F.lit("GCM"))
    return df.withColumns({into: F.base64(value) if armor else value, f"{into}_code": passphrase_code(F.col(key))})


def decrypt_content(df: DataFrame, content: str, key: str, into: str = "decrypted", armor: bool = False) -> DataFrame:
    """Decrypt a column; null where the passphrase is missing or wrong."""
    source = F.unbase64(F.col(content)) if armor else F.col(content)
    value = F.try_aes_decrypt(source, _key(F.col(key)), F.lit("GCM"))
    return df.withColumns({into: value, f"{into}_code": passphrase_code(F.col(key))})
