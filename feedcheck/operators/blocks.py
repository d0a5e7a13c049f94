"""Encryption of contents by blocks, so that no row holds a whole file.

Each block is sealed on its own (AES-GCM, a fresh nonce each), bound to its file, its place and to whether it is the last.
A block that was changed, moved, taken from another file or opened with another passphrase does not open; one that is
missing, at the end too, or there twice shows when the blocks of a file are counted.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..sources.walk import open_bytes
from .crypt import normalise_passphrase, passphrase_code

BLOCK = 1 << 20
ITERATIONS = 200_000
_CUT = "file_id string, block_no long, is_last boolean, content binary"


def cut_blocks(df: DataFrame, file_id: str, content: str, size: int = BLOCK) -> DataFrame:
    """``file_id, block_no, is_last, content`` of a binary column. An empty or missing content is one empty block."""
    whole = F.coalesce(F.col(content), F.lit(b""))
    last = F.greatest(F.ceil(F.octet_length(whole) / F.lit(size)) - 1, F.lit(0)).cast("bigint")
    rows = df.select(F.col(file_id).cast("string").alias("file_id"), whole.alias("whole"), last.alias("last"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))).alias("block_no"))
    piece = F.substring("whole", (F.col("block_no") * size + 1).cast("int"), F.lit(size))
    return rows.select("file_id", "block_no", (F.col("block_no") == F.col("last")).alias("is_last"), piece.alias("content"))


def read_blocks(files: DataFrame, size: int = BLOCK) -> DataFrame:
    """The same of files on disk (``path``, ``size``, as ``walk`` lists them), each block read by a seek of its own.
    ``file_id`` is the path. A file that has become shorter since stops the job."""
    last = F.greatest(F.ceil(F.col("size") / F.lit(size)) - 1, F.lit(0)).cast("bigint")
    places = files.select(F.col("path").alias("file_id"), F.col("size").alias("bytes"), last.alias("last"))
    places = places.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))).alias("block_no"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, total, end, n in zip(batch["file_id"], batch["bytes"], batch["last"], batch["block_no"]):
                want = min(size, total - n * size)
                with open_bytes(path) as f:
                    f.seek(n * size)
                    content = f.read(want)
                if len(content) != want:
                    raise OSError(f"{path} has become shorter")
                yield pd.DataFrame({"file_id": [path], "block_no": [n], "is_last": [n == end], "content": [content]})

    # Spread by place, so that a large file is not one task's.
    return places.repartition("file_id", "block_no").mapInPandas(read, _CUT)


@lru_cache(maxsize=4096)
def _derived(passphrase: str, salt: bytes, iterations: int) -> bytes:
    return hashlib.pbkdf2_hmac("sha256", normalise_passphrase(passphrase).encode(), salt, iterations, 32)


@F.pandas_udf(BinaryType())
def _master(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for passphrase, salt, iterations in batches:
        yield pd.Series([None if not p or s is None else _derived(p, bytes(s), int(n)) for p, s, n in zip(passphrase, salt, iterations)], dtype=object)


def _with_file_key(blocks: DataFrame, keys: DataFrame) -> DataFrame:
    """Blocks with ``file_key``, each file's own: from what was derived of its passphrase, and from its id.
    Keys are never written."""
    own = keys.select(F.col("file_id").cast("string").alias("file_id"), "passphrase")
    joined = blocks.join(own, "file_id", "left")
    made = F.unhex(F.sha2(F.concat(_master("passphrase", "salt", "iterations"), F.encode("file_id", "UTF-8")), 256))
    return joined.withColumn("file_key", made)


def _bound() -> Column:
    """What a block is bound to, besides its key."""
    return F.concat(F.col("block_no").cast("string"), F.when(F.col("is_last"), F.lit("/last")).otherwise(F.lit("/more")))


def encrypt_blocks(blocks: DataFrame, keys: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """``file_id, block_no, is_last, salt, iterations, sealed, code`` of cut blocks.

    ``keys`` has one row per file, ``file_id, passphrase``. A call has one random salt, and what is derived from a passphrase
    (PBKDF2, SHA-256) is remembered by the tasks, so its cost goes by passphrases; every file has a key of its own.
    ``sealed`` is null where the passphrase is missing or empty, with the reason in ``code``. Nonces are random,
    so a file may have up to 2^32 blocks.
    """
    salted = blocks.withColumns({"salt": F.lit(os.urandom(16)), "iterations": F.lit(iterations)})
    sealed = F.aes_encrypt(F.col("content"), F.col("file_key"), F.lit("GCM"), F.lit("DEFAULT"), F.lit("").cast("binary"), _bound())
    out = _with_file_key(salted, keys).withColumns({"sealed": sealed, "code": passphrase_code(F.col("passphrase"))})
    return out.select("file_id", "block_no", "is_last", "salt", "iterations", "sealed", "code")


def decrypt_blocks(sealed: DataFrame, keys: DataFrame) -> DataFrame:
    """``file_id, block_no, is_last, content, code``: content is null where a block does not open."""
    opened = F.try_aes_decrypt(F.col("sealed"), F.col("file_key"), F.lit("GCM"), F.lit("DEFAULT"), _bound())
    out = _with_file_key(sealed, keys).withColumns({"content": opened, "code": passphrase_code(F.col("passphrase"))})
    return out.select("file_id", "block_no", "is_last", "content", "code")


def whole_files(opened: DataFrame) -> DataFrame:
    """``file_id, n_blocks, n_bytes, whole`` of decrypted blocks: a file is whole if every block from the first to the
    one that is the last is there once and has opened. Blocks of other files may be used, those of this one not."""
    places = opened.groupBy("file_id", "block_no").agg(
        F.count(F.lit(1)).alias("n"), F.count("content").alias("n_open"), F.bool_or("is_last").alias("ends"), F.sum(F.octet_length("content")).alias("bytes")
    )
    files = places.groupBy("file_id").agg(
        F.sum("n").alias("n_blocks"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("n_bytes"), F.max("n").alias("most"), F.min("n_open").alias("fewest"),
        F.min("block_no").alias("first"), F.max("block_no").alias("top"), F.count_if("ends").alias("ends"), F.max(F.when(F.col("ends"), F.col("block_no"))).alias("end"),
    )
    whole = (F.col("most") == 1) & (F.col("fewest") == 1) & (F.col("first") == 0) & (F.col("top") + 1 == F.col("n_blocks")) & (F.col("ends") == 1) & (F.col("end") == F.col("top"))
    return files.select("file_id", "n_blocks", "n_bytes", F.coalesce(whole, F.lit(False)).alias("whole"))
