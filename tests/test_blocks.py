"""Contents sealed by blocks: what went in comes out, and nothing else opens."""

import os

import pytest
from pyspark.sql import functions as F

from feedcheck import codes
from feedcheck.operators import blocks as bl
from feedcheck.sources.walk import walked_files

BODIES = {"a": b"0123456789" * 5, "b": b"x" * 16, "c": b"", "d": None, "e": b"short", "f": bytes(range(256))}


def _sealed(spark):
    df = spark.createDataFrame(list(BODIES.items()), "id string, body binary")
    keys = spark.createDataFrame([(k, "caf\u00e9") for k in BODIES], "file_id string, passphrase string")
    sealed = bl.encrypt_blocks(bl.cut_blocks(df, "id", "body", 16), keys, iterations=10).collect()
    return spark.createDataFrame(sealed, "file_id string, block_no long, is_last boolean, salt binary, iterations int, sealed binary, code string"), keys


def _whole(spark, sealed, keys):
    return {r.file_id for r in bl.whole_files(bl.decrypt_blocks(sealed, keys)).collect() if r.whole}


def test_round_trip(spark):
    sealed, keys = _sealed(spark)
    nonces = [bytes(r.sealed)[:12] for r in sealed.collect()]
    assert len(set(nonces)) == len(nonces) == 4 + 1 + 1 + 1 + 1 + 16
    spelt = keys.withColumn("passphrase", F.lit("café"))
    rows = bl.decrypt_blocks(sealed, spelt).orderBy("file_id", "block_no").collect()
    out = {}
    for r in rows:
        out[r.file_id] = out.get(r.file_id, b"") + bytes(r.content)
    assert out == {k: v or b"" for k, v in BODIES.items()}
    got = {r.file_id: (r.n_blocks, r.n_bytes, r.whole) for r in bl.whole_files(bl.decrypt_blocks(sealed, keys)).collect()}
    assert got == {"a": (4, 50, True), "b": (1, 16, True), "c": (1, 0, True), "d": (1, 0, True), "e": (1, 5, True), "f": (16, 256, True)}


def test_damage_is_seen(spark):
    sealed, keys = _sealed(spark)
    every, place = set(BODIES), F.col("block_no")
    a = F.col("file_id") == "a"
    flip = F.concat(F.substring("sealed", 1, 13), F.unhex(F.lit("00")), F.substring("sealed", F.lit(15), F.lit(1 << 20)))
    damaged = [
        sealed.withColumn("block_no", F.when(a & (place < 2), 1 - place).otherwise(place)),
        sealed.filter(~(a & F.col("is_last"))),
        sealed.filter(~(a & (place == 1))),
        sealed.filter(~(a & F.col("is_last"))).withColumn("is_last", F.when(a & (place == 2), True).otherwise(F.col("is_last"))),
        sealed.unionByName(sealed.filter(a & (place == 1))),
        sealed.filter(~(a & (place == 0))).unionByName(sealed.filter("file_id = 'f' and block_no = 0").withColumn("file_id", F.lit("a"))),
        sealed.withColumn("sealed", F.when(a & (place == 3), flip).otherwise(F.col("sealed"))),
        sealed.filter(~(a & (place == 0))).unionByName(sealed.filter(a & (place == 1))),
    ]
    for n, frame in enumerate(damaged):
        assert _whole(spark, frame, keys) == every - {"a"}, n


def test_passphrases(spark):
    sealed, keys = _sealed(spark)
    assert _whole(spark, sealed, keys.withColumn("passphrase", F.lit("other"))) == set()
    mixed = spark.createDataFrame([("a", None), ("b", "")], "file_id string, passphrase string")
    cut = bl.cut_blocks(spark.createDataFrame([("a", b"1"), ("b", b"2"), ("z", b"3")], "id string, body binary"), "id", "body")
    rows = {r.file_id: (r.sealed, r.code) for r in bl.encrypt_blocks(cut, mixed, 10).collect()}
    assert rows == {"a": (None, codes.PASSPHRASE_NULL), "b": (None, codes.PASSPHRASE_EMPTY), "z": (None, codes.PASSPHRASE_NULL)}


def test_files_are_read_by_blocks(spark, folder):
    bodies = {"one": os.urandom(1000), "none": b"", "even": os.urandom(512)}
    for name, body in bodies.items():
        with open(f"{folder}/{name}", "wb") as out:
            out.write(body)
    files = walked_files(spark, folder).cache()
    rows = bl.read_blocks(files, 256).orderBy("file_id", "block_no").collect()
    assert {r.file_id: r.block_no for r in rows if r.is_last} == {f"{folder}/one": 3, f"{folder}/none": 0, f"{folder}/even": 1}
    for name, body in bodies.items():
        assert b"".join(bytes(r.content) for r in rows if r.file_id.endswith("/" + name)) == body
    assert bl.read_blocks(files.limit(0)).count() == 0
    files.count()
    os.truncate(f"{folder}/one", 10)
    with pytest.raises(Exception, match="shorter"):
        bl.read_blocks(files, 256).collect()
