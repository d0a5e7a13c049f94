"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedcheck.llm import bpe, exact, html, kneser, langid, minhash, neighbours, packing, phrases, runs, suffixes, tokenfiles, urls
from feedcheck.llm.common import table

END_ID = 2

#: Rules of the URL query: (verdict, host, path).
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_digests(suffixes.repeats(table(spark, sf_dir, "documents"), size=400))


def op3_tokenfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tokenfiles.write_token_files(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), END_ID)
    return tokenfiles.sequence_digests(tokenfiles.read_index(spark, folder))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.coding_digests(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op6_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), END_ID, size=4096)


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.main_texts(pages, html.fit(pages))


def op11_kneser(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = "crc32(cast(cast(doc_id as string) as binary)) % 7 = 2"
    return kneser.score(docs, kneser.fit(docs.filter(f"not coalesce({held_out}, false)")), held_out)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), words=3, least=10, inside=50, limit=2000)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(table(spark, sf_dir, "documents"), runs.repeated_tail)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_minhash, op2_suffixes, op3_tokenfiles, op4_bpe, op5_language, op6_exact, op7_neighbours, op8_urls, op9_packing, op10_html, op11_kneser, op12_phrases, op13_runs)
}
