"""The corpus operators as queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import documents, stored


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import detect, digest

    return digest(detect(documents(spark, sf_dir)))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import kept_lines

    return kept_lines(documents(spark, sf_dir))


def op3_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .gif_media import digest, store

    return digest(stored(store(documents(spark, sf_dir)), "gif"))


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import repeated_passages

    return repeated_passages(documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import classes

    return classes(documents(spark, sf_dir)).drop("row")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import classes

    return classes(documents(spark, sf_dir)).drop("row")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score, train

    docs = documents(spark, sf_dir)
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .subword import digest

    return digest(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op10_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .wavelet import encode_and_read

    return encode_and_read(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_pii, op2_line_dedup, op3_gif, op4_suffix_array, op5_exact_dedup, op6_minhash, op7_quality, op8_packing, op9_sentencepiece, op10_wavelet)}

ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
        g AS (SELECT norm, arg_min(doc_id, (-n, doc_id)) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM d JOIN g USING (norm)
    """,
}
