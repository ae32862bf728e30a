"""Token counts through a cache keyed by content digest and tokenizer version; only distinct misses are encoded."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from importlib.metadata import version as library_version

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm.common import LOWER, small_batches
from tracelake.session import materialise

CACHE = "version string, digest string, n_tokens long"
#: Words whose counts a task remembers; beyond it the memory starts anew.
REMEMBERED_WORDS = 400_000


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and of the library release that runs it."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + library_version("tokenizers").encode()).hexdigest()


def content_digest(text):
    """Digest of a text with runs of ASCII white space made one blank and the ends trimmed.

    This tokenizer drops white space between words, so texts that agree here have the same tokens. Null counts as empty.
    """
    return F.sha2(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")), 256)


def word_counter(path: str):
    """Function from a list of texts to their token counts.

    No token spans white space, so a text's count is the sum over its words, and a word met before is not encoded again.
    The tokenizer lower-cases, so A-Z are folded first, but for words that might hold a special string.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    known: dict[bytes, int] = {}

    def count(texts: list[str]) -> list[int]:
        split = [_folded(text.encode("utf-8")).split() for text in texts]
        new = list({word for words in split for word in words if word not in known})
        if len(known) + len(new) > REMEMBERED_WORDS:
            known.clear()
            new = list({word for words in split for word in words})
        encoded = tokenizer.encode_batch_fast([word.decode("utf-8") for word in new], add_special_tokens=False)
        known.update(zip(new, map(len, encoded), strict=True))
        return [sum(map(known.__getitem__, words)) for words in split]

    return count


def _folded(text: bytes) -> bytes:
    return text if b"<|" in text else text.translate(LOWER)


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Digest and count of one tokenizer version; an absent cache is empty. Rows appended twice count once."""
    try:
        rows = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE)
    return rows.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row; the cache folder gains the contents it lacked.

    Null and empty texts have no bytes and no tokens; a repeated row gives a row each; null ids are kept; other columns
    are ignored, whatever their names. Contents are told apart first by narrow digest rows, so that copies, however
    many, shuffle as digests only and one representative is encoded. A text is read whole.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    rows = texts.select("__id", content_digest(F.col("__text")).alias("digest"), F.octet_length("__text").cast("long").alias("n_bytes"))
    rows = materialise(rows, "digests")
    misses = rows.join(stored_counts(spark, cache, version), "digest", "left_anti").groupBy("digest").agg(F.min("__id").alias("__id"), F.count("__id").alias("__n"))
    chosen = misses.select("__id").distinct()
    # A digest met only under null ids has no representative id; those few rows are taken by their nullness.
    nameless = texts.where(F.col("__id").isNull())
    wanted = texts.join(chosen, "__id", "left_semi").unionByName(nameless)
    encode = _encoder(tokenizer)
    counted = small_batches(wanted).select(content_digest(F.col("__text")).alias("digest"), "__text").mapInArrow(encode, "digest string, n_tokens long")
    fresh = counted.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")).join(misses.select("digest"), "digest", "left_semi")
    fresh.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache)
    return rows.join(stored_counts(spark, cache, version), "digest", "left").select(F.col("__id").alias(id_col), "n_bytes", "n_tokens", "digest")


def _encoder(tokenizer: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = word_counter(tokenizer)
        for batch in batches:
            counts = count(batch.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return encode
