"""Words, token estimates and chunks, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.runtime import WHITESPACE

CHUNK_WORDS, STRIDE_WORDS = 1536, 1344


def tokens_of(c: Column | str) -> Column:
    """The words between white space; null and blank texts give an empty array."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.filter(F.split(c, WHITESPACE), lambda w: w != ""), F.array().cast("array<string>"))


def token_estimate(words: Column) -> Column:
    """Three quarters of a word to a token, rounded down."""
    return F.floor(F.size(words) / F.lit(0.75)).cast("int")


def shaped(c: Column, chars: int = 120_000, tokens: int = 30_000, keep_words: int = 22_500) -> Column:
    """A text cut to what an embedding request takes: first by characters, then by words if its estimate is still too large."""
    cut = F.substring(c, 1, chars)
    words = tokens_of(cut)
    return F.when(F.greatest(F.lit(1), token_estimate(words)) > tokens, F.array_join(F.slice(words, 1, keep_words), " ")).otherwise(cut)


def chunked(df: DataFrame, text: str | Column, size: int = CHUNK_WORDS, stride: int = STRIDE_WORDS) -> DataFrame:
    """df with one row for each chunk: chunk_index, total_chunks, chunk_text, token_count.

    A chunk begins at every stride, so the last may lie wholly inside the one before. Blank texts give no row. The
    words are cut once, before the rows multiply.
    """
    words = df.withColumn("_words", tokens_of(text)).filter(F.size("_words") > 0)
    total = F.ceil(F.size("_words") / F.lit(stride)).cast("int")
    rows = words.withColumn("total_chunks", total).withColumn("chunk_index", F.explode(F.sequence(F.lit(0), F.col("total_chunks") - 1)))
    own = F.slice("_words", F.col("chunk_index") * stride + 1, F.lit(size))
    return rows.withColumn("chunk_text", F.array_join(own, " ")).withColumn("token_count", token_estimate(own)).drop("_words")
