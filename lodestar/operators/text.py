"""Text operators (survey §2.14, N1-N9) over whole documents.

Word counts are explode + aggregate: the per-word partial count is
combined map-side, so a very frequent word ("the") costs one row per task
in the shuffle. The TF-IDF chain is MLlib (distributed fit of the IDF
document frequencies).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions import text as T


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Raw whitespace-token frequencies."""
    w = df.select(F.explode(T.words(text)).alias("word"))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def clean_word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Cleaned words longer than 3 characters, seen more than once.

    Cleaning a word = dropping its non-letters. Dropping every character
    that is neither a letter nor whitespace from the whole (lower-cased)
    text first, then splitting on whitespace, yields exactly the cleaned
    words — one regex pass per document instead of one per word."""
    keep_ws = T.WORD_CLEAN_DROP[:-1] + r"\s]"
    cleaned = F.regexp_replace(F.lower(F.col(text)), keep_ws, "")
    w = df.select(F.explode(T.words(cleaned)).alias("word"))
    w = w.where(F.length("word") > T.WORD_MIN_LEN_EXCLUSIVE)
    c = w.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return c.where(F.col("n") > T.WORD_MIN_COUNT_EXCLUSIVE)


def top_words(counts: DataFrame, k: int = 10) -> DataFrame:
    """Top-k by count, ties broken by the word (ascending)."""
    return counts.orderBy(F.col("n").desc(), F.col("word").asc()).limit(k)


def tfidf_model(text: str = "text", features: int = 10_000) -> Pipeline:
    """Tokenizer -> StopWordsRemover -> HashingTF -> IDF."""
    return Pipeline(stages=[
        Tokenizer(inputCol=text, outputCol="tokens"),
        StopWordsRemover(inputCol="tokens", outputCol="terms"),
        HashingTF(inputCol="terms", outputCol="tf", numFeatures=features),
        IDF(inputCol="tf", outputCol="features", minDocFreq=1),
    ])


def hashed_beforehand(df: DataFrame, hashing: HashingTF, counts: Sequence[int]) -> DataFrame:
    """``df`` with the term frequencies for each feature count, as columns
    that ``Hashed`` takes."""
    for n in counts:
        df = hashing.copy({hashing.numFeatures: n, hashing.outputCol: f"{hashing.getOutputCol()}_{n}"}).transform(df)
    return df


class Hashed(HashingTF):
    """A ``HashingTF`` for tuning, whose frames hold the term frequencies
    of each feature count already (``hashed_beforehand``)."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.getOutputCol()
        return dataset.withColumn(out, F.col(f"{out}_{self.getNumFeatures()}"))
