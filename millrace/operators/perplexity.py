"""Perplexity of held-out text under a word model counted on the training side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.tokens import word_counts
from millrace.session import stage
from millrace.sizing import lookup_join


def perplexity(train: DataFrame, test: DataFrame, by: Sequence[str] = (), text: str = "text") -> DataFrame:
    """``exp`` of the mean negative log likelihood, one row a group.

    The model is a unigram count with one added to each word and one more slot for words never
    seen. Test words are counted per group before they meet the model, so a frequent word is
    one row a group however often it occurs.
    """
    model = stage(word_counts(train, text), "word-model")
    size = model.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    slots = float(size["n"] + size["v"] + 1)
    seen = word_counts(test, text, by).withColumnRenamed("n", "_times")
    scored = lookup_join(seen, model, "word", "left")
    likelihood = F.log((F.coalesce(F.col("n"), F.lit(0)) + 1) / F.lit(slots))
    loss = -F.sum(F.col("_times") * likelihood) / F.sum("_times")
    return scored.groupBy(*by).agg(F.sum("_times").alias("n_tokens"), F.exp(loss).alias("perplexity"))
