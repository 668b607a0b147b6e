"""Relevance of documents by lexicons, scores and a decision rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.operators import rules


def relevance(docs: DataFrame, key: str, text: Column, direct: list[str], latent: list[str], hard: Column, depth: Column, include_from: int = 14) -> DataFrame:
    """(key, level, focus, total, decision): evidence found by lexicon, scored in three aspects, decided by gates.

    A term of the direct lexicon is direct evidence, more of them make the focus stronger; a latent term alone is
    latent evidence. One pass, no join: lexicons are short lists of words.
    """
    found = docs.select(key, rules.lexicon_terms(text, direct).alias("d"), rules.lexicon_terms(text, latent).alias("l"), hard.alias("hard"), depth.alias("depth"))
    n = F.size("d")
    level = F.when(n > 0, "direct").when(F.size("l") > 0, "latent").otherwise("absent")
    focus = F.when(n >= 3, "essential").when(n == 2, "meaningful").when(n == 1, "incidental").otherwise("none")
    scored = found.select(key, level.alias("level"), focus.alias("focus"), "d", "hard", "depth").withColumns({"centrality": rules.centrality(F.col("level"), F.col("focus")), "specificity": rules.specificity(F.col("level"), F.col("d"), F.col("focus"))})
    total = F.col("centrality") + F.col("specificity") + F.col("depth")
    gates = (F.col("centrality") >= 2) & (F.col("depth") >= 2) & (total >= include_from)
    decision = F.when(F.col("hard") | (F.col("level") == "absent"), "exclude").when((F.col("level") == "direct") & gates, "include").when(F.col("level").isin("direct", "latent"), "review").otherwise("exclude")
    return scored.select(key, "level", "focus", total.cast("bigint").alias("total"), decision.alias("decision"))
