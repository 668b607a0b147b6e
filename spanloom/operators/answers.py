"""Answers that stand on their evidence: validate, soften, fall back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import sentences
from spanloom.operators.contracts import holds_number, numbers_of

ABSTAINED = "The corpus does not answer this."


def tags_of(sentence: Column) -> Column:
    return F.regexp_extract_all(sentence, F.lit(r"\[(E[0-9]+)\]"), 1)


def carried(sentence: Column, quotes: Column) -> Column:
    """The sentence cites evidence that is there, and its numbers stand in what it cites. quotes: map of tag to quote."""
    tags = tags_of(sentence)
    numbers = numbers_of(F.regexp_replace(sentence, r"\[E[0-9]+\]", ""))
    known = F.forall(tags, lambda t: F.map_contains_key(quotes, t))
    return (F.size(tags) > 0) & known & F.forall(numbers, lambda n: F.exists(tags, lambda t: holds_number(F.try_element_at(quotes, t), n)))


def stub(quotes: Column) -> Column:
    """The first sentence of E1 with its tag. A mark within a number or a word ends none; tags of the text's own go."""
    quote = F.try_element_at(quotes, F.lit("E1"))
    plain = F.regexp_replace(F.regexp_replace(quote, r"\[E[0-9]+\]", " "), r"\s+", " ")
    first = F.coalesce(F.get(sentences(plain), F.lit(0)), F.when(quote.isNotNull(), ""))
    return F.concat(F.trim(F.regexp_replace(first, r"[.!?]+$", "")), F.lit(" [E1]."))


def answers(raw: DataFrame, bundle: DataFrame) -> DataFrame:
    """C4: (question, verdict, answer, cited) of generated answers.

    raw: question, raw. bundle: question, tag, quote, a bounded number a question; a question without a row there is
    abstained from. An answer whose sentences are all carried is "supported"; else those that are stay ("softened");
    where none is, the stub stands in ("fallback").
    """
    held = bundle.groupBy("question").agg(F.map_from_entries(F.collect_list(F.struct("tag", "quote"))).alias("quotes"))
    rows = raw.join(held, "question", "left").withColumn("said", F.filter(sentences(F.coalesce("raw", F.lit(""))), lambda s: F.trim(s) != ""))
    rows = rows.withColumn("kept", F.filter("said", lambda s: carried(s, F.col("quotes"))))
    verdict = F.when(F.col("quotes").isNull(), "abstained").when(F.size("kept") == 0, "fallback").when(F.size("kept") < F.size("said"), "softened").otherwise("supported")
    rows = rows.withColumn("verdict", verdict)
    answer = F.when(F.col("verdict") == "abstained", ABSTAINED).when(F.col("verdict") == "fallback", stub(F.col("quotes"))).otherwise(F.array_join("kept", " "))
    return rows.select("question", "verdict", answer.alias("answer")).withColumn("cited", F.array_join(F.array_sort(F.array_distinct(tags_of(F.col("answer")))), ","))
