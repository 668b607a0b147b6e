"""Study families: blocking, scoring and verdicts over pairs of papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import title_tokens
from spanloom.operators.graph import connected_components
from spanloom.operators.metrics import overlap_share
from spanloom.operators.ranks import HOT, spread
from spanloom.storage import materialize

# Blocking and decision thresholds.
RARE_MAX, BUCKET_MAX = 40, 60
TITLE_FLOOR, REVIEW_FLOOR = 0.55, 0.72
ABSTRACT_ALONE, TITLE_STRONG, ABSTRACT_WITH_TITLE = 0.85, 0.90, 0.60
TITLE_GOOD, AUTHORS_WITH_TITLE, ABSTRACT_WITH_BOTH = 0.80, 0.60, 0.50
MAX_YEAR_GAP = 6


def block(papers: DataFrame, key: str, title: str) -> DataFrame:
    """Pairs (i, j) that share a word of few titles, or all their title words. Larger buckets are skipped."""
    words = papers.select(F.col(key).alias("k"), title_tokens(F.col(title)).alias("w"))
    single = words.select("k", F.explode("w").alias("b")).withColumn("b", F.concat(F.lit("w "), "b"))
    whole = words.where(F.size("w") > 0).select("k", F.concat(F.lit("t "), F.array_join("w", " ")).alias("b"))
    rows = _of_few(single, min(RARE_MAX, BUCKET_MAX)).unionByName(_of_few(whole, BUCKET_MAX))
    held = rows.groupBy("b").agg(F.sort_array(F.collect_list("k")).alias("k"))  # at most BUCKET_MAX rows a bucket
    return held.select("k", F.explode("k").alias("i")).select("i", F.explode("k").alias("j")).where("i < j").distinct()


def _of_few(rows: DataFrame, most: int) -> DataFrame:
    """The rows whose b is that of 2 to so many rows. Those of hot ones, by counts added up in each task, go before the exchange."""
    sizes = materialize(rows.groupBy("b").agg(F.count("*").alias("n")), "bucket-sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot = sizes.where(F.col("n") > max(total // HOT, most)).select("b")  # at most HOT rows
    return rows.join(F.broadcast(hot), "b", "left_anti").join(sizes.where(f"n between 2 and {most}").select("b"), "b", "left_semi")


def verdict(same_doi: Column, title: Column, abstract: Column, author: Column, gap: Column, numbers_differ: Column) -> tuple[Column, Column]:
    """C11: (merge, review or separate; why). Every merge but that of an equal DOI needs two signals."""
    close, says = title >= REVIEW_FLOOR, lambda c: F.format_string("%.2f", c)
    both, three = (title >= TITLE_STRONG) & (abstract >= ABSTRACT_WITH_TITLE), (title >= TITLE_GOOD) & (author >= AUTHORS_WITH_TITLE) & (abstract >= ABSTRACT_WITH_BOTH)
    far, series = gap > MAX_YEAR_GAP, numbers_differ & (abstract < ABSTRACT_ALONE)
    merges = same_doi | (~far & ~series & ((abstract >= ABSTRACT_ALONE) | both | three))
    reason = (
        F.when(same_doi, "identical DOI")
        .when(far & close, "years too far apart")
        .when(series & close & ~far, "titles differ by a number")
        .when(far | series, "")
        .when(abstract >= ABSTRACT_ALONE, F.concat(F.lit("abstract "), says(abstract)))
        .when(both, F.concat(F.lit("title "), says(title), F.lit(" + abstract "), says(abstract)))
        .when(three, F.concat(F.lit("title "), says(title), F.lit(" + authors "), says(author), F.lit(" + abstract "), says(abstract)))
        .when(close, "close, not confirmed")
        .otherwise("")
    )
    return F.when(merges, "merge").when(close, "review").otherwise("separate"), reason


def score(pairs: DataFrame, papers: DataFrame, key: str) -> DataFrame:
    """The signals of each pair above the title floor. papers: key, title, abstract, doi, surnames array, year.

    Overlaps are Jaccard shares, 0 where a side is empty; an unknown year makes the gap 99; an empty DOI equals none.
    """

    def side(k: str) -> DataFrame:
        digits = F.array_sort(F.array_distinct(F.regexp_extract_all(F.col("title"), F.lit("[0-9]+"), 0)))
        doi = F.trim(F.replace(F.lower(F.coalesce("doi", F.lit(""))), F.lit("https://doi.org/"), F.lit("")))
        every = title_tokens(F.col("abstract"), stop=[""])  # abstracts keep all words
        fields = {"t": title_tokens(F.col("title")), "a": every, "n": digits, "d": doi, "s": F.array_distinct("surnames"), "y": F.col("year")}
        return papers.select(F.col(key).alias(k), *[c.alias(f"{n}_{k}") for n, c in fields.items()])

    share = lambda n: overlap_share(F.col(f"{n}_i"), F.col(f"{n}_j"))
    first = spread(spread(pairs, "i").join(side("i"), "i"), "j")
    both = first.join(side("j"), "j").withColumn("title", share("t")).where(F.col("title") >= TITLE_FLOOR)
    gap = F.coalesce(F.abs(F.col("y_i") - F.col("y_j")), F.lit(99))
    same_doi = (F.col("d_i") == F.col("d_j")) & (F.col("d_i") != "")
    return both.select("i", "j", "title", share("a").alias("abstract"), share("s").alias("author"), gap.alias("gap"), (F.col("n_i") != F.col("n_j")).alias("numbers_differ"), same_doi.alias("same_doi"))


def decide(scored: DataFrame) -> DataFrame:
    """Scored pairs with their decision and why."""
    decision, why = verdict(*[F.col(c) for c in ("same_doi", "title", "abstract", "author", "gap", "numbers_differ")])
    return scored.withColumns({"decision": decision, "why": why})


def families(merges: DataFrame, papers: DataFrame, key: str) -> DataFrame:
    """(key, family, family_size): the least key of each component of merged pairs."""
    comp = connected_components(merges, "i", "j")
    named = papers.select(F.col(key)).join(comp, F.col(key) == F.col("node"), "left").select(key, F.coalesce("component", key).alias("family"))
    return named.join(named.groupBy("family").agg(F.count("*").alias("family_size")), "family").select(key, "family", "family_size")
