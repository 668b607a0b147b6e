"""Predicates and decision rules as Column expressions (P*, H21)."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reasons(rules: dict[str, Column]) -> Column:
    """The names of all rules that hold, in order; unknown counts as not."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]))


def first_reason(rules: dict[str, Column]) -> Column:
    """The name of the first rule that holds, else null."""
    return F.coalesce(*[F.when(c, F.lit(name)) for name, c in rules.items()])


def assistant_turn(kind: Column, chosen: Column, reasoning: Column, answer: Column) -> Column:
    """P7"""
    return F.when(kind == "PREFERENCE", chosen).when((kind == "REASONING") & (F.length(reasoning) > 0), F.concat(reasoning, F.lit("\n\nAnswer: "), answer)).otherwise(answer)


def decide(hard: Column, level: Column, centrality: Column, depth: Column, total: Column) -> Column:
    """Exclusions first; direct and inherent evidence is included behind three gates, else reviewed; latent is reviewed."""
    direct = level.isin("direct", "inherent")
    return (
        F.when(hard | level.isin("affiliation_only", "absent", "contradicted"), "exclude")
        .when(direct & (centrality >= 2) & (depth >= 2) & (total >= 14), "include")
        .when(direct & (centrality >= 1), "review")
        .when(level == "latent", "review")
        .otherwise("exclude")
    )


def decide_production(hard: Column, said: Column, centrality: Column, depth: Column, total: Column, review_from: int = 10) -> Column:
    """Like :func:`decide` by the scores alone, but a model that hedges is taken at its word."""
    return F.when(hard, "exclude").when(said == "review", "review").when((total >= 14) & (centrality >= 2) & (depth >= 2), "include").when(total >= review_from, "review").otherwise("exclude")


def centrality(level: Column, focus: Column) -> Column:
    """How central the subject is, 0 to 4."""
    by_focus = F.when(focus == "essential", 4).when(focus == "meaningful", 3).when(focus == "incidental", 2).otherwise(1)
    return F.when(level.isin("direct", "inherent"), by_focus).when(level == "latent", 1).otherwise(0)


def specificity(level: Column, places: Column, focus: Column) -> Column:
    """How specific the place is, 0 to 4."""
    n = F.size(places)
    direct = F.when(n >= 2, 4).when((n == 1) | focus.isin("essential", "meaningful"), 3).otherwise(2)
    return F.when(level.isin("direct", "inherent"), direct).when(level == "latent", 1).otherwise(0)


def hits(text: Column, patterns: Iterable[str]) -> Column:
    """How many of the patterns occur."""
    return reduce(lambda a, b: a + b, [F.rlike(F.lower(text), F.lit(p)).cast("int") for p in patterns], F.lit(0))


def holds_any(text: Column, words: Iterable[str]) -> Column:
    """Any of the strings occurs, whatever the case."""
    return reduce(lambda a, b: a | b, [F.contains(F.lower(text), F.lit(w)) for w in words])


def lexicon_terms(text: Column, terms: list[str]) -> Column:
    """The terms that occur as words, in declared order."""
    low = F.lower(text)
    return F.array_compact(F.array(*[F.when(F.rlike(low, F.lit(f"(^|[^a-z]){t}($|[^a-z])")), F.lit(t)) for t in terms]))


def near(text: Column, a: str, b: str, width: int) -> Column:
    """The two words stand within so many characters of each other."""
    word = lambda w: f"(^|[^a-z]){w}($|[^a-z])"
    both = [f"(?s){word(x)}.{{0,{width}}}{word(y)}" for x, y in ((a, b), (b, a))]
    return F.rlike(F.lower(text), F.lit(both[0])) | F.rlike(F.lower(text), F.lit(both[1]))


def permitted(urls: list[Column], usable: Callable[[Column], Column]) -> Column:
    """The distinct usable addresses, in order."""
    return F.filter(F.array_distinct(F.array_compact(F.array(*urls))), usable)


def allowed(rows: DataFrame, column: str, allow: list[str]) -> DataFrame:
    """Rows of the allowed values; a value that no row has raises."""
    known = {r[0] for r in rows.where(F.col(column).isin(*allow)).select(column).distinct().collect()}  # at most the list
    if missing := set(allow) - known:
        raise ValueError(f"no row has {column} {sorted(missing)}")
    return rows.where(F.col(column).isin(*allow))
