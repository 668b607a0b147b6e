"""JSON, arrays and maps: salvage, flattening, rendering, signatures (N*)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.vectorized import vectorized


def closers(text: str) -> tuple[str, int]:
    """The brackets that are open at the end, closed in order, and the place after the last whole value."""
    stack, quoted, escaped, safe = [], False, False, 0
    for i, c in enumerate(text):
        if quoted:
            quoted, escaped = (escaped or c != '"'), (c == "\\" and not escaped)
        elif c == '"':
            quoted = True
        elif c in "[{":
            stack.append("]" if c == "[" else "}")
        elif c in "]}" and stack:
            stack.pop()
            safe = i + 1
        elif c == ",":
            safe = i
    return "".join(reversed(stack)), safe


def salvage(text: str) -> tuple[str | None, bool]:
    """(a JSON object as text or None, whether it needed repair)."""
    body = text[text.find("{") :] if "{" in text else ""
    if not body:
        return None, False
    import re

    tries = [(body, False), (re.sub(r",\s*([\]}])", r"\1", body), True)]
    mended = re.sub(r'(?<=[A-Za-z0-9])"(?=[A-Za-z0-9])', r"\\\"", body)
    tries.append((re.sub(r",\s*([\]}])", r"\1", mended), True))
    for candidate, repaired in tries:
        try:
            value, _ = json.JSONDecoder().raw_decode(candidate)
            return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")), repaired
        except ValueError:
            continue
    cut = tries[1][0]
    while cut:  # take whole values off the end until the rest closes
        _, safe = closers(cut)
        if not safe:
            return None, False
        cut = cut[:safe].rstrip(", \n")
        ends, _ = closers(cut)
        try:
            return json.dumps(json.loads(cut + ends), ensure_ascii=False, sort_keys=True, separators=(",", ":")), True
        except ValueError:
            cut = cut[:-1]
    return None, False


@vectorized("struct<payload:string,salvaged:boolean>")
def salvaged(s: pd.Series) -> pd.DataFrame:
    rows = [salvage(v) if v is not None else (None, False) for v in s]
    return pd.DataFrame({"payload": pd.Series([r[0] for r in rows], dtype=object), "salvaged": [r[1] for r in rows]})


def strict_object(c: Column) -> Column:
    """The text, without a thinking block, if it is just one JSON object; else null."""
    t = F.trim(F.regexp_replace(c, "(?s)<think>.*?</think>", ""))
    return F.when(F.rlike(t, F.lit(r"(?s)^\{.*\}$")) & F.try_parse_json(t).isNotNull(), t)


def first_object(c: Column) -> Column:
    """An object, or the first object of a list."""
    v = F.try_parse_json(c)
    return F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$[0]", "string")).when(F.schema_of_variant(v).startswith("OBJECT"), F.try_variant_get(v, "$", "string"))


_EVIDENCE = "array<struct<quote:string,page:string>>"


def evidence_of(value: object) -> list[tuple[str, str]]:
    """Quotes in any of the shapes models give: a string, an object, lists of either, nested under known names."""
    if isinstance(value, str):
        return [(value.strip(), "")] if value.strip() else []
    if isinstance(value, list):
        return [x for v in value for x in evidence_of(v)]
    if isinstance(value, dict):
        quote = next((value[k] for k in ("quote", "text", "span") if isinstance(value.get(k), str)), "").strip()
        own = [(quote, str(value.get("page") or ""))] if quote else []
        return own + [x for k in ("evidence", "spans", "quotes", "source", "items") if k in value for x in evidence_of(value[k])]
    return []


@vectorized(_EVIDENCE)
def recovered_evidence(s: pd.Series) -> pd.Series:
    def one(v: str | None) -> list[dict]:
        try:
            found = evidence_of(json.loads(v)) if v else []
        except ValueError:
            found = []
        return [{"quote": q, "page": p} for q, p in dict.fromkeys(found)]

    return s.map(one)


def names_line(c: Column, most: int, limit: int) -> Column:
    """A JSON list of names as one line, each once, so many, cut to a length."""
    names = F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))
    return F.left(F.array_join(F.slice(F.array_distinct(names), 1, most), "; "), F.lit(limit))


def sorted_map_line(c: Column) -> Column:
    """A map as JSON with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(c))))


def maps_agree(a: Column, b: Column) -> Column:
    """Equal on every key that both have."""
    return F.forall(F.array_intersect(F.map_keys(a), F.map_keys(b)), lambda k: F.try_element_at(a, k) == F.try_element_at(b, k))


def signature(qualifiers: Column, kinds: list[str]) -> Column:
    """The qualifiers of the kinds that tell identities apart, sorted, each once."""
    return F.array_sort(F.array_distinct(F.filter(qualifiers, lambda q: q["kind"].isin(*kinds))))


def messages(question: Column, answer: Column) -> Column:
    """A conversation of two turns."""
    return F.array(F.struct(F.lit("user").alias("role"), question.alias("content")), F.struct(F.lit("assistant").alias("role"), answer.alias("content")))


def alias_errors(c: Column, kinds: list[str], most: int = 10) -> Column:
    """Why a list of alias records (text, kind, language) is refused; empty if it is good."""
    text = F.transform(c, lambda a: F.lower(F.trim(a["text"])))
    rules = {
        "TOO_MANY": F.size(c) > most,
        "BLANK": F.exists(text, lambda t: t == ""),
        "KIND": F.exists(c, lambda a: ~a["kind"].isin(*kinds)),
        "LANGUAGE": F.exists(c, lambda a: ~F.rlike(a["language"], F.lit("^[a-z]{2}$"))),
        "REPEATED": F.size(F.array_distinct(text)) < F.size(text),
    }
    return F.array_compact(F.array(*[F.when(r, F.lit(n)) for n, r in rules.items()]))


def merged_qualifiers(rows: DataFrame, key: str, qualifiers: str) -> DataFrame:
    """(key, kind, value, conflict): the union of a group's qualifiers; a kind of two values is a conflict."""
    each = rows.select(key, F.explode(qualifiers).alias("q")).select(key, "q.kind", "q.value")
    grouped = each.groupBy(key, "kind").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return grouped.select(key, "kind", F.when(F.col("low") == F.col("high"), F.col("low")).alias("value"), (F.col("low") != F.col("high")).alias("conflict"))


def flatten_records(rows: DataFrame, key: str, payload: str, items: str, prefix: str) -> DataFrame:
    """(key, local_id, position, item) of a list in a JSON text; ids that are missing follow the position."""
    listed = F.from_json(F.get_json_object(payload, f"$.{items}"), "array<string>")
    each = rows.select(key, F.posexplode(listed).alias("position", "item"))
    local = F.coalesce(F.get_json_object("item", "$.id"), F.concat(F.lit(prefix), (F.col("position") + 1).cast("string")))
    return each.select(key, F.concat_ws(":", F.col(key).cast("string"), local).alias("local_id"), "position", "item")
