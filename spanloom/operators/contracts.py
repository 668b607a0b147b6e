"""Contracts of extracted records: each gives the codes of its broken rules, in order.

Records are typed structs. Closed lists of allowed values are parameters. A null field is missing. What a rule
compares is compared whole and word for word; numbers are compared by value.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import skeleton
from spanloom.operators.rules import first_reason, reasons

# The longest quote, aliases of an entity, further disciplines, and the least length of a descriptor.
MAX_QUOTE, MAX_ALIASES, MAX_SECONDARY, MIN_DESCRIPTOR = 1_500, 10, 2, 45
# The scores of a relevance verdict, its keys, decisions and domains; the keys are a parameter where used.
SCORES = ("african_centrality", "local_specificity", "scientific_depth", "knowledge_value", "local_applicability")
VERDICT_KEYS = ("decision", "hard_exclusion", *SCORES, "domain", "evidence", "reason")
DECISIONS = ("include", "review", "exclude")
DOMAINS = ("MAT", "AGR", "HLT", "ENR", "ENV", "TEC", "OUTSIDE_TAXONOMY")
_NUMBER = r"[-+]?[0-9][0-9,]*(?:\.[0-9]+)?"


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(c) == "", F.lit(True))


def outside(c: Column, allowed: Iterable[str]) -> Column:
    return ~F.coalesce(c.isin(*allowed), F.lit(False))


def numbers_of(text: Column) -> Column:
    """The numbers of a text by value; commas between digits do not count."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_NUMBER), 0)
    return F.transform(found, lambda n: F.replace(n, F.lit(","), F.lit("")).cast("double"))


def holds_number(text: Column, value: Column) -> Column:
    """A number of the text equals the value but for rounding."""
    return F.exists(numbers_of(text), lambda n: F.abs(n - value) <= 1e-9 * F.greatest(F.abs(n), F.abs(value)))


def unsupported_numbers(text: Column, evidence: Column) -> Column:
    """The numbers of a text that its evidence does not hold."""
    return F.filter(numbers_of(text), lambda n: ~holds_number(evidence, n))


def has_keys(json: Column, keys: Iterable[str]) -> Column:
    """The object has just these keys."""
    return F.coalesce(F.array_sort(F.json_object_keys(json)) == F.array(*[F.lit(k) for k in sorted(keys)]), F.lit(False))


def model_output(text: Column, keys: Iterable[str] = VERDICT_KEYS, scores: Iterable[str] = SCORES, domain: str = "domain") -> Column:
    """The first error of a model's verdict, or null. Thoughts and code fences around the object are cut off.

    domain: the key of the verdict's domain, one of ``keys``.
    """
    body = F.regexp_extract(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?s)<think>.*?</think>|```json|```", ""), r"(?s)\{.*\}", 0)
    field = lambda k: F.get_json_object(body, f"$.{k}")
    held = F.coalesce(F.json_object_keys(body), F.array().cast("array<string>"))
    missing = F.array_except(F.array(*[F.lit(k) for k in sorted(keys)]), held)
    # a score that is a boolean or a string with letters is no number; a whole number from 0 to 4 is wanted
    bad = [F.when(~F.coalesce(field(k).try_cast("double").isin(0.0, 1.0, 2.0, 3.0, 4.0), F.lit(False)), F.lit(f"score:{k}")) for k in scores]
    wrong = F.array_compact(F.array(*bad))
    return F.coalesce(
        F.when(body == "", F.lit("no object")),
        F.when(F.json_object_keys(body).isNull(), F.lit("no JSON")),
        F.when(F.size(missing) > 0, F.concat(F.lit("missing:"), F.array_join(missing, ","))),
        F.when(outside(field("decision"), DECISIONS), F.lit("decision")),
        F.when(outside(F.upper(F.trim(field(domain))), DOMAINS), F.lit("domain")),
        F.when(blank(field("evidence")), F.lit("evidence")),
        F.try_element_at(wrong, F.lit(1)),
    )


def descriptor_leaks(answer: Column, descriptor: Column) -> Column:
    """P20: the descriptor holds the answer as whole words, or all of the answer's numbers."""
    flat = lambda c: F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0), " "), F.lit(" "))
    whole = (F.trim(flat(answer)) != "") & F.contains(flat(descriptor), flat(answer))
    numbers = numbers_of(answer)
    return whole | ((F.size(numbers) > 0) & (F.size(unsupported_numbers(answer, descriptor)) == 0))


def closed_ready(kind: Column, question: Column, answer: Column, descriptor: Column, verified: Column, case_report: str = r"(?i)case report|single case") -> Column:
    """Why a pair cannot be asked without its paper, or null: a ladder of eight reasons."""
    return first_reason(
        {
            "not verified against the paper": ~F.coalesce(verified, F.lit(False)),
            "not an SFT knowledge pair": outside(F.upper(F.trim(kind)), ("FACTUAL", "REASONING")),
            "no titled study descriptor": blank(descriptor) | (F.length(descriptor) < MIN_DESCRIPTOR) | ~F.contains(descriptor, F.lit("'")),
            "single case is not a stable closed-book target": F.rlike(descriptor, F.lit(case_report)) | F.rlike(F.coalesce(question, F.lit("")), F.lit(case_report)),
            "question or target is blank": blank(question) | blank(answer),
            "descriptor reveals the target": descriptor_leaks(answer, descriptor),
        }
    )


def permissive_ready(kind: Column, question: Column, answer: Column, descriptor: Column) -> Column:
    """Why a pair fails the closed prompt's contract without a claim of verification, or null."""
    lines = F.filter(F.split(F.coalesce(descriptor, F.lit("")), "\n"), lambda x: F.trim(x) != "")
    return first_reason(
        {
            "not an SFT knowledge pair": outside(F.upper(F.trim(kind)), ("FACTUAL", "REASONING")),
            "no usable study context": F.size(lines) < 2,
            "question or target is blank": blank(question) | blank(answer),
            "study context reveals the target": descriptor_leaks(answer, descriptor),
        }
    )


def preference_ready(chosen: Column, rejected: Column, supported: Column) -> Column:
    """Why a preference pair cannot be used, or null."""
    return first_reason(
        {
            "chosen or rejected missing": blank(chosen) | blank(rejected),
            "chosen and rejected are the same": skeleton(chosen) == skeleton(rejected),
            "chosen is not supported by the evidence": ~F.coalesce(supported, F.lit(False)),
        }
    )


def resolver_gate(complete: Column, science: Column, relevant: Column) -> Column:
    """Why a paper's entities stay out of resolution, joined by "|"; a paper that was read in part never does."""
    why = reasons({"NOT_REAL_SCIENCE": ~science, "NOT_AFRICA_RELEVANT": ~relevant})
    return F.when(~complete, "").otherwise(F.array_join(why, "|"))


def quality_flags(level: Column, conditions: Column, qualifiers: Column, types: Column, alignments: Column) -> Column:
    """The sorted flags of an observation. The last four are arrays of names, kinds, types and statuses."""
    return F.array_sort(
        reasons(
            {
                "SECONDARY_EVIDENCE": level == "SECONDARY",
                "SYNTHESIS_EVIDENCE": level == "SYNTHESIS",
                "UNMODELED_CONDITION": F.array_contains(conditions, F.lit("UNMODELED_CONDITION")),
                "UNMODELED_QUALIFIER": F.array_contains(qualifiers, F.lit("UNMODELED_QUALIFIER")),
                "OTHER_ENTITY_TYPE": F.array_contains(types, F.lit("OTHER")),
                "AMBIGUOUS_SOURCE_ALIGNMENT": F.array_contains(alignments, F.lit("EXACT_AMBIGUOUS")),
            }
        )
    )


def first_licence(*columns: Column) -> Column:
    """The first licence that says something, trimmed and in lower case, else the empty string."""
    said = [F.lower(F.trim(c)) for c in columns]
    return F.coalesce(*[F.when(~c.isin("", "nan", "none"), c) for c in said], F.lit(""))


def evidence_errors(e: Column, pages: Column, kinds: Iterable[str]) -> Column:
    """P31. e: local_id, source_kind, source_label, page, section, quote; pages: map of page to text."""
    text, quote = F.try_element_at(pages, e["page"]), e["quote"]
    ragged = blank(quote) | (quote != F.trim(quote))
    return reasons(
        {
            "LOCAL_ID_EMPTY": blank(e["local_id"]),
            "SOURCE_KIND": outside(e["source_kind"], kinds),
            "SOURCE_LABEL": e["source_label"].isNull(),
            "SECTION": e["section"].isNull(),
            "PAGE_OUTSIDE_TASK": text.isNull(),
            "QUOTE_NOT_TRIMMED": ragged,
            "QUOTE_TOO_LONG": F.length(quote) > MAX_QUOTE,
            "QUOTE_NOT_IN_SOURCE": ~ragged & text.isNotNull() & ~F.contains(text, quote),
        }
    )


def alias_errors(aliases: Column, own: list[Column], kinds: Iterable[str]) -> Column:
    """Of an entity's aliases (text, kind, language, stated_in_paper)."""
    folded = F.transform(aliases, lambda a: F.lower(F.trim(a["text"])))
    names = F.array(*[F.lower(F.trim(c)) for c in own])
    return reasons(
        {
            "ALIAS_LIST": aliases.isNull(),
            "ALIAS_COUNT": F.size(aliases) > MAX_ALIASES,
            "ALIAS_EMPTY": F.exists(aliases, lambda a: blank(a["text"])),
            "ALIAS_IS_OWN_NAME": F.arrays_overlap(folded, names),
            "ALIAS_REPEATED": F.size(F.array_distinct(folded)) < F.size(folded),
            "ALIAS_KIND": F.exists(aliases, lambda a: outside(a["kind"], kinds)),
            "ALIAS_LANGUAGE": F.exists(aliases, lambda a: a["language"].isNull()),
            "ALIAS_STATED": F.exists(aliases, lambda a: a["stated_in_paper"].isNull()),
        }
    )


def entity_errors(x: Column, owner: Column, context: Column, enums: dict[str, Iterable[str]], allow_context: bool = True) -> Column:
    """P33. owner and context: maps of evidence id to quote. enums: roles, types, provenances, qualifiers, aliases.

    x: source_mention_id, source_evidence_id, surface_text, atom_text, role, entity_type, identity_scope,
    instance_local_id, provenance_scope, aliases, qualifiers (kind, value_text).
    """
    from_context = x["provenance_scope"] == "STUDY_CONTEXT"
    quote = F.when(from_context, F.try_element_at(context, x["source_evidence_id"]) if allow_context else F.lit(None)).otherwise(F.try_element_at(owner, x["source_evidence_id"]))
    quotes = F.concat(F.map_values(owner), F.map_values(context))
    q = x["qualifiers"]
    broken = reasons(
        {
            **{f"{name.upper()}_EMPTY": blank(x[name]) for name in ("source_mention_id", "source_evidence_id", "surface_text", "atom_text")},
            "ROLE": outside(x["role"], enums["roles"]),
            "ENTITY_TYPE": outside(x["entity_type"], enums["types"]),
            "IDENTITY_SCOPE": outside(x["identity_scope"], ("CANONICAL", "STUDY_INSTANCE")),
            "INSTANCE_ID_REQUIRED": (x["identity_scope"] == "STUDY_INSTANCE") & blank(x["instance_local_id"]),
            "INSTANCE_ID_FORBIDDEN": (x["identity_scope"] == "CANONICAL") & ~blank(x["instance_local_id"]),
            "PROVENANCE": outside(x["provenance_scope"], enums["provenances"]),
            "CONTEXT_NOT_ALLOWED": from_context & F.lit(not allow_context),
            "EVIDENCE_UNRESOLVED": quote.isNull(),
            "SURFACE_NOT_IN_EVIDENCE": ~blank(x["surface_text"]) & ~F.coalesce(F.contains(quote, x["surface_text"]), F.lit(False)),
            "QUALIFIER_LIST": q.isNull(),
            "QUALIFIER_KIND": F.exists(q, lambda i: outside(i["kind"], enums["qualifiers"])),
            "QUALIFIER_EMPTY": F.exists(q, lambda i: blank(i["value_text"])),
            "QUALIFIER_NOT_IN_EVIDENCE": F.exists(q, lambda i: ~blank(i["value_text"]) & ~F.exists(quotes, lambda t: F.contains(t, i["value_text"]))),
            "QUALIFIER_REPEATED": F.size(F.array_distinct(q)) < F.size(q),
        }
    )
    return F.concat(broken, alias_errors(x["aliases"], [x["surface_text"], x["atom_text"]], enums["aliases"]))


def source_group_errors(entities: DataFrame, owner: str, group: str, signature: list[str], atom: list[str]) -> DataFrame:
    """(owner, group, disagree, repeated): groups whose members have several signatures or one atom twice."""
    hashed = entities.select(owner, group, F.xxhash64(*signature).alias("s"), F.xxhash64(*atom).alias("a"))
    counted = hashed.groupBy(owner, group).agg((F.countDistinct("s") > 1).alias("disagree"), (F.count("*") > F.countDistinct("a")).alias("repeated"))
    return counted.where("disagree or repeated")


def pair_errors(p: Column, source: Column, enums: dict[str, Iterable[str]]) -> Column:
    """Of one training pair. enums: kinds (of reasoning), negatives, rejections.

    p: kind (FACTUAL, REASONING, RERANKER, PREFERENCE), local_id, pair_kind, question, answer, reasoning, chosen,
    rejected, rejection_reason, positive_quote, hard_negative_quote, negative_reason, quote (the linked evidence).
    """
    is_ = lambda *kinds: p["kind"].isin(*kinds)
    within = lambda c: F.coalesce(F.contains(source, c), F.lit(False))
    loose = lambda c: F.size(unsupported_numbers(c, p["quote"])) > 0
    return reasons(
        {
            "KIND": outside(p["kind"], ("FACTUAL", "REASONING", "RERANKER", "PREFERENCE")),
            "LOCAL_ID_EMPTY": blank(p["local_id"]),
            "QUESTION_EMPTY": blank(p["question"]),
            "ANSWER_EMPTY": is_("FACTUAL", "REASONING") & blank(p["answer"]),
            "REASONING_EMPTY": is_("REASONING") & blank(p["reasoning"]),
            "PAIR_KIND": is_("REASONING") & outside(p["pair_kind"], enums["kinds"]),
            "ANSWER_NUMBERS": is_("FACTUAL", "REASONING") & loose(p["answer"]),
            "REASONING_NUMBERS": is_("REASONING") & loose(p["reasoning"]),
            "QUOTE_EMPTY": is_("RERANKER") & (blank(p["positive_quote"]) | blank(p["hard_negative_quote"])),
            "QUOTE_NOT_IN_SOURCE": is_("RERANKER") & ((~blank(p["positive_quote"]) & ~within(p["positive_quote"])) | (~blank(p["hard_negative_quote"]) & ~within(p["hard_negative_quote"]))),
            "NEGATIVE_REASON": is_("RERANKER") & outside(p["negative_reason"], enums["negatives"]),
            "QUOTES_EQUAL": is_("RERANKER") & (p["positive_quote"] == p["hard_negative_quote"]),
            "POSITIVE_NOT_IN_EVIDENCE": is_("RERANKER") & ~F.coalesce(F.contains(p["quote"], p["positive_quote"]), F.lit(False)),
            "CHOICE_EMPTY": is_("PREFERENCE") & (blank(p["chosen"]) | blank(p["rejected"])),
            "CHOICES_EQUAL": is_("PREFERENCE") & (p["chosen"] == p["rejected"]),
            "REJECTION_REASON": is_("PREFERENCE") & outside(p["rejection_reason"], enums["rejections"]),
            "CHOSEN_NUMBERS": is_("PREFERENCE") & loose(p["chosen"]),
            "REJECTED_IS_GROUNDED": is_("PREFERENCE") & (p["rejection_reason"] == "UNGROUNDED_NUMBER") & ~loose(p["rejected"]),
        }
    )


def task_errors(pairs: DataFrame, budgets: DataFrame, floors: DataFrame) -> DataFrame:
    """(task_id, code) of tasks over their share, under a floor, or with an id that repeats.

    pairs: task_id, kind, pair_kind, local_id. budgets: task_id, kind, share. floors: pair_kind, floor, asked only
    where a task has at least so many reasoning pairs.
    """
    counts = pairs.groupBy("task_id", "kind").agg(F.count("*").alias("n"))
    over = counts.join(budgets, ["task_id", "kind"], "left").where(F.col("n") > F.coalesce("share", F.lit(0))).select("task_id", F.concat(F.lit("OVER_SHARE:"), "kind").alias("code"))
    enough = counts.where("kind = 'REASONING'").select("task_id", F.col("n").alias("all_"))
    wanted = enough.crossJoin(F.broadcast(floors)).where(F.col("all_") >= F.col("floor"))  # floors are a configuration
    made = pairs.where("kind = 'REASONING'").groupBy("task_id", "pair_kind").agg(F.count("*").alias("made"))
    under = wanted.join(made, ["task_id", "pair_kind"], "left").where(F.coalesce("made", F.lit(0)) < F.col("floor")).select("task_id", F.concat(F.lit("UNDER_FLOOR:"), "pair_kind").alias("code"))
    twice = pairs.groupBy("task_id", "local_id").agg(F.count("*").alias("n")).where("n > 1").select("task_id", F.lit("REPEATED_ID").alias("code")).distinct()
    return over.unionByName(under).unionByName(twice)


def profile_errors(p: Column, complete: Column, disciplines: Iterable[str], domains: Iterable[str], kinds: Iterable[str]) -> Column:
    """P36. complete: was the whole paper supplied?

    p: coverage_complete, language, key_contribution, is_real_science, is_africa_relevant, domain, discipline,
    discipline_secondary, missing_content (kind, label, referenced_on_page, status; null: nothing is missing).
    """
    more, missing = p["discipline_secondary"], p["missing_content"]
    return reasons(
        {
            "COVERAGE": ~p["coverage_complete"].eqNullSafe(complete),
            "LANGUAGE_EMPTY": blank(p["language"]),
            "CONTRIBUTION_EMPTY": blank(p["key_contribution"]),
            "SCIENCE_FLAG": p["is_real_science"].isNull(),
            "RELEVANCE_FLAG": p["is_africa_relevant"].isNull(),
            "DOMAIN": outside(p["domain"], domains),
            "DISCIPLINE": outside(p["discipline"], disciplines),
            "SECONDARY_LIST": more.isNull(),
            "SECONDARY_COUNT": F.size(more) > MAX_SECONDARY,
            "SECONDARY_INVALID": F.exists(more, lambda d: outside(d, disciplines)),
            "SECONDARY_IS_PRIMARY": F.array_contains(more, p["discipline"]),
            "SECONDARY_REPEATED": F.size(F.array_distinct(more)) < F.size(more),
            "MISSING_OF_PARTIAL": ~p["coverage_complete"] & missing.isNotNull(),
            "MISSING_KIND": F.exists(missing, lambda m: outside(m["kind"], kinds)),
            "MISSING_STATUS": F.exists(missing, lambda m: outside(m["status"], ("MISSING", "DAMAGED"))),
            "MISSING_LABEL": F.exists(missing, lambda m: blank(m["label"])),
            "MISSING_PAGE": F.exists(missing, lambda m: m["referenced_on_page"].isNull()),
        }
    )


CONTEXT_FIELDS = ("study_design", "population_text", "period_text", "sample_size_text")


def context_errors(c: Column, quotes: Column) -> Column:
    """P37. c: local_id, label and the CONTEXT_FIELDS; quotes: the array of the context's valid quotes."""
    absent = lambda f: ~blank(c[f]) & ~F.exists(quotes, lambda t: F.contains(t, c[f]))
    return reasons(
        {
            "LOCAL_ID_EMPTY": blank(c["local_id"]),
            "LABEL_EMPTY": blank(c["label"]),
            "NO_EVIDENCE": F.coalesce(F.size(quotes) == 0, F.lit(True)),
            **{f"{f.upper()}_TYPE": c[f].isNull() for f in CONTEXT_FIELDS},
            **{f"{f.upper()}_NOT_IN_EVIDENCE": absent(f) for f in CONTEXT_FIELDS},
        }
    )


OBSERVATION_TEXTS = ("value_text", "unit_reported", "uncertainty_text")


def observation_errors(o: Column, quote: Column, contexts: Column, roles: Column, enums: dict[str, Iterable[str]]) -> Column:
    """P38. contexts: array of valid context ids; roles: array of the entities' roles; enums by field name.

    o: local_id, context_id, statement, statement_kind, result_basis, source_level, direction, value, value_low,
    value_high, value_text, unit_reported, uncertainty_text, limitations.
    """
    low, high, scalar = o["value_low"], o["value_high"], o["value"]
    finite = lambda c: c.isNull() | ~(F.isnan(c) | (F.abs(c) == float("inf")))
    absent = lambda f: ~blank(o[f]) & ~F.contains(quote, o[f])
    loose = lambda c: c.isNotNull() & ~holds_number(quote, c)
    return reasons(
        {
            "LOCAL_ID_EMPTY": blank(o["local_id"]),
            "CONTEXT_UNKNOWN": ~F.coalesce(F.array_contains(contexts, o["context_id"]), F.lit(False)),
            "STATEMENT_EMPTY": blank(o["statement"]),
            **{f.upper(): outside(o[f], enums[f]) for f in ("statement_kind", "result_basis", "source_level", "direction")},
            "NO_ENTITIES": F.coalesce(F.size(roles) == 0, F.lit(True)),
            "ROLES": o["statement_kind"].isin("RESULT", "INTERPRETATION") & ~(F.array_contains(roles, F.lit("SUBJECT")) & F.array_contains(roles, F.lit("OUTCOME"))),
            "LIMITATION_EMPTY": F.exists(o["limitations"], blank),
            "LIMITATION_NOT_IN_EVIDENCE": F.exists(o["limitations"], lambda x: ~blank(x) & ~F.contains(quote, x)),
            **{f"{f.upper()}_NOT_IN_EVIDENCE": absent(f) for f in OBSERVATION_TEXTS},
            "NOT_FINITE": ~(finite(scalar) & finite(low) & finite(high)),
            "SCALAR_AND_RANGE": scalar.isNotNull() & (low.isNotNull() | high.isNotNull()),
            "HALF_RANGE": low.isNull() != high.isNull(),
            "RANGE_REVERSED": low > high,
            "VALUE_TEXT_MISSING": F.coalesce(scalar, low, high).isNotNull() & blank(o["value_text"]),
            "VALUE_UNSUPPORTED": loose(scalar) | loose(low) | loose(high),
        }
    )


def mention_errors(m: Column, enums: dict[str, Iterable[str]], qualifier_types: dict[str, Iterable[str]]) -> Column:
    """Of one mention. enums: roles, types, scopes, owners; qualifier_types: allowed types of each kind.

    m: role, entity_type, identity_scope, owner_kind, context_id, alignment, char_start, char_end, occurrences, page,
    assertion, provenance, evidence_id, qualifier_kinds.
    """
    unique, ambiguous = m["alignment"] == "EXACT_UNIQUE", m["alignment"] == "EXACT_AMBIGUOUS"
    known = F.create_map(*[x for k, types in qualifier_types.items() for x in (F.lit(k), F.array(*[F.lit(t) for t in types]))])
    allowed = lambda k: F.try_element_at(known, k)
    kinds = m["qualifier_kinds"]
    return reasons(
        {
            "OFF_LIST_ROLE": outside(m["role"], enums["roles"]),
            "OFF_LIST_ENTITY_TYPE": outside(m["entity_type"], enums["types"]),
            "OFF_LIST_IDENTITY_SCOPE": outside(m["identity_scope"], enums["scopes"]),
            "OFF_LIST_OWNER_KIND": outside(m["owner_kind"], enums["owners"]),
            "INSTANCE_CONTEXT_MISSING": (m["identity_scope"] == "STUDY_INSTANCE") & blank(m["context_id"]),
            "VERIFIED_SOURCE_OFFSETS_MISSING": unique & (m["char_start"].isNull() | m["char_end"].isNull()),
            "UNIQUE_OCCURRENCE_COUNT_INVALID": unique & ~m["occurrences"].eqNullSafe(F.lit(1)),
            "AMBIGUOUS_OFFSET_MUST_BE_NULL": ambiguous & (m["char_start"].isNotNull() | m["char_end"].isNotNull()),
            "AMBIGUOUS_OCCURRENCE_COUNT_INVALID": ambiguous & F.coalesce(m["occurrences"] < 2, F.lit(True)),
            "VERIFIED_SOURCE_PAGE_MISSING": F.coalesce(m["page"] < 1, F.lit(True)),
            "NON_REPORTED_ASSERTION": outside(m["assertion"], ("REPORTED",)),
            "CONTEXT_PROVENANCE_MISSING": (m["provenance"] == "STUDY_CONTEXT") & blank(m["evidence_id"]),
            "OFF_LIST_QUALIFIER_KIND": F.exists(kinds, lambda k: allowed(k).isNull()),
            "QUALIFIER_TYPE_CONFLICT": F.exists(kinds, lambda k: allowed(k).isNotNull() & ~F.array_contains(allowed(k), m["entity_type"])),
        }
    )


def mention_issues(mentions: DataFrame, record: Column, enums: dict[str, Iterable[str]], qualifier_types: dict[str, Iterable[str]], signature: list[str]) -> DataFrame:
    """(mention_id, code) of all issues, those of repeated ids and of groups that disagree among them.

    mentions: mention_id, source_mention_id and the columns of the signature. Counts are joined back by key.
    """
    own = mentions.select("mention_id", F.explode(mention_errors(record, enums, qualifier_types)).alias("code"))
    twice = mentions.groupBy("mention_id").agg(F.count("*").alias("n")).where("n > 1").select("mention_id", F.lit("DUPLICATE_MENTION_ID").alias("code"))
    groups = mentions.groupBy("source_mention_id").agg(F.countDistinct(F.xxhash64(*signature)).alias("n")).where("n > 1").select("source_mention_id")
    apart = mentions.join(groups, "source_mention_id", "left_semi").select("mention_id", F.lit("INCONSISTENT_SOURCE_MENTION_GROUP").alias("code"))
    return own.unionByName(twice).unionByName(apart).distinct()
