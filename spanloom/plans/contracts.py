
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators import contracts as C
from spanloom.plans.base import query, read

Spark = SparkSession
TYPES = ("ECONOMY", "SMALL", "LARGE")


def _codes(rules: dict[str, str]) -> str:
    """SQL of the names of all conditions that hold, in order."""
    cases = ", ".join(f"CASE WHEN {condition} THEN '{code}' END" for code, condition in rules.items())
    return f"array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL), '|')"


def _parts(spark: Spark, sf: str, **fields: str | Column) -> DataFrame:
    """p_partkey and a record of the fields, which are SQL over a part."""
    typed = [(F.expr(c) if isinstance(c, str) else c).alias(n) for n, c in fields.items()]
    return read(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", F.struct(*typed).alias("r"))


def _said(rows: DataFrame, errors: Column) -> DataFrame:
    return rows.select("p_partkey", F.array_join(errors, "|").alias("codes"))


@query("model_outputs", """WITH x AS (SELECT event_id, event_id % 9 AS k FROM events) SELECT event_id, CASE k WHEN 0 THEN 'no object' WHEN 1 THEN 'missing:reason' WHEN 2 THEN 'decision' WHEN 3 THEN 'domain' WHEN 4 THEN 'evidence' WHEN 5 THEN 'score:scientific_depth' WHEN 6 THEN 'score:knowledge_value' ELSE '' END AS error FROM x""")
def model_outputs(spark: Spark, sf: str) -> DataFrame:
    """Verdicts of a model, with thoughts and fences around them, checked."""
    k = F.col("event_id") % 9
    field = lambda name, good, bad, at: F.when(k == at, bad).otherwise(good).alias(name)
    fields = [field("decision", "include", "maybe", 2), F.lit(False).alias("hard_exclusion"), field("domain", "agr", "XYZ", 3), field("evidence", "said so", " ", 4), F.when(k != 1, "because").alias("reason")]
    fields += [F.when((k == 5) & (F.lit(n) == "scientific_depth"), "true").when((k == 6) & (F.lit(n) == "knowledge_value"), "2.5").otherwise("3").alias(n) for n in C.SCORES]
    said = F.concat(F.lit("<think>{no}</think>```json\n"), F.to_json(F.struct(*fields)), F.lit("\n```"))
    return read(spark, sf, "events").select("event_id", F.coalesce(C.model_output(F.when(k == 0, "I cannot say").otherwise(said)), F.lit("")).alias("error"))


_LADDER = "SELECT p_partkey, p_size AS s, p_type AS kind, CASE WHEN p_size % 11 = 0 THEN '' ELSE 'What is ' || p_name END AS question, CASE WHEN p_size % 13 = 0 THEN p_name ELSE p_brand END AS answer, CASE WHEN p_size % 7 = 0 THEN 'short' WHEN p_size % 17 = 0 THEN p_name || ' in a case report of the ''North'' with many words' ELSE p_name || ' in the study ''A long and telling title'' of many' END AS descriptor FROM part"


def _asked(spark: Spark, sf: str) -> DataFrame:
    s, name = F.col("p_size"), F.col("p_name")
    descriptor = F.when(s % 7 == 0, "short").when(s % 17 == 0, F.concat(name, F.lit(" in a case report of the 'North' with many words"))).otherwise(F.concat(name, F.lit(" in the study 'A long and telling title' of many")))
    kind = F.when(F.col("p_type") == "ECONOMY", "factual").when(F.col("p_type") == "SMALL", "REASONING").otherwise("PREFERENCE")
    return read(spark, sf, "part").select("p_partkey", s.alias("s"), kind.alias("kind"), F.when(s % 11 == 0, "").otherwise(F.concat(F.lit("What is "), name)).alias("question"), F.when(s % 13 == 0, name).otherwise(F.col("p_brand")).alias("answer"), descriptor.alias("descriptor"))


@query("closed_readiness", f"""WITH x AS ({_LADDER}) SELECT p_partkey, CASE WHEN s = 3 THEN 'not verified against the paper' WHEN kind NOT IN ('ECONOMY', 'SMALL') THEN 'not an SFT knowledge pair' WHEN length(descriptor) < 45 OR NOT contains(descriptor, '''') THEN 'no titled study descriptor' WHEN contains(descriptor, 'case report') THEN 'single case is not a stable closed-book target' WHEN question = '' THEN 'question or target is blank' WHEN s % 13 = 0 THEN 'descriptor reveals the target' ELSE '' END AS why FROM x""")
def closed_readiness(spark: Spark, sf: str) -> DataFrame:
    """P18 P20"""
    c = F.col
    return _asked(spark, sf).select("p_partkey", F.coalesce(C.closed_ready(c("kind"), c("question"), c("answer"), c("descriptor"), c("s") != 3), F.lit("")).alias("why"))


@query("permissive_readiness", f"""WITH x AS ({_LADDER}) SELECT p_partkey, CASE WHEN kind NOT IN ('ECONOMY', 'SMALL') THEN 'not an SFT knowledge pair' WHEN s % 2 = 0 THEN 'no usable study context' WHEN question = '' THEN 'question or target is blank' WHEN s % 13 = 0 AND s % 7 <> 0 THEN 'study context reveals the target' ELSE '' END AS why FROM x""")
def permissive_readiness(spark: Spark, sf: str) -> DataFrame:
    """A context of two lines or more is wanted."""
    c = F.col
    lines = F.concat(F.when(c("s") % 2 == 0, F.replace("descriptor", F.lit("\n"), F.lit(" "))).otherwise(F.concat("descriptor", F.lit("\nfurther context"))))
    return _asked(spark, sf).select("p_partkey", F.coalesce(C.permissive_ready(c("kind"), c("question"), c("answer"), lines), F.lit("")).alias("why"))


@query("preference_readiness", """SELECT p_partkey, CASE WHEN p_size = 1 THEN 'chosen or rejected missing' WHEN p_size % 2 = 0 THEN 'chosen and rejected are the same' WHEN p_size % 5 = 0 THEN 'chosen is not supported by the evidence' ELSE '' END AS why FROM part""")
def preference_readiness(spark: Spark, sf: str) -> DataFrame:
    """P21"""
    s = F.col("p_size")
    rejected = F.when(s == 1, " ").when(s % 2 == 0, F.upper(F.replace("p_name", F.lit(" "), F.lit("-")))).otherwise(F.col("p_brand"))
    return read(spark, sf, "part").select("p_partkey", F.coalesce(C.preference_ready(F.col("p_name"), rejected, s % 5 != 0), F.lit("")).alias("why"))


@query("resolver_gates", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' WHEN o_totalprice < 100000 AND o_orderpriority = '5-LOW' THEN 'NOT_REAL_SCIENCE|NOT_AFRICA_RELEVANT' WHEN o_totalprice < 100000 THEN 'NOT_REAL_SCIENCE' WHEN o_orderpriority = '5-LOW' THEN 'NOT_AFRICA_RELEVANT' ELSE '' END AS excluded FROM orders")
def resolver_gates(spark: Spark, sf: str) -> DataFrame:
    """P26"""
    gate = C.resolver_gate(F.col("o_orderstatus") != "P", F.col("o_totalprice") >= 100000, F.col("o_orderpriority") != "5-LOW")
    return read(spark, sf, "orders").select("o_orderkey", gate.alias("excluded"))


@query("observation_flags", f"SELECT p_partkey, {_codes({'AMBIGUOUS_SOURCE_ALIGNMENT': 'p_size < 10', 'OTHER_ENTITY_TYPE': 'p_size % 3 = 0', 'SECONDARY_EVIDENCE': "p_type = 'SMALL'", 'SYNTHESIS_EVIDENCE': "p_type = 'LARGE'", 'UNMODELED_CONDITION': 'p_size % 5 = 0', 'UNMODELED_QUALIFIER': 'p_size % 7 = 0'})} AS codes FROM part")
def observation_flags(spark: Spark, sf: str) -> DataFrame:
    """P27"""
    s = F.col("p_size")
    one = lambda c, yes, no: F.array(F.lit(no), F.when(c, yes).otherwise(no))
    level = F.when(F.col("p_type") == "SMALL", "SECONDARY").when(F.col("p_type") == "LARGE", "SYNTHESIS").otherwise("PRIMARY")
    flags = C.quality_flags(level, one(s % 5 == 0, "UNMODELED_CONDITION", "PH"), one(s % 7 == 0, "UNMODELED_QUALIFIER", "COUNTRY"), one(s % 3 == 0, "OTHER", "PLACE"), one(s < 10, "EXACT_AMBIGUOUS", "EXACT_UNIQUE"))
    return _said(read(spark, sf, "part"), flags)


@query("resolved_licences", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN lower(p_type) WHEN p_size % 3 = 0 THEN lower(p_brand) WHEN p_size % 5 = 0 THEN 'cc-by' ELSE '' END AS licence FROM part")
def resolved_licences(spark: Spark, sf: str) -> DataFrame:
    """The first of three columns that says something."""
    s = F.col("p_size")
    first, second, third = F.when(s % 2 == 0, F.concat(F.lit(" "), "p_type")).otherwise("NaN"), F.when(s % 3 == 0, F.col("p_brand")), F.when(s % 5 == 0, "CC-BY ").otherwise("None")
    return read(spark, sf, "part").select("p_partkey", C.first_licence(first, second, third).alias("licence"))


@query("evidence_contract", f"SELECT p_partkey, {_codes({'LOCAL_ID_EMPTY': 'p_size = 1', 'SOURCE_KIND': "p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE')", 'SECTION': 'p_size = 2', 'PAGE_OUTSIDE_TASK': 'p_size > 40', 'QUOTE_NOT_TRIMMED': 'p_size % 5 = 0', 'QUOTE_TOO_LONG': 'p_size = 9', 'QUOTE_NOT_IN_SOURCE': 'p_size <= 40 AND p_size % 5 <> 0 AND (p_size % 7 = 0 OR p_size = 9)'})} AS codes FROM part")
def evidence_contract(spark: Spark, sf: str) -> DataFrame:
    """A quote must stand, as it is, on its page."""
    quote = "CASE WHEN p_size % 5 = 0 THEN concat(p_brand, ' ') WHEN p_size = 9 THEN repeat('q', 1501) WHEN p_size % 7 = 0 THEN concat(p_brand, 'x') ELSE p_brand END"
    rows = _parts(spark, sf, local_id="CASE WHEN p_size = 1 THEN ' ' ELSE p_name END", source_kind="p_type", source_label="p_name", page="p_size", section="CASE WHEN p_size <> 2 THEN p_name END", quote=quote)
    pages = F.create_map(F.when(F.col("p_size") <= 40, F.col("p_size")).otherwise(0), F.concat("p_name", F.lit(" "), "p_brand", F.lit(" end")))
    return _said(rows, C.evidence_errors(F.col("r"), pages, TYPES))


_ENTITY = {
    "SURFACE_TEXT_EMPTY": "p_size = 1",
    "ROLE": "p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE')",
    "INSTANCE_ID_REQUIRED": "p_size % 2 = 0 AND p_size % 3 = 0",
    "INSTANCE_ID_FORBIDDEN": "p_size % 2 = 1 AND p_size % 3 <> 0",
    "EVIDENCE_UNRESOLVED": "p_size = 5",
    "SURFACE_NOT_IN_EVIDENCE": "p_size = 5 OR p_size % 7 = 0",
    "QUALIFIER_KIND": "p_size % 11 = 0",
    "QUALIFIER_NOT_IN_EVIDENCE": "p_size % 13 = 0",
    "QUALIFIER_REPEATED": "p_size % 17 = 0",
    "ALIAS_IS_OWN_NAME": "p_size % 19 = 0",
    "ALIAS_REPEATED": "p_size % 23 = 0",
    "ALIAS_KIND": "p_size % 25 = 0",
}


@query("entity_contract", f"SELECT p_partkey, {_codes(_ENTITY)} AS codes FROM part")
def entity_contract(spark: Spark, sf: str) -> DataFrame:
    """P33 N15 N16"""
    qualifier = "named_struct('kind', CASE WHEN p_size % 11 = 0 THEN 'X' ELSE 'COUNTRY' END, 'value_text', CASE WHEN p_size % 13 = 0 THEN 'zz' ELSE p_brand END)"
    alias = lambda text, kind="'SYNONYM'": f"named_struct('text', {text}, 'kind', {kind}, 'language', 'en', 'stated_in_paper', true)"
    rows = _parts(
        spark, sf, source_mention_id="p_brand", source_evidence_id="CASE WHEN p_size = 5 THEN 'none' ELSE 'E1' END", surface_text="CASE WHEN p_size = 1 THEN '' WHEN p_size % 7 = 0 THEN 'absent' ELSE p_name END", atom_text="p_name", role="p_type",
        entity_type=F.lit("PLACE"), identity_scope="CASE WHEN p_size % 2 = 0 THEN 'STUDY_INSTANCE' ELSE 'CANONICAL' END", instance_local_id="CASE WHEN p_size % 3 = 0 THEN '' ELSE 'I1' END", provenance_scope=F.lit("OWNER"),
        aliases=f"array({alias("CASE WHEN p_size % 19 = 0 THEN upper(p_name) ELSE 'first' END")}, {alias("CASE WHEN p_size % 23 = 0 THEN 'FIRST ' ELSE 'second' END", "CASE WHEN p_size % 25 = 0 THEN '?' ELSE 'SYNONYM' END")})",
        qualifiers=f"CASE WHEN p_size % 17 = 0 THEN array({qualifier}, {qualifier}) ELSE array({qualifier}) END",
    )
    enums = {"roles": TYPES, "types": ("PLACE",), "provenances": ("OWNER", "STUDY_CONTEXT"), "qualifiers": ("COUNTRY",), "aliases": ("SYNONYM",)}
    quotes = F.create_map(F.lit("E1"), F.concat("p_name", F.lit(" of "), "p_brand"))
    return _said(rows, C.entity_errors(F.col("r"), quotes, F.create_map(F.lit("C1"), F.lit("context")), enums))


@query("source_groups", "SELECT p_brand AS owner, p_name AS g, count(DISTINCT p_type) > 1 AS disagree, count(*) > count(DISTINCT p_size) AS repeated FROM part GROUP BY ALL HAVING count(DISTINCT p_type) > 1 OR count(*) > count(DISTINCT p_size)")
def source_groups(spark: Spark, sf: str) -> DataFrame:
    """Mentions of one source phrase that disagree, or one atom twice."""
    rows = read(spark, sf, "part").select(F.col("p_brand").alias("owner"), F.col("p_name").alias("g"), "p_type", "p_size")
    return C.source_group_errors(rows, "owner", "g", ["p_type"], ["p_size"])


_PAIR = {
    "ANSWER_EMPTY": "k IN (0, 1) AND s = 1",
    "PAIR_KIND": "k = 1 AND s % 3 = 0",
    "ANSWER_NUMBERS": "k IN (0, 1) AND s <> 1 AND s % 5 = 0",
    "QUOTE_NOT_IN_SOURCE": "k = 2 AND s % 5 = 0",
    "NEGATIVE_REASON": "k = 2 AND s % 7 = 0",
    "QUOTES_EQUAL": "k = 2 AND s % 11 = 0",
    "POSITIVE_NOT_IN_EVIDENCE": "k = 2 AND s % 5 = 0",
    "CHOICES_EQUAL": "k = 3 AND s % 5 = 0",
    "CHOSEN_NUMBERS": "k = 3 AND s % 5 = 0",
    "REJECTED_IS_GROUNDED": "k = 3 AND s % 2 = 0 AND s % 5 <> 0",
}
_KINDS = ("FACTUAL", "REASONING", "RERANKER", "PREFERENCE")


def _pairs(spark: Spark, sf: str) -> DataFrame:
    bad = "CASE WHEN p_size % 5 = 0 THEN 'it is 77,777' ELSE concat('it is ', p_size) END"
    return _parts(
        spark, sf, kind=f"element_at(array{_KINDS}, cast(p_partkey % 4 as int) + 1)", local_id="p_name", pair_kind="CASE WHEN p_size % 3 = 0 THEN 'odd' ELSE 'CAUSAL' END", question="p_name", answer=f"CASE WHEN p_size = 1 THEN '' ELSE {bad} END", reasoning="p_name",
        chosen=bad, rejected="CASE WHEN p_size % 5 = 0 THEN 'it is 77,777' ELSE concat('not ', p_size) END", rejection_reason="CASE WHEN p_size % 2 = 0 THEN 'UNGROUNDED_NUMBER' ELSE 'VAGUE' END",
        positive_quote="CASE WHEN p_size % 5 = 0 THEN 'absent' ELSE p_name END", hard_negative_quote="CASE WHEN p_size % 11 = 0 THEN CASE WHEN p_size % 5 = 0 THEN 'absent' ELSE p_name END ELSE p_brand END", negative_reason="CASE WHEN p_size % 7 = 0 THEN '?' ELSE 'NEAR' END", quote="concat(p_name, ' has ', p_size)",
    )


@query("training_pairs_contract", f"WITH x AS (SELECT p_partkey, p_partkey % 4 AS k, p_size AS s FROM part) SELECT p_partkey, {_codes(_PAIR)} AS codes FROM x")
def training_pairs_contract(spark: Spark, sf: str) -> DataFrame:
    """P35 F67"""
    source = F.concat("p_name", F.lit(" "), "p_brand")
    return _said(_pairs(spark, sf), C.pair_errors(F.col("r"), source, {"kinds": ("CAUSAL",), "negatives": ("NEAR",), "rejections": ("UNGROUNDED_NUMBER", "VAGUE")}))


@query("training_task_budgets", """WITH x AS (SELECT p_brand AS task_id, p_partkey % 4 AS k, p_size % 3 = 0 AS odd, p_name FROM part), n AS (SELECT task_id, k, count(*) AS n, count(*) FILTER (WHERE odd) AS odd FROM x GROUP BY ALL)
SELECT task_id, 'OVER_SHARE:' || ['FACTUAL', 'REASONING', 'RERANKER', 'PREFERENCE'][k + 1] AS code FROM n WHERE n > 20 UNION ALL SELECT task_id, 'UNDER_FLOOR:odd' FROM n WHERE k = 1 AND n >= 8 AND odd < 8 UNION ALL SELECT DISTINCT task_id, 'REPEATED_ID' FROM (SELECT task_id, p_name FROM x GROUP BY ALL HAVING count(*) > 1)""")
def training_task_budgets(spark: Spark, sf: str) -> DataFrame:
    """Shares of a paper's budget, floors of kinds, and ids, a task."""
    pairs = _pairs(spark, sf).select(F.col("p_brand").alias("task_id"), "r.kind", "r.pair_kind", "r.local_id")
    budgets = pairs.select("task_id").distinct().select("task_id", F.explode(F.array(*map(F.lit, _KINDS))).alias("kind"), F.lit(20).alias("share"))
    return C.task_errors(pairs, budgets, spark.createDataFrame([("odd", 8)], "pair_kind string, floor int"))


_PROFILE = {
    "COVERAGE": "p_size % 2 = 0",
    "CONTRIBUTION_EMPTY": "p_size = 1",
    "SCIENCE_FLAG": "p_size = 2",
    "DOMAIN": "p_size % 3 = 0",
    "DISCIPLINE": "p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE')",
    "SECONDARY_COUNT": "p_size % 5 = 0",
    "SECONDARY_IS_PRIMARY": "p_type = 'SMALL' OR (p_size % 5 = 0 AND p_type IN ('ECONOMY', 'LARGE'))",
    "SECONDARY_REPEATED": "p_size % 7 = 0 AND p_size % 5 <> 0",
    "MISSING_OF_PARTIAL": "p_size % 2 = 1 AND p_size % 11 = 0",
    "MISSING_STATUS": "p_size % 11 = 0",
}


@query("profile_contract", f"SELECT p_partkey, {_codes(_PROFILE)} AS codes FROM part")
def profile_contract(spark: Spark, sf: str) -> DataFrame:
    """P36"""
    rows = _parts(
        spark, sf, coverage_complete="p_size % 2 = 0", language=F.lit("en"), key_contribution="CASE WHEN p_size = 1 THEN '' ELSE p_name END", is_real_science="CASE WHEN p_size <> 2 THEN true END", is_africa_relevant=F.lit(True), domain="CASE WHEN p_size % 3 = 0 THEN '?' ELSE 'AGR' END",
        discipline="p_type", discipline_secondary="CASE WHEN p_size % 5 = 0 THEN array('SMALL', 'LARGE', 'ECONOMY') WHEN p_size % 7 = 0 THEN array('SMALL', 'SMALL') ELSE array('SMALL') END",
        missing_content="CASE WHEN p_size % 11 = 0 THEN array(named_struct('kind', 'TABLE', 'label', 'T1', 'referenced_on_page', 3, 'status', 'LOST')) END",
    )
    return _said(rows, C.profile_errors(F.col("r"), F.lit(False), TYPES, C.DOMAINS, ("TABLE",)))


@query("context_contract", f"SELECT p_partkey, {_codes({'LOCAL_ID_EMPTY': 'p_size = 1', 'LABEL_EMPTY': 'p_size % 5 = 0', 'NO_EVIDENCE': 'p_size = 3', 'PERIOD_TEXT_TYPE': 'p_size % 7 = 0', 'STUDY_DESIGN_NOT_IN_EVIDENCE': 'p_size = 3', 'POPULATION_TEXT_NOT_IN_EVIDENCE': 'p_size % 3 = 0'})} AS codes FROM part")
def context_contract(spark: Spark, sf: str) -> DataFrame:
    """What is said of a study stands in its evidence."""
    rows = _parts(spark, sf, local_id="CASE WHEN p_size = 1 THEN '' ELSE p_name END", label="CASE WHEN p_size % 5 = 0 THEN ' ' ELSE p_name END", study_design="p_name", population_text="CASE WHEN p_size % 3 = 0 THEN 'nobody' ELSE p_brand END", period_text="CASE WHEN p_size % 7 <> 0 THEN '' END", sample_size_text=F.lit(""))
    quotes = F.when(F.col("p_size") == 3, F.array().cast("array<string>")).otherwise(F.array("p_brand", F.concat(F.lit("a "), "p_name")))
    return _said(rows, C.context_errors(F.col("r"), quotes))


_OBSERVATION = {
    "CONTEXT_UNKNOWN": "p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE')",
    "DIRECTION": "p_size % 11 = 0",
    "ROLES": "p_size % 2 = 0 AND p_size % 3 = 0",
    "LIMITATION_NOT_IN_EVIDENCE": "p_size % 13 = 0",
    "UNIT_REPORTED_NOT_IN_EVIDENCE": "p_size % 17 = 0",
    "SCALAR_AND_RANGE": "p_size % 5 = 0",
    "HALF_RANGE": "p_size % 5 = 0 AND p_size % 2 = 0",
    "RANGE_REVERSED": "p_size % 5 = 0 AND p_size % 2 = 1",
    "VALUE_TEXT_MISSING": "p_size % 19 = 0",
    "VALUE_UNSUPPORTED": "p_size % 5 = 0 OR p_size % 7 = 0",
}


@query("observation_contract", f"SELECT p_partkey, {_codes(_OBSERVATION)} AS codes FROM part")
def observation_contract(spark: Spark, sf: str) -> DataFrame:
    """A value or a range, and what is said must stand in the quote."""
    double = lambda sql: f"cast({sql} as double)"
    rows = _parts(
        spark, sf, local_id="p_name", context_id="p_type", statement="p_name", statement_kind="CASE WHEN p_size % 2 = 0 THEN 'RESULT' ELSE 'METHOD' END", result_basis=F.lit("MEASURED"), source_level=F.lit("PRIMARY"), direction="CASE WHEN p_size % 11 = 0 THEN '?' ELSE 'UP' END",
        value=double("CASE WHEN p_size % 7 = 0 THEN p_size + 1000 ELSE p_size END"), value_low=double("CASE WHEN p_size % 5 = 0 THEN p_size + 2000 END"), value_high=double("CASE WHEN p_size % 10 = 5 THEN p_size + 1999 END"),
        value_text="CASE WHEN p_size % 19 = 0 THEN '' ELSE cast(p_size as string) END", unit_reported="CASE WHEN p_size % 17 = 0 THEN 'mg' ELSE 'kg' END", uncertainty_text=F.lit(""), limitations="CASE WHEN p_size % 13 = 0 THEN array('unsaid') ELSE array(p_name) END",
    )
    quote = F.concat("p_name", F.lit(" weighed "), F.col("p_size").cast("string"), F.lit(" kg"))
    roles = F.when(F.col("p_size") % 3 == 0, F.array(F.lit("SUBJECT"))).otherwise(F.array(F.lit("SUBJECT"), F.lit("OUTCOME")))
    enums = {"statement_kind": ("RESULT", "METHOD"), "result_basis": ("MEASURED",), "source_level": ("PRIMARY",), "direction": ("UP",)}
    return _said(rows, C.observation_errors(F.col("r"), quote, F.array(*map(F.lit, TYPES)), roles, enums))


_MENTIONS = {
    "OFF_LIST_ENTITY_TYPE": "p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE')",
    "INSTANCE_CONTEXT_MISSING": "p_size % 2 = 0 AND p_size % 3 = 0",
    "VERIFIED_SOURCE_OFFSETS_MISSING": "p_size % 5 = 0",
    "UNIQUE_OCCURRENCE_COUNT_INVALID": "p_size % 5 <> 1 AND p_size % 7 = 0",
    "AMBIGUOUS_OFFSET_MUST_BE_NULL": "p_size % 5 = 1",
    "AMBIGUOUS_OCCURRENCE_COUNT_INVALID": "p_size % 5 = 1 AND p_size % 7 <> 0",
    "VERIFIED_SOURCE_PAGE_MISSING": "p_size = 9",
    "NON_REPORTED_ASSERTION": "p_size = 11",
    "OFF_LIST_QUALIFIER_KIND": "p_size % 13 = 0",
    "QUALIFIER_TYPE_CONFLICT": "p_size % 13 <> 0 AND p_type <> 'SMALL'",
}


@query("mention_contract", f"WITH x AS (SELECT p_partkey, p_name, p_brand, p_type, unnest(list_filter(string_split({_codes(_MENTIONS)}, '|'), lambda c: c <> '')) AS code FROM part), g AS (SELECT p_name, p_brand FROM part GROUP BY ALL HAVING count(DISTINCT p_type) > 1) SELECT p_partkey AS mention_id, code FROM x UNION ALL SELECT p_partkey, 'INCONSISTENT_SOURCE_MENTION_GROUP' FROM part SEMI JOIN g USING (p_name, p_brand)")
def mention_contract(spark: Spark, sf: str) -> DataFrame:
    """C25"""
    rows = _parts(
        spark, sf, role=F.lit("SUBJECT"), entity_type="p_type", identity_scope="CASE WHEN p_size % 2 = 0 THEN 'STUDY_INSTANCE' ELSE 'CANONICAL' END", owner_kind=F.lit("OBSERVATION"), context_id="CASE WHEN p_size % 3 = 0 THEN '' ELSE 'C' END", alignment="CASE WHEN p_size % 5 = 1 THEN 'EXACT_AMBIGUOUS' ELSE 'EXACT_UNIQUE' END",
        char_start="CASE WHEN p_size % 5 <> 0 THEN p_size END", char_end="p_size + 3", occurrences="CASE WHEN p_size % 7 = 0 THEN 2 ELSE 1 END", page="CASE WHEN p_size <> 9 THEN p_size END", assertion="CASE WHEN p_size = 11 THEN 'INFERRED' ELSE 'REPORTED' END", provenance=F.lit("OWNER"), evidence_id=F.lit("E"), qualifier_kinds="array(CASE WHEN p_size % 13 = 0 THEN 'X' ELSE 'COUNTRY' END)",
    )
    rows = rows.select("r", "p_type", F.col("p_partkey").alias("mention_id"), F.concat("p_name", F.lit("/"), "p_brand").alias("source_mention_id"))
    enums = {"roles": ("SUBJECT",), "types": TYPES, "scopes": ("CANONICAL", "STUDY_INSTANCE"), "owners": ("OBSERVATION",)}
    return C.mention_issues(rows, F.col("r"), enums, {"COUNTRY": ("SMALL",)}, ["p_type"])
