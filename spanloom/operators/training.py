"""The training-set funnel: pairs to seven tables, stage by stage, and the invariants of its output.

Every stage keeps rows or sends them, with stage and reason, to ``quarantine`` (may be mended) or ``discarded``
(never). Nothing is counted twice: each pair ends in just one place, or in several renderings of one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import skeleton
from spanloom.operators import contracts, grounding
from spanloom.operators.rules import assistant_turn, first_reason, reasons
from spanloom.operators.splits import suppress_crossing
from spanloom.storage import materialize

# Types of pairs, the routes that verify one, the line that leads provenance in.
SFT_TYPES, ROUTES = ("FACTUAL", "REASONING"), ("OPEN_AS_IS", "OPEN_WIDENED")
FOOTER = "\n\nProvenance:"
KEYS = ["paper_id", "family_id", "split", "pair_id", "pair_type", "question_key"]
SFT = [*KEYS, "example_id", "mode", "assignment", "verification_tier", "support_route", "question", "descriptor", "evidence", "response", "citation_label", "messages"]
DPO = [*KEYS, "verification_tier", "support_route", "question", "evidence", "chosen", "rejected", "citation_label"]
RERANKER = [*KEYS, "verification_tier", "question", "positive_quote", "hard_negative_quote"]
REJECTED = [*KEYS, "stage", "reason"]
TABLES = {"sft_examples": SFT, "sft_mixed": SFT, "dpo_pairs": DPO, "preference_mixed": DPO, "reranker_mixed": RERANKER, "quarantine": REJECTED, "discarded": REJECTED}
STAGES = ("STRUCTURAL", "DUPLICATE", "RERANKER", "DPO_CONTRACT", "SUPPORT", "ASSIGNMENT", "SPLIT_LEAKAGE")


def _sieve(rows: DataFrame, stage: str, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(rows without a reason, the others with stage and reason)."""
    told = rows.withColumn("reason", reason)
    out = told.where("reason is not null").withColumn("stage", F.lit(stage)).select(*REJECTED)
    return told.where("reason is null").drop("reason"), out


def footed(text: Column, label: Column) -> Column:
    """the provenance under a response, where there is a citation."""
    return F.when(contracts.blank(label), text).otherwise(F.concat(text, F.lit(f"{FOOTER} "), label))


def render_sft(rows: DataFrame, tier: str) -> DataFrame:
    """An example a mode; open ones show the evidence, closed ones the study's descriptor."""
    modes = F.when(F.col("assignment") == "DUAL", F.array(F.lit("OPEN"), F.lit("CLOSED"))).otherwise(F.array("assignment"))
    shown = F.when(F.col("mode") == "OPEN", F.concat(F.lit("Evidence:\n"), "evidence")).otherwise(F.col("descriptor"))
    rows = rows.withColumn("mode", F.explode(modes)).withColumn("response", footed(F.col("target"), F.col("citation_label")))
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    messages = F.array(turn("user", F.concat(shown, F.lit("\n\n"), "question")), turn("assistant", F.col("response")))
    return rows.withColumns({"example_id": F.concat_ws(":", "pair_id", "mode"), "verification_tier": F.lit(tier), "messages": messages}).select(*SFT)


def render_preference(rows: DataFrame, tier: str) -> DataFrame:
    """Both answers carry the same footer, so that it cannot tell them apart."""
    both = {c: footed(F.col(c), F.col("citation_label")) for c in ("chosen", "rejected")}
    return rows.withColumns({**both, "verification_tier": F.lit(tier)}).select(*DPO)


def build(pairs: DataFrame, manifest: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """(seven tables, stage counts) of the pairs of a corpus.

    pairs: pair_id, paper_id, pair_type, question, answer, reasoning, chosen, rejected, positive_quote,
    hard_negative_quote, descriptor, assignment, evidence, citation_label. manifest: paper_id, family_id, split.
    Strict tables hold what its evidence supports; mixed ones hold that and what could not be verified.
    """
    c = F.col
    target = assistant_turn(c("pair_type"), c("chosen"), c("reasoning"), c("answer"))
    rows = pairs.join(manifest, "paper_id", "left").withColumns({"question_key": skeleton(F.coalesce("question", F.lit(""))), "target": target})
    reranker, preference = c("pair_type") == "RERANKER", c("pair_type") == "PREFERENCE"
    structural = {"unknown paper": c("split").isNull(), "unknown type": contracts.outside(c("pair_type"), (*SFT_TYPES, "PREFERENCE", "RERANKER")), "blank question": contracts.blank(c("question")), "blank target": ~reranker & contracts.blank(c("target"))}
    kept, structural_out = _sieve(rows, "STRUCTURAL", first_reason(structural))
    kept = materialize(kept, "structural")
    # equal copies are one row; different rows under one id cannot be told apart
    content = F.xxhash64(*[c(n) for n in pairs.columns if n != "pair_id"])
    copies = kept.withColumn("content", content).groupBy("pair_id").agg((F.min("content") != F.max("content")).alias("apart"))
    kept = kept.dropDuplicates(["pair_id", *[n for n in pairs.columns if n != "pair_id"]]).join(copies, "pair_id")
    kept, duplicate_out = _sieve(kept, "DUPLICATE", F.when(c("apart"), "different rows of one id"))
    both = {"blank quote": contracts.blank(c("positive_quote")) | contracts.blank(c("hard_negative_quote")), "equal quotes": c("positive_quote") == c("hard_negative_quote")}
    kept, reranker_out = _sieve(kept, "RERANKER", F.when(reranker, first_reason(both)))
    kept, contract_out = _sieve(kept, "DPO_CONTRACT", F.when(preference, contracts.preference_ready(c("chosen"), c("rejected"), F.lit(True))))
    kept = materialize(kept, "contracts")
    # what the evidence carries is verified; the rest is quarantined and stays in the mixed tables as unverified
    report = grounding.support(c("target"), c("evidence"), c("question"))
    told = materialize(kept.withColumn("r", F.when(~reranker, report)).withColumns({"supported": F.coalesce("r.supported", F.lit(False)), "why": c("r.reason")}).drop("r"), "support")
    told = told.withColumn("support_route", F.when(c("supported"), "OPEN_AS_IS").otherwise("QUARANTINE"))
    support_out = told.where(~reranker & ~c("supported")).withColumns({"stage": F.lit("SUPPORT"), "reason": c("why")}).select(*REJECTED)
    # a pair that cannot be asked without its paper is asked with it
    closed = contracts.closed_ready(c("pair_type"), c("question"), c("target"), c("descriptor"), c("supported")).isNull()
    told = told.withColumn("assignment", F.when(closed, c("assignment")).when(contracts.blank(c("evidence")), F.lit(None)).otherwise("OPEN"))
    told, assignment_out = _sieve(told, "ASSIGNMENT", F.when(c("pair_type").isin(*SFT_TYPES) & c("assignment").isNull(), "neither open nor closed"))
    told = materialize(told, "assigned")
    clean = suppress_crossing(told, "question_key", "split").select(*told.columns)
    leaked = told.join(clean.select("pair_id"), "pair_id", "left_anti").withColumns({"stage": F.lit("SPLIT_LEAKAGE"), "reason": F.lit("question in several splits")}).select(*REJECTED)
    clean = materialize(clean, "clean")
    sft, pref, rerank = clean.where(c("pair_type").isin(*SFT_TYPES)), clean.where(preference), clean.where(reranker)
    strict, loose = (lambda d: d.where("supported")), (lambda d: d.where("not supported"))
    tables = {
        "sft_examples": render_sft(strict(sft), "VERIFIED"),
        "sft_mixed": render_sft(strict(sft), "VERIFIED").unionByName(render_sft(loose(sft), "UNVERIFIED")),
        "dpo_pairs": render_preference(strict(pref), "VERIFIED"),
        "preference_mixed": render_preference(strict(pref), "VERIFIED").unionByName(render_preference(loose(pref), "UNVERIFIED")),
        "reranker_mixed": rerank.withColumn("verification_tier", F.lit("UNVERIFIED")).select(*RERANKER),
        "quarantine": reduce(DataFrame.unionByName, [duplicate_out, support_out, leaked]),
        "discarded": reduce(DataFrame.unionByName, [structural_out, reranker_out, contract_out, assignment_out]),
    }
    tables = {n: materialize(df, n) for n, df in tables.items()}
    out = tables["quarantine"].unionByName(tables["discarded"]).groupBy("stage").agg(F.count("*").alias("n"))
    made = [df.agg(F.lit(n).alias("stage"), F.count("*").alias("n")) for n, df in tables.items()]
    return tables, reduce(DataFrame.unionByName, [rows.agg(F.lit("READ").alias("stage"), F.count("*").alias("n")), out, *made])


def violations(tables: dict[str, DataFrame], manifest: DataFrame) -> DataFrame:
    """(rule, n) of every invariant, 0 where it holds; one aggregate a table, joins only for what spans tables."""
    c, found = F.col, []
    wrong = [n for n, columns in TABLES.items() if n not in tables or tables[n].columns != columns]
    if wrong:
        raise ValueError(f"tables or columns differ: {wrong}")
    spark = manifest.sparkSession

    def count(name: str, rules: dict[str, Column], unique: str | None) -> None:
        sums = [F.count_if(F.coalesce(r, F.lit(True))).alias(rule) for rule, r in rules.items()]
        repeats = [(F.count("*") - F.countDistinct(unique)).alias("repeated id")] if unique else []
        one = tables[name].agg(*sums, *repeats)
        found.append(one.select(F.explode(F.array(*[F.struct(F.lit(f"{name}: {r}").alias("rule"), c(f"`{r}`").cast("bigint").alias("n")) for r in one.columns])).alias("x")).select("x.*"))

    trace = lambda text: F.contains(text, F.lit(FOOTER)) != ~contracts.blank(c("citation_label"))
    for name, tiers in (("sft_examples", ("VERIFIED",)), ("sft_mixed", ("VERIFIED", "UNVERIFIED"))):
        rules = {
            "pair type": ~c("pair_type").isin(*SFT_TYPES), "tier": ~c("verification_tier").isin(*tiers), "route": (c("verification_tier") == "VERIFIED") & ~c("support_route").isin(*ROUTES),
            "two messages": F.size("messages") != 2, "response in messages": F.try_element_at("messages", F.lit(2))["content"] != c("response"), "footer": trace(c("response")),
            "open without evidence": (c("mode") == "OPEN") & contracts.blank(c("evidence")), "closed without descriptor": (c("mode") == "CLOSED") & contracts.blank(c("descriptor")), "mode": ~c("mode").isin("OPEN", "CLOSED"),
        }
        count(name, rules, "example_id")
        dual = tables[name].where("assignment = 'DUAL'").groupBy("pair_id").agg(F.array_sort(F.collect_list("mode")).alias("modes"))
        found.append(dual.agg(F.lit(f"{name}: dual is open and closed").alias("rule"), F.count_if(c("modes") != F.array(F.lit("CLOSED"), F.lit("OPEN"))).alias("n")))
    for name, tiers in (("dpo_pairs", ("VERIFIED",)), ("preference_mixed", ("VERIFIED", "UNVERIFIED"))):
        rules = {
            "pair type": c("pair_type") != "PREFERENCE", "tier": ~c("verification_tier").isin(*tiers), "route": (c("verification_tier") == "VERIFIED") & ~c("support_route").isin(*ROUTES),
            "footer tells them apart": F.contains("chosen", F.lit(FOOTER)) != F.contains("rejected", F.lit(FOOTER)), "footer": trace(c("chosen")),
        }
        count(name, rules, "pair_id")
    count("reranker_mixed", {"pair type": c("pair_type") != "RERANKER", "tier": c("verification_tier") != "UNVERIFIED", "blank quote": contracts.blank(c("positive_quote")) | contracts.blank(c("hard_negative_quote"))}, "pair_id")
    for strict, mixed, key in (("sft_examples", "sft_mixed", "example_id"), ("dpo_pairs", "preference_mixed", "pair_id")):
        lost = tables[strict].select(key, F.xxhash64(*tables[strict].columns).alias("h")).join(tables[mixed].select(key, F.xxhash64(*tables[mixed].columns).alias("h")), [key, "h"], "left_anti")
        found.append(lost.agg(F.lit(f"{strict}: differs from {mixed}").alias("rule"), F.count("*").alias("n")))
    frozen = manifest.select("paper_id", c("family_id").alias("f"), c("split").alias("s"))
    for name in TABLES:
        joined = tables[name].where("reason <> 'unknown paper'" if "reason" in TABLES[name] else "true").join(frozen, "paper_id", "left")
        found.append(joined.agg(F.lit(f"{name}: differs from the manifest").alias("rule"), F.count_if(~(c("family_id").eqNullSafe(c("f")) & c("split").eqNullSafe(c("s")))).alias("n")))
    published = reduce(DataFrame.unionByName, [tables[n].select("question_key", "split") for n in ("sft_mixed", "preference_mixed", "reranker_mixed")])
    crossing = published.groupBy("question_key").agg((F.min("split") != F.max("split")).alias("x"))
    found.append(crossing.agg(F.lit("question crosses splits").alias("rule"), F.count_if("x").alias("n")))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "rule string, n bigint")
