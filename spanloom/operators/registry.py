"""Changes of a registry of concepts, as tables in and tables out, with the events that tell them.

concepts: concept, label, entity_type, state (ACTIVE, RETIRED), redirect, version. aliases: concept, alias, trust.
assignments: mention_id, concept. constraints: mention_id, rule, target_id. events: version, event, subject, object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.numeric import stable_id
from spanloom.functions.text import primary_key


def _event(version: int, name: str, subject: Column, object_: Column) -> list[Column]:
    return [F.lit(version).alias("version"), F.lit(name).alias("event"), subject.cast("string").alias("subject"), object_.cast("string").alias("object")]


def commit(concepts: DataFrame, aliases: DataFrame, mentions: DataFrame, decisions: DataFrame, version: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(concepts, aliases, events) after ready proposals became concepts and matched mentions taught their names.

    mentions: mention_id, name, entity_type; decisions: mention_id, status, target. A name is learned, as LEARNED, once
    for each concept that has neither it as its label nor as an alias. A second commit of the same changes nothing.
    """
    named = decisions.join(mentions.select("mention_id", "name", "entity_type"), "mention_id")
    ready = named.where("status = 'PROPOSED'").groupBy("target").agg(F.min("name").alias("label"), F.min("entity_type").alias("entity_type"))
    new = ready.join(concepts.select(F.col("concept").alias("target")), "target", "left_anti")
    new = new.select(F.col("target").alias("concept"), "label", "entity_type", F.lit("ACTIVE").alias("state"), F.lit(None).cast("string").alias("redirect"), F.lit(version).alias("version"))
    every = concepts.unionByName(new)
    known = every.select("concept", primary_key(F.col("label")).alias("k")).unionByName(aliases.select("concept", primary_key(F.col("alias")).alias("k")))
    said = named.where("status IN ('MATCHED', 'PROPOSED')").select(F.col("target").alias("concept"), "name", primary_key(F.col("name")).alias("k"))
    learned = said.join(known, ["concept", "k"], "left_anti").groupBy("concept", "k").agg(F.min("name").alias("alias")).select("concept", "alias", F.lit("LEARNED").alias("trust"))
    events = new.select(*_event(version, "CREATE", F.col("concept"), F.col("label"))).unionByName(learned.select(*_event(version, "LEARN_ALIAS", F.col("concept"), F.col("alias"))))
    return every, aliases.unionByName(learned), events


def merge(concepts: DataFrame, requests: DataFrame, version: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(concepts, events, refused) for requests (source, target): the source is retired and leads to the target.

    Refused are requests of unknown or retired concepts, of a concept into itself, of different types, of a source
    that is asked into several targets, and of a target that is itself to be retired.
    """
    side = lambda p: concepts.select(F.col("concept").alias(p), F.col("entity_type").alias(f"{p}_type"), F.col("state").alias(f"{p}_state"))
    targets = requests.groupBy("source").agg(F.countDistinct("target").alias("targets"))
    leaving = requests.select(F.col("source").alias("target")).distinct().withColumn("leaves", F.lit(True))
    asked = requests.distinct().join(targets, "source").join(side("source"), "source", "left").join(side("target"), "target", "left").join(leaving, "target", "left")
    why = (
        F.when(F.col("source_state").isNull() | F.col("target_state").isNull(), "UNKNOWN_CONCEPT")
        .when((F.col("source_state") != "ACTIVE") | (F.col("target_state") != "ACTIVE"), "RETIRED_CONCEPT")
        .when(F.col("source") == F.col("target"), "SELF_MERGE")
        .when(F.col("source_type") != F.col("target_type"), "TYPE_CONFLICT")
        .when(F.col("targets") > 1, "SEVERAL_TARGETS")
        .when(F.col("leaves"), "TARGET_IS_MERGED")
    )
    asked = asked.withColumn("why", why)
    done = asked.where("why is null").select(F.col("source").alias("concept"), F.col("target").alias("__to"))
    after = concepts.join(done, "concept", "left")
    columns = {"state": F.when(F.col("__to").isNotNull(), "RETIRED").otherwise(F.col("state")), "redirect": F.coalesce("__to", "redirect"), "version": F.when(F.col("__to").isNotNull(), version).otherwise(F.col("version"))}
    after = after.select(*[columns.get(c, F.col(c)).alias(c) for c in concepts.columns])
    return after, done.select(*_event(version, "MERGE", F.col("concept"), F.col("__to"))), asked.where("why is not null").select("source", "target", "why")


def split(concepts: DataFrame, assignments: DataFrame, parts: DataFrame, version: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(concepts, assignments, events) for parts (mention_id, label): mentions leave their concept for a new one.

    The new concept's id is a stable hash of the old id and the label; mentions without an assignment are left out.
    """
    moved = parts.join(assignments, "mention_id").withColumn("new", stable_id("SPLIT", F.col("concept"), F.col("label")))
    fresh = moved.groupBy("new").agg(F.min("label").alias("label"), F.min("concept").alias("concept")).join(concepts.select("concept", "entity_type"), "concept")
    made = fresh.join(concepts.select(F.col("concept").alias("new")), "new", "left_anti")
    made = made.select(F.col("new").alias("concept"), "label", "entity_type", F.lit("ACTIVE").alias("state"), F.lit(None).cast("string").alias("redirect"), F.lit(version).alias("version"))
    events = fresh.select(*_event(version, "SPLIT", F.col("concept"), F.col("new")))
    return concepts.unionByName(made), _moved(assignments, moved.select("mention_id", F.col("new").alias("to"))), events


def reassign(assignments: DataFrame, moves: DataFrame, concepts: DataFrame, version: int) -> tuple[DataFrame, DataFrame]:
    """(assignments, events) for moves (mention_id, to) to active concepts; other moves are left out."""
    active = concepts.where("state = 'ACTIVE'").select(F.col("concept").alias("to"))
    good = moves.join(active, "to", "left_semi").join(assignments.select("mention_id", "concept"), "mention_id").where("concept <> to")
    return _moved(assignments, good.select("mention_id", "to")), good.select(*_event(version, "REASSIGN", F.col("mention_id"), F.col("to")))


def _moved(assignments: DataFrame, moves: DataFrame) -> DataFrame:
    return assignments.join(moves, "mention_id", "left").select("mention_id", F.coalesce("to", "concept").alias("concept"))


def constrain(constraints: DataFrame, asked: DataFrame, version: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(constraints, events, refused): new rules join the old ones.

    Refused are rules that contradict an old or a new one: the same target must and must not be linked, or a mention
    must be linked to two targets.
    """
    new = asked.select(*constraints.columns).distinct().join(constraints, constraints.columns, "left_anti")
    every = constraints.unionByName(new)
    both = every.groupBy("mention_id", "target_id").agg((F.min("rule") != F.max("rule")).alias("both"))
    twice = every.where("rule = 'MUST_LINK'").groupBy("mention_id").agg((F.countDistinct("target_id") > 1).alias("twice"))
    judged = new.join(both, ["mention_id", "target_id"]).join(twice, "mention_id", "left")
    why = F.when(F.col("both"), "CONFLICTING_MUST_AND_CANNOT_LINK").when((F.col("rule") == "MUST_LINK") & F.col("twice"), "CONFLICTING_MUST_LINKS")
    judged = judged.withColumn("why", why)
    good = judged.where("why is null").select(*constraints.columns)
    events = good.select(*_event(version, "CONSTRAIN", F.col("mention_id"), F.concat_ws(" ", "rule", "target_id")))
    return constraints.unionByName(good), events, judged.where("why is not null").select(*constraints.columns, "why")
