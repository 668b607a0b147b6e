"""Entity resolution: candidates, conflicts and decisions of mentions against a registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.numeric import stable_id
from spanloom.functions.structured import sorted_map_line
from spanloom.functions.text import ngrams, primary_key, words
from spanloom.operators.ranks import spread
from spanloom.operators.search import top_k
from spanloom.storage import materialize


# Bounds of lexical blocking, and the scores from which a candidate counts and is linked without review.
MAX_POSTINGS, MAX_BLOCKERS, MAX_POOL, TOP_K = 500, 24, 100, 10
CANDIDATE_MIN, ACCEPT, MIN_MARGIN = 60.0, 95.0, 5.0
TRUSTED = ("AUTHORITY", "REVIEWED")
METHODS = ("EXACT_AUTHORITY_ID", "TRUSTED_ALIAS", "NORMALIZED_PRIMARY")


def target_conflicts(m: dict[str, Column], t: dict[str, Column]) -> Column:
    """C20: sorted codes of what keeps a mention from a target; a qualifier that one side lacks is no conflict.

    m: scope, paper_id, context_id, entity_type, qualifiers; t: target_kind and the same others.
    """
    instance = (m["scope"] == "STUDY_INSTANCE") & (t["target_kind"] == "INSTANCE")
    wanted = F.when(m["scope"] == "STUDY_INSTANCE", "INSTANCE").otherwise("CONCEPT")
    unequal = F.filter(F.map_keys(m["qualifiers"]), lambda k: F.map_contains_key(t["qualifiers"], k) & (F.try_element_at(m["qualifiers"], k) != F.try_element_at(t["qualifiers"], k)))
    codes = [
        F.when(t["target_kind"] != wanted, "IDENTITY_SCOPE_CONFLICT"),
        F.when(instance & ~m["paper_id"].eqNullSafe(t["paper_id"]), "CROSS_PAPER_INSTANCE"),
        F.when(instance & ~m["context_id"].eqNullSafe(t["context_id"]), "INSTANCE_CONTEXT_CONFLICT"),
        F.when(m["entity_type"] != t["entity_type"], "ENTITY_TYPE_CONFLICT"),
    ]
    qualifiers = F.transform(F.coalesce(unequal, F.array().cast("array<string>")), lambda k: F.concat(F.lit("IDENTITY_QUALIFIER_CONFLICT:"), k))
    return F.array_sort(F.concat(F.array_compact(F.array(*codes)), qualifiers))


_MENTION = ("scope", "paper_id", "context_id", "entity_type", "qualifiers")
_TARGET = ("target_kind", "paper_id", "context_id", "entity_type", "qualifiers")


def judged(pairs: DataFrame, mentions: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs (mention_id, target_id, ...) with the codes of their conflicts."""
    m = mentions.select("mention_id", *[F.col(c).alias(f"m_{c}") for c in _MENTION])
    t = targets.select("target_id", *[F.col(c).alias(f"t_{c}") for c in _TARGET])
    both = pairs.join(m, "mention_id").join(t, "target_id")
    codes = target_conflicts({c: F.col(f"m_{c}") for c in _MENTION}, {c: F.col(f"t_{c}") for c in _TARGET})
    return both.select(*pairs.columns, codes.alias("conflicts"))


def _block(kind: Column) -> Column:
    """What a mention and a target must share to meet: kind and type, and of instances the paper and the context."""
    scope = F.when(kind == "INSTANCE", F.concat_ws("\x1f", "paper_id", F.coalesce("context_id", F.lit("")))).otherwise("")
    return F.concat_ws("\x1f", kind, "entity_type", scope)


def blocking_keys(label: Column) -> Column:
    """The words (kind 0) and padded character three-grams (kind 1) of a label."""
    own = F.array_distinct(words(label))
    grams = F.array_distinct(ngrams(F.array_join(words(label), " "), 3, ("^", "$")))
    return F.concat(F.transform(own, lambda w: F.struct(F.lit(0).alias("kind"), w.alias("key"))), F.transform(grams, lambda g: F.struct(F.lit(1).alias("kind"), g.alias("key"))))


def label_score(a: Column, b: Column) -> Column:
    """0 to 100, the greater of the edit distance's share and the overlap of words."""
    far = F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))
    x, y = F.array_distinct(words(a)), F.array_distinct(words(b))
    overlap = F.size(F.array_intersect(x, y)) / F.greatest(F.size(F.array_union(x, y)), F.lit(1))
    return F.round(100 * F.greatest(1 - far, overlap), 4)


def _named(mentions: DataFrame) -> DataFrame:
    """(mention_id, block, asked): what each mention asks for, and within what."""
    kind = F.when(F.col("scope") == "STUDY_INSTANCE", "INSTANCE").otherwise("CONCEPT")
    return mentions.select("mention_id", _block(kind).alias("block"), primary_key(F.col("name")).alias("asked"))


def _name_pool(named: DataFrame, targets: DataFrame, most_postings: int = MAX_POSTINGS, blockers: int = MAX_BLOCKERS, pool: int = MAX_POOL) -> DataFrame:
    """(block, asked, target_id, token_hits, gram_hits, rarity): :func:`lexical_pool` of the distinct names of each block."""
    asked = named.select("block", "asked").distinct().withColumn("k", F.explode(blocking_keys(F.col("asked")))).select("block", "asked", "k.*")
    keys = ["block", "kind", "key"]
    postings = spread(targets.select(_block(F.col("target_kind")).alias("block"), "target_id", F.explode(blocking_keys(primary_key(F.col("label")))).alias("k")).select("block", "target_id", "k.*").distinct(), *keys)
    sizes = postings.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") <= most_postings)
    chosen = top_k(asked.join(sizes, keys), ["block", "asked"], [F.col("n"), F.col("kind"), F.col("key")], blockers)
    hits = spread(chosen.select("block", "asked", "kind", "key", "n"), *keys).join(postings, keys)
    found = hits.groupBy("block", "asked", "target_id").agg(F.count_if(F.col("kind") == 0).alias("token_hits"), F.count_if(F.col("kind") == 1).alias("gram_hits"), F.round(F.sum(1 / F.col("n")), 9).alias("rarity"))
    return top_k(found, ["block", "asked"], [F.desc("token_hits"), F.desc("rarity"), F.desc("gram_hits"), F.col("target_id")], pool)


def lexical_pool(mentions: DataFrame, targets: DataFrame, most_postings: int = MAX_POSTINGS, blockers: int = MAX_BLOCKERS, pool: int = MAX_POOL) -> DataFrame:
    """(mention_id, target_id, token_hits, gram_hits, rarity), a bounded pool for each mention.

    Words and three-grams of a mention look up the targets' postings. Postings of more than ``most_postings`` targets
    ask nothing, as their definition has it; of the others the ``blockers`` rarest do, and the ``pool`` targets with
    most words, rarest keys and most three-grams in common stay. Equal mentions of one block are looked up once.
    """
    named = _named(mentions)
    best = _name_pool(named, targets, most_postings, blockers, pool)
    return named.join(best, ["block", "asked"]).select("mention_id", "target_id", "token_hits", "gram_hits", "rarity")


def lexical_candidates(mentions: DataFrame, targets: DataFrame, k: int = TOP_K, least: float = CANDIDATE_MIN) -> DataFrame:
    """(mention_id, target_id, score, rank) of the k most similar targets of each mention's pool.

    Equal mentions of one block are looked up and scored once; only the k best meet the mentions.
    """
    named = _named(mentions)
    labels = targets.select("target_id", primary_key(F.col("label")).alias("b"))
    scored = _name_pool(named, targets).join(labels, "target_id").select("block", "asked", "target_id", label_score(F.col("asked"), F.col("b")).alias("score"))
    best = top_k(scored.where(F.col("score") >= least), ["block", "asked"], [F.desc("score"), F.col("target_id")], k)
    return named.join(best, ["block", "asked"]).select("mention_id", "target_id", "score", "rank")


def exact_hits(mentions: DataFrame, targets: DataFrame, aliases: DataFrame | None = None, hints: DataFrame | None = None, links: DataFrame | None = None) -> DataFrame:
    """(mention_id, target_id, method) by authority id, trusted alias and primary key; method is a place in METHODS.

    aliases: entity_type, alias, target_id, trust; hints: mention_id, authority, external_id; links: authority,
    external_id, target_id. Instances are found by the label within their paper and context.
    """
    kind = F.when(F.col("scope") == "STUDY_INSTANCE", "INSTANCE").otherwise("CONCEPT")
    named = mentions.select("mention_id", "scope", "entity_type", _block(kind).alias("block"), primary_key(F.col("name")).alias("k"))
    labelled = targets.select("target_id", _block(F.col("target_kind")).alias("block"), primary_key(F.col("label")).alias("k"))
    out = named.join(labelled, ["block", "k"]).select("mention_id", "target_id", F.lit(2).alias("method"))
    if aliases is not None:
        known = aliases.where(F.col("trust").isin(*TRUSTED)).select("entity_type", primary_key(F.col("alias")).alias("k"), "target_id")
        out = out.unionByName(named.where("scope <> 'STUDY_INSTANCE'").join(known, ["entity_type", "k"]).select("mention_id", "target_id", F.lit(1).alias("method")))
    if hints is not None and links is not None:
        out = out.unionByName(hints.join(links, ["authority", "external_id"]).select("mention_id", "target_id", F.lit(0).alias("method")))
    return out.distinct()


def resolve(mentions: DataFrame, targets: DataFrame, *, constraints: DataFrame | None = None, aliases: DataFrame | None = None, hints: DataFrame | None = None, links: DataFrame | None = None, vectors: DataFrame | None = None, automatic: bool = True) -> DataFrame:
    """One decision a mention: (mention_id, status, method, target, reasons, score, margin).

    mentions: mention_id, name, entity_type, scope, paper_id, context_id, qualifiers map, safe (its source allows a
    link without review). targets: target_id, target_kind, label, entity_type, paper_id, context_id, qualifiers.
    constraints: mention_id, rule (MUST_LINK, CANNOT_LINK), target_id. vectors: mention_id, target_id, score of an
    embedding search. The arms, the first that decides:

    1. HUMAN: one must-link without conflict links; several, or one that is forbidden or conflicts, go to review.
    2. EXACT: authority id, trusted alias, primary key. Compatible targets are one concept unless their qualifiers
       contradict each other; the least id is linked.
    3. LEXICAL and EMBEDDING candidates: linked from ACCEPT on, if the runner-up is MIN_MARGIN behind and the source safe.
    4. BOOTSTRAP: safe canonical mentions are proposed as new concepts, by type, primary key and qualifiers; PROPOSED
       when two papers or more mention them, else REVIEW. All others wait for review.
    """
    spark = mentions.sparkSession
    none = spark.createDataFrame([], "mention_id string, rule string, target_id string")
    rules = (none if constraints is None else constraints).select(F.col("mention_id").cast(mentions.schema["mention_id"].dataType).alias("mention_id"), "rule", "target_id").distinct()
    cannot = rules.where("rule = 'CANNOT_LINK'").select("mention_id", "target_id")
    musts = rules.where("rule = 'MUST_LINK'").select("mention_id", "target_id")
    tested = judged(musts, mentions, targets)
    must = musts.join(tested, ["mention_id", "target_id"], "left").join(cannot.withColumn("forbidden", F.lit(True)), ["mention_id", "target_id"], "left")
    must = must.groupBy("mention_id").agg(F.count("*").alias("n"), F.min("target_id").alias("target"), F.max(F.coalesce("forbidden", F.lit(False))).alias("forbidden"), F.max(F.col("conflicts").isNull()).alias("missing"), F.flatten(F.collect_list("conflicts")).alias("codes"))
    reason = F.when(F.col("n") > 1, "CONFLICTING_MUST_LINKS").when(F.col("forbidden"), "CONFLICTING_MUST_AND_CANNOT_LINK").when(F.col("missing"), "MUST_LINK_TARGET_MISSING").when(F.size("codes") > 0, F.array_join(F.array_sort("codes"), "|"))
    human = must.select("mention_id", F.when(reason.isNull(), "MATCHED").otherwise("REVIEW_REQUIRED").alias("status"), F.when(reason.isNull(), "HUMAN_OVERRIDE").otherwise("HARD_CONFLICT").alias("method"), F.when(reason.isNull(), F.col("target")).alias("target"), F.coalesce(reason, F.lit("ACTIVE_HUMAN_MUST_LINK")).alias("reasons"), F.lit(None).cast("double").alias("score"), F.lit(None).cast("double").alias("margin"))
    human = materialize(human, "human-links")
    left = mentions.join(human.select("mention_id"), "mention_id", "left_anti")

    hits = exact_hits(left, targets, aliases, hints, links).join(cannot, ["mention_id", "target_id"], "left_anti")
    fitting = materialize(judged(hits, left, targets).where(F.size("conflicts") == 0), "exact-hits")
    allowed = fitting.groupBy("mention_id").agg(F.min("target_id").alias("target"), F.countDistinct("target_id").alias("n"), F.min("method").alias("method"))
    said = fitting.select("mention_id", "target_id").distinct().join(targets.select("target_id", F.explode("qualifiers").alias("q", "v")), "target_id")
    apart = said.groupBy("mention_id", "q").agg((F.min("v") != F.max("v")).alias("apart")).where("apart").groupBy("mention_id").agg(F.array_join(F.array_sort(F.collect_set(F.concat(F.lit("AUTO_MERGE_IDENTITY_QUALIFIER_CONFLICT:"), "q"))), "|").alias("apart"))
    name_of = F.element_at(F.array(*map(F.lit, METHODS)), F.col("method") + 1)
    together = F.col("apart").isNull()
    plain = F.when(F.col("n") > 1, "AUTO_MERGE_EXACT_DUPLICATE_CONCEPTS").otherwise("COLLISION_FREE")
    exact = allowed.join(apart, "mention_id", "left").select("mention_id", F.when(together, "MATCHED").otherwise("REVIEW_REQUIRED").alias("status"), F.when(together, name_of).otherwise("HARD_CONFLICT").alias("method"), F.when(together, F.col("target")).alias("target"), F.coalesce("apart", plain).alias("reasons"), F.lit(100.0).alias("score"), F.lit(None).cast("double").alias("margin"))
    left = materialize(left.join(allowed.select("mention_id"), "mention_id", "left_anti"), "undecided")

    near = lexical_candidates(left, targets).select("mention_id", "target_id", "score", F.lit("LEXICAL_CALIBRATED").alias("by"))
    if vectors is not None:
        near = near.unionByName(vectors.join(left.select("mention_id"), "mention_id", "left_semi").where(F.col("score") >= CANDIDATE_MIN).select("mention_id", "target_id", F.col("score").cast("double").alias("score"), F.lit("EMBEDDING_CALIBRATED").alias("by")))
    near = materialize(judged(near.join(cannot, ["mention_id", "target_id"], "left_anti"), left, targets), "near-targets")
    fits = F.size("conflicts") == 0
    best = near.where(fits).groupBy("mention_id", "target_id").agg(F.max(F.struct("score", "by")).alias("x")).select("mention_id", "target_id", "x.*")
    ranked = top_k(best, ["mention_id"], [F.desc("score"), F.col("target_id")], 2)
    top = ranked.groupBy("mention_id").agg(F.max("score").alias("score"), F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("runner"), F.max(F.when(F.col("rank") == 1, F.col("target_id"))).alias("candidate"), F.max(F.when(F.col("rank") == 1, F.col("by"))).alias("by"))
    blocked = near.where(~fits).select("mention_id").distinct().withColumn("blocked", F.lit(True))
    rest = left.join(top, "mention_id", "left").join(blocked, "mention_id", "left")
    margin = F.col("score") - F.coalesce("runner", F.lit(0.0))
    linked = F.col("safe") & F.lit(automatic) & (F.col("score") >= ACCEPT) & (margin >= MIN_MARGIN)
    seeds = F.col("safe") & (F.col("scope") == "CANONICAL") & (F.col("entity_type") != "OTHER")
    alone = F.col("candidate").isNull() & F.col("blocked").isNull()
    rest = rest.withColumns({"linked": F.coalesce(linked, F.lit(False)), "margin": F.round(margin, 4), "new": seeds | (F.col("safe") & alone)})
    why = F.when(F.col("linked"), "CALIBRATED_TYPE_POLICY").when(~F.col("safe"), "SOURCE_REQUIRES_REVIEW").when(F.col("candidate").isNotNull(), "APPROXIMATE_CANDIDATES_REQUIRE_REVIEW").when(F.col("blocked"), "ALL_CANDIDATES_BLOCKED").otherwise("NO_CANDIDATE")
    rest = rest.withColumns({"k": primary_key(F.col("name")), "signature": sorted_map_line(F.col("qualifiers")), "why": why})
    groups = rest.where("not linked and new").groupBy("entity_type", "k", "signature").agg(F.countDistinct("paper_id").alias("papers"))
    rest = rest.join(groups.withColumn("grouped", F.lit(True)), ["entity_type", "k", "signature"], "left")
    fresh = F.col("new") & F.col("grouped")
    status = F.when(F.col("linked"), "MATCHED").when(fresh & (F.col("papers") >= 2), "PROPOSED").when(fresh, "REVIEW").otherwise("REVIEW_REQUIRED")
    method = F.when(F.col("linked"), F.col("by")).when(fresh, "BOOTSTRAP").when(F.col("candidate").isNotNull(), "AMBIGUOUS_CANDIDATES").when(F.col("blocked"), "HARD_CONFLICT").otherwise("NO_SAFE_DECISION")
    target = F.when(F.col("linked"), F.col("candidate")).when(fresh, stable_id("NEW", F.col("entity_type"), F.col("k"), F.col("signature")))
    approximate = rest.select("mention_id", status.alias("status"), method.alias("method"), target.alias("target"), F.col("why").alias("reasons"), "score", "margin")
    return human.unionByName(exact).unionByName(approximate)


# The names, other forms and adjectives of African countries, by their ISO 3166-1 alpha-2 code.
COUNTRY_NAMES = {
    "DZ": "algeria, algerian", "AO": "angola, angolan", "BJ": "benin, beninese", "BW": "botswana, botswanan, motswana", "BF": "burkina faso, burkinabe", "BI": "burundi, burundian",
    "CV": "cabo verde, cape verde, cabo verdean, cape verdean", "CM": "cameroon, cameroonian", "CF": "central african republic, central african", "TD": "chad, chadian", "KM": "comoros, comorian",
    "CD": "democratic republic of the congo, democratic republic of congo, congo kinshasa, dr congo, drc", "CG": "republic of the congo, republic of congo, congo brazzaville",
    "CI": "cote d ivoire, ivory coast, cote divoire, côte d ivoire, ivorian", "DJ": "djibouti, djiboutian", "EG": "egypt, egyptian", "GQ": "equatorial guinea, equatorial guinean", "ER": "eritrea, eritrean",
    "SZ": "eswatini, swaziland, swazi", "ET": "ethiopia, ethiopian", "GA": "gabon, gabonese", "GM": "gambia, the gambia, gambian", "GH": "ghana, ghanaian", "GN": "guinea", "GW": "guinea bissau, bissau guinean",
    "KE": "kenya, kenyan", "LS": "lesotho, basotho, lesothan", "LR": "liberia, liberian", "LY": "libya, libyan", "MG": "madagascar, malagasy", "MW": "malawi, malawian", "ML": "mali, malian",
    "MR": "mauritania, mauritanian", "MU": "mauritius, mauritian", "MA": "morocco, moroccan", "MZ": "mozambique, mozambican", "NA": "namibia, namibian", "NE": "niger, nigerien",
    "NG": "nigeria, federal republic of nigeria, nigerian", "RW": "rwanda, rwandan", "ST": "sao tome and principe, são tomé and príncipe, sao tomean", "SN": "senegal, senegalese", "SC": "seychelles, seychellois",
    "SL": "sierra leone, sierra leonean", "SO": "somalia, somali", "ZA": "south africa, south african", "SS": "south sudan, south sudanese", "SD": "sudan, sudanese",
    "TZ": "tanzania, united republic of tanzania, tanzanian", "TG": "togo, togolese", "TN": "tunisia, tunisian", "UG": "uganda, ugandan", "ZM": "zambia, zambian", "ZW": "zimbabwe, zimbabwean",
}
# Spellings of feature classes.
FEATURE_NAMES = {"river": "river, rivers", "lake": "lake, lakes", "basin": "basin, basins, watershed, watersheds"}
_QUALIFIERS = {
    "COUNTRY": {name: code for code, names in COUNTRY_NAMES.items() for name in [*names.split(", "), code.lower()]},
    "FEATURE_CLASS": {name: value for value, names in FEATURE_NAMES.items() for name in names.split(", ")},
}


def qualifier_value(kind: Column, value: Column) -> Column:
    """the canonical value of a qualifier of a kind; other values in lower case."""
    low = F.lower(F.trim(F.regexp_replace(value, r"\s+", " ")))
    loose = F.trim(F.regexp_replace(F.regexp_replace(F.replace(low, F.lit("_"), F.lit(" ")), r"(?U)[^\w\s]|-", " "), r"\s+", " "))
    out = low
    for name, values in _QUALIFIERS.items():
        table = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
        out = F.when(F.upper(kind) == name, F.coalesce(F.try_element_at(table, loose), low)).otherwise(out)
    return out


def context_fields(text: Column) -> Column:
    """the fields of a text of the form "name: value; name: value"; parts without a name are left out."""
    parts = F.filter(F.split(text, ";"), lambda p: F.rlike(p, F.lit("^[^:]+:.*[^ ]")))
    pair = lambda p: F.struct(F.lower(F.trim(F.split_part(p, F.lit(":"), F.lit(1)))).alias("key"), F.trim(F.regexp_replace(p, "^[^:]*:", "")).alias("value"))
    pairs = F.transform(parts, pair)
    first = F.filter(pairs, lambda x, i: ~F.array_contains(F.transform(F.slice(pairs, F.lit(1), i), lambda y: y["key"]), x["key"]))
    return F.map_from_entries(first)


def grounded_conditions(conditions: Column, evidence: Column) -> Column:
    """The names of conditions whose value stands in no evidence, word for word."""
    return F.array_sort(F.filter(F.map_keys(conditions), lambda k: ~F.exists(evidence, lambda e: F.contains(e, F.try_element_at(conditions, k)))))


def compatible_clusters(mentions: DataFrame, name: str, mention: str, qualifiers: str) -> DataFrame:
    """(name, mention, cluster): mentions of a name in clusters of compatible qualifiers.

    Equal qualifiers are one cluster. Two clusters merge while each is the only one that the other is compatible with;
    mentions without qualifiers join the cluster if there is just one, else they are a cluster of their own. A task
    holds the distinct qualifier sets of one name; the mentions are joined to their sets afterwards.
    """
    import json

    import pandas as pd

    signed = mentions.select(name, mention, F.to_json(F.map_from_entries(F.array_sort(F.map_entries(qualifiers)))).alias("signature"))
    sets = signed.groupBy(name, "signature").agg(F.min(mention).alias("least"))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        clusters = [(json.loads(s), [s], least) for s, least in sorted(zip(pdf["signature"], pdf["least"], strict=True)) if s != "{}"]
        agree = lambda a, b: all(a[k] == b[k] for k in a.keys() & b.keys())
        while True:
            fits = [[j for j, (b, *_) in enumerate(clusters) if i != j and agree(a, b)] for i, (a, *_) in enumerate(clusters)]
            pair = next(((i, f[0]) for i, f in enumerate(fits) if len(f) == 1 and fits[f[0]] == [i]), None)
            if pair is None:
                break
            i, j = pair
            clusters[i] = ({**clusters[i][0], **clusters[j][0]}, clusters[i][1] + clusters[j][1], min(clusters[i][2], clusters[j][2]))
            del clusters[j]
        rows = [(s, least) for _, held, least in clusters for s in held]
        bare = pdf[pdf["signature"] == "{}"]["least"]
        if len(bare):
            rows.append(("{}", min(clusters[0][2], bare.iloc[0]) if len(clusters) == 1 else bare.iloc[0]))
            if len(clusters) == 1:
                rows = [(s, rows[-1][1]) for s, _ in rows]
        return pd.DataFrame([(pdf[name].iloc[0], s, c) for s, c in rows], columns=[name, "signature", "cluster"])

    kinds = {f.name: f.dataType.simpleString() for f in sets.schema.fields}
    named = sets.groupBy(name).applyInPandas(merge, f"{name} {kinds[name]}, signature string, cluster {kinds['least']}")
    return signed.join(named, [name, "signature"]).select(name, mention, "cluster")
