"""Composite operators against hand-made cases."""

import random

import pytest
from pyspark.sql import functions as F

from spanloom.operators import chunks, classify, compare, families, funnel, graph, grounding, joins, metrics, registry, resolve, rules, search, sequences, splits
from spanloom.operators.search import DECAY, FREE_SLOTS


def rows(df, *by):
    return [tuple(r) for r in df.orderBy(*by).collect()]


def test_components_of_chain_star_and_loop(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 9)] + [(50, 50), (None, 3)]
    got = dict(graph.connected_components(spark.createDataFrame(edges, "a int, b int")).collect())
    assert {got[n] for n in range(100, 161)} == {100} and {got[n] for n in range(1, 9)} == {1} and got[50] == 50


def test_components_without_edges(spark):
    assert graph.connected_components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_diversity_equals_the_greedy_choice(spark):
    rng, hits = random.Random(5), []
    for q in range(20):
        hits += [(q, d, round(rng.choice([1.0, 0.9, 0.8, 0.5]) * rng.random(), 3), f"p{rng.randrange(3)}") for d in range(15)]
    df = spark.createDataFrame(hits, "question int, doc int, score double, paper string")
    got = {}
    for r in search.diversify(df, 8, ["question"], "paper").collect():
        got.setdefault(r["question"], {})[r["place"]] = r["reduced"]
    for q in range(20):
        left, seen, best = sorted([h for h in hits if h[0] == q], key=lambda h: (-h[2], h[1])), {}, []
        while left and len(best) < 8:
            value = lambda h: round(h[2] * DECAY ** max(0, seen.get(h[3], 0) - FREE_SLOTS + 1), 6)  # noqa: B023, E731
            top = max(left, key=lambda h: (value(h), h[2], -h[1]))
            best.append(value(top))
            seen[top[3]] = seen.get(top[3], 0) + 1
            left.remove(top)
        assert [got[q][k] for k in sorted(got[q])] == pytest.approx(best)


def test_rrf(spark):
    channels = spark.createDataFrame([(1, 10, "a", 1), (1, 11, "a", 2), (1, 11, "b", 1)], "question int, doc int, channel string, rank int")
    got = rows(search.fuse(channels, {"a": 1.0, "b": 0.5}), "doc")
    assert got == [(1, 10, round(1 / 61, 9), "a"), (1, 11, round(1 / 62 + 0.5 / 61, 9), "a,b")]


def test_gate_reasons(spark):
    hits = spark.createDataFrame([(1, 1, 1, ["x", "y"]), (2, 1, 1, ["y"]), (3, 1, 1, ["y", "z"])], "question int, doc int, rank int, facets array<string>")
    wanted = spark.createDataFrame([(1, "x"), (2, None), (3, "x"), (4, "x")], "question int, primary string")
    got = {r["question"]: (r["reason"], r["available"], r["answerable"]) for r in search.gate(hits, wanted, ["z"]).collect()}
    assert got == {1: ("both_axes_matched", "", True), 2: ("no_property_constraint", "", True), 3: ("property_absent", "y", False), 4: ("no_candidates", "", False)}


def test_split_keeps_families_and_quotas(spark):
    papers = spark.createDataFrame([(f"f{i // 2}", "health" if i < 400 else "tech") for i in range(440)], "family string, domain string")
    got = splits.stratified_split(papers, "family", "domain", 0.03, 0.03, floor=5).groupBy("domain", "split").count()
    n = {(r[0], r[1]): r[2] for r in got.collect()}
    assert n["health", "evaluate"] == n["health", "test"] == 6 and n["tech", "evaluate"] == n["tech", "test"] == 4 and n["tech", "train"] == 12


def test_heal_and_suppress(spark):
    df = spark.createDataFrame([(1, "k", "train"), (2, "k", "test"), (3, "m", "test")], "id int, key string, split string")
    assert rows(splits.heal(df, "key", "split").select("id", "split", "moved"), "id") == [(1, "train", False), (2, "train", True), (3, "test", False)]
    assert rows(splits.suppress_crossing(df, "key", "split").select("id"), "id") == [(2,), (3,)]


def test_curriculum_is_stable_and_respects_readiness(spark):
    df = spark.createDataFrame([(i, "train", 10 + i, 5, i % 3 != 0) for i in range(60)], "pair_id bigint, split string, open_tokens bigint, closed_tokens bigint, closed_ready boolean")
    shares = {"OPEN": 0.5, "CLOSED": 0.2, "DUAL": 0.3}
    first, second = (rows(splits.assign_curriculum(df.repartition(n), "split", shares), "pair_id") for n in (1, 3))
    assert first == second and {a for i, _, a in first if i % 3 == 0} == {"OPEN"} and {a for *_, a in first} == set(shares)


def test_largest_remainder(spark):
    w = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "k string, w int")
    assert rows(splits.largest_remainder(w, "k", "w", 10), "k") == [("a", 4), ("b", 3), ("c", 3)]


@pytest.mark.parametrize(
    ("case", "expected"),
    [((True, 0, 0, 0, 9, False), "merge"), ((False, 0.8, 0.9, 0, 9, False), "review"), ((False, 0.8, 0.84, 0, 1, True), "review"), ((False, 0.6, 0.86, 0, 1, True), "merge"), ((False, 0.91, 0.61, 0, 1, False), "merge"), ((False, 0.81, 0.51, 0.61, 1, False), "merge"), ((False, 0.6, 0.3, 0, 1, False), "separate")],
)
def test_family_verdict(spark, case, expected):
    assert spark.range(1).select(families.verdict(*map(F.lit, case))[0]).first()[0] == expected


def test_unique_left_join_refuses_repeats(spark):
    left, right = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="twice"):
        joins.unique_left_join(left, right, ["k"]).collect()


def test_redirects(spark):
    got = rows(joins.resolve_redirects(spark.createDataFrame([(5, 4), (4, 3), (9, 3)], "retired int, target int")), "retired")
    assert got == [(4, 3), (5, 3), (9, 3)]
    with pytest.raises(ValueError, match="cycle"):
        joins.resolve_redirects(spark.createDataFrame([(1, 2), (2, 1)], "retired int, target int"))


def test_upsert_keeps_rows(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert rows(funnel.upsert(old, spark.createDataFrame([(2, None), (3, "x")], "k int, v string"), ["k"]), "k") == [(1, "a"), (2, None)]


def test_contract(spark):
    df = spark.createDataFrame([(1, ""), (1, "x")], "id int, t string")
    assert rows(funnel.contract(df, {"blank": F.col("t") == ""}, unique={"repeats": "id"}), "rule") == [("blank", 1), ("repeats", 1)]


@pytest.mark.parametrize(
    ("target", "evidence", "supported"),
    [("Lead reached 32 mg/l", "Lead reached 32 mg/l in wells", True), ("Lead reached 32 mg/l", "Lead reached 32.7 mg/l in wells", False), ("Yields increased in maize", "Yields decreased in maize", False), ("The method is not valid", "The method is valid", False)],
)
def test_support(target, evidence, supported):
    assert grounding.report(target, evidence).supported is supported


def test_router(spark):
    pairs = spark.createDataFrame([(1, 1, "lead in wells"), (1, 2, "lead in wells. cadmium in rivers."), (2, 3, "gold")], "paper_id bigint, pair_id bigint, target string")
    spans = spark.createDataFrame([(1, 1, 1, "lead in wells"), (1, 2, 2, "cadmium in rivers"), (2, 3, 1, "silver")], "paper_id bigint, span_id bigint, rank bigint, quote string")
    got = {r["pair_id"]: (r["route"], r["bundle"]) for r in grounding.route(pairs, spans).collect()}
    assert got[1] == ("OPEN_AS_IS", "1") and got[2] == ("OPEN_WIDENED", "1,2") and got[3][0] == "QUARANTINE"


def test_chunks_have_places():
    text = "<!-- PDF_PAGE: 2 -->\n# Methods\nWe went.\n\nThen we came back home.\n\n# References\n[1]"
    got = chunks.chunks_of(text, 40)
    assert all(text[a:b].strip() for *_, a, b in got) and got[-1][1:3] == (2, "Methods") and "[1]" not in text[got[-1][3] : got[-1][4]]


def test_merge_spans(spark):
    df = spark.createDataFrame([("a", 0, 5), ("a", 4, 9), ("a", 20, 22), ("b", 1, 2)], "k string, x int, y int")
    assert rows(sequences.merge_spans(df, "k", "x", "y"), "k", "x") == [("a", 0, 9), ("a", 20, 22), ("b", 1, 2)]


def test_disagreement(spark):
    data = [("s", "f", 1, 10.0, {"site": "a"}), ("s", "f", 2, 10.5, {"site": "a"}), ("s", "f", 3, 30.0, {"site": "b"})]
    got = compare.disagreement(spark.createDataFrame(data, "subject string, facet string, family int, value double, conditions map<string,string>")).first()
    assert (got["supporting"], got["conflicting"], got["families"], got["differing"]) == (2, 1, 3, "site")


def test_decisions(spark):
    f = lambda *a: spark.range(1).select(rules.decide(*map(F.lit, a))).first()[0]
    assert [f(True, "direct", 4, 4, 20), f(False, "direct", 2, 2, 14), f(False, "direct", 2, 1, 14), f(False, "latent", 1, 4, 15), f(False, "absent", 0, 4, 15)] == ["exclude", "include", "review", "review", "exclude"]


def test_classifier_metrics(spark):
    df = spark.createDataFrame([("include", "include"), ("exclude", "include"), ("exclude", "exclude")], "d string, g string")
    assert tuple(metrics.classifier(df, "d", "g").first()) == (3, 0.6667, 0.5, 1.0)


def test_relevance_without_rows(spark):
    empty = spark.createDataFrame([], "id int, t string")
    assert classify.relevance(empty, "id", F.col("t"), ["a"], ["b"], F.lit(False), F.lit(2)).count() == 0


M_SCHEMA = "mention_id int, name string, entity_type string, scope string, paper_id string, context_id string, qualifiers map<string,string>, safe boolean"
T_SCHEMA = "target_id string, target_kind string, label string, entity_type string, paper_id string, context_id string, qualifiers map<string,string>"


def test_every_arm_of_the_cascade(spark):
    mention = lambda i, name, kind="PLACE", scope="CANONICAL", paper="p1", context=None, safe=True, **q: (i, name, kind, scope, paper, context, q, safe)
    mentions = [
        mention(1, "anything", paper="p9"),  # a must-link
        mention(2, "anything else"),  # two must-links
        mention(3, "forbidden"),  # must and cannot
        mention(4, "gone"),  # a must-link to nowhere
        mention(5, "Lake Chad"),  # primary key
        mention(6, "tchad lake"),  # trusted alias
        mention(7, "some water"),  # authority id
        mention(8, "Lake Chad", country="NG"),  # contradicts the concept's qualifier
        mention(9, "Niger Delta region"),  # near a label, not near enough
        mention(10, "Okavango deltaa"),  # nearly a label
        mention(11, "new place", paper="p1"), mention(12, "New  place", paper="p2"), mention(13, "lone place"),
        mention(14, "blurred place", safe=False),
        mention(15, "site a", scope="STUDY_INSTANCE", context="c1"), mention(16, "site a", scope="STUDY_INSTANCE", context="c2"),
        mention(17, "twin"),  # two concepts of one name, of equal qualifiers
        mention(18, "rival"),  # two concepts of one name that contradict each other
        mention(19, "vector friend"),  # found by vectors alone
        mention(20, "xyz", kind="OTHER"),
        mention(21, "Lake Chad"),  # but must not be the lake
    ]
    concept = lambda i, label, kind="PLACE", **q: (i, "CONCEPT", label, kind, None, None, q)
    targets = [concept("C1", "Lake Chad", country="TD"), concept("C2", "Niger Delta"), concept("C3", "Okavango Delta"), concept("C4", "twin"), concept("C5", "twin"), concept("C6", "rival", state="A"), concept("C7", "rival", state="B"), concept("C8", "far away"), ("I1", "INSTANCE", "site a", "PLACE", "p1", "c1", {})]
    rules = [(1, "MUST_LINK", "C2"), (2, "MUST_LINK", "C2"), (2, "MUST_LINK", "C3"), (3, "MUST_LINK", "C2"), (3, "CANNOT_LINK", "C2"), (4, "MUST_LINK", "C99"), (21, "CANNOT_LINK", "C1")]
    got = resolve.resolve(
        spark.createDataFrame(mentions, M_SCHEMA),
        spark.createDataFrame(targets, T_SCHEMA),
        constraints=spark.createDataFrame(rules, "mention_id int, rule string, target_id string"),
        aliases=spark.createDataFrame([("PLACE", "Tchad Lake", "C1", "REVIEWED"), ("PLACE", "lone place", "C8", "MODEL")], "entity_type string, alias string, target_id string, trust string"),
        hints=spark.createDataFrame([(7, "GEO", "77")], "mention_id int, authority string, external_id string"),
        links=spark.createDataFrame([("GEO", "77", "C3")], "authority string, external_id string, target_id string"),
        vectors=spark.createDataFrame([(19, "C8", 99.0), (13, "C8", 20.0)], "mention_id int, target_id string, score double"),
    )
    got = {r["mention_id"]: (r["status"], r["method"], r["target"], r["reasons"]) for r in got.collect()}
    assert len(got) == len(mentions)
    assert got[1] == ("MATCHED", "HUMAN_OVERRIDE", "C2", "ACTIVE_HUMAN_MUST_LINK")
    assert [got[i][1:] for i in (2, 3, 4)] == [("HARD_CONFLICT", None, c) for c in ("CONFLICTING_MUST_LINKS", "CONFLICTING_MUST_AND_CANNOT_LINK", "MUST_LINK_TARGET_MISSING")]
    assert [got[i][1:3] for i in (5, 6, 7)] == [("NORMALIZED_PRIMARY", "C1"), ("TRUSTED_ALIAS", "C1"), ("EXACT_AUTHORITY_ID", "C3")]
    assert got[8][1] == "BOOTSTRAP" and got[8][3] == "ALL_CANDIDATES_BLOCKED" and got[9][1] == "BOOTSTRAP" and got[9][3] == "APPROXIMATE_CANDIDATES_REQUIRE_REVIEW"
    assert got[10][:2] == ("REVIEW", "BOOTSTRAP")  # 93.3 is below the bound
    assert got[11][:2] == got[12][:2] == ("PROPOSED", "BOOTSTRAP") and got[11][2] == got[12][2] and got[13][0] == "REVIEW" and got[13][3] == "NO_CANDIDATE"
    assert got[14][:2] == ("REVIEW_REQUIRED", "NO_SAFE_DECISION") and got[15][:3] == ("MATCHED", "NORMALIZED_PRIMARY", "I1") and got[16][2] != "I1"
    assert got[17][2:] == ("C4", "AUTO_MERGE_EXACT_DUPLICATE_CONCEPTS") and got[18] == ("REVIEW_REQUIRED", "HARD_CONFLICT", None, "AUTO_MERGE_IDENTITY_QUALIFIER_CONFLICT:state")
    assert got[19][1:3] == ("EMBEDDING_CALIBRATED", "C8") and got[20][0] == "REVIEW" and got[21][2] not in ("C1", None)


def test_conflicts_of_instances(spark):
    mentions = spark.createDataFrame([(1, "a", "X", "STUDY_INSTANCE", "p1", "c1", {"k": "1", "only": "z"}, True)], M_SCHEMA)
    targets = spark.createDataFrame([("I", "INSTANCE", "a", "Y", "p2", "c2", {"k": "2"}), ("C", "CONCEPT", "a", "X", None, None, {})], T_SCHEMA)
    pairs = spark.createDataFrame([(1, "I"), (1, "C")], "mention_id int, target_id string")
    got = {r["target_id"]: r["conflicts"] for r in resolve.judged(pairs, mentions, targets).collect()}
    assert got == {"I": ["CROSS_PAPER_INSTANCE", "ENTITY_TYPE_CONFLICT", "IDENTITY_QUALIFIER_CONFLICT:k", "INSTANCE_CONTEXT_CONFLICT"], "C": ["IDENTITY_SCOPE_CONFLICT"]}


def test_large_postings_ask_nothing(spark):
    targets = spark.createDataFrame([(f"T{i}", "CONCEPT", f"common {i}", "X", None, None, {}) for i in range(9)], T_SCHEMA)
    mentions = spark.createDataFrame([(1, "common 3", "X", "CANONICAL", "p", None, {}, True)], M_SCHEMA)
    found = resolve.lexical_pool(mentions, targets, most_postings=5).collect()
    assert [r["target_id"] for r in found] == ["T3"] and found[0]["token_hits"] == 1


def test_commits_are_made_once(spark):
    concepts = spark.createDataFrame([("C1", "lake", "X", "ACTIVE", None, 1)], "concept string, label string, entity_type string, state string, redirect string, version int")
    aliases = spark.createDataFrame([("C1", "the lake", "REVIEWED")], "concept string, alias string, trust string")
    mentions = spark.createDataFrame([(1, "Lake", "X"), (2, "big lake", "X"), (3, "pond", "X"), (4, "Pond", "X"), (5, "the lake", "X"), (6, "sea", "X")], "mention_id int, name string, entity_type string")
    decisions = spark.createDataFrame([(1, "MATCHED", "C1"), (2, "MATCHED", "C1"), (3, "PROPOSED", "NEW-1"), (4, "PROPOSED", "NEW-1"), (5, "MATCHED", "C1"), (6, "REVIEW", "NEW-2")], "mention_id int, status string, target string")
    after, names, events = registry.commit(concepts, aliases, mentions, decisions, 2)
    assert sorted(r["concept"] for r in after.collect()) == ["C1", "NEW-1"]
    assert sorted((r["event"], r["subject"], r["object"]) for r in events.collect()) == [("CREATE", "NEW-1", "Pond"), ("LEARN_ALIAS", "C1", "big lake")]
    again = registry.commit(after, names, mentions, decisions, 3)
    assert again[0].count() == 2 and again[2].count() == 0



def test_equal_names_are_scored_once(spark, monkeypatch):
    from pyspark.sql.types import DoubleType

    calls, score = spark.sparkContext.accumulator(0), F.udf(lambda a, b: calls.add(1) or 90.0, DoubleType())
    monkeypatch.setattr(resolve, "label_score", lambda a, b: score(a, b))
    mentions = spark.createDataFrame([(i, "Lake  Chad" if i % 2 else "lake chad", "X", "CANONICAL", "p", None, {}, True) for i in range(60)], M_SCHEMA)
    targets = spark.createDataFrame([(f"T{i}", "CONCEPT", f"lake {i}", "X", None, None, {}) for i in range(3)], T_SCHEMA)
    got = {tuple(r) for r in resolve.lexical_candidates(mentions, targets, k=2).collect()}
    assert got == {(i, f"T{r}", 90.0, r + 1) for i in range(60) for r in range(2)} and calls.value <= 9  # three, but for retries and plans made anew


def test_buckets_of_hot_words_are_skipped(spark, monkeypatch):
    rng, total = random.Random(3), 400
    monkeypatch.setattr(families, "HOT", 8)
    titles = [" ".join(["hot", f"rare{rng.randrange(150)}", f"some{rng.randrange(12)}"]) for _ in range(total)]
    words = [{w for w in t.split()} for t in titles]
    sizes = {w: sum(w in own for own in words) for w in set().union(*words)}
    same = lambda i, j: any(2 <= sizes[w] <= families.RARE_MAX for w in words[i] & words[j]) or (words[i] == words[j] and 2 <= words.count(words[i]) <= families.BUCKET_MAX)
    papers = spark.createDataFrame(list(enumerate(titles)), "k int, t string")
    pairs = families.block(papers, "k", "t")
    assert sorted(map(tuple, pairs.collect())) == [(i, j) for i in range(total) for j in range(i + 1, total) if same(i, j)]
    assert "LeftAnti" in pairs._jdf.queryExecution().toString()  # hot words go before rows are exchanged


@pytest.mark.parametrize(("chunk", "most"), [(1024, 4096), (3, 7)])
def test_pairs_of_a_block(spark, monkeypatch, chunk, most):
    monkeypatch.setattr(joins, "CHUNK", chunk)
    monkeypatch.setattr(joins, "BLOCK_ROWS", most)
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice([["x"], ["x", "y"], ["y"], None])) for i in range(60)] + [(7, "a", ["z"])]
    share = lambda u, v: None if u is None or v is None else len(set(u) & set(v)) / len(set(u) | set(v))
    expected = [(i, j, share(u, v)) for i, a, u in rows for j, b, v in rows if i < j and a == b and a is not None]
    got = joins.pairs_within(spark.createDataFrame(rows, "k int, b string, w array<string>"), ["b"], "k", "w", metrics.overlap_share, "s")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))
