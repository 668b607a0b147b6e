"""Citation metadata: the document's own author and year against the manifest's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import byline_region, citation_label, first_page
from spanloom.functions.unicode import family_name, family_names, unaccented

# Statuses; what lines say where a document states its year, with their weights, and the least weight.
VERIFIED, METADATA, CORRECTED, CONFLICT, INVALID = "VERIFIED", "METADATA_ONLY", "CORRECTED", "CONFLICT", "INVALID"
YEAR_SIGNALS = {"how to cite|cite this|citation": 7, "published|publication date": 6, "copyright|©": 6, r"\bvol(ume)?\b|\bissue\b|\bno\.\s*[0-9]+": 4}
YEAR_FLOOR, LONGEST_LINE, EVIDENCE = 4, 800, 500
FIRST_YEAR = 1800
AUDIT_VERSION = "1"


def folded(c: Column) -> Column:
    """Lower case without marks; what is no letter or digit is one space."""
    return F.trim(F.regexp_replace(F.lower(unaccented(c)), "[^a-z0-9]+", " "))


def document_author(region: Column, families: Column) -> Column:
    """(family, evidence, relation) of the family name that stands first in a byline.

    region: the byline, folded line by line; families: folded names in the manifest's order. The relation is MATCH for
    the first of them, ORDER_CORRECTED for another, NONE where none stands there.
    """
    at = F.transform(families, lambda f, i: F.struct(F.regexp_instr(region, F.concat(F.lit("(?<![a-z0-9])"), f, F.lit("(?![a-z0-9])"))).alias("at"), i.alias("i"), f.alias("family")))
    found = F.filter(at, lambda x: (x["family"] != "") & (x["at"] > 0))
    first = F.array_min(found)
    relation = F.when(F.size(found) == 0, "NONE").when(first["i"] == 0, "MATCH").otherwise("ORDER_CORRECTED")
    return F.struct(F.when(F.size(found) > 0, first["i"]).alias("place"), F.coalesce(relation, F.lit("NONE")).alias("relation"))


def unrelated_author(region: Column) -> Column:
    """the name on a line of the byline that is set apart as one, by a heading, emphasis or "By"."""
    lines = F.filter(F.split(region, "\n"), lambda x: F.rlike(F.trim(x), F.lit(r"(?i)^(#{2,6}\s+|\*{1,2}\s*|by\s+)")))
    bare = F.transform(lines, lambda x: F.trim(F.regexp_replace(F.trim(x), r"(?i)^(#{1,6}\s*|\*+\s*|by\s+)", "")))
    alone = F.transform(bare, lambda x: F.trim(F.regexp_extract(x, r"(?i)^(.*?)(;|\band\b|&|,|\*|$)", 1)))
    names = F.filter(alone, lambda x: F.rlike(x, F.lit(r"^\p{Lu}[\p{L}.'-]*( \p{Lu}[\p{L}.'-]*){1,4}$")))
    return F.try_element_at(names, F.lit(1))


def year_candidates(page: Column, now: int) -> Column:
    """(score, year, evidence) of the years on lines that say when a document was published, best first."""
    lines = F.filter(F.transform(F.split(page, "\n"), lambda x: F.trim(F.regexp_replace(x, r"[*_#`\s]+", " "))), lambda x: F.length(x).between(1, LONGEST_LINE))
    weight = lambda x: sum((F.when(F.rlike(F.lower(x), F.lit(p)), n).otherwise(0) for p, n in YEAR_SIGNALS.items()), F.lit(0))
    weighed = F.filter(F.transform(lines, lambda x: F.struct(weight(x).alias("w"), x.alias("line"))), lambda x: x["w"] >= YEAR_FLOOR)
    years = F.transform(weighed, lambda x: F.transform(F.regexp_extract_all(x["line"], F.lit(r"(?<![0-9])((?:18|19|20)[0-9]{2})(?![0-9])"), 1), lambda y: F.struct((-x["w"]).alias("score"), y.cast("int").alias("year"), F.left(x["line"], F.lit(EVIDENCE)).alias("evidence"))))
    return F.array_sort(F.filter(F.flatten(years), lambda x: x["year"].between(FIRST_YEAR, now + 1)))


def document_year(pages: DataFrame, key: str, page: str, now: int = 2026) -> DataFrame:
    """(key, year): the year whose lines signal publication best; a tie of different years gives none."""
    found = pages.select(key, year_candidates(F.col(page), now).alias("c"))
    tops = F.array_distinct(F.transform(F.filter("c", lambda x: x["score"] == F.col("c")[0]["score"]), lambda x: x["year"]))
    return found.select(key, F.when((F.size("c") > 0) & (F.size(tops) == 1), tops[0]).alias("year"))


def component(given: Column, own: Column, unrelated: Column, ambiguous: Column) -> tuple[Column, Column]:
    """(the value to cite, its status) of a manifest's value and the document's own; null is missing."""
    have, held = given.isNotNull(), own.isNotNull()
    same = F.lower(given.cast("string")) == F.lower(own.cast("string"))
    status = F.when(ambiguous, F.when(have, CONFLICT).otherwise(INVALID)).when(held, F.when(~have, CORRECTED).when(same, VERIFIED).when(unrelated, CONFLICT).otherwise(CORRECTED)).when(have, METADATA).otherwise(INVALID)
    return F.when(status == CORRECTED, own).otherwise(given), status


def overall(author: Column, year: Column, fallback: Column) -> Column:
    """the status of a citation of its two parts."""
    either = lambda s: (author == s) | (year == s)
    return F.when(either(CONFLICT), CONFLICT).when(either(CORRECTED), CORRECTED).when((author == VERIFIED) & (year == VERIFIED), VERIFIED).when(fallback & either(INVALID), INVALID).otherwise(METADATA)


def audit(papers: DataFrame, now: int = 2026) -> DataFrame:
    """The 24 columns of a citation audit.

    papers: paper_id, openalex_id, title, authors array<string>, year, page (the first one, or more). Everything about
    a paper is computed in its row; only citations that collide are counted over all papers.
    """
    region = byline_region(first_page(F.col("page")))
    rows = papers.withColumns({"families": family_names(F.col("authors")), "region": region, "candidates": year_candidates(first_page(F.col("page")), now)})
    rows = rows.withColumns({"folded": F.lower(unaccented(F.col("region"))), "keys": F.split(F.lower(unaccented(F.array_join("families", "\n"))), "\n")})
    rows = rows.withColumn("found", document_author(F.col("folded"), F.col("keys")))
    other = F.when(F.col("found.relation") == "NONE", family_name(unrelated_author(F.col("region"))))
    rows = rows.withColumns({"own": F.coalesce(F.try_element_at("families", F.col("found.place") + 1), other), "first": F.nullif(F.try_element_at("families", F.lit(1)), F.lit(""))})
    best = F.filter("candidates", lambda x: x["score"] == F.col("candidates")[0]["score"])
    years = F.array_distinct(F.transform(best, lambda x: x["year"]))
    rows = rows.withColumns({"ambiguous": F.size(years) > 1, "own_year": F.when(F.size(years) == 1, years[0]), "year_lines": F.array_join(F.array_distinct(F.transform(best, lambda x: x["evidence"])), " | ")})
    author, author_status = component(F.col("first"), F.col("own"), F.col("found.relation") == "NONE", F.lit(False))
    year, year_status = component(F.col("year"), F.col("own_year"), F.lit(False), F.col("ambiguous"))
    rows = rows.withColumns({"author_status": author_status, "year_status": year_status, "cited": author, "cited_year": year})
    rows = rows.withColumn("fallback", F.col("cited").isNull() | F.col("cited_year").isNull())
    names = lambda c: F.when(c.isNotNull(), F.concat(F.array(c), F.slice(F.filter("families", lambda f: f != c), 1, 1 << 20))).otherwise(F.array().cast("array<string>"))
    label = citation_label(names(F.col("cited")), F.col("cited_year"))
    sure = F.when(F.col("fallback"), "FALLBACK").when((F.col("author_status") == CORRECTED) | (F.col("year_status") == CORRECTED), "OPENALEX+DOCUMENT_CORRECTION").when((F.col("author_status") == VERIFIED) | (F.col("year_status") == VERIFIED), "OPENALEX+DOCUMENT").otherwise("OPENALEX")
    line = F.try_element_at(F.filter(F.split("region", "\n"), lambda x: F.contains(F.lower(x), F.lower(F.col("own")))), F.lit(1))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    out = rows.select(
        "paper_id", "openalex_id", "title", F.to_json("authors").alias("raw_authors_json"), text(F.try_element_at("authors", F.lit(1))).alias("openalex_first_author"), text(F.col("first")).alias("openalex_first_author_family"),
        text(F.col("year")).alias("openalex_year"), text(citation_label(names(F.col("first")), F.col("year"))).alias("openalex_label"), text(F.col("own")).alias("document_first_author_family"), text(F.col("own_year")).alias("document_year"),
        "author_status", "year_status", overall(F.col("author_status"), F.col("year_status"), F.col("fallback")).alias("citation_status"), F.when(F.col("fallback"), F.left("title", F.lit(60))).otherwise(label).alias("citation_label"),
        F.concat(F.lit("("), text(label), F.lit(")")).alias("citation_parenthetical"), sure.alias("metadata_source"), text(F.left(F.trim(line), F.lit(EVIDENCE))).alias("author_evidence"), text(F.col("year_lines")).alias("year_evidence"),
        F.to_json("candidates").alias("document_year_candidates_json"), F.concat_ws("|", F.lower(text(F.col("cited"))), text(F.col("cited_year"))).alias("collision_key"), F.col("fallback").alias("fallback_used"), F.lit("FIRST_PAGE").alias("audit_mode"), F.lit(AUDIT_VERSION).alias("audit_version"),
    )
    counts = out.groupBy("collision_key").agg(F.count("*").alias("collision_count"))
    return out.join(counts, "collision_key").select(*COLUMNS)


COLUMNS = (
    "paper_id", "openalex_id", "title", "raw_authors_json", "openalex_first_author", "openalex_first_author_family", "openalex_year", "openalex_label", "document_first_author_family", "document_year", "author_status", "year_status",
    "citation_status", "citation_label", "citation_parenthetical", "metadata_source", "author_evidence", "year_evidence", "document_year_candidates_json", "collision_key", "collision_count", "fallback_used", "audit_mode", "audit_version",
)
