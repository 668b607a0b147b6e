"""Citation audits of single papers."""

import pytest

from spanloom.operators import citations

SCHEMA = "paper_id int, openalex_id string, title string, authors array<string>, year int, page string"


def audited(spark, authors, year, page):
    return citations.audit(spark.createDataFrame([(1, "W1", "On rivers", authors, year, page)], SCHEMA)).first()


@pytest.mark.parametrize(
    ("authors", "year", "page", "expected"),
    [
        (["Ada Obi", "Bo Eze"], 2001, "# On rivers\nAda Obi and Bo Eze\nPublished 2001", ("VERIFIED", "VERIFIED", "VERIFIED", "Obi & Eze, 2001", "OPENALEX+DOCUMENT")),
        (["Ada Obi", "Bo Eze"], 2001, "# On rivers\nBo Eze, Ada Obi\nPublished 2001", ("CORRECTED", "VERIFIED", "CORRECTED", "Eze & Obi, 2001", "OPENALEX+DOCUMENT_CORRECTION")),
        (["Áda Óbi"], 2001, "# On rivers\nby ada obi\nVol. 3, 2002", ("VERIFIED", "CORRECTED", "CORRECTED", "Óbi, 2002", "OPENALEX+DOCUMENT_CORRECTION")),
        (["Ada Obi"], 2001, "# On rivers\n## Jane Doe\nPublished 2001", ("CONFLICT", "VERIFIED", "CONFLICT", "Obi, 2001", "OPENALEX+DOCUMENT")),
        (["Ada Obi"], 2001, "# On rivers\nnobody\nPublished 1999\n© 2001", ("METADATA_ONLY", "CONFLICT", "CONFLICT", "Obi, 2001", "OPENALEX")),
        ([], None, "# On rivers\n**Jane Doe**\nPublished 1999", ("CORRECTED", "CORRECTED", "CORRECTED", "Doe, 1999", "OPENALEX+DOCUMENT_CORRECTION")),
        ([], 2001, "", ("INVALID", "METADATA_ONLY", "INVALID", "On rivers", "FALLBACK")),
        (["Ada Obi"], None, None, ("METADATA_ONLY", "INVALID", "INVALID", "On rivers", "FALLBACK")),
        (["Ada Obi"], 2001, "# On rivers\nx\nAbstract\nAda Obi wrote in 2005", ("METADATA_ONLY", "METADATA_ONLY", "METADATA_ONLY", "Obi, 2001", "OPENALEX")),
    ],
)
def test_audits(spark, authors, year, page, expected):
    r = audited(spark, authors, year, page)
    assert (r["author_status"], r["year_status"], r["citation_status"], r["citation_label"], r["metadata_source"]) == expected
    assert tuple(r.asDict()) == citations.COLUMNS and len(r) == 24


def test_collisions_are_counted(spark):
    rows = [(i, f"W{i}", "t", ["Ada Obi"], 2001, None) for i in range(3)] + [(9, "W9", "t", ["Bo Eze"], 2001, None)]
    got = citations.audit(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["paper_id"]: r["collision_count"] for r in got} == {0: 3, 1: 3, 2: 3, 9: 1}
