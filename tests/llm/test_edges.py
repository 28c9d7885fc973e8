"""Repeated rows, null ids and very long inputs of operators whose other cases are tested beside them."""

import random

from tracefoundry.llm import lines, quality, urls

from .cases import DOCS, documents, frame, prose


def test_classifier_judges_repeats_alike(spark):
    """Rows repeated whole, and rows of one text without a doc_id, get one decision each, and every row gets one.

    Scores are compared to three decimals: running sums over a batch round by a row's place in it.
    """
    rng = random.Random(2)
    text = prose(rng, 60) + "."
    rows = [*documents(3, 20), *[(5000, text, "en", "s", 1, True, "k", 1)] * 5, *[(None, text, "en", "s", 1, True, "k", 1)] * 3]
    got = [(r[0], r[1], round(r[2], 3), r[3]) for r in quality.classify(frame(spark, rows)).select("doc_id", "weak_label", "score", "kept").collect()]
    assert len(got) == len(rows)
    assert len({r for r in got if r[0] == 5000}) == 1 and sum(r[0] == 5000 for r in got) == 5
    assert sum(r[0] is None for r in got) == 4 and len({r for r in got if r[0] is None}) <= 2


def test_lines_of_repeated_rows(spark):
    """Rows repeated whole say the same of each line; the first line of the smallest id stays."""
    text = "a line that is long enough to have shingles\nanother line with other words in it\n"
    rows = [(3, text), (3, text), (3, text), (9, text), (9, "own line of the second text that stands alone")]
    got = lines.fuzzy_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 4 * 3 + 1
    assert len({tuple(r) for r in got if r["doc_id"] == 3}) == 3
    assert {(r["first_doc_id"], r["first_line_no"]) for r in got if r["doc_id"] == 9 and r["line_no"] == 1 and not r["kept"]} == {(3, 1)}


def test_very_long_urls(spark):
    """A path of 200,000 characters and a host of 500 labels are judged like others."""
    host = ".".join(["a"] * 500) + ".example.org"
    rows = [(1, f"https://{host}/es/" + "x/" * 100_000), (2, f"http://{host.upper()}/en/2"), (3, "http://x.fr/" + "y" * 200_000 + "?q#f")]
    got = {r["page_id"]: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert [(got[i]["rule"], got[i]["verdict"]) for i in (1, 2, 3)] == [("example.org/es/", "block"), ("org/", "allow"), (None, "allow")]
    assert got[1]["host"] == host and len(got[1]["path"]) == 200_004 and len(got[3]["path"]) == 200_001


def test_schemas_of_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert quality.classify(empty).count() == 0 and lines.fuzzy_lines(empty).count() == 0
