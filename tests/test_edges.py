import pytest

from spanloom.plans import general, quotes
from tests import edges

#: Queries whose result is one row of counts, or a row per row of a table, over empty tables too.
COUNTS = {"run_statistics", "manifest_counts", "pr_f1", "seed_cap_effect"}
NAMES = [*general.QUERIES, *quotes.QUERIES]
BOTH = general.QUERIES | quotes.QUERIES


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    make = lambda f: str(f(spark, tmp_path_factory.mktemp(f.__name__)))
    return make(edges.emptied), make(edges.widened), make(edges.nulled)


@pytest.mark.parametrize("name", [n for n in NAMES if n not in ("stream_enrich", "stream_windows")])
def test_empty_tables(spark, folders, name):
    assert BOTH[name](spark, folders[0]).count() == (1 if name in COUNTS else 0)


@pytest.mark.parametrize("name", [*general.QUERIES, "quote_matches", "rewrite_segments", "ambiguity_pairs", "greedy_disjoint_spans", "chain_islands", "manifest_state", "lookup_with_default", "file_pattern_parse", "pending_work", "pr_f1"])
def test_other_columns_do_not_matter(spark, folders, name):
    assert edges.rows(BOTH[name](spark, folders[1])) == edges.rows(BOTH[name](spark, edges.FROM))


@pytest.mark.parametrize("name", [n for n in NAMES if n not in ("stream_enrich", "stream_windows")])
def test_rows_of_nulls(spark, folders, name):
    BOTH[name](spark, folders[2]).collect()


@pytest.mark.parametrize("name", ["p1_found", "p4_found", "p6_found", "p7_found"])
def test_rows_of_nulls_are_no_cases(spark, folders, name):
    assert edges.rows(BOTH[name](spark, folders[2])) == edges.rows(BOTH[name](spark, edges.FROM))
