import pytest

from spanloom.llm.queries import QUERIES
from tests import edges


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    make = lambda f: str(f(spark, tmp_path_factory.mktemp("llm_" + f.__name__)))
    return make(edges.emptied), make(edges.widened), make(edges.nulled)


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(spark, folders, name):
    assert QUERIES[name](spark, folders[0]).count() == 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_other_columns_do_not_matter(spark, folders, name):
    assert edges.rows(QUERIES[name](spark, folders[1])) == edges.rows(QUERIES[name](spark, edges.FROM))


@pytest.mark.parametrize("name", list(QUERIES))
def test_rows_of_nulls(spark, folders, name):
    got, plain = edges.rows(QUERIES[name](spark, folders[2])), edges.rows(QUERIES[name](spark, edges.FROM))
    extra = 2 if name in ("p8_ids", "p9_clean") else 0  # every document has a row there
    assert len(got) == len(plain) + extra
