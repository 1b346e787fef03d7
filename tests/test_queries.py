"""Every query that has SQL, beside it, on the smallest tables; every other one has to run."""

import pytest

import __spark_entry__ as entry
from oracle import compare
from skeinmill.sources.documents import parse_bibtex

DATA = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
CORE = {k: f for k, f in entry.queries().items() if "skeinmill.llm" not in f.__module__}


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, name):
    if name in SQL:
        compare(spark, DATA, CORE[name], SQL[name])
    else:
        rows = CORE[name](spark, DATA).collect()
        assert rows and VALUES[name]([r.asDict() for r in rows])


#: What must hold of the queries that SQL can't say.
VALUES = {
    "bibtex_render": lambda rows: all(len(parse_bibtex(r["entry"])) == 1 and parse_bibtex(r["entry"])[0]["citation_key"] == r["citation_key"] for r in rows),
}


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_names_match():
    assert set(SQL) <= set(entry.queries())
