"""Every operator of the survey has a registered query."""

from tests import coverage
from tradeloom.catalog import REGISTRY


def test_coverage_file_is_the_generated_one():
    assert (coverage.ROOT / "COVERAGE.md").read_text() == coverage.text()


def test_every_survey_id_is_covered():
    wanted = set(coverage.survey_ids())
    assert len(wanted) > 120
    covered = {i for e in REGISTRY.values() for i in e.covers}
    assert wanted - covered == set()
    assert covered - wanted == set()


def test_entry_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert all(callable(q) for q in e.queries().values())


def test_read_only_statements_keep_whole_tables():
    for name, sql in ((n, e.sql) for n, e in REGISTRY.items() if e.sql):
        assert "TABLESAMPLE" not in sql.upper(), name
