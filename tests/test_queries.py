import pytest

from contrail.plans import registry
from tests.compare import connect, same


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_like_sql(spark, sf_dir, name):
    same(registry.queries()[name](spark, sf_dir), connect(sf_dir), registry.oracle_sql()[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_training_data_operators(monkeypatch):
    import sys

    import __spark_entry__

    monkeypatch.setitem(sys.modules, "contrail.llm.queries", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert "flights" in __spark_entry__.queries() and not [k for k in __spark_entry__.queries() if k.startswith("op")]
