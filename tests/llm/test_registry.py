import __spark_entry__ as entry
from silverlake.llm import registry


def test_every_operator_is_offered():
    """The entry leaves out what does not import, so here nothing may be missing."""
    numbers = {int(name[2:].split("_")[0]) for name in registry.QUERIES}
    assert numbers == set(range(1, 14))
    assert registry.QUERIES.items() <= entry.queries().items() and "pipeline" in entry.queries()
    assert registry.SQL.items() <= entry.oracle_sql().items()
