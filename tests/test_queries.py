"""Every query of the engine against its SQL."""

import pytest

from conftest import DATA
from tidemark.plans import registry


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, same_as_sql, name):
    df = registry.queries()[name](spark, DATA)
    same_as_sql(df, registry.oracle_sql()[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_null_or_default_judges_every_event(spark):
    rows = {r["event_id"]: r for r in registry.queries()["null_default_every_text"](spark, DATA).collect()}
    events = spark.read.parquet(f"{DATA}/events.parquet").select("event_id", "user_id").collect()
    assert len(rows) == len(events)
    for e in events:
        kind = e["event_id"] % 16
        number = {0: e["event_id"], 1: e["event_id"], 6: -e["user_id"], 13: 1}.get(kind, 0)
        assert (rows[e["event_id"]]["nullable"], rows[e["event_id"]]["filled"]) == (None if kind == 15 else number, number)
