import __spark_entry__ as E
from stayline.config import STAYS
from stayline.plans.datasets import prepare
from stayline.sources.fixtures import stays

from conftest import SF0001


def test_entry_runs(spark):
    rows = {r["branch"]: r["rows"] for r in E.entry(spark).collect()}
    assert rows == {"inlier": 977, "outlier": 23}


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.oracle_sql()) >= 30


def test_prepare_families_and_state(spark):
    prep = prepare(stays(spark, SF0001), STAYS)
    counts = {(r["family"], r["split"]): r["count"] for r in prep.data.groupBy("family", "split").count().collect()}
    assert counts[("outlier", "train")] + counts[("outlier", "test")] == 23
    assert sum(v for (f, _), v in counts.items() if f == "nosplit") == 1000
    assert set(prep.encoder.global_mean) == {"inlier", "outlier", "class", "nosplit"}


def test_scan_is_pruned(spark, capsys):
    E.queries()["frailty_digits"](spark, SF0001).explain()
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,props:string>" in plan


def test_the_source_is_read_once(spark):
    prep = prepare(stays(spark, SF0001), STAYS, ("nosplit",))
    assert prep.data.inputFiles() and all("/cleaned-" in f for f in prep.data.inputFiles())
