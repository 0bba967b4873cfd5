"""Several writers at one registry: every commit is kept, numbers and versions are given once."""

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reviewlab.plans.experiment import Registry
from reviewlab.sources.commit_log import CommitLog

VALUES = {"accuracy": 0.5, "macro_f1": 0.5, "micro_f1": 0.5, "weighted_f1": 0.5, "macro_precision": 0.5, "macro_recall": 0.5,
          "settings": "{}", "started_at": None, "drift_share": None}


def test_two_writers_keep_all_runs_and_versions_are_unique(spark, tmp_path):
    def work(writer):
        registry = Registry(spark, str(tmp_path / "reg"))
        return [registry.add_run("e", f"run-{writer}-{i}", "M", {**VALUES, "macro_f1": 0.1 * writer + 0.01 * i}) for i in range(3)]
    with ThreadPoolExecutor(2) as pool:
        given = [v for r in pool.map(work, (1, 2)) for v in r]
    registry = Registry(spark, str(tmp_path / "reg"))
    assert sorted(given) == [1, 2, 3, 4, 5, 6]
    assert sorted(r["version"] for r in registry.versions().collect()) == sorted(given)
    runs = registry.runs().collect()
    assert sorted(r["start_seq"] for r in runs) == sorted(given) and len({r["run_id"] for r in runs}) == 6
    assert all(r["started_at"] is not None for r in runs)
    # the best of all writers' runs is promoted
    plan = registry.promote().first()
    assert plan["promoted"] and plan["best_run_id"] == "run-2-2"
    assert [tuple(r) for r in registry.aliases().collect()] == [("M", "Production", plan["version"])]
    assert registry.promote().first()["reason"] == "already at alias"


def test_an_overtaken_commit_is_built_again_on_what_the_other_wrote(spark, tmp_path):
    log, seen = CommitLog(spark, str(tmp_path)), []

    def build(state):
        seen.append(state.number)
        if len(seen) == 1:      # another writer commits between this one's read and its publication
            CommitLog(spark, str(tmp_path)).commit(lambda s: {"t": spark.range(1)})
        return {"t": spark.createDataFrame([(state.table("t", "id long").count() + 10,)], "id long")}
    assert log.commit(build) == 2 and seen == [0, 1]
    assert sorted(r["id"] for r in log.state().table("t", "id long").collect()) == [0, 11]
    assert len([p for p in (tmp_path / "t").iterdir()]) == 2          # the refused rows are gone
    assert not list((tmp_path / "log").glob(".draft-*"))


def test_unpublished_rows_are_not_read_and_tables_commit_together(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    assert log.state().number == 0 and log.state().table("t", "id long").count() == 0
    spark.range(5).write.parquet(str(tmp_path / "t" / "crashed"))     # a writer that ended before it published
    assert log.commit(lambda s: {}) == 0
    with pytest.raises(Exception):
        log.commit(lambda s: {"t": spark.range(2), "u": spark.range(1).select(F.raise_error(F.lit("stop")))})
    assert log.state().number == 0
    log.commit(lambda s: {"t": spark.range(2), "u": spark.range(3)})
    state = log.state()
    assert state.table("t", "id long").count() == 2 and state.table("u", "id long").count() == 3
    assert len(list(Path(tmp_path, "log").glob("0*"))) == 1


def test_a_writer_that_never_gets_through_says_so(spark, tmp_path):
    def build(state):
        CommitLog(spark, str(tmp_path)).commit(lambda s: {"t": spark.range(1)})
        return {"t": spark.range(1)}
    with pytest.raises(RuntimeError, match="overtaken"):
        CommitLog(spark, str(tmp_path)).commit(build, attempts=2)
