"""Tables that change in one step: runs that end at any moment lose and double nothing."""

import glob
import os
import subprocess
import sys
import textwrap
from collections import Counter
from datetime import date
from pathlib import Path

import pytest
from lodestream.operators import incremental
from lodestream.session import configured
from lodestream.sources import sinks
from lodestream.sources.published import STEPS, Published, directory_key, key_values, measured
from pyspark.sql import functions as F

from test_operators import batch


class Killed(Exception):
    pass


def dies_at(step):
    def hear(now):
        if now == step:
            raise Killed(step)

    return hear


def rows_of(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


@pytest.mark.parametrize("step", STEPS)
def test_a_batch_that_ends_anywhere_is_whole_after_a_retry(spark, tmp_path, step):
    configured(spark)
    path, plain = str(tmp_path / "raw"), str(tmp_path / "plain")
    for p in (path, plain):
        sinks.write_batch(batch(spark, 100), p)
    old = rows_of(sinks.read_table(spark, path))
    sinks.write_batch(batch(spark, 60, 70, shift=1), plain)
    new = rows_of(sinks.read_table(spark, plain))
    for _ in range(2):
        with pytest.raises(Killed):
            sinks.write_batch(batch(spark, 60, 70, shift=1), path, on_step=dies_at(step))
        # What a reader sees is the table before or after, never between.
        assert rows_of(sinks.read_table(spark, path)) == (new if step == "remove" else old)
        if step == "remove":
            break
    if step in ("measure", "point"):
        # Half of what the dead run had written never arrived.
        live = set(sinks.raw_table(spark, path).files())
        junk = [f for f in glob.glob(f"{path}/*/*/*/*.parquet") if os.path.relpath(f, path) not in live]
        assert junk
        os.remove(junk[0])
    sinks.write_batch(batch(spark, 60, 70, shift=1), path)
    assert rows_of(sinks.read_table(spark, path)) == new
    # Nothing of the dead runs is left: the bare folder holds the same rows.
    assert rows_of(spark.read.parquet(path).select(sinks.read_table(spark, path).columns)) == new


@pytest.mark.parametrize("by", ["day", None])
@pytest.mark.parametrize("step", STEPS)
def test_a_load_that_ends_anywhere_is_whole_after_a_retry(spark, tmp_path, step, by):
    path, days = str(tmp_path / "fct"), [date(2025, 1, d) for d in (1, 2, 3)]
    row = lambda *xs: spark.createDataFrame(xs, "k string, day date, v int")
    incremental.load(spark, path, lambda t: row(("a", days[0], 1), ("b", days[1], 1), ("c", days[2], 1), ("n", None, 1)), "k", "full", partition_by=by)
    late = lambda t: row(("a", days[1], 2), ("d", days[1], 2), ("n", days[0], 2))
    with pytest.raises(Killed):
        incremental.load(spark, path, late, "k", partition_by=by, on_step=dies_at(step))
    out = incremental.load(spark, path, late, "k", partition_by=by)
    assert sorted(map(tuple, out.select("k", "day", "v").collect())) == [("a", days[1], 2), ("b", days[1], 1), ("c", days[2], 1), ("d", days[1], 2), ("n", days[0], 2)]
    assert spark.read.parquet(path).count() == 5


def test_a_process_that_is_killed_leaves_the_old_table(spark, tmp_path):
    configured(spark)
    path = str(tmp_path / "raw")
    sinks.write_batch(batch(spark, 80), path)
    old = rows_of(sinks.read_table(spark, path))
    code = f"""
        import os, sys
        sys.path[:0] = [{str(Path(__file__).parents[1])!r}, {str(Path(__file__).parent)!r}]
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        from lodestream.sources import sinks
        from test_operators import batch
        sinks.write_batch(batch(spark, 40, 60, shift=1), {path!r}, on_step=lambda s: s == "point" and os.kill(os.getpid(), 9))
    """
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "pyspark-shell"}
    assert subprocess.run([sys.executable, "-c", textwrap.dedent(code)], env=env, timeout=180, capture_output=True).returncode == -9
    assert rows_of(sinks.read_table(spark, path)) == old
    sinks.write_batch(batch(spark, 40, 60, shift=1), path)
    assert sinks.read_table(spark, path).count() == 100 and spark.read.parquet(path).count() == 100


def test_readers_that_began_earlier_keep_their_files(spark, tmp_path):
    configured(spark)
    path = str(tmp_path / "raw")
    sinks.write_batch(batch(spark, 50), path, keep=1)
    reader = sinks.read_table(spark, path)
    sinks.write_batch(batch(spark, 50, shift=1), path, keep=1)
    assert reader.filter("v = 37").count() == 1 and sinks.read_table(spark, path).filter("v = 38").count() == 1
    sinks.write_batch(batch(spark, 50, shift=2), path)
    assert sinks.read_table(spark, path).count() == spark.read.parquet(path).count() == 50


def test_a_batch_opens_its_own_directories_only(spark, tmp_path):
    configured(spark)
    path = str(tmp_path / "raw")
    sinks.write_batch(batch(spark, 300), path)
    table = sinks.raw_table(spark, path)
    first = {k for k in map(directory_key, (f.rpartition("/")[0] for f in table.files())) if k[0] == "2025-03-01"}
    assert len(first) == 3 and table.read(first).count() == 60
    assert len(table.read(first).inputFiles()) == 3 and len(table.read().inputFiles()) == 6


def test_fingerprints_are_kept_with_the_table(spark, tmp_path):
    """Stored equals recomputed after overlapping batches, also when the table gets a column and a wider type; a changed file is found."""
    configured(spark)
    path = str(tmp_path / "raw")
    sinks.write_batch(batch(spark, 200), path)
    sinks.write_batch(batch(spark, 100, 150, shift=2).withColumn("v", F.col("v").cast("long") + (1 << 40)).withColumn("channel", F.lit("web")), path)
    sinks.write_batch(batch(spark, 20, shift=5), path)
    table = sinks.raw_table(spark, path)
    now = measured(table.read(), sinks.LAYOUT).withColumn("fingerprint", F.col("fingerprint").cast("string"))
    assert rows_of(table.stored().drop("files")) == rows_of(now) and table.unproven().count() == 0
    assert sum(r["rows"] for r in table.stored().collect()) == 250
    victim = next(f for f in table.files() if f.startswith("_ingested_date=2025-03-02"))
    other = next(f for f in table.files() if f.startswith("_ingested_date=2025-03-01"))
    os.remove(f"{path}/{victim}")
    Path(f"{path}/{victim}").write_bytes(Path(f"{path}/{other}").read_bytes())
    for crc in Path(path).rglob(".*.crc"):
        crc.unlink()
    assert table.unproven().count() == 1
    assert table.unproven({directory_key(other.rpartition("/")[0])}).count() == 0


def test_rows_outside_the_touched_directories_are_an_error(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"), ["k"])
    df = spark.createDataFrame([("a/b=c", 1), (None, 2)], "k string, v int")
    with pytest.raises(ValueError):
        table.replace(df, {(None,)})
    # What the run wrote is no row of the table, though it was the first.
    table = Published(spark, str(tmp_path / "t"), ["k"])
    assert table.exists and not table.stored().count() and not table.read().count()
    table.replace(df, key_values(df, ["k"]))
    assert sorted(map(tuple, table.read().select("k", "v").collect()), key=repr) == [("a/b=c", 1), (None, 2)]
    table.replace(df.limit(0), {("a/b=c",)})
    assert [tuple(r) for r in table.read().select("k", "v").collect()] == [(None, 2)]
    table.drop(lambda key: True)
    assert table.read().count() == 0 and table.read().columns == ["v", "k"]


def test_a_folder_without_a_manifest_is_a_table(spark, tmp_path):
    configured(spark)
    path = str(tmp_path / "raw")
    sinks.placed(batch(spark, 50)).write.partitionBy(*sinks.LAYOUT).parquet(path)
    sinks.write_batch(batch(spark, 50, 25, shift=1), path)
    assert sinks.read_table(spark, path).count() == 75 and spark.read.parquet(path).count() == 75


def test_a_batch_is_shuffled_once(spark, tmp_path, monkeypatch):
    """Copies of an offset and rows of a directory meet in one shuffle: the rows that are written come out of a single exchange."""
    configured(spark)
    path, plans, replace = str(tmp_path / "raw"), [], Published.replace

    def heard(self, rows, *args, **kwargs):
        plans.append(rows._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0].count("Exchange "))
        return replace(self, rows, *args, **kwargs)

    monkeypatch.setattr(Published, "replace", heard)
    sinks.write_batch(batch(spark, 300), path)
    sinks.write_batch(batch(spark, 300, shift=1), path)
    assert plans == [1, 1]
    table = sinks.raw_table(spark, path)
    assert sinks.read_table(spark, path).count() == 300 and all(len(x) == 1 for x in [table.files({k}) for k in map(directory_key, (f.rpartition("/")[0] for f in table.files()))])


def test_distinct_offsets_are_counted_without_shuffling_rows(spark):
    from lodestream.plans.ingest_queries import _counted

    rows = spark.createDataFrame([(p, o) for p in (0, 1) for o in (0, 5, 5, 32_767, 32_768, 99_999)], "_kafka_partition int, _kafka_offset long")
    out = _counted(rows, "write", "now")
    assert [tuple(r) for r in out.collect()] == [("write", "now", 12, 10, 2 * (5 + 5 + 32_767 + 32_768 + 99_999))]
    assert "distinct" not in out._jdf.queryExecution().executedPlan().toString().lower().replace("n_distinct", "")


def test_a_table_of_many_files_is_opened_by_few_tasks(spark, tmp_path):
    """Tasks that look up files do not grow with their number."""
    configured(spark)
    table = Published(spark, str(tmp_path / "t"), ["k"])
    table.replace(spark.range(80).select("id", F.col("id").alias("k")).coalesce(1), None)
    sc = spark.sparkContext
    sc.setJobGroup("open", "open")
    try:
        assert len(table.read().inputFiles()) == 80
        jobs = sc.statusTracker().getJobIdsForGroup("open")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    assert sum(tracker.getStageInfo(s).numTasks for j in jobs for s in tracker.getJobInfo(j).stageIds) <= 32
