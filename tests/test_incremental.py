"""The incremental release: restarts, repeated batches, and empty drops."""

import pytest
from pyspark.sql import functions as F

from evidlake.streaming.incremental import Release

SCHEMA = "id long, k string, v string"


def drops(n):
    return [[(100 * d + i, f"k{(7 * i + 3 * d) % 40}", f"v{d}.{i}") for i in range(30)] for d in range(n)]


def first_wins(rows):
    out = {}
    for i, k, v in rows:
        out.setdefault(k, (i, v))
    return out


def test_runs_with_restarts_release_what_one_run_does(spark, tmp_path):
    parts = [*drops(4), [(999, None, "null key")], [(1000, None, "again")]]
    for d, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        release = Release(spark, f"{tmp_path}/out", ["k"], ["id"], buckets=8)  # a new object each time, as after a restart
        assert release.run(f"{tmp_path}/in", SCHEMA) == 1
        assert release.run(f"{tmp_path}/in", SCHEMA) == 0  # nothing has arrived
        assert release.committed() >= d
    got = {r["k"]: (r["id"], r["v"]) for r in Release(spark, f"{tmp_path}/out", ["k"], ["id"]).rows().collect()}
    assert got == first_wins([r for part in parts for r in part]) and got[None] == (999, "null key")
    whole = Release(spark, f"{tmp_path}/whole", ["k"], ["id"])
    whole.run(f"{tmp_path}/in", SCHEMA)
    assert {r["k"]: (r["id"], r["v"]) for r in whole.rows().collect()} == got
    assert whole.rows().count() == len(got)


def test_a_batch_that_fails_half_way_is_released_once(spark, tmp_path):
    parts = drops(3)
    release = Release(spark, f"{tmp_path}/out", ["k"], ["id"], buckets=4)
    spark.createDataFrame(parts[0], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    release.run(f"{tmp_path}/in", SCHEMA)
    spark.createDataFrame(parts[1], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    class Broken(Release):
        def accept(self, batch, number):
            super().accept(batch, number)
            raise RuntimeError("the driver is lost before the batch is committed")

    with pytest.raises(Exception, match="driver is lost"):
        Broken(spark, f"{tmp_path}/out", ["k"], ["id"], buckets=4).run(f"{tmp_path}/in", SCHEMA)
    assert {r["v"].split(".")[0] for r in release.rows().collect()} == {"v0"}  # what is not committed is not read
    spark.createDataFrame(parts[2], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    release.run(f"{tmp_path}/in", SCHEMA)
    got = release.rows().groupBy("k").agg(F.count("*").alias("n"), F.first("v").alias("v")).collect()
    assert all(r["n"] == 1 for r in got)
    assert {r["k"] for r in got} == {k for part in parts for _, k, _ in part}
    want = first_wins(parts[0])
    assert all(r["v"] == want[r["k"]][1] for r in got if r["k"] in want)


def test_files_in_several_batches(spark, tmp_path):
    rows = [r for part in drops(5) for r in part]
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/in")
    release = Release(spark, f"{tmp_path}/out", ["k"], ["id"])
    assert release.run(f"{tmp_path}/in", SCHEMA, files=2) == 3
    assert sorted(r["k"] for r in release.rows().collect()) == sorted({k for _, k, _ in rows})
