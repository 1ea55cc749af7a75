"""Splittable archives and tables against the files they were made from."""

import os
import random
import sqlite3
import tracemalloc
import zipfile

import pytest
from pyspark.sql import functions as F

from evidlake.sources import archives as A
from evidlake.sources import readers as I


def test_members_come_in_tasks_and_parts(spark, tmp_path):
    rng = random.Random(1)
    want = {}
    for a in range(3):
        os.makedirs(tmp_path / f"d{a}")
        with zipfile.ZipFile(tmp_path / f"d{a}" / f"x{a}.ZIP", "w", zipfile.ZIP_DEFLATED) as z:
            z.mkdir("folder")
            for k in range(20):
                body = rng.randbytes(rng.choice([0, 1, 999, 1000, 1001, 2000, 12_345]))
                z.writestr(f"folder/{k} é.bin", body)
                want[f"x{a}.ZIP", f"folder/{k} é.bin"] = body
    (tmp_path / "loose.txt").write_bytes(b"not an archive")
    got = A.zip_members(spark, str(tmp_path), task=8000, chunk=1000)
    assert got.rdd.getNumPartitions() > 6
    rows = got.select(F.element_at(F.split("archive", "/"), -1).alias("a"), "member", "part", "last", "content").collect()
    held = {}
    for r in sorted(rows, key=lambda r: (r["a"], r["member"], r["part"])):
        assert len(r["content"]) <= 1000
        held.setdefault((r["a"], r["member"]), []).append(r)
    assert {k: b"".join(bytes(r["content"]) for r in v) for k, v in held.items()} == want
    assert all([r["part"] for r in v] == list(range(len(v))) and [r["last"] for r in v] == [False] * (len(v) - 1) + [True] for v in held.values())
    assert A.zip_members(spark, str(tmp_path / "d0" / "x0.ZIP")).count() == 20
    os.makedirs(tmp_path / "none")
    assert A.zip_members(spark, str(tmp_path / "none")).count() == 0


def test_a_large_member_is_never_held_whole(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z, z.open("big", "w", force_zip64=True) as f:
        for _ in range(64):
            f.write(b"0" * (1 << 20))
    reader = A.ZipReader(str(tmp_path), A.TASK, 1 << 20)
    tracemalloc.start()
    total = sum(len(row[4]) for p in reader.partitions() for row in reader.read(p))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == 64 << 20 and peak < 16 << 20


def test_sqlite_ranges(spark, tmp_path):
    path = str(tmp_path / "x.db")
    with sqlite3.connect(path) as db:
        db.execute('CREATE TABLE "a ""b" (k INTEGER PRIMARY KEY, "v w" TEXT, n REAL)')
        db.executemany('INSERT INTO "a ""b" VALUES (?, ?, ?)', [(3 * i - 50, None if i % 7 == 0 else f"é{i}", i / 2) for i in range(1000)])
        db.execute("CREATE TABLE w (k TEXT PRIMARY KEY, v TEXT) WITHOUT ROWID")
        db.executemany("INSERT INTO w VALUES (?, ?)", [(f"k{i}", str(i)) for i in range(50)])
        db.execute("CREATE TABLE e (k TEXT)")
    got = A.sqlite_table(spark, path, 'a "b', rows=400)
    assert got.columns == ["k", "v w", "n"] and got.rdd.getNumPartitions() == 8
    assert sorted((int(r[0]), r[1], float(r[2])) for r in got.collect()) == [(3 * i - 50, None if i % 7 == 0 else f"é{i}", i / 2) for i in range(1000)]
    assert A.sqlite_table(spark, path, "w").count() == 50 and A.sqlite_table(spark, path, "e").count() == 0


def test_contents_replace_archives_by_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/x.txt", "inside")
    (tmp_path / "b.html").write_bytes(b"<p>b</p>")
    got = {r["path"].rsplit("/", 2)[-1] if "!" not in r["path"] else r["path"].split("/", 1)[1][-13:]: (r["kind"], bytes(r["content"])) for r in I.contents(spark, str(tmp_path)).collect()}
    assert sorted(v for v in got.values()) == [("markup", b"<p>b</p>"), ("other", b"inside")]


def test_discovery_is_one_plan(spark, tmp_path):
    """Many files with different headers, places of the key column, quotes and byte-order marks."""
    want = []
    for i in range(120):
        os.makedirs(tmp_path / f"s{i % 7}", exist_ok=True)
        key = ["row_id", "AMM", "Amm", "other", "Row_Id"][i % 5]
        cols = ["a", "b"]
        cols.insert(i % 3, key)
        with open(tmp_path / f"s{i % 7}" / f"f{i}.csv", "w", encoding="utf-8-sig" if i % 2 else "utf-8", newline="") as f:
            f.write(",".join(cols) + "\n")
            for k in range(3):
                row = [f'"x, {i}"', f"y{k}"]
                row.insert(i % 3, f'"v{i},{k}"' if k else f"v{i}")
                f.write(",".join(row) + "\n")
                if key != "other" and i % 7 != 3:
                    want.append((f"f{i}.csv", key.lower(), f"v{i},{k}" if k else f"v{i}"))
    (tmp_path / "s0" / "empty.csv").write_bytes(b"")
    got = I.discover(spark, str(tmp_path), skip=["s3"])
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 2


def test_xml_records_with_and_without_prefixes(spark, tmp_path):
    want = [(i, f"name {i} & é", i * 3) for i in range(3000)]
    for prefix in ("", "ns.1:"):
        folder = tmp_path / f"x{len(prefix)}"
        os.makedirs(folder)
        for k in range(3):
            body = "".join(f'<{prefix}rec id="{i}" x:note="a"><{prefix}name>name {i} &amp; é</{prefix}name>\n<{prefix}size>{n}</{prefix}size><{prefix}recs>x</{prefix}recs></{prefix}rec>' for i, _, n in want[k::3])
            (folder / f"{k}.xml").write_text(f'<?xml version="1.0"?><{prefix}all xmlns:x="u" xmlns:ns.1="v"><{prefix}records>{body}</{prefix}records></{prefix}all>', encoding="utf-8")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # records lie across the ends of splits
        try:
            got = I.xml_rows(spark, str(folder), "rec", "_id long, name string, size long")
            assert got.rdd.getNumPartitions() > 10
            assert sorted(map(tuple, got.collect())) == want
            assert I.xml_records(spark, str(folder), "rec", ["name 17 "]).count() == 1
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert I.xml_records(spark, str(folder), "missing").count() == 0
    (tmp_path / "x0" / "other.xml").write_text("<q:rec>1</q:rec>")
    with pytest.raises(ValueError, match="prefixes"):
        I.xml_records(spark, str(tmp_path / "x0"), "rec")
