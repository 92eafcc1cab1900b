"""Runs that replace a volume at once, skip what hasn't changed and log once; pages that are read by name."""

import json

import pytest
from pyspark.sql import functions as F

from quire.plans import volume
from quire.sources import commits, io

from test_sources import block, put


def files_of(root):
    return {p: p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def test_store(spark, tmp_path):
    store = commits.Store(spark, str(tmp_path))
    schema = "volume_slug string, x int"
    assert store.read("t", schema).collect() == [] and store.manifest().collect() == []

    def commit(rows, parts, digest):
        c = store.begin()
        store.write("t", c, spark.createDataFrame(rows, schema))
        unseen = sorted(map(tuple, store.read("t", schema).collect()))
        version = store.publish(c, spark.createDataFrame([(p, digest) for p in parts], "part string, digest string"))
        return unseen, version

    assert commit([("a b/c", 1), ("b", 2)], ["a b/c", "b"], "1") == ([], 1)
    assert commit([("b", 3), ("b", 4)], ["b"], "2") == ([("a b/c", 1), ("b", 2)], 2)
    assert sorted(map(tuple, store.read("t", schema).collect())) == [("a b/c", 1), ("b", 3), ("b", 4)]
    assert commit([], ["a b/c"], "3")[1] == 3  # a part without rows
    want = [("b", 3), ("b", 4)]
    assert sorted(map(tuple, store.read("t", schema).collect())) == want
    left = store.begin()
    store.write("t", left, spark.createDataFrame([("b", 9)], schema))  # a run that died
    assert sorted(map(tuple, store.read("t", schema).collect())) == want
    gone = store.vacuum()
    assert not any(left in p for p in gone) and len(list(tmp_path.glob("t/commit=*"))) == 3  # the dead run is young; the commit without rows is kept, as it is read
    assert any(left in p for p in store.vacuum(grace=-10)) and sorted(map(tuple, store.read("t", schema).collect())) == want
    assert [p.name for p in (tmp_path / "_manifest").iterdir()] == ["version=3"]


def test_two_runs_that_end_together(spark, tmp_path, monkeypatch):
    """A version that another run has taken is not replaced: both runs' parts are in the next one."""
    store = commits.Store(spark, str(tmp_path))
    parts = lambda p: spark.createDataFrame([(p, "d")], "part string, digest string")
    store.publish("c1", parts("a"))
    real, calls = commits.versions, []

    def late(*args):
        calls.append(args)
        if len(calls) == 1:
            found = real(*args)
            store.publish("c2", parts("b"))
            return found
        return real(*args)

    monkeypatch.setattr(commits, "versions", late)
    assert store.publish("c3", parts("c")) == 3
    assert {(r["part"], r["commit"]) for r in store.manifest().collect()} == {("a", "c1"), ("b", "c2"), ("c", "c3")}


def test_only_changed_volumes_are_run(spark, tmp_path, monkeypatch):
    def structure(raw, volumes, keep):
        rows = raw.select("volume_slug", "page_num", F.explode("blocks").alias("b")).select("volume_slug", "page_num", "b.text")
        arts = volumes.select("volume_slug", F.lit(1).alias("num"))
        return {"ordered": keep("ordered", rows), "articles": keep("articles", arts)}

    def documents(tables, volumes, as_of):
        return {"pagexml": tables["ordered"].groupBy("volume_slug", "page_num").agg(F.max("text").alias("content")).select(F.concat("volume_slug", F.format_string("/pagexml/page_%04d.xml", "page_num")).alias("path"), "content")}

    monkeypatch.setattr(volume, "structure", structure)
    monkeypatch.setattr(volume, "documents", documents)
    monkeypatch.setattr(volume.render, "crop_manifest", lambda df: df.select("volume_slug", "page_num"))
    for slug in ("vol-001-2000", "vol-002-2001"):
        for n in (1, 2):
            put(tmp_path, slug, n, [block(1, "section-header", "A Title"), block(2, "text", f"words of {n}", 200)])
    volumes = [io.Volume(volume_number=1, volume_year=2000), io.Volume(volume_number=2, volume_year=2001)]
    out = tmp_path / "tables"

    def go(date, force=False):
        return volume.run(spark, io.read_volumes(spark, str(tmp_path), volumes), io.volumes_table(spark, volumes), str(out), str(tmp_path / "files"), force, date)

    assert go("2024-01-01")
    store = commits.Store(spark, str(out))
    ordered = "volume_slug string, page_num int, text string"
    first = files_of(out)
    html = {p: (p.stat().st_mtime_ns, p.read_text()) for p in (tmp_path / "files").rglob("*") if p.is_file()}
    assert go("2024-01-02") == {} and files_of(out) == first
    # one page changes: that volume alone is written again, and of its files those that differ
    put(tmp_path, "vol-002-2001", 2, [block(1, "section-header", "A Title"), block(2, "text", "other words", 200)])
    assert go("2024-01-02")
    second = files_of(out)
    kept = {p for p in first if "volume_slug=vol-001-2000" in str(p)}
    assert kept and all(second.get(p) == first[p] for p in kept)
    assert not any("volume_slug=vol-002-2001" in str(p) for p in first if p in second)
    got = {(r["volume_slug"], r["page_num"], r["text"]) for r in store.read("ordered", ordered).where("text like '%words%'").collect()}
    assert got == {("vol-001-2000", 1, "words of 1"), ("vol-001-2000", 2, "words of 2"), ("vol-002-2001", 1, "words of 1"), ("vol-002-2001", 2, "other words")}
    now = {p: (p.stat().st_mtime_ns, p.read_text()) for p in (tmp_path / "files").rglob("*") if p.is_file()}
    assert now.keys() == html.keys() and all((now[p][0] == html[p][0]) == (now[p][1] == html[p][1]) for p in now)
    assert any(now[p] != html[p] for p in now) and all(now[p] == html[p] for p in now if "vol-001-2000" in str(p))
    # a page goes, the same day: its files go, and no second entry is logged
    (tmp_path / "vol-002-2001/interim/page_0002.json").unlink()
    assert go("2024-01-02") and not (tmp_path / "files/vol-002-2001/pagexml/page_0002.xml").exists()
    log = sorted((r["date"], r["slug"], r["pages"]) for r in store.read("log", volume.LOG).collect())
    assert log == [("2024-01-01", "vol-001-2000", 2), ("2024-01-01", "vol-002-2001", 2), ("2024-01-02", "vol-002-2001", 2)]


def test_files_outside_what_is_asked_for_are_not_opened(spark, tmp_path):
    for slug in ("v1", "v2", "v3"):
        for n in range(1, 9):
            put(tmp_path, slug, n, [block(1, "text", "x")])
    asked = {("v1", 3), ("v1", 4), *(("v2", n) for n in range(1, 9))}
    for p in tmp_path.rglob("page_*.json"):
        if (p.parts[-3], int(p.stem[5:])) not in asked:
            p.chmod(0)
            p.rename(p.with_name(p.name + ".off"))
            (p.parent / p.name).mkdir()  # to open it is an error
    (tmp_path / "v1/interim/notes.json").write_text("{")
    got = io.read_interim(spark, str(tmp_path), volumes={"v1": (3, 4), "v2": None, "none": None})
    assert {(r["volume_slug"], r["page_num"]) for r in got.collect()} == asked
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        rows = spark.read.format("interim_pages").option("pushdown", "true").option("path", str(tmp_path)).load()
        for where, want in (("volume_slug = 'v2' and file_page > 6", 2), ("volume_slug in ('v1', 'v2') and file_page >= 3 and file_page <= 4", 4), ("volume_slug = 'v1' and file_page = 3", 1), ("volume_slug = 'v2' and file_page < 2 and value like '%page_num%'", 1)):
            assert rows.where(where).count() == want
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


@pytest.mark.parametrize("text", ["", "[]", "{", "null", '{"page_num": "x"}'])
def test_broken_pages(spark, tmp_path, text):
    put(tmp_path, "v", 1, [block(1, "text", "x")])
    (tmp_path / "v/interim/page_0002.json").write_text(text)
    (tmp_path / "v/interim/page_0003.json").write_text("﻿" + json.dumps({"page_num": 3, "blocks": []}))
    assert sorted(r["page_num"] for r in io.read_interim(spark, str(tmp_path)).collect()) == [1, 3]
    assert io.read_interim(spark, str(tmp_path / "none")).collect() == []
    assert [r["page_num"] for r in io.read_interim(spark, str(tmp_path), (3, 9)).select(F.col("page_num")).collect()] == [3]
