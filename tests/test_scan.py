"""Scans that go on, archives, and an empty corpus."""

import json
import zipfile

from pyspark.sql import functions as F

from quire.__main__ import main
from quire.plans import scan, volume
from quire.sources import archive, commits


def picture(root, slug, n, data):
    folder = root / slug / "pages"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"page_{n:04d}.png").write_bytes(data)


def test_only_changed_pictures_are_recognised(spark, tmp_path):
    for slug in ("v1", "v2"):
        for n in (1, 2, 3):
            picture(tmp_path, slug, n, f"{slug}{n}".encode())
    asked = []

    def infer(todo):
        asked.append(sorted((r["volume_slug"], r["page_num"]) for r in todo.collect()))
        raw = F.to_json(F.struct("page_num", F.array(F.struct(F.lit("b").alias("id"), F.col("digest").alias("text"))).alias("blocks")))
        return todo.where("not (volume_slug = 'v2' and page_num = 3)").select("volume_slug", "page_num", raw.alias("raw"), F.lit(1.5).alias("ocr_seconds"))

    out = str(tmp_path / "scans")
    go = lambda force=False: scan.scan(spark, scan.page_pictures(spark, str(tmp_path)), infer, out, force)
    everything = [(s, n) for s in ("v1", "v2") for n in (1, 2, 3)]
    assert go().count() == 5 and asked[-1] == everything
    vols = spark.createDataFrame([("v1", 1), ("v2", 2)], "volume_slug string, volume_number int")
    state = lambda: {r["part"]: r["digest"] for r in volume.inputs(scan.raw_pages(commits.Store(spark, out).read("scans", scan.SCANS)), vols).collect()}
    before = state()
    rows = go().collect()
    assert asked[-1] == [("v2", 3)] and all(r["resumed"] for r in rows) and len(rows) == 5 and state() == before
    picture(tmp_path, "v1", 2, b"changed")
    picture(tmp_path, "v1", 4, b"new")
    (tmp_path / "v2/pages/page_0001.png").unlink()
    rows = go().collect()
    assert asked[-1] == [("v1", 2), ("v1", 4), ("v2", 3)]
    assert {(r["volume_slug"], r["page_num"], r["resumed"]) for r in rows} == {("v1", 1, True), ("v1", 2, False), ("v1", 3, True), ("v1", 4, False), ("v2", 2, True)}
    after = state()
    assert after["v1"] != before["v1"] and after["v2"] != before["v2"]
    assert go(True).count() == 5 and len(asked[-1]) == 6 and state() == after
    page = scan.raw_pages(commits.Store(spark, out).read("scans", scan.SCANS)).where("page_num = 4").first()
    assert (page["image_filename"], len(page["blocks"])) == ("page_0004.png", 1)


def test_archives(spark, tmp_path):
    rows = [("v1", "v1/b.txt", b"b" * 5000), ("v1", "v1/a/ü.txt", "ä".encode()), ("v2", "v2/x", None), ("v2", "v2/empty", b"")]
    files = spark.createDataFrame(rows, "volume_slug string, path string, content binary")
    archive.write_archives(files.repartition(3), str(tmp_path / "one"))
    archive.write_archives(files.orderBy(F.desc("path")).repartition(2), str(tmp_path / "two"))
    made = sorted(p.name for p in (tmp_path / "one").iterdir())
    assert made == ["v1.zip", "v2.zip"] and all((tmp_path / "one" / n).read_bytes() == (tmp_path / "two" / n).read_bytes() for n in made)
    with zipfile.ZipFile(tmp_path / "one/v1.zip") as z:
        assert z.namelist() == ["v1/a/ü.txt", "v1/b.txt"] and z.read("v1/a/ü.txt").decode() == "ä" and z.testzip() is None
    for _, path, data in rows:
        (tmp_path / "root" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "root" / path).write_bytes(data or b"")
    archive.bundle(spark, str(tmp_path / "root"), spark.createDataFrame([("v1",)], "volume_slug string"))
    assert sorted(p.name for p in (tmp_path / "root").glob("*.zip")) == ["v1.zip"]
    assert (tmp_path / "root/v1.zip").read_bytes() == (tmp_path / "one/v1.zip").read_bytes()


def test_empty_corpus(tmp_path):
    root = tmp_path / "corpus"
    assert main(["init-wiki", str(root), "--series", "Jährliche Hefte", "--publisher", "P", "--date", "2024-01-01"]) == 0
    doc = json.loads((root / "graph/corpus.jsonld").read_text())
    assert doc["@context"] == json.loads((root / "_context.json").read_text())["@context"] and doc["@graph"][0]["@id"] == "doc:series/jahrliche-hefte"
    assert (root / "series.md").read_text().startswith("---\n'@context': ./_context.json\n'@id': doc:series/jahrliche-hefte\n") and "[2024-01-01] init-wiki" in (root / "log.md").read_text()
    assert main(["init-wiki", str(root)]) == 1 and main(["init-wiki", str(root), "--force"]) == 0
