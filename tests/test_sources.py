"""Configs, interim pages of several volumes, configured offsets, files, links and contents."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import toc
from quire.plans import volume
from quire.sources import io


def put(root, slug, n, blocks):
    folder = root / slug / "interim"
    folder.mkdir(parents=True, exist_ok=True)
    page = {"page_num": n, "image_filename": f"page_{n:04d}.png", "image_width": 1000, "image_height": 1500, "blocks": blocks}
    (folder / f"page_{n:04d}.json").write_text(json.dumps(page))


def block(i, kind, text, y=50):
    return {"id": f"b{i}", "type": kind, "bbox": [100, y, 900, y + 40], "text": text, "html": ""}


def test_each_volume_has_its_own_range(spark, tmp_path):
    for slug in ("vol-001-2000", "vol-002-2001", "vol-003-2002"):
        for n in range(1, 8):
            put(tmp_path, slug, n, [block(1, "text", "words")])
    volumes = [io.Volume(volume_number=1, volume_year=2000, page_range=(2, 3)), io.Volume(volume_number=2, volume_year=2001)]
    got = {(r["volume_slug"], r["page_num"]) for r in io.read_volumes(spark, str(tmp_path), volumes).collect()}
    assert got == {("vol-001-2000", 2), ("vol-001-2000", 3), *(("vol-002-2001", n) for n in range(1, 8))}


@pytest.mark.parametrize(("offset", "first"), [(4, 13), (None, 9)])
def test_configured_offset(spark, tmp_path, offset, first):
    contents = "INHALT\nAUFSÄTZESmith, First Article ...... 9Jones, Second Article ...... 12"
    put(tmp_path, "vol-001-2000", 1, [block(1, "text", "x")])
    put(tmp_path, "vol-001-2000", 9, [block(1, "table-of-contents", contents)])
    for n in range(10, 18):
        put(tmp_path, "vol-001-2000", n, [block(1, "text", "x", 700)])
    for n in (2, 3, 4):  # printed numbers that agree on no offset
        put(tmp_path, "vol-001-2000", n, [block(1, "page-header", str(n))])
    v = [io.Volume(volume_number=1, volume_year=2000, printed_page_offset=offset)]
    out = volume.structure(io.read_volumes(spark, str(tmp_path), v), io.volumes_table(spark, v))
    assert [r["page_first"] for r in out["articles"].where("num > 0").orderBy("num").collect()][0] == first


def test_write_files(spark, tmp_path):
    rows = spark.createDataFrame([("articles/a b.md", "one\n"), ("index.md", "ä"), ("x/y/z.md", None)], "path string, content string")
    io.write_files(rows.repartition(2), str(tmp_path))
    assert (tmp_path / "articles/a b.md").read_text() == "one\n" and (tmp_path / "index.md").read_text() == "ä" and (tmp_path / "x/y/z.md").read_text() == ""
    for bad in ("../out.md", "/etc/x", None):
        with pytest.raises(Exception, match="relative"):
            io.write_files(spark.createDataFrame([(bad, "x")], "path string, content string"), str(tmp_path))


def test_graphs_of_like_names(spark, tmp_path):
    for name in ("a.jsonld", "ba.jsonld", "sub/a.jsonld"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(json.dumps({"@graph": [{"@id": name, "@type": "Book"}]}))
    paths = [str(tmp_path / n) for n in ("a.jsonld", "ba.jsonld", "sub/a.jsonld")]
    got = io.read_graphs(spark, paths).orderBy("source_ord").collect()
    assert [(r["source_ord"], r["node_id"]) for r in got] == [(0, "a.jsonld"), (1, "ba.jsonld"), (2, "sub/a.jsonld")]


def test_links():
    assert all(T.safe_link(x) for x in ("http://a", "HTTPS://a", "mailto:a@b", "page.html", "/a:b", "#fn-1", "?q=a:b", ""))
    assert not any(T.safe_link(x) for x in ("javascript:x", "java\nscript:x", " \x01javascript:x", "data:text/html,x", "vbscript:x", "ftp://x"))


def contents(spark, text):
    return [(r["kind"], r["token"], r["page"]) for r in toc.tokens(spark.createDataFrame([("v", text)], "volume_slug string, text string")).orderBy("pos").collect()]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (None, []), ("", []), ("AUFSÄTZE", [("header", "AUFSÄTZE", None)]), ("ab", [("entry", "ab", None)]), ("AB", [("entry", "AB", None)]),
        ("INHALT\nOne .. 1Two ... 2-3 Rest", [("title", "INHALT", None), ("entry", "One", "1"), ("entry", "Two", "2-3"), ("entry", "Rest", None)]),
        ("Wait... what .... 12", [("entry", "Wait... what", "12")]),
        ("NEUE BERICHTE Karl Schmotz, Title ...... 5–9", [("header", "NEUE BERICHTE", None), ("entry", "Karl Schmotz, Title", "5–9")]),
        ("AB Karl .. 1", [("entry", "AB Karl", "1")]), ("BERICHTE K. Schmotz .. 1", [("entry", "BERICHTE K. Schmotz", "1")]), ("A .. 12345", [("entry", "A", "1234"), ("entry", "5", None)]),
    ],
)
def test_contents(spark, text, want):
    assert contents(spark, text) == want


def test_authors(spark):
    cases = {
        "Hartmut Wolff, Titel": ("Hartmut Wolff", "Titel"), "K. Schmotz/Anton von Berg, A, B": ("K. Schmotz/Anton von Berg", "A, B"), "Karl  Schmotz\nund Eva Maier: Titel": ("Karl Schmotz und Eva Maier", "Titel"),
        "Schmotz: Titel": ("", "Schmotz: Titel"), "Schmotz, Titel": ("Schmotz", "Titel"), "Ein Buch, das fehlt: Rest": ("Ein Buch", "das fehlt: Rest"), "ein Buch, das fehlt": ("", "ein Buch, das fehlt"),
        "Karl Schmotz,Titel": ("", "Karl Schmotz,Titel"), "Karl von: Titel": ("", "Karl von: Titel"), "Anna de la Cruz, T": ("", "Anna de la Cruz, T"), "": ("", ""), None: ("", ""),
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = {r["i"]: (r["a"]["author"], r["a"]["title"]) for r in df.select("i", T.author_title(F.col("t")).alias("a")).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_slugs(spark):
    words = ["Wolff, Jürgen", "Čapek Karel", "Łukasz", "Erdős Pál", "ﬁ x² Ⅷ", "", "!!", "Ａｂｃ１", "été", "Ελλάδα"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    rows = df.select("w", T.slug(F.col("w")).alias("a"), T.nfkd_slug(F.col("w")).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows)


def test_slugs_of_all_characters(spark):
    """The native slug equals normalisation for every character of the first plane, and for those beyond that decompose or combine."""
    import unicodedata

    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and (i < 0x10000 or unicodedata.combining(chr(i)) or unicodedata.decomposition(chr(i)) or i % 997 == 0)]
    words = [f"A{c}b" for c in chars] + ["".join(chars[i : i + 50]) for i in range(0, len(chars), 50)]
    df = spark.createDataFrame(pd.DataFrame({"w": words})).repartition(4)
    wrong = df.select("w", T.slug(F.col("w")).alias("a"), T.nfkd_slug(F.col("w")).alias("b")).where("not a <=> b").limit(5).collect()
    assert wrong == [] and len(words) > 65000


def test_configs(tmp_path):
    """Recognition's record, folders and plain values; a config written from a volume reads as the same volume."""
    import yaml

    path = tmp_path / "v.yaml"
    path.write_text("volume_number: 7\nvolume_year: 2001\noutput_root: out/\npage_range: [2, 5]\nocr: {batch_size: 4}\n")
    v = io.read_config(str(path))
    assert (v.ocr.method, v.ocr.batch_size, v.folder(), v.folder("interim")) == ("hf", 4, "out/vol-007-2001", "out/vol-007-2001/interim")
    w = io.read_config(str(path), ocr_method="vllm", vllm_url="http://x/v1", pdf_path="a.pdf")
    assert (w.ocr.method, w.ocr.vllm_url, w.ocr.batch_size, w.pdf_path) == ("vllm", "http://x/v1", 4, "a.pdf")
    path.write_text(yaml.safe_dump(w.as_dict()))
    assert io.read_config(str(path)) == w
    with pytest.raises(ValueError, match="vllm_url"):
        io.read_config(str(path), vllm_url="")
    for bad in ("ocr: {method: x}", "ocr: {speed: 1}", "colour: 1"):
        path.write_text(f"volume_number: 7\nvolume_year: 2001\n{bad}\n")
        with pytest.raises((ValueError, TypeError)):
            io.read_config(str(path))
    with pytest.raises(ValueError, match="no folder"):
        v.folder("x")
