"""The corpus in buckets: batches against one merge of all, replays, what is written; files in order without one row."""

import json

from pyspark.sql import functions as F

from quire.operators import graph, wiki
from quire.sources import io
from quire.streaming import merge


def nodes(spark, rows):
    return spark.createDataFrame([(s, i, n, [t], p) for i, (s, n, t, p) in enumerate(rows)], merge.NODE)


def parts(root):
    return {str(p.relative_to(root)): p.stat().st_size for p in root.rglob("part-*.parquet") if "_manifest" not in str(p)}


def test_batches_and_replays(spark, tmp_path):
    first = nodes(spark, [(0, f"n{i}", "Book", {"name": str(i), "a": "1"}) for i in range(200)] + [(0, None, "Book", {})])
    second = nodes(spark, [(0, "n7", "Person", {"name": '"later"', "b": "2"}), (1, "new", "Book", {"z": "1"}), (0, "new", "Person", {"y": "2", "z": "3"})])
    root = str(tmp_path)
    assert merge.add_batch(root, first, 0, buckets=16)
    before = parts(tmp_path)
    assert merge.add_batch(root, second, 1)
    after = parts(tmp_path)
    written = {p: n for p, n in after.items() if p not in before}
    touched = {p.split("/")[2] for p in written}
    assert 1 <= len(touched) <= 2 and sum(written.values()) < 0.3 * sum(before.values())
    assert {p.split("/")[2] for p in before if p not in after} <= touched and len({p.split("/")[2] for p in after}) == 16
    got = merge.corpus(spark, root).orderBy("seen").select("node_id", "types", "props").collect()
    whole = first.withColumn("source_ord", F.lit(0)).unionByName(second.withColumn("source_ord", F.col("source_ord") + 1))
    assert got == graph.merge(whole).orderBy("seen").select("node_id", "types", "props").collect()
    seven = next(r for r in got if r["node_id"] == "n7")
    assert seven["types"] == ["Book"] and list(seven["props"].items()) == [("name", "7"), ("a", "1"), ("b", "2")]
    assert not merge.add_batch(root, second, 1) and not merge.add_batch(root, first, 0) and parts(tmp_path) == after
    assert merge.add_batch(root, nodes(spark, []), 2) and parts(tmp_path).keys() == after.keys()


def test_stream(spark, tmp_path):
    source, root, check = (str(tmp_path / x) for x in ("in", "corpus", "check"))
    nodes(spark, [(0, "a", "Book", {"x": "1"})]).write.parquet(source)
    merge.start(spark, source, root, check).awaitTermination()
    nodes(spark, [(0, "a", "Book", {"x": "2", "y": "3"}), (0, "b", "Book", {})]).write.mode("append").parquet(source)
    merge.start(spark, source, root, check).awaitTermination()
    got = {r["node_id"]: r["props"] for r in merge.corpus(spark, root).collect()}
    assert got == {"a": {"x": "1", "y": "3"}, "b": {}}


def test_files_in_order(spark, tmp_path):
    rows = spark.range(1000).repartition(7).select(F.col("id").alias("key"), F.concat(F.lit("Zeile ü "), "id").alias("line"))
    path = str(tmp_path / "sub/all.txt")
    io.write_ordered(rows, path, "[\n", "\n]", ",\n")
    want = "[\n" + ",\n".join(f"Zeile ü {i}" for i in range(1000)) + "\n]"
    assert (tmp_path / "sub/all.txt").read_text() == want
    io.write_ordered(rows, path, "[\n", "\n]", ",\n", in_place=False)
    assert (tmp_path / "sub/all.txt").read_text() == want and [p.name for p in (tmp_path / "sub").iterdir()] == ["all.txt"]
    io.write_ordered(rows.where("key < 0"), path, "[", "]", ",")
    assert (tmp_path / "sub/all.txt").read_text() == "[]"


def test_graph_document(spark, tmp_path):
    given = tmp_path / "a.jsonld"
    given.write_text(json.dumps({"@context": {"x": "http://x"}, "@graph": [{"@id": f"n{i}", "@type": "Book", "k": i} for i in range(50)]}))
    merged = graph.merge(io.read_graphs(spark, [str(given)]))
    io.write_graph(merged, str(tmp_path / "out.jsonld"), io.read_context(spark, [str(given)]))
    made = json.loads((tmp_path / "out.jsonld").read_text())
    assert made == json.loads(given.read_text())


def test_index_lines(spark, tmp_path):
    rows = [("d:vol/b", ["PublicationVolume"], {"name": '"V"', "datePublished": '"2001"'}), ("d:x/1", ["WebPage"], {})]
    io.write_ordered(wiki.index_rows(spark.createDataFrame(rows, "node_id string, types array<string>, props map<string,string>")), str(tmp_path / "index.md"), wiki.INDEX_HEAD, "\n", "\n")
    assert (tmp_path / "index.md").read_text().endswith("\n\n## Volumes (1)\n\n- [V (2001)](volumes/b.md) · `d:vol/b`\n\n## Other nodes of the graph\n\n- WebPage: 1\n")
