"""Engine tables made from the driver's tables, by the same arithmetic in Spark and in SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import fixed

WIDTH, HEIGHT = 1400, 2000
TYPE = "CASE WHEN p % 13 = 0 THEN 'page-header' WHEN p % 17 = 0 THEN 'page-footer' WHEN p % 7 = 0 THEN 'section-header' WHEN p % 5 = 0 THEN 'footnote' ELSE 'text' END"
Y1 = "100 + (s * 97 + n * 211 + p * 13) % 1700"
X1 = "CASE WHEN p % 11 = 0 THEN 60 WHEN pg % 3 = 0 THEN 100 WHEN pg % 3 = 1 THEN 100 + (p * 29) % 700 WHEN p % 2 = 0 THEN 80 + s % 7 ELSE 740 + s % 9 END"
W = "CASE WHEN p % 11 = 0 THEN 1280 WHEN pg % 3 = 0 THEN 1200 WHEN p % 19 = 0 THEN 700 ELSE 420 + p % 160 END"
TEXT = "CASE WHEN p % 13 = 0 THEN cast(pg % 97 AS {s}) WHEN p % 7 = 0 THEN concat('Heading ', cast(p AS {s})) WHEN p % 5 = 0 THEN concat(CASE WHEN p % 3 = 0 THEN '' ELSE concat(cast(1 + p % 4 AS {s}), '. ') END, 'Note ', cast(p AS {s})) WHEN p % 4 = 0 THEN concat('Body ', cast(1 + p % 4 AS {s}), '^ ends') WHEN p % 4 = 1 THEN concat('Body word ', cast(1 + s % 4 AS {s}), ' . And more') WHEN p % 4 = 2 THEN 'Im Jahr 1825 wurde verlie-' ELSE 'henen <x> & Wort' END"

SQL = f"""WITH l AS (SELECT l_orderkey AS pg, l_partkey AS p, l_suppkey AS s, l_linenumber AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS emit_pos FROM lineitem),
b AS (SELECT pg % 50 AS vol, pg AS page_num, emit_pos, concat('p', cast(pg AS VARCHAR), '_b', lpad(cast(emit_pos + 1 AS VARCHAR), 3, '0')) AS block_id, {TYPE} AS type, {X1} AS x1, {Y1} AS y1, {X1} + ({W}) AS x2, {Y1} + 50 AS y2, {TEXT.format(s="VARCHAR")} AS text, p, s, n FROM l),
cand AS (SELECT *, (x1 + x2) / 2.0 AS c FROM b WHERE type NOT IN ('page-header', 'page-footer', 'table-of-contents', 'title') AND x2 - x1 <= 840),
cc AS (SELECT page_num, c, lag(c) OVER w AS pc, row_number() OVER w AS rn, count(*) OVER (PARTITION BY page_num) AS k FROM cand WINDOW w AS (PARTITION BY page_num ORDER BY c)),
g AS (SELECT page_num, mid FROM (SELECT page_num, c - pc AS gap, (c + pc) / 2 AS mid, row_number() OVER (PARTITION BY page_num ORDER BY c - pc DESC, rn) AS r FROM cc WHERE pc IS NOT NULL AND k >= 4) WHERE r = 1 AND gap >= 84),
cols AS (SELECT page_num, min(x1) FILTER (c < mid) AS l0, least(max(x2) FILTER (c < mid), cast(floor(mid) AS BIGINT)) AS l1, greatest(min(x1) FILTER (c >= mid), cast(floor(mid) AS BIGINT)) AS r0, max(x2) FILTER (c >= mid) AS r1 FROM cand JOIN g USING (page_num) GROUP BY page_num, mid HAVING count(*) FILTER (c < mid) >= 2 AND count(*) FILTER (c >= mid) >= 2),
a AS (SELECT b.*, cols.l0 IS NOT NULL AS two, CASE WHEN l0 IS NULL OR type IN ('page-header', 'page-footer', 'table-of-contents', 'title') OR x2 - x1 > 840 OR (greatest(0, least(x2, l1) - greatest(x1, l0)) >= 0.3 * greatest(1, x2 - x1) AND greatest(0, least(x2, r1) - greatest(x1, r0)) >= 0.3 * greatest(1, x2 - x1)) THEN NULL WHEN abs((x1 + x2) / 2.0 - (l0 + l1) / 2.0) <= abs((x1 + x2) / 2.0 - (r0 + r1) / 2.0) THEN 0 ELSE 1 END AS col FROM b LEFT JOIN cols USING (page_num)),
sp AS (SELECT x.page_num, x.emit_pos, count(y.emit_pos) FILTER (y.y1 < x.y1) AS above, count(y.emit_pos) FILTER (y.y1 <= x.y1) AS upto FROM a x LEFT JOIN a y ON x.page_num = y.page_num AND y.col IS NULL GROUP BY ALL),
o AS (SELECT a.*, above, upto, row_number() OVER (PARTITION BY page_num ORDER BY CASE WHEN two THEN above ELSE 0 END, CASE WHEN two AND col IS NULL THEN 1 ELSE 0 END, CASE WHEN two THEN coalesce(col, 0) ELSE 0 END, CASE WHEN two THEN y1 ELSE 0 END, emit_pos) - 1 AS reading_pos FROM a JOIN sp USING (page_num, emit_pos)),
anchors AS (SELECT o_custkey % 50 AS vol, o_orderkey AS page_num FROM orders WHERE o_orderpriority = '1-URGENT'),
vp AS (SELECT o_custkey % 50 AS vol, o_orderkey AS page_num FROM orders)
"""


#: Blocks of all types, one for each line item: what a text, markup and description may hold.
KINDS = ("text", "section-header", "caption", "footnote", "table", "image", "figure", "diagram", "equation", "code", "bibliography", "table-of-contents", "page-header", "page-footer", "list", "form")
KINDS_SQL = """WITH k AS (SELECT l_orderkey, l_linenumber, l_partkey, concat('b', cast(l_partkey AS {s}), '_', cast(l_linenumber AS {s})) AS block_id, {array}[{at}] AS type, cast(l_linenumber AS int) AS emit_pos,
cast(l_suppkey % 900 AS int) AS x1, cast(l_partkey % 1500 AS int) AS y1, cast(l_suppkey % 900 + 300 AS int) AS x2, cast(l_partkey % 1500 + 40 AS int) AS y2,
CASE WHEN l_partkey % 23 = 0 THEN '' WHEN l_partkey % 3 = 0 THEN concat('One <x> & ', cast(l_partkey AS {s}), chr(10), chr(10), '  two "q" ', chr(10)) ELSE concat('Line ', cast(l_partkey AS {s})) END AS text,
CASE WHEN l_suppkey % 2 = 0 THEN concat('<table onclick="x"><tr><td>', cast(l_partkey AS {s}), '</td></tr></table>') ELSE '' END AS html, CASE WHEN l_suppkey % 5 = 0 THEN concat('A "view" ', cast(l_suppkey AS {s})) END AS description FROM {rows}) """
KINDS_ORACLE = KINDS_SQL.format(s="VARCHAR", array=f"([{', '.join(repr(k) for k in KINDS)}])", at="l_partkey % 16 + 1", rows="lineitem")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each order with its line items as blocks: one exchange, by page."""
    l = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))).alias("items"))
    named = fixed(rows).select(F.col("l_orderkey").alias("pg"), F.transform("items", lambda x, i: F.struct(i.alias("emit_pos"), x["l_partkey"].alias("p"), x["l_suppkey"].alias("s"), x["l_linenumber"].alias("n"))).alias("items"))
    flat = {"p": "x.p", "s": "x.s", "n": "x.n"}

    def of(expr: str) -> str:
        return re.sub(r"\b([psn])\b(?![a-z'])", lambda m: flat[m[1]], expr)

    items = f"transform(items, x -> named_struct('emit_pos', x.emit_pos, 'p', x.p, 's', x.s, 'n', x.n, 't', {of(TYPE)}, 'x1', {of(X1)}, 'y1', {of(Y1)}))"
    block = f"""transform({items}, x -> named_struct('emit_pos', x.emit_pos, 'block_id', concat('p', pg, '_b', CASE WHEN x.emit_pos < 9 THEN '00' WHEN x.emit_pos < 99 THEN '0' ELSE '' END, x.emit_pos + 1), 'type', x.t, 'raw_type', x.t,
        'x1', cast(x.x1 AS int), 'y1', cast(x.y1 AS int), 'x2', cast(x.x1 + ({of(W)}) AS int), 'y2', cast(x.y1 + 50 AS int), 'text', {of(TEXT.format(s="string"))}, 'html', '', 'description', cast(null AS string), 'p', x.p, 's', x.s, 'n', x.n))"""
    return fixed(named.select(
        F.col("pg").cast("int").alias("page_num"), (F.col("pg") % 50).alias("vol"), F.format_string("vol-%03d-2000", F.col("pg") % 50).alias("volume_slug"),
        F.lit(WIDTH).alias("image_width"), F.lit(HEIGHT).alias("image_height"), F.format_string("page_%04d.png", "pg").alias("image_filename"), F.expr(block).alias("blocks"),
    ))


def kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of all types: l_orderkey, l_linenumber, l_partkey and the columns that renderings take."""
    text = KINDS_SQL.format(s="string", array=f"array({', '.join(repr(k) for k in KINDS)})", at="cast(l_partkey % 16 AS int)", rows="{rows}")
    return spark.sql(text + "SELECT *, type AS raw_type FROM k", rows=read(spark, sf_dir, "lineitem"))


def volume_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(F.format_string("vol-%03d-2000", F.col("o_custkey") % 50).alias("volume_slug"), F.col("o_orderkey").cast("int").alias("page_num"), "o_orderpriority")


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("int")
    return volume_pages(spark, sf_dir).where("o_orderpriority = '1-URGENT'").select("volume_slug", F.col("page_num").alias("pdf_page"), F.lit(0).alias("toc_pos"), none.alias("page_end"), F.concat(F.lit("Title "), F.col("page_num").cast("string")).alias("title"))
