"""Tables whose parts are replaced as a whole: a run writes beside what is there, and one rename makes it count.

Rows lie under <root>/<table>/commit=<id>/<part column>=<part>/. The manifest, a small Parquet table of part, commit and digest in
<root>/_manifest/version=<n>/, tells which commit each part is read from, for all tables at once. A new version of it is written
aside and renamed into place; a rename never replaces a version, so of two runs that end together one takes the other's version as
its base and tries again. Readers see a part as it was or as it is, never half of it; a run that dies leaves nothing that is read.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Seconds after which folders of commits that were never published are removed.
GRACE = 24 * 3600


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in children(spark, root) if n.startswith("version="))


def publish_folder(spark: SparkSession, made: str, root: str, version: int) -> bool:
    """Rename a folder to root/version=<version>; False if there is one already."""
    fs, target = file_system(spark, f"{root}/version={version}")
    source = spark._jvm.org.apache.hadoop.fs.Path(made)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(source, target, none)
    except Exception as e:
        if "FileAlreadyExists" in str(e) or "already exists" in str(e):
            return False
        raise
    return True


class Store:
    """The tables under one root; part: the column by which they are replaced."""

    MANIFEST = "part string, commit string, digest string"

    def __init__(self, spark: SparkSession, root: str, part: str = "volume_slug"):
        self.spark, self.root, self.part = spark, root.rstrip("/"), part

    def begin(self) -> str:
        """The id of a new commit; ids sort by the time they were given."""
        return f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"

    def manifest(self, version: int | None = None) -> DataFrame:
        """part, commit, digest as of a version, the newest by default."""
        known = versions(self.spark, f"{self.root}/_manifest")
        if not known:
            return self.spark.createDataFrame([], self.MANIFEST)
        return self.spark.read.schema(self.MANIFEST).parquet(f"{self.root}/_manifest/version={version or known[-1]}")

    def write(self, name: str, commit: str, df: DataFrame) -> DataFrame:
        """Write a table of a commit, and read it again; nobody else sees it before `publish`. A second write replaces the first."""
        at = f"{self.root}/{name}/commit={commit}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(self.part) if self.part in df.columns else writer).parquet(at)
        return self.spark.read.schema(df.schema).parquet(at).select(df.columns)

    def read(self, name: str, schema) -> DataFrame:
        """All parts of a table, each from its newest commit; the scan is pruned to the folders that the manifest names."""
        fs, p = file_system(self.spark, f"{self.root}/{name}")
        columns = self.spark.createDataFrame([], schema)
        if not fs.exists(p) or not versions(self.spark, f"{self.root}/_manifest"):
            return columns
        given = columns.withColumn("commit", F.lit("")).schema
        rows = self.spark.read.schema(given).parquet(f"{self.root}/{name}")
        now = self.manifest().select(F.col("part").alias(self.part), "commit")
        return rows.join(now, [self.part, "commit"], "left_semi").select(columns.columns)

    def publish(self, commit: str, parts: DataFrame, tries: int = 20) -> int:
        """Let parts (part, digest) be read from this commit; returns the manifest's new version."""
        new = parts.select("part", F.lit(commit).alias("commit"), "digest")
        for _ in range(tries):
            last = max([0, *versions(self.spark, f"{self.root}/_manifest")])
            made = f"{self.root}/_manifest/_new-{uuid.uuid4().hex}"
            self.manifest().join(new, "part", "left_anti").unionByName(new).coalesce(1).write.parquet(made)
            if publish_folder(self.spark, made, f"{self.root}/_manifest", last + 1):
                return last + 1
            remove(self.spark, made)
        raise PySparkException(f"the manifest under {self.root} changed {tries} times in a row")

    def vacuum(self, grace: float = GRACE) -> list[str]:
        """Remove folders of parts that are read from a later commit, whole commits that are read no more, and old ones never published."""
        live: dict[str, set[str]] = {}
        for r in self.manifest().toLocalIterator():
            live.setdefault(r["commit"], set()).add(r["part"])
        known = versions(self.spark, f"{self.root}/_manifest")
        before = {r["commit"] for v in known[:-1] for r in self.manifest(v).select("commit").distinct().collect()}
        young, gone = f"{int((time.time() - grace) * 1000):015d}", []
        for name in children(self.spark, self.root):
            if name.startswith("_"):
                continue
            for folder in children(self.spark, f"{self.root}/{name}"):
                commit = folder.removeprefix("commit=")
                at = f"{self.root}/{name}/{folder}"
                if commit in live:
                    gone += [f"{at}/{p}" for p in children(self.spark, at) if p.startswith(f"{self.part}=") and self._value(p) not in live[commit]]
                elif commit in before or commit < young:
                    gone.append(at)
        gone += [f"{self.root}/_manifest/version={v}" for v in known[:-1]]
        for path in gone:
            remove(self.spark, path)
        return gone

    def _value(self, folder: str) -> str:
        return self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder.split("=", 1)[1])
