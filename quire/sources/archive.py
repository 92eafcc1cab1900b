"""A sink that writes one zip archive for each volume: tasks stream archives aside, and all appear when the job is done.

Rows are (volume_slug, path, content as binary). The bytes of an archive depend on its rows alone: files come in order of their
path, with one fixed date. `write_archives` deals rows so that each volume is written by one task, one file in memory at a time.
"""

from __future__ import annotations

import uuid
import zipfile
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from .interim import opened

#: The oldest date that archives can hold; every file has it.
DATE = (1980, 1, 1, 0, 0, 0)


@dataclass
class Written(WriterCommitMessage):
    made: list[tuple[str, str]] = field(default_factory=list)  # the archive's place and the one where it waits


class ArchiveWriter(DataSourceWriter):
    def __init__(self, root: str):
        self.root = root

    def write(self, iterator):
        store, base = opened(self.root)
        store.create_dir(base, recursive=True)
        done, now, out, archive = Written(), None, None, None
        for row in iterator:
            if row["volume_slug"] != now:
                if archive:
                    archive.close()
                    out.close()
                now = row["volume_slug"]
                waits = f"{base}/.{now}-{uuid.uuid4().hex}.zip"
                done.made.append((f"{base}/{now}.zip", waits))
                out = store.open_output_stream(waits)
                archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=6)
            entry = zipfile.ZipInfo(row["path"], DATE)
            entry.compress_type, entry.external_attr = zipfile.ZIP_DEFLATED, 0o644 << 16
            archive.writestr(entry, bytes(row["content"] or b""))
        if archive:
            archive.close()
            out.close()
        return done

    def commit(self, messages):
        store, _ = opened(self.root)
        for m in messages:
            for target, waits in m.made if m else ():
                store.move(waits, target)

    def abort(self, messages):
        store, _ = opened(self.root)
        for m in messages:
            for _, waits in m.made if m else ():
                store.delete_file(waits)


class Archives(DataSource):
    """One <path>/<volume_slug>.zip for each volume."""

    @classmethod
    def name(cls):
        return "volume_archives"

    def schema(self):
        return "volume_slug string, path string, content binary"

    def writer(self, schema, overwrite):
        return ArchiveWriter(self.options["path"])


def write_archives(files: DataFrame, root: str) -> None:
    """Write root/<volume_slug>.zip with the files (volume_slug, path, content) of each volume; archives that were there are replaced."""
    files.sparkSession.dataSource.register(Archives)
    rows = files.select("volume_slug", "path", F.col("content").cast("binary").alias("content")).repartition("volume_slug").sortWithinPartitions("volume_slug", "path")
    rows.write.format("volume_archives").option("path", root).mode("append").save()


def bundle(spark, root: str, slugs: DataFrame, to: str | None = None) -> None:
    """Archives of all files under root/<volume_slug>, whatever they are, for these volumes (volume_slug); paths start with the slug."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    rest = F.regexp_replace(F.substring_index("path", root.rstrip("/") + "/", -1), "^/+", "")
    rows = rows.select(F.substring_index(rest, "/", 1).alias("volume_slug"), rest.alias("path"), "content").where(F.contains(rest, F.lit("/")))
    write_archives(rows.join(slugs.select("volume_slug").distinct(), "volume_slug", "left_semi"), to or root)
