"""A data source of interim page files that opens only those asked for: volumes are folders, page numbers are in file names.

One partition is one volume's folder, listed by the task that reads it; the driver lists the volumes alone. Volumes with their
pages (`ranges`) and a range for all (`pages`) come as options. With the option `pushdown` filters on volume_slug and file_page do the
same, if Spark pushes filters down to sources in Python (spark.sql.python.filterPushdown.enabled).
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

#: Fixed by the layout of a run's folders.
PAGE_FILE = re.compile(r"page_(\d+)\.json")


def opened(root: str):
    """The file system that holds root, and root within it."""
    import os

    from pyarrow import fs

    return fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{os.path.abspath(root)}")


@dataclass
class Folder(InputPartition):
    root: str
    slug: str
    pages: tuple[int | None, int | None]


class InterimReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        #: Volumes asked for with first and last page, None where it is open; None for all.
        self.ranges = {k: tuple(v) for k, v in json.loads(options["ranges"]).items()} if "ranges" in options else None
        self.least, self.most = json.loads(options.get("pages", "[null, null]"))
        self.slugs = None

    def partitions(self):
        from pyarrow import fs

        store, base = opened(self.root)
        if self.ranges is not None:
            slugs = sorted(self.ranges)
        else:
            slugs = sorted(x.base_name for x in store.get_file_info(fs.FileSelector(base, allow_not_found=True)) if x.type == fs.FileType.Directory)
        return [Folder(self.root, s, (self.ranges or {}).get(s, (None, None))) for s in slugs if self.slugs is None or s in self.slugs]

    def read(self, partition):
        from pyarrow import fs

        if partition is None:  # what Spark passes where there are no partitions
            return
        store, base = opened(partition.root)
        found = []
        for x in store.get_file_info(fs.FileSelector(f"{base}/{partition.slug}/interim", allow_not_found=True)):
            m = PAGE_FILE.fullmatch(x.base_name)
            n = int(m[1]) if m else None
            asked = n is not None and all(a is None or n >= a for a in (partition.pages[0], self.least)) and all(z is None or n <= z for z in (partition.pages[1], self.most))
            if asked:
                found.append((n, x.path))
        for n, path in sorted(found):
            with store.open_input_stream(path) as f:
                yield partition.slug, n, f.read().decode("utf-8-sig")


class FilteredReader(InterimReader):
    """Takes filters too; Spark refuses such a reader where it pushes none."""

    def pushFilters(self, filters):
        for f in filters:
            name, value = f.attribute[0], getattr(f, "value", None)
            if name == "volume_slug" and isinstance(f, EqualTo | In):
                asked = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.slugs = asked if self.slugs is None else self.slugs & asked
            elif name == "file_page" and isinstance(f, EqualTo):
                self._between(value, value)
            elif name == "file_page" and isinstance(f, GreaterThan | GreaterThanOrEqual):
                self._between(value + isinstance(f, GreaterThan), None)
            elif name == "file_page" and isinstance(f, LessThan | LessThanOrEqual):
                self._between(None, value - isinstance(f, LessThan))
            else:
                yield f

    def _between(self, least, most):
        self.least = least if self.least is None else self.least if least is None else max(self.least, least)
        self.most = most if self.most is None else self.most if most is None else min(self.most, most)


class InterimPages(DataSource):
    """Rows (volume_slug, file_page, value) of <path>/<volume>/interim/page_<n>.json."""

    @classmethod
    def name(cls):
        return "interim_pages"

    def schema(self):
        return "volume_slug string, file_page int, value string"

    def reader(self, schema):
        options = dict(self.options)
        return (FilteredReader if options.get("pushdown") == "true" else InterimReader)(options)
