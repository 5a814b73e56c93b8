"""Streaming source ``snapshot_months``: the month folders below a root, an offset being a month.

The newest offset is the newest month all of whose required files are there, so an incomplete month
ends no batch and a month that arrives after a newer one is passed over. A batch holds a row
``(month, folder)`` for each complete month after its start up to its end; run again, it holds the
months up to the same end. Only names are listed.
"""

from __future__ import annotations

import fnmatch
import json
import re
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from regiscope.sources.zipcsv import open_fs

# The innermost folder of a path that begins with a month, or has one behind an equals sign.
_MONTH = re.compile(r"^.*[/=]([0-9]{4}-[0-9]{2})[^/]*/")


@dataclass
class Folders(InputPartition):
    rows: list


class MonthStream(DataSourceStreamReader):
    def __init__(self, options) -> None:
        self.root = options["path"].rstrip("/")
        self.files = options.get("files", "*")
        self.required = json.loads(options.get("required", "[]"))

    def complete(self) -> list[tuple[str, str]]:
        """``(month, folder)`` of the months whose files are all there, ascending, one folder for each."""
        from pyarrow import fs

        files, root = open_fs(self.root)
        found = {}
        for info in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            folder = f"{self.root}/{info.base_name}"
            month = _MONTH.match(f"{folder}/")
            if info.type != fs.FileType.Directory or not month:
                continue
            below = files.get_file_info(fs.FileSelector(f"{root}/{info.base_name}", recursive=True))
            names = [i.base_name for i in below if i.is_file and i.base_name[:1] not in "._"]
            kept = [n for n in names if fnmatch.fnmatchcase(n, self.files)]
            if kept and all(any(re.search(p, n) for n in names) for p in self.required):
                found[month[1]] = max(folder, found.get(month[1], ""))
        return sorted(found.items())

    def initialOffset(self) -> dict:
        return {"month": ""}

    def latestOffset(self) -> dict:
        return {"month": max((month for month, _ in self.complete()), default="")}

    def partitions(self, start: dict, end: dict):
        return [Folders([r for r in self.complete() if start["month"] < r[0] <= end["month"]])]

    def read(self, partition: Folders):
        yield from partition.rows


class MonthSource(DataSource):
    @classmethod
    def name(cls):
        return "snapshot_months"

    def schema(self):
        return "month string, folder string"

    def streamReader(self, schema: StructType):
        return MonthStream(self.options)
