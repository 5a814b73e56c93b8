"""Data source ``zip_csv``: delimited text inside zip archives.

One input partition per archive member. A member is a deflate stream and cannot be split, so
each task streams its member through the Arrow CSV reader in blocks, without a temporary file
and without holding the member in memory. Archives are opened through ``pyarrow.fs``, so any
path the executors share will do.

Quoted blanks stay ``''`` and unquoted blanks become NULL. A record of the wrong width fails
the job, or, with ``mode=quarantine``, arrives as a row of NULLs with its text in
``_corrupt_record``. Filters on ``_file`` decide which archives are opened at all.

Written, every partition becomes an archive of its own, named by its number. Tasks write below a
folder of the job's; what the successful ones wrote is moved to its place at the commit, and
all of the folder goes when the job fails, so a failed job or a repeated task leaves nothing behind.

The module imports nothing from the package, so that it can be shipped to workers by value.
"""

from __future__ import annotations

import codecs
import fnmatch
import io
import uuid
import zipfile
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.types import StructType

_FILE, _LINE, _CORRUPT = "_file", "_line", "_corrupt_record"


def open_fs(path: str):
    """File system of a path or URI, and the path on it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), path


def list_archives(pattern: str) -> list[str]:
    """Archives whose name matches the last part of the pattern, in name order."""
    from pyarrow import fs

    folder, _, name = pattern.rpartition("/")
    files, root = open_fs(folder or ".")
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    names = sorted(i.base_name for i in found if i.is_file and fnmatch.fnmatchcase(i.base_name, name))
    return [f"{folder or '.'}/{n}" for n in names]


@dataclass
class Member(InputPartition):
    archive: str
    name: str


class _Without(io.RawIOBase):
    """A byte stream in UTF-8 with some bytes left out, read and recoded in small pieces: whole blocks in several
    forms at once are most of what a reader holds."""

    PIECE = 1 << 18

    def __init__(self, raw, unwanted: bytes, charset: str = "utf8"):
        self._raw, self._unwanted, self._rest = raw, unwanted, memoryview(b"")
        plain = codecs.lookup(charset).name == "utf-8"
        self._decoder = None if plain else codecs.getincrementaldecoder(charset)()

    def readable(self):
        return True

    def readinto(self, buffer):
        while not self._rest:
            chunk = self._raw.read(self.PIECE)
            kept = chunk.translate(None, self._unwanted)
            if self._decoder:
                kept = self._decoder.decode(kept, final=not chunk).encode()
            self._rest = memoryview(kept)
            if not chunk and not kept:
                return 0
        size = min(len(buffer), len(self._rest))
        buffer[:size] = self._rest[:size]
        self._rest = self._rest[size:]
        return size


class ZipCsvReader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.columns = [f.name for f in schema if f.name not in (_FILE, _LINE, _CORRUPT)]
        self.output = [f.name for f in schema]
        self.path = options["path"]
        self.sep = options.get("sep", ";")
        self.charset = options.get("charset", "iso8859-15")
        self.header = options.get("header", "false").lower() == "true"
        self.unwanted = b"\x00\r" if options.get("stripcr", "false").lower() == "true" else b"\x00"
        self.quarantine = options.get("mode", "failfast").lower() == "quarantine"
        # Of each filter on the file, the beginnings that a file's name may have, and whether they are whole names.
        self.wanted: list[tuple[list[str], bool]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Note the filters on ``_file``; Spark applies all of them again."""
        for f in filters:
            if getattr(f, "attribute", None) == (_FILE,):
                if isinstance(f, StringStartsWith):
                    self.wanted.append(([f.value], False))
                elif isinstance(f, EqualTo):
                    self.wanted.append(([f.value], True))
                elif isinstance(f, In):
                    self.wanted.append((list(f.value), True))
            yield f

    def _may_hold(self, archive: str) -> bool:
        top = f"{archive}!"
        return all(any(v.startswith(top) or (not whole and top.startswith(v)) for v in values) for values, whole in self.wanted)

    def _is_wanted(self, member: str) -> bool:
        return all(any(member == v if whole else member.startswith(v) for v in values) for values, whole in self.wanted)

    def partitions(self):
        members = []
        for archive in filter(self._may_hold, list_archives(self.path)):
            files, path = open_fs(archive)
            with files.open_input_file(path) as handle, zipfile.ZipFile(handle) as zipped:
                names = [i.filename for i in zipped.infolist() if not i.is_dir()]
            members += [Member(archive, n) for n in names if self._is_wanted(f"{archive}!{n}")]
        return members

    def read(self, partition: Member):
        files, path = open_fs(partition.archive)
        with files.open_input_file(path) as handle, zipfile.ZipFile(handle) as zipped:
            with zipped.open(partition.name) as raw:
                text = io.BufferedReader(_Without(raw, self.unwanted, self.charset), _Without.PIECE)
                if text.peek(1):
                    yield from self._batches(text, f"{partition.archive}!{partition.name}")

    def _batches(self, text, source: str):
        import pyarrow as pa
        from pyarrow import csv

        broken: list[str] = []

        def on_broken(row):
            broken.append(row.text)
            return "skip"

        reader = csv.open_csv(
            text,
            read_options=csv.ReadOptions(
                column_names=self.columns, skip_rows=int(self.header),
                block_size=8 << 20, use_threads=False,
            ),
            parse_options=csv.ParseOptions(
                delimiter=self.sep, quote_char='"', double_quote=True, newlines_in_values=True,
                invalid_row_handler=on_broken if self.quarantine else None,
            ),
            convert_options=csv.ConvertOptions(
                column_types={c: pa.string() for c in self.columns}, null_values=[""],
                strings_can_be_null=True, quoted_strings_can_be_null=False,
            ),
        )
        line = 0
        for batch in reader:
            yield self._shape(pa, batch.num_rows, dict(zip(self.columns, batch.columns)), source, line)
            line += batch.num_rows
        if broken:
            yield self._shape(pa, len(broken), {_CORRUPT: pa.array(broken, pa.string())}, source, line)

    def _shape(self, pa, rows: int, columns: dict, source: str, line: int):
        import numpy as np

        columns = columns | {
            _FILE: pa.array([source], pa.string()).take(pa.array([0] * rows, pa.int32())),
            _LINE: pa.array(np.arange(line + 1, line + rows + 1, dtype="int64")),
        }
        empty = pa.nulls(rows, pa.string())
        arrays = [columns.get(name, empty) for name in self.output]
        return pa.RecordBatch.from_arrays(arrays, names=self.output)


@dataclass
class Written(WriterCommitMessage):
    """A file that a task has written, and the name it is to have; none for a partition without rows."""

    parts: list[tuple[str, str]] = field(default_factory=list)


class ZipCsvWriter(DataSourceArrowWriter):
    """Quoted text: blanks quoted, NULLs not. Each archive holds ``members`` files, each with its own header line if
    there is one: the first batch is dealt to all, the last goes on with the others. Batches are written as
    they come.
    """

    def __init__(self, schema: StructType, options, overwrite: bool):
        self.columns = [f.name for f in schema]
        self.folder, self.overwrite = options["path"].rstrip("/"), overwrite
        self.sep, self.newline = options.get("sep", ";"), options.get("newline", "\n")
        self.charset, self.prefix = options.get("charset", "iso8859-15"), options.get("prefix", "part")
        self.members = int(options.get("members", "1"))
        self.header, self.zipped, self.numbered = (options.get(k, d).lower() == "true" for k, d in (
            ("header", "false"), ("zipped", "true"), ("numbered", "true")))
        self.ending = "zip" if self.zipped else "csv"
        # Made here alone: a task that outlives the job's failure must not make it again.
        self.pending = f"{self.folder}/_pending-{uuid.uuid4().hex}"
        files, pending = open_fs(self.pending)
        files.create_dir(pending, recursive=True)

    def write(self, iterator):
        from contextlib import nullcontext
        from itertools import chain

        from pyspark import TaskContext

        batches = (b for b in iterator if b.num_rows)
        first = next(batches, None)
        if first is None:
            return Written()
        number = f"{TaskContext.get().partitionId():06d}" if self.numbered else ""
        name = f"{self.prefix}{number}.{self.ending}"
        files, pending = open_fs(self.pending)
        path = f"{pending}/{uuid.uuid4().hex}"
        size = -(-first.num_rows // self.members)
        parts = [[first.slice(i * size, size)] for i in range(self.members)]
        parts[-1] = chain(parts[-1], batches)
        top = self.sep.join(self.columns) + self.newline if self.header else ""
        with files.open_output_stream(path) as f, (
                zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) if self.zipped else nullcontext()) as z:
            for i, part in enumerate(parts):
                with z.open(f"part{i}.csv", "w", force_zip64=True) if self.zipped else nullcontext(f) as out:
                    out.write(top.encode(self.charset))
                    for batch in part:
                        out.write(self._encoded(batch))
        return Written([(path, name)])

    def _encoded(self, batch) -> bytes:
        from pyarrow import csv

        out = io.BytesIO()
        csv.write_csv(batch, out, csv.WriteOptions(include_header=False, delimiter=self.sep, quoting_style="all_valid"))
        text = out.getvalue().decode("utf8")
        return (text if self.newline == "\n" else text.replace("\n", self.newline)).encode(self.charset)

    def commit(self, messages) -> None:
        parts = [p for m in messages if m is not None for p in m.parts]
        if len({name for _, name in parts}) < len(parts):
            self.abort(messages)
            raise ValueError(f"several partitions would be {parts[0][1]}; number them")
        files, folder = open_fs(self.folder)
        files.create_dir(folder, recursive=True)
        if self.overwrite:
            for old in list_archives(f"{self.folder}/{self.prefix}*.{self.ending}"):
                files.delete_file(open_fs(old)[1])
        for path, name in parts:
            files.move(path, f"{folder}/{name}")
        self.abort(messages)

    def abort(self, messages) -> None:
        from pyarrow import fs

        files, pending = open_fs(self.pending)
        if files.get_file_info(pending).type == fs.FileType.NotFound:
            return
        if isinstance(files, fs.LocalFileSystem):
            # By another name, tasks that still run add nothing while it is deleted.
            files.move(pending, f"{pending}-gone")
            pending = f"{pending}-gone"
        files.delete_dir(pending)


class ZipCsvSource(DataSource):
    @classmethod
    def name(cls):
        return "zip_csv"

    def reader(self, schema: StructType):
        return ZipCsvReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool):
        return ZipCsvWriter(schema, self.options, overwrite)
