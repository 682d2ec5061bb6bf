"""Zipped landing: monthly archives → flight rows, as one Spark job.

Archives are a data source of their own (``zipped_csv``, Spark's Python data
source API): one partition per archive, whose first ``.csv`` member
(case-insensitive) is streamed from an open handle, so a task holds one chunk of
rows whatever the archive's size. Quoted commas and line breaks are data. Each
row carries its archive's own header, so archives may order their columns
differently. ``read_landing`` has each archive's task pick the schema's columns by
name, a chunk at a time and column by column, as looking names up in every row
costs several times the parsing; Spark then casts them. Sizes come from the zip directory at the archive's end: checking them extracts nothing.
Text that is no UTF-8 is replaced and counted (``bad_chars``).

The handle comes from pyarrow's file systems (local, HDFS and object stores).
Where the store is known to Spark only, an archive arrives as a ``binaryFile`` row
instead, which holds it in memory (2 GB at most).
"""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from itertools import islice
from urllib.parse import quote

import pyarrow as pa
from pyarrow import csv as pacsv
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from runway.operators.state import MIN_FILE_SIZE
from runway.sources.schema import FLIGHTS_SCHEMA, conform

CHUNK_ROWS = 2000  # CSV rows a task holds at once
BLOCK = 1 << 20  # bytes of CSV that Arrow's parser takes at once
ROW_SCHEMA = "path string, row_no long, names array<string>, fields array<string>, bad_chars long"
SIZE_SCHEMA = "path string, csv_bytes long, error string"
ROWS, SIZES, COLUMNS = "rows", "sizes", "columns"


def uri(path: str) -> str:
    """A Hadoop path as the URI that pyarrow takes."""
    scheme, rest = re.match(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(.*)$", path, re.S).groups()
    if scheme in (None, "file"):
        return "file://" + quote(re.sub(r"^//", "", rest) if rest.startswith("///") else rest)
    return f"{scheme}:{quote(rest)}"


def open_file(path: str):
    """A seekable handle; nothing is read yet."""
    system, where = pafs.FileSystem.from_uri(uri(path))
    return system.open_input_file(where)


def _member(handle) -> tuple[zipfile.ZipFile | None, zipfile.ZipInfo | None, str | None]:
    """An archive's first CSV member, or what is wrong with it."""
    try:
        archive = zipfile.ZipFile(handle)
    except (zipfile.BadZipFile, pa.ArrowInvalid):  # the latter for a seek before the start
        return None, None, "corrupt"
    for info in archive.infolist():
        if info.filename.lower().endswith(".csv"):
            return archive, info, None
    return archive, None, "no_csv"


def _size(path: str, handle) -> tuple[str, int, str | None]:
    _, info, error = _member(handle)
    return path, info.file_size if info else 0, error


def _chunks(handle, skip: int = 0):
    """(header, numbered CSV rows) of an archive, a chunk at a time, after ``skip`` rows."""
    archive, info, error = _member(handle)
    if error:
        return
    with archive.open(info) as raw:
        lines = csv.reader(io.TextIOWrapper(raw, "utf-8-sig", errors="replace", newline=""))
        names = [c.strip().lower() for c in next(lines, [])]
        numbered = islice(((n, fields) for n, fields in enumerate(lines, 1) if fields), skip, None)
        while chunk := list(islice(numbered, CHUNK_ROWS)):
            yield names, chunk


def _rows(path: str, handle):
    """CSV rows of an archive, a chunk at a time, with its header."""
    for names, chunk in _chunks(handle):
        yield [(path, n, names, [f if f != "" else None for f in fields], sum(f.count("\ufffd") for f in fields))
               for n, fields in chunk]


def _parsed(handle, columns: list[str]):
    """``_columns`` by Arrow's parser. What ``csv`` reads otherwise or more leniently raises
    ``ArrowInvalid``: rows of another width, text that is no UTF-8, a quote inside a field."""
    archive, info, error = _member(handle)
    if error:
        return
    with archive.open(info) as raw:
        names = [c.strip().lower() for c in next(csv.reader(io.TextIOWrapper(raw, "utf-8-sig", errors="replace", newline="")), [])]
    if len(names) < 2:
        raise pa.ArrowInvalid("no header of several columns")
    own = [str(i) for i in range(len(names))]
    at = {c: str(names.index(c)) for c in columns if c in names}
    if not at:
        raise pa.ArrowInvalid("none of the columns")
    with archive.open(info) as raw:
        found = pacsv.open_csv(
            raw, pacsv.ReadOptions(use_threads=False, block_size=BLOCK, column_names=own, skip_rows_after_names=1),
            pacsv.ParseOptions(newlines_in_values=True),
            pacsv.ConvertOptions(column_types=dict.fromkeys(own, pa.string()), include_columns=sorted(set(at.values()), key=int),
                                 strings_can_be_null=True, quoted_strings_can_be_null=True, null_values=[""]))
        schema = pa.schema([(c, pa.string()) for c in columns])
        for batch in found:
            arrays = [batch.column(at[c]) if c in at else pa.nulls(len(batch), pa.string()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _columns(handle, columns: list[str]):
    """The named columns of an archive's rows, a chunk at a time; an empty field and one
    that the row or the archive lacks is NULL."""
    done = 0
    try:
        for batch in _parsed(handle, columns):
            yield batch
            done += len(batch)
        return
    except pa.ArrowInvalid:  # the rest row by row
        pass
    schema = pa.schema([(c, pa.string()) for c in columns])
    for names, chunk in _chunks(handle, done):
        width = len(names)
        rows = [f if len(f) == width else (f + [""] * width)[:width] for _, f in chunk]
        fields = [[f or None for f in column] for column in zip(*rows)]
        arrays = [pa.array(fields[names.index(c)], pa.string()) if c in names else pa.nulls(len(rows), pa.string()) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


_ARROW = {ROWS: pa.schema([("path", pa.string()), ("row_no", pa.int64()), ("names", pa.list_(pa.string())),
                           ("fields", pa.list_(pa.string())), ("bad_chars", pa.int64())]),
          SIZES: pa.schema([("path", pa.string()), ("csv_bytes", pa.int64()), ("error", pa.string())])}


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _batches(path: str, handle, what: str, columns: list[str]):
    if what == COLUMNS:
        yield from _columns(handle, columns)
    else:
        for chunk in [[_size(path, handle)]] if what == SIZES else _rows(path, handle):
            yield _batch(chunk, _ARROW[what])


def _shape(what: str, columns: list[str]) -> str:
    """The schema of what is read."""
    return ROW_SCHEMA if what == ROWS else SIZE_SCHEMA if what == SIZES else ", ".join(f"`{c}` string" for c in columns)


class ZippedCsv(DataSource):
    """``spark.read.format("zipped_csv")``. Options: ``archives`` (a JSON list of paths) and
    ``what``: ``rows`` of the first CSV member, its ``columns`` of the names in the option
    ``columns`` (a JSON list), or ``sizes`` from the directories."""

    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def _asked(self) -> tuple[str, list[str]]:
        return self.options.get("what", ROWS), json.loads(self.options.get("columns", "[]"))

    def schema(self) -> str:
        return _shape(*self._asked())

    def reader(self, schema) -> DataSourceReader:
        return _Archives(json.loads(self.options["archives"]), *self._asked())


class _Archives(DataSourceReader):
    def __init__(self, paths: list[str], what: str, columns: list[str]):
        self.paths, self.what, self.columns = paths, what, columns

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition):
        with open_file(partition.value) as handle:
            yield from _batches(partition.value, handle, self.what, self.columns)


def _opened(path: str) -> bool:
    try:
        open_file(path).close()
        return True
    except (OSError, pa.ArrowException):
        return False


def _read(spark: SparkSession, root: str, glob: str, what: str, columns: list[str] = ()) -> DataFrame:
    paths = [r.path for r in archive_inventory(spark, root, glob).select("path").orderBy("path").collect()]  # a row an archive
    columns = list(columns)
    if not paths:
        return spark.createDataFrame([], _shape(what, columns))
    if not _opened(paths[0]):
        return _through_spark(spark, root, glob, what, columns)
    spark.dataSource.register(ZippedCsv)
    return (spark.read.format("zipped_csv").option("archives", json.dumps(paths)).option("what", what)
            .option("columns", json.dumps(columns)).load())


def _through_spark(spark: SparkSession, root: str, glob: str, what: str, columns: list[str] = ()) -> DataFrame:
    """The same from archives that only Spark can read, each in memory."""
    def run(batches):
        for found in batches:
            for path, content in zip(found.column("path"), found.column("content")):
                yield from _batches(path.as_py(), pa.BufferReader(content.as_buffer()), what, columns)

    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root))
    return files.select("path", "content").mapInArrow(run, _shape(what, columns))


def archive_inventory(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """(path, modificationTime, length) of every archive, without reading contents."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True).load(root).select("path", "modificationTime", "length"))


def archive_rows(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """SRC-06: the CSV rows of each archive's first CSV member with its header's names."""
    return _read(spark, root, glob, ROWS)


def landing_outcomes(spark: SparkSession, root: str, min_size: int = MIN_FILE_SIZE, glob: str = "*.zip") -> DataFrame:
    """SRC-07 per archive: ``missing`` when the archive or its CSV is below the minimum, or
    the archive is corrupt / has no CSV; else ``success``."""
    j = archive_inventory(spark, root, glob).join(_read(spark, root, glob, SIZES), "path", "left")
    outcome = (F.when(F.col("length") < min_size, "missing")
               .when(F.col("error").isNotNull(), "missing")
               .when(F.col("csv_bytes") < min_size, "missing")
               .otherwise("success"))
    return j.select("path", "length", "csv_bytes", "error", outcome.alias("outcome"))


def read_landing(spark: SparkSession, root: str, schema=FLIGHTS_SCHEMA, glob: str = "*.zip") -> DataFrame:
    """Flight rows of all archives: each schema column by its name in the archive's own
    header (NULL where the archive lacks it or the field is empty), cast to its type."""
    return conform(_read(spark, root, glob, COLUMNS, schema.names), schema)
