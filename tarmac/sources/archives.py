"""Zipped monthly archives → raw rows, one task for each member.

Spark's CSV reader cannot open zip archives, and a deflated member is not splittable, but an
archive's members are independent. A Python data source plans them: the central directory of
each archive, a few kilobytes at its end, names the members, and each ``.csv`` member is one
input partition. Its task opens the archive by path through a seekable file handle, goes to
its member and streams it in row chunks as Arrow batches; neither the archive nor a member is
ever held whole. Only the asked columns are cut out of a line.
"""

from __future__ import annotations

import csv
import io
import itertools
import json
import sys
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from tarmac import schema as S

DEFAULT_CHUNK_ROWS = 50_000
REPLACE, STRICT = "replace", "strict"

# Schemes as Spark lists them and as Arrow names the same stores.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def _open_binary(path: str):
    """Seekable binary handle for a path as Spark lists it (``file:/…``, ``hdfs://…``, ``s3://…``)."""
    if path.startswith("file:"):
        local = path[len("file:"):]
        while local.startswith("//"):
            local = local[1:]
        return open(local, "rb")
    from pyarrow import fs as pafs

    scheme, _, rest = path.partition("://")
    filesystem, inner = pafs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}://{rest}")
    return filesystem.open_input_file(inner)


def csv_members(archive: zipfile.ZipFile, path: str = "") -> list[str]:
    members = [m for m in archive.namelist() if m.lower().endswith(".csv") and not m.startswith("__MACOSX/")]
    if not members:
        raise FileNotFoundError(f"No CSV found inside archive {path}")
    return members


def _header(line: str) -> list[str]:
    return next(csv.reader([line.rstrip("\r\n").lstrip("\ufeff")]), [])


@dataclass
class Member(InputPartition):
    """One CSV member of one archive."""

    path: str
    name: str


class MemberReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.archives = json.loads(options["archives"])
        self.columns = columns
        self.chunk_rows = int(options.get("chunkRows", DEFAULT_CHUNK_ROWS))
        self.errors = options.get("decode", REPLACE)

    def partitions(self) -> list[Member]:
        def members(path: str) -> list[Member]:
            with _open_binary(path) as handle, zipfile.ZipFile(handle) as archive:
                return [Member(path, name) for name in csv_members(archive, path)]

        with ThreadPoolExecutor(16) as pool:
            return [m for found in pool.map(members, self.archives) for m in found]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        """Rows of the member, by header name.

        As Spark's reader does in permissive mode, a line with fewer cells than the header is
        filled with nulls and cells beyond it are dropped; columns never shift.
        """
        csv.field_size_limit(sys.maxsize)
        schema = pa.schema([(c, pa.string()) for c in self.columns])
        with _open_binary(partition.path) as handle, zipfile.ZipFile(handle) as archive:
            with archive.open(partition.name) as raw:
                text = io.TextIOWrapper(raw, encoding="utf-8", errors=self.errors, newline="")
                header = _header(text.readline())
                missing = [c for c in S.RAW_COLUMNS if c not in header]
                if missing:
                    raise ValueError(f"{partition.path}:{partition.name} lacks columns {missing}")
                picks = [header.index(c) for c in self.columns]
                lines = (row for row in csv.reader(line.replace("\0", "") for line in text) if row)
                while chunk := list(itertools.islice(lines, self.chunk_rows)):
                    cells = [[(row[k] or None) if k < len(row) else None for row in chunk] for k in picks]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cells], schema=schema)


class ZipMembers(DataSource):
    """``spark.read.format("zip_members")``: CSV members of the archives listed, as JSON, in ``archives``."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> StructType:
        return S.RAW_SCHEMA

    def reader(self, schema: StructType) -> MemberReader:
        return MemberReader(dict(self.options), schema.names)


def read_archives(
    spark: SparkSession,
    path: str | list[str],
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    columns: list[str] | None = None,
    decode: str = REPLACE,
) -> DataFrame:
    """Raw rows from every zip archive under ``path`` (files, directories or globs).

    ``columns`` picks some of the raw columns; no other cell is kept or sent to the JVM. Bytes
    that are not UTF-8 become U+FFFD, as they do in plain files, and the intake gives such
    cells a reason; ``decode="strict"`` fails on them instead. An archive without a CSV member,
    or a member without one of the raw columns, fails.
    """
    if decode not in (REPLACE, STRICT):
        raise ValueError(f"decode must be {REPLACE!r} or {STRICT!r}")
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path")
    paths = sorted(r["path"] for r in listing.collect())  # names of files, as Spark's own file listing has them
    if not paths:
        return spark.createDataFrame([], S.RAW_SCHEMA).select(*(columns or S.RAW_COLUMNS))
    spark.dataSource.register(ZipMembers)
    wanted = StructType([StructField(c, StringType(), True) for c in columns or S.RAW_COLUMNS])
    reader = spark.read.format("zip_members").schema(wanted).option("archives", json.dumps(paths))
    return reader.option("chunkRows", chunk_rows).option("decode", decode).load()
