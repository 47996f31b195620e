"""Zipped CSV as a source (and, for fixtures, as a sink).

Spark's ``binaryFile`` source lists the archives (their contents aren't read);
tasks read the archives' directories and emit a row per member, dealt out
anew, whose task opens the archive, reads that member's byte range and unpacks
it as a stream of lines in bounded batches, which Spark's own ``from_csv``
parses with the given schema.  No archive and no member is ever whole in a
cell or in memory, so both may have any size (zip64).

A compressed member can't be split and is one task; a stored one is cut into
parts of ``PART_BYTES``, where a part holds the lines that begin in it (zip's
checksum is tested for members read in one part only).  Records must be one per
line, ended by a line feed (no quoted line breaks), as with the line-based
tools this replaces.  Archives are opened through the Arrow file system of their
URI; ``opener`` (path to a seekable binary file) stands in for other stores.
"""

from __future__ import annotations

import io
import shutil
import urllib.parse
import zipfile
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import local_path, materialize, ship_package

LINES_SCHEMA = "path string, member string, start long, line long, value string"
#: Lines, and bytes of them, in a batch.
BATCH_LINES, BATCH_BYTES = 65536, 8 << 20
#: A stored member's part; also the unpacked bytes that a task reads, about.
PART_BYTES = 64 << 20

#: ``at`` is the member's place in the directory (names may repeat); a part holds
#: the lines that begin in ``start`` to ``end``.
MEMBERS_SCHEMA = "path string, at long, member string, start long, end long"

Opener = Callable[[str], BinaryIO]


def _arrow(path: str):
    """The Arrow file system of a path, and the path there."""
    from pyarrow import fs as pafs

    plain = local_path(path)
    if plain != path or "://" not in path:
        return pafs.LocalFileSystem(), plain
    return pafs.FileSystem.from_uri(urllib.parse.quote(path, safe=":/"))


def open_seekable(path: str) -> BinaryIO:
    filesystem, name = _arrow(path)
    return filesystem.open_input_file(name)


def _members(opener: Opener, part_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                rows = []
                with opener(path) as raw, zipfile.ZipFile(raw) as zf:
                    for at, info in enumerate(zf.infolist()):
                        if info.is_dir():
                            continue
                        whole = info.compress_type != zipfile.ZIP_STORED or info.file_size <= part_bytes
                        step = info.file_size if whole else part_bytes
                        for start in range(0, info.file_size, step or 1):
                            rows.append((path, at, info.filename, start, min(start + step, info.file_size)))
                yield pd.DataFrame(rows, columns=["path", "at", "member", "start", "end"])
    return run


def part_lines(fh: BinaryIO, start: int, end: int) -> Iterator[bytes]:
    """The lines that begin at the places ``start`` to ``end`` of a file, without
    their line ends."""
    place = start
    if start:
        # The line that holds the byte before belongs to an earlier part.
        fh.seek(start - 1)
        place += len(fh.readline()) - 1
    while place < end and (x := fh.readline()):
        place += len(x)
        yield x.rstrip(b"\r\n")


def _lines(opener: Opener):
    def run(batches):
        import pyarrow as pa

        def batch(r, first, values):
            n = len(values)
            return pa.RecordBatch.from_arrays(
                [pa.array([r["path"]] * n), pa.array([r["member"]] * n), pa.array([r["start"]] * n, pa.int64()),
                 pa.array(range(first, first + n), pa.int64()), pa.array(values, pa.binary()).cast(pa.string())],
                names=["path", "member", "start", "line", "value"])

        held, raw, zf = None, None, None
        try:
            for b in batches:
                for r in b.to_pylist():
                    if r["path"] != held:
                        # Rows come sorted: an archive's directory is read once a task.
                        if zf is not None:
                            zf.close()
                            raw.close()
                        held, raw = r["path"], opener(r["path"])
                        zf = zipfile.ZipFile(raw)
                    with zf.open(zf.infolist()[r["at"]]) as member, io.BufferedReader(member, 1 << 20) as fh:
                        first, size, values = 0, 0, []
                        for x in part_lines(fh, r["start"], r["end"]):
                            values.append(x)
                            size += len(x)
                            if len(values) == BATCH_LINES or size >= BATCH_BYTES:
                                yield batch(r, first, values)
                                first, size, values = first + len(values), 0, []
                        if values:
                            yield batch(r, first, values)
        finally:
            if zf is not None:
                zf.close()
                raw.close()
    return run


def zip_members(spark: SparkSession, path: str, opener: Opener = open_seekable, part_bytes: int = PART_BYTES) -> DataFrame:
    """A row per member, or part of a stored member, of every archive under ``path``."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path")
    return files.mapInPandas(_members(opener, part_bytes), MEMBERS_SCHEMA)


def zip_lines(spark: SparkSession, path: str, opener: Opener = open_seekable, part_bytes: int = PART_BYTES) -> DataFrame:
    """Every text line of every member of every archive under ``path``; ``start`` is
    the place of the member's part and ``line`` counts within it."""
    members = materialize(zip_members(spark, path, opener, part_bytes), "zip-members")
    n, size = members.agg(F.count(F.lit(1)), F.sum(F.col("end") - F.col("start"))).first()
    # The rows are small whatever they stand for, so their number of tasks is fixed by what they stand for.
    tasks = max(1, min(n, -(-(size or 0) // part_bytes) * 2))
    dealt = members.repartition(tasks).sortWithinPartitions("path", "at", "start")
    return dealt.mapInArrow(_lines(opener), LINES_SCHEMA)


def read_zip_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
                 malformed: str = "raise", opener: Opener = open_seekable, part_bytes: int = PART_BYTES) -> DataFrame:
    """Parse zipped CSV members with an explicit, positional schema.

    The header line of each member and blank lines are skipped; empty fields
    become null.  A line that doesn't parse as the schema raises
    (``malformed="raise"``), is dropped (``"drop"``) or becomes a row with nulls
    (``"null"``).
    """
    if malformed not in ("raise", "drop", "null"):
        raise ValueError(malformed)
    ddl = schema if isinstance(schema, str) else schema.simpleString()[len("struct<"):-1].replace(":", " ")
    lines = zip_lines(spark, path, opener, part_bytes)
    if header:
        lines = lines.filter((F.col("line") > 0) | (F.col("start") > 0))
    lines = lines.filter(F.trim("value") != "")
    bad = "_malformed"
    parsed = lines.select(F.from_csv("value", f"{ddl}, {bad} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}).alias("r"))
    rows = parsed.select("r.*")
    if malformed == "drop":
        rows = rows.filter(F.col(bad).isNull())
    elif malformed == "raise":
        rows = rows.filter(F.col(bad).isNull() | F.raise_error(F.concat(F.lit("malformed line: "), F.col(bad))).cast("boolean"))
    return rows.drop(bad)


def _zip_parts(dest: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, root = _arrow(dest)
        out = []
        for pdf in batches:
            for path in pdf["path"]:
                name = path.rstrip("/").rsplit("/", 1)[-1]
                member = name if name.endswith(".csv") else name + ".csv"
                target = f"{root}/{name}.zip"
                with (open_seekable(path) as part, filesystem.open_output_stream(target) as fh,
                      zipfile.ZipFile(fh, "w", compression=zipfile.ZIP_DEFLATED) as zf,
                      zf.open(member, "w", force_zip64=True) as packed):
                    shutil.copyfileobj(part, packed, 1 << 20)
                out.append(target)
        yield pd.DataFrame({"archive": out})
    return run


def write_zip_csv(df: DataFrame, path: str) -> None:
    """Write headed CSV parts with Spark, then zip each part next to them.

    Each task streams the parts it is given through the Arrow file system of the
    destination URI; nothing passes through the driver.
    """
    ship_package(df.sparkSession)
    parts = f"{path.rstrip('/')}/_parts"
    df.write.mode("errorifexists").option("header", True).csv(parts)
    files = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(parts).select("path")
    files.mapInPandas(_zip_parts(path.rstrip("/")), "archive string").write.format("noop").mode("overwrite").save()
