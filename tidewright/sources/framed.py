"""Framed logs as a Spark data source, and the audit of their frames.

A frame is: magic, version, payload length, checksum, payload. Files are read in
byte ranges; a range owns the frames whose first byte lies in it, and searches for
the next magic after anything that is no frame. What lies between frames is found
afterwards from the frames' places.

    spark.dataSource.register(FramedLog)
    spark.read.format("framed_log").option("path", "...").load()
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# The format (fixed values).
MAGIC = b"WAL1"
VERSION = 1
HEADER = "<4sBII"
HEADER_SIZE = struct.calcsize(HEADER)
MAX_PAYLOAD = 16 * 1024 * 1024
SPLIT = 64 * 1024 * 1024
SCHEMA = "file STRING, file_size BIGINT, offset BIGINT, end BIGINT, status STRING, payload BINARY"
#: A day with a larger share of bytes outside frames is refused.
MAX_SKIPPED = 0.01


def encode(payload: bytes) -> bytes:
    """One frame."""
    head = struct.pack("<BI", VERSION, len(payload))
    return MAGIC + head + struct.pack("<I", zlib.crc32(head + payload)) + payload


@dataclass
class Range(InputPartition):
    file: str
    size: int
    start: int
    end: int


class FramedLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "framed_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FramedReader(self.options)


class FramedReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.split = int(options.get("splitBytes", SPLIT))

    def _open(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def partitions(self) -> list[Range]:
        from pyarrow import fs

        store, path = self._open()
        info = store.get_file_info(path)
        files = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path, recursive=True))
        files = [f for f in files if f.type == fs.FileType.File and f.size]
        return [Range(f.path, f.size, at, min(at + self.split, f.size)) for f in files for at in range(0, f.size, self.split)] or [Range("", 0, 0, 0)]

    def read(self, part: Range) -> Iterator[tuple]:
        if not part.size:
            return
        store, _ = self._open()
        with store.open_input_file(part.file) as f:
            # a frame may begin in the last bytes of the range; its payload is read where it is not at hand
            data = f.read_at(min(part.end + HEADER_SIZE, part.size) - part.start, part.start)
            at = data.find(MAGIC)
            while 0 <= at < part.end - part.start:
                offset, step = part.start + at, 1
                if at + HEADER_SIZE > len(data):
                    yield part.file, part.size, offset, part.size, "incomplete", None
                else:
                    _, version, length, crc = struct.unpack_from(HEADER, data, at)
                    end = offset + HEADER_SIZE + length
                    if version != VERSION:
                        yield part.file, part.size, offset, offset, "bad_version", None
                    elif length <= MAX_PAYLOAD and end > part.size:
                        yield part.file, part.size, offset, part.size, "incomplete", None
                    elif length <= MAX_PAYLOAD:
                        body = data[at + HEADER_SIZE : at + HEADER_SIZE + length]
                        if len(body) < length:
                            body = f.read_at(length, offset + HEADER_SIZE)
                        if zlib.crc32(data[at + 4 : at + 9] + body) == crc:
                            yield part.file, part.size, offset, end, "ok", body
                            step = HEADER_SIZE + length
                at = data.find(MAGIC, at + step)


def frames(found: DataFrame, width: int = SPLIT) -> DataFrame:
    """The frames that count: those in order, without what lies inside another, up to a wrong version.

    How far the frames before one reach is a running maximum in two levels: over the frames
    that begin in one range of ``width`` bytes, and over the ranges of a file.
    """
    ok_end = F.when(F.col("status") == "ok", F.col("end"))
    placed = found.withColumn("_range", F.floor(F.col("offset") / width))
    ranges = placed.groupBy("file", "_range").agg(F.max(ok_end).alias("_end"))
    earlier = W.partitionBy("file").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select("file", "_range", F.coalesce(F.max("_end").over(earlier), F.lit(0)).alias("_before"))
    inside = W.partitionBy("file", "_range").orderBy("offset", "end").rowsBetween(W.unboundedPreceding, -1)
    placed = placed.join(ranges, ["file", "_range"]).withColumn("reached", F.greatest(F.coalesce(F.max(ok_end).over(inside), F.lit(0)), F.col("_before")))
    wrong = placed.where((F.col("status") == "bad_version") & (F.col("offset") == F.col("reached")))
    # one row for each file that has a wrong version
    placed = placed.join(wrong.groupBy("file").agg(F.min("offset").alias("stop")), "file", "left")
    kept = placed.where((F.col("offset") >= F.col("reached")) & (F.col("stop").isNull() | (F.col("offset") <= F.col("stop"))))
    return kept.select(*found.columns, "reached", "stop")


def audit(found: DataFrame, width: int = SPLIT) -> DataFrame:
    """file, frames_ok, skipped_bytes, resyncs, truncated_tail, wrong_version, refused for each file."""
    f = frames(found.drop("payload"), width)
    gap = F.col("offset") - F.col("reached")
    ok = F.col("status") == "ok"
    out = f.groupBy("file").agg(
        F.first("file_size").alias("size"), F.count_if(ok).alias("frames_ok"), F.coalesce(F.sum(F.when(ok, gap)), F.lit(0)).alias("inner"), F.count_if(ok & (gap > 0)).alias("inner_resyncs"),
        F.coalesce(F.max(F.when(ok, F.col("end"))), F.lit(0)).alias("last"), F.min("stop").alias("stop"), F.max(F.when(F.col("status") == "incomplete", F.col("offset"))).alias("cut"),
    )
    tail = F.when(F.col("stop").isNotNull(), 0).otherwise(F.col("size") - F.col("last"))
    truncated = (F.col("tail") > 0) & ((F.col("tail") < HEADER_SIZE) | (F.coalesce(F.col("cut"), F.lit(-1)) == F.col("last")))
    out = out.withColumn("tail", tail).withColumn("truncated_tail", truncated)
    skipped = F.col("inner") + F.col("tail")
    return out.select(
        "file", "frames_ok", skipped.alias("skipped_bytes"), (F.col("inner_resyncs") + ((F.col("tail") > 0) & ~F.col("truncated_tail")).cast("int")).alias("resyncs"), "truncated_tail",
        F.col("stop").isNotNull().alias("wrong_version"), (skipped > MAX_SKIPPED * F.col("size")).alias("refused"),
    )


def log_rows(found: DataFrame, decode: Callable[[Column], Column], start: int, end: int, at: str = "funding_time", width: int = SPLIT) -> DataFrame:
    """The rows of a log that may still be written to, with ``at`` in a half-open window.

    ``decode`` makes a struct of a payload, or null where it cannot. What lies behind a
    wrong version, torn frames and payloads that are none are passed over; a broken end
    never fails the read.
    """
    rows = frames(found, width).where("status = 'ok'").select("file", "offset", decode(F.col("payload")).alias("r"))
    return rows.select("file", "offset", "r.*").where((F.col(at) >= start) & (F.col(at) < end))
