"""Records of text files whose quoted fields may hold line breaks, read in parallel.

A file is read by lines in as many splits as it has. Whether a split begins inside a quoted field follows from the number of quotes
ahead of it, so the first pass adds up the quotes of each split, and a running sum over that small table (a row for each split)
gives the state in which each one begins. The second pass puts lines together to records, each task on its own; the pieces
of a record that a cut went through meet afterwards, and only they are shuffled.

A quote is taken to open or close a field wherever it stands. A field that is never closed takes the rest of its file.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'
#: Bytes of lines that a Python worker is handed, and takes apart, at once; a longer line comes alone.
BATCH_BYTES = 4 << 20


def split_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(value, path, file, block): raw lines in the order of their file within each split, with the split's first byte."""
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    return lines.select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


def cut_splits(lines: DataFrame) -> DataFrame:
    """(path, block, owner): the splits that begin inside a quoted field, and the split in which that record begins."""
    odd = (F.octet_length("value") - F.octet_length(F.replace("value", F.lit(QUOTE), F.lit("")))) % 2
    # A split lies in one task, so the last of its lines is that of the file.
    splits = lines.groupBy("path", "block").agg(F.sum(odd).alias("odd"), F.last(odd).alias("last"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before) % 2, F.lit(0)) == 1
    # Inside a field, a record can begin after any line with an odd number of quotes but the last.
    begins = ~F.col("inside") | (F.col("odd") - F.col("last") > 0)
    owner = F.last(F.when(F.col("begins"), F.col("block")), ignorenulls=True).over(before)
    return (splits.withColumn("inside", inside).withColumn("begins", begins).withColumn("owner", owner)
            .where("inside").select("path", "block", "owner"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the lines of each part have few bytes, however long or many they are."""
    for lines in batches:
        part = np.cumsum(pc.binary_length(lines.column("value")).to_numpy(zero_copy_only=False), dtype=np.int64) // BATCH_BYTES
        for start, end in pairwise([0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lines)]):
            yield lines.slice(start, end - start)


def _pieces(batches: Iterator[pa.RecordBatch], header: bool) -> Iterator[pa.RecordBatch]:
    """Whole records, and pieces of those that begin or end in another split.

    (file, path, owner, block, whole, record): ``owner`` is the split in which the record begins.
    """
    names = ["file", "path", "owner", "block", "whole", "record"]
    at = None  # split
    held: list[bytes] = []
    owner, inside, skip = 0, False, False

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def leftover() -> list[tuple]:
        return [(at[2], at[0], owner, at[1], False, b"\n".join(held))] if held else []

    for lines in _slices(batches):
        values = lines.column("value")
        odd = (pc.count_substring(values, pattern=QUOTE).to_numpy() & 1).astype(bool)
        text, paths, files = values.to_pylist(), lines.column("path").to_pylist(), lines.column("file").to_pylist()
        blocks, owners = lines.column("block").to_pylist(), lines.column("owner").to_pylist()
        change = np.array([paths[k] != paths[k - 1] or blocks[k] != blocks[k - 1] if k else True for k in range(len(text))], bool)
        out: list[tuple] = []
        for k in range(len(text)):
            if change[k] and (at is None or at[:2] != (paths[k], blocks[k])):
                if at:
                    out += leftover()
                held, at = [], (paths[k], blocks[k], files[k])
                inside = owners[k] is not None
                owner, first = owners[k] if inside else blocks[k], inside
                skip = header and blocks[k] == 0
            held.append(text[k])
            inside ^= bool(odd[k])
            if not inside:
                record = b"\n".join(held)
                if first:
                    out.append((at[2], at[0], owner, at[1], False, record))
                elif skip and record.strip(b"\r"):
                    skip = False
                else:
                    out.append((at[2], at[0], owner, at[1], True, record))
                held, owner, first = [], at[1], False
        yield batch(out)
    if at:
        yield batch(leftover())


def whole_records(spark: SparkSession, paths: Sequence[str], header: bool = False) -> DataFrame:
    """(value, file): the undecoded text of each record, without its last line break. Empty ones are left out, and with ``header`` the
    first of each file.

    The setting for the bytes of Arrow batches stays: the frame is run later."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    lines = split_lines(spark, paths)
    cut = cut_splits(lines).persist()
    some = not cut.isEmpty()
    marked = lines.join(F.broadcast(cut), ["path", "block"], "left") if some else lines.withColumn("owner", F.lit(None).cast("long"))
    pieces = marked.select(F.col("value").cast("binary"), "path", "file", "block", "owner").mapInArrow(
        lambda batches: _pieces(batches, header), "file string, path string, owner long, block long, whole boolean, record binary")
    text = F.col("record").cast("string")
    if some:
        joined = pieces.where("NOT whole").groupBy("path", "owner").agg(
            F.first("file").alias("file"), F.array_sort(F.collect_list(F.struct("block", text.alias("record")))).alias("parts"))
        found = pieces.where("whole").select(text.alias("value"), "file").unionByName(
            joined.select(F.array_join("parts.record", "\n").alias("value"), "file"))
    else:  # what is left open goes to the end of its file
        found = pieces.select(text.alias("value"), "file")
    raw = F.col("value").cast("binary")
    short = F.substring(raw, F.lit(1), F.octet_length(raw) - 1).cast("string")
    found = found.withColumn("value", F.when(F.col("value").endswith("\r"), short).otherwise(F.col("value")))
    return found.where("value <> ''")
