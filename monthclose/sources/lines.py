"""Raw lines of text files: plain, gzip and zip.

The ``value`` column holds the undecoded bytes of a line in a string column (Spark does not touch
them), and ``file`` the file name.
Plain files are split into blocks and read in parallel. A compressed file is one task; when
there are fewer of them than cores, the lines are spread out before the costly parsing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20


def raw_lines(
    spark: SparkSession,
    paths: Sequence[str],
    newline_only: bool = False,
    spread: bool = True,
    header: bool = False,
) -> DataFrame:
    """The lines of some files. ``newline_only`` keeps a lone carriage return inside a line; with ``header`` the first line
    of each file that is not empty is left out."""
    zips = [p for p in paths if p.lower().endswith(".zip")]
    texts = [p for p in paths if not p.lower().endswith(".zip")]
    parts = []
    if texts:
        lines = _lines_below_header(spark, texts) if header else _text_lines(spark, texts, newline_only)
        if spread and all(p.lower().endswith(".gz") for p in texts):
            # A path may be a folder of parts, so the files themselves are counted.
            lines = _spread(lines, len(lines.inputFiles()))
        parts.append(lines)
    if zips:
        lines = _zip_lines(spark, zips, header)
        parts.append(_spread(lines, len(zips)) if spread else lines)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _text_lines(spark: SparkSession, paths: Sequence[str], newline_only: bool) -> DataFrame:
    reader = spark.read
    if newline_only:
        reader = reader.option("lineSep", "\n")
    return reader.text(list(paths)).select("value", F.col("_metadata.file_name").alias("file"))


def _lines_below_header(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines by Spark's CSV reader, as it alone knows which line of a split file is the first. Every byte is one character,
    a whole line is one field, and a line that has the separator all the same comes whole as a malformed one."""
    lines = spark.read.schema("value string, whole string").options(
        sep="\x01", quote="", escape="", header=True, encoding="ISO-8859-1", columnNameOfCorruptRecord="whole",
        columnPruning=False, maxCharsPerColumn=-1,
    ).csv(list(paths))
    value = F.encode(F.coalesce("whole", "value", F.lit("")), "ISO-8859-1").cast("string")
    return lines.select(value.alias("value"), F.col("_metadata.file_name").alias("file"))


def _spread(lines: DataFrame, files: int) -> DataFrame:
    """Share out the lines of fewer compressed files than there are cores."""
    cores = lines.sparkSession.sparkContext.defaultParallelism
    return lines.repartition(cores) if files < cores else lines


def _zip_lines(spark: SparkSession, paths: Sequence[str], header: bool) -> DataFrame:
    """Lines of all members of each archive, in the order of the archive; one archive per task, streamed in blocks.

    Each member counts as a file of its own. A member that is a folder has no lines.
    """
    names = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "n int, path string")
    # Ranges of a running number, as a hash would put several archives into one task.
    listing = names.repartitionByRange(len(paths), "n").select("path")
    raw = listing.mapInArrow(_read_archives, "value binary, file string, first boolean")
    wanted = raw.where("not first") if header else raw
    return wanted.select(F.col("value").cast("string"), "file")


def _read_archives(batches: Iterator) -> Iterator:
    import zipfile

    import pyarrow as pa
    from pyarrow import fs

    def batch(lines: list[bytes], name: str, seen: bool):
        """A batch of lines; ``first`` marks the first one that is not empty, if the file had none before."""
        header = None if seen else next((i for i, line in enumerate(lines) if line), None)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(lines, pa.binary()),
                pa.array([name] * len(lines), pa.string()),
                pa.array([i == header for i in range(len(lines))], pa.bool_()),
            ],
            ["value", "file", "first"],
        )

    for paths in batches:
        for path in paths.column("path").to_pylist():
            if "://" in path or path.startswith("file:"):
                system, inner = fs.FileSystem.from_uri(path)
            else:
                system, inner = fs.LocalFileSystem(), path
            name = path.rstrip("/").rsplit("/", 1)[-1]
            with system.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive:
                members = [m for m in archive.infolist() if not m.is_dir()]
                for info in members:
                    label = name if len(members) == 1 else f"{name}/{info.filename}"
                    with archive.open(info) as member:
                        rest, seen = b"", False
                        while block := member.read(BLOCK_BYTES):
                            *lines, rest = (rest + block).split(b"\n")
                            if lines:
                                lines = [line.rstrip(b"\r") for line in lines]
                                yield batch(lines, label, seen)
                                seen = seen or any(lines)
                        if rest:
                            yield batch([rest.rstrip(b"\r")], label, seen)


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of one file, as raw text. Only the first block is opened."""
    row = raw_lines(spark, [path], spread=False).select("value").head()
    return row["value"] if row else None
