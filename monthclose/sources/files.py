"""Files: the shared work folder, listing, and choosing the file of a month.

Only names are handled on the driver, and always through Hadoop's file system API, so that the same
code works on a local path, HDFS or an object store.
"""

from __future__ import annotations

import atexit
import fnmatch
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# File extensions in the order in which they are tried.
EXTENSIONS = (".zip", ".dat.gz", ".DAT", ".dat", ".prn", ".csv", ".csv.gz", ".parquet")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the shared folder the cluster names in ``spark.checkpoint.dir``.

    It is deleted when the application ends. A local temporary folder is used only where the
    setting is absent and Spark itself runs in this one process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        local = tempfile.mkdtemp(prefix=f"monthclose-{label}-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        return local
    path = f"{shared.rstrip('/')}/monthclose-{label}-{uuid.uuid4().hex[:12]}"
    fs, hadoop_path = _fs(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return hadoop_path.getFileSystem(conf), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file, and the folders above it."""
    fs, hadoop_path = _fs(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    fs.create(hadoop_path, True).close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, and the folders above it."""
    fs, hadoop_path = _fs(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    out = fs.create(hadoop_path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_small(spark: SparkSession, path: str) -> str:
    """A small text file."""
    fs, hadoop_path = _fs(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file, in one step where the file system can."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.rename(hadoop_path, _fs(spark, target)[1]):
        raise OSError(f"cannot rename {path} to {target}")


def list_names(spark: SparkSession, folder: str, hidden: bool = False) -> list[str]:
    """Names in a folder, sorted; hidden and marker names are left out unless asked for."""
    fs, hadoop_path = _fs(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    return sorted(n for n in names if hidden or not n.startswith((".", "_")))


class Folders:
    """Names of folders that are told apart: a name that is taken already, also in other case, gets a number.

    ``endings`` are what is put behind each name, ``taken`` names that are not to be used.
    """

    def __init__(self, *taken: str, endings: tuple[str, ...] = ("",)):
        self._taken, self._endings = {name.lower() for name in taken}, endings

    def name_of(self, label: str) -> str:
        name, n = label, 1
        while any((name + e).lower() in self._taken for e in self._endings):
            n += 1
            name = f"{label}~{n}"
        self._taken.update((name + e).lower() for e in self._endings)
        return name


def file_stem(name: str) -> str:
    """A file name without its extension; ``x.dat.gz`` loses both."""
    stem = name.rsplit(".", 1)[0] if "." in name else name
    return stem[:-4] if stem.lower().endswith(".dat") else stem


def resolve_files(names: list[str], pattern: str, multi: bool = False) -> list[str]:
    """The names a pattern stands for.

    An exact name is looked up by its stem in the order of EXTENSIONS. A wildcard pattern gives the
    last match by name, or with ``multi`` every match. A pattern without an extension is tried with
    each of them, and the last match is then taken from the last extension that has any.
    """
    if "*" in pattern or "?" in pattern:
        if pattern.lower().endswith(tuple(e.lower() for e in EXTENSIONS)):
            globs = [pattern]
        else:
            globs = [pattern + ext for ext in EXTENSIONS]
        found = [n for g in globs for n in sorted(names) if fnmatch.fnmatchcase(n, g)]
        if not found:
            raise FileNotFoundError(f"no file matches {pattern}")
        return found if multi else found[-1:]
    present = set(names)
    stem = file_stem(pattern)
    for ext in EXTENSIONS:
        if stem + ext in present:
            return [stem + ext]
    raise FileNotFoundError(f"no file {stem}.*")


def latest_files(names: DataFrame, patterns: list[str]) -> DataFrame:
    """DataFrame form for large listings: per wildcard pattern, the last matching name.

    One pass over ``names(name)`` with two aggregates per pattern and one row to shuffle per task; a
    pattern without a match is kept with NULL.
    """
    if not patterns:
        raise ValueError("no patterns")
    aggregates, pairs = [], []
    for i, pattern in enumerate(patterns):
        hit = F.col("name").like(_like(pattern))
        aggregates += [
            F.max(F.when(hit, F.col("name"))).alias(f"n{i}"),
            F.count_if(hit).alias(f"c{i}"),
        ]
        pairs += [F.lit(pattern), F.col(f"n{i}"), F.col(f"c{i}")]
    return (
        names.agg(*aggregates)
        .select(F.stack(F.lit(len(patterns)), *pairs).alias("pattern", "name", "matches"))
    )


def _like(pattern: str) -> str:
    """A wildcard pattern as a LIKE pattern."""
    for special in ("\\", "%", "_"):
        pattern = pattern.replace(special, "\\" + special)
    return pattern.replace("*", "%").replace("?", "_")
