"""Questions to the file system a path belongs to, answered without a Spark job.

They go through the session's own Hadoop client, so they need a classic session, not Spark Connect.
"""

from __future__ import annotations

from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, a directory or anything matching a glob lies at ``path``."""
    system, hadoop_path = _file_system(spark, path)
    return bool(system.globStatus(hadoop_path))


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a visible, non-empty file lies at or below ``path``. Looks no further than the first."""
    system, hadoop_path = _file_system(spark, path)
    for found in system.globStatus(hadoop_path) or []:
        files = system.listFiles(found.getPath(), True)
        while files.hasNext():
            file = files.next()
            if file.getLen() > 0 and not file.getPath().getName().startswith(("_", ".")):
                return True
    return False


def visible_files(spark: SparkSession, path: str) -> list[tuple[str, str | None]]:
    """The visible files at or below ``path``, a glob allowed, each with the directory it was found from, if any."""
    system, hadoop_path = _file_system(spark, path)
    found = []
    for top in system.globStatus(hadoop_path) or []:
        base = top.getPath().toString()
        files = system.listFiles(top.getPath(), True)
        while files.hasNext():
            file = files.next().getPath().toString()
            below = file[len(base) :].strip("/").split("/") if top.isDirectory() else [file.rsplit("/", 1)[-1]]
            if not any(name.startswith(".") or name.startswith("_") and "=" not in name for name in below):
                found.append((file, base if top.isDirectory() else None))
    return sorted(found)


def files_below(spark: SparkSession, path: str) -> dict[str, dict[str, int]]:
    """The visible files below a directory, by their directory relative to it: each with its size."""
    system, hadoop_path = _file_system(spark, path)
    top, found = system.getFileStatus(hadoop_path).getPath().toString(), {}
    files = system.listFiles(hadoop_path, True)
    while files.hasNext():
        file = files.next()
        folder, _, name = file.getPath().toString()[len(top) :].strip("/").rpartition("/")
        if not name.startswith(("_", ".")):
            found.setdefault(folder, {})[name] = file.getLen()
    return found


def sizes_below(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """The sizes of the visible files below a directory, by their directory relative to it."""
    return {folder: list(sizes.values()) for folder, sizes in files_below(spark, path).items()}


def listed_bytes(df: DataFrame) -> int:
    """Total size of the files a scan has listed; nothing is listed again."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless one is there. Of several callers one gets True, where the store creates atomically."""
    system, hadoop_path = _file_system(spark, path)
    return bool(system.createNewFile(hadoop_path))


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or a directory with all it holds; whether it was there."""
    system, hadoop_path = _file_system(spark, path)
    return bool(system.delete(hadoop_path, True))


def names_below(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a directory; none where there is no such directory."""
    system, hadoop_path = _file_system(spark, path)
    if not system.exists(hadoop_path):
        return []
    return sorted(found.getPath().getName() for found in system.listStatus(hadoop_path))


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    system, hadoop_path = _file_system(spark, path)
    stream = system.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file unless one is there; whether it was written.

    It is written beside and then renamed, without replacing, so it appears with all it holds or not at all. Of several
    writers one gets True where the store renames atomically, as HDFS does.
    """
    system, hadoop_path = _file_system(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(hadoop_path.getParent(), f".{hadoop_path.getName()}-{uuid4().hex}")
    stream = system.create(beside, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), system.getConf())
    plain = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(beside, hadoop_path, plain)
    except Py4JJavaError as error:
        system.delete(beside, False)
        if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
            return False
        raise
    return True


def modified_at(spark: SparkSession, path: str) -> float:
    """When a file or directory was last modified, in seconds of the store's clock."""
    system, hadoop_path = _file_system(spark, path)
    return system.getFileStatus(hadoop_path).getModificationTime() / 1000
