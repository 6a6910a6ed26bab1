"""Where checkpoints and working tables go, and the few file-system calls the library needs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, set as the checkpoint folder.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        place = tempfile.mkdtemp(prefix="terrace-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(place)
    return place


def new_dir(spark: SparkSession, name: str) -> str:
    """A path nobody else uses, in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/terrace/{name}-{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at, hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, at, _ = _fs(spark, path)
    return fs.exists(at)


def leaf_dirs(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Folders ``depth`` levels below ``path``, relative to it."""
    fs, at, hadoop = _fs(spark, path)
    root = fs.makeQualified(at).toString().rstrip("/") + "/"
    found = fs.globStatus(hadoop.Path(at, "/".join(["*=*"] * depth))) if depth else []
    return [s.getPath().toString()[len(root) :] for s in found if s.isDirectory()]


def read_text(spark: SparkSession, path: str) -> str:
    fs, at, _ = _fs(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def swap_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: write beside it, then rename over it."""
    fs, at, hadoop = _fs(spark, path)
    beside = hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    context.rename(fs.makeQualified(beside), fs.makeQualified(at), options)


def hidden_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` that begin with a dot."""
    fs, at, _ = _fs(spark, path)
    found = fs.listStatus(at) if fs.exists(at) else []
    return [s.getPath().getName() for s in found if s.isDirectory() and s.getPath().getName().startswith(".")]


def rename(spark: SparkSession, old: str, new: str) -> bool:
    """Rename a folder to a name that is free."""
    fs, at, hadoop = _fs(spark, old)
    return fs.rename(at, hadoop.Path(new))
