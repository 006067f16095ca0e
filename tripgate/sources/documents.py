"""Small metadata documents on any Hadoop file system (K5, S7 for single objects).

Manifests and reports are single small JSON objects (indented, sorted keys, UTF-8). They are
written to a temporary name and renamed into place, so a reader sees the old or the new
document, never a partial one.

What several writers may decide at once (which batch is live) is a numbered log: document n + 1
comes into being only if there is none yet, whole, and is never changed. So of two writers that
both build on document n one succeeds and the other learns of it. The exclusive step is a hard
link on local disks and a rename without overwriting elsewhere; a store whose rename isn't
atomic must offer one that fails where the target exists.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, recursive))


def holds(spark: SparkSession, path: str, suffix: str | tuple[str, ...]) -> bool:
    """Whether a file below ``path`` ends with ``suffix`` (or one of several); the walk stops at the first one."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(suffix):
            return True
    return False


def _staged(spark: SparkSession, path: str, text: str):
    """(file system, final path, temporary path beside it that holds ``text``)."""
    fs, final = _fs(spark, path)
    tmp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{final.getName()}.{uuid.uuid4().hex}.tmp")
    fs.mkdirs(final.getParent())
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return fs, final, tmp


def _rename(spark: SparkSession, tmp, final, *options) -> None:
    jvm = spark.sparkContext._jvm
    ctx = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    chosen = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, len(options))
    for i, option in enumerate(options):
        chosen[i] = option
    ctx.rename(tmp, final, chosen)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write ``text`` to ``path`` atomically (temporary object + rename with overwrite)."""
    _, final, tmp = _staged(spark, path, text)
    _rename(spark, tmp, final, spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE)


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put ``text`` at ``path``, whole, if nothing is there; False if something is."""
    jvm = spark.sparkContext._jvm
    fs, final, tmp = _staged(spark, path, text)
    try:
        if fs.getScheme() == "file":
            local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(final), local(tmp))
        else:
            _rename(spark, tmp, final)
        return True
    except Py4JJavaError as failed:
        if "FileAlreadyExists" in failed.java_exception.getClass().getSimpleName():
            return False
        raise
    finally:
        fs.delete(tmp, False)


# ---- numbered logs -------------------------------------------------------------------------

def _numbered(folder: str, number: int) -> str:
    return f"{folder.rstrip('/')}/{number:010d}.json"


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below ``folder``."""
    fs, p = _fs(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def latest(spark: SparkSession, folder: str) -> tuple[int, dict | None]:
    """(number, document) of the last entry of a log; (0, None) before the first."""
    numbers = [int(n.removesuffix(".json")) for n in children(spark, folder) if n.endswith(".json") and not n.startswith(".")]
    return (max(numbers), load_json(spark, _numbered(folder, max(numbers)))) if numbers else (0, None)


def commit_after(spark: SparkSession, folder: str, number: int, doc: dict) -> bool:
    """Add the entry that follows ``number``; False if another writer has added one meanwhile."""
    return create_new(spark, _numbered(folder, number + 1), _as_text(doc))


def append(spark: SparkSession, folder: str, doc: dict) -> int:
    """Add an entry after whatever is the last one; its number."""
    while True:
        number, _ = latest(spark, folder)
        if commit_after(spark, folder, number, doc):
            return number + 1


def read_text(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        data = jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")


def _as_text(doc: dict) -> str:
    return json.dumps(doc, indent=2, sort_keys=True)


def save_json(spark: SparkSession, path: str, doc: dict) -> None:
    write_text(spark, path, _as_text(doc))


def load_json(spark: SparkSession, path: str) -> dict:
    return json.loads(read_text(spark, path))
