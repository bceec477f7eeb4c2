"""Shared scratch folders and a few Hadoop file-system calls.

Every path may live on any file system Spark can reach, so nothing here uses ``os``.
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from sluiceway.errors import SluicewayError


_own_folders: dict[str, str] = {}
_stored: dict[str, list[str]] = {}

#: Files that are renamed at a time.
MOVERS = 16


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with the machine, so the setting is then required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise SluicewayError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="sluiceway-")
    return _own_folders[application]


def unused() -> str:
    """A name nobody else has."""
    return uuid.uuid4().hex


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody else uses; it is not created."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{unused()}"


def stored(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, cut off from its plan.

    The files stay, as frames made of them may be read at any time, until ``remove_stored``.
    """
    folder = new_folder(df.sparkSession, "stored")
    df.write.parquet(folder)
    _stored.setdefault(df.sparkSession.sparkContext.applicationId, []).append(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove_stored(spark: SparkSession) -> int:
    """Removes what ``stored`` has written in this application, once no frame that reads it is needed; returns how many."""
    folders = _stored.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        remove(spark, folder)
    return len(folders)


def sibling(path: str, label: str) -> str:
    """An unused hidden path next to ``path``, so that a later rename stays on one file system."""
    parent, _, name = path.rstrip("/").rpartition("/")
    hidden = f"_{label}_{name}_{unused()}"
    return f"{parent}/{hidden}" if parent or path.startswith("/") else hidden


def _locate(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _locate(spark, path)
    return fs.exists(location)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, location = _locate(spark, path)
    return fs.exists(location) and fs.getFileStatus(location).isFile()


def size_in_bytes(spark: SparkSession, path: str) -> int:
    fs, location = _locate(spark, path)
    return fs.getContentSummary(location).getLength()


def remove(spark: SparkSession, path: str) -> None:
    fs, location = _locate(spark, path)
    fs.delete(location, True)


def move(spark: SparkSession, old: str, new: str) -> None:
    fs, source = _locate(spark, old)
    if not fs.exists(source) or not fs.rename(source, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise SluicewayError(f"cannot move {old} to {new}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, location = _locate(spark, path)
    fs.mkdirs(location)


def subfolders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders ``depth`` levels below a folder, relative to it; depth 0 is the folder itself."""
    fs, location = _locate(spark, path)
    level = [("", location)]
    for _ in range(depth):
        level = [
            (f"{relative}/{status.getPath().getName()}", status.getPath())
            for relative, folder in level
            for status in fs.listStatus(folder)
            if status.isDirectory() and "=" in status.getPath().getName()
        ]
    return [relative for relative, _ in level]


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Moves the files of a staged folder into a folder, below the same partitions.

    Spark gives files names that no other job gives, so none meets one that is there. The rename of the staged
    folder is the point of no return: from then on ``recover`` moves whatever a crash has left.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    arriving = f"{parent}/_arriving_{name}_{unused()}" if parent or path.startswith("/") else f"_arriving_{name}_{unused()}"
    move(spark, staged, arriving)
    _move_files(spark, arriving, path)


def _move_files(spark: SparkSession, folder: str, path: str) -> None:
    fs, location = _locate(spark, folder)
    root, names = str(fs.resolvePath(location)), []
    listed = fs.listFiles(location, True)
    while listed.hasNext():
        relative = str(listed.next().getPath())[len(root) :]
        if not relative.rpartition("/")[2].startswith(("_", ".")):
            names.append(relative)
    make_folder(spark, path)
    for subfolder in sorted({name.rpartition("/")[0] for name in names} - {""}):
        make_folder(spark, path.rstrip("/") + subfolder)
    with ThreadPoolExecutor(MOVERS) as movers:
        list(movers.map(lambda name: move(spark, folder + name, path.rstrip("/") + name), names))
    remove(spark, folder)


def _arriving(spark: SparkSession, path: str) -> list[str]:
    """Folders whose files a broken-off job was moving into a folder."""
    parent, _, name = path.rstrip("/").rpartition("/")
    fs, location = _locate(spark, parent or ("/" if path.startswith("/") else "."))
    if not fs.exists(location):
        return []
    return [str(s.getPath()) for s in fs.listStatus(location) if s.getPath().getName().startswith(f"_arriving_{name}_")]


def _retired(path: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_retired_{name}" if parent or path.startswith("/") else f"_retired_{name}"


def swap_in(spark: SparkSession, staged: str, path: str, depth: int = 0) -> None:
    """Puts the folder ``staged`` in the place of ``path``, or each of its partition folders.

    An old folder is moved aside before the new one is moved in and is removed after that, so its
    rows exist at every moment. ``recover`` puts it back if the swap was broken off in between.
    One job at a time may write a folder.
    """
    recover(spark, path)
    aside = _retired(path)
    for part in subfolders(spark, staged, depth):
        old, new, kept = path.rstrip("/") + part, staged + part, f"{aside}/depth{depth}{part}"
        if exists(spark, old):
            _make_parent(spark, kept)
            move(spark, old, kept)
        _make_parent(spark, old)
        try:
            move(spark, new, old)
        except Exception:
            recover(spark, path)
            raise
    remove(spark, aside)
    remove(spark, staged)


def recover(spark: SparkSession, path: str) -> None:
    """Ends a swap or a publication that was broken off: folders without a successor come back, files arrive."""
    for folder in _arriving(spark, path):
        _move_files(spark, folder, path)
    aside = _retired(path)
    if not exists(spark, aside):
        return
    fs, location = _locate(spark, aside)
    for status in fs.listStatus(location):
        name = status.getPath().getName()
        for part in subfolders(spark, f"{aside}/{name}", int(name.removeprefix("depth"))):
            old = path.rstrip("/") + part
            if not exists(spark, old):
                _make_parent(spark, old)
                move(spark, f"{aside}/{name}{part}", old)
    remove(spark, aside)


def _make_parent(spark: SparkSession, path: str) -> None:
    fs, location = _locate(spark, path)
    if location.getParent() is not None:
        fs.mkdirs(location.getParent())
