"""Versioned folders: each write makes a new one, readers take the newest.

A table can then be rewritten from itself, and a failed write leaves the old one in place. A version
is written under a name of its own and gets its number last; if another writer has taken that number
meanwhile, what was written is based on an old version, and the write fails.

Who gives a version its number holds a claim on it for that moment: a file with the writer's name and
an end of its validity. A claim whose writer died runs out, and the next writer takes its place. This
needs a store in which a file is made, or a folder renamed, by one of several writers only, as on HDFS,
local disks and stores with real folders. On plain object stores such as s3a let one writer at a time
update a table.
"""

import json
import re
import time
import uuid

from pyspark.sql import SparkSession

_NAME = re.compile(r"v(\d{8})")
#: Seconds that a claim is valid for, and after which what a writer left behind is nobody's.
LEASE_SECONDS, ABANDONED_SECONDS = 600, 86_400


class VersionTaken(RuntimeError):
    """Another writer made the next version first."""


def folder_of(spark: SparkSession, path: str):
    """(store, path) of a path, as Hadoop has them."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def read_text(spark: SparkSession, path: str) -> str:
    store, target = folder_of(spark, path)
    stream = store.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a file that isn't there yet; fails if it is."""
    store, target = folder_of(spark, path)
    stream = store.create(target, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _versions(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """(number, complete) of each version under ``root``."""
    store, folder = folder_of(spark, root)
    if not store.exists(folder):
        return []
    found = []
    for status in store.listStatus(folder):
        if name := _NAME.fullmatch(status.getPath().getName()):
            marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            found.append((int(name[1]), store.exists(marker)))
    return sorted(found)


def _path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/v{number:08d}"


def complete_versions(spark: SparkSession, root: str) -> list[str]:
    """The paths of the complete versions, from the first to the newest."""
    return [_path(root, number) for number, done in _versions(spark, root) if done]


def latest_version(spark: SparkSession, root: str) -> str | None:
    complete = complete_versions(spark, root)
    return complete[-1] if complete else None


def next_version(spark: SparkSession, root: str) -> str:
    """The version that a write which begins now may become."""
    versions = _versions(spark, root)
    return _path(root, versions[-1][0] + 1 if versions else 1)


def new_folder(root: str) -> str:
    """Where a version is written before it has a number."""
    return f"{root.rstrip('/')}/_writing-{uuid.uuid4().hex}"


def _holder(spark: SparkSession, claim: str) -> tuple[str | None, float]:
    """The writer that holds a claim, and until when; none and 0 if there is no claim (any more)."""
    store, target = folder_of(spark, claim)
    try:
        made = store.getFileStatus(target).getModificationTime() / 1000
        text = read_text(spark, claim)
    except Exception:
        return None, 0.0
    try:
        held = json.loads(text)
    except ValueError:  # its writer has not finished it
        held = {}
    return held.get("writer"), held.get("until", made + LEASE_SECONDS)


def _hold(spark: SparkSession, claim: str, writer: str) -> None:
    """Make the claim, or take over one that has run out."""
    for last in (False, True):
        try:
            write_text(spark, claim, json.dumps({"writer": writer, "until": time.time() + LEASE_SECONDS}))
            return
        except Exception as error:
            _, until = _holder(spark, claim)
            if last or until > time.time():
                raise VersionTaken(f"{claim} is held by another writer") from error
            # Of the writers that find it run out, one moves it away.
            store, target = folder_of(spark, claim)
            name = f"{claim}-{uuid.uuid4().hex}"
            _, aside = folder_of(spark, name)
            if store.exists(target) and store.rename(target, aside):
                if _holder(spark, name)[1] > time.time():  # another one has done so, and this is its claim
                    store.rename(aside, target)
                    raise VersionTaken(f"{claim} is held by another writer") from error
                store.delete(aside, False)


def publish(spark: SparkSession, written: str, version: str) -> None:
    """Make what was written the given version, unless there is one already."""
    store, target = folder_of(spark, version)
    _, source = folder_of(spark, written)
    root, _, name = version.rpartition("/")
    claim, writer = f"{root}/_claim-{name}", uuid.uuid4().hex
    try:
        _hold(spark, claim, writer)
    except VersionTaken:
        store.delete(source, True)
        raise
    try:
        if store.exists(target):
            store.delete(source, True)
            raise VersionTaken(f"{version} was made by another writer")
        if _holder(spark, claim)[0] != writer:
            store.delete(source, True)
            raise VersionTaken(f"the claim on {version} ran out")
        if not store.rename(source, target):
            raise OSError(f"cannot rename {written} to {version}")
    finally:
        if _holder(spark, claim)[0] == writer:
            store.delete(folder_of(spark, claim)[1], False)


def expire_versions(spark: SparkSession, root: str, keep: int = 3) -> None:
    """Delete all but the newest ``keep`` complete versions, incomplete ones older than those, and what
    writers left behind a day ago."""
    versions = _versions(spark, root)
    complete = [number for number, done in versions if done]
    oldest = complete[-keep] if len(complete) >= keep else 0
    store, folder = folder_of(spark, root)
    for number, _ in versions:
        if number < oldest:
            store.delete(folder_of(spark, _path(root, number))[1], True)
    if not store.exists(folder):
        return
    for status in store.listStatus(folder):
        left = status.getPath().getName().startswith(("_writing-", "_claim-"))
        if left and status.getModificationTime() / 1000 < time.time() - ABANDONED_SECONDS:
            store.delete(status.getPath(), True)
