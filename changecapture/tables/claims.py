"""One run of a table at a time, across sessions and drivers.

A run claims its table by creating the next numbered file in a folder beside the table's files;
creating a file that must not exist yet is one step for the file system, so of several runs one
wins and the others raise. The claim is renewed while the run lasts. A claim that was not
renewed for a lease belongs to a driver that is gone: the next run revokes it and takes the
number after it.

Before a run shows anything to readers it creates the commit file of its claim, and whoever
revokes a claim creates that same file. So a run that lost its claim cannot commit any more, and
one that has committed is found by its successor as a run that broke off.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from changecapture.tables import parts

#: Seconds after which a claim that was not renewed is taken for given up.
LEASE = 600.0
_WIDTH = 12
_EXISTS = ("FileAlreadyExistsException", "already exists")


class TableBusy(RuntimeError):
    """Another run of the table is at work."""


class ClaimLost(RuntimeError):
    """The run was not heard of for a lease, and another one has taken its place."""


class _Folder:
    """Files of the claims on a mirror."""

    def __init__(self, spark: SparkSession, mirror: str):
        self.spark = spark
        self.path = f"{parts.files_root(spark, mirror)}/claims"
        found, self.files = parts.hadoop_path(spark, self.path)
        self.files.mkdirs(found)

    def at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def names(self) -> list[str]:
        found = self.files.listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(self.path))
        return sorted(s.getPath().getName() for s in found)

    def create(self, name: str) -> bool:
        """Create a file in one step; False if it is there."""
        path = self.files.makeQualified(self.at(name))
        jvm = self.spark._jvm
        try:
            if path.toUri().getScheme() == "file":
                # Hadoop's local file system looks first and creates then, which is two steps
                nio, none = jvm.java.nio.file, self.spark._sc._gateway.new_array
                there = nio.Paths.get(path.toUri())
                nio.Files.createFile(there, none(nio.attribute.FileAttribute, 0))
            else:
                self.files.create(path, False).close()
        except Py4JJavaError as error:
            if any(told in str(error.java_exception) for told in _EXISTS):
                return False
            raise
        return True

    def age(self, name: str) -> float:
        """Seconds since a file was renewed, by the clock that renews it."""
        changed = self.files.getFileStatus(self.at(name)).getModificationTime()
        return (self.spark._jvm.System.currentTimeMillis() - changed) / 1000

    def renew(self, name: str) -> None:
        self.files.setTimes(self.at(name), self.spark._jvm.System.currentTimeMillis(), -1)

    def delete(self, name: str) -> None:
        self.files.delete(self.at(name), False)


class Claim:
    """The right to run a table, until it is released or revoked."""

    def __init__(self, folder: _Folder, name: str, mirror: str):
        self.folder, self.name, self.mirror = folder, name, mirror
        self.committed = False

    def commit(self) -> None:
        """Settle that this run goes on to its end; raises if its claim was revoked."""
        if self.committed:
            return
        if not self.folder.create(f"{self.name}.commit"):
            raise ClaimLost(f"{self.mirror}: another run has taken the place of this one")
        self.committed = True

    def release(self) -> None:
        """Let the next run in. The last released claim stays, for its number."""
        for name in self.folder.names():
            if name.split(".")[0] < self.name:
                self.folder.delete(name)
        self.folder.create(f"{self.name}.done")


def _next(folder: _Folder, mirror: str, lease: float) -> str:
    """Number of the next claim; raises if the last one is alive."""
    names = folder.names()
    claims = [n for n in names if "." not in n]
    if not claims:
        return "0".zfill(_WIDTH)
    last = claims[-1]
    if f"{last}.done" not in names:
        if folder.age(last) < lease:
            raise TableBusy(f"{mirror}: another run is at work")
        folder.create(f"{last}.commit")
    return str(int(last) + 1).zfill(_WIDTH)


@contextmanager
def claimed(spark: SparkSession, mirror: str, lease: float = LEASE) -> Iterator[Claim]:
    """Claim a table for what is executed inside; raises ``TableBusy`` if another run has it.

    ``lease`` must be longer than any pause of a driver that is alive, and the same for all runs
    of a table. It is renewed three times as often.
    """
    folder = _Folder(spark, mirror)
    name = _next(folder, mirror, lease)
    if not folder.create(name):
        raise TableBusy(f"{mirror}: another run has begun at the same time")
    if max(n.split(".")[0] for n in folder.names()) > name:
        # others came and went since the folder was listed, and took this number's files along
        folder.delete(name)
        raise TableBusy(f"{mirror}: other runs have begun at the same time")
    claim, stop = Claim(folder, name, mirror), threading.Event()

    def renew() -> None:
        while not stop.wait(lease / 3):
            folder.renew(name)

    thread = threading.Thread(target=inheritable_thread_target(spark)(renew), daemon=True)
    thread.start()
    try:
        yield claim
    finally:
        stop.set()
        thread.join()
        claim.release()
