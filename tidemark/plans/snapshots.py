"""Versioned builds behind one pointer.

A build writes all its tables into a folder of its own; readers do not see it.
One entry put into the log (``streaming/commits.py``) makes it the current
snapshot, whole: a build that dies between two tables changes nothing, and a
reader that has opened a snapshot keeps it while the next one is published.
The entry also says up to which load of the staging table the build went, so
that a snapshot's staging rows and reports belong together.

``expire`` removes snapshots that are no longer current, and folders of builds
that never came to an end, once they are old enough for no reader to hold them.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

from tidemark.streaming.commits import CommitLog


class NoSnapshotError(FileNotFoundError):
    """No build has been published below this root."""


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/_snapshots")

    @property
    def folder(self) -> str:
        return f"{self.root}/snapshots"

    def new(self) -> str:
        """A folder for a build; nobody reads it before it is published."""
        return f"{self.folder}/{uuid.uuid4().hex[:12]}"

    def current(self) -> dict:
        """The newest published entry: folder (a full path), loads, published."""
        entries = self.log.entries()
        if not entries:
            raise NoSnapshotError(f"no published build below {self.root}")
        return entries[-1] | {"folder": f"{self.folder}/{entries[-1]['folder']}"}

    def publish(self, path: str, loads: int) -> int:
        """Make a finished folder the current snapshot and return its number;
        loads: how many loads of the staging table it was built from.  Of
        builds published at the same time each gets a number, the last one is current."""
        while True:
            number = len(self.log.entries())
            entry = {"folder": path.rsplit("/", 1)[1], "loads": loads, "published": int(time.time())}
            if self.log.put(number, entry):
                return number

    def expire(self, older_than_seconds: float = 7 * 86_400) -> int:
        """Remove folders other than the current snapshot that were replaced, or
        last written to, so long ago; return their number."""
        entries = self.log.entries()
        keep = entries[-1]["folder"] if entries else None
        replaced = {a["folder"]: b["published"] for a, b in zip(entries, entries[1:])}
        gone, now = 0, time.time()
        for name in self.log.files.names(self.folder):
            since = replaced.get(name) or self.log.files.changed(f"{self.folder}/{name}")
            if name != keep and now - since >= older_than_seconds:
                self.log.files.delete(f"{self.folder}/{name}")
                gone += 1
        return gone
