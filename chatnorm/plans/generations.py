"""Folders that are replaced as a whole: numbered generations, the newest complete one counts."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

from .session import file_system, remove_folder

_NAME = re.compile(r"g(\d{10})-[0-9a-f]{32}")
_MARK = "_COMPLETE"


class Generations:
    """Generations below ``root``. A generation is made in a folder of its own and becomes visible with one
    small file, so a reader sees the old or the new one and never a part. Old ones stay until the second
    :meth:`clean` after, for readers that began before the switch."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def names(self, folder: str) -> list[str]:
        """What lies in a folder; nothing where there is none."""
        fs, path = file_system(self.spark, folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def count(self, folder: str) -> int:
        """Data files of a folder."""
        return sum(not n.startswith(("_", ".")) for n in self.names(folder))

    def _all(self) -> list[str]:
        return [n for n in self.names(self.root) if _NAME.fullmatch(n)]

    def complete(self) -> list[str]:
        return [n for n in self._all() if _MARK in self.names(f"{self.root}/{n}")]

    def current(self) -> str | None:
        """Path of the newest complete generation."""
        complete = self.complete()
        return f"{self.root}/{complete[-1]}" if complete else None

    def new(self) -> str:
        """Path of a generation to be made, newer than all."""
        last = max((int(_NAME.fullmatch(n)[1]) for n in self._all()), default=0)
        return f"{self.root}/g{last + 1:010d}-{uuid.uuid4().hex}"

    def publish(self, generation: str) -> None:
        """Make a finished generation the current one."""
        fs, path = file_system(self.spark, f"{generation}/{_MARK}")
        fs.create(path, False).close()

    def clean(self, keep: int = 2) -> None:
        """Remove generations older than the newest ``keep`` complete ones, among them what failed runs left."""
        complete = self.complete()
        if not complete:
            return
        oldest = complete[-keep] if len(complete) >= keep else complete[0]
        for name in self._all():
            if name < oldest:
                remove_folder(self.spark, f"{self.root}/{name}")
