"""Versioned manifests: what a folder of files means, committed whole, one version after another."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Someone else committed the version first."""


class Manifest:
    """manifest-00000001.json, manifest-00000002.json, ...: the last one counts. A version is written aside
    and renamed to a name that must not exist, so readers see whole versions and the slower of two
    writers fails. Files that no version names are what failed runs left, and are never read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder)))
        return sorted(int(m[1]) for m in (re.fullmatch(r"manifest-(\d{8})\.json", n) for n in names) if m)

    def load(self, version: int | None = None):
        """(version, value); (0, None) where nothing was committed."""
        found = self.versions()
        if not found:
            return 0, None
        version = version or found[-1]
        text = self.spark.read.option("wholetext", True).text(f"{self.folder}/manifest-{version:08d}.json").first()[0]
        return version, json.loads(text)

    def commit(self, version: int, value) -> int:
        """`value` as the version after `version`."""
        target = self._path(f"{self.folder}/manifest-{version + 1:08d}.json")
        draft = self._path(f"{self.folder}/.draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        finally:
            stream.close()
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise Conflict(f"version {version + 1} of {self.folder} exists")
        return version + 1
