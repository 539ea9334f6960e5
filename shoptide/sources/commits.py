"""Commits: which folders make up a view, one small file a version, beside the folders.

Data is written to folders of new names first; a commit then names those that count, by a file that is written aside and renamed to a name that
must not exist yet. So a reader sees the state of one commit whole, a writer that fails at any point leaves the last one as it is, and of two writers of
the same version one fails. Nothing is ever changed in place. A view has one writer at a time.

``prune`` removes folders that no kept commit names, also those of writers that failed. A reader opens files of the commit that it found, so
enough commits should be kept for the longest read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

_FOLDER = "_commits"


class Commits:
    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self.location = location.rstrip("/")
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.location).getFileSystem(self._conf)

    def _path(self, at: str):
        return self._jvm.org.apache.hadoop.fs.Path(at)

    def _listed(self, at: str) -> list[tuple[str, bool]]:
        """(name, is a folder) of what is at ``at``; nothing if it is not a folder."""
        path = self._path(at)
        if not self._fs.exists(path) or not self._fs.getFileStatus(path).isDirectory():
            return []
        return [(s.getPath().getName(), s.isDirectory()) for s in self._fs.listStatus(path)]

    def folders(self, of: str = "") -> list[str]:
        """Names of the folders below the view, or below one of its folders."""
        names = self._listed(f"{self.location}/{of}" if of else self.location)
        return sorted(name for name, folder in names if folder and not name.startswith(("_", ".")))

    def _files(self) -> list[str]:
        return sorted(n for n, folder in self._listed(f"{self.location}/{_FOLDER}") if n.endswith(".json") and not folder and not n.startswith("."))

    def _content(self, file: str) -> dict:
        stream = self._fs.open(self._path(f"{self.location}/{_FOLDER}/{file}"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self, below: int | None = None) -> tuple[int, dict] | None:
        """(version, content) of the newest commit, or of the newest one of a version smaller than ``below``."""
        for file in reversed(self._files()):
            version = int(file.split(".")[0])
            if below is None or version < below:
                return version, self._content(file)
        return None

    def commit(self, version: int, content: dict) -> None:
        """Make ``content`` the state of ``version``. A version committed before is followed by a newer state of it."""
        again = [int(f.split(".")[1]) for f in self._files() if int(f.split(".")[0]) == version]
        name = f"{version:020d}.{max(again, default=-1) + 1:06d}.json"
        aside = self._path(f"{self.location}/{_FOLDER}/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        out.write(bytearray(json.dumps(content), "utf-8"))
        out.close()
        # this rename does not replace
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        options = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context.rename(self._fs.makeQualified(aside), self._fs.makeQualified(self._path(f"{self.location}/{_FOLDER}/{name}")), options)

    def remove(self, of: str) -> None:
        self._fs.delete(self._path(f"{self.location}/{of}"), True)

    def prune(self, keep: int, paths) -> None:
        """Keep the newest ``keep`` commits, and of the folders those that ``paths(content)`` names for one of them: "folder", or "folder/part"."""
        files = self._files()
        for file in files[:-keep]:
            self.remove(f"{_FOLDER}/{file}")
        named = {path for file in files[-keep:] for path in paths(self._content(file))}
        whole = {path.split("/")[0] for path in named}
        for folder in self.folders():
            if folder not in whole:
                self.remove(folder)
            elif folder not in named:
                for part in self.folders(folder):
                    if f"{folder}/{part}" not in named:
                        self.remove(f"{folder}/{part}")
