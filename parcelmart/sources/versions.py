"""Folders that change by whole versions.

A version is a small description (JSON) in ``_versions/<number>``, put there by
one rename, which fails if the number is taken: a reader sees all of a version
or nothing of it, and of two writers one is told. Data lies in folders of its
own that no version but the ones naming them refers to, so a failed write
leaves the versions as they were.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

VERSIONS = "_versions"


class Conflict(RuntimeError):
    """Another writer has taken the version's number."""


class Files:
    """Hadoop's file system of a folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        context = spark.sparkContext
        self._hadoop, conf = context._jvm.org.apache.hadoop.fs, context._jsc.hadoopConfiguration()
        self._gateway = context._gateway
        self.root = root.rstrip("/")
        path = self._hadoop.Path(self.root)
        self._fs = path.getFileSystem(conf)
        self._context = self._hadoop.FileContext.getFileContext(path.toUri(), conf)

    def path(self, name: str):
        return self._hadoop.Path(f"{self.root}/{name}")

    def names(self, name: str) -> list[str]:
        """Names below a folder; none if it does not exist."""
        path = self.path(name)
        return [status.getPath().getName() for status in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put_once(self, name: str, text: str) -> None:
        """A new file, whole at once; Conflict if there is one of that name."""
        unfinished = f"{VERSIONS}/.{uuid.uuid4().hex}"
        stream = self._fs.create(self.path(unfinished), False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        keep_existing = self._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            self._context.rename(self.path(unfinished), self.path(name), keep_existing)
        except Exception as error:
            self._fs.delete(self.path(unfinished), False)
            if "FileAlreadyExistsException" in str(error):
                raise Conflict(f"{self.root}/{name}") from None
            raise

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)


class Versions:
    """The versions of one folder; ``keep`` of them are held for readers that resolved them earlier."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 3) -> None:
        if keep < 1:
            raise ValueError("keep at least the current version")
        self.files, self.keep = Files(spark, root), keep

    def numbers(self) -> list[int]:
        return sorted(int(name) for name in self.files.names(VERSIONS) if name.isdigit())

    def describe(self, number: int) -> dict:
        return json.loads(self.files.read(f"{VERSIONS}/{number:012d}"))

    def current(self) -> tuple[int, dict]:
        """Number and description of the newest version; (0, {}) before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.describe(numbers[-1])) if numbers else (0, {})

    def new_folder(self, number: int) -> str:
        """Name of an unused data folder for a version to be written."""
        return f"data/{number:012d}-{uuid.uuid4().hex}"

    def commit(self, number: int, description: dict) -> None:
        """Make a version the current one; drop versions beyond ``keep`` and what only they use."""
        self.files.put_once(f"{VERSIONS}/{number:012d}", json.dumps(description))
        self.expire()

    def expire(self) -> None:
        """Drop all but the newest ``keep`` versions, and data that none of those uses.

        Data of a number that is taken and that no kept version uses is left over from an old version or from
        a failed or overtaken write, which can never become a version.
        """
        numbers = self.numbers()
        used = {name for number in numbers[-self.keep :] for name in folders(self.describe(number))}
        for number in numbers[: -self.keep]:
            self.files.delete(f"{VERSIONS}/{number:012d}")
        for name in self.files.names("data"):
            if f"data/{name}" not in used and int(name.split("-")[0]) <= numbers[-1]:
                self.files.delete(f"data/{name}")


def folders(description: dict) -> set[str]:
    """Data folders a version refers to: one, or one per part."""
    return set(description.get("parts", {}).values()) | ({description["folder"]} if "folder" in description else set())
