"""Tables as immutable folders and one pointer per version.

``data/`` holds folders that are written once and never changed, ``_versions/`` one small
file per version that names the folders of each frame. A version comes into being when its
pointer file appears under its number: the file is written beside and then renamed, and the
rename fails if the number is taken. Whoever reads sees the newest pointer and
the complete folders it names; a writer that dies at any step leaves folders that no
pointer names. Several frames can change in one commit.

The rename must be refused if its target exists, as HDFS and local folders do; a
store without such a rename needs a single writer.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ROWS = "rows"


class VersionConflict(RuntimeError):
    """Another writer has committed since the version this commit was based on."""


@dataclass(frozen=True)
class Version:
    """``folders`` and ``schemas`` (JSON) by frame name; number 0 is the empty table before any commit."""

    number: int
    folders: dict[str, list[str]]
    schemas: dict[str, str]


class VersionedTable:
    """A folder of versions. Readers need no lock; of two writers the later one fails and may retry."""

    def __init__(self, spark: SparkSession, path: str, format: str = "parquet"):
        self.spark, self.path, self.format = spark, path.rstrip("/"), format
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def current(self) -> Version:
        """The newest version."""
        numbers = self._numbers()
        return self.version(max(numbers)) if numbers else Version(0, {}, {})

    def version(self, number: int) -> Version:
        if number == 0:
            return Version(0, {}, {})
        stream = self._files().open(self._path(self._pointer(number)))
        try:
            said = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(number, said["folders"], said["schemas"])

    def exists(self, name: str = ROWS) -> bool:
        return name in self.current().folders

    def read(self, name: str = ROWS, version: int | None = None) -> DataFrame:
        """A frame of the newest version, or of an older one that has not been vacuumed.

        Columns that a folder was written without are NULL.
        """
        at = self.current() if version is None else self.version(version)
        if name not in at.folders:
            raise ValueError(f"{self.path} has no frame {name!r} in version {at.number}")
        schema = T.StructType.fromJson(json.loads(at.schemas[name]))
        paths = [f"{self.path}/{folder}" for folder in at.folders[name]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.format(self.format).schema(schema).load(paths)

    def commit(
        self,
        replace: Mapping[str, DataFrame] | None = None,
        append: Mapping[str, DataFrame] | None = None,
        based_on: int | None = None,
        drop: Sequence[str] = (),
    ) -> Version:
        """Write the given frames and make them the next version, all or nothing.

        The frames may read this table. Frames in ``drop`` are left out of the next version. ``based_on`` names the version they were derived from (default: the
        newest now); if another commit has come between, nothing changes and ``VersionConflict`` is raised.
        """
        replace, append = dict(replace or {}), dict(append or {})
        if replace.keys() & append.keys():
            raise ValueError("a frame is either replaced or appended to")
        base = self.current() if based_on is None else self.version(based_on)
        folders = {name: list(f) for name, f in base.folders.items()}
        schemas = dict(base.schemas)
        for name, df in {**replace, **append}.items():
            known = schemas.get(name) if name in append else None
            # checked before anything is written
            schemas[name] = _merged(known, df.schema).json() if known else df.schema.json()
        for name, df in {**replace, **append}.items():
            kept = folders.get(name, []) if name in append else []
            folders[name] = [*kept, self._write(df)]
        for name in drop:
            del folders[name], schemas[name]
        return self._publish(Version(base.number + 1, folders, schemas))

    def vacuum(self, keep: int = 1, older_than_seconds: float = 86_400) -> int:
        """Delete what only versions before the last ``keep`` name; returns the folders deleted.

        Folders of commits under way are named by no pointer yet, so young folders stay.
        """
        numbers = sorted(self._numbers())
        kept = {f for n in numbers[-keep:] for names in self.version(n).folders.values() for f in names}
        files, deleted = self._files(), 0
        if files.exists(self._path("data")):
            for status in files.listStatus(self._path("data")):
                young = status.getModificationTime() / 1000 > time.time() - older_than_seconds
                if f"data/{status.getPath().getName()}" not in kept and not young:
                    files.delete(status.getPath(), True)
                    deleted += 1
        for n in numbers[:-keep]:
            files.delete(self._path(self._pointer(n)), False)
        return deleted

    def _write(self, df: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        df.write.format(self.format).save(f"{self.path}/{folder}")
        return folder

    def _publish(self, version: Version) -> Version:
        files, beside = self._files(), self._path(f"_versions/.{uuid.uuid4().hex}")
        out = files.create(beside, False)
        try:
            out.write(json.dumps({"folders": version.folders, "schemas": version.schemas}).encode())
        finally:
            out.close()
        self._rename(beside, self._path(self._pointer(version.number)))
        return version

    def _rename(self, source, target) -> None:
        context = self._hadoop.FileContext.getFileContext(target.toUri(), self._conf)
        options = self.spark._sc._gateway.new_array(self._hadoop.Options.Rename, 0)
        try:
            context.rename(source, target, options)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                self._files().delete(source, False)
                raise VersionConflict(f"{target.toString()} exists: commit again from the newest version") from None
            raise

    def _numbers(self) -> list[int]:
        files, folder = self._files(), self._path("_versions")
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return [int(name) for name in names if name.isdecimal()]

    def _pointer(self, number: int) -> str:
        return f"_versions/{number:012d}"

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def _files(self):
        return self._hadoop.Path(self.path).getFileSystem(self._conf)


def _merged(known: str, fresh: T.StructType) -> T.StructType:
    """The stored schema with new columns at its end; a column keeps its type."""
    stored = T.StructType.fromJson(json.loads(known))
    types = {f.name: f.dataType for f in stored}
    for f in fresh:
        if types.get(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} is stored as {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    added = [f for f in fresh if f.name not in types]
    return T.StructType([T.StructField(f.name, f.dataType) for f in [*stored, *added]])
