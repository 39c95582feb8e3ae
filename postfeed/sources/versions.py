"""A table of immutable files with a log of versions.

A version is a list of files. A commit writes new files, then the list of the files that its version has, then the
version's entry in the log; that last step is one rename, and until it has happened every reader sees the version
before. Deleting rewrites only the files that hold a row to delete; all others are carried over by name. A commit
has an id of the caller's choice and takes effect once however often it is repeated.

    table/data/<folder>/part-*.parquet    rows
    table/files/<folder>/part-*.parquet   the files of a version, with their row counts
    table/log/<version>.json              one entry per version
    table/applied/<hash of commit id>     the version of a commit
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postfeed.session import materialise, path_exists

FILES = T.StructType([T.StructField("file", T.StringType()), T.StructField("n", T.LongType())])

# Files listed in one part of a version's list, and how often a commit that lost the race for a version is tried again.
LIST_PART = 100_000
ATTEMPTS = 20


class Conflict(RuntimeError):
    """Another commit took the version."""


@dataclass(frozen=True)
class Version:
    """An entry of the log: ``added`` and ``removed`` count files, ``rows`` and ``files`` what the version has."""

    version: int
    commit: str
    listing: str
    rows: int
    files: int
    added: int
    removed: int


class VersionedTable:
    """Rows of one schema below ``path``. Every method acts at once; ``read`` gives a DataFrame pinned to a version."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path = spark, path.rstrip("/")
        # Files do not keep what is required of a column.
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])

    # ---- the log ----

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{path}")

    def _files(self):
        target = self._hadoop("log")
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        fs, folder = self._files(), self._hadoop("log")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _read_text(self, path: str) -> str:
        stream = self._files().open(self._hadoop(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_text(self, path: str, text: str) -> None:
        stream = self._files().create(self._hadoop(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def version(self, number: int | None = None) -> Version | None:
        """An entry of the log, without a number the last one; None for an empty log and for version 0, before the first."""
        if number is None:
            known = self.versions()
            if not known:
                return None
            number = known[-1]
        if number == 0:
            return None
        return Version(**json.loads(self._read_text(f"log/{number:012d}.json")))

    @staticmethod
    def _mark(commit: str) -> str:
        return f"applied/{hashlib.sha256(commit.encode()).hexdigest()}"

    def applied(self, commit: str) -> int | None:
        """The version that a commit made, None if it has not happened. Only the last entry can lack its mark."""
        head = self.version()
        if head and head.commit == commit:
            return head.version
        mark = self._mark(commit)
        return int(self._read_text(mark)) if path_exists(self.spark, f"{self.path}/{mark}") else None

    def _publish(self, entry: Version) -> None:
        """The entry becomes the next version by a rename that fails if there is such a version."""
        draft = f"log/draft-{uuid.uuid4().hex}"
        self._write_text(draft, json.dumps(asdict(entry)))
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._hadoop("").toUri(), self.spark._jsc.hadoopConfiguration())
        plain = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._hadoop(draft), self._hadoop(f"log/{entry.version:012d}.json"), plain)
        except Exception as error:
            self._files().delete(self._hadoop(draft), False)
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"version {entry.version} of {self.path} is taken") from error
            raise

    # ---- rows ----

    def files(self, version: int | None = None) -> DataFrame:
        """``file``, below the table's folder, and ``n``, its rows, of a version."""
        entry = self.version(version)
        if entry is None or not entry.files:
            return self.spark.createDataFrame([], FILES)
        return self.spark.read.schema(FILES).parquet(f"{self.path}/{entry.listing}")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, without a number of the one that is last now."""
        # Spark keeps the names of a table's files on the driver in any case.
        return self._rows([r.file for r in self.files(version).select("file").collect()])

    def _rows(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{name}" for name in names])

    def _file(self) -> Column:
        return F.regexp_extract("_metadata.file_path", r"(data/[^/]+/[^/]+)$", 1)

    def _write(self, df: DataFrame) -> DataFrame:
        """New files with the rows, and the list of those that have any; counts come from the files' footers."""
        wrong = {f.name for f in self.schema} ^ set(df.columns)
        if wrong:
            raise ValueError(f"columns differ from the table's: {sorted(wrong)}")
        folder = f"data/{uuid.uuid4().hex}"
        df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]).write.parquet(f"{self.path}/{folder}")
        return self._listed(folder)

    def _listed(self, folder: str) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}")
        return materialise(rows.groupBy(self._file().alias("file")).agg(F.count(F.lit(1)).alias("n")), "files")

    def holding(self, victims: DataFrame, on: str = "id", version: int | None = None) -> list[str]:
        """The files of a version with a row that ``victims`` lists; only the column ``on`` is read."""
        low, high = victims.agg(F.min(on), F.max(on)).first()
        if low is None:
            return []
        # Files whose footers exclude the range of the victims are not read further.
        keys = self.read(version).where(F.col(on).between(F.lit(low), F.lit(high))).select(on, self._file().alias("file"))
        return [r.file for r in keys.join(victims.select(on), on, "left_semi").select("file").distinct().collect()]

    # ---- commits ----

    def commit(self, commit: str, append: DataFrame | None = None, delete: DataFrame | None = None, on: str = "id", replace: bool = False) -> Version:
        """A version without the rows that ``delete`` lists and with those of ``append``, or with these alone.

        Rows are deleted if ``delete`` has their value of ``on``; a null is never deleted. Rows of ``append`` are not
        looked at by ``delete``. A commit that has happened is not repeated, whatever it is given then; its version
        is returned. If others commit meanwhile, the deletion is done again on theirs; appended rows are written
        once. What a commit that breaks off has written is in no version.
        """
        done = self.applied(commit)
        if done is not None:
            return self.version(done)
        added = self._write(append) if append is not None else self.spark.createDataFrame([], FILES)
        victims = materialise(delete.where(F.col(on).isNotNull()).select(on).distinct(), "victims") if delete is not None else None
        for attempt in range(ATTEMPTS):
            before = self.version()
            try:
                return self._attempt(commit, before, added, victims, on, replace)
            except Conflict:
                done = self.applied(commit)
                if done is not None:
                    return self.version(done)
                time.sleep(min(2.0, 0.05 * 2**attempt))
        raise Conflict(f"{commit}: {ATTEMPTS} times another commit was first")

    def _attempt(self, commit: str, before: Version | None, added: DataFrame, victims: DataFrame | None, on: str, replace: bool) -> Version:
        number = before.version if before else 0
        old = self.files(number) if before else self.spark.createDataFrame([], FILES)
        gone: list[str] = []
        if replace:
            kept = old.limit(0)
        else:
            gone = self.holding(victims, on, number) if victims is not None and before else []
            kept = old
            if gone:
                kept = old.join(self.spark.createDataFrame([(name,) for name in gone], "file string"), "file", "left_anti")
                added = added.unionByName(self._write(self._rows(gone).join(victims, on, "left_anti")))
        return self._entry(commit, before, kept, added)

    def _entry(self, commit: str, before: Version | None, kept: DataFrame, added: DataFrame) -> Version:
        """The version of the files in ``kept`` and ``added``, published after ``before``."""
        number = before.version if before else 0
        listing = f"files/{uuid.uuid4().hex}"
        now = kept.unionByName(added)
        n_files, n_new = now.count(), added.count()
        now.repartition(1 + n_files // LIST_PART).write.parquet(f"{self.path}/{listing}")
        rows = self.spark.read.schema(FILES).parquet(f"{self.path}/{listing}").agg(F.sum("n")).first()[0] or 0
        entry = Version(number + 1, commit, listing, rows, n_files, n_new, (before.files if before else 0) - (n_files - n_new))
        if before:
            self._write_text(self._mark(before.commit), str(before.version))
        self._publish(entry)
        self._write_text(self._mark(commit), str(entry.version))
        return entry

    def append(self, df: DataFrame, commit: str) -> Version:
        return self.commit(commit, append=df)

    def delete(self, victims: DataFrame, commit: str, on: str = "id") -> Version:
        return self.commit(commit, delete=victims, on=on)

    def replace(self, df: DataFrame, commit: str) -> Version:
        """All rows anew, which ``df`` may take from the table: no file of an older version is touched."""
        return self.commit(commit, append=df, replace=True)

    def compact(self, commit: str, rows_per_file: int, order: str | None = None) -> Version | None:
        """A version of the same rows in which the small files, under half of ``rows_per_file`` rows, are put together.

        New files have about that many rows, by range of ``order`` if given; all others are carried over. So the
        number of files is bounded by the rows, however many commits made them. With fewer than two small files
        nothing is done. Commits that happen meanwhile are kept; a small file that one of them has rewritten makes
        the compaction start again.
        """
        done = self.applied(commit)
        if done is not None:
            return self.version(done)
        small, added = None, None
        for attempt in range(ATTEMPTS):
            before = self.version()
            listed = self.files(before.version if before else 0)
            # Names of files, which Spark keeps on the driver to read the table.
            there = {r.file: r.n for r in listed.collect()}
            if small is None or not set(small) <= set(there):
                small = [name for name, n in there.items() if 2 * n < rows_per_file]
                if len(small) < 2:
                    return before
                parts = -(-sum(there[name] for name in small) // rows_per_file)
                rows = self._rows(small)
                added = self._write(rows.repartitionByRange(parts, order) if order else rows.repartition(parts))
            names = self.spark.createDataFrame([(name,) for name in small], "file string")
            try:
                return self._entry(commit, before, listed.join(names, "file", "left_anti"), added)
            except Conflict:
                time.sleep(min(2.0, 0.05 * 2**attempt))
        raise Conflict(f"{commit}: {ATTEMPTS} times another commit was first")

    def history(self) -> DataFrame:
        """The entries of the log in order of version."""
        rows = [tuple(asdict(self.version(v)).values()) for v in self.versions()]
        return self.spark.createDataFrame(rows, "version long, commit string, listing string, rows long, files long, added long, removed long").drop("listing")

    def vacuum(self, keep: int = 10, older_than_s: float = 7 * 24 * 3600) -> int:
        """Deletes entries before the last ``keep``, and folders of files and lists that no remaining version has.

        Only folders written before ``older_than_s`` seconds go, as a commit under way has files that no version has
        yet. A folder with one file in use stays whole. Marks of commits stay, so that they still count as done.
        """
        known = self.versions()
        kept = [self.version(v) for v in known[-keep:]]
        fs, used = self._files(), {f"{v.listing}" for v in kept}
        for v in kept:
            used |= {f"data/{r.folder}" for r in self.files(v.version).select(F.split("file", "/")[1].alias("folder")).distinct().collect()}
        for number in known[:-keep]:
            fs.delete(self._hadoop(f"log/{number:012d}.json"), False)
        latest, gone = (time.time() - older_than_s) * 1000, 0
        for kind in ("data", "files"):
            folder = self._hadoop(kind)
            for status in fs.listStatus(folder) if fs.exists(folder) else []:
                name = f"{kind}/{status.getPath().getName()}"
                if name not in used and status.getModificationTime() < latest:
                    fs.delete(status.getPath(), True)
                    gone += 1
        return gone
