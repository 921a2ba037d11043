"""Partition folders of a stored table: listing, latest value, and all-or-nothing replacement.

Only folder names are read here, never data.  A replacement is staged and checked beside the
table, then its partition folders are moved in; each old one is kept until all are in place.
A failed move puts all old folders back.  A journal beside the table lists the moves, so that
``recover`` does the same after a crash.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: The columns above the date in a date-partitioned table.
DATE_PARTITIONS = ("year", "month")


class ReplaceError(RuntimeError):
    """Partitions could not be replaced; those before them are still in place."""


class Folder:
    """A table's folder in any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.path = path.rstrip("/")
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)

    def rename(self, source: str, target: str) -> bool:
        """Moves a folder, given by its whole path, and makes the parents of its new place."""
        self._fs.mkdirs(self._hadoop(target).getParent())
        return self._fs.rename(self._hadoop(source), self._hadoop(target))

    def partitions(self, columns: Sequence[str]) -> dict[str, dict[str, str]]:
        """Value per column of each partition folder, by its path below the table."""
        found = self._fs.globStatus(self._at("/".join(f"{c}=*" for c in columns))) or []
        root = self._fs.makeQualified(self._hadoop(self.path)).toUri().getPath().rstrip("/")
        names = [s.getPath().toUri().getPath().removeprefix(f"{root}/") for s in found if s.isDirectory()]
        return {n: {c: unquote(part.partition("=")[2]) for c, part in zip(columns, n.split("/"), strict=True)} for n in names}

    def write_text(self, name: str, text: str) -> None:
        out = self._fs.create(self._at(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _at(self, name: str):
        return self._hadoop(f"{self.path}/{name}" if name else self.path)


def latest_partition(spark: SparkSession, path: str, columns: Sequence[str]) -> str | None:
    """The greatest value of the last partition column, from folder names alone.

    Dates are ISO text and compare as such; partitions without a value do not count.
    """
    values = [p[columns[-1]] for p in Folder(spark, path).partitions(columns).values()]
    return max((v for v in values if v != "__HIVE_DEFAULT_PARTITION__"), default=None)


def replace_partitions(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    write: Callable[[str], None],
    replaced: Callable[[dict[str, str]], bool],
    check: Callable[[DataFrame], None] | None = None,
    rename: Callable[[str, str], bool] | None = None,
) -> int:
    """Replace all partitions for which ``replaced`` holds by what ``write`` stores; returns how many were moved in.

    ``write`` gets the folder to stage in.  ``check`` gets the staged rows and raises to stop the
    replacement.  A staged partition that must not be replaced is an error.  A partition to be
    replaced that is not staged goes, and with no staged rows all of them go.
    """
    recover(spark, path)
    table, tag = Folder(spark, path), uuid.uuid4().hex
    stage, retired, journal = (f"{table.path}.{kind}-{tag}" for kind in ("stage", "old", "swap"))
    rename = rename or table.rename
    write(stage)
    new = list(Folder(spark, stage).partitions(columns).items())
    strange = [n for n, values in new if not replaced(values)]
    if strange:
        Folder(spark, stage).delete()
        raise ReplaceError(f"rows outside the partitions to replace, first {strange[0]}")
    if check is not None and new:
        try:
            check(spark.read.parquet(stage))
        except Exception:
            Folder(spark, stage).delete()
            raise
    old = [n for n, values in table.partitions(columns).items() if replaced(values)]
    Folder(spark, journal).write_text("", json.dumps({"old": old, "new": [n for n, _ in new]}))
    try:
        for name in old:
            if not rename(f"{table.path}/{name}", f"{retired}/{name}"):
                raise ReplaceError(f"{name} could not be set aside")
        for name, _ in new:
            if not rename(f"{stage}/{name}", f"{table.path}/{name}"):
                raise ReplaceError(f"{name} could not be moved in")
    except Exception:
        recover(spark, path)
        raise
    # From here on the new partitions count: without a journal nothing is put back.
    Folder(spark, journal).delete()
    for folder in (stage, retired):
        Folder(spark, folder).delete()
    return len(new)


def recover(spark: SparkSession, path: str) -> int:
    """Undo replacements that did not come to their end; returns how many.

    Writers of one table must not run at the same time, as with any overwrite.
    """
    table = Folder(spark, path)
    journals = table._fs.globStatus(table._hadoop(f"{table.path}.swap-*")) or []
    for status in journals:
        journal = status.getPath().toString()
        stage, retired = (Folder(spark, journal.replace(".swap-", f".{kind}-")) for kind in ("stage", "old"))
        moves = json.loads(Folder(spark, journal).read_text(""))
        # What is staged no more has been moved in, so it is the new one that stands in the table.
        for name in moves["new"]:
            if not stage.exists(name) and table.exists(name) and (name not in moves["old"] or retired.exists(name)):
                table.delete(name)
        for name in moves["old"]:
            if retired.exists(name) and not table.rename(f"{retired.path}/{name}", f"{table.path}/{name}"):
                raise ReplaceError(f"{name} is at {retired.path} and could not be moved back")
        for folder in (stage, retired, Folder(spark, journal)):
            folder.delete()
    return len(journals)


def unique_keys(keys: Sequence[str]) -> Callable[[DataFrame], None]:
    """A check that no key occurs twice or is null."""

    def check(staged: DataFrame) -> None:
        missing = F.count_if(F.expr(" OR ".join(f"{k} IS NULL" for k in keys)))
        counts = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), missing.alias("missing"))
        bad = counts.agg(F.count_if(F.col("n") > 1).alias("twice"), F.coalesce(F.sum("missing"), F.lit(0)).alias("missing")).first()
        if bad["twice"] or bad["missing"]:
            raise ReplaceError(f"{bad['twice']} keys of {', '.join(keys)} occur twice, {bad['missing']} rows lack a key")

    return check
