"""Tables that change at one instant (SK1-SK4, SK9, ST2).

A table is a folder of Parquet segments and a folder of versions.  A version is
a small text file that names the segments in order, and for each the rows of
earlier segments it replaces: those of a scope value from a date on.  Reading
is a union of the segments, each without what later ones replace, a filter on
scope and date that reaches the scan; a segment is range-clustered by both, so
files outside are skipped.

A write puts its segment beside the others, where no version names it, and
then adds a version by a rename that fails if the version exists.  Readers see
the table before or after, also while a write runs, fails or is repeated; of
two writers at once, one fails.  "Delete from a date on, then append" costs the
batch, not the days or files it replaces.  (The store's rename must be atomic,
as HDFS and local file systems have it.)

Replaced rows stay in their files until the table is compacted, which a write
does by itself once there are MOST_SEGMENTS; `vacuum` deletes what the newest
versions no longer name.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.session import materialise

MOST_SEGMENTS = 16
Start = str | dt.date | None


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # Versions.

    def _file(self, name: str):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self._conf)

    def versions(self) -> list[int]:
        folder, fs = self._file("versions")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n[1:]) for n in names if n.startswith("v"))

    def exists(self) -> bool:
        return bool(self.versions())

    def manifest(self, version: int | None = None) -> tuple[int, dict]:
        """The newest version's number and content, or of the one given; number
        0 and no segments before the first write."""
        if version is None:
            found = self.versions()
            if not found:
                return 0, {"segments": [], "previous": [], "batches": {}}
            version = found[-1]
        path, fs = self._file(f"versions/v{version:012d}")
        stream = fs.open(path)
        try:
            return version, json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, before: int, manifest: dict) -> None:
        """Version before + 1 appears by a rename; FileExistsError if another
        writer was first."""
        draft, fs = self._file(f"drafts/{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        target, _ = self._file(f"versions/v{before + 1:012d}")
        fs.mkdirs(target.getParent())
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        no_overwrite = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(context.makeQualified(draft), context.makeQualified(target), no_overwrite)
        except Exception as error:
            fs.delete(draft, False)
            if "already exist" in str(error).lower():
                raise FileExistsError(f"{self.path}: version {before + 1} was written meanwhile") from error
            raise

    # Segments.

    def _segment(self, df: DataFrame, cluster: Sequence[str], replaces: dict | None = None) -> dict:
        folder = f"data/{uuid.uuid4().hex}"
        if cluster:
            columns = [F.col(f"`{c}`") for c in cluster]
            df = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
        df.write.mode("error").parquet(f"{self.path}/{folder}")
        return {"folder": folder, "cluster": list(cluster), "replaces": replaces}

    @staticmethod
    def _stays(by: dict) -> Column:
        """Whether a later segment leaves a row of an earlier one."""
        day = F.to_date(f"`{by['date']}`")
        cases = []
        for values, start in by["starts"]:
            other = [~F.col(f"`{c}`").cast("string").eqNullSafe(F.lit(v)) for c, v in zip(by["scope"], values)]
            cases.append(reduce(lambda a, b: a | b, other, (day < F.lit(dt.date.fromisoformat(start))) | day.isNull()))
        return reduce(lambda a, b: a & b, cases)

    def _rows(self, segments: list[dict]) -> DataFrame:
        frames = []
        for i, segment in enumerate(segments):
            rows = self.spark.read.parquet(f"{self.path}/{segment['folder']}")
            later = [s["replaces"] for s in segments[i + 1 :] if s["replaces"]]
            frames.append(rows.where(reduce(lambda a, b: a & b, map(self._stays, later))) if later else rows)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest version, or of the one given."""
        found, manifest = self.manifest(version)
        if not found:
            raise FileNotFoundError(self.path)
        return self._rows(manifest["segments"])

    def previous(self) -> DataFrame | None:
        """The generation before the last `rotate`; None before the second."""
        segments = self.manifest()[1]["previous"]
        return self._rows(segments) if segments else None

    # Writes.

    def overwrite(self, df: DataFrame, cluster: Sequence[str] = ()) -> None:
        """SK1: the table becomes `df`."""
        before, manifest = self.manifest()
        self.commit(before, manifest | {"segments": [self._segment(df, cluster)]})

    def rotate(self, df: DataFrame, cluster: Sequence[str] = ()) -> None:
        """SK9: what was current is the previous generation, `df` is current;
        both change at once."""
        before, manifest = self.manifest()
        self.commit(before, manifest | {"segments": [self._segment(df, cluster)], "previous": manifest["segments"]})

    def append(self, df: DataFrame, cluster: Sequence[str] = ()) -> None:
        before, manifest = self.manifest()
        self.commit(before, manifest | {"segments": [*manifest["segments"], self._segment(df, cluster)]})

    def replace_from(self, df: DataFrame, date_col: str, start: Start | Mapping[object, Start] = None,
                     scope: Sequence[str] = (), batch: tuple[str, int] | None = None) -> dict[tuple, dt.date] | None:
        """SK3/SK4: the table becomes (old rows with date < start) and the batch,
        separately for each `scope` value (e.g. country) that the batch has.

        `start` is one date, or a date for each scope value, or by default the
        batch's least date in that scope.  Rows with a NULL date are never
        replaced, and batch rows dated before `start`, or not at all, are added.
        An empty batch changes nothing.  `batch` names a stream and its batch
        number: a batch that is in the table already is skipped.  Returns the
        starts used, or None if nothing changed.  A row for each scope value
        comes to the driver."""
        before, manifest = self.manifest()
        if batch and manifest["batches"].get(batch[0], -1) >= batch[1]:
            return None
        rows = materialise(df, "replace-batch")
        found = rows.groupBy(*[F.col(f"`{c}`") for c in scope]).agg(F.min(F.to_date(date_col)).alias("_least"), F.count("*").alias("_n"))
        found = found.select("*", F.array(*[F.col(f"`{c}`").cast("string") for c in scope]).alias("_text")).where("_n > 0").collect()
        if not found:
            return None

        def given(key: tuple, least: dt.date | None) -> Start:
            if isinstance(start, Mapping):
                return start.get(key, start.get(key[0] if len(key) == 1 else key, least))
            return least if start is None else start

        starts, texts = {}, []
        for r in found:
            key = tuple(r[: len(scope)])
            first = given(key, r["_least"])
            if first is not None:
                starts[key] = dt.date.fromisoformat(str(first))
                texts.append((list(r["_text"]), starts[key].isoformat()))
        replaces = {"date": date_col, "scope": list(scope), "starts": texts} if texts else None
        segments = [*manifest["segments"], self._segment(rows, [*scope, date_col], replaces)]
        if len(segments) > MOST_SEGMENTS:
            segments = [self._segment(self._rows(segments), [*scope, date_col])]
        batches = manifest["batches"] | ({batch[0]: batch[1]} if batch else {})
        self.commit(before, manifest | {"segments": segments, "batches": batches})
        return starts

    def vacuum(self, keep: int = 2) -> int:
        """Delete versions but the newest `keep`, and segments that these don't
        name.  Nothing may be writing.  Returns the number of segments deleted."""
        found = self.versions()
        named = {s["folder"].split("/")[1] for v in found[-keep:] for part in ("segments", "previous") for s in self.manifest(v)[1][part]}
        gone = 0
        for v in found[:-keep]:
            path, fs = self._file(f"versions/v{v:012d}")
            fs.delete(path, False)
        folder, fs = self._file("data")
        for status in fs.listStatus(folder) if fs.exists(folder) else []:
            if status.getPath().getName() not in named:
                gone += bool(fs.delete(status.getPath(), True))
        return gone
