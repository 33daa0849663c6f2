"""Tables that change by publishing versions, and state that is kept up to date by rewriting only what a change touches.

A version is a manifest, a small JSON file naming the folders of its rows. It is written last, so a run that
stops before leaves readers on the version before, and a reader that has chosen a version keeps it whatever is published meanwhile.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tarnwork.operators.cdc import current_rows, latest_changes
from tarnwork.session import settle

_BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer has published the version."""


class VersionedTable:
    """Parquet folders under ``path`` and the manifests that make versions of them; one writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._writing = threading.RLock()  # streams of one session may share the object

    def _store(self, name: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def versions(self) -> list[int]:
        fs, place = self._store("_versions")
        if not fs.exists(place):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(place)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """``version``, ``schema``, ``parts`` (name to folder) and ``applied`` (flow to its last batch); version 0 before the first one."""
        known = self.versions()
        if not known and version is None:
            return {"version": 0, "schema": None, "parts": {}, "applied": {}}
        version = known[-1] if version is None else version
        if version not in known:
            raise ValueError(f"{self.path} has no version {version}")
        fs, place = self._store(f"_versions/{version:012d}.json")
        stream = fs.open(place)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _switch(self, manifest: Mapping) -> int:
        """Makes the manifest the newest version: written aside, then renamed."""
        version = manifest["version"] + 1
        fs, final = self._store(f"_versions/{version:012d}.json")
        aside = self.write_text(f"_versions/.{uuid.uuid4().hex}", json.dumps({**manifest, "version": version}))
        if fs.exists(final) or not fs.rename(aside, final):
            raise Conflict(f"{self.path} has a version {version} already")
        return version

    def write_text(self, name: str, text: str):
        """A new small file in the table's folder; gives its place."""
        fs, place = self._store(name)
        out = fs.create(place, False)
        out.write(bytearray(text.encode()))
        out.close()
        return place

    def _folder(self) -> str:
        return f"data/{uuid.uuid4().hex}"

    def _rows(self, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest version, or of the one asked for."""
        manifest = self.manifest(version)
        if manifest["schema"] is None:
            raise ValueError(f"{self.path} has no version yet")
        return self._rows(list(manifest["parts"].values()), T.StructType.fromJson(manifest["schema"]))

    def publish(self, df: DataFrame) -> int:
        """A version that holds the rows of ``df``, which may read the table itself; gives its number."""
        with self._writing:
            manifest, folder = self.manifest(), self._folder()
            df.write.parquet(f"{self.path}/{folder}")
            return self._switch({**manifest, "schema": df.schema.jsonValue(), "parts": {"all": folder}})

    def vacuum(self, keep: int = 2) -> list[int]:
        """Deletes all versions but the last ``keep`` and the folders only they name; readers of older versions lose them. Gives what is left."""
        if keep < 1:
            raise ValueError("at least one version stays")
        known = self.versions()
        named = {v: set(self.manifest(v)["parts"].values()) for v in known}
        kept = set().union(*[named[v] for v in known[-keep:]], set())
        for version in known[:-keep]:
            for folder in named[version] - kept:
                fs, place = self._store(folder)
                fs.delete(place, True)
            fs, place = self._store(f"_versions/{version:012d}.json")
            fs.delete(place, False)
        return known[-keep:]


class BucketedTable(VersionedTable):
    """Rows dealt to ``buckets`` folders by a hash of ``keys``; a change rewrites the buckets it has keys of, and no others.

    Work and memory go with the buckets touched, not with the table's age: choose so many that one is a file's size.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 16) -> None:
        super().__init__(spark, path)
        self.keys, self.buckets = list(keys), buckets

    def combine(self, rows: DataFrame) -> DataFrame:
        """One row per key from any number; the order they come in must not matter."""
        raise NotImplementedError

    def apply(self, changes: DataFrame, flow: str | None = None, batch: int = 0) -> list[int]:
        """Publishes the table with ``changes`` (reduced to one row per key) taken in; gives the buckets that were rewritten.

        With ``flow`` a batch that was published before is left out, so a repeated micro-batch changes nothing.
        A flow's batches are numbered upwards; one that starts anew needs another name.
        """
        with self._writing:
            return self._apply(changes, flow, batch)

    def _apply(self, changes: DataFrame, flow: str | None, batch: int) -> list[int]:
        manifest = self.manifest()
        if flow is not None and manifest["applied"].get(flow, -1) >= batch:
            return []
        dealt = changes.withColumn(_BUCKET, F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int"))
        dealt = settle(dealt, "changes")
        touched = sorted(r[0] for r in dealt.select(_BUCKET).distinct().collect())  # no more than there are buckets
        applied = {**manifest["applied"], **({} if flow is None else {flow: batch})}
        if not touched:
            if manifest["schema"] is None:
                manifest = {**manifest, "schema": changes.schema.jsonValue()}
            self._switch({**manifest, "applied": applied})
            return []
        rows = dealt.drop(_BUCKET)
        old = [manifest["parts"][str(b)] for b in touched if str(b) in manifest["parts"]]
        if old:
            rows = self._rows(old, T.StructType.fromJson(manifest["schema"])).unionByName(rows, allowMissingColumns=True)
        new = self.combine(rows)
        schema = new.schema
        if manifest["schema"] is not None:
            # Sums widen a decimal each time; the table's columns keep their types, new ones come last.
            known = T.StructType.fromJson(manifest["schema"])
            new = new.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in known], *[f"`{f.name}`" for f in schema if f.name not in known.names])
            schema = new.schema
        folder = self._folder()
        bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int")
        new.withColumn(_BUCKET, bucket).repartition(len(touched), _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        parts = {**manifest["parts"], **{str(b): f"{folder}/{_BUCKET}={b}" for b in touched}}
        nullable = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])
        self._switch({**manifest, "schema": nullable.jsonValue(), "parts": parts, "applied": applied})
        return touched


class KeyedTable(BucketedTable):
    """The newest row per key of a change feed, tombstones included, so that late changes undo nothing."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], sequence_by: Sequence[str], buckets: int = 16) -> None:
        super().__init__(spark, path, keys, buckets)
        self.sequence_by = list(sequence_by)

    def combine(self, rows: DataFrame) -> DataFrame:
        return latest_changes(rows, self.keys, self.sequence_by)

    def take(
        self, feed: DataFrame, delete_when: str | Column | None = None, except_columns: Sequence[str] = (), flow: str | None = None, batch: int = 0
    ) -> list[int]:
        """Take in a feed's changes; gives the buckets that were rewritten."""
        return self.apply(latest_changes(feed, self.keys, self.sequence_by, delete_when, except_columns), flow, batch)

    def current(self, version: int | None = None) -> DataFrame:
        """The rows that are not deleted."""
        return current_rows(self.read(version))


class IncrementalView(BucketedTable):
    """Aggregates per ``keys`` that take in new rows without reading the old ones.

    ``sums``, ``least`` and ``most`` name results and the columns they are of, ``counted`` a count of rows. ``distinct`` names results that count
    different values exactly: the state then has a row per value. ``about_distinct`` counts them by mergeable HLL sketches of
    ``2**sketch_size`` cells, a few kilobytes each, whose relative standard error is 1.04 over the root of the cells; they
    also roll up to fewer keys (``rolled_up``) without the base rows. NULL keys make a group; NULL values count nowhere.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        sums: Mapping[str, str] | None = None,
        counted: str | None = None,
        least: Mapping[str, str] | None = None,
        most: Mapping[str, str] | None = None,
        distinct: Mapping[str, str] | None = None,
        about_distinct: Mapping[str, str] | None = None,
        sketch_size: int = 12,
        buckets: int = 16,
    ) -> None:
        self.distinct = dict(distinct or {})
        if len(self.distinct) > 1:
            raise ValueError("one exact distinct count; others by sketches or by a view of their own")
        self.view_keys = list(keys)
        super().__init__(spark, path, [*keys, *[f"_value_{n}" for n in self.distinct]], buckets)
        self.sums, self.counted, self.least, self.most = dict(sums or {}), counted, dict(least or {}), dict(most or {})
        self.about, self.sketch_size = dict(about_distinct or {}), sketch_size

    def partial(self, rows: DataFrame) -> DataFrame:
        """A batch's state: one row per group (and counted value)."""
        rows = rows.withColumns({f"_value_{n}": F.col(c) for n, c in self.distinct.items()})
        wide = lambda c: F.col(c).cast(T.DecimalType(38, t.scale)) if isinstance(t := rows.schema[c].dataType, T.DecimalType) else F.col(c)
        parts = [F.sum(wide(c)).alias(n) for n, c in self.sums.items()] + [F.min(c).alias(n) for n, c in self.least.items()] + [F.max(c).alias(n) for n, c in self.most.items()]
        parts += [F.hll_sketch_agg(c, F.lit(self.sketch_size)).alias(n) for n, c in self.about.items()]
        return rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias(self.counted or "_rows"), *parts)

    def _merged(self, state: DataFrame, keys: Sequence[str]) -> DataFrame:
        parts = [F.sum(n).alias(n) for n in (self.counted or "_rows", *self.sums)] + [F.min(n).alias(n) for n in self.least] + [F.max(n).alias(n) for n in self.most]
        return state.groupBy(*keys).agg(*parts, *[F.hll_union_agg(n).alias(n) for n in self.about])

    def combine(self, rows: DataFrame) -> DataFrame:
        return self._merged(rows, self.keys)

    def refresh(self, rows: DataFrame, flow: str | None = None, batch: int = 0) -> list[int]:
        """Take in new rows; reads them, and of the state the buckets of their groups. Gives those."""
        return self.apply(self.partial(rows), flow, batch)

    def rolled_up(self, keys: Sequence[str], version: int | None = None) -> DataFrame:
        """The view by fewer keys, from the state alone; ``<name>_error`` gives a sketch's relative standard error."""
        missing = [k for k in keys if k not in self.view_keys]
        if missing:
            raise ValueError(f"the view has no key {', '.join(missing)}")
        state = self.read(version)
        decimals = {f.name: f.dataType for f in state.schema if f.name in self.sums and isinstance(f.dataType, T.DecimalType)}
        merged = self._merged(state, keys)
        exact = {n: F.count_distinct(f"_value_{n}").alias(n) for n in self.distinct}
        if exact:
            counts = state.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(*exact.values())
            same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
            merged = merged.join(counts, same).drop(*[f"_of_{k}" for k in keys]) if keys else merged.crossJoin(counts)  # one row each without keys
        shown = [*keys, *([self.counted] if self.counted else []), *[F.col(n).cast(decimals[n]).alias(n) if n in decimals else n for n in self.sums], *self.least, *self.most, *exact]
        for n in self.about:
            shown += [F.hll_sketch_estimate(n).alias(n), F.lit(1.04 / 2 ** (self.sketch_size / 2)).alias(f"{n}_error")]
        return merged.select(*shown)

    def current(self, version: int | None = None) -> DataFrame:
        return self.rolled_up(self.view_keys, version)


def refresh_each(views: Sequence[IncrementalView], flow: str) -> Callable[[DataFrame, int], None]:
    """A stream's batch function that brings all views up to date."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for view in views:
            view.refresh(batch, flow, batch_id)

    return write
