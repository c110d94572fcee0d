"""Tables on a shared file system, changed all or nothing.

Spark cannot replace Parquet files it is reading, and a failed overwrite leaves a
mix. So a change is first computed and written in full to a new directory; then one
small numbered manifest, naming the directories that now make up each table, is
renamed into place. A job that fails before that leaves the old state current. A
manifest lists directories per table partition, so a keyed change rewrites only
the partitions its source rows fall into. The partition columns are in the paths, as Spark
writes them, so it prunes by them.

The file system must rename atomically and refuse to rename onto an existing file
(HDFS and POSIX-like stores do).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barfold.operators.maintain import delete_matching, one_per_key, replace_by
from barfold.schema import Partition, Registry, TableSpec
from barfold.sources.scratch import COMPRESSION
from barfold.sources.staging import conform

# The folder of one write, as a partition level of its own: Spark wants all paths of a table to be of one form.
_CHANGE = "change"

# Bounds of a column, both included; None for an open end.
Range = tuple[object, object]


class ConcurrentChange(RuntimeError):
    """Another writer published first; nothing of this change is visible."""


class Change:
    """Tables as they will be once a change is published; see :meth:`Store.change`."""

    def __init__(self, store: Store, base: int) -> None:
        self._store, self.base = store, base
        self.manifest = store._manifest(base)
        self._added: dict[str, list[str]] = {}

    def read(self, name: str, between: Mapping[str, Range] | None = None) -> DataFrame:
        return self._store._read(name, self.manifest[name], between)

    def upsert(self, sources: Mapping[str, DataFrame],
               by: Mapping[str, list[str]] | None = None) -> None:
        """Merge source rows into tables, as :meth:`Store.upsert` does, without publishing them."""
        store = self._store

        def merge(name: str) -> tuple[dict, dict[str, list[str]]]:
            if name not in self.manifest:
                raise KeyError(f"no table {name!r} in {store.root}")
            entry = self.manifest[name]
            spec = store._spec(name, entry)
            delete_by = list((by or {}).get(name, spec.primary_key))
            if spec.primary_key and set(delete_by) == set(spec.primary_key):
                return store._merged_by_key(entry, spec, sources[name])
            with store.staged(conform(sources[name], spec)) as staged:
                return store._merged(entry, spec, staged, delete_by), {}

        # The tables' jobs run side by side: small ones fill the gaps of large ones.
        with ThreadPoolExecutor(max_workers=4) as pool:
            merged = dict(zip(sources, pool.map(inheritable_thread_target(store.spark)(merge), sources)))
        self.manifest = self.manifest | {name: entry for name, (entry, _) in merged.items()}
        self._added |= {name: added for name, (_, added) in merged.items()}

    def added(self, name: str) -> DataFrame:
        """The rows that the last merge by primary key put into a table, read from where it stored them."""
        entry = self.manifest[name] | {"parts": self._added[name]}
        return self._store._read(name, entry)


class Store:
    """Keyed tables under one root directory."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)
        self._fs.mkdirs(self._path(f"{self.root}/manifests"))

    # Manifests

    def version(self) -> int:
        """Number of the current manifest, 0 for an empty store."""
        names = [s.getPath().getName()
                 for s in self._fs.listStatus(self._path(f"{self.root}/manifests"))]
        return max((int(n[:-5]) for n in names if n.endswith(".json")), default=0)

    def _manifest(self, version: int) -> dict:
        if version == 0:
            return {}
        stream = self._fs.open(self._path(self._manifest_path(version)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/{version:012d}.json"

    def _switch(self, base: int, manifest: dict) -> None:
        draft = self._path(f"{self.root}/manifests/.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(manifest, sort_keys=True), "utf-8"))
        finally:
            stream.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            draft.toUri() if draft.toUri().getScheme() else self._fs.getUri(), self._conf
        )
        options = self.spark.sparkContext._gateway.new_array(
            self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0
        )
        try:
            context.rename(draft, self._path(self._manifest_path(base + 1)), options)
        except Exception as error:
            if self.version() > base:
                raise ConcurrentChange(f"the store is past version {base}") from error
            raise

    # Reading

    def names(self) -> list[str]:
        return sorted(self._manifest(self.version()))

    def _entry(self, name: str, version: int | None = None) -> dict:
        manifest = self._manifest(self.version() if version is None else version)
        if name not in manifest:
            raise KeyError(f"no table {name!r} in {self.root}")
        return manifest[name]

    def spec(self, name: str) -> TableSpec:
        return self._spec(name, self._entry(name))

    @staticmethod
    def _spec(name: str, entry: dict) -> TableSpec:
        return TableSpec(name, T.StructType.fromJson(entry["schema"]), tuple(entry["primary_key"]),
                         tuple(Partition(*p) for p in entry["partition_by"]))

    def registry(self) -> Registry:
        manifest = self._manifest(self.version())
        return Registry([self._spec(n, e) for n, e in manifest.items()])

    def read(self, name: str, version: int | None = None,
             between: Mapping[str, Range] | None = None) -> DataFrame:
        """All rows of a table, as of the current manifest or an earlier one.

        ``between`` bounds columns by values (date, int or text, both ends included, None for an open end); of the
        table's folders only those that can hold such rows are opened. Equal ends also choose buckets.
        """
        return self._read(name, self._entry(name, version), between)

    def _read(self, name: str, entry: dict, between: Mapping[str, Range] | None = None) -> DataFrame:
        spec, tests = self._spec(name, entry), []
        for column, (low, high) in (between or {}).items():
            kind = spec.schema[column].dataType.simpleString()
            low, high = (None if v is None else f"CAST('{_escaped(v)}' AS {kind})" for v in (low, high))
            for p in [Partition(f"`{column}`", "{}", column, True), *spec.partition_by]:
                if p.column == column and low is not None and low == high:
                    tests.append(f"{p.name} = {p.of(low)}")
                elif p.column == column and p.rising:
                    tests += [f"{p.name} {sign} {p.of(v)}" for sign, v in ((">=", low), ("<=", high)) if v is not None]
        return self._rows(entry, spec, list(entry["parts"]), tests)

    def _rows(self, entry: dict, spec: TableSpec, parts: list[str], tests: Sequence[str] = ()) -> DataFrame:
        paths = [f"{self.root}/{d}" for p in parts for d in entry["parts"].get(p, [])]
        if not paths:
            # The filter tells Spark before it plans that there are no rows, so joins with them fall away.
            return self.spark.createDataFrame([], spec.schema).where(F.lit(False))
        schema = T.StructType([*spec.schema.fields, T.StructField(_CHANGE, T.StringType()),
                               *[T.StructField(p.name, T.LongType()) for p in spec.partition_by]])
        rows = self.spark.read.option("basePath", f"{self.root}/data/{spec.name}").schema(schema).parquet(*paths)
        for test in tests:
            rows = rows.where(test)
        return rows.select(*spec.fields)

    def dictionaries(self) -> dict[str, DataFrame]:
        return {n: self.read(n) for n in self.registry().dictionaries()}

    # Writing

    def create(self, *specs: TableSpec) -> None:
        """Add empty tables; a table that exists stays as it is."""
        base = self.version()
        manifest = self._manifest(base)
        fresh = {s.name: self._new_entry(s) for s in specs if s.name not in manifest}
        if fresh:
            self._switch(base, manifest | fresh)

    @staticmethod
    def _new_entry(spec: TableSpec) -> dict:
        return {"schema": spec.schema.jsonValue(), "primary_key": list(spec.primary_key),
                "partition_by": [[p.name, p.expr, p.column, p.rising] for p in spec.partition_by], "parts": {}}

    def _write(self, spec: TableSpec, rows: DataFrame, laid_out: bool = False) -> dict[str, list[str]]:
        """Write rows to a new directory; returns the directories per partition."""
        folder = f"data/{spec.name}/{_CHANGE}={uuid.uuid4().hex}"
        names = [p.name for p in spec.partition_by]
        rows = conform(rows, spec).withColumns(self._places(spec))
        if not laid_out:
            # AQE merges small and splits large partitions of a rebalance.
            rows = rows.hint("rebalance", *names)
        (rows.write.partitionBy(*names) if names else rows.write).parquet(f"{self.root}/{folder}")
        parts = [""]
        for name in names:
            parts = [f"{part}/{found}" if part else found for part in parts
                     for found in self._children(f"{folder}/{part}") if found.startswith(f"{name}=")]
        return {part: [f"{folder}/{part}" if part else folder] for part in parts}

    def _children(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/{folder}".rstrip("/")))]

    @staticmethod
    def _places(spec: TableSpec, columns: Sequence[str] | None = None) -> dict[str, Column]:
        """The partitions of a row, or those that ``columns`` tell."""
        return {p.name: F.expr(p.of(f"`{p.column}`")).cast("long") for p in spec.partition_by
                if columns is None or p.column in columns}

    def publish(self, tables: Mapping[str, DataFrame], laid_out: bool = False) -> None:
        """Replace the content of one or more tables in a single step.

        Rows that are ``laid_out``, as those built on :func:`barfold.operators.returns.by_security`, are not
        dealt out once more.
        """
        base = self.version()
        manifest = self._manifest(base)
        for name, rows in tables.items():
            entry = self._entry(name, base)
            manifest[name] = entry | {"parts": self._write(self._spec(name, entry), rows, laid_out)}
        self._switch(base, manifest)

    def upsert(self, sources: Mapping[str, DataFrame],
               by: Mapping[str, list[str]] | None = None) -> None:
        """Merge source rows into tables in a single step, by primary key.

        ``by`` names, per table, columns whose matching target rows are deleted in
        place of those with a matching primary key; such a source is written to a staging
        directory, as it is read several times. By primary key it is written once, where it stays.
        """
        with self.change() as change:
            change.upsert(sources, by)

    @contextmanager
    def change(self) -> Iterator[Change]:
        """Several merges, each seeing those before it, that become visible together at the end.

        If the block raises, nothing does.
        """
        change = Change(self, self.version())
        yield change
        self._switch(change.base, change.manifest)

    @contextmanager
    def staged(self, rows: DataFrame) -> Iterator[DataFrame]:
        """``rows`` written next to the tables, for as long as the block runs."""
        path = f"{self.root}/staging/{uuid.uuid4().hex}"
        try:
            rows.write.parquet(path, compression=COMPRESSION)
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            self._fs.delete(self._path(path), True)

    def _merged(self, entry: dict, spec: TableSpec, source: DataFrame, delete_by: list[str]) -> dict:
        keys = list(spec.primary_key)
        touched = list(entry["parts"])
        places = self._places(spec, delete_by)
        if places:
            # At most one row per partition of the table.
            found = source.select(*[place.alias(name) for name, place in places.items()]).na.drop().distinct().collect()
            wanted = {tuple(f"{name}={row[name]}" for name in places) for row in found}
            chosen = [n for n, p in enumerate(spec.partition_by) if p.name in places]
            touched = [part for part in touched if tuple(part.split("/")[n] for n in chosen) in wanted]
        merged = replace_by(self._rows(entry, spec, touched), source, delete_by, keys)
        kept = {p: d for p, d in entry["parts"].items() if p not in set(touched)}
        # Where the columns deleted by do not tell the whole partition, new rows may join one that is kept.
        written = self._write(spec, merged)
        return entry | {"parts": kept | {p: kept.get(p, []) + d for p, d in written.items()}}

    def _merged_by_key(self, entry: dict, spec: TableSpec, source: DataFrame) -> tuple[dict, dict[str, list[str]]]:
        """The table's new entry and the folders of the source rows alone.

        Source rows are checked and written once, into folders of their own. Of the partitions they fall into, the other
        rows are written again: those of a run (as a security is) without source rows just as they lie.
        """
        keys = list(spec.primary_key)
        run = [p.column for p in spec.partition_by if not p.rising] or keys
        added = self._write(spec, one_per_key(conform(source, spec), keys, run), laid_out=True)
        touched = [part for part in entry["parts"] if part in added]
        parts = {p: d for p, d in entry["parts"].items() if p not in added}
        if touched:
            target, rows = self._rows(entry, spec, touched), self._rows({"parts": added}, spec, list(added))
            # Stored first, so that Spark knows how few they are.
            with self.staged(rows.select(*run).distinct()) as runs:
                beside = target.join(runs, run, "left_anti").select(*target.columns)
                within = target.join(runs, run, "left_semi").select(*target.columns)
                kept = self._write(spec, beside.unionByName(delete_matching(within, rows, keys)), laid_out=True)
            parts |= kept
        return entry | {"parts": parts | {p: parts.get(p, []) + d for p, d in added.items()}}, added

    def compact(self, name: str) -> None:
        """Rewrite a table in key order with evenly sized files; its rows stay the same."""
        base = self.version()
        manifest = self._manifest(base)
        entry = self._entry(name, base)
        spec = self._spec(name, entry)
        order = [*self._places(spec).values(), *[F.col(k) for k in spec.primary_key]]
        rows = self._rows(entry, spec, list(entry["parts"]))
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        manifest[name] = entry | {"parts": self._write(spec, rows, laid_out=True)}
        self._switch(base, manifest)

    def expire(self, keep: int = 1) -> None:
        """Free the space of all but the newest ``keep`` versions.

        Only directories an expired manifest names and no kept one are deleted, so a
        change being written now is safe.
        """
        if keep < 1:
            raise ValueError("the current version has to stay")
        last = self.version()
        kept, expired = range(max(1, last - keep + 1), last + 1), range(1, last - keep + 1)
        expired = [v for v in expired if self._fs.exists(self._path(self._manifest_path(v)))]
        needed = {d for v in kept for d in self._directories(v)}
        for directory in sorted({d for v in expired for d in self._directories(v)} - needed):
            self._fs.delete(self._path(f"{self.root}/{directory}"), True)
        for v in expired:
            self._fs.delete(self._path(self._manifest_path(v)), False)

    def _directories(self, version: int) -> set[str]:
        return {d for entry in self._manifest(version).values()
                for directories in entry["parts"].values() for d in directories}


def _escaped(value: object) -> str:
    return str(value).replace("\\", "\\\\").replace("'", "\\'")
