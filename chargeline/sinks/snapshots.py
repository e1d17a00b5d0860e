"""Append-only Parquet tables read by snapshot.

A table is a folder of *parts*, one per committed batch, and a short manifest
per version that names the parts of that version:

    ROOT/batch=00000007-1f2e3d4c/billing_month=.../part-*.parquet
    ROOT/_manifests/00000008.json

Spark writes a part completely before the manifest that names it is created
(and creating it fails if another writer was first), so a reader sees all of a
batch or nothing of it, and goes on reading the version it began with while a
job writes, fails or compacts. ``batch`` is a partition column, so reading only
newer batches is partition pruning.

The manifest also carries, per writer, the last batch it committed (a replayed
micro-batch is recognised and writes nothing) and, per source, how far this
table has consumed it. ``compact`` rewrites runs of small parts as one;
``vacuum`` deletes what old versions alone name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MANIFESTS = "_manifests"


class ConcurrentCommit(RuntimeError):
    """Another writer published the next version first."""


@dataclass(frozen=True)
class Part:
    """A folder of rows; it covers the batches ``first`` to ``last``."""

    name: str
    first: int
    last: int
    bytes: int


@dataclass(frozen=True)
class Snapshot:
    version: int = 0
    parts: tuple[Part, ...] = ()
    next_batch: int = 0
    writers: dict[str, int] = field(default_factory=dict)
    consumed: dict[str, int] = field(default_factory=dict)

    @property
    def last(self) -> int:
        return self.next_batch - 1

    def after(self, batch: int) -> tuple[Part, ...]:
        """The parts of later batches; a part that lies on both sides is an error."""
        split = [p.name for p in self.parts if p.first <= batch < p.last]
        if split:
            raise ValueError(f"compacted across batch {batch}: {split}")
        return tuple(p for p in self.parts if p.first > batch)


class SnapshotTable:
    """``sides`` names folders that hold more of each part (see ``ledger``); they are committed and compacted with it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ manifests

    def _versions(self) -> list[int]:
        folder = self._path(f"{self.root}/{MANIFESTS}")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and n[0].isdigit())

    def _manifest(self, version: int):
        return self._path(f"{self.root}/{MANIFESTS}/{version:08d}.json")

    def _load(self, version: int) -> Snapshot | None:
        stream = self._fs.open(self._manifest(version))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            raw = json.loads(text)
        except ValueError:  # its writer has not closed it yet: not published
            return None
        return Snapshot(raw["version"], tuple(Part(**p) for p in raw["parts"]), raw["next_batch"], raw["writers"],
                        raw["consumed"])

    def _foreign(self) -> bool:
        """Whether the folder holds anything but parts (of a first commit that failed)."""
        folder = self._path(self.root)
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return any(not n.startswith(("batch=", "_", ".")) for n in names)

    def exists(self) -> bool:
        return bool(self._versions())

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The named version, or the newest; version 0 is the table before its first commit."""
        if version is not None:
            return self._load(version) if version else Snapshot()
        for v in reversed(self._versions()):
            found = self._load(v)
            if found is not None:
                return found
        return Snapshot()

    def publish(self, base: Snapshot, **changes) -> Snapshot:
        """Make the next version: ``base`` with the changes. Fails if ``base`` is no longer the newest."""
        new = replace(base, version=base.version + 1, **changes)
        body = json.dumps(asdict(new))
        if new.version in self._versions():
            raise ConcurrentCommit(f"{self.root} version {new.version}")
        try:
            out = self._fs.create(self._manifest(new.version), False)
        except Exception as e:
            raise ConcurrentCommit(f"{self.root} version {new.version}") from e
        try:
            out.write(bytearray(body, "utf-8"))
        finally:
            out.close()
        return new

    # ------------------------------------------------------------ reading

    def read(self, snapshot: Snapshot | None = None, after: int | None = None, schema: StructType | None = None,
             side: str = "") -> DataFrame | None:
        """Rows of a snapshot (of its batches later than ``after``); None where it has no rows."""
        s = snapshot or self.snapshot()
        parts = s.parts if after is None else s.after(after)
        names = [p.name for p in parts if p.bytes]
        if not names:
            return None
        base = f"{self.root}/{side}" if side else self.root
        reader = self.spark.read.option("basePath", base)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(*(f"{base}/{n}" for n in names))

    def bytes(self, folder: str) -> int:
        return self._fs.getContentSummary(self._path(f"{self.root}/{folder}")).getLength()

    # ------------------------------------------------------------ writing

    def append(self, df: DataFrame, partition_col: str, *, writer: str | None = None, batch_id: int | None = None,
               consumed: dict[str, int] | None = None,
               also: Callable[[str, DataFrame], None] | None = None) -> Snapshot:
        """Commit the rows as one batch. A batch of a ``writer`` that was committed before writes nothing.

        ``also(name, rows)`` writes what belongs to the part elsewhere, from the
        rows as written, before the commit.
        """
        from chargeline.sinks import writers

        base = self.snapshot()
        if writer is not None and base.writers.get(writer, -1) >= batch_id:
            return base
        if not base.version and self._foreign():
            raise ValueError(f"{self.root} holds files that no manifest names")
        number = base.next_batch
        name = f"batch={number:08d}-{uuid.uuid4().hex[:8]}"
        writers.append_partitioned(df, f"{self.root}/{name}", partition_col)
        size = self.bytes(name)
        if also is not None and size:
            also(name, self.spark.read.parquet(f"{self.root}/{name}"))
        return self.publish(
            base, parts=(*base.parts, Part(name, number, number, size)), next_batch=number + 1,
            writers=base.writers | ({writer: batch_id} if writer is not None else {}),
            consumed=base.consumed | (consumed or {}))

    def compact(self, partition_col: str, target_bytes: int = 512 << 20, boundaries: Iterable[int] = (),
                sides: Sequence[tuple[str, str]] = ()) -> Snapshot:
        """Rewrite runs of consecutive parts as one of about ``target_bytes``.

        No run crosses a batch in ``boundaries`` (how far a consumer has read),
        so a consumer's position never falls inside a part. ``sides`` are (folder,
        partition column) pairs that are rewritten alike.
        """
        from chargeline.sinks import writers

        base = self.snapshot()
        runs: list[list[Part]] = []
        size, cuts = 0, set(boundaries)
        for p in base.parts:
            if not runs or size + p.bytes > target_bytes or any(runs[-1][-1].last <= c < p.first for c in cuts):
                runs.append([])
                size = 0
            runs[-1].append(p)
            size += p.bytes
        parts = []
        for run in runs:
            if len(run) == 1:
                parts += run
                continue
            first, last = run[0].first, run[-1].last
            name = f"batch={last:08d}-{uuid.uuid4().hex[:8]}"
            one = replace(base, parts=tuple(run))
            rows = self.read(one)
            if rows is not None:
                writers.append_partitioned(rows.drop("batch"), f"{self.root}/{name}", partition_col)
                for folder, by in sides:
                    writers.append_partitioned(self.read(one, side=folder).drop("batch"), f"{self.root}/{folder}/{name}", by)
            parts.append(Part(name, first, last, self.bytes(name) if rows is not None else 0))
        return self.publish(base, parts=tuple(parts)) if len(parts) < len(base.parts) else base

    def vacuum(self, keep_versions: int = 2, sides: Sequence[str] = ()) -> list[str]:
        """Delete the manifests before the last ``keep_versions``, and parts that only they name.

        Parts of a commit still under way are left alone: they are newer than all named ones.
        """
        versions = self._versions()
        old, kept = versions[:-keep_versions], [self.snapshot(v) for v in versions[-keep_versions:]]
        named = {p.name for s in kept if s for p in s.parts}
        gone = {p.name for v in old if (s := self.snapshot(v)) for p in s.parts} - named
        for name in sorted(gone):
            for folder in ("", *sides):
                self._fs.delete(self._path(f"{self.root}/{folder}/{name}" if folder else f"{self.root}/{name}"), True)
        for v in old:
            self._fs.delete(self._manifest(v), False)
        return sorted(gone)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest snapshot of a table, or a plain Parquet folder; None where there are no rows."""
    from chargeline.sinks import writers

    table = SnapshotTable(spark, path)
    if table.exists():
        rows = table.read()
        return None if rows is None else rows.drop("batch")
    return writers.read_table_or_none(spark, path)
