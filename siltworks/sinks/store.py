"""Parquet tables that can be replaced and upserted while they are being read.

``MERGE`` needs a table format that open Spark does not ship, and a Parquet table cannot be
overwritten by a query that reads it. So each commit writes a new folder and then replaces the table's
*manifest*, a small file that names the folders the table consists of, its schema and layout, the
last micro-batch and the high-water mark. Replacing it is one rename: a reader of ``StoredTable.read`` sees
all of a commit or nothing, and so does the next run. The catalog follows: its locations are set after the commit, and again by the
next writer where that was cut short. One writer per table.

Two layouts, which belong to the table from its creation on:

* plain: an upsert rewrites the table;
* ``buckets=n``: rows are kept by a hash bucket of the primary key. An upsert reads and rewrites only
  the buckets in which the batch has keys. Choose ``n`` so that a bucket is a few gigabytes;
  ``rebucket`` changes it.

Either can take batches as *runs* (``delta_runs``): an upsert then writes its own rows only, sorted by key, and neither reads
nor rewrites the table. ``read`` merges base and runs. Runs are gathered in tiers of growing size, and folded into the base
when together they are a given share of it, so a row is rewritten a bounded number of times however many
batches there are. For clustered tables the ends of clustering and key columns are kept by file, beside the data: ``read_where`` opens
only files that can hold what is asked for. The *catalog* shows the base; ``read_table`` and ``StoredTable.read`` show everything, ``compact`` folds
at once.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import cached_property, reduce, wraps
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import TableContract
from ..functions.columns import METADATA, ref
from ..functions.names import quoted
from ..operators.merge import repeated_keys, text_bytes, upsert, upsert_small
from ..operators.versions import RUN, Run, merged, run_of, thinned
from ..session import shuffles_deleted
from . import files

BUCKET = "_key_bucket"
# Buckets of a contract that names none, where there are keys.
DEFAULT_BUCKETS = 32
# A batch of this many bytes of Parquet at most is looked at more closely …
SMALL_FILE_BYTES = 32 << 20
# … and counts as small if its rows, as text, take no more than this: the table is not shuffled then.
BROADCAST_BYTES = 256 << 20

# Rows that come placed lie in so many places of each bucket, so that tasks are not bound to their number …
PLACES_PER_BUCKET = 16
# … and a large batch is merged by groups of buckets of about so many bytes of Parquet, or a sixteenth of all that is merged.
GROUP_BYTES = 512 << 20
# Stored rows hold hashes as hexadecimal text, which takes half the bytes where the codec has an entropy coder.
CODEC = "zstd"

# So many runs of one tier are gathered into one of the next …
RUNS_PER_TIER = 8
# … and runs of this share of the base's bytes are folded into it.
FOLD_SHARE = 0.25

_VERSION_PROPERTY, _LAYOUT_PROPERTY, _BASE_PROPERTY = "silver.published_version", "silver.published_layout", "silver.base"
_SNAPSHOT = re.compile(r"snap-(\d+)$")
_WRITTEN = re.compile(r"snap-(\d+)(-staged|-stats)?$")


def _scratch_deleted(method):
    """Shuffle files of each query in the method are deleted when it ends: what a commit needs on disk is that of its largest query."""

    @wraps(method)
    def run(self, *args, **kwargs):
        with shuffles_deleted(self.spark):
            return method(self, *args, **kwargs)

    return run


class Batch(NamedTuple):
    """A micro-batch: the stream that made it, by the id its checkpoint holds, and its number there.

    A stream that starts anew with another checkpoint has another id, so its batches are not taken
    for those of the earlier one.
    """

    stream: str
    number: int


def ddl(spark: SparkSession, schema: T.StructType) -> str:
    return spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json()).toDDL()


def ensure_database(spark: SparkSession, table: str) -> None:
    database = table.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def clustered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range layout, so Parquet's min/max statistics skip row groups.

    A hash of the row is the last range key: a clustering value that holds a third of all rows
    is spread over as many tasks as its rows need.
    """
    if not keys:
        return df
    plain = [
        ref(f.name) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    return (
        df.repartitionByRange(*[ref(k) for k in keys], F.xxhash64(*plain))
        .sortWithinPartitions(*[ref(k) for k in keys])
    )


@dataclass(frozen=True)
class Manifest:
    """What a table consists of after a commit. Folders are relative to the table's base folder."""

    version: int
    schema: dict
    buckets: int
    keys: list[str]
    folders: dict[str, str] = field(default_factory=dict)  # by bucket; the plain layout has one, named ""
    batch: list | None = None
    mark: int | None = None  # greatest bronze ingestion time, in microseconds
    # Oldest first: folder, tier, rows, bytes (of files), text (bytes of the rows as text), members (number, order_by, columns)
    runs: list[dict] = field(default_factory=list)
    base_bytes: int | None = None
    # Statistics of the base's files: folder of the statistics, snapshot they are of, columns
    stats: list[dict] = field(default_factory=list)
    # Micro-batches of the source that were read, see operators.ledger
    ledger: dict[str, list[list[int]]] = field(default_factory=dict)
    # What the last commit's contract turned away: counts by kind
    rejects: dict[str, int] = field(default_factory=dict)
    # The keys that buckets are made of, where not of all
    placed_by: list[str] = field(default_factory=list)

    @property
    def bucket_keys(self) -> list[str]:
        return self.placed_by or self.keys

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)

    def key_types(self) -> dict[str, T.DataType]:
        types = {f.name.lower(): f.dataType for f in self.struct.fields}
        return {k: types[k.lower()] for k in self.keys}


@dataclass(frozen=True)
class StoredTable:
    spark: SparkSession
    name: str
    clustering: tuple[str, ...] = ()
    buckets: int = 0
    base: str | None = None
    delta_runs: bool = False
    # Buckets are made of these keys, of all where there are none: rows that share them lie together. It holds from the table's creation on.
    placed_by: tuple[str, ...] = ()

    @classmethod
    def of_contract(
        cls, spark: SparkSession, contract: TableContract, name: str, base: str | None = None, delta_runs: bool = False
    ) -> StoredTable:
        buckets = contract.key_buckets
        if buckets is None:
            buckets = DEFAULT_BUCKETS if contract.primary_keys else 0
        return cls(spark, name, contract.clustering_keys, buckets, base, delta_runs, tuple(contract.document_keys))

    # -- reading ---------------------------------------------------------------------------

    @cached_property
    def base_folder(self) -> str:
        """Where the table's folders are: as given, as the catalog has it, or below the database's folder."""
        if self.base:
            return self.base.rstrip("/")
        if self.spark.catalog.tableExists(self.name) and (base := self._properties().get(_BASE_PROPERTY)):
            return base
        database, _, table = self.name.rpartition(".")
        home = self.spark.catalog.getDatabase(database or self.spark.catalog.currentDatabase())
        return f"{home.locationUri.rstrip('/')}/{table}"

    def manifest(self) -> Manifest | None:
        database = self.name.rpartition(".")[0]
        if not self.base and database and not self.spark.catalog.databaseExists(database):
            return None
        text = files.read_text(self.spark, f"{self.base_folder}/manifest.json")
        return Manifest(**json.loads(text)) if text else None

    @property
    def exists(self) -> bool:
        return self.manifest() is not None

    def _known(self) -> Manifest:
        known = self.manifest()
        if known is None:
            raise ValueError(f"the table {self.name} has not been stored")
        return known

    def read(self) -> DataFrame:
        """The rows of the last commit."""
        return self._rows(self._known())

    def _rows(self, known: Manifest, buckets: Sequence[str] | None = None, paths: Sequence[str] | None = None) -> DataFrame:
        base = self._base_rows(known, buckets, paths)
        if not known.runs:
            return base
        runs = self._run_rows(known, known.runs)
        if buckets is not None:
            runs = runs.filter(_bucket_of(known.bucket_keys, known.buckets).cast("string").isin(list(buckets)))
        small = sum(r["text"] for r in known.runs) <= BROADCAST_BYTES
        return merged(base, runs, known.keys, _members(known.runs), small)

    def read_where(self, ranges: Mapping[str, tuple]) -> DataFrame:
        """The rows whose columns lie in these ranges, ends included (None: open): ``{"day": (low, high)}``.

        Files whose least and greatest values, kept since they were written, lie outside are not opened. While runs are
        pending only ranges of key columns choose files, as a run may change any other value.
        """
        known = self._known()
        if not ranges:
            return self._rows(known)
        chosen = [c for c in ranges if not known.runs or c.lower() in {k.lower() for k in known.keys}]
        paths = self._matching_files(known, {c: ranges[c] for c in chosen}) if chosen else None
        rows = self._rows(known, paths=paths)
        return rows.filter(reduce(and_, [_within(ref(c), ref(c), *ends) for c, ends in ranges.items()]))

    def _matching_files(self, known: Manifest, ranges: Mapping[str, tuple]) -> list[str]:
        """Paths below the base folder; whole folders where a commit left no statistics."""
        told = {s["of"] for s in known.stats}
        found = [f for f in known.folders.values() if f.split("/")[0] not in told]
        current = [F.col("folder") == f for f in known.folders.values()]
        for s in known.stats:
            slots = {c.lower(): i for i, c in enumerate(s["columns"])}
            tests = [_within(F.col(f"low_{i}"), F.col(f"high_{i}"), *ends) for c, ends in ranges.items() if (i := slots.get(c.lower())) is not None]
            files_of = self.spark.read.parquet(f"{self.base_folder}/{s['folder']}").filter(reduce(or_, current))
            found += [r["file"] for r in reduce(DataFrame.filter, tests, files_of).select("file").collect()]
        return found

    def _with_stats(self, new: Manifest) -> Manifest:
        """Count rows and note the ends of clustering and key columns, file by file, of the snapshot just written."""
        name = f"snap-{new.version:06d}"
        used = {f.split("/")[0] for f in new.folders.values()}
        kept = [s for s in new.stats if s["of"] in used]
        fields = {f.name.lower(): f for f in new.struct.fields}
        plain = [f for c in dict.fromkeys([*self.clustering, *new.keys]) if (f := fields.get(c.lower())) and isinstance(f.dataType, T.AtomicType)]
        if not self.clustering or not plain or name not in used:
            return replace(new, stats=kept)
        rows = self.spark.read.schema(T.StructType(plain)).parquet(*[f"{self.base_folder}/{f}" for f in new.folders.values() if f.split("/")[0] == name])
        file = F.regexp_extract("_metadata.file_path", r"(snap-[0-9]+/.*)\z", 1).alias("file")
        ends = [e for i, f in enumerate(plain) for e in (F.min(ref(f.name)).alias(f"low_{i}"), F.max(ref(f.name)).alias(f"high_{i}"))]
        told = rows.select("*", file).groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *ends)
        told = told.withColumn("folder", F.regexp_replace("file", r"/[^/]*\z", ""))
        told.coalesce(1).write.mode("overwrite").parquet(f"{self._folder(new.version)}-stats")
        return replace(new, stats=[*kept, {"folder": f"{name}-stats", "of": name, "columns": [f.name for f in plain]}])

    def _run_rows(self, known: Manifest, runs: Sequence[dict]) -> DataFrame:
        schema = T.StructType([*known.struct.fields, T.StructField(RUN, T.LongType())])
        return self.spark.read.schema(schema).parquet(*[f"{self.base_folder}/{r['folder']}" for r in runs])

    def _base_rows(self, known: Manifest, buckets: Sequence[str] | None = None, paths: Sequence[str] | None = None) -> DataFrame:
        chosen = [f for b, f in known.folders.items() if buckets is None or b in buckets] if paths is None else paths
        if not chosen:
            return self.spark.createDataFrame([], known.struct)
        paths = [f"{self.base_folder}/{f}" for f in chosen]
        return self.spark.read.schema(known.struct).parquet(*paths)

    @property
    def location(self) -> str:
        """Current data folder of a plain table."""
        return f"{self.base_folder}/{self._known().folders['']}"

    @property
    def pending_runs(self) -> int:
        """Runs that the base, and so the catalog, does not have yet."""
        known = self.manifest()
        return len(known.runs) if known else 0

    @classmethod
    def by_name(cls, spark: SparkSession, name: str) -> StoredTable | None:
        """The stored table behind a name of the catalog; None for any other table or view."""
        if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType not in ("EXTERNAL", "MANAGED"):
            return None
        table = cls(spark, name)
        return table if _BASE_PROPERTY in table._properties() else None

    def last_batch(self) -> Batch | None:
        known = self.manifest()
        return Batch(*known.batch) if known and known.batch else None

    def has(self, batch: Batch | None) -> bool:
        last = self.last_batch() if batch else None
        return last is not None and last.stream == batch.stream and batch.number <= last.number

    # -- writing ---------------------------------------------------------------------------

    def next_version(self) -> int:
        """The number that the next commit will have, if nothing else is written before."""
        return self._next_version(self.manifest())

    def _next_version(self, known: Manifest | None) -> int:
        numbers = [int(m.group(1)) for f in files.listing(self.spark, self.base_folder) if (m := _SNAPSHOT.search(f.name))]
        return max([*numbers, known.version if known else -1]) + 1

    def _drop_unfinished(self, known: Manifest) -> None:
        """Delete what runs that died before their commit have left: data newer than the manifest, which nothing refers to."""
        for f in files.listing(self.spark, self.base_folder):
            if (m := _WRITTEN.match(f.name)) and int(m.group(1)) > known.version:
                files.delete(self.spark, f.path)

    def _folder(self, version: int) -> str:
        return f"{self.base_folder}/snap-{version:06d}"

    def place_of(self, rows: DataFrame, keys: Sequence[str], values: Mapping[str, Column] | None = None) -> Column | None:
        """Where rows belong in this table's layout: rows of one place are in one bucket. None where the layout has no buckets.

        ``values`` are those of some keys, for rows that have no key columns yet; None too where the layout needs others.
        """
        known = self.manifest()
        buckets = known.buckets if known else self.buckets
        if not buckets or not keys or known and [k.lower() for k in keys] != [k.lower() for k in known.keys]:
            return None
        types = {f.name.lower(): f.dataType for f in (known.struct if known else rows.schema).fields}
        by = known.bucket_keys if known else self._placed_by(keys)
        if values is not None:
            values = {k.lower(): v for k, v in values.items()}
            if not {k.lower() for k in by} <= set(values):
                return None
            return _place([values[k.lower()].cast(types[k.lower()]) if known else values[k.lower()] for k in by], buckets)
        return _place([ref(k).cast(types[k.lower()]) for k in by], buckets)

    def _placed_by(self, keys: Sequence[str]) -> list[str]:
        """The keys that buckets of a table with these keys are made of."""
        some = {k.lower() for k in self.placed_by}
        return [k for k in keys if k.lower() in some] if some and some <= {k.lower() for k in keys} else list(keys)

    def _write(self, df: DataFrame, keys: Sequence[str], buckets: int, version: int, gather: bool = True, mode: str = "overwrite") -> dict[str, str]:
        """Write rows into a new folder; what the manifest will say of them.

        Clustering is kept inside buckets, so nothing but the rewritten buckets is sorted. ``gather`` brings a bucket's rows
        together (and splits one that is too large); it is left out where they lie together already.
        """
        folder, name = self._folder(version), f"snap-{version:06d}"
        if not buckets:
            laid = clustered(df, self.clustering) if gather else df.sortWithinPartitions(*[ref(c) for c in self.clustering]) if self.clustering else df
            laid.write.mode("overwrite").parquet(folder, compression=CODEC)
            return {"": name}
        placed = df.withColumn(BUCKET, _bucket_of(keys, buckets).cast("int"))  # of the keys that buckets are made of
        if gather:
            placed = placed.hint("rebalance", BUCKET)
        placed = placed.sortWithinPartitions(BUCKET, *[ref(c) for c in self.clustering])
        placed.write.mode(mode).partitionBy(BUCKET).parquet(folder, compression=CODEC)
        made = [f.name for f in files.listing(self.spark, folder) if f.is_dir and f.name.startswith(BUCKET + "=")]
        return {n.split("=")[1]: f"{name}/{n}" for n in made}

    def _commit(self, new: Manifest) -> None:
        """The rename in here is the commit. What comes after only brings the catalog up to date."""
        files.write_text(self.spark, f"{self.base_folder}/manifest.json", json.dumps(asdict(new)))
        self.publish()

    def create(
        self,
        df: DataFrame,
        keys: Sequence[str] = (),
        batch: Batch | None = None,
        refuse_repeats: bool = False,
        ledger: dict | None = None,
        rejects: dict | None = None,
        placed: bool = False,
    ) -> None:
        """First load: make the database when missing, write the rows, register the table."""
        ensure_database(self.spark, self.name)
        self._replace(df, keys, batch, refuse_repeats, ledger=ledger, rejects=rejects, placed=placed)

    @_scratch_deleted
    def _replace(self, df: DataFrame, keys: Sequence[str], batch: Batch | None = None, refuse_repeats: bool = False, buckets: int | None = None, ledger: dict | None = None, rejects: dict | None = None, placed: bool = False) -> None:
        known = self.manifest()
        buckets = (known.buckets if known else self.buckets) if buckets is None else buckets
        keys = list(keys) or (known.keys if known else [])
        if buckets and not keys:
            raise ValueError("a bucketed table needs its primary keys")
        version = self._next_version(known)
        if known:
            self._drop_unfinished(known)
        same = known and [k.lower() for k in known.keys] == [k.lower() for k in keys]
        by = known.bucket_keys if same else self._placed_by(keys)
        folders = self._write(df, by, buckets, version, gather=not (placed and buckets))
        new = Manifest(version, _stored_schema(df.schema), buckets, keys, folders, list(batch) if batch else None, ledger=ledger or {}, rejects=rejects or {}, placed_by=by if by != keys else [])
        if refuse_repeats:
            try:
                self._refuse_repeats(self._rows(new), keys)
            except ValueError:
                files.delete(self.spark, self._folder(version))
                raise
        self._commit(self._with_stats(replace(new, mark=_mark_of(self._rows(new)))))

    def overwrite(self, df: DataFrame, keys: Sequence[str] = ()) -> None:
        """Replace all rows; the schema may change. The query may read the table itself: it is written once, then switched to."""
        if not self.exists:
            return self.create(df, keys)
        return self._replace(df, keys)

    def rebucket(self, buckets: int) -> None:
        """Another number of buckets (0: plain): the table is rewritten."""
        known = self._known()
        self._replace(self.read(), known.keys, Batch(*known.batch) if known.batch else None, buckets=buckets, ledger=known.ledger)

    @_scratch_deleted
    def upsert(
        self,
        new: DataFrame,
        keys: Sequence[str],
        order_by: Sequence[str] = (),
        batch: Batch | None = None,
        keys_are_unique: bool = False,
        ledger: dict | None = None,
        rejects: dict | None = None,
        placed: bool = False,
    ) -> None:
        """Create the table, or merge a batch into it. A micro-batch that was committed is skipped.

        ``ledger`` tells what of the source has been read with this batch; it changes with the commit, or not at all.

        Keys take the types that the table has before they are hashed or compared, and the table's own number of
        buckets holds, whatever this object says. ``placed`` tells that the batch's rows lie together by ``place_of``; it decides how
        they are moved, not what is stored.
        """
        if self.has(batch):
            return
        known = self.manifest()
        if known is None:
            self.create(new, keys, batch, refuse_repeats=not keys_are_unique, ledger=ledger, rejects=rejects, placed=placed)
            return
        if (known.buckets or known.runs or self.delta_runs and known.keys) and [k.lower() for k in keys] != [k.lower() for k in known.keys]:
            raise ValueError(f"the table {self.name} is kept by {known.keys}, not by {list(keys)}")
        known = replace(known, ledger=known.ledger if ledger is None else ledger, rejects=rejects or {})
        if self.delta_runs:
            return self._append_run(replace(known, keys=list(known.keys or keys)), new, keys, order_by, batch, keys_are_unique)
        if known.runs:
            self.compact()
            known = replace(self._known(), ledger=known.ledger, rejects=known.rejects)
        self.publish()
        types = {f.name.lower(): f.dataType for f in known.struct.fields}
        for k in keys:
            new = new.withColumn(k, ref(k).cast(types[k.lower()]))
        version = self._next_version(known)
        self._drop_unfinished(known)
        # The batch is needed more than once: write it, so that it is computed once, survives the
        # loss of executors, and has a size that is known and not guessed.
        staged_path = f"{self._folder(version)}-staged"
        placed = placed and known.buckets > 0
        laid = new.withColumn(BUCKET, _bucket_of(known.bucket_keys, known.buckets).cast("int")).write.partitionBy(BUCKET) if placed else new.write
        laid.mode("overwrite").parquet(staged_path, compression=CODEC)
        try:
            parts = {f.name.split("=")[1]: f.path for f in files.listing(self.spark, staged_path) if f.is_dir} if placed else {}
            staged = self._staged(new.schema, list(parts.values()) if placed else [staged_path])
            if not keys_are_unique:
                self._refuse_repeats(staged, keys)
            marks = [m for m in (known.mark, _mark_of(staged)) if m is not None]
            after = replace(known, version=version, batch=list(batch) if batch else known.batch, mark=max(marks, default=None))
            if staged.isEmpty():
                struct = _with_fields(known.struct, staged.schema)
                self._commit(replace(after, schema=_stored_schema(struct)))
                return
            touched = list(parts) if placed else None
            if known.buckets and not placed:
                touched = [str(r[0]) for r in staged.select(_bucket_of(known.bucket_keys, known.buckets)).distinct().collect()]  # at most one row per bucket
            small = self._is_small(staged, staged_path)
            folders, mode = {}, "overwrite"
            for group in [touched] if small or touched is None else self._groups(known, touched, staged_path, parts):
                old, rows = self._rows(known, group), staged
                if placed:
                    rows = self._staged(new.schema, [parts[b] for b in group])
                elif group != touched:
                    rows = staged.filter(_bucket_of(known.bucket_keys, known.buckets).cast("string").isin(group))
                # Joined where the buckets need them, rows are not moved again to be written.
                where = [_place([ref(k) for k in known.bucket_keys], known.buckets)] if known.buckets else []
                result = upsert_small(old, rows, keys, order_by, measured=True) if small else upsert(old, rows, keys, order_by, *where)
                folders.update(self._write(result, known.bucket_keys, known.buckets, version, gather=not small and not where, mode=mode))
                mode = "append"
                for b in group if placed else ():
                    files.delete(self.spark, parts[b])
            kept = {b: f for b, f in known.folders.items() if touched is not None and b not in touched}
            self._commit(self._with_stats(replace(after, schema=_stored_schema(result.schema), folders={**kept, **folders}, base_bytes=None)))
        finally:
            files.delete(self.spark, staged_path)

    def _staged(self, schema: T.StructType, paths: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _groups(self, known: Manifest, touched: Sequence[str], staged_path: str, parts: Mapping[str, str]) -> list[list[str]]:
        """Buckets to merge together: a merge shuffles what it merges, so a few groups need a fraction of the disk."""
        each = 0 if parts else files.total_bytes(self.spark, staged_path) / len(touched)
        size_of = lambda b: (
            (files.total_bytes(self.spark, parts[b]) if parts else each)
            + (files.total_bytes(self.spark, f"{self.base_folder}/{known.folders[b]}") if b in known.folders else 0)
        )
        sizes = {b: size_of(b) for b in sorted(touched, key=int)}
        most = max(GROUP_BYTES, sum(sizes.values()) / 16)
        groups, filled = [[]], 0
        for b, size in sizes.items():
            if groups[-1] and filled + size > most:
                groups.append([])
                filled = 0
            groups[-1].append(b)
            filled += size
        return groups

    def _append_run(self, known: Manifest, new: DataFrame, keys: Sequence[str], order_by: Sequence[str], batch: Batch | None, keys_are_unique: bool) -> None:
        """Commit a batch as rows of its own. Values take the types that the table has; new columns are added."""
        if not keys:
            raise ValueError("an upsert needs at least one key")
        have = {f.name.lower(): f for f in known.struct.fields}
        columns = [ref(f.name).cast(have[f.name.lower()].dataType).alias(have[f.name.lower()].name) if f.name.lower() in have else ref(f.name) for f in new.schema.fields]
        struct = _with_fields(known.struct, new.schema)
        version = self._next_version(known)
        self._drop_unfinished(known)
        folder, name = self._folder(version), f"snap-{version:06d}"
        run = new.select(*columns, F.lit(version).cast("bigint").alias(RUN))
        run.sortWithinPartitions(*[ref(k) for k in keys]).write.mode("overwrite").parquet(folder, compression=CODEC)
        after = replace(known, version=version, batch=list(batch) if batch else known.batch, schema=_stored_schema(struct))
        entry = {"folder": name, "tier": 0, "members": [[version, list(order_by), sorted(f.name.lower() for f in new.schema.fields)]]}
        written = self._run_rows(after, [entry])
        if not keys_are_unique:
            try:
                self._refuse_repeats(written, keys)
            except ValueError:
                files.delete(self.spark, folder)
                raise
        entry = self._measured(entry, written)
        marks = [m for m in (known.mark, _mark_of(written)) if m is not None]
        after = replace(after, mark=max(marks, default=None), runs=[*known.runs, entry] if entry["rows"] else known.runs)
        self._commit(after)
        self._tidy(after)

    def _measured(self, entry: dict, rows: DataFrame) -> dict:
        n, text = rows.agg(F.count(F.lit(1)), F.sum(text_bytes(rows))).first()
        return {**entry, "rows": n, "text": text or 0, "bytes": files.total_bytes(self.spark, f"{self.base_folder}/{entry['folder']}")}

    def _tidy(self, known: Manifest) -> None:
        """Gather the runs of a full tier, or fold all runs that have grown to a share of the base."""
        if known.base_bytes is None:
            known = replace(known, base_bytes=sum(files.total_bytes(self.spark, f"{self.base_folder}/{f}") for f in known.folders.values()))
            self._commit(known)
        if sum(r["bytes"] for r in known.runs) >= FOLD_SHARE * known.base_bytes and len(known.runs) >= RUNS_PER_TIER:
            return self.compact()
        while known.runs and len(newest := [r for r in known.runs if r["tier"] == known.runs[-1]["tier"]]) >= RUNS_PER_TIER:
            version = self._next_version(known)
            rows = thinned(self._run_rows(known, newest), known.keys, _members(newest))
            keys = [ref(k) for k in known.keys]
            rows.repartitionByRange(*keys).sortWithinPartitions(*keys, RUN).write.mode("overwrite").parquet(self._folder(version), compression=CODEC)
            entry = {"folder": f"snap-{version:06d}", "tier": newest[0]["tier"] + 1, "members": [m for r in newest for m in r["members"]]}
            entry = self._measured(entry, self._run_rows(known, [entry]))
            known = replace(known, version=version, runs=[*[r for r in known.runs if r not in newest], entry])
            self._commit(known)

    @_scratch_deleted
    def compact(self) -> None:
        """Fold all runs into the base: only buckets that the runs have keys of are rewritten."""
        known = self._known()
        if not known.runs:
            return
        touched = None
        if known.buckets:
            touched = [str(r[0]) for r in self._run_rows(known, known.runs).select(_bucket_of(known.bucket_keys, known.buckets)).distinct().collect()]
        version = self._next_version(known)
        folders = self._write(self._rows(known, touched), known.bucket_keys, known.buckets, version)
        kept = {b: f for b, f in known.folders.items() if touched is not None and b not in touched}
        self._commit(self._with_stats(replace(known, version=version, folders={**kept, **folders}, runs=[], base_bytes=None)))

    def _is_small(self, staged: DataFrame, path: str) -> bool:
        if files.total_bytes(self.spark, path) > SMALL_FILE_BYTES:
            return False
        return (staged.agg(F.sum(text_bytes(staged))).first()[0] or 0) <= BROADCAST_BYTES

    def _refuse_repeats(self, new: DataFrame, keys: Sequence[str]) -> None:
        if not repeated_keys(new, keys).isEmpty():
            raise ValueError(f"the batch for {self.name} has several rows with the same key {list(keys)}")

    # -- the catalog -----------------------------------------------------------------------

    def publish(self) -> None:
        """Bring the catalog up to the manifest. Safe to repeat; nothing to do when it is there already."""
        known = self._known()
        there = self.spark.catalog.tableExists(self.name)
        properties = self._properties() if there else {}
        if properties.get(_VERSION_PROPERTY) == str(known.version):
            return
        layout = hashlib.sha256(json.dumps([known.schema, known.folders], sort_keys=True).encode()).hexdigest()
        if there and properties.get(_LAYOUT_PROPERTY) == layout:  # a commit of rows beside the base
            self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{_VERSION_PROPERTY}' = '{known.version}')")
            return
        whole = T.StructType([*known.struct.fields, *([T.StructField(BUCKET, T.IntegerType())] if known.buckets else [])])
        comment, comments = None, {}
        if there:
            have = self.spark.table(self.name).schema
            same = {f.name: f.dataType for f in whole.fields if f.name in have.names}
            grown = all(f.name in same and same[f.name] == f.dataType for f in have.fields)
            if grown and (BUCKET in have.names) == bool(known.buckets):
                fresh = T.StructType([f for f in known.struct.fields if f.name not in have.names])
                if fresh.fields:
                    self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({ddl(self.spark, fresh)})")
            else:
                # Another schema: the entry is made anew, the files stay, descriptions and tags are carried over.
                comment = self.spark.catalog.getTable(self.name).description
                comments = {c.name: c.description for c in self.spark.catalog.listColumns(self.name) if c.description}
                self.spark.sql(f"DROP TABLE {self.name}")
                there = False
        if not there:
            self._register(whole, known, comment, comments, properties)
        if known.buckets:
            self._point_buckets(known)
        else:
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{self.base_folder}/{known.folders['']}'")
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{_VERSION_PROPERTY}' = '{known.version}', '{_LAYOUT_PROPERTY}' = '{layout}', '{_BASE_PROPERTY}' = '{self.base_folder}')")
        self.spark.catalog.refreshTable(self.name)

    def _register(self, whole: T.StructType, known: Manifest, comment: str | None, comments: dict, properties: dict) -> None:
        described = T.StructType([
            T.StructField(f.name, f.dataType, True, {"comment": comments[f.name]} if f.name in comments else {}) for f in whole.fields
        ])
        where = self._folder(known.version) if known.buckets else f"{self.base_folder}/{known.folders['']}"
        literal = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
        own = {k: v for k, v in properties.items() if k not in (_VERSION_PROPERTY, _LAYOUT_PROPERTY) and not k.startswith(("spark.", "transient_"))}
        self.spark.sql(
            f"CREATE TABLE {self.name} ({ddl(self.spark, described)}) USING parquet "
            + (f"PARTITIONED BY ({BUCKET}) " if known.buckets else "")
            + f"LOCATION '{where}' "
            + (f"COMMENT {literal(comment)} " if comment else "")
            + (f"TBLPROPERTIES ({', '.join(f'{literal(k)} = {literal(v)}' for k, v in own.items())})" if own else "")
        )

    def _point_buckets(self, known: Manifest) -> None:
        there = {r[0].split("=")[1] for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}
        for value, folder in known.folders.items():
            spec = f"PARTITION ({BUCKET} = {value})"
            path = f"{self.base_folder}/{folder}"
            if value in there:
                self.spark.sql(f"ALTER TABLE {self.name} {spec} SET LOCATION '{path}'")
            else:
                self.spark.sql(f"ALTER TABLE {self.name} ADD {spec} LOCATION '{path}'")
        for value in there - set(known.folders):
            self.spark.sql(f"ALTER TABLE {self.name} DROP PARTITION ({BUCKET} = {value})")

    def _properties(self) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}

    def expire(self, keep: int) -> None:
        """Delete data of all but the newest ``keep`` commits, sparing what the table still uses."""
        if keep < 1:
            raise ValueError("at least one version must be kept")
        known = self._known()
        self.publish()
        current = {*known.folders.values(), *(r["folder"] for r in known.runs)}
        found = [(int(m.group(1)), f) for f in files.listing(self.spark, self.base_folder) if (m := _SNAPSHOT.search(f.name))]
        used = {c.split("/")[0] for c in current}
        for _, f in sorted(found, key=lambda x: x[0])[:-keep]:
            if f.name not in used:
                files.delete(self.spark, f"{f.path}-stats")
            if f.name in current:
                continue
            parts = [p for p in files.listing(self.spark, f.path) if p.name.startswith(BUCKET + "=")]
            for part in parts or [f]:
                if not parts or f"{f.name}/{part.name}" not in current:
                    files.delete(self.spark, part.path)


def _within(low: Column, high: Column, least, most) -> Column:
    """Whether values from ``low`` to ``high`` can lie between the ends."""
    tests = [*([] if least is None else [high >= F.lit(least)]), *([] if most is None else [low <= F.lit(most)])]
    return reduce(and_, tests, low.isNotNull())


def _place(keys: Sequence[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets * PLACES_PER_BUCKET))


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[ref(k) for k in keys]), F.lit(buckets))


def _members(runs: Sequence[dict]) -> list[Run]:
    return [run_of(m) for r in runs for m in r["members"]]


def _mark_of(rows: DataFrame) -> int | None:
    """Greatest bronze ingestion time of rows with lineage, in microseconds."""
    if METADATA not in rows.columns or "bronze_ingested_at" not in getattr(rows.schema[METADATA].dataType, "names", ()):
        return None
    return rows.agg(F.unix_micros(F.max(F.col(f"{quoted(METADATA)}.bronze_ingested_at").cast("timestamp")))).first()[0]


def _stored_schema(schema: T.StructType) -> dict:
    """The schema as files have it: anything may be null, at any depth."""
    return json.loads(re.sub(r'"(nullable|containsNull|valueContainsNull)": ?false', r'"\1":true', json.dumps(schema.jsonValue())))


def _with_fields(known: T.StructType, seen: T.StructType) -> T.StructType:
    have = {f.name.lower() for f in known.fields}
    return T.StructType([*known.fields, *(f for f in seen.fields if f.name.lower() not in have)])
