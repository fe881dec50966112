"""A table that grows two ways: rows are appended below, feature columns are added beside.

Everything is Parquet. Raw rows and every feature column are bucketed by the row key into the
same buckets, so putting columns side by side needs no shuffle of the wide raw rows. Small
increments are kept as plain files instead (a bucketed write makes one file per bucket).
`manifest/` holds one small JSON file per version; no data file is ever rewritten.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrete.operators.feature import FeatureDef, in_dependency_order
from accrete.operators import keys
from accrete.operators.lookup import SHORT_LIST, in_list_order
from accrete.sources.files import Folder, split_table_path

RAW_SOURCE = "raw data"
BUCKETED, LOOSE = "bucketed", "loose"
PART = "accrete_part"
# New keys up to this number are looked for by Bloom bits; more are compared with all keys, bucket by bucket.
FEW_KEYS = 200_000
RANGES = "file string, rows long, least {0}, greatest {0}, part string"

# Key ranges of files by folder, part and its own name. Files never change, and Spark's list of them is as long.
_ranges: dict[tuple[str, str, str], pa.Table] = {}


class FeatureTable:
    def __init__(self, spark: SparkSession, folder: Folder, manifest: dict):
        self.spark, self.folder, self.manifest = spark, folder, manifest

    # ---- create and open -------------------------------------------------------------------

    @classmethod
    def create(
        cls, spark: SparkSession, path: str, df: DataFrame, key: str = "id", buckets: int | None = None,
        mode: str = "errorifexists", file_rows: int | None = None,
        group_rows: int | None = None,
    ) -> FeatureTable:
        """Write `df` as the raw rows of a new table (or, with mode "overwrite", of a new version).

        `key` must be unique and not null. Choose `buckets` for some hundred MB of raw data in
        each; a bucket is one task of every later column-side-by-side read. With `file_rows`, a bucket
        is cut into files of so many rows, in key order, so that `take` opens less; `group_rows` bounds the
        rows of a row group, which is the least that a task of a costly feature can be given.
        """
        folder = _folder(spark, path)
        last = _latest(folder)
        if last and mode != "overwrite":
            raise FileExistsError(f"{path} exists; use mode='overwrite'")
        version = last + 1
        manifest = {
            "version": last,
            "key": key,
            "buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions")),
            "schema": df.schema.jsonValue(),
            "base": f"base-{version:06d}",
            "file_rows": file_rows,
            "group_rows": group_rows,
            "parts": [],
            "features": {},
        }
        return cls(spark, folder, manifest)._add_part(df, bucketed=True, part=None)

    @classmethod
    def open(cls, spark: SparkSession, path: str, version: int | None = None) -> FeatureTable:
        folder = _folder(spark, path)
        version = version or _latest(folder)
        if not version:
            raise FileNotFoundError(path)
        return cls(spark, folder, json.loads(folder.read("manifest", _manifest_name(version))))

    def latest(self) -> FeatureTable:
        return FeatureTable.open(self.spark, self.folder.root)

    def as_of(self, version: int) -> FeatureTable:
        return FeatureTable.open(self.spark, self.folder.root, version)

    # ---- what is there ---------------------------------------------------------------------

    @property
    def version(self) -> int:
        return self.manifest["version"]

    @property
    def key(self) -> str:
        return self.manifest["key"]

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType.fromJson(self.manifest["schema"])

    @property
    def features(self) -> dict[str, dict]:
        return self.manifest["features"]

    @property
    def schema(self) -> T.StructType:
        added = [T.StructField(n, T.DataType.fromDDL(f["type"])) for n, f in self.features.items()]
        return T.StructType([*self.raw_schema.fields, *added])

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def count_rows(self) -> int:
        """Row count from the manifest; no data is read."""
        return sum(part["rows"] for part in self.manifest["parts"])

    def is_complete(self, name: str) -> bool:
        return {p["name"] for p in self.manifest["parts"]} <= set(self.features[name]["complete"])

    def provenance(self) -> DataFrame:
        """(column, type, source, is_new) in schema order."""
        rows = []
        for f in self.schema.fields:
            made = self.features.get(f.name)
            source = f"tier {made['tier']} feature of {', '.join(made['inputs'])}" if made else RAW_SOURCE
            rows.append((f.name, f.dataType.simpleString(), source, made is not None))
        return self.spark.createDataFrame(rows, "column string, type string, source string, is_new boolean")

    # ---- rows ------------------------------------------------------------------------------

    def append(
        self, df: DataFrame, bucketed: bool = False, part: str | None = None, on_repeat: str = "error",
    ) -> FeatureTable:
        """Add rows below the existing ones. Increments of at least a few thousand rows per bucket
        should be `bucketed`; small ones stay loose. A part already committed is left alone.

        Keys must stay unique and not null. A key that repeats inside `df` or is null raises; one
        that the table has already raises too, or with `on_repeat` "skip" its new row is left out,
        so a file that lands twice adds nothing. For a small increment Bloom bits of the parts tell which
        of them may have one of its keys, and only key columns of files around those keys are read.

        Like every change, it builds on the newest version and publishes the next one; of two
        writers at the same moment one gets FileExistsError and can simply try again."""
        if on_repeat not in ("error", "skip"):
            raise ValueError("on_repeat is error or skip")
        return self.latest()._add_part(df, bucketed, part, on_repeat)

    def _keys(self) -> DataFrame | None:
        parts = self.manifest["parts"]
        return self._stitch([self.key], parts) if parts else None

    def _suspected(self, rows: DataFrame) -> DataFrame | None:
        """The keys of `rows` that the table has, read only from files that may hold one; None where none
        can. Parts that Bloom bits rule out are not read, and of the others no file outside the range."""
        parts = [p for p in self.manifest["parts"] if p["rows"]]
        asked = keys.hashed_keys(rows, self.key, FEW_KEYS) if parts else None
        if asked is None:
            return self._keys().join(rows.select(self.key).distinct(), self.key, "left_semi") if parts else None
        ids = asked["key"]
        found: list[tuple[dict, pa.Table]] = [(p, asked) for p in parts if not p.get("indexed")]
        indexed = {p["name"]: p for p in parts if p.get("indexed")}
        if indexed and len(ids):
            place = f"{self.manifest['base']}/bits"
            bits = self.small_files(place, list(indexed), "shards int, shard int, bits binary, part string")
            hits = keys.suspects(bits, asked).toArrow()  # FEW_KEYS and those that pass by chance, part by part
            names, at = hits["part"].to_numpy(zero_copy_only=False), hits["at"].to_numpy()
            found += [(indexed[n], asked.take(pa.array(at[names == n]))) for n in sorted(set(names))]
        pieces = [
            self._scan_near(self.manifest["base"], self.raw_schema, p["layout"], [p["name"]], few["key"]).select(self.key)
            for p, few in found if few.num_rows
        ]
        return reduce(DataFrame.unionByName, pieces) if pieces else None

    def _refuse_repeats(self, added: DataFrame, among: bool) -> None:
        inside = added.groupBy(self.key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(self.key).isNull())
        bad = inside.select(self.key).head(1)
        known = self._suspected(added) if among and not bad else None
        if known is not None:
            bad = known.head(1)
        if bad:
            raise ValueError(f"key {self.key} is null or repeated: {bad[0][0]}")

    def _add_part(self, df: DataFrame, bucketed: bool, part: str | None, on_repeat: str = "error") -> FeatureTable:
        part = part or f"p{len(self.manifest['parts']):06d}-{uuid.uuid4().hex[:8]}"
        if any(p["name"] == part for p in self.manifest["parts"]):
            return self
        rows, base = df.select(*self.raw_schema.names), self.manifest["base"]
        known = self._suspected(rows) if on_repeat == "skip" else None
        if known is not None:
            rows = rows.join(known, self.key, "left_anti")
        layout = BUCKETED if bucketed else LOOSE
        if bucketed:
            rows = rows.repartition(self.manifest["buckets"], self.key)
        self._write(rows, base, layout, part)
        added = self._scan(base, self.raw_schema, layout, [part])
        self._refuse_repeats(added.select(self.key), on_repeat == "error")
        count = self._index(base, layout, part)
        self.put_small(keys.key_bits(added, self.key, count), f"{base}/bits", part)
        # A name of its own for what is known of this part: another table may come to stand in its place.
        entry = {"name": part, "layout": layout, "rows": count, "indexed": uuid.uuid4().hex}
        return self._commit(parts=[*self.manifest["parts"], entry])

    # ---- key ranges ------------------------------------------------------------------------

    def put_small(self, df: DataFrame, place: str, part: str) -> None:
        """Write a few rows about a part; writing them again changes nothing."""
        df.coalesce(1).write.mode("overwrite").parquet(self.folder.path(*place.split("/"), f"part={part}"))

    def part_rows(self, part: str, columns: list[str]) -> DataFrame:
        """Raw columns of one part."""
        layout = next(p["layout"] for p in self.manifest["parts"] if p["name"] == part)
        return self._scan(self.manifest["base"], self.raw_schema, layout, [part]).select(*dict.fromkeys(columns))

    def _index(self, folder: str, layout: str, part: str) -> int:
        """Write down the key range of each file of a part, and give the number of its rows."""
        place = self.folder.path(*_place(folder, layout, part).split("/"))
        kind = self.raw_schema[self.key].dataType.simpleString()
        rows = self.spark.read.schema(T.StructType([self.raw_schema[self.key]])).parquet(place)
        self.put_small(keys.file_ranges(rows, self.key), f"{folder}/ranges", part)
        return sum(self.small_files(f"{folder}/ranges", [part], RANGES.format(kind)).toArrow()["rows"].to_pylist())

    def small_files(self, place: str, parts: list[str], schema: str) -> DataFrame:
        """What `put_small` wrote about these parts, with the column `part`."""
        root = self.folder.path(*place.split("/"))
        return self.spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/part={p}" for p in parts])

    def _file_ranges(self, folder: str, parts: list[str]) -> pa.Table:
        root, told = self.folder.path(*folder.split("/")), {p["name"]: p.get("indexed") for p in self.manifest["parts"]}
        keyed = {p: (root, p, str(told.get(p, ""))) for p in parts}
        absent = [p for p in parts if keyed[p] not in _ranges]
        if absent:
            kind = self.raw_schema[self.key].dataType.simpleString()
            found = self.small_files(f"{folder}/ranges", absent, RANGES.format(kind)).toArrow()
            names = found["part"].to_numpy(zero_copy_only=False)
            if len(_ranges) > 10_000:
                _ranges.clear()
            _ranges.update({keyed[p]: found.filter(pa.array(names == p)) for p in absent})
        return pa.concat_tables([_ranges[keyed[p]] for p in parts])

    def _scan_near(self, folder: str, schema: T.StructType, layout: str, parts: list[str], ids: pa.ChunkedArray) -> DataFrame:
        """The rows of `ids` in these parts; only files whose range holds one of them are opened."""
        wanted = F.broadcast(self.spark.createDataFrame(pa.table({self.key: ids})).select(
            F.col(self.key).cast(schema[self.key].dataType)).distinct())
        indexed = {p["name"] for p in self.manifest["parts"] if p.get("indexed")}
        indexed |= {c["name"] for f in self.features.values() for c in f["chunks"] if c.get("indexed")}
        if not set(parts) <= indexed:
            return self._scan(folder, schema, layout, parts).join(wanted, self.key, "left_semi")
        known, numbers = self._file_ranges(folder, parts), np.unique(ids.to_numpy(zero_copy_only=False))
        files = known["file"].to_numpy(zero_copy_only=False)
        places = np.array([f"{p}/{f}" for p, f in zip(known["part"].to_pylist(), files)], object)
        buckets = ()
        if layout == BUCKETED:
            kind = self.raw_schema[self.key].dataType.simpleString()
            buckets = (np.array([int(_bucket(f)) for f in files], np.int64),
                       keys.bucket_numbers(self.spark, numbers, self.key, kind, self.manifest["buckets"]))
        least, greatest = (known[c].to_numpy(zero_copy_only=False) for c in ("least", "greatest"))
        near = [p.split("/") for p in keys.holding_files(places, least, greatest, numbers, *buckets)]
        if not near:
            return self.spark.createDataFrame([], schema)
        paths = [self.folder.path(*_place(folder, layout, p).split("/"), f) for p, f in near]
        ends = numbers[[0, -1]].tolist()
        inside = F.col(self.key).between(*map(F.lit, ends))
        return self.spark.read.schema(schema).parquet(*paths).where(inside).join(wanted, self.key, "left_semi")

    # ---- feature columns -------------------------------------------------------------------

    def add_columns(self, features: dict[str, FeatureDef] | list[FeatureDef]) -> FeatureTable:
        """Register feature columns; they read as null until backfilled. Unchanged ones are kept.

        A column's version is made of its code and of the versions of the features it reads. So when one
        of those changes, every feature that reads it, directly or through others, gets a new version too,
        which is empty until it is backfilled: no value made of older inputs is read beside newer ones.
        Features on other branches, and earlier versions of the table, are left as they are.
        """
        listed = list(features.values() if isinstance(features, dict) else features)
        table = self.latest()
        known = dict(table.features)
        for f in in_dependency_order(listed):
            if f.name in table.raw_schema.names:
                raise ValueError(f"{f.name} is a raw column")
            absent = [c for c in f.inputs if c not in known and c not in table.raw_schema.names]
            if absent:
                raise KeyError(f"{f.name} reads columns that are not there: {absent}")
            made = {"type": f.data_type, "inputs": list(f.inputs), "tier": f.tier, "kind": f.kind, "fingerprint": f.fingerprint()}
            stamp = _stamp(made, known)
            if f.name in known and known[f.name]["fingerprint"] == made["fingerprint"] and _stamp_of(f.name, known) == stamp:
                continue
            known[f.name] = _unfilled(f.name, made, stamp, read=[c for c in f.inputs if c in known])
        known = _carried(known)
        return table if known == table.features else table._commit(features=known)

    def versions(self) -> DataFrame:
        """(feature, version, input, input_version, stale): the version graph, an edge for each input that
        a feature reads; raw columns have no version. `stale` features lost their values to a change
        upstream and are not filled again yet."""
        rows = []
        for name, entry in self.features.items():
            for column in entry["inputs"]:
                version = _stamp_of(column, self.features) if column in self.features else None
                rows.append((name, _stamp_of(name, self.features), column, version, name in self.stale))
        return self.spark.createDataFrame(
            rows, "feature string, version string, input string, input_version string, stale boolean")

    @property
    def stale(self) -> list[str]:
        """Features that a change upstream emptied and that are not filled again yet."""
        return [n for n, f in self.features.items() if f.get("emptied") and not self.is_complete(n)]

    def drop_columns(self, names: list[str]) -> FeatureTable:
        """A version without these features; earlier versions still read them."""
        table = self.latest()
        missing = [n for n in names if n not in table.features]
        if missing:
            raise KeyError(f"not feature columns: {missing}")
        return table._commit(features={n: f for n, f in table.features.items() if n not in names})

    def backfill(
        self, feature: FeatureDef, concurrency: int = 1, task_size: int | None = None,
        checkpoint_size: int | None = None, max_chunks: int | None = None,
    ) -> FeatureTable:
        """Fill a feature for every row that lacks it, and publish a new version.

        Work is done in chunks of about `checkpoint_size` rows (whole files of raw data), each
        one Spark job whose result is kept whatever happens later: a rerun skips the files
        already done. `concurrency` chunks run at a time. `task_size` bounds the rows of one
        task for costly features; `max_chunks` ends a time-boxed run early, a later call goes on.
        New code under the same name starts a new column version. Rows for which a feature that is
        read is not filled yet are left for a later call.
        """
        table = self.add_columns([feature])
        entry = table.features[feature.name]
        if table.is_complete(feature.name):
            return table
        chunks = table._open_chunks(feature, entry, checkpoint_size)[:max_chunks]
        try:
            with ThreadPoolExecutor(max(1, concurrency)) as pool:
                list(pool.map(lambda c: table._fill(feature, entry, c, task_size), chunks))
        finally:
            table = table._publish_progress(feature.name)
        return table

    def backfill_all(self, features: list[FeatureDef], **options) -> FeatureTable:
        """Backfill several features, each after the features it reads."""
        table = self
        for f in in_dependency_order(features):
            table = table.backfill(f, **options)
        return table

    def _open_chunks(self, feature: FeatureDef, entry: dict, checkpoint_size: int | None) -> list[dict]:
        read = [self.features[c] for c in feature.inputs if c in self.features]
        open_parts = [p for p in self._open_parts(entry) if all(p["name"] in f["complete"] for f in read)]
        done = self._done(entry, open_parts)
        stitched = bool(read)
        chunks = []
        for part in open_parts:
            folder = _place(self.manifest["base"], part["layout"], part["name"])
            finished = {f for d in done if d["part"] == part["name"] for f in d["files"]}
            files = [f for f in self.folder.files(*folder.split("/")) if f not in finished]
            step = len(files)
            if checkpoint_size and part["rows"]:
                all_files = len(files) + len(finished)
                step = max(1, math.floor(checkpoint_size * all_files / part["rows"]))
            for i in range(0, len(files), max(step, 1)):
                chunks.append({
                    "name": f"{part['name']}-{uuid.uuid4().hex[:8]}", "part": part["name"],
                    "layout": part["layout"], "folder": folder, "files": files[i : i + step],
                    "stitched": stitched, "whole": step >= len(files) and not finished,
                })
        return chunks

    def _fill(self, feature: FeatureDef, entry: dict, chunk: dict, task_size: int | None) -> None:
        rows = self._rows_to_fill(feature, chunk, task_size)
        self._write(feature.apply(rows, self.key), entry["folder"], chunk["layout"], chunk["name"])
        self._index(entry["folder"], chunk["layout"], chunk["name"])
        record = {**{k: chunk[k] for k in ("name", "part", "layout", "files")}, "indexed": True}
        self.folder.publish(json.dumps(record), *entry["folder"].split("/"), "done", f"{chunk['name']}.json")

    def _rows_to_fill(self, feature: FeatureDef, chunk: dict, task_size: int | None) -> DataFrame:
        """Key and inputs of the rows of a chunk, in tasks of about `task_size` rows: raw files are cut where
        the scan reads them, so nothing is shuffled. Inputs that are joined are dealt out by key."""
        columns = list(dict.fromkeys([self.key, *feature.inputs]))
        made = [c for c in columns if c in self.features]
        if chunk["stitched"] and chunk["whole"]:
            rows = self._stitch(columns, [p for p in self.manifest["parts"] if p["name"] == chunk["part"]])
        else:
            wanted = T.StructType([f for f in self.raw_schema.fields if f.name in columns])
            folder = chunk["folder"].split("/")
            paths = [self.folder.path(*folder, f) for f in chunk["files"]]
            spark = self._with_splits(chunk, task_size) if task_size and not made else self.spark
            rows = spark.read.schema(wanted).parquet(*paths)
            for name in made:
                rows = rows.join(self._feature_beside(name, chunk), self.key, "left")
            rows = rows.select(*columns)
        if task_size and made:
            tasks = math.ceil(max(self._rows_of(chunk), 1) / task_size)
            if chunk["layout"] == BUCKETED:
                # A multiple of the buckets, so that each task still belongs to one bucket.
                tasks = math.ceil(tasks / self.manifest["buckets"]) * self.manifest["buckets"]
            rows = rows.repartition(tasks, self.key)
        return rows

    def _rows_of(self, chunk: dict) -> int:
        """Rows in the raw files of a chunk, from their key ranges; of the whole part if it has none."""
        part = next(p for p in self.manifest["parts"] if p["name"] == chunk["part"])
        if not part.get("indexed"):
            return part["rows"]
        known, files = self._file_ranges(self.manifest["base"], [chunk["part"]]), set(chunk["files"])
        return sum(n for f, n in zip(known["file"].to_pylist(), known["rows"].to_pylist()) if f in files)

    def _with_splits(self, chunk: dict, task_size: int) -> SparkSession:
        """A session like this one whose scans give a task the bytes that about `task_size` of the chunk's rows
        take. A row group is the least a task can read; `group_rows` of the table bounds it."""
        sizes = self.folder.sizes(*chunk["folder"].split("/"))
        taken = sum(sizes[f] for f in chunk["files"])
        session = self.spark.newSession()
        for name, value in self.spark.conf.getAll.items():
            if self.spark.conf.isModifiable(name):
                session.conf.set(name, value)
        session.conf.set("spark.sql.files.maxPartitionBytes", max(1, taken * task_size // max(self._rows_of(chunk), 1)))
        session.conf.set("spark.sql.files.openCostInBytes", 0)
        session.conf.set("spark.sql.files.minPartitionNum", 1)
        return session

    def _feature_beside(self, name: str, chunk: dict) -> DataFrame:
        """A feature of the rows in a chunk's raw files: only its files of the same buckets are read."""
        entry, schema = self.features[name], self._feature_schema(name)
        mine = {_bucket(f) for f in chunk["files"]}
        paths = []
        for done in entry["chunks"]:
            if done["part"] == chunk["part"]:
                place = _place(entry["folder"], done["layout"], done["name"]).split("/")
                paths += [self.folder.path(*place, f) for f in self.folder.files(*place)
                          if done["layout"] == LOOSE or _bucket(f) in mine]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _open_parts(self, entry: dict) -> list[dict]:
        complete = set(entry["complete"])
        return [p for p in self.manifest["parts"] if p["name"] not in complete]

    def _done(self, entry: dict, parts: list[dict]) -> list[dict]:
        """Records of finished chunks of these parts; a chunk is named after its part."""
        place, wanted = [*entry["folder"].split("/"), "done"], {p["name"] for p in parts}
        names = [n for n in self.folder.files(*place) if n.rsplit("-", 1)[0] in wanted]
        return [json.loads(self.folder.read(*place, n)) for n in names]

    def _publish_progress(self, name: str) -> FeatureTable:
        table = self.latest()
        entry = table.features[name]
        open_parts = table._open_parts(entry)
        done = table._done(entry, open_parts)
        complete = list(entry["complete"])
        for part in open_parts:
            folder = _place(table.manifest["base"], part["layout"], part["name"])
            finished = {f for d in done if d["part"] == part["name"] for f in d["files"]}
            if set(table.folder.files(*folder.split("/"))) <= finished:
                complete.append(part["name"])
        known = {c["name"] for c in entry["chunks"]}
        added = [{k: d[k] for k in ("name", "part", "layout", "indexed") if k in d} for d in done if d["name"] not in known]
        if complete == entry["complete"] and not added:
            return table
        changed = {**entry, "complete": complete, "chunks": [*entry["chunks"], *added]}
        return table._commit(features={**table.features, name: changed})

    # ---- reading ---------------------------------------------------------------------------

    def select(self, *columns: str) -> DataFrame:
        """The named columns of every row. Only the folders holding them are touched: features
        not named are not joined, and complete features are read without the raw rows."""
        unknown = [c for c in columns if c not in self.columns]
        if unknown:
            raise KeyError(f"no such columns: {unknown}")
        return self._stitch(list(columns), self.manifest["parts"]).select(*columns)

    def to_df(self) -> DataFrame:
        return self.select(*self.columns)

    def read_columns(self, columns: list[str], limit: int | None = None) -> DataFrame:
        """Columns of the newest version, the first `limit` rows in key order."""
        table = self.latest()
        if limit is None or limit >= table.count_rows():
            return table.select(*columns)
        kept = table.select(*dict.fromkeys([self.key, *columns]))
        return kept.orderBy(self.key).limit(limit).select(*columns)

    def take(self, ids: list[int] | DataFrame, columns: list[str]) -> DataFrame:
        """Rows of an id list, in its order and with its repeats, from stored columns; unknown ids are left out.

        For a list of up to SHORT_LIST ids only files are opened whose bucket and key range hold one of them,
        of the folders of these columns. A longer list, or a DataFrame with the key and the order in `_pos`,
        is joined with the table, whose side is not shuffled.
        """
        named = list(dict.fromkeys([self.key, *columns]))
        if isinstance(ids, DataFrame):
            return self.select(*named).join(ids.select(self.key, "_pos"), self.key).orderBy("_pos").select(*columns)
        if not ids:
            return self.select(*columns).limit(0)
        kind = self.raw_schema[self.key].dataType
        wanted = self.spark.createDataFrame(pa.table({"_pos": pa.array(range(len(ids)), pa.int64()), self.key: pa.array(ids)}))
        wanted = wanted.select("_pos", F.col(self.key).cast(kind).alias(self.key))
        if len(ids) > SHORT_LIST:
            return self.take(wanted, columns)
        some = pa.chunked_array([pa.array(ids)])
        near = self._stitch(named, self.manifest["parts"], lambda *where: self._scan_near(*where, some))
        return in_list_order(near.join(F.broadcast(wanted), self.key), columns)

    def bucket_pieces(self, columns: list[str]) -> list[tuple[int, DataFrame]]:
        """(first, rows) by layout: the named columns with all rows of a bucket in one partition, and the
        number that the layout's buckets count from. Only loose increments are shuffled for that."""
        pieces = []
        for i, layout in enumerate((BUCKETED, LOOSE)):
            held = [p for p in self.manifest["parts"] if p["layout"] == layout and p["rows"]]
            if held:
                rows = self._side_by_side(list(dict.fromkeys([self.key, *columns])), layout, held, self._scan)
                if layout == LOOSE:
                    rows = rows.repartition(self.manifest["buckets"], self.key)
                pieces.append((i * self.manifest["buckets"], rows))
        return pieces

    def missing_rows(self, name: str) -> DataFrame:
        """Keys of rows a feature does not cover yet, whatever the manifest says."""
        parts = self.manifest["parts"]
        base = self._stitch([self.key], parts)
        filled = [self._scan_feature(name, layout, parts) for layout in (BUCKETED, LOOSE)]
        for df in filter(None, filled):
            base = base.join(df.select(self.key), self.key, "left_anti")
        return base

    def _stitch(self, columns: list[str], parts: list[dict], scan: Callable[..., DataFrame] | None = None) -> DataFrame:
        pieces = []
        for layout in (BUCKETED, LOOSE):
            held = [p for p in parts if p["layout"] == layout]
            if held:
                pieces.append(self._side_by_side(columns, layout, held, scan or self._scan))
        return reduce(DataFrame.unionByName, pieces)

    def _side_by_side(self, columns: list[str], layout: str, parts: list[dict], scan: Callable[..., DataFrame]) -> DataFrame:
        names = [p["name"] for p in parts]
        raw = [c for c in columns if c in self.raw_schema.names and c != self.key]
        made = [c for c in columns if c in self.features]
        groups = {c: self._scan_feature(c, layout, parts, scan) for c in made}
        partial = [c for c in made if groups[c] is None or not set(names) <= set(self.features[c]["complete"])]
        df, how = None, "inner"
        if raw or partial or not made:
            df = scan(self.manifest["base"], self.raw_schema, layout, names).select(self.key, *raw)
            how = "left"
        for c in made:
            if groups[c] is None:
                df = df.withColumn(c, F.lit(None).cast(T.DataType.fromDDL(self.features[c]["type"])))
            else:
                df = groups[c] if df is None else df.join(groups[c], self.key, how)
        return df.select(*dict.fromkeys([self.key, *columns]))

    def _scan_feature(
        self, name: str, layout: str, parts: list[dict], scan: Callable[..., DataFrame] | None = None,
    ) -> DataFrame | None:
        entry = self.features[name]
        held = {p["name"] for p in parts}
        chunks = [c["name"] for c in entry["chunks"] if c["layout"] == layout and c["part"] in held]
        return (scan or self._scan)(entry["folder"], self._feature_schema(name), layout, chunks) if chunks else None

    def _feature_schema(self, name: str) -> T.StructType:
        kind = T.DataType.fromDDL(self.features[name]["type"])
        return T.StructType([self.raw_schema[self.key], T.StructField(name, kind)])

    # ---- files -----------------------------------------------------------------------------

    def _catalog_table(self, folder: str, schema: T.StructType, parts: list[str]) -> str:
        """Session table over a bucketed folder: the catalog is where Spark keeps bucketing."""
        location = self.folder.path(*folder.split("/"), BUCKETED)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        name = "accrete_" + hashlib.sha256(f"{location} {fields}".encode()).hexdigest()[:20]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({fields}, {PART} string) USING parquet "
            f"PARTITIONED BY ({PART}) CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
            f"INTO {self.manifest['buckets']} BUCKETS LOCATION '{location}'"
        )
        if parts:
            specs = " ".join(f"PARTITION ({PART}='{p}')" for p in parts)
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
        return name

    def _scan(self, folder: str, schema: T.StructType, layout: str, parts: list[str]) -> DataFrame:
        if layout == BUCKETED:
            table = self._catalog_table(folder, schema, parts)
            return self.spark.table(table).where(F.col(PART).isin(parts)).drop(PART)
        paths = [self.folder.path(*folder.split("/"), LOOSE, p) for p in parts]
        return self.spark.read.schema(schema).parquet(*paths)

    def _write(self, df: DataFrame, folder: str, layout: str, part: str) -> None:
        # Each part is a folder of its own, so jobs running side by side cannot disturb each other.
        place = self.folder.path(*_place(folder, layout, part).split("/"))
        writer = df.write.mode("overwrite").format("parquet").option("path", place)
        if self.manifest.get("file_rows"):
            writer = writer.option("maxRecordsPerFile", self.manifest["file_rows"])
        if self.manifest.get("group_rows"):
            writer = writer.option("parquet.block.row.count.limit", self.manifest["group_rows"])
        if layout == LOOSE:
            writer.save()
            return
        table = f"accrete_{uuid.uuid4().hex}"
        writer.bucketBy(self.manifest["buckets"], self.key).sortBy(self.key).saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")  # external: the files stay

    def _commit(self, **changes) -> FeatureTable:
        manifest = {**self.manifest, **changes, "version": self.version + 1, "parent": self.version}
        self.folder.publish(json.dumps(manifest, indent=1), "manifest", _manifest_name(manifest["version"]))
        return FeatureTable(self.spark, self.folder, manifest)


def _stamp(entry: dict, known: dict[str, dict]) -> str:
    """Version of a feature: its code and, feature by feature, the versions of those it reads."""
    read = [(c, _stamp_of(c, known)) for c in entry["inputs"] if c in known]
    if not read:
        return entry["fingerprint"]
    return hashlib.sha256(repr((entry["fingerprint"], read)).encode()).hexdigest()[:16]


def _stamp_of(name: str, known: dict[str, dict]) -> str:
    """The version a feature was registered with; tables written before there were any have the
    fingerprint of the code."""
    return known[name].get("stamp", known[name]["fingerprint"])


def _unfilled(name: str, made: dict, stamp: str, **more) -> dict:
    folder = f"features/{name}-{stamp}-{uuid.uuid4().hex[:6]}"
    return {**made, "stamp": stamp, "complete": [], "chunks": [], "folder": folder, **more}


def _carried(known: dict[str, dict]) -> dict[str, dict]:
    """Features whose inputs are of another version than they were made of are emptied, and so on along
    the graph. One that reads a column that was dropped keeps its values: nothing can replace them."""
    known, done = dict(known), set()

    def visit(name: str, above: tuple[str, ...]) -> None:
        if name in above:
            raise ValueError("features read each other: " + " -> ".join([*above, name]))
        if name in done:
            return
        entry = known[name]
        for column in entry["inputs"]:
            if column in known:
                visit(column, (*above, name))
        done.add(name)
        made = {k: entry[k] for k in ("type", "inputs", "tier", "kind", "fingerprint")}
        if "stamp" in entry and entry["stamp"] != _stamp(made, known) and all(c in known for c in entry.get("read", ())):
            known[name] = {**_unfilled(name, made, _stamp(made, known), emptied=True), "read": entry.get("read", [])}

    for name in list(known):
        visit(name, ())
    return known


def _folder(spark: SparkSession, path: str) -> Folder:
    parent, name = split_table_path(path)
    return Folder(spark, f"{parent}/{name}")


def _manifest_name(version: int) -> str:
    return f"v{version:06d}.json"


def _latest(folder: Folder) -> int:
    names = folder.files("manifest")
    return int(names[-1][1:-5]) if names else 0


def _bucket(file: str) -> str:
    """Bucket number in the name of a bucketed file."""
    return file.rsplit("_", 1)[-1].split(".", 1)[0]


def _place(folder: str, layout: str, part: str) -> str:
    return f"{folder}/{layout}/{PART}={part}" if layout == BUCKETED else f"{folder}/{layout}/{part}"
