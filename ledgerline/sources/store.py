"""Parquet table storage for the layers, without a table format.

Layout under ``root`` (any file system Spark can write, e.g. a shared bucket):

    raw/<table>/_batch=<load time>-<run>/_month=<business month>/       append-only version log
    <layer>/<model>/_commit=<version>-<run>/<partition>=<value>/        models
    _ledger/<layer>.<model>/_commit=<version>-<run>/                    totals of each commit's partitions (``plans.ledger``)
    _keys/<layer>.<model>/_commit=<version>-<run>/                      Bloom filters of keys (``operators.key_filter``)
    _changes/<layer>.<model>/_commit=<version>-<run>/                   signed changes of each commit (facts)
    _commits/<table>/<version>.json, _runs/<token>.json                 manifests (``sources.manifest``)
    _work/<run>/<name>/                                                 batches of one run

* Keyed models are partitioned by the month of an immutable business date (``_month``) or by a hash bucket of the key
  (``_bucket``). delete+insert reads the live partitions the batch touches and writes them anew into a commit folder of
  its own; day tables (``activity_date``) get the days of the batch the same way. Nothing that a reader may use is
  overwritten: the manifest, published last, names the live partitions of every commit folder.
* A run that dies before its manifest leaves the table as it was, and its folder is never read; the rerun recomputes the
  same batch. Two runs at once: one is refused (``ConcurrentWrite``). ``vacuum`` deletes what no manifest needs.
* Ledgers, key filters and change feeds lie under the same commit folder's name and are live with it.
* The raw log refuses a load time that is not after the last one (the watermark is a strict ``>``). Repeating the last
  load is a no-op when it brings nothing new, and an error otherwise. Only published loads are read.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import key_filter, quality
from ledgerline.operators.incremental import delete_insert, rows_with_keys
from ledgerline.plans import ledger
from ledgerline.plans.build import SENTINEL, Table, measured, table_from
from ledgerline.schemas import LOADED_AT, MODELS, RAW_TABLES, STATE, raw_schema
from ledgerline.sources.manifest import Manifest, Manifests

BUCKETS = 64  # partitions of undated keyed models (dimensions, small staging tables)
# Keys enforced unique on write (a unique index in the source system): the batch is checked
# before anything is written.
ENFORCED_UNIQUE = {"players": ("player_id",), "dim_player": ("player_id",)}
INTERNAL = ("_month", "_bucket", "_batch", "_commit")
FEEDS = 100  # commits whose change feeds are kept for a consumer that lags behind
# Unique keys of tables that are partitioned by another column: a key could return in another partition.
SPREAD_KEYS = {name: m.keys[0] for name, m in MODELS.items() if m.partition_by == "_month" and len(m.keys) == 1}
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class LoadOrderError(ValueError):
    pass


def _batch_tag(ts: dt.datetime) -> int:
    """Directory value of a load: microseconds since 1970 (read back as LONG), so that no two load times share one."""
    return (ts.replace(tzinfo=None) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def _month_of_text(c: str):
    """yyyyMM of an ISO date text as INT; NULL (default partition) when the text is no date."""
    return F.when(
        F.col(c).rlike(r"^[0-9]{4}-[0-9]{2}"), F.concat(F.substring(c, 1, 4), F.substring(c, 6, 2)).cast("int")
    )


def _observed_rows(obs: Observation) -> int:
    """Row count of an observed sub-plan; AQE prunes a sub-plan it found empty together with its
    metrics, so missing metrics mean zero rows."""
    return int(obs.get.get("rows") or 0)


class TableStore:
    partitioned = True  # models are partitioned directories

    def __init__(self, spark: SparkSession, root: str, run_id: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.run_id = run_id or uuid.uuid4().hex[:12]
        self.manifests = Manifests(spark, self.root)
        self._known: dict[str, Manifest | None] = {}  # a store sees one version of a table until it commits the next

    # --- paths -------------------------------------------------------------------
    def raw_path(self, table: str) -> str:
        return f"{self.root}/raw/{table}"

    def model_path(self, name: str) -> str:
        return f"{self.root}/{MODELS[name].layer}/{name}"

    def _key(self, name: str) -> str:
        return f"{MODELS[name].layer}.{name}"

    def ledger_path(self, name: str) -> str:
        return f"{self.root}/_ledger/{self._key(name)}"

    def keys_path(self, name: str) -> str:
        return f"{self.root}/_keys/{self._key(name)}"

    def changes_path(self, name: str) -> str:
        return f"{self.root}/_changes/{self._key(name)}"

    def work_path(self, name: str) -> str:
        return f"{self.root}/_work/{self.run_id}/{name}"

    # --- manifests ------------------------------------------------------------------
    def begin_run(self) -> int:
        """Refuse all commits of runs that began earlier, from now on."""
        return self.manifests.begin_run(self.run_id)

    def manifest(self, key: str) -> Manifest | None:
        if key not in self._known:
            self._known[key] = self.manifests.latest(key)
        return self._known[key]

    def last_commit(self, key: str) -> dict | None:
        m = self.manifest(key)
        if m is None:
            return None
        watermark = dt.datetime.fromisoformat(m.watermark) if m.watermark else None
        return {"version": m.version, "watermark": watermark, "rows": m.rows, "run_id": m.run, "loads": m.loads}

    def _commit(self, key: str, watermark: dt.datetime | None, rows: int, changed: dict | None = None) -> Manifest:
        """Publish the next version of a table (after the data it names); what isn't ``changed`` stays."""
        before = self.manifest(key)
        kept = {} if before is None else {k: getattr(before, k) for k in ("schema", "folders", "loads", "zone", "history", "consumed", "checked")}
        version = self.manifests.next_version(key)
        new = Manifest(version, self.run_id, watermark.isoformat() if watermark else None, rows, **(kept | (changed or {})))
        self._known[key] = self.manifests.publish(key, new, before)
        return new

    def _commit_folder(self, name: str) -> str:
        return f"_commit={self.manifests.next_version(self._key(name)):08d}-{self.run_id}"

    def vacuum(self) -> list[str]:
        """Delete commit folders that no kept manifest names, and change feeds no consumer may need; returns them. Not for
        use while other runs write: the folder of a commit still under way is named by no manifest."""
        gone = []
        for name in MODELS:
            key, needed, feeds = self._key(name), set(), set()
            for n in self.manifests._numbers(self.manifests._folder(key)):
                m = json.loads(self.manifests.files.read(f"{self.manifests._folder(key)}/{n:012d}.json"))
                needed |= set(m["folders"])
                feeds |= {folder for _, folder in m["history"]}
            sides = (self.model_path(name), self.ledger_path(name), self.keys_path(name))
            for path, keep in (*[(x, needed) for x in sides], (self.changes_path(name), feeds)):
                for folder in self.manifests.files.names(path):
                    if folder.startswith("_commit=") and folder not in keep:
                        self.manifests.files.delete(f"{path}/{folder}")
                        gone.append(f"{path}/{folder}")
        return gone

    # --- raw version log ----------------------------------------------------------
    def read_raw(self, table: str, since: dt.datetime | None = None, from_date: dt.date | None = None) -> DataFrame | None:
        """The raw log, pruned to loads after ``since`` and business months from ``from_date``."""
        last = self.last_commit(f"raw.{table}")
        if last is None:
            return None
        # only published loads: a load that died is no part of the log
        first = _batch_tag(since) if since is not None else None
        published = [x for x in last["loads"] if first is None or int(x.split("-")[0]) >= first]
        df = self.spark.read.schema(self._raw_schema(table)).parquet(self.raw_path(table)).filter(F.col("_batch").isin(published))
        if since is not None:
            df = df.filter(F.col(LOADED_AT) > F.lit(since).cast(T.TimestampType()))
        if from_date is not None and RAW_TABLES[table].date_column:
            df = df.filter(F.col("_month") >= F.lit(int(from_date.strftime("%Y%m"))))
        return df.drop("_batch", "_month")

    def _raw_schema(self, table: str) -> T.StructType:
        parts = [T.StructField("_batch", T.StringType()), T.StructField("_month", T.IntegerType())]
        return T.StructType([*raw_schema(table).fields, *parts])

    def append_versions(self, table: str, rows: DataFrame, batch_ts: dt.datetime) -> int:
        """Append one load (every row stamped ``loaded_at = batch_ts``); returns rows written."""
        last = self.last_commit(f"raw.{table}")
        if last is not None:
            if batch_ts == last["watermark"]:
                if rows.isEmpty():
                    return 0  # a rerun: the log has all of this load's versions
                raise LoadOrderError(f"raw.{table}: another load was stored at {batch_ts}")
            if batch_ts < last["watermark"]:
                raise LoadOrderError(f"raw.{table}: load time {batch_ts} is not after the last one {last['watermark']}")
        cfg = RAW_TABLES[table]
        out = rows.withColumn(LOADED_AT, F.lit(batch_ts).cast(T.TimestampType()))
        month = _month_of_text(cfg.date_column) if cfg.date_column else F.lit(0)
        out = out.withColumn("_month", month)
        obs = Observation()
        day = F.to_date(cfg.date_column, "yyyy-MM-dd") if cfg.date_column else F.lit(None).cast("date")
        seen = [F.count(F.lit(1)).alias("rows"), F.min(day).alias("lowest"), F.max(day).alias("highest")]
        out = out.hint("rebalance", "_month").observe(obs, *seen)
        load = f"{_batch_tag(batch_ts)}-{self.run_id}"  # a run's own folder: a run that died or lost is never read
        target = f"{self.raw_path(table)}/_batch={load}"
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_month").parquet(target)
        written = _observed_rows(obs)
        total = (last["rows"] if last else 0) + written
        self._commit(f"raw.{table}", batch_ts, total, {"loads": [*(last["loads"] if last else []), load], "zone": self._zone(table, obs)})
        return written

    def _zone(self, table: str, obs: Observation) -> list[str]:
        """The stored dates' range once a load's is added."""
        before = self.manifest(f"raw.{table}")
        found = [x.isoformat() for x in (obs.get.get("lowest"), obs.get.get("highest")) if x is not None]
        found += before.zone if before else []
        return [min(found), max(found)] if found else []

    def newest_date(self, table: str) -> dt.date | None:
        """The newest business date in the raw log, from its manifest: no file is read."""
        m = self.manifest(f"raw.{table}")
        return dt.date.fromisoformat(m.zone[1]) if m and m.zone else None

    # --- models -------------------------------------------------------------------------
    def _with_partition(self, name: str, df: DataFrame) -> DataFrame:
        layout = MODELS[name]
        if layout.partition_by == "_month":
            return df.withColumn("_month", F.date_format(F.col(layout.date_column), "yyyyMM").cast("int"))
        if layout.partition_by == "_bucket":
            return df.withColumn("_bucket", F.pmod(F.xxhash64(*layout.keys), F.lit(BUCKETS)))
        return df

    def read_model(self, name: str) -> Table | None:
        m = self.manifest(self._key(name))
        if m is None:
            return None
        # ``_month`` stays visible so readers can prune months; buckets and commits are dropped
        df = self._read(name, self.model_path(name), m, T.StructType.fromJson(json.loads(m.schema)))
        state = df.drop(*[x for x in INTERNAL if x != "_month"])
        visible = state.drop(*[c for c in state.columns if c.startswith(STATE)])
        watermark = dt.datetime.fromisoformat(m.watermark) if m.watermark else SENTINEL
        return Table(visible, watermark, m.rows, state=state, version=m.version, consumed=m.consumed)

    def _read(self, name: str, path: str, m: Manifest, schema: T.StructType, only: Sequence[str] | None = None) -> DataFrame:
        """The live partitions (or ``only`` those of them) of the folders that a manifest names."""
        part = MODELS[name].partition_by
        parts = {f: [p for p in own["live"] if only is None or p in only] for f, own in m.folders.items()}
        parts = {f: own for f, own in parts.items() if own}
        fields = [f for f in schema.fields if f.name != part]
        whole = T.StructType([*fields, T.StructField("_commit", T.StringType()), schema[part]])
        if not parts:
            return self.spark.createDataFrame([], whole)
        conditions = []
        for folder, own in parts.items():
            here = F.col("_commit") == folder.split("=", 1)[1]
            if only is None:
                dead = m.folders[folder]["dead"]
                conditions.append(here & ~self._in_parts(part, schema[part].dataType, dead) if dead else here)
            else:
                conditions.append(here & self._in_parts(part, schema[part].dataType, own))
        df = self.spark.read.schema(whole).option("basePath", path).parquet(*[f"{path}/{f}" for f in parts])
        return df.filter(reduce(lambda a, b: a | b, conditions))

    @staticmethod
    def _in_parts(part: str, kind: T.DataType, folders: Sequence[str]) -> Column:
        """Literal test for partition folders (``<partition>=<value>``): only directories are looked at."""
        values = [f.split("=", 1)[1] for f in folders]
        known = [F.lit(v).cast(kind) for v in values if v != NO_VALUE]
        found = F.coalesce(F.col(part).isin(known), F.lit(False)) if known else F.lit(False)
        return found | F.col(part).isNull() if NO_VALUE in values else found

    def _folders_of(self, name: str, df: DataFrame) -> list[str]:
        """Names of the partition folders that hold the rows of ``df`` (months, buckets or days: bounded)."""
        part = MODELS[name].partition_by
        values = [r[0] for r in df.select(F.col(part).cast("string")).distinct().collect()]
        return [f"{part}={NO_VALUE if v is None else v}" for v in values]

    def _read_partitions(self, name: str, folders: list[str]) -> DataFrame:
        m = self.manifest(self._key(name))
        return self._read(name, self.model_path(name), m, T.StructType.fromJson(json.loads(m.schema)), folders).drop("_commit")

    def _write(self, name: str, folder: str, df: DataFrame) -> list[str]:
        """Write partitioned rows into a commit folder, then their ledger and key filters; returns the partition folders."""
        part = MODELS[name].partition_by
        target = f"{self.model_path(name)}/{folder}"
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(part).parquet(target)
        written = [n for n in self.manifests.files.names(target) if n.startswith(f"{part}=")]
        stored = self.spark.read.schema(df.schema).parquet(target) if written else None
        sides = []
        if written and name in ledger.LEDGERS:
            sides.append((ledger.totals(stored, name, [part]), self.ledger_path(name)))
        if written and name in SPREAD_KEYS:
            sides.append((key_filter.build(stored, part, SPREAD_KEYS[name]), self.keys_path(name)))
        for side, path in sides:  # a few rows a partition: no directories of their own
            side.write.mode("overwrite").parquet(f"{path}/{folder}")
        return written

    def doubled_keys(self, name: str, parts: Sequence[str]) -> DataFrame:
        """Keys of the rows in partition folders ``parts`` that more than one row of the table holds, with their number.
        Of the other partitions only those are read whose key filter is hit, and there the keys that hit."""
        m, key, part = self.manifest(self._key(name)), SPREAD_KEYS[name], MODELS[name].partition_by
        kind = T.StructType.fromJson(json.loads(m.schema))[part]
        fields = [("blocks", T.LongType()), ("block", T.LongType()), ("bits", T.BinaryType()), ("lo", T.LongType()), ("hi", T.LongType())]
        schema = T.StructType([kind, *[T.StructField(c, t) for c, t in fields]])
        others = [p for p in m.live() if p not in set(parts)]
        own = self._read_partitions(name, [p for p in parts if p in m.live()]).select(F.col(key).alias("key"))
        filters = self._read(name, self.keys_path(name), m, schema, others).drop("_commit")
        hits = self.scratch(f"{name}__hits", key_filter.probe(own.distinct(), filters, part)).df
        hit = self._folders_of(name, hits)
        elsewhere = self._read_partitions(name, hit).select(F.col(key).alias("key")).join(hits.select("key").distinct(), "key", "left_semi")
        return quality.duplicates(own.unionByName(elsewhere), ["key"]).withColumnRenamed("key", key)

    def read_ledger(self, name: str, live: dict[str, str] | None = None) -> DataFrame:
        """The ledger of a model's live partitions, or of those in ``live`` (partition folder -> commit folder)."""
        m = self.manifest(self._key(name))
        only = None
        if live is not None:
            folders: dict[str, dict[str, list[str]]] = {}
            for p, f in live.items():
                folders.setdefault(f, {"live": [], "dead": []})["live"].append(p)
            m, only = Manifest(m.version, m.run, schema=m.schema, folders=folders), list(live)
        schema = ledger.schema(name, T.StructType.fromJson(json.loads(m.schema)))
        return self._read(name, self.ledger_path(name), m, schema, only).drop("_commit")

    # --- what a gate has not seen yet --------------------------------------------------
    def unchecked_parts(self, check: str, name: str) -> list[str] | None:
        """Partition folders of a model that were written or dropped since ``check`` last passed; None if it never did."""
        gate, m = self.manifest(f"gate.{check}"), self.manifest(self._key(name))
        if gate is None or name not in gate.checked:
            return None
        old, new = gate.checked[name], m.live()
        return sorted(p for p in {*old, *new} if old.get(p) != new.get(p))

    def unchecked_days(self, check: str, name: str) -> DataFrame | None:
        """``activity_date`` of a model's days whose ledger differs from the one ``check`` last passed with. None: never
        passed, or the folders of that time are gone."""
        parts = self.unchecked_parts(check, name)
        if parts is None:
            return None
        old, new = self.manifest(f"gate.{check}").checked[name], self.manifest(self._key(name)).live()
        old, new = ({p: f for p, f in live.items() if p in parts} for live in (old, new))
        stored = set(self.manifests.files.names(self.ledger_path(name)))
        if not set(old.values()) <= stored:
            return None
        return ledger.changed_days(self.read_ledger(name, old), self.read_ledger(name, new), name)

    def read_parts(self, name: str, parts: Sequence[str] | None) -> DataFrame:
        """The visible rows of some live partitions (None: of all)."""
        table = self.read_model(name)
        if parts is None:
            return table.df
        df = self._read_partitions(name, list(parts))
        return df.select(*table.df.columns)

    def mark_passed(self, check: str, names: Sequence[str]) -> None:
        """Remember the live partitions that ``check`` has just passed with."""
        checked = {n: self.manifest(self._key(n)).live() for n in names}
        before = self.manifest(f"gate.{check}")
        if before is None or before.checked != checked:
            self._commit(f"gate.{check}", None, 0, {"checked": checked})

    # --- change feeds ------------------------------------------------------------------
    def changes(self, name: str, table: Table, version: int) -> DataFrame | None:
        return self.changes_since(name, version)

    def changes_since(self, name: str, version: int) -> DataFrame | None:
        """The signed changes of a model after ``version``, each commit once; None if its feeds don't reach back so far."""
        m = self.manifest(self._key(name))
        if m.version != version and (not m.history or version < m.history[0][0] - 1):
            return None
        folders = [folder for n, folder in m.history if n > version]
        schema = ledger.changes_schema(name)
        if not folders:
            return self.spark.createDataFrame([], schema)
        path = self.changes_path(name)
        return self.spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in folders])

    def scratch(self, name: str, df: DataFrame) -> Table:
        """Write an intermediate batch under this run's work folder and read it back."""
        obs_df, obs = measured(df)
        obs_df.write.mode("overwrite").parquet(self.work_path(name))
        return table_from(self.spark.read.parquet(self.work_path(name)), obs)

    def _enforce(self, name: str, batch: DataFrame) -> None:
        if name in ENFORCED_UNIQUE:
            quality.gate(f"unique_on_write:{name}", quality.duplicates(batch, ENFORCED_UNIQUE[name]))

    def replace(self, name: str, df: DataFrame, consumed: dict[str, int] | None = None) -> Table:
        """First build of a model, or a new whole one: every partition goes into one commit folder."""
        layout = MODELS[name]
        if name in ENFORCED_UNIQUE:
            df = self.scratch(f"{name}__full", df).df
            self._enforce(name, df)
        # few files per partition, AQE splits a hot one; observe sits above the rebalance so an
        # empty input still reports its metrics
        df = self._with_partition(name, df)
        obs_df, obs = measured(df.hint("rebalance", layout.partition_by))
        folder = self._commit_folder(name)
        written = self._write(name, folder, obs_df)
        m = obs.get
        folders = {folder: {"live": written, "dead": []}} if written else {}
        self._commit(
            self._key(name), m.get("watermark") or SENTINEL, int(m["rows"]),
            {"schema": df.schema.json(), "folders": folders, "history": [], "consumed": consumed or {}},
        )
        return self.read_model(name)

    def merge_keys(self, name: str, old: Table, batch: Table, keys, feed: Callable | None = None) -> Table:
        """delete+insert restricted to the partitions of the batch rows. With ``feed``, the replaced rows and the batch go
        through it into the commit's change feed."""
        self._enforce(name, batch.df)
        batch_df = self._with_partition(name, batch.df)
        touched = self._folders_of(name, batch_df)
        before = self._read_partitions(name, touched)
        folder = self._commit_folder(name)
        history = self.manifest(self._key(name)).history
        if feed is not None:
            replaced = rows_with_keys(before, batch_df, keys, batch.rows)
            feed(replaced, batch_df).write.mode("overwrite").parquet(f"{self.changes_path(name)}/{folder}")
            history = [*history, [self.manifests.next_version(self._key(name)), folder]][-FEEDS:]
        obs_old = Observation()
        counted = before.observe(obs_old, F.count(F.lit(1)).alias("rows"))
        merged = delete_insert(counted, batch_df, keys, batch.rows)
        obs_new = Observation()
        merged = merged.hint("rebalance", MODELS[name].partition_by).observe(obs_new, F.count(F.lit(1)).alias("rows"))
        written = self._write(name, folder, merged)
        rows = old.rows - _observed_rows(obs_old) + _observed_rows(obs_new)
        m = self.manifest(self._key(name))
        changed = {"folders": m.replaced(touched, folder, written), "history": history}
        self._commit(self._key(name), max(old.watermark, batch.watermark), rows, changed)
        return self.read_model(name)

    def merge_days(
        self, name: str, old: Table, fresh: Table, date_col: str, days: DataFrame | None = None, consumed: dict[str, int] | None = None
    ) -> Table:
        """Replace every row of ``days`` (by default those present in ``fresh``); other days are not touched."""
        touched = self._folders_of(name, days if days is not None else fresh.df)  # days of one batch: bounded
        replaced = self._read_partitions(name, touched).count()
        folder = self._commit_folder(name)
        written = self._write(name, folder, fresh.df.hint("rebalance", date_col))
        m = self.manifest(self._key(name))
        self._commit(
            self._key(name), max(old.watermark, fresh.watermark), old.rows - replaced + fresh.rows,
            {"folders": m.replaced(touched, folder, written), "consumed": consumed or m.consumed},
        )
        return self.read_model(name)
