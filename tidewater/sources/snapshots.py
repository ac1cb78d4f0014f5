"""Versioned tables of Parquet files with contracts, on any Hadoop file system.

A version is a folder of files and a manifest; a table's manifest is written
last and under a temporary name, so readers see whole versions only.  Versions
may share the files of earlier ones (appends).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    """A frame does not fit its contract; nothing was written."""


@dataclass(frozen=True)
class Contract:
    columns: dict[str, str]
    key: list[str]
    checks: dict[str, str] = field(default_factory=dict)

    @classmethod
    def of(cls, schema: T.StructType, key: list[str], checks: dict[str, str] | None = None) -> Contract:
        return cls({f.name: f.dataType.simpleString() for f in schema}, key, checks or {})

    def schema_violations(self, schema: T.StructType) -> list[str]:
        """Missing, unexpected and mistyped columns."""
        found = {f.name: f.dataType.simpleString() for f in schema}
        return (
            [f"missing column {c}" for c in self.columns if c not in found]
            + [f"unexpected column {c}" for c in found if c not in self.columns]
            + [f"column {c} is {found[c]}, not {t}" for c, t in self.columns.items() if c in found and found[c] != t]
        )

    def row_checks(self) -> dict[str, str]:
        return {f"{c}_not_null": f"{c} IS NOT NULL" for c in self.key} | self.checks

    def row_violations(self, df: DataFrame) -> dict[str, int]:
        """How many rows break each check, and how many repeat a key, in one pass."""
        names = list(self.row_checks())
        tests = [F.count_if(~F.coalesce(F.expr(e), F.lit(False))).alias(n) for n, e in self.row_checks().items()]
        keyed = df.groupBy(*self.key).agg(F.count("*").alias("__n"), *tests) if self.key else df.select(F.lit(1).alias("__n"), *[F.lit(0).alias(n) for n in names])
        one = keyed.agg(F.sum(F.col("__n") - 1).alias("duplicate_key"), *[F.sum(n).alias(n) for n in names]).first()
        return {k: v for k, v in one.asDict().items() if v}

    def enforce(self, df: DataFrame) -> None:
        if broken := self.schema_violations(df.schema):
            raise ContractError("; ".join(broken))
        if broken := self.row_violations(df):
            raise ContractError("; ".join(f"{k}: {v} rows" for k, v in sorted(broken.items())))


class _Files:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self._conf)

    def path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def read(self, p: str) -> str | None:
        if not self.fs.exists(self.path(p)):
            return None
        stream = self.fs.open(self.path(p))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, p: str, text: str) -> None:
        temporary = f"{p}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(temporary), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.fs.delete(self.path(p), False)
        self.fs.rename(self.path(temporary), self.path(p))


def _check(df: DataFrame, conditions: dict[str, str]) -> None:
    """ContractError unless every row passes every condition; null does not pass."""
    if not conditions:
        return
    one = df.agg(*[F.count_if(~F.coalesce(F.expr(e), F.lit(False))).alias(n) for n, e in conditions.items()]).first()
    if broken := {k: v for k, v in one.asDict().items() if v}:
        raise ContractError("; ".join(f"{k}: {v} rows" for k, v in sorted(broken.items())))


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._files = _Files(spark, self.root)

    def history(self) -> list[dict]:
        """Manifests of all versions, oldest first."""
        text = self._files.read(f"{self.root}/manifest.json")
        return json.loads(text) if text else []

    @property
    def version(self) -> int:
        """The newest version; -1 while there is none."""
        return len(self.history()) - 1

    def read(self, version: int | None = None) -> DataFrame:
        history = self.history()
        if not history or version is not None and not 0 <= version < len(history):
            raise LookupError(f"{self.root} has no version {version if version is not None else 0}")
        entry = history[-1 if version is None else version]
        schema = T.StructType.fromJson(entry["schema"])
        if not entry["parts"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p}" for p in entry["parts"]])

    def constraints(self) -> dict[str, str]:
        """Name -> condition of the checks that every row written must pass."""
        history = self.history()
        return dict(history[-1].get("constraints") or {}) if history else {}

    def apply_constraints(self, contract: Contract) -> dict[str, list[str]]:
        """Make the table's checks those of ``contract``: missing ones are added,
        differing ones replaced, others dropped, equal ones (but for case and
        blanks) left alone.  New conditions must hold for all rows that are there,
        or nothing changes.  Returns the names by what was done; a table whose
        checks change gets a new version over the same files."""
        old, new = self.constraints(), contract.row_checks()
        same = lambda a, b: " ".join(a.split()).lower() == " ".join(b.split()).lower()
        done = {
            "added": sorted(set(new) - set(old)),
            "replaced": sorted(k for k in new if k in old and not same(old[k], new[k])),
            "dropped": sorted(set(old) - set(new)),
        }
        if not any(done.values()):
            return done
        _check(self.read(), {k: new[k] for k in done["added"] + done["replaced"]})
        history = self.history()
        entry = {**history[-1], "version": len(history), "added": [], "removed": [], "constraints": new}
        self._files.replace(f"{self.root}/manifest.json", json.dumps([*history, entry]))
        return done

    def _commit(self, df: DataFrame, contract: Contract | None, keep: list[str], inputs: dict | None) -> int:
        if contract:
            contract.enforce(df)
        kept = self.constraints()
        _check(df, kept)
        history = self.history()
        part = f"v{len(history)}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.root}/{part}")
        before = history[-1]["parts"] if history else []
        entry = {"version": len(history), "schema": json.loads(df.schema.json()), "parts": [*keep, part], "added": [part], "removed": [p for p in before if p not in keep], "contract": asdict(contract) if contract else None, "constraints": kept, "inputs": inputs or {}}
        self._files.replace(f"{self.root}/manifest.json", json.dumps([*history, entry]))
        return len(history)

    def write(self, df: DataFrame, contract: Contract | None = None, inputs: dict | None = None) -> int:
        """Replace the content; returns the new version."""
        return self._commit(df, contract, [], inputs)

    def append(self, df: DataFrame, contract: Contract | None = None) -> int:
        """Add rows.  The contract is checked on the new rows, and keys on all."""
        history = self.history()
        if history and contract and contract.key:
            old = self.read().select(*contract.key)
            if df.join(old, contract.key, "left_semi").limit(1).count():
                raise ContractError("duplicate_key: rows exist already")
        return self._commit(df, contract, history[-1]["parts"] if history else [], None)

    def upsert(self, df: DataFrame, key: list[str], contract: Contract | None = None) -> int:
        """Replace rows of equal key and add the others."""
        if self.version < 0:
            return self.write(df, contract)
        rest = self.read().join(df.select(*key), key, "left_anti")
        return self.write(rest.unionByName(df), contract)

    def changes(self, since: int) -> DataFrame:
        """Rows of the files added after version ``since``."""
        parts = [p for e in self.history()[since + 1 :] for p in e["added"]]
        return self.spark.read.parquet(*[f"{self.root}/{p}" for p in parts]) if parts else self.read().limit(0)


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/{name}")

    def read(self, name: str, versions: dict[str, int] | None = None) -> DataFrame:
        """A table by name, at its pinned version or the newest."""
        return self.table(name).read((versions or {}).get(name))

    def locations(self) -> DataFrame:
        """full_name, storage_path of all tables of the store."""
        files = _Files(self.spark, self.root)
        found = files.fs.listStatus(files.path(self.root)) if files.fs.exists(files.path(self.root)) else []
        rows = [(s.getPath().getName(), s.getPath().toString()) for s in found if s.isDirectory() and files.fs.exists(files.path(f"{s.getPath().toString()}/manifest.json"))]
        return self.spark.createDataFrame(sorted(rows), "full_name string, storage_path string")

    def pins(self, versions: dict[str, int] | None, names: list[str]) -> dict[str, int | None]:
        """A version for every name, or for none: a frame built from a mix of
        pinned and floating inputs could not be built again."""
        if not versions:
            return dict.fromkeys(names)
        if missing := [n for n in names if n not in versions]:
            raise ValueError(f"pin all inputs or none; missing {', '.join(missing)}")
        return {n: versions[n] for n in names}


def replace_partition(df: DataFrame, path: str, **values: object) -> None:
    """Replace one partition folder (column=value/...) by ``df``, also when it
    is empty; other partitions stay."""
    folder = "/".join([path.rstrip("/"), *[f"{k}={v}" for k, v in values.items()]])
    df.drop(*values).write.mode("overwrite").parquet(folder)


def read_partition(spark: SparkSession, path: str, **values: object) -> DataFrame:
    """A scan of a partitioned table with the filter on the partition columns."""
    df = spark.read.option("basePath", path).parquet(path)
    for k, v in values.items():
        df = df.where(F.col(k) == F.lit(v))
    return df


def register(spark: SparkSession, name: str, path: str) -> None:
    """An external table over ``path``.  A table of that name elsewhere is an error."""
    if spark.catalog.tableExists(name):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
        at = rows[0]["data_type"].removeprefix("file:").rstrip("/") if rows else None
        if at != path.removeprefix("file://").removeprefix("file:").rstrip("/"):
            raise ValueError(f"{name} already points to {at}")
        return
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")


def key_ddl(schema: str, table: str, entity: list[str], time: str | None) -> list[str]:
    """Statements that declare a feature table's keys to a catalogue."""
    name, columns = f"{schema}.{table}", [*entity, *([time] if time else [])]
    listed = ", ".join([*entity, *([f"{time} TIMESERIES"] if time else [])])
    return [f"ALTER TABLE {name} ALTER COLUMN {c} SET NOT NULL" for c in columns] + [f"ALTER TABLE {name} ADD CONSTRAINT {table}_pk PRIMARY KEY ({listed})", f"ALTER TABLE {name} SET TBLPROPERTIES (delta.enableChangeDataFeed = true)"]


def catalogue_locations(spark: SparkSession, databases: list[str] | None = None) -> DataFrame:
    """full_name, storage_path of the session catalogue's tables that have files;
    one row for each table is collected from the catalogue."""
    rows = []
    for db in databases or [d.name for d in spark.catalog.listDatabases()]:
        for t in spark.catalog.listTables(db):
            if not t.isTemporary and t.tableType != "VIEW":
                found = spark.sql(f"DESCRIBE TABLE EXTENDED `{db}`.`{t.name}`").where("col_name = 'Location'").collect()
                rows += [(f"{db}.{t.name}", r["data_type"]) for r in found]
    return spark.createDataFrame(sorted(rows), "full_name string, storage_path string")
