"""Warehouse sinks: a JDBC database, or parquet tables in the Spark catalog."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stockloom.functions.columns import field_ref
from stockloom.model import WAREHOUSE, Table
from stockloom.operators.surrogate import with_sparse_keys, with_surrogate_keys
from stockloom.sources.scratch import delete_folder, folder_names, stage


class Sink(Protocol):
    def write(self, df: DataFrame, table: str, mode: str = "append", load_id: str | None = None) -> int:
        """Write the rows and return their number."""


def shape_for(df: DataFrame, table: Table, with_surrogate: bool = False) -> DataFrame:
    """Columns of ``table`` in contract order and type, defaults filled in."""
    present = set(df.columns)
    out = []
    for f in table.fields:
        if f.surrogate and not with_surrogate:
            continue
        default = f.default_column()
        if f.name not in present:
            value = F.lit(None) if default is None else default
        elif default is None:
            value = field_ref(f.name)
        else:
            value = F.coalesce(field_ref(f.name), default)
        out.append(value.try_cast(f.dtype).alias(f.name))
    return df.select(*out)


@dataclass(frozen=True)
class JdbcSink:
    """Writes through JDBC; the database hands out surrogate ids.

    ``overwrite`` truncates instead of dropping, so keys, ids and indexes of the
    target table survive. ``max_connections`` is the number of writing tasks, each with
    its own connection and transaction; the rows are spread over them evenly, which shuffles
    the table once, while the plan before the write keeps its parallelism. A database cannot tell a repeated task
    from a new one, so rely on the unique keys of the target table, or load into a
    table of your own first, where rows must not repeat after a lost executor.
    """

    url: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"
    max_connections: int = 16
    batch_size: int = 10_000
    options: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def postgres_url(host: str, port: int, database: str) -> str:
        return f"jdbc:postgresql://{host}:{port}/{database}"

    def write(
        self, df: DataFrame, table: str, mode: str = "append", load_id: str | None = None, **extra: str
    ) -> int:
        contract = WAREHOUSE.get(table)
        rows = df if contract is None else shape_for(df, contract)
        settings = {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "dbtable": table,
            "batchsize": str(self.batch_size),
            "truncate": str(mode == "overwrite").lower(),
            **self.options,
            **extra,
        }
        try:
            counted = Observation()
            spread = rows.repartition(self.max_connections).observe(counted, F.count(F.lit(1)).alias("rows"))
            spread.write.format("jdbc").options(**settings).mode(mode).save()
            return counted.get["rows"]
        except Exception as error:
            raise RuntimeError(f"writing table {table} failed: {error}") from error


LOAD = "load_id"
WHOLE = "all"  #: the load of a table that is always replaced as a whole
LEDGER = "load_ledger"
_LEDGER_COLUMNS = "path string, length bigint, modified timestamp, tables map<string,bigint>, finished timestamp"


@dataclass(frozen=True)
class CatalogSink:
    """Parquet tables in a Spark database, a partition per load, with surrogate ids assigned on load.

    Every write goes to a folder of its own. The catalog's entry of its partition is pointed there last, in one
    call, so a write that dies leaves the rows of before, and a repeated load replaces its own rows and no others.
    Folders that nothing points to any more go with the next write but one, when no query reads them.

    Rows of tables with a natural key keep their ids over reloads: keys are looked up in ``<table>_ids``, and
    unseen ones go on behind its greatest id. A key that holds a null isn't known again. Ids are unique but have gaps, as those of a database sequence may, and rows are written
    once as they come. With ``dense_ids`` they run without gaps in the order of the natural
    key, for which the rows are sorted and written an extra time; files then also hold
    narrow key ranges, so lookups by company skip most of them.
    """

    spark: SparkSession
    database: str
    location: str
    dense_ids: bool = False

    def qualified(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def initialise(self) -> None:
        """Drop and recreate every warehouse table, the ledger and the ids, empty."""
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.location}'"
        )
        for table in WAREHOUSE.values():
            self._create(table.name, ", ".join(f"`{f.name}` {f.dtype.simpleString()}" for f in table.fields))
            if table.surrogate and table.unique:
                keys = ", ".join(f"`{k}` {table.field(k).dtype.simpleString()}" for k in table.unique)
                self._create(f"{table.name}_ids", f"{keys}, `{table.surrogate.name}` bigint")
        self._create(LEDGER, _LEDGER_COLUMNS)

    def _create(self, table: str, columns: str) -> None:
        """A table without partitions holds no rows, whatever files lie at its location."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.qualified(table)}")
        self.spark.sql(
            f"CREATE TABLE {self.qualified(table)} ({columns}, {LOAD} STRING) USING parquet "
            f"PARTITIONED BY ({LOAD}) LOCATION '{self.location}/{table}'"
        )

    def write(
        self, df: DataFrame, table: str, mode: str = "append", load_id: str | None = None, stable_ids: bool = True
    ) -> int:
        """Write the rows of a load. ``append`` replaces the load of that id, ``overwrite`` all loads.

        Rows that repeat a natural key need ``stable_ids`` off, since ids are kept by that key.
        """
        contract = WAREHOUSE[table]
        rows = shape_for(df, contract)
        load_id = WHOLE if mode == "overwrite" else load_id or uuid.uuid4().hex
        if contract.surrogate and contract.unique and stable_ids:
            rows = self._known(rows, contract)
        elif contract.surrogate:
            last = None if mode == "overwrite" else self.others(table, load_id).agg(F.max(contract.surrogate.name)).first()[0]
            rows = self._new_ids(rows, contract, last or 0)
        try:
            return self._publish(rows, table, load_id, alone=mode == "overwrite")
        except Exception as error:
            raise RuntimeError(f"writing table {table} failed: {error}") from error

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.qualified(table)).drop(LOAD)

    def others(self, table: str, load_id: str) -> DataFrame:
        """Rows of all loads but one."""
        return self.spark.table(self.qualified(table)).where(F.col(LOAD) != load_id).drop(LOAD)

    def record(self, load_id: str, inputs: DataFrame, tables: dict[str, int]) -> None:
        """Note in the ledger that a load is done, what it read (path, length, modified), and its rows by table."""
        counts = F.create_map(*(F.lit(v) for name, n in tables.items() for v in (name, n)))
        done = inputs.select(
            "path", "length", "modified", counts.cast("map<string,bigint>").alias("tables"), F.current_timestamp().alias("finished")
        )
        self._publish(done, LEDGER, load_id)

    def is_recorded(self, load_id: str) -> bool:
        return load_id in self._loads(LEDGER)

    def _loads(self, table: str) -> set[str]:
        """Ids of the loads of a table; one per load, so few."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.qualified(table)}").collect()
        return {row.partition.split("=", 1)[1] for row in listed}

    def _folder(self, table: str, load_id: str) -> str:
        found = self.spark.sql(f"DESCRIBE EXTENDED {self.qualified(table)} PARTITION ({LOAD}='{load_id}')")
        return found.where("col_name = 'Location'").first().data_type

    def _publish(self, rows: DataFrame, table: str, load_id: str, alone: bool = False) -> int:
        name = self.qualified(table)
        before = self._loads(table)
        current = self._folder(table, load_id) if load_id in before else None
        folder = f"{self.location}/{table}/{load_id}-{uuid.uuid4().hex}"
        counted = Observation()
        rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
        if current:
            self.spark.sql(f"ALTER TABLE {name} PARTITION ({LOAD}='{load_id}') SET LOCATION '{folder}'")
        else:
            self.spark.sql(f"ALTER TABLE {name} ADD PARTITION ({LOAD}='{load_id}') LOCATION '{folder}'")
        for other in before - {load_id} if alone else ():
            self.spark.sql(f"ALTER TABLE {name} DROP PARTITION ({LOAD}='{other}')")
        if current:
            self._prune(table, load_id, {folder, current})
        return counted.get["rows"]

    def _prune(self, table: str, load_id: str, keep: set[str]) -> None:
        """Delete older folders of a load; the one just replaced may still be read."""
        kept = {path.rstrip("/").rsplit("/", 1)[-1] for path in keep}
        for name in folder_names(self.spark, f"{self.location}/{table}"):
            if name.rpartition("-")[0] == load_id and name not in kept:
                delete_folder(self.spark, f"{self.location}/{table}/{name}")

    def _known(self, rows: DataFrame, contract: Table) -> DataFrame:
        """``rows`` with the ids that their natural keys have had before, or new ones, which are noted."""
        key, natural = contract.surrogate.name, contract.unique
        ids = f"{contract.name}_ids"
        columns = [f.name for f in contract.fields]
        known = self.read(ids)
        # Ids of keys with nulls are in the table only; none is given out twice.
        last = known.select(key).union(self.read(contract.name).select(key)).agg(F.max(key)).first()[0]
        if last is None:
            seen, unseen = None, rows
        else:
            met = stage(rows.join(known.withColumnRenamed(key, "__known"), list(natural), "left"), "known-ids")
            seen = met.where("__known is not null").withColumn(key, F.col("__known")).select(*columns)
            unseen = met.where("__known is null").drop("__known")
        numbered = stage(self._new_ids(unseen, contract, last or 0), "new-ids")
        fresh = numbered.select(*natural, key).dropna(subset=list(natural))
        if not fresh.isEmpty():
            self._publish(fresh, ids, uuid.uuid4().hex)
        numbered = numbered.select(*columns)
        return numbered if seen is None else seen.unionByName(numbered)

    def _new_ids(self, rows: DataFrame, contract: Table, start: int) -> DataFrame:
        key = contract.surrogate.name
        if not self.dense_ids:
            return with_sparse_keys(rows, key, start)
        return with_surrogate_keys(
            rows, key, contract.natural_order, start=start, unique=bool(contract.unique)
        )
