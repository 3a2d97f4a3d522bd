"""The layered tables: partitioned ones in versions, plain ones in a database per layer, and the watermarks (K6)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .. import schemas
from ..session import configure, note_databases, shared_folder
from .versions import Key, Version, VersionedTable

LAYERS = ("raw", "staging", "analytics", "ml", "ref", "ops")

_FLIGHTS = ("date_photo", "origin_airport")
_WEATHER = ("date_photo", "airport_iata")

# (layer, table) -> (columns, partition columns). Partition columns come last in every schema.
TABLES = {
    ("raw", "raw_flights"): (schemas.RAW_FLIGHTS, _FLIGHTS),
    ("raw", "scheduled_flights"): (schemas.RAW_FLIGHTS, _FLIGHTS),
    ("raw", "raw_weather"): (schemas.RAW_WEATHER, _WEATHER),
    ("raw", "scheduled_weather"): (schemas.RAW_WEATHER, _WEATHER),
    ("staging", "raw_flights"): (schemas.STAGING_FLIGHTS, _FLIGHTS),
    ("staging", "scheduled_flights"): (schemas.STAGING_FLIGHTS, _FLIGHTS),
    ("staging", "raw_weather"): (schemas.STAGING_WEATHER, _WEATHER),
    ("staging", "scheduled_weather"): (schemas.STAGING_WEATHER, _WEATHER),
    ("analytics", "raw_flights"): (schemas.ANALYTICS_FLIGHTS, _FLIGHTS),
    ("analytics", "scheduled_flights"): (schemas.ANALYTICS_SCHEDULED, _FLIGHTS),
    ("ml", "flight_predictions"): (schemas.PREDICTIONS, ("flight_date",)),
    ("ml", "model_registry"): (schemas.MODEL_REGISTRY, ("name",)),
    ("ml", "runs"): (schemas.ML_RUNS, ("experiment", "run_id")),
    ("ref", "iata_delay_codes"): (schemas.IATA_DELAY_CODES, ()),
    ("ref", "weather_codes"): (schemas.WEATHER_CODES, ()),
    ("ops", "quarantine"): (schemas.QUARANTINE, ("load_table", "date_photo")),
}


Spec = dict[str, str]


class Lake:
    """Names and creates the tables; ``namespace`` keeps several lakes apart in one catalog.

    Tables with partition columns are ``VersionedTable`` folders below ``root``; a commit changes any number of their partitions
    at once, and their watermark with them. Tables without are catalog tables, replaced as a whole.
    """

    def __init__(self, spark: SparkSession, root: str, namespace: str = ""):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.namespace = namespace
        self._versioned: dict[tuple[str, str], VersionedTable] = {}
        for layer in LAYERS:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}{layer}` LOCATION '{self.root}/{layer}'")

    @classmethod
    def scratch(cls, spark: SparkSession, purpose: str) -> Lake:
        """A lake of its own in the shared folder of the cluster."""
        root = shared_folder(spark, purpose)
        namespace = f"{root.rsplit('/', 1)[-1].replace('-', '_')}_"
        note_databases(namespace)
        return cls(spark, root, namespace)

    def name(self, layer: str, table: str) -> str:
        """The name of a table without partitions in the catalog."""
        return f"`{self.namespace}{layer}`.`{table}`"

    def versioned(self, layer: str, table: str) -> VersionedTable:
        """The versions of a partitioned table."""
        key = (layer, table)
        if key not in self._versioned:
            self._versioned[key] = VersionedTable(self.spark, f"{self.root}/versioned/{layer}/{table}")
        return self._versioned[key]

    def exists(self, layer: str, table: str) -> bool:
        return self.versioned(layer, table).exists() or self.spark.catalog.tableExists(self.name(layer, table))

    def create(self, layer: str, table: str, ddl: str | None = None, partitioned_by: Iterable[str] | None = None) -> None:
        """Create the table when absent; known tables need no schema."""
        if ddl is None:
            if self.exists(layer, table):
                return
            ddl, partitioned_by = TABLES[(layer, table)]
        keys = tuple(partitioned_by or ())
        if keys:
            self.versioned(layer, table).create(StructType.fromDDL(ddl), keys)
        else:
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(layer, table)} ({ddl}) USING parquet")

    def table(
        self, layer: str, table: str, version: int | None = None, keep: Callable[[Spec], bool] | None = None
    ) -> DataFrame:
        """The rows of a table: of the newest version, or of a given one; ``keep`` picks partitions before files are listed."""
        versions = self.versioned(layer, table)
        if version is None and keep is None and not versions.exists():
            return self.spark.table(self.name(layer, table))
        return versions.read(version, keep)

    def view(self, layer: str, table: str) -> str:
        """A name for SQL that stands for the newest version as of now, in this session."""
        if not self.versioned(layer, table).exists():
            return self.name(layer, table)
        name = f"{self.namespace}{layer}_{table}"
        self.table(layer, table).createOrReplaceTempView(name)
        return f"`{name}`"

    def version(self, layer: str, table: str) -> int:
        """The number of the newest version; a change computed from the table's rows names the one it read."""
        return self.versioned(layer, table).current().number

    def partitions(self, layer: str, table: str) -> list[Spec]:
        """Partition values as texts; their number is days x airports, whatever the row count."""
        version = self.versioned(layer, table).current()
        return [version.spec(key) for key in version.parts]

    def write(self, layer: str, table: str, df: DataFrame) -> dict[Key, str]:
        """Rows into new folders; ``commit`` makes them part of the table."""
        return self.versioned(layer, table).write(df)

    def commit(self, layer: str, table: str, *args, **changes) -> Version:
        """All changes of one step: see ``VersionedTable.commit``."""
        return self.versioned(layer, table).commit(*args, **changes)

    def drop_partitions(self, layer: str, table: str, drop: Callable[[Spec], bool]) -> None:
        """Remove whole partitions: no row is rewritten."""
        self.commit(layer, table, drop=drop)

    def replace_partitions(self, layer: str, table: str, df: DataFrame, base: int | None = None) -> None:
        """Replace exactly the partitions ``df`` holds rows of, all at once.

        A frame computed from the table passes the version it was read from as ``base``: a change that came in between
        would be lost, so the commit is refused. A failure on the way leaves the table as it was.
        """
        written = self.write(layer, table, df)
        if written:
            self.commit(layer, table, written, base=base)

    def watermark(self, layer: str, table: str) -> dt.date | None:
        """Snapshot date loaded last; each (layer, table) has its own."""
        versions = self.versioned(layer, table)
        found = versions.current().watermark if versions.exists() else None
        return None if found is None else dt.date.fromisoformat(found)

    def advance_watermark(self, layer: str, table: str, date_photo: dt.date) -> None:
        self.commit(layer, table, watermark=date_photo.isoformat())
