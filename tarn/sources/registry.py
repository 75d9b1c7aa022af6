"""Named sources - logical table names resolved to stored tables.

A registry maps ``group.table`` to a path under one root (or to an explicit
path), so plans name what they read and a deployment says where it lies.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tarn.operators.store import read


@dataclass(frozen=True)
class Sources:
    root: str
    tables: dict[str, tuple[str, ...]]                    # group -> table names
    paths: dict[str, str] = field(default_factory=dict)   # "group.table" -> path, where it is not under the root

    def path(self, group: str, table: str) -> str:
        if table not in self.tables.get(group, ()):
            raise KeyError(f"unknown source: {group}.{table}")
        return self.paths.get(f"{group}.{table}", f"{self.root.rstrip('/')}/{group}/{table}")

    def read(self, spark: SparkSession, group: str, table: str) -> DataFrame:
        return read(spark, self.path(group, table))


# The raw tables the marts read (fixed names).
RAW_TABLES = {"raw": ("lwq_data", "lwq_wfs_table_latest", "transfer_table", "list_of_urls")}
