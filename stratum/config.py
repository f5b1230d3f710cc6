"""Names and locations of the lakehouse layers, validated, plus namespace bootstrap.

Replaces per-environment token files: one object holds every name a run needs,
and ``validate`` fails early when one is missing (the reference defined the
domain schemas for one environment only).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

REQUIRED = ("bronze_billing", "bronze_claim", "silver_billing", "silver_claim", "gold")


@dataclass(frozen=True)
class LakehouseConfig:
    root: str                                   # shared storage root of all layers
    schemas: dict[str, str] = field(default_factory=dict)   # role -> schema name
    landing_vault: str | None = None
    as_of: _dt.date | None = None

    def validate(self) -> "LakehouseConfig":
        missing = [r for r in REQUIRED if not self.schemas.get(r)]
        if missing:
            raise ValueError(f"schema names missing for {missing}")
        bad = [n for n in self.schemas.values() if not n.replace("_", "").isalnum()]
        if bad:
            raise ValueError(f"invalid schema names {bad}")
        return self

    def location(self, role: str) -> str:
        return f"{self.root.rstrip('/')}/{self.schemas[role]}"


def bootstrap(spark: SparkSession, cfg: LakehouseConfig) -> list[str]:
    """``CREATE DATABASE IF NOT EXISTS`` for every layer schema (non-destructive)."""
    cfg.validate()
    made = []
    for role in REQUIRED:
        name = cfg.schemas[role]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{cfg.location(role)}'")
        made.append(name)
    return made


def write_view(df, cfg: LakehouseConfig, name: str) -> None:
    """Materialized-view sink into the gold schema: full recompute, overwrite."""
    df.write.mode("overwrite").format("parquet").saveAsTable(f"`{cfg.schemas['gold']}`.`{name}`")
