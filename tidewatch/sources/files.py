"""Monitors from files alone: a JSON definition and the SQL it names."""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidewatch.config import ConfigError, MonitorConfig
from tidewatch.sources.sql import GroupedSqlSource, run_sql


def _relation(spark: SparkSession, location: str) -> DataFrame:
    """A Parquet path (anything with a slash) or a catalog table."""
    return spark.read.parquet(location) if "/" in location else spark.table(location)


def load_monitor(
    spark: SparkSession, file: str | Path, places: Mapping[str, str] | None = None
) -> tuple[MonitorConfig, GroupedSqlSource, DataFrame | None]:
    """A monitor's definition, its source, and its source of truth if it has one.

    Beside what :meth:`MonitorConfig.from_dict` takes, the JSON has ``key`` and ``source``:

    * ``query_file``: SQL for a :class:`GroupedSqlSource`, beside the JSON file;
    * ``levels``: for each dimension level the column that the query groups by, or null;
    * ``relations``: the names the SQL uses in braces, and where they are, a path or a table; ``places``
      fills names in braces in these locations;
    * ``sot_query_file``, if any: SQL over the same relations that returns ``metric_date`` and totals.
    """
    path = Path(file)
    raw = json.loads(path.read_text(encoding="utf-8"))
    try:
        key, source = raw["key"], raw["source"]
        levels, query = dict(source["levels"]), source["query_file"]
        located = {
            name: location.format(**(places or {}))
            for name, location in source.get("relations", {}).items()
        }
    except (KeyError, TypeError) as error:
        raise ConfigError(f"monitor file {path.name}: {error!r}") from error
    config = MonitorConfig.from_dict(key, raw)
    if unknown := set(config.dimensions) - set(levels):
        raise ConfigError(f"monitor {key!r}: no column given for levels {sorted(unknown)}")

    def text(name: str) -> str:
        return (path.parent / name).read_text(encoding="utf-8")

    relations = {name: _relation(spark, location) for name, location in located.items()}
    sot = None
    if "sot_query_file" in source:
        sot = run_sql(spark, text(source["sot_query_file"]), **relations)
    return config, GroupedSqlSource(spark, text(query), levels, relations), sot
