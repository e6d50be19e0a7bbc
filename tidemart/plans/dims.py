"""Configuration-driven dimension upkeep and fact routing."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemart import schemas
from tidemart.operators import etl, routing
from tidemart.sources.feeds import config_rows


def dimension_rows(events: DataFrame, config_events: DataFrame, db: str) -> DataFrame:
    """All changes of configured tables, each with its sink, row key and wanted columns."""
    config = routing.current_config(config_rows(config_events, schemas.DIM_CONFIG_COLUMNS), ["source_table"])
    return routing.route_dimensions(etl.valid_events(events, db), config)


def current_dimensions(events: DataFrame, config_events: DataFrame, db: str) -> DataFrame:
    return routing.current_dimension(dimension_rows(events, config_events, db))


def fact_rows(events: DataFrame, config_events: DataFrame) -> DataFrame:
    """Changes sent to a fact table by (table, kind)."""
    config = routing.current_config(config_rows(config_events, schemas.FACT_CONFIG_COLUMNS),
                                    ["source_table", "source_type"])
    return routing.route_facts(etl.drop_bootstrap(events), config)


def fact_rows_as_of(events: DataFrame, config_events: DataFrame) -> DataFrame:
    """Changes sent to the fact table that was configured for (table, kind) when they happened."""
    return routing.route_facts_as_of(etl.drop_bootstrap(events), config_rows(config_events, schemas.FACT_CONFIG_COLUMNS))


def dimension_rows_as_of(events: DataFrame, config_events: DataFrame, db: str) -> DataFrame:
    """Changes of tables that were configured when they happened, each by the configuration of that time."""
    return routing.route_dimensions_as_of(etl.valid_events(events, db), config_rows(config_events, schemas.DIM_CONFIG_COLUMNS))


def table_life(config_events: DataFrame) -> DataFrame:
    """When each dimension table was created, dropped or made anew."""
    return routing.table_actions(config_rows(config_events, schemas.DIM_CONFIG_COLUMNS))


def dimension_rows_by_life(events: DataFrame, config_events: DataFrame, db: str) -> DataFrame:
    """As ``dimension_rows_as_of``, each row with the ``generation`` of its table."""
    return routing.with_generation(dimension_rows_as_of(events, config_events, db), table_life(config_events))
