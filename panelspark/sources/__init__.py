"""Readers for the base tables and the derived panels."""

from panelspark.sources.csv import DEATHS_SCHEMA, VAX_SCHEMA, read_panel_csv, read_panel_csv_checked
from panelspark.sources.panels import deaths_panel, entities, vax_panel
from panelspark.sources.stored import StoredPanel
from panelspark.sources.tables import read_table

__all__ = [
    "DEATHS_SCHEMA",
    "StoredPanel",
    "VAX_SCHEMA",
    "deaths_panel",
    "entities",
    "read_panel_csv",
    "read_panel_csv_checked",
    "read_table",
    "vax_panel",
]
