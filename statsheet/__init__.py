"""statsheet: published statistical tables as Spark DataFrames.

A small spec per table (header position, dimension / measure / id columns,
types, units, aliases, period column) drives one lazy plan from the source
table to uniform observations ``(period, measure, value, unit, dimensions)``.
"""

from .operators.search import search_datasets
from .plans.api import Result, catalogue, describe_dataset, get_data, latest, list_curated, top_n
from .plans.ingest import ingest
from .plans.refresh import discover, refresh_manifest
from .spec import Spec, get_spec, load_all
from .streaming.accumulate import accumulate_stream, upsert

__all__ = [
    "Result",
    "Spec",
    "accumulate_stream",
    "catalogue",
    "describe_dataset",
    "discover",
    "get_data",
    "get_spec",
    "ingest",
    "latest",
    "list_curated",
    "load_all",
    "refresh_manifest",
    "search_datasets",
    "top_n",
    "upsert",
]
