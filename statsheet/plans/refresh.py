"""Finding the newest published file of every dataset (the manifest refresh).

    landing pages (url, html) ─ extract links ─┐
    spec discovery rules ──────────────────────┴─ equi-join on landing URL
        → include / exclude patterns → file-name date score (+ "database")
        → best link per dataset (partial max_by)
        → tiers: live link, else seed manifest, else the spec's default URL
        → manifest diff against the previous manifest

The pages table can be any size (one row per fetched landing page); the rule
table has one row per spec, so AQE broadcasts it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..operators.links import (
    best_links,
    candidate_links,
    extract_links,
    manifest_diff,
    resolve_tiers,
    rules_from_specs,
    rules_table,
)
from ..spec import Spec


def discover(
    spark: SparkSession, pages: DataFrame, specs: Iterable[Spec], url_col: str = "url", html_col: str = "html", extension: str = "xlsx"
) -> DataFrame:
    """Best link per dataset: ``dataset_id, link_url, file_name, score, pos``."""
    rules = rules_from_specs(specs)
    links = extract_links(pages, url_col, html_col, extension)
    best = best_links(candidate_links(links, rules_table(spark, rules), url_col))
    return best.select("dataset_id", "link_url", "file_name", "score", "pos")


def refresh_manifest(
    spark: SparkSession, pages: DataFrame, specs: Iterable[Spec], seed: DataFrame, payloads: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(resolved tiers per dataset, manifest diff against ``seed``).

    ``seed`` is ``dataset_id, seed_url`` (see ``operators.links.seed_manifest``
    / ``read_seed_manifest``); the default URL of a dataset is its spec's
    ``download_url``.
    """
    specs = list(specs)
    datasets = spark.createDataFrame([(s.id, s.download_url) for s in specs], "dataset_id string, default_url string")
    resolved = resolve_tiers(datasets, discover(spark, pages, specs), seed, payloads)
    return resolved, manifest_diff(seed, resolved)
