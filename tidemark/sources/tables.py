"""Readers for the Parquet catalogue."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings chapter coc characters "
    "characters_detail character_affiliation graph_nodes wiki_text wiki_chunks source_units unit_factors mix_targets "
    "pack_limits"
).split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of ``folder``; column pruning and filters reach the scan through Catalyst."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register(spark: SparkSession, folder: str, names: list[str] | None = None) -> None:
    """Register the tables of ``folder`` as temporary views for SQL; without ``names`` those of the catalogue that exist."""
    for name in names or TABLES:
        try:
            found = table(spark, folder, name)
        except AnalysisException:
            if names:
                raise
            continue
        found.createOrReplaceTempView(name)
