"""Queries over the raw records: packed fields and free-text quantities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import packed_values, units
from tidemark.sources.tables import table


def p2_values(spark: SparkSession, folder: str) -> DataFrame:
    return packed_values.unpack(packed_values.packed_fields(table(spark, folder, "characters_detail"), table(spark, folder, "character_affiliation")))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return p2_values(spark, folder).filter(F.col("n_items") >= 2).select("field", "rec_id", "pos", "item")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    detail = table(spark, folder, "characters_detail")
    return units.to_base(units.quantity_fields(detail), table(spark, folder, "unit_factors"), table(spark, folder, "source_units"))


def queries() -> dict:
    return {"p2_found": p2_found, "p2_values": p2_values, "p4_found": p4_found}


def oracle_sql() -> dict:
    return {}
