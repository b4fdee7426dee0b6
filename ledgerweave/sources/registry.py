"""Ledger and code registries: the names behind the numbers.

A registry is configuration, not data: it is read once when a job is planned
and becomes constants of the plan. ``Registry.from_tables`` reads the two small
tables a deployment keeps it in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.functions.values import MAX_SCALE, text

LEDGER_SCHEMA = "name string, id bigint, scale int"
CODE_SCHEMA = "name string, value int"


@dataclass(frozen=True)
class Registry:
    ledgers: tuple[tuple[str, int, int], ...]  # (name, id, scale)
    codes: tuple[tuple[str, int], ...]  # (name, value)

    @staticmethod
    def of(ledgers: dict[str, tuple[int, int]], codes: dict[str, int]) -> "Registry":
        return Registry(
            tuple((n, i, s) for n, (i, s) in ledgers.items()), tuple(codes.items())
        )

    @staticmethod
    def from_tables(ledgers: DataFrame, codes: DataFrame) -> "Registry":
        return Registry(
            tuple(tuple(r) for r in ledgers.select("name", "id", "scale").collect()),
            tuple(tuple(r) for r in codes.select("name", "value").collect()),
        )

    def ledger_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.ledgers), LEDGER_SCHEMA)

    def code_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.codes), CODE_SCHEMA)

    # lookups as constants of the plan; names are case-sensitive
    def ledger_map(self) -> str:
        """SQL map ``name -> struct<id, scale>``."""
        parts = [
            f"{text(n)}, named_struct('id', {i}L, 'scale', {s})" for n, i, s in self.ledgers
        ]
        return f"cast(map({', '.join(parts)}) as map<string,struct<id:bigint,scale:int>>)"

    def code_map(self) -> str:
        """SQL map ``name -> value``."""
        return f"cast(map({', '.join(f'{text(n)}, {v}' for n, v in self.codes)}) as map<string,int>)"


def bad_ledgers(ledgers: DataFrame) -> DataFrame:
    """Ledger entries a job must not start with, one row per broken rule."""
    twice = (
        ledgers.groupBy("id").agg(F.count("*").alias("n"), F.min("name").alias("name"))
        .filter("n > 1").select("name", "id", F.lit("duplicate id").alias("problem"))
    )
    zero = ledgers.filter("id = 0").select("name", "id", F.lit("id must not be zero").alias("problem"))
    scale = ledgers.filter((F.col("scale") < 0) | (F.col("scale") > MAX_SCALE)).select(
        "name", "id", F.lit("scale out of range").alias("problem")
    )
    return zero.unionByName(scale).unionByName(twice)


def bad_codes(codes: DataFrame) -> DataFrame:
    """Code entries a job must not start with, one row per broken rule."""
    twice = (
        codes.groupBy("value").agg(F.count("*").alias("n"), F.min("name").alias("name"))
        .filter("n > 1").select("name", "value", F.lit("duplicate value").alias("problem"))
    )
    zero = codes.filter("value = 0").select(
        "name", "value", F.lit("value must not be zero").alias("problem")
    )
    return zero.unionByName(twice)


def check(ledgers: DataFrame, codes: DataFrame) -> None:
    """Raise when the registry tables are empty or broken."""
    for name, table, bad in (
        ("ledgers", ledgers, bad_ledgers(ledgers)), ("codes", codes, bad_codes(codes))
    ):
        if table.isEmpty():
            raise ValueError(f"{name}: must not be empty")
        first = bad.first()
        if first is not None:
            raise ValueError(f"{name}: {first['name']}: {first['problem']}")
