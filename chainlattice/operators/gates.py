"""Quality gates: floors and invariants that stop a build. All gates of a table are one aggregation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateFailure(RuntimeError):
    """A gate that a build may not pass; code is the process's exit code."""

    def __init__(self, message: str, code: int = 1):
        super().__init__(message)
        self.code = code


@dataclass(frozen=True)
class Gate:
    name: str
    value: Column
    floor: float
    code: int = 1


# The floors of the builds.
OFAC_ADDRESSES, BRIDGE_ADDRESSES, BRIDGES, VASP_ROWS, VASP_MULTI = 800, 150, 9, 1000, 40


def measure(df: DataFrame, gates: list[Gate]) -> DataFrame:
    """name, value, floor and passed of each gate."""
    one = df.agg(*[g.value.cast("double").alias(g.name) for g in gates])
    rows = F.array(*[F.struct(F.lit(g.name).alias("name"), F.coalesce(F.col(g.name), F.lit(0.0)).alias("value"), F.lit(float(g.floor)).alias("floor")) for g in gates])
    return one.select(F.inline(rows)).withColumn("passed", F.col("value") >= F.col("floor"))


def check(df: DataFrame, gates: list[Gate]) -> dict[str, float]:
    """The gates' values; GateFailure for the first that fails."""
    found = {r.name: r.value for r in measure(df, gates).collect()}
    for g in gates:
        if found[g.name] < g.floor:
            raise GateFailure(f"{g.name}: {found[g.name]:g} is below {g.floor:g}", g.code)
    return found


def check_subset(small: DataFrame, large: DataFrame, keys: list[str], what: str) -> None:
    """GateFailure if a key of small is missing from large."""
    if not small.join(large, keys, "left_anti").isEmpty():
        raise GateFailure(f"{what}: a key was dropped")


def check_unique(df: DataFrame, keys: list[str], what: str) -> None:
    if not df.groupBy(*keys).count().where("count > 1").isEmpty():
        raise GateFailure(f"{what}: a key is repeated")
