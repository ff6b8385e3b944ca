"""A record's standing from its dated press-release labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.chains import lookup, strip
from ..functions.dates import ISO_DAY
from ..schema import ACTIONS, ILLICIT_SOURCES, ILLICIT_TYPES, PRESS_RELEASE


def priority(action: Column) -> Column:
    return lookup(action, {k: str(v) for k, v in ACTIONS.items()}).cast("int")


def net_action(actions: Column) -> Column:
    """The strongest of an array of actions; designation if there is none."""
    best = F.array_max(F.transform(actions, lambda a: F.struct(F.coalesce(priority(a), F.lit(-1)).alias("p"), a.alias("a"))))
    return F.coalesce(best["a"], F.lit("designation"))


def claims_illicit(label: Column) -> Column:
    return F.lower(strip(F.coalesce(label["type"], F.lit("")))).isin(*ILLICIT_TYPES) | F.coalesce(label["source"], F.lit("")).isin(*ILLICIT_SOURCES)


def press_status(labels: Column) -> Column:
    """listed or removed by the latest dated action (same day: the strongest), or null."""
    votes = F.filter(labels, lambda x: (x["source"] == PRESS_RELEASE) & priority(x["context"]["action"]).isNotNull() & x["context"]["action_date"].rlike(ISO_DAY))
    last = F.array_max(F.transform(votes, lambda x: F.struct(x["context"]["action_date"].alias("day"), priority(x["context"]["action"]).alias("p"))))
    return F.when(last["p"] == ACTIONS["removal"], "removed").when(last.isNotNull(), "listed")


def reconcile(records: DataFrame) -> DataFrame:
    """records with sanctioned, is_illicit and category as their labels say, press_status and changed."""
    others = F.filter("labels", lambda x: ~x["source"].eqNullSafe(F.lit(PRESS_RELEASE)))
    sanctioned_elsewhere = F.exists(others, lambda x: F.lower(strip(F.coalesce(x["type"], F.lit("")))) == "sanctioned")
    status = F.col("press_status")
    listed = (status == "listed") | (status.isNotNull() & F.col("__elsewhere"))
    removed = (status == "removed") & ~F.col("__elsewhere")
    was = {f: F.coalesce(F.col(f), F.lit(False)) for f in ("sanctioned", "is_illicit")}
    category = (
        F.when(listed & (F.col("category").isNull() | (F.col("category") == "unknown")), "sanctioned")
        .when(removed & (F.col("category") == "sanctioned"), F.lit(None).cast("string"))
        .otherwise(F.col("category"))
    )
    marked = records.withColumns({"press_status": press_status(F.col("labels")), "__elsewhere": sanctioned_elsewhere, "__illicit": F.exists(others, claims_illicit)})
    new = {
        "__sanctioned": F.when(listed, True).when(removed, False).otherwise(was["sanctioned"]),
        "__is_illicit": F.when(listed, True).when(removed, F.col("__illicit")).otherwise(was["is_illicit"]),
        "__category": category,
    }
    out = marked.withColumns(new)
    changed = (F.col("__sanctioned") != was["sanctioned"]) | (F.col("__is_illicit") != was["is_illicit"]) | ~F.col("__category").eqNullSafe(F.col("category"))
    return out.withColumn("changed", changed).withColumns({"sanctioned": F.col("__sanctioned"), "is_illicit": F.col("__is_illicit"), "category": F.col("__category")}).drop("__elsewhere", "__illicit", *new)
