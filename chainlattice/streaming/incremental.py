"""Incremental forms of two merges, for batches and pages that keep arriving.

Both are additions of this engine: the merges are the batch operators, applied batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.text import links
from ..operators import label_set, standing
from ..schema import ACTIONS, LABEL_SET


def grow_label_set(batches: DataFrame, read: Callable[[], DataFrame], write: Callable[[DataFrame, int], None], now: str) -> DataStreamWriter:
    """Merge each micro-batch of attribution rows (BATCH columns and ord) into the label set that read()
    gives; write(rows, batch number) stores the next version. A repeated batch number must overwrite its
    own version: then a restarted stream merges nothing twice."""

    def merge(rows: DataFrame, number: int) -> None:
        screened = label_set.screen(rows)
        base = read()
        merged = label_set.merge_batch(base, screened, f"stream-{number}", now)
        label_set.check_append_only(base, merged)
        write(merged.select([c.split()[0] for c in LABEL_SET.replace("array<string>", "x").split(", ")]), number)

    return batches.writeStream.foreachBatch(merge)


def latest_actions(actions: DataFrame) -> DataFrame:
    """A stream of dated actions (address, action, action_date) as each address's standing. Late rows do no
    harm: the latest day decides, whatever the order of arrival. The state is one row for each address."""
    vote = F.struct(F.col("action_date").alias("day"), standing.priority(F.col("action")).alias("p"))
    dated = actions.where(F.col("action_date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.col("action").isin(*ACTIONS))
    last = dated.groupBy("address").agg(F.max(vote).alias("last"))
    return last.select("address", F.col("last.day").alias("action_date"), F.when(F.col("last.p") == 0, "removed").otherwise("listed").alias("status"))


def page_links(pages: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Links of arriving pages (html, ts), each once within the watermark."""
    return pages.withWatermark("ts", watermark).select("ts", F.explode(links(F.col("html"))).alias("link")).dropDuplicatesWithinWatermark(["link"])
