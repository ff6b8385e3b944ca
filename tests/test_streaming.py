"""The streams on folders of files."""

import json

from chainlattice.operators import label_set
from chainlattice.schema import BATCH, LABEL_SET
from chainlattice.streaming import incremental

EVM = "0x" + "ab" * 20


def test_label_set_grows(spark, tmp_path):
    rows = [{"ord": 1, "chain": "eth", "address": EVM, "classes": ["a"], "source_url": "u", "source_date": "d"}, {"ord": 2, "chain": "eth", "address": EVM, "classes": ["b"], "source_url": "u", "source_date": "d"}]
    (tmp_path / "in").mkdir()
    for i, r in enumerate(rows):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps(r))
    versions = []

    def read():
        return spark.read.schema(LABEL_SET).parquet(versions[-1]) if versions else spark.createDataFrame([], LABEL_SET)

    def write(merged, number):
        path = str(tmp_path / f"v{number}")
        merged.write.mode("overwrite").parquet(path)
        versions.append(path)

    stream = spark.readStream.schema(f"ord long, {BATCH}").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    incremental.grow_label_set(stream, read, write, "now").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    r = read().collect()
    assert len(versions) == 2 and len(r) == 1 and r[0].classes == ["a", "b"] and r[0].sources == ["attribution_batch:stream-0", "attribution_batch:stream-1"]
    assert label_set.screen(spark.createDataFrame([], f"ord long, {BATCH}")).count() == 0


def test_latest_actions(spark, tmp_path):
    rows = [("a", "designation", "2020-01-01"), ("a", "removal", "2021-01-01"), ("b", "removal", "2021-01-01"), ("b", "designation", "2021-01-01"), ("c", "x", "2021-01-01"), ("d", "change", "soon")]
    spark.createDataFrame(rows, "address string, action string, action_date string").repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("address string, action string, action_date string").parquet(str(tmp_path / "in"))
    incremental.latest_actions(stream).writeStream.format("memory").queryName("standing").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert {r.address: r.status for r in spark.table("standing").collect()} == {"a": "removed", "b": "listed"}


def test_page_links(spark, tmp_path):
    spark.createDataFrame([('<a href="/x"><a href="/y">', "2024-01-01 00:00:00"), ('<a href="/x">', "2024-01-01 01:00:00")], "html string, t string").selectExpr("html", "cast(t as timestamp) as ts").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("html string, ts timestamp").parquet(str(tmp_path / "in"))
    incremental.page_links(stream).writeStream.format("memory").queryName("links").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.link for r in spark.table("links").collect()) == ["/x", "/y"]
