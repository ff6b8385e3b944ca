"""Sequenced change applier: numbered changes of clients applied in order by a stateful stream, with a timing wheel.

Changes are numbered per client by the dense rank of seq, then cut into batches by day and written as
files. One streaming query, started anew for each batch on one checkpoint, keeps a state per bucket of clients:

* per client: next number, city, balance, and the changes held until their turn;
* a wheel: expiry day (earliest held day + WAIT) -> clients that hold changes.

A tick row wakes every bucket in every batch, even an empty one. Only slots up to the largest day
of earlier batches are visited; their clients jump to their smallest held number until nothing held is due, and are put into the
slot of their new earliest day. Last, a batch without changes makes every client jump to its end.

Within a batch a change is rejected if its number is below the client's next one at the start, or held, or
also that of an earlier change (by day, change_id) of the batch: next never passes a number that has not come,
so nothing needs sorting, and equal numbers compete in a dictionary.

Buckets follow the number of rows (ROWS a bucket). A client of more than SPAN numbers is split: each SPAN of
its numbers is a unit of its own, in any bucket, with its held changes and its own place on a wheel. At the end of a
batch, units report their first missing number and, from the slots that are due by the next batch, their largest due
number. Aggregates of these reports (`bounds`) give per client the number that the run has reached and the one that the
next batch's jump reaches; units hear of both at the next batch and apply their changes below
them, labelled with the batch that each belongs to. Values and missed numbers of such clients follow afterwards, from a
scan by units, whose own ends are scanned by groups of SPAN units, and so on (`carried`). So no task
has all changes of a client, nor all its units. Changes of one number stand together. The rank counts distinct (client,
seq) by ranges.

Cases: changes without change_id or valid_at, or with crc32(change_id) divisible by 11, go after numbering.
A null client is a client, a null seq the smallest. Days before the first batch fall into it. Repeated rows
count once; different rows with one change_id compete by op, city and balance. NaN balances are null; operations other than I, U
and D change nothing. Other columns only tell rows apart. An empty table gives no rows.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, shared_path

#: Days that a change may be held while later ones arrive.
WAIT = 8
BATCHES, FIRST_DAY, DAYS = 10, 19723, 160
#: Changes a bucket, on average.
ROWS = 4096
#: Numbers a unit of a client that has more, and parts that one step of a scan takes together.
SPAN = 1024
#: Tasks that share a client's units where these meet what holds for the whole client.
SALTS = 64
EVER = 2**31 - 1
COLUMNS = ("change_id", "client_id", "seq", "op", "valid_at", "city", "balance")
FEED = "bucket int, change_id long, client string, n long, day int, op string, city string, balance double, unit long, ran long, next long"
RESULT = "change_id long, client string, n long, op string, batch int, missed long, city string, cents long, balance double, unit long, due long, gap long, status string"
STATE = "clients binary, wheel binary, units binary, unit_wheel binary"


def ranked(changes: DataFrame) -> DataFrame:
    """Distinct changes with n, the dense rank of seq per client_id, and top, the client's largest n. Distinct pairs are sorted by ranges, ranked inside
    each range, and moved by the client's pairs in earlier ranges: a client of many changes is spread."""
    rows = durable(changes.distinct().select(*COLUMNS), "changes")
    pairs = rows.select("client_id", "seq").distinct().repartitionByRange("client_id", "seq").withColumn("part", F.spark_partition_id())
    pairs = durable(pairs, "ranges")
    before = Window.partitionBy("client_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = pairs.groupBy("client_id", "part").count().select("client_id", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("moved"), F.sum("count").over(Window.partitionBy("client_id")).alias("top"))
    own = Window.partitionBy("client_id", "part").orderBy("seq")
    inside = pairs.withColumn("i", F.row_number().over(own)).alias("p")
    m = moved.alias("m")
    ranks = inside.join(m, F.col("p.client_id").eqNullSafe(F.col("m.client_id")) & (F.col("p.part") == F.col("m.part")))
    ranks = ranks.select(F.col("p.client_id").alias("own_client"), F.col("p.seq").alias("own_seq"), (F.col("i") + F.col("moved")).cast("long").alias("n"), "top")
    return rows.join(ranks, F.col("client_id").eqNullSafe(F.col("own_client")) & F.col("seq").eqNullSafe(F.col("own_seq"))).drop("own_client", "own_seq")


def cut(changes: DataFrame) -> DataFrame:
    """The changes that stay, with day and batch."""
    h = F.crc32(F.col("change_id").cast("string").cast("binary"))
    day = (F.unix_date(F.to_date("valid_at")) + 5 * (h % 4)).cast("int")
    batch = F.greatest(F.lit(1), F.least(F.lit(BATCHES), 1 + F.floor((F.col("day") - FIRST_DAY) * BATCHES / DAYS))).cast("int")
    return changes.where(F.col("valid_at").isNotNull() & (h % 11 != 0)).withColumn("day", day).withColumn("batch", batch)


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64("client", "unit"), F.lit(n)).cast("int")


class Client:
    """Next number, values, and the held changes by number: (day, change_id, op, city, balance)."""

    __slots__ = ("next", "city", "balance", "held", "slot")

    def __init__(self) -> None:
        self.next, self.city, self.balance, self.held, self.slot = 1, None, None, {}, None

    def run(self, out: list, name: Any, batch: int, missed: int) -> None:
        """Apply held changes from the next number on, as long as they follow one another."""
        while (change := self.held.pop(self.next, None)) is not None:
            _, change_id, op, city, balance = change
            if op == "I":
                self.city, self.balance = city, balance
            elif op == "U":
                self.city, self.balance = self.city if city is None else city, self.balance if balance is None else balance
            elif op == "D":
                self.city = self.balance = None
            cents = None if self.balance is None else math.floor(100 * self.balance + 0.5)
            out.append((change_id, name, self.next, op, batch, missed, self.city, cents, None, None, None, None, "applied"))
            self.next, missed = self.next + 1, 0


class Unit:
    """The held changes among SPAN numbers of a client, and its next number as last heard of."""

    __slots__ = ("next", "held", "slot")

    def __init__(self) -> None:
        self.next, self.held, self.slot = 1, {}, None

    def gap(self, first: int, end: int) -> int:
        """The first number from first on that is not held; end if there is none before it."""
        return next((n for n in range(first, end) if n not in self.held), end)


def _schedule(wheel: dict[int, set], name: Any, c: Client | Unit) -> None:
    """Put a client or unit into the slot of its earliest held day, out of the one it was in."""
    slot = min(h[0] for h in c.held.values()) + WAIT if c.held else None
    if slot != c.slot:
        if c.slot in wheel:
            wheel[c.slot].discard(name)
            if not wheel[c.slot]:
                del wheel[c.slot]
        if slot is not None:
            wheel.setdefault(slot, set()).add(name)
        c.slot = slot


class Bucket:
    """The clients of a bucket and its wheel; units of long clients and theirs."""

    def __init__(self, clients: dict | None = None, wheel: dict | None = None, units: dict | None = None, unit_wheel: dict | None = None, span: int = SPAN):
        self.clients: dict[Any, Client] = clients or {}
        self.wheel: dict[int, set] = wheel or {}
        self.units: dict[tuple, Unit] = units or {}
        self.unit_wheel: dict[int, set] = unit_wheel or {}
        self.span = span

    def hear(self, told: Iterable[tuple], batch: int, out: list) -> None:
        """Apply what units hold below the numbers that their client ran to in the batch before and jumped to in this
        one; told: client, unit, ran, next."""
        for client, unit, ran, following in told:
            u = self.units[client, unit]
            u.next = following
            for n in sorted(n for n in u.held if n < following):
                _, change_id, op, city, balance = u.held.pop(n)
                out.append((change_id, client, n, op, batch - (n < ran), 0, city, None, balance, unit, None, None, "applied"))
            _schedule(self.unit_wheel, (client, unit), u)
            if not u.held:
                del self.units[client, unit]

    def report(self, coming: int | None, batch: int, out: list) -> None:
        """First missing number of each unit, and of those in due slots the largest due number and the first missing one after it."""
        due: dict[tuple, int] = {}
        for slot in [s for s in self.unit_wheel if coming is not None and s <= coming]:
            for name in self.unit_wheel[slot]:
                due[name] = max(n for n, h in self.units[name].held.items() if h[0] + WAIT <= coming)
        for (client, unit), u in self.units.items():
            low, end, last = unit * self.span, (unit + 1) * self.span, due.get((client, unit))
            out.append((None, client, u.gap(max(low, u.next), end), None, batch, 0, None, None, None, unit, last, None if last is None else u.gap(last + 1, end), "open"))

    def tick(self, today: int | None, batch: int, out: list) -> None:
        """Visit the due slots. A due change is reached when all held numbers up to it are applied: jumping goes on up to the
        largest due number."""
        if today is None:
            return
        for slot in sorted(s for s in self.wheel if s <= today):
            for name in self.wheel.pop(slot):
                c = self.clients[name]
                c.slot = None
                last = max(n for n, h in c.held.items() if h[0] + WAIT <= today)
                for n in sorted(c.held):
                    if n > last:
                        break
                    if n in c.held:
                        missed, c.next = n - c.next, n
                        c.run(out, name, batch, missed)
                _schedule(self.wheel, name, c)

    def take(self, rows: Iterable[tuple], batch: int, out: list) -> None:
        """Hold or reject the changes of a batch, then apply what follows; rows: change_id, client, n, day, op, city, balance,
        and for those of long clients unit and next."""
        new: dict[tuple, tuple] = {}

        def reject(change: tuple, name: Any, n: int) -> None:
            out.append((change[1], name, n, change[2], batch, 0, None, None, None, None, None, None, "rejected"))

        for change_id, name, n, day, op, city, balance, *where in rows:
            unit, following = where or (None, None)
            if unit is None:
                c = self.clients.setdefault(name, Client())
            else:
                c = self.units.setdefault((name, unit), Unit())
                c.next = following
            change = (day, change_id, op, city, balance)
            if n < c.next or n in c.held:
                reject(change, name, n)
                continue
            other = new.get((name, unit, n))
            if other is not None:
                change, other = sorted((change, other), key=_order)
                reject(other, name, n)
            new[name, unit, n] = change
        touched = set()
        for (name, unit, n), change in new.items():
            (self.clients[name] if unit is None else self.units[name, unit]).held[n] = change
            touched.add((name, unit))
        for name, unit in touched:
            if unit is None:
                self.clients[name].run(out, name, batch, 0)
                _schedule(self.wheel, name, self.clients[name])
            else:
                _schedule(self.unit_wheel, (name, unit), self.units[name, unit])
        for key in [key for key, u in self.units.items() if not u.held]:
            del self.units[key]


def _order(change: tuple) -> tuple:
    return tuple((v is not None, v) if v is not None else (False,) for v in change)


def _whole(value: Any) -> int | None:
    return None if pd.isna(value) else int(value)


def _rows(frame: pd.DataFrame) -> Iterator[tuple]:
    own = frame[frame["n"] > 0]
    for change_id, client, n, day, op, city, balance, unit, following in zip(*[own[c].tolist() for c in ("change_id", "client", "n", "day", "op", "city", "balance", "unit", "next")], strict=True):
        yield change_id, client, n, day, op, city, None if balance is None or not math.isfinite(balance) else balance, _whole(unit), _whole(following)


def _told(frame: pd.DataFrame) -> Iterator[tuple]:
    own = frame[(frame["n"] == 0) & frame["unit"].notna()]
    for client, unit, ran, following in zip(*[own[c].tolist() for c in ("client", "unit", "ran", "next")], strict=True):
        yield client, int(unit), int(ran), int(following)


def _step(batch: int, today: int | None, coming: int | None, span: int):
    """What the stream does with a bucket in a batch. today, coming: the largest days before this batch and before the next."""
    names = [c.split()[0] for c in RESULT.split(", ")]

    def step(key, frames, state):
        clients, wheel, units, unit_wheel = map(pickle.loads, state.get) if state.exists else (None,) * 4
        bucket = Bucket(clients, wheel, units, unit_wheel, span)
        out: list[tuple] = []
        own = list(frames)
        bucket.hear((row for frame in own for row in _told(frame)), batch, out)
        bucket.tick(today, batch, out)
        bucket.take((row for frame in own for row in _rows(frame)), batch, out)
        bucket.report(coming, batch, out)
        if bucket.clients or bucket.units or state.exists:
            state.update(tuple(map(pickle.dumps, (bucket.clients, bucket.wheel, bucket.units, bucket.unit_wheel))))
        if out:
            done = pd.DataFrame(out, columns=names)
            for c in ("change_id", "n", "missed", "cents", "unit", "due", "gap"):
                done[c] = done[c].astype("Int64")
            done["balance"] = done["balance"].astype("Float64")
            yield done

    return step


def _client(other: str = "whose") -> Column:
    return F.col("client").eqNullSafe(F.col(other))


def _with_client(rows: DataFrame, clients: DataFrame) -> DataFrame:
    """rows (client, unit, ...) with what clients (client, top_unit, ...) tell, null for clients without a row there. A client's row
    is repeated for SALTS groups of its units at most, so a client's units don't meet in one task."""
    last = F.least(F.coalesce("top_unit", F.lit(0)), F.lit(SALTS - 1)).cast("int")
    spread = clients.withColumnRenamed("client", "whose").withColumn("lane", F.explode(F.sequence(F.lit(0), last))).drop("top_unit")
    return rows.join(spread, _client() & (F.col("unit") % SALTS == F.col("lane")), "left").drop("whose", "lane")


def bounds(reports: DataFrame, known: DataFrame, span: int = SPAN) -> DataFrame:
    """client, top_unit, ran and next of long clients: the numbers that they ran to in the batch of the reports and jump to in the
    next one. reports: client, unit, n, due, gap; known: client, top_unit, next, of all long clients."""
    end = (F.col("unit") + 1) * span
    after = reports.select(F.col("client").alias("whose"), (F.col("unit") - 1).alias("before"))
    ends = reports.join(after, _client() & (F.col("unit") == F.col("before")), "left")
    stop = lambda at: F.when(F.col(at) < end, F.col(at)).when(F.col("before").isNull(), end)
    ends = ends.select("client", "unit", "due", stop("n").alias("stop"), stop("gap").alias("due_stop"))
    own = ends.groupBy(F.col("client").alias("whose")).agg(F.min("unit").alias("first"), F.min("stop").alias("reached"), F.max("due").alias("due"))
    ran = F.when(F.col("first") == F.floor(F.col("next") / span), F.col("reached")).otherwise(F.col("next"))
    clients = known.join(own, _client(), "left").select("client", "top_unit", ran.alias("ran"), "due")
    last = clients.select("client", "top_unit", F.col("due").alias("last"))
    met = _with_client(ends, last)
    at = F.floor(F.col("last") / span)
    jumped = met.groupBy(F.col("client").alias("whose")).agg(F.min(F.when(F.col("unit") == at, F.col("due_stop")).when(F.col("unit") > at, F.col("stop"))).alias("jumped"))
    following = F.when(F.col("due") >= F.col("ran"), F.col("jumped")).otherwise(F.col("ran"))
    return clients.join(jumped, _client(), "left").select("client", "top_unit", "ran", following.alias("next"))


def carried(parts: DataFrame, names: list[str], top: int, span: int = SPAN) -> DataFrame:
    """parts (client, unit, names) with the last non-null value of each name in earlier units of the client. top: the largest unit.
    Units are scanned in groups of SPAN, the groups' ends by themselves."""
    last = lambda w: [F.last(c, True).over(w.orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)).alias(c) for c in names]
    if top < span:
        return parts.select("client", "unit", *last(Window.partitionBy("client")))
    grouped = parts.withColumn("set", F.floor(F.col("unit") / span))
    ends = grouped.groupBy("client", "set").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("unit"))).alias(c) for c in names])
    above = carried(ends.withColumnRenamed("set", "unit"), names, top // span, span)
    above = above.select(F.col("client").alias("whose"), F.col("unit").alias("of"), *[F.col(c).alias(f"far_{c}") for c in names])
    inside = grouped.select("client", "unit", "set", *last(Window.partitionBy("client", "set")))
    both = inside.join(above, _client() & (F.col("set") == F.col("of")), "left")
    return both.select("client", "unit", *[F.coalesce(c, f"far_{c}").alias(c) for c in names])


def valued(applied: DataFrame, top: int, span: int = SPAN) -> DataFrame:
    """missed, city and cents of the applied changes of long clients. top: the largest unit."""
    names = ["own_city", "own_balance", "own_n"]
    whole = F.coalesce(F.col("op").isin("I", "D"), F.lit(False))
    sets = lambda c: F.when(whole, F.struct(F.when(F.col("op") == "I", F.col(c)).alias("v"))).when((F.col("op") == "U") & F.col(c).isNotNull(), F.struct(F.col(c).alias("v")))
    rows = applied.withColumns({"own_city": sets("city"), "own_balance": sets("balance"), "own_n": F.col("n")})
    ends = rows.groupBy("client", "unit").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("n"))).alias(c) for c in names])
    far = carried(ends, names, top, span).select(F.col("client").alias("whose"), F.col("unit").alias("of"), *[F.col(c).alias(f"far_{c}") for c in names])
    own = Window.partitionBy("client", "unit").orderBy("n")
    so_far = own.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"own_city": F.last("own_city", True).over(so_far), "own_balance": F.last("own_balance", True).over(so_far), "own_n": F.lag("n").over(own)})
    rows = rows.join(far, _client() & (F.col("unit") == F.col("of")), "left")
    value = lambda c: F.coalesce(f"own_{c}", f"far_own_{c}")
    return rows.withColumns(
        {"missed": F.col("n") - F.coalesce(value("n"), F.lit(0)) - 1, "city": value("city")["v"], "cents": F.floor(100 * value("balance")["v"] + 0.5).cast("long")}
    ).select(applied.columns)


def apply(changes: DataFrame, span: int = SPAN, a_bucket: int = ROWS) -> DataFrame:
    """change_id, client_id, status, batch, missed, city, cents and current of every change that stays."""
    spark = changes.sparkSession
    root = shared_path(spark, "applier")
    kept = cut(ranked(changes)).withColumn("unit", F.when(F.col("top") > span, F.floor(F.col("n") / span)))
    kept = kept.select("change_id", F.col("client_id").cast("string").alias("client"), "n", "day", "op", "city", F.col("balance").cast("double").alias("balance"), "unit", "top", "batch")
    kept.write.partitionBy("batch").parquet(f"{root}/rows")
    rows = spark.read.schema(kept.schema).parquet(f"{root}/rows")
    days = {r.batch: r for r in rows.groupBy("batch").agg(F.count("*").alias("n"), F.max("day").alias("day"), F.max("unit").alias("unit")).collect()}
    n = max(1, -(-sum(r.n for r in days.values()) // a_bucket))
    top = max((r.unit for r in days.values() if r.unit is not None), default=None)
    feed = [c.split() for c in FEED.split(", ")]
    row = lambda df, **own: df.select(*[own.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in feed])
    ticks = row(spark.range(n), bucket=F.col("id"), change_id=F.lit(-1), n=F.lit(0), day=F.lit(0))
    known, told = None, None
    if top is not None:
        known = rows.where(F.col("unit").isNotNull()).groupBy("client").agg(F.max("unit").alias("top_unit")).withColumn("ran", F.lit(1).cast("long")).withColumn("next", F.lit(1).cast("long"))
        known = durable(known, "bounds")
    day = lambda batch: max((r.day for b, r in days.items() if b < batch), default=None) if batch <= BATCHES else EVER
    listed = [c for c, _ in feed if c != "bucket"]
    for batch in range(1, BATCHES + 2):
        own = rows.where(F.col("batch") == batch).drop("batch", "top")
        short = own.where(F.col("unit").isNull()) if known is not None else own
        fed = short.withColumns({"ran": F.lit(None).cast("long"), "next": F.lit(None).cast("long")}).select(listed)
        if known is not None:
            fed = fed.unionByName(_with_client(own.where(F.col("unit").isNotNull()), known).select(listed))
            if told is not None:
                fed = fed.unionByName(told)
        fed = fed.withColumn("bucket", _bucket(n)).select([c for c, _ in feed])
        fed.unionByName(ticks).write.mode("append").parquet(f"{root}/feed")
        stream = spark.readStream.schema(FEED).parquet(f"{root}/feed").groupBy("bucket")
        done = stream.applyInPandasWithState(_step(batch, day(batch), day(batch + 1), span), RESULT, STATE, "append", "NoTimeout")
        query = done.writeStream.format("parquet").partitionBy("status").option("path", f"{root}/done").option("checkpointLocation", f"{root}/checkpoint").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
        if known is not None and batch <= BATCHES:
            reports = spark.read.schema(RESULT).parquet(f"{root}/done").where((F.col("status") == "open") & (F.col("batch") == batch)).select("client", "unit", "n", "due", "gap")
            known = durable(bounds(reports, known, span), "bounds")
            told = row(_with_client(reports.select("client", "unit"), known), client=F.col("client"), unit=F.col("unit"), ran=F.col("ran"), next=F.col("next"), n=F.lit(0)).select(listed)
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    out = spark.read.schema(RESULT).parquet(f"{root}/done").where("status != 'open'")
    if top is not None:
        long = (F.col("status") == "applied") & F.col("unit").isNotNull()
        out = out.where(~long).unionByName(valued(out.where(long), top, span))
    last = out.where("status = 'applied'").groupBy("client").agg(F.max("n").alias("last_n")).withColumnRenamed("client", "own")
    final = F.col("client").eqNullSafe(F.col("own")) & (F.col("n") == F.col("last_n")) & (F.col("status") == "applied")
    return out.join(last, final, "left").select(
        "change_id", F.col("client").cast("long").alias("client_id"), "status", "batch", "missed", "city", "cents", (F.col("last_n").isNotNull() & F.coalesce(F.col("op") != "D", F.lit(True))).alias("current"),
    )
