"""Spans of a text as native columns: all non-overlapping matches of a pattern with their places.

Spark gives the matches of a pattern, but not where they stand. Splitting the text by the same
pattern gives the gaps between them, and lengths of gaps and matches in turn add up to the places,
in code points. Sums and overlaps are running totals over sorted arrays, so a text with n matches
takes n log n steps. Patterns are written so that Java's matcher needs neither deep recursion nor
quadratic time on very long runs: possessive loops, and starts tied to the beginning of a run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.arrays import running, running_sum

#: In the order of sorting: start, kind as listed, end.
SPAN = "struct<at:int,rank:int,till:int,kind:string,value:string,before:string>"
#: Characters before a span that it carries, no further back than the last match of its pattern.
NEAR = 24
EMPTY = f"array<{SPAN}>"


def matches(text: Column, pattern: str, present: Column | None = None) -> Column:
    """All matches; `present` is a cheap test without which there is none."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return found if present is None else F.when(present, found).otherwise(F.array().cast("array<string>"))


def spans(text: Column, pattern: str, found: Column, rank: int, kind: str) -> Column:
    """found (what matches() gave for the same text and pattern) with start and exclusive end."""
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    pairs = F.zip_with(gaps, found, lambda g, v: F.struct((F.char_length(g) + F.char_length(v)).alias("size"), F.right(g, F.lit(NEAR)).alias("before"), v.alias("value")))
    ends = running(pairs, F.size(found), lambda a, b: F.struct((a["size"] + b["size"]).alias("size"), b["before"].alias("before"), b["value"].alias("value")), F.struct(F.lit(0).alias("size"), F.lit("").alias("before"), F.lit("").alias("value")))
    placed = F.transform(ends, lambda x: _span(x["size"] - F.char_length(x["value"]), x["size"], F.lit(rank), F.lit(kind), x["value"], x["before"]))
    return F.when(F.size(found) > 0, placed).otherwise(F.array().cast(EMPTY))


def _span(at: Column, till: Column, rank: Column, kind: Column, value: Column, before: Column) -> Column:
    return F.struct(at.alias("at"), rank.alias("rank"), till.alias("till"), kind.alias("kind"), value.alias("value"), before.alias("before")).cast(SPAN)


def pairs_of_words(items: Column, titles: tuple[str, ...]) -> Column:
    """Of spans that are runs of words with one space between: a span for every two neighbours that are
    no titles, with the title before them if there is one. Pairs of a run overlap."""
    titled = lambda w: F.rtrim(w, F.lit(".")).isin(*titles)

    def split(s: Column) -> Column:
        words = F.split(s["value"], " ")
        sizes = running_sum(F.transform(words, lambda w: F.char_length(w) + 1), F.size(words))
        placed = F.zip_with(words, sizes, lambda w, e: F.struct(w.alias("word"), (s["at"] + e - 1).alias("till"), titled(w).alias("title")))
        follow = _with_next(placed, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        both = _with_next(F.concat(F.array(F.lit(None)), follow), lambda x, y: F.struct(x["a"].alias("ahead"), y["a"].alias("a"), y["b"].alias("b")))
        good = F.filter(both, lambda x: x["b"].isNotNull() & ~x["a"]["title"] & ~x["b"]["title"])
        name = lambda x: F.concat_ws(" ", F.when(x["ahead"]["title"], x["ahead"]["word"]), x["a"]["word"], x["b"]["word"])
        before = lambda x: F.coalesce(x["ahead"]["word"], s["before"])
        return F.transform(good, lambda x: _span(x["b"]["till"] - F.char_length(name(x)), x["b"]["till"], s["rank"], s["kind"], name(x), before(x)))

    return F.flatten(F.transform(items, split))


def clear_of(items: Column, others: Column) -> Column:
    """The items that overlap none of the others. Both are sorted together by position, others by start
    and items by end: an item is overlapped if the furthest end of the others before it is beyond its start."""
    mark = lambda s, at, other: F.struct(at.alias("pos"), F.lit(other).alias("other"), F.when(F.lit(other == 1), s["till"]).otherwise(0).alias("reach"), s.alias("span"))
    marks = F.array_sort(F.concat(F.transform(items, lambda s: mark(s, s["till"], 0)), F.transform(others, lambda s: mark(s, s["at"], 1))))
    reach = running(F.transform(marks, lambda x: x["reach"]), F.size(items) + F.size(others), lambda a, b: F.greatest(a, b), F.lit(0))
    judged = F.zip_with(marks, reach, lambda x, r: F.struct(((x["other"] == 0) & (r <= x["span"]["at"])).alias("free"), x["span"].alias("span")))
    kept = F.transform(F.filter(judged, lambda x: x["free"]), lambda x: x["span"])
    return F.when((F.size(items) == 0) | (F.size(others) == 0), items).otherwise(kept)


def outside(items: Column, others: Column) -> Column:
    """The parts of the items (which don't overlap each other) that none of the others covers. Starts and
    ends of all are sorted; running sums tell what is open between two of them."""
    none = F.lit(None).cast(SPAN)
    event = lambda pos, own, other, span: F.struct(pos.alias("pos"), F.lit(own).alias("own"), F.lit(other).alias("other"), span.alias("span"))
    events = F.array_sort(
        F.concat(
            F.transform(items, lambda s: event(s["at"], 1, 0, s)),
            F.transform(items, lambda s: event(s["till"], -1, 0, none)),
            F.transform(others, lambda s: event(s["at"], 0, 1, none)),
            F.transform(others, lambda s: event(s["till"], 0, -1, none)),
        )
    )
    add = lambda a, b: F.struct(b["pos"].alias("pos"), (a["own"] + b["own"]).alias("own"), (a["other"] + b["other"]).alias("other"), F.coalesce(b["span"], a["span"]).alias("span"))
    open_at = running(events, 2 * (F.size(items) + F.size(others)), add, event(F.lit(None).cast("int"), 0, 0, none))
    upto = lambda x, later: F.struct(x["own"].alias("own"), x["other"].alias("other"), x["pos"].alias("at"), later["pos"].alias("till"), x["span"].alias("span"))
    return F.when((F.size(items) == 0) | (F.size(others) == 0), items).otherwise(
        F.transform(
            F.filter(_with_next(open_at, upto), lambda x: (x["own"] > 0) & (x["other"] == 0) & (x["at"] < x["till"])),
            lambda x: part(x["span"], x["at"], x["till"]),
        )
    )


def _with_next(items: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """combine of each element and the next one; null in place of the one after the last."""
    return F.element_at(F.transform(F.array(items), lambda a: F.zip_with(a, F.slice(a, F.lit(2), F.size(a)), combine)), 1)


def likeliest(scored: Column) -> Column:
    """Of spans with a score `p`, ordered by place: those that no neighbour overlaps whose score is higher,
    or the same and to the left."""
    none = F.array(F.lit(None))
    with_next = _with_next(scored, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    three = F.zip_with(F.concat(none, F.slice(with_next, F.lit(1), F.greatest(F.size(with_next) - 1, F.lit(0)))), with_next, lambda a, b: F.struct(a["x"].alias("ahead"), b["x"].alias("x"), b["y"].alias("next")))
    left = lambda t: t["ahead"].isNull() | (t["ahead"]["span"]["till"] <= t["x"]["span"]["at"]) | (t["ahead"]["p"] < t["x"]["p"])
    right = lambda t: t["next"].isNull() | (t["next"]["span"]["at"] >= t["x"]["span"]["till"]) | (t["next"]["p"] <= t["x"]["p"])
    kept = F.transform(F.filter(three, lambda t: left(t) & right(t)), lambda t: t["x"]["span"])
    return F.when(F.size(scored) > 0, kept).otherwise(F.array().cast(EMPTY))


def part(span: Column, at: Column, till: Column) -> Column:
    """The span from `at` to `till`."""
    value = F.substring(span["value"], at - span["at"] + 1, till - at)
    return _span(at, till, span["rank"], span["kind"], value, F.lit(None))


def listed(items: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["at"], s["till"])), ",")


def count(items: Column, kind: str) -> Column:
    return F.size(F.filter(items, lambda s: s["kind"] == kind)).cast("long")


def by_start(items: Column) -> Column:
    return F.array_sort(items)


def by_kind(items: Column) -> Column:
    ordered = F.array_sort(F.transform(items, lambda s: F.struct(s["rank"].alias("rank"), s["at"].alias("at"), s.alias("span"))))
    return F.transform(ordered, lambda x: x["span"])


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    reversed_digits = F.transform(F.split(F.reverse(number), ""), lambda d: F.coalesce(F.try_to_number(d, F.lit("9")).cast("int"), F.lit(0)))
    doubled: Callable = lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))
    return F.aggregate(F.transform(reversed_digits, doubled), F.lit(0), lambda a, d: a + d) % 10 == 0
