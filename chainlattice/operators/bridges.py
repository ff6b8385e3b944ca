"""The bridge registry: escrows anywhere in a project's JSON, split by the kind of project."""

from __future__ import annotations

import json as jsonlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from .dedupe import first_wins
from .gates import BRIDGE_ADDRESSES, BRIDGES, Gate

# Declared types that make a bridge, in the order they are looked for.
DECLARED = ("denomination", "intent", "liquidity", "canonical", "aggregator")
#: Levels of a document that the JSON parser takes.
DEEPEST = 1000


_TOKEN = re.compile(r'\s*("(?:[^"\\\x00-\x1f]|\\.)*"|[{}\[\]:,]|-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null)')
_FOUND = ("escrow_address", "chain", "token_address", "error")


def escrows(body: str) -> Iterator[tuple[str, str | None, str | None]]:
    """Escrow address, chain and token address of every balanceOfEscrow object of a JSON text of any depth and size:
    one pass over its tokens with a stack of open objects and lists. Of equal keys the last counts. ValueError if malformed."""
    stack: list[dict | None] = []  # scalars by key of each open object; None for a list
    keys: list[str | None] = []
    wanted, at, end = "value", 0, len(body.rstrip())
    while at < end:
        m = _TOKEN.match(body, at)
        if not m:
            raise ValueError(f"no JSON token at character {at}")
        token, at = m.group(1), m.end()
        if token in "]}" and stack and wanted in ("next", "first"):
            top = stack.pop()
            keys.pop()
            if (token == "}") == (top is None):
                raise ValueError(f"unexpected {token} at character {at - 1}")
            if top and top.get("type") == "balanceOfEscrow" and top.get("escrowAddress"):
                yield top["escrowAddress"], top.get("chain"), top.get("address")
            wanted = "next" if stack else "end"
        elif wanted == "next" and token == ",":
            wanted = "value" if stack[-1] is None else "key"
        elif wanted == "colon" and token == ":":
            wanted = "value"
        elif (wanted == "key" or (wanted == "first" and stack[-1] is not None)) and token[0] == '"':
            keys[-1], wanted = jsonlib.loads(token), "colon"
        elif (wanted == "value" or (wanted == "first" and stack[-1] is None)) and token not in ",:]}":
            if stack and stack[-1] is not None:
                stack[-1][keys[-1]] = None if token in "[{" or token == "null" else jsonlib.loads(token) if token[0] == '"' else token
            if token in "[{":
                stack.append({} if token == "{" else None)
                keys.append(None)
            wanted = "first" if token in "[{" else "next" if stack else "end"
        else:
            raise ValueError(f"unexpected {token[:20]} at character {at - len(token)}")
    if wanted != "end":
        raise ValueError(f"the text ends at character {end}, a {'value' if wanted == 'value' else 'closing mark'} is missing")


def _scanned(docs: DataFrame, key: str, json: str) -> DataFrame:
    """key, escrow_address, chain, token_address and error of the documents that the JSON parser refuses: deep, large, with
    repeated keys, or malformed. A malformed one gives a single row, with its error."""
    kinds = StructType([docs.select(key).schema.fields[0], *[StructField(c, StringType()) for c in _FOUND]])
    arrow = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, body in enumerate(batch.column(1)):
                try:
                    found = [(*e, None) for e in escrows(body.as_py())]
                except ValueError as e:
                    found = [(None, None, None, str(e))]
                if found:
                    own = batch.column(0).take(pa.array([i] * len(found)))
                    yield pa.RecordBatch.from_arrays([own, *[pa.array(c, pa.string()) for c in zip(*found, strict=True)]], schema=arrow)

    refused = docs.select(key, json).where(F.col(json).isNotNull() & F.try_parse_json(F.col(json)).isNull())
    return refused.mapInArrow(run, kinds)


def failures(docs: DataFrame, key: str = "path", json: str = "body") -> DataFrame:
    """key and error of every document that is no JSON."""
    return _scanned(docs, key, json).where("error is not null").select(key, "error")


def walk(docs: DataFrame, key: str = "path", json: str = "body") -> DataFrame:
    """key, escrow_address, chain and token_address of every object of type balanceOfEscrow, however deep.

    Each document is taken apart for itself, level by level as variants: as many levels as it has opening
    brackets, DEEPEST at most, which is what the parser takes. No document waits for another. Documents that the parser refuses
    are read token by token (escrows); malformed ones have no escrows and are listed by failures, null ones are no documents.
    What follows a complete value is ignored, as by the parser."""
    item = "struct<escrow_address:string,chain:string,token_address:string>"
    text = lambda v, k: F.try_variant_get(v, f"$.{k}", "string")
    inside = lambda v: F.coalesce(F.map_values(F.try_variant_get(v, "$", "map<string,variant>")), F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))
    own = lambda v: F.struct(text(v, "escrowAddress").alias("escrow_address"), text(v, "chain").alias("chain"), text(v, "address").alias("token_address")).cast(item)
    of_type = lambda vs: F.transform(F.filter(vs, lambda v: (text(v, "type") == "balanceOfEscrow") & (F.coalesce(text(v, "escrowAddress"), F.lit("")) != "")), own)

    def descend(acc: Column, _: Column) -> Column:
        below = F.flatten(F.transform(acc["level"], inside))
        return F.when(F.size(acc["level"]) == 0, acc).otherwise(F.struct(below.alias("level"), F.concat(acc["found"], of_type(acc["level"])).alias("found")))

    levels = F.least(F.size(F.regexp_extract_all(json, F.lit(r"[\[{]"), F.lit(0))) + 1, F.lit(DEEPEST))
    start = F.struct(F.array("v").cast("array<variant>").alias("level"), F.array().cast(f"array<{item}>").alias("found"))
    parsed = docs.select(F.col(key), F.try_parse_json(F.col(json)).alias("v"), levels.alias("levels")).where("v is not null")
    found = F.aggregate(F.sequence(F.lit(1), F.col("levels")), start, descend, lambda acc: acc["found"])
    return parsed.select(key, F.inline(found)).unionByName(_scanned(docs, key, json).where("error is null").drop("error"))


def classify(source: Column) -> Column:
    """kind, declared and privacy_marker of a project from its declaration (null: unknown)."""
    text = F.coalesce(source, F.lit(""))
    declared = F.coalesce(*[F.when(F.contains(text, F.lit(f"type: '{d}'")), d) for d in DECLARED])
    privacy = F.contains(text, F.lit("ProjectPrivacyToken")) | F.contains(F.substring_index(F.lower(text), "import", 1), F.lit("privacy"))
    kind = (
        F.when(privacy | (declared == DECLARED[0]), "privacy").when(F.contains(text, F.lit("ScalingProject")), "scaling_l2").when(declared.isin(*DECLARED[1:]), "bridge").otherwise("unknown")
    )
    return F.struct(kind.alias("kind"), declared.alias("declared"), privacy.alias("privacy_marker"))


def registry(docs: DataFrame, commit: str, repo: str, fetched_at: str) -> DataFrame:
    """All escrows of docs (path, project, body, declaration, ord) at the grain (bridge, escrow, chain)."""
    rows = walk(docs).join(docs.select("path", "project", "ord", classify(F.col("declaration")).alias("c")), "path")
    out = rows.select(
        F.col("project").alias("bridge"), F.col("c.kind").alias("project_kind"), F.col("c.declared").alias("project_declared_type"), F.lower("escrow_address").alias("escrow_address"),
        F.col("escrow_address").alias("escrow_address_raw"), "chain", F.nullif(F.lower("token_address"), F.lit("")).alias("token_address"), F.lit(repo).alias("source_repo"),
        F.lit(commit).alias("source_commit"), F.col("path").alias("source_path"), F.lit(fetched_at).alias("fetched_at_utc"), "ord",
    )
    return first_wins(out, ["bridge", "escrow_address", "chain"], ["ord", "escrow_address_raw", "token_address"]).drop("ord")


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bridges, and what is kept apart: privacy and unknown projects."""
    return rows.where("project_kind in ('scaling_l2', 'bridge')"), rows.where("project_kind in ('privacy', 'unknown')")


def gates() -> list[Gate]:
    return [Gate("addresses", F.count_distinct("escrow_address", F.coalesce("chain", F.lit(""))), BRIDGE_ADDRESSES, 4), Gate("bridges", F.count_distinct("bridge"), BRIDGES, 4)]
