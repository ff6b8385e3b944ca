"""Quality classifier: logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates and scored as sparse dot products.

Tokens are runs of word characters and runs of other visible characters; features are hashed single
tokens and pairs of neighbours, present or not, scaled to unit length beside a bias. Nothing but the text enters.

Training takes a bounded sample, the SAMPLE labelled documents whose ids have the smallest hashes, in
one task that reads at most so many rows of features; its result is a vector of 2**BITS weights
(1 MB), which is broadcast. Scoring is one pass over Arrow batches without a shuffle.

Cases: null and empty texts have no features and get the score of the bias. Labels that are null, or
of documents that don't exist, are not learned from; with no usable label, or only one kind, the
weights follow from what there is (0.5 for all without any). Repeated rows are scored each for itself.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import slices, trimmed

BITS, SAMPLE, EPOCHS = 18, 6000, 6
ALPHA, BETA, L1, L2 = 3.0, 1.0, 0.01, 0.0
THRESHOLD = 0.7
TOKEN = re.compile(r"\w+|[^\w\s]+")


def features(text: str | None) -> np.ndarray:
    """The bias (bucket 0), then the sorted distinct buckets of the text's single tokens, its pairs of
    neighbours, and one that says whether some token stands three times in a row."""
    digest = xxhash.xxh3_64_intdigest
    tokens = TOKEN.findall(text or "")
    one = np.fromiter((digest(t) for t in tokens), np.uint64, len(tokens))
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
    two ^= two >> np.uint64(29)
    found = [one, two]
    if ((one[:-2] == one[1:-1]) & (one[1:-1] == one[2:])).any():
        found.append(np.array([digest("\n")], np.uint64))
    buckets = np.unique(np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int32)
    return np.append(np.int32(0), buckets[buckets > 0])


def scales(n: int) -> tuple[float, float]:
    """The input of the bias, and of each of the n - 1 other features."""
    return 1.0, 1 / math.sqrt(max(1, n - 1))


def logit(weights: np.ndarray) -> float:
    """The dot product, of the weights of one text's features."""
    bias, x = scales(len(weights))
    return bias * float(weights[0]) + x * float(weights[1:].sum())


def fit(samples: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Weights by FTRL-proximal over the samples, in their order, EPOCHS times."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for found, label in samples:
            w, x = weights(found), np.full(len(found), scales(len(found))[1])
            x[0] = scales(len(found))[0]
            g = (1 / (1 + math.exp(-max(-35.0, min(35.0, logit(w))))) - label) * x
            sigma = (np.sqrt(n[found] + g * g) - np.sqrt(n[found])) / ALPHA
            z[found] += g - sigma * w
            n[found] += g * g
    return weights(np.arange(1 << BITS)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> np.ndarray:
    """Weights learned from at most `sample` of the labels, those whose keys have the smallest hashes."""
    chosen = (
        labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
        .where("__label in (0, 1) and __key is not null")
        .withColumn("__order", F.xxhash64("__key"))
        .orderBy("__order", "__key", "__label")
        .limit(sample)
    )

    def featurise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            yield pd.DataFrame({"at": x["__order"], "label": x["__label"], "found": [features(t).tobytes() for t in x["text"]]})

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        samples = [(np.frombuffer(f, np.int32), y) for x in frames for f, y in zip(x["found"], x["label"], strict=True)]
        yield pd.DataFrame({"weights": [fit(samples).tobytes()]})

    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("text")).join(F.broadcast(chosen), "__key").select("__order", "__label", "text").mapInPandas(featurise, "at long, label int, found binary")
    found = rows.repartition(1).sortWithinPartitions("at", "label", "found").mapInPandas(learn, "weights binary").collect()
    return np.frombuffer(found[0][0], np.float32) if found else np.zeros(1 << BITS, np.float32)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", column: str = "score") -> DataFrame:
    """docs with the probability of label 1 in `column` (an input column of that name is replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kept = docs.select(*[c for c in docs.columns if c != column])
    where = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in slices(batches):
            at = [logit(w[f]) for f in map(features, batch.column(where).to_pylist())]
            values = 1 / (1 + np.exp(-np.clip(np.array(at, np.float64), -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], names=[*batch.schema.names, column])

    return kept.mapInArrow(trimmed(run), StructType([*kept.schema.fields, StructField(column, DoubleType())]))
