"""Secret scan: plain patterns, and Markov models of random strings and ordinary identifiers.

Base kinds: `assign` (a name like password or api_key, a colon or equals sign, a value of 12 or more
characters), `access` (AKIA and capitals or digits, 18 or more characters), `hex` (16 or more).
The method adds kind `markov`. Each maximal run of 16 or more token characters is a candidate, or what
base spans leave of it. Its transitions get the log-likelihood ratio of two character Markov models,
one of random strings and one of ordinary identifiers. The stretch with the greatest sum of (ratio -
LIMIT) is taken, so a secret is found behind an identifier that is glued to it by =, / or _; it is
listed if the sum is MARGIN or more and the stretch has LEAST characters or more, KINDS different ones at least.

Both models are trained from labelled samples (`text`, `secret` 1 or 0), which a caller may pass;
samples() generates bounded ones. Training counts transitions with DataFrame functions; what reaches
the driver has one row for each label and pair of the 67 token characters. The table of log ratios
is a constant of the scoring expression, so scoring is one pass without a shuffle, a join or Python.

Cases: null and empty texts have no spans. Very long texts are taken whole. Repeated rows are
scanned each for itself. Other input columns are kept; those named like a result are replaced.
"""

from __future__ import annotations

import importlib
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import spans as S

ASSIGN = (
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]++"""
)
#: The value inside a match of ASSIGN.
VALUE = r"""[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)\z"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
CLASSES = (26, 52, 62, 67)  # ends of lower, upper, digit and symbol in ALPHABET
LIMIT, MARGIN, LEAST, KINDS, PRIOR = 0.2, 6.0, 14, 8, 0.05
RESULT = ("base", "added")
#: Ordinary identifiers come from the public names of these modules of the standard library, and from WORDS.
MODULES = (
    "argparse ast asyncio calendar collections csv datetime decimal email.message http.client inspect io json logging os pathlib socket "
    "sqlite3 ssl statistics string subprocess threading typing unittest urllib.parse uuid xml.dom.minidom zipfile"
).split()
WORDS = (
    "get set user name value index count list item data file path node tree map key table row column field type class object string number "
    "array buffer stream reader writer parser token handler manager service client server request response session config option default "
    "error message event listener callback thread process queue cache memory block page line text word char the and that with from this "
    "have which their would there about nicht und der die das auch haben werden dans pour avec nous vous cette para como entre sobre desde"
).split()
STYLES = ("camel", "snake", "kebab", "upper", "path", "joined")
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (LETTERS, LETTERS + "0123456789", ALPHABET[:62], ALPHABET[:62], ALPHABET[:64], LETTERS.upper() + "234567")


def identifiers() -> list[str]:
    """Public names of MODULES and of the classes in them, sorted."""
    found = set()
    for module in map(importlib.import_module, MODULES):
        for name in (x for x in dir(module) if not x.startswith("_")):
            own = getattr(module, name)
            found |= {name, *(x for x in dir(own) if isinstance(own, type) and not x.startswith("_"))}
    return sorted(x for x in found if x.isascii() and x.isidentifier())


def samples(spark: SparkSession, n: int = 16000) -> DataFrame:
    """n labelled strings, half of them random ones; they follow from their numbers. Ordinary ones are two
    to five names in some style, one in five with digits, and one in eight digits alone."""
    pick = lambda salt, k: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(k)).cast("int")
    rows = spark.range(n // 2).select("id", F.split(F.lit(" ".join(identifiers())), " ").alias("names"), F.split(F.lit(" ".join(WORDS)), " ").alias("words"))
    alphabet = F.element_at(F.array(*map(F.lit, ALPHABETS)), pick(1, len(ALPHABETS)) + 1)
    drawn = lambda of, salt: lambda j: F.substring(of, F.pmod(F.xxhash64("id", j, F.lit(salt)), F.char_length(of)).cast("int") + 1, F.lit(1))
    random = F.array_join(F.transform(F.sequence(F.lit(1), pick(2, 25) + 20), drawn(alphabet, 5)), "")
    digits = F.array_join(F.transform(F.sequence(F.lit(1), pick(6, 20) + 10), drawn(F.lit("0123456789"), 7)), "")
    word = lambda of, j: F.element_at(F.col(of), F.pmod(F.xxhash64("id", j), F.size(of)).cast("int") + 1)
    some = F.transform(F.sequence(F.lit(1), pick(3, 4) + 2), lambda j: F.when(F.pmod(F.xxhash64(j, "id"), F.lit(5)) < 3, word("names", j)).otherwise(word("words", j)))
    style = F.element_at(F.array(*map(F.lit, STYLES)), pick(4, len(STYLES)) + 1)
    joined = (
        F.when(style == "camel", F.array_join(F.transform("some", lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, F.lit(2), F.char_length(w)))), ""))
        .when(style == "snake", F.lower(F.array_join("some", "_")))
        .when(style == "kebab", F.lower(F.array_join("some", "-")))
        .when(style == "upper", F.upper(F.array_join("some", "_")))
        .when(style == "path", F.array_join("some", "/"))
        .otherwise(F.lower(F.array_join("some", "")))
    )
    dated = F.concat(F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), pick(8, 15000)), "yyyy-MM-dd"), F.lit("_"), "joined")
    way = pick(9, 40)
    plain = F.when(way < 5, digits).when(way < 11, F.concat("joined", F.left(digits, pick(10, 6) + 1))).when(way < 13, dated).otherwise(F.col("joined"))
    named = rows.withColumn("some", some).withColumn("joined", joined)
    return rows.select(random.alias("text"), F.lit(1).alias("secret")).unionByName(named.select(plain.alias("text"), F.lit(0).alias("secret")))


def _codes(token: Column) -> Column:
    """Places in ALPHABET, from 0; characters outside it are left out."""
    return F.filter(F.transform(F.split(token, ""), lambda c: F.when(c != "", F.instr(F.lit(ALPHABET), c) - 1).otherwise(-1)), lambda i: i >= 0)


def _steps(token: Column) -> Column:
    """The transitions of a token, as first * 67 + second."""
    codes = _codes(token)
    return F.zip_with(F.slice(codes, F.lit(1), F.greatest(F.size(codes) - 1, F.lit(0))), F.slice(codes, F.lit(2), F.greatest(F.size(codes) - 1, F.lit(0))), lambda a, b: (a * len(ALPHABET) + b).cast("int"))


def train(labelled: DataFrame) -> list[float]:
    """Log ratio of each transition: random model over identifier model. Counts are smoothed by the
    frequencies of transitions between classes of characters."""
    k = len(ALPHABET)
    counts = labelled.where("text is not null and secret in (0, 1)").select("secret", F.explode(_steps(F.col("text"))).alias("step")).groupBy("secret", "step").count().collect()
    kind = [next(c for c, end in enumerate(CLASSES) if i < end) for i in range(k)]
    width = [kind.count(c) for c in range(len(CLASSES))]
    logs = {}
    for secret in (0, 1):
        pair = [0.0] * (k * k)
        group = [[1.0] * len(CLASSES) for _ in CLASSES]
        for r in counts:
            if r.secret == secret:
                pair[r.step] += r["count"]
                group[kind[r.step // k]][kind[r.step % k]] += r["count"]
        for a in range(k):
            total = sum(pair[a * k : a * k + k])
            whole = sum(group[kind[a]])
            for b in range(k):
                broad = group[kind[a]][kind[b]] / whole / width[kind[b]]
                own = pair[a * k + b] / total if total else broad
                logs[secret, a * k + b] = math.log((1 - PRIOR) * own + PRIOR * broad)
    return [round(logs[1, i] - logs[0, i], 4) for i in range(k * k)]


def stretch(token: Column, table: list[float]) -> Column:
    """The stretch of a token (total, first character, end; the first from 0) whose transitions have the
    greatest sum of (log ratio - LIMIT); a total of 0 if there is none above."""
    values = F.split(F.lit(",".join(str(round(x - LIMIT, 4)) for x in table)), ",").cast("array<double>")
    state = lambda total, first, at, best, low, high: F.struct(*(x.alias(n) for x, n in zip((total, first, at, best, low, high), ("total", "first", "at", "best", "low", "high"), strict=True)))
    zero, none = F.lit(0), F.lit(0.0)

    def step(acc: Column, code: Column) -> Column:
        anew = acc["total"] <= 0
        total = F.when(anew, none).otherwise(acc["total"]) + F.get(values, code)
        first = F.when(anew, acc["at"]).otherwise(acc["first"])
        better = total > acc["best"]
        keep = lambda new, old: F.when(better, new).otherwise(old)
        return state(total, first, acc["at"] + 1, keep(total, acc["best"]), keep(first, acc["low"]), keep(acc["at"] + 2, acc["high"]))

    return F.aggregate(_steps(token), state(none, zero, zero, none, zero, zero), step)


def scan(docs: DataFrame, table: list[float], text: str = "text") -> DataFrame:
    """docs with `base` and `added`: arrays of spans (at, rank, till, kind, value) ordered by start."""
    kept = [F.col(c) for c in docs.columns if c not in RESULT]
    whole = F.coalesce(F.col("__text"), F.lit(""))
    found = docs.select(*kept, F.col(text).alias("__text")).select(
        "*",
        S.matches(whole, ASSIGN, whole.rlike("[:=]")).alias("__assign"),
        S.matches(whole, ACCESS, F.contains(whole, F.lit("AKIA"))).alias("__access"),
        S.matches(whole, HEX).alias("__hex"),
        S.matches(whole, CANDIDATE).alias("__candidate"),
    )
    assign = F.filter(S.spans(whole, ASSIGN, F.col("__assign"), 0, "assign"), lambda s: F.char_length(F.regexp_extract(s["value"], VALUE, 1)) >= 12)
    placed = found.select(
        *kept,
        S.by_start(F.concat(assign, S.spans(whole, ACCESS, F.col("__access"), 1, "access"), S.spans(whole, HEX, F.col("__hex"), 2, "hex"))).alias("base"),
        S.spans(whole, CANDIDATE, F.col("__candidate"), 3, "markov").alias("__spans"),
    )
    long_enough = F.filter(S.outside(F.col("__spans"), F.col("base")), lambda s: F.char_length(s["value"]) >= LEAST)
    scored = F.transform(long_enough, lambda s: F.struct(s.alias("span"), stretch(s["value"], table).alias("best")))
    good = F.filter(scored, lambda x: (x["best"]["best"] >= MARGIN) & (x["best"]["high"] - x["best"]["low"] >= LEAST))
    cut = F.transform(good, lambda x: S.part(x["span"], x["span"]["at"] + x["best"]["low"], x["span"]["at"] + x["best"]["high"]))
    added = F.filter(cut, lambda s: F.size(F.array_distinct(F.split(s["value"], ""))) >= KINDS)
    return placed.select("*", S.by_start(added).alias("added")).drop("__spans")
