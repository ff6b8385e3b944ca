"""Personal data: plain patterns, and a span classifier trained by weak supervision.

Base kinds: `email`, `ip` (parts at most 255), `card` (16 to 19 digits passing Luhn) and `phone`
(8 to 15 digits). Beyond them the method looks at candidates: every two neighbours in runs of
capitalised words (`person`) and runs of seven or more digits (`number`). Four labelers vote 1
(personal), -1 (not) or 0 (abstain) on every candidate and base span: the shape as a regex, gazetteers
(a parameter), words of the context before it, and its structure. Expectation-maximisation over the
counts of vote patterns of all documents estimates how reliable each labeler is, and gives each
pattern a probability.

The final classifier sees the text, not the votes: hashed features of a span's shape, words, endings,
length and the words before it. It is a logistic regression whose targets are the probabilities that
EM gives; it is fitted on at most SAMPLE candidates, those with the smallest hashes of key and place. So it also finds names that no gazetteer holds, by what stands around them. Base spans stay; a
candidate that overlaps one is dropped, and of overlapping candidates the likeliest stays.

Votes, features, counts and scores are DataFrame functions. The first pass writes spans, votes and
features (without texts) to the shared folder; what reaches the driver is one row for each kind and
vote pattern, at most 6 x 81, and the sample of candidates.

Cases: null and empty texts have no spans. Very long texts are taken whole. Repeated rows are judged
each for itself. Without any candidate, nothing is added. Columns other than the key are not kept.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as S
from .common import durable

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|\z)){4}"
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora")
PERSON = rf"(?<![\p{{L}}\p{{N}}])(?:(?:{'|'.join(TITLES)})\.?\x20)?\p{{Lu}}\p{{Ll}}++(?![\p{{L}}\p{{N}}])(?:\x20\p{{Lu}}\p{{Ll}}++(?![\p{{L}}\p{{N}}]))++"
NUMBER = r"(?<![0-9A-Za-z])[0-9](?:[\x20./-]?[0-9]){6,}+(?![A-Za-z0-9])"
KINDS = ("email", "ip", "card", "phone", "person", "number")
LABELERS = ("shape", "gazetteer", "context", "structure")
BUCKETS, SAMPLE, EPOCHS, LIMIT = 4096, 20_000, 12, 0.5
#: The gazetteers used where a caller gives none.
GIVEN = (
    "James Mary John Patricia Robert Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica Thomas Sarah Charles Karen "
    "Christopher Nancy Daniel Lisa Matthew Betty Anthony Margaret Mark Sandra Donald Ashley Steven Kimberly Paul Emily Andrew Donna Joshua Michelle "
    "Kenneth Carol Kevin Amanda Brian Melissa George Deborah Edward Stephanie Ronald Rebecca Timothy Sharon Jason Laura Jeffrey Cynthia Ryan Kathleen "
    "Peter Anna Hans Ursula Klaus Monika Wolfgang Petra Jürgen Sabine Stefan Andrea Uwe Claudia Dieter Susanne Bernd Birgit Heinz Helga Werner Ingrid "
    "Jean Marie Pierre Nathalie Michel Isabelle Philippe Sylvie Alain Catherine Patrick Martine Nicolas Christine Christophe Françoise Laurent Valérie "
    "José Jose Carmen Antonio Maria María Manuel Ana Juan Isabel Francisco Dolores Javier Pilar Carlos Teresa Miguel Rosa Luis Cristina Jesus Marta "
    "Lucas Emma Julia Sofia Leon Lena Felix Clara Louis Chloé Hugo Alice Pablo Lucia Diego Elena Noah Olivia Liam Mia Ethan Ava Oliver Amelia"
).split()
SURNAMES = (
    "Smith Johnson Williams Brown Jones Davis Miller Wilson Moore Taylor Anderson Thomas Jackson White Harris Martin Thompson Robinson Clark Lewis Lee "
    "Walker Hall Allen Young King Wright Hill Scott Green Adams Baker Nelson Carter Mitchell Roberts Turner Phillips Campbell Parker Evans Edwards Collins "
    "Müller Schmidt Schneider Fischer Weber Meyer Wagner Becker Schulz Hoffmann Schäfer Koch Bauer Richter Klein Wolf Schröder Neumann Schwarz Zimmermann "
    "Bernard Dubois Durand Leroy Moreau Laurent Lefebvre Michel Garcia Bertrand Roux Fournier Girard Bonnet Dupont Lambert Fontaine Rousseau Vincent "
    "García González Rodríguez Fernández López Martínez Sánchez Pérez Gómez Martín Jiménez Ruiz Hernández Díaz Moreno Álvarez Romero Alonso Navarro Torres"
).split()
NOT_NAMES = (
    "January February March April May June July August September October November December Monday Tuesday Wednesday Thursday Friday Saturday Sunday North "
    "South East West New Old The And Der Die Das Les Des Los Las United States Kingdom University Street Avenue Road City County Company Inc Ltd Bank Chapter "
    "Section Figure Table Contact Call Dear Please See Montag Dienstag Mittwoch Donnerstag Freitag Samstag Sonntag Lundi Mardi Mercredi Jeudi Vendredi Lunes Martes"
).split()
DOMAINS = "com org net edu gov io info fr de es it uk eu us ca au nl ch at be se no dk fi pl pt br mx jp cn in ru kr za nz ie co me dev app".split()
ABOUT = r"\b(?:call|phone|tel|telephone|mobile|fax|contact|mail|e-mail|email|write|name|mr|mrs|ms|dr|ssn|passport|born|card|visa|address|dear|signed|from|telefon|anruf|frau|herr|madame|monsieur|courriel|correo|llame)\b"
NOT_ABOUT = r"\b(?:version|page|pages|order|isbn|issn|chapter|section|figure|table|build|commit|seite|kapitel|figura|tabla)\b"


@dataclass(frozen=True)
class Gazetteers:
    """Word lists of the gazetteer labeler: broadcastable literals, so of bounded size."""

    given: tuple[str, ...] = tuple(GIVEN)
    surnames: tuple[str, ...] = tuple(SURNAMES)
    not_names: tuple[str, ...] = tuple(NOT_NAMES)
    domains: tuple[str, ...] = tuple(DOMAINS)


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return (out if no is None else out.when(no, -1)).otherwise(0).cast("int")


def _votes(s: Column, lists: Gazetteers) -> Column:
    """The votes on one span, in the order of LABELERS."""
    kind, value = s["kind"], s["value"]
    words = F.split(value, " ")
    surname = F.get(words, F.size(words) - 1)
    given = F.get(words, F.size(words) - 2)
    digits = S.digits(value)
    n = F.char_length(digits)
    before = F.lower(s["before"])
    same = digits.rlike(r"^(.)\1*\z")
    shape = (
        F.when(kind == "person", _vote(F.size(words) > 2))
        .when(kind == "number", _vote(value.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}\z|^[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}\z"), value.rlike(r"^[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}") | same | value.rlike(r"^[0-9]++\z")))
        .otherwise(F.lit(1))
    )
    gazetteer = (
        F.when(kind == "person", _vote(given.isin(*lists.given) | (surname.isin(*lists.surnames) & ~given.isin(*lists.not_names)), given.isin(*lists.not_names) | surname.isin(*lists.not_names)))
        .when(kind == "email", _vote(F.substring_index(value, ".", -1).isin(*lists.domains)))
        .when(kind == "ip", _vote(F.lit(False), value.rlike(r"^(?:0|127|255)\.")))
        .when(kind == "card", _vote(digits.rlike("^[3-6]"), ~digits.rlike("^[3-6]")))
        .when(kind == "phone", _vote(value.rlike(r"^\+(?:1|33|34|44|49)[^0-9]")))
        .otherwise(F.lit(0))
    )
    structure = (
        F.when(kind == "person", _vote(F.lit(False), given == surname))
        .when(kind == "number", _vote(F.lit(False), (n > 15) | (n < 9)))
        .when(kind == "email", _vote(F.char_length(value) <= 254, F.char_length(value) > 254))
        .when(kind.isin("card", "phone"), _vote(~same, same))
        .otherwise(F.lit(1))
    )
    context = _vote(before.rlike(ABOUT), before.rlike(NOT_ABOUT))
    return F.array(shape, gazetteer, context, structure)


def _features(s: Column) -> Column:
    """Buckets of what the classifier sees of a span: its text and the words before it."""
    words = F.split(s["value"], " ")
    first, last = F.get(words, F.lit(0)), F.get(words, F.size(words) - 1)
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(s["value"], r"\p{Lu}", "A"), r"\p{Ll}+", "a"), "[0-9]", "9")
    before = F.split(F.trim(F.lower(F.regexp_replace(s["before"], r"[^\p{L}\p{N}]+", " "))), " ")
    one, two = F.get(before, F.size(before) - 1), F.get(before, F.size(before) - 2)
    near = F.right(s["before"], F.lit(2))
    person = [F.concat(F.lit("given "), F.get(words, F.size(words) - 2)), F.concat(F.lit("last "), last), F.concat(F.lit("end "), F.right(last, F.lit(3))), F.concat(F.lit("begin "), F.left(first, F.lit(3)))]
    number = [F.concat(F.lit("digits "), F.char_length(S.digits(s["value"]))), F.concat(F.lit("start "), F.left(s["value"], F.lit(2)))]
    both = [F.lit(""), F.concat(F.lit("shape "), F.left(shape, F.lit(24))), F.concat(F.lit("one "), one), F.concat(F.lit("two "), two, one), F.concat(F.lit("near "), near)]
    names = F.array_compact(F.concat(F.array(*both), F.when(s["kind"] == "person", F.array(*person)).otherwise(F.array(*number))))
    return F.array_distinct(F.transform(names, lambda x: F.pmod(F.xxhash64(s["kind"], x), F.lit(BUCKETS)).cast("int")))


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", lists: Gazetteers = Gazetteers()) -> DataFrame:  # noqa: B008
    """key, base spans by kind, and `judged`: every base span and candidate with its votes, and candidates with their features."""
    whole = F.coalesce(F.col("__text"), F.lit(""))
    found = docs.select(F.col(key), F.col(text).alias("__text")).select(
        "*",
        S.matches(whole, EMAIL, F.contains(whole, F.lit("@"))).alias("__email"),
        S.matches(whole, IP).alias("__ip"),
        S.matches(whole, CARD).alias("__card"),
        S.matches(whole, PHONE, F.contains(whole, F.lit("+"))).alias("__phone"),
        S.matches(whole, PERSON).alias("__person"),
        S.matches(whole, NUMBER).alias("__number"),
    )
    spans = lambda pattern, kind: S.spans(whole, pattern, F.col(f"__{kind}"), KINDS.index(kind), kind)
    n = lambda s: F.char_length(S.digits(s["value"]))
    base = F.concat(
        spans(EMAIL, "email"),
        F.filter(spans(IP, "ip"), lambda s: s["value"].rlike(IP_PARTS)),
        F.filter(spans(CARD, "card"), lambda s: F.when(n(s).between(16, 19), S.luhn(S.digits(s["value"]))).otherwise(False)),
        F.filter(spans(PHONE, "phone"), lambda s: n(s).between(8, 15)),
    )
    placed = found.select(key, S.by_kind(base).alias("base"), F.concat(S.pairs_of_words(spans(PERSON, "person"), TITLES), spans(NUMBER, "number")).alias("__more"))
    shared = placed.select(key, "base", S.clear_of(F.col("__more"), F.col("base")).alias("__more"))
    voted = lambda s: F.struct(s.alias("span"), _votes(s, lists).alias("votes"), F.when(s["rank"] >= 4, _features(s)).alias("features"))
    return shared.select(key, "base", F.transform(F.concat("base", "__more"), voted).alias("judged"))


def estimate(counts: list[tuple[str, tuple[int, ...], int]], rounds: int = 30) -> dict[tuple, float]:
    """EM for (kind, votes, n): the probability that spans of that pattern are personal data. Each
    labeler has a distribution of votes for personal and for other spans, each kind a prior."""
    post = {(k, v): min(0.95, max(0.05, 0.35 + 0.3 * sum(v))) for k, v, _ in counts}
    for _ in range(rounds):
        like = {y: [defaultdict(lambda: 1.0) for _ in LABELERS] for y in (0, 1)}
        prior: dict = defaultdict(lambda: [1.0, 1.0])
        for k, v, n in counts:
            for y, p in ((1, post[k, v]), (0, 1 - post[k, v])):
                prior[k][y] += n * p
                for j, vote in enumerate(v):
                    like[y][j][vote] += n * p
        for k, v, _ in counts:
            log = [0.0, 0.0]
            for y in (0, 1):
                log[y] = math.log(prior[k][y] / sum(prior[k]))
                for j, vote in enumerate(v):
                    log[y] += math.log(like[y][j][vote] / (sum(like[y][j][x] for x in (-1, 0, 1))))
            post[k, v] = 1 / (1 + math.exp(max(-50.0, min(50.0, log[0] - log[1]))))
    return post


def fit(sample: list[tuple[list[int], float]], epochs: int = EPOCHS) -> list[float]:
    """Weights of the span classifier: logistic regression on (features, probability), by adaptive steps."""
    w, seen = [0.0] * BUCKETS, [1.0] * BUCKETS
    for _ in range(epochs):
        for own, target in sample:
            gap = target - 1 / (1 + math.exp(-max(-50.0, min(50.0, sum(w[f] for f in own)))))
            for f in own:
                seen[f] += gap * gap
                w[f] += 0.5 * gap / math.sqrt(seen[f]) - 1e-4 * w[f]
    return w


def probability(features: Column, w: list[float]) -> Column:
    """The classifier's score of a span by its features, as an expression."""
    values = F.split(F.lit(",".join(str(round(x, 5)) for x in w)), ",").cast("array<double>")
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.aggregate(features, F.lit(0.0), lambda a, f: a + F.get(values, f))))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: float = LIMIT, lists: Gazetteers = Gazetteers()) -> DataFrame:  # noqa: B008
    """key, `base` and `added`: arrays of spans (at, rank, till, kind, value, before) ordered by kind and start."""
    found = durable(candidates(docs, key, text, lists), "pii")
    each = found.select(F.explode("judged").alias("x")).groupBy(F.col("x.span.kind").alias("kind"), F.col("x.votes").alias("votes")).count()
    counts = sorted((r.kind, tuple(r.votes), r["count"]) for r in each.collect())
    post = estimate(counts)
    total = sum(n for kind, _, n in counts if KINDS.index(kind) >= 4)
    more = found.select(F.xxhash64(key).alias("order"), F.explode(F.filter("judged", lambda x: x["features"].isNotNull())).alias("x"))
    drawn = more.select(F.xxhash64("order", "x.span.at", "x.span.kind").alias("order"), F.col("x.span.kind").alias("kind"), F.col("x.votes").alias("votes"), F.col("x.features").alias("features"))
    low = min(1 << 63, (1 << 63) * SAMPLE // max(1, total)) - (1 << 63) // 2  # a share of the hashes, from the smallest
    rows = drawn.where(F.shiftright("order", 1) < F.lit(low)).limit(2 * SAMPLE).collect()
    sample = [(r.features, post[r.kind, tuple(r.votes)]) for r in sorted(rows, key=lambda r: (r.order, r.kind, r.votes, r.features))[:SAMPLE]]
    w = fit(sample)
    scored = F.transform(F.filter("judged", lambda x: x["features"].isNotNull()), lambda x: F.struct(x["span"].alias("span"), probability(x["features"], w).alias("p")))
    likely = F.array_sort(F.filter(scored, lambda x: x["p"] > limit))
    return found.select(key, "base", likely.alias("__likely")).select(key, "base", S.by_kind(S.likeliest(F.col("__likely"))).alias("added"))
