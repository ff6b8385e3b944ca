"""What a raw record must pass before it is merged, and its alignment with the schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.address import TOKEN, is_case_destroyed, storage_key
from ..functions.chains import is_canonical_chain, store_chain, strip
from ..functions.dates import ISO_DAY
from ..schema import CATEGORIES, LABEL, LABEL_LENGTHS, LENGTHS, LICENCE_STATES

REASONS = ("no_address", "bad_address", "unknown_chain", "case_destroyed", "synthetic")


def kept_labels(labels: Column, address: Column) -> Column:
    """Labels with their chain in the store's spelling; those on a chain outside it go, those without one stay."""
    spelt = F.transform(labels, lambda x: x.withField("chain", F.when(x["chain"].isNotNull(), store_chain(x["chain"], address))))
    return F.filter(spelt, lambda x: x["chain"].isNull() | is_canonical_chain(x["chain"]))


def screen(raw: DataFrame) -> DataFrame:
    """raw with chain, labels and key in the store's form, dropped_labels, and reject_reason (null: accepted).

    The reasons come in the order of REASONS: the first that holds is given."""
    at = F.col("address")
    chain = store_chain(F.col("chain"), at)
    labels = kept_labels(F.coalesce(F.col("labels"), F.array().cast(f"array<{LABEL}>")), at)
    placed = raw.withColumns({"__chain": chain, "__labels": labels}).withColumn("key", storage_key(at, F.col("__chain")))
    reason = (
        F.when(F.coalesce(at, F.lit("")) == "", "no_address")
        .when(~strip(at).rlike(TOKEN), "bad_address")
        .when(~is_canonical_chain(F.col("__chain")), "unknown_chain")
        .when(is_case_destroyed(F.col("key"), F.col("__chain")), "case_destroyed")
        .when(F.contains("key", F.lit("::")), "synthetic")
    )
    dropped = F.coalesce(F.size("labels"), F.lit(0)) - F.size("__labels")
    out = placed.withColumns({"reject_reason": reason, "dropped_labels": F.greatest(dropped, F.lit(0))})
    return out.withColumns({"chain": F.col("__chain"), "labels": F.when(F.col("labels").isNotNull(), F.col("__labels"))}).drop("__chain", "__labels")


def reject_counts(screened: DataFrame, by: str) -> DataFrame:
    """Records of each source by reason, with up to five examples of each."""
    return (
        screened.where("reject_reason is not null")
        .groupBy(by, "reject_reason")
        .agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_set(F.substring("address", 1, 60))), 1, 5).alias("examples"))
    )


def align(records: DataFrame) -> DataFrame:
    """Incoming records with values outside the vocabularies moved to extras, dates cut to their day or
    nulled, and one boolean for each kind of change: category_stashed, license_status_stashed,
    date_truncated, date_invalid_nulled."""
    category, status, date = F.col("category"), F.col("license_status"), F.col("source_date")
    day = F.substring(strip(date), 1, 10)
    bad = lambda c, allowed: F.coalesce(~c.isin(*allowed), F.lit(False))
    stash = {
        "category_stashed": bad(category, CATEGORIES),
        "license_status_stashed": bad(status, LICENCE_STATES),
        "date_truncated": F.coalesce((F.char_length(strip(date)) > 10) & day.rlike(ISO_DAY), F.lit(False)),
    }
    stash["date_invalid_nulled"] = F.coalesce(~strip(date).rlike(ISO_DAY), F.lit(False)) & ~stash["date_truncated"]
    marked = records.withColumns(stash)
    dated = F.col("date_truncated") | F.col("date_invalid_nulled")
    extra = F.map_from_entries(
        F.filter(
            F.array(
                F.struct(F.lit("_category_raw").alias("k"), F.when(F.col("category_stashed"), category).alias("v")),
                F.struct(F.lit("_license_status_raw").alias("k"), F.when(F.col("license_status_stashed"), status).alias("v")),
                F.struct(F.lit("_source_date_raw").alias("k"), F.when(dated, date).alias("v")),
            ),
            lambda e: e["v"].isNotNull(),
        )
    )
    old = F.map_filter(F.coalesce("extras", F.create_map().cast("map<string,string>")), lambda k, v: ~F.map_contains_key(extra, k))
    return marked.withColumns(
        {
            "extras": F.map_concat(old, extra),
            "category": F.when(~F.col("category_stashed"), category),
            "license_status": F.when(~F.col("license_status_stashed"), status),
            "source_date": F.when(F.col("date_truncated"), day).when(~F.col("date_invalid_nulled"), date),
        }
    )


def is_valid(label_field: str = "labels") -> Column:
    """Whether a record of the store fits the schema's lengths and vocabularies."""
    within = lambda c, n: c.isNull() | (F.char_length(c) <= n)
    tests = [within(F.col(f), n) for f, n in LENGTHS.items()]
    tests += [F.coalesce(F.char_length("address") >= 1, F.lit(False)), F.col("chain").isNotNull()]
    tests += [F.col("category").isNull() | F.col("category").isin(*CATEGORIES), F.col("license_status").isNull() | F.col("license_status").isin(*LICENCE_STATES)]
    tests.append(F.col("source_date").isNull() | F.col("source_date").rlike(ISO_DAY))
    fits = lambda x: ~F.exists(F.array(*[x[f].isNull() | (F.char_length(x[f]) > n) for f, n in LABEL_LENGTHS.items()]), lambda b: b)
    tests.append(F.forall(F.coalesce(F.col(label_field), F.array().cast(f"array<{LABEL}>")), fits))
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out
