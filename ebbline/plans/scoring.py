"""Batch scoring: validation with a message per row, features, forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.series import SHAPE_FEATURES, STATIC_FEATURES, base_log, shape_features
from ebbline.functions.text import comma_items, scoring_norm, strict_number, to_int
from ebbline.plans.boosting import QuantileModel, column_name, predict
from ebbline.plans.panel import TAG_FIELDS
from ebbline.schemas import PREDICT_REQUIRED

# The error texts, and the spellings of a missing value.
NOT_POSITIVE = "All avg/peak values must be > 0."
MISSING_COLUMN = "Missing column: "
MISSING_VALUE = "Missing value: "
NOT_A_NUMBER = "could not convert string to float: '"
NOT_AN_INTEGER = "invalid literal for int() with base 10: '"
MISSING_WORDS = ("", "nan", "null", "none", "na", "n/a")

MEASURES = ("avg_m1", "avg_m2", "avg_m3", "peak_m1", "peak_m2", "peak_m3")


def _text(rows: DataFrame, name: str) -> Column:
    """The column as text, NULL where it is absent or spells a missing value."""
    if name not in rows.columns:
        return F.lit(None).cast("string")
    value = F.col(name).cast("string")
    return F.when(~F.lower(F.trim(value)).isin(*MISSING_WORDS), value)


def _quoted(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value, F.lit("'"))


def _flag(rows: DataFrame) -> Column:
    text = F.lower(F.trim(_text(rows, "is_free")))
    whole = to_int(F.regexp_replace(text, r"\.0+$", ""))
    return F.when(text == "true", 1).when(text == "false", 0).otherwise(whole)


def _with_numbers(rows: DataFrame) -> DataFrame:
    """Each number parsed once, as ``_n_<name>``; the formulas then read plain columns."""
    names = (*MEASURES, "price_usd", "age_months", "age_since_release_months")
    numbers = {f"_n_{name}": strict_number(_text(rows, name)) for name in names}
    return rows.withColumns(numbers | {"_n_is_free": _flag(rows)})


def validate(rows: DataFrame) -> DataFrame:
    """Add ``row_error``: empty for a usable row, else the first thing wrong with it. No row is lost."""
    error = F
    for name in PREDICT_REQUIRED:
        if name not in rows.columns:
            error = error.when(F.lit(True), MISSING_COLUMN + name)
    for name in MEASURES:
        raw = _text(rows, name)
        error = error.when(raw.isNull(), MISSING_VALUE + name)
        error = error.when(F.col(f"_n_{name}").isNull(), _quoted(NOT_A_NUMBER, raw))
    least = F.least(*[F.col(f"_n_{name}") for name in MEASURES])
    error = error.when(least <= 0, NOT_POSITIVE)
    flag, price = _text(rows, "is_free"), _text(rows, "price_usd")
    error = error.when(flag.isNull(), MISSING_VALUE + "is_free")
    error = error.when(F.col("_n_is_free").isNull(), _quoted(NOT_AN_INTEGER, flag))
    error = error.when(price.isNotNull() & F.col("_n_price_usd").isNull(), _quoted(NOT_A_NUMBER, price))
    return _with_numbers(rows).select(*rows.columns, error.otherwise("").alias("row_error"))


def match_tags(items: Column, vocabulary: list[str]) -> Column:
    """Vocabulary tags meant by free-text items, by their scoring key; the first tag of a key wins.

    The vocabulary has at most the top-k sizes, so the lookup is a literal map.
    """
    if not vocabulary:
        return F.array().cast("array<string>")
    keys = F.array(*[scoring_norm(F.lit(tag)) for tag in vocabulary])
    tags = F.array(*[F.lit(tag) for tag in vocabulary])

    wanted = F.filter(F.transform(items, scoring_norm), lambda x: x != "")
    places = F.filter(F.transform(wanted, lambda x: F.array_position(keys, x)), lambda at: at > 0)
    return F.array_distinct(F.transform(places, lambda at: F.get(tags, (at - 1).cast("int"))))


def feature_rows(validated: DataFrame, vocabulary: dict[str, list[str]]) -> DataFrame:
    """Feature columns beside the input ones, NULL where the row has an error.

    Month 1 is the oldest of the three. The formulas are the panel's own.
    """
    ok = F.col("row_error") == ""
    numbers = _with_numbers(validated)
    numbers = numbers.withColumns({c: F.when(ok, F.col(c)) for c in numbers.columns if c.startswith("_n_")})
    shape = shape_features(
        tuple(F.col(f"_n_avg_m{i}") for i in (1, 2, 3)), tuple(F.col(f"_n_peak_m{i}") for i in (1, 2, 3))
    )
    columns = {name: shape[name] for name in SHAPE_FEATURES}
    for name in STATIC_FEATURES:
        columns[name] = F.col(f"_n_{name}")
    for kind, field in TAG_FIELDS.items():
        tags = match_tags(comma_items(_text(validated, field)), vocabulary.get(kind, []))
        columns[field] = F.when(ok, tags)
    return numbers.select(*validated.columns, *[c.alias(f"f_{name}") for name, c in columns.items()])


def align(features: DataFrame, names: list[str]) -> DataFrame:
    """Exactly the model's feature columns, in its order; absent ones are NULL, others are dropped."""
    have = set(features.columns)
    return features.select(*[(F.col(n) if n in have else F.lit(None).cast("double")).alias(n) for n in names])


def back_transform(avg_k: Column, delta: Column) -> Column:
    return F.exp(base_log(avg_k) + delta)


def score(rows: DataFrame, model: QuantileModel) -> DataFrame:
    """Input columns, ``pred_p10/p50/p90_players`` and ``row_error``; rows with an error have no forecast."""
    checked = validate(rows)
    features = feature_rows(checked, model.vocabulary)
    originals = F.struct(*[F.col(c) for c in checked.columns]).alias("_row")
    names = [c for c in features.columns if c.startswith("f_")]
    bare = features.select(originals, *[F.col(c).alias(c[2:]) for c in names])
    missing = {c: F.lit(None).cast("double") for c in model.features if c not in bare.columns}
    predicted = predict(bare.withColumns(missing) if missing else bare, model)
    forecasts = []
    for q in sorted(model.trees):
        value = back_transform(F.col("avg_k"), F.col(column_name(q)))
        forecasts.append(F.when(F.col("_row.row_error") == "", value).alias(f"pred_p{round(q * 100):02d}_players"))
    inputs = [F.col(f"_row.`{c}`") for c in rows.columns]
    return predicted.select(*inputs, *forecasts, F.col("_row.row_error").alias("row_error"))
