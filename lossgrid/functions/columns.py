"""Column expressions shared by the operators. All of them run inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def months_since(later: Column, earlier: Column) -> Column:
    """Calendar months from the month of ``earlier`` to the month of ``later``."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def age_years(event_date: Column, birth_date: Column) -> Column:
    """Completed years of age at the event."""
    return F.floor(F.months_between(event_date, birth_date) / 12)


def age_bucket(age: Column) -> Column:
    """Age band; NULL for an unknown or negative age."""
    return (
        F.when(age < 0, None)
        .when(age <= 20, "0_20")
        .when(age <= 35, "21_35")
        .when(age <= 50, "36_50")
        .when(age <= 60, "51_60")
        .when(age > 60, "60_plus")
    )


def outward_postcode(postcode: Column) -> Column:
    return F.split_part(postcode, F.lit(" "), F.lit(1))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL instead of an error when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def short_id(text: Column) -> Column:
    """First six characters of the url-safe base64 form of the SHA-256 digest."""
    digest = F.base64(F.unhex(F.sha2(text, 256)))
    return F.substring(F.translate(digest, "+/", "-_"), 1, 6)


def clean_name(text: Column) -> Column:
    """Name that a catalog takes: white space, brackets, slashes, dots, bars, control signs and dashes become ``_``, lower case."""
    return F.lower(F.regexp_replace(text, r"[.\s/()\[\]{}|\x00-\x1F\x7F-]", "_"))


def probability_map(value: Column, kind: str) -> Column:
    """Map of class to probability from a map, an array (classes by place) or text: JSON object, JSON list or one number.

    ``kind`` is the type name of ``value``. Text that cannot be read gives NULL.
    """
    def by_place(items: Column) -> Column:
        return F.map_from_entries(F.transform(items, lambda x, i: F.struct(i.cast("string").alias("key"), x.cast("double").alias("value"))))

    if kind.startswith("map"):
        return value.cast("map<string,double>")
    if kind.startswith("array"):
        return by_place(value)
    if kind != "string":
        return F.when(value.isNotNull(), F.create_map(F.lit("0"), value.cast("double")))
    text = F.trim(value)
    number = text.try_cast("double")
    return (
        F.when(text.startswith("{"), F.from_json(text, "map<string,double>"))
        .when(text.startswith("["), by_place(F.from_json(text, "array<double>")))
        .when(number.isNotNull(), F.create_map(F.lit("0"), number))
    )


def normalise_target(target: Column) -> Column:
    """Canonical label of a forecast target; unknown names are kept as they are."""
    name = F.regexp_replace(F.lower(F.trim(target)), "[^a-z0-9]+", "_")
    return (
        F.when(name.isin("burning_cost", "bc"), "BC")
        .when(name.isin("frequency_claim", "frequency_claims"), "Frequency_claims")
        .when(name.isin("severity_claim", "severity_claims"), "Severity_claims")
        .otherwise(target)
    )


def same_key(left: Column, right: Column) -> Column:
    """Null-safe equality, still planned as a hash key."""
    return left.eqNullSafe(right)
