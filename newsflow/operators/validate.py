"""Record validation: a list of broken rules per row instead of an exception."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.constants import EVENT_TYPES, OUTPUT_VERSION, RAW_VERSION
from newsflow.functions.urls import is_http_url

ARTICLE_REQUIRED = ("source", "title", "url", "content")
RAW_REQUIRED = ("source", "title", "url", "raw_text_length", "raw_text_preview", "http_status", "collected_at")
OUTPUT_REQUIRED = (
    "source",
    "title",
    "url",
    "summary",
    "investment_relevant",
    "event_type",
    "model_used",
    "prompt_version",
    "processing_timestamp",
    "article_hash",
    "investors",
    "metadata",
    "collected_at",
)
MUST_EXIST = ("published_at",)  # may be null, but the field has to be there


def required_rules(df: DataFrame, names: tuple[str, ...]) -> dict[str, Column]:
    """Rule per required field, true where it is broken; a field that is not there breaks every row."""
    return {n: F.col(n).isNull() if n in df.columns else F.lit(True) for n in names}


def _or(rules: dict[str, Column], name: str, bad: Column) -> None:
    rules[name] = rules[name] | F.coalesce(bad, F.lit(True))


def article_rules(df: DataFrame) -> dict[str, Column]:
    return required_rules(df, ARTICLE_REQUIRED)


def _version_rule(df: DataFrame, version: str) -> dict[str, Column]:
    present = "schema_version" in df.columns
    return {"schema_version": F.coalesce(F.col("schema_version") != version, F.lit(True))} if present else {}


def raw_rules(df: DataFrame) -> dict[str, Column]:
    rules = {**_version_rule(df, RAW_VERSION), **required_rules(df, RAW_REQUIRED)}
    return rules | {n: F.lit(n not in df.columns) for n in MUST_EXIST}


def output_rules(df: DataFrame) -> dict[str, Column]:
    rules = {**_version_rule(df, OUTPUT_VERSION), **required_rules(df, OUTPUT_REQUIRED)}
    if "url" in df.columns:
        _or(rules, "url", ~is_http_url(F.col("url")))
    if "event_type" in df.columns:
        _or(rules, "event_type", ~F.col("event_type").isin(*EVENT_TYPES))
    return rules | {n: F.lit(n not in df.columns) for n in MUST_EXIST}


def violations(rules: dict[str, Column]) -> Column:
    """Names of the broken rules, in rule order."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))


def validate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``violations array<string>``; empty means valid."""
    return df.withColumn("violations", violations(rules))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without, and quarantined rows with, their violations."""
    bad = F.size("violations") > 0
    return checked.where(~bad).drop("violations"), checked.where(bad)
