"""Article analysis: prompt, batch analyzer, parsed results, output records with defaults."""

import datetime as dt
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.constants import (
    DEFAULT_EVENT_TYPE,
    DEFAULT_SUMMARY,
    EVENT_TYPES,
    OUTPUT_VERSION,
    PROMPT_CHARS,
    PROMPT_TEMPLATE,
    PROMPT_VERSION,
    UNKNOWN_MODEL,
)
from newsflow.functions.times import isoformat, run_time
from newsflow.operators.skew import HOT_ROWS, lookup_join
from newsflow.schemas import ANALYSIS, OUTPUT_RECORD

# --- fixed values: texts that stand for a boolean -----------------------------------------------
TRUE_TEXTS = ("true", "t", "yes", "y", "on", "1", "1.0")
FALSE_TEXTS = ("false", "f", "no", "n", "off", "0", "0.0")

Analyzer = Callable[[str], dict | str | None]


def article_hash(content: Column) -> Column:
    """Hex SHA-256 of the content."""
    return F.sha2(content, 256)


def build_prompt(title: Column, source: Column, date: Column, content: Column) -> Column:
    """Fill the request template; content is cut to its fixed limit, a missing date reads ``None``."""
    fields = {
        "title": title,
        "source": source,
        "date": F.coalesce(date, F.lit("None")),
        "content": F.substring(content, 1, PROMPT_CHARS),
    }
    parts, rest = [], PROMPT_TEMPLATE
    for name, value in fields.items():
        text, rest = rest.split("{" + name + "}", 1)
        parts += [F.lit(text), value]
    return F.concat(*parts, F.lit(rest))


def prompt_date(published_at: Column) -> Column:
    """Timestamp as the template prints it (a blank between date and time)."""
    return F.replace(isoformat(published_at), F.lit("T"), F.lit(" "))


def checked_analysis(a: Column) -> Column:
    """The struct if it is a valid analysis, else null; missing investors become an empty list."""
    valid = (
        a["summary"].isNotNull()
        & a["investment_relevant"].isNotNull()
        & F.coalesce(a["event_type"].isin(*EVENT_TYPES), F.lit(False))
    )
    fields = [
        F.coalesce(a[f.name], F.array().cast(f.dataType)).alias(f.name)
        if f.name == "investors"
        else a[f.name].alias(f.name)
        for f in ANALYSIS
    ]
    return F.when(valid, F.struct(*fields))


def _truth(value: Column) -> Column:
    """True or false from a JSON boolean, or from a text or number that means one; else null."""
    low = F.lower(value.try_cast("string"))
    return F.when(low.isin(*TRUE_TEXTS), True).when(low.isin(*FALSE_TEXTS), False)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` reads it, also inside conditions."""
    return F.transform(F.array(value), use)[0]


def parse_analysis(response: Column) -> Column:
    """JSON response to a checked analysis; malformed or incomplete text, or a field of another type, gives null.

    Texts must be JSON strings and investors a list of them; a null list counts as empty.
    """
    paths = {f.name: f"$.{f.name}" for f in ANALYSIS}

    def typed(values: Column) -> Column:
        strict, fields = F.lit(True), []
        for f in ANALYSIS:
            value = values[f.name]
            kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
            kept = F.try_variant_get(value, "$", f.dataType.simpleString())
            if f.name == "investment_relevant":
                kept = _truth(F.try_variant_get(value, "$", "string"))
            elif f.name == "investors":
                strict &= kind.isin("VOID", "ARRAY<VOID>", "ARRAY<STRING>")
                strict &= ~F.coalesce(F.exists(kept, lambda x: x.isNull()), F.lit(False))
            else:
                strict &= kind.isin("VOID", "STRING")
            fields.append(kept.alias(f.name))
        return F.when(strict, F.struct(*fields))

    def fields_of(found: Column) -> Column:
        return F.struct(*[F.try_variant_get(found, path, "variant").alias(name) for name, path in paths.items()])

    values = _once(F.try_parse_json(response), fields_of)
    return _once(_once(values, typed), checked_analysis)


def analyze(df: DataFrame, prompt: Column, analyzer_factory: Callable[[], Analyzer] | None) -> DataFrame:
    """Add ``analysis`` (struct or null) and ``analysis_error``.

    The factory runs once per task; its analyzer gets one prompt and returns a dict, JSON text or None.
    An exception becomes that row's error and leaves the run alone. Only prompts travel to Python and
    only response text comes back; the other columns stay in the JVM. Without a factory nothing is
    called. Call it after the dedupe and quota steps, which Spark cannot move below it.
    """
    if analyzer_factory is None:
        return df.withColumn("analysis", F.lit(None).cast(ANALYSIS)).withColumn(
            "analysis_error", F.lit(None).cast("string")
        )

    @F.pandas_udf("response string, error string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        analyzer = analyzer_factory()

        def one(text):
            try:
                answer = analyzer(text)
            except Exception as error:  # noqa: BLE001 - any failure belongs to the row
                return None, f"{type(error).__name__}: {error}"
            return (answer if answer is None or isinstance(answer, str) else json.dumps(answer)), None

        for prompts in batches:
            yield pd.DataFrame(map(one, prompts), columns=["response", "error"], dtype=object)

    called = df.withColumn("_call", call.asNondeterministic()(prompt))
    return (
        called.withColumn("analysis", parse_analysis(F.col("_call.response")))
        .withColumn("analysis_error", F.col("_call.error"))
        .drop("_call")
    )


def attach_analysis(
    df: DataFrame, results: DataFrame, spread="pos", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``analysis`` from stored results ``(article_hash, analysis)``, null where there is none."""
    return lookup_join(
        df, results.select("article_hash", "analysis"), "article_hash", spread, hot_rows=hot_rows
    )


def output_records(df: DataFrame, run_ts: dt.datetime, model_used: str = UNKNOWN_MODEL) -> DataFrame:
    """v2.0 records from articles with ``analysis``; defaults stand in only where it is missing."""
    a = F.col("analysis")
    has = a.isNotNull()
    now = isoformat(run_time(run_ts))
    values = {
        "schema_version": F.lit(OUTPUT_VERSION),
        "source": F.col("source"),
        "title": F.col("title"),
        "url": F.col("url"),
        "published_at": isoformat(F.col("published_at")),
        "company": a["company"],
        "funding_amount": a["funding_amount"],
        "funding_stage": a["funding_stage"],
        "investors": F.when(has, a["investors"]).otherwise(F.array().cast("array<string>")),
        "summary": F.when(has, a["summary"]).otherwise(DEFAULT_SUMMARY),
        "investment_relevant": F.when(has, a["investment_relevant"]).otherwise(False),
        "event_type": F.when(has, a["event_type"]).otherwise(DEFAULT_EVENT_TYPE),
        "model_used": F.lit(model_used),
        "prompt_version": F.lit(PROMPT_VERSION),
        "processing_timestamp": now,
        "article_hash": F.col("article_hash") if "article_hash" in df.columns else article_hash(F.col("content")),
        "metadata": F.coalesce(F.col("raw_metadata"), F.lit("{}")),
        "collected_at": now,
    }
    carried = [c for c in ("canonical_key", "pos") if c in df.columns]
    return df.select(*[values[f.name].alias(f.name) for f in OUTPUT_RECORD], *carried)
