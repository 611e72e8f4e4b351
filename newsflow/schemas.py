"""Record and table schemas."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "array<long>": T.ArrayType(T.LongType()),
}


def schema(fields: str) -> T.StructType:
    """Nullable fields from ``name type, name type``; needs no session."""
    pairs = (field.split() for field in fields.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


FEED_ENTRY = schema("feed_pos long, title string, link string, published string")
RANKED_IDS = schema("ids array<long>")
STORY_ITEM = schema(
    "id long, title string, url string, text string, time long, score long, descendants long, by string"
)
LANDED_PAGE = schema("url string, html string, http_status int")
ARTICLE = schema(
    "source string, title string, url string, published_at timestamp, content string, raw_metadata string"
)
RAW_RECORD = schema(
    "schema_version string, source string, title string, url string, published_at string, "
    "raw_text_length int, raw_text_preview string, http_status int, collected_at string"
)
ANALYSIS = schema(
    "company string, funding_amount string, funding_stage string, investors array<string>, "
    "summary string, investment_relevant boolean, event_type string"
)
RELEVANCE = schema("is_relevant boolean, reasoning string")
OUTPUT_RECORD = schema(
    "schema_version string, source string, title string, url string, published_at string, "
    "company string, funding_amount string, funding_stage string, investors array<string>, "
    "summary string, investment_relevant boolean, event_type string, model_used string, "
    "prompt_version string, processing_timestamp string, article_hash string, metadata string, "
    "collected_at string"
)
SEEN_KEYS = schema("canonical_key string")
SEEN_FILE = schema("hashes array<string>")
ARTICLES = schema(
    "id long, canonical_key string, source string, title string, url string, published_at string, "
    "company string, funding_amount string, funding_stage string, investors array<string>, "
    "investment_relevant boolean, event_type string, summary string, inserted_at string, raw_data string"
)
RUN_EVENTS = schema(
    "run_id string, source string, event_ts timestamp, status string, items_processed long, errors long"
)
RUNS = schema(
    "run_id string, source string, started_at string, completed_at string, status string, "
    "items_processed long, errors long"
)
