"""Words, labels, limits and text formats that results depend on."""

# --- fixed values: topic filter -------------------------------------------------------------
TOPIC_WORDS = ("ai",)
TOPIC_PHRASES = (
    "artificial intelligence",
    "llm",
    "large language model",
    "machine learning",
    "neural network",
    "transformer",
    "gpt",
    "openai",
    "anthropic",
    "deepmind",
    "generative ai",
    "diffusion model",
)

# --- fixed values: record labels ------------------------------------------------------------
RAW_VERSION = "1.0"
OUTPUT_VERSION = "2.0"
PROMPT_VERSION = "2.0.0"
EVENT_TYPES = ("funding", "acquisition", "partnership", "contract", "restructuring", "other")
DEFAULT_EVENT_TYPE = "other"
DEFAULT_SUMMARY = "Analysis failed or content unavailable."
UNKNOWN_MODEL = "unknown"
UNKNOWN_TITLE = "Unknown Title"
UNKNOWN_SOURCE = "unknown"
SOURCE_RANKED = "hackernews"
SOURCE_FEED = "techcrunch"
ITEM_PAGE = "https://news.ycombinator.com/item?id="

# --- fixed values: limits -------------------------------------------------------------------
PROMPT_CHARS = 15_000
PREVIEW_CHARS = 500
SHORT_TITLE = 10
SHORT_TEXT = 500
RANKED_OVERFETCH = 2

# --- fixed values: comparison ---------------------------------------------------------------
VOLATILE_FIELDS = ("collected_at", "processing_timestamp", "metadata")
INGESTION_FIELDS = (
    "source",
    "url",
    "title",
    "content",
    "published_at",
    "raw_text_length",
    "raw_text_preview",
    "http_status",
)

# --- fixed values: page selectors (tag, class) ----------------------------------------------
TITLE_SELECTOR = ("h1", "article__title")
CONTENT_SELECTORS = (("div", "article-content"), ("div", "entry-content"))

# --- fixed values: URL schemes whose path may carry ";params" / whose rebuilt form has "//" ---
PARAM_SCHEMES = (
    "ftp hdl prospero http imap https shttp rtsp rtsps rtspu sip sips mms sftp tel"
).split()
AUTHORITY_SCHEMES = (
    "ftp http gopher nntp telnet imap wais file mms https shttp snews prospero rtsp rtsps rtspu "
    "rsync svn svn+ssh sftp nfs git git+ssh ws wss itms-services"
).split()

# --- fixed value: the analysis request ------------------------------------------------------
PROMPT_TEMPLATE = """
Analyze the following article for Capital Intelligence:

Title: {title}
Source: {source}
Date: {date}
Content:
{content}

Extract the required fields based on the schema.
"""
