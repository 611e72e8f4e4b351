"""Article extraction from landed pages.

Works on whole frames, not columns: each costly intermediate (the rest of the page after the opening
tag, the block) is a column of its own that several later ones read, and Spark does not merge such
projections, so every page is scanned once per pattern.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.constants import CONTENT_SELECTORS, TITLE_SELECTOR, UNKNOWN_TITLE
from newsflow.functions.text import block_tail, flat_block, meta_published, nested_block, nests, paragraphs, strip_join, visible_markup

Selector = tuple[str, str | None]


def with_first_block(df: DataFrame, page: str, out: str, selectors: tuple[Selector, ...]) -> DataFrame:
    """Add ``out``: inner HTML of the first element found, selectors tried in order; null if none is there.

    Elements of the same name inside it are counted, which costs an array of pieces, so only rows that
    do nest pay for it. An element that is never closed runs to the end of the page.
    """
    columns = df.columns
    block = F.lit(None).cast("string")
    taken = F.lit(False)
    for i, (tag, css_class) in enumerate(selectors):
        tail, flat = f"_tail{i}", f"_flat{i}"
        df = df.withColumn(tail, F.when(~taken, block_tail(F.col(page), tag, css_class)))
        here = F.coalesce(F.col(tail), F.lit("")) != ""
        df = df.withColumn(flat, F.when(here, flat_block(F.col(tail), tag)))
        whole = F.when(nests(F.col(flat), tag), nested_block(F.col(tail), tag)).otherwise(F.col(flat))
        block = F.when(here, whole).otherwise(block)
        taken = taken | here
    return df.select(*columns, block.alias(out))


def with_article(
    df: DataFrame,
    page: str = "html",
    title_selector: Selector = TITLE_SELECTOR,
    content_selectors: tuple[Selector, ...] = CONTENT_SELECTORS,
) -> DataFrame:
    """Add ``page_title`` (or a fixed placeholder), ``content`` (or empty text) and ``published_raw``.

    Elements inside comments, scripts and styles are not found.
    """
    columns = df.columns
    df = df.withColumn("_shown", visible_markup(F.col(page)))
    df = with_first_block(df, "_shown", "_title", (title_selector,))
    df = with_first_block(df, "_shown", "_content", content_selectors)
    return df.select(
        *columns,
        F.coalesce(strip_join(F.col("_title")), F.lit(UNKNOWN_TITLE)).alias("page_title"),
        F.coalesce(paragraphs(F.col("_content")), F.lit("")).alias("content"),
        meta_published(F.col("_shown")).alias("published_raw"),
    )
