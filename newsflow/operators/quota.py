"""Success quota: walk each source in order until enough rows were accepted."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.operators.dedupe import ACCEPTED, ERROR
from newsflow.operators.ordering import RANGE_BITS, with_prior_count


def take_successes(
    df: DataFrame, n: int, source: str = "source", pos: str = "pos", bits: int = RANGE_BITS
) -> DataFrame:
    """Rows of ``df`` (with ``status``) that the walk visits before ``n`` rows of the source are accepted.

    The quota caps accepted rows, not checked rows. Failures before the stop stay in, so that they can
    be counted; everything after it was never looked at.
    """
    flagged = df.withColumn("_accepted", F.col("status") == ACCEPTED)
    visited = with_prior_count(flagged, pos, [source], "_accepted", "_prior", below=n, bits=bits)
    return visited.drop("_accepted", "_prior")


def run_counters(visited: DataFrame, source: str = "source", failed=None) -> DataFrame:
    """``items_processed`` and ``errors`` per source; ``failed`` adds accepted rows that count as errors too."""
    bad = F.col("status") == ERROR
    if failed is not None:
        bad = bad | ((F.col("status") == ACCEPTED) & failed)
    return visited.groupBy(source).agg(
        F.count_if(F.col("status") == ACCEPTED).alias("items_processed"),
        F.count_if(bad).alias("errors"),
    )
