"""Article table with one row per key: runs upsert, and rewrite only the buckets in which they meet known keys."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.operators.upsert import KEPT, assign_ids, upsert_articles
from newsflow.schemas import ARTICLES
from newsflow.schemas import schema as schema_of
from newsflow.session import stage
from newsflow.sources.readers import read_or_empty
from newsflow.sources.sinks import before_run

RUN = schema_of("run_source string, batch long")
FOLDER = schema_of("bucket int, commit string")
#: One row per bucket that a commit wrote; ``replaces``: what earlier commits wrote of it is void.
MANIFEST = schema_of("seq long, commit string, bucket int, replaces boolean, top long")
ATTEMPTS = 5


class KeyedArticles:
    """Article rows under ``path/bucket=B/commit=C``, the bucket by hash of the key, and the list of commits beside it.

    A run adds a folder to each bucket in which all its keys are new, and writes the others anew, old rows and
    its own merged: a known key takes the updated columns and keeps its id and the kept ones, null keys are left
    out. Rows are merged with the table as it is when the run writes, so runs that overlap leave one row per key
    and unique ids. A commit counts once its list is there; folders of a writer that died are never read. If
    another run commits first, the merge is done again on the new state. Finding that out takes a file system
    that refuses to create what exists; on others let one run write at a time.

    Rows know the run that brought their key, so a replay sees the table as it was before it. Writing the same
    run again changes nothing. ``compact`` gathers buckets of many folders; void folders may be deleted at will.
    The number of buckets belongs to the path: give the same one always, so many that one holds about a million rows.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = ARTICLES, buckets: int = 256):
        self.spark, self.path, self.schema, self.buckets = spark, path.rstrip("/"), schema, buckets
        self._commits = f"{self.path}.commits"

    def manifest(self) -> DataFrame:
        return read_or_empty(self.spark, self._commits, MANIFEST, "json")

    def live(self) -> DataFrame:
        """``(bucket, commit)`` of the folders that count, at most one per bucket and commit since its last rewrite."""
        written = self.manifest()
        since = written.where("replaces").groupBy("bucket").agg(F.max("seq").alias("_since"))
        counted = written.join(since, "bucket", "left").where(F.col("seq") >= F.coalesce("_since", F.lit(0)))
        return counted.select("bucket", "commit")

    def stored(self, folders: DataFrame | None = None) -> DataFrame:
        """Current rows with run and folder, or those in ``folders``, which prune what is read."""
        rows = read_or_empty(self.spark, self.path, T.StructType([*self.schema.fields, *RUN.fields, *FOLDER.fields]))
        return rows.join(self.live() if folders is None else folders, ["bucket", "commit"], "left_semi")

    def read(self, before: tuple[str, int] | None = None) -> DataFrame:
        """Current rows; ``before=(source, batch)`` leaves out keys that this run and later ones of its source brought."""
        rows = self.stored()
        if before is not None:
            rows = before_run(rows, *before)
        return rows.select(self.schema.fieldNames())

    def write_run(self, rows: DataFrame, source: str, batch: int) -> None:
        """Upsert the rows of a run (``pos`` gives their order, ids are given here)."""
        columns = [F.col(f.name).cast(f.dataType) for f in self.schema if f.name != "id"]
        run = [F.lit(source).alias("run_source"), F.lit(batch).cast("long").alias("batch")]
        bucket = F.pmod(F.xxhash64("canonical_key"), F.lit(self.buckets)).cast("int").alias("bucket")
        keyed = rows.where(F.col("canonical_key").isNotNull())
        incoming = stage(keyed.select(*columns, *run, bucket, "pos"), "incoming")
        for attempt in range(ATTEMPTS):
            try:
                return self._merge(incoming)
            except AnalysisException as error:
                if error.getCondition() != "PATH_ALREADY_EXISTS" or attempt == ATTEMPTS - 1:
                    raise

    def _merge(self, incoming: DataFrame) -> None:
        seq, top = self._last()
        touched = self.live().join(incoming.select("bucket").distinct(), "bucket", "left_semi")
        known = self.stored(touched).select("bucket", "canonical_key")
        hits = known.join(incoming.select("bucket", "canonical_key"), ["bucket", "canonical_key"], "left_semi")
        hits = stage(hits.select("bucket").distinct(), "hits")
        old = self.stored(self.live().join(hits, "bucket", "left_semi"))
        kept = (*KEPT, *RUN.fieldNames(), "bucket")
        updated = tuple(f.name for f in self.schema if f.name not in ("id", "canonical_key", *KEPT))
        merged = stage(upsert_articles(old, incoming, kept=kept, updated=updated), "merged")
        before = self.spark.createDataFrame([(top,)], "id long")
        self._commit(assign_ids(merged, before), hits, seq + 1)

    def _last(self) -> tuple[int, int]:
        last = self.manifest().agg(F.coalesce(F.max("seq"), F.lit(0)), F.coalesce(F.max("top"), F.lit(0))).first()
        return last[0], last[1]

    def _commit(self, rows: DataFrame, replaced: DataFrame, seq: int) -> None:
        """Write ``rows`` as the commit ``seq``; it replaces the buckets in ``replaced``. Without rows there is none."""
        commit = uuid.uuid4().hex
        placed = rows.select(*self.schema.fieldNames(), *RUN.fieldNames(), "bucket", F.lit(commit).alias("commit"))
        placed.hint("rebalance", F.col("bucket")).write.mode("append").partitionBy("bucket", "commit").parquet(self.path)
        every = read_or_empty(self.spark, self.path, T.StructType([*placed.schema.fields]))
        written = every.where(F.col("commit") == commit).groupBy("commit", "bucket").agg(F.max("id").alias("top"))
        flags = replaced.select("bucket", F.lit(True).alias("replaces"))
        listed = written.join(flags, "bucket", "left").withColumn("replaces", F.coalesce("replaces", F.lit(False)))
        listed = listed.select("commit", "bucket", "replaces", "top")
        if not listed.isEmpty():
            listed.coalesce(1).write.mode("errorifexists").json(f"{self._commits}/seq={seq}")

    def compact(self, folders: int = 16) -> None:
        """Write buckets of more than ``folders`` folders anew, one folder each."""
        seq, _ = self._last()
        many = self.live().groupBy("bucket").count().where(F.col("count") > folders)
        many = stage(many.select("bucket"), "many")
        rows = self.stored(self.live().join(many, "bucket", "left_semi"))
        self._commit(rows, many, seq + 1)
