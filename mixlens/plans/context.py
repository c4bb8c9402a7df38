"""Shared inputs of the registered queries.

One context per (application, source), where the source is a folder of TPC-H-style
tables or ``export:<format>:<path>``. The raw media fact and the cleaned rows (partitioned by
year) are each written once as Parquet into the checkpoint folder the session names
(``spark.checkpoint.dir``), and beside them a table of weekly statistics from which sales are
allocated as rows are read. Every view reads those tables, so the source join and the cleaning
run once, lineage is cut (a lost executor re-reads files instead of recomputing the join), and
later scans get column pruning, filter pushdown and partition pruning on ``year``.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.allocate import allocate_with, key_statistics
from ..operators.clean import clean, date_parts
from ..session import ensure_checkpoint_dir
from ..sources.media_fact import media_from_tpch
from ..spec import DEFAULT_SPEC, MediaSpec

_CONTEXTS: dict = {}
# keeps written files near a few hundred MB however many rows one task holds
MAX_RECORDS_PER_FILE = 5_000_000
# rows that a task compares with each other: a hash table of some 100 MB
PIECE_ROWS = 250_000
_LOCK = threading.Lock()


class MediaContext:
    def __init__(self, spark: SparkSession, sf_dir: str, spec: MediaSpec = DEFAULT_SPEC):
        self.spark, self.sf_dir, self.spec = spark, sf_dir, spec
        self._rows = None
        self._clean = None
        self._raw = None
        self._weekly = None
        self._pieces = None
        self._lock = threading.RLock()   # one materialisation per table, even from threads

    # -- raw fact, written once (the source join runs one time) ----------------------
    def _raw_table(self) -> DataFrame:
        with self._lock:
            return self._raw_table_locked()

    def _source(self) -> DataFrame:
        """The raw media fact: a real export (``export:<format>:<path>``) read with the header
        rename map, or the fact derived from a folder of TPC-H-style tables."""
        if self.sf_dir.startswith("export:"):
            from ..sources.media_fact import read_media
            _, fmt, path = self.sf_dir.split(":", 2)
            opts = {"header": True} if fmt == "csv" else {}
            # an export carries no synthetic copies: line number 1 means "one copy"
            return read_media(self.spark, path, fmt=fmt, **opts).withColumn("_lnum", F.lit(1))
        return media_from_tpch(self.spark, self.sf_dir, keep_line=True)

    def _raw_table_locked(self) -> DataFrame:
        if self._raw is None:
            path = self._path("raw_fact")
            (self._source()
                .write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path))
            self._raw = self.spark.read.parquet(path)
        return self._raw

    def raw(self) -> DataFrame:
        return self._raw_table().drop("_lnum")

    def raw_with_copies(self) -> DataFrame:
        from ..sources.media_fact import add_copies
        return add_copies(self._raw_table())

    def pieces(self) -> int:
        """Pieces of PIECE_ROWS rows that the raw fact makes (its rows are counted from the stored files)."""
        with self._lock:
            if self._pieces is None:
                self._pieces = max(1, -(-self._raw_table().count() // PIECE_ROWS))
            return self._pieces

    def clean(self) -> DataFrame:
        return clean(self.raw(), self.spec, self.pieces())

    # -- materialised row fact -------------------------------------------------------
    def _path(self, name: str) -> str:
        key = hashlib.sha1(f"{self.sf_dir}|{self.spec}".encode()).hexdigest()[:12]
        app = self.spark.sparkContext.applicationId
        return f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/mixlens/{app}/{key}/{name}"

    def clean_fact(self) -> DataFrame:
        """Cleaned rows with calendar parts: the one stored copy, clustered by year.

        Rows move once, into even ranges of year and digest: there equal rows meet, and a year
        (a hot one too) has few files of even size instead of one from every task.
        """
        with self._lock:
            if self._clean is None:
                path = self._path("clean_fact")
                by_year = F.year(self.spec.week_col)
                fact = clean(self.raw(), self.spec, self.pieces(), by_year).transform(date_parts, self.spec.week_col)
                (fact.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
                     .partitionBy("year").parquet(path))
                self._clean = self.spark.read.parquet(path)
            return self._clean

    def rows(self) -> DataFrame:
        """The cleaned rows with ``activity_weight`` and ``estimated_sales``, allocated as they are read
        from the stored rows and the stored weekly statistics."""
        with self._lock:
            if self._rows is None:
                clean = self.clean_fact()
                path = self._path("key_statistics")
                key_statistics(clean, self.spec).write.mode("overwrite").parquet(path)
                self._rows = allocate_with(clean, self.spark.read.parquet(path), self.spec)
            return self._rows

    def row_level(self) -> DataFrame:
        """The published row-level table: cleaned columns, calendar parts, allocated sales and
        the seven row ratios (the internal activity weight is dropped)."""
        from ..operators.efficiency import row_ratios
        return row_ratios(self.rows(), self.spec.target_col).drop("activity_weight")

    def weekly(self) -> DataFrame:
        """Weekly feature table (D3) from the materialised rows; small (one row per week)."""
        from ..operators.measure import weekly_feature_table
        with self._lock:
            if self._weekly is None:
                self._weekly = weekly_feature_table(self.clean_fact(), self.spec).checkpoint(eager=True)
            return self._weekly

    def weekly_sales(self) -> DataFrame:
        return self.weekly().select(self.spec.week_col, "total_sales")


def context(spark: SparkSession, sf_dir: str, spec: MediaSpec = DEFAULT_SPEC) -> MediaContext:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), repr(spec))
    with _LOCK:
        if key not in _CONTEXTS:
            ensure_checkpoint_dir(spark)
            _CONTEXTS[key] = MediaContext(spark, sf_dir.rstrip("/"), spec)
        return _CONTEXTS[key]


__all__ = ["MediaContext", "context"]
