"""Key digests in files, for loads that have to know what earlier batches loaded."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "digest binary, prefix string, batch_id long"


@dataclass(frozen=True)
class DigestFiles:
    """Digests (bytes) below ``path``, partitioned by their first ``prefix`` hexadecimal digits and their batch.

    A replayed batch overwrites its own files.
    """

    path: str
    prefix: int = 1

    def _prefix(self) -> Column:
        return F.substring(F.lower(F.hex(F.substring("digest", 1, (self.prefix + 1) // 2))), 1, self.prefix).alias("prefix")

    def keep(self, digests: DataFrame, batch_id: int) -> None:
        """Add the values of column ``digest``; nulls are left out."""
        rows = digests.filter("digest IS NOT NULL").select(
            "digest", self._prefix(), F.lit(batch_id).cast("long").alias("batch_id")
        )
        writer = rows.repartition("prefix").sortWithinPartitions("prefix", "digest").write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("prefix", "batch_id").parquet(self.path)

    def known(self, wanted: DataFrame, before: Column) -> DataFrame | None:
        """Those of the ``wanted`` digests that batches matching ``before`` have kept.

        Only partitions that ``wanted`` has digests for are read. None if nothing was kept yet.
        """
        prefixes = wanted.select(self._prefix()).distinct().collect()  # 16 ** prefix at most
        try:
            kept = wanted.sparkSession.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        earlier = kept.filter(F.col("prefix").isin([r[0] for r in prefixes]) & before)
        return earlier.select("digest").join(wanted, "digest", "left_semi").distinct()
