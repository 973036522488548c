"""Results that are dear to make, kept by what they were made of."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from phonoloom.sources.sinks import Versioned

KEY = ["path", "model", "max_seconds"]


class TranscriptCache(Versioned):
    """Transcripts by path, model and longest duration. Only what isn't there is made; two runs at once may both make
    the same, and the later one's table stays."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, "path string, model string, max_seconds double, transcript string")

    def get(self, wanted: DataFrame, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """(path, model, max_seconds, transcript) of the wanted keys, each once; ``make`` gets the missing ones. Null
        paths are left out."""
        keys = wanted.select(*KEY).where("path is not null").distinct()
        known = self.read()
        missing = keys.join(known.select(*KEY), KEY, "left_anti")
        if not missing.isEmpty():
            self.replace(known.unionByName(make(missing).select(*KEY, "transcript")))
        return self.read().join(keys, KEY, "left_semi")

    def invalidate(self, prefix: str) -> None:
        """Forgets all whose path begins so."""
        self.replace(self.read().where(~F.col("path").startswith(prefix)))
