"""New records against a standing index: a stateless join of a stream of normalized records with stored keys.

The index side's keys and frequencies are made once, in batch, and stored; each micro-batch of new Source 1 records is
blocked against them. Candidate lists are complete by record, since a record is in one micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import normalized
from ..operators import blocking as B
from ..sources.store import stored


class Index:
    """Stored frequencies and pruned keys of index records."""

    def __init__(self, norm: DataFrame, settings: B.Settings = B.Settings()):
        self.settings = settings
        self.frequencies = stored(B.frequencies(norm), "frequencies")
        self.keys = stored(B.pruned(B.keys(B.ranked(norm, self.frequencies), settings), settings.max_block), "index-keys")

    def candidates(self, records: DataFrame) -> DataFrame:
        """Candidate pairs of raw records."""
        norm = stored(normalized(records), "new-records")
        keys = B.keys(B.ranked(norm, self.frequencies), self.settings, query=True)
        return B.capped(B.combined(keys, self.keys), self.settings.max_cands)


def block_stream(records: DataFrame, index: Index, out: str, checkpoint: str) -> StreamingQuery:
    """Writes the candidates of a stream of raw records to `out`, a folder a micro-batch, so that a repeated batch replaces itself."""

    def each(batch: DataFrame, number: int) -> None:
        index.candidates(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return records.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
