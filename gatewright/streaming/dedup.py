"""Natural-key deduplication of an unbounded input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_dedup(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str, order: Sequence[str]) -> DataFrame:
    """Keep one row per natural key; repeats may arrive up to ``delay`` late.

    With the event time in the key, as for a captured read, the first row in
    ``order`` stays. A key is decided when the watermark has passed its time: all
    its copies that count have arrived by then, so the same one stays as in a
    batch, whatever the order of arrival, and the row appears that much later. A
    key with very many copies is reduced in every map task before the shuffle.

    Without it, the row that arrives first stays and appears at once. Its key is
    remembered until the watermark has passed the row's time by ``delay``;
    repeats until then are dropped, in later micro-batches too, and a repeat
    after that is a new row. What arrives behind the watermark is dropped even
    if its key is new. ``order`` does not decide between rows of one micro-batch.
    """
    if event_time not in keys:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
    rest = [c for c in stream.columns if c not in keys]
    late = stream.withWatermark(event_time, delay)
    if not rest:
        return late.groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies")).select(*stream.columns)
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("__first")
    return late.groupBy(*keys).agg(first).select(*keys, "__first.*").select(*stream.columns)
