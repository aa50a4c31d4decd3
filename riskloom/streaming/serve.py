"""Replay of a fitted spec over a stream.

The replay is a stateless projection plus joins with static WoE maps, so it runs
on any streaming source without watermark or state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from riskloom.operators.transforms import serve_features


def serve_stream(
    stream: DataFrame,
    spec: DataFrame,
    out_path: str,
    checkpoint: str,
    features: Sequence[str] | None = None,
    target: str | None = None,
    keep: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append engineered rows to Parquet; the default trigger drains what is there and stops."""
    served = serve_features(stream, spec, features, target, keep)
    return (
        served.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
