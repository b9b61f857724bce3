"""De-identification of streams: the rules' projection is stateless, so a stream takes it as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.rules import Rule, deidentify


def deidentify_stream(stream: DataFrame, rules: dict[str, Rule], key: str, table_path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Write a stream's de-identified rows to a folder, each input row once."""
    out = deidentify(stream, rules, key)
    return out.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(table_path)
