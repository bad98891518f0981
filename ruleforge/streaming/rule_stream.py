"""Rules on streaming DataFrames.

A compiled rule is a plain ``Column``, so filters, flags, conditionals and
stored lookup queries apply to a ``readStream`` DataFrame exactly as to a
batch one; the query stays stateless. This module adds the sink side: start
the stream with its checkpoint in the cluster's checkpoint folder.
"""

from __future__ import annotations

import hashlib
import posixpath

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.evaluate import RuleResult, run_rule
from ..session import checkpoint_root
from ..sources.ruleset import RuleSet


def run_rule_on_stream(rules: RuleSet, stream: DataFrame, **kwargs) -> RuleResult:
    """``run_rule`` for a streaming input (the result DataFrame streams too)."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame (spark.readStream...)")
    if kwargs.get("order_by"):
        raise ValueError("order_by is not supported on a stream; sort the sink's output instead")
    return run_rule(rules, stream, **kwargs)


def start_sink(result: DataFrame, path: str, *, query_name: str, fmt: str = "parquet",
               checkpoint_location: str | None = None, available_now: bool = True,
               output_mode: str = "append") -> StreamingQuery:
    """Write the stream to ``path``; offsets and commits live under the
    cluster's checkpoint folder (one folder per query name and output path)
    unless a location is given, so a restarted query resumes exactly where
    it stopped. Filters, flags and transformations stream in ``append``
    mode. File sinks only append, so a grouped lookup needs a watermark on
    its input, or a sink that supports ``output_mode="complete"``/``"update"``
    (``fmt="memory"``, or ``foreachBatch`` outside this helper). Changing a
    rule under the same name and path resumes from the old offsets: give the
    query a new name then."""
    if checkpoint_location is None:
        base = checkpoint_root(result.sparkSession)
        tag = hashlib.sha1(path.rstrip("/").encode()).hexdigest()[:12]
        checkpoint_location = posixpath.join(base, "streams", f"{query_name}-{tag}")
    writer = (result.writeStream.format(fmt).outputMode(output_mode)
              .option("path", path).option("checkpointLocation", checkpoint_location)
              .queryName(query_name))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
