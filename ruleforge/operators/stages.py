"""Staged rule runs: narrow the rows with one rule, identify with the next.

Each stage's output DataFrame is the next stage's input, and can be
registered as a temporary view under a name later rules (or SQL) refer to.
Because every stage is lazy, Catalyst merges the stages' filters into a
single scan of the source. For very long chains the intermediate result can
be checkpointed to the cluster's checkpoint folder to cut the lineage.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Any, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.ruleset import RuleSet
from .evaluate import RuleResult, run_rule


@dataclass(frozen=True)
class Stage:
    rule_id: str
    process: str
    process_key: str
    is_lookup: Any = None
    view_name: str | None = None     # register the stage output under this name
    options: dict = field(default_factory=dict)  # extra run_rule keyword arguments


@dataclass
class StagedRun:
    df: DataFrame | None
    results: list[RuleResult]

    @property
    def ok(self) -> bool:
        return all(r.ok for r in self.results) and (self.df is not None or not self.results)


def run_stages(rules: RuleSet, table: DataFrame | str, stages: Sequence[Stage], *,
               as_of: dt.date | None = None, table_name: str | None = None,
               checkpoint_between: bool = False, observe: Sequence[Observation] | None = None) -> StagedRun:
    """Run ``stages`` in order; stop at the first rejected stage.

    A stage without ``view_name`` is named in the next stage's query text as
    a subquery of its own query. Each result's ``executed`` text is the typed
    SQL that ran (on the table or view it names) and can be re-run as is;
    ``query`` keeps the rule language's spelling, which ANSI mode may refuse.
    ``checkpoint_between`` writes each intermediate result (not the final
    one) with a reliable ``checkpoint()`` into ``spark.checkpoint.dir`` so a
    lost executor does not recompute earlier stages; it is off by default
    because stages are cheap filters that Catalyst fuses. Set
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` to have Spark delete
    the files once the result is no longer referenced. ``observe`` (one
    ``Observation`` per stage) counts each stage's output rows as ``rows_out``
    while the result is written.
    """
    current: DataFrame | str = table
    name = table_name if table_name else (table if isinstance(table, str) else None)
    ran = name  # the same chain of names, as executed
    results: list[RuleResult] = []
    for i, stage in enumerate(stages):
        res = run_rule(rules, current, rule_id=stage.rule_id, process=stage.process,
                       process_key=stage.process_key, is_lookup=stage.is_lookup,
                       as_of=as_of, table_name=name, **stage.options)
        if name != ran and name and res.executed:
            res.executed = res.executed.replace(name, ran, 1)
        results.append(res)
        if not res.ok or res.df is None:
            return StagedRun(None, results)
        out = res.df
        if observe is not None:
            out = out.observe(observe[i], F.count(F.lit(1)).alias("rows_out"))
        if checkpoint_between and i < len(stages) - 1 and not out.isStreaming:
            ensure_checkpoint_dir(out.sparkSession)
            out = out.checkpoint(eager=True)
        if stage.view_name:
            out.createOrReplaceTempView(stage.view_name)
            name = ran = stage.view_name
        elif name and res.query.lstrip().lower().startswith("select"):
            name = "({}\n)".format(res.query.strip())  # newline: a tail may end in a -- comment
            ran = "({}\n)".format(res.executed.strip())
        else:
            name = ran = None
        current = out
    return StagedRun(current if isinstance(current, DataFrame) else None, results)


def write_audited_run(rules: RuleSet, table: DataFrame | str, stages: Sequence[Stage], output: str, audit: str, run_id: str, *,
                      as_of: dt.date | None = None, table_name: str | None = None) -> StagedRun:
    """Write a staged run's result to ``output/run_id=<id>`` and its audit rows to ``audit/run_id=<id>`` with one job over the data.

    The stages' row counts are observed while the result is written, so the audit costs no scan of its own.
    Both folders are overwritten when a run id is repeated: a run is in each table exactly once. Audit rows have
    ``stage`` (number), ``rule_id``, ``status``, ``message``, ``query``, ``executed``, ``rows_out``; a rejected run writes
    only its audit rows.
    """
    if not run_id or not all(c.isalnum() or c in "._-" for c in run_id):
        raise ValueError(f"run id {run_id!r} is no folder name")
    seen = [Observation() for _ in stages]
    run = run_stages(rules, table, stages, as_of=as_of, table_name=table_name, observe=seen)
    if run.df is not None:
        run.df.write.mode("overwrite").parquet(f"{output}/run_id={run_id}")
    rows = []
    for i, stage in enumerate(stages):
        res = run.results[i] if i < len(run.results) else None
        if res is None:
            rows.append((i, stage.rule_id, "skipped", "an earlier stage was rejected or produced no table", "", "", None))
        else:
            status = ("ok" if res.df is not None else "no output") if res.ok else "rejected"
            n = seen[i].get["rows_out"] if run.df is not None else None
            rows.append((i, ",".join(res.rule_ids), status, res.message, res.query, res.executed, n))
    schema = "stage int, rule_id string, status string, message string, query string, executed string, rows_out bigint"
    rules.spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{audit}/run_id={run_id}")
    return run
