"""Checks over a rule document, unmatched calls and the audit trail.

The validation report is a Spark job over the flattened document (catalog +
conditions), so every rule is checked at once and a bad rule is reported
rather than aborting the run. The audit frame records what each rule call
did (query text, status, message) and is appended to a table by the caller.
"""

from __future__ import annotations

import datetime as dt
import json
from typing import Iterable, Sequence

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json_lookup import json_object
from ..functions.predicates import COMPARISONS, PREFIX_LIKE
from ..plans import resolution as R
from ..sources.ruleset import RuleSet, strip_ws
from .evaluate import RuleResult

RULE_DATE_PATTERN = "d/M/yyyy"


def _issue(cond, fmt: str, *args) -> F.Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.format_string(fmt, *args))


def _rule_date(c: str) -> F.Column:
    """day/month/4-digit-year, as rule resolution reads it (null otherwise)."""
    return F.when(F.col(c).rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), F.try_to_date(c, RULE_DATE_PATTERN))


def rule_validation(rules: RuleSet, as_of: dt.date | None = None) -> DataFrame:
    """One row per rule: ``doc, rule_pos, id, process, process_key, active, issues, ok``.

    Runs over the rule document (configuration); ``collect_list`` gathers
    at most one issue per check per condition of a single rule.
    """
    as_of = as_of or dt.date.today()
    blank = ["process", "process_key", "is_lookup", "is_valid", "field_name", "field_value",
             "valid_from", "valid_till"]
    cat = rules.catalog_df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in blank else c
                                    for c in rules.catalog_df.columns])
    start, end = _rule_date("valid_from"), _rule_date("valid_till")
    day = F.lit(as_of)
    is_builder = F.col("process_key") == "query_builder"
    lookup_keys = F.col("process_key").isin(*R.LOOKUP_KEYS)
    dup = F.count(F.lit(1)).over(Window.partitionBy("id"))
    key = ["doc", "rule_pos"]

    header = cat.select(
        "doc", "rule_pos", "id", "process", "process_key", "field_name", "field_value", "n_conditions",
        ((F.col("is_valid") == "true") & start.isNotNull() & end.isNotNull()
         & (start <= day) & (day <= end)).alias("active"),
        F.array(
            _issue(~F.col("process_key").isin(*R.KNOWN_KEYS), R.MSG_INVALID_KEY),
            _issue(~F.coalesce(F.col("is_valid").isin("true", "false"), F.lit(False)),
                   "is_valid %s is neither true nor false", F.col("is_valid")),
            _issue(start.isNull(), "valid_from %s is not a day/month/year date", F.col("valid_from")),
            _issue(end.isNull(), "valid_till %s is not a day/month/year date", F.col("valid_till")),
            _issue(start > end, "validity window %s..%s is empty", F.col("valid_from"), F.col("valid_till")),
            _issue(lookup_keys & (F.col("is_lookup") != "true"),
                   "%s rules need is_lookup true", F.col("process_key")),
            _issue(F.col("process_key").isin(*R.BUILDER_KEYS) & (F.col("is_lookup") == "true"),
                   "%s rules need is_lookup false", F.col("process_key")),
            _issue(F.col("n_conditions") <= 0, "rule has no conditions"),
            _issue((F.col("process_key") == "conditional") & (F.col("field_name") != "goto"),
                   R.MSG_CONDITIONAL_BAD),
            _issue(dup > 1, "id %s appears %d times; they are tried in order: a disabled or expired one "
                   "rejects the call, one without conditions is skipped", F.col("id"), dup),
        ).alias("header_issues"),
    )

    goto_targets = sorted({r.then_value for r in rules.rules() if r.is_goto and r.then_value})
    conds = (rules.conditions_df(outer=False)
             .select(*key, "cond_pos", *[F.coalesce(F.col(c), F.lit("")).alias(c)
                                         for c in ("field_name", "operator", "join")],
                     "field_value", "lookup_value")
             .join(cat.select(*key, "process_key", "n_conditions", F.col("field_name").alias("then_field"),
                              F.col("id").isin(*goto_targets).alias("is_target")), key))
    n = F.col("n_conditions")
    pos = F.col("cond_pos") + 1
    ops_allowed = list(COMPARISONS) + list(PREFIX_LIKE)
    join_u = F.upper(F.col("join"))
    cond_issues = conds.select(
        *key,
        F.explode(F.array(
            _issue(is_builder & ~F.upper(F.col("operator")).isin(*[o.upper() for o in ops_allowed]),
                   "condition %d: operator %s is not supported", pos, F.col("operator")),
            _issue(is_builder & ~join_u.isin("AND", "OR", ""),
                   "condition %d: join %s must be AND, OR or empty", pos, F.col("join")),
            _issue(is_builder & (join_u == "") & (F.col("cond_pos") < n - 1) & ~F.col("is_target"),
                   "condition %d has no join before condition %d", pos, pos + 1),
            _issue(is_builder & (join_u == "") & (F.col("cond_pos") < n - 1) & F.col("is_target"),
                   "condition %d has no join before condition %d: fine inside a goto chain (AND), "
                   "rejected when the rule is called directly", pos, pos + 1),
            _issue(is_builder & (F.col("then_field") == "goto") & (join_u == "OR") & (F.col("cond_pos") == n - 1),
                   "condition %d: a trailing OR cannot lead into a goto", pos),
            _issue(is_builder & F.col("field_value").isNull(), "condition %d has no field_value", pos),
            _issue(is_builder & F.col("field_name").rlike(r"^\s*$"), "condition %d has no field_name", pos),
            _issue((F.col("cond_pos") == 0) & (F.col("process_key") == "value_lookup")
                   & json_object("lookup_value").isNull(), "lookup_value is not a JSON object"),
            _issue((F.col("cond_pos") == 0) & F.col("process_key").isin("query_lookup", "groupby_lookup")
                   & (F.trim(F.coalesce(F.col("lookup_value"), F.lit(""))) == ""),
                   "lookup query is empty"),
            _issue((F.col("process_key") == "transformation")
                   & ((F.col("field_name") == "") | (F.col("then_field") == "")),
                   "transformation needs then.field_name (target) and a field_name (expression) in each when"),
            _issue((F.col("cond_pos") >= 1) & F.col("process_key").isin(*R.LOOKUP_KEYS)
                   & F.col("lookup_value").isNotNull(),
                   "condition %d: a lookup reads its first lookup_value only, this one is ignored", pos),
        )).alias("issue"),
    ).where(F.col("issue").isNotNull())

    extra = (cond_issues.unionByName(_resolution_issues(rules, as_of))
             .groupBy(*key).agg(F.array_sort(F.collect_list("issue")).alias("more")))
    out = (header.join(extra, key, "left")
           .select("doc", "rule_pos", "id", "process", "process_key", "active",
                   F.concat(F.array_compact("header_issues"),
                            F.coalesce("more", F.array().cast("array<string>"))).alias("issues")))
    return out.withColumn("ok", F.size("issues") == 0)


def _resolution_issues(rules: RuleSet, as_of: dt.date) -> DataFrame:
    """Issues found by running the resolution code itself over the rule list
    (configuration, already on the driver): goto chains as ``follow_gotos``
    sees them and stored group-by tails as ``grouping_keys`` reads them."""
    from ..errors import RuleConfigError
    from .evaluate import grouping_keys
    rows = []
    for r in rules.rules():
        if r.is_goto and r.process_key in ("query_builder", "conditional"):
            try:
                R.follow_gotos(rules, r, as_of, include_start=r.process_key != "conditional")
            except RuleConfigError as e:
                rows.append((r.doc, r.doc_pos, f"goto chain: {e}"))
        if r.process_key == "groupby_lookup" and r.conditions:
            try:
                if grouping_keys(rules.spark, (r.conditions[0].lookup_value or "").strip()) is None:
                    rows.append((r.doc, r.doc_pos, "groupby_lookup tail has no top-level group by"))
            except (RuleConfigError, ParseException) as e:
                rows.append((r.doc, r.doc_pos, str(e).strip().splitlines()[0]))
    return rules.spark.createDataFrame(rows, "doc string, rule_pos int, issue string")


REQUEST_COLUMNS = ("process", "process_key", "rule_id", "is_lookup")


def unmatched_requests(rules: RuleSet, requests: DataFrame) -> DataFrame:
    """Calls (process, process_key, rule_id, is_lookup) that no rule answers,
    with the message the rule call would report. Values are stripped and a
    null ``is_lookup`` follows from the process key, as in ``run_rule``.

    The join carries no hint: Spark broadcasts a rule list of ordinary size,
    and for a larger one adaptive execution splits a combination that very
    many requests share."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))  # noqa: E731 - as the driver rule list
    cat = rules.catalog_df.select(
        blank("process").alias("_p"), blank("process_key").alias("_k"),
        blank("id").alias("_i"), blank("is_lookup").alias("_l")).distinct()

    def strip(c: str) -> F.Column:
        return F.coalesce(strip_ws(F.col(c).cast("string")), F.lit(""))
    derived = F.when(strip("process_key").isin(*R.LOOKUP_KEYS), F.lit("true")).otherwise(F.lit("false"))
    trimmed = requests.select(
        "*", *[strip(c).alias(f"_req_{c}") for c in REQUEST_COLUMNS if c != "is_lookup"],
        F.when(F.col("is_lookup").isNull(), derived).otherwise(strip("is_lookup")).alias("_req_is_lookup"))
    cond = ((trimmed["_req_process"] == cat["_p"]) & (trimmed["_req_process_key"] == cat["_k"])
            & (trimmed["_req_rule_id"] == cat["_i"]) & (trimmed["_req_is_lookup"] == cat["_l"]))
    return (trimmed.join(cat, cond, "left_anti")
            .drop(*[f"_req_{c}" for c in REQUEST_COLUMNS])
            .withColumn("message", F.lit(R.MSG_UNMATCHED)))


AUDIT_SCHEMA = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("rule_id", T.StringType()),
    T.StructField("valid_params", T.BooleanType()),
    T.StructField("rule_validity", T.BooleanType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("executed", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
])


def _audit_text(res: RuleResult) -> str | None:
    if not res.has_value:
        return res.query
    if res.value is None:
        return None
    return res.value if isinstance(res.value, str) else json.dumps(res.value)


def audit_frame(spark: SparkSession, entries: Iterable[tuple[str, RuleResult]],
                logged_at: dt.datetime | None = None) -> DataFrame:
    """One audit row per (stage name, rule result)."""
    when = logged_at or dt.datetime.now(dt.timezone.utc)  # aware: no driver-zone shift
    rows = []
    for stage, res in entries:
        ok = res.ok
        rows.append((stage, ",".join(res.rule_ids), res.valid_params is True, bool(res.rule_validity),
                     "ok" if ok else "rejected", res.message,
                     _audit_text(res), res.executed or None, when))
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def audit_stages(spark: SparkSession, stage_names: Sequence[str], results: Sequence[RuleResult]) -> DataFrame:
    return audit_frame(spark, zip(stage_names, results))


STAGE_AUDIT_SCHEMA = "stage string, rule_id string, status string, message string, query string, executed string, rows_out bigint"


def stage_audit(spark: SparkSession, run, stage_names: Sequence[str]) -> DataFrame:
    """Audit of a staged run with each stage's output row count.

    One row per stage name: ``stage, rule_id, status, message, query,
    rows_out``, with ``executed`` (the typed SQL that ran) beside ``query``. A stage followed by plain filter stages is counted together
    with them in one scan (``count_if`` of the accumulated predicates);
    other stages get a count of their own. A rejected stage has no count,
    and stages after it are listed as ``skipped``.
    """
    names = list(stage_names)
    parts, i = [], 0

    def meta(k):
        res = run.results[k] if k < len(run.results) else None
        if res is None:
            return res, (names[k], "", "skipped", "an earlier stage was rejected or produced no table", "", "")
        status = ("ok" if res.df is not None else "no output") if res.ok else "rejected"
        return res, (names[k], ",".join(res.rule_ids), status, res.message, res.query, res.executed)

    def literal_row(m, count_col):
        cols = [F.lit(v).alias(c) for v, c in zip(m, ("stage", "rule_id", "status", "message", "query", "executed"))]
        return cols + [count_col.alias("rows_out")]

    while i < len(names):
        res, m = meta(i)
        if res is None or m[2] != "ok":
            parts.append(spark.range(1).select(*literal_row(m, F.lit(None).cast("bigint"))))
            i += 1
            continue
        # this stage's output, plus every following plain filter stage, in one aggregate
        group = [(m, None)]
        preds = []
        j = i + 1
        while j < len(names):
            nres, nm = meta(j)
            if nres is None or nm[2] != "ok" or nres.applied_as != "filter" or nres.predicate is None:
                break
            preds.append(nres.predicate)
            group.append((nm, list(preds)))
            j += 1
        conds = []
        for _, ps in group[1:]:
            cond = ps[0]
            for p in ps[1:]:
                cond = cond & p
            conds.append(cond)
        # project the predicates first: an aggregate may not hold non-deterministic ones
        flags = res.df.select(F.lit(1).alias("c0"), *[c.alias(f"c{k}") for k, c in enumerate(conds, start=1)])
        aggs = [F.count("c0").alias("c0")] + [F.count_if(f"c{k}").alias(f"c{k}")
                                              for k in range(1, len(conds) + 1)]
        try:
            counts = flags.agg(*aggs)
        except AnalysisException:
            # e.g. a non-deterministic predicate (rand(), uuid()) cannot sit inside an
            # aggregate: count each stage on its own output instead
            for k in range(i, j):
                kres, km = meta(k)
                parts.append(kres.df.agg(F.count(F.lit(1)).alias("c")).select(*literal_row(km, F.col("c"))))
            i = j
            continue
        rows = F.array(*[F.struct(*literal_row(gm, F.col(f"c{k}"))) for k, (gm, _) in enumerate(group)])
        parts.append(counts.select(F.inline(rows)))
        i = j
    if not parts:
        return spark.createDataFrame([], STAGE_AUDIT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
