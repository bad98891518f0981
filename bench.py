"""Benchmark: every registered query plus the many-rule scale experiments.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``; each query is fully materialised through the
``noop`` sink, one warm-up then the median of ``$BENCH_REPEAT`` (default 5)
runs (scale experiments: ``$BENCH_SCALE_REPEAT``, default 3). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402

from ruleforge import RuleSet  # noqa: E402
from ruleforge.operators.multi_rule import compile_rules, rule_hit_counts, rule_hits, spread_input  # noqa: E402
from ruleforge.operators.rules_as_data import (  # noqa: E402
    rules_as_data_hits, threshold_hit_counts, threshold_rules)
from ruleforge.queries import AS_OF, QUERIES, table  # noqa: E402
from ruleforge.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "5"))
SCALE_REPEAT = int(os.environ.get("BENCH_SCALE_REPEAT", "3"))


def materialise(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(build, repeat: int = REPEAT) -> float:
    materialise(build())  # warm-up
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        materialise(build())
        runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 4)


def generated_rules(n: int) -> list[dict]:
    """``n`` single-threshold rules spread over four lineitem columns."""
    fields = [("l_quantity", 1.0, 50.0), ("l_extendedprice", 1000.0, 100000.0),
              ("l_discount", 0.0, 0.1), ("l_tax", 0.0, 0.08)]
    out = []
    for i in range(n):
        name, lo, hi = fields[i % len(fields)]
        step = (i // len(fields) + 1) / (n // len(fields) + 2)
        op = ">=" if i % 2 == 0 else "<"
        out.append({"id": f"gen_{i}", "name": "GEN", "description": "generated", "is_valid": "true",
                    "valid_from": "01/01/2020", "valid_till": "31/12/2999", "process": "identification",
                    "process_key": "query_builder", "is_lookup": "false",
                    "when": [{"field_name": name, "operator": op,
                              "field_value": f"{lo + (hi - lo) * step:.4f}", "join": ""}],
                    "then": {"field_name": "", "field_value": ""}})
    return out


def main() -> None:
    spark = local_session(f"local[{CPUS}]", shuffle_partitions=int(CPUS) * 2,
                          checkpoint_dir=tempfile.mkdtemp(prefix="ruleforge-bench-"))
    results: dict[str, float] = {}
    for name, fn in QUERIES.items():
        results[name] = timed(lambda fn=fn: fn(spark, SF_DIR))
    headline = round(sum(results.values()), 4)

    scale: dict[str, float] = {}
    errors: dict[str, str] = {}
    try:
        lineitem = table(spark, SF_DIR, "lineitem")
        keys = ["l_orderkey", "l_linenumber"]
        for n in (5, 50, 200):
            rs = RuleSet.from_rules(spark, generated_rules(n))
            batch = compile_rules(rs, lineitem, as_of=AS_OF)
            # local tables are single-row-group files: spread many-rule work over the cores, for every rule count
            spread = True
            scale[f"hits_{n}_rules_one_scan"] = timed(lambda b=batch, s=spread: rule_hits(lineitem, b, keys, spread=s),
                                                      SCALE_REPEAT)
            scale[f"counts_{n}_rules"] = timed(lambda b=batch: rule_hit_counts(spread_input(lineitem), b), SCALE_REPEAT)

            def per_rule(b=batch):
                for _, p in b.compiled:
                    materialise(lineitem.where(p.column).select(*keys))
            materialise(lineitem.select(*keys))
            t0 = time.perf_counter()
            per_rule()
            scale[f"hits_{n}_rules_one_query_each"] = round(time.perf_counter() - t0, 4)
        for n in (200, 1000):
            rs = RuleSet.from_rules(spark, generated_rules(n))
            thr = threshold_rules(rs, lineitem, as_of=AS_OF)
            scale[f"rules_as_data_{n}_rules"] = timed(
                lambda t=thr: rules_as_data_hits(lineitem, t, keys, spread=True), SCALE_REPEAT)
            scale[f"interval_counts_{n}_rules"] = timed(lambda t=thr: threshold_hit_counts(spread_input(lineitem), t),
                                                        SCALE_REPEAT)
            if n == 1000:
                batch = compile_rules(rs, lineitem, as_of=AS_OF)
                scale[f"counts_{n}_rules"] = timed(lambda b=batch: rule_hit_counts(spread_input(lineitem), b), SCALE_REPEAT)
    except Exception as e:  # noqa: BLE001 - still print the headline numbers
        errors["scale"] = f"{type(e).__name__}: {e}"[:500]
    spark.stop()
    print(json.dumps({"metric": "sum_of_median_query_sec", "value": headline, "unit": "sec",
                      "queries": results, "scale": scale, "sf": os.path.basename(SF_DIR.rstrip("/")),
                      "cpus": int(CPUS), "repeat": REPEAT, **({"errors": errors} if errors else {})}))


if __name__ == "__main__":
    main()
