"""Rules on a file stream: same predicates, stateless, checkpointed sink."""

import os

from conftest import AS_OF, FIXTURES

from ruleforge.sources.files import TRANSACTION_SCHEMA
from ruleforge.streaming.rule_stream import run_rule_on_stream, start_sink


def test_file_stream_filter(spark, current_rules, tmp_path):
    src = str(tmp_path / "in")
    os.makedirs(src)
    with open(os.path.join(FIXTURES, "transactions.csv")) as f:
        data = f.read()
    with open(os.path.join(src, "part1.csv"), "w") as f:
        f.write(data)
    stream = spark.readStream.schema(TRANSACTION_SCHEMA).option("header", True).csv(src)
    res = run_rule_on_stream(current_rules, stream, rule_id="rule_4", process="identification",
                             process_key="query_builder", as_of=AS_OF)
    assert res.df.isStreaming
    lookup = run_rule_on_stream(current_rules, res.df, rule_id="rule_1", process="filtration",
                                process_key="query_lookup", as_of=AS_OF)
    out = str(tmp_path / "out")
    q = start_sink(lookup.df, out, query_name="rules_smoke", checkpoint_location=str(tmp_path / "ckpt"))
    assert q.awaitTermination(120), "stream did not finish"
    got = sorted((r.session_id, r.id) for r in spark.read.parquet(out).collect())
    assert got == [(6, 12), (8, 16), (9, 18)]


def test_restart_resumes_from_checkpoint(spark, current_rules, tmp_path):
    src, out, ckpt = (str(tmp_path / d) for d in ("in", "out", "ckpt"))
    os.makedirs(src)
    with open(os.path.join(FIXTURES, "transactions.csv")) as f:
        header, *rows = f.read().splitlines()

    def run_once():
        stream = spark.readStream.schema(TRANSACTION_SCHEMA).option("header", True).csv(src)
        res = run_rule_on_stream(current_rules, stream, rule_id="rule_3", process="identification",
                                 process_key="query_builder", as_of=AS_OF, mode="flag")
        q = start_sink(res.df, out, query_name="rules_restart", checkpoint_location=ckpt)
        assert q.awaitTermination(120), "stream did not finish"

    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("\n".join([header] + rows[:5]) + "\n")
    run_once()
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write("\n".join([header] + rows[5:]) + "\n")
    run_once()  # a new query on the same checkpoint only reads the new file
    got = spark.read.parquet(out)
    assert got.count() == 10
    assert sorted((r.session_id, r.id) for r in got.where("is_ttr = 'true'").collect()) == \
        [(5, 12), (6, 12), (6, 13), (7, 14), (7, 15), (8, 16), (9, 18), (9, 19)]
