import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
AS_OF = dt.date(2022, 3, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ruleforge.session import local_session
    s = local_session("local[4]", shuffle_partitions=4, app_name="ruleforge-tests",
                      checkpoint_dir=str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def atm(spark):
    from ruleforge.sources.files import read_csv_table
    df = read_csv_table(spark, os.path.join(FIXTURES, "transactions.csv"))
    df.createOrReplaceTempView("atm_transactions")
    return df


@pytest.fixture(scope="session")
def current_rules(spark):
    from ruleforge import RuleSet
    return RuleSet.from_path(spark, os.path.join(FIXTURES, "rules_current.json"))


@pytest.fixture(scope="session")
def legacy_rules(spark):
    from ruleforge import RuleSet
    return RuleSet.from_path(spark, os.path.join(FIXTURES, "rules_legacy.json"))


def rule(rule_id, when, then=("", ""), process="identification", process_key="query_builder",
         is_lookup=None, is_valid="true", valid_from="01/01/2021", valid_till="31/12/2999"):
    if is_lookup is None:
        is_lookup = "true" if process_key in ("query_lookup", "value_lookup", "groupby_lookup",
                                              "conditional") else "false"
    return {"id": rule_id, "name": "T", "description": rule_id, "is_valid": is_valid,
            "valid_from": valid_from, "valid_till": valid_till, "process": process,
            "process_key": process_key, "is_lookup": is_lookup, "when": when,
            "then": {"field_name": then[0], "field_value": then[1]}}


def cond(field, operator, value, join=""):
    return {"field_name": field, "operator": operator, "field_value": value, "join": join}


def keys(df, *cols):
    cols = cols or ("session_id", "id")
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
