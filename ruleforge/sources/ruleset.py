"""Rule documents: explicit schema, loaders and the catalog / conditions frames.

A rule document is ``{"rules": [rule, ...]}``. Every leaf is read as STRING
with an explicit schema -- never inferred -- so objects, arrays, numbers and
booleans keep their JSON text (``lookup_value`` may be a SQL tail in one rule
and an object in the next; an integer ``field_value`` stays ``"10000"``).

The document is configuration: tens to thousands of small rows. It is read
by Spark (any Hadoop path works), flattened with ``posexplode`` and collected
to the driver once per ``RuleSet``; the data the rules run on never is.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Condition (child) of a rule. Builder rules use field_name / operator /
# field_value / join; lookup rules use lookup_value (SQL tail or JSON text).
CONDITION_TYPE = T.StructType([
    T.StructField("field_name", T.StringType()),
    T.StructField("operator", T.StringType()),
    T.StructField("field_value", T.StringType()),
    T.StructField("join", T.StringType()),
    T.StructField("lookup_value", T.StringType()),
])

OUTCOME_TYPE = T.StructType([
    T.StructField("field_name", T.StringType()),
    T.StructField("field_value", T.StringType()),
])

RULE_TYPE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("is_valid", T.StringType()),
    T.StructField("valid_from", T.StringType()),
    T.StructField("valid_till", T.StringType()),
    T.StructField("process", T.StringType()),
    T.StructField("process_key", T.StringType()),
    T.StructField("key", T.StringType()),  # legacy name of process_key
    T.StructField("is_lookup", T.StringType()),
    T.StructField("when", T.ArrayType(CONDITION_TYPE)),
    T.StructField("then", OUTCOME_TYPE),
])

RULESET_SCHEMA = T.StructType([T.StructField("rules", T.ArrayType(RULE_TYPE))])


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()`` semantics: drop leading/trailing whitespace."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")  # (?U): Unicode whitespace, as str.strip()


def _blank(value: str | None) -> str:
    return "" if value is None else value


@dataclass(frozen=True)
class Condition:
    pos: int
    field_name: str
    operator: str
    field_value: str | None
    join: str
    lookup_value: str | None


@dataclass(frozen=True)
class Rule:
    pos: int
    id: str
    name: str
    description: str
    is_valid: str
    valid_from: str
    valid_till: str
    process: str
    process_key: str
    is_lookup: str
    conditions: tuple[Condition, ...] = field(default_factory=tuple)
    then_field: str = ""
    then_value: str = ""
    doc: str = ""        # source document key ...
    doc_pos: int = 0     # ... and position in it (catalog_df's doc, rule_pos)

    @property
    def is_goto(self) -> bool:
        return self.then_field == "goto"


class RuleSet:
    """A loaded rule document.

    ``doc_df`` holds the raw document rows (``doc`` = source file, ``rules:
    array<struct>``); ``rules_df``/``catalog_df``/``conditions_df`` are its
    flattened views, keyed by ``(doc, rule_pos)`` so a folder of several
    documents keeps every rule apart, and ``rules()`` is the driver-side list
    used to compile predicates (documents in path order, rules in document
    order). A folder behaves like one document concatenated in path order:
    ids (call selection, goto targets, duplicates) resolve across all files,
    the first usable rule winning.
    """

    def __init__(self, spark: SparkSession, doc_df: DataFrame):
        self.spark = spark
        self.doc_df = doc_df
        self._rules: list[Rule] | None = None
        self._by_id: dict[str, list[Rule]] | None = None

    # ---------------------------------------------------------------- loaders
    @classmethod
    def from_path(cls, spark: SparkSession, path: str) -> "RuleSet":
        """Read a (multi-line) JSON rule document from any Hadoop path.

        FAILFAST: with an explicit schema a malformed document would otherwise
        read silently as ``rules = null``.
        """
        doc = (spark.read.schema(RULESET_SCHEMA)
               .option("multiLine", True).option("mode", "FAILFAST").json(path)
               .select(F.col("_metadata.file_path").alias("doc"), "rules"))
        return cls(spark, doc)

    @classmethod
    def from_json_text(cls, spark: SparkSession, text: str) -> "RuleSet":
        doc = (spark.createDataFrame([(text,)], "doc string")
               .select(F.from_json("doc", RULESET_SCHEMA, {"mode": "FAILFAST"}).alias("d"))
               .select(F.lit("").alias("doc"), "d.rules"))
        return cls(spark, doc)

    @classmethod
    def from_rules(cls, spark: SparkSession, rules: Iterable[dict[str, Any]] | dict[str, Any]) -> "RuleSet":
        """Build from Python dicts shaped like the JSON document."""
        doc = rules if isinstance(rules, dict) else {"rules": list(rules)}
        return cls.from_json_text(spark, json.dumps(doc))

    @classmethod
    def from_dataframe(cls, doc_df: DataFrame) -> "RuleSet":
        """Wrap a DataFrame with a ``rules`` column of RULE_TYPE (one row per
        document) and optionally a ``doc`` column naming and ordering them.

        The documents are configuration (small): they are numbered on the
        driver -- by ``doc`` when given (null or repeated names are refused),
        else in the order Spark returns them -- and keyed ``<ordinal>:<name>``,
        so every rule gets a unique, stable, traceable key however often the
        frame is re-read.
        """
        spark = doc_df.sparkSession
        rules_type = RULESET_SCHEMA["rules"].dataType
        text = F.to_json(F.struct(F.col("rules").cast(rules_type).alias("rules")))
        if "doc" in doc_df.columns:
            rows = doc_df.select("doc", text).collect()
            names = [r[0] for r in rows]
            if any(n is None for n in names) or len(set(names)) != len(names):
                raise ValueError("every rule document needs its own non-null doc value")
            rows.sort(key=lambda r: r[0])
            named = [(f"{i:09d}:{r[0]}", r[1]) for i, r in enumerate(rows)]
        else:
            named = [(f"{i:09d}", r[0]) for i, r in enumerate(doc_df.select(text).collect())]
        numbered = spark.createDataFrame(named, "doc string, text string")
        return cls(spark, numbered.select("doc", F.from_json("text", RULESET_SCHEMA)["rules"].alias("rules")))

    # ------------------------------------------------------------------ frames
    @property
    def rules_df(self) -> DataFrame:
        """One row per rule; ``rule_pos`` is its position in document ``doc``."""
        return (self.doc_df
                .select("doc", F.posexplode("rules").alias("rule_pos", "rule"))
                .select("doc", "rule_pos", "rule.*"))

    @staticmethod
    def _header_columns() -> list[Column]:
        return [
            strip_ws(F.col("id")).alias("id"),
            strip_ws(F.col("name")).alias("name"),
            strip_ws(F.col("description")).alias("description"),
            strip_ws(F.col("is_valid")).alias("is_valid"),
            strip_ws(F.col("valid_from")).alias("valid_from"),
            strip_ws(F.col("valid_till")).alias("valid_till"),
            strip_ws(F.col("process")).alias("process"),
            strip_ws(F.coalesce(F.col("process_key"), F.col("key"))).alias("process_key"),
            strip_ws(F.col("is_lookup")).alias("is_lookup"),
            strip_ws(F.col("then.field_name")).alias("field_name"),
            strip_ws(F.col("then.field_value")).alias("field_value"),
        ]

    @property
    def catalog_df(self) -> DataFrame:
        """Rule header, trimmed, legacy ``key`` folded into ``process_key`` and
        the outcome flattened into ``field_name``/``field_value``."""
        return self.rules_df.select(
            "doc", "rule_pos", *self._header_columns(),
            F.coalesce(F.size("when"), F.lit(-1)).alias("n_conditions"))

    def conditions_df(self, outer: bool = False) -> DataFrame:
        """One row per condition with its position (order is semantic).

        The inner form drops rules with an empty ``when``; ``outer=True``
        keeps them with null condition columns (used by validation).
        """
        explode = F.posexplode_outer if outer else F.posexplode
        return (self.rules_df
                .select("doc", "rule_pos", strip_ws(F.col("id")).alias("id"),
                        explode("when").alias("cond_pos", "c"))
                .select("doc", "rule_pos", "id", "cond_pos",
                        strip_ws(F.col("c.field_name")).alias("field_name"),
                        strip_ws(F.col("c.operator")).alias("operator"),
                        F.col("c.field_value").alias("field_value"),
                        strip_ws(F.col("c.join")).alias("join"),
                        F.col("c.lookup_value").alias("lookup_value")))

    # ------------------------------------------------------------ driver list
    def rules(self) -> list[Rule]:
        """The rule list on the driver (config only; collected once)."""
        if self._rules is None:
            conds = F.transform(
                F.coalesce(F.col("when"), F.array().cast(T.ArrayType(CONDITION_TYPE))),
                lambda c, i: F.struct(
                    i.alias("pos"),
                    strip_ws(c["field_name"]).alias("field_name"),
                    strip_ws(c["operator"]).alias("operator"),
                    c["field_value"].alias("field_value"),
                    strip_ws(c["join"]).alias("join"),
                    c["lookup_value"].alias("lookup_value")))
            rows = (self.rules_df
                    .select("doc", "rule_pos", *self._header_columns(), conds.alias("conds"))
                    .collect())
            rows.sort(key=lambda r: (r["doc"] or "", r["rule_pos"]))
            out = []
            for pos, r in enumerate(rows):
                out.append(Rule(
                    pos=pos, id=_blank(r["id"]), name=_blank(r["name"]),
                    description=_blank(r["description"]), is_valid=_blank(r["is_valid"]),
                    valid_from=_blank(r["valid_from"]), valid_till=_blank(r["valid_till"]),
                    process=_blank(r["process"]), process_key=_blank(r["process_key"]),
                    is_lookup=_blank(r["is_lookup"]),
                    conditions=tuple(
                        Condition(pos=c["pos"], field_name=_blank(c["field_name"]),
                                  operator=_blank(c["operator"]), field_value=c["field_value"],
                                  join=_blank(c["join"]), lookup_value=c["lookup_value"])
                        for c in r["conds"]),
                    then_field=_blank(r["field_name"]), then_value=_blank(r["field_value"]),
                    doc=r["doc"] or "", doc_pos=r["rule_pos"]))
            self._rules = out
        return self._rules

    def rule_count(self) -> int:
        """Number of rules; from the driver list when it is loaded already,
        otherwise counted by Spark without collecting the document."""
        if self._rules is not None:
            return len(self._rules)
        return self.rules_df.count()

    def rule_ids(self) -> list[str]:
        return [r.id for r in self.rules()]

    def find(self, rule_id: str) -> list[Rule]:
        """All rules with this id, document order."""
        if self._by_id is None:
            index: dict[str, list[Rule]] = {}
            for r in self.rules():
                index.setdefault(r.id, []).append(r)
            self._by_id = index
        return list(self._by_id.get(rule_id.strip(), ()))
