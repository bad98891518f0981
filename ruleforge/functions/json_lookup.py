"""Named values stored as JSON objects, read with Spark's JSON functions.

Works on any string column holding a JSON object: a rule's ``lookup_value``
or a data column such as an event's ``props``. Values come back as text
(integers as written; other numbers in Spark's spelling, so ``1.10`` reads
``1.1`` and ``1E2`` reads ``100.0``; nested objects as their JSON text), missing
keys and malformed JSON give null.
"""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JSON_OBJECT_TYPE = "map<string,string>"
# keys a get_json_object bracket path reads exactly; anything else uses the parsed map
_PLAIN_KEY = re.compile(r"^[A-Za-z0-9_]([A-Za-z0-9_.\-]*[A-Za-z0-9_])?$")


def json_object(c: Column | str) -> Column:
    """Parse a JSON object into ``map<string,string>`` (null if not an object)."""
    return F.from_json(c, JSON_OBJECT_TYPE)


def json_value(c: Column | str, key: str | Column) -> Column:
    """Value of ``key`` in the JSON object in ``c`` (null when missing).

    A plain key is read with ``get_json_object`` and a bracket path, which
    stops at the key instead of building a map of the whole object; keys
    that a path cannot quote fall back to the parsed map.
    """
    if isinstance(key, str) and _PLAIN_KEY.match(key):
        return F.get_json_object(c if isinstance(c, Column) else F.col(c), f"$['{key}']")
    k = key if isinstance(key, Column) else F.lit(key)
    return F.try_element_at(json_object(c), k)


def json_typed(c: Column | str, path: str, dtype: str) -> Column:
    """The value at ``path`` (``$.a.b[0]``) of the JSON text in ``c`` as ``dtype``, keeping JSON's own types on the way:
    numbers are not read as text, nested objects may be taken as structs, arrays, maps or ``variant``. Null where the text
    is not JSON, the path is missing, the value is JSON null or does not convert."""
    return F.try_variant_get(F.try_parse_json(c if isinstance(c, Column) else F.col(c)), path, dtype)


def json_entries(c: Column | str) -> Column:
    """``array<struct<key,value>>`` of the object's entries (for ``inline``)."""
    return F.map_entries(json_object(c))


def parse_lookup_text(text: str | None) -> Any:
    """Driver-side parse of one rule's ``lookup_value`` (config, tiny)."""
    if text is None:
        raise ValueError("no lookup_value")
    return json.loads(text)


def lookup_table(rules) -> "DataFrame":
    """Every value-lookup rule's named values as rows
    ``(doc, rule_pos, id, value_key, value)``; rules whose ``lookup_value``
    is not a JSON object are left out (the validation report lists them)."""
    conds = rules.conditions_df()
    keyed = rules.catalog_df.where(F.col("process_key") == "value_lookup").select("doc", "rule_pos")
    return (conds.join(keyed, ["doc", "rule_pos"])
            .where(F.col("cond_pos") == 0)
            .select("doc", "rule_pos", "id",
                    F.inline(json_entries("lookup_value")).alias("value_key", "value")))
