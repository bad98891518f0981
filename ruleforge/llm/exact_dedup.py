"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` becomes
one space; null counts as empty.

1. One scan reduces each row to (length, hash of the first ``prefix`` characters).
2. Lengths that occur once are settled; of the rest, (length, prefix hash)
   pairs that occur once are settled. Both counts are combined map-side.
3. Rows whose pair is left have their full content hashed (SHA-256), and groups are
   formed on (length, full hash). While the pairs left are few enough to broadcast,
   no other content is hashed; beyond that every row is hashed where it is read,
   because moving texts to a join costs more than hashing them.

Defined results: a null text is the empty text; all empty texts are one group;
a ``doc_id`` that repeats with an equal text is one document that stays
(``same_id`` counts its rows); an empty table gives no rows; extra columns are
ignored by ``exact_groups`` and kept by ``keep_one``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, SPACE_CLASS, bounded, id_text, saved

PREFIX = 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+", " ")


def exact_groups(docs: DataFrame, prefix: int = PREFIX, digest_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, same_id, text_sha256.

    ``text_sha256`` (binary) is null for rows settled before the full hash,
    unless ``digest_all`` asks for it on every row.
    """
    keyed = (id_text(docs).select("doc_id", normalised(F.col("text")).alias("t"))
             .select("doc_id", "t", F.length("t").alias("len"),
                     F.xxhash64(F.substring("t", 1, prefix)).alias("head")))
    # length 0 has no content to tell apart, longer ones go on to the prefix
    pairs = keyed.groupBy("len", "head").agg(F.count("*").alias("n"))
    lengths = pairs.groupBy("len").agg(F.sum("n").alias("n_len")).where("n_len > 1").select("len")
    left = saved(pairs.where("n > 1").join(lengths, "len", "left_semi")
                 .select("len", "head", F.lit(True).alias("again")), "exact-pairs")
    full, again = F.unhex(F.sha2(F.col("t").cast("binary"), 256)), F.coalesce("again", F.lit(False))
    if digest_all or left.count() > BROADCAST_ROWS:
        # every text is hashed where it is read: the join moves no text, however many pairs are left
        hashed = (keyed.select("doc_id", "len", "head", full.alias("digest")).join(left, ["len", "head"], "left")
                  .select("doc_id", "len", again.alias("again"), "digest"))
    else:
        hashed = (keyed.join(F.broadcast(left), ["len", "head"], "left")
                  .select("doc_id", "len", again.alias("again"), F.when(again, full).alias("digest")))
    hashed = saved(hashed, "exact-hashed")
    again, alone = hashed.where("again"), hashed.where("not again")
    ids = again.groupBy("len", "digest", "doc_id").agg(F.count("*").alias("same_id"))
    groups = ids.groupBy("len", "digest").agg(F.min("doc_id").alias("keep_id"), F.sum("same_id").alias("group_size"))
    # a table of its own, so that the join back may split a group with very many copies
    found = again.join(saved(groups, "exact-groups"), ["len", "digest"])
    many = ids.where("same_id > 1").select("len", "digest", "doc_id", "same_id")
    found = (found.join(many, (found.len == many.len) & (found.digest == many.digest)
                        & found.doc_id.eqNullSafe(many.doc_id), "left")
             .select(found.doc_id, "keep_id", "group_size", found.doc_id.eqNullSafe(F.col("keep_id")).alias("kept"),
                     F.coalesce("same_id", F.lit(1)).cast("bigint").alias("same_id"), found.digest))
    return found.unionByName(alone.select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), F.lit(1).cast("bigint").alias("same_id"), "digest"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are.

    A doc_id that repeats with equal texts (``same_id`` above 1) is narrowed to
    one of its rows; only those rows are shuffled whole.
    """
    ids = saved(exact_groups(docs).groupBy("doc_id").agg(
        F.max("kept").alias("kept"), F.max(F.when(F.col("kept"), F.col("same_id"))).alias("same_id")), "exact-ids")
    key = docs["doc_id"]

    def with_ids(some: DataFrame, how: str) -> DataFrame:
        some = bounded(some.select(F.col("doc_id").alias("__id")))
        return docs.join(some, key.eqNullSafe(F.col("__id")), how)

    one = with_ids(ids.where("not kept or same_id > 1"), "left_anti")
    several = with_ids(ids.where("kept and same_id > 1"), "left_semi")
    shrunk = several.withColumn("__same", F.sha2(normalised(F.col("text").cast("string")).cast("binary"), 256))
    return one.unionByName(shrunk.dropDuplicates(["doc_id", "__same"]).drop("__same"))
