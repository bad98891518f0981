"""The thin ``opN_*`` queries over the whole test tables, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (classifier, exact_dedup, hard_negatives, language_id, packing, paragraphs, quality_rules, ranked_search, secrets,
               simhash, token_counts, toxicity, transducer)
from .common import held_out, table


def tokenizer_file(name: str) -> str:
    """A vocabulary file of the installed public tokenizers; the operators take any path."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"), words=4, radius=4)
    return found.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = classifier.fit(docs, table(spark, sf_dir, "labels"))
    found = classifier.score(docs, weights)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= classifier.THRESHOLD).cast("int").alias("predicted"))


def op4_sentencepiece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.encode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest_columns(secrets.secret_spans(table(spark, sf_dir, "documents")))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_groups(table(spark, sf_dir, "documents"), digest_all=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_simhash_near_dedup, op3_quality_classifier, op4_sentencepiece_transducer,
    op5_secret_scans, op6_quality_rules, op7_best_fit_packing, op8_exact_dedup, op9_token_counts,
    op10_language_id, op11_toxicity, op12_hard_negatives, op13_ranked_search)}

ORACLE_SQL = {
    "op8_exact_dedup": r"""
        with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm
                   from documents),
             g as (select norm, min(doc_id) as keep_id, count(*) as group_size from t group by norm)
        select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.norm) as text_sha256
        from t join g on t.norm = g.norm""",
    "op12_hard_negatives": """
        with v as (select row_number() over () as r, vec_id, if(vec_id % 7 = 0, (label + 1) % 10, label) as label,
                          list_transform(embedding, lambda x: floor(256 * x::double)) as ints
                   from embeddings
                   where label is not null and embedding is not null
                     and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
             s as (select a.r as anchor, a.vec_id as anchor_id, a.label = b.label as same, b.r, b.vec_id,
                          list_inner_product(a.ints, b.ints)::bigint as score
                   from v a, v b where a.vec_id % 100 = 0 and a.r != b.r),
             p as (select * from s where same
                   qualify row_number() over (partition by anchor order by score desc, vec_id) <= 5),
             n as (select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score,
                          s.score as negative_score,
                          row_number() over (partition by p.anchor, p.r order by s.score desc, s.vec_id) as rank
                   from p join s on p.anchor = s.anchor and not s.same
                    and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score)
        select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score from n where rank <= 10""",
    "op13_ranked_search": r"""
        with words as (
               select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
               from documents),
             tf as (select doc_id, term, count(*) as tf from words group by doc_id, term),
             docs as (select doc_id, sum(tf)::bigint as n from tf group by doc_id),
             total as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from docs),
             terms as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
                       from tf, total group by term, n_docs),
             asked as (select item_id, unnest(regexp_extract_all(
                         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
             scored as (
               select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::bigint as score
               from asked join terms using (term) join tf using (term) join docs using (doc_id), total
               group by item_id, doc_id),
             ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank
                        from scored where score > 0)
        select item_id, rank::integer as rank, doc_id, score from ranked where rank <= 10""",
}
