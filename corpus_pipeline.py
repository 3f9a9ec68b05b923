"""From raw documents to packed training sequences.

Five stages, each one operator of ``isoclime.llm`` applied to all its predecessor kept. Rows are told apart
by (doc_id, text), so null or repeated ids and extra columns do no harm; the first four stages return the
columns they were given, with their values, whatever their names. Of rows that share doc_id and text (up to A-Z
case, from stage 2 on), the one with the least text, then the least hash of all its columns, stands for all.

1. language_id: documents that have no language (null text, or no letter) go; a null ``lang`` is filled in.
2. exact_dedup: of texts equal up to A-Z case, the row with the largest doc_id stays (null is below all).
3. simhash_near_dedup: of each component of near copies (linked by a Jaccard similarity of 0.8 or more of their
   sets of 5-word shingles, verified exactly), the row with the smallest doc_id stays (null only if
   there is no other). Candidates are what three
   64-bit fingerprints link within 30 of their 192 bits, and what shares a MinHash band.
4. curriculum_mix: documents appear once for every pass of the mix they are in, in training order; one
   that the mix takes in part appears whole.
5. pack_best_fit: token pieces of full sequences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoclime.llm.common import lower_ascii, materialize, partitions, table
from isoclime.llm.exact_dedup import exact_dedup
from isoclime.llm.language import fit, identify
from isoclime.llm.mixing import curriculum
from isoclime.llm.packing import pack
from isoclime.llm.simhash import jaccard_components
from isoclime.session import mark, release

NEAR_DUP_WORDS, NEAR_DUP_WIDTH, NEAR_DUP_BITS, NEAR_DUP_JACCARD = 5, 3, 30, 0.8


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _row_key(nulls: str) -> Column:
    """What tells rows apart, in order of doc_id; ``nulls`` is first or last."""
    rank = F.col("doc_id").isNull() if nulls == "last" else F.col("doc_id").isNotNull()
    return F.struct(rank.alias("rank"), F.col("doc_id").alias("id"), F.sha2(lower_ascii(F.col("text")), 256).alias("sha"))


def _join_key(key: Column) -> Column:
    return F.concat_ws(":", F.coalesce(key["id"].cast("string"), F.lit("null")), key["sha"])


def _only(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is in ``keys`` (column key), one for each key.

    Rows that share a key meet before the join, in partial aggregates, so a hot key is never one task's load.
    """
    k, row = _fresh(docs, "_k"), F.struct(*(F.col(c) for c in docs.columns))
    order = F.struct("text", F.xxhash64(*(f.name for f in docs.schema if f.dataType.typeName() not in ("map", "variant"))))
    one = docs.withColumn(k, _join_key(_row_key("last"))).groupBy(k).agg(F.min_by(row, order).alias("row"))
    kept = one.join(keys.select(_join_key(F.col("key")).alias(k)).distinct(), k, "left_semi")
    return kept.select("row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lang, score = _fresh(docs, "lang_pred"), _fresh(docs, "score")
    model = fit(docs.select("doc_id", "text", "lang"))
    found = identify(docs, model, lang_pred=lang, score=score)
    known = (F.col(lang) != "und") if model.families else F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    out = found.filter(known).withColumn("lang", F.coalesce("lang", F.nullif(lang, F.lit("und"))))
    return out.select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = exact_dedup(docs.select(_row_key("first").alias("key"), "text"), key="key")
    return _only(docs, rows.filter("kept").select("key"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = docs.select(_row_key("last").alias("key"), "text")
    rows = jaccard_components(keyed, "text", "key", NEAR_DUP_WORDS, NEAR_DUP_JACCARD, NEAR_DUP_BITS, NEAR_DUP_WIDTH)
    return _only(docs, rows.filter("key = component_id").select("key"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    k, at, t = (_fresh(docs, name) for name in ("_k", "_at", "_t"))
    keyed = docs.withColumn(k, _join_key(_row_key("last")))
    plan = curriculum(keyed.select(k, "text", "source"), key=k).filter("copies > 0")
    plan = plan.groupBy(k).agg(F.min(F.struct("position", "position_2")).alias(at))
    rows = keyed.join(plan, k).withColumn(t, F.explode(F.array_compact(F.array(f"{at}.position", f"{at}.position_2"))))
    order = [F.col(t), F.md5(k), F.col(k)]
    return rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("curriculum_mix", mix),
    ("pack_best_fit", pack_sequences),
]

#: The language model, fingerprints and tokenizer have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what a stage wrote for itself, and its input, is deleted once its output is written."""
    docs, begin = table(spark, sf_dir, "documents"), mark()
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        release(spark, begin, keep_last=True)
    return STAGES[-1][1](spark, docs, sf_dir)
