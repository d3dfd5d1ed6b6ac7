"""Stages of the corpus pipeline: one operator each, returning whole documents.

Decisions are made on slim rows and taken back to the documents by id and text, so rows
equal in both fare alike and other columns, whatever their names, go through unchanged.

Defined cases, in all stages: without documents there are no rows; null ids, languages and
sources are values like others; texts are taken whole, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm import decontaminate as benchmark_hits
from headway.llm import jaccard, mixing, quality, sharding
from headway.llm.common import bit_table, fresh, in_table_column, written


def _key(*columns: str) -> Column:
    """The columns, and hashes of the text, for comparing rows of a stage."""
    text = F.coalesce(F.encode("text", "UTF-8"), F.lit(b"\x00null"))
    return F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], F.xxhash64(text).alias("h1"), F.md5(text).alias("h2"))


def _matched(docs: DataFrame, keys: DataFrame, key: Column, how: str) -> DataFrame:
    """Semi or anti join of documents with the keys in the first column of a frame.

    A bit table tells most documents that have no key among these, and their texts are not
    shuffled; the join settles the others.
    """
    (name,) = fresh(docs, "_key")
    marked = docs.withColumn(name, key)
    sought = written(keys.select(F.col(keys.columns[0]).alias(f"{name}_sought")).distinct(), "keys", slim=True)
    table = bit_table(sought.select(F.col(f"{name}_sought.h1").alias("h1")), "h1")
    maybe = in_table_column(docs.sparkSession, table, f"{name}.h1")
    found = marked.where(maybe).join(sought, F.col(name).eqNullSafe(F.col(f"{name}_sought")), how)
    return (marked.where(~maybe).unionByName(found) if how == "left_anti" else found).drop(name)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep: null, empty and very short texts have too few words and go."""
    key = _key("doc_id", "lang", "source")
    found = written(quality.counted(docs.select("lang", "source", "text", key.alias("key")), ["key", "lang", "source"]), "quality")
    return _matched(docs, quality.judged(found, "key").where("NOT kept").select("key"), key, "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles agree by 0.8: that of the least id, null first.

    Of several texts with that id the one whose hash is least stays, and one of rows equal in
    id and text; rows without words all stay.
    """
    key = _key("doc_id")
    slim = docs.select(key.alias("key"), "text")
    found = written(jaccard.jaccard_components(slim, n=5, num=80, den=100, doc_id="key"), "components")
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id")
    kept = _matched(docs, gone, key, "left_anti")
    again = written(found.where("n_shingles > 0").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    (name,) = fresh(docs, "_key")
    single = _matched(kept, again, key, "left_semi").withColumn(name, key).dropDuplicates([name]).drop(name)
    return _matched(kept, again, key, "left_anti").unionByName(single)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't contaminated by the folder's benchmark.

    Null and empty texts have no words and stay, as all documents do beside an empty benchmark.
    """
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    key = _key("doc_id")
    found = benchmark_hits.decontamination(docs.select("text", key.alias("key")), benchmark, doc_id="key")
    return _matched(docs, found.where("contaminated").select("key"), key, "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, up to three times.

    Null and empty texts cost nothing and are taken at their source's rate; repeated rows share their copies.
    """
    key = _key("doc_id", "source")
    found = mixing.mix(docs.select("source", "text", key.alias("key")), keep=["key"])
    taken = found.groupBy("key").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0")
    name, copies, rows, nth = fresh(docs, "_key", "_copies", "_rows", "_nth")
    taken = taken.select(F.col("key").alias(f"{name}_taken"), F.col("copies").alias(copies), F.col("rows").alias(rows))
    marked = docs.withColumn(name, key)
    joined = marked.join(taken, marked[name].eqNullSafe(taken[f"{name}_taken"]))
    # Rows equal in id, source and text share their copies.
    ranked = joined.withColumn(nth, F.row_number().over(Window.partitionBy(name).orderBy(F.lit(0))))
    own = F.floor(F.col(copies) / F.col(rows)) + (F.col(nth) <= F.col(copies) % F.col(rows)).cast("long")
    return ranked.withColumn(copies, own).where(F.col(copies) > 0).withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*[F.col(f"`{c}`") for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix; a null text counts as empty, copies are neighbours."""
    return sharding.shard(docs)
