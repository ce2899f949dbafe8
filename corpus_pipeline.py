"""A corpus pipeline from text operators: documents in, token files out.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of documents. Decisions are joined
back by a number given to each row, or by id and text where they hang on these
alone, so repeated rows and further columns are kept as they are, whatever the
names of these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagwright.llm import jaccard, mixing, quality, templates, tokens
from tagwright.session import write_shared

# Near copies share four fifths of their five-word shingles.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep(docs, model)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows, stored with a number each, and the name of that column."""
    name = unused(docs, "row")
    return write_shared(docs.withColumn(name, F.monotonically_increasing_id())), name


def unused(docs: DataFrame, name: str) -> str:
    """``name``, longer by underscores if the table has a column of that name."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest id (null before
    all), then of the smallest text hash. Rows are linked by their texts alone,
    whatever their ids; of rows without words, one of each id and text stays."""
    rows, row = numbered(docs)
    groups = jaccard.jaccard_components(rows.select(F.col(row).alias("doc_id"), "text"), NEAR_WORDS, NEAR_PERCENT)
    groups = groups.select(F.col("doc_id").alias("node"), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("group"))
    named = rows.select(F.col(row).alias("node"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("key")).join(groups, "node")
    first = F.min(F.struct("id", "key", "node"))["node"].alias("node")
    linked = named.filter("group is not null").groupBy("group").agg(first).select("node")
    wordless = named.filter("group is null").groupBy("id", "key").agg(F.min("node").alias("node")).select("node")
    kept = linked.union(wordless).withColumnRenamed("node", unused(rows, "node"))
    return rows.join(kept, rows[row] == kept[kept.columns[0]], "left_semi").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    found = templates.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter("contaminated")
    leak, key = unused(docs, "leak"), unused(docs, "key")
    found = found.select(F.col("doc_id").alias(leak), F.col("text_key").alias(key)).distinct()
    same = docs["doc_id"].eqNullSafe(found[leak]) & (F.xxhash64(docs["text"]) == found[key])
    return docs.join(found, same, "left_anti")


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    rows, row = numbered(docs)
    taken, often, copy = unused(rows, "taken"), unused(rows, "often"), unused(rows, "copy")
    due = mixing.mix_sources(rows, keep=row).filter("copies > 0").select(F.col("kept").alias(taken), F.col("copies").alias(often))
    repeated = rows.join(due, rows[row] == due[taken])
    each = F.explode(F.sequence(F.lit(1).cast("long"), due[often])).alias(copy)
    return repeated.select(*[rows[c] for c in docs.columns], each).select(docs.columns)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, and what reading them back finds."""
    return tokens.token_files(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_to_targets),
    ("token-ID / binary output", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# Classifier and tokenizer are not expressible in SQL: tests/llm holds the
# stages against plain versions.
ORACLE_SQL = None
