"""The corpus pipeline: five stages over ``documents``, each calling one training-data operator.

Each stage takes (spark, docs, sf_dir), works on every row that the stage before kept and
returns the columns of ``docs``, the last one the token ids. Columns beside doc_id, text and
n_chars pass through as they are, whatever their names. Null texts count as empty and
stay where a stage doesn't reject them; an empty table passes through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlode.llm import bpe, decontam, neardup, pii, quality
from ledgerlode.llm.common import fresh, shared_dir, table


def _packed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows as one struct beside ``text``, so that an operator's columns can't clash with theirs."""
    (name,) = fresh(docs, "row")
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(name), "text"), name


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier predicts as 0; without labels to learn from, keeps all."""
    model = quality.training(spark, sf_dir)
    if model is None:
        return docs
    rows, name = _packed(docs)
    return quality.assess(rows, model, [name]).where("predicted = 1").select(f"{name}.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least doc_id of each near-duplicate class; repeated rows become one."""
    found = neardup.classes(docs)
    (h, g) = fresh(docs, "h", "g")
    own_h, own_g = neardup.keys()
    gone = found.where("not kept").select(F.col("h").alias(h), F.col("g").alias(g)).distinct()
    left = docs.withColumns({h: own_h, g: own_g}).join(gone, [h, g], "left_anti")
    return left.dropDuplicates([h, g]).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with words inside a benchmark window."""
    rows, name = _packed(docs)
    return decontam.annotate(rows, table(spark, sf_dir, "benchmark"), [name]).where("n_hit = 0").select(f"{name}.*")


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each personal-data span by its kind in brackets; n_chars follows."""
    (h, g, spans) = fresh(docs, "h", "g", "spans")
    own_h, own_g = neardup.keys()
    keyed = docs.withColumns({h: own_h, g: own_g})
    found = pii.find(keyed.select(F.col(h).alias("h"), F.col(g).alias("g"), "text"), ["h", "g"]).where(F.size("spans") > 0)
    found = found.groupBy("h", "g").agg(F.first("spans").alias("s")).select(F.col("h").alias(h), F.col("g").alias(g), F.col("s").alias(spans))
    part = "if(s.start < a.at, struct(a.out as out, greatest(a.at, s.end) as at), struct(concat(a.out, substring(text, cast(a.at as int) + 1, cast(s.start - a.at as int)), '[', upper(s.kind), ']') as out, s.end as at))"
    text = F.expr(f"aggregate(`{spans}`, struct('' as out, 0L as at), (a, s) -> {part}, a -> concat(a.out, substring(text, cast(a.at as int) + 1)))")
    marked = keyed.join(found, [h, g], "left").withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(text))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        marked = marked.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return marked.select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every document."""
    out = bpe.encode(docs, ["doc_id"])
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality classifier", keep_good),
    ("near-duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("personal data", without_pii),
    ("byte-level BPE", encoded),
]

#: SQL expresses neither the classifier nor the bootstrap.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    root = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
