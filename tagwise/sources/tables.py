"""Driver tables and the views every query reads (see FIXTURES.md part B).

Every view is a projection/aggregation of a driver table, so its work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Raw movie table contract (M1): explicit schema, never inferred.
MOVIE_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.LongType(), False),
        T.StructField("movie_name", T.StringType(), True),
        T.StructField("description", T.StringType(), True),
        T.StructField("genre", T.StringType(), True),
    ]
)

# fixed values: the per-label thresholds fixture (the labels from L8 on are absent on purpose -> global default)
THRESHOLD_FIXTURE = [
    ("L0", 0.40),
    ("L1", 0.45),
    ("L2", 0.50),
    ("L3", 0.55),
    ("L4", 0.60),
    ("L5", 0.65),
    ("L6", 0.70),
    ("L7", 0.50),
]
N_SCORE_LABELS = 64  # one label per embedding element


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy movie table over documents ⟕ labels: null/duplicate names, null texts and genres.

    The whole text is the name, so only exact copies are duplicates."""
    d = table(spark, sf_dir, "documents").alias("d")
    lab = table(spark, sf_dir, "labels").alias("l")
    j = d.join(lab, F.col("d.doc_id") == F.col("l.doc_id"), "left")
    genre_parts = F.concat_ws(
        " ,",
        F.when(F.col("d.lang") != "en", F.col("d.lang")),
        F.col("d.source"),
        F.when(F.col("l.quality") == 1, F.lit("quality")),
        F.when(F.col("l.toxic") == 1, F.lit("toxic")),
        F.concat(F.lit(" "), F.col("d.source")),
    )
    return j.select(
        F.col("d.doc_id").alias("row_id"),
        F.when(F.col("d.doc_id") % 83 == 0, F.lit(None).cast("string")).otherwise(F.col("d.text")).alias("movie_name"),
        F.when(F.col("d.doc_id") % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("d.text")).alias("description"),
        F.when(F.col("d.doc_id") % 89 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(genre_parts, F.lit(", ")))
        .alias("genre"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), F.col("p_name").alias("movie_name"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision scores (row_id, label_idx, score): every embedding element times ten."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("row_id"),
        F.posexplode("embedding").alias("label_idx", "x"),
    ).select("row_id", F.col("label_idx").cast("int").alias("label_idx"), (F.col("x").cast("double") * 10).alias("score"))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True labels (row_id, label_idx): {label, (label + vec_id) % 64}."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("row_id"),
        F.explode(F.array_distinct(F.array(F.col("label").cast("int"), ((F.col("label") + F.col("vec_id")) % N_SCORE_LABELS).cast("int")))).alias(
            "label_idx"
        ),
    )


def score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scored row (so rows without any true or predicted label are kept)."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"))


def label_names(spark: SparkSession) -> DataFrame:
    return spark.range(N_SCORE_LABELS).select(
        F.col("id").cast("int").alias("label_idx"), F.concat(F.lit("L"), F.col("id").cast("string")).alias("label")
    )


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(THRESHOLD_FIXTURE, "label string, threshold double")


def true_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("row_id"), F.col("label").cast("int").alias("true_idx"))


def pred_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arg-max of the elements (first maximum wins)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("row_id"),
        (F.array_position("embedding", F.array_max("embedding")) - 1).cast("int").alias("pred_idx"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("row_id"),
        F.when(F.col("doc_id") % 50 == 0, F.lit("")).otherwise(F.col("text")).alias("description"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validation score table (candidate, fold, train_score, val_score) from events."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(F.col("event_type").alias("candidate"), (F.col("user_id") % 5).cast("int").alias("fold")).agg(
        (F.avg("value") / 500).alias("val_score"),
        (F.max("value") / 1000).alias("train_score"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_totalprice").alias("metric"),
        F.col("o_orderstatus").alias("tag"),
        F.col("o_orderdate").alias("created_at"),
    )
