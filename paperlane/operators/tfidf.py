"""TF-IDF: vocabulary as an aggregate, vectors row by row."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperlane.sources import batches


def term_counts(df: DataFrame, tokens: str) -> DataFrame:
    """``term`` with its corpus frequency ``cf`` and document frequency ``df``.

    One pass and one shuffle: each document sends its tokens with weight (1, 0) and its distinct
    tokens with weight (0, 1), and these are summed per task before they travel.
    """
    occurrences = F.transform(
        tokens, lambda t: F.struct(t.alias("term"), F.lit(1).alias("cf"), F.lit(0).alias("df"))
    )
    presences = F.transform(
        F.array_distinct(tokens),
        lambda t: F.struct(t.alias("term"), F.lit(0).alias("cf"), F.lit(1).alias("df")),
    )
    return sum_counts(df.select(F.inline(F.concat(occurrences, presences))))


def sum_counts(counts: DataFrame) -> DataFrame:
    """One row per term from partial counts."""
    return counts.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


def select_terms(
    terms: DataFrame, documents: Column, max_features: int = 200, min_df: int = 2, max_df: float = 0.95
) -> DataFrame:
    """The vocabulary, from the counts of all terms and the number of documents."""
    kept = (
        terms.withColumn("_n", documents)
        .filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * F.col("_n")))
        .orderBy(F.desc("cf"), "term")
        .limit(max_features)
    )
    idf = F.ln((F.lit(1.0) + F.col("_n")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    # at most max_features rows
    position = F.row_number().over(Window.orderBy("term")) - 1
    return kept.select("term", position.alias("idx"), "cf", "df", idf.alias("idf"))


def vocabulary(
    df: DataFrame, tokens: str, max_features: int = 200, min_df: int = 2, max_df: float = 0.95
) -> DataFrame:
    """Terms with corpus frequency, document frequency, smoothed idf and position.

    Of the terms in at least ``min_df`` documents and at most the share ``max_df`` of them, the
    ``max_features`` most frequent are kept, the smaller term winning a tie. idf is
    ``ln((1 + n) / (1 + df)) + 1``; positions follow the alphabet.
    """
    documents = df.agg(F.count("*")).scalar()
    return select_terms(term_counts(df, tokens), documents, max_features, min_df, max_df)


class GrowingCounts:
    """Term counts of a corpus that grows by batches of new documents.

    Each batch is read once, when it comes: its counts are kept as a batch of partial sums, together with
    its number of documents, so both are there or neither. The vocabulary is chosen from the sums; no
    earlier text is read again. What is kept is as large as the vocabularies of the batches.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def add(self, df: DataFrame, tokens: str, batch: str) -> bool:
        """Count a batch; False if it has been counted."""
        documents = df.agg(F.count("*").alias("n"))
        return batches.append_batch(self.spark, {"terms": term_counts(df, tokens), "documents": documents}, self.root, batch)

    def counts(self) -> DataFrame:
        return sum_counts(batches.read_committed(self.spark, self.root, "terms", "term string, cf bigint, df bigint"))

    def documents(self) -> Column:
        """Number of documents of all batches."""
        rows = batches.read_committed(self.spark, self.root, "documents", "n bigint")
        return rows.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()

    def vocabulary(self, max_features: int = 200, min_df: int = 2, max_df: float = 0.95) -> DataFrame:
        """The same as ``vocabulary`` of all documents so far."""
        return select_terms(self.counts(), self.documents(), max_features, min_df, max_df)

    def merge(self) -> str | None:
        """Sum up the partial counts, one row per term again."""
        total = {"terms": sum_counts, "documents": lambda rows: rows.agg(F.sum("n").alias("n"))}
        return batches.merge_batches(self.spark, self.root, total)


def vectorizer(vocab: DataFrame, tokens: str, features: str = "features") -> PipelineModel:
    """Model that turns tokens into L2-normed TF-IDF vectors, one row at a time.

    Unknown terms are ignored; a document without a known term becomes the zero vector. The model
    holds the vocabulary, as many terms as ``max_features`` asked for, and passes through the driver;
    ``weights`` gives the same numbers without a model.
    """
    rows = vocab.orderBy("idx").collect()
    if not rows:
        raise ValueError("empty vocabulary")
    counts = CountVectorizerModel.from_vocabulary([row["term"] for row in rows], tokens, "_counts")
    weights = ElementwiseProduct(
        scalingVec=Vectors.dense([row["idf"] for row in rows]),
        inputCol="_counts", outputCol="_weights",
    )
    norm = Normalizer(p=2.0, inputCol="_weights", outputCol=features)
    return PipelineModel(stages=[counts, weights, norm])


def vectorize(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the vector column; no shuffle."""
    return model.transform(df).drop("_counts", "_weights")


def weights(df: DataFrame, key: str, tokens: str, vocab: DataFrame) -> DataFrame:
    """Long form ``(key, term, weight)`` of the same vectors, for a vocabulary of any size.

    A document without a known term has one row, with neither term nor weight. Equal terms of a
    document are one row before the join; rows with the same key count as one document.
    """
    counts = df.select(key, F.explode(tokens).alias("term")).groupBy(key, "term").agg(F.count("*").alias("_tf"))
    known = counts.join(vocab.select("term", "idf"), "term").withColumn("_w", F.col("_tf") * F.col("idf"))
    lengths = known.groupBy(key).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"))
    weighted = known.join(lengths, key).select(key, "term", (F.col("_w") / F.col("_norm")).alias("weight"))
    return df.select(key).distinct().join(weighted, key, "left")
