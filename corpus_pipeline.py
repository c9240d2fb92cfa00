"""From raw documents to training tokens: five stages, each one of the training-data operators.

A stage gets what its predecessor kept, read back from Parquet, and returns the columns of documents;
the last one adds tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlane.llm import bpe, decontamination, jaccard, langid, pii
from paperlane.llm.queries import VOCABULARIES
from paperlane.llm.registry import table
from paperlane.llm.tasks import tune_batches
from paperlane.session import materialize

FEW = 0.0005  # share of labelled documents that may lie below the cosine from which the floor follows
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_floor(scored: DataFrame) -> float:
    """Half of the cosine that all but a few (``FEW``) of the documents with a label reach; 0 without any.

    Cosines are counted in thousandths over all rows, so the result is exact and the same in every run. Short
    clean texts have low cosines too, hence the half.
    """
    cosine = F.floor(F.col("_cosine_") * 1000).cast("int").alias("cosine")
    bins = scored.filter("lang IS NOT NULL AND _letters_").groupBy(cosine).agg(F.count("*").alias("n"))
    # at most a thousand and one rows
    counts = sorted((row["cosine"], row["n"]) for row in bins.collect())
    left = FEW * sum(n for _, n in counts)
    for value, n in counts:
        left -= n
        if left < 0:
            return value / 2000
    return 0.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are in no known language: without a letter, or less like every language than
    hardly any document with a label is like its nearest one. A missing label is filled in, others stay.

    Where no document has a label there is nothing to learn, and only those without a letter go.
    """
    tune_batches(spark)
    known = langid.profiles(docs, "text", "lang")

    def judged(some: DataFrame, keep: tuple[str, ...]) -> DataFrame:
        found = langid.identify(some, "text", known, out="_language_", score="_cosine_", keep=keep)
        letters = F.col("_language_") != langid.UNKNOWN if known else F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
        return found.withColumn("_letters_", letters)

    # labelled texts are read twice, which takes less than keeping a copy of all texts until the floor is known
    floor = language_floor(judged(docs.filter("lang IS NOT NULL"), ("lang",))) if known else 0.0
    some = judged(docs, COLUMNS).filter(F.col("_letters_") & (F.col("_cosine_") >= floor))
    guessed = F.when(F.col("_language_") != langid.UNKNOWN, F.col("_language_"))
    return some.withColumn("lang", F.coalesce("lang", guessed)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    tune_batches(spark)
    return jaccard.one_of_each(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    found = decontamination.contamination(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.filter("NOT contaminated").select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind."""
    tune_batches(spark)
    found = pii.detect(docs, "text", pii.learn(docs, "text"), spans="_spans_", masked="_masked_", keep=COLUMNS)
    masked = F.when(F.col("text").isNotNull(), F.col("_masked_")).alias("text")
    changed = found.select("doc_id", masked, "lang", "source", (F.size("_spans_") > 0).alias("changed"), "n_chars")
    n_chars = F.when(F.col("changed"), F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return changed.withColumn("n_chars", n_chars).select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode each text, and tell whether decoding gives it back."""
    tune_batches(spark)
    found = bpe.round_trip(docs, "text", f"{VOCABULARIES}/byte_bpe_50k.json", ids="ids", decoded="_decoded_", keep=COLUMNS)
    same = F.col("_decoded_") == F.coalesce("text", F.lit(""))
    return found.select(*COLUMNS, F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("tokens", encode_tokens),
]

# No SQL finds near duplicates or encodes tokens; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
