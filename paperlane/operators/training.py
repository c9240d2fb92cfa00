"""Splits, folds, the forest and its out-of-fold scores."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from paperlane.functions.numbers import round_even
from paperlane.operators import forests
from paperlane.operators.order import shuffled_rank
from paperlane.session import materialize

SMALL = 10_000  # training rows up to which a forest is grown by one fit
TREES_PER_PART = 10
ROWS_PER_TASK = 250_000  # training rows that a task of a part reads
TASKS = 16  # tasks that the parts which grow at a time may have together
FOLDS_AT_ONCE = 2  # folds whose trees are grown by tasks

Part = RandomForestClassificationModel | forests.GrownTrees
Forest = RandomForestClassificationModel | Sequence[Part]


def stratified_split(
    df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split``: exactly ``round(share * n)`` rows of each class are ``test``."""
    ranked = shuffled_rank(df, [label], key, seed, "_rank", "_size")
    n_test = round_even(F.lit(test_share) * F.col("_size"), 0)
    split = F.when(F.col("_rank") <= n_test, "test").otherwise("train")
    return ranked.select(*df.columns, split.alias("split"))


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1; the folds of a class differ by one row at most."""
    ranked = shuffled_rank(df, [label], key, seed, "_rank", "_size")
    return ranked.select(*df.columns, ((F.col("_rank") - 1) % k).cast("int").alias("fold"))


def class_sizes(df: DataFrame, label: str, part: str) -> DataFrame:
    """Rows per part and class with the share of the class in its part."""
    counts = df.groupBy(part, label).agg(F.count("*").alias("n_rows"))
    # one row per part and class
    total = F.sum("n_rows").over(Window.partitionBy(part))
    return counts.withColumn("share", F.col("n_rows") / total)


def forest(
    trees: int = 100, max_depth: int = 30, seed: int = 42, features: str = "features",
    label: str = "label", **settings,
) -> RandomForestClassifier:
    """Random forest with the square root of the features tried per split.

    Trees go as deep as Spark allows. Splits are found on binned features, so single scores differ
from a forest with exact splits; quality is comparable. Further ``settings`` are those of
    Spark's classifier.
    """
    return RandomForestClassifier(
        numTrees=trees, maxDepth=max_depth, seed=seed, featureSubsetStrategy="sqrt",
        featuresCol=features, labelCol=label, **{"cacheNodeIds": True, **settings},
    )


def positive_probability(column: str = "probability") -> Column:
    """Probability of class 1."""
    return vector_to_array(F.col(column))[1]


def _parts(classifier: RandomForestClassifier, df: DataFrame, small: int, per_task: int) -> tuple[list, DataFrame, int]:
    """The classifiers of the parts of a forest, the rows for each of them, and how many may grow at a time; 0 for one part."""
    trees, seed = classifier.getNumTrees(), classifier.getSeed()
    n = df.count()
    if n <= small or trees <= TREES_PER_PART:
        return [classifier], df, 0
    tasks = -(-n // per_task)
    parts = [
        # bootstraps are seeded by seed and task, so seeds lie far apart
        classifier.copy({classifier.numTrees: min(TREES_PER_PART, trees - done), classifier.seed: seed + 10_000 * done})
        for done in range(0, trees, TREES_PER_PART)
    ]
    return parts, df.coalesce(tasks), max(1, TASKS // tasks)


def grow(
    classifier: RandomForestClassifier, df: DataFrame, small: int = SMALL, per_task: int = ROWS_PER_TASK
) -> list[Part]:
    """Grow a forest, in parts of ten trees each if there are more than ``small`` rows.

    The trees of the parts are grown by tasks (``forests.grow``) and stay in a table, so the driver holds none of them.
    Rows are read several times, so they should have been written.

    Settings and labels that tasks do not know (weights, categories, other measures or shares of features, more than
    two classes) are left to Spark's fits. Each task that reads rows sends statistics of all nodes of its trees there,
    however few of its rows they hold, so one fit costs nodes times tasks. A part is read by few tasks, one per
    ``per_task`` rows, and parts grow side by side instead. In both ways all rows take part in the bootstrap of every tree.
    """
    parts, rows, width = _parts(classifier, df, small, per_task)
    if width and forests.fits(classifier, df):
        grown = forests.grow(classifier, df, [part.getNumTrees() for part in parts])
        if grown is not None:
            return grown
    with ThreadPoolExecutor(max(1, width)) as pool:
        return list(pool.map(inheritable_thread_target(df.sparkSession)(lambda part: part.fit(rows)), parts))


def _models(forest: Forest) -> list[Part]:
    return [forest] if isinstance(forest, RandomForestClassificationModel) else list(forest)


def _grown(trees: Sequence[Part]) -> bool:
    return isinstance(trees[0], forests.GrownTrees)


def score(model: Forest, df: DataFrame) -> DataFrame:
    """Add ``y_pred_prob``, the mean vote of all trees; all other columns, the key among them, stay in place.

    Of a forest in parts, each part scores in a job of its own, which is sent with its trees alone. Trees that tasks have
    grown score in jobs that are sent with a bounded number of bytes.
    """
    kept, parts = df.columns, _models(model)
    if _grown(parts):
        trees = [tree for part in parts for tree in part.trees]
        total = F.lit(0.0)
        for some in forests.in_turns(trees, len(trees)):
            votes, sent = forests.asked(df.sparkSession, some)
            summed = total + F.aggregate(votes, F.lit(0.0), lambda x, y: x + y)
            df = materialize(df.select(*kept, summed.alias("_total")), "part_scores")
            sent.destroy()
            total = F.col("_total")
        return df.select(*kept, (total / len(trees)).alias("y_pred_prob"))
    if len(parts) == 1:
        scored = parts[0].transform(df).withColumn("y_pred_prob", positive_probability())
        return scored.select(*kept, "y_pred_prob")
    total, trees = F.lit(0.0), sum(part.getNumTrees for part in parts)
    for part in parts:
        alone = part.copy().setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_part")
        summed = total + positive_probability("_part") * part.getNumTrees
        df = materialize(alone.transform(df).select(*kept, summed.alias("_total")), "part_scores")
        total = F.col("_total")
    return df.select(*kept, (total / trees).alias("y_pred_prob"))


def tree_votes(model: Forest, df: DataFrame, at_once: int = 10) -> DataFrame:
    """Add ``votes``: what each tree alone says of class 1, in the order of the trees. Their mean is the score.

    A job is sent with the trees it asks, so a few vote ``at_once``, and the rows are written with their votes so far.
    """
    kept, trees = df.columns, [tree for part in _models(model) for tree in part.trees]
    votes = F.array().cast("array<double>")
    if _grown(trees):
        for some in forests.in_turns(trees, at_once):
            new, sent = forests.asked(df.sparkSession, some)
            df = materialize(df.select(*kept, F.concat(votes, new).alias("votes")), "votes")
            sent.destroy()
            votes = F.col("votes")
        return df
    for start in range(0, len(trees), at_once):
        some = trees[start : start + at_once]
        for i, tree in enumerate(some):
            # of a tree's outputs only the probability is made
            alone = tree.copy().setPredictionCol("").setRawPredictionCol("").setProbabilityCol(f"_vote_{i}")
            df = alone.transform(df)
        new = F.array(*(positive_probability(f"_vote_{i}") for i in range(len(some))))
        df = materialize(df.select(*kept, F.concat(votes, new).alias("votes")), "votes")
        votes = F.col("votes")
    return df


def cross_validate(
    df: DataFrame, classifier: RandomForestClassifier, fold: str, k: int, parallelism: int = 5,
    small: int = SMALL, per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Out-of-fold scores of all rows: each fold is scored by a forest grown on the others.

    Above ``small`` rows the trees of two folds at a time are grown by tasks (see ``grow``). A fit of Spark grows level by level in short jobs, so several folds, or parts of their forests (see ``grow``), are
    fitted at a time. A fold in parts is scored as soon as it has them, while the next ones grow.
    """
    if forests.fits(classifier, df):
        # of folds whose trees are grown by tasks, two keep them busy
        counts = {row[fold]: row["count"] for row in df.groupBy(fold).count().filter(F.col(fold).between(0, k - 1)).collect()}
        least = sum(counts.values()) - max(counts.values(), default=0)
        if least > small and classifier.getNumTrees() > TREES_PER_PART:

            def leave_out(i: int) -> DataFrame:
                model = grow(classifier, df.filter(F.col(fold) != i), small, per_task)
                return score(model, df.filter(F.col(fold) == i))

            with ThreadPoolExecutor(FOLDS_AT_ONCE) as pool:
                return reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(df.sparkSession)(leave_out), range(k)))
    plans = [_parts(classifier, df.filter(F.col(fold) != i), small, per_task) for i in range(k)]
    fit = inheritable_thread_target(df.sparkSession)(lambda part, rows: part.fit(rows))
    width = min(width or parallelism for _, _, width in plans)

    scored = []
    with ThreadPoolExecutor(width) as pool:
        fits: list[list[Future]] = [[pool.submit(fit, part, rows) for part in parts] for parts, rows, _ in plans]
        for i in range(k):
            # the forest of a fold in parts is let go once it is scored
            models = [future.result() for future in fits[i]]
            fits[i] = []
            scored.append(score(models, df.filter(F.col(fold) == i)))
    return reduce(DataFrame.unionByName, scored)
