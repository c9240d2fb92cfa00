"""Base forms of words by endings that are learned from the corpus; there is no word list.

Words that share a stem and differ in their endings belong together if writing them as stem and ending is
shorter than writing them out. Lengths are counted in letters, so all numbers are whole. First the endings
that pay are chosen, one by one; then stems with the same set of such endings form a paradigm, and
a paradigm pays or not as a whole. A word's longest ending that a paradigm has is replaced by the
shortest one of that paradigm.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_STEM, LONGEST_ENDING = 3, 4
REFERENCE = 2  # letters that a reference to a stem or a paradigm is worth
MAX_ENDINGS = 200


def distinct_words(df: DataFrame, tokens: str) -> DataFrame:
    """Words of letters alone, long enough to be a stem."""
    words = df.select(F.explode(tokens).alias("word")).filter(F.length("word") >= LEAST_STEM).distinct()
    return words.filter(F.col("word").rlike(r"^\p{L}+$"))


def word_splits(words: DataFrame) -> DataFrame:
    """Every way to part a word into a stem and a short ending."""
    most = F.least(F.length("word") - LEAST_STEM, F.lit(LONGEST_ENDING))
    cut = words.filter(F.length("word") > LEAST_STEM).select("word", F.explode(F.sequence(F.lit(1), most)).alias("n"))
    stem = F.left("word", F.length("word") - F.col("n"))
    return cut.select(stem.alias("stem"), F.right("word", F.col("n")).alias("ending"))


def paying_endings(words: DataFrame, splits: DataFrame, most: int = MAX_ENDINGS) -> DataFrame:
    """``ending``, ``words`` (that are a word with the ending added) and the letters saved (``gain``).

    A word of this kind costs a reference instead of its stem, and the ending is written once.
    """
    found = splits.join(words.select(F.col("word").alias("stem")), "stem", "left_semi")
    sums = found.groupBy("ending").agg(F.count("*").alias("words"), F.sum(F.length("stem") - REFERENCE).alias("saved"))
    gains = sums.select("ending", "words", (F.col("saved") - F.length("ending")).alias("gain"))
    return gains.filter("words > 1 AND gain > 0").orderBy(F.desc("gain"), "ending").limit(most)


def paradigms(words: DataFrame, splits: DataFrame, endings: DataFrame) -> DataFrame:
    """``endings`` (shortest first), the number of ``stems`` that have exactly these, and the letters saved.

    Written out, every stem comes once per ending and every ending once per stem; as a paradigm each
    is written once, and a stem refers to its paradigm.
    """
    parted = splits.join(endings.select("ending"), "ending").select("stem", "ending")
    bare = words.select(F.col("word").alias("stem"), F.lit("").alias("ending"))
    # at most one entry per chosen ending
    sets = parted.unionByName(bare).groupBy("stem").agg(F.collect_set(F.struct(F.length("ending").alias("n"), "ending")).alias("set"))
    sets = sets.filter(F.size("set") > 1).select("stem", F.array_sort("set")["ending"].alias("endings"))
    sums = sets.groupBy("endings").agg(F.count("*").alias("stems"), F.sum(F.length("stem")).alias("letters")).filter("stems > 1")
    written = F.char_length(F.array_join("endings", ""))
    gain = (F.size("endings") - 1) * F.col("letters") + (F.col("stems") - 1) * written - REFERENCE * F.col("stems")
    return sums.select("endings", "stems", gain.cast("long").alias("gain")).filter("gain > 0")


def ending_rules(found: DataFrame) -> DataFrame:
    """``ending``, ``replacement`` and ``gain`` of the paradigm that saves most among those with the ending."""
    best = F.max(F.struct("gain", F.array_join("endings", ",").alias("name"), F.get("endings", F.lit(0)).alias("replacement")))
    each = found.select(F.explode("endings").alias("ending"), "gain", "endings")
    rules = each.groupBy("ending").agg(best.alias("best")).select("ending", "best.replacement", "best.gain")
    return rules.filter("ending <> replacement")


def learn_rules(df: DataFrame, tokens: str, most: int = MAX_ENDINGS) -> DataFrame:
    """Rules from all words of a token column."""
    words = distinct_words(df, tokens)
    splits = word_splits(words)
    return ending_rules(paradigms(words, splits, paying_endings(words, splits, most)))


class Endings:
    """Rules as a trie over reversed endings, which is walked from the end of a word.

    It is a constant of the plan, and holds one entry per rule and per beginning of one.
    """

    def __init__(self, rules: Mapping[str, str]):
        self.nodes: dict[str, str | None] = {}
        for ending, replacement in rules.items():
            reverse = ending[::-1]
            for n in range(1, len(reverse)):
                self.nodes.setdefault(reverse[:n], None)
            self.nodes[reverse] = replacement

    @classmethod
    def from_rules(cls, rules: DataFrame) -> Endings:
        """At most ``MAX_ENDINGS`` rows come to the driver."""
        return cls({row["ending"]: row["replacement"] for row in rules.select("ending", "replacement").collect()})

    def __call__(self, word: Column) -> Column:
        """The base form of a word; a word that no rule fits stays as it is."""
        if not self.nodes:
            return word
        trie = F.create_map(*[F.lit(x) for path, value in sorted(self.nodes.items()) for x in (path, value)])
        most = F.least(F.length(word) - LEAST_STEM, F.lit(LONGEST_ENDING))
        letters = F.split(F.reverse(F.right(word, F.greatest(most, F.lit(0)))), "")
        start = F.struct(F.lit("").alias("path"), F.lit(0).alias("cut"), F.lit("").alias("put"))

        def step(state: Column, letter: Column) -> Column:
            path = F.concat(state["path"], letter)
            # off the trie the path is lost, and no longer one is in it
            known = state["path"].isNotNull() & (letter != "") & F.map_contains_key(trie, path)
            put = F.when(known, F.element_at(trie, path))
            return F.struct(
                F.when(known, path).alias("path"), F.when(put.isNotNull(), F.length(path)).otherwise(state["cut"]).alias("cut"),
                F.coalesce(put, state["put"]).alias("put"),
            )

        def changed(state: Column) -> Column:
            return F.concat(F.left(word, F.length(word) - state["cut"]), state["put"])

        return F.when(F.length(word) > LEAST_STEM, F.aggregate(letters, start, step, changed)).otherwise(word)


def lemmas(tokens: Column, endings: Endings) -> Column:
    """Base forms of an array of words, in their order."""
    return F.transform(tokens, endings)
