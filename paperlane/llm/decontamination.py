"""Benchmark decontamination with a positional inverted index.

The index stores postings (term, document, position) of training tokens, of the rarest terms of
every benchmark window. Postings less the place of the term in the item give the same number where
terms stand as in the item: these adjusted lists are intersected, and what is left is compared word
by word. Only built-in functions run here. Documents with the same text share their postings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlane.llm.sizes import broadcast_within
from paperlane.session import materialize

WINDOW = 10
LISTS = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in lower case: runs of digits, letters and all that is not ASCII."""
    # lower() is far faster, and does the same where every character is one byte
    plain = F.octet_length(text) == F.char_length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.array_remove(F.split(low, SEPARATORS), ""), F.array().cast("array<string>"))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def item_places(items: DataFrame, size: int) -> DataFrame:
    """Every word of the items: item, term, place, and the first places of the first and last window around it.

    A window has ``size`` words, or all of a shorter item. Items without words have no windows.
    """
    words = items.select("item", F.size("words").alias("n"), F.posexplode("words").alias("place", "term"))
    length = F.least("n", F.lit(size))
    return words.select(
        "item", "term", "place", length.alias("length"),
        F.greatest(F.col("place") - length + 1, F.lit(0)).alias("low"), F.least("place", F.col("n") - length).alias("high"),
    )


def in_windows(places: DataFrame) -> DataFrame:
    """Each place once for every window around it, whose first place is ``first``."""
    return places.withColumn("first", F.explode(F.sequence("low", "high"))).drop("low", "high")


def rare_places(places: DataFrame, counts: DataFrame, lists: int) -> DataFrame:
    """Places in the items whose terms are among the rarest distinct ones of some window."""
    # counts are looked up once per place, and a small vocabulary comes to the places
    known = places.join(broadcast_within(counts), "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # of a term that occurs twice in a window, the first place
    once = in_windows(known).groupBy("item", "first", "term", "n").agg(F.min("place").alias("place"))
    order = Window.partitionBy("item", "first").orderBy("n", "term")
    rare = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= lists)
    return rare.select("term", "item", "place").distinct()


class Index:
    """Stored postings of the terms that matter for some benchmark items."""

    def __init__(self, docs: DataFrame, items: DataFrame, text: str, item_text: str, item_id: str, size: int = WINDOW, lists: int = LISTS):
        spark = docs.sparkSession
        self.size = size
        rows = items.select(F.col(item_id).cast("string").alias("item_id"), words_of(F.col(item_text)).alias("words"))
        # the words name an item: equal items are one, with all their ids
        rows = rows.filter(F.size("words") > 0).groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
        self.items = materialize(rows.withColumn("item", F.unhex(F.md5(F.array_join("words", " ").cast("binary")))), "items")

        words = docs.select(words_of(F.col(text)).alias("words"))
        vocabulary = materialize(self.items.select(F.explode("words").alias("term")).distinct(), "vocabulary")
        seen = words.select(F.explode("words").alias("term")).join(broadcast_within(vocabulary), "term")
        counts = materialize(seen.groupBy("term").agg(F.count("*").alias("n")), "counts")
        self.places = materialize(rare_places(item_places(self.items, size), counts, lists), "places")

        terms = materialize(self.places.select("term").distinct(), "terms")
        tokens = docs.select(text_key(F.col(text)).alias("key"), F.posexplode(words_of(F.col(text))).alias("position", "term"))
        self.postings = materialize(tokens.join(broadcast_within(terms), "term"), "postings")

    def alignments(self) -> DataFrame:
        """Where an item may start in a document: the places of the item whose adjusted postings meet there."""
        adjusted = self.postings.join(broadcast_within(self.places), "term")
        adjusted = adjusted.select("key", "item", (F.col("position") - F.col("place")).alias("start"), "place")
        # equal texts have the same postings
        return adjusted.groupBy("key", "item", "start").agg(F.count_distinct("place").alias("places"))

    def candidates(self) -> DataFrame:
        """Alignments (key, item, start) at which some window may have all its listed terms."""
        spots = item_places(self.items, self.size).join(self.places.select("item", "place"), ["item", "place"])
        # a window's own rarest terms are among the listed places inside it; two of them must be there
        need = in_windows(spots).groupBy("item", "first").agg(F.count("*").alias("needed"))
        least = materialize(need.groupBy("item").agg(F.min("needed").alias("fewest")), "needed")
        met = self.alignments().join(broadcast_within(least), "item")
        return met.filter(F.col("places") >= F.least("fewest", F.lit(2))).select("key", "item", "start")

    def hits(self, docs: DataFrame, text: str) -> DataFrame:
        """Per text with any: ``key``, ``n_hit`` and the ids of the items whose windows occur, as JSON.

        Texts that have candidates are split once more; of a text, an alignment takes along only the words under the
        item. So no row holds more than a text and an item, however many alignments there are.
        """
        found = materialize(self.candidates(), "candidates")
        keys = materialize(found.select("key").distinct(), "keys")
        texts = docs.select(text_key(F.col(text)).alias("key"), F.col(text).alias("text")).join(broadcast_within(keys), "key", "left_semi")
        texts = texts.dropDuplicates(["key"]).select("key", words_of(F.col("text")).alias("words"))
        sizes = self.items.select("item", F.size("words").alias("n"))
        # an item may begin before the text does
        before = F.greatest(-F.col("start"), F.lit(0))
        cut = F.slice("words", F.greatest("start", F.lit(0)) + 1, F.greatest(F.col("n") - before, F.lit(0)))
        under = found.join(sizes, "item").join(texts, "key").select("key", "item", "start", before.alias("before"), cut.alias("under"))
        both = under.join(self.items, "item")
        length = F.least(F.size("words"), F.lit(self.size))
        first = F.sequence(F.col("before"), F.size("words") - length)

        def same(i: Column) -> Column:
            return F.slice("under", i - F.col("before") + 1, length) == F.slice("words", i + 1, length)

        firsts = F.filter(F.when(F.col("before") <= F.size("words") - length, first), same)
        matched = both.select("key", "ids", "start", length.alias("length"), firsts.alias("firsts")).filter(F.size("firsts") > 0)
        matched = materialize(matched, "matched")
        windows = matched.select("key", "start", "length", F.explode("firsts").alias("first"))
        at = F.col("start") + F.col("first")
        covered = windows.select("key", at.alias("at"), "length").distinct()
        covered = covered.select("key", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("length") - 1)).alias("place")).distinct()
        listed = matched.select("key", F.explode("ids").alias("id")).distinct().groupBy("key").agg(F.to_json(F.array_sort(F.collect_list("id"))).alias("ids"))
        return covered.groupBy("key").agg(F.count("*").alias("n_hit")).join(listed, "key", "left")


def contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id",
    size: int = WINDOW,
) -> DataFrame:
    """Add to each document its words, the words hit by item windows, and the items they belong to.

    Columns added (those of the same names are replaced): ``n_words``, ``n_hit``, ``items`` (sorted
    ids, as strings) and ``contaminated``. A window has ``size`` words; an item with fewer is one
    window. Missing and empty texts have no words and are clean. Items without an id hit words but
    are not listed. Repeated rows each get the result of their text.
    """
    added = ("n_words", "n_hit", "items", "contaminated")
    kept = [c for c in docs.columns if c.lower() not in added]
    index = Index(docs, items, text, item_text, item_id, size)
    hits = materialize(index.hits(docs, text), "hits").withColumnsRenamed({"key": "_key_", "n_hit": "_n_hit_", "ids": "_ids_"})
    rows = docs.select(*kept, F.size(words_of(F.col(text))).cast("long").alias("n_words"), text_key(F.col(text)).alias("_key_"))
    found = rows.join(broadcast_within(hits), "_key_", "left")
    ids = F.coalesce(F.from_json("_ids_", "array<string>"), F.array().cast("array<string>"))
    n_hit = F.coalesce("_n_hit_", F.lit(0)).cast("long")
    return found.select(*kept, "n_words", n_hit.alias("n_hit"), ids.alias("items"), (n_hit > 0).alias("contaminated"))


def near_matches(
    docs: DataFrame, items: DataFrame, slop: int, text: str = "text", item_text: str = "text", item_id: str = "item_id",
    size: int = WINDOW,
) -> DataFrame:
    """Proximity matches: texts in which all words of an item window occur, in any order, within
    ``slop`` words more than the window has on either side of its rarest term.

    Returns ``key`` (MD5 of the text), ``item_id``, ``first`` (the window's place in the item) and
    ``position`` (of the rarest term in the text).
    """
    index = Index(docs, items, text, item_text, item_id, size, lists=1)
    spots = in_windows(item_places(index.items, size).join(index.places.select("item", "place"), ["item", "place"]))
    words = index.items.select("item", "ids", "words")
    windows = spots.join(words, "item").select("term", "ids", "first", F.expr("array_distinct(slice(words, first + 1, length))").alias("terms"), "length")
    spots = index.postings.distinct().join(windows, "term")
    texts = docs.select(text_key(F.col(text)).alias("key"), words_of(F.col(text)).alias("words")).dropDuplicates(["key"])
    reach = F.expr(f"slice(words, greatest(position - length - {slop}, 0) + 1, position + 1 + length + {slop} - greatest(position - length - {slop}, 0))")
    near = spots.join(texts, "key").filter(F.size(F.array_except("terms", reach)) == 0)
    return near.select("key", F.explode("ids").alias("item_id"), "first", "position").distinct()
