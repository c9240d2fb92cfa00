"""Text cleaning, entity tags, tokens and marks.

The cleaning, tagging and token rules are this package's own specification; they use patterns that
mean the same in Java and RE2, so that SQL engines can check them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

from paperlane.functions.binding import evaluate_once

# Every Unicode blank but the line feed.
BLOCK = 4096  # signs of a block of a text
BLANKS = "\t\x0b\x0c\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# The tags, each with the pattern it stands for, in the order of replacement.
TAG_PATTERNS = (
    ("<URL>", r"(?i)(?:https?://|www\.)[^ \t\n<>\"']+"),
    ("<EMAIL>", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("<LEGAL_ARTICLE>", r"(?i)(?:§+|art\.|article|artikel) ?[0-9]+[a-z]?(?: abs\. ?[0-9]+)?"),
    ("<DR_REFERENCE>", r"(?i)dr\.? (?:[ivx]+ )?[0-9]+/[0-9]{2,4}"),
    ("<CUR>", r"(?i)(?:[€$£] ?[0-9]+(?:[.,][0-9]+)*|[0-9]+(?:[.,][0-9]+)* ?(?:[€$£]|eur|usd))"),
    ("<PHONE>", r"(?:\+|00)[0-9]{1,3}[ /-]?[0-9]{2,5}(?:[ /-]?[0-9]{2,8}){1,3}"),
    ("<NUMBER>", r"[0-9]+(?:[.,][0-9]+)*"),
)
TAGS = tuple(tag for tag, _ in TAG_PATTERNS)

# The same matches in time that grows with the text alone: a run that is part of no match is tried
# only from its first character (or right after a match), and numbers are never given back.
_NUMBER = "[0-9]++(?:[.,][0-9]++)*+"
LINEAR_PATTERNS = {
    "<EMAIL>": r"(?:\G|(?<![A-Za-z0-9._%+-]))" + dict(TAG_PATTERNS)["<EMAIL>"],
    "<LEGAL_ARTICLE>": dict(TAG_PATTERNS)["<LEGAL_ARTICLE>"].replace("§+", r"(?:\G|(?<!§))§++"),
    "<CUR>": rf"(?i)(?:[€$£] ?{_NUMBER}|(?:\G|(?<![0-9])(?<![0-9][.,])){_NUMBER} ?(?:[€$£]|eur|usd))",
    "<NUMBER>": _NUMBER,
}

TOKEN_GAP = r"[^\p{L}\p{N}<>_]+"
MAX_TOKEN_LENGTH = 45


def clean_text(
    text: Column,
    strip_html: bool = True,
    normalize_whitespace: bool = True,
    remove_short_lines: bool = True,
    short_line_threshold: int = 3,
    lowercase: bool = True,
) -> Column:
    """Clean a text; each step has its own switch and a missing text becomes the empty one.

    Steps in order: drop HTML tags; collapse blanks within each line and trim the line; drop lines
    shorter than the threshold; lower case. Line breaks are kept.
    """
    text = F.coalesce(text, F.lit(""))
    if strip_html:
        text = without_tags(text)
    if normalize_whitespace:
        text = F.regexp_replace(text, f"[{BLANKS}]+", " ")
        text = F.regexp_replace(text, "(?md)^ | $", "")
    if remove_short_lines:
        text = F.regexp_replace(text, rf"(?md)^[^\n]{{0,{short_line_threshold - 1}}}(?:\n|$)", "")
        text = F.regexp_replace(text, r"\n$", "")
    if lowercase:
        text = F.lower(text)
    return text


def without_tags(text: Column) -> Column:
    """Text without ``<...>``, from a ``<`` to the next ``>``.

    Every piece between two ``>`` loses what follows its first ``<``, which reads the text once; a
    pattern would read on to the end of the text from every ``<`` that nothing closes.
    """

    def strip(pieces: Column) -> Column:
        def kept(piece: Column, i: Column) -> Column:
            closed = F.when(piece.contains("<"), F.substring_index(piece, "<", 1)).otherwise(F.concat(piece, F.lit(">")))
            return F.when(i < F.size(pieces) - 1, closed).otherwise(piece)

        return F.array_join(F.transform(pieces, kept), "")

    return evaluate_once(F.split(text, ">", -1), strip)


def replace_with_tags(text: Column) -> Column:
    """Put a tag in the place of each address, reference, amount, phone number and number."""
    for tag, pattern in TAG_PATTERNS:
        text = F.regexp_replace(text, LINEAR_PATTERNS.get(tag, pattern), tag)
    return text


def count_tag(text: Column, tag: str) -> Column:
    """Occurrences of one tag, from the length the text loses without it."""
    without = F.replace(text, F.lit(tag), F.lit(""))
    return ((F.length(text) - F.length(without)) / len(tag)).cast("int")


def tokens(
    text: Column,
    stop_words: Sequence[str] = (),
    keep: Sequence[str] = ("m",),
    max_length: int = MAX_TOKEN_LENGTH,
) -> Column:
    """Lower-case words without stop words, plain numbers, tags and overlong words.

    Words listed in ``keep`` stay even if they are stop words.
    """
    words = F.split(F.lower(text), TOKEN_GAP)
    dropped = [word for word in stop_words if word not in keep]

    def wanted(word: Column) -> Column:
        test = (
            (word != "")
            & (F.length(word) < max_length)
            & ~word.rlike("^[0-9]+$")
            & ~word.startswith("<")
            & ~word.endswith(">")
        )
        return test & ~word.isin(*dropped) if dropped else test

    return F.filter(words, wanted)


def default_stop_words(language: str) -> list[str]:
    """Spark's own list for a language, such as ``german``."""
    return StopWordsRemover.loadDefaultStopWords(language)


def mark_tokens(
    text: Column, fragments: Sequence[Column | str], opening: str = "[[", closing: str = "]]"
) -> Column:
    """Put marks around every occurrence of each fragment; empty fragments are skipped."""
    for fragment in fragments:
        part = F.lit(fragment) if isinstance(fragment, str) else F.coalesce(fragment, F.lit(""))
        marked = F.replace(text, part, F.concat(F.lit(opening), part, F.lit(closing)))
        text = F.when(part == "", text).otherwise(marked)
    return text


def running_sums(numbers: Column) -> Column:
    """Running sums of an array of whole numbers.

    An array that grows entry by entry is copied at each step, so sums are made in runs of about the square
    root of their number, first over whole runs and then inside each.
    """

    def sums(values: Column, start: Column) -> Column:
        begin = F.struct(start.cast("long").alias("sum"), F.array().cast("array<bigint>").alias("all"))

        def step(state: Column, x: Column) -> Column:
            total = state["sum"] + x
            return F.struct(total.alias("sum"), F.concat(state["all"], F.array(total)).alias("all"))

        return F.aggregate(values, begin, step, lambda state: state["all"])

    def in_runs(values: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(values).cast("double"))).cast("int")
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / width).cast("int")), lambda i: F.slice(values, i * width + 1, width))

        def joined(both: Column) -> Column:
            def inside(run: Column, i: Column) -> Column:
                return sums(run, F.when(i == 0, F.lit(0)).otherwise(F.get(both["ends"], i - 1)))

            return F.flatten(F.transform(both["runs"], inside))

        def with_ends(runs: Column) -> Column:
            totals = F.transform(runs, lambda run: F.aggregate(run, F.lit(0).cast("long"), lambda x, y: x + y))
            return evaluate_once(F.struct(runs.alias("runs"), sums(totals, F.lit(0)).alias("ends")), joined)

        return F.when(F.size(values) > 0, evaluate_once(cut, with_ends)).otherwise(F.array().cast("array<bigint>"))

    return evaluate_once(numbers, in_runs)


def text_blocks(text: Column) -> Column:
    """A text in blocks of equal length, from which pieces are cut without counting signs from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def cut_piece(blocks: Column, start: Column, length: Column) -> Column:
    """``length`` signs of a text in blocks, from a place counted from 0; as ``substring`` of the whole text."""
    first, inside = F.floor(start / BLOCK).cast("int"), start % BLOCK
    count = F.floor((inside + F.greatest(length, F.lit(0))) / BLOCK).cast("int") + 1
    return F.substring(F.array_join(F.slice(blocks, first + 1, count), ""), inside + 1, length)


def mark_spans(text: Column, spans: Column, opening: str = "[[", closing: str = "]]") -> Column:
    """Put marks around spans ``(text, start, end)`` that are in order and do not overlap."""

    def marked(both: Column) -> Column:
        spans, blocks = both["spans"], both["blocks"]

        def piece(span: Column, i: Column) -> Column:
            done = F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["end"])
            before = cut_piece(blocks, done, span["start"] - done)
            return F.concat(before, F.lit(opening), span["text"], F.lit(closing))

        done = F.coalesce(F.try_element_at(spans, F.lit(-1))["end"], F.lit(0))
        return F.concat(F.array_join(F.transform(spans, piece), ""), F.substring(text, done + 1, F.length(text)))

    empty = F.array().cast("array<struct<text:string,start:int,end:int>>")
    both = F.struct(F.coalesce(spans, empty).alias("spans"), text_blocks(text).alias("blocks"))
    return F.when(text.isNotNull(), evaluate_once(both, marked))


def show_line_breaks(text: Column, mark: str = "<LINE_BREAK>") -> Column:
    """Make line breaks visible."""
    return F.replace(text, F.lit("\n"), F.lit(mark))
