"""Case ids, dates and names found in a text.

The patterns are this package's own specification, but for the cue words, month names and salutations,
which are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperlane.functions.binding import evaluate_once
from paperlane.functions.text import BLANKS, cut_piece, running_sums, text_blocks

# looking at the first character before the word boundary keeps the search fast
CASE_ID_PATTERN = r"(?U)(?=1)\b1[0-9]{10,12}\b"

# Month names, cue words, salutations.
MONTHS = (
    "januar", "februar", "märz", "april", "mai", "juni",
    "juli", "august", "september", "oktober", "november", "dezember",
)
CUES = ("gegen", r"\./\.")
SALUTATION_WORDS = ("herr", "herrn", "frau", "fräulein")

SALUTATIONS = rf"\b({'|'.join(SALUTATION_WORDS)})\b"

MONTH_NAMES = "|".join(MONTHS).replace("ä", "[äÄ]")
DATE_PATTERN = (
    r"(?i)(?=[0-9])\b(?:[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2}"
    rf"|[0-9]{{1,2}}\. ?(?:{MONTH_NAMES}) [0-9]{{4}})\b"
)
MIN_YEAR = 2000
ANY_BLANK = f"[{BLANKS}\n]"
NO_BLANK = f"[^{BLANKS}\n]"


def case_id(text: Column, pattern: str = CASE_ID_PATTERN) -> Column:
    """First id in the text, NULL when there is none."""
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


def parse_day(text: Column) -> Column:
    """Date of ``d.M.yyyy``, ``yyyy-MM-dd`` or ``d. month yyyy``; NULL for an impossible one."""
    lower = F.lower(text)
    month = F.regexp_extract(lower, f"({'|'.join(MONTHS)})", 1)
    number = F.array_position(F.array(*[F.lit(name) for name in MONTHS]), month).cast("string")
    spelled = F.regexp_replace(
        lower, F.lit(rf"\. ?(?:{'|'.join(MONTHS)}) "), F.concat(F.lit("."), number, F.lit("."))
    )
    iso = F.regexp_replace(spelled, r"^([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})$", "$3-$2-$1")
    return iso.try_cast("date")


def date_matches(text: Column, valid_only: bool = True) -> Column:
    """Dates in the text as ``(text, start, end)``, positions counted from 0.

    A match is valid if it is a real day from the year 2000 on. NULL when nothing is left.
    """
    found = F.regexp_extract_all(text, F.lit(DATE_PATTERN), F.lit(0))
    between = F.split(text, DATE_PATTERN, -1)

    # the piece after the last match has no match to go with, so its hit is NULL
    pairs = F.filter(F.arrays_zip(between.alias("gap"), found.alias("hit")), lambda pair: pair["hit"].isNotNull())

    def placed(pairs: Column) -> Column:
        ends = running_sums(F.transform(pairs, lambda pair: F.length(pair["gap"]) + F.length(pair["hit"])))
        return F.transform(
            F.arrays_zip(pairs.alias("pair"), ends.alias("end")),
            lambda x: F.struct(
                x["pair"]["hit"].alias("text"), (x["end"].cast("int") - F.length(x["pair"]["hit"])).alias("start"), x["end"].cast("int").alias("end"),
            ),
        )

    spans = evaluate_once(pairs, placed)
    if valid_only:
        spans = F.filter(spans, lambda span: F.year(parse_day(span["text"])) >= MIN_YEAR)
    return evaluate_once(spans, lambda found: F.when(F.size(found) > 0, found))


def date_contexts(text: Column, spans: Column, window: int = 40) -> Column:
    """The text around the first match of each distinct date, clipped at both ends."""

    def firsts(both: Column) -> Column:
        place = F.map_from_arrays(both["distinct"], F.transform(both["distinct"], lambda t: F.array_position(both["texts"], t)))
        return F.transform(F.map_values(place), lambda i: F.get(spans, (i - 1).cast("int")))

    texts = F.transform(spans, lambda span: span["text"])
    first = evaluate_once(F.struct(texts.alias("texts"), F.array_distinct(texts).alias("distinct")), firsts)

    def contexts(both: Column) -> Column:
        def context(span: Column) -> Column:
            start = F.greatest(span["start"] - window, F.lit(0))
            end = F.least(span["end"] + window, both["length"])
            return cut_piece(both["blocks"], start, end - start)

        return F.transform(both["first"], context)

    both = F.struct(first.alias("first"), text_blocks(text).alias("blocks"), F.length(text).alias("length"))
    return F.when(spans.isNotNull(), evaluate_once(both, contexts))


def name_context(text: Column, window: int = 15) -> Column:
    """The words that follow the first cue word, at most ``window`` of them; NULL without one.

    Line breaks inside the context are kept, other blanks at its start are not.
    """
    cues = "|".join(CUES)
    # looking at the first character of a cue before what is in front of it keeps the search fast
    pattern = (
        rf"(?iu)(?=[g.])(?<!{NO_BLANK})(?:{cues})"
        rf"((?:{ANY_BLANK}+{NO_BLANK}+){{1,{window}}})"
    )

    def trimmed(context: Column) -> Column:
        return F.nullif(F.regexp_replace(context, f"^[{BLANKS}]+", ""), F.lit(""))

    return evaluate_once(F.regexp_extract(text, pattern, 1), trimmed)


def pick_name(context: Column) -> Column:
    """The line of a context that holds the name: of its first two, the first with two letters or more.

    A context of one line gives NULL, as nothing tells where its name ends. What follows the first
    comma of the line is a first name and moves to the front.
    """
    lines = F.split(context, "\n")
    two = F.when(F.size(lines) > 1, F.transform(F.slice(lines, 1, 2), lambda line: F.trim(line)))
    line = F.get(F.filter(two, lambda line: F.length(line) > 1), F.lit(0))

    def turned(line: Column) -> Column:
        comma = F.instr(line, ",")
        last, first = F.substring_index(line, ",", 1), F.get(F.split(line, ",", 3), F.lit(1))
        return F.when(comma > 0, F.concat_ws(" ", F.trim(first), F.trim(last))).otherwise(line)

    return evaluate_once(line, turned)


def clean_name(name: Column) -> Column:
    """The words of a name: letters and hyphens, the first letter upper case, the others lower case.

    Words are what blanks part. ``c/o``, salutations and words without a letter or hyphen are left out;
    NULL when no word is left.
    """
    words = F.filter(F.split(F.lower(name), f"{ANY_BLANK}+"), lambda word: word != "c/o")
    letters = F.transform(words, lambda word: F.regexp_replace(word, r"[^\p{L}-]+", ""))
    kept = F.filter(letters, lambda word: (word != "") & ~word.isin(*SALUTATION_WORDS))
    return F.nullif(F.initcap(F.array_join(kept, " ")), F.lit(""))


def has_salutation(text: Column) -> Column:
    """A salutation anywhere in the text, in any case."""
    return text.rlike(f"(?iU){SALUTATIONS}")


def main_punctuation(context: Column) -> Column:
    """The most frequent punctuation sign; the one seen first wins a tie."""

    def most(signs: Column) -> Column:
        counted = F.transform(
            F.array_distinct(signs),
            lambda sign: F.struct(
                F.size(F.filter(signs, lambda other: other == sign)).alias("n"),
                (-F.array_position(signs, sign)).alias("earliest"),
                sign.alias("sign"),
            ),
        )
        return F.array_max(counted)["sign"]

    return evaluate_once(F.regexp_extract_all(context, F.lit(r"(\p{P})"), F.lit(1)), most)
