"""Names of persons in texts without a cue: a first-order tagger, fitted on the names that a cue gives away.

Each token belongs to one of a few shapes. The tagger knows how often a shape is part of a name and how
often a name goes on or ends; both are counted on the contexts that follow a cue, where the line of the
name is known. The best sequence of tags is found by Viterbi's algorithm in one pass over the
tokens. What a path has to remember is only where its first name begins and ends.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlane.functions.binding import evaluate_once
from paperlane.functions.extract import NO_BLANK, SALUTATION_WORDS, clean_name, name_context, pick_name

BREAK, SALUTED, WITH_COMMA, CAPITAL, SHORT, NUMBER, LOWER, ANYTHING = range(8)
SHAPES = 8
UNIT = 1000  # scores are logarithms in thousandths, so that sums are whole numbers
NEVER = -(10**15)


def text_tokens(text: Column) -> Column:
    """Words, and line breaks as tokens of their own."""
    return F.regexp_extract_all(text, F.lit(f"\n|{NO_BLANK}+"), F.lit(0))


def shape(token: Column) -> Column:
    """What a token looks like."""
    letters = F.regexp_replace(F.lower(token), r"[^\p{L}]+", "")
    return (
        F.when(token == "\n", BREAK).when(letters.isin(*SALUTATION_WORDS), SALUTED)
        .when(token.rlike(r"^\p{Lu}[\p{L}-]+,$"), WITH_COMMA).when(token.rlike(r"^\p{Lu}[\p{L}-]+$"), CAPITAL)
        .when(token.rlike(r"^\p{Lu}\p{L}{0,3}\.$"), SHORT).when(token.rlike("[0-9]"), NUMBER)
        .when(token.rlike(r"^\p{Ll}"), LOWER).otherwise(ANYTHING)
    )


def context_tags(context: Column) -> Column:
    """The shapes of the words of a context, each with whether it lies on the line of the name; NULL if no name is found."""
    def marked(lines: Column) -> Column:
        picked = F.when(F.length(F.trim(F.get(lines, F.lit(0)))) > 1, 0).otherwise(1)

        def tagged(line: Column, i: Column) -> Column:
            words = F.transform(
                F.regexp_extract_all(line, F.lit(f"{NO_BLANK}+"), F.lit(0)), lambda w: F.struct(shape(w).alias("shape"), (i == picked).alias("name")),
            )
            line_break = F.struct(F.lit(BREAK).alias("shape"), F.lit(False).alias("name"))
            return F.concat(F.when(i > 0, F.array(line_break)).otherwise(F.slice(words, 1, 0)), words)

        return F.flatten(F.transform(lines, tagged))

    return F.when(pick_name(context).isNotNull(), evaluate_once(F.split(context, "\n"), marked))


def marked_contexts(texts: DataFrame, text: str) -> DataFrame:
    """``tags``: the shapes of the words after a cue, each with whether it lies on the line of the name.

    Only contexts in which a name is found teach anything. A context has a bounded number of words.
    """
    # the filter looks at an exploded value, so that it is not worked out again below
    return texts.select(F.explode(F.array(evaluate_once(name_context(F.col(text)), context_tags))).alias("tags")).filter("tags IS NOT NULL")


@dataclass(frozen=True)
class Tagger:
    """Scores of shapes by tag (0 other, 1 name), and of a tag by the one before."""

    shapes: tuple[tuple[int, ...], tuple[int, ...]]
    steps: tuple[tuple[int, int], tuple[int, int]]


def tagger_scores(texts: DataFrame, text: str) -> DataFrame:
    """``kind`` (shape or step), ``given`` (a tag), ``what`` (a shape or the next tag) and ``score``.

    Every event counts once more than it was seen. What comes before the first word is no name.
    """
    def events(tags: Column) -> Column:
        def both(tag: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(tags, i - 1)["name"]).otherwise(False).cast("int")
            name = tag["name"].cast("int")
            return F.array(
                F.struct(F.lit("shape").alias("kind"), name.alias("given"), tag["shape"].alias("what")),
                F.struct(F.lit("step").alias("kind"), before.alias("given"), name.alias("what")),
            )

        return F.flatten(F.transform(tags, both))

    # one expression from the text to its events: plans repeat a column's work wherever a filter or a generator names it
    found = evaluate_once(name_context(F.col(text)), lambda context: evaluate_once(context_tags(context), events))
    counts = texts.select(F.inline(found)).groupBy("kind", "given", "what").agg(F.count("*").alias("n"))
    # all events there can be, twenty rows
    possible = texts.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.lit(given).alias("given"), F.lit(what).alias("what"))
        for kind, n in (("shape", SHAPES), ("step", 2)) for given in (0, 1) for what in range(n)
    ])))
    full = possible.join(counts, ["kind", "given", "what"], "left").withColumn("n", F.coalesce("n", F.lit(0)) + 1)
    # twenty rows, so that the texts are read once
    total = F.sum("n").over(Window.partitionBy("kind", "given"))
    score = F.round(F.ln(F.col("n") / total) * UNIT).cast("long")
    return full.select("kind", "given", "what", score.alias("score"))


def learn_tagger(texts: DataFrame, text: str) -> Tagger:
    """Fit the tagger; its twenty numbers come to the driver."""
    found = {(r["kind"], r["given"], r["what"]): r["score"] for r in tagger_scores(texts, text).collect()}
    shapes = tuple(tuple(found["shape", tag, s] for s in range(SHAPES)) for tag in (0, 1))
    return Tagger(shapes, tuple(tuple(found["step", tag, after] for after in (0, 1)) for tag in (0, 1)))


def first_name_span(shapes: Column, tagger: Tagger) -> Column:
    """Place of the first word of the first name and of the one after its last; -1 for both without a name.

    For both tags the best path that ends in it is kept: its score, and the first name on it. Of equal paths
    the one that comes from no name wins.
    """
    names = [f"{part}{tag}" for tag in (0, 1) for part in ("score", "first", "end")]
    start = F.struct(
        F.lit(0).alias("at"), *(F.lit(v).cast("long").alias(n) for n, v in zip(names, (0, -1, -1, NEVER, -1, -1), strict=True)),
    )
    emitted = [F.array(*(F.lit(x).cast("long") for x in row)) for row in tagger.shapes]

    def step(state: Column, kind: Column) -> Column:
        out, at = [(state["at"] + 1).alias("at")], state["at"].cast("long")
        for tag in (0, 1):
            one, two = (state[f"score{before}"] + tagger.steps[before][tag] for before in (0, 1))
            named = two > one
            first = F.when(named, state["first1"]).otherwise(state["first0"])
            end = F.when(named, state["end1"]).otherwise(state["end0"])
            if tag:
                first = F.when(first < 0, at).otherwise(first)
            else:
                # the first name ends when a path leaves it
                end = F.when(named & (end < 0), at).otherwise(end)
            score = F.greatest(one, two) + F.get(emitted[tag], kind)
            out += [score.alias(f"score{tag}"), first.alias(f"first{tag}"), end.alias(f"end{tag}")]
        return F.struct(*out)

    def last(state: Column) -> Column:
        named = state["score1"] > state["score0"]
        first = F.when(named, state["first1"]).otherwise(state["first0"])
        end = F.when(named & (state["end1"] < 0), state["at"].cast("long")).when(named, state["end1"]).otherwise(state["end0"])
        return F.struct(first.cast("int").alias("first"), end.cast("int").alias("end"))

    return F.aggregate(shapes, start, step, last)


def person_names(texts: DataFrame, text: str, tagger: Tagger) -> DataFrame:
    """Add ``cue_name``, the name after a cue, and ``tagged_name``, the first one that the tagger finds where
    there is no cue. Both are clean names. A missing or empty text has none."""
    context = texts.withColumn("_context", name_context(F.col(text)))
    tokens = context.withColumn("_tokens", F.when(F.col("_context").isNull(), text_tokens(F.col(text))))
    spans = tokens.withColumn("_span", first_name_span(F.transform("_tokens", shape), tagger))
    words = F.slice("_tokens", F.col("_span.first") + 1, F.col("_span.end") - F.col("_span.first"))
    tagged = F.when(F.col("_span.first") >= 0, clean_name(F.array_join(words, " ")))
    named = spans.withColumns({"cue_name": clean_name(pick_name(F.col("_context"))), "tagged_name": tagged})
    return named.drop("_context", "_tokens", "_span")
