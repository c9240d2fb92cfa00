"""Quoted literals, model answers, dict literals and OCR blocks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperlane.functions.binding import evaluate_once

BLOCK_TYPE = "array<struct<BlockType:string,Text:string,Id:string,Confidence:double>>"
LINE_CONFIDENCE = 99.0

# How a Python literal becomes JSON, in the order of replacement.
JSON_WORDS = ((" ", ""), ("\n", ""), ("True", "true"), ("False", "false"), ("None", "null"), ("'", '"'))


def quoted_true(value: Column) -> Column:
    """Exactly the word True in single quotes."""
    return value == "'True'"


def mentions_true(value: Column) -> Column:
    """The word True anywhere in the value."""
    return value.contains("True")


# A whole or decimal number with an exponent if need be; Spark alone would also read 0.95d and 1f.
NUMBER_PATTERN = r"^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)? *$"


def quoted_double(value: Column) -> Column:
    """Number stored with quotes around it; NULL when it is no plain number."""

    def read(text: Column) -> Column:
        return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))

    return evaluate_once(F.replace(value, F.lit("'"), F.lit("")), read)


def _as_json(answer: Column) -> Column:
    for old, new in JSON_WORDS:
        answer = F.replace(answer, F.lit(old), F.lit(new))
    return answer


def answer_object(answer: Column, last: bool = False) -> Column:
    """First (or last) ``{...}`` of a model answer as JSON text; NULL when there is none.

    Braces are matched up to the nearest closing one, so a nested object comes out cut and later
    fails to parse, which counts as an empty answer.
    """
    found = F.regexp_extract_all(_as_json(answer), F.lit(r"(?s)(\{.*?\})"), F.lit(1))
    return F.try_element_at(found, F.lit(-1 if last else 1))


def answer_flag(json_object: Column, key: str, missing: bool | None = None) -> Column:
    """Boolean under ``key``; ``missing`` where the key or the object is absent.

    An explicit JSON null stays NULL. A string or a number is not a boolean and gives NULL.
    """
    value = F.from_json(json_object, f"`{key}` boolean")[key]
    if missing is None:
        return value
    known = F.coalesce(
        F.array_contains(F.json_object_keys(json_object), key), F.lit(False)
    )
    return F.when(known, value).otherwise(F.lit(missing))


def dict_literal(text: Column) -> Column:
    """Python dict literal with scalar values as a string map; NULL when it cannot be read."""
    as_json = text
    for word, token in (("None", "null"), ("True", "true"), ("False", "false")):
        as_json = F.regexp_replace(as_json, rf"([:,\[{{]\s*){word}(?=\s*[,\]}}])", rf"$1{token}")
    return F.from_json(as_json, "map<string,string>", {"allowSingleQuotes": "true"})


def blocks_to_text(blocks: Column) -> Column:
    """LINE blocks joined by line breaks; a failed job (NULL) gives the empty text."""
    lines = F.filter(blocks, lambda block: block["BlockType"] == "LINE")
    texts = F.transform(lines, lambda block: block["Text"])
    return F.coalesce(F.array_join(texts, "\n"), F.lit(""))


def text_to_blocks(text: Column) -> Column:
    """One LINE block per non-blank line; the id keeps the number of the line in the text."""
    numbered = F.transform(
        F.split(text, "\n", -1),
        lambda line, i: F.struct(
            F.lit("LINE").alias("BlockType"),
            line.alias("Text"),
            F.concat(F.lit("line_"), i.cast("string")).alias("Id"),
            F.lit(LINE_CONFIDENCE).alias("Confidence"),
        ),
    )
    return F.filter(numbered, lambda block: block["Text"].rlike(r"(?U)\S"))


def render_prompt(template: str, values: dict[str, Column]) -> Column:
    """Fill ``$name`` and ``${name}`` of a prompt template; other marks stay as they are.

    The template is cut on the driver, so the document text is inserted as it is and never
    searched for marks itself.
    """
    pieces, done = [], 0
    for mark in re.finditer(r"\$(?:\{(\w+)\}|(\w+))", template):
        name = mark.group(1) or mark.group(2)
        if name in values:
            pieces += [F.lit(template[done:mark.start()]), values[name]]
            done = mark.end()
    return F.concat(*pieces, F.lit(template[done:]))


def chat_messages(prompt: Column, role: str = "user") -> Column:
    """A prompt in the message form of a chat model, as JSON."""
    return F.to_json(F.array(F.struct(F.lit(role).alias("role"), prompt.alias("content"))))


def safe_timestamp(text: Column, formats: Sequence[str]) -> Column:
    """First format that fits; NULL when none does."""
    return F.coalesce(
        *[F.try_to_timestamp(text, F.lit(form)).cast("timestamp_ntz") for form in formats]
    )


def split_full_name(name: Column) -> tuple[Column, Column]:
    """First name and the rest, split at the first blank."""
    parts = F.split(name, " ", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def unify_date(text: Column, mark: str = ".") -> Column:
    """Slashes and dashes of a date become one separator."""
    return F.replace(F.replace(text, F.lit("/"), F.lit(mark)), F.lit("-"), F.lit(mark))
