"""Native text expressions for rendered outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space is that of Unicode, as in Python patterns over text.
OUTPUT = r"(?sU)^\s*<think>(.*?)</think>\s*(.*)$"
THOUGHT = r"(?sU)^\s*<think>.*?</think>\s*"
SPACE = r"(?U)\s+"
ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, ENDS, "")


def has_thought(output: Column) -> Column:
    """Whether an output is a thought in its tags and then something."""
    return F.coalesce(output.rlike(OUTPUT), F.lit(False))


def thought(output: Column) -> Column:
    """The text up to the first closing tag."""
    return F.when(has_thought(output), F.regexp_extract(output, OUTPUT, 1))


def call_text(output: Column) -> Column:
    """What follows the first closing tag, stripped."""
    return F.when(has_thought(output), strip(F.regexp_extract(output, OUTPUT, 2)))


def without_thought(output: Column) -> Column:
    """The call of an output as text; an output without a thought as it is."""
    return F.regexp_replace(output, THOUGHT, "")


def without_fences(text: Column) -> Column:
    """Without a Markdown code fence around it."""
    bare = strip(text)
    opened = F.regexp_replace(F.regexp_replace(bare, r"(?U)^```[A-Za-z]*\s*", ""), r"(?U)\s+$", "")
    inner = F.when(opened.endswith("```"), F.regexp_replace(F.left(opened, F.length(opened) - 3), r"(?U)\s+$", "")).otherwise(opened)
    return F.when(bare.startswith("```"), inner).otherwise(bare)


def render(thinking: Column, call: Column) -> Column:
    """An output from its thought and the text of its call."""
    return F.concat(F.lit("<think>"), thinking, F.lit("</think>"), call)


def token_set(text: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Shared part of two token sets; 1 for two empty ones, 0 if one is empty."""
    both, one = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(one == 0, F.lit(1.0)).otherwise(both / F.greatest(one, F.lit(1)))


def error_bucket(error: Column) -> Column:
    """The first 80 characters, stripped."""
    return strip(F.substring(F.coalesce(error, F.lit("")), 1, 80))


def table_cell(error: Column) -> Column:
    """80 characters that fit into a Markdown table."""
    return F.replace(F.substring(F.coalesce(error, F.lit("")), 1, 80), F.lit("|"), F.lit("\\|"))


def run_family(name: Column) -> Column:
    """family and seed of a run name that ends in -seed and digits."""
    parts = r"^(.+)-seed(\d+)$"
    hit = name.rlike(parts)
    return F.struct(F.when(hit, F.regexp_extract(name, parts, 1)).otherwise(name).alias("family"), F.when(hit, F.regexp_extract(name, parts, 2).try_cast("bigint")).alias("seed"))


def response_content(body: Column) -> Column:
    """The text of a saved model response: the first choice's message, else its text, else the text blocks together."""
    parsed = F.from_json(body, "choices array<struct<message:struct<content:string>,text:string>>, content array<struct<type:string,text:string>>")
    first = F.get(parsed["choices"], 0)
    blocks = F.filter(parsed["content"], lambda b: b["type"] == "text")
    return F.coalesce(first["message"]["content"], first["text"], F.when(F.size(blocks) > 0, F.array_join(F.transform(blocks, lambda b: b["text"]), "")))
