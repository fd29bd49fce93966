"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may be altered by up to a share ``rate`` of them,
its error budget e. Of e + 1 pieces at least one is then found unaltered, so
one automaton of all pieces proposes every place where an item can be, and
Myers' bit-parallel distance over the text around it decides. Items of less
than ``min_chars`` characters have no budget: they match as they are, where no
letter or digit goes before or follows. Texts and items are compared in lower
case with white space turned into single spaces, and ``match_start`` and
``match_end`` are places in this plain form of the text.

Items go to the executors in blocks of bounded size, one pass over the
documents for each block.

Defined results: a null text or item is an empty one; an empty item matches
nothing; of places with equal distances the first counts; a null doc_id or item_id is kept; rows that repeat a doc_id give
their matches each; items that repeat an item_id are matched each on its own
and reported once, with the least distance; extra columns are not read.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepledger.llm._shared import slices

RATE, MIN_CHARS = 0.08, 32
#: Characters of the items that one automaton holds, about.
BLOCK_CHARS = 4 << 20
MATCHES = "doc_id long, item_id long, distance int, match_start int, match_end int"


def plain(text: str | None) -> str:
    """Lower case, single spaces."""
    return " ".join((text or "").lower().split())


def cut(item: str, budget: int) -> list[tuple[int, str]]:
    """budget + 1 pieces of an item, with their places."""
    ends = [len(item) * k // (budget + 1) for k in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:])]


def myers(item: str, text: str, budget: int) -> tuple[int, int] | None:
    """Least edit distance of the item to a part of the text and this part's end, if within the budget."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    equal: dict[str, int] = {}
    for i, ch in enumerate(item):
        equal[ch] = equal.get(ch, 0) | 1 << i
    plus, minus, score = full, 0, m
    best = None
    for at, ch in enumerate(text):
        eq = equal.get(ch, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (~(horizontal | plus) & full)
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus = down | (~(vertical | up) & full)
        minus = up & vertical
        if score <= budget and (best is None or score < best[0]):
            best = (score, at + 1)
    return best


class Matcher:
    """All places of a block of items in a text."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE, min_chars: int = MIN_CHARS):
        self.items = [(i, t, int(len(t) * rate) if len(t) >= min_chars else 0) for i, t in items if t]
        self.min_chars = min_chars
        pieces: dict[str, list[tuple[int, int, int]]] = {}
        for k, (_, text, budget) in enumerate(self.items):
            for at, piece in cut(text, budget):
                pieces.setdefault(piece, []).append((k, at, len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in pieces.items():
            self.automaton.add_word(piece, uses)
        if pieces:
            self.automaton.make_automaton()

    def matches(self, raw: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item_id, distance, start, end) of each item that is in the text, where it differs least."""
        text = plain(raw)
        if not self.items or not text:
            return []
        places: dict[int, set[int]] = {}
        for end, uses in self.automaton.iter(text):
            for k, at, size in uses:
                places.setdefault(k, set()).add(end + 1 - size - at)
        found: dict[int | None, tuple[int, int, int]] = {}
        for k, starts in places.items():
            item_id, item, budget = self.items[k]
            best = None
            if len(item) < self.min_chars:
                alone = [a for a in starts if not text[a - 1 : a].isalnum() and not text[a + len(item) : a + len(item) + 1].isalnum()]
                if alone and (0, min(alone)) < found.get(item_id, (1, 0))[:2]:
                    found[item_id] = (0, min(alone), min(alone) + len(item))
                continue
            for a, b in windows(sorted(starts), len(item), budget):
                window = text[max(0, a) : b]
                at = window.find(item)
                if at >= 0:
                    best = (0, max(0, a) + at, max(0, a) + at + len(item))
                    break
                if hit := myers(item, window, budget):
                    end = max(0, a) + hit[1]
                    if best is None or hit[0] < best[0]:
                        back = myers(item[::-1], text[max(0, end - len(item) - budget) : end][::-1], hit[0])
                        best = (hit[0], end - (back[1] if back else len(item)), end)
            if best and (item_id not in found or best < found[item_id]):
                found[item_id] = best
        return [(i, *f) for i, f in found.items()]


def windows(starts: list[int], length: int, budget: int):
    """Parts of the text around proposed starts; those that overlap become one."""
    held: list[int] | None = None
    for s in starts:
        a, b = s - budget, s + length + budget
        if held and a <= held[1] - length:
            held[1] = b
        else:
            if held:
                yield held[0], held[1]
            held = [a, b]
    if held:
        yield held[0], held[1]


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS):
    """The items, normalised, in blocks of about so many characters."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars) or 1
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r["item_id"], plain(r["text"])) for r in part.collect()]


def find(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for each document and each item that it contains."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    names = [x.split()[0] for x in MATCHES.split(", ")]

    def scan(items):
        def run(batches):
            matcher = Matcher(items, rate, min_chars)
            for batch in slices(batches):
                rows = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for m in matcher.matches(t)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        return texts.mapInArrow(run, MATCHES)

    blocks = [scan(items) for items in item_blocks(benchmark, block_chars)]
    out = blocks[0]
    for more in blocks[1:]:
        out = out.unionByName(more)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    at = docs.columns.index("text")

    def keep(items):
        def run(batches):
            matcher = Matcher(items, rate, min_chars)
            for batch in slices(batches):
                yield batch.filter(pa.array([not matcher.matches(t) for t in batch.column(at).to_pylist()], pa.bool_()))

        return run

    for items in item_blocks(benchmark, block_chars):
        docs = docs.mapInArrow(keep(items), docs.schema)
    return docs
