"""Language-model scores by a subword lattice.

A text is a sequence of pieces of an existing subword vocabulary and an end
token; each word opens with the vocabulary's mark for white space. All
segmentations of a text count: forward recursion in log space sums up the
products of their pieces' weights, so a score is the marginal log10
probability of the text, not that of its best segmentation.

The vocabulary that is installed is a byte-pair one, whose scores are ranks
and no probabilities. In their place the unigram weights are how often the
vocabulary's own segmentation of the training documents uses a piece, every
occurrence of a word counted, smoothed by a half.

Pieces never cross white space, so the recursion runs once for each distinct
word, not for each occurrence. Documents are dealt into chunks with a word
list each; word lists are counted, scored and joined back, which moves a word
once for each chunk and not once for each document.

Defined results: a null text is an empty one and has the end token only; rows
with a null doc_id train the model; rows that repeat a doc_id count and are
scored one by one; without any training row all pieces weigh the same; texts
of any length are scored whole; extra columns are not read.
"""

from __future__ import annotations

import math
import os
from collections import defaultdict
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepledger.llm._shared import materialise, slices

#: Characters and rows of a chunk at most, a longer text being one of its own.
CHUNK_CHARS, CHUNK_ROWS = 16 << 20, 8192
#: Words that the recursion takes together, and characters of a word that takes it alone.
BLOCK, LONG = 4096, 48
SMOOTH = 0.5
PIECES = "piece_bpe_32k.model"

CHUNK = pa.schema([("chunk", pa.int64()), ("idx", pa.int32()), ("word", pa.string()), ("c", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n", pa.int64()), ("ids", pa.binary())])
CHUNK_DDL = "chunk long, idx int, word string, c long, doc_id long, held_out boolean, n long, ids binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def vocabulary(name: str = PIECES) -> str:
    """The place of a subword vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(doc_id) -> F.Column:
    """Whether a row is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def pack_ids(ids: np.ndarray) -> bytes:
    """Sorted indices as differences, in two bytes each where these suffice."""
    steps = np.diff(np.sort(ids), prepend=0)
    return steps.astype("<u2" if steps.max(initial=0) < 1 << 16 else "<u4").tobytes()


def unpack_ids(raw: bytes, n: int) -> np.ndarray:
    """What pack_ids has packed, sorted."""
    return np.cumsum(np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * n else "<u4"), dtype=np.int64)


def chunks(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: the words of a chunk with their training counts, and its documents as indices of these."""

    def close(rows):
        chunk = int.from_bytes(os.urandom(8), "big") >> 1
        index = defaultdict(count().__next__)
        packed, trained = [], []
        for doc_id, held, text in rows:
            words = (text or "").encode().lower().split()
            ids = np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))
            packed.append((doc_id, held, len(words), pack_ids(ids)))
            if not held:
                trained.append(ids)
        counts = np.bincount(np.concatenate(trained) if trained else np.zeros(0, dtype=np.int64), minlength=len(index))
        size = 1 << 16
        words = [w.decode() for w in index]
        for at in range(0, len(words), size):
            part = words[at : at + size]
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(part)), pa.array(np.arange(at, at + len(part), dtype=np.int32)), pa.array(part), pa.array(counts[at : at + size]), *[pa.nulls(len(part), t) for t in CHUNK.types[4:]]], schema=CHUNK)
        columns = [pa.array(list(x), t) for x, t in zip(zip(*packed, strict=True), CHUNK.types[4:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(packed)), *[pa.nulls(len(packed), t) for t in CHUNK.types[1:4]], *columns], schema=CHUNK)

    def run(batches):
        rows, size = [], 0
        for batch in slices(batches):
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                rows.append(row)
                size += len(row[2] or "")
                if size >= CHUNK_CHARS or len(rows) >= CHUNK_ROWS:
                    yield from close(rows)
                    rows, size = [], 0
        if rows:
            yield from close(rows)

    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(run, CHUNK_DDL)


@lru_cache(maxsize=2)
def processor(path: str):
    """The subword library with a vocabulary."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_counts(words: DataFrame, path: str) -> np.ndarray:
    """How often the vocabulary's own segmentations use each piece in words that occur c times."""

    def run(batches):
        model = processor(path)
        total = np.zeros(model.get_piece_size(), dtype=np.int64)
        for batch in batches:
            found = model.encode(batch.column(0).to_pylist(), num_threads=1)
            times = np.repeat(batch.column(1).to_numpy(), [len(ids) for ids in found])
            np.add.at(total, np.fromiter((i for ids in found for i in ids), dtype=np.int64, count=len(times)), times)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "n"])

    rows = words.select("word", "c").mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(processor(path).get_piece_size())
    for r in rows:
        counts[r["piece"]] = r["n"]
    return counts


def weights(path: str, counts: np.ndarray, ends: int) -> tuple[dict[int, float], float]:
    """Logarithms of the weights of all pieces and of the end token, which add up to 1 as weights."""
    model = processor(path)
    real = [i for i in range(len(counts)) if not (model.is_control(i) or model.is_unknown(i))]
    smooth = counts[real] + SMOOTH
    total = smooth.sum() + ends + SMOOTH
    return dict(zip(real, np.log(smooth / total), strict=True)), math.log((ends + SMOOTH) / total)


class Lattice:
    """Marginal log probabilities of words under unigram weights of pieces."""

    def __init__(self, path: str, counts: np.ndarray, ends: int):
        model = processor(path)
        logs, self.end = weights(path, counts, ends)
        self.bytes = np.full(256, -np.inf)
        self.pieces = {}
        for i in logs:
            if model.is_byte(i):
                self.bytes[int(model.id_to_piece(i)[3:5], 16)] = logs[i]
            else:
                self.pieces[model.id_to_piece(i)] = logs[i]
        nodes: dict[tuple[int, int], int] = {}
        ends = [-np.inf]
        for piece, log in self.pieces.items():
            at = 0
            for ch in piece:
                key = (at, ord(ch))
                if key not in nodes:
                    nodes[key] = len(ends)
                    ends.append(-np.inf)
                at = nodes[key]
            ends[at] = log
        keys = np.array([a << 21 | b for a, b in nodes], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.child = keys[order], np.array(list(nodes.values()), dtype=np.int64)[order]
        self.ends = np.array(ends)
        self.first = np.zeros(0x110000, dtype=np.int32)
        for (at, ch), to in nodes.items():
            if not at:
                self.first[ch] = to
        self.longest = max(map(len, self.pieces))

    def alone(self, word: str) -> float:
        """Forward recursion over one word."""
        text = "▁" + word
        sums = [-math.inf] * (len(text) + 1)
        sums[0] = 0.0
        for i, ch in enumerate(text):
            here = sums[i]
            edges = [(i + 1, float(self.bytes[list(ch.encode())].sum()))]
            edges += [(j, self.pieces[p]) for j in range(i + 1, min(len(text), i + self.longest) + 1) if (p := text[i:j]) in self.pieces]
            for j, log in edges:
                sums[j] = float(np.logaddexp(sums[j], here + log))
        return sums[-1]

    def together(self, words: list[str]) -> np.ndarray:
        """Forward recursion over words of one length."""
        width = len(words[0]) + 1
        chars = np.frombuffer("".join("▁" + w for w in words).encode("utf-32-le"), dtype="<u4").reshape(-1, width).astype(np.int64)
        seen, back = np.unique(chars, return_inverse=True)
        spelled = np.array([self.bytes[list(chr(c).encode())].sum() for c in seen])[back.reshape(chars.shape)]
        sums = np.full((width + 1, len(words)), -np.inf)
        sums[0] = 0.0
        for i in range(width):
            sums[i + 1] = np.logaddexp(sums[i + 1], sums[i] + spelled[:, i])
            rows = np.arange(len(words))
            state = self.first[chars[:, i]].astype(np.int64)
            rows, state = rows[state > 0], state[state > 0]
            for j in range(i + 1, width + 1):
                log = self.ends[state]
                end = log > -np.inf
                to = rows[end]
                sums[j, to] = np.logaddexp(sums[j, to], sums[i, to] + log[end])
                if j == width or not len(rows):
                    break
                key = state << 21 | chars[rows, j]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                good = self.keys[at] == key
                rows, state = rows[good], self.child[at[good]]
        return sums[width]

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Natural logarithms of the marginals, in the order of the words."""
        out = np.empty(len(words))
        by_length = defaultdict(list)
        for k, w in enumerate(words):
            by_length[len(w)].append(k)
        for length, group in by_length.items():
            if length > LONG:
                for k in group:
                    out[k] = self.alone(words[k])
                continue
            for a in range(0, len(group), BLOCK):
                part = group[a : a + BLOCK]
                out[part] = self.together([words[k] for k in part])
        return out


def score(docs: DataFrame, path: str) -> DataFrame:
    """Counts, base score and lattice score of every document."""
    cut = materialise(chunks(docs), "chunks")
    words = cut.where(F.col("word").isNotNull()).select("chunk", "idx", "word", "c")
    texts = cut.where(F.col("n").isNotNull()).select("chunk", "doc_id", "held_out", "n", "ids")
    counted = materialise(words.groupBy("word").agg(F.sum("c").alias("c")), "words")
    known = counted.where("c > 0")
    got = known.agg(F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    ends = texts.where(~F.col("held_out")).count()
    tokens, types = got["n"] + ends, got["v"] + (ends > 0)
    below = math.log10(tokens + 0.5 * (types + 1))
    pieces = piece_counts(known, path)
    end_log = weights(path, pieces, ends)[1] / math.log(10)

    def weigh(batches):
        lattice = Lattice(path, pieces, ends)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lattice.log_probabilities(batch.column(0).to_pylist()) / math.log(10))], names=["word", "c", "log"])

    weighed = counted.select("word", "c").mapInArrow(weigh, "word string, c long, log double")
    listed = words.select("chunk", "idx", "word").join(weighed, "word").select(F.col("chunk").alias("of"), "idx", "c", "log")

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        at = right.column("idx").to_numpy()
        c, log = np.zeros(len(at), dtype=np.int64), np.zeros(len(at))
        c[at], log[at] = right.column("c").to_numpy(), right.column("log").to_numpy()
        base = np.log10(c + 0.5)
        rows = []
        for doc_id, held, n, raw in zip(*[left.column(k).to_pylist() for k in ("doc_id", "held_out", "n", "ids")], strict=True):
            ids = unpack_ids(raw, n)
            total = n + 1
            rows.append((doc_id, held, total, int((c[ids] > 0).sum()) + (ends > 0), tokens, float(base[ids].sum()) + math.log10(ends + 0.5) - total * below, float(log[ids].sum()) + end_log))
        types_ = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        names = [x.split()[0] for x in SCORES.split(", ")]
        return pa.table([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), types_, strict=True)] if rows else [pa.array([], t) for t in types_], names=names)

    return texts.groupBy("chunk").cogroup(listed.groupBy("of")).applyInArrow(add_up, SCORES)
