"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Strict patterns give the base spans, which always stay. Generators with high
recall propose overlapping further spans: every run of neighbouring digit
groups with the digits of a phone or card number, dotted and coloned groups,
anything around a sign or word for @. Boosted trees score each proposal by
its format and the text around it; a span is added where its score reaches
the threshold of its kind and it overlaps neither a base span nor an added
span of a higher score. Strict patterns drop a match that fails as a whole;
proposals also are the parts of such a match, so a phone number followed by
another number is found.

There are no labels of personal data, so the trees learn from base spans in
their surroundings, as they are and written in other ways (``DISGUISES``),
against proposals of the corpus outside base spans, other parts of the same
text, and look-alikes (dates, versions, amounts). Every base span and every
proposal of all documents is learned from or calibrates, however many there
are; those of a kind that has more than ``WINDOWS`` weigh as much as
``WINDOWS`` together, so that frequent kinds don't drown rare ones. A fourth
of them by a hash, written in ways of which training has none (``UNSEEN``),
calibrates for each kind the lowest threshold that still gives the wanted
precision. Quantiles and the sums for splits are taken over all examples, as
whole numbers, so the trees don't depend on how rows are spread; equal
examples are one row with a weight. Up to ``DRIVER_ROWS`` different ones the
driver adds up itself, more stay with the executors, with the same result.

Defined results: a null text is an empty one without spans; a null doc_id is
kept; each row gives one row, repeated or not; extra columns are not read;
without any base span the trees learn from invented data only.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepledger.llm._shared import discard, materialise, slices

KINDS = ("email", "ip", "card", "phone")
#: What all surroundings of a kind weigh at most, and characters on each side of a span.
WINDOWS, AROUND = 500, 32
TREES, DEPTH, RATE, BINS, SEED = 60, 4, 0.2, 32, 23
PRECISION, HELD, LEAST = 0.95, 0.25, 0.5
#: Invented data of each kind to learn from and to calibrate with, beside those of the corpus.
INVENTED = (350, 120)
#: Proposals scored at once.
SCORED = 4096
#: The weight of one example; weights and gradients are whole numbers of it, whose sums are exact in any order.
UNIT = 1 << 30
#: Different examples whose sums the driver makes itself.
DRIVER_ROWS = 1 << 17
#: Different examples that a task holds at once.
HELD_ROWS = 1 << 14

Span = tuple[int, int, int]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run fails or matches as a whole, so starting only at its first digit finds the same matches.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]")

# What may stand for @ and for a dot in an address, and between the groups of a number.
AT = re.compile(r"\s{0,2}(?:[(\[{<_-]\s?(?:at|a|@)\s?[)\]}>_-]|@|\uff20|%40|&#64;|(?<=\s)at(?=\s))\s{0,2}", re.I)
DOT = r"(?:\s?[(\[{<_]\s?(?:dot|\.)\s?[)\]}>_]\s?|\sdot\s|\s\.\s?|\.)"
LEFT = re.compile(rf"[A-Za-z0-9_%+-]{{1,64}}(?:{DOT}[A-Za-z0-9_%+-]{{1,64}}){{0,3}}\Z", re.I)
RIGHT = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{2,24}}){{1,4}}", re.I)
AT_HINT = re.compile(r"@|\uff20|%40|&#64;|[(\[{<_-]\s?at?\s?[)\]}>_-]|\sat\s", re.I)
GROUP = re.compile(r"[0-9]+")
BETWEEN = re.compile(r"[ .\-/_(),:\u00a0\u2009\u2010-\u2015]{1,3}")
DOTTED = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?: ?[(\[{] ?(?:\.|dot) ?[)\]}] ?| dot | ?[.,] ?)[0-9]{1,3}){3}(?![0-9])", re.I)
COLONED = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}|:)(?::[0-9A-Fa-f]{1,4}){0,5}(?![0-9A-Za-z:])")
#: Digits of a proposal, least length of its groups but the first (phone) or last (card), most groups.
NUMBERS = ((2, 12, 19, 3, 6), (3, 7, 15, 2, 6))
# Words that speak for and against, in the text before a span.
FOR = {k: re.compile(p, re.I) for k, p in {"email": r"mail|contact|write|address", "ip": r"\bip\b|host|server|address|ping", "card": r"card|visa|credit|pay|account", "phone": r"phone|tel|call|mobile|fax|contact|dial|ring"}.items()}
AGAINST = re.compile(r"version|isbn|issn|date|page|pages|order|ref|token|hash|key|price|total|sum|lot|batch|part|room|born|section|\bno\b|\bid\b|\bpp\b|\bvol\b|[$\u20ac\u00a3=#\"/]\s*$", re.I)
UNITS = re.compile(r"\s?(?:%|euros?|eur|usd|dollars?|km|kg|mm|cm|people|pages|items|times|units|pieces|bytes|years|votes|m\b)", re.I)
ENDING = re.compile(r"(?:com|org|net|edu|gov|info|io|de|fr|es|uk|it|nl|eu)\Z", re.I)


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses; each @ is looked at once."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (found := DOMAIN.match(text, at + 1)):
            end = found.end()
            out.append((start, end))
        else:
            end = max(end, at)
        at = text.find("@", max(at + 1, end))
    return out


def small_parts(address: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in address.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, by start, then kind."""
    if not HINT.search(text):
        return []
    out = [(a, 0, b) for a, b in emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if small_parts(m.group())]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isascii() and c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def numbers(text: str) -> Iterator[Span]:
    """Runs of neighbouring digit groups that have the digits of a card or phone number."""
    groups = [(m.start(), m.end()) for m in GROUP.finditer(text)]
    for i, (first, end) in enumerate(groups):
        if first and text[first - 1] == ".":  # behind a point, as in 0.1234567
            continue
        start = first
        while start and text[start - 1] in "(+" and first - start < 2:
            start -= 1
        digits, sizes, last = 0, [], end
        for k in range(i, min(len(groups), i + max(n[4] for n in NUMBERS))):
            a, b = groups[k]
            if k > i and not BETWEEN.fullmatch(text, last, a):
                break
            digits, last = digits + b - a, b
            if digits > 19:
                break
            sizes.append(b - a)
            for kind, low, high, least, most in NUMBERS:
                rest = sizes[1:] if kind == 3 else sizes[:-1]
                if low <= digits <= high and len(sizes) <= most and min(rest, default=least) >= least:
                    yield start, kind, b
            if len(sizes) > 2 and min(sizes[1:]) < 2:
                break


def candidates(text: str) -> list[Span]:
    """(start, kind, end) of all proposals."""
    out: list[Span] = []
    if AT_HINT.search(text):
        for m in AT.finditer(text):
            left = LEFT.search(text, max(0, m.start() - 72), m.start())
            right = RIGHT.match(text, m.end(), m.end() + 160)
            if left and right:
                out.append((left.start(), 0, right.end()))
                # the local part may be the last word only
                if " " in left.group():
                    out.append((m.start() - len(left.group().split()[-1]), 0, right.end()))
    if HINT.search(text):
        for pattern in (DOTTED, COLONED):
            out += [(m.start(), 1, m.end()) for m in pattern.finditer(text)]
        out += numbers(text)
    return list(dict.fromkeys(out))


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format of a span and what stands around it."""
    span, before, after = text[start:end], text[max(0, start - AROUND) : start], text[end : end + 12]
    digits = re.sub("[^0-9]", "", span)
    groups = GROUP.findall(span)
    sizes = list(map(len, groups)) or [0]
    seps = re.findall(r"[^0-9A-Za-z]+", span)
    inner = set(seps)
    parts = [int(g) for g in groups if len(g) < 4]
    colons = span.split(":")
    left, at, right = (re.split(AT, span, maxsplit=1) + ["", ""])[0], AT.search(span), re.split(AT, span, maxsplit=1)[-1]
    year = [g for g in groups if len(g) == 4 and g[:2] in ("19", "20")]
    return [
        *[float(kind == k) for k in range(4)],
        len(span),
        len(digits),
        len(groups),
        max(sizes),
        min(sizes),
        sizes[0],
        sizes[-1],
        len(set(sizes[:-1])),
        len(inner),
        max(map(len, seps), default=0),
        sum(map(len, seps)) / len(span),
        sum(c.isalpha() for c in span) / len(span),
        float(span[0] == "+" or span[:2] == "(+"),
        float(digits[:2] == "00"),
        float("(" in span),
        float("." in span),
        float("-" in span),
        float("/" in span),
        float(" " in span),
        float("," in span),
        float(luhn(digits)) if 12 <= len(digits) <= 19 else -1.0,
        float(digits[0]) if digits else -1.0,
        sum(p > 255 for p in parts),
        sum(len(g) > 1 and g[0] == "0" for g in groups),
        len(year),
        float(bool(year) and any(len(g) <= 2 and 0 < int(g) <= 12 for g in groups)),
        float(digits[:3] in ("978", "979")),
        len(colons) - 1,
        float(":" in span and max(map(len, colons)) <= 4 and (len(colons) == 8 or "::" in span)),
        float(":" in span and any(c.isalpha() for c in span)),
        float(bool(at and re.search(r"[(\[{<_&%]", at.group()))),
        float(bool(at and at.group().strip() in ("@", "\uff20"))),
        float(bool(kind == 0 and re.search(r"dot", right, re.I))),
        float(bool(kind == 0 and re.search(r"\.(?!\s)", right))),
        float(bool(kind == 0 and ENDING.search(span))),
        float(kind == 0 and len(left)),
        float(bool(FOR[KINDS[kind]].search(before))),
        float(bool(AGAINST.search(before))),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(bool(re.search(r"[0-9][ .\-/_(),:]{1,3}\Z", before))),
        float(bool(re.match(r"[ .\-/_(),:]{1,3}[0-9]", after))),
        float(before[-1:] in tuple("=\"'#$/\u20ac\u00a3-_.")),
        float(bool(UNITS.match(after))),
        float(bool(AT.match(after))),
    ]


Values = list[tuple[np.ndarray, np.ndarray]]


def quantiles(values: Values) -> list[np.ndarray]:
    """Edges of bins of equal weight, from the values of each feature and their weights."""
    out = []
    for v, w in values:
        order = np.argsort(v, kind="stable")
        upto = np.cumsum(w[order])
        wanted = np.linspace(0, 1, BINS + 1)[1:-1] * (upto[-1] if len(upto) else 0)
        out.append(np.unique(v[order][np.searchsorted(upto, wanted)]) if len(v) else np.array([]))
    return out


class Rows:
    """Binned examples with whole weights, in this process."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, w: np.ndarray, kind: np.ndarray | None = None):
        self.bins, self.y, self.w, self.kind = bins, y, w.astype(float), kind
        self.score, self.known = None, 0

    def weight(self) -> tuple[float, float]:
        """The weight of label 1 and of all."""
        return float(self.w @ self.y), float(self.w.sum())

    def sums(self, model: Boosted, tree: list[tuple], nodes: list[int]) -> np.ndarray:
        """Gradient, curvature and weight of each bin of each feature in these nodes of a tree."""
        if self.score is None:
            self.score = np.full(len(self.y), model.start)
        for grown in model.trees[self.known :]:
            self.score += model._walk(grown, self.bins)
        self.known = len(model.trees)
        place = np.full(len(tree), -1)
        place[nodes] = np.arange(len(nodes))
        place = place[model._reach(tree, self.bins)]
        inside = place >= 0
        place, bins, w = place[inside] * BINS, self.bins[inside], self.w[inside]
        prob = 1 / (1 + np.exp(-self.score[inside]))
        parts = (np.rint(w * (self.y[inside] - prob)), np.rint(w * prob * (1 - prob)), w)
        out = np.empty((len(nodes), self.bins.shape[1], BINS, 3))
        for f in range(self.bins.shape[1]):
            for c, part in enumerate(parts):
                out[:, f, :, c] = np.bincount(place + bins[:, f], part, len(nodes) * BINS).reshape(-1, BINS)
        return out

    def scored(self, model: Boosted) -> Iterator[tuple[int, float, int, int]]:
        """(kind, score, weight of label 1, weight), by kind and falling score."""
        p = model.likelihood(self.bins)
        for i in np.lexsort((-p, self.kind)):
            yield int(self.kind[i]), float(p[i]), int(self.w[i] * self.y[i]), int(self.w[i])


def merged(bins: np.ndarray, y: np.ndarray, w: np.ndarray) -> Rows:
    """Equal examples as one row, as fit() has them: gradients are rounded once for all of them."""
    found, at = np.unique(np.column_stack([bins, y.astype(np.uint8)]), axis=0, return_inverse=True)
    return Rows(found[:, :-1], found[:, -1].astype(np.int64), np.bincount(at.ravel(), w, len(found)))


class SpreadRows:
    """Binned examples with whole weights, in a frame (kind, y, w, x): the same sums."""

    def __init__(self, rows: DataFrame):
        self.rows = rows.select("kind", "y", "w", "x")

    def weight(self) -> tuple[float, float]:
        found = self.rows.agg(F.sum(F.col("w") * F.col("y")), F.sum("w")).first()
        return float(found[0] or 0), float(found[1] or 0)

    def sums(self, model: Boosted, tree: list[tuple], nodes: list[int]) -> np.ndarray:
        def run(batches):
            total = None
            for batch in batches:
                found = unpacked(batch).sums(model, tree, nodes)
                total = found if total is None else total + found
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        # a row of sums for each core
        tasks = max(1, self.rows.sparkSession.sparkContext.defaultParallelism)
        shape = (len(nodes), len(model.edges), BINS, 3)
        return sum((np.frombuffer(r["sums"]).reshape(shape) for r in self.rows.coalesce(tasks).mapInArrow(run, "sums binary").toLocalIterator()), np.zeros(shape))

    def scored(self, model: Boosted) -> Iterator[tuple[int, float, int, int]]:
        def run(batches):
            for batch in batches:
                p = model.likelihood(unpacked(batch).bins)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), batch.column(1), batch.column(2)], names=["kind", "p", "y", "w"])

        found = self.rows.mapInArrow(run, "kind int, p double, y int, w long").groupBy("kind", "p").agg(F.sum(F.col("w") * F.col("y")).alias("right"), F.sum("w").alias("w"))
        return (tuple(r) for r in found.orderBy("kind", F.desc("p")).toLocalIterator())


def unpacked(batch: pa.RecordBatch | pa.Table) -> Rows:
    """Rows from columns kind, y, w and x."""
    kind, y, w = (np.array(batch.column(i).to_pylist(), dtype=np.int64) for i in range(3))
    return Rows(np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(len(y), -1), y, w, kind)


class Boosted:
    """Gradient-boosted trees for two classes, logistic loss, binned splits."""

    def __init__(self):
        self.edges: list[np.ndarray] = []
        self.trees: list[list[tuple]] = []
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        w = np.full(len(y), UNIT)
        self.edges = quantiles([(c, w) for c in x.T])
        return self.boost(merged(self._bin(x), y, w))

    def boost(self, rows: Rows | SpreadRows) -> Boosted:
        """Grow the trees from the sums of binned rows."""
        right, total = rows.weight()
        p = min(max(right / max(total, 1.0), 0.01), 0.99)
        self.start = float(np.log(p / (1 - p)))
        for _ in range(TREES):
            self.trees.append(self._grow(rows))
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], axis=1).astype(np.uint8)

    def _grow(self, rows: Rows | SpreadRows) -> list[tuple]:
        """One tree, level by level: (feature, bin, left, right), or a value in the third place."""
        tree: list[tuple] = [(None, None, 0.0, None)]
        nodes = [0]
        for depth in range(DEPTH):
            if not nodes:
                break
            below = []
            for at, found in zip(nodes, rows.sums(self, tree, nodes) / UNIT, strict=True):
                g, h, weight = found[0].sum(axis=0) + (0.0, 1.0, 0.0)
                if depth == 0:
                    tree[at] = (None, None, RATE * g / h, None)
                if weight < 10:
                    continue
                gs, hs = np.cumsum(found[:, :-1, 0], axis=1), np.cumsum(found[:, :-1, 1], axis=1) + 1.0
                gain = gs**2 / hs + (g - gs) ** 2 / (h - hs + 2.0) - g**2 / h
                n = np.cumsum(found[:, :-1, 2], axis=1)
                gain[(n <= 0) | (n >= weight)] = 0.0
                f, k = np.unravel_index(gain.argmax(), gain.shape)
                if gain[f, k] <= 1e-6:
                    continue
                a, b = len(tree), len(tree) + 1
                tree[at] = (int(f), int(k), a, b)
                tree += [(None, None, float(RATE * gs[f, k] / hs[f, k]), None), (None, None, float(RATE * (g - gs[f, k]) / (h - hs[f, k] + 1.0)), None)]
                below += [a, b]
            nodes = below
        return tree

    def _reach(self, tree, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.empty(len(x), dtype=np.int64)
        stack = [(0, np.arange(len(x)))]
        while stack:
            at, rows = stack.pop()
            f, k, a, b = tree[at]
            if f is None:
                out[rows] = at
            else:
                left = x[rows, f] <= k
                stack += [(a, rows[left]), (b, rows[~left])]
        return out

    def _walk(self, tree, x: np.ndarray) -> np.ndarray:
        return np.array([0.0 if f is not None else a for f, _, a, _ in tree])[self._reach(tree, x)]

    def likelihood(self, binned: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.start + sum(self._walk(t, binned) for t in self.trees))))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.likelihood(self._bin(x))


def grouped(digits: str, sizes: Iterable[int], sep: str) -> str:
    """Digits in groups of these sizes, what is left being the last."""
    out, at = [], 0
    for n in sizes:
        out.append(digits[at : at + n])
        at += n
    return sep.join(filter(None, [*out, digits[at:]]))


def spelled(at: str, dot: str) -> Callable:
    """An address with other signs."""
    return lambda rng, s: (lambda name, host: f"{name}{at}{host.replace('.', dot)}")(*s.split("@", 1))


def dotted(sep: str) -> Callable:
    return lambda rng, s: s.replace(".", sep)


def fours(sep: str) -> Callable:
    return lambda rng, s: grouped(re.sub("[^0-9]", "", s), (4, 4, 4), sep)


def dialled(shape: str) -> Callable:
    """A number of ten digits, c being a country's code, in a shape."""

    def write(rng, s):
        digits = re.sub("[^0-9]", "", s)
        a, b, d = digits[-10:-7] or "212", digits[-7:-4], digits[-4:]
        return shape.format(c=digits[:-10] or "1", a=a, b=b, d=d, b1=b[:2], b2=b[2:] + d[:1], d2=d[1:3], d3=d[3:])

    return write


def coloned(short: bool) -> Callable:
    def write(rng, s):
        parts = [f"{int(rng.integers(1, 16 ** int(k))):x}" for k in rng.integers(1, 5, 8)]
        cut = int(rng.integers(2, 5))
        return ":".join(parts[:cut]) + "::" + ":".join(parts[-2:]) if short else ":".join(parts)

    return write


def once(sep: str) -> Callable:
    """One dot of an address written in another way."""

    def write(rng, s):
        parts = s.split(".")
        cut = int(rng.integers(1, len(parts)))
        return ".".join(parts[:cut]) + sep + ".".join(parts[cut:])

    return write


def regrouped(lead: str, sizes: tuple[int, ...], sep: str) -> Callable:
    """The last digits of a number behind a lead, in groups of sizes that vary by one."""

    def write(rng, s):
        digits = re.sub("[^0-9]", "", s)[-sum(sizes) :]
        return lead + grouped(digits, [n + int(rng.integers(-1, 2)) if n > 2 else n for n in sizes[:-1]], sep)

    return write


def followed(sep: str, shape: str) -> Callable:
    """A datum as it is, with a number behind it that makes its strict match fail as a whole."""
    return lambda rng, s: s + sep + "".join(str(rng.integers(1, 10)) if c == "9" else c for c in shape)


def both(first: Callable, then: Callable) -> Callable:
    return lambda rng, s: then(rng, first(rng, s))


#: Ways to write a datum of each kind that the base patterns miss. What follows a datum as it is ends behind "\x00".
DISGUISES: tuple[tuple[Callable, ...], ...] = (
    (spelled(" at ", " dot "), spelled("(at)", "."), spelled("[at]", "[dot]"), spelled(" (at) ", " (dot) "), spelled(" @ ", "."), spelled(" [at] ", "."), spelled("{at}", "{dot}"), spelled("%40", "."), spelled("@", " . "), spelled(" - at - ", ".")),
    (dotted("[.]"), dotted("(.)"), dotted("[dot]"), dotted(" . "), dotted(" dot "), coloned(False), coloned(True), once("[.]"), once("(dot)")),
    (fours("."), fours("/"), fours("_"), fours(" - "), fours("  "), regrouped("", (4, 6, 6), "."), regrouped("", (4, 6, 6), "/"), followed("\x00 ", "99"), followed("\x00 ", "9999999999999999"), followed("\x00-", "99999"), both(fours(" "), followed("\x00 ", "999")), both(fours("-"), followed("\x00 ", "9999"))),
    tuple(map(dialled, ("({a}) {b}-{d}", "{a}-{b}-{d}", "{a}.{b}.{d}", "00 {c} {a} {b} {d}", "{c}-{a}-{b}-{d}", "{c} ({a}) {b}-{d}", "0{a} {b1} {b2} {d2}", "{a}/{b}-{d}"))) + (regrouped("0", (3, 3, 2, 2), " "), regrouped("0", (2, 3, 4), "-"), regrouped("00", (2, 2, 6), " "), regrouped("00", (2, 3, 3, 2), "-"), regrouped("(0) ", (3, 4, 2), " "), regrouped("0", (3, 6), "/"), followed("\x00 ", "99.999.99.9"), followed("\x00 ", "9999999999999999"), followed("\x00 ", "99999")),
)
#: Ways that only calibration sees.
UNSEEN: tuple[tuple[Callable, ...], ...] = (
    (spelled(" AT ", " DOT "), spelled("&#64;", "."), spelled("<at>", "<dot>"), spelled(" (at) ", "."), spelled("[@]", ".")),
    (dotted("(dot)"), dotted("{.}"), dotted(" [.] "), coloned(True), once(" [.] ")),
    (fours(", "), fours(":"), fours(" . "), regrouped("", (4, 6, 6), "_"), followed("\x00 ", "999"), followed("\x00 - ", "9999")),
    tuple(map(dialled, ("({a}){b}-{d}", "{a} {b} {d}", "{c}.{a}.{b}.{d}", "00{c}-{a}-{b}-{d}", "({a}) {b} {d}"))) + (regrouped("0", (4, 2, 2, 2), "."), regrouped("00", (2, 4, 4), " "), followed("\x00 ", "9999"), followed("\x00 ", "999.99.99.99")),
)
#: Numbers and phrases that are nobody's data; y is a year, m a month, d a day, n a number up to 99, t of three digits, f of four.
LOOK_ALIKES = (
    "{y}-{m:02d}-{d:02d} {n:02d}.{m:02d}.{d:02d}", "{d:02d}/{m:02d}/{y} - {n}/{m:02d}/{y}", "{d:02d}.{m:02d}.{y}", "{y} {y} {y}", "{y}-{y}", "{y}/{y}/{y}", "{n} {n} {n} {n} {n}", "1 {t} {t} {t}", "{t} {t} {t}", "{n},{t},{t}", "{n}.{t}.{t}",
    "978-{n:02d}-{f}-{t}-1", "{f}-{f}-{f}", "{f} {f} {f} {f}", "{f}{f}{f}{f}", "{f}.{f}.{f}.{f}", "{y}-{y} {f} {f} {n}", "{n:02d}:{m:02d}:{d:02d}", "{n:02d}:{m:02d}:{d:02d}:{n:02d}", "{n}/{n}/{n}/{n}/{n}", "look at it dot dot dot", "meet at noon. Then go", "v{n}.{n}.{n}.{n}.{n}", "{n}.{t}.4{t}.7{t}", "{n}, {n}, {t}, {t}",
    "(at) the end dot", "pp. {t}-{t}", "{n}.{f}{f}", "${t},{t}.{n:02d}", "#{f}{f}", "{f}{f}{t}", "{t}-{n:02d}-{f}", "{n:02d}-{n:02d}-{n:02d}-{n:02d}-{n:02d}-{n:02d}", "{n:02d}:{n:02d}:{n:02d}:{n:02d}:{n:02d}:{n:02d}", "she is at 5. He left", "look at this dot so there", "he is at ten dot then gone", "all at once . then", "talk at it dot him", "sat at home dot by", "a1:{n:02d}:1b:2c:{n:02d}:4e", "{n:02d}:3f:{n:02d}:5b:6c:7d", "{f}:{f}:{f}:{f}", "{n}:{n}:{n}:{n}",
)


def look_alike(rng: np.random.Generator) -> str:
    """A number or phrase that is nobody's datum but may be proposed; never a card's number by its check sum."""
    shape = LOOK_ALIKES[int(rng.integers(len(LOOK_ALIKES)))]
    draw = {"y": (1900, 2030), "m": (1, 13), "d": (1, 29), "n": (1, 100), "t": (100, 1000), "f": (1000, 10000)}
    text = re.sub(r"\{(\w)(:02d)?\}", lambda m: format(int(rng.integers(*draw[m[1]])), (m[2] or ":")[1:]), shape)
    digits = re.sub("[^0-9]", "", text)
    return text[:-1] + str((int(text[-1]) + 1) % 10) if len(digits) >= 12 and luhn(digits) and text[-1].isdigit() else text


Window = tuple[int, str, str, str]
def invented(rng: np.random.Generator, n: int) -> list[Window]:
    """Data of each kind with little around them, for corpora that have few."""
    out: list[Window] = []
    for _ in range(n):
        name, host = ("".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(k))) for k in rng.integers(2, 10, 2))
        end = ("com", "org", "net", "co.uk", "de")[int(rng.integers(5))]
        before = (" ", "me at ", "is ", ", ")[int(rng.integers(4))]
        out.append((0, before, f"{name}{'._'[int(rng.integers(2))]}{int(rng.integers(100))}@{host}.{end}", " "))
        widths = ((0, 10), (10, 100), (100, 256))
        out.append((1, before, ".".join(str(int(rng.integers(*widths[int(k)]))) for k in rng.integers(0, 3, 4)), " "))
        digits = "4" + "".join(map(str, rng.integers(0, 10, 14)))
        out.append((2, before, next(digits + c for c in "0123456789" if luhn(digits + c)), " "))
        out.append((3, before, f"+{int(rng.integers(1, 99))} ({int(rng.integers(200, 1000))}) {int(rng.integers(200, 1000))}-{int(rng.integers(1000, 10000))}", " "))
    return out


def examples(known: list[Window], other: list[Window], ways=DISGUISES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels: of (kind, before, span, after) of known data in other writing, and of other proposals as they are."""
    rng = np.random.default_rng(seed)
    x, y = [], []

    def add(text: str, low: int, high: int, kind: int | None):
        for a, k, b in candidates(text):
            if a < high and b > low:
                x.append(features(text, a, k, b))
                y.append(float(k == kind and abs(a - low) <= 1 and abs(b - high) <= 1))

    for kind, before, span, after in known:
        choice = ways[kind]
        new = choice[int(rng.integers(len(choice)))](rng, span)
        core = new.partition("\x00")[0]
        add(before + new.replace("\x00", "") + after, len(before), len(before) + len(core), kind)
        new = look_alike(rng)
        add(before + new + after, len(before), len(before) + len(new), None)
    for kind, before, span, after in other:
        x.append(features(before + span + after, len(before), kind, len(before) + len(span)))
        y.append(0.0)
    return np.array(x, dtype=float).reshape(len(x), len(features("1", 0, 0, 1))), np.array(y, dtype=float)


def free(base: list[Span], found: Iterable[Span]) -> list[Span]:
    """The spans that overlap no base span."""
    merged: list[list[int]] = []
    for a, _, b in base:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    starts = [a for a, _ in merged]

    def clear(a: int, b: int) -> bool:
        i = bisect_left(starts, b) - 1
        return i < 0 or merged[i][1] <= a

    return [c for c in found if clear(c[0], c[2])]


def surroundings(doc_id, text: str) -> Iterator[tuple[int, int, bool, str, str, str]]:
    """(hash, kind, known, before, span, after) of every base span and of every other proposal of a text."""
    base = base_spans(text)
    for known, found in ((True, base), (False, free(base, candidates(text)))):
        for a, kind, b in found:
            before, span, after = text[max(0, a - AROUND) : a], text[a:b], text[b : b + AROUND]
            yield xxhash.xxh64_intdigest(f"{doc_id}:{a}:{before}{span}{after}".encode(errors="replace"), kind) >> 1, kind, known, before, span, after


def windows(docs: DataFrame, most: int = WINDOWS) -> list[tuple]:
    """(kind, known, before, span, after) of a few of each kind, those with the smallest hashes, to look at; fit() takes all."""

    def run(batches):
        held: dict[tuple[int, bool], list] = {(k, known): [] for k in range(4) for known in (True, False)}
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for h, *row in surroundings(doc_id, text or ""):
                    # the smallest hashes: a heap of negated ones
                    entry, heap = (-h, tuple(row)), held[row[0], row[1]]
                    if len(heap) < most:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
        rows = [(-h, *row) for heap in held.values() for h, row in heap]
        types = [pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["h", "kind", "known", "before", "span", "after"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = materialise(rows.mapInArrow(run, "h long, kind int, known boolean, before string, span string, after string"), "windows")
    parts = [found.where((F.col("kind") == k) & (F.col("known") == known)).orderBy("h", "before", "span", "after").limit(most) for k in range(4) for known in (True, False)]
    out = [tuple(r)[1:] for r in reduce(DataFrame.unionByName, parts).collect()]
    discard(found)
    return out


def calibrated(scored: Iterable[tuple[int, float, int, int]], precision: float = PRECISION) -> list[float]:
    """For each kind the lowest threshold with the wanted precision, from (kind, score, weight of label 1, weight) by kind and falling score."""
    out = [2.0] * 4
    for kind, rows in groupby(scored, key=itemgetter(0)):
        right = total = 0
        last = None  # a score that gives the precision, until the next lower one is known
        for score, equal in groupby(rows, key=itemgetter(1)):
            if last is not None:
                # half-way to the next lower score, for what lies between is unknown
                out[kind], last = (last + score) / 2, None
            for _, _, r, n in equal:
                right, total = right + r, total + n
            if right >= precision * total:
                last = score
        if last is not None:
            out[kind] = last
    return [max(LEAST, t) for t in out]


#: Where an example is from: twice its kind, one more if its span is known, or invented.
INVENTED_SOURCE = 8
EXAMPLE = "held boolean, source int, kind int, y int, first long, n long, x binary"


def made(held: bool) -> tuple[np.ndarray, np.ndarray]:
    """Examples of invented data, to learn from or to calibrate with."""
    rng = np.random.default_rng(SEED)
    data = [invented(rng, n) for n in INVENTED][held]
    return examples(data, [], UNSEEN if held else DISGUISES, SEED + held)


def learn(rows: list[tuple], precision: float = PRECISION) -> tuple[Boosted, list[float]]:
    """Trees and thresholds from invented data and these windows alone, each of the weight 1."""
    side = np.random.default_rng(SEED).random(len(rows)) < HELD
    parts = []
    for held in (False, True):
        known, other = ([r[:1] + r[2:] for r, h in zip(rows, side, strict=True) if bool(r[1]) == right and h == held] for right in (True, False))
        parts.append([np.concatenate(z) for z in zip(made(held), examples(known, other, UNSEEN if held else DISGUISES, SEED + held), strict=True)])
    (x, y), (xh, yh) = parts
    model = Boosted().fit(x, y)
    return model, calibrated(Rows(model._bin(xh), yh, np.full(len(yh), UNIT), xh[:, :4].argmax(axis=1)).scored(model), precision)


def every_example(docs: DataFrame) -> DataFrame:
    """All examples of all documents, equal ones of a task as one row; ``first`` counts surroundings, ``n`` examples."""

    def run(batches):
        held: dict[tuple, list[int]] = {}

        def out():
            columns = list(zip(*((*k[:4], *n, k[4]) for k, n in held.items()), strict=True)) if held else [[]] * 7
            types = [pa.bool_(), *[pa.int32()] * 3, *[pa.int64()] * 2, pa.binary()]
            batch = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in EXAMPLE.split(", ")])
            held.clear()
            return batch

        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for h, kind, known, *window in surroundings(doc_id, text or ""):
                    # the hash decides the side and the writing, wherever the row is
                    side = (h & 0xFFFF) < HELD * 0x10000
                    one = [(kind, *window)]
                    x, y = examples(one if known else [], [] if known else one, UNSEEN if side else DISGUISES, h)
                    for i, (row, label) in enumerate(zip(x, y, strict=True)):
                        count = held.setdefault((side, 2 * kind + known, int(row[:4].argmax()), int(label), row.tobytes()), [0, 0])
                        count[0] += i == 0
                        count[1] += 1
                    if len(held) >= HELD_ROWS:
                        yield out()
        yield out()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, EXAMPLE)


def fit(docs: DataFrame, driver_rows: int = DRIVER_ROWS) -> tuple[Boosted, list[float]]:
    """Trees and thresholds from every base span and every other proposal of all documents, and invented data."""
    corpus = materialise(every_example(docs), "examples")
    weights = [UNIT] * (INVENTED_SOURCE + 1)
    for r in corpus.groupBy("source").agg(F.sum("first").alias("n")).collect():
        weights[r["source"]] = max(1, round(UNIT * min(1.0, WINDOWS / r["n"])))
    invented_rows = [(held, INVENTED_SOURCE, int(row[:4].argmax()), int(label), 0, 1, row.tobytes()) for held in (False, True) for row, label in zip(*made(held), strict=True)]
    weight = F.element_at(F.array(*map(F.lit, weights)).cast("array<bigint>"), F.col("source") + 1)
    rows = corpus.unionByName(docs.sparkSession.createDataFrame(invented_rows, EXAMPLE)).withColumn("w", F.col("n") * weight).select("held", "kind", "y", "w", "x")

    def values(batches):
        for batch in batches:
            x, w = matrix(batch.column(4)), np.array(batch.column(3).to_pylist(), dtype=float)
            for f, column in enumerate(x.T):
                found, at = np.unique(column, return_inverse=True)
                sums = np.bincount(at, w).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([f] * len(found), pa.int32()), pa.array(found), pa.array(sums)], names=["f", "value", "w"])

    model = Boosted()
    # proposals are of bounded length, so a feature has a bounded number of values
    found = rows.where(~F.col("held")).mapInArrow(values, "f int, value double, w long").groupBy("f", "value").agg(F.sum("w").alias("w")).toArrow()
    feature, value, w = (found.column(i).to_numpy() for i in range(3))
    model.edges = quantiles([(value[feature == f], w[feature == f]) for f in range(len(features("1", 0, 0, 1)))])

    def binned(batches):
        for batch in batches:
            bins = model._bin(matrix(batch.column(4)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([b.tobytes() for b in bins], pa.binary())], names=batch.schema.names)

    small = materialise(rows.mapInArrow(binned, rows.schema).groupBy("held", "kind", "y", "x").agg(F.sum("w").alias("w")).select("held", "kind", "y", "w", "x"), "binned")
    discard(corpus)
    sides = [small.where(F.col("held") == held).drop("held") for held in (False, True)]
    if small.count() <= driver_rows:
        parts = [unpacked(side.toArrow()) for side in sides]
    else:
        parts = [SpreadRows(side) for side in sides]
    model.boost(parts[0])
    thresholds = calibrated(parts[1].scored(model))
    discard(small)
    return model, thresholds


def matrix(column: pa.Array) -> np.ndarray:
    """Features from rows of bytes."""
    return np.frombuffer(b"".join(column.to_pylist())).reshape(len(column), -1)


def spans(text: str, base: list[Span], model: Boosted, thresholds: list[float]) -> list[Span]:
    """Base spans and those that the model adds, by start, kind and end."""
    proposed = free(base, candidates(text))
    if not proposed:
        return base
    good: list[tuple[float, Span]] = []
    for at in range(0, len(proposed), SCORED):
        part = proposed[at : at + SCORED]
        p = model.probability(np.array([features(text, *c) for c in part], dtype=float))
        good += [(s, c) for s, c in zip(p.tolist(), part, strict=True) if s >= thresholds[c[1]]]
    starts: list[int] = []
    taken: list[Span] = []
    for _, c in sorted(good, key=lambda z: (-z[0], z[1][0] - z[1][2], z[1])):
        i = bisect_right(starts, c[0])
        if (i and taken[i - 1][2] > c[0]) or (i < len(taken) and taken[i][0] < c[2]):
            continue
        starts.insert(i, c[0])
        taken.insert(i, c)
    return sorted([*base, *taken])


def named(found: list[tuple[int, int, int]]) -> str:
    """kind:start:end of each span."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def find(docs: DataFrame, model: Boosted, thresholds: list[float]) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""

    def run(batches):
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                kinds = [k for _, k, _ in base]
                rows.append((*[kinds.count(k) for k in range(4)], hashlib.sha256(named(base).encode()).hexdigest(), named(spans(text or "", base, model, thresholds))))
            types = [pa.int64()] * 4 + [pa.string()] * 2
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]], names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind; overlapping spans by that of the first."""
    out, at = [], 0
    for a, k, b in sorted(found):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k]}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])
