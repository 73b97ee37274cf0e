"""Personal data by base patterns and a skip-chain conditional random field.

The nodes of a document's field are its words that hold a digit or an at sign. Neighbouring nodes share a chain
potential. Nodes with the same key (same digits, seven at least, or same lower-case letters and digits) share a skip
potential with one of them, however far apart: the first that a base span holds, else the first that is valid as it stands (a card's check digit, an address's
four numbers). So any two mentions are at most two steps from each other, and mentions without any evidence of their own don't lift one another. Sum-product messages pass over this loopy graph, damped, until none changes by more than ``TOLERANCE`` (``MAX_ROUNDS``
at most), in blocks of edges, so temporary memory is bounded; nodes inside base spans are held at their kind. Free nodes whose belief in one kind reaches
``SURE`` become more spans, neighbours of one kind (``+1``, ``(555``, ``123-4567``) one span together, if the whole is valid for its kind (``holds``); base spans
always stay. So a number that is plainly a phone number in one place is one also where it stands without its plus sign.

Weights are fitted in pieces on at most ``TRAIN_DOCS`` documents (those with such words whose ids hash lowest; of equal rows one), with
the base spans as labels: a multinomial regression on the shape of a word (at most ``TRAIN_NODES`` words of a document, drawn by a hash
of their place), and smoothed log ratios of label pairs on all their chain and skip edges. Tagging covers every document, whole.

Defined results: null text counts as empty and has no spans; equal texts have equal spans; documents with null or repeated ids
are rows like others; without any document to fit on only base spans are found; an empty table gives no rows; ``mask`` keeps further
columns under any names, ``find`` those that it is asked to keep.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import add_columns, beside, together
from .common import mix64, table
from .spans import span_text

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 2000
TRAIN_NODES = 200
SURE = 0.9
MAX_ROUNDS, TOLERANCE = 60, 1e-3
#: Nodes, and edges, whose shapes and messages are made at once.
BLOCK = 1 << 14
#: Pseudo-counts, spread as independent labels are; prior weight of the claim that two ends of a skip edge bear one label.
SMOOTH, ALIKE = 10.0, 0.9
#: Letters and digits from which on equal words are taken as mentions of one thing.
LEAST_KEY = 5

_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_local = re.compile(r"[A-Za-z0-9._%+-]+")
# A run of digits matches from its first digit or not at all, so the look-behind changes nothing but the time.
_ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What may stand between the words of one mention; characters of a mention, at most, that is put together.
_between = re.compile(r"[\x20().,-]{1,3}")
MOST_CHARS = 60
_digit = re.compile("[0-9]")
_mark = re.compile("[0-9@]")
_word_end = re.compile(r"[^\x20\x09-\x0D]*")
_blanks = "\x20\t\n\v\f\r"

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """From each at sign outwards: as the leftmost match of the whole pattern, in linear time."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        if at >= free:
            left = _local.match(text[free:at][::-1])
            right = _domain.match(text, at + 1)
            if left and right:
                out.append((at - left.end(), 0, right.end()))
                free = right.end()
            else:
                free = at + 1
        at = text.find("@", at + 1)
    return out


def octets(text: str) -> bool:
    """True for four numbers of at most 255."""
    parts = text.split(".")
    return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in parts)


def holds(kind: int, text: str) -> bool:
    """True if ``text`` can be a whole mention of the kind."""
    digits = "".join(filter("0123456789".__contains__, text))
    if kind == 0:
        return "@" in text[1:-1]
    if kind == 1:
        return octets(text)
    if any(c.isalpha() for c in text):
        return False
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 7 <= len(digits) <= 15


def base_spans(text: str) -> list[Span]:
    """All base spans, by start, then kind."""
    out = emails(text) if "@" in text else []
    if _digit.search(text):
        out += [(m.start(), 1, m.end()) for m in _ip.finditer(text) if octets(m[0])]
        for m in _card.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _phone.finditer(text) if 10 <= sum(map(str.isdigit, m[0])) <= 15]
    return sorted(out)


@dataclass(slots=True)
class Node:
    start: int
    end: int
    word: int  # a number that grows with the distance between nodes
    core: str
    key: str


def nodes(text: str) -> list[Node]:
    """The words with a digit or an at sign, without punctuation at their ends."""
    out, at = [], 0
    while m := _mark.search(text, at):
        start = max(text.rfind(b, at, m.start()) for b in _blanks) + 1
        start, end = max(start, at), _word_end.match(text, m.end()).end()
        at = end
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while start < end and not text[end - 1].isalnum():
            end -= 1
        if start < end:
            core = text[start:end]
            digits = "".join(filter("0123456789".__contains__, core))
            out.append(Node(start, end, start // 24, core, digits if len(digits) >= 7 else "".join(filter(str.isalnum, core.lower()))))
    return out


SHAPE = 27


def shape(node: Node) -> np.ndarray:
    x = np.zeros(SHAPE)
    core = node.core
    n_digits = sum(c in "0123456789" for c in core)
    x[0] = 1
    x[1 + min(7, (n_digits + 2) // 3)] = 1
    x[9] = "@" in core
    x[10 + min(4, core.count("."))] = 1
    x[15] = core.startswith("+")
    x[16] = "-" in core
    x[17] = n_digits == len(core)
    x[18] = any(c.isalpha() for c in core)
    x[19] = "(" in core
    x[20] = "@" in core and "." in core.partition("@")[2]
    x[21] = len(core) > 30
    card = 14 <= n_digits <= 19 and not x[18]
    x[22], x[23] = card and holds(2, core), card and not holds(2, core)
    dotted = core.count(".") == 3 and core.replace(".", "").isdigit()
    x[24], x[25] = dotted and octets(core), dotted and not octets(core)
    x[26] = 10 <= n_digits <= 15 and not x[18]
    return x


def labels(found: list[Node], spans: list[Span]) -> np.ndarray:
    """1 + kind of the base span that a node meets, 0 for none. Spans are few; both lists are in order of start."""
    out = np.zeros(len(found), np.int64)
    starts = np.array([n.start for n in found])
    ends = np.array([n.end for n in found])
    for s, kind, e in spans:
        lo, hi = np.searchsorted(ends, s, side="right"), np.searchsorted(starts, e)
        free = out[lo:hi] == 0
        out[lo:hi][free] = 1 + kind
    return out


def valid(node: Node) -> bool:
    """True for what a check digit or the form alone makes a mention."""
    return holds(1, node.core) or holds(2, node.core)


def edges(found: list[Node], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chain edges between near neighbours, and skip edges from a key's anchor to its other nodes: each a row of two. A key without known or valid node has no anchor."""
    chain = [(i - 1, i) for i in range(1, len(found)) if found[i].word - found[i - 1].word <= 2]
    anchor: dict[str, int] = {}
    for i, n in enumerate(found):
        if len(n.key) >= LEAST_KEY and (known[i] or valid(n)) and (n.key not in anchor or (known[i] and not known[anchor[n.key]])):
            anchor[n.key] = i
    skip = [(anchor[n.key], i) for i, n in enumerate(found) if anchor.get(n.key, i) != i]
    return np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 2)


@dataclass
class Field:
    weights: np.ndarray  # shape features by labels
    chain: np.ndarray  # log potential of two labels
    skip: np.ndarray

    def beliefs(self, found: list[Node], known: np.ndarray) -> np.ndarray:
        """Marginals of every node by loopy message passing."""
        unary = np.concatenate([np.stack([shape(n) for n in found[k : k + BLOCK]]) @ self.weights for k in range(0, len(found), BLOCK)])
        held = known > 0
        unary[held] = -30.0
        unary[held, known[held]] = 0.0
        chain, skip = edges(found, known)
        n = len(chain) + len(skip)
        if not n:
            return _softmax(unary)
        ends = np.concatenate([chain, skip])
        start, end = np.concatenate([ends[:, 0], ends[:, 1]]), np.concatenate([ends[:, 1], ends[:, 0]])
        kind = np.repeat(np.arange(4, dtype=np.int8), [len(chain), len(skip)] * 2)
        tables = np.stack([self.chain, self.skip, self.chain.T, self.skip.T])
        message = np.zeros((2 * n, unary.shape[1]))
        for _ in range(MAX_ROUNDS):
            total, last, change = self._total(unary, end, message), message, 0.0
            message = np.empty_like(last)
            for k in range(0, 2 * n, BLOCK):
                some = slice(k, k + BLOCK)
                back = (np.arange(k, min(k + BLOCK, 2 * n)) + n) % (2 * n)
                out = (total[start[some]] - last[back])[:, :, None] + tables[kind[some]]
                top = out.max(1, keepdims=True)
                new = np.log(np.exp(out - top).sum(1)) + top[:, 0]
                new -= new.max(1, keepdims=True)
                message[some] = 0.5 * last[some] + 0.5 * new
                change = max(change, float(np.abs(message[some] - last[some]).max()))
            if change < TOLERANCE:
                break
        return _softmax(self._total(unary, end, message))

    @staticmethod
    def _total(unary: np.ndarray, end: np.ndarray, message: np.ndarray) -> np.ndarray:
        return unary + np.stack([np.bincount(end, m, len(unary)) for m in message.T], 1)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def tag(text: str, field: Field | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    base = base_spans(text)
    found = nodes(text) if field else []
    if not found:
        return base, base
    return base, sorted([*base, *added(text, found, labels(found, base), field)])


def added(text: str, found: list[Node], known: np.ndarray, field: Field) -> list[Span]:
    """The spans of free nodes: of each run of neighbours that are surely of one kind, the longest valid parts from the left."""
    p = field.beliefs(found, known)
    kinds = np.where((known == 0) & (p.max(1) >= SURE), p.argmax(1), 0)
    out: list[Span] = []
    i = 0
    while i < len(found):
        last = None
        if kind := int(kinds[i]):
            j = i
            while True:
                piece = text[found[i].start : found[j].end]
                if holds(kind - 1, piece):
                    last = j
                j += 1
                if j == len(found) or kinds[j] != kind or len(piece) > MOST_CHARS or not _between.fullmatch(text, found[j - 1].end, found[j].start):
                    break
        if last is not None:
            out.append((found[i].start, kind - 1, found[last].end))
        i = (i if last is None else last) + 1
    return out


def hidden(text: str, field: Field) -> tuple[int, int, int, int]:
    """How well the field finds what it isn't shown: every other base span whose key stands in another one is hidden. (hidden, found again, added, of those hidden or within one)."""
    base = base_spans(text)
    found = nodes(text)
    key = {s: tuple(n.key for n in found if n.start < s[2] and n.end > s[0]) for s in base}
    seen: dict[tuple, int] = {}
    away: list[Span] = []
    for s in base:
        seen[key[s]] = seen.get(key[s], 0) + 1
        if seen[key[s]] % 2 == 0:
            away.append(s)
    if not away:
        return 0, 0, 0, 0
    got = added(text, found, labels(found, [s for s in base if s not in away]), field)
    meets = lambda a, b: a[1] == b[1] and a[0] < b[2] and b[0] < a[2]
    free = [g for g in got if not any(meets(g, s) for s in base if s not in away)]
    return len(away), sum(any(meets(s, g) for g in free) for s in away), len(free), sum(any(meets(g, s) for s in away) for g in free)


def fit_field(x: np.ndarray, y: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> Field:
    """Piecewise: a penalised multinomial regression, and log ratios of pair counts to those of independent labels."""
    k = len(KINDS) + 1
    w = np.zeros((SHAPE, k))
    target = np.eye(k)[y]
    velocity = np.zeros_like(w)
    for _ in range(400):
        grad = x.T @ (target - _softmax(x @ w)) / len(y) - 1e-3 * w
        velocity = 0.9 * velocity + grad
        w += 0.3 * velocity
    share = np.bincount(y, minlength=k) + 1.0
    share /= share.sum()

    def ratio(counts: np.ndarray, alike: float) -> np.ndarray:
        counts = counts + counts.T + SMOOTH * share[:, None] * share[None]
        joint = (1 - alike) * counts / counts.sum() + alike * np.diag(share)
        return np.clip(np.log(joint) - np.log(share[:, None] * share[None]), -8, 8)

    return Field(w, ratio(chain, 0.0) / 2, ratio(skip, ALIKE))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Field | None:
    """The field's weights from a bounded sample; counts of nodes, labels and label pairs come to the driver."""
    marked = docs.where(F.col(f"`{text}`").rlike("[0-9@]")).select(F.col(f"`{doc_id}`").alias("s_id"), F.xxhash64(f"`{text}`").alias("s_hash"))
    chosen = marked.orderBy(F.xxhash64("s_id", "s_hash"), "s_hash").limit(TRAIN_DOCS)
    # TRAIN_DOCS rows of two numbers are broadcast.
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("hash"))
    rows = rows.join(F.broadcast(chosen.distinct()), F.col("id").eqNullSafe(F.col("s_id")) & (F.col("hash") == F.col("s_hash")), "left_semi")
    rows = rows.groupBy("id", "hash").agg(F.first("text").alias("text"))  # a chosen pair may be on any number of rows
    k = len(KINDS) + 1

    def measure():
        def work(texts: list[str]) -> list[pa.Array]:
            xs, ys, pairs = [], [], []
            for t in texts:
                found = nodes(t)
                known = labels(found, base_spans(t))
                counts = np.zeros((2, k, k))
                for table_, e in zip(counts, edges(found, known), strict=True):
                    np.add.at(table_, (known[e[:, 0]], known[e[:, 1]]), 1)
                drawn = np.argsort(mix64(np.arange(1, len(found) + 1, dtype=np.uint64)))[:TRAIN_NODES]
                xs.append([float(v) for i in drawn for v in shape(found[i])])
                ys.append(known[drawn].tolist())
                pairs.append(counts.ravel().tolist())
            return [pa.array(xs, pa.list_(pa.float64())), pa.array(ys, pa.list_(pa.int64())), pa.array(pairs, pa.list_(pa.float64()))]

        return work

    schema = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("y", T.ArrayType(T.LongType())), T.StructField("pairs", T.ArrayType(T.DoubleType()))])
    got = add_columns(rows, "text", ["hash"], schema, measure).toArrow().sort_by("hash")  # rows of one hash are one text
    x, y, pairs = (got[c].combine_chunks().flatten().to_numpy() for c in ("x", "y", "pairs"))
    if not len(y):
        return None
    x = x.reshape(-1, SHAPE)
    counts = pairs.reshape(-1, 2, k, k).sum(0)
    return fit_field(x, y, counts[0], counts[1])


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind_no", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("end", T.IntegerType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind_no", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))


def _column(spans: list[list[Span]]) -> pa.Array:
    return pa.array([[{"start": s, "kind_no": k, "kind": KINDS[k], "end": e} for s, k, e in one] for one in spans], _ARROW_SPANS)


def find(docs: DataFrame, field: Field | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` of ``docs`` with ``pii_base`` and ``pii_spans`` (code points, end exclusive)."""

    def work():
        def run(texts: list[str]) -> list[pa.Array]:
            both = [tag(t, field) for t in texts]
            return [_column([b for b, _ in both]), _column([a for _, a in both])]

        return run

    return add_columns(docs, text, keep, T.StructType([T.StructField("pii_base", _SPANS), T.StructField("pii_spans", _SPANS)]), work)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; of overlapping spans the first counts, lengthened by the others."""
    out, at = [], 0
    for s, kind, e in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[kind].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, field: Field | None, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with personal data masked and ``n_chars`` (where there is such a column) as the new length; other columns stay, null texts too."""
    added = T.StructType([T.StructField("masked", T.StringType())])
    masks = lambda texts: [pa.array([masked(t, tag(t, field)[1]) for t in texts], pa.string())]
    done = add_columns(beside(docs, text, "row", "body"), "body", ["row"], added, lambda: masks)
    length = {n_chars: F.when(F.col("row").getField("some"), F.length("masked")).cast(docs.schema[n_chars].dataType)} if n_chars in docs.columns else {}
    return done.select(*together(docs.columns, text, "row", F.col("masked"), **length))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, fit(docs), ["doc_id"])
    count = lambda kind: F.size(F.filter("pii_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(span_text(F.col("pii_base")), 256).alias("base_sha256"), span_text(F.col("pii_spans")).alias("spans"))
