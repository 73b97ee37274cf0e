"""BPE encoding and decoding by a segment tree over the ranks of adjacent pairs.

Each distinct piece of text is encoded once per task memory: the leaves of a segment tree hold
``rank * width + position`` for every adjacent pair that merges, so the root is the leftmost pair of lowest
rank. Merging it changes three leaves, each with one path to the root. Many pieces of like width are
encoded together: every step of the loop merges one pair in each of them with array operations. Few of a width, such as a very long
piece, go one by one through a tree of plain numbers, whose updates stop where nothing changes above.

The vocabulary file is the one of the ``tokenizers`` library (JSON); its path is a parameter, read in each task
from the folder where that package is installed.

Defined results: null text counts as empty and has no ids; texts of any length are read and decoded in parts cut at
blanks; special tokens in a text are matched as such; rows are independent, so repeated rows, ties, empty tables and
further columns need no care. Code points that this Python's Unicode tables do not know go through the
library's own normaliser and splitter.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import add_columns, check_names, kept, segments
from .common import table

#: Bytes of text that are encoded at once: their new words meet in the groups below, and their lists and ids are held beside the memories.
SLICE = 1 << 18
#: Bytes that a task may hold as ids of words, and as many of pieces of words. Results don't depend on it, only how often a rare word is encoded again.
CACHED_BYTES = 24 << 20
#: What an entry takes beyond its own bytes: two objects and their place in a dictionary.
ENTRY_BYTES = 150
#: Cells of the tree of one group of pieces.
GROUP_CELLS = 1 << 17
#: Fewer pieces of a width than this are merged one by one.
LEAST_GROUP = 12
#: Ids that are decoded at once.
DECODED = 1 << 16
NONE = np.int64(1) << 60


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Splitter:
    """Normalised pieces of a text, as the file's normaliser and pre-tokeniser give them."""

    def __init__(self, spec: dict, path: str):
        self.path = path
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_re = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        parts = [x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split"]
        self.find = regex.compile(parts[0]["pattern"]["Regex"]).findall
        self.known: set[str] = set()

    def unknown(self, text: str) -> bool:
        if text.isascii():
            return False
        new = set(text) - self.known
        odd = any(unicodedata.category(c) == "Cn" for c in new)
        if not odd:
            self.known |= new
        return odd

    @lru_cache(maxsize=1)  # noqa: B019
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def pieces(self, text: str) -> list[str]:
        out: list[str] = []
        for part in self.special_re.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(part)
            elif part.isascii():
                out += self.find(part.lower())
            elif self.unknown(part):
                lib = self.library()
                out += (unbyte(w) for w, _ in lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(part)))
            else:
                out += self.find(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return out


    def words(self, words: list[bytes]) -> list[list[str]]:
        """The pieces of each of many blank-free words."""
        text = b"\n".join(words).decode()
        if "<|" not in text and not self.unknown(text):
            return self._plain(text)
        texts = text.split("\n")
        odd = {i for i, w in enumerate(texts) if "<|" in w or self.unknown(w)}
        plain = iter(self._plain("\n".join(w for i, w in enumerate(texts) if i not in odd)) if len(odd) < len(texts) else [])
        return [self.pieces(w) if i in odd else next(plain) for i, w in enumerate(texts)]

    def _plain(self, text: str) -> list[list[str]]:
        find = self.find
        words = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower().split("\n")
        return [[w] if w.isalpha() else [w[:-1], w[-1]] if w[-1:] in ",.:;!?" and w[:-1].isalpha() else find(w) for w in words]


@lru_cache
def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def unbyte(word: str) -> str:
    back = {c: b for b, c in enumerate(byte_chars())}
    return bytes(back[c] for c in word).decode("utf-8", "replace")


class Memory:
    """Ids by word or piece, within ``CACHED_BYTES``; beyond it the later half is forgotten, since frequent ones come early."""

    def __init__(self, fixed: dict):
        # A plain dictionary: sets take differences to it in time of their own size, to a subclass in time of its size.
        self.ids, self.fixed, self.held = dict(fixed), fixed, 0

    def learn(self, keys: list, ids: list[bytes]) -> None:
        self.ids.update(zip(keys, ids, strict=True))
        self.held += ENTRY_BYTES * len(keys) + sum(map(len, keys)) + sum(map(len, ids))

    def trim(self) -> None:
        if self.held > CACHED_BYTES:
            self.ids = dict(list(self.ids.items())[: len(self.ids) // 2]) | self.fixed
            self.held = ENTRY_BYTES * len(self.ids) + sum(map(len, self.ids)) + sum(map(len, self.ids.values()))


class SegmentTreeBPE:
    """Encodes texts with the merges of a vocabulary file: the pieces of new words together with those of many others, remembered within bounds."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.splitter = Splitter(spec, path)
        self.pieces = Memory({t: np.array(i, "<u4").tobytes() for t, i in self.splitter.special.items()})
        self.words = Memory({})
        self.tokens = [""] * (1 + max([*vocab.values(), *self.splitter.special.values()]))
        for t, i in (vocab | self.splitter.special).items():
            self.tokens[i] = t
        chars = byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + suffix] for c in chars], np.int64)
        a, b = np.array([[vocab[x], vocab[y]] for x, y in model["merges"]], np.int64).T
        order = np.argsort(a << 32 | b, kind="stable")
        self.pairs, self.ranks = (a << 32 | b)[order], order
        self.merged = np.array([vocab[x + y] for x, y in model["merges"]], np.int64)

    @cached_property
    def rank_of(self) -> dict[int, int]:
        return dict(zip(self.pairs.tolist(), self.ranks.tolist(), strict=True))

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, or NONE."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], NONE)

    def encode_pieces(self, words: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        raw = [w.encode() for w in words]
        out = [b""] * len(words)
        widths: dict[int, list[int]] = {}
        for i, w in enumerate(raw):
            if w:
                widths.setdefault(max(1, (len(w) - 1).bit_length()), []).append(i)
        for bits, members in widths.items():
            step = max(1, GROUP_CELLS >> (bits + 1))
            if min(step, len(members)) < LEAST_GROUP:
                for i in members:
                    out[i] = self._merge_one(raw[i])
                continue
            for k in range(0, len(members), step):
                group = members[k : k + step]
                for i, ids in zip(group, self._merge([raw[i] for i in group], bits), strict=True):
                    out[i] = ids
        return out

    def _merge_one(self, word: bytes) -> bytes:
        """The same merges in one piece; an update climbs only as far as it changes a node."""
        n = len(word)
        width = 1 << max(1, (n - 1).bit_length())
        data = np.frombuffer(word, np.uint8)
        first = self.inner[data]
        first[-1] = self.last[data[-1]]
        ranks = self.rank(first[:-1], first[1:])
        made = np.full(2 * width, NONE, np.int64)
        made[width : width + n - 1] = np.where(ranks < NONE, ranks * width + np.arange(n - 1), NONE)
        k = width // 2
        while k:
            made[k : 2 * k] = np.minimum(made[2 * k : 4 * k : 2], made[2 * k + 1 : 4 * k : 2])
            k //= 2
        tree = array("q", made.tobytes())
        symbol = array("q", first.tobytes())
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        none, rank_of, merged = int(NONE), self.rank_of, self.merged
        bits = width.bit_length() - 1

        def put(i: int, value: int) -> None:
            node = width + i
            tree[node] = value
            node >>= 1
            while node:
                left, right = tree[2 * node], tree[2 * node + 1]
                least = left if left < right else right
                if tree[node] == least:
                    break
                tree[node] = least
                node >>= 1

        while (root := tree[1]) < none:
            i = root & (width - 1)
            j = after[i]
            far, near = after[j], before[i]
            symbol[i] = new = int(merged[root >> bits])
            symbol[j] = -1
            after[i] = far
            put(j, none)
            if far < n:
                before[far] = i
                r = rank_of.get(new << 32 | symbol[far])
                put(i, none if r is None else r * width + i)
            else:
                put(i, none)
            if near >= 0:
                r = rank_of.get(symbol[near] << 32 | new)
                put(near, none if r is None else r * width + near)
        ids = np.frombuffer(symbol, np.int64)
        return ids[ids >= 0].astype("<u4").tobytes()

    def _merge(self, words: list[bytes], bits: int) -> list[bytes]:
        n, width = len(words), 1 << bits
        lengths = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        at = np.arange(width)
        symbol = np.full((n, width + 1), -1, np.int64)
        symbol[:, :width] = np.where(at < lengths[:, None] - 1, self.inner[data], np.where(at == lengths[:, None] - 1, self.last[data], -1))
        after = np.tile(np.minimum(np.arange(1, width + 2), width), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        live = symbol[:, :width] >= 0
        tree = np.full((n, 2 * width), NONE, np.int64)
        ranks = self.rank(symbol[:, :-1], symbol[:, 1:])
        tree[:, width:] = np.where(ranks < NONE, ranks * width + at, NONE)
        k = width // 2
        while k:
            tree[:, k : 2 * k] = np.minimum(tree[:, 2 * k : 4 * k : 2], tree[:, 2 * k + 1 : 4 * k : 2])
            k //= 2
        # Flat views: cell (row, i) of a table w wide is at row * w + i.
        symbols, afters, befores, lives, leaves = symbol.ravel(), after.ravel(), before.ravel(), live.ravel(), tree.ravel()
        rows = np.arange(n)
        while True:
            root = leaves[rows * (2 * width) + 1]
            going = root < NONE
            if not going.all():
                rows, root = rows[going], root[going]
            if not len(rows):
                break
            base, top = rows * (width + 1), rows * (2 * width)
            rank, i = root >> bits, root & (width - 1)
            j = afters[base + i]
            far = afters[base + j]
            near = befores[base + i]
            new = self.merged[rank]
            symbols[base + i] = new
            lives[rows * width + j] = False
            afters[base + i] = far
            befores[base + far] = i  # the column behind the last one takes what has no place
            # Without a left neighbour, near is -1: the cell before the row's first, whose pair is set to NONE.
            first = near < 0
            at_near = np.where(first, i, near)
            pair = self.rank(np.concatenate([new, symbols[base + at_near]]), np.concatenate([symbols[base + far], new]))
            right, left = pair[: len(rows)], pair[len(rows) :]
            leaves[top + width + j] = NONE
            keep = ~first
            leaves[(top + width + at_near)[keep]] = np.where(left < NONE, left * width + at_near, NONE)[keep]
            leaves[top + width + i] = np.where(right < NONE, right * width + i, NONE)
            tops = np.concatenate([top, top, top])
            node = np.concatenate([i, j, at_near]) + width
            for _ in range(bits):
                node = node >> 1
                child = tops + 2 * node
                leaves[tops + node] = np.minimum(leaves[child], leaves[child + 1])
        counts = live.sum(1)
        flat = symbol[:, :width][live].astype("<u4").tobytes()
        ends = np.cumsum(counts) * 4
        return [flat[e - 4 * c : e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]

    def _learn(self, words: list[bytes]) -> None:
        split = self.splitter.words(words)
        new = list({p for pieces in split for p in pieces}.difference(self.pieces.ids))
        self.pieces.learn(new, self.encode_pieces(new))
        lookup = self.pieces.ids.__getitem__
        self.words.learn(words, [lookup(x[0]) if len(x) == 1 else b"".join(map(lookup, x)) for x in split])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned integers; the words of about ``SLICE`` characters are held at once."""
        out: list[list[bytes]] = [[] for _ in texts]
        parts: list[tuple[int, list[bytes]]] = []
        new: set[bytes] = set()
        size = 0

        def flush() -> None:
            if new:
                self._learn(list(new))
                new.clear()
            lookup = self.words.ids.__getitem__
            for i, words in parts:
                out[i].append(b"".join(map(lookup, words)))
            parts.clear()
            self.words.trim()
            self.pieces.trim()

        for i, text in enumerate(texts):
            for _, part in segments(text):
                words = part.encode().split()
                new |= set(words).difference(self.words.ids)
                parts.append((i, words))
                size += len(part)
                if size >= SLICE:
                    flush()
                    size = 0
        flush()
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def decode(self, ids: bytes) -> str:
        """The tokens' strings joined by blanks, as the library does for a file without decoder."""
        token, flat = self.tokens.__getitem__, np.frombuffer(ids, "<u4")
        return " ".join(" ".join(map(token, flat[k : k + DECODED].tolist())) for k in range(0, len(flat), DECODED))


def codec(path: str) -> SegmentTreeBPE:
    return kept(("codec", path), lambda: SegmentTreeBPE(path))


def encode(df: DataFrame, keep: list[str], path: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """``keep`` of ``df`` and ``ids``: the text's token ids as little-endian unsigned 32-bit integers (binary)."""
    path = path or default_path()

    def work():
        bpe = codec(path)
        return lambda texts: [pa.array(bpe.encode(texts), pa.binary())]

    return add_columns(df, text, keep, T.StructType([T.StructField(ids, T.BinaryType())]), work, SLICE)


def decode(df: DataFrame, keep: list[str], path: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``keep`` of ``df`` and ``text``: the decoded ids (null: empty). A kept column named ``text`` raises ValueError."""
    check_names(df, keep, [text])
    path = path or default_path()
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(text, T.StringType())])

    def run(batches):
        bpe = codec(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = pa.array([bpe.decode(x or b"") for x in part.column(ids).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), texts], names=[*keep, text])

    return df.select(*(f"`{c}`" for c in dict.fromkeys([*keep, ids]))).mapInArrow(run, schema)


def round_trip(df: DataFrame, keep: list[str], path: str | None = None, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``keep`` of ``df``, ``ids`` as ``encode`` gives them, and ``decoded``, those ids' text: one pass, so a task has one worker with one vocabulary."""
    path = path or default_path()

    def work():
        bpe = codec(path)

        def run(texts: list[str]) -> list[pa.Array]:
            made = bpe.encode(texts)
            return [pa.array(made, pa.binary()), pa.array(map(bpe.decode, made), pa.string())]

        return run

    return add_columns(df, text, keep, T.StructType([T.StructField(ids, T.BinaryType()), T.StructField(decoded, T.StringType())]), work, SLICE)


def digests(trip: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, n_tokens and the SHA-256 of ids and decoded text."""
    return trip.select(
        *(f"`{c}`" for c in keep),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(round_trip(table(spark, sf_dir, "documents"), ["doc_id"]), ["doc_id"])
