"""Token ids in binary files: canonical length-limited Huffman codes from global counts.

Ids are made once and stored, with counts at each task's end; the sums over all documents give one code table. Documents are then dealt out
by ranges of doc_id, and each task writes its range, in order, as files of at most ``FILE_TOKENS`` ids (or one
document). In a file the ids are cut into blocks of ``BLOCK`` ids; the bit offset of every block is kept, so blocks decode
independently: the reader looks up one code in each of many blocks at a time in a table of 2**max_len entries.

A task's files carry its attempt in their names and reach the reader only through the stored list of what finished
tasks wrote, so a lost or repeated task leaves no trace.

File: magic, six unsigned 64-bit numbers (table size, longest code, documents, ids, blocks, payload bytes) and the bytes of the
deflated code lengths; these lengths; then doc_id, null flag and number of ids per document, block offsets, payload.

Defined results: null text counts as empty, a null doc_id comes first, rows with equal doc_id are ordered by
a hash of their ids, every document ends with the end id, an empty table writes nothing and reads as no rows. Further columns of the table are not read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrow import kept, release, segments, slices
from .bpe import Splitter, byte_chars, default_path
from .common import drop, shared_dir, ship, stored, table

MAGIC = b"KILNHUF1"
BLOCK = 256
FILE_TOKENS = 2_000_000
#: Ids that a part of the order holds on average, at most.
PART_TOKENS = 2 * FILE_TOKENS
MAX_LEN = 18
#: Bytes that a task may hold as words, pieces of words and their ids, and what an entry takes: two small objects and their place in a dictionary.
WORDS_BYTES, ENTRY_BYTES = 256 << 20, 170
#: Ids that are packed at once.
CHUNK = 1 << 15


class LibraryIds(dict):
    """Ids of blank-free words as bytes, by the tokenizers library's model; a word that isn't known yet is looked up by its pieces.

    The library's ids for a text are those of the text's words in turn; the tests hold this against its encoding of whole texts.
    """

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        self.letter = {"<u2": "H", "<u4": "I"}[kind]
        with open(path, encoding="utf-8") as f:
            self.splitter = Splitter(json.load(f), path)
        self.model = Tokenizer.from_file(path).model
        self.chars = {b: ord(c) for b, c in enumerate(byte_chars())}
        self.special = {t: struct.pack(f"<{self.letter}", i) for t, i in self.splitter.special.items()}
        self.pieces: dict[str, bytes] = {}
        self.held = 0

    def piece(self, p: str) -> bytes:
        ids = self.pieces.get(p) or self.special.get(p)
        if ids is None:
            tokens = self.model.tokenize(p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(self.chars))
            ids = self.pieces[p] = struct.pack(f"<{len(tokens)}{self.letter}", *[t.id for t in tokens])
            if len(p) > 32:
                self.held += len(ids) + len(p)
        return ids

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if text.isascii():
            low = text.lower()
            if low.isalpha():
                ids = self.pieces.get(low) or self.piece(low)
            elif low[-1] in ",.:;!?" and (stem := low[:-1]).isalpha():
                ids = (self.pieces.get(stem) or self.piece(stem)) + self.piece(low[-1])
            else:
                ids = b"".join(map(self.piece, self.splitter.pieces(text)))
        else:
            ids = b"".join(map(self.piece, self.splitter.pieces(text)))
        self[word] = ids
        if len(word) > 32:  # what is shorter counts as an entry
            self.held += len(ids) + len(word)
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            parts = []
            for _, part in segments(text):
                parts.append(b"".join(map(self.__getitem__, part.encode().split())))
                if self.held + ENTRY_BYTES * (len(self) + len(self.pieces)) > WORDS_BYTES:
                    self.forget()
            out.append(parts[0] if len(parts) == 1 else b"".join(parts))
        return out

    def forget(self) -> None:
        for known in (self, self.pieces):
            for w in list(known)[len(known) // 2 :]:  # frequent words come early
                del known[w]
        self.held = sum(len(k) + len(v) for known in (self, self.pieces) for k, v in known.items() if len(k) > 32)


ENCODED = "doc_id long, ids binary, id array<int>, n array<long>"
_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("id", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))])


def encoded(docs: DataFrame, path: str, end_id: int, vocab_size: int, kind: str) -> DataFrame:
    """doc_id and ids of every document with its end id, and at a task's end one row more: how often each id occurred in it."""
    ship(docs.sparkSession)
    end = np.array(end_id, kind).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = kept(("library", path, kind), lambda: LibraryIds(path, kind))
        total = np.zeros(vocab_size, np.int64)
        for batch, texts in slices(batches, "text"):
            ids = [x + end for x in lib.encode(texts)]
            for x in ids if len(texts) == 1 else [b"".join(ids)]:
                total += np.bincount(np.frombuffer(x, kind), minlength=vocab_size)
            none = pa.nulls(len(ids), pa.list_(pa.int32())), pa.nulls(len(ids), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()), *none], schema=_ENCODED)
        some = np.flatnonzero(total)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([some.tolist()], _ENCODED.field("id").type), pa.array([total[some].tolist()], _ENCODED.field("n").type)], schema=_ENCODED)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ENCODED)


def id_counts(rows: DataFrame, vocab_size: int) -> np.ndarray:
    """How often each id occurs, from the counts that tasks left; as many rows come to the driver as the vocabulary has ids."""
    each = rows.where(F.col("ids").isNull()).select(F.explode(F.arrays_zip("id", "n")).alias("c")).groupBy("c.id").agg(F.sum("c.n").alias("n"))
    counts = np.zeros(vocab_size, np.int64)
    for r in each.collect():
        counts[r.id] = r.n
    return counts


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError("more ids than codes of that length")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    is_leaf = []
    merged = leaves
    flags = np.ones(n, bool)
    for _ in range(limit):
        is_leaf.append(flags)
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        merged, flags = both[rank], rank < n
    take = 2 * n - 2
    for flags in reversed(is_leaf):
        chosen = int(flags[:take].sum())
        lengths[order[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


class Code:
    """The canonical code of given lengths: shorter codes first, ids in order within a length."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        self.max_len = max(1, int(lengths.max(initial=0)))
        span = np.int64(1) << (self.max_len - lengths[order].astype(np.int64))
        left = np.cumsum(span) - span
        self.codes = np.zeros(len(lengths), np.int64)
        self.codes[order] = left >> (self.max_len - lengths[order].astype(np.int64))
        self.symbols = np.zeros(1 << self.max_len, np.uint32)
        self.steps = np.ones(1 << self.max_len, np.int64)
        filled = int(span.sum())
        self.symbols[:filled] = np.repeat(order, span)
        self.steps[:filled] = np.repeat(lengths[order], span)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Payload, and the bit offset of every block."""
        lengths = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(lengths)
        offsets = (ends - lengths)[::BLOCK]
        words = np.zeros((int(ends[-1]) + 63) // 64 + 1 if len(ids) else 1, np.uint64)
        for k in range(0, len(ids), CHUNK):
            code, n, last = self.codes[ids[k : k + CHUNK]].astype(np.uint64), lengths[k : k + CHUNK], ends[k : k + CHUNK] - 1
            word, bit = last >> 6, last & 63  # a code ends at this bit of this 64-bit word, counted from the top
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[starts]] |= np.bitwise_or.reduceat(code << (63 - bit).astype(np.uint64), starts)
            over = np.flatnonzero(bit + 1 < n)  # its first bits belong to the word before; at most one code does so a word
            words[word[over] - 1] |= code[over] >> (bit[over] + 1).astype(np.uint64)
        payload = words.astype(">u8").tobytes()
        return payload[: (int(ends[-1]) + 7) // 8 if len(ids) else 0], offsets

    def decode(self, payload: bytes, offsets: np.ndarray, n_ids: int) -> np.ndarray:
        data = np.frombuffer(payload + bytes(BLOCK * 8 + 8), np.uint8).astype(np.uint32)
        words = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        at = offsets.astype(np.int64)
        out = np.empty((BLOCK, len(at)), np.uint32)
        mask = (1 << self.max_len) - 1
        for k in range(BLOCK):
            value = words[np.minimum(at >> 3, len(words) - 1)] >> (32 - self.max_len - (at & 7)).astype(np.uint32) & mask
            out[k] = self.symbols[value]
            at += self.steps[value]
        return out.T.reshape(-1)[:n_ids]


def pack(code: Code, doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    flat = np.concatenate(ids)
    payload, offsets = code.encode(flat)
    lengths = zlib.compress(code.lengths.tobytes())
    head = struct.pack("<7Q", len(code.lengths), code.max_len, len(ids), len(flat), len(offsets), len(payload), len(lengths))
    return b"".join([
        MAGIC, head, lengths, np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is None for x in doc_ids], np.uint8).tobytes(),
        np.array([len(x) for x in ids], "<u8").tobytes(), offsets.astype("<u8").tobytes(), payload,
    ])


def unpack(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc ids, number of ids of each, all ids."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    _, _, docs, tokens, blocks, size, packed = struct.unpack_from("<7Q", data, 8)
    at = 8 + 56
    lengths = np.frombuffer(zlib.decompress(data[at : at + packed]), np.uint8)
    at += packed
    doc_ids = np.frombuffer(data, "<i8", docs, at).tolist()
    null = np.frombuffer(data, np.uint8, docs, at + 8 * docs)
    counts = np.frombuffer(data, "<u8", docs, at + 9 * docs).astype(np.int64)
    offsets = np.frombuffer(data, "<u8", blocks, at + 17 * docs)
    at += 17 * docs + 8 * blocks
    if len(data) != at + size:
        raise ValueError("token file is cut short")
    return [None if z else x for x, z in zip(doc_ids, null, strict=True)], counts, Code(lengths).decode(data[at:], offsets, tokens)


MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long"


def write_files(ids: DataFrame, lengths: np.ndarray, n_tokens: int, kind: str, folder: str) -> DataFrame:
    """Write stored ``ids(doc_id, ids)`` in order of doc_id; the list of files, in order by part and seq.

    Parts follow from the number of ids, so a task's share is bounded at any size. Rows of one doc_id are cut by a hash of their ids, so none is a part of its own for that.
    """
    spark = ids.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_tokens // PART_TOKENS))
    keyed = ids.select("doc_id", "ids", F.xxhash64("ids").alias("ids_hash"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("ids_hash")]
    ordered = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order, "ids").select("doc_id", "ids")
    packed = lengths.tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        code = Code(np.frombuffer(packed, np.uint8))
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        held: tuple[list, list] = ([], [])
        seq = total = 0

        def flush() -> pa.RecordBatch:
            name = f"part-{part:06d}-{seq:05d}-{uuid.uuid4().hex}.huf"
            with store.open_output_stream(f"{base}/{name}") as f:
                f.write(pack(code, *held))
            return pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "path": f"{folder}/{name}", "n_docs": len(held[0]), "n_tokens": total}], schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

        for batch in batches:
            for doc, x in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                held[0].append(doc)
                held[1].append(np.frombuffer(x, kind))
                total += len(held[1][-1])
                if total >= FILE_TOKENS:
                    yield flush()
                    held, seq, total = ([], []), seq + 1, 0
        if held[0]:
            yield flush()

    return stored(ordered.mapInArrow(write, MANIFEST), "manifest", folder)


def read_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (little-endian unsigned 32-bit integers, binary)."""
    # Files are summed within their part; only the sums of parts, two numbers each, are put in order together.
    sums = manifest.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    sums = sums.select(F.col("part").alias("p"), (F.sum("part_tokens").over(W.orderBy("part")) - F.col("part_tokens")).alias("part_base"))
    before = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    placed = manifest.join(sums, F.col("part") == F.col("p")).withColumn("base", F.col("part_base") + F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                store, at = fs.FileSystem.from_uri(path)
                with store.open_input_stream(at) as f:
                    docs, counts, ids = unpack(f.read())
                ends = np.cumsum(counts)
                data = ids.astype("<u4").tobytes()
                bodies = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                for k in range(0, len(docs), 512):
                    some = slice(k, k + 512)
                    yield pa.RecordBatch.from_arrays([pa.array(docs[some], pa.int64()), pa.array((ends - counts + base)[some]), pa.array(bodies[some], pa.binary())], names=["doc_id", "start", "ids"])

    return placed.select("path", "base").repartition(parts, "path").mapInArrow(read, "doc_id long, start long, ids binary")


def write_corpus(docs: DataFrame, path: str | None = None, end_id: int = 1, max_len: int = MAX_LEN) -> DataFrame:
    """Encode all of ``docs(doc_id, text)`` and write the files; their list."""
    from tokenizers import Tokenizer

    path = path or default_path()
    size = Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    folder = shared_dir(docs.sparkSession)
    rows = encoded(docs, path, end_id, size, kind)
    rows.write.option("compression", "zstd").parquet(f"{folder}/ids")
    rows = docs.sparkSession.read.schema(rows.schema).parquet(f"{folder}/ids")
    counts = id_counts(rows, size)
    lengths = code_lengths(counts, max(max_len, size.bit_length()))
    files = write_files(rows.where(F.col("ids").isNotNull()), lengths, int(counts.sum()), kind, folder)
    drop(docs.sparkSession, folder, "ids")
    return files


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_files(write_corpus(table(spark, sf_dir, "documents"))).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
