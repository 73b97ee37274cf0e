"""Moving rows through ``mapInArrow`` in pieces of bounded text size."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Hashable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import ship

#: Bytes of text that a task handles at once, beyond a single row or word.
SLICE = 1 << 20
_blank = re.compile(r"[\x20\x09-\x0D]")


class _Kept:
    """The one thing that a Python worker process keeps from task to task."""

    name: Hashable = None
    value: object = None
    asked = False


def kept(name: Hashable, make: Callable[[], object]):
    """``make()``, once a worker process: it stays until a task keeps another thing or none."""
    if _Kept.name != name:
        release()
        _Kept.name, _Kept.value = name, make()
    _Kept.asked = True
    return _Kept.value


def release() -> None:
    """Let go of what earlier tasks kept: workers outlive stages, and the next stage needs the memory."""
    _Kept.name = _Kept.value = None


@lru_cache
def _trim() -> Callable[[int], int]:
    """The C library's call that returns freed memory to the system, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return lambda _: 0


def give_back() -> None:
    """Return freed memory to the system: allocators keep what a batch needed, and idle workers would hold it beside later stages."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Each batch in runs of rows whose texts hold about ``size`` bytes, with those texts (null: empty).

    Lengths come from the Arrow offsets, so only one run at a time becomes Python strings. After each batch freed memory goes back to the system.
    """
    for batch in batches:
        column = batch.column(text)
        start = held = 0
        cuts = []
        for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
            if i > start and held + n > size:
                cuts.append((start, i))
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            cuts.append((start, batch.num_rows))
        for a, b in cuts:
            yield batch.slice(a, b - a), [x or "" for x in column.slice(a, b - a).to_pylist()]
        del batch, column
        give_back()


def segments(text: str, size: int = SLICE) -> Iterator[tuple[int, str]]:
    """A very long text in parts that begin at a blank, with their offsets; their words are the text's words."""
    start = 0
    while len(text) - start > size:
        cut = _blank.search(text, start + size)
        if not cut:
            break
        yield start, text[start : cut.start()]
        start = cut.start()
    yield start, text[start:] if start else text


def check_names(df: DataFrame, keep: list[str], added: list[str]) -> None:
    """Raise ValueError where a kept column has the name of an added one, as Spark compares names."""
    same = (lambda c: c) if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    clash = [c for c in keep if same(c) in {same(a) for a in added}]
    if clash:
        raise ValueError(f"columns {clash} exist already")


def add_columns(df: DataFrame, text: str, keep: list[str], added: StructType, per_slice: Callable[[], Callable[[list[str]], list[pa.Array]]], size: int = SLICE) -> DataFrame:
    """``keep`` and ``text`` of ``df`` through ``mapInArrow``; ``per_slice()`` is made once a task and turns texts, about ``size`` bytes of them, into the added columns.

    ``text`` itself is returned only where ``keep`` names it. Row order and number are kept.
    """
    check_names(df, keep, added.names)
    ship(df.sparkSession)
    carried = list(dict.fromkeys([*keep, text]))
    schema = StructType([*(df.schema[c] for c in keep), *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _Kept.asked = False
        work = per_slice()
        if not _Kept.asked:
            release()
        for batch, texts in slices(batches, text, size):
            columns = work(texts)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *columns], names=[*keep, *(f.name for f in added)])

    return df.select(*(f"`{c}`" for c in carried)).mapInArrow(run, schema)


def beside(df: DataFrame, text: str, row: str, body: str) -> DataFrame:
    """The text of ``df`` as ``body``, and all else that a row holds as one struct ``row``: the text crosses to Python once, and names of the input can't clash with what is added."""
    rest = [c for c in df.columns if c != text]
    held = F.struct(F.col(f"`{text}`").isNotNull().alias("some"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)))
    return df.select(held.alias(row), F.col(f"`{text}`").alias(body))


def together(columns: list[str], text: str, row: str, new: Column, **changed: Column) -> list[Column]:
    """The columns that ``beside`` took apart, in their order, with ``new`` as the text (null texts stay null) and ``changed`` in place of columns of those names."""
    place = {c: f"c{i}" for i, c in enumerate(c for c in columns if c != text)}
    whole = {c: F.col(row).getField(at) for c, at in place.items()} | {text: F.when(F.col(row).getField("some"), new)} | changed
    return [whole[c].alias(c) for c in columns]
