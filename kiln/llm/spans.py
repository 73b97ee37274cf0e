"""Spans of regular expressions in DataFrame operations: kind, start, end in code points.

Defined results: an empty text has no spans; a null text gives a null array, so callers pass an empty text for it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Matches whose spans are gathered in one fold, which copies what it has at each of them.
CHUNK = 64
SPAN = "struct<start:int,kind_no:int,kind:string,end:int,value:string>"


def regex_spans(text: Column, pattern: str, kind_no: int, kind: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches, in order, as an array of SPAN; ``value`` is the given group.

    What lies between matches comes from ``split``, so a match starts after the lengths of all text and matches before it.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    zipped = F.zip_with(F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m"))), values, lambda x, v: F.struct(x["g"].alias("g"), x["m"].alias("m"), v.alias("v")))
    piece = "struct<g:int,m:int,v:string>"

    def runs(z: Column) -> Column:
        """Runs of CHUNK matches, so that what is appended to stays short."""
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(z) / CHUNK).cast("int")), lambda i: F.slice(z, i * CHUNK + 1, CHUNK))

    def place(acc: Column, run: Column) -> Column:
        after = F.aggregate(run, acc["at"], lambda at, x: at + x["g"] + x["m"])
        return F.struct(after.alias("at"), F.array_append(acc["out"], F.struct(acc["at"].alias("at"), run.alias("run"))).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        first = acc["at"] + x["g"]
        span = F.struct(first.alias("start"), F.lit(kind_no).alias("kind_no"), F.lit(kind).alias("kind"), (first + x["m"]).alias("end"), x["v"].alias("value"))
        return F.struct((first + x["m"]).alias("at"), F.array_append(acc["out"], span).alias("out"))

    begin = lambda at, kind_: F.struct(at.alias("at"), F.expr(f"cast(array() as array<{kind_}>)").alias("out"))
    placed = F.aggregate(F.transform(F.array(zipped), runs)[0], begin(F.lit(0), f"struct<at:int,run:array<{piece}>>"), place, lambda acc: acc["out"])
    return F.flatten(F.transform(placed, lambda p: F.aggregate(p["run"], begin(p["at"], SPAN), step, lambda acc: acc["out"])))


def no_spans() -> Column:
    return F.expr(f"cast(array() as array<{SPAN}>)")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    one = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")
