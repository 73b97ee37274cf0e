"""CSV tables of any common delimiter, with typed columns and one notion of a missing value."""

from __future__ import annotations

import csv
import io
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELIMITERS = (",", ";", "\t", "|")
#: Texts that stand for a missing value.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def first_line(spark: SparkSession, path: str) -> str:
    row = spark.read.text(path).first()
    if row is None:
        raise ValueError(f"{path} is empty")
    return row.value.removeprefix("﻿")


def sniff(line: str) -> str:
    """The candidate that a header line holds most often outside quotes; a line without any is a single column."""
    outside = "".join(line.split('"')[::2])
    counts = [(outside.count(d), -i) for i, d in enumerate(DELIMITERS)]
    best = max(counts)
    return DELIMITERS[-best[1]] if best[0] else ","


def raw_header(line: str, sep: str) -> list[str]:
    return next(csv.reader(io.StringIO(line), delimiter=sep))


def unique_names(header: list[str]) -> list[str]:
    """Blank names become ``Unnamed: i``, repeats get ``.1``, ``.2`` and so on."""
    names: list[str] = []
    for i, h in enumerate(header):
        name, k = h or f"Unnamed: {i}", 0
        while (name if not k else f"{name}.{k}") in names:
            k += 1
        names.append(name if not k else f"{name}.{k}")
    return names


def _not_one_line() -> Column:
    """True for a line that isn't a row of its own: it has an odd number of quotes, as one that ends within quotes has, or it is
    blank but for delimiters, which a reader of lines would drop."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return (quotes % 2 == 1) | F.col("value").rlike(r"^[\x01-\x20]+$")


def one_line_rows(spark: SparkSession, path: str) -> bool:
    """True if every row is a line of its own, so a file can be cut anywhere."""
    return spark.read.text(path).where(_not_one_line()).isEmpty()


KINDS = ("bigint", "double", "boolean", "date")


def read_csv(spark: SparkSession, path: str, infer: bool = True) -> DataFrame:
    """A CSV table. Types are bigint, double, boolean, date or string, the first that fits every value that isn't missing.

    Rows with fewer fields than the header are filled with nulls; rows with more raise.
    """
    line = first_line(spark, path)
    sep = sniff(line)
    names = unique_names(raw_header(line, sep))
    slots = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(s, T.StringType()) for s in [*slots, "too_many"]])
    how = {"sep": sep, "quote": '"', "escape": '"'}

    def cleaned(text: DataFrame) -> DataFrame:
        return text.withColumns({s: F.when(~F.trim(s).isin(*NULL_TOKENS), F.col(s)) for s in slots})

    def facts_of() -> list[Column]:
        fits = [F.struct(*((F.count(_try(s, k)) == F.count(s)).alias(k) for k in KINDS), F.count(s).alias("some")).alias(s) for s in slots]
        return [F.count("too_many").alias("too_many"), *fits]

    # One pass over the lines tells whether each is a row and, if so, which types fit; else the rows are read as a whole for that.
    lines = spark.read.text(path).withColumn("head", F.regexp_replace("value", "^\ufeff", "") == line)
    parsed = F.from_csv(F.when(~F.col("head"), F.col("value")), schema.simpleString()[7:-1].replace(":", " "), how)
    looked = cleaned(lines.where("value <> ''").select("value", "head", parsed.alias("row")).select("value", "head", "row.*"))
    facts = looked.agg(F.count_if(_not_one_line()).alias("odd"), F.count_if("head").alias("heads"), *facts_of()).first()
    whole = facts.odd > 0
    text = cleaned(spark.read.csv(path, schema=schema, header=True, enforceSchema=True, multiLine=whole, **how))
    if whole or facts.heads != 1:
        facts = text.agg(*facts_of()).first()
    if facts.too_many:
        raise ValueError(f"{facts.too_many} rows of {path} have more fields than its header")
    kinds = {s: next((k for k in KINDS if facts[s][k]), "string") if infer and facts[s]["some"] else "double" if infer else "string" for s in slots}
    return text.select(*((_try(s, kinds[s]) if kinds[s] != "string" else F.col(s)).alias(n) for s, n in zip(slots, names, strict=True)))


def _try(slot: str, kind: str) -> Column:
    """The slot's text as a value of that type, null where it isn't one."""
    col = F.col(slot)
    if kind == "boolean":
        return F.when(F.lower(col) == "true", True).when(F.lower(col) == "false", False)
    if kind == "date":
        return F.when(col.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), col.try_cast("date"))
    if kind == "bigint":
        return F.when(F.trim(col).rlike("^[+-]?[0-9]+$"), F.trim(col).try_cast("bigint"))
    number = F.when(F.trim(col).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), F.trim(col).try_cast("double"))
    endless = F.when(F.lower(F.trim(col)).rlike(r"^\+?inf(inity)?$"), float("inf")).when(F.lower(F.trim(col)).rlike("^-inf(inity)?$"), float("-inf"))
    return F.coalesce(number, endless)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file at ``path``, as the contract of a submission asks; its rows (ids and a few features) pass through one writer.

    Spark writes into a folder beside it; the file then takes its final name, replacing one that is there.
    """
    spark = df.sparkSession
    beside = f"{path}.{uuid.uuid4().hex}"
    text = df.select(*(F.initcap(F.col(f"`{c}`").cast("string")).alias(c) if kind == "boolean" else F.col(f"`{c}`") for c, kind in df.dtypes))
    text.coalesce(1).write.option("escape", '"').option("emptyValue", "").csv(beside, header=True)
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(beside)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in store.listStatus(folder) if s.getPath().getName().startswith("part-"))
    target = jvm.org.apache.hadoop.fs.Path(path)
    store.delete(target, False)
    store.rename(part, target)
    store.delete(folder, True)
