"""A folder of tables, and the small text files beside them."""

from __future__ import annotations

import math
import re
import tomllib
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from .csv import read_csv


def table_paths(spark: SparkSession, folder: str) -> dict[str, str]:
    """name -> path of the CSV and Parquet tables in a folder of any file system that Spark reads."""
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for status in store.listStatus(top):
        name = status.getPath().getName()
        stem, _, kind = name.rpartition(".")
        if kind in ("csv", "parquet"):
            found[stem] = f"{folder}/{name}"
    return dict(sorted(found.items()))


class TableCatalog:
    """Tables of a folder by name, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.paths = spark, folder, table_paths(spark, folder)

    def __iter__(self):
        return iter(self.paths)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.paths:
            raise FileNotFoundError(f"no table {name!r}")
        path = self.paths[name]
        top = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        store = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not store.getContentSummary(top).getLength():
            raise ValueError(f"{path} is empty")
        return self.spark.read.parquet(path) if path.endswith(".parquet") else read_csv(self.spark, path)

    def readme(self) -> str:
        """The text of ``readme.txt`` in the folder, empty where there is none."""
        top = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/readme.txt")
        if not top.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(top):
            return ""
        return "\n".join(r.value for r in self.spark.read.text(str(top)).collect())  # a page of prose


_DESCRIBED = re.compile(r"^[\s#*•-]*`?(\w+)(?:\.(\w+))?`?\s*(?:\([^)]*\))?\s*(?:[:—–-]+\s*(.*))?$")


def descriptions(text: str, tables: list[str]) -> list[tuple[str, str | None, str]]:
    """(table, column, description) from lines ``table``, ``table.csv: text``, ``column: text`` below a table, or ``table.column: text``.

    Bullets, heading marks, back ticks and a note in brackets after the name are skipped; other lines are prose and left out.
    """
    found, at = [], None
    for line in text.split("\n"):
        m = _DESCRIBED.match(line.strip())
        if not m:
            continue
        name, part, said = m.groups()
        if name in tables and part in (None, "csv", "parquet"):
            at = name
            found.append((name, None, said or ""))
        elif name in tables:
            found.append((name, part, said or ""))
        elif at and not part and said is not None:
            found.append((at, name, said))
    return found


def join_hints(described: list[tuple[str, str | None, str]], columns: dict[str, list[str]]) -> set[tuple[str, str, str, str]]:
    """(child, child column, parent, parent column) where a column's description names ``table.column`` of another table."""
    known = [(t, c, other, k) for t, c, said in described if c in columns.get(t, []) for other, k in re.findall(r"(\w+)\.(\w+)", said)]
    return {h for h in known if h[0] != h[2] and h[3] in columns.get(h[2], [])}


def _terms(text: str) -> list[str]:
    """Words of a name or sentence, lower-cased, without a plural's end; ``userId`` and ``user_id`` are two words."""
    parts = re.findall(r"[^\W\d_]+|\d+", re.sub(r"(?<=[^\W\d_A-Z])(?=[A-Z])", " ", text))
    return [w[:-1] if len(w) > 3 and w.endswith("s") else w for w in map(str.lower, parts)]


def prose_hints(text: str, columns: dict[str, list[str]], most: int = 20) -> list[tuple[tuple[str, str, str, str], float]]:
    """Joins that free prose speaks of, as ((child, child column, parent, parent column), weight), the likeliest first; values must confirm them.

    A sentence counts for the tables and columns whose names it holds, as written or as their words; one without a table goes on about the last one named.
    A column of one table beside another table, or beside a column of it, is a candidate. Rare names weigh more, names as written twice; where the
    other column isn't named, each of its table's is tried at half the weight.
    """
    names = {*columns, *(c for some in columns.values() for c in some)}
    seen = Counter(t for n in names for t in set(_terms(n)))
    rare = {n: sum(math.log(1 + len(names) / seen[t]) for t in set(_terms(n))) for n in names}
    found: dict[tuple[str, str, str, str], float] = {}
    at = None
    for sentence in re.split(r"(?<=[.!?;])\s+|\n+", text):
        written, words = {w.lower() for w in re.findall(r"\w+", sentence)}, set(_terms(sentence))
        hit = {n: rare[n] * (2 if n.lower() in written else 1) for n in names if n.lower() in written or (_terms(n) and set(_terms(n)) <= words)}
        here = [t for t in columns if t in hit]
        about = list(dict.fromkeys([*here, *([at] if at else [])]))
        for child in about:
            for c in (c for c in columns[child] if c in hit):
                for parent in columns:
                    keys = [k for k in columns[parent] if k in hit]
                    if parent == child or not (parent in here or keys and parent in about):
                        continue
                    for k in keys or columns[parent]:
                        weight = hit[c] + hit.get(parent, 0.0) + (hit[k] if keys else 0.0)
                        link = (child, c, parent, k)
                        found[link] = max(found.get(link, 0.0), weight if keys else weight / 2)
        at = here[0] if here else at
    return sorted(found.items(), key=lambda x: (-x[1], x[0]))[:most]


def dependencies(text: str) -> list[str]:
    """The lower-cased dependency list of a project file."""
    found = tomllib.loads(text).get("project", {}).get("dependencies", [])
    if not isinstance(found, list):
        raise TypeError("project.dependencies is not a list")
    return [str(x).lower() for x in found]


def missing_dependencies(found: list[str], needed: list[str]) -> list[str]:
    """What no entry names, by substring."""
    return [n for n in needed if not any(n in x for x in found)]


def has_setting(text: str, key: str) -> bool:
    """True if a line of a settings file starts with the key."""
    return any(line.startswith(key) for line in text.split("\n"))
