"""The inputs of a file stage: each stands alone, from reading to its own output.

An input is a path: a JSONL file, or a folder whose files are read as one (such as an
earlier stage's output). A pattern stands for each path that it matches. Inputs are
registered once: every row then carries its input's number, which is part of every grouping
key, so that equal file names, or equal queries, of two inputs never meet. What was read,
left out and written is counted on the way, without a second read.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from distillery import schemas
from distillery.sources import jsonl

STAGE_PREFIX = "output="


@dataclass(frozen=True)
class Input:
    number: int
    path: str
    #: Name of its output: its own name with the suffix before the extension.
    output: str


def _pattern(path: str) -> re.Pattern:
    """What a path pattern (``*``, ``?``, ``[...]``, ``{a,b}``) matches, as a regular expression."""
    out, depth, i = "", 0, 0
    while i < len(path):
        c = path[i]
        if c == "*":
            out += "[^/]*"
        elif c == "?":
            out += "[^/]"
        elif c == "[" and "]" in path[i + 1:]:
            end = path.index("]", i + 1)
            out += "[" + path[i + 1:end] + "]"
            i = end
        elif c == "{":
            out, depth = out + "(?:", depth + 1
        elif c == "}" and depth:
            out, depth = out + ")", depth - 1
        elif c == "," and depth:
            out += "|"
        else:
            out += re.escape(c)
        i += 1
    return re.compile("(?:^|/)" + out.lstrip("/") + "(?=/|$)")


def _files(spark: SparkSession, path: str) -> list[str] | None:
    """The files that a path stands for, or None if there is no such path."""
    try:
        return spark.read.schema("value string").text(path).inputFiles()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def _expanded(spark: SparkSession, path: str) -> list[str]:
    files = _files(spark, path)
    if files is None:
        return []
    if not re.search(r"[*?\[{]", path):
        return [path.rstrip("/")]
    found = _pattern(path.rstrip("/"))
    return sorted({f[:m.end()] for f in files if (m := found.search(f))})


def _named(path: str, suffix: str) -> str:
    base, ext = posixpath.splitext(posixpath.basename(path).removeprefix(STAGE_PREFIX))
    return f"{base}{suffix}{ext}"


def register(spark: SparkSession, paths: Sequence[str] | str, suffix: str = "", on_missing: str = "skip",
             on_clash: str = "path") -> list[Input]:
    """The inputs that ``paths`` stand for, in order, each path once, with their outputs' names.

    A path that doesn't exist is left out (``on_missing="skip"``) or an error. Inputs of equal
    names get outputs named by as much of their paths as tells them apart (``on_clash="path"``),
    or are refused (``"error"``)."""
    if on_missing not in ("skip", "error") or on_clash not in ("path", "error"):
        raise ValueError("on_missing is 'skip' or 'error', on_clash 'path' or 'error'")
    found: list[str] = []
    for path in [paths] if isinstance(paths, str) else paths:
        some = _expanded(spark, path)
        if not some and on_missing == "error":
            raise FileNotFoundError(path)
        found += some
    found = list(dict.fromkeys(re.sub("(?<!:)//+", "/", p) for p in found))
    names = [_named(p, suffix) for p in found]
    if len(set(names)) < len(names):
        if on_clash == "error":
            raise ValueError(f"inputs of equal names: {sorted({n for n in names if names.count(n) > 1})}")
        parts = [[q.removeprefix(STAGE_PREFIX) for q in p.split("/") if q and not q.endswith(":")] for p in found]
        for depth in range(2, max(map(len, parts)) + 1):
            longer = ["__".join([*q[-depth:-1], n]) if names.count(n) > 1 else n for q, n in zip(parts, names)]
            if len(set(longer)) == len(longer):
                break
        if len(set(longer)) < len(longer):
            longer = [f"{i}__{n}" if names.count(n) > 1 else n for i, n in enumerate(names)]
        names = longer
    return [Input(i, p, n) for i, (p, n) in enumerate(zip(found, names))]


class Tally:
    """Counts by input, taken by ``observe`` while a stage runs: of what is read from each
    input, and of what is written for each. Known once the stage's write has ended.

    A count belongs to the tasks that ran: should Spark run a stage of a read again for lost
    files, its rows can be counted again; what is written is counted by the writing tasks."""

    def __init__(self, inputs: Sequence[Input]):
        self.inputs = list(inputs)
        self._read: dict[int, tuple[Observation, DataFrame, list[Column]]] = {}
        self._written: dict[str, Observation] = {}

    def read(self, df: DataFrame, number: int, **counts: Column) -> DataFrame:
        metrics = [F.count(F.lit(1)).alias("n_rows"), *[F.count(F.when(c, F.lit(1))).alias(n) for n, c in counts.items()]]
        seen = Observation()
        self._read[number] = seen, df, metrics
        return df.observe(seen, *metrics)

    def written(self, df: DataFrame, name: str, input_col: str = "input") -> DataFrame:
        self._written[name] = Observation()
        each = [F.count(F.when(F.col(input_col) == x.number, F.lit(1))).alias(f"n{x.number}") for x in self.inputs]
        return df.observe(self._written[name], F.count(F.lit(1)).alias("total"), *each)

    @staticmethod
    def _told(seen: Observation) -> dict:
        """What was observed; nothing if the run dropped that part of its plan, as it does where it
        finds a stage's result empty."""
        try:
            return seen.get
        except Py4JJavaError:
            return {}

    def rows(self) -> list[dict]:
        """A dictionary for each input, in order: ``input, output``, then its counts. Only where nothing
        at all came of the reads are they counted anew."""
        read = {n: self._told(seen) or df.agg(*metrics).first().asDict() for n, (seen, df, metrics) in self._read.items()}
        written = {name: self._told(o) for name, o in self._written.items()}
        return [{"input": x.path, "output": x.output} | read.get(x.number, {}) | {
            name: w.get(f"n{x.number}", 0) for name, w in written.items()} for x in self.inputs]

    def frame(self, spark: SparkSession) -> DataFrame:
        """A row for each input (inputs without a row among them), and one of totals, whose input
        and output are null."""
        rows = self.rows()
        names = list(dict.fromkeys(k for r in rows for k in r if k not in ("input", "output")))
        total = {k: sum(r.get(k, 0) for r in rows) for k in names}
        schema = ", ".join(["input string", "output string", *[f"`{k}` long" for k in names]])
        data = [(r["input"], r["output"], *[r.get(k, 0) for k in names]) for r in rows]
        return spark.createDataFrame([*data, (None, None, *total.values())], schema)


def _union(spark: SparkSession, parts: list[DataFrame], schema: str) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_each(spark: SparkSession, inputs: Sequence[Input], read: Callable[[Input], DataFrame], schema: str) -> DataFrame:
    """The rows of all inputs with their ``input`` number; ``schema`` is that without any input."""
    return _union(spark, [read(x).withColumn("input", F.lit(x.number)) for x in inputs], schema)


SAMPLES = ("query string, positive array<string>, negative array<string>, source_file string, "
           "seq struct<block:bigint,row:bigint>, input int")
PAIRS = ("query string, passage string, score double, source_file string, seq struct<block:bigint,row:bigint>, "
         "reason string, record string, input int")


def sample_inputs(spark: SparkSession, inputs: Sequence[Input], mode: str = "strict",
                  min_partitions: int | None = None) -> DataFrame:
    """Samples of all inputs (see :func:`jsonl.read_samples`; strict or truthy) with ``input``."""
    return read_each(spark, inputs, lambda x: jsonl.read_samples(spark, x.path, mode, min_partitions=min_partitions), SAMPLES)


def pair_inputs(spark: SparkSession, inputs: Sequence[Input], tally: Tally | None = None,
                min_partitions: int | None = None) -> DataFrame:
    """Scored pairs of all inputs with ``input``, ``reason`` and ``record``: the reason is null for
    a good row, else ``malformed`` (no JSON, or a field of the wrong type), ``missing`` (a key that
    is absent or null) or ``nan``; the record is the malformed line."""
    def read(x: Input) -> DataFrame:
        rows = jsonl.read_lines(spark, x.path, schemas.SCORED_PAIR, min_partitions)
        missing = F.col("query").isNull() | F.col("passage").isNull() | F.col("score").isNull()
        reason = F.when(F.col(schemas.CORRUPT_COL).isNotNull(), "malformed").when(missing, "missing").when(
            F.isnan("score"), "nan")
        rows = rows.withColumn("reason", reason).withColumnRenamed(schemas.CORRUPT_COL, "record")
        if tally is None:
            return rows
        return tally.read(rows, x.number, **{f"n_{k}": F.col("reason") == k for k in ("malformed", "missing", "nan")})

    return read_each(spark, inputs, read, PAIRS)


def output_of(inputs: Sequence[Input], input_col: str = "input") -> Column:
    """The name of the output of a row's input."""
    if not inputs:
        return F.lit(None).cast("string")
    return F.element_at(F.array(*[F.lit(x.output) for x in inputs]), F.col(input_col) + 1)


def write_outputs(df: DataFrame, inputs: Sequence[Input], path: str, order: Sequence[str], columns: Sequence[str],
                  tally: Tally | None = None, name: str = "n_rows_out", ordered: bool = True) -> None:
    """``columns`` of ``df`` as JSONL, a folder ``output=<name>`` for each input with rows. With
    ``ordered``, a folder's part files, read by name, are in ``order`` within the input."""
    from distillery.sources.ordering import in_file_order

    rows = df.withColumn("output", output_of(inputs))
    if ordered:
        rows = in_file_order(rows, order, ["output"])
    if tally is not None:
        rows = tally.written(rows, name)
    jsonl.write_jsonl(rows.select(*columns, "output"), path, partition_by=["output"])
