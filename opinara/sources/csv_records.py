"""CSV files whose lines may be broken: every record comes with what is wrong with it, and a bad one takes no other along.

Spark's own reader with ``multiLine`` lets a quote that is never closed swallow the lines after it, and reads each file in one task.
Here files are read by lines, split as Spark splits them.  A quoted text may go on over line breaks until its quote closes; a line
that is a whole record by itself ends such a text, whose first line is then malformed.  What is open at the
end of a split is joined with the beginning of the next one by its place in the file.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions import first_match
from opinara.operators.cleaning import MALFORMED

# tasks get these functions by value: executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BROKEN_QUOTE, WRONG_FIELDS = "quote never closed", "wrong number of fields"


@dataclass(frozen=True)
class Dialect:
    """How fields are written, and how many a record has."""

    fields: int
    sep: str = ","
    quote: str = '"'
    escape: str = "\\"

    def count(self, text: str) -> int:
        """Fields of one record; -1 where a quote is left open."""
        doubled = self.escape == self.quote
        reader = csv.reader(text.splitlines(keepends=True), delimiter=self.sep, quotechar=self.quote, doublequote=True, escapechar=None if doubled else self.escape, strict=True)
        try:
            return len(next(reader, []))
        except csv.Error as error:
            return -1 if "unexpected end" in str(error) else 0

    def turns(self, text: str) -> bool:
        """Whether a line changes between inside and outside of quotes."""
        escaped = 0 if self.escape == self.quote else text.count(self.escape + self.quote)
        return (text.count(self.quote) - escaped) % 2 == 1

    def records(self, lines: list[str]) -> tuple[list[tuple[str, str | None]], list[str]]:
        """Records with what is wrong with them, and the lines at the end that may go on."""
        out: list[tuple[str, str | None]] = []
        first, last = 0, 0
        while first < len(lines):
            if not self.turns(lines[first]) or self.count(lines[first]) >= 0:
                out.append((lines[first], None))
                first += 1
                continue
            for last in range(first + 1, len(lines)):
                if self.turns(lines[last]) or self.count(lines[last]) == self.fields:
                    break
            else:
                return out, lines[first:]
            whole = "\n".join(lines[first : last + 1])
            if self.count(lines[last]) != self.fields and self.count(whole) == self.fields:
                out.append((whole, None))
                first = last + 1
            else:
                out.append((lines[first], BROKEN_QUOTE))
                first += 1
        return out, []

    def alone(self, lines: list[str]) -> list[tuple[str, str | None]]:
        """Records of lines that nothing follows."""
        out: list[tuple[str, str | None]] = []
        while lines:
            found, lines = self.records(lines)
            out += found
            if lines:
                out.append((lines[0], BROKEN_QUOTE))
                lines = lines[1:]
        return out


_OUT = "record string, reason string, file string, at long, head boolean"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("record", pa.string()), ("reason", pa.string()), ("file", pa.string()), ("at", pa.int64()), ("head", pa.bool_()))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], names=[name for name, _ in kinds])


class _Split:
    """One split of a file, line by line: records, and its two ends, which may belong together with the neighbours'."""

    def __init__(self, dialect: Dialect, file: str, start: int, length: int, header: str | None) -> None:
        self.dialect, self.file, self.start, self.end, self.header = dialect, file, start, start + length, header
        self.head: list[str] | None = [] if start else None  # lines before the first whole record, which may end another split's text
        self.open: list[str] = []

    def take(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        if self.header is not None and self.start == 0 and len(lines):
            if lines[0].as_py().rstrip("\r") == self.header:
                lines = lines.slice(1)
            self.header = None
        dialect = self.dialect
        if self.head is not None:
            n = 0
            while n < len(lines) and dialect.count(lines[n].as_py()) != dialect.fields:
                self.head.append(lines[n].as_py())
                n += 1
            lines = lines.slice(n)
            if not len(lines):
                return
            yield from self._close_head()
        plain = pc.sum(pc.bit_wise_and(pc.count_substring(lines, dialect.quote), 1)).as_py() if len(lines) else 0
        if not self.open and not plain:  # no line opens or closes a quote
            nothing = pa.nulls(len(lines), pa.string())
            yield pa.RecordBatch.from_arrays([lines.cast(pa.string()), nothing, nothing, pa.nulls(len(lines), pa.int64()), pa.nulls(len(lines), pa.bool_())], names=["record", "reason", "file", "at", "head"])
            return
        found, self.open = dialect.records(self.open + lines.to_pylist())
        yield _batch([(record, reason, None, None, None) for record, reason in found])

    def _close_head(self) -> Iterator[pa.RecordBatch]:
        if self.head:
            yield _batch([("\n".join(self.head), None, self.file, self.start, True)])
        self.head = None

    def finish(self) -> Iterator[pa.RecordBatch]:
        yield from self._close_head()
        if self.open:
            yield _batch([("\n".join(self.open), None, self.file, self.end, False)])


def _read(dialect: Dialect, header: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split: _Split | None = None
        for batch in batches:
            value, file, start, length = batch.columns
            places = pc.run_end_encode(pc.binary_join_element_wise(file.cast(pa.string()), start.cast(pa.string()), "\n"))
            first = 0
            for last in places.run_ends.to_pylist():
                where = (dialect, file[first].as_py(), start[first].as_py(), length[first].as_py(), header)
                if split is None or (split.file, split.start) != where[1:3]:
                    if split is not None:
                        yield from split.finish()
                    split = _Split(*where)
                yield from split.take(value.slice(first, last - first))
                first = last
        if split is not None:
            yield from split.finish()

    return run


def _ends(dialect: Dialect):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lines in batch.column(0).to_pylist():
                yield _batch([(record, reason, None, None, None) for record, reason in dialect.alone(lines.split("\n"))])

    return run


def read_records(spark: SparkSession, path: str, columns: list[str], header: str | None = None, sep: str = ",", quote: str = '"', escape: str = "\\", **options: str) -> DataFrame:
    """The records of CSV files as text ``columns``, and ``malformed``: null, or what is wrong with a record, whose fields are then those that could be read.

    ``header`` is the line to leave out at the beginning of each file.  Empty lines are no records.  A text that goes on over more than two splits of
    a file (128 MB each, unless set otherwise) is malformed.
    """
    dialect = Dialect(len(columns), sep, quote, escape)
    place = [F.col(f"_metadata.{name}") for name in ("file_path", "file_block_start", "file_block_length")]
    read = spark.read.text(path).select("value", *place).mapInArrow(_read(dialect, header), _OUT)
    inner = read.where("at is null").select("record", "reason")
    # the end of a split and the beginning of the one behind it; as many rows as splits
    ends = read.where("at is not null").groupBy("file", "at").agg(F.max(F.when(~F.col("head"), F.col("record"))).alias("tail"), F.max(F.when(F.col("head"), F.col("record"))).alias("head"))
    joined = ends.select(F.concat_ws("\n", "tail", "head").alias("lines")).mapInArrow(_ends(dialect), _OUT).select("record", "reason")
    records = inner.unionByName(joined).where(F.length(F.trim("record")) > 0)

    corrupt = "_corrupt_record"
    schema = ", ".join(f"`{name}` string" for name in (*columns, corrupt))
    settings = {"sep": sep, "quote": quote, "escape": escape, "multiLine": "true", "columnNameOfCorruptRecord": corrupt, "mode": "PERMISSIVE", **options}
    parsed = records.select("reason", F.from_csv("record", F.lit(schema), settings).alias("fields"))
    wrong = first_match([(F.col("reason").isNotNull(), F.col("reason")), (F.col(f"fields.{corrupt}").isNotNull(), F.lit(WRONG_FIELDS))], None)
    return parsed.select(*[F.col(f"fields.`{name}`").alias(name) for name in columns], wrong.alias(MALFORMED))
