"""CSV files as whole records, read by many tasks.

A quoted cell may hold line breaks, so a task that starts in the middle of a
file can't tell whether its first line begins a record. Every line is a
function of the state before it (outside or inside a quoted cell) to the state
after it, and such functions compose. A first pass composes them for each split
of the file; the driver chains the splits' functions (one row per split, like
the file listing it plans with) into the state and the row number that each
split starts with. A second pass then cuts records: those that begin in its
split. A record that runs into the next split is put together from its pieces.

Lines end at ``\\n`` (or ``\\r\\n``); a quote opens a cell at its start only and is
doubled inside it, as Spark's own CSV reader has it with ``escape='"'``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARSER = dict(quote='"', escape='"', mode="PERMISSIVE")

# Possessive quantifiers: every choice is the only one, so matching is linear and needs no stack.
_QUOTED_REST = r'[^"]*+(?:""[^"]*+)*+'  # what follows an opening quote, up to a closing one
_CELL = rf'(?:"{_QUOTED_REST}"(?:[^",][^,]*+)?+|[^",][^,]*+)?+'
#: A line that starts outside and ends inside a quoted cell; and one that starts inside.
_OPENS = rf'^(?:{_CELL},)*+"{_QUOTED_REST}\z'
_STAYS = rf'^{_QUOTED_REST}(?:"(?:[^",][^,]*+)?+,(?:{_CELL},)*+"{_QUOTED_REST})?+\z'
#: A comma and the cell after it, closed or not.
_NEXT_CELL = rf',(?:"{_QUOTED_REST}(?:"(?:[^",][^,]*+)?+)?+|[^",][^,]*+)?+'


@dataclass(frozen=True)
class Split:
    """One split of a file: the state and the row number it starts with."""

    inside: bool
    row: int
    last: bool
    crlf: bool


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, value, opens, stays, blank)``: the lines in file order within each split."""
    value = F.col("value")
    quoted = F.instr(value, '"') > 0
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.when(quoted, value.rlike(_OPENS)).otherwise(False).alias("opens"),
        F.when(quoted, value.rlike(_STAYS)).otherwise(True).alias("stays"),
        ((value == "") | (value == "\r")).alias("blank"), value.endswith("\r").alias("cr"))


def states(opens: np.ndarray, stays: np.ndarray, inside: bool) -> np.ndarray:
    """The state before every line, and after the last: lines where both states lead
    to one set it, those that swap the two flip it, all others leave it."""
    n = len(opens)
    sets, flips = opens == stays, opens & ~stays
    parity = np.concatenate([[0], np.cumsum(flips)])
    last = np.concatenate([[0], np.maximum.accumulate(np.where(sets, np.arange(1, n + 1), 0))]) if n else np.zeros(1, np.int64)
    base = np.concatenate([[inside], opens])[last]  # the state after the last line that set it
    return base ^ ((parity - parity[last]) & 1).astype(bool)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Parts of batches that lie in one split; columns file and start come first."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        code = file.indices.to_numpy()
        cuts = np.flatnonzero((code[1:] != code[:-1]) | (start[1:] != start[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield (file.dictionary[int(code[a])].as_py(), int(start[a])), batch.slice(a, b - a)


def _flags(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False).astype(bool) for n in names]


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: the state after it and the records that start in it, for either state before it."""

    def row(split, after, rows, cr) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": [split[0]], "start": [split[1]], "opens": [bool(after[0])], "stays": [bool(after[1])], "rows_out": [rows[0]], "rows_in": [rows[1]], "crlf": [cr]})

    now, after, rows, cr = None, [False, True], [0, 0], False
    for split, part in _runs(batches):
        opens, stays, blank, ends_cr = _flags(part, "opens", "stays", "blank", "cr")
        if split != now:
            if now is not None:
                yield row(now, after, rows, cr)
            now, after, rows, cr = split, [False, True], [0, 0], bool(ends_cr[0])
        for k in (0, 1):
            before = states(opens, stays, after[k])
            rows[k] += int((~before[:-1] & ~blank).sum())
            after[k] = bool(before[-1])
    if now is not None:
        yield row(now, after, rows, cr)


def plan_splits(lines: DataFrame) -> dict[tuple[str, int], Split]:
    """What every split starts with, by (file, start)."""
    found = lines.select("file", "start", "opens", "stays", "blank", "cr").mapInArrow(
        _summary, "file string, start long, opens boolean, stays boolean, rows_out long, rows_in long, crlf boolean").collect()
    out: dict[tuple[str, int], Split] = {}
    file, inside, row, crlf = None, False, 0, False
    by_place = sorted(found, key=lambda r: (r["file"], r["start"]))
    for k, r in enumerate(by_place):
        if r["file"] != file:
            file, inside, row, crlf = r["file"], False, 0, r["crlf"]
        last = k + 1 == len(by_place) or by_place[k + 1]["file"] != file
        out[file, r["start"]] = Split(inside, row, last, crlf)
        row += r["rows_in"] if inside else r["rows_out"]
        inside = r["stays"] if inside else r["opens"]
    return out


class _Cutter:
    """Cuts the lines of one split into records."""

    def __init__(self, key: tuple[str, int], plan: dict[tuple[str, int], Split]):
        if key not in plan:
            raise RuntimeError(f"split {key} was not there when the file was scanned: the file or the number of cores changed; read it again")
        self.key, self.split = key, plan[key]
        self.inside, self.row = self.split.inside, self.split.row - 1
        #: Lines of the record that is open, and whether it began in an earlier split.
        self.open: list[str] = []
        self.head = self.inside

    def feed(self, part: pa.RecordBatch) -> tuple[list[int], list[str], list[bool]]:
        """Row numbers and texts of the records that end here; True marks a piece."""
        opens, stays, blank = _flags(part, "opens", "stays", "blank")
        before = states(opens, stays, self.inside)
        self.inside = bool(before[-1])
        values = part.column(part.schema.get_field_index("value"))
        begins = np.flatnonzero(~before[:-1] & ~blank)
        goes_on = np.flatnonzero(before[:-1])
        rows, texts, pieces = [], [], []
        if not len(goes_on):
            # every line is a record; the last stays open in case the next line goes on with it
            self._close(rows, texts, pieces)
            found = values.take(pa.array(begins, pa.int64())).to_pylist()
            rows += range(self.row + 1, self.row + len(found))
            texts += found[:-1]
            pieces += [False] * (len(texts) - len(pieces))
            self.row += len(found)
            self.open = found[-1:]
            return rows, texts, pieces
        values = values.to_pylist()
        for k in np.sort(np.concatenate([begins, goes_on])).tolist():
            if not before[k]:
                self._close(rows, texts, pieces)
                self.row += 1
            self.open.append(values[k])
        return rows, texts, pieces

    def _close(self, rows: list, texts: list, pieces: list, piece: bool = False) -> None:
        if self.open:
            rows.append(self.row)
            texts.append("\n".join(self.open))
            pieces.append(piece or self.head)
        self.open, self.head = [], False

    def end(self) -> tuple[list[int], list[str], list[bool]]:
        rows, texts, pieces = [], [], []
        self._close(rows, texts, pieces, self.inside and not self.split.last)
        return rows, texts, pieces


_RECORD = "file string, row long, start long, record string, piece boolean"


def _cut(lines: DataFrame, plan: dict[tuple[str, int], Split]) -> DataFrame:
    """``(file, row, start, record, piece)``: whole records, and pieces of those that cross splits."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(cutter, rows, texts, pieces) -> pa.RecordBatch:
            if cutter.split.crlf:
                texts = [t[:-1].replace("\r\n", "\n") if t.endswith("\r") else t.replace("\r\n", "\n") for t in texts]
            n = len(rows)
            return pa.RecordBatch.from_pydict({"file": [cutter.key[0]] * n, "row": rows, "start": [cutter.key[1]] * n, "record": texts, "piece": pieces}, schema)

        schema = pa.schema([("file", pa.string()), ("row", pa.int64()), ("start", pa.int64()), ("record", pa.string()), ("piece", pa.bool_())])
        cutter = None
        for key, part in _runs(batches):
            if cutter is None or cutter.key != key:
                if cutter is not None:
                    yield out(cutter, *cutter.end())
                cutter = _Cutter(key, plan)
            yield out(cutter, *cutter.feed(part))
        if cutter is not None:
            yield out(cutter, *cutter.end())

    return lines.select("file", "start", "value", "opens", "stays", "blank").mapInArrow(cut, _RECORD)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, row, record)``: every record of the CSV file(s) at ``path``, as text.

    ``row`` numbers the records of a file from 0, without gaps and in file order,
    however many tasks read it. Empty lines are no records. The file is read
    twice, both times in parallel: once for the quotes alone.
    """
    lines = lines_of(spark, path)
    plan = plan_splits(lines)
    whole = _cut(lines, plan).filter("not piece").select("file", "row", "record")
    keys = sorted(plan)
    crossed = [(f, s) for at, (f, s) in enumerate(keys) if plan[f, s].inside or (at + 1 < len(keys) and keys[at + 1][0] == f and plan[keys[at + 1]].inside)]
    if not crossed:
        return whole
    # Only the splits around a crossed border are cut a second time, for the pieces.
    around = lines.join(F.broadcast(spark.createDataFrame(crossed, "file string, start long")), ["file", "start"], "left_semi")
    pieces = _cut(around, {k: plan[k] for k in crossed}).filter("piece")
    joined = F.array_join(F.sort_array(F.collect_list(F.struct("start", "record"))).getField("record"), "\n")
    return whole.unionByName(pieces.groupBy("file", "row").agg(joined.alias("record")))


def text_schema(width: int) -> T.StructType:
    """``width`` string columns ``c0…``."""
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])


def cells(record: Column) -> Column:
    """How many cells a record has."""
    return F.size(F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_NEXT_CELL), F.lit(0)))


def used_cells(record: Column) -> Column:
    """How many cells a record has up to its last one with any text."""
    text = F.regexp_replace(record, r",+\z", "")
    return F.when(text == "", 0).otherwise(cells(text))


def parsed(record: Column, schema: T.StructType) -> Column:
    """The record as a struct of the schema's types, by Spark's CSV parser."""
    return F.from_csv(record, ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields), {**PARSER, "maxColumns": str(max(20480, len(schema.fields) + 1))})


def first_record(spark: SparkSession, path: str) -> list[str | None] | None:
    """The cells of the first record; None where there is none. Spark's own reader stops after it."""
    rows = spark.read.options(**PARSER, header=False, multiLine=True).csv(path).limit(1).collect()
    return list(rows[0]) if rows else None
