"""CSV files with line breaks inside quotes, read by as many tasks as they have splits.

Whether a line begins inside quotes depends on all lines before it. Each split is therefore run twice through the two-state
automaton of quotes, once for either state it may begin in; the outcomes of the splits, a few bytes each, are composed in
order, and then every split knows the state it begins in. A record that runs over the end of a split is put together from
its pieces, which are all that is shuffled."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tableprep.sources.splits import earlier, kept_small, placed

OUTSIDE, INSIDE = 0, 1
_OPEN = r'"[^"]*+(?:""[^"]*+)*+'
#: The rest of a field behind the quote that closes it is taken as it stands.
_FIELD = rf'(?:{_OPEN}"[^,]*+|[^",][^,]*+)?+,'
_ENDS_OPEN = re.compile(rf"(?:{_FIELD})*+{_OPEN}")
_CLOSES = re.compile(r'[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,|\Z)')
#: Files that Spark's reader can split; those that need their quotes followed; those that only a whole read takes.
PLAIN, QUOTED, WHOLE = 0, 1, 2


def state_after(line: str, state: int) -> int:
    """Whether quotes are open at the end of a line that begins in ``state``. Quotes open at the start of a field only;
    doubled ones inside do not close."""
    if '"' not in line:
        return state
    start = 0
    if state == INSIDE:
        closed = _CLOSES.match(line)
        if closed is None:
            return INSIDE
        start = closed.end()
        if not closed[0].endswith(","):
            return OUTSIDE
    return INSIDE if _ENDS_OPEN.fullmatch(line, start) else OUTSIDE


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """The lines of each split in turn; rows are keyed by their first ``keys`` columns."""
    rows = (row for batch in batches for row in zip(*[column.to_pylist() for column in batch.columns], strict=True))
    return groupby(rows, key=lambda row: row[:keys])


@dataclass
class _Outcome:
    """One split from one starting state: where it ends, whether quotes were open between lines, how many records begin in
    it, and whether the last of those looks blank."""

    state: int
    spans: bool = False
    records: int = 0
    blank: bool = False

    def take(self, line: str, blank: bool) -> None:
        if self.state == OUTSIDE and line:
            self.records += 1
            self.blank = blank
        self.state = state_after(line, self.state)
        self.spans |= self.state == INSIDE


SPLIT = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("start", T.LongType()), T.StructField("odd", T.IntegerType()),
    *[T.StructField(f"{name}_{state}", kind) for state in (OUTSIDE, INSIDE) for name, kind in (
        ("end", T.IntegerType()), ("spans", T.BooleanType()), ("records", T.LongType()), ("blank", T.BooleanType()))]])
PIECE = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("start", T.LongType()), T.StructField("begun", T.LongType()),
    T.StructField("first", T.BooleanType()), T.StructField("last", T.BooleanType()), T.StructField("text", T.StringType())])
PIECES_AT_ONCE = 4096


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    columns = zip(zip(*rows, strict=True), schema.fields, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType.simpleString()]) for c, f in columns], names=schema.names)


def _outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of ``SPLIT`` for each split of (path, start, odd, blank, line)."""
    for (path, start), lines in _runs(batches, 2):
        both, odd = (_Outcome(OUTSIDE), _Outcome(INSIDE)), PLAIN
        for _, _, kind, blank, line in lines:
            odd = max(odd, kind)
            for each in both:
                each.take(line, blank)
        ends = [value for each in both for value in (each.state, each.spans, each.records, each.blank)]
        yield _batch([(path, start, odd, *ends)], SPLIT)


def _composed(splits: DataFrame) -> DataFrame:
    """The splits with the state each begins in (``entry``), the split in which a record open there began (``opened``),
    and whether the last record of the file begins in it (``is_last``)."""
    in_order = Window.partitionBy("path").orderBy("start")
    flips = (F.col("end_0") == INSIDE) & (F.col("end_1") == OUTSIDE)
    fixed = F.col("end_0") == F.col("end_1")
    turns = F.sum(F.when(flips, 1).otherwise(0)).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    known = splits.withColumn("turns", turns)
    # a split that ends alike from either state settles it; those behind it keep or turn it
    settled = F.last(F.when(fixed, F.struct(F.col("end_0").alias("state"), "turns")), True).over(earlier())
    known = known.withColumn("settled", settled).withColumn("turned", F.coalesce(F.lag("turns").over(in_order), F.lit(0)))
    since = F.col("turned") - F.coalesce("settled.turns", F.lit(0))
    known = known.withColumn("entry", F.pmod(F.coalesce("settled.state", F.lit(OUTSIDE)) + since, F.lit(2)).cast("int"))

    def by_entry(name: str) -> Column:
        return F.when(F.col("entry") == INSIDE, F.col(f"{name}_1")).otherwise(F.col(f"{name}_0")).alias(name)

    known = known.select("path", "start", "odd", "entry", *[by_entry(name) for name in ("end", "spans", "records", "blank")])
    begun = F.last(F.when((F.col("end") == INSIDE) & (F.col("records") > 0), F.col("start")), True).over(earlier())
    last = F.max(F.when(F.col("records") > 0, F.col("start"))).over(Window.partitionBy("path"))
    return known.select("*", begun.alias("opened"), F.coalesce(F.col("start") == last, F.lit(False)).alias("is_last"))


def _pieces(whole: bool):
    """What splits hold of (path, start, entry, opened, is_last, line), as rows of ``PIECE``: the records that lie in one
    split, or the pieces of those that do not."""
    def of_split(path: str, start: int, entry: int, opened: int | None, is_last: bool, lines: Iterator[tuple]) -> Iterator[tuple]:
        state, held, begun, first = entry, [], opened, False
        ready: tuple | None = None  # the last record begun and ended here, until it is known that another follows
        seen = False
        for row in lines:
            line = row[-1]
            if state == OUTSIDE:
                if not line:
                    continue
                held, begun, first, seen = [], start, start == 0 and not seen, True
            held.append(line)
            state = state_after(line, state)
            if state == OUTSIDE:
                if begun == start:
                    if whole and ready is not None:
                        yield ready
                    ready = (path, start, begun, first, False, "\n".join(held))
                elif not whole:
                    yield path, start, begun, False, False, "\n".join(held)
                held = []
        ends_in_other = bool(held) and begun == start
        if whole and ready is not None:
            yield (*ready[:4], is_last and not ends_in_other, ready[5])
        if held and not whole:
            yield path, start, begun, first and begun == start, is_last and begun == start, "\n".join(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for key, lines in _runs(batches, 5):
            for row in of_split(*key, lines):
                rows.append(row)
                if len(rows) == PIECES_AT_ONCE:
                    yield _batch(rows, PIECE)
                    rows = []
        if rows:
            yield _batch(rows, PIECE)

    return run


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with their places; a carriage return in front of a line break belongs to it."""
    value = F.col("value")
    bare = F.when(value.endswith("\r"), F.substring(value, F.lit(1), F.char_length(value) - 1)).otherwise(value)
    return placed(spark.read.option("lineSep", "\n").text(paths).select(bare.alias("line")))


def survey(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The splits of the files under ``paths``, as ``_composed`` tells them. Only lines that hold quotes go to Python."""
    line = F.col("line")
    odd = F.when(line.contains("\r"), WHOLE).when((line != "") & (F.trim(line) == ""), QUOTED).otherwise(PLAIN)
    short = F.when(line.contains('"'), line).otherwise(F.when(line == "", "").otherwise("x"))
    sent = _lines(spark, paths).select("path", "start", odd.alias("odd"), line.rlike('^[",\\s]*$').alias("blank"), short.alias("line"))
    return _composed(sent.mapInArrow(_outcomes, SPLIT))


def kinds_of_files(splits: DataFrame) -> DataFrame:
    """(file, kind): ``PLAIN`` where every record is one line and the last is not blank, ``WHOLE`` where lines end in bare
    carriage returns, else ``QUOTED``."""
    ends_blank = F.max(F.col("is_last") & F.col("blank"))
    kind = F.greatest(F.max("odd"), F.when(F.max("spans") | ends_blank, QUOTED).otherwise(PLAIN))
    path = F.col("path")
    file = F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    return splits.groupBy("path").agg(kind.alias("kind")).select(file.alias("file"), "kind")


def read_quoted(spark: SparkSession, paths: list[str], splits: DataFrame, names: list[str], header: bool) -> DataFrame:
    """The records of the files at ``paths`` as string columns ``names``, without headers and without a blank record at the
    end of a file. Wrong headers fail when they are read."""
    known = kept_small(splits.select("path", "start", "entry", "opened", "is_last"), "quotes")
    lines = _lines(spark, paths).select("path", "start", "line").join(known, ["path", "start"], "left").select(
        "path", "start", F.coalesce("entry", F.raise_error(F.lit("files or split settings changed")).cast("int")).alias("entry"),
        "opened", "is_last", "line")
    columns = ["path", "begun", "first", "last", "text"]
    alone = lines.mapInArrow(_pieces(True), PIECE).select(*columns)
    split = lines.mapInArrow(_pieces(False), PIECE).groupBy("path", "begun").agg(
        F.max("first").alias("first"), F.max("last").alias("last"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda p: p["text"]), "\n").alias("text"))
    more = "more"
    while more in names:
        more += "_"
    fields = ", ".join("`" + name.replace("`", "``") + "` string" for name in [*names, more])
    parsed = alone.unionByName(split.select(*columns)).select(
        "first", "last", F.from_csv("text", fields, {"quote": '"', "escape": '"'}).alias("row"))
    cells = [F.col("row").getField(name) for name in names]
    blank = F.lit(True)
    for cell in cells:
        blank = blank & F.coalesce(cell == "", F.lit(True))
    kept = ~(F.col("last") & blank)
    if header:
        same = F.col("row").getField(more).isNull()
        for cell, name in zip(cells, names, strict=True):
            same = same & F.coalesce(F.lower(cell) == name.lower(), F.lit(name.startswith("_c")))
        other = F.raise_error(F.lit(f"a file has another header than {', '.join(names)}")).cast("boolean")
        kept = F.when(F.col("first"), F.when(same, False).otherwise(other)).otherwise(kept)
    return parsed.where(kept).select(*[cell.alias(name) for cell, name in zip(cells, names, strict=True)])
