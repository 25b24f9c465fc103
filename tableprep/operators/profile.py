"""Profiling values: characters, hyphens, frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableprep.errors import SchemaError
from tableprep.functions.columns import quoted
from tableprep.functions.fixed import CLASS_LABELS, TOO_HIGH, bucket_label

STEP_BYTES = 2**20  # text counted at once inside a task
CLASSES = (
    "non_digit", "letter", "digit", "typeable_other", "non_typeable", "not_number", "not_date", "leading", "non_leading")
LEADING_HYPHEN = -1  # stands for a hyphen that starts a text, beside its own code point


def _refuse(names: Sequence[str], made: Sequence[str]) -> None:
    """An error if one of ``names`` is also that of a column made here, in whatever case."""
    taken = [name for name in names if name.lower() in made]
    if taken:
        raise SchemaError(f"the result has columns of its own called {', '.join(taken)}; rename those of the frame")


def _partial_counts(
    frame: DataFrame, column: str, by: Sequence[str], leading_hyphens_too: bool = False
) -> DataFrame:
    """(by…, code_point, n): characters counted per step, still to be summed.

    ``leading_hyphens_too`` adds the texts that start with a hyphen, under ``LEADING_HYPHEN``, and a row with a null
    code point for each group with a null text, so that a group without any text is seen.

    Tasks count about a mebibyte of text at a time with array operations, so what is shuffled is one row per task,
    group and distinct character, never one row per character. A very long text is held as bytes, as a string and as
    32-bit code points while it is counted, plain ASCII as bytes alone.
    """
    by = list(by)
    low, lead, step_bytes = TOO_HIGH, LEADING_HYPHEN, STEP_BYTES

    def count_batches(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def steps(batch):
            """Whole rows of about ``step_bytes``."""
            sizes = pc.fill_null(pc.binary_length(batch.column(len(by))), 0).to_numpy(zero_copy_only=False)
            lots = np.cumsum(sizes, dtype=np.int64) // step_bytes
            edges = [0, *(np.flatnonzero(np.diff(lots)) + 1), batch.num_rows]
            for first, last in zip(edges, edges[1:]):
                yield batch.slice(first, last - first)

        def groups(step):
            """A number for each row's group, and a row of each group."""
            group = np.zeros(step.num_rows, dtype=np.int64)
            for i in range(len(by)):
                codes = step.column(i).dictionary_encode(null_encoding="encode")
                group = group * len(codes.dictionary) + codes.indices.to_numpy(zero_copy_only=False)
                group = np.unique(group, return_inverse=True)[1]
            return group, np.unique(group, return_index=True)[1]

        def no_text(step):
            member = pa.array(groups(step)[1])
            return pa.RecordBatch.from_arrays(
                [*[step.column(i).take(member) for i in range(len(by))], pa.nulls(len(member), pa.int32()),
                 pa.array(np.zeros(len(member), dtype=np.int64))],
                names=[*by, "code_point", "n"],
            )

        def code_points(texts):
            """All code points of the texts, and where each text's end. Taken from the buffers at once where the bytes are well
            formed; else text by text, as a malformed byte counts as one U+FFFD."""
            values = texts.cast(pa.binary())
            offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1]
            held = values.buffers()[2]
            data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held else np.zeros(0, np.uint8)
            places = offsets[1:].astype(np.int64) - offsets[0]
            if not (data & 0x80).any():
                return data, places
            leads = (data & 0xC0) != 0x80
            firsts = np.concatenate([[0], places[:-1]])[np.diff(offsets) > 0]
            try:
                whole = data.tobytes().decode("utf-8") if leads[firsts].all() else None
            except UnicodeDecodeError:
                whole = None
            if whole is not None:
                return np.frombuffer(whole.encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum(leads)])[places]
            read = [value.decode("utf-8", "replace") for value in values.to_pylist()]
            return np.frombuffer("".join(read).encode("utf-32-le"), np.uint32), np.cumsum([len(value) for value in read], dtype=np.int64)

        def count_step(step):
            group, member = groups(step)
            texts = step.column(len(by))
            points, ends = code_points(texts)
            begins = np.concatenate([[0], ends[:-1]])
            counted, high = np.zeros(len(member) * low, dtype=np.int64), []
            for start in range(0, len(points), step_bytes):
                piece = points[start:start + step_bytes].astype(np.int64)
                lengths = np.minimum(ends, start + len(piece)) - np.maximum(begins, start)
                owner = np.repeat(group, np.maximum(lengths, 0))
                is_low = piece < low
                counted += np.bincount(owner[is_low] * low + piece[is_low], minlength=len(counted))
                high.append(np.unique(owner[~is_low] * 0x110000 + piece[~is_low], return_counts=True))
            hit = np.flatnonzero(counted)
            owners, found, n = [hit // low], [hit % low], [counted[hit]]
            for pairs, times in high:
                owners.append(pairs // 0x110000)
                found.append(pairs % 0x110000)
                n.append(times)
            if leading_hyphens_too:
                starts = pc.starts_with(texts, "-").to_numpy(zero_copy_only=False).astype(bool)
                owners.append(np.arange(len(member)))
                found.append(np.full(len(member), lead))
                n.append(np.bincount(group[starts], minlength=len(member)))
            keys = pa.array(member[np.concatenate(owners)])
            return pa.RecordBatch.from_arrays(
                [
                    *[step.column(i).take(keys) for i in range(len(by))],
                    pa.array(np.concatenate(found).astype(np.int32)), pa.array(np.concatenate(n).astype(np.int64)),
                ],
                names=[*by, "code_point", "n"],
            )

        for batch in batches:
            valid = pc.is_valid(batch.column(len(by)))
            nulls = batch.filter(pc.invert(valid))
            if leading_hyphens_too and nulls.num_rows:
                yield from map(no_text, steps(nulls))
            batch = batch.filter(valid)
            if batch.num_rows:
                yield from map(count_step, steps(batch))

    fields = [frame.schema[c] for c in by]
    partial = T.StructType([*fields, T.StructField("code_point", T.IntegerType()), T.StructField("n", T.LongType())])
    texts = frame.select(*[quoted(c) for c in by], quoted(column).cast("string").alias("__text"))
    return texts.mapInArrow(count_batches, partial)


def character_counts(frame: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """(by…, code_point, n): how often each character occurs in ``column``. ``by`` may not use the two names."""
    _refuse(by, ("code_point", "n"))
    return _partial_counts(frame, column, by).groupBy(*[quoted(c) for c in by], "code_point").agg(F.sum("n").alias("n"))


def with_bucket_label(buckets: DataFrame, bucket: str = "bucket") -> DataFrame:
    """Adds ``label``, the three-wide name of each bucket."""
    labels = "\n".join(bucket_label(i) for i in range(TOO_HIGH + len(CLASS_LABELS)))
    return buckets.withColumn("label", F.element_at(F.split(F.lit(labels), "\n"), F.col(bucket) + 1))


def char_histogram(
    frame: DataFrame, column: str, by: Sequence[str] = (), include: Sequence[int] | None = None
) -> DataFrame:
    """(by…, bucket, n, label): a count per character 0-255 and one bucket, 256, for all above.

    ``include`` keeps only the listed buckets among 0-255; bucket 256 always stays. ``by`` may not use the names of the
    result's other columns, nor ``code_point``.
    """
    _refuse(by, ("code_point", "bucket", "n", "label"))
    bucket = F.least(F.col("code_point"), F.lit(TOO_HIGH)).alias("bucket")
    counts = _partial_counts(frame, column, by).select(*[quoted(c) for c in by], bucket, "n")
    if include is not None:
        counts = counts.where(F.col("bucket").isin([*include, TOO_HIGH]))
    return with_bucket_label(counts.groupBy(*[quoted(c) for c in by], "bucket").agg(F.sum("n").alias("n")))


def leading_hyphens(text: Column) -> Column:
    """1 when the untrimmed text starts with a hyphen."""
    return F.when(text.startswith("-"), 1).otherwise(0)


def non_leading_hyphens(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("-"))) - leading_hyphens(text)


def hyphen_position(frame: DataFrame, column: str) -> DataFrame:
    """``frame`` with (leading, non_leading) hyphen counts of ``column``; it may not have columns of these names."""
    _refuse(frame.columns, ("leading", "non_leading"))
    text = quoted(column)
    return frame.withColumns(
        {"leading": leading_hyphens(text).cast("bigint"), "non_leading": non_leading_hyphens(text).cast("bigint")}
    )


def char_class_totals(frame: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per group with the totals of buckets 257-265. As sums in SQL, those of a group whose texts are all null
    are null, but for its leading hyphens, which are 0; without groups they are 0.

    Letters are Unicode letters; typeable is the space to the tilde. Characters that rule out a number are typeables
    other than digits, dots and a leading hyphen; those that rule out a date or time are typeables other than digits,
    ``/ : . T Z``, spaces and non-leading hyphens. Classes are decided per counted character, not per occurrence.
    ``by`` may not use the names of the totals, nor ``code_point`` and ``n``.
    """
    _refuse(by, (*CLASSES, "code_point", "n"))
    n, point = F.col("n"), F.col("code_point")
    char = F.decode(F.unhex(F.lpad(F.hex(F.greatest(point, F.lit(0))), 8, "0")), "UTF-32")
    real = point != LEADING_HYPHEN
    digit = point.between(48, 57)
    letter = char.rlike(r"\p{L}")
    typeable = point.between(32, 126)

    def total(condition: Column, name: str) -> Column:
        counted = F.coalesce(F.sum(F.when(condition, n)), F.lit(0))
        return (F.when(F.count("code_point") > 0, counted) if by and name != "leading" else counted).alias(name)

    totals = _partial_counts(frame, column, by, leading_hyphens_too=True).groupBy(*[quoted(c) for c in by]).agg(
        total(real & ~digit, "non_digit"),
        total(real & letter, "letter"),
        total(digit, "digit"),
        total(typeable & ~letter & ~digit, "typeable_other"),
        total(real & ~typeable & ~letter & ~digit, "non_typeable"),
        total(typeable & ~digit & (point != ord(".")), "not_number"),
        total(typeable & ~digit & ~point.isin([ord(c) for c in "/:. TZ-"]), "not_date"),
        total(point == LEADING_HYPHEN, "leading"),
        total(point == ord("-"), "hyphens"),
    )
    return totals.select(
        *[quoted(c) for c in by], "non_digit", "letter", "digit", "typeable_other", "non_typeable",
        (F.col("not_number") - F.col("leading")).alias("not_number"),
        (F.col("not_date") + F.col("leading")).alias("not_date"),
        "leading", (F.col("hyphens") - F.col("leading")).alias("non_leading"),
    )


def value_counts(frame: DataFrame, column: str, null_code: str = "9") -> DataFrame:
    """(value, n): frequencies of ``column``, nulls counted under ``null_code``."""
    value = F.coalesce(quoted(column).cast("string"), F.lit(null_code)).alias("value")
    return frame.groupBy(value).agg(F.count("*").alias("n"))


def row_count(frame: DataFrame) -> DataFrame:
    """One row, ``n``."""
    return frame.agg(F.count("*").alias("n"))
