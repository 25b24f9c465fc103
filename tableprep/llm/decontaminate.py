"""Benchmark decontamination by templates: numbers, names and units become placeholders, windows of the template are
joined by hash, and what stood in the placeholders must map consistently from the item to the document. Windows are also
joined as written, in small letters and without punctuation, since both decide what looks like a name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tableprep.llm.batches import raw, slices, text
from tableprep.llm.components import stored

WINDOW = 5
MIN_COVERAGE = 0.8
FILTER_BITS = 23
MOST_WORDS = 200_000

UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms lb lbs "
    "pound pounds oz ounce ounces ton tons ml l liter liters litre litres gallon gallons s sec second seconds min "
    "minute minutes h hr hour hours day days week weeks month months year years % percent degree degrees $ dollar "
    "dollars cent cents euro euros mph kmh km/h".split()
)
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
NUMBER = re.compile(r"[$€£+-]?\d[\d.,:/]*(?:st|nd|rd|th|%)?")
QUANTITY = re.compile(r"[$€£+-]?\d[\d.,:/]*([^\W\d_]+|%)")
PUNCTUATION = re.compile(r"[^\w]+")
CORE = re.compile(r"[\w$€£%+-](?:.*[\w%])?", re.DOTALL)

_EMPTY, _NUMBER, _UNIT, _CAPITAL, _ENDS = 1, 2, 4, 8, 16
_NUMBER_CODE, _UNIT_CODE, _NAME_CODE = (np.uint64(xxhash.xxh64_intdigest(x, 7)) for x in (b"<number>", b"<unit>", b"<name>"))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


class Words(dict):
    """Numbers of words met before; ``code`` and ``flags`` by number."""

    def __init__(self):
        super().__init__()
        self.code, self.flags = np.zeros(1024, dtype=np.uint64), np.zeros(1024, dtype=np.uint8)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        if number >= len(self.code):
            self.code, self.flags = np.resize(self.code, 2 * number), np.resize(self.flags, 2 * number)
        self.code[number], self.flags[number] = describe(text(word))
        return number


def core(word: str) -> str:
    """The word without punctuation around it."""
    found = CORE.search(word)
    return found.group() if found else ""


def plain(inner: str) -> str:
    """In small letters; without punctuation inside unless it is part of a number."""
    lower = inner.casefold()  # ß in capitals is SS
    if lower.isalnum() or NUMBER.fullmatch(inner) or QUANTITY.fullmatch(inner):
        return lower
    return PUNCTUATION.sub("", lower) or lower


def describe(word: str) -> tuple[int, int]:
    inner = core(word)
    lower = inner.lower()
    flags = 0
    if not inner:
        flags |= _EMPTY
    elif NUMBER.fullmatch(inner) or QUANTITY.fullmatch(inner) and QUANTITY.fullmatch(lower).group(1) in UNITS or lower in NUMBER_WORDS:
        flags |= _NUMBER
    elif inner[0].isupper() and not (len(inner) > 1 and inner.isupper()):
        flags |= _CAPITAL
    if lower in UNITS:
        flags |= _UNIT
    if word.rstrip("\"')]”’»")[-1:] in tuple(".!?:"):
        flags |= _ENDS
    return xxhash.xxh64_intdigest(plain(inner).encode(), 7), flags


def template(data: bytes, words: Words) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words that are not mere punctuation, their codes with placeholders, and their codes as written.

    A capitalised word that begins no sentence is a name; a unit is one only right behind a number."""
    tokens = data.split()
    if len(words) > MOST_WORDS:
        words.clear()
    number = np.fromiter(map(words.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    flags = words.flags[number]
    if (flags & _EMPTY).any():
        kept = np.flatnonzero((flags & _EMPTY) == 0)
        tokens, number, flags = [tokens[i] for i in kept], number[kept], flags[kept]
    written = words.code[number]
    codes = written.copy()
    is_number = (flags & _NUMBER) > 0
    begins = np.ones(len(tokens), dtype=bool)
    begins[1:] = (flags[:-1] & _ENDS) > 0
    behind = np.zeros(len(tokens), dtype=bool)
    behind[1:] = is_number[:-1]
    codes[is_number] = _NUMBER_CODE
    codes[(flags & _UNIT > 0) & behind & ~is_number] = _UNIT_CODE
    codes[(flags & _CAPITAL > 0) & ~begins] = _NAME_CODE
    return tokens, codes, written


def window_hashes(codes: np.ndarray, written: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each window as written and as template, and whether the template says more: it has a placeholder, and
    two words or more outside."""
    n = len(codes) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
    as_template, as_written = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
    literal = np.zeros(n, dtype=np.int64)
    for j in range(window):
        as_template = as_template * _BASE + codes[j:j + n]
        literal += codes[j:j + n] == written[j:j + n]
        as_written = as_written * _BASE + written[j:j + n]
    return as_written ^ _SECOND, as_template, (literal >= 2) & (literal < window)


def whole_hashes(written: np.ndarray, length: int) -> np.ndarray:
    """Hashes as written of the windows of ``length`` words, apart from those of other lengths."""
    n = max(0, len(written) - length + 1)
    found = np.full(n, length, dtype=np.uint64)
    for j in range(length):
        found = found * _BASE + written[j:j + n]
    return found ^ (found >> np.uint64(31)) * _SECOND


def _bit(hashes: np.ndarray, second: bool) -> np.ndarray:
    return ((np.multiply(hashes, _SECOND) if second else hashes) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _met(field: np.ndarray, hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    places = places[field[_bit(hashes[places], False)]]
    return places[field[_bit(hashes[places], True)]]


WINDOWS = T.StructType([
    T.StructField("window", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("length", T.IntegerType()),
    T.StructField("slots", T.ArrayType(T.StringType())), T.StructField("places", T.ArrayType(T.IntegerType())),
    T.StructField("as_written", T.BooleanType()), T.StructField("alike", T.IntegerType()),
    T.StructField("bits", T.ArrayType(T.LongType())),
])


def template_windows(docs: DataFrame, id_column: str, text_column: str, window: int = WINDOW, wanted=None,
                     short: Sequence[int] = ()) -> DataFrame:
    """``id`` and, for each window of the row, its hash ``as_written`` and, where it has a placeholder, that of its
    template, with its place and the words that stand in placeholders with theirs. Without ``wanted`` the rows are
    benchmark items: ``alike`` is the first place of the same template, and the first window of one that begins with a
    capital letter comes again with a name there. ``wanted``: a broadcast bit field of ``2 ** FILTER_BITS`` bits; windows
    it does not have are left out, and those it has by chance the join drops. An item of fewer words than a window is one
    window of its own length, as written only; ``short`` are the lengths that documents are searched for besides."""
    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType), *WINDOWS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, field = Words(), None
        if wanted is not None:
            field = np.unpackbits(np.frombuffer(wanted.value, dtype=np.uint8), bitorder="little").view(bool)
        for batch in slices(batches, text_column):
            rows, out = [], {name: [] for name in WINDOWS.names}
            for row, data in enumerate(raw(batch.column(text_column))):
                tokens, codes, written = template(data, words)
                hashes, templates, templated = window_hashes(codes, written, window)
                if field is None and 0 < len(tokens) < window:
                    hashes, templates, templated = whole_hashes(written, len(tokens)), np.zeros(1, np.uint64), np.zeros(1, bool)
                places, slotted, alike = np.arange(len(hashes)), np.flatnonzero(templated), {}
                if field is not None:
                    places, slotted = _met(field, hashes, places), _met(field, templates, slotted)

                def add(place: int, value: np.ndarray, as_written: bool, row=row, tokens=tokens, written=written, codes=codes) -> None:
                    slot = []
                    if field is None or not as_written:
                        slot = np.flatnonzero(codes[place:place + window] != written[place:place + window]).tolist()
                    rows.append(row)
                    out["window"].append(int(value.view(np.int64)))
                    out["at"].append(place)
                    out["length"].append(min(window, len(tokens)) if field is None else window)
                    out["slots"].append([plain(core(text(tokens[place + i]))) for i in slot])
                    out["places"].append([place + i for i in slot])
                    out["as_written"].append(as_written)
                    out["alike"].append(alike.get(place, place))
                    out["bits"].append([int(_bit(value, x)) for x in (False, True)] if field is None else [])

                if field is None:
                    first = {}
                    for place, value in enumerate(np.where(templated, templates, hashes).tolist()):
                        alike[place] = first.setdefault(value, place)
                for place in places.tolist():
                    add(place, hashes[place], True)
                for place in slotted.tolist():
                    add(place, templates[place], False)
                for length in short:
                    hashes = whole_hashes(written, length)
                    for place in _met(field, hashes, np.arange(len(hashes))).tolist():
                        add(place, hashes[place], True)
                if field is None and len(tokens) >= window and words.flags[words[tokens[0]]] & _CAPITAL:
                    codes[0] = _NAME_CODE  # the item may stand within a sentence of a document
                    _, templates, templated = window_hashes(codes[:window], written[:window], window)
                    if templated[0]:
                        add(0, templates[0], False)
            if rows:
                arrays = [pa.array(out[f.name], pa_type) for f, pa_type in zip(WINDOWS, _ARROW, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(id_column).take(pa.array(rows)), *arrays], names=schema.names)

    return docs.select(id_column, text_column).mapInArrow(run, schema)


_ARROW = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.bool_(), pa.int32(), pa.list_(pa.int64())]


def _field_of(windows: DataFrame) -> bytes:
    """The bit field of all windows. It has ``2 ** FILTER_BITS`` bits however many windows there are."""
    bits = windows.select(F.explode("bits").alias("bit"))
    whole = bits.groupBy(F.shiftright("bit", 5).alias("place")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("set")).toPandas()
    field = np.zeros(1 << FILTER_BITS - 5, dtype=np.uint32)
    field[whole["place"].to_numpy(dtype=np.int64)] = whole["set"].to_numpy(dtype=np.int64).astype(np.uint32)
    return field.tobytes()


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", item_column: str = "item_id",
               text_column: str = "text", window: int = WINDOW, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """Pairs of a document and a benchmark item it repeats: ``id_column``, ``item_column``, ``n_windows`` of the item,
    how many of them are ``matched``, ``coverage``, ``kind`` (``copy``, or ``reparameterised`` if a window is met only
    with other numbers, names or units in its places), and ``same_items`` (sorted ids of all items the row speaks for).

    A pair counts if at least ``min_coverage`` of the item's different template windows of ``window`` words stand in
    the document. A window met as written, but for capitals and punctuation, counts whatever stands elsewhere. One met as a
    template counts if its values are those that the item's values take: in an alignment of item and document, each item
    value takes the document value that most windows give it, itself if as many do. So one edited number costs no more
    than the windows that hold it, as an edited word does.

    Items that share a whole template and its values are one, named by the smallest id; those of other values are
    searched each for itself. An item with fewer words than a window is one window of its own length, as written. Null and
    empty texts match nothing. Different texts of one id are searched apart, and the best of them is the id's row, as with
    different texts of one item id; repeated rows count once. Empty tables give no rows. Ids may be null."""
    spark = docs.sparkSession

    def keyed(frame: DataFrame, key: str, name: str) -> DataFrame:
        body = F.col(text_column)
        return frame.select(F.struct(
            F.col(key).isNull().alias("no_id"), F.col(key).alias("id"), F.xxhash64(body).alias("text")).alias(name), body.alias("body"))

    found = stored(template_windows(keyed(benchmark, item_column, "item"), "item", "body", window).withColumnRenamed("id", "item"), "benchmark")
    short = sorted(row.length for row in found.where(F.col("length") < window).select("length").distinct().collect())
    first = F.struct("at", "slots", "places")
    unique = found.groupBy("item", "window", "as_written", "alike").agg(F.min(first).alias("f")).select(
        "item", "window", "as_written", "alike", "f.*")
    every = F.xxhash64(F.array_sort(F.collect_set(F.struct("window", "at", "slots", "places")))).alias("whole")
    whole = found.groupBy("item").agg(every).join(unique.groupBy("item").agg(F.count_distinct("alike").alias("n_windows")), "item")
    named = whole.groupBy("whole", "n_windows").agg(
        F.min("item").alias("item"), F.array_distinct(F.transform(F.array_sort(F.collect_list("item")), lambda i: i["id"])).alias("same_items"))
    asked = unique.join(named.select("item", "n_windows"), "item").select(
        "item", "n_windows", "window", "alike", F.col("as_written").alias("item_as_written"),
        F.col("at").alias("item_at"), F.col("slots").alias("item_slots"))
    wanted = spark.sparkContext.broadcast(_field_of(found))
    in_docs = template_windows(keyed(docs, id_column, "id"), "id", "body", window, wanted, short).select("id", "window", "at", "slots")
    run = ["id", "item", "n_windows", "shift"]
    met = stored(in_docs.join(asked, "window").select(
        "id", "item", "n_windows", (F.col("at") - F.col("item_at")).alias("shift"), "alike", "item_as_written", "item_slots",
        F.when(F.col("item_as_written"), F.col("item_slots")).otherwise(F.col("slots")).alias("slots")).distinct(), "met")
    pair = F.explode(F.arrays_zip(F.col("item_slots").alias("asked"), F.col("slots").alias("given"))).alias("pair")
    votes = met.select(*run, "alike", pair).groupBy(*run, "pair.asked", "pair.given").agg(F.count_distinct("alike").alias("n"))
    taken = votes.groupBy(*run, "asked").agg(
        F.max_by("given", F.struct("n", F.col("asked") == F.col("given"), "given")).alias("given"))
    values = taken.groupBy(*run).agg(F.map_from_entries(F.collect_list(F.struct("asked", "given"))).alias("values"))
    own = F.arrays_zip(F.col("item_slots").alias("asked"), F.col("slots").alias("given"))
    agrees = F.forall(own, lambda s: F.element_at("values", s["asked"]) == s["given"])
    counted = met.join(values, run, "left").where(F.col("item_as_written") | F.coalesce(agrees, F.lit(False)))
    pairs = counted.groupBy("id", "item", "n_windows").agg(
        F.collect_set("alike").alias("hit"), F.collect_set(F.when(F.col("item_slots") == F.col("slots"), F.col("alike"))).alias("same"))
    coverage = F.size("hit") / F.col("n_windows")
    good = pairs.withColumn("coverage", coverage).where(F.col("coverage") >= min_coverage).join(named.select("item", "same_items"), "item")
    rows = good.select(
        F.col("id.id").alias("id"), F.col("item.id").alias("item"), F.struct(
            "coverage", (F.size(F.array_except("hit", "same")) == 0).alias("is_copy"), F.size("hit").cast("long").alias("matched"),
            F.col("n_windows").cast("long").alias("n_windows"), "same_items").alias("row"))
    best = rows.groupBy("id", "item").agg(F.max("row").alias("row"))
    return best.select(
        F.col("id").alias(id_column), F.col("item").alias(item_column), "row.n_windows", "row.matched", "row.coverage",
        F.when(F.col("row.is_copy"), "copy").otherwise("reparameterised").alias("kind"), "row.same_items")
