"""Secret scans with column functions only, and multipart credentials linked by an interval join.

A lone user name, a lone 40-letter string or a lone service address is no finding. Such weak candidates are reported
where the parts that make them a credential stand within ``scope`` code points of each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tableprep.llm.components import stored
from tableprep.llm.names import fresh

# fixed values: the patterns and least lengths of the base kinds
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = ("assign", "access", "hex")
LEAST = {"assign": 8, "access": 16, "hex": 32}

SECRET = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
#: Flat classes, as Java follows a repeated group by recursion: dotted texts would overflow its stack.
ENDPOINT = r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?|(?<![A-Za-z0-9.-])[a-z0-9.-]*[a-z0-9-]\.amazonaws\.com"
EMPTY_LABEL = r"^\.|^[^:/]*\.\."
IDENTIFIER = r"""(?i:(?:user(?:_?name)?|login|account|client_?id|access_?key_?id))["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
WEAK = ("secret", "endpoint", "identifier")
KINDS = (*BASE, *WEAK)
SCOPE = 240

SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


#: Arrays are walked in chunks of so many elements, since what an aggregate gathers is copied at every step.
CHUNK = 128


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _chunks(items: Column) -> Column:
    """Numbers of the chunks of an array, which may be empty."""
    return F.filter(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int")), lambda c: c * CHUNK < F.size(items))


def _chunk(items: Column, number: Column) -> Column:
    return F.slice(items, number * CHUNK + 1, CHUNK)


def _all_spans(body: Column, pattern: str, kind: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost matches that do not overlap, in code points; those that ``keep`` refuses are dropped. It gets a struct of
    ``match`` and ``inner``, its last group. The work grows with the text and the number of matches."""
    group = 2 if pattern == ASSIGN else 0
    parts = [F.split(body, pattern, -1).alias("gap"), F.regexp_extract_all(body, F.lit(pattern), F.lit(0)).alias("match")]
    if group:
        parts.append(F.regexp_extract_all(body, F.lit(pattern), F.lit(group)).alias("inner"))
    met = F.transform(F.filter(F.arrays_zip(*parts), lambda x: x["match"].isNotNull()), lambda x: F.struct(
        F.char_length(x["gap"]).cast("bigint").alias("gap"), F.char_length(x["match"]).cast("bigint").alias("length"),
        (F.lit(True) if keep is None else keep(x)).alias("good")))
    nothing = F.array().cast(SPAN)

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + x["length"]
        span = F.array(F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(x["good"], F.concat(state["spans"], span.cast(SPAN))).otherwise(state["spans"]).alias("spans"))

    def spans(items: Column) -> Column:
        zero = F.lit(0).cast("bigint")
        lengths = F.transform(_chunks(items), lambda c: F.aggregate(_chunk(items, c), zero, lambda n, x: n + x["gap"] + x["length"]))
        firsts = F.aggregate(lengths, F.array(zero), lambda known, n: F.concat(known, F.array(F.element_at(known, -1) + n)))
        return _let(firsts, lambda places: F.flatten(F.transform(_chunks(items), lambda c: F.aggregate(
            _chunk(items, c), F.struct(F.get(places, c).alias("at"), nothing.alias("spans")), add, lambda state: state["spans"]))))

    return F.when(body.rlike(pattern), _let(met, spans)).otherwise(nothing)


def base_spans(body: Column) -> Column:
    """Spans of the kinds that are findings by themselves, by start and then in the order of ``BASE``."""
    found = [
        _all_spans(body, ASSIGN, "assign", lambda x: F.char_length(x["inner"]) >= LEAST["assign"]),
        _all_spans(body, ACCESS, "access", lambda x: F.char_length(x["match"]) >= LEAST["access"]),
        _all_spans(body, HEX[:-1] + f"{{{LEAST['hex']},}}", "hex"),  # a shorter run can hold no longer one
    ]
    return F.array_sort(F.concat(*found))


def weak_spans(body: Column) -> Column:
    """Candidates that need company; a 40-letter string must mix capital and small letters and digits, and a host name with
    an empty label is none."""
    return F.concat(
        _all_spans(body, SECRET, "secret", lambda x: _mixed(x["match"])),
        _all_spans(body, ENDPOINT, "endpoint", lambda x: ~x["match"].rlike(EMPTY_LABEL)),
        _all_spans(body, IDENTIFIER, "identifier"))


def _mixed(word: Column) -> Column:
    return word.rlike("[A-Z]") & word.rlike("[a-z]") & word.rlike("[0-9]")


def _linked(spans: DataFrame, scope: int) -> DataFrame:
    """Weak spans that stand within the scope of what they lack, a row each.

    Both sides are cut into bins of the scope's length, so a span meets only what is near it. Spans of a kind do not
    overlap and have a least length, which bounds what a bin of one text can hold."""
    key = ["id", "body_hash"]
    part = spans.where(F.size("weak") > 0).select(*key, F.explode(F.concat("base", "weak")).alias("s")).distinct()
    part = part.select(*key, "s.*").where("kind <> 'hex'")
    bins = lambda low, high: F.explode(F.sequence(F.floor(low / scope), F.floor(high / scope)))
    weak = part.where(F.col("kind").isin(*WEAK)).withColumn(
        "bin", bins(F.greatest(F.col("start") - scope, F.lit(0)), F.col("end") + scope))
    near = part.withColumn("bin", bins(F.col("start"), F.col("end"))).select(
        F.col("id").alias("other_id"), F.col("body_hash").alias("other_hash"), F.col("bin").alias("other_bin"),
        F.col("start").alias("other_start"), F.col("end").alias("other_end"), F.col("kind").alias("other"))
    met = weak.join(
        near, weak["id"].eqNullSafe(near["other_id"]) & (weak["body_hash"] == near["other_hash"])
        & (weak["bin"] == near["other_bin"]) & (near["other_start"] <= weak["end"] + scope)
        & (near["other_end"] >= weak["start"] - scope))
    names = F.max(F.col("other").isin("access", "identifier")).alias("named")
    opens = F.max(F.col("other").isin("assign", "secret")).alias("opened")
    together = met.groupBy(*key, "start", "rank", "end", "kind").agg(names, opens)
    complete = (
        (F.col("kind").isin("secret", "endpoint") & F.col("named") | (F.col("kind") == "identifier"))
        & (F.col("kind").isin("identifier", "endpoint") & F.col("opened") | (F.col("kind") == "secret"))
    )
    return together.where(complete)


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", scope: int = SCOPE) -> DataFrame:
    """``id_column``, ``body_hash`` (xxhash64 of the text), ``base`` and ``spans`` for each row of ``docs``; arrays of
    (start, rank, end, kind) by start and then kind.

    ``base`` has assignments, access identifiers and long hexadecimal runs. ``spans`` adds weak candidates: a lone
    secret beside an identifier, an identifier beside a secret, an endpoint beside both. Null and empty texts have no
    span, repeated rows stay and are scanned alike, other columns are left out. Runs on column functions alone."""
    body = F.coalesce(F.col(text_column), F.lit(""))
    scanned = stored(docs.select(
        F.col(id_column).alias("id"), F.xxhash64(body).alias("body_hash"), base_spans(body).alias("base"),
        weak_spans(body).alias("weak")), "spans")
    more = _linked(scanned, scope).groupBy(F.col("id").alias("more_id"), F.col("body_hash").alias("more_hash")).agg(
        F.collect_list(F.struct("start", "rank", "end", "kind")).cast(SPAN).alias("more"))
    both = scanned.join(more, scanned["id"].eqNullSafe(more["more_id"]) & (scanned["body_hash"] == more["more_hash"]), "left")
    return both.select(
        F.col("id").alias(id_column), "body_hash", "base",
        F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(SPAN)))).alias("spans"))


def span_list(spans: str) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redact(docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text_column: str = "text",
           mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with ``mark`` in place of every span of ``find_secrets``; overlapping spans get one. All columns and
    rows stay; texts without a span are not touched."""
    spans, other_id, other_hash = (fresh(docs, name) for name in ("spans", "span_id", "span_hash"))
    some = found.where(F.size("spans") > 0).select(
        F.col(id_column).alias(other_id), F.col("body_hash").alias(other_hash), F.col("spans").alias(spans)
    ).dropDuplicates([other_id, other_hash])
    body = F.coalesce(F.col(text_column), F.lit(""))

    def marked(piece: Column, from_place: Column, some_spans: Column) -> Column:
        def step(state: Column, s: Column) -> Column:
            gap = F.substring(piece, (state["at"] - from_place + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
            out = F.when(s["start"] >= state["at"], F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
            return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

        return F.aggregate(some_spans, F.struct(from_place.alias("at"), F.lit("").alias("out")), step, lambda state: state["out"])

    def cut(place: Column, end: Column) -> Column:
        return F.substring(body, (place + 1).cast("int"), (end - place).cast("int"))

    # each chunk of spans works on its own piece of the text, from the furthest end before it to its own
    items = F.col(spans)
    ends = F.transform(_chunks(items), lambda c: F.array_max(F.transform(_chunk(items, c), lambda s: s["end"])))
    places = F.aggregate(
        ends, F.array(F.lit(0).cast("bigint")), lambda known, end: F.concat(known, F.array(F.greatest(F.element_at(known, -1), end))))
    clean = _let(places, lambda at: F.concat(
        F.array_join(F.transform(_chunks(items), lambda c: _let(
            cut(F.get(at, c), F.get(at, c + 1)), lambda piece: marked(piece, F.get(at, c), _chunk(items, c)))), ""),
        cut(F.element_at(at, -1), F.char_length(body).cast("bigint"))))
    joined = docs.join(some, docs[id_column].eqNullSafe(some[other_id]) & (F.xxhash64(body) == some[other_hash]), "left")
    changed = joined.withColumn(text_column, F.when(F.col(spans).isNotNull(), clean).otherwise(F.col(text_column)))
    return changed.select(*docs.columns)
