"""Byte-level BPE: merges compiled into a lazily determinised transducer, and decoding as a stream.

The greedy merges of BPE have a local test: a row of tokens is the encoding of its bytes exactly when every two
neighbours, encoded together, stay those two tokens. So the last token before each position follows from the bytes up to
there, and an encoder can read bytes from left to right. It keeps the positions from which a longer token may still
come (the bounded lookahead: no token is longer than the longest one of the vocabulary). As soon as all of them agree on
how the text began, those tokens are emitted. States and steps are built when first met and dropped when too many.
"""

from __future__ import annotations

import base64
import gc
import re
import struct
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from tableprep.llm.batches import lists, raw, slices, text

MOST_STATES = 200_000
MOST_PIECES = 300_000
LONGEST_KEPT = 48
RUN_SHIFT = 32
STATE_MASK = (1 << RUN_SHIFT) - 1


def read_ranks(path: str) -> bytes:
    """The vocabulary file as it is: base64 of a token, a blank and its rank in each line."""
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(vocabulary: bytes) -> dict[bytes, int]:
    pairs = (line.split() for line in vocabulary.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge_greedily(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE by its definition: join the neighbours of lowest rank, the leftmost first. For short strings only."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        found = [(ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        best = min((pair for pair in found if pair[0] is not None), default=None)
        if best is None:
            break
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[part] for part in parts]


class Transducer:
    """Bytes to token ranks, in one pass from left to right.

    A state is a number, and what it stands for is packed, as there are very many and most are met once. ``keys``: the
    token to its left (from 1; 0: none, or it does not matter) in four bytes, and the bytes read since. ``live``: for
    each position from which a token may still grow, the node that the bytes since then lead to, how many tokens come
    before, and these; the position read so far comes first, without its node. ``steps`` has the step met for a state
    and byte: the next state in its low bits, above them the place among ``runs`` of the tokens to emit."""

    def __init__(self, ranks: dict[bytes, int], most_states: int = MOST_STATES):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._plant()
        self.agrees: dict[int, bool] = {}
        self.made_of: dict[int, tuple[int, int] | None] = {}
        self.most_states = most_states
        self.states: dict[bytes, int] = {}
        self.keys: list[bytes] = []
        self.live: list[bytes] = []
        self.steps: dict[int, int] = {}
        self.run_of: dict[tuple, int] = {}
        self.runs: list[tuple] = []
        self._forget()

    def _plant(self) -> None:
        """The vocabulary as a tree: ``child`` by node and byte, the token that ends at a node, and whether one goes on."""
        self.child: dict[int, int] = {}
        self.ending: list[int | None] = [None]
        self.growing = [False]
        for token, rank in self.ranks.items():
            node = 0
            for byte in token:
                self.growing[node] = True
                following = self.child.setdefault(node << 8 | byte, len(self.ending))
                if following == len(self.ending):
                    self.ending.append(None)
                    self.growing.append(False)
                node = following
            self.ending[node] = rank

    def _forget(self) -> None:
        for known in (self.states, self.keys, self.live, self.steps, self.run_of, self.runs):
            known.clear()
        self.run_of[()] = 0
        self.runs.append(())
        self._add(bytes(4), [0])

    def _add(self, key: bytes, live: list[int]) -> int:
        number = self.states[key] = len(self.keys)
        self.keys.append(key)
        self.live.append(array("i", live).tobytes())
        return number

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The last merge that makes ``token``; None for a single byte."""
        if token not in self.made_of:
            data = self.tokens[token]
            below = {part: rank for part, rank in self.ranks_within(data) if rank < token}
            self.made_of[token] = tuple(merge_greedily(data, below)) if len(data) > 1 else None
        return self.made_of[token]

    def ranks_within(self, data: bytes) -> Iterator[tuple[bytes, int]]:
        for i in range(len(data)):
            for j in range(i + 1, len(data) + 1):
                if (rank := self.ranks.get(data[i:j])) is not None:
                    yield data[i:j], rank

    def _neighbours(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart. Their merges are undone, the latest first; a merge across the border that
        would have come before the one just undone would have taken its place."""
        pair = left << 32 | right
        known = self.agrees.get(pair)
        if known is not None:
            return known
        if len(self.agrees) > self.most_states:
            self.agrees.clear()
        a, b, before, apart = left, right, float("inf"), True
        while True:
            across = self.ranks.get(self.tokens[a] + self.tokens[b])
            if across is not None and across < before:
                apart = False
                break
            halves_a, halves_b = self._halves(a), self._halves(b)
            if halves_a and (a > b or not halves_b):
                a, before = halves_a[1], a
            elif halves_b:  # of equal ranks the left one merges first
                b, before = halves_b[0], b + 1
            else:
                break
        self.agrees[pair] = apart
        return apart

    def _entries(self, state: int) -> list[tuple[int, list[int]]]:
        flat = memoryview(self.live[state]).cast("i").tolist()
        at = 1 + flat[0]
        found, last = [], (0, flat[1:at])
        while at < len(flat):
            end = at + 2 + flat[at + 1]
            found.append((flat[at], flat[at + 2:end]))
            at = end
        found.append(last)
        return found

    def _step(self, state: int, byte: int) -> int:
        child, ending, growing = self.child, self.ending, self.growing
        key = self.keys[state]
        own = int.from_bytes(key[:4], "little") - 1
        live, path = [], None
        for place, before in self._entries(state):
            node = child.get(place << 8 | byte)
            if node is None:
                continue
            if path is None and (token := ending[node]) is not None:
                left = before[-1] if before else own
                if left < 0 or self._neighbours(left, token):
                    path = [*before, token]
            if growing[node]:
                live.append((node, before))
        common = len(path)
        for _, other in live:
            common = min(common, len(other))
            while path[:common] != other[:common]:
                common -= 1
        emitted = tuple(path[:common])
        pending = key[4:] + bytes((byte,))
        if emitted:
            pending = pending[sum([len(self.tokens[token]) for token in emitted]):]
            own = emitted[-1]
        # what stands to the left matters only where the next token may begin right behind it
        matters = len(path) == common or any([len(other) == common for _, other in live])
        key = (own + 1 if matters else 0).to_bytes(4, "little") + pending
        following, forgotten = self.states.get(key), False
        if following is None:
            forgotten = len(self.states) >= self.most_states
            if forgotten:
                self._forget()
            flat = [len(path) - common, *path[common:]]
            for node, other in live:
                flat += (node, len(other) - common, *other[common:])
            following = self._add(key, flat)
        run = self.run_of.setdefault(emitted, len(self.runs))
        if run == len(self.runs):
            self.runs.append(emitted)
        step = run << RUN_SHIFT | following
        if not forgotten:  # else there is no such state any more
            self.steps[state << 8 | byte] = step
        return step

    def encode(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        state, out, known = 0, [], self.steps.get
        for byte in data:
            step = known(state << 8 | byte)
            if step is None:
                step = self._step(state, byte)
            state = step & STATE_MASK
            if step != state:
                out += self.runs[step >> RUN_SHIFT]
        tail = memoryview(self.live[state]).cast("i")
        return out + tail[1:1 + tail[0]].tolist()


class _Pieces(dict):
    """Packed ids of pieces met before. When full, it becomes the older half and starts anew; what is asked for again
    comes back from there, so that common pieces are never lost."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.encode, self.older = transducer.encode, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids = self.encode(piece.encode())
            packed = struct.pack(f"<{len(ids)}i", *ids)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= MOST_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


LATIN_END = 0x250


def latin_pattern(pattern: str) -> str:
    """``pattern`` for Python's own, faster ``re``: its letter, number and white space classes spelled out. Both find
    the same in texts without code points from ``LATIN_END`` on."""

    def members(kind: str) -> str:
        return "".join(rf"\u{c:04x}" for c in range(LATIN_END) if unicodedata.category(chr(c))[0] == kind)

    classes = {r"\p{L}": members("L"), r"\p{N}": members("N"), r"\s": r"\t-\r \x85\xa0"}
    out, inside = [], False
    for part in re.findall(r"\\p\{[LN]\}|\\[sS]|\\.|.", pattern, re.DOTALL):
        if part in classes:
            part = classes[part] if inside else f"[{classes[part]}]"
        elif part == r"\S":
            part = f"[^{classes[chr(92) + 's']}]"
        inside = part == "[" or inside and part != "]"
        out.append(part)
    return "".join(out)


@lru_cache(maxsize=4)
def cutter(pattern: str) -> Callable[[str], list[str]]:
    """Text to the list of its matches."""
    anywhere = regex.compile(pattern).findall
    if re.search(r"\\p\{(?![LN]\})|\\[PdDwWbB]", pattern):
        return anywhere
    latin, beyond = re.compile(latin_pattern(pattern)).findall, re.compile(rf"[^\0-\u{LATIN_END - 1:04x}]").search
    return lambda string: anywhere(string) if beyond(string) else latin(string)


@lru_cache(maxsize=2)
def _pieces(vocabulary: bytes) -> _Pieces:
    # the states are many small objects that stay: looking through them for garbage often is wasted time
    gc.set_threshold(200_000, 20, 50)
    return _Pieces(Transducer(parse_ranks(vocabulary)))


def _tail_range(lead: int, second: bool) -> tuple[int, int]:
    """Bytes that may follow in a well-formed UTF-8 sequence."""
    if second:
        narrow = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}
        return narrow.get(lead, (0x80, 0xBF))
    return 0x80, 0xBF


def _length(lead: int) -> int:
    """Length of the sequence that a byte begins; 0 where none can."""
    return 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0


def utf8_step(pending: bytes, byte: int) -> tuple[bytes, bytes, int]:
    """The state is the unfinished sequence. Gives the next state, what is finished now, and how many ill-formed
    sequences ended here; their bytes pass unchanged."""
    if pending:
        low, high = _tail_range(pending[0], len(pending) == 1)
        if low <= byte <= high:
            pending += bytes((byte,))
            return (b"", pending, 0) if len(pending) == _length(pending[0]) else (pending, b"", 0)
        following, done, bad = utf8_step(b"", byte)
        return following, pending + done, bad + 1
    one, length = bytes((byte,)), _length(byte)
    return (b"", one, int(length == 0)) if length < 2 else (one, b"", 0)


def _well_formed(data: bytes) -> bool:
    try:
        data.decode()
    except UnicodeDecodeError:
        return False
    return True


class StreamDecoder:
    """Token ids to bytes that end at whole characters; feed it any part of a stream at a time.

    The steps of the byte machine are composed to steps for whole tokens as these are met."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self.states: dict[bytes, dict] = {b"": {}}
        # steps that lead from the first state back to it, and for which tokens there is none
        closed = [token for token, data in tokens.items() if _well_formed(data)]
        every = [tokens.get(token) for token in range(max(tokens, default=-1) + 1)]
        self.open = np.ones(len(every), dtype=bool)
        self.open[closed] = False
        self.table = pa.array(every, pa.large_binary())
        self.reset()

    def reset(self) -> None:
        self.pending, self.bad = b"", 0

    def _compose(self, pending: bytes, token: int) -> tuple[bytes, bytes, int]:
        out, bad, state = [], 0, pending
        for byte in self.tokens[token]:
            state, done, wrong = utf8_step(state, byte)
            out.append(done)
            bad += wrong
        step = (state, b"".join(out), bad)
        if len(self.states) > 4096:
            self.states = {b"": {}}
        self.states.setdefault(state, {})
        self.states.setdefault(pending, {})[token] = step
        return step

    def feed(self, ids: np.ndarray) -> bytes:
        """Tokens that keep the machine in its first state are looked up, all in one call, and taken in runs; the others
        are stepped through."""
        data, begins = self._look_up(ids)
        stops = np.append(np.flatnonzero(self.open[ids]), len(ids))
        out, at = [], 0
        if self.pending:
            at = self._walk(ids, 0, out)
        for stop, begin in zip(stops.tolist(), begins[stops].tolist(), strict=True):
            if stop < at:
                continue
            out.append(data[begins[at]:begin])
            at = self._walk(ids, stop, out)
        return b"".join(out)

    def _look_up(self, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The bytes of ``ids`` in a row, and where each begins."""
        found = self.table.take(pa.array(ids))
        _, ends, data = found.buffers()
        return memoryview(data or b""), np.frombuffer(ends, dtype=np.int64)[found.offset:]

    def _walk(self, ids: np.ndarray, at: int, out: list) -> int:
        """Steps on from ``at`` until the machine is in its first state again; gives the place behind."""
        state = self.pending
        while at < len(ids):
            token = int(ids[at])
            state, done, wrong = self.states.setdefault(state, {}).get(token) or self._compose(state, token)
            out.append(done)
            self.bad += wrong
            at += 1
            if not state:
                break
        self.pending = state
        return at

    def finish(self) -> bytes:
        """What an unfinished sequence at the end holds; it counts as ill-formed."""
        rest, self.pending = self.pending, b""
        self.bad += bool(rest)
        return rest


@lru_cache(maxsize=2)
def _decoder(vocabulary: bytes) -> StreamDecoder:
    return StreamDecoder({rank: token for token, rank in parse_ranks(vocabulary).items()})


def _decode_all(decoder: StreamDecoder, columns: list[np.ndarray]) -> list[pa.Array]:
    """``decoded`` and ``ill_formed`` for each array of ids."""
    decoded, bad = [], []
    for ids in columns:
        decoder.reset()
        decoded.append(decoder.feed(ids) + decoder.finish())
        bad.append(decoder.bad)
    return [pa.array(decoded, pa.binary()), pa.array(bad, pa.int32())]


_DECODED = [T.StructField("decoded", T.BinaryType()), T.StructField("ill_formed", T.IntegerType())]


def encode_bpe(docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text",
               decoded: bool = False) -> DataFrame:
    """``id_column`` and ``token_ids`` (array of int), a row for each row of ``docs``.

    Each match of ``pattern`` is encoded by itself. A null or empty text gives an empty array, repeated rows stay, other
    columns are left out, and malformed bytes count as U+FFFD. ``decoded`` adds what ``decode_bpe`` would make of the
    ids, in the same pass. Narrow: nothing is shuffled. A task holds the vocabulary, at most ``MOST_STATES`` states and
    twice ``MOST_PIECES`` pieces, and a few MB of text at a time."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    fields = [docs.schema[id_column], T.StructField("token_ids", T.ArrayType(T.IntegerType(), False))]
    schema = T.StructType(fields + _DECODED if decoded else fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, cut = _pieces(vocabulary.value), cutter(pattern)
        for batch in slices(batches, text_column):
            packed = [b"".join(map(pieces.__getitem__, cut(text(data)))) for data in raw(batch.column(text_column))]
            ids = lists(np.frombuffer(b"".join(packed), dtype=np.int32), [len(one) // 4 for one in packed])
            arrays = [batch.column(id_column), ids]
            if decoded:
                arrays += _decode_all(_decoder(vocabulary.value), [np.frombuffer(one, dtype=np.int32) for one in packed])
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(id_column, text_column).mapInArrow(run, schema)


def decode_bpe(encoded: DataFrame, ranks_path: str, id_column: str = "doc_id") -> DataFrame:
    """Adds ``decoded`` (binary) and ``ill_formed`` (count of sequences that are not UTF-8) to the columns of
    ``encode_bpe``. A null array decodes to nothing; an id outside the vocabulary is an error."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept = encoded.select(id_column, "token_ids")
    schema = T.StructType([*kept.schema, *_DECODED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(0, dtype=np.int32)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                ids = [x.values.to_numpy() if x.is_valid else nothing for x in batch.column("token_ids")]
                arrays = [*batch.columns, *_decode_all(_decoder(vocabulary.value), ids)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return kept.mapInArrow(run, schema)
