"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered whole, ``<|im_start|>role<|im_sep|>text<|im_end|>`` turn by turn. Inside roles and texts every
``<|`` is written ``<||``, so no control string can stand there, and reading ``<||`` as ``<|`` gives the text back. The
rendered string is encoded once with offsets; the spans of the turns that bear loss and the spans of the tokens are both
sorted, and binary search finds the tokens of each turn.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableprep.llm.batches import lists, raw, text

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROLS = (START, SEPARATOR, END)


def escape(string: str) -> str:
    return string.replace("<|", "<||")


def unescape(string: str) -> str:
    return string.replace("<||", "<|")


def escaped(column: Column) -> Column:
    return F.replace(F.make_valid_utf8(F.coalesce(column, F.lit(""))), F.lit("<|"), F.lit("<||"))


def render(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
           text_column: str = "text") -> DataFrame:
    """``conversation``, ``formatted``, and ``pieces`` (code points of each turn's role and text as written), a row for
    each conversation.

    Turns stand by ``turn``, nulls first, equal ones by role and text; repeated rows stay. Null roles and texts count
    as empty, malformed UTF-8 as U+FFFD, a null conversation id is an id. Turns are rendered before the shuffle; a conversation is one row of the
    result, so its turns have to meet."""
    said = conversations.select(
        F.col(conversation).alias("id"), F.col(turn).alias("turn"), escaped(F.col(role)).alias("role"),
        escaped(F.col(text_column)).alias("body"))
    turns = said.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "body"))).alias("turns"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(
        F.lit(START), t["role"], F.lit(SEPARATOR), t["body"], F.lit(END))), "")
    sizes = F.transform("turns", lambda t: F.struct(
        F.char_length(t["role"]).alias("role"), F.char_length(t["body"]).alias("body"), t["role"].alias("name")))
    return turns.select(F.col("id").alias(conversation), whole.alias("formatted"), sizes.alias("pieces"))


def turn_spans(role_sizes: np.ndarray, body_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each turn's text begins and ends in the rendered string."""
    before = len(START) + role_sizes + len(SEPARATOR)
    whole = before + body_sizes + len(END)
    start = np.cumsum(whole) - whole + before
    return start, start + body_sizes


def mask_of(starts: np.ndarray, ends: np.ndarray, span_starts: np.ndarray, span_ends: np.ndarray) -> np.ndarray:
    """1 for each token that lies in one of the spans. Both are sorted and do not overlap; empty tokens are outside."""
    mask = np.zeros(len(starts) + 1, dtype=np.int32)
    first = np.searchsorted(starts, span_starts, side="left")
    last = np.searchsorted(ends, span_ends, side="right")
    full = last > first
    np.add.at(mask, first[full], 1)
    np.add.at(mask, last[full], -1)
    return (np.cumsum(mask[:-1]) > 0).astype(np.int8)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(control, special=True, normalized=False) for control in CONTROLS])
    return tokenizer


def tokenise(rendered: DataFrame, tokenizer_path: str, conversation: str = "conv_id",
             loss_role: str = "assistant") -> DataFrame:
    """Adds ``token_ids``, ``starts`` and ``ends`` (code points), and ``mask`` (1: the token bears loss) to ``render``'s
    ``conversation`` and ``formatted``. Control strings are tokens of their own, so no token crosses a turn's border;
    bytes of one character that fall into several tokens share its offsets."""
    schema = T.StructType([
        rendered.schema[conversation], T.StructField("formatted", T.StringType()),
        *[T.StructField(n, T.ArrayType(T.IntegerType(), False)) for n in ("token_ids", "starts", "ends")],
        T.StructField("mask", T.ArrayType(T.ByteType(), False)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        for whole in batches:
            for first in range(0, whole.num_rows, 64):
                batch = whole.slice(first, 64)
                found = tokenizer.encode_batch([text(x) for x in raw(batch.column("formatted"))], add_special_tokens=False)
                columns: tuple[list, ...] = ([], [], [], [])
                for encoded, pieces in zip(found, batch.column("pieces"), strict=True):
                    offsets = np.array(encoded.offsets, dtype=np.int32).reshape(-1, 2)
                    sizes = pieces.values
                    start, end = turn_spans(sizes.field("role").to_numpy().astype(np.int64), sizes.field("body").to_numpy().astype(np.int64))
                    bears = np.array([name == loss_role for name in sizes.field("name").to_pylist()], dtype=bool)
                    mask = mask_of(offsets[:, 0], offsets[:, 1], start[bears], end[bears])
                    for column, values in zip(columns, (np.array(encoded.ids, dtype=np.int32), offsets[:, 0], offsets[:, 1], mask), strict=True):
                        column.append(values)
                arrays = [lists(np.concatenate(c), [len(x) for x in c]) for c in columns]
                yield pa.RecordBatch.from_arrays([batch.column(conversation), batch.column("formatted"), *arrays], names=schema.names)

    return rendered.select(conversation, "formatted", "pieces").mapInArrow(run, schema)


def read_back(tokenised: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """``conversation``, ``formatted``, ``turns`` (array of role and text, unescaped) and ``loss_text`` (all that the
    masked tokens cover, unescaped), parsed from the rendered string and the mask."""
    kind = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
    schema = T.StructType([
        tokenised.schema[conversation], T.StructField("formatted", T.StringType()), T.StructField("turns", kind),
        T.StructField("loss_text", T.StringType()),
    ])
    arrow = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, loss = [], []
            masks = [batch.column(name) for name in ("starts", "ends", "mask")]
            for row, data in enumerate(raw(batch.column("formatted"))):
                string = text(data)
                parts = [part.split(SEPARATOR) for part in string.removesuffix(END).removeprefix(START).split(END + START)]
                turns.append([{"role": unescape(role), "text": unescape(body)} for role, body in parts])
                starts, ends, mask = (column[row].values.to_numpy() for column in masks)
                # tokens of one run share borders; bytes of one character share its offsets
                at = np.flatnonzero(mask)
                begins = at[np.diff(at, prepend=-2) > 1]
                stops = at[np.diff(at, append=len(mask) + 1) > 1]
                pieces = [string[starts[a]:ends[b]] for a, b in zip(begins, stops, strict=True)]
                loss.append("".join(map(unescape, pieces)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(conversation), batch.column("formatted"), pa.array(turns, arrow), pa.array(loss, pa.string())],
                names=schema.names)

    return tokenised.select(conversation, "formatted", "starts", "ends", "mask").mapInArrow(run, schema)
