"""Masks of chats whose texts are malformed, long or beside columns of clashing names."""

import public_tokenizers
from pyspark.sql import functions as F

from tableprep.llm.chat import read_back, render, tokenise
from tableprep.llm.queries import BYTE_BPE_OFFSETS


def test_malformed_bytes_do_not_move_the_mask(spark):
    rows = [(1, 0, "user", bytearray(b"a\xff\xc3\xffb")), (1, 1, "assistant", bytearray(b"hello world")), (1, 2, "user", bytearray(b"\xe2\x82")),
            (1, 3, "assistant", bytearray(b"x\xf0\x9fy")), (2, 0, "assistant", bytearray("é€😀 ".encode() * 20_000))]
    said = spark.createDataFrame([(*r, "t", [1]) for r in rows], "conv_id int, turn int, role string, text binary, formatted string, pieces array<int>")
    done = read_back(tokenise(render(said.withColumn("text", F.col("text").cast("string"))), public_tokenizers.path(BYTE_BPE_OFFSETS)))
    found = {r.conv_id: r for r in done.collect()}
    assert found[1].loss_text == "hello world" + found[1].turns[3].text and found[1].turns[3].text.startswith("x�")
    assert found[1].turns[0].text.replace("�", "") == "ab" and found[2].loss_text == "é€😀 " * 20_000
