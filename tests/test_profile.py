import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st, HealthCheck
from pyspark.sql import functions as F

from tableprep.functions.fixed import bucket_label
from tableprep.operators import profile
from tests.test_reconcile import rows

TEXTS = ["", "-12.5", "2020-01-02T03:04:05Z", "café", "€", "\t", "a\nb", None, "--", "x-y", "日本語 12", "🙂-"]


@pytest.fixture()
def texts(spark):
    return spark.createDataFrame([(i % 3 or None, t) for i, t in enumerate(TEXTS)], "g int, t string").repartition(3)


def test_histogram(texts):
    counts = Counter(min(ord(c), 256) for t in TEXTS if t for c in t)
    assert {r.bucket: r.n for r in profile.char_histogram(texts, "t").collect()} == counts


def test_grouped_histogram_with_labels_and_mask(texts):
    expected = Counter(
        (i % 3 or None, min(ord(c), 256)) for i, t in enumerate(TEXTS) if t for c in t if c in "-1" or ord(c) > 255
    )
    got = profile.char_histogram(texts, "t", ["g"], include=[ord("-"), ord("1")]).collect()
    assert {(r.g, r.bucket): r.n for r in got} == expected
    assert {r.bucket: r.label for r in got} == {45: "  -", 49: "  1", 256: "2Hi"}


def totals(texts):
    text = [t for t in texts if t is not None]
    everything = "".join(text)

    def count(pattern):
        return len(re.findall(pattern, everything))

    lead = sum(t.startswith("-") for t in text)
    letters = sum(c.isalpha() for c in everything)
    return {
        "non_digit": count("[^0-9]"), "letter": letters, "digit": count("[0-9]"),
        "typeable_other": count("[ -~]") - count("[0-9A-Za-z]"),
        "non_typeable": sum(not (c.isalpha() or " " <= c <= "~") for c in everything),
        "not_number": count("[ -~]") - count("[0-9.]") - lead,
        "not_date": count("[ -~]") - count("[-0-9/:. TZ]") + lead,
        "leading": lead, "non_leading": count("-") - lead,
    }


def test_class_totals(texts):
    assert profile.char_class_totals(texts, "t").first().asDict() == totals(TEXTS)


def test_class_totals_by_two_columns(texts):
    twice = texts.withColumn("h", F.col("t").startswith("-"))
    got = {(r.g, r.h): r.leading for r in profile.char_class_totals(twice, "t", ["g", "h"]).collect()}
    assert got[(1, True)] == 1 and got[(2, True)] == 1 and got[(None, False)] == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(st.characters(codec="utf-8"), max_size=30)), min_size=1, max_size=20))
def test_histogram_of_anything(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "t string")
    counts = Counter(ord(c) for v in values if v for c in v)
    assert {r.code_point: r.n for r in profile.character_counts(frame, "t").collect()} == counts


def test_many_rows_per_step(spark):
    frame = spark.range(2000).select((F.col("id") % 2).alias("g"), F.lit("ab").alias("t"))
    got = profile.character_counts(frame, "t", ["g"]).collect()
    assert {(r.g, r.code_point): r.n for r in got} == {(g, c): 1000 for g in (0, 1) for c in (97, 98)}


def test_texts_longer_than_a_step(spark):
    frame = spark.range(5).select(
        "id", F.concat(F.lit("é"), F.repeat(F.lit("ab€"), 500_000), F.lit("-")).alias("t")
    ).repartition(1)
    got = {(r.id, r.code_point): r.n for r in profile.character_counts(frame, "t", ["id"]).collect()}
    one = {ord("é"): 1, ord("a"): 500_000, ord("b"): 500_000, ord("€"): 500_000, ord("-"): 1}
    assert got == {(i, c): n for i in range(5) for c, n in one.items()}


def test_no_text_at_all(spark):
    assert profile.char_histogram(spark.createDataFrame([], "t string"), "t").count() == 0
    assert profile.char_class_totals(spark.createDataFrame([(None,)], "t string"), "t").first().letter == 0


def test_labels():
    assert [bucket_label(b) for b in (0, 9, 32, 65, 128, 129, 161, 255, 256, 257, 265)] == [
        "nul", "tab", " sp", "  A", "  €", "   ", "  ¡", "  ÿ", "2Hi", "Ndg", "NL-"
    ]
    assert all(len(bucket_label(b)) == 3 for b in range(266))


def test_hyphens(spark):
    frame = spark.createDataFrame([("-a-b",), ("a",), (" -",), (None,)], "t string")
    got = {(r.t, r.leading, r.non_leading) for r in profile.hyphen_position(frame, "t").collect()}
    assert got == {("-a-b", 1, 1), ("a", 0, 0), (" -", 0, 1), (None, 0, None)}


def test_value_counts(spark):
    frame = spark.createDataFrame([("a",), (None,), (None,), ("9",)], "c string")
    assert rows(profile.value_counts(frame, "c")) == [("9", 3), ("a", 1)]
    assert rows(profile.row_count(frame)) == [(4,)]


def test_class_totals_of_groups_without_text(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (2, "-a1"), (2, None), (None, None), (3, "")], "g int, t string")
    got = {r.g: r.asDict() for r in profile.char_class_totals(frame, "t", ["g"]).collect()}
    assert set(got) == {1, 2, 3, None} and got[2] == {"g": 2, **totals(["-a1"])} and got[3] == {"g": 3, **totals([""])}
    for g in (1, None):
        assert {k for k, v in got[g].items() if v is not None} - {"g"} == {"leading"} and got[g]["leading"] == 0
