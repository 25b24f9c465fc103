"""Conversation repair, collocations and the compression classifier against brute force, held-out rows and odd input."""

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableprep.llm import collocations, quality, repair
from tableprep.llm.queries import ORACLES, QUERIES
from tests.compare import duck, mismatch

SF_DIR = "/root/testdata/sf0.001"


def cheapest_by_search(turns):
    """Every edit script in order of cost and letters, until one leaves legal roles."""
    queue = [(0, "", 0, "")]
    while queue:
        cost, audit, place, roles = heapq.heappop(queue)
        if place == len(turns) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit
        if cost > 2 * len(turns):
            continue
        for role in "ua":
            heapq.heappush(queue, (cost + 5, audit + "I", place, roles + role))
        if place < len(turns):
            initial, must_go, unfinished = turns[place]
            heapq.heappush(queue, (cost + 2, audit + "D", place + 1, roles))
            if not must_go:
                more = 5 * unfinished
                heapq.heappush(queue, (cost + more, audit + "K", place + 1, roles + (initial or "-")))
                for role in "ua":
                    heapq.heappush(queue, (cost + 1 + more, audit + "R", place + 1, roles + role))


def test_edits_are_the_cheapest():
    rng = np.random.default_rng(5)
    for length in list(range(6)) * 40:
        turns = [repair.Turn(rng.choice(["s", "u", "a", "u", "a", "x", ""]), rng.random() < 0.2, rng.random() < 0.2) for _ in range(length)]
        assert repair.cheapest_edits(turns) == cheapest_by_search(turns)


def cheapest_by_table(turns):
    """Least cost and letters for each state, turn by turn; insertions stand before what they precede."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    due = {"": "u", "s": "u", "u": "a", "a": "u"}

    def settled(best):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                best[due[state]] = min(best.get(due[state], (10 ** 9, "")), (cost + 5, audit + "I"))
        return best

    best = settled({"": (0, "")})
    for initial, must_go, unfinished in turns:
        after = {}
        for state, (cost, audit) in best.items():
            ways = [(state, 2, "D")]
            if not must_go:
                ways.append((due[state], 1 + 5 * unfinished, "R"))
                if (state, initial) in step:
                    ways.append((step[state, initial], 5 * unfinished, "K"))
            for to, more, letter in ways:
                after[to] = min(after.get(to, (10 ** 9, "")), (cost + more, audit + letter))
        best = settled(after)
    return min(best.get(state, (10 ** 9, "")) for state in ("", "a"))


def test_longer_conversations_and_very_long_ones():
    rng = np.random.default_rng(6)
    for length in [12, 25, 60] * 20:
        turns = [repair.Turn(rng.choice(["s", "u", "a", "u", "a", "x"]), rng.random() < 0.1, rng.random() < 0.1) for _ in range(length)]
        assert repair.cheapest_edits(turns) == cheapest_by_table(turns)
    turns = [repair.Turn(rng.choice(["s", "u", "a"]), rng.random() < 0.1, rng.random() < 0.1) for _ in range(20_000)]
    cost, audit = repair.cheapest_edits(turns)
    assert len(audit) - audit.count("I") == len(turns) and cost <= 2 * len(turns)
    assert cost == sum({"K": 0, "R": 1, "D": 2, "I": 5}[e] for e in audit) + 5 * sum(
        t.unfinished for t, e in zip(turns, audit.replace("I", ""), strict=True) if e in "KR")


def repaired_by_hand(rows):
    """The answer of the query for (conv_id, turn, role, text) rows, in plain Python."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        group = groups[conv]
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        group += [(turn is not None, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    for conv, group in groups.items():
        group.sort(key=lambda r: (r[0], r[1] or 0, r[2].encode(), r[3].encode()))
        known = {r[1] for r in group if r[0]}
        judged, seen, counts = [], set(), Counter()
        for _, _, role, text in group:
            last = re.search(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z", text)
            fault = "blank" if last is None else "duplicate" if (role, text) in seen else "truncated" if last[1] not in ".!?" else None
            counts[fault] += 1
            judged.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
            seen.add((role, text))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit = cheapest_by_table(judged)
        out, place = [], 0
        for edit in audit:
            due = "assistant" if out and out[-1][0][:1] == "u" else "user"
            if edit == "K":
                out.append(group[place][2:])
            elif edit in "IR":
                out.append((due, "" if edit == "I" else group[place][3]))
            place += edit != "I"
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        yield (conv, max(known) - min(known) + 1 - len(known) if known else 0, counts["blank"], counts["duplicate"],
               counts["truncated"], illegal, cost, audit, digest)


def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = [tuple(r) for r in QUERIES["op11_conversation_repair"](spark, SF_DIR).collect()]
    assert sorted(found) == sorted(repaired_by_hand(rows))
    assert sum(r[6] for r in found) > 0


def test_repair_of_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None), (None, 3, "user", "hi."), (1, None, "user", "a"), (1, None, "user", "a"), (1, 2, "", ""),
            (2, 0, "system", "é€😀."), (2, 0, "assistant", "b."), (2, 9, "user", "x" * 300_000), (3, 5, "ubot", "\t \n"), (4, 0, "user", "A."),
            (4, 7, "system", "late."), (4, 8, "assistant", "b?  \n")] + [(5, i, "user", f"{i}.") for i in range(500)]
    frame = spark.createDataFrame([(*r, "q") for r in rows], "conv_id long, turn long, role string, text string, cost string")
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    found = [tuple(r) for r in QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()]
    assert sorted(found, key=repr) == sorted(repaired_by_hand(rows), key=repr)
    assert repair.repair_conversations(frame.limit(0)).count() == 0
    turns = spark.createDataFrame([(1, 0, bytearray(b"a\xff."), "u")], "conv_id int, turn int, text binary, role string")
    only = repair.repair_conversations(turns.withColumn("text", F.col("text").cast("string"))).first()
    assert only.audit == "D" and only.truncated == 0 and only.cost == 2
    gone = repair.repair_conversations(turns.withColumn("text", F.lit("x")), present=F.lit(None).cast("boolean")).first()
    assert tuple(gone) == (1, 0, 0, 0, 0, 0, 0, "", [])


def phrases_by_hand(rows, least=10, longest=3, percent=50, top=2000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    for lang, count in counts.items():
        n = sum(c for p, c in count.items() if len(p) == 1)
        chosen, covered = [], {}
        candidates = {p: c for p, c in count.items() if len(p) > 1 and c >= least}
        for phrase, c in candidates.items():
            for size in range(2, len(phrase)):
                for start in range(len(phrase) - size + 1):
                    part = phrase[start:start + size]
                    covered[part] = max(covered.get(part, 0), c)
        for phrase, a in candidates.items():
            if 100 * covered.get(phrase, 0) >= percent * a:
                continue
            score, k = min((10 ** 6 * a * a // (count[phrase[:k]] * count[phrase[k:]]), k) for k in range(1, len(phrase)))
            chosen.append((-score, -a, " ".join(phrase).encode(), count[phrase[:k]], count[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(chosen)[:top], 1):
            yield lang, rank, phrase.decode(), -a, left, right, n, -score


def test_collocations_query(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    frame = QUERIES["op12_collocations"](spark, SF_DIR)
    found = sorted(tuple(r) for r in frame.collect())
    assert found == sorted(phrases_by_hand(rows)) and len(found) > 100
    assert mismatch(frame, duck(SF_DIR), ORACLES["op12_collocations"]) is None


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations_of_odd_texts(spark, monkeypatch, longest):
    monkeypatch.setattr(collocations, "_TEXT_SLICE", 50)
    rng = np.random.default_rng(1)
    words = ["a", "B", "b", "é", "c\x00", " x", "n ", "very" * 30]
    rows = [(lang, "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", "\r\n", " "]) for _ in range(400)))
            for lang in (None, "und", "en", "de", "en", "") for _ in range(2)]
    rows += [("en", "same words here, again and again. ")] * 30 + [("en", None), ("en", ""), (None, " .,; "), ("xx", "w" * 100_000)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, phrase string, n int").repartition(5)
    found = collocations.collocations(frame, least=4, longest=longest, top=25).collect()
    assert sorted(tuple(r) for r in found) == sorted(phrases_by_hand(rows, 4, longest, top=25))
    assert collocations.collocations(frame.limit(0)).count() == 0
    assert [r.n for r in collocations.collocations(frame, least=1, longest=2).where("lang = 'xx'").collect()] == []


def test_intervals_agree_between_directions():
    rng = np.random.default_rng(2)
    ids = np.concatenate([[0], rng.integers(0, 5, 3000), [0]]).astype(np.int32)
    text = " ".join(map(str, ids))
    index = collocations.BidirectionalIndex(ids, 3)
    found = index.to_the_left(index.to_the_right(index.single_words()))
    other = index.to_the_right(index.to_the_left(index.single_words()))
    as_rows = lambda x: sorted(zip(*[w.tolist() for w in x.words], x.forward.tolist(), x.backward.tolist(), x.size.tolist(), strict=True))
    assert as_rows(found) == as_rows(other)
    for a, b, c, *_, size in as_rows(found):
        assert size == len(re.findall(rf"(?<!\d)(?={a} {b} {c}(?!\d))", text))


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = QUERIES["op13_quality"](spark, sf).collect()
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    out = [(r.score, r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    good, bad = [s for s, _, q in out if q == 1], [s for s, _, q in out if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert np.mean([p == 1 for _, p, q in out if q == 1]) > 0.95


def test_quality_of_odd_rows(spark, docs, odd, nothing):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(60)] + [(None, 1, "x"), (7, None, "x")], "doc_id long, quality int, text string")
    seen = docs([(i, "plain words in a row, told with care" if i % 2 else "BUY!! NOW!! FREE!!") for i in range(60)] + [(3, "plain words"), (None, "x")])
    model = quality.fit_quality(seen, labels)
    scores = {(r.doc_id): r.score for r in quality.score_quality(seen, model).collect() if r.doc_id is not None}
    assert min(s for i, s in scores.items() if i % 2) > max(s for i, s in scores.items() if i % 2 == 0)
    found = quality.score_quality(odd, model).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2)}) == 1
    assert quality.score_quality(nothing, model).count() == 0
    one = quality.fit_quality(seen, labels.where("quality = 1"))
    assert {round(r.score, 3) for r in quality.score_quality(odd, one).collect()} == {round(31 / 32, 3)}
    none = quality.fit_quality(nothing, labels.limit(0))
    assert {r.score for r in quality.score_quality(odd, none).collect()} == {0.5}
    long = docs([(0, "plain words in a row, told with care. " * 30_000)])
    assert quality.score_quality(long, model).first().score > 0.5
