"""Leaks against all pairs compared in plain Python, and copies with one edit."""

import random
from collections import Counter, defaultdict

import pytest

from tableprep.llm import decontaminate as d

ITEM = ("A farmer has 2 eggs and 2 carrots in a basket when the rain begins to fall over the quiet field and he walks "
        "slowly back to the old house by the river")


def leaks_by_hand(docs, items, window=d.WINDOW, least=d.MIN_COVERAGE):
    words = d.Words()

    def windows(text, is_item):
        """(place, key, is template, slots) of each window."""
        tokens, codes, written = d.template((text or "").encode(), words)
        found = []
        length = min(window, len(tokens)) if is_item else window
        plain = [d.plain(d.core(t.decode())) for t in tokens]
        versions = [codes]
        if is_item and len(tokens) >= window and words.flags[words[tokens[0]]] & d._CAPITAL:
            named = codes.copy()
            named[0] = d._NAME_CODE
            versions.append(named)
        for number, version in enumerate(versions):
            for place in range(len(tokens) - length + 1 if length else 0):
                part = range(place, place + length)
                slots = [i for i in part if version[i] != written[i]]
                if number == 0:
                    found.append((place, tuple(written[i] for i in part), False, [plain[i] for i in slots]))
                if length == window and 2 <= length - len(slots) < length and (number == 0 or place == 0):
                    found.append((place, tuple(version[i] for i in part), True, [plain[i] for i in slots]))
        return found, tokens, written

    best = {}
    asked = []
    for item, text in set(items):
        found, tokens, _ = windows(text, True)
        if tokens:
            main = {}
            for place, key, is_template, _ in found:
                if is_template or place not in main:
                    main.setdefault(place, (key, is_template)) if not is_template else main.__setitem__(place, (key, True))
            asked.append((item, found, len(tokens)))
    for doc, text in set(docs):
        have, tokens, written = windows(text, False)
        by_key = defaultdict(list)
        for place, key, is_template, slots in have:
            by_key[key, is_template].append((place, slots))
        for item, found, size in asked:
            alike, first = {}, {}
            for place, key, is_template, _ in found:
                if not is_template:
                    template = next((k for p, k, t, _ in found if t and p == place), None)
                    alike[place] = first.setdefault(("t", template) if template else ("w", key), place)
            lookup = by_key
            if size < window:
                lookup = defaultdict(list)
                for place in range(len(tokens) - size + 1):
                    lookup[tuple(written[place:place + size]), False].append((place, []))
            runs = defaultdict(list)
            for place, key, is_template, slots in found:
                for at, given in lookup.get((key, is_template), ()):
                    runs[at - place].append((alike[place], is_template, slots, given if is_template else slots))
            hit, same = set(), set()
            for met in runs.values():
                votes = defaultdict(lambda: defaultdict(set))
                for number, _, slots, given in met:
                    for a, g in zip(slots, given):
                        votes[a][g].add(number)
                taken = {a: max(of, key=lambda g: (len(of[g]), a == g, g)) for a, of in votes.items()}
                for number, is_template, slots, given in met:
                    if not is_template or all(taken[a] == g for a, g in zip(slots, given)):
                        hit.add(number)
                        if slots == given:
                            same.add(number)
            total = len(set(alike.values()))
            if total and len(hit) / total >= least:
                row = (len(hit) / total, not hit - same, len(hit), total)
                best[doc, item] = max(best.get((doc, item), row), row)
    return {key: (row[3], row[2], row[0], "copy" if row[1] else "reparameterised") for key, row in best.items()}


def found_by(spark, docs, items):
    def frame(rows, name):
        return spark.createDataFrame([(*r, 1) for r in rows], f"{name} long, text string, window int")

    rows = d.find_leaks(frame(docs, "doc_id"), frame(items, "item_id")).collect()
    return {(r.doc_id, r.item_id): (r.n_windows, r.matched, r.coverage, r.kind) for r in rows}


def test_one_edit_costs_at_most_the_windows_that_hold_it(spark):
    half = ITEM.split()
    docs = [(1, ITEM.replace("2 carrots", "3 carrots")), (2, ITEM.replace("carrots", "turnips")), (3, ITEM), (4, ITEM.replace("2", "7")),
            (5, " ".join(half[:len(half) // 2])), (5, " ".join(half[len(half) // 2:])), (6, ITEM.replace("2 eggs", "9 eggs").replace("2 carrots", "8 carrots")),
            (7, "other words that have nothing of it at all in any place"), (None, ITEM), (None, None), (8, ""), (3, ITEM)]
    found = found_by(spark, docs, [(1, ITEM)])
    assert {doc for doc, _ in found} == {1, 2, 3, 4, None, 6} and found == leaks_by_hand(docs, [(1, ITEM)])
    assert found[1, 1][2] >= found[2, 1][2] >= 0.8 and found[3, 1][2:] == (1.0, "copy") and found[4, 1][2:] == (1.0, "reparameterised")


def test_items_shorter_than_a_window(spark):
    docs = [(1, "he said: Quiet Field, then left"), (2, "a quiet open field lay there"), (3, "Quiet field"), (4, "quiet")]
    items = [(1, "quiet field"), (2, "the rare word here"), (3, ""), (4, None)]
    assert found_by(spark, docs, items) == {(1, 1): (1, 1, 1.0, "copy"), (3, 1): (1, 1, 1.0, "copy")} == leaks_by_hand(docs, items)


@pytest.mark.parametrize("seed", [1, 2])
def test_all_pairs(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["2", "3", "km", "hours", "Anna", "Bert", "London", "the", "river", "runs", "past", "a", "house.", "and", "three", "trees", "Then", "it"]
    items = [(i % 11, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 30)))) for i in range(14)]
    docs = []
    for i in range(120):
        text = rng.choice(items)[1].split()
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        docs.append((i % 100, " ".join([rng.choice(vocabulary) for _ in range(rng.randrange(6))] + text + [rng.choice(vocabulary)] * rng.randrange(3))))
    found, want = found_by(spark, docs, items), leaks_by_hand(docs, items)
    assert found == want and len(found) > 30
