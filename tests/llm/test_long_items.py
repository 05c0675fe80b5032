"""Operator 6: items longer than a unit are found within the budget of the whole item."""

import random

import numpy as np

from citeloom.llm import decontaminate


def least_edits(item, text):
    """The edits between item and the piece of text nearest to it, a column of the table at a time."""
    text = np.array([ord(c) for c in text])
    row, steps = np.zeros(len(text) + 1, np.int64), np.arange(len(text) + 1)
    for i, c in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (text != ord(c)), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def letters(r, n):
    return "".join(r.choice("abcdefgh") for _ in range(n))


def changed(r, s, places):
    s = list(s)
    for p in sorted(places, reverse=True):
        s[p : p + 1] = r.choice([[], ["z"], [s[p], "z"]])
    return "".join(s)


def test_edits_in_one_stretch_are_within_the_budget():
    r = random.Random(1)
    for m in (201, 250, 350, 399, 420, 590, 750, 1000):
        item = letters(r, m)
        ix = decontaminate.index([(1, item)])
        assert ix.wholes[0].k == m // 10
        for at in (0, m // 2 - 30, m - m // 10 - 1):
            text = letters(r, 80) + changed(r, item, range(at, at + m // 10)) + letters(r, 80)
            found = list(decontaminate.spans(ix, [letters(r, 300), text, letters(r, 300)]))
            assert [(f[0], f[1]) for f in found] == [(1, 0)], (m, at)
            assert found[0][2] <= 80 + m // 10 and found[0][3] >= len(text) - 80 - m // 10


def test_items_up_to_1000_characters_equal_brute_force():
    """A text holds an item if the whole item or a window of UNIT characters of it occurs within its budget."""
    r = random.Random(2)
    items = [(m, letters(r, m)) for m in (150, 201, 260, 350, 399, 505, 700, 1000)]
    texts = []
    for m, item in items:
        for n in (m // 10 - 1, m // 10, m // 10 + 1, m // 10 + 4):
            at = r.randrange(0, m - n)
            texts.append(letters(r, 60) + changed(r, item, range(at, at + n)) + letters(r, 60))
            texts.append(changed(r, item, r.sample(range(m), n)))
        texts += [item[: m // 2], item[m // 3 :], letters(r, 40) + item[:190], letters(r, m)]
    unit = decontaminate.UNIT

    def holds(text, item):
        m = len(item)
        windows = [] if m <= unit else [item[s : s + unit] for s in [*range(0, m - unit, unit // 2), m - unit]]
        return least_edits(item, text) <= m // 10 or any(least_edits(w, text) <= unit // 10 for w in windows)

    want = {(t, i) for t, text in enumerate(texts) for i, (_, item) in enumerate(items) if holds(text, item)}
    assert {(f[0], f[1]) for f in decontaminate.spans(decontaminate.index(items), texts)} == want and len(want) > 50


def test_a_part_alone_is_not_its_item():
    """Parts are filters: what has one part of a long item, but neither the item nor a window, is clean; also without edits."""
    r = random.Random(3)
    item = letters(r, 390)
    for rate in (0.1, 0.0, 0.005):
        ix = decontaminate.index([(1, item)], rate)
        assert list(decontaminate.spans(ix, [item[:130], letters(r, 50) + item[130:260], item[260:] + letters(r, 50)])) == []
        assert [f[:2] for f in decontaminate.spans(ix, ["x" * 30 + item])] == [(0, 0)]


def test_units_are_no_longer_than_asked():
    for m in range(1, 900, 7):
        for unit in (50, 120, 200):
            units = decontaminate.units_of(0, np.arange(m), 0.1, unit, 0)
            assert max(len(u.codes) for u in units) <= unit
            parts = [u for u in units if u.whole >= 0]
            assert (not parts and m <= unit) or sum(len(u.codes) for u in parts) == m


def test_long_items_in_documents(spark, docs):
    r = random.Random(5)
    item = letters(r, 350)
    near = changed(r, item, range(150, 185))
    given = docs([(1, letters(r, 500) + near), (2, changed(r, item, range(150, 200))), (3, item), (4, None), (5, letters(r, 700))])
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert sorted(f["doc_id"] for f in decontaminate.find(given, bench).collect()) == [1, 3]
    assert sorted(c["doc_id"] for c in decontaminate.keep_clean(given, bench).collect()) == [2, 4, 5]
