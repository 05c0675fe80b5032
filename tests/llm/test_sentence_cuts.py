"""Operator 9 where texts hold the same words with other stops and line breaks."""

import random

import brute
import pytest

from citeloom.llm import sentence_dedup


def removed(spark, docs, given):
    return {r["doc_id"]: r["text"] for r in sentence_dedup.dedup(docs(given).repartition(3)).collect()}


def all_runs(given):
    return brute.without_repeated_runs(given, sentence_dedup.sentences, sentence_dedup.SENTENCES, sentence_dedup.WORDS)


def test_a_passage_with_other_line_breaks_goes(spark, docs):
    words = [f"w{i}" for i in range(36)]
    lines = lambda n: "\n".join(" ".join(words[i : i + n]) for i in range(0, 36, n))
    given = [(1, f"Own start here.\n{lines(12)}\nOwn end."), (2, f"Another start.\n{lines(9)}\nAnother end."), (3, lines(6))]
    got = removed(spark, docs, given)
    assert got == all_runs(given) == {1: given[0][1], 2: "Another start.\nAnother end.", 3: ""}


def test_a_long_passage_of_sentences_with_other_line_breaks_goes(spark, docs):
    """Beyond the bounds, stops are borders that both texts have."""
    r = random.Random(4)
    sentences = [[f"s{i}x{j}" for j in range(r.randrange(20, 45))] for i in range(12)]

    def wrapped(n):
        words = [w for s in sentences for w in [*s[:-1], s[-1] + "."]]
        return "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))

    got = removed(spark, docs, [(1, wrapped(11)), (2, "Own start.\n\n" + wrapped(7) + "\n\nOwn end.")])
    assert got == {1: wrapped(11), 2: "Own start.\n\nOwn end."}


def test_a_missing_stop_does_not_hide_a_run(spark, docs):
    part = lambda t, n: " ".join(f"{t}{i}" for i in range(n))
    given = [(1, f"{part('a', 3)}. {part('b', 15)}. {part('c', 4)}."), (2, f"{part('a', 3)} {part('b', 15)}. {part('c', 4)}.")]
    assert removed(spark, docs, given) == all_runs(given) == {1: given[0][1], 2: ""}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_within_the_bounds_all_runs_are_hashed(spark, docs, seed):
    """At most 8 sentences and 48 words a text, cut anyhow: what goes is what all runs of any length remove."""
    r = random.Random(seed)
    stock = [[f"v{i}x{j}" for j in range(r.randrange(5, 22))] for i in range(12)]
    given = []
    for i in range(150):
        words = [w for _ in range(r.randrange(1, 4)) for w in r.choice(stock)][:48]
        cuts = sorted(r.sample(range(1, len(words)), min(len(words) - 1, r.randrange(0, 7))))
        text = "".join(" ".join(words[a:z]) + r.choice([". ", "\n", "! ", "\n\n"]) for a, z in zip([0, *cuts], [*cuts, len(words)]))
        given.append((i, text))
    assert removed(spark, docs, given) == all_runs(given)


def test_share_of_all_runs_for_random_cuts(spark, docs):
    """Longer texts whose words are cut at random in every copy, the hardest case: of what all runs remove nearly all goes, and nothing else."""
    r = random.Random(11)
    stock = [[f"v{i}x{j}" for j in range(r.randrange(5, 40))] for i in range(15)]
    given = []
    for i in range(80):
        words = [w for _ in range(r.randrange(1, 7)) for w in r.choice(stock)]
        out, at = "", 0
        while at < len(words):
            n = r.randrange(3, 14)
            out, at = out + " ".join(words[at : at + n]) + r.choice([". ", ". ", "\n"]), at + n
        given.append((i, out))
    got, want = removed(spark, docs, given), all_runs(given)
    assert all(len(got[d]) >= len(want[d]) for d in want)
    gone, due = (sum(len(t) - len(x[d]) for d, t in given) for x in (got, want))
    print(f"{gone} of {due} characters")
    assert gone >= 0.95 * due
