import pytest

from siftlane.llm import truncation as T

WHOLE = ["We waited.", "Is it?", "No!", "He said: “Yes.”", "(Applause.)", "Thanks. (Applause)", "– (The microphone was switched off.)", "Sagte: „Nein.“", "dit : « Oui. »", "是です。", "Ναι;", "End. \n\t", "End.…", "End. [...]", "rząd „Bill” musi.", "A.\n(Heiterkeit)"]
BROKEN = ["in the [...]", "the…", "outst�", "and (Applause.", "[Interruption from the", "said: “We will wait.", "Seed Bank (Amendment)", "and,", "but –", "he said: «", "no;", "..."]
OPEN = ["Motion agreed to", "the coastal fis", "Ayes 49, Noes 15"]


@pytest.mark.parametrize("text", WHOLE)
def test_whole(text):
    assert T.ending(text)[0] in ("whole", "dot")


@pytest.mark.parametrize("text", BROKEN)
def test_broken(text):
    assert T.ending(text)[0] == "broken" or (text in ("the…", "outst�", "in the [...]") and T.ending(text)[0] == "unit")


@pytest.mark.parametrize("text", OPEN)
def test_open(text):
    assert T.ending(text)[0] == "unit"


def test_blank():
    assert [T.ending(t)[0] for t in ("", " \n", " ​")] == ["blank"] * 3


def speech(i, n=40):
    return " ".join(f"Speaker {i} moved item {i * 7 + k} of the list and nobody but member {k * 3 + i} objected to it." for k in range(n))


def test_aligned():
    full = speech(1)
    for share in (0.2, 0.5, 0.93):
        assert T.aligned(full[: int(len(full) * share)], full) == "cut"
    assert T.aligned(full[: int(len(full) * 0.93)] + " [...]", full) == "cut"
    assert T.aligned(full, full) is None
    assert T.aligned(full[: full.rindex("Speaker")].rstrip(), full) is None  # ends with a sentence
    assert T.aligned(full, full + "\nMotion agreed to") == "whole"
    assert T.aligned("something else was said at " + full[200:260], full) is None  # no near copy of the beginning
    assert T.aligned("a b", full) is None


def corpus():
    rows = [(i, speech(i, 12), "s1") for i in range(60)]
    rows += [(100 + i, speech(i + 100, 12) + "\n\nMotion agreed to", "s1") for i in range(8)]
    rows += [(200 + i, speech(i + 500, 12) + f" We thank Mr. {'Abel Baker Clark'.split()[i % 3]} for it. We heard Mr. Abel. Then we saw Mr. Baker.", "s2") for i in range(90)]
    rows += [(300, speech(300, 12) + " We thank Mr.", "s2"), (301, speech(301, 12)[:-9], "s2"), (302, speech(302, 12) + "\n\nMotion agr", "s2"), (303, speech(303, 12) + " (Applause", None)]
    rows += [(304, speech(5, 12)[: int(len(speech(5, 12)) * 0.95)], "s2")] * 2
    rows += [(400, None, "s1"), (401, "", "s1"), (402, " \n", "s1"), (None, "Nothing is", "s1")]
    return rows


def test_judged(spark):
    df = spark.createDataFrame([(*r, "x", 1) for r in corpus()], "doc_id long, text string, source string, state string, n_words int").repartition(5)
    out = T.judge(df).collect()
    assert len(out) == len(corpus())
    assert sorted({r["doc_id"] or 0 for r in out if r["truncated"]}) == [0, 300, 301, 302, 303, 304]
    assert sorted(r["decided_by"] for r in out if r["doc_id"] in (304, 300)) == ["copy", "copy", "ending"]
    shares = {r["source"]: r for r in T.shares(T.judge(df)).collect()}
    assert shares[None]["share"] == 1.0 and (shares["s1"]["documents"], shares["s1"]["truncated"]) == (69, 1)


def test_other_ways(spark, monkeypatch):
    """Texts are shuffled where pairs are too many to be sent, and hubs come in parts, with the same result."""
    monkeypatch.setattr(T, "SENT_PAIRS", 0)
    monkeypatch.setattr(T, "HUB_ROWS", 1)
    monkeypatch.setattr(T, "SENT_WORDS", 0)
    monkeypatch.setattr("siftlane.operators.skew.HOT_ROWS", 1)
    df = spark.createDataFrame(corpus(), "doc_id long, text string, source string")
    assert sorted({r["doc_id"] or 0 for r in T.judge(df).filter("truncated").collect()}) == [0, 300, 301, 302, 303, 304]


def crowded():
    """A bucket whose longest text is a near copy of none of the others; two are cut between words, one in its last word, one with a cut sign."""
    shared = speech(1, 30)
    full = {k: shared + " " + " ".join(f"Point {k} {i} was raised by delegate {i * k} for the committee of Mr. Abel{i} again." for i in range(12)) for k in (2, 3, 4, 5)}
    cut = {k: full[k][: full[k].rindex(" of Mr. Abel11")] for k in (2, 3)}
    cut |= {4: full[4][: full[4].rindex("agai") + 3], 5: full[5][: full[5].rindex(" again.")] + " [...]"}
    other = shared + " " + speech(77, 40)
    return [(1, other, "s")] + [(10 * k, t, "s") for k, t in full.items()] + [(10 * k + 1, t, "s") for k, t in cut.items()]


def test_in_a_crowded_bucket(spark, monkeypatch):
    """Every member of a bucket meets its full copy, though another text is the longest; pairs come in many rounds."""
    import numpy as np

    def one_bucket(self, x, begin, bands=T.Hasher.bands):
        found, per_text = bands(self, x, begin)
        return np.full_like(found, 7), per_text

    monkeypatch.setattr(T, "ROUND_PAIRS", 1)
    monkeypatch.setattr(T.Hasher, "bands", one_bucket)
    rows = crowded()
    assert not any(T.aligned(r[1], rows[0][1]) for r in rows)
    out = T.judge(spark.createDataFrame([*rows, (99, rows[-1][1], "s")], "doc_id long, text string, source string").repartition(3)).collect()
    assert {r["doc_id"] for r in out if r["decided_by"] == "copy" and r["truncated"]} == {21, 31, 41, 51, 99}


def test_recall_of_verified_pairs(spark):
    """Near copies with words changed, cut to 20 to 95 per cent within a sentence."""
    import random

    rng = random.Random(3)
    rows, cut = [], set()
    for i in range(150):
        full = speech(i, 30)
        words = full.split(" ")
        for k in rng.sample(range(len(words)), len(words) // 100):
            words[k] = f"corrected{k}"
        noisy = " ".join(words)
        at = noisy.index(" ", int(len(noisy) * rng.uniform(0.2, 0.94)))
        while noisy[at - 1] == ".":
            at = noisy.index(" ", at + 1)
        rows += [(i, full, "s"), (1000 + i, noisy[:at], "s")]
        cut.add(1000 + i)
    out = T.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by_copy = {r["doc_id"] for r in out if r["decided_by"] == "copy" and r["truncated"]}
    assert by_copy <= cut and len(by_copy) >= 0.9 * len(cut)


def test_formulas_whatever_the_corpus(spark):
    """Three documents make a formula, in few documents and in many, however long it is."""
    long = "and so the house in its present sitting resolves without a division that the matter be laid upon the table until the committee has met again"
    rows = [(i, speech(i, 3) + "\n" + text, "s") for i, text in enumerate(["Motion agreed to"] * 3 + [long] * 3 + ["Motion agreed never"] * 2)]
    few = spark.createDataFrame(rows, "doc_id long, text string, source string")
    many = few.unionByName(spark.range(1000, 21_000).selectExpr("id AS doc_id", "concat('Filler ', id, ' was read and ', id * 7, ' was not.') AS text", "'s' AS source"))
    for df in (few, many):
        assert {r["doc_id"] for r in T.judge(df).filter("truncated").collect()} == {6, 7}


def test_far_from_the_end(spark):
    """Marks and text further from the end than any window count, behind a full stop and before many blanks."""
    said = "It went on as before. " * 300
    rows = [(1, "We met. (Note: " + said, "s"), (2, "He said: „" + said, "s"), (3, "Nothing is," + " " * 5000, "s"), (4, "We met. (Note: " + said + ")", "s"), (5, "We met. " + said, "s"), (6, " " * 5000, "s")]
    got = {r["doc_id"]: r["state"] for r in T.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == {1: "broken", 2: "broken", 3: "broken", 4: "whole", 5: "dot", 6: "blank"}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert T.judge(df).count() == 0 and T.shares(T.judge(df)).count() == 0
