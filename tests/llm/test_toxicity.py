"""The chain's marginals against all labellings, and held-out accuracy."""

import itertools
import math
import random
import zlib

import duckdb
import numpy as np
import pytest

from feedlens.llm import queries, toxicity

SF = "/root/testdata/sf0.1"
SCHEMA = "id long, text string, score string, spans string, label_id string"


def plain_marginals(scores, enter, leave, stay):
    moves = {(0, 0): 0.0, (0, 1): enter, (1, 0): leave, (1, 1): stay}
    weight, toxic = 0.0, [0.0] * len(scores)
    for states in itertools.product((0, 1), repeat=len(scores)):
        w = math.exp(sum(s * y for s, y in zip(scores, states)) + sum(moves[m] for m in zip(states, states[1:])))
        weight += w
        for t, y in enumerate(states):
            toxic[t] += w * y
    return [x / weight for x in toxic]


@pytest.mark.parametrize("n", [1, 2, 5, 9])
def test_marginals(n):
    rng = random.Random(n)
    scores = [rng.gauss(0, 2) for _ in range(n)]
    enter, leave, stay = (rng.gauss(0, 1) for _ in range(3))
    got = toxicity.marginals([math.exp(s) for s in scores], enter, leave, stay)
    assert got == pytest.approx(plain_marginals(scores, enter, leave, stay), abs=1e-12)
    # the batched version of the fit, with a shorter sequence beside it
    u = np.array([scores + [0.0], [*scores[:1], *[0.0] * n]])
    inside = np.array([[True] * n + [False], [True] + [False] * n])
    p, pairs = toxicity._expected(u, inside, np.exp([enter, leave, stay]))
    assert p[0, :n] == pytest.approx(got, abs=1e-12) and p[0, n] == p[1, 1] == 0
    assert p[1, 0] == pytest.approx(1 / (1 + math.exp(-scores[0])))
    if n == 2:
        z = 1 + math.exp(scores[0] + leave) + math.exp(scores[1] + enter) + math.exp(sum(scores) + stay)
        assert pairs == pytest.approx([math.exp(scores[1] + enter) / z, math.exp(scores[0] + leave) / z,
                                       math.exp(sum(scores) + stay) / z])


def invented(n, seed):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abcdeilnorst") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["Zukw", "ZUKW", "zukw"]) + rng.choice("aeiou") + rng.choice("bdgklnprst"))
            words.insert(rng.randrange(len(words)), "grumb")
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_learns_words_and_beginnings(spark):
    rows = invented(600, 1)
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows], "id long, toxic int, text string")
    sample = toxicity.labelled_sample(docs, labels)
    assert len(sample) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i, _, _ in rows)
    small = toxicity.labelled_sample(docs, labels, toxic=5, clean=7)
    assert sorted(y for _, y in small) == [0] * 7 + [1] * 5
    model = toxicity.fit(sample)
    text = "é zukwem ok, ZUKWAN."                   # an unseen word with a known beginning
    more = docs.union(spark.createDataFrame([(1000, text, "", "", ""), (1001, None, "", "", ""), (1002, "", "", "", ""),
                                             (None, "hm", "", "", ""), (1000, text, "", "", "")], SCHEMA))
    got = toxicity.score(more, model).collect()
    assert len(got) == 605
    by = {r.id: r for r in got}
    for i, _, y in rows:
        assert by[i].predicted == y and by[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert (by[i].n_offending > 0) == bool(y)
    assert by[1000].spans == "2:8,13:19" and by[1000].predicted == 1
    assert by[1001].score == by[1002].score < 0.1 and by[1001].spans == "" and by[None].held_out is False


def test_labels_that_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"w{i}", "", "", "") for i in range(6)], SCHEMA)
    labels = spark.createDataFrame([(0, None), (1, 2), (None, 1), (2, 0), (2, 1)], "id long, toxic int")
    assert toxicity.labelled_sample(docs, labels) == []
    assert {r.score for r in toxicity.score(docs, toxicity.fit([])).collect()} == {0.0}
    one_kind = toxicity.fit([("a", 1), ("b", 1)])
    assert {r.score for r in toxicity.score(docs, one_kind).collect()} == {1.0}
    assert toxicity.score(docs.limit(0), one_kind).collect() == []


def test_long_text():
    tag = toxicity.tagger(toxicity.fit([(t, y) for _, t, y in invented(300, 2)]))
    score, spans = tag("abc " * 400_000 + "zukwit zukwan grumb zukwor")
    assert 0 <= score <= 1 and len(spans) == 4 and spans[0] == (1_600_000, 1_600_006)


def test_held_out_documents(spark):
    """On documents whose labels were not learnt from."""
    got = {r.doc_id: r for r in queries.registry()["op11_toxicity"](spark, SF).collect()}
    truth = duckdb.sql(f"select d.doc_id, l.toxic from '{SF}/documents.parquet' d join '{SF}/labels.parquet' l using (doc_id)").fetchall()
    assert len(got) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    pairs = [(got[i].predicted, y) for i, y in truth if got[i].held_out]
    right, told, toxic = sum(p and y for p, y in pairs), sum(p for p, _ in pairs), sum(y for _, y in pairs)
    assert len(pairs) > 1000 and right >= 0.9 * toxic and right >= 0.95 * told
