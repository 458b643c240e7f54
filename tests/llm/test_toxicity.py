import random
import zlib

import duckdb
import pytest

from tenure.llm import toxicity
from tenure.llm.queries import op9_toxicity
from tenure.llm.toxicity import Model, segments
from tests.llm.helpers import SF, edge_rows, frame


def slow_segments(scores):
    """Again and again the best stretch (the shortest of equals), then left and right of it."""

    def best(a, b):
        top = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-12 and (top is None or (total, i - j) > (top[0] + 1e-9, top[1] - top[2])):
                    top = (total, i, j)
        if top is None:
            return []
        return best(a, top[1]) + [(top[1], top[2], top[0])] + best(top[2] + 1, b)

    return best(0, len(scores))


def test_segments_against_definition():
    rnd = random.Random(1)
    for _ in range(400):
        n = rnd.randrange(1, 30)
        rest = -rnd.random() - 0.01
        scores = [rnd.random() * 3 if rnd.random() < 0.35 else rest for _ in range(n)]
        at = [i for i, s in enumerate(scores) if s > 0]
        got = segments(at, [scores[i] for i in at], rest)
        want = slow_segments(scores)
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(got, want, strict=True))


def corpus(spark, n=400):
    rnd = random.Random(2)
    plain = ["".join(rnd.choices("abcdefghijklmnop", k=5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        ws = rnd.choices(plain, k=rnd.randrange(20, 200))
        toxic = i % 8 == 0
        for _ in range(4 if toxic else 0):
            ws.insert(rnd.randrange(len(ws)), rnd.choice(["Vexkord", "grumblat", "grumblatin", "grumblator", "zzoink!"]))
        rows.append((i, " ".join(ws)))
        if i % 5:
            labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_and_passages(spark):
    rows, labels = corpus(spark)
    docs, labels = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, labels, usable=toxicity.usable_label())
    got = toxicity.scored(docs, model, names=("s_", "w_", "p_")).collect()
    assert got[0].asDict().keys() == {*docs.columns, "s_", "w_", "p_"}
    for r in got:
        assert (r.s_ >= 0.7) == (r.doc_id % 8 == 0)
        for p in r.p_:
            assert any(x in r.text[p.start : p.end] for x in ("Vexkord", "grumblat", "zzoink"))
    # a form that no text has is scored by its prefix
    new = frame(spark, [(1, "abc grumblation def grumblatable ghi vexkord")])
    assert toxicity.scored(new, model, names=("s_", "w_", "p_")).first().s_ >= 0.7
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows if i % 8}


def test_only_usable_labels_teach(spark):
    rows, labels = corpus(spark)
    docs = frame(spark, rows)
    wrong = [(i, t if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - t) for i, t in labels]
    a, b = (toxicity.train(docs, spark.createDataFrame(x, "doc_id long, toxic int"), usable=toxicity.usable_label()) for x in (labels, wrong))
    assert a == b


def test_passage_that_many_documents_hold(spark):
    rnd = random.Random(6)
    passage = "murk vorn dask yelt brun zoph kwil"  # no word twice, no shared prefix
    plain = ["".join(rnd.choices("abcdefghijklmnop", k=5)) for _ in range(300)]
    rows = [(i, " ".join([*rnd.choices(plain, k=60), *([passage] if i % 8 == 0 else []), *rnd.choices(plain, k=60)])) for i in range(1000)]
    labels = [(i, int(i % 8 == 0)) for i, _ in rows if i < 800]  # a hundred copies are labelled, those from 800 on are held out
    docs, labels = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert set(passage.split()) <= model.tokens.keys()
    kept = {r.doc_id for r in toxicity.without_toxic(docs, labels).collect()}
    assert kept == {i for i, _ in rows if i % 8}


def test_edges(spark):
    rows, labels = corpus(spark)
    ls = spark.createDataFrame([*labels, (None, 1), (0, None), (3, 7), (99999, 1), (5, 0), (5, 0)], "doc_id long, toxic int")
    model = toxicity.train(frame(spark, rows + edge_rows()), ls)
    df = frame(spark, edge_rows())
    got = toxicity.scored(df, model, keep=["doc_id"]).collect()
    assert len(got) == len(edge_rows()) and all(0 < r.score < 0.7 for r in got)
    assert toxicity.scored(df.limit(0), model, keep=["doc_id"]).count() == 0
    for none in (ls.limit(0), ls.filter("toxic = 0"), ls.filter("toxic = 1")):
        flat = toxicity.train(frame(spark, rows), none)
        assert not flat.tokens and 0 < flat.probability(0.0) < 1
    assert toxicity.without_toxic(df.limit(0), ls).count() == 0


def test_probability_grows():
    m = Model({"x": 3.0}, intercept=-5, slope=0.5)
    assert m.probability(0) < m.probability(4) < m.probability(14) < 1


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_query_held_out_accuracy(spark, sf):
    got = {r.doc_id: r for r in op9_toxicity(spark, sf).collect()}
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for d, r in got.items())
    labels = [(d, t) for d, t in duckdb.sql(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall() if got[d].held_out]
    right = sum(got[d].predicted == t for d, t in labels) / len(labels)
    recall = sum(got[d].predicted for d, t in labels if t) / sum(t for _, t in labels)
    assert right >= 0.95 and recall >= 0.8


def test_query_columns(spark):
    assert op9_toxicity(spark, SF).columns == ["doc_id", "held_out", "score", "predicted"]
