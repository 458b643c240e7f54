import random
import re
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from tenure.llm import filter_audit
from tenure.llm.queries import op11_filter_audit
from tests.llm.helpers import SF, WORD, edge_rows, frame, same


def brute(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic); each order applied document by document."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, x in labels if d is not None and x == 1}
    late = lambda d: (d is None, d or 0)
    first = {}
    for d, t, _ in docs:
        first[t or ""] = min(first.get(t or "", (True, 10**18)), late(d))
    parts = {}
    for d, t, lang in docs:
        t = t or ""
        ws = WORD.findall(t)
        fails = {
            "A": len(ws) < 100, "B": 100 * len(set(ws)) < 80 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": late(d) > first[t],
        }
        parts.setdefault(lang or "", []).append(({f for f, x in fails.items() if x}, d in good, d in toxic))
    out = []
    for part, rows in parts.items():
        share = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for i, f in enumerate(order, 1):
                here = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                share[f] += len(here)
                redundant = sum(f in r[0] for r in rows) - len(here)
                steps.append((part, order, i, len(left), len(here), redundant, sum(r[0] == {f} for r in rows), sum(r[1] for r in here), sum(r[2] for r in here), f))
        out += [(*s[:-1], share[s[-1]]) for s in steps]
    return out


def run(docs, labels):
    lost = filter_audit.with_losses(filter_audit.text_failures(docs), labels, good_lost="quality", toxic_lost="toxic")
    return filter_audit.audit(lost, "ABCDE", "lang", ("good_lost", "toxic_lost")).collect()


def test_query(spark):
    docs = duckdb.sql(f"select doc_id, text, lang from '{SF}/documents.parquet'").fetchall()
    labels = duckdb.sql(f"select doc_id, quality, toxic from '{SF}/labels.parquet'").fetchall()
    got = op11_filter_audit(spark, SF).collect()
    assert len(got) == 600 * len({x[2] for x in docs})
    same(got, brute(docs, labels))


def test_edges(spark):
    rows = edge_rows() + [(20 + i, "Words " * 120 + "%" * (i % 2)) for i in range(6)] + [(30, "A B"), (30, "A B"), (31, "A B")]
    df = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "x").when(F.col("doc_id") % 3 == 1, ""))
    labels = [(1, 1, 0), (1, 0, 1), (None, 1, 1), (21, None, 1), (22, 1, None), (30, 1, 1), (99, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit("clash")).withColumn("lang", F.lit("clash"))
    docs = [(r.doc_id, r.text, r.lang) for r in df.collect()]
    same(run(df.repartition(4), table), brute(docs, labels))
    assert run(df.limit(0), table) == []
    same(run(df, table.limit(0)), brute(docs, []))


def test_diagram():
    rnd = random.Random(1)
    for k in (1, 2, 3, 4):
        masks = {m: (rnd.randrange(4), rnd.randrange(3)) for m in range(1 << k) if rnd.random() < 0.7} or {0: (1, 0)}
        d = filter_audit.Diagram(masks, k, 2)
        for level in filter_audit.plain_changes(k):
            d.swap(level)
            gone = 0
            for v, kept, removed in d.steps():
                want = [w for m, w in masks.items() if not m & gone and m >> v & 1]
                gone |= 1 << v
                assert removed == tuple(sum(w[i] for w in want) for i in (0, 1))
                left = [w for m, w in masks.items() if not m & gone]
                assert kept == tuple(sum(w[i] for w in left) for i in (0, 1))
    # equal parts of a diagram are one node: all masks alike need one node a level
    d = filter_audit.Diagram({m: (3,) for m in range(32)}, 5, 1)
    assert len(d.nodes) == 5 and d.sums[d.root] == (96,)


@pytest.mark.parametrize("n", range(1, 7))
def test_plain_changes(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for level in filter_audit.plain_changes(n):
        order[level], order[level + 1] = order[level + 1], order[level]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert len(seen) == len(list(permutations(range(n))))
