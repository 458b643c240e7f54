import hashlib
from collections import defaultdict

from tenure.llm.line_dedup import dedup_lines
from tenure.llm.queries import op5_line_dedup
from tests.llm.helpers import SF, documents, edge_rows, frame, same

STRIP = " \t\n\x0b\f\r"
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows):
    key = lambda line: line.strip(STRIP).translate(LOWER)
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None:
                holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and d != max(holders[key(x)]))]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_edges(spark):
    rows = edge_rows()
    df = dedup_lines(frame(spark, rows), n_lines_col="n", n_dropped_col="pos")
    same(df.select("doc_id", "text", "n", "pos").collect(), brute(rows))
    assert df.filter("th = 'clash' and h1 = 'clash'").count() == len(rows)


def test_columns_stay_and_empty(spark):
    df = frame(spark, edge_rows())
    out = dedup_lines(df.limit(0))
    assert out.columns == df.columns and out.count() == 0


def test_query(spark):
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, t, n, k in brute([r[:2] for r in documents()])]
    same(op5_line_dedup(spark, SF).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect(), want)
