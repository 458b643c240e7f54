from collections import Counter, defaultdict

from tenure.llm.queries import op10_quality
from tenure.llm.quality import quality
from tests.llm.helpers import SF, WORD, documents, edge_rows, frame, same

STRIP = " \t\n\x0b\f\r"
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, max_line_docs=20, min_kept_percent=30):
    key = lambda line: line.strip(STRIP).translate(LOWER)
    holders = defaultdict(set)
    for row, (_, t, host) in enumerate(rows):
        for line in (t or "").split("\n"):
            if key(line):
                holders[host, key(line)].add(row)
    out = []
    for d, t, host in rows:
        t = t or ""
        ws = WORD.findall(t)
        grams = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
        many = Counter(grams)
        cover = {i + j for i, g in enumerate(grams) if many[g] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        gone = sum(len(WORD.findall(x)) for x in lines if len(holders[host, key(x)]) > max_line_docs)
        failed = len(ws) < 20 or 100 * len(cover) > 30 * len(ws)
        kept = not failed and not 100 * (len(ws) - gone) < min_kept_percent * len(ws)
        out.append((d, len(ws), sum(map(len, ws)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover), gone, failed, kept))
    return out


def test_edges(spark):
    df = frame(spark, edge_rows())
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    for limit in (0, 1, 20):
        same(quality(df, max_line_docs=limit).collect(), brute(rows, limit))
    assert quality(df.limit(0)).count() == 0


def test_depleted(spark):
    own = "each of these words is met here only once and so this line stays as it is number %d"
    rows = [(i, "Accept all cookies and read our long privacy notice before you go on to the next page of this site now\n" + (own % i if i % 2 else "x y")) for i in range(60)]
    df = frame(spark, rows, clash=False)
    got = quality(df).collect()
    same(got, brute([(r.doc_id, r.text, r.source) for r in df.collect()]))


def test_copies_are_documents(spark):
    """A line of 30 exact copies on one host is over the limit; 20 copies, or two hosts with 15 each, are not."""
    text = " ".join(f"word{i}" for i in range(40))
    for n, hosts, kept in ((30, 1, False), (20, 1, True), (30, 2, True), (21, 1, False)):
        rows = [(i, text, f"h{i % hosts}") for i in range(n)] + [(99, "another text of its own " * 1, "h0")]
        got = quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
        same(got, brute(rows))
        assert {r.kept for r in got if r.doc_id != 99} == {kept}
    # a line said 30 times by one document is one document's line
    rows = [(1, "\n".join([text] * 30), "h"), (2, text + "\nmore", "h")]
    assert {r.removed_words for r in quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()} == {0}


def test_query(spark):
    same(op10_quality(spark, SF).collect(), brute(documents()))
