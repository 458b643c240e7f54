import random
import string
import textwrap
from collections import Counter

from tenure.llm.license_texts import TEMPLATES
from tenure.llm.licenses import LEAST, Templates, find, licenses
from tenure.llm.queries import op1_license_scan
from tests.llm.helpers import SF, documents, edge_rows, frame, same


def words(t):
    return [w for w in (x.strip(string.punctuation) for x in t.lower().split()) if w]


def grams(ws):
    return Counter(zip(ws, ws[1:], strict=False))


def dice(a, y):
    """``y``: bigrams of a template."""
    x = grams(a)
    return 2 * sum(min(n, y[g]) for g, n in x.items()) / (x.total() + y.total()) if x and y else 0.0


VERSIONS = {name: [grams(words(v)) for v in vs] for name, vs in TEMPLATES.items()}
#: Notices and short licences; the long ones have a test of their own.
SHORT = {name: own for name, vs in TEMPLATES.items() if (own := [v for v in vs if len(words(v)) < 400])}


def brute(text):
    """Every unit against every template, without bounds."""
    lines = (text or "").split("\n")
    paragraphs, own = [], []
    for i, line in enumerate([*lines, ""], 1):
        if words(line):
            own.append(i)
        elif own:
            paragraphs.append(own)
            own = []
    units = [(i, i) for i in range(1, len(lines) + 1)] + [(p[0], p[-1]) for p in paragraphs if len(p) > 1]
    if len(paragraphs) > 1:
        units.append((paragraphs[0][0], paragraphs[-1][-1]))
    best = {}
    for a, b in units:
        ws = words("\n".join(lines[a - 1 : b]))
        scores = {name: max(dice(ws, v) for v in vs) for name, vs in VERSIONS.items()}
        top = max(scores.values())
        for name, s in scores.items():
            if s == top >= LEAST and (-s, a, b) < best.get(name, (1, 0, 0)):
                best[name] = (-s, a, b)
    own = [(n, round(-d, 9), a, b) for n, (d, a, b) in sorted(best.items())]
    return [x for x in own if not any(y[1] > x[1] and y[2] <= x[2] <= x[3] <= y[3] for y in own)]


def rows_of(df):
    return [(r.doc_id, r.license, round(r.dice, 9), r.first_line, r.last_line) for r in df.collect()]


def want_of(rows):
    return [(d, *m) for d, t in rows for m in brute(t)]


def planted():
    rnd = random.Random(1)
    out, k = [], 200
    for versions in SHORT.values():
        for v in versions:
            ws = v.split(" ")
            for changes in (0, 1, len(ws) // 12, len(ws) // 3):
                new = list(ws)
                for _ in range(changes):
                    new[rnd.randrange(len(new))] = rnd.choice(["other", "THE", "new"])
                out.append((k, f"some words of prose before it\n\n{' '.join(new)}\n\nand more after it"))
                out.append((k + 1, " ".join(new).upper()))
                k += 2
    return out


def test_templates_are_found():
    t = Templates(TEMPLATES, LEAST)
    for name, versions in SHORT.items():
        for v in versions:
            assert (name, 1.0) in [m[:2] for m in find("Words before.\n\n" + v + "\n\nWords after.", t)] + [m[:2] for m in find(v, t)]


def test_edges_and_planted(spark):
    rows = edge_rows() + planted() + [(None, "Released under the MIT License.")] * 2
    same(rows_of(licenses(frame(spark, rows))), want_of(rows))
    assert licenses(frame(spark, rows).limit(0)).count() == 0
    assert licenses(frame(spark, rows), texts={}).count() == 0


def every_run(text, texts):
    """All runs of words against all templates: the highest Dice first, then the longest, none that shares words with one before."""
    ws = words(text)
    found = []
    for a in range(len(ws)):
        for b in range(a + 1, len(ws)):
            found += [(-s, a, b, name) for name, vs in texts.items() if (s := max(dice(ws[a : b + 1], grams(words(v))) for v in vs)) >= LEAST]
    taken, out = [], []
    for s, a, b, name in sorted(found, key=lambda x: (x[0], x[1] - x[2], x[1], x[3])):
        if (s, a, b) in taken or not any(a <= y and x <= b for _, x, y in taken):
            taken.append((s, a, b))
            out.append((name, -s, a, b))
    return out


def test_runs_against_all_runs():
    rnd = random.Random(3)
    texts = {"a": ["p q r s p q t", "u v w"], "b": ["p q r s p q x", "q p q p q"], "c": ["r s t u v w x p"]}
    t = Templates(texts, LEAST)
    some = 0
    for _ in range(400):
        ws = []
        while len(ws) < 30:
            ws += rnd.choice([rnd.choices("pqrstuvwxyz", k=3), rnd.choice(rnd.choice(list(texts.values()))).split()])
            if rnd.random() < 0.4:
                ws[rnd.randrange(len(ws))] = rnd.choice("pqrsz")
        got = t.windows(ws)
        assert sorted(got) == sorted(every_run(" ".join(ws), texts))
        some += len(got)
    assert some > 400


def prose(rnd):
    return "\n".join(" ".join("".join(rnd.choices("abcdefgh", k=4)) for _ in range(9)) for _ in range(60))


def between_prose(rnd):
    """(licences, first line, last line, text): each template, unwrapped and wrapped, between long prose."""
    for versions in SHORT.values():
        for v in map(str.strip, versions):
            alike = [n for n, vs in TEMPLATES.items() if any(words(x) == words(v) for x in vs)]
            for own in (v, "\n\n".join(textwrap.fill(p, 72, break_on_hyphens=False, break_long_words=False) for p in v.split("\n\n"))):
                for part in ("\n\n", "\n"):
                    first = 60 + len(part)
                    yield alike, first, first + own.count("\n"), prose(rnd) + part + own + part + prose(rnd)


def test_licences_between_long_texts():
    rnd, t = random.Random(4), Templates(TEMPLATES, LEAST)
    for alike, first, last, text in between_prose(rnd):
        assert [x[:2] for x in t.windows(words(text))] == [(n, 1.0) for n in alike]
        assert find(text, t, runs=True) == [(n, 1.0, first, last) for n in alike]
    for name, versions in SHORT.items():
        for v in versions:
            got = find("some words " + " ".join(v.split()) + " and others", t, runs=True)
            assert name in [x[0] for x in got] and all(x[2:] == (1, 1) for x in got)
    both = find("\n".join([prose(rnd), TEMPLATES["MIT"][0], prose(rnd), TEMPLATES["GPL-3.0"][0], prose(rnd)]), t, runs=True)
    assert [x[:2] for x in both] == [("GPL-3.0", 1.0), ("MIT", 1.0)]


def test_query_finds_licences_between_long_texts(spark, tmp_path):
    rows = [(k, x) for k, x in enumerate(between_prose(random.Random(5)))]
    spark.createDataFrame([(k, x[3]) for k, x in rows], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.license) for r in op1_license_scan(spark, str(tmp_path)).collect()}
    assert got == {(k, n) for k, x in rows for n in x[0]}


def test_query(spark):
    """The query has what the units have, by a run of words where that is more like the licence."""
    got = {(d, n): dice for d, n, dice, *_ in rows_of(op1_license_scan(spark, SF))}
    want = {(d, n): dice for d, n, dice, *_ in want_of([r[:2] for r in documents()])}
    assert want and all(got.get(k, 0) >= dice for k, dice in want.items())


def test_published_texts_are_their_own_licence_alone(spark):
    """Whole texts, and whole texts between prose on the same lines."""
    rnd = random.Random(6)
    prose = lambda: " ".join("".join(rnd.choices(string.ascii_lowercase, k=6)) for _ in range(300))
    long = {n: v for n, vs in TEMPLATES.items() for v in vs if len(words(v)) > 150}
    assert len(long) >= 16
    rows = [(f"{n} {k}", t) for n, v in long.items() for k, t in enumerate((v, f"{prose()}\n{v}\n{prose()}", " ".join([prose(), *v.split(), prose()])))]
    got = licenses(spark.createDataFrame(rows, "doc_id string, text string"), runs=True).collect()
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append(r.license)
    assert all(r.license in found[r.doc_id] for r in got)
    for n in long:
        assert found[f"{n} 0"] == [n]
        assert n in found[f"{n} 1"] and n in found[f"{n} 2"]
