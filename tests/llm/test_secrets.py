import hashlib
import random
import re
from itertools import product

import numpy as np

from tenure.llm import secrets as M
from tenure.llm.queries import op7_secrets
from tests.llm.helpers import SF, documents, edge_rows, frame, same

ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def brute(text):
    out = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [s for *_, s in sorted(out)]


SAMPLES = [
    'password = "hunter2abc"', "PASSWD:abc", "passwd:abcdef token=x secret='AAAAAAAA'", "ſecret: abcdefgh", "apikey=123456api_key: abcdef.ghi",
    "AKIA" + "A1" * 10, "AKIA" + "B" * 15, "xAKIA" + "C" * 16 + "d", "0123456789abcdef01234567", "0123456789abcdef0123456", "token: 0123456789abcdef0123456789",
    "é token  :  'abc_def-gh' x", "password=password=abcdefg", "secret\"   =\n abcdefgh",
]


def test_base_spans():
    for t in [*SAMPLES, " ".join(SAMPLES), "\n".join(reversed(SAMPLES))]:
        assert [f"{k}:{a}:{b}" for a, b, k, *_ in M.base_spans(t)] == brute(t), t


def test_viterbi_against_all_paths():
    r = np.random.default_rng(1)
    for n in range(1, 7):
        for _ in range(30):
            scores, steps = r.normal(size=(n, 3)) * 2, r.normal(size=(3, 3))

            def value(path, scores=scores, steps=steps):
                whole = [0, *path, 0]
                return sum(scores[i, t] for i, t in enumerate(path)) + sum(steps[a, b] for a, b in zip(whole, whole[1:], strict=False))

            assert tuple(M.viterbi(scores, steps)) == max(product(range(3), repeat=n), key=value)


def test_gradient_against_differences():
    r = np.random.default_rng(2)
    part = [(r.integers(0, 6, (n, 4)), r.integers(0, 3, n)) for n in (1, 3, 5)]
    w, steps = r.normal(size=(6, 3)), r.normal(size=(3, 3))

    def likelihood(w, steps):
        total = 0.0
        for x, t in part:
            s = w[x].sum(1)

            def value(path, s=s):
                whole = [0, *path, 0]
                return sum(s[i, k] for i, k in enumerate(path)) + sum(steps[a, b] for a, b in zip(whole, whole[1:], strict=False))

            total += value(t) - np.log(sum(np.exp(value(p)) for p in product(range(3), repeat=len(t))))
        return total

    dw, ds = M._gradient(part, w, steps)
    for g, at, which in [(dw, (2, 1), 0), (dw, (5, 0), 0), (ds, (0, 1), 1), (ds, (1, 2), 1), (ds, (0, 0), 1), (ds, (2, 0), 1)]:
        args = [[w.copy(), steps.copy()] for _ in range(2)]
        args[0][which][at] += 1e-5
        args[1][which][at] -= 1e-5
        assert abs((likelihood(*args[0]) - likelihood(*args[1])) / 2e-5 - g[at]) < 1e-5


def test_pruned_tagging_equals_whole_viterbi():
    rnd = random.Random(3)
    texts = [make(rnd) for _ in range(150)]
    field = M.fit([s for t in texts[:80] for s in M.lessons(t)])
    tagger = M.Tagger(field)
    for at in (80, 115):
        part = texts[at : at + 35]
        for t, tags in zip(part, tagger.tags(part, [*map(M.tokens_of, part)]), strict=True):
            tokens = M.tokens_of(t)
            scores = np.zeros((len(tokens), 3))
            for i in range(len(tokens)):
                for o in M.AROUND:
                    for f in M.token_features(tokens[i + o] if 0 <= i + o < len(tokens) else M.EDGE):
                        scores[i] += field.weights.get(f"{o}{f}", 0)
                scores[i] += field.file(t, len(tokens))
            want = M.viterbi(scores, field.steps)
            assert (want == (tags if tags is not None else 0)).all()


def make(rnd, key=None):
    ws = ["".join(rnd.choices("aeioulnrst", k=rnd.randrange(2, 9))) for _ in range(rnd.randrange(30, 120))]
    for _ in range(rnd.randrange(0, 4)):
        secret = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz0123456789ABCDEF", k=rnd.randrange(16, 33)))
        ws.insert(rnd.randrange(len(ws)), f'{key or rnd.choice(["password", "secret", "api_key", "token"])} {rnd.choice("=:")} "{secret}"')
    for _ in range(rnd.randrange(0, 4)):
        ws.insert(rnd.randrange(len(ws)), rnd.choice(["12.5.2020", "4111 1111 1111 1111", "x.y@example.org", "10.0.0.1", "(see p. 12)", "3.14159"]))
    return " ".join(ws)


def test_field_finds_held_out_secrets():
    rnd = random.Random(4)
    texts = [make(rnd) for _ in range(400)]
    tagger = M.Tagger(M.fit([s for t in texts[:250] for s in M.lessons(t)]))
    found = right = wanted = 0
    for t in texts[250:]:
        tags = tagger.tags([t], [M.tokens_of(t)])[0]
        got = set(M.spans_of(t, tags)) if tags is not None else set()
        want = {(a, b) for *_, a, b in M.base_spans(t)}
        found, right, wanted = found + len(got), right + len(got & want), wanted + len(want)
    assert right >= 0.95 * wanted and right >= 0.95 * found
    # a keyword that no pattern has: the field adds what the patterns miss
    new = [make(rnd, "passphrase") for _ in range(40)]
    missed = sum(t.count("passphrase") for t in new)
    added = sum(len(M.spans_of(t, g)) for t in new if (g := tagger.tags([t], [M.tokens_of(t)])[0]) is not None)
    assert added >= 0.5 * missed


def check(df, rows):
    got = df.collect()
    want = [(d, *(sum(s.startswith(k) for s in b) for k in ("assign", "access", "hex")), hashlib.sha256(",".join(b).encode()).hexdigest()) for d, t in rows if (b := brute(t or "")) is not None]
    same([r[:5] for r in got], want)
    for r in got:
        spans = [s for s in r.spans.split(",") if s]
        own = [s for s in spans if not s.startswith("crf")]
        assert hashlib.sha256(",".join(own).encode()).hexdigest() == r.base_sha256
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)


def test_edges(spark):
    rows = edge_rows() + [(100 + i, t) for i, t in enumerate(SAMPLES)] + [(None, SAMPLES[0])]
    df = frame(spark, rows)
    check(M.secrets(df), rows)
    check(M.secrets(df.filter("doc_id < 12")), [r for r in rows if r[0] is not None and r[0] < 12])
    assert M.secrets(df.limit(0)).count() == 0


def test_query(spark):
    check(op7_secrets(spark, SF), [r[:2] for r in documents()])


def test_planted_forms_in_real_documents(spark):
    """Forms that no pattern knows, planted in documents, and secrets that a pattern catches in part."""
    rnd = random.Random(8)
    draw = lambda n: "".join(rnd.choices("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789", k=n))
    forms = ["passphrase: {}", "credential = {}", 'pwd="{}"', "auth_key: {}"]
    rows = [r[:2] for r in documents("/root/testdata/sf0.1")[:4000]]
    planted, texts = {}, {}
    for i in range(90):
        d, words = 1_000_000 + i, (rows[i][1] or "").split(" ")
        secret = draw(rnd.randrange(18, 30)) if i < 80 else draw(6) + "!$" + draw(14)
        words.insert(len(words) // 2, (forms[i % 4] if i < 80 else 'password="{}"').format(secret))
        texts[d] = " ".join(words)
        planted[d] = (texts[d].index(secret), texts[d].index(secret) + len(secret))
    got = M.secrets(spark.createDataFrame([*rows, *texts.items()], "doc_id long, text string")).collect()
    spans = {r.doc_id: [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("crf")] for r in got}
    base = {d: [s[:2] for s in M.base_spans(t)] for d, t in texts.items()}
    found = [d for d, (x, y) in planted.items() if any(a < y and x < b for a, b in spans[d])]
    # an added span lies in no base span, whatever else it overlaps
    assert all(not (x <= a and b <= y) for d in texts for a, b in spans[d] for x, y in base[d])
    print("unknown", sum(d < 1_000_080 for d in found), "parts", sum(d >= 1_000_080 for d in found), "clean", sum(len(spans[d]) for d, _ in rows))
    assert sum(d < 1_000_080 for d in found) >= 15  # mostly the quoted form; held out, the others are rarely found
    assert sum(len(spans[d]) for d, _ in rows) <= 5
