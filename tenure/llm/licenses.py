"""License scans: Dice coefficient over word bigrams against licence templates."""

from __future__ import annotations

import heapq
import math
import string
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tenure.llm.common import picked
from tenure.llm.license_texts import TEMPLATES

LEAST = 0.8
_STRIP = string.punctuation


def normalised(text: str) -> list[str]:
    """Lower-cased words without punctuation at their ends."""
    return [w for x in text.lower().split() if (w := x.strip(_STRIP))]


def bigrams(ws: list[str]) -> Counter:
    return Counter(zip(ws, ws[1:], strict=False))


class Templates:
    """Templates by their number of bigrams, for look-ups by size.

    A Dice coefficient of ``least`` needs sizes within a factor of
    (2 - least) / least, so templates outside these bounds are never compared.
    """

    def __init__(self, texts: dict[str, list[str]], least: float):
        self.least = least
        self.all = sorted(((name, b, b.total()) for name, versions in texts.items() for v in versions if (b := bigrams(normalised(v)))), key=lambda x: (x[2], x[0]))
        self.first = min((n for *_, n in self.all), default=1) * least / (2 - least)
        self.last = max((n for *_, n in self.all), default=0) * (2 - least) / least
        self.known = {g for _, b, _ in self.all for g in b}
        #: Bigram to the templates that hold it (by their place in ``all``).
        self.holders: dict[tuple[str, str], list[int]] = defaultdict(list)
        for t, (_, b, _) in enumerate(self.all):
            for g in b:
                self.holders[g].append(t)

    def match(self, ws: list[str]) -> list[tuple[str, float]]:
        """(licence, Dice) of the licence with the highest Dice, if that is ``least`` or more; several if they tie."""
        n = len(ws) - 1
        if not self.first <= n <= self.last:
            return []
        # no template can share more of the run's bigrams than are in any template
        common = sum(g in self.known for g in zip(ws, ws[1:], strict=False))
        low, high = n * self.least / (2 - self.least), n * (2 - self.least) / self.least
        if 2 * common < self.least * (n + low) - 1e-9:
            return []
        own = bigrams(ws)
        best: dict[str, float] = {}
        for name, b, size in self.all:
            if low <= size <= high and 2 * common >= self.least * (n + size) - 1e-9:
                dice = 2 * (own & b).total() / (n + size)
                if dice >= self.least:
                    best[name] = max(dice, best.get(name, 0.0))
        return sorted((name, d) for name, d in best.items() if d == max(best.values()))


    def windows(self, ws: list[str]) -> list[tuple[str, float, int, int]]:
        """(licence, Dice, first word, last word) of the runs of words that are most like a template.

        Of all runs with a Dice of ``least`` or more the highest goes first (then the longest,
        then the first); runs that share a word with one before go, but for licences
        that tie on the same run.
        """
        grams = list(zip(ws, ws[1:], strict=False))
        hits = [i for i, g in enumerate(grams) if g in self.known]
        places: dict[int, list[int]] = defaultdict(list)
        for i in hits:
            for t in self.holders[grams[i]]:
                places[t].append(i)
        heap, searches = [], {}
        for t, at in places.items():
            search = Search(at, grams, *self.all[t][1:], self.least)
            for k in search.starts:
                if found := search.best(k, len(ws)):
                    heap.append((-found[0], at[k] - found[1], at[k], self.all[t][0], t, k))
                    searches[t] = search
        heapq.heapify(heap)
        firsts: list[int] = []
        lasts: list[int] = []
        best, out = {}, []
        while heap:
            d, less, a, name, t, k = heapq.heappop(heap)
            b = a - less
            i = bisect_right(firsts, a)
            if i and lasts[i - 1] >= a:
                if best.get(a) == (d, b):
                    out.append((name, -d, a, b))
            elif i < len(firsts) and firsts[i] <= b:  # the run's end is gone: the best shorter one
                if found := searches[t].best(k, firsts[i]):
                    heapq.heappush(heap, (-found[0], a - found[1], a, name, t, k))
            else:
                firsts.insert(i, a)
                lasts.insert(i, b)
                best[a] = (d, b)
                out.append((name, -d, a, b))
        return out


class Search:
    """Runs of a text's words that are like one template.

    ``at`` has the places of the template's bigrams in the text. The best run from
    a word starts and ends with such a bigram, and within its size bounds lie
    at least ``need`` of them; other starts are never tried.
    """

    def __init__(self, at: list[int], grams: list[tuple[str, str]], template: Counter, size: int, least: float):
        self.size, self.least = size, least
        need, self.most = math.ceil(size * least / (2 - least) - 1e-9), math.floor(size * (2 - least) / least + 1e-9)
        self.starts = [k for k in range(len(at) - need + 1) if at[k + need - 1] - at[k] < self.most]
        if not self.starts:
            return
        # a bigram counts in runs that start after ``before``: there it is not yet as often as in the template
        seen: dict[tuple[str, str], list[int]] = defaultdict(list)
        before = []
        for i in at:
            g = grams[i]
            own = seen[g]
            before.append(own[-template[g]] if len(own) >= template[g] else -1)
            own.append(i)
        self.at, self.before = np.array(at), np.array(before)

    def best(self, k: int, end: int) -> tuple[float, int] | None:
        """Dice and last word of the best run (the longest of equals) from the ``k``-th place that ends before word ``end``."""
        first = int(self.at[k])
        stop = bisect_left(self.at, min(first + self.most, end - 1))
        if stop <= k:
            return None
        inside = self.at[k:stop]
        dice = 2 * np.cumsum(self.before[k:stop] < first) / (inside - first + 1 + self.size)
        i = len(dice) - 1 - int(dice[::-1].argmax())
        return (float(dice[i]), int(inside[i]) + 1) if dice[i] >= self.least else None


def units(lines: list[list[str]]) -> Iterator[tuple[int, int, list[str]]]:
    """(first line, last line, words) of each line, each paragraph of several lines, and
    the whole text where it has several paragraphs; lines count from 1, blank ones part paragraphs."""
    every, parts, first = [], [], 0
    for i, ws in enumerate([*lines, []], 1):
        if ws:
            yield i, i, ws
            parts.append(ws)
            first = first or i
        elif parts:
            if len(parts) > 1:
                yield first, i - 1, [w for p in parts for w in p]
            every.append((first, i - 1))
            parts, first = [], 0
    if len(every) > 1:
        yield every[0][0], every[-1][1], [w for ws in lines for w in ws]


def find(text: str | None, templates: Templates, runs: bool = False) -> list[tuple[str, float, int, int]]:
    """(licence, Dice, first line, last line): per licence the best unit (then the first, then
    the shortest); with ``runs``, the best run of words if no unit is as like it.

    A licence is left out where its place lies within another's of a higher Dice: there a
    text or notice was cut short, or names the other licence's kin.
    """
    best: dict[str, tuple] = {}
    lines = [normalised(x) for x in (text or "").split("\n")]
    for first, last, ws in units(lines):
        for name, dice in templates.match(ws):
            key = (-dice, first, last)
            if name not in best or key < best[name]:
                best[name] = key
    starts = np.cumsum([0, *map(len, lines)])
    for name, dice, a, b in templates.windows([w for ws in lines for w in ws]) if runs else []:
        if name not in best or -dice < best[name][0]:
            first, last = np.searchsorted(starts, [a, b], "right").tolist()
            best[name] = (-dice, first, last)
    own = [(name, -d, a, b) for name, (d, a, b) in sorted(best.items())]
    return [x for x in own if not any(y[1] > x[1] and y[2] <= x[2] and x[3] <= y[3] for y in own)]


def licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: dict[str, list[str]] = TEMPLATES, least: float = LEAST,
    runs: bool = False,
) -> DataFrame:
    """One row per document row and licence found: ``doc_id, license, dice, first_line, last_line``.

    Every line, paragraph and whole text is compared (bigrams with their
    counts) and goes to the licence that it is most like; a licence is reported
    with its best unit. With ``runs`` a licence that no unit is as like, such as a header of
    several paragraphs before code, or a notice within a line, is reported with the
    best run of words anywhere in the text (``Templates.windows``) and the lines that
    it touches. A licence whose place lies within that of a better match is left
    out. ``texts``: licence to its versions.

    Defined cases: null, empty and one-word texts have no licence; null and
    repeated ids get rows per input row; an empty table or no templates give no
    rows; other columns are ignored.

    Scale: one narrow pass. The templates, shipped with the task, are a fixed list. Runs
    are searched only from places with enough of a template's bigrams near by, each
    in time linear in the template.
    """
    own = picked(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(texts, least)
        for b in batches:
            rows = [(d, *m) for d, t in zip(b.column("doc_id"), b.column("text"), strict=True) for m in find(t.as_py(), templates, runs)]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [b.schema.field("doc_id").type, pa.string(), pa.float64(), pa.int32(), pa.int32()]
            ids = pa.array([d.as_py() for d in cols[0]], kinds[0])
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(cols[1:], kinds[1:], strict=True))], ["doc_id", "license", "dice", "first_line", "last_line"])

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, license string, dice double, first_line int, last_line int")
