"""Toxicity by maximum-scoring segments.

Tokens are words and the beginnings of words. Their log-odds between toxic and other training documents are
shrunk by a Dirichlet prior in proportion to their overall frequency; only tokens whose log-odds stand out keep a
score, every other word costs a small drift. One linear scan finds all maximal-scoring segments of a text. The
extreme-value law of the best segment of a text of n words gives each segment an E-value; the segments that are
significant are the toxic passages. A logistic curve, fitted on the training rows, turns the evidence of all
significant passages into a probability.

The model is fitted on a bounded sample of labelled rows; scoring reads whole texts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.llm.common import bounded_sample

WORDS = re.compile(r"\w+")
SHORTEST, LONGEST = 4, 10
DRIFT = -0.4
MOST = 6.0
CACHE = 300_000


def tokens(word: str) -> list[str]:
    """The word itself, marked, and its beginnings of SHORTEST to LONGEST letters."""
    return ["=" + word, *(word[:k] for k in range(SHORTEST, min(LONGEST, len(word)) + 1))]


def segments(scores: list[float]) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments: score, first and last index (exclusive).

    Linear time: each segment knows the last one before it that starts lower, so those between are passed over once.
    """
    found: list[tuple[float, float, int, int, int]] = []  # sum before, sum after, start, end, place of the last that starts lower
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        left, right, start, end = before, total, i, i + 1
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= left:
                j = found[j][4]
            if j < 0 or found[j][1] >= right:
                found.append((left, right, start, end, j))
                break
            left, _, start, _, lower = found[j]
            del found[j:]
            j = lower
    return [(r - l, int(a), int(b)) for l, r, a, b, _ in found]


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    rate: float = 1.0
    log_k: float = 0.0
    slope: float = 1.0
    offset: float = 0.0
    _known: dict[str, float] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_known": {}}

    def word_score(self, word: str) -> float:
        s = self._known.get(word)
        if s is None:
            if len(self._known) >= CACHE:
                self._known.clear()
            w = word.lower()
            s = self._known[word] = max((self.weights[t] for t in tokens(w) if t in self.weights), default=DRIFT)
        return s

    def passages(self, text: str) -> tuple[int, list[tuple[float, int, int]]]:
        """Number of words, and of each significant passage the negative log E-value and its span in code points.

        Stretches of words without a score are skipped as one step, which changes no segment.
        """
        known, hits, n = self._known, [], 0
        words = WORDS.findall(text)
        for w in set(words):
            if (known.get(w) if w in known else self.word_score(w)) > 0:
                hits.append(w)
        n = len(words)
        if not hits:
            return n, []
        hot = {w: self.word_score(w) for w in hits}
        scores, at = [], []
        gap = 0
        for i, w in enumerate(words):
            s = hot.get(w)
            if s is None:
                gap += 1
                continue
            if i and w == words[i - 1]:  # a word said again at once neither adds nor costs anything
                continue
            if gap:
                scores.append(gap * DRIFT)
                at.append(-1)
                gap = 0
            scores.append(s)
            at.append(i)
        spans = [m.span() for m in WORDS.finditer(text)]
        out = []
        for score, a, b in segments(scores):
            evidence = self.rate * score - self.log_k - np.log(max(n, 1))
            if evidence > 0:
                out.append((float(evidence), spans[at[a]][0], spans[at[b - 1]][1]))
        return n, out

    def evidence(self, text: str) -> float:
        return sum(e for e, _, _ in self.passages(text)[1])

    def probability(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-(self.slope * np.log1p(evidence) + self.offset))))


def without_copies(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The first row of each group of near copies, told by either of two min-hashes of five-word shingles.

    Copies of one text would make its words look frequent in its class.
    """
    seen: set[tuple[int, int]] = set()
    out = []
    for text, label in rows:
        words = text.lower().split()
        hashes = [zlib.crc32(" ".join(words[i : i + 5]).encode()) for i in range(max(1, len(words) - 4))]
        marks = [(k, min((h * m + a) & 0xFFFFFFFF for h in hashes)) for k, (m, a) in enumerate(((1, 0), (2654435761, 97)))]
        if seen.isdisjoint(marks):
            out.append((text, label))
        seen.update(marks)
    return out


def fit(rows: list[tuple[str, int]], totals: tuple[int, int] | None = None, prior: float = 200.0, least_z: float = 4.5, least_log_odds: float = 2.5) -> ToxicityModel:
    """Fits token scores, extreme-value constants and the logistic curve on (text, toxic) rows.

    totals: how many rows of each label the sample stands for; the logistic curve weighs them so.
    """
    rows = without_copies(rows)
    by_class: tuple[Counter, Counter] = Counter(), Counter()
    n = [0, 0]
    for text, toxic in rows:
        n[toxic] += 1
        seen: set[str] = set()
        for w in set(WORDS.findall(text.lower())):
            seen.update(tokens(w))
        by_class[toxic].update(seen)
    model = ToxicityModel({})
    if not n[0] or not n[1]:  # with one class only there is nothing to tell apart
        model.slope, model.offset = 0.0, -3.0 if n[0] or not n[1] else 3.0
        return model
    share = n[1] / (n[0] + n[1])
    for t, y1 in by_class[1].items():
        y0 = by_class[0][t]
        if y1 < 3:
            continue
        a = prior * (y0 + y1) / (n[0] + n[1])
        a1, a0 = a * share, a * (1 - share)  # the prior: as frequent in either class
        log_odds = np.log((y1 + a1) / max(n[1] + prior * share - y1 - a1, 0.5)) - np.log((y0 + a0) / max(n[0] + prior * (1 - share) - y0 - a0, 0.5))
        z = log_odds / np.sqrt(1 / (y1 + a1) + 1 / (y0 + a0))
        if z >= least_z and log_odds >= least_log_odds:
            model.weights[t] = float(min(MOST, log_odds))
    # The extreme-value rate: the positive root of E[exp(rate * score)] = 1 over words of documents that are not toxic.
    counts: Counter = Counter()
    for text, toxic in rows:
        if not toxic:
            for w in WORDS.findall(text):
                s = model.word_score(w)
                counts[round(s, 3)] += 1
    total = sum(counts.values())
    if any(s > 0 for s in counts):
        values, p = np.array(list(counts)), np.array(list(counts.values())) / total
        low, high = 1e-3, 10.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if (p * np.exp(mid * values)).sum() < 1 else (low, mid)
        model.rate = max(low, 0.05)
    else:
        model.rate = float(np.log(max(total, 2)) / MOST)
    # K from the share of documents that have a segment at all: the mean number of chance segments at score 0 is K n.
    chance = sum(bool(any(model.word_score(w) > 0 for w in set(WORDS.findall(t)))) for t, y in rows if not y)
    words = sum(len(WORDS.findall(t)) for t, y in rows if not y)
    model.log_k = float(np.log((chance + 0.5) / (words + 1)))
    x = np.array([np.log1p(model.evidence(t)) for t, _ in rows])
    y = np.array([k for _, k in rows], float)
    stands = [t / c for t, c in zip(totals or n, n)]
    w = np.where(y == 1, stands[1], stands[0]) / np.mean(stands)
    slope, offset = 1.0, -2.0
    for _ in range(50):  # Newton, with a small ridge so that separable rows keep finite constants
        p = 1 / (1 + np.exp(-(slope * x + offset)))
        g = np.array([(w * (p - y) * x).sum() + 0.5 * slope, (w * (p - y)).sum() + 0.05 * offset])
        r = w * p * (1 - p)
        h = np.array([[(r * x * x).sum() + 0.5, (r * x).sum()], [(r * x).sum(), r.sum() + 0.05]])
        step = np.linalg.solve(h, g)
        slope, offset = slope - np.clip(step[0], -2, 2), offset - np.clip(step[1], -2, 2)
    model.slope, model.offset = float(max(slope, 0.0)), float(offset)
    model._known.clear()
    return model


def fit_toxicity(train: DataFrame, documents: tuple[int, int] = (6000, 2000), max_chars: int = 20_000, seed: int = 2) -> ToxicityModel:
    """Fits the model on a bounded sample of rows with text and toxic: `documents` of label 0 and 1 at most."""
    sample, totals = bounded_sample(train, "toxic", dict(enumerate(documents)), seed, max_chars)
    rows = [(r["text"], int(r["toxic"])) for r in sample.select("text", "toxic").orderBy("toxic", F.xxhash64("text")).toLocalIterator()]
    return fit(rows, (totals.get(0, 0), totals.get(1, 0)))


def score_toxicity(df: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """Adds score, predicted, n_passages and passages (start, end and evidence of each significant passage, in code points).

    A null text counts as empty: no passage, the score of no evidence. Columns of df with these names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    names = ["score", "predicted", "n_passages", "passages"]
    kept = [c for c in df.columns if c not in names or c == text_col]
    df = df.select(*[f"`{c}`" for c in kept])
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("evidence", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                found = [m.passages(t or "")[1] for t in batch.column(kept.index(text_col)).to_pylist()]
                score = [m.probability(sum(e for e, _, _ in f)) for f in found]
                spans = pa.array([[{"start": a, "end": b, "evidence": e} for e, a, b in f] for f in found], span)
                added = [pa.array(score, pa.float64()), pa.array([int(s >= threshold) for s in score], pa.int32()), pa.array([len(f) for f in found], pa.int64()), spans]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*kept, *names])

    kinds = "score double, predicted int, n_passages long, passages array<struct<start:long,end:long,evidence:double>>"
    return df.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), kinds]))
