"""Quality classifier: a byte-level convolutional network in numpy.

Every byte of a text becomes a symbol: its value, and whether the four bytes at it repeat those at one to 24 bytes
before. Learned filters of WIDTH symbols run over all positions. The text is covered by chunks of 2 * HALF bytes,
each overlapping the next by half; in a chunk a filter's activation is averaged, over the document its chunks are
max-pooled, and the pooled activations are combined into one probability of good quality.

The network is fitted on a bounded sample of labelled rows; scoring reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.llm.common import bounded_sample

SYMBOLS, WIDTH, FILTERS, HALF, LAGS = 512, 4, 12, 128, 24
BLOCK = 512 * HALF


def symbols(data: bytes) -> np.ndarray:
    """Byte values, plus 256 where the four bytes from there repeat those at a lag of 1 to LAGS."""
    b = np.frombuffer(data, np.uint8)
    out = b.astype(np.int64)
    n = len(b) - 3
    if n > 1:
        four = b[:n].astype(np.uint32)
        for k in range(1, 4):
            four |= b[k : k + n].astype(np.uint32) << np.uint32(8 * k)
        same = np.zeros(n, bool)
        for lag in range(1, min(LAGS, n - 1) + 1):
            same[lag:] |= four[lag:] == four[:-lag]
        out[:n][same] += 256
    return out


@dataclass
class QualityNetwork:
    filters: np.ndarray  # WIDTH x SYMBOLS x FILTERS
    bias: np.ndarray
    weights: np.ndarray
    offset: float

    def activations(self, s: np.ndarray) -> np.ndarray:
        """Filter activations at each position of the symbols; behind the end there is nothing."""
        h = self.filters[0].take(s, axis=0)
        for k in range(1, WIDTH):
            h[:-k or None][: max(0, len(s) - k)] += self.filters[k].take(s[k:], axis=0)
        h += self.bias
        np.maximum(h, 0, out=h)
        return h

    def pooled(self, data: bytes) -> np.ndarray:
        """Max over the chunks of the mean activation in each; zeros for an empty text."""
        best = np.zeros(FILTERS, np.float32)
        if not data:
            return best
        carried = None
        for start in range(0, len(data), BLOCK):  # blocks of whole half-chunks, with the symbols of a little before and after
            before = min(start, LAGS)
            s = symbols(data[start - before : start + BLOCK + WIDTH + 2])[before:]
            h = self.activations(s)[: min(BLOCK, len(data) - start)]
            edges = np.arange(0, len(h), HALF)
            sums = np.add.reduceat(h, edges, axis=0)
            sizes = np.diff(np.append(edges, len(h))).astype(np.float32)
            if carried is not None:
                sums, sizes = np.concatenate([carried[0][None], sums]), np.append(carried[1], sizes)
            if len(sums) > 1:
                best = np.maximum(best, ((sums[:-1] + sums[1:]) / (sizes[:-1] + sizes[1:])[:, None]).max(axis=0))
            elif len(data) <= HALF:
                best = sums[0] / sizes[0]
            carried = sums[-1], np.float32(sizes[-1])
        return best

    def score(self, text: str | None) -> float:
        z = float(self.pooled((text or "").encode()) @ self.weights + self.offset)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list[tuple[str, int]], rounds: int = 8, seed: int = 10, rate: float = 0.02) -> QualityNetwork:
    """Trains on (text, label) rows by Adam; both classes weigh the same."""
    rng = np.random.default_rng(seed)
    net = QualityNetwork(rng.normal(0, 0.1, (WIDTH, SYMBOLS, FILTERS)).astype(np.float32), np.full(FILTERS, 0.02, np.float32), rng.normal(0, 0.3, FILTERS).astype(np.float32), 0.0)
    n = [sum(y == k for _, y in rows) for k in (0, 1)]
    if not n[0] or not n[1]:  # with one class only there is nothing to tell apart
        net.weights[:] = 0
        net.offset = -3.0 if n[0] else 3.0
        return net
    data = [(symbols(t.encode()), y) for t, y in rows if t]
    params = [net.filters, net.bias, net.weights, np.zeros(1, np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(rounds):
        order = rng.permutation(len(data))
        for at in range(0, len(order), 16):
            grads = [np.zeros_like(p) for p in params]
            for i in order[at : at + 16]:
                s, y = data[i]
                h = net.activations(s)
                edges = np.arange(0, len(s), HALF)
                sums = np.add.reduceat(h, edges, axis=0)
                sizes = np.diff(np.append(edges, len(s))).astype(np.float32)
                if len(sums) > 1:
                    sums, sizes = sums[:-1] + sums[1:], sizes[:-1] + sizes[1:]
                means = sums / sizes[:, None]
                chunk = means.argmax(axis=0)
                pooled = means.max(axis=0)
                z = float(np.clip(pooled @ net.weights + params[3][0], -30, 30))
                d = (1 / (1 + np.exp(-z)) - y) * 0.5 * len(rows) / n[y] / 16
                grads[2] += d * pooled
                grads[3] += d
                for c in np.unique(chunk):  # only a filter's best chunk gets its gradient
                    f = np.flatnonzero(chunk == c)
                    a, b = c * HALF, min(len(s), c * HALF + int(sizes[c]))
                    g = (h[a:b, f] > 0) * (d * net.weights[f] / sizes[c])
                    grads[1][f] += g.sum(axis=0)
                    for k in range(WIDTH):
                        sym = s[a + k : b + k]
                        for j, column in zip(f, g.T):
                            grads[0][k, :, j] += np.bincount(sym, column[: len(sym)], SYMBOLS)
            step += 1
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (1 - 0.8 * epoch / rounds) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            net.offset = float(params[3][0])
    return net


def fit_quality(train: DataFrame, documents_per_label: int = 700, max_chars: int = 12_000, seed: int = 10) -> QualityNetwork:
    """Trains on a bounded sample of rows with text and quality (documents_per_label of each label at most)."""
    sample, _ = bounded_sample(train, "quality", documents_per_label, seed, max_chars)
    sample = sample.select("text", "quality")
    rows = [(r["text"], int(r["quality"])) for r in sample.orderBy("quality", F.xxhash64("text")).toLocalIterator()]
    return fit(rows)


def score_quality(df: DataFrame, network: QualityNetwork, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """Adds score (probability of label 1) and predicted (1 from the threshold on) to each row.

    A null text counts as empty and gets the score of no activation. Columns of df with these names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(network)
    kept = [c for c in df.columns if c not in ("score", "predicted") or c == text_col]
    df = df.select(*[f"`{c}`" for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                score = [shared.value.score(t) for t in batch.column(kept.index(text_col)).to_pylist()]
                added = pa.array(score, pa.float64()), pa.array([int(s >= threshold) for s in score], pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*kept, "score", "predicted"])

    return df.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), "score double, predicted int"]))
