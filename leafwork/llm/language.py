"""Language identification by language-bitmask n-gram filters.

One Bloom filter for each language, bit-sliced: a slot holds a word with one bit for each language (a word for each
64 of them where there are more), so that the AND of an n-gram's slots gives all languages that contain it at once. A
text's hits are counted for each language, corrected for the filters' false positives, and the language with the most wins.

N-grams are five bytes of the lower-cased UTF-8 text. The model is fitted on a bounded sample of the training rows
(documents_per_language rows of max_chars code points at most for each language); prediction reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.llm.common import bounded_sample

GRAM = 5
SLOT_BITS = 20
HASHES = 3
#: Languages in a word of a slot.
LANGUAGES = 64
#: Odd multipliers of the hash functions: fixed values.
_MULTIPLIERS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
BLOCK = 1 << 18


def grams(data: np.ndarray) -> np.ndarray:
    """The five-byte windows of the bytes, as numbers."""
    if len(data) < GRAM:
        return np.zeros(0, np.uint64)
    x = data.astype(np.uint64)
    n = len(x) - GRAM + 1
    g = x[:n].copy()
    for k in range(1, GRAM):
        g |= x[k : k + n] << np.uint64(8 * k)
    return g


@dataclass
class LanguageFilters:
    languages: list[str]
    slots: list[np.ndarray]
    false_rate: np.ndarray
    fallback: str

    @classmethod
    def fit(cls, texts: dict[str, list[str]], most_grams: int = 60_000, least_share: float = 0.2) -> LanguageFilters:
        """Puts into each language's filter its commonest n-grams (most_grams at most, seen twice or more) that are
        at least least_share times as frequent in it as in the language where they are most frequent."""
        languages = sorted(texts)
        kind = next(t for bits, t in ((8, np.uint8), (16, np.uint16), (32, np.uint32), (64, np.uint64)) if min(len(languages), LANGUAGES) <= bits)
        counted = []
        for lang in languages:
            g, n = np.unique(grams(np.frombuffer(" \n ".join(texts[lang]).lower().encode(), np.uint8)), return_counts=True)
            counted.append((g, n, max(1, n.sum())))
        every = np.unique(np.concatenate([g for g, _, _ in counted])) if counted else np.zeros(0, np.uint64)
        best = np.zeros(len(every))
        for g, n, total in counted:
            at = np.searchsorted(every, g)
            best[at] = np.maximum(best[at], n / total)
        slots = [np.zeros(1 << SLOT_BITS, kind) for _ in range(0, max(1, len(languages)), LANGUAGES)]
        for bit, (g, n, total) in enumerate(counted):
            own = np.flatnonzero((n >= 2) & (n / total >= least_share * best[np.searchsorted(every, g)]))
            own = own[np.argsort(-n[own], kind="stable")[:most_grams]]
            for m in _MULTIPLIERS:
                slots[bit // LANGUAGES][(g[own] * m) >> np.uint64(64 - SLOT_BITS)] |= kind(1 << bit % LANGUAGES)
        full = np.array([np.count_nonzero(slots[b // LANGUAGES] & kind(1 << b % LANGUAGES)) / (1 << SLOT_BITS) for b in range(len(languages))])
        fallback = max(languages, key=lambda x: (len(texts[x]), x)) if languages else "und"
        return cls(languages, slots, full**HASHES, fallback)

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text the number of its n-grams and, by language, of those that its filter contains."""
        data = [t.lower().encode() for t in texts]
        hits, totals = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        at = 0
        while at < len(data):  # short texts in one block, a long one in blocks that overlap
            upto, size = at + 1, len(data[at])
            while upto < len(data) and size + len(data[upto]) + GRAM <= BLOCK:
                size += len(data[upto]) + GRAM
                upto += 1
            if upto == at + 1:
                for start in range(0, max(1, len(data[at])), BLOCK):
                    piece = np.frombuffer(data[at][start : start + BLOCK + GRAM - 1], np.uint8)
                    masks = self._masks(grams(piece))
                    totals[at] += len(masks[0])
                    hits[at] += [np.count_nonzero(masks[b // LANGUAGES] & masks[0].dtype.type(1 << b % LANGUAGES)) for b in range(len(self.languages))]
            else:
                buffer = np.frombuffer(b"\0\0\0\0\0".join(data[at:upto]) + b"\0" * GRAM, np.uint8)
                masks = self._masks(grams(buffer))
                starts = np.cumsum([0, *(len(d) + GRAM for d in data[at:upto])])
                n = np.maximum(0, np.array([len(d) for d in data[at:upto]]) - GRAM + 1)
                inside = np.repeat(np.tile([True, False], upto - at), np.stack([n, np.diff(starts) - n], 1).ravel())
                masks = [np.append(np.where(inside[: len(m)], m, 0), np.zeros(1, m.dtype)) for m in masks]
                totals[at:upto] = n
                for b in range(len(self.languages)):
                    hits[at:upto, b] = np.add.reduceat((masks[b // LANGUAGES] >> masks[0].dtype.type(b % LANGUAGES)) & masks[0].dtype.type(1), starts[:-1], dtype=np.int64)
            at = upto
        return totals, hits

    def _masks(self, g: np.ndarray) -> list[np.ndarray]:
        at = [(g * m) >> np.uint64(64 - SLOT_BITS) for m in _MULTIPLIERS]
        return [np.bitwise_and.reduce([slots[i] for i in at]) for slots in self.slots]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text: hits beyond the expected false ones, as a share of all languages' hits."""
        totals, hits = self.count([t or "" for t in texts])
        true = np.maximum(0, (hits - totals[:, None] * self.false_rate) / np.maximum(1e-9, 1 - self.false_rate))
        out = []
        for text, row in zip(texts, true):
            if text is None or not any(map(str.isalpha, text)) or not self.languages:
                out.append(("und", 0.0))
            elif row.sum() <= 0:
                out.append((self.fallback, 0.0))
            else:
                best = int(row.argmax())
                out.append((self.languages[best], float(row[best] / row.sum())))
        return out


def fit_language_filters(train: DataFrame, documents_per_language: int = 1500, max_chars: int = 20_000, seed: int = 6) -> LanguageFilters:
    """Fits the filters on a bounded sample of rows with text and lang, for all languages."""
    sample, _ = bounded_sample(train, "lang", documents_per_language, seed, max_chars)
    sample = sample.select("lang", "text")
    texts: dict[str, list[str]] = {}
    for r in sample.orderBy("lang", F.xxhash64("text")).toLocalIterator():
        texts.setdefault(r["lang"], []).append(r["text"])
    return LanguageFilters.fit(texts)


def identify_language(df: DataFrame, model: LanguageFilters, text_col: str = "text") -> DataFrame:
    """Adds lang_pred and score to each row; `und` with score 0 where the text is null or has no letter.

    With letters but no known n-gram it is the language with most training rows, with score 0. Columns of df with
    these names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c not in ("lang_pred", "score") or c == text_col]
    df = df.select(*[f"`{c}`" for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                found = shared.value.predict(batch.column(kept.index(text_col)).to_pylist())
                added = pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*kept, "lang_pred", "score"])

    return df.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), "lang_pred string, score double"]))
