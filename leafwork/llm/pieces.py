"""SentencePiece BPE encoding and decoding by a prefix table, without the library.

A text's encoding is found from left to right: for each prefix the encoding has exactly one last piece. The
candidates for it are the pieces that an Aho-Corasick automaton finds to end there; a candidate is the right one
if it and the last piece of the prefix that remains before it encode, as a pair, to just themselves. Going back
from the end through the last pieces gives the ids.

Pieces of this kind never contain a word mark behind another character nor a line feed, so texts are cut there
and the ids of a unit are remembered (the number kept has a bound). Where a vocabulary has such pieces, the text
stays whole.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHE_UNITS, CACHE_CHARS, CACHE_PAIRS = 150_000, 48, 400_000


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        c = b[i]
        i += 1
        value |= (c & 127) << shift
        shift += 7
        if c < 128:
            return value, i


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        wire = key & 7
        if wire == 0:
            value, i = _varint(b, i)
        else:
            n = {1: 8, 5: 4}.get(wire)
            if n is None:
                n, i = _varint(b, i)
            value, i = b[i : i + n], i + n
        yield key >> 3, value


def _bad_bytes(e: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (e.end - e.start), e.end


codecs.register_error("leafwork-each-byte", _bad_bytes)


class PieceModel:
    """The vocabulary of a model file: encode(text) gives ids, decode(ids) the text."""

    def __init__(self, model: bytes):
        import struct

        self.pieces: list[str] = []
        kinds: list[int] = []
        scores: list[float] = []
        self.dummy_prefix, self.eos = True, -1
        trainer: dict[int, int | bytes] = {}
        for number, value in _fields(model):
            if number == 1:
                f = dict(_fields(value))
                self.pieces.append(f.get(1, b"").decode())
                scores.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
                kinds.append(f.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                f = dict(_fields(value))
                if f.get(2, b"") or f.get(4, 1):
                    raise ValueError("only models without character map and white-space removal are supported")
                self.dummy_prefix = bool(f.get(3, 1))
        if trainer.get(3) != 2 or USER in kinds or not trainer.get(35):
            raise ValueError("only BPE models with byte fallback and no user-defined pieces are supported")
        self.eos = next(i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == CONTROL and p == "</s>")
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == NORMAL}
        self.score = {p: scores[i] for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == BYTE}
        self.surface = [self._surface(p, k, trainer) for p, k in zip(self.pieces, kinds)]
        self.decimal = [str(i) for i in range(len(self.pieces))]
        self.automaton = ahocorasick.Automaton()
        self._halves: dict[str, tuple[str, str]] = {}
        for p, i in self.ids.items():
            parts, halves = self._merge(p)
            if parts == [p]:
                self.automaton.add_word(p, (len(p), i))
                if halves:
                    self._halves[p] = halves
        self.automaton.make_automaton()
        # Pieces that are not made after their parts, or have such a part, are tested by plain merging.
        self._odd: set[str] = set()
        for p, halves in sorted(self._halves.items(), key=lambda x: len(x[0])):
            if any(h in self._odd or len(h) > 1 and self.score[h] <= self.score[p] for h in halves):
                self._odd.add(p)
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.ids):
            self.cut = re.compile("(?s).+")
        else:
            self.cut = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        self._pairs: dict[int, bool] = {}
        self._units: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def _surface(piece: str, kind: int, trainer: dict) -> str:
        if kind == CONTROL:
            return ""
        if kind == UNKNOWN:
            return trainer.get(44, " ⁇ ".encode()).decode()
        if kind == BYTE:  # a byte above 127 waits as a lone surrogate until its run is complete
            b = int(piece[3:5], 16)
            return chr(b) if b < 128 else chr(0xDC00 + b)
        return piece.replace(MARK, " ")

    def _merge(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Plain merging: the pair with the best score first, the leftmost of equals. Also the two parts merged last."""
        parts, last = list(text), None
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts, last
            last = parts[at], parts[at + 1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _stay_apart(self, p: str, q: str) -> bool:
        """Whether no merge crosses the border of p and q, told from the order in which the two were formed.

        The two parts that meet at the border are taken back in time: the one that was formed last is split, and
        if its inner half and the part opposite form a better piece, that piece would have been made first.
        """
        score, halves = self.score, self._halves
        if p + q in score:
            return False
        while True:
            formed_p, formed_q = halves.get(p), halves.get(q)
            if formed_p is None and formed_q is None:
                return True
            if formed_q is None or formed_p is not None and score[p] < score[q]:
                made, p = score[p], formed_p[1]
                if score.get(p + q, made) > made:
                    return False
            else:  # of equal pieces the left one comes first; and a piece across the border lies left of one in q
                made, q = score[q], formed_q[0]
                crossing = score.get(p + q)
                if crossing is not None and crossing >= made:
                    return False

    def compatible(self, a: int, b: int) -> bool:
        """Whether the text of the two pieces encodes to just these two."""
        key = a << 32 | b
        found = self._pairs.get(key)
        if found is None:
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            p, q = self.pieces[a], self.pieces[b]
            found = self._pairs[key] = self._merge(p + q)[0] == [p, q] if p in self._odd or q in self._odd else self._stay_apart(p, q)
        return found

    def last_pieces(self, unit: str) -> tuple[list[int], list[int]]:
        """For each prefix, the empty one first, length and id of its unique last piece; id -1: a character without a piece."""
        lengths, ids, done = [0], [-1], 0
        pairs, compatible = self._pairs, self.compatible
        for end, (length, i) in self.automaton.iter(unit):  # by end, and there the longest first
            if end < done:
                continue
            while done < end:
                lengths.append(1)
                ids.append(-1)
                done += 1
            before = ids[end + 1 - length]
            if before >= 0:
                fits = pairs.get(before << 32 | i)
                if not (compatible(before, i) if fits is None else fits):
                    continue
            lengths.append(length)
            ids.append(i)
            done += 1
        for _ in range(done, len(unit)):
            lengths.append(1)
            ids.append(-1)
        return lengths, ids

    def unit_ids(self, unit: str) -> tuple[int, ...]:
        """The ids of a unit, recovered backwards from its prefix table."""
        lengths, ids = self.last_pieces(unit)
        end, back = len(unit), []
        while end:
            i = ids[end]
            end -= lengths[end]
            if i < 0:
                back += [self.bytes[b] for b in reversed(unit[end].encode())]
            else:
                back.append(i)
        back.reverse()
        return tuple(back)

    def _remember(self, unit: str) -> tuple[int, ...]:
        """The ids of a unit that is not among the newest; of the older ones, those still in use stay."""
        found = self._older.get(unit)
        if found is None:
            found = self.unit_ids(unit)
        if len(unit) <= CACHE_CHARS:
            if len(self._units) >= CACHE_UNITS:
                self._older, self._units = self._units, {}
            self._units[unit] = found
        return found

    def encode(self, text: str | None, add_eos: bool = True) -> list[int]:
        ids: list[int] = []
        if text:
            text = text.replace(" ", MARK)
            for unit in self.cut.findall(MARK + text if self.dummy_prefix else text):
                found = self._units.get(unit)
                ids += self._remember(unit) if found is None else found
        if add_eos:
            ids.append(self.eos)
        return ids

    def decode(self, ids: list[int]) -> str:
        text = "".join(map(self.surface.__getitem__, ids))
        if self.dummy_prefix and ids:
            first = next((i for i in ids if self.surface[i]), None)
            if first is not None and self.pieces[first].startswith(MARK):
                text = text[1:]
        try:
            text.encode()
        except UnicodeEncodeError:
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "leafwork-each-byte")
        return text


_models: dict[int, PieceModel] = {}


def model_of(model: bytes) -> PieceModel:
    """The model, built once in each Python process."""
    key = hash(model)
    if key not in _models:
        _models[key] = PieceModel(model)
    return _models[key]


def read_model(path: str) -> bytes:
    """The bytes of a model file; half a megabyte, which travels with the tasks so that executors need no such file."""
    with open(path, "rb") as f:
        return f.read()


def tokenize(df: DataFrame, model_path: str, text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Adds n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids array<int> and decoded string to each row.

    A null text counts as the empty text, whose encoding is the end id alone. Rows are handled one by one: order,
    repeated rows and an empty table make no difference. Columns of df with these names are replaced.
    """
    model = df.sparkSession.sparkContext.broadcast(read_model(model_path))
    added = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    if with_ids:
        added += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
    names = [n for n, _ in added]
    kept = [c for c in df.columns if c not in names or c == text_col]
    df = df.select(*[f"`{c}`" for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model_of(model.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                out: list[list] = [[] for _ in added]
                for text in batch.column(kept.index(text_col)).to_pylist():
                    ids = m.encode(text)
                    decoded = m.decode(ids)
                    row = [len(ids), hashlib.sha256(" ".join(map(m.decimal.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), ids, decoded]
                    for o, v in zip(out, row):
                        o.append(v)
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(o, t) for o, (_, t) in zip(out, added))], names=[*kept, *names])

    kinds = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    return df.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), kinds]))
