"""SentencePiece encoding and decoding by a streaming Viterbi search.

The best segmentation is the one with the largest sum of piece scores; among equal
sums, at each boundary the longest last piece wins. Only the scores of the last
``longest`` boundaries are held, since no piece reaches back further. Back pointers are
held from the last boundary through which all surviving paths pass; as soon as they
meet at a later one, the ids up to there are committed and forgotten.

A boundary that no piece spans is one where all paths meet, whatever the scores. Texts are
cut there first, and the stretches between such boundaries, seldom longer than a word, are
searched many at a time in arrays, where the window is the whole stretch: up to four times
the longest piece. Longer stretches, and those with a character that has no piece, go
through the streaming search one by one. Both give the ids that the streaming search gives
over the uncut text.

Text becomes pieces after one space is put in front and every space is written as the
mark U+2581. A character without a piece is written as its UTF-8 bytes. So is a mark
that stands in the text itself, which makes decoding exact for every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.carried import Carried, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Stand for a mark of the text itself until it is written as bytes, and for a cut; no text holds a lone surrogate.
OWN = "\ud800"
CUT = "\ud801"
MEMO = 60_000


@dataclass
class Vocabulary(Carried):
    scores: dict[str, float]
    ids: dict[str, int]
    texts: list[bytes]
    byte_ids: list[int]
    longest: int
    unknown: float
    trie: dict[str, tuple[dict, float | None]]
    single: frozenset[str]


def load(model_file: str = MODEL) -> Vocabulary:
    """Ordinary pieces and byte pieces of a model file; control and unused pieces match no text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    scores, ids, texts, byte_ids = {}, {}, [], [-1] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            texts.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            texts.append(b"")
        else:
            scores[piece], ids[piece] = model.get_score(i), i
            texts.append(piece.replace(MARK, " ").encode())
    if -1 in byte_ids:
        raise ValueError("the model has no byte pieces")
    return make(scores, ids, texts, byte_ids)


def make(scores: dict[str, float], ids: dict[str, int], texts: list[bytes], byte_ids: list[int]) -> Vocabulary:
    """A vocabulary with the trie of its pieces; an unknown character scores 10 less than any piece."""
    trie: dict = {}
    for piece, score in scores.items():
        node = trie
        for c in piece[:-1]:
            node = node.setdefault(c, ({}, None))[0]
        node[piece[-1]] = (node.get(piece[-1], ({}, None))[0], score)
    return Vocabulary(scores, ids, texts, byte_ids, max(map(len, scores), default=1), min(scores.values(), default=0.0) - 10, trie, frozenset(p for p in scores if len(p) == 1))


class _Arrays:
    """The same search for many short stretches of text side by side."""

    def __init__(self, v: Vocabulary):
        self.v = v
        keys, self.score, self.id = [], [np.nan], [-1]
        waiting = [(0, v.trie, "")]
        while waiting:
            number, node, so_far = waiting.pop()
            for c, (below, gain) in node.items():
                keys.append((number << 21 | ord(c), len(self.score)))
                waiting.append((len(self.score), below, so_far + c))
                self.score.append(np.nan if gain is None else gain)
                self.id.append(-1 if gain is None else v.ids[so_far + c])
        # Characters of the pieces are numbered from 1; 0 is every other one.
        letters = sorted({key & 0x1FFFFF for key, _ in keys})
        self.letter = np.zeros(0x110000, dtype=np.int32)
        self.letter[letters] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        kind = np.int32 if self.width * len(self.score) < 2**31 else np.int64
        pairs = sorted(((key >> 21) * self.width + int(self.letter[key & 0x1FFFFF]), child) for key, child in keys)
        self.key = np.array([key for key, _ in pairs], dtype=kind)
        self.child = np.array([child for _, child in pairs], dtype=kind)
        self.score, self.id = np.array(self.score), np.array(self.id, dtype=np.int32)
        self.ends = ~np.isnan(self.score)

    def _next(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Child nodes, 0 where there is none."""
        if not len(self.key):
            return np.zeros(len(node), dtype=np.int32)
        key = node * self.key.dtype.type(self.width) + letter
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.child[at], 0)

    def encode(self, units: list[str]) -> dict[str, bytes]:
        """Ids of each unit; units with a character that has no piece are left out."""
        code = self.letter[np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        size = np.array([len(u) for u in units])
        first = np.cumsum(size) - size
        unit = np.repeat(np.arange(len(units)), size)
        place = np.arange(len(code)) - first[unit]
        # A unit of n characters has n + 1 boundaries.
        score = np.full(len(code) + len(units), -np.inf)
        score[first + np.arange(len(units))] = 0.0
        length, ident = np.zeros(len(score), dtype=np.int64), np.zeros(len(score), dtype=np.int32)
        # Places in order of their distance from the unit's start; what is left out keeps the order.
        at = np.argsort(place.astype(np.int16), kind="stable")
        node = np.zeros(len(code), dtype=self.key.dtype)
        known = np.zeros(len(code), dtype=bool)
        places = np.arange(int(size.max(initial=0)) + 1)
        found = []  # by length: boundaries where a piece begins, its gain and id, and where each place's begin
        for k in range(1, self.v.longest + 1):
            node = self._next(node, code[at + k - 1])
            is_piece = self.ends[node]
            begin, end = at[is_piece], node[is_piece]
            if k == 1:
                known[begin] = True
            cuts = np.searchsorted(place[begin], places)
            found.append((begin + unit[begin], self.score[end], self.id[end], cuts))
            goes_on = node > 0
            goes_on &= place[at] + k < size[unit[at]]
            at, node = at[goes_on], node[goes_on]
        for i in range(int(size.max(initial=0))):
            for k, (begin, gain, piece, cuts) in enumerate(found, 1):
                part = slice(cuts[i], cuts[i + 1])
                if part.start == part.stop:
                    continue
                begin = begin[part]
                new = score[begin] + gain[part]
                better = new > score[begin + k]
                end = begin[better] + k
                score[end], length[end], ident[end] = new[better], k, piece[part][better]
        whole = np.ones(len(units), dtype=bool)
        whole[unit[~known]] = False
        low, now = first + np.arange(len(units)), first + size + np.arange(len(units))
        steps, open_ = [], np.flatnonzero(whole & (size > 0))
        while len(open_):
            steps.append((open_, ident[now[open_]]))
            now[open_] -= length[now[open_]]
            open_ = open_[now[open_] > low[open_]]
        count = np.zeros(len(units), dtype=np.int64)
        for which, _ in steps:
            count[which] += 1
        ends = np.cumsum(count)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype="<i4")
        for back, (which, piece) in enumerate(steps, 1):
            out[ends[which] - back] = piece
        raw, cut = out.tobytes(), [0, *(ends * 4).tolist()]
        return {u: raw[cut[i] : cut[i + 1]] for i, u in enumerate(units) if whole[i]}


class Encoder:
    """Encodes texts.

    A place between two characters that stand side by side in no piece is a boundary of
    every path, so what lies between such places is encoded by itself and remembered.
    Short stretches are searched many at a time in arrays, longer ones by :meth:`viterbi`.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = v = vocabulary
        self.most_held = 0
        inner = {p[i : i + 2] for p in v.scores for i in range(len(p) - 1)}
        self.alone = [c for c in ("\n", "\t", OWN) if not any(c in p for p in v.scores)]
        self.cut_at_mark = not any(pair[1] == MARK != pair[0] for pair in inner)
        self.memo: dict[str, bytes] = {}
        self.arrays = _Arrays(v)

    def split(self, marked: str) -> list[str]:
        """Stretches between places that no piece spans."""
        if self.cut_at_mark:
            marked = marked.replace(MARK, CUT + MARK)
            while MARK + CUT + MARK in marked:
                marked = marked.replace(MARK + CUT + MARK, MARK + MARK)
        for c in self.alone:
            if c in marked:
                marked = marked.replace(c, CUT + c + CUT)
        return marked.split(CUT)

    def learn(self, units: set[str]) -> None:
        """Encodes what the memo lacks of ``units``; the short ones many at a time."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        missing = [u for u in units if u not in self.memo]
        short = [u for u in missing if len(u) <= 4 * self.v.longest]
        for low in range(0, len(short), 1 << 14):
            self.memo.update(self.arrays.encode(short[low : low + (1 << 14)]))
        for unit in missing:
            if unit not in self.memo:
                self.memo[unit] = b"".join(pack(f"<{len(part)}i", *part) for part in self.viterbi(unit))

    def viterbi(self, chars: str) -> Iterator[list[int]]:
        """Ids of the best segmentation of ``chars``, committed as the search goes.

        ``score`` and ``start`` hold, for the boundaries from ``done`` to the furthest that a
        piece can reach, the best sum and the start of the last piece.
        """
        root, unknown, longest, single = self.v.trie, self.v.unknown, self.v.longest, self.v.single
        step = 4 * longest
        n, done, none = len(chars), 0, -np.inf
        score, start = [none] * (min(n, step) + longest + 1), [0] * (min(n, step) + longest + 1)
        score[0] = 0.0
        for i in range(n):
            at = i - done
            if at and at % step == 0:
                self.most_held = max(self.most_held, at)
                ends = {j for j in range(at, at + longest) if score[j] > none}
                meet = self._meet(start, ends, done)
                if meet:
                    yield self._ids(chars, start, done, meet)
                    score, start = score[meet:], start[meet:]
                    done += meet
                    at -= meet
                more = at + step + longest + 1 - len(score)
                score += [none] * more
                start += [0] * more
            here, node, j = score[at], root, at
            if chars[i] not in single and here + unknown > score[at + 1]:
                score[at + 1], start[at + 1] = here + unknown, i
            for c in chars[i : i + longest]:
                found = node.get(c)
                if found is None:
                    break
                node, gain = found
                j += 1
                # A later start is a shorter last piece: it must be better to win.
                if gain is not None and here + gain > score[j]:
                    score[j], start[j] = here + gain, i
        yield self._ids(chars, start, done, n - done)

    @staticmethod
    def _meet(start: list[int], ends: set[int], done: int) -> int:
        """The last boundary, counted from ``done``, that every path to one of ``ends`` passes."""
        while len(ends) > 1:
            last = max(ends)
            ends.remove(last)
            ends.add(start[last] - done)
        return ends.pop()

    def _ids(self, chars: str, start: list[int], done: int, high: int) -> list[int]:
        """Ids of the path to the boundary ``high``, counted from ``done``."""
        out, j, get = [], done + high, self.v.ids.get
        while j > done:
            i = start[j - done]
            found = get(chars[i:j])
            if found is None:
                raw = (MARK if chars[i:j] == OWN else chars[i:j]).encode()
                out.extend(self.v.byte_ids[b] for b in reversed(raw))
            else:
                out.append(found)
            j = i
        out.reverse()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers; an empty text has none."""
        units = [self.split(MARK + t.replace(MARK, OWN).replace(" ", MARK)) if t else [] for t in texts]
        self.learn(set().union(*units))
        get = self.memo.__getitem__
        return [b"".join(map(get, u)) for u in units]


def decode(texts: list[bytes], ids: np.ndarray) -> str:
    """The text of ids, given the text of every piece; ids that no encoding gave may hold broken bytes, which become U+FFFD."""
    raw = b"".join(map(texts.__getitem__, ids.tolist()))
    return raw[1:].decode(errors="replace") if raw.startswith(b" ") else raw.decode(errors="replace")


def _encoded(vocabulary: Vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns of ``batches`` with ids in place of _text."""
    encoder = Encoder(vocabulary)
    for batch in batches:
        texts, rest = batch.column("_text"), [c for c in batch.schema.names if c != "_text"]
        for low in range(0, batch.num_rows, 100):
            raw = encoder.encode([t or "" for t in texts.slice(low, 100).to_pylist()])
            offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(raw), dtype="<i4"))
            ids = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(low, 100) for c in rest], ids], [*rest, "ids"])


def _decoded(texts: list[bytes], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches`` and the text of their ids."""
    for batch in batches:
        for low in range(0, batch.num_rows, 100):
            part = batch.slice(low, 100)
            rows = [decode(texts, ids.values.to_numpy()) if ids.is_valid else None for ids in part.column("ids")]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, pa.string())], [*part.schema.names, "decoded"])


def _mapped(known, work):
    """A task's work with a broadcast value; what it held is free when memory is given back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(known.value, batches)
        tidy()

    return run


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def encode_texts(docs: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of ``docs`` and ids (array of int) of the whole text; a null or empty text has no ids."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(*keep, F.col("text").alias("_text"))
    return rows.mapInArrow(_mapped(known, _encoded), _schema(docs.select(*keep)) + ", ids array<int>")


def decode_ids(df: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Add ``decoded``, the text of ``ids``; null ids give null."""
    known = df.sparkSession.sparkContext.broadcast(vocabulary.texts)
    return df.mapInArrow(_mapped(known, _decoded), _schema(df) + ", decoded string")


def round_trip(docs: DataFrame, model_file: str = MODEL) -> DataFrame:
    """(doc_id, ids, decoded) of every row: encoded, then decoded from the ids alone; null text decodes as empty.

    Both are done by one worker a task, as :func:`encode_texts` and then :func:`decode_ids` do them.
    """
    known = docs.sparkSession.sparkContext.broadcast(load(model_file))
    rows = docs.select("doc_id", F.col("text").alias("_text"))

    def there_and_back(vocabulary: Vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(vocabulary.texts, _encoded(vocabulary, batches))

    schema = _schema(docs.select("doc_id")) + ", ids array<int>, decoded string"
    return rows.mapInArrow(_mapped(known, there_and_back), schema)
