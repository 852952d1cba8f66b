"""Packing token streams into sequences by order-preserving dynamic programming.

Documents follow one another in a stream per partition, in the order of their ids. Cuts
between sequences are chosen among the ends of documents and sentences so that padding
plus penalties for cutting inside a document are least. The best way to reach a cut is a
minimum over the cuts within one sequence's length before it, which a monotone queue
gives in constant time; lengths without padding are looked up one by one.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapflow.llm.token_count import byte_letters

TOKENIZER = "word_bpe_49k.json"
LENGTH = 4096
END_ID = 2
#: Penalties, in tokens of padding: for a sequence, a cut between two sentences of a
#: document, and one inside a sentence.
PER_SEQUENCE, IN_DOCUMENT, IN_SENTENCE = 8, 2, 64
#: Tokens over which cuts are chosen together; all but the last are final.
STRETCH = 1 << 18
#: Words whose ids a Python worker keeps, some 200 bytes each; more are encoded anew.
KEPT_WORDS = 1_000_000
#: ASCII that is neither letter, digit nor white space.
MARKS = bytes(i for i in range(33, 127) if not chr(i).isalnum())
BYTE_LETTERS = {b: letter for letter, b in byte_letters().items()}


class WordIds(dict):
    """Ids of a word between white space, as little-endian 32-bit numbers.

    The tokenizer never joins text across white space, so that the ids of a text are
    those of its words. Words are split at ASCII white space only.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        ends = [
            i
            for token, i in self.tokenizer.get_vocab().items()
            if token.endswith("</w>") and token[:-4] and not token[:-4].strip(".!?")
        ]
        self.sentence_end = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.sentence_end[ends] = True
        self.model = self.tokenizer.model
        #: Each id as it is written.
        self.raw = [i.to_bytes(4, "little") for i in range(len(self.sentence_end))]

    def __missing__(self, word: bytes) -> bytes:
        if word.isalpha():
            # ASCII letters stand for themselves.
            made = self._raw(self.model.tokenize(word.decode("ascii").lower()))
        elif (core := word.rstrip(MARKS)) and core != word and core[-1:].isalpha() and b"<|" not in word:
            # Marks after a letter are a piece of their own.
            made = self[core] + self[word[len(core) :]]
        else:
            made = self._encoded(word)
        if len(self) >= KEPT_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = made
        return made

    def _raw(self, tokens: list) -> bytes:
        raw = self.raw
        return b"".join([raw[t.id] for t in tokens])

    def _encoded(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        plain = text.lower()
        # Letters below U+0180 are in normal form and one piece, which the model takes in
        # the letters that stand for its bytes; this spares the steps before.
        if plain.isalpha() and max(plain) < "\u0180":
            piece = plain.encode("utf-8").decode("latin-1").translate(BYTE_LETTERS)
            return self._raw(self.model.tokenize(piece))
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([self.raw[i] for i in ids])

    def document(self, text: str | None, end_id: int = END_ID) -> np.ndarray:
        raw = (text or "").encode("utf-8")
        # The tokenizer lowers all letters, but not within the special strings.
        found = (raw if b"<|" in raw else raw.lower()).split()
        ids = b"".join(map(self.__getitem__, found))
        return np.frombuffer(ids + int(end_id).to_bytes(4, "little"), "<u4")


def padding(size: int, length: int = LENGTH) -> int:
    return 0 if size & (size - 1) == 0 else length - size


def choose_cuts(
    places: np.ndarray, penalties: np.ndarray, length: int = LENGTH
) -> tuple[list[int], list[float]]:
    """The best cut before each place, and its cost. `places` ascend from 0, with gaps of
    at most `length`."""
    at = places.tolist()
    own = penalties.tolist()
    index = np.full(at[-1] + 1, -1, np.int64)
    index[places] = np.arange(len(places))
    ends, starts = [], []
    size = 1
    while size < length:
        back = places - size
        hits = np.flatnonzero(index[np.maximum(back, 0)] >= 0)
        hits = hits[back[hits] >= 0]
        ends.append(hits)
        starts.append(index[back[hits]])
        size *= 2
    # The cuts a power of two before each place, place by place.
    ends, starts = np.concatenate(ends), np.concatenate(starts)
    order = np.argsort(ends, kind="stable")
    starts = starts[order].tolist()
    upto = np.searchsorted(ends[order], np.arange(len(at) + 1)).tolist()
    cost, before = [0.0] * len(at), [0] * len(at)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, len(at)):
        here = at[j]
        while here - at[queue[0][1]] > length:
            queue.popleft()
        best, i = queue[0]
        best += length - here
        for k in starts[upto[j] : upto[j + 1]]:
            if cost[k] < best:
                best, i = cost[k], k
        cost[j] = total = best + own[j] + PER_SEQUENCE
        before[j] = i
        key = total + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    return before, cost


class Packer:
    """Packs a stream of documents; gives rows (document, start, length, crc, document's
    tokens, sequence, offset)."""

    def __init__(self, words: WordIds, sequence: int, length: int = LENGTH, end_id: int = END_ID):
        self.words, self.sequence, self.length, self.end_id = words, sequence, length, end_id
        #: Documents not yet packed as a whole: id, ids, tokens packed.
        self.open: list[list] = []
        self.waiting = 0

    def add(self, key, text: str | None) -> Iterator[tuple]:
        ids = self.words.document(text, self.end_id)
        self.open.append([key, ids, 0])
        self.waiting += len(ids)
        if self.waiting >= STRETCH:
            yield from self._pack(last=False)

    def finish(self) -> Iterator[tuple]:
        if self.open:
            yield from self._pack(last=True)

    def _places(self, last: bool) -> tuple[np.ndarray, np.ndarray]:
        ids = np.concatenate([x[1][x[2] :] for x in self.open])
        penalty = np.full(len(ids) + 1, np.inf)
        penalty[1:][self.words.sentence_end[ids]] = IN_DOCUMENT
        penalty[np.cumsum([len(x[1]) - x[2] for x in self.open])] = 0
        penalty[0] = 0
        if last:
            # The rest of a stream may be cut anywhere, to lengths without padding.
            tail = penalty[max(1, len(ids) - 2 * self.length) :]
            tail[np.isinf(tail)] = IN_SENTENCE
        places = np.flatnonzero(np.isfinite(penalty))
        for i in np.flatnonzero(np.diff(places) > self.length // 2):
            inside = np.arange(places[i] + self.length // 2, places[i + 1], self.length // 2)
            penalty[inside] = IN_SENTENCE
        places = np.flatnonzero(np.isfinite(penalty))
        return places, penalty[places]

    def _pack(self, last: bool) -> Iterator[tuple]:
        places, penalties = self._places(last)
        before, cost = choose_cuts(places, penalties, self.length)
        end = len(places) - 1
        if not last:
            # What follows is unknown: stop at the cheapest cut of the last sequence's
            # length, and pack the rest with the next stretch.
            near = np.flatnonzero(places >= places[-1] - self.length)
            end = int(near[np.argmin(np.array(cost)[near])])
        cuts = [end]
        while cuts[-1]:
            cuts.append(before[cuts[-1]])
        yield from self._pieces([int(places[i]) for i in reversed(cuts)])

    def _pieces(self, cuts: list[int]) -> Iterator[tuple]:
        at, number = 0, 0
        done = 0
        for x in self.open:
            key, ids, start = x
            while start < len(ids) and number < len(cuts) - 1:
                size = min(len(ids) - start, cuts[number + 1] - at)
                crc = zlib.crc32(ids[start : start + size].tobytes())
                yield key, start, size, crc, len(ids), self.sequence, at - cuts[number]
                at, start = at + size, start + size
                if at == cuts[number + 1]:
                    number += 1
                    self.sequence += 1
            x[2] = start
            done += start == len(ids)
        self.open = self.open[done:]
        self.waiting -= at


_LOADED: dict[str, WordIds] = {}


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    length: int = LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of documents in sequences of at most `length` tokens.

    Returns `key`, start, length, ids_crc32, doc_tokens, sequence_id and offset. A null
    or empty text is its end id alone. Every row is a document of its own, also repeated
    ones and those without an id; within a partition they come by id. No row moves to
    another partition, so the work needs no shuffle. Other columns are not read.
    """
    if length < 2 or length & (length - 1):
        raise ValueError("the length must be a power of two")
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        path = public_tokenizers.path(tokenizer)
        if path not in _LOADED:
            _LOADED[path] = WordIds(path)
        packer = Packer(_LOADED[path], TaskContext.get().partitionId() << 40, length, end_id)
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for at in range(0, len(batch), 256):
                some = batch.slice(at, 256)
                rows = zip(some.column(0).to_pylist(), some.column(1).to_pylist())
                yield _batch([p for k, t in rows for p in packer.add(k, t)], names, id_type)
        if id_type is not None:
            yield _batch(list(packer.finish()), names, id_type)

    rows = docs.select(key, text).sortWithinPartitions(key, F.xxhash64(text))
    return rows.mapInArrow(
        run, f"`{key}` {kind}, " + ", ".join(f"{n} long" for n in names[1:])
    )


def _batch(rows: list[tuple], names: list[str], id_type: pa.DataType) -> pa.RecordBatch:
    columns: Iterable = zip(*rows) if rows else [[] for _ in names]
    kinds = [id_type] + [pa.int64()] * (len(names) - 1)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names
    )
