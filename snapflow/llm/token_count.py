"""Token counts: exact at every prefix, by dynamic programming over the text.

In a byte-pair encoding the encoding of a prefix is settled by its last token: of all
vocabulary entries that end the prefix exactly one may follow the last token of what
lies before it, namely where encoding the two together gives these two again. So
count[i] = count[i - len(t)] + 1, from left to right, with a table per chunk of text
between spaces. Of a table only the last entry, the chunk's count, is kept, since chunks
repeat. A text is then a row of chunks with running totals. A prefix that ends within a
piece is a total plus the count of the pieces at its end, which are split and encoded
again; a cut to a budget does so once per character it goes back.
"""

from __future__ import annotations

import json
from bisect import bisect_left

import ahocorasick
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from snapflow.llm.common import map_slices

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
#: Counts kept by a Python worker, of chunks and of pieces each, some 150 bytes an entry.
#: More are made anew, so memory is bounded.
KEPT = 500_000

#: The split before the merges, as the file names it (`use_regex` of ByteLevel). Fixed.
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: A space that does not stand between two other characters than white space.
UNEVEN = regex.compile(r"^ | (?=\p{White_Space}|$)")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Kept(dict):
    """What a function gives for short texts, up to KEPT of them."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, text: str) -> int:
        made = self.make(text)
        if len(self) >= KEPT:
            self.clear()
        if len(text) <= 64:
            self[text] = made
        return made


class PrefixTokenizer:
    """Counts of tokens at prefixes, for a byte-level BPE file of `tokenizers`."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.vocab = {raw(t) for t in spec["model"]["vocab"] if all(c in letters for c in t)}
        self.merge = {a + b: (a, b) for a, b in self.rank}
        names = sorted(self.vocab, key=lambda t: self.rank_of(t))
        number = {t: i for i, t in enumerate(names)}
        self.parts = [
            (number[m[0]], number[m[1]]) if (m := self.merge.get(t)) else None for t in names
        ]
        self.made = [self.rank_of(t) for t in names]
        self.joined = {
            number[a] * len(names) + number[b]: rank for (a, b), rank in self.rank.items()
        }
        self.size = len(names)
        self.ends_with = ahocorasick.Automaton()
        for t, i in number.items():
            self.ends_with.add_word(t.decode("latin-1"), (i, len(t)))
        self.ends_with.make_automaton()
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_split = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
            if self.special
            else None
        )
        self._follows: dict[int, bool] = {}
        self._chunks = Kept(lambda chunk: sum(map(self._pieces.__getitem__, SPLIT.findall(chunk))))
        self._pieces = Kept(lambda piece: self.table(piece.encode("utf-8"))[-1])

    def rank_of(self, token: bytes) -> int:
        """The rank of the merge that makes a token; -1 for a single byte."""
        return self.rank[self.merge[token]] if token in self.merge else -1

    def follows(self, before: int, token: int) -> bool:
        """Whether `token` stays apart from `before` when both are encoded together.

        Merges are undone on both sides of the seam, latest first. The two stay apart
        unless at some time the parts at the seam would have merged before the next
        merge beside them; of equal merges the left one comes first.
        """
        left, right, until, known = before, token, len(self.rank), None
        while known is None:
            if self.joined.get(left * self.size + right, until) < until:
                known = False
            elif (made := self.made[left]) > self.made[right]:
                left, until = self.parts[left][1], made
            elif self.parts[right]:
                right, until = self.parts[right][0], self.made[right] + 1
            else:
                known = True
        if len(self._follows) >= 2 * KEPT:
            self._follows.clear()
        self._follows[before * self.size + token] = known
        return known

    def table(self, piece: bytes) -> list[int]:
        """Tokens of each prefix of a piece that is not split, by its length in bytes."""
        size, known, follows = self.size, self._follows.get, self.follows
        counts, last, done = [0], [0], -1
        # Of each end, the entries that end there, longest first.
        for end, (token, length) in self.ends_with.iter(piece.decode("latin-1")):
            if end > done:
                start = end + 1 - length
                if start:
                    before = last[start]
                    fits = known(before * size + token)
                    if fits is None:
                        fits = follows(before, token)
                    if not fits:
                        continue
                counts.append(counts[start] + 1)
                last.append(token)
                done = end
        if len(counts) <= len(piece):
            raise ValueError(f"no token ends {piece[:len(counts)]!r}")
        return counts

    def pieces(self, text: str) -> list[str]:
        """The text as it is split before merging; special strings are pieces."""
        if self.special_split is None or not any(s in text for s in self.special):
            return SPLIT.findall(text)
        found = []
        for part in self.special_split.split(text):
            found += [part] if part in self.special else SPLIT.findall(part)
        return found

    def tokens(self, piece: str) -> int:
        return 1 if piece in self.special else self._pieces[piece]

    def chunk_counts(self, text: str) -> list[int] | None:
        """Tokens of each chunk of a text that is cut before its spaces.

        No piece crosses a single space between two other characters, so a chunk's
        tokens are its own. None where a space stands otherwise, or at special strings.
        """
        if "\0" in text or UNEVEN.search(text) or any(s in text for s in self.special):
            return None
        first, *rest = text.replace(" ", "\0 ").split("\0")
        return [self._chunks[first], *map(self._chunks.__getitem__, rest)]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        counts = self.chunk_counts(text)
        if counts is not None:
            return sum(counts)
        return sum(map(self.tokens, self.pieces(text)))

    def index(self, text: str | None) -> PrefixIndex:
        return PrefixIndex(self, text or "")


class PrefixIndex:
    """The counts of all prefixes of one text, in characters."""

    def __init__(self, tokenizer: PrefixTokenizer, text: str):
        self.tokenizer, self.text = tokenizer, text
        self.ends, self.totals = [0], [0]
        for piece in tokenizer.pieces(text):
            self.ends.append(self.ends[-1] + len(piece))
            self.totals.append(self.totals[-1] + tokenizer.tokens(piece))

    def count_at(self, length: int) -> int:
        """Tokens of the first `length` characters."""
        if length == self.ends[-1]:
            return self.totals[-1]
        # At the end the last piece may join the one before it, which starts at a cut
        # that stands in every longer prefix.
        start = max(0, bisect_left(self.ends, length) - 2)
        rest = self.tokenizer.pieces(self.text[self.ends[start] : length])
        return self.totals[start] + sum(map(self.tokenizer.tokens, rest))

    def cut(self, budget: int) -> int:
        """The longest prefix, in characters, of at most `budget` tokens."""
        if self.totals[-1] <= budget:
            return self.ends[-1]
        at = bisect_left(self.totals, budget + 1)
        upto = self.ends[min(at + 1, len(self.ends) - 1)]
        return next(n for n in range(upto, -1, -1) if self.count_at(n) <= budget)


_LOADED: dict[str, PrefixTokenizer] = {}


def loaded(path: str) -> PrefixTokenizer:
    """One tokenizer per Python worker, with the tables that it has made."""
    if path not in _LOADED:
        _LOADED[path] = PrefixTokenizer(path)
    return _LOADED[path]


def token_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    limit: int = LIMIT,
) -> DataFrame:
    """Bytes and tokens of each text, and where to cut it for `limit` tokens.

    Returns `key`, n_bytes, n_tokens, over_limit and cut_chars: the longest prefix, in
    characters, that stays within the limit. Null and empty texts have 0 of each. Every
    row has its own result, also repeated ones and those without an id. Other columns
    of `docs` are not read.
    """

    def make():
        bpe = loaded(public_tokenizers.path(tokenizer))

        def act(keys, texts):
            counts = [bpe.count(t) for t in texts]
            return (
                keys,
                [len(t.encode("utf-8")) if t else 0 for t in texts],
                counts,
                [n > limit for n in counts],
                [
                    len(t or "") if n <= limit else cut_within(bpe, t, limit)
                    for t, n in zip(texts, counts)
                ],
            )

        return act

    kind = docs.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean, cut_chars long"
    return map_slices(docs.select(key, text), out, make)


def cut_within(bpe: PrefixTokenizer, text: str, limit: int) -> int:
    """`PrefixIndex.cut`, with an index of the chunks around the cut alone."""
    counts = bpe.chunk_counts(text)
    if counts is None:
        return bpe.index(text).cut(limit)
    total, start = 0, 0
    chunks = text.split(" ")
    for at, count in enumerate(counts):
        if total + count > limit:
            near = (" " if at else "") + " ".join(chunks[at : at + 3])
            return start + bpe.index(near).cut(limit - total)
        total += count
        start += len(chunks[at]) + (at > 0)
    return len(text)


def prefix_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER
) -> DataFrame:
    """Each text with its whole table: `counts[i]` tokens in the first i characters."""

    def make():
        bpe = loaded(public_tokenizers.path(tokenizer))

        def act(keys, texts):
            made = []
            for t in texts:
                index = bpe.index(t)
                made.append([index.count_at(n) for n in range(len(t or "") + 1)])
            return keys, made

        return act

    kind = docs.schema[key].dataType.simpleString()
    return map_slices(docs.select(key, text), f"`{key}` {kind}, counts array<int>", make)
