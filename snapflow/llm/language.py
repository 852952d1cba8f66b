"""Language by cross-parsing entropy.

A suffix automaton of labelled text per language tells how far a text may be read on as a
substring of that language's sample. Reading so, greedily, cuts a text into phrases; a
text costs the fewest phrases in its own language. The phrases are normalised by the
entropy of the sample, so log2(sample length) bits for each, per character. The automata
are built from a bounded sample and walked for many texts at once.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import id_rest, map_slices

#: Characters of sample text per language, and of one row, at most.
SAMPLE_CHARS = 24_000
ROW_CHARS = 400
#: Languages at most; labels beyond, by number of rows, are not learned.
LANGUAGES = 256
#: A text is read in stretches of so many characters, side by side. A phrase that runs
#: over the end of a stretch counts as two, so that a text costs one phrase more at most
#: for each 1,024 characters, in every language alike.
STRETCH = 1024
LANES = 2048
UNKNOWN = "und"


def normalise(text: str) -> str:
    """Lower case; letters and single blanks only."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


class SuffixAutomaton:
    """Transitions of the suffix automaton of a text over a dense alphabet."""

    def __init__(self, text: str, alphabet: dict[str, int]):
        links, lengths, moves = [-1], [0], [{}]
        last = 0
        for c in text:
            code = alphabet[c]
            state = len(moves)
            links.append(0)
            lengths.append(lengths[last] + 1)
            moves.append({})
            at = last
            while at >= 0 and code not in moves[at]:
                moves[at][code] = state
                at = links[at]
            if at >= 0:
                target = moves[at][code]
                if lengths[at] + 1 == lengths[target]:
                    links[state] = target
                else:
                    twin = len(moves)
                    links.append(links[target])
                    lengths.append(lengths[at] + 1)
                    moves.append(dict(moves[target]))
                    while at >= 0 and moves[at].get(code) == target:
                        moves[at][code] = twin
                        at = links[at]
                    links[target] = links[state] = twin
            last = state
        # State 0 is where a phrase starts; no transition leads back to it.
        self.table = np.zeros((len(moves), len(alphabet) + 1), np.int32)
        for state, row in enumerate(moves):
            for code, target in row.items():
                self.table[state, code] = target * self.table.shape[1]


class LanguageModel:
    """Automata of the languages learned, over one alphabet."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        letters = sorted(set("".join(samples.values())))
        self.alphabet = {c: i for i, c in enumerate(letters)}
        self.codes = {ord(c): i for c, i in self.alphabet.items()}
        self.lookup = np.full(0x110000, len(letters), np.int16)
        for point, code in self.codes.items():
            self.lookup[point] = code
        self.tables = [SuffixAutomaton(samples[x], self.alphabet).table for x in self.languages]
        self.bits = [np.log2(max(2, len(samples[x]))) for x in self.languages]

    def stretches(self, text: str) -> tuple[list[np.ndarray], int]:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.lookup[points]
        return [codes[i : i + STRETCH] for i in range(0, len(codes), STRETCH)], len(codes)

    def phrases(self, table: np.ndarray, lanes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases of each stretch; stretches lie in columns, longest first."""
        # States are places of rows in the flat table, so a move is one addition.
        flat = table.reshape(-1)
        first = table[0]
        state = np.zeros(lanes.shape[1], np.int32)
        count = np.zeros(lanes.shape[1], np.int32)
        for i in range(lanes.shape[0]):
            n = int(sizes[i])
            code = lanes[i, :n]
            at = state[:n]
            ahead = flat.take(at + code)
            ends = ahead == 0
            # A new phrase starts here; an unknown character is one by itself.
            count[:n] += ends | (at == 0)
            np.copyto(at, ahead)
            np.copyto(at, first.take(code), where=ends)
        return count

    def costs(self, texts: list[str]) -> np.ndarray:
        """Bits per character of each text in each language."""
        lanes, owner, totals = [], [], []
        for at, text in enumerate(texts):
            parts, total = self.stretches(text)
            lanes += parts
            owner += [at] * len(parts)
            totals.append(max(1, total))
        cost = np.zeros((len(texts), len(self.languages)))
        order = sorted(range(len(lanes)), key=lambda i: -len(lanes[i]))
        for at in range(0, len(order), LANES):
            some = order[at : at + LANES]
            lengths = np.array([len(lanes[i]) for i in some])
            block = np.zeros((lengths.max(initial=0), len(some)), np.int32)
            for column, i in enumerate(some):
                block[: len(lanes[i]), column] = lanes[i]
            sizes = (lengths[None, :] > np.arange(len(block))[:, None]).sum(axis=1)
            owners = np.array([owner[i] for i in some])
            for k, table in enumerate(self.tables):
                found = self.phrases(table, block, sizes)
                np.add.at(cost[:, k], owners, found * self.bits[k])
        return cost / np.array(totals, float)[:, None] if texts else cost

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score: 1 less the share of its cost in the second best's, doubled
        into 0.5 to 1. No letter: `und` with 0."""
        clean = [normalise(t) if t else "" for t in texts]
        known = [i for i, t in enumerate(clean) if t]
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages or not known:
            return langs, scores
        cost = self.costs([clean[i] for i in known])
        weight = np.exp2(-4 * (cost - cost.min(axis=1, keepdims=True)))
        share = weight.max(axis=1) / weight.sum(axis=1)
        for i, k, s in zip(known, cost.argmin(axis=1), share):
            langs[i], scores[i] = self.languages[k], float(min(1.0, s))
        return langs, scores


def training_samples(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    folds: int = 5,
    sample_chars: int = SAMPLE_CHARS,
    row_chars: int = ROW_CHARS,
) -> dict[str, str]:
    """Sample text per language, from rows outside the held-out fold.

    Of each row at most `row_chars` characters of its middle, of each language the rows of
    least hash until `sample_chars` are full; sentences that occur again in these rows tell
    nothing of a language and are left out. So at most LANGUAGES * sample_chars characters come
    to the driver, whatever the input.
    """
    middle = F.greatest(F.lit(1), (F.length(text) - row_chars) / 2).cast("int")
    rows = docs.filter(
        (id_rest(key, folds) != 0) & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")
    ).select(
        F.col(lang).alias("lang"),
        F.substring(F.col(text), middle, F.lit(row_chars)).alias("text"),
        F.xxhash64(text).alias("order"),
    )
    most = -(-sample_chars // row_chars) * 2
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    sizes = {r["lang"]: r["count"] for r in counts.collect()}
    if not sizes:
        return {}
    # Rows are thinned by hash to a few times `most` of a language before the least of
    # them are gathered, so no group is large.
    position = F.col("order").cast("double") / float(1 << 64) + 0.5
    share = F.create_map(*[F.lit(y) for x, n in sizes.items() for y in (x, 4.0 * most / n)])
    least = F.expr(f"slice(array_sort(collect_set(struct(order, text))), 1, {most})")
    found = (
        rows.filter(position <= share[F.col("lang")]).groupBy("lang").agg(least.alias("rows"))
    ).collect()
    return distinct_sentences(
        {r["lang"]: [row["text"] for row in r["rows"]] for r in found}, sample_chars
    )


def distinct_sentences(rows: dict[str, list[str]], most: int) -> dict[str, str]:
    """Per language the sentences of its rows that occur once in all, in order."""
    parts = {
        lang: [normalise(x) for text in texts for x in re.split(r"[.!?\n]", text)]
        for lang, texts in rows.items()
    }
    seen = Counter(x for found in parts.values() for x in found)
    return {
        lang: " ".join(x for x in found if seen[x] == 1)[:most] for lang, found in parts.items()
    }


def predict_language(
    docs: DataFrame,
    samples: dict[str, str],
    key: str = "doc_id",
    text: str = "text",
    folds: int = 5,
) -> DataFrame:
    """Language of each whole text: `key`, held_out, lang_pred and score (0 to 1).

    Null texts and texts without a letter, and all texts if nothing was learned, get
    `und` and 0. Of languages at equal cost the first by name wins. Repeated rows each
    get their result; other columns of `docs` are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def make():
        model = LanguageModel(shared.value)

        def act(keys, held, texts):
            langs, scores = model.predict(texts)
            return keys, held, langs, scores

        return act

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(key, (id_rest(key, folds) == 0).alias("held_out"), text)
    return map_slices(
        rows, f"`{key}` {kind}, held_out boolean, lang_pred string, score double", make
    )
