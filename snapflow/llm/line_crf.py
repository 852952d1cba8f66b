"""Quality of texts by a linear-chain conditional random field over their lines.

Every line is good or bad. A line speaks for itself and for its neighbours by its
features, and the label of a line depends on the one before. Forward-backward gives each
line's marginal; weighted by length these make the quality of the text. Labels are known
for whole texts only, so that in learning all lines of a text have its label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import columns_of, id_rest, map_slices

#: Bounds of the sample that is learned from: labelled texts, by least hash of the id, and
#: lines of each.
SAMPLE_DOCS = 3000
SAMPLE_LINES = 60
STEPS, RATE, RIDGE = 150, 0.15, 1e-3
OWN = (
    "length upper symbols bangs digits pipes again stutter word_length stops letters beyond ended "
    "short sentences_again"
).split()
#: Features that a line also takes from the lines before and after.
SHARED = ["upper", "symbols", "bangs", "pipes", "again", "stutter", "sentences_again", "length"]
WIDTH = 1 + len(OWN) + 2 * len(SHARED) + 4


def line_features(line: str) -> list[float]:
    """What a line with a word says by itself, in the order of OWN."""
    found = line.split()
    n, size = max(1, len(found)), max(1, len(line))
    letters = sum(map(str.isalpha, line))
    upper = sum(map(str.isupper, line))
    sentences = [s for s in line.split(". ") if s]
    return [
        np.log1p(size) / 5,
        upper / max(1, letters),
        sum(map(line.count, "#*$%&<>")) / size,
        line.count("!") / size,
        sum(map(str.isdigit, line)) / size,
        line.count("|") / n,
        1 - len(set(found)) / n,
        sum(a == b for a, b in zip(found, found[1:])) / n,
        size / n / 10,
        sum(map(line.count, ".,;:?")) / n,
        letters / size,
        1 - len(line.encode("ascii", "ignore")) / size,
        float(line.rstrip()[-1:] in ".?"),
        float(n < 5),
        1 - len(set(sentences)) / max(1, len(sentences)),
    ]


def text_features(text: str | None, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features of the lines of a text that hold a word, and the lines' lengths."""
    lines = [x for x in (text or "").split("\n") if x.strip()][:most]
    if not lines:
        return np.zeros((0, WIDTH)), np.zeros(0)
    own = np.array([line_features(x) for x in lines])
    some = own[:, [OWN.index(x) for x in SHARED]]
    edge = np.zeros((1, len(SHARED)))
    before, after = np.concatenate([edge, some[:-1]]), np.concatenate([some[1:], edge])
    same = np.array([float(a == b) for a, b in zip(lines, lines[1:])])
    rest = np.zeros((len(lines), 4))
    rest[1:, 0], rest[:-1, 1] = same, same
    rest[0, 2] = rest[-1, 3] = 1
    features = np.concatenate([np.ones((len(lines), 1)), own, before, after, rest], axis=1)
    return features, np.array([len(x) for x in lines], float)


@dataclass
class Chain:
    """Weights for "good" of a line, and log-weights from one label to the next."""

    weights: np.ndarray
    moves: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def scaled(self, features: np.ndarray) -> np.ndarray:
        return (features - self.mean) / self.spread


def spans(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of chains that lie one after the other, the order by length, and how many
    chains have more than t lines."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, int)
    order = np.argsort(-sizes, kind="stable")
    longer = np.zeros(int(sizes.max(initial=0)) + 1, int)
    np.add.at(longer, sizes, 1)
    alive = len(sizes) - np.cumsum(longer)
    return starts.astype(int), order, alive


def forward_backward(
    good: np.ndarray, moves: np.ndarray, sizes: np.ndarray, weight: np.ndarray | float = 1.0
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of "good" per line, and of the four moves in all (each counted by the
    weight of its second line), for chains of `sizes` lines with log-odds `good`."""
    starts, order, alive = spans(sizes)
    bias = np.clip(good, -30, 30)
    local = np.stack([np.exp(-bias / 2), np.exp(bias / 2)], axis=1)
    step = np.exp(moves)
    ahead, behind = np.zeros_like(local), np.ones_like(local)
    for t in range(len(alive)):
        chains = order[: alive[t]] if t else order[sizes[order] > 0]
        at = starts[chains] + t
        now = local[at] if t == 0 else (ahead[at - 1] @ step) * local[at]
        ahead[at] = now / now.sum(axis=1, keepdims=True)
    for t in range(len(alive) - 1, 0, -1):
        at = starts[order[: alive[t]]] + t
        now = (behind[at] * local[at]) @ step.T
        behind[at - 1] = now / now.sum(axis=1, keepdims=True)
    both = ahead * behind
    both /= both.sum(axis=1, keepdims=True)
    later = np.ones(len(good), bool)
    later[starts[sizes > 0]] = False
    at = np.flatnonzero(later)
    pairs = ahead[at - 1][:, :, None] * step[None] * (behind[at] * local[at])[:, None, :]
    pairs /= pairs.sum(axis=(1, 2), keepdims=True) if len(at) else 1
    return both[:, 1], (pairs * np.broadcast_to(weight, len(good))[at, None, None]).sum(axis=0)


def learn(texts: list[tuple[np.ndarray, int]]) -> Chain:
    """Weights that make the labels likeliest, for (features, label) of texts; by gradient
    steps with momentum and scaled per weight."""
    texts = [(x, y) for x, y in texts if len(x)]
    if not texts:
        return Chain(np.zeros(WIDTH), np.zeros((2, 2)), np.zeros(WIDTH), np.ones(WIDTH))
    raw = np.concatenate([x for x, _ in texts])
    sizes = np.array([len(x) for x, _ in texts])
    labels = np.repeat([float(y) for _, y in texts], sizes)
    mean, spread = raw.mean(axis=0), raw.std(axis=0)
    mean[0], spread = 0.0, np.where(spread > 1e-9, spread, 1.0)
    features = (raw - mean) / spread
    # A text counts by its lines' mean, not by their number.
    weight = np.repeat(1.0 / sizes, sizes)
    kept = np.zeros((2, 2))
    for (_, y), n in zip(texts, sizes):
        kept[y, y] += (n - 1) / n
    chain = Chain(np.zeros(WIDTH), np.zeros((2, 2)), mean, spread)
    params = np.zeros(WIDTH + 4)
    first, second = np.zeros_like(params), np.zeros_like(params)
    total = len(texts)
    for i in range(1, STEPS + 1):
        chain.weights, chain.moves = params[:WIDTH], params[WIDTH:].reshape(2, 2)
        marginal, pairs = forward_backward(features @ chain.weights, chain.moves, sizes, weight)
        slope = np.concatenate(
            [
                features.T @ ((labels - marginal) * weight) / total,
                ((kept - pairs) / total).ravel(),
            ]
        ) - RIDGE * params
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        params = params + RATE * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.99**i)) + 1e-8)
    chain.weights, chain.moves = params[:WIDTH], params[WIDTH:].reshape(2, 2)
    return chain


def qualities(chain: Chain, texts: list[str | None]) -> list[float]:
    """The quality of each text; 0 for texts without a word."""
    made = [text_features(t) for t in texts]
    sizes = np.array([len(x) for x, _ in made], int)
    if not sizes.sum():
        return [0.0] * len(texts)
    features = np.concatenate([x for x, _ in made])
    marginal, _ = forward_backward(chain.scaled(features) @ chain.weights, chain.moves, sizes)
    lengths = np.concatenate([n for _, n in made])
    owner = np.repeat(np.arange(len(texts)), sizes)
    top = np.bincount(owner, marginal * lengths, len(texts))
    all_of = np.bincount(owner, lengths, len(texts))
    return np.clip(top / np.maximum(all_of, 1), 0, 1).tolist()


def learn_quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    folds: int = 3,
    fold: int = 1,
    most: int = SAMPLE_DOCS,
) -> Chain:
    """A chain learned from labelled texts outside the held-out fold: of at most `most`
    ids, SAMPLE_LINES lines of each text, which alone come to the driver."""
    known = labels.filter((id_rest(key, folds) != fold) & F.col(label).isin(0, 1))
    sample = (
        known.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("id"))
        .agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most)
    )
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(sample), "id").select("text", "label")

    def make():
        def act(texts, marks):
            made = [text_features(t, SAMPLE_LINES)[0].astype(np.float32) for t in texts]
            return columns_of([(x.ravel().tolist(), y) for x, y in zip(made, marks)], 2)

        return act

    found = map_slices(rows, "features array<float>, label int", make).limit(2 * most).collect()
    texts = [(np.array(r["features"], float).reshape(-1, WIDTH), r["label"]) for r in found]
    return learn(sorted(texts, key=lambda x: (x[1], len(x[0]), x[0].sum() if len(x[0]) else 0.0)))


def score_quality(
    docs: DataFrame,
    chain: Chain,
    key: str = "doc_id",
    text: str = "text",
    folds: int = 3,
    fold: int = 1,
) -> DataFrame:
    """Quality of each whole text: `key`, held_out, score (0 to 1) and predicted.

    Null texts and texts without a word score 0. Repeated rows each get their result; if
    nothing was learned all other texts score 0.5. Other columns of `docs` are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def make():
        def act(keys, held, texts):
            scores = qualities(shared.value, texts)
            return keys, held, scores, [int(s >= 0.5) for s in scores]

        return act

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(key, (id_rest(key, folds) == fold).alias("held_out"), text)
    return map_slices(rows, f"`{key}` {kind}, held_out boolean, score double, predicted int", make)
