"""Quality scores: random-indexing word vectors, pooled per document, into a small network.

1. Words are runs of letters, digits or marks, and line ends. Each has a place in a table
   of ``PLACES`` rows by its shape (lower case, capitalised, upper case, digits, marks, a
   word just said again) and its hash. The commoner words have a place almost to themselves;
   the table's size bounds what tasks hold and send, whatever the number of words.
2. Each place has a fixed sparse random index vector. The vector of a place is the sum of
   the index vectors of the words within ``REACH`` of it in all documents: integer sums, so
   the grouped sum is the same in any order.
3. A document is the mean and the standard deviation of its words' unit vectors.
4. A two-layer numpy network is trained on the driver on at most about ``TRAIN_ROWS``
   labelled documents (sampled by hash; the only bound), its temperature on a share of them
   it has not seen. Scores are the calibrated probabilities.

Nulls and empties: a null text is the empty one, whose features are zeros; it is scored
too. Labels that are null or not 0 or 1, or without document, are left out; of several for
one document the majority counts, on a tie 0. With labels of one kind only (or none) the
score is their mean (or one half). A document row is scored once per row. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollbook.llm.shared import span_hashes, texts

#: The bound on the labelled documents that the network is trained on.
TRAIN_ROWS = 20_000
WIDTH, REACH, HIDDEN, EPOCHS = 32, 2, 32, 40

#: First place and number of places of each shape.
_SIZES = (1 << 16, 1 << 13, 1 << 11, 1 << 10, 14, 1, 1)
_FIRST = [sum(_SIZES[:i]) for i in range(len(_SIZES))]
LOWER, CAPITAL, UPPER, MARKS, DIGITS, LINE, AGAIN = zip(_FIRST, _SIZES)
PLACES = sum(_SIZES)
#: Words whose neighbours are summed together.
TOGETHER = 1 << 20

_SPACE, _LETTER, _DIGIT, _MARK, _FEED = range(5)
_KIND = np.full(256, _MARK, dtype=np.uint8)
_KIND[[32, 9, 11, 12, 13]] = _SPACE
_KIND[10] = _FEED
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = _LETTER
_IS_UPPER = np.zeros(256, dtype=np.int32)
_IS_UPPER[65:91] = 1


def index_vectors() -> np.ndarray:
    """Sparse ternary vectors: four entries of +1 or -1 per place."""
    draw = np.random.default_rng(20240501)
    out = np.zeros((PLACES, WIDTH), dtype=np.int64)
    chosen = np.argsort(draw.random((PLACES, WIDTH)), axis=1)[:, :4]
    np.put_along_axis(out, chosen, draw.choice((-1, 1), (PLACES, 4)), axis=1)
    return out


def places(text: str) -> np.ndarray:
    """The place of each word of a text, in order."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(raw):
        return np.empty(0, dtype=np.int64)
    kind = _KIND[raw]
    edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts, ends = np.concatenate(([0], edge)), np.concatenate((edge, [len(raw)]))
    kinds = kind[starts]
    seen = kinds != _SPACE
    starts, ends, kinds = starts[seen], ends[seen], kinds[seen]
    h = span_hashes(raw, starts, ends)
    size = ends - starts
    caps = np.concatenate(([0], np.cumsum(_IS_UPPER[raw])))
    n_caps = caps[ends] - caps[starts]
    shape = np.array([LOWER, CAPITAL, UPPER, MARKS, DIGITS, LINE, AGAIN])
    which = np.zeros(len(h), dtype=np.int64)
    letters = kinds == _LETTER
    which[letters & (n_caps > 0)] = 1
    which[letters & (n_caps > 1) & (2 * n_caps > size)] = 2
    which[kinds == _MARK] = 3
    which[kinds == _DIGIT] = 4
    which[kinds == _FEED] = 5
    at = np.flatnonzero(letters)
    which[at[1:][h[at[1:]] == h[at[:-1]]]] = 6
    value = np.where(which == 4, np.minimum(size, DIGITS[1]) - 1, (h >> np.uint64(8)).astype(np.int64) & 0xFFFFFFFF)
    return shape[which, 0] + value % shape[which, 1]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each place has each other within reach, as sums of index vectors."""
    index = index_vectors()
    column, sign = np.nonzero(index)[1].reshape(PLACES, 4), index[index != 0].reshape(PLACES, 4)
    total = np.zeros(PLACES * WIDTH)
    for batch in batches:
        held, size = [], 0
        for text in texts(batch["text"]):
            held += [places(text), np.full(REACH, -1)]  # no word reaches into the next text
            size += len(held[-2])
            if size >= TOGETHER:
                _add(total, np.concatenate(held), column, sign)
                held, size = [], 0
        if held:
            _add(total, np.concatenate(held), column, sign)
    sums = total.astype(np.int64).reshape(PLACES, WIDTH)
    some = np.flatnonzero(sums.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()), *(pa.array(sums[some, i]) for i in range(WIDTH))],
        ["place", *(f"v{i}" for i in range(WIDTH))],
    )


def _add(total: np.ndarray, ids: np.ndarray, column: np.ndarray, sign: np.ndarray) -> None:
    for step in range(1, REACH + 1):
        for left, right in ((ids[:-step], ids[step:]), (ids[step:], ids[:-step])):
            both = (left >= 0) & (right >= 0)
            word, near = left[both] * WIDTH, right[both]
            for k in range(4):
                total += np.bincount(word + column[near, k], sign[near, k], minlength=len(total))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vector of each place, from the words around it in all documents."""
    names = [f"v{i}" for i in range(WIDTH)]
    schema = "place int, " + ", ".join(f"{n} bigint" for n in names)
    parts = docs.select("text").mapInArrow(_neighbours, schema)
    sums = parts.groupBy("place").agg(*(F.sum(n).alias(n) for n in names)).toArrow()  # at most PLACES rows
    out = np.zeros((PLACES, WIDTH))
    at = sums["place"].to_numpy()
    for i, name in enumerate(names):
        out[at, i] = sums[name].to_numpy()
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def pooled(text: str, vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the vectors of a text's words."""
    ids = places(text)
    if not len(ids):
        return np.zeros(2 * WIDTH)
    held = vectors[ids]
    return np.concatenate((held.mean(axis=0), held.std(axis=0)))


@dataclass
class Model:
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    constant: float | None = None

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((features - self.centre) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(features), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -40, 40)))


def _features(vectors: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [pooled(t, vectors) for t in texts(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["label"], pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "label", "x"]
            )

    return run


def train(x: np.ndarray, y: np.ndarray, vectors: np.ndarray) -> Model:
    """Adam on the cross entropy; the last fifth sets the temperature."""
    none = np.zeros(0)
    if len(set(y.tolist())) < 2:
        return Model(vectors, none, none, [], 1.0, float(y.mean()) if len(y) else 0.5)
    draw = np.random.default_rng(7)
    order = draw.permutation(len(x))
    x, y = x[order], y[order]
    held = max(1, len(x) // 5)
    fit_x, fit_y, rest_x, rest_y = x[held:], y[held:], x[:held], y[:held]
    centre, scale = fit_x.mean(0), fit_x.std(0) + 1e-6
    z = (fit_x - centre) / scale
    w = [draw.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for _ in range(EPOCHS):
        for at in np.array_split(draw.permutation(len(z)), max(1, len(z) // 128)):
            h = np.tanh(z[at] @ w[0] + w[1])
            p = 1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -40, 40)))
            g = (p - fit_y[at]) / len(at)
            back = np.outer(g, w[2]) * (1 - h * h)
            grads = [z[at].T @ back + 1e-4 * w[0], back.sum(0), h.T @ g + 1e-4 * w[2], g.sum(keepdims=True)]
            t += 1
            for k, d in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                w[k] = w[k] - 3e-3 * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    model = Model(vectors, centre, scale, w, 1.0)
    logits = model.logits(rest_x)

    def loss(temperature: float) -> float:
        s = np.clip(logits / temperature, -40, 40)
        return float(np.mean(np.logaddexp(0, s) - rest_y * s))

    model.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return model


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """``docs``: doc_id, text. ``labels``: doc_id, quality; learn from all that are given."""
    read = docs.select("doc_id", "text")
    vectors = word_vectors(read)
    voted = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg((F.avg("quality") > 0.5).cast("double").alias("label"))
    )
    share = rows / max(voted.count(), 1)
    if share < 1:
        voted = voted.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # About ``rows`` rows of two numbers each: small enough to send, by construction.
    sample = read.join(F.broadcast(voted), "doc_id")
    got = sample.mapInArrow(_features(vectors), "doc_id bigint, label double, x array<double>").collect()
    got.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in got]).reshape(len(got), 2 * WIDTH)
    return train(x, np.array([r["label"] for r in got]), vectors)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [pooled(t, model.vectors) for t in texts(batch["text"])]
            x = np.array(rows).reshape(len(rows), 2 * WIDTH)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.scores(x))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")
