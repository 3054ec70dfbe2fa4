"""Quality classifier: supervised subword embeddings.

A text is the average of learned vectors of hashed features: its words, word pairs (a word after
itself is the same pair for all words) and the character n-grams of its words (with boundary marks). A softmax layer turns the average into class
probabilities. Vectors and layer are trained by stochastic gradient descent in numpy on
at most ``SAMPLE`` labelled rows, those with the smallest hash of their id. Only texts are inputs.

Scoring is one narrow pass over whole texts: the layer is linear in the average, so each feature
bucket folds into one number (half a megabyte for the model), and a text's score needs only the mean of
its features' numbers, taken for many texts at a time.

Defined results: null and empty texts have no features and get the score of the layer's bias;
repeated rows are scored row by row; labels other than 0 and 1, null labels and labels of unknown
ids are not used; without labels of both classes the score is the share of label 1 among those there
are, or 0.5; empty tables give empty results; other columns are ignored or passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cartlens.llm.common import Powers, byte_slices, fresh, ship, utf8

#: Text scored at a time; arrays of features and powers take over 100 bytes for each of its bytes, in every worker.
BATCH_BYTES = 1 << 18
#: Labelled rows used for training, at most.
SAMPLE = 8_000
BUCKETS = 1 << 17
DIMENSIONS = 8
EPOCHS = 3
RATE = 40.0
SEED = 11
NGRAMS = (3, 4, 5)
THRESHOLD = 0.3
FOLDS = 5
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x5851F42D4C957F2D
_powers = Powers(_BASE)


def _bucket(x: np.ndarray, kind: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(kind)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return ((x >> np.uint64(40)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def features(texts: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Hashed features of texts side by side: (place, bucket) arrays per kind, and where each text starts.

    Places are offsets in the joined texts, so a feature belongs to the text whose range holds it;
    a kind has at most one feature per place.
    """
    sizes = np.asarray([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 2)])[:-1]
    data = np.frombuffer(b"".join([b" ", b"  ".join(texts), b" "]), np.uint8)  # a blank at both ends of each text
    n = len(data)
    blank = _BLANK[data]
    found = []
    with np.errstate(over="ignore"):
        code = np.where(blank, 0, data.astype(np.uint64) + np.uint64(1))
        # n-grams may begin or end at a blank, which marks the word's edge
        rolled, inner = code.copy(), np.ones(n, bool)
        for k in range(1, max(NGRAMS)):
            if n <= k:
                break
            rolled = rolled[: n - k] + code[k:] * np.uint64(pow(_BASE, k, 1 << 64))
            inner = inner[: n - k] & ~blank[k - 1 : n - 1] if k > 1 else np.ones(n - k, bool)
            if k + 1 in NGRAMS:
                place = np.flatnonzero(inner)
                found.append((place, _bucket(rolled[place], k + 1)))
        powers, inverse = _powers(n)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(code * powers[:n], out=prefix[1:])
        edges = np.diff(np.concatenate([[True], blank]).astype(np.int8))
        first, end = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        word = (prefix[end] - prefix[first]) * inverse[first]
        found.append((first, _bucket(word, 1)))
        if len(first) > 1:
            text_of = np.searchsorted(starts, first, "right")
            pair = np.flatnonzero(text_of[1:] == text_of[:-1])
            joint = word[pair] * np.uint64(0x9E3779B97F4A7C15) + word[pair + 1]
            # a word after itself is one feature whatever the word
            joint[word[pair] == word[pair + 1]] = 0
            found.append((first[pair], _bucket(joint, 2)))
    return found, starts


@dataclass
class Model:
    """One number per bucket (difference of the two logits) and the bias difference."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 of each UTF-8 text."""
        if not texts:
            return np.zeros(0)
        found, starts = features(texts)
        n = int(starts[-1]) + len(texts[-1]) + 2
        total, count = np.zeros(n), np.zeros(n)
        for place, bucket in found:
            total[place] += self.weights[bucket]
            count[place] += 1
        sums, counts = np.add.reduceat(total, starts), np.add.reduceat(count, starts)
        logit = sums / np.maximum(counts, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def counted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares of its features."""
    found, _ = features([text])
    bucket, count = np.unique(np.concatenate([b for _, b in found] or [np.zeros(0, np.int64)]), return_counts=True)
    return bucket.astype(np.int32), (count / max(count.sum(), 1)).astype(np.float32)


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Train on labelled texts; the order of the rows does not matter if they come sorted."""
    share = float(np.mean(labels)) if labels else 0.5
    if not labels or not 0 < share < 1:
        odds = np.clip(share, 1e-6, 1 - 1e-6)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(odds / (1 - odds))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = rng.uniform(-1, 1, (2, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    bias = np.log(np.asarray([1 - share, share], np.float32))
    steps, step = epochs * len(texts), 0
    for _ in range(epochs):
        for i in rng.permutation(len(texts)).tolist():
            bucket, weight = counted(texts[i])  # counted anew: the features of all texts take ten times their memory
            own = vectors[bucket]
            hidden = weight @ own
            logits = layer @ hidden + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[labels[i]] -= 1
            now = rate * (1 - step / steps)
            back = layer.T @ error
            layer -= 0.05 * now * np.outer(error, hidden)
            bias -= 0.005 * now * error
            vectors[bucket] = own - now * weight[:, None] * back
            step += 1
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def fold(id_col: Column) -> Column:
    """Fold of a document: CRC-32 of its id as text, modulo FOLDS; fold 0 is held out."""
    return F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit a model on at most SAMPLE labelled rows outside the held-out fold.

    The rows come to the driver, where one process trains on them: SAMPLE bounds them whatever the
    size of the tables. They are picked by the hash of their id before any text is read.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & (fold(F.col(id_col)) != 0))
    known = known.groupBy(id_col).agg(F.max(label_col).cast("int").alias("_label"))
    picked = known.orderBy(F.xxhash64(id_col), id_col).limit(SAMPLE)
    # bounded: SAMPLE ids
    rows = docs.select(text_col, id_col).join(F.broadcast(picked), id_col).select(F.coalesce(text_col, F.lit("")).cast("binary"), "_label").toArrow()
    pairs = sorted(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()))
    return fit([t for t, _ in pairs], [y for _, y in pairs])


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """The input with a column of scores, the probability of label 1, in place of any of that name; no shuffle.

    Only texts go to Python and only scores come back; the other columns, and the texts, wait in the JVM.
    """
    spark = docs.sparkSession
    ship(spark)
    columns = [c for c in docs.columns if c != name]
    shared = spark.sparkContext.broadcast(model)  # half a megabyte, whatever the data

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [shared.value.scores(utf8(run, "_text")) for run in byte_slices(pa.RecordBatch.from_arrays([texts], ["_text"]), "_text", BATCH_BYTES)]
            yield pa.array(np.concatenate([np.zeros(0), *parts]))

    return docs.select(*columns, scored(F.col(text_col)).alias(name))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score of the threshold or more, with all their columns."""
    (name,) = fresh(docs.columns, "_score")
    return score(docs, model, text_col, name).where(F.col(name) >= threshold).select(*docs.columns)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` and ``predicted`` (score of THRESHOLD or more)."""
    scored = score(docs.select(id_col, text_col), train(docs, labels, id_col=id_col, text_col=text_col), text_col)
    return scored.select(
        id_col,
        (F.coalesce(fold(F.col(id_col)), F.lit(1)) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
