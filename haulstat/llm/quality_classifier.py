"""Quality classifier: hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates.

Tokens are runs of word characters and runs of other visible characters, in
the text's own case. Features are the tokens, pairs of adjacent tokens, and the
pattern of a token that comes again within at most REPEATS tokens (one slot per
distance, whatever the token), hashed to ``1 << BITS`` slots; a document's vector holds the square root of
each slot's count, scaled to length 1. A score is the logistic function of the
sparse dot product of that vector with the weights, plus a bias.

Training sees about ``fit_rows`` labelled rows (a documented bound; chosen by a
hash of the id, whole texts, streamed in a fixed order through one task that
keeps two arrays of ``1 << BITS`` numbers). Held-out rows (see ``held_out``)
are never learned from; neither id, source, language nor label enters a score.

Scoring runs inside ``mapInArrow``: no shuffle, texts never leave their task.

Defined results: null or empty text: the bias alone, hence a score as well;
no labelled row: score 0.5; empty table: no rows; very long texts: every token counts, held as one text's
slots; a score of exactly 0.5 (a tie): label 1; a document with several labels: each labelled row
is learned; null labels are not learned; repeated rows are scored alike; extra
columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulstat.llm.common import held_out, stored

TOKENS = re.compile(r"\w+|[^\w\s]+")
BITS = 18
REPEATS = 4  # slots 1 to REPEATS also stand for tokens that come again at that distance
FIT_ROWS = 6000
CACHE_TOKENS = 400_000


@dataclass(frozen=True)
class Ftrl:
    """Per-coordinate learning rate ``alpha / (beta + sqrt(sum of squared gradients))``, L1 and L2 penalties."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 1e-4
    epochs: int = 3


class Hasher:
    """Token hashes, kept for tokens seen before within a bound."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def hashes(self, tokens: list[str]) -> np.ndarray:
        if len(self.known) > CACHE_TOKENS:
            self.known.clear()
        for t in set(tokens):
            if t not in self.known:
                self.known[t] = xxhash.xxh3_64_intdigest(t)
        return np.fromiter(map(self.known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))

    def slots(self, tokens: list[str]) -> np.ndarray:
        """A slot for every token, pair of adjacent tokens, and token equal to one shortly before it."""
        h = self.hashes(tokens)
        with np.errstate(over="ignore"):
            pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + (h[1:] ^ (h[1:] >> np.uint64(31)))
            pairs ^= pairs >> np.uint64(29)
            pairs *= np.uint64(0xBF58476D1CE4E5B9)
        again = [np.full(int((h[d:] == h[:-d]).sum()), d) for d in range(1, REPEATS + 1)]
        return np.concatenate([(np.concatenate([h, pairs]) >> np.uint64(64 - BITS)).astype(np.int64), *again])


def vector(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots and their values."""
    index, count = np.unique(slots, return_counts=True)
    value = np.sqrt(count.astype(np.float64))
    return index, value / np.sqrt(max(float(count.sum()), 1.0))


class Trainer:
    def __init__(self, p: Ftrl) -> None:
        self.p, self.z, self.n = p, np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, index) -> np.ndarray:
        p, z, n = self.p, self.z[index], self.n[index]
        w = -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2)
        return np.where(np.abs(z) <= p.l1, 0.0, w)

    def update(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(index)
        g = (sigmoid(float(w @ value)) - label) * value
        n = self.n[index]
        self.z[index] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.p.alpha * w
        self.n[index] = n + g * g


def sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -35, 35))))


def fit(docs: DataFrame, labels: DataFrame, params: Ftrl = Ftrl(), fit_rows: int = FIT_ROWS,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> np.ndarray:
    """Weights, the bias last."""
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
    known = known.where(F.col("__label").isin(0, 1) & F.col("__id").isNotNull() & ~held_out(F.col("__id")))
    share = fit_rows / max(known.count(), 1)
    order = F.xxhash64("__id", F.lit("quality fit"))
    known = known.where(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = stored(docs.select(F.col(id_col).alias("__id"), F.coalesce(text_col, F.lit("")).alias("__text"))
                  .join(F.broadcast(known), "__id")  # about fit_rows rows of two numbers
                  .select(order.alias("__order"), "__text", "__label"), "quality-fit")

    def train(batches):
        trainer, hasher, seen = Trainer(params), Hasher(), []
        for b in batches:
            for text, label in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                index, value = vector(hasher.slots(TOKENS.findall(text)))
                index = np.append(index, 1 << BITS)
                value = np.append(value, 1.0)
                trainer.update(index, value, label)
                seen.append((index.astype(np.int32), value.astype(np.float32), label))
        for _ in range(params.epochs - 1):
            for index, value, label in seen:
                trainer.update(index, value, label)
        w = trainer.weights(np.arange((1 << BITS) + 1))
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary())], ["weights"])

    got = rows.repartition(1).sortWithinPartitions("__order", "__text", "__label").mapInArrow(train, "weights binary")
    trained = got.first()
    return np.frombuffer(trained["weights"]) if trained else np.zeros((1 << BITS) + 1)


def score(df: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: doc_id, score."""
    shared = df.sparkSession.sparkContext.broadcast(weights)  # 1 << BITS numbers

    def run(batches):
        w, hasher = shared.value, Hasher()
        bias = float(w[-1])
        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                tokens = TOKENS.findall(text) if text else []
                if not tokens:
                    out.append(sigmoid(bias))
                    continue
                index, value = vector(hasher.slots(tokens))
                out.append(sigmoid(float(w[index] @ value) + bias))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def quality_classifier(docs: DataFrame, labels: DataFrame, params: Ftrl = Ftrl(), fit_rows: int = FIT_ROWS,
                       id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Fit on labelled training rows and score all rows: doc_id, held_out, score, predicted."""
    weights = fit(docs, labels, params, fit_rows, id_col, text_col, label_col)
    return (score(docs, weights, id_col, text_col)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))
