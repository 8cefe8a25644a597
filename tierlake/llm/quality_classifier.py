"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Every passage of the whole text is described by figures
over its bytes and words; a learned layer encodes them; gated attention weighs the passages against
each other; the weighted sum is scored. Only the document has a label, yet a few bad passages
can decide, because the attention learns where to look.

Fitting takes a sample of labelled rows bounded by ``max_documents`` (the smallest hashes of doc_id,
so reruns agree), one row for each id and at most ``max_passages`` passages of it, spread over its whole
text; it runs on the driver in vectors. Scoring runs on every passage of every document in Arrow batches.
Only the text enters a score. Labels come from rows whose crc32(doc_id as text) mod 5 is not 0.

Null, empty and word-free texts are one passage without words. Rows without label or doc_id are scored,
not learned from. A doc_id that repeats in ``labels`` is learned with its smallest label, one that repeats
in the documents from the row whose passages have the smallest hash. With
no usable label of one kind every score is 0.5. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierlake.llm import text as T

PASSAGE_WORDS = 64
HIDDEN, ATTENTION = 16, 8
# Bounds of the sample that is fitted on: 3,000 documents of 128 passages are 31 MB of figures on the driver.
MAX_DOCUMENTS, MAX_PASSAGES = 3000, 128
EPOCHS, RATE, PENALTY, SEED = 250, 0.02, 1e-4, 7
THRESHOLD = 0.3

# Byte classes whose share of a passage is a feature.
CLASSES = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "!", "?", ".,;:", "|", "#*$%&<>", "()[]{}", "-_=+/\\", "\"'", "\n"]
_CLASS = np.full(256, len(CLASSES), np.int64)
for _k, _bytes in enumerate(CLASSES):
    _CLASS[list(_bytes.encode())] = _k
_CLASS[128:] = len(CLASSES) + 1
N_CLASSES = len(CLASSES) + 2
N_FEATURES = N_CLASSES + 7


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and where each text's passages begin (one more at the end)."""
    words = T.Words(data, offsets)
    per_text = np.diff(words.first)
    counts = np.maximum(1, -(-per_text // PASSAGE_WORDS))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    features = np.zeros((bounds[-1], N_FEATURES))
    if len(words.starts) == 0:
        return features, bounds
    within = np.arange(len(words.starts)) - words.first[words.text]
    owner = bounds[words.text] + within // PASSAGE_WORDS
    begins = np.flatnonzero(within % PASSAGE_WORDS == 0)
    filled = owner[begins]
    sizes = np.diff(np.append(begins, len(owner)))
    # Bytes of a passage reach from its first word to the next passage or the end of the text.
    starts = words.starts[begins]
    stops = np.append(starts[1:], len(data))
    last = np.append(words.text[begins][1:] != words.text[begins][:-1], True)
    stops[last] = offsets[words.text[begins][last] + 1]
    code = _CLASS[data]
    length = (stops - starts).astype(float)
    for k in range(N_CLASSES):
        total = np.concatenate([[0], np.cumsum(code == k)])
        features[filled, k] = (total[stops] - total[starts]) / length
    h = words.hashes()
    chars = (words.ends - words.starts).astype(float)
    order = np.lexsort((h, owner))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    mean = np.add.reduceat(chars, begins) / sizes
    figures = [
        mean / 10,
        np.sqrt(np.maximum(np.add.reduceat(chars * chars, begins) / sizes - mean**2, 0)) / 10,
        np.bincount(owner[order], fresh, bounds[-1])[filled] / sizes,
        np.add.reduceat(same, begins) / sizes,
        np.add.reduceat((chars == 1).astype(float), begins) / sizes,
        np.log1p(per_text[words.text[begins]]) / 10,
        np.ones(len(begins)),
    ]
    features[filled[:, None], N_CLASSES + np.arange(len(figures))] = np.stack(figures, axis=1)
    return features, bounds


@dataclass
class Model:
    """Weights of the encoder, the gated attention and the score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return _forward(self.weights, (features - self.mean) / self.scale, bounds)["score"]


def _forward(w: dict[str, np.ndarray], x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    starts, owner = bounds[:-1], np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    h = np.tanh(x @ w["encode"] + w["shift"])
    view, gate = np.tanh(h @ w["view"]), 1 / (1 + np.exp(-(h @ w["gate"])))
    energy = (view * gate) @ w["attend"]
    energy = np.exp(energy - np.maximum.reduceat(energy, starts)[owner])
    share = energy / np.add.reduceat(energy, starts)[owner]
    pooled = np.add.reduceat(share[:, None] * h, starts)
    score = 1 / (1 + np.exp(-(pooled @ w["out"] + w["bias"][0])))
    return {"h": h, "view": view, "gate": gate, "share": share, "pooled": pooled, "score": score, "owner": owner}


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(w, x, bounds)
    owner, starts, h = f["owner"], bounds[:-1], f["h"]
    off = (f["score"] - labels) / len(labels)
    to_pool = off[:, None] * w["out"]
    by_share = (h * to_pool[owner]).sum(axis=1)
    to_energy = f["share"] * (by_share - np.add.reduceat(f["share"] * by_share, starts)[owner])
    to_view = to_energy[:, None] * w["attend"] * f["gate"] * (1 - f["view"] ** 2)
    to_gate = to_energy[:, None] * w["attend"] * f["view"] * f["gate"] * (1 - f["gate"])
    to_h = f["share"][:, None] * to_pool[owner] + to_view @ w["view"].T + to_gate @ w["gate"].T
    to_x = to_h * (1 - h**2)
    grads = {
        "encode": x.T @ to_x, "shift": to_x.sum(axis=0), "view": h.T @ to_view, "gate": h.T @ to_gate,
        "attend": (f["view"] * f["gate"]).T @ to_energy, "out": f["pooled"].T @ off, "bias": np.array([off.sum()]),
    }
    return {k: g + PENALTY * w[k] for k, g in grads.items()}


def fit(features: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> Model:
    """Learn from bags of passages by full-batch Adam, from fixed starting weights."""
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x = (features - mean) / scale
    rng = np.random.default_rng(SEED)
    shapes = {
        "encode": (N_FEATURES, HIDDEN), "shift": (HIDDEN,), "view": (HIDDEN, ATTENTION), "gate": (HIDDEN, ATTENTION),
        "attend": (ATTENTION,), "out": (HIDDEN,), "bias": (1,),
    }
    w = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shapes.items()}
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, EPOCHS + 1):
        for k, g in _gradients(w, x, bounds, labels).items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            w[k] = w[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Model(mean, scale, w)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def spread_passages(count: int, most: int) -> np.ndarray:
    """Places of at most ``most`` of ``count`` passages, by a hash of the place that spreads them evenly."""
    if count <= most:
        return np.arange(count)
    order = np.argsort(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.sort(order[:most])


def sample(docs: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS, max_passages: int = MAX_PASSAGES) -> DataFrame:
    """(doc_id, quality, features) of the documents to fit on: one row for each id, none of them held out."""
    labels = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = labels.filter(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents)
    known = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _described(batches, max_passages)

    # Passages' figures, not texts, are compared and moved: some 80 bytes for each of them.
    bags = known.mapInArrow(described, "doc_id bigint, quality int, features binary")
    least = bags.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("features"), "quality", "features")).alias("row"))
    return least.select("doc_id", "row.quality", "row.features")


def train(docs: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS, max_passages: int = MAX_PASSAGES) -> Model | None:
    """Fit on at most ``max_documents`` labelled documents that are not held out, and ``max_passages`` of each."""
    described = sample(docs, labels, max_documents, max_passages).toPandas()
    if described["quality"].nunique() < 2:
        return None
    described = described.sort_values("doc_id")
    bags = [np.frombuffer(x, np.float32).reshape(-1, N_FEATURES) for x in described["features"]]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in bags])])
    return fit(np.concatenate(bags).astype(float), bounds, described["quality"].to_numpy(float))


def _described(batches: Iterator[pa.RecordBatch], max_passages: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, quality = T.column(batch, "doc_id"), T.column(batch, "quality").cast(pa.int32())
        for row, end, data, offsets in T.slices(T.column(batch, "text")):
            features, bounds = passages(data, offsets)
            bags = [
                features[a + spread_passages(b - a, max_passages)].astype(np.float32).tobytes()
                for a, b in zip(bounds[:-1], bounds[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(row, end - row), quality.slice(row, end - row), pa.array(bags, pa.binary())],
                ["doc_id", "quality", "features"],
            )


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = T.column(batch, "doc_id")
            for row, end, data, offsets in T.slices(T.column(batch, "text")):
                known = model.score(*passages(data, offsets)) if model else np.full(end - row, 0.5)
                yield pa.RecordBatch.from_arrays([ids.slice(row, end - row), pa.array(known, pa.float64())], ["doc_id", "score"])

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(scored, "doc_id bigint, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold."""

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [np.zeros(0, bool)]
            for row, end, data, offsets in T.slices(T.column(batch, "text")):
                keep.append(model.score(*passages(data, offsets)) >= THRESHOLD if model else np.ones(end - row, bool))
            yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(good, docs.schema)
