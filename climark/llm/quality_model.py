"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words, whatever its length;
whole texts are read, and a long bag is scored in chunks of ``MAX_PASSAGES`` with
running sums of the softmax.  Every passage is encoded by a small network from its character and
word statistics; gated attention, ``softmax(w . (tanh(V h) * sigmoid(U h)))``,
weighs the passages, and the weighted sum of their encodings gives the score.
Only document labels train it: encoder, attention and output together, by
Adam on the cross entropy.

Training takes at most ``SAMPLE`` labelled rows outside the held-out fold (those
with the smallest hash of doc_id), whose features are computed on the
executors; of these rows the driver takes whole bags, by the same hash, up to
``TRAIN_PASSAGES`` passages in all (a bag longer than what is left is passed over).

Defined results for odd input: a null or empty text is one passage without
words and gets a score like any other; null labels and null ids train nothing;
a document with several labels counts with each; of rows that repeat a sampled
doc_id the one with the smallest text trains; without labelled rows every
score is 0.5; repeated rows are scored one by one; further columns are ignored
by ``score``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climark.llm.common import held_out, stored

PASSAGE_WORDS = 64
MAX_PASSAGES = 64       # of a chunk
SAMPLE = 6000
TRAIN_PASSAGES = 1 << 18
AT_ONCE = 1 << 14       # passages encoded together
HIDDEN, ATTENTION = 24, 12
EPOCHS, BATCH, RATE, DECAY = 30, 128, 0.01, 1e-4

# Character classes whose share of a passage is a feature.
_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&", b"|<>=_~^\\@", b".", b"!?", b",;:", b"\"'()[]{}",
            bytes(range(128, 256)), b"aeiou"]
FEATURES = len(_CLASSES) + 9
_SPACE = re.compile("[\x20\x09-\x0D]+")


def passages(text: str | None) -> np.ndarray:
    """Features of the first chunk of passages of a text, one row each."""
    return next(chunks(text))


def chunks(text: str | None) -> Iterator[np.ndarray]:
    """Features of all passages of a text, at most ``MAX_PASSAGES`` rows at a time."""
    ws = (text or "").split()
    if not ws:
        row = np.zeros((1, FEATURES), np.float32)
        row[0, -1] = 1.0
        yield row
        return
    size = PASSAGE_WORDS
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in ws), np.int64, len(ws))
    again = np.zeros(len(ws))
    if len(ws) >= 3:
        windows = (ids[:-2] * len(known) + ids[1:-1]) * len(known) + ids[2:]
        _, at, counts = np.unique(windows, return_inverse=True, return_counts=True)
        again[:-2] = counts[at] > 1
    lines = text.split("\n")
    same_lines = 1 - len(set(lines)) / len(lines)
    out = []
    for k in range(0, len(ws), size):
        part = ws[k:k + size]
        raw = " ".join(part).encode("utf-8", "surrogatepass")
        n, m = len(raw), len(part)
        shares = [(n - len(raw.translate(None, c))) / n for c in _CLASSES]
        out.append([*shares, min(n / m, 40) / 10, len(set(part)) / m, again[k:k + size].mean(), same_lines,
                    sum(w[0].isupper() for w in part) / m, max(map(len, part)) / 40 if m else 0,
                    np.log1p(len(ws)) / 8, np.log1p(m) / 5, 0.0])
        if len(out) == MAX_PASSAGES:
            yield np.minimum(np.array(out, np.float32), 8.0)
            out = []
    if out:
        yield np.minimum(np.array(out, np.float32), 8.0)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict

    def score(self, bags: Iterable[Iterable[np.ndarray]]) -> np.ndarray:
        """Scores of bags, each given as its chunks."""
        w, top, total, z, held, n_held = self.weights, [], [], [], [], 0

        def flush():
            rows = (np.concatenate([c for _, c in held]) - self.mean) / self.scale
            begin = np.concatenate([[0], np.cumsum([len(c) for _, c in held])[:-1]])
            group = np.repeat(np.arange(len(held)), [len(c) for _, c in held])
            h, _, _, e = _encoded(w, rows)
            most = np.maximum.reduceat(e, begin)
            e = np.exp(e - most[group])
            sums, own = np.add.reduceat(e, begin), np.add.reduceat(e[:, None] * h, begin, axis=0)
            for j, (k, _) in enumerate(held):               # running softmax sums
                new = max(top[k], most[j])
                old, add = np.exp(top[k] - new), np.exp(most[j] - new)
                top[k], total[k], z[k] = new, total[k] * old + sums[j] * add, z[k] * old + own[j] * add

        for k, bag in enumerate(bags):
            top.append(-np.inf), total.append(0.0), z.append(np.zeros(HIDDEN))
            for chunk in bag if w else ():
                held.append((k, chunk))
                n_held += len(chunk)
                if n_held >= AT_ONCE:
                    flush()
                    held, n_held = [], 0
        if held:
            flush()
        if not w or not top:
            return np.full(len(top), 0.5)
        return _sigmoid(np.array(z) / np.array(total)[:, None] @ w["c"] + w["c0"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _encoded(w: dict, rows: np.ndarray):
    """Encodings of passages, both gates, and the attention before the softmax."""
    h = np.tanh(rows @ w["We"] + w["be"])
    t, s = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    return h, t, s, (t * s) @ w["w"]


def _forward(w: dict, rows: np.ndarray, begin: np.ndarray):
    """Scores of bags (rows from ``begin`` on) and what the gradient needs."""
    group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(rows))))
    h, t, s, e = _encoded(w, rows)
    e = np.exp(e - np.maximum.reduceat(e, begin)[group])
    a = e / np.add.reduceat(e, begin)[group]
    z = np.add.reduceat(a[:, None] * h, begin, axis=0)
    p = _sigmoid(z @ w["c"] + w["c0"])
    return p, (group, h, t, s, a, z)


def _gradient(w: dict, rows: np.ndarray, begin: np.ndarray, y: np.ndarray) -> dict:
    p, (group, h, t, s, a, z) = _forward(w, rows, begin)
    d = (p - y) / len(y)
    dz = d[:, None] * w["c"]
    da = (dz[group] * h).sum(axis=1)
    de = a * (da - np.add.reduceat(a * da, begin)[group])
    dt, ds = de[:, None] * w["w"] * s * (1 - t * t), de[:, None] * w["w"] * t * s * (1 - s)
    dh = (a[:, None] * dz[group] + dt @ w["V"].T + ds @ w["U"].T) * (1 - h * h)
    return {"We": rows.T @ dh, "be": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": ((t * s) * de[:, None]).sum(axis=0),
            "c": z.T @ d, "c0": d.sum()}


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Train on bags of passages and 0/1 labels."""
    if not bags:
        return Model(np.zeros(FEATURES), np.ones(FEATURES), {})
    every = np.concatenate(bags)
    model = Model(every.mean(axis=0), every.std(axis=0) + 1e-3, {})
    rng = np.random.default_rng(seed)
    w = {"We": rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, HIDDEN)), "be": np.zeros(HIDDEN),
         "V": rng.normal(0, 0.3, (HIDDEN, ATTENTION)), "U": rng.normal(0, 0.3, (HIDDEN, ATTENTION)),
         "w": rng.normal(0, 0.3, ATTENTION), "c": rng.normal(0, 0.3, HIDDEN), "c0": np.zeros(())}
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    scaled = [(b - model.mean) / model.scale for b in bags]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            own = [scaled[k] for k in pick]
            begin = np.concatenate([[0], np.cumsum([len(b) for b in own])[:-1]])
            grad = _gradient(w, np.concatenate(own), begin, labels[pick])
            step += 1
            rate = RATE * 0.5 ** (epoch / 10)
            for k, g in grad.items():
                g = g + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    model.weights = w
    return model


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most ``sample`` labelled documents outside the held-out fold."""
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_label")).filter(
        F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id"))).distinct()
    chosen = known.orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample)      # bounded, so it may be broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")).join(
        F.broadcast(chosen), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.concatenate(list(chunks(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(map(len, own), pa.int64()),
                 pa.array([b.tobytes() for b in own], pa.binary())], names=["id", "label", "n", "bag"])

    found = stored(rows.select("_id", "_text", "_label").mapInArrow(bags, "id long, label int, n long, bag binary"),
                   "quality_bags")
    sizes = found.select(F.xxhash64("id"), "id", "label", "n").collect()        # at most ``sample`` rows
    room, chosen = TRAIN_PASSAGES, []
    for _, i, label, n in sorted(map(tuple, sizes)):
        if n <= room:                       # a document too long for the room left is passed over
            chosen.append((i, label))
            room -= n
    if not chosen:
        return fit([], np.zeros(0))
    within = F.broadcast(docs.sparkSession.createDataFrame(chosen, "id long, label int"))
    got = sorted((r["id"], r["label"], bytes(r["bag"])) for r in found.join(within, ["id", "label"]).collect())
    return fit([np.frombuffer(b, np.float32).reshape(-1, FEATURES) for _, _, b in got], np.array([x for _, x, _ in got], float))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, score (0 to 1, higher: label 1 likelier)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            scores = [shared.value.score(map(chunks, texts[k:k + 512])) for k in range(0, len(texts), 512)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate([np.zeros(0), *scores]))], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")
