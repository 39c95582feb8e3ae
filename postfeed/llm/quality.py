"""A quality classifier: a byte-level convolutional network in numpy.

A document is covered by overlapping chunks of bytes. In each chunk learned filters run over the embedded
bytes, and each filter's response is pooled by its maximum over the chunk. Over all chunks of the document the
maxima are pooled by their maximum and their mean, and go through a hidden layer to one probability.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postfeed.llm.common import few, slices, written

# Bytes of a chunk, and how many of them the next chunk repeats.
CHUNK, OVERLAP = 512, 64

# Embedding size, filter width, filters and hidden units.
EMBED, WIDTH, FILTERS, HIDDEN = 6, 6, 20, 12

# Labelled rows that a model is fitted on at most, and bytes of their texts, for each of the two labels. All chunks of
# a row are learnt from.
TRAIN_ROWS, TRAIN_BYTES = 800, 6 << 20
BATCH, RATE, SEED = 32, 0.01, 7

# Passes over the sample, more of them where it is small, so that there are STEPS steps at least.
EPOCHS, STEPS = 8, 400

# Remainder of crc32(id as text) modulo FOLDS that marks rows a model never learns from.
FOLDS, HELD_OUT = 5, 0

# Score from which a document is kept.
KEEP_FROM = 0.3


def chunk_matrix(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All chunks of all texts as rows of bytes, 0 beyond a text's end, and the text each belongs to."""
    step = CHUNK - OVERLAP
    starts, owner, base = [], [], 0
    for i, text in enumerate(texts):
        own = np.arange(0, max(1, len(text) - OVERLAP), step)
        starts.append(own + base)
        owner.append(np.full(len(own), i))
        base += len(text)
    ends = np.cumsum([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts) + b"\0" * CHUNK, dtype=np.uint8)
    starts, owner = np.concatenate(starts), np.concatenate(owner)
    rows = np.lib.stride_tricks.sliding_window_view(data, CHUNK)[starts].copy()
    left = ends[owner] - starts
    short = np.flatnonzero(left < CHUNK)
    for k in short:
        rows[k, max(0, left[k]) :] = 0
    return rows, owner


@dataclass
class Model:
    """The weights; ``prior`` is the answer where there was nothing to learn from."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    prior: float | None = None

    def responses(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows of embedded bytes, flattened, and what the filters say to each."""
        embedded = self.embed[rows]
        windows = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH, axis=1)
        flat = windows.transpose(0, 1, 3, 2).reshape(len(rows), CHUNK - WIDTH + 1, WIDTH * EMBED)
        return flat, np.maximum(flat @ self.filters + self.bias, 0)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.prior is not None or not texts:
            return np.full(len(texts), self.prior or 0.0)
        rows, owner = chunk_matrix(texts)
        top = [self.responses(rows[at : at + 256])[1].max(axis=1) for at in range(0, len(rows), 256)]
        features = pooled(np.concatenate(top), owner, len(texts))
        inner = np.maximum((features - self.centre) / self.scale @ self.hidden + self.hidden_bias, 0)
        return 1 / (1 + np.exp(-np.clip(inner @ self.out + self.out_bias, -30, 30)))


def pooled(top: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Features of each text: the maximum and the mean over its chunks of what each chunk gives."""
    first = np.searchsorted(owner, np.arange(n))
    counts = np.bincount(owner, minlength=n)[:, None]
    return np.concatenate([np.maximum.reduceat(top, first), np.add.reduceat(top, first) / counts], axis=1)


def fit(samples: list[np.ndarray], labels: list[int]) -> Model:
    """Fits all weights by gradient descent with adaptive steps; the same rows give the same model.

    A sample is the matrix of a document's chunks.
    """
    rng = np.random.default_rng(SEED)
    n_features = 2 * FILTERS
    f32 = np.float32
    model = Model(
        rng.normal(0, 0.5, (256, EMBED)).astype(f32), rng.normal(0, 0.3, (WIDTH * EMBED, FILTERS)).astype(f32), np.zeros(FILTERS, f32),
        np.zeros(n_features, f32), np.ones(n_features, f32), rng.normal(0, 0.2, (n_features, HIDDEN)).astype(f32), np.full(HIDDEN, 0.1, f32),
        rng.normal(0, 0.3, HIDDEN).astype(f32), 0.0,
    )
    y = np.asarray(labels, dtype=f32)
    if len(set(labels)) < 2:
        model.prior = float(y.mean()) if len(y) else 0.5
        return model
    rows = np.concatenate(samples)
    first = np.concatenate([[0], np.cumsum([len(s) for s in samples])])
    names = ["embed", "filters", "bias", "hidden", "hidden_bias", "out"]
    moments = {k: (np.zeros_like(getattr(model, k)), np.zeros_like(getattr(model, k))) for k in names}
    step = 0
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(samples)))):
        order = rng.permutation(len(samples))
        for at in range(0, len(order), BATCH):
            docs = order[at : at + BATCH]
            chunks = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
            own = np.repeat(np.arange(len(docs)), [first[d + 1] - first[d] for d in docs])
            part = rows[chunks]
            flat, said = model.responses(part)
            where = said.argmax(axis=1)
            top = said.max(axis=1)
            features = pooled(top, own, len(docs))
            x = ((features - model.centre) / model.scale).astype(f32)
            inner = x @ model.hidden + model.hidden_bias
            active = np.maximum(inner, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ model.out + model.out_bias, -30, 30)))
            d_out = ((p - y[docs]) / len(docs)).astype(f32)
            grads = {"out": active.T @ d_out}
            d_inner = np.outer(d_out, model.out) * (inner > 0)
            grads["hidden"], grads["hidden_bias"] = x.T @ d_inner, d_inner.sum(axis=0)
            d_x = d_inner @ model.hidden.T / model.scale
            # A chunk's maximum goes to the place it came from; the document's goes to its chunk, the mean to all of them.
            doc_first = np.searchsorted(own, np.arange(len(docs)))
            is_top = top == np.maximum.reduceat(top, doc_first)[own]
            d_top = d_x[own, :FILTERS] * is_top + d_x[own, FILTERS:] / np.bincount(own)[own][:, None]
            d_said = np.zeros_like(said)
            np.put_along_axis(d_said, where[:, None, :], (d_top * (top > 0)).astype(f32)[:, None, :], axis=1)
            flat2, d2 = flat.reshape(-1, WIDTH * EMBED), d_said.reshape(-1, FILTERS)
            grads["filters"], grads["bias"] = flat2.T @ d2, d2.sum(axis=0)
            d_flat = (d2 @ model.filters.T).reshape(len(part), -1, WIDTH, EMBED)
            d_embed = np.zeros((256, EMBED), f32)
            for k in range(WIDTH):
                seen = part[:, k : k + d_flat.shape[1]].ravel()
                for e in range(EMBED):
                    d_embed[:, e] += np.bincount(seen, weights=d_flat[:, :, k, e].ravel(), minlength=256)
            grads["embed"] = d_embed
            step += 1
            model.out_bias -= RATE * float(d_out.sum())
            for name in names:
                m, v = moments[name]
                m *= 0.9
                m += 0.1 * grads[name]
                v *= 0.99
                v += 0.01 * grads[name] ** 2
                getattr(model, name)[...] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return model


def training_sample(
    documents: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[list[np.ndarray], list[int]]:
    """All chunks and the label of at most ``rows`` rows of each label, chosen by a hash of the id.

    Rows whose crc32(id as text) leaves HELD_OUT modulo FOLDS are never taken. A row that would bring the texts of its
    label to more than ``most_bytes`` is passed over, so what comes to the driver is bounded; a row that is taken is
    taken whole. Of rows that share an id the one with the shortest, then smallest text counts; a null text is empty.
    """
    pool = labels.where(f"{label} IN (0, 1) AND {id_col} IS NOT NULL").select(F.col(id_col).cast("long").alias("__id"), F.col(label).cast("int").alias("__label"))
    pool = pool.where(F.crc32(F.col("__id").cast("string").cast("binary")) % FOLDS != HELD_OUT).groupBy("__id").agg(F.max("__label").alias("__label"))
    # A few more than needed, as not every labelled id is in the table.
    picked = [pool.where(f"__label = {v}").orderBy(F.xxhash64("__id"), "__id").limit(4 * rows) for v in (0, 1)]
    chosen = picked[0].unionAll(picked[1])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = documents.select(F.col(id_col).cast("long").alias("__id"), text.alias("text")).join(F.broadcast(chosen), "__id")
    sample = written(few(found.groupBy("__id", "__label").agg(F.min(F.struct(F.octet_length("text").alias("size"), "text")).alias("t"))), "sample")
    taken: list[int] = []
    for v in (0, 1):
        left, count = most_bytes, 0
        for r in sample.where(f"__label = {v}").orderBy(F.xxhash64("__id"), "__id").select("__id", "t.size").collect():
            if count < rows and r["size"] <= left:
                left, count = left - r["size"], count + 1
                taken.append(r["__id"])
    got = sample.where(F.col("__id").isin(taken)).orderBy("__label", F.xxhash64("__id"), "__id").select("t.text", "__label").collect()
    return [chunk_matrix([r["text"].encode("utf-8", "surrogatepass")])[0] for r in got], [r["__label"] for r in got]


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", **columns) -> Model:
    """A model fitted on the sample. Without rows of both labels it gives their mean, or 0.5, for every text."""
    return fit(*training_sample(documents, labels, label, **columns))


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``keep``, then doc_id, held_out, score and predicted of each row's whole text.

    Only the text enters the score. A null text is the empty text and gets the model's answer to nothing;
    a null id is never held out. Equal texts get equal scores, whatever stands in other columns.
    """
    columns = list(keep)

    def run(batches):
        for part in slices(batches, "__text"):
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in part.column("__text").to_pylist()]
            ids = part.column("__id").to_pylist()
            scores = model.score(texts)
            held = [i is not None and zlib.crc32(str(i).encode()) % FOLDS == HELD_OUT for i in ids]
            arrays = [part.column(f"__keep_{k}") for k in range(len(columns))] + [
                part.column("__id"), pa.array(held), pa.array(scores.astype(np.float64)), pa.array((scores >= KEEP_FROM).astype(np.int32))]
            yield pa.record_batch(arrays, names=[f"__keep_{k}" for k in range(len(columns))] + ["doc_id", "held_out", "score", "predicted"])

    chosen = documents.select(*[F.col(f"`{c}`").alias(f"__keep_{k}") for k, c in enumerate(columns)], F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"))
    kinds = [f"__keep_{k} {chosen.schema[k].dataType.simpleString()}" for k in range(len(columns))]
    return chosen.mapInArrow(run, ", ".join([*kinds, "doc_id long, held_out boolean, score double, predicted int"]))
