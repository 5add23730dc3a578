"""Language identification by a small convolutional network over bytes, trained in numpy.

A text is cut into fixed-length windows of bytes.  Filters of several widths run over byte embeddings, each filter's
largest response over the window is kept (max pooling), and a softmax layer turns the responses into language
probabilities.  A document's probabilities are the mean of its windows' log-probabilities, weighted by length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from helixframe.llm.common import id_remainder, texts


@dataclass(frozen=True)
class Shape:
    """widths, filters: filters of each width; embed: size of a byte's vector; window: bytes of a window."""

    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    embed: int = 8
    window: int = 192


@dataclass(frozen=True)
class Training:
    """sample: largest number of labelled documents that training reads; windows: largest number taken of each."""

    sample: int = 4000
    windows: int = 3
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


def windows_of(body: bytes, size: int) -> np.ndarray:
    """All windows of the text, one row each; the last is filled with zero bytes."""
    n = max(1, -(-len(body) // size))
    return np.frombuffer(body.ljust(n * size, b"\0"), np.uint8).reshape(n, size)


def start_model(shape: Shape, classes: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    model = {"embed": rng.normal(0, 0.5, (256, shape.embed)).astype(np.float32)}
    for w in shape.widths:
        model[f"filter{w}"] = rng.normal(0, 1 / np.sqrt(w * shape.embed), (w * shape.embed, shape.filters)).astype(np.float32)
        model[f"bias{w}"] = np.zeros(shape.filters, np.float32)
    hidden = shape.filters * len(shape.widths)
    model["out"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, classes)).astype(np.float32)
    model["out_bias"] = np.zeros(classes, np.float32)
    return model


def patches(x: np.ndarray, w: int) -> np.ndarray:
    """(rows, places, w * embed) of embedded windows."""
    return np.concatenate([x[:, i : x.shape[1] - w + 1 + i] for i in range(w)], axis=2)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: np.ndarray, labels: np.ndarray, classes: int, shape: Shape, how: Training) -> dict[str, np.ndarray]:
    """Adam on the cross entropy; gradients flow only through each filter's largest response."""
    model, rng = start_model(shape, classes, how.seed), np.random.default_rng(how.seed)
    first, second, step = {k: np.zeros_like(v) for k, v in model.items()}, {k: np.zeros_like(v) for k, v in model.items()}, 0
    for epoch in range(how.epochs):
        rate = how.rate / (1 + epoch)
        order = rng.permutation(len(rows))
        for begin in range(0, len(rows), how.batch):
            pick = order[begin : begin + how.batch]
            r, y = rows[pick], labels[pick]
            x, n = model["embed"][r], len(pick)
            pooled, best = [], {}
            for w in shape.widths:
                response = patches(x, w) @ model[f"filter{w}"]
                best[w] = response.argmax(axis=1)
                top = np.take_along_axis(response, best[w][:, None, :], 1)[:, 0] + model[f"bias{w}"]
                pooled.append(np.maximum(top, 0))
            h = np.concatenate(pooled, axis=1)
            d = softmax(h @ model["out"] + model["out_bias"])
            d[np.arange(n), y] -= 1
            d /= n
            grad = {"out": h.T @ d, "out_bias": d.sum(axis=0), "embed": np.zeros_like(model["embed"])}
            dh = (d @ model["out"].T) * (h > 0)
            for k, w in enumerate(shape.widths):
                g = dh[:, k * shape.filters : (k + 1) * shape.filters]
                at = best[w][:, :, None] + np.arange(w)  # (rows, filters, w): bytes under the winning place
                codes = r[np.arange(n)[:, None, None], at]
                seen = model["embed"][codes].reshape(n, shape.filters, -1)
                grad[f"filter{w}"] = np.einsum("nf,nfe->ef", g, seen)
                grad[f"bias{w}"] = g.sum(axis=0)
                back = (g[:, :, None] * model[f"filter{w}"].T[None]).reshape(n, shape.filters, w, shape.embed)
                np.add.at(grad["embed"], codes.ravel(), back.reshape(-1, shape.embed))
            step += 1
            for key, g in grad.items():
                first[key] = 0.9 * first[key] + 0.1 * g
                second[key] = 0.999 * second[key] + 0.001 * g * g
                model[key] = (model[key] - rate * (first[key] / (1 - 0.9**step)) / (np.sqrt(second[key] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


class Scorer:
    """Log-probabilities of windows.  A filter's response is a sum of one table row for each byte it covers."""

    def __init__(self, model: dict[str, np.ndarray], shape: Shape):
        self.model, self.shape = model, shape
        self.tables = {}
        for w in shape.widths:
            parts = model[f"filter{w}"].reshape(w, shape.embed, shape.filters)
            single = [model["embed"] @ parts[i] for i in range(w)]
            pairs = [(single[i][:, None, :] + single[i + 1][None, :, :]).reshape(65536, -1) for i in range(0, w - 1, 2)]
            self.tables[w] = (pairs, single[-1] if w % 2 else None)

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        shape, out = self.shape, []
        for begin in range(0, len(rows), 32):
            r = rows[begin : begin + 32]
            pair = r[:, :-1].astype(np.int32) * 256 + r[:, 1:]
            pooled = []
            for w in shape.widths:
                places = r.shape[1] - w + 1
                tables, single = self.tables[w]
                response = None
                for k, table in enumerate(tables):
                    part = table[pair[:, 2 * k : 2 * k + places]]
                    response = part if response is None else np.add(response, part, out=response)
                if single is not None:
                    response += single[r[:, w - 1 : w - 1 + places]]
                pooled.append(np.maximum(response.max(axis=1) + self.model[f"bias{w}"], 0))
            z = np.concatenate(pooled, axis=1) @ self.model["out"] + self.model["out_bias"]
            z -= z.max(axis=1, keepdims=True)
            out.append(z - np.log(np.exp(z).sum(axis=1, keepdims=True)))
        return np.concatenate(out)


@dataclass
class LanguageModel:
    languages: list[str]
    weights: dict[str, np.ndarray]
    shape: Shape


def fit(docs: DataFrame, held_out: int = 1, modulus: int = 3, shape: Shape = Shape(), how: Training = Training(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel | None:
    """The network learned from at most `how.sample` labelled documents outside the held-out remainder.

    The sample is the first by a hash of the id, so it is the same in every run.  None if nothing is labelled.
    """
    remainder = id_remainder(id_col, modulus)
    rows = docs.where((remainder != held_out) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    # A training document gives windows that start at its beginning, its first and its second third, read as bytes.
    body = F.col(text_col).cast("string").cast("binary")
    size, n = shape.window, F.length(body)
    parts = [F.substring(body, F.greatest(F.lit(1), (n * k / how.windows).cast("int") + 1), F.lit(size)) for k in range(how.windows)]
    sample = rows.select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col)).alias("h"), F.array(*parts).alias("parts")).orderBy("h", "lang").limit(how.sample).collect()
    languages = sorted({r["lang"] for r in sample})
    if not languages:
        return None
    windows, labels = [], []
    for r in sample:
        for part in {bytes(p) for p in r["parts"] if p and len(p) >= 8}:
            windows.append(windows_of(part, size)[0])
            labels.append(languages.index(r["lang"]))
    if not windows:
        return None
    return LanguageModel(languages, train(np.array(windows), np.array(labels), len(languages), shape, how), shape)


ASCII_LETTER = re.compile(rb"[A-Za-z]")
SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("n_windows", pa.int64())])


def has_letter(body: bytes) -> bool:
    return bool(ASCII_LETTER.search(body)) or any(c.isalpha() for c in body.decode("utf-8", "replace"))


def predict(docs: DataFrame, model: LanguageModel | None, held_out: int = 1, modulus: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score and n_windows of every row, over all windows of the whole text.

    `und` with score 0 where the text is null or has no letter, or where nothing could be learned.  A null id is not
    held out.  Repeated rows are scored one by one; an empty table gives an empty result; other columns are ignored.
    """
    held = F.coalesce(id_remainder(id_col, modulus) == held_out, F.lit(False)).alias("held")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.weights, model.shape) if model else None
        for batch in batches:
            out = []
            for doc_id, body, held_row in zip(*(batch.column(c).to_pylist() for c in ("id", "body", "held")), strict=True):
                if not body or scorer is None or not has_letter(body):
                    out.append((doc_id, held_row, "und", 0.0, 0))
                    continue
                rows = windows_of(body, model.shape.window)
                weight = np.full(len(rows), model.shape.window, float)
                weight[-1] -= len(rows) * model.shape.window - len(body)
                p = softmax((scorer.log_probabilities(rows) * weight[:, None]).sum(axis=0, keepdims=True) / weight.sum())[0]
                best = int(p.argmax())
                out.append((doc_id, held_row, model.languages[best], float(p[best]), len(rows)))
            columns = list(zip(*out, strict=True)) or [()] * len(SCHEMA)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, SCHEMA.types, strict=True)], schema=SCHEMA)

    return texts(docs, id_col, text_col, held).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, n_windows long")
