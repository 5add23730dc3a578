"""Toxicity by compression distance: which of two zstandard dictionaries shortens a text's windows more.

An ordinary dictionary is trained on ordinary text.  The toxic dictionary holds the same content and, at its end, the
segments that are typical of toxic text; in the ordinary one that place is blank, so offsets cost the same and only
those segments make a difference.  Each window of words is compressed with both; the document's windows give a few
shares and counts above thresholds, and a logistic curve fitted to labelled rows turns them into a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from helixframe.llm.common import id_remainder, texts

NOT_WORD = re.compile(rb"[^a-z\x80-\xff]+")
GRAM = 6
MULTIPLIERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


@dataclass(frozen=True)
class Training:
    """toxic, ordinary: most labelled documents read of each; most_bytes: longer documents are not sampled.

    A segment is typical where its 6-byte pieces are in at least `least_docs` toxic documents, `least_z` standard
    deviations above what their frequency in both kinds lets expect, and if at least `least_share` of the documents with
    it are toxic.  Copies and near copies count once.
    """

    toxic: int = 1500
    ordinary: int = 3000
    most_bytes: int = 32_768
    dictionary_bytes: int = 16_384
    segment_bytes: int = 2048
    least_docs: int = 4
    least_z: float = 6.0
    least_share: float = 0.75
    window_words: int = 12
    level: int = 6
    min_match: int = 6


def plain(body: bytes) -> bytes:
    """Lower-case words with one blank between them and at both ends."""
    return b" " + NOT_WORD.sub(b" ", body.lower()).strip() + b" "


def windows(body: bytes, size: int) -> list[bytes]:
    words = plain(body).split()
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, max(1, len(words)), size)]


def grams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The 6-byte pieces at every place as numbers, and whether a piece lies inside one word (with its blanks)."""
    n = len(text) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, bool)
    codes = np.frombuffer(text, np.uint8)
    value, inner = np.zeros(n, np.uint64), np.zeros(n, bool)
    for j in range(GRAM):
        value = (value << np.uint64(8)) | codes[j : n + j]
        if 0 < j < GRAM - 1:
            inner |= codes[j : n + j] == 32
    return value, ~inner


def unlike(texts_of_kind: list[bytes]) -> list[bytes]:
    """One text of each group of copies and near copies: those with two equal min-hashes of their pieces count as one."""
    kept: dict[tuple, bytes] = {}
    for text in texts_of_kind:
        value = grams(text)[0]
        key = tuple(int((((value ^ (value >> np.uint64(29))) * m) ^ (value >> np.uint64(7))).min()) for m in MULTIPLIERS) if len(value) else (text,)
        kept.setdefault(key, text)
    return list(kept.values())


def document_grams(docs: list[bytes]) -> np.ndarray:
    parts = [np.unique(value[inside]) for value, inside in map(grams, docs)]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def typical_segments(toxic: list[bytes], ordinary: list[bytes], how: Training) -> bytes:
    """Stretches of toxic documents whose pieces are over-represented there, most frequent last (nearest to the window)."""
    ours, theirs = document_grams(toxic), document_grams(ordinary)
    pieces, n1 = np.unique(ours, return_counts=True)
    pieces, n1 = pieces[n1 >= how.least_docs], n1[n1 >= how.least_docs]
    if not len(pieces):
        return b""
    at = np.searchsorted(pieces, theirs)
    at = at[(at < len(pieces)) & (pieces[np.minimum(at, len(pieces) - 1)] == theirs)]
    n = n1 + np.bincount(at, minlength=len(pieces))
    share = len(ours) / max(1, len(ours) + len(theirs))
    z = (n1 - n * share) / np.sqrt(n * share * (1 - share) + 1e-9)
    chosen = pieces[(z > how.least_z) & (n1 >= how.least_share * n)]
    found: Counter = Counter()
    for text in toxic:
        value, inside = grams(text)
        places = np.flatnonzero(np.isin(value, chosen) & inside)
        if len(places):
            cuts = np.flatnonzero(np.diff(places) > 1)
            for a, b in zip(np.r_[places[0], places[cuts + 1]], np.r_[places[cuts], places[-1]], strict=True):
                found[text[a : b + GRAM]] += 1
    kept, size = [], 0
    for segment, count in sorted(found.items(), key=lambda s: (-s[1], s[0])):
        if count >= 3 and size + len(segment) <= how.segment_bytes:
            kept.append(segment)
            size += len(segment)
    return b"".join(reversed(kept))


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    how: Training


class Comparer:
    """Compressed length of a window with the ordinary dictionary less that with the toxic one."""

    def __init__(self, ordinary: bytes, toxic: bytes, how: Training):
        self.pair = [self.compressor(d, how) for d in (ordinary, toxic)]
        self.size = how.window_words

    @staticmethod
    def compressor(content: bytes, how: Training) -> zstandard.ZstdCompressor:
        settings = zstandard.ZstdCompressionParameters.from_level(how.level, source_size=64, dict_size=len(content), min_match=how.min_match, write_content_size=False, write_dict_id=False, write_checksum=False)
        return zstandard.ZstdCompressor(compression_params=settings, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))

    def features(self, body: bytes) -> list[float]:
        a, b = (c.compress for c in self.pair)
        gain = np.array([len(a(w)) - len(b(w)) for w in windows(body, self.size)], float)
        at_least = [(gain >= t).sum() for t in (1, 2, 4)]
        n = len(gain)
        return [1.0, gain.mean(), min(gain.max(), 8.0), *(k / n for k in at_least), min(4, at_least[1]), min(4, at_least[2]), np.log(n), (gain <= -1).mean()]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    pull = ridge * np.r_[1e-6, np.ones(len(w) - 1)]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (p - y) + pull * w)
    return w


def learn(toxic: list[bytes], ordinary: list[bytes], how: Training = Training()) -> Model:
    """The model of so many labelled texts; without any of one kind the score is the share of toxic labels.

    The texts may hold the kinds in other shares than the labels do: `fit` moves the constant.
    """
    share = len(toxic) / max(1, len(toxic) + len(ordinary))
    base = np.zeros(10)
    base[0] = np.log((share + 1e-6) / (1 - share + 1e-6))
    if not toxic or not ordinary:
        return Model(b"", b"", base, how)
    ours, theirs = [plain(t) for t in toxic], [plain(t) for t in ordinary]
    samples = [t[i : i + 400] for t in theirs for i in range(0, len(t), 400)][:20_000]
    try:
        common = zstandard.train_dictionary(how.dictionary_bytes, samples, k=16, d=6).as_bytes()
    except zstandard.ZstdError:  # too little text for a training: the text itself
        common = b"".join(samples)[: how.dictionary_bytes]
    segments = typical_segments(unlike(ours), unlike(theirs), how)
    model = Model(common + b"\0" * len(segments), common + segments, base, how)
    compare = Comparer(model.ordinary, model.toxic, how)
    x = np.array([compare.features(t) for t in toxic + ordinary])
    model.weights = logistic(x, np.r_[np.ones(len(toxic)), np.zeros(len(ordinary))])
    return model


def fit(docs: DataFrame, labels: DataFrame, held_out: int = 1, modulus: int = 3, how: Training = Training(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learned from labelled documents outside the held-out remainder, the first of each kind by a hash of the id."""
    flag = F.col(label_col).cast("int")
    marks = labels.where((id_remainder(id_col, modulus) != held_out) & flag.isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(flag).alias("toxic"))
    rows = texts(docs, id_col, text_col)
    sizes = rows.select("id", F.length("body").alias("n")).where(F.col("n") <= how.most_bytes).join(marks, "id").select("id", "toxic").distinct()
    kinds = {r["toxic"]: r["n"] for r in sizes.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    first = lambda kind, most: sizes.where(F.col("toxic") == kind).orderBy(F.xxhash64("id"), "id").limit(most)
    # Ids are chosen before a text is moved; the chosen ones are at most how.toxic + how.ordinary.
    chosen = rows.join(F.broadcast(first(1, how.toxic).union(first(0, how.ordinary))), "id").where(F.length("body") <= how.most_bytes)
    bodies = sorted((r["toxic"], bytes(r["body"])) for r in chosen.select("toxic", "body").collect())
    toxic, ordinary = [b for kind, b in bodies if kind], [b for kind, b in bodies if not kind]
    model = learn(toxic, ordinary, how)
    if toxic and ordinary:
        model.weights[0] += np.log(kinds[1] / kinds[0]) - np.log(len(toxic) / len(ordinary))
    return model


SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def score(docs: DataFrame, model: Model, held_out: int = 1, modulus: int = 3, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row, over all windows of the whole text.

    A null or empty text is one empty window.  A null id is not held out.  Repeated rows are scored one by one; an
    empty table gives an empty result; other columns are ignored.
    """
    held = F.coalesce(id_remainder(id_col, modulus) == held_out, F.lit(False)).alias("held")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compare = Comparer(model.ordinary, model.toxic, model.how) if model.toxic else None
        for batch in batches:
            scores = []
            for body in batch.column("body").to_pylist():
                z = float(np.dot(model.weights, compare.features(body or b""))) if compare else float(model.weights[0])
                scores.append(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), batch.column("held"), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())], schema=SCHEMA)

    return texts(docs, id_col, text_col, held).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
