"""Quality rules from compression: repetitive and incompressible texts leave their length's band.

A text is compressed whole, and once more in fixed chunks.  The ratio (bytes / compressed bytes) must lie
inside the band of its length.  Repetition raises the ratio, random characters lower it; the bands widen
with the length because a compressor finds more matches in a longer text.

The bands are learned from the table: ratios are counted for each length class (half an octave; classes of few texts
join the next), over all texts that the base rules keep and over those labelled good.  Where enough are labelled good, the
upper limit is the ratio that the share `tail` of them exceeds; elsewhere it lies as far above the median of all
texts as their lower tail (taken from the lower quartile) reaches below it.  The lower limit lies twice as far below the median as the lower tail
reaches.  Every fifth id is held out of the labelled texts.  Lengths without evidence keep the fixed bands.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, replace
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from helixframe.llm.common import id_remainder, per_text, texts

#: (from so many bytes, lowest ratio, highest ratio); shorter texts are not judged by ratio.  For lengths without evidence.
WHOLE = ((64, 0.0, 2.6), (256, 1.05, 3.2), (512, 1.2, 3.5), (1024, 1.4, 3.8), (4096, 1.5, 4.5), (16384, 1.5, 6.0), (131072, 1.5, 9.0))
CHUNK = ((1024, 1.35, 4.0),)


@dataclass(frozen=True)
class Bands:
    """level: of the compressor; chunk_bytes: size of a chunk; bad_chunks: largest share of chunks out of band."""

    level: int = 3
    chunk_bytes: int = 4096
    whole: tuple = WHOLE
    chunk: tuple = CHUNK
    bad_chunks: float = 0.5


#: Bytes that are no word's code point: the ASCII blanks, and the continuation bytes of UTF-8.
NOT_COUNTED = b" \t\n\x0b\x0c\r" + bytes(range(0x80, 0xC0))


def band(length: int, bands: tuple) -> tuple[float, float]:
    """Lowest and highest ratio allowed for so many bytes."""
    low, high = 0.0, float("inf")
    for start, a, b in bands:
        if length >= start:
            low, high = a, b
    return low, high


def repeated_window_words(words: list[bytes]) -> int:
    """Words inside any 3-word window that occurs twice or more in the text."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = np.unique(codes[:-1] * len(number) + codes[1:], return_inverse=True)[1]
    _, place, count = np.unique(pairs[:-1] * len(number) + codes[2:], return_inverse=True, return_counts=True)
    again = count[place] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : len(words) - 2 + shift] |= again
    return int(covered.sum())


def counts(body: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """word characters, symbols, repeated lines and words in repeated windows of one text."""
    chars = len(body.translate(None, NOT_COUNTED))
    symbols = len(body) - len(body.translate(None, b"#*$%&|<>"))
    lines = [line for line in body.split(b"\n") if line.split()]
    return chars, symbols, len(lines) - len(set(lines)), repeated_window_words(words)


SCHEMA = pa.schema(
    [("doc_id", pa.int64())] + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("ratio", pa.float64())]
    + [(c, pa.int64()) for c in ("n_chunks", "n_bad_chunks")] + [("reason", pa.string())]
)


def measures(level: int, chunk_bytes: int):
    """(words, counts, base_failed, whole ratio, [(length, ratio) of each chunk]) of a text, by one compressor."""
    compressor = zstandard.ZstdCompressor(level=level, write_content_size=False)

    def ratio(part: bytes) -> float:
        return len(part) / len(compressor.compress(part))

    def of(body: bytes):
        words = body.split()
        counted = counts(body, words)
        failed = len(words) < 50 or 100 * counted[3] > 50 * len(words)
        parts = [body[start : start + chunk_bytes] for start in range(0, len(body), chunk_bytes)] if len(body) > chunk_bytes else []
        return words, counted, failed, ratio(body) if body else None, [(len(part), ratio(part)) for part in parts]

    return of


def judge(bands: Bands):
    """The function that one task applies to each text."""

    def make():
        measured = measures(bands.level, bands.chunk_bytes)

        def one(doc_id, body):
            body = body or b""
            words, (chars, symbols, dup_lines, repeated), failed, whole, parts = measured(body)
            low, high = band(len(body), bands.whole)
            bad = 0
            for length, ratio in parts:
                a, b = band(length, bands.chunk)
                bad += not a <= ratio <= b
            reason = "base" if failed else "repetitive" if whole > high else "incompressible" if whole < low else "chunks" if bad > bands.bad_chunks * len(parts) else None
            return doc_id, len(words), chars, symbols, dup_lines, repeated, failed, reason is None, whole, len(parts), bad, reason

        return one

    return make


#: Ratios are counted in steps of 1 / STEPS, up to a ratio of 20; a class needs LEAST texts.
STEPS, LEAST = 500, 100
COUNTED = pa.schema([("id", pa.int64()), ("chunk", pa.bool_()), ("class", pa.int64()), ("step", pa.int64()), ("n", pa.int64())])


def length_class(length: int) -> int:
    return math.floor(2 * math.log2(length))


def class_start(c: int) -> int:
    return math.ceil(2 ** (c / 2) - 1e-9)


def ratio_counts(cols: DataFrame, bands: Bands, good: DataFrame | None) -> list:
    """(chunk, class, step, n of all texts, n of good ones): as many rows as classes and steps, however large the table."""

    def count(batches):
        measured = measures(bands.level, bands.chunk_bytes)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                piece, rows = batch.slice(start, 1000), []
                for doc_id, body in zip(piece.column("id").to_pylist(), piece.column("body").to_pylist(), strict=True):
                    if body:
                        _, _, failed, whole, parts = measured(body)
                        if not failed:
                            found = Counter((k > 0, length_class(length), min(math.floor(ratio * STEPS), 20 * STEPS)) for k, (length, ratio) in enumerate([(len(body), whole), *parts]))
                            rows += [(doc_id, *at, n) for at, n in found.items()]
                columns = list(zip(*rows, strict=True)) or [()] * len(COUNTED)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, COUNTED.types, strict=True)], schema=COUNTED)

    found = cols.mapInArrow(count, "id long, chunk boolean, class long, step long, n long")
    if good is None:
        found = found.withColumn("good", F.lit(0))
    else:
        found = found.join(good.select(F.col("id").cast("long").alias("id"), F.lit(1).alias("good")).distinct(), "id", "left")
    return found.groupBy("chunk", "class", "step").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good")).collect()


def quantile(steps: Counter, share: float) -> float:
    """The ratio (middle of its step) that the share of what is counted lies below."""
    left = share * sum(steps.values())
    for step in sorted(steps):
        left -= steps[step]
        if left <= 0:
            break
    return (step + 0.5) / STEPS


def learned_limits(rows: list[tuple[int, int, int, int]], fixed: tuple, tail: float) -> tuple:
    """Bands from (class, step, n of all, n of good): classes of few texts join the next shorter ones."""
    groups, last, everything, good = [], None, Counter(), Counter()
    for c in sorted({r[0] for r in rows if class_start(r[0] + 1) > fixed[0][0]}, reverse=True):
        last = c if last is None else last
        for _, step, n, n_good in (r for r in rows if r[0] == c):
            everything[step] += n
            good[step] += n_good
        if everything.total() >= LEAST:
            groups.append((c, everything, good))
            everything, good = Counter(), Counter()
    if not groups:
        return fixed
    out = [b for b in fixed if b[0] < class_start(groups[-1][0])]
    for c, everything, good in reversed(groups):
        labelled = good.total() >= LEAST
        seen = good if labelled else everything
        middle = quantile(seen, 0.5)
        # All texts hold junk of both kinds, which moves a tail but hardly a quartile; of a normal share the quartile gives the tail.
        lowest = quantile(seen, tail) if labelled else middle - NormalDist().inv_cdf(tail) / NormalDist().inv_cdf(0.25) * (middle - quantile(seen, 0.25))
        # At most 15 % of a class go without labels to prove it, also where many copies of one text make the median.
        high = quantile(seen, 1 - tail) if labelled else max(2 * middle - lowest, quantile(seen, 0.85))
        out.append((max(class_start(c), fixed[0][0]), 2 * lowest - middle, high))
    end = class_start(last + 1)
    return (*out, (end, *band(end, fixed)), *(b for b in fixed if b[0] > end))


def learned(docs: DataFrame, labels: DataFrame | None = None, bands: Bands = Bands(), tail: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> Bands:
    """`bands` with the limits that the texts of `docs` give, and `labels` (id, quality 0 or 1) where there are some."""
    good = None if labels is None else labels.where((F.col("quality") == 1) & (id_remainder(id_col, 5) != 0)).select(F.col(id_col).alias("id"))
    rows = ratio_counts(texts(docs, id_col, text_col), bands, good)
    whole, chunk = ([(r["class"], r["step"], r["n"], r["good"]) for r in rows if r["chunk"] is kind] for kind in (False, True))
    return replace(bands, whole=learned_limits(whole, bands.whole, tail), chunk=learned_limits(chunk, bands.chunk, tail))


def quality(docs: DataFrame, bands: Bands | None = None, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of counts, ratios and the verdict for each row of `docs`, in one pass without a shuffle.

    Without `bands` a pass before that learns them from `docs` and `labels`; its shuffle moves ids and counts, no text.

    Words are split at the six ASCII blanks.  A null text counts as empty: no words, no ratio, base_failed.
    Texts under 64 bytes have no band.  Repeated rows are judged one by one; a null id is handed through; other
    columns of `docs` are neither read nor returned; an empty table gives an empty result.
    """
    bands = bands or learned(docs, labels, id_col=id_col, text_col=text_col)
    return texts(docs, id_col, text_col).mapInArrow(per_text(judge(bands), SCHEMA), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long, reason string")


def keep_good(docs: DataFrame, bands: Bands | None = None, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `quality` keeps, with all their columns, in one pass without a shuffle."""
    bands = bands or learned(docs, labels, id_col=id_col, text_col=text_col)

    def run(batches):
        one = judge(bands)()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                piece = batch.slice(start, 1000)
                bodies = piece.column(text_col).cast(pa.binary()).to_pylist()
                yield piece.filter(pa.array([one(None, body)[7] for body in bodies], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
