"""Packing documents into fixed-length sequences: best fit, then a swap-based local search.

Texts are tokenised and only documents longer than a sequence are cut.  Pieces are dealt by hash into groups of about
`group_sequences` full sequences.  In a group, pieces go longest first into the fullest bin with room; then underfull bins
exchange pieces (move one, one for one, two for one) wherever that increases the sum of squared fills, until
bins run empty.  The pieces of bins that stay underfull are dealt out again, into as many groups as they need, and packed once more.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from helixframe.llm.common import texts, written

END_ID = 1
PIECES = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
PIECES_DDL = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


#: A sign of ASCII other than the apostrophe, right after a small ASCII letter: the pre-tokenizer always cuts there.
AFTER_LETTER = re.compile(r"[!-&(-/:-@\[-`{-~](?<=[a-z].)")
#: Blanks that every rule of the tokenizer drops; other blanks stay inside a chunk.
BLANKS = bytes.maketrans(b"\n\t", b"  ")


class ChunkIds(dict):
    """The ids of chunks as little-endian bytes, tokenised when first asked for."""

    def __init__(self, tokenizer):
        super().__init__()
        self.encode, self.model = tokenizer.encode, tokenizer.model

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isalpha() and chunk.isascii() and chunk.islower():  # one pre-token, and normal as it is
            ids = [t.id for t in self.model.tokenize(chunk)]
        else:
            ids = self.encode(chunk, add_special_tokens=False).ids
        value = self[chunk] = np.array(ids, "<u4").tobytes() if sys.byteorder == "big" else array("I", ids).tobytes()
        return value


class ChunkTokenizer:
    """Token ids of a text, put together from those of its chunks.

    Chunks end at blanks and between a letter and a sign.  The vocabulary lower-cases and its pre-tokenizer cuts at these
    places, so a chunk's ids do not depend on its neighbours and each chunk is tokenised once.  Texts with the opening
    of a special token are cut at blanks only.  The store of chunks is emptied when it has passed `most` entries.
    """

    def __init__(self, path: str, most: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.known = ChunkIds(self.tokenizer)

    def ids(self, body: bytes) -> np.ndarray:
        body = body.translate(BLANKS)
        if b"<|" in body:
            chunks = body.decode("utf-8", "replace").split(" ")
        else:
            chunks = AFTER_LETTER.sub(r" \g<0>", body.lower().decode("utf-8", "replace")).split(" ")
        if len(self.known) > self.most:
            self.known.clear()
        return np.frombuffer(b"".join(map(self.known.__getitem__, chunks)), "<u4")


def tokenized(path: str | None, capacity: int, end_id: int = END_ID):
    """mapInArrow function: the pieces of each text, without its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = path
        if file is None:
            import public_tokenizers

            file = public_tokenizers.path("word_bpe_49k.json")
        tokenizer = ChunkTokenizer(file)
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                slices = batch.slice(begin, 500)
                out: list[tuple] = []
                for doc_id, row, body in zip(*(slices.column(c).to_pylist() for c in ("id", "row", "body")), strict=True):
                    ids = np.append(tokenizer.ids(body or b""), np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        out.append((doc_id, row, piece, start, len(part), zlib.crc32(part.tobytes())))
                columns = list(zip(*out, strict=True)) or [()] * len(PIECES)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, PIECES.types, strict=True)], schema=PIECES)

    return run


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Item numbers by bin: longest first, each into the bin with the least room that is enough."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (room, bin), ordered
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(room, (lengths[item], -1))
        if at < len(room):
            left, b = room.pop(at)
            bins[b].append(item)
        else:
            left, b = capacity, len(bins)
            bins.append([item])
        insort(room, (left - lengths[item], b))
    return bins


def local_search(bins: list[list[int]], lengths: list[int], capacity: int, full: float = 1.0, rounds: int = 50) -> list[list[int]]:
    """Exchanges between underfull bins that increase the sum of squared fills; bins that run empty go.

    Each step looks at the emptiest bin that is not yet settled.  It gives a piece to a fuller bin (move), or a fuller
    bin takes a longer piece for a shorter one (one for one) or for two shorter ones (two for one).  Every step raises
    the squared fill, so the search ends; partners are found by length through sorted lists, not by trying all pairs.
    A bin is underfull below the share `full` of its capacity; other bins stay as they are.
    """
    bins = [list(b) for b in bins]
    fill = [sum(lengths[i] for i in b) for b in bins]
    for _ in range(rounds):
        open_bins = sorted((b for b in range(len(bins)) if 0 < fill[b] < full * capacity), key=lambda b: (fill[b], b))
        changed = False
        for source in open_bins:
            if not fill[source]:
                continue
            others = [b for b in open_bins if b != source and fill[source] <= fill[b] < capacity]
            by_room = sorted((capacity - fill[b], b) for b in others)
            for item in sorted(bins[source], key=lambda i: -lengths[i]):  # move
                at = bisect_left(by_room, (lengths[item], -1))
                if at < len(by_room):
                    left, b = by_room.pop(at)
                    bins[source].remove(item)
                    bins[b].append(item)
                    fill[source] -= lengths[item]
                    fill[b] += lengths[item]
                    insort(by_room, (left - lengths[item], b))
                    changed = True
            if not fill[source]:
                continue
            own = sorted((lengths[i], i) for i in bins[source])
            for _, b in by_room:
                room = capacity - fill[b]
                if not room:
                    continue
                best = (0, None, ())
                theirs = sorted((lengths[i], i) for i in bins[b])
                gives = [(n, (i,)) for n, i in theirs] + [(m + n, (i, j)) for (m, i), (n, j) in zip(theirs, theirs[1:])]
                for total, items in gives:  # the largest own piece that fits once `items` have left
                    at = bisect_left(own, (total + room + 1, -1)) - 1
                    if at >= 0 and (gain := own[at][0] - total) > best[0]:
                        best = (gain, own[at][1], items)
                gain, item, items = best
                if gain > 0:
                    bins[source].remove(item)
                    bins[b].append(item)
                    for i in items:
                        bins[b].remove(i)
                        bins[source].append(i)
                    fill[source] -= gain
                    fill[b] += gain
                    own = sorted((lengths[i], i) for i in bins[source])
                    changed = True
        if not changed:
            break
    return [b for b in bins if b]


def packed(frame: pd.DataFrame, capacity: int, full: float) -> pd.DataFrame:
    """The group's pieces with bin, place in the bin and whether the bin is still underfull."""
    frame = frame.sort_values(["length", "row", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    lengths = [int(n) for n in frame["length"]]
    bins = local_search(best_fit(lengths, capacity), lengths, capacity, full)
    number, offset, is_open = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), np.zeros(len(lengths), bool)
    for b, items in enumerate(bins):
        at = 0
        for i in items:
            number[i], offset[i] = b, at
            at += lengths[i]
        is_open[items] = at < full * capacity
    return frame.assign(bin=number, offset=offset, open=is_open)


PACKED_DDL = "doc_id long, row long, piece int, start long, length long, ids_crc32 long, grp long, bin long, offset long, open boolean"


def pack(docs: DataFrame, capacity: int = 4096, tokenizer_path: str | None = None, group_sequences: int = 500, full: float = 0.995, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    `tokenizer_path` is a `tokenizers` file; unset, the public 49k word vocabulary that the cluster has installed.
    A null or empty text is the end id alone.  Repeated rows are packed each; a null id is handed through; an empty
    table gives an empty result; other columns of `docs` are ignored.

    The number of groups follows the count of tokens, so a task holds about `group_sequences` sequences of pieces
    (numbers only, never texts) however large the table is.  Only pieces are shuffled.
    """
    cols = texts(docs, id_col, text_col, F.monotonically_increasing_id().alias("row"))
    pieces = written(cols.mapInArrow(tokenized(tokenizer_path, capacity), PIECES_DDL), "pieces")
    tokens = pieces.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]

    def step(key, frame):
        return packed(frame, capacity, full)

    def dealt(df: DataFrame, n: int) -> DataFrame:  # by a hash of the row, so that no key of the data decides a group
        return df.withColumn("grp", F.pmod(F.xxhash64("row", "piece"), F.lit(n))).groupBy("grp").applyInPandas(step, PACKED_DDL)

    n = max(1, round(tokens / (capacity * group_sequences)))
    done = dealt(pieces, n).withColumn("level", F.lit(0))
    if n > 1:
        first = written(done, "packed")
        underfull = first.where("open").select("grp", "bin").distinct().count()
        rest = dealt(first.where("open").select(*pieces.columns), max(1, round(underfull / group_sequences)))
        done = first.where("not open").unionByName(rest.withColumn("level", F.lit(1)))
    sequence = (F.col("grp") * 2 + F.col("level")) * F.lit(1 << 24) + F.col("bin")
    return done.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset")
