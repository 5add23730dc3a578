"""Near-duplicate detection by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 32-bit numbers give a whole signature: the first breaks up the order of a set's elements, the
second, shifted circularly by k, gives coordinate k (the least shifted value over the set).  Bands of coordinates are the
candidate keys.  Texts with equal sets are one class from the start.  Candidates are confirmed on full sets, in rounds:
first every class against the smallest class it shares a band with, then all those pairs of a band that are not yet in
one component.  In crowded bands the second round compares blocks of sets and returns only links that join
components, so a large group of near copies gives no row for each pair, and no link that could join two is left out.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from helixframe.llm.common import per_text, texts, written

U32, U64 = np.uint32, np.uint64
ODD64 = U64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Bands:
    """bands * rows coordinates.  At similarity s a pair is missed with probability (1 - s**rows)**bands: 2e-6 at 0.8."""

    bands: int = 44
    rows: int = 6


class WordHashes(dict):
    """64-bit hashes of words, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = (x ^ (x >> U64(31))) * U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> U64(29))


def shingle_set(body: bytes, size: int, known: WordHashes) -> np.ndarray:
    """Distinct hashes of the runs of `size` words, ordered; of the whole text if it has fewer words; none without words."""
    words = body.lower().split()
    if not words:
        return np.empty(0, U64)
    if len(known) > 300_000:
        known.clear()
    h = np.fromiter(map(known.__getitem__, words), U64, len(words))
    n = min(size, len(words))
    run = h[: len(h) - n + 1] + U64(n)
    for j in range(1, n):
        run = run * ODD64 + h[j : len(h) - n + 1 + j]
    return np.unique(mixed(run))


class Circulant:
    """Signatures and band keys of sets of 64-bit numbers."""

    def __init__(self, bands: Bands):
        self.bands = bands
        self.shift = np.arange(bands.bands * bands.rows, dtype=U32)[:, None] * U32(0x9E3779B1)
        rng = np.random.default_rng(2024)
        self.weights = rng.integers(1, 2**63, (bands.bands, bands.rows), dtype=U64) | U64(1)
        self.salt = rng.integers(1, 2**63, bands.bands, dtype=U64)

    def signature(self, elements: np.ndarray) -> np.ndarray:
        x = (elements ^ (elements >> U64(32))).astype(U32)
        x = (x ^ (x >> U32(16))) * U32(0x85EBCA6B)  # first permutation
        x = (x ^ (x >> U32(13))) * U32(0xC2B2AE35)
        x = (x ^ (x >> U32(16))) * U32(0x9E3779B1)  # place times the factor; a shift by k adds k times the factor
        least = None
        for start in range(0, len(x), 2048):
            v = x[None, start : start + 2048] + self.shift  # second permutation, shifted
            v ^= v >> U32(15)
            v *= U32(0x2C1B3C6D)
            v ^= v >> U32(12)
            v *= U32(0x297A2D39)
            v ^= v >> U32(15)
            part = v.min(axis=1)
            least = part if least is None else np.minimum(least, part)
        return least

    def keys(self, elements: np.ndarray) -> np.ndarray:
        sig = self.signature(elements).astype(U64).reshape(self.bands.bands, self.bands.rows)
        return mixed((sig * self.weights).sum(axis=1, dtype=U64) + self.salt).view(np.int64)


SIGNED = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("same", pa.binary()), ("keys", pa.list_(pa.int64()))])
SIGNED_DDL = "doc_id long, row long, n long, same binary, keys array<long>"


def same_set(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def sign(size: int, bands: Bands):
    def make():
        circulant, known = Circulant(bands), WordHashes()

        def one(doc_id, row, body):
            elements = shingle_set(body or b"", size, known)
            if not len(elements):
                return doc_id, row, 0, None, None
            return doc_id, row, len(elements), same_set(elements), circulant.keys(elements)

        return one

    return per_text(make, SIGNED, ("id", "row", "body"))


SETS = pa.schema([("cid", pa.int64()), ("elements", pa.binary())])


def full_sets(size: int):
    """(cid, elements) of a class from the text of its document; elements are the ordered 64-bit hashes of its shingles."""

    def run(batches):
        known = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                cids, out = [], []
                for cid, same, body in zip(*(part.column(c).to_pylist() for c in ("cid", "same", "body")), strict=True):
                    elements = shingle_set(body or b"", size, known)
                    if len(elements) and same_set(elements) == same:  # another text under the same id is not this class
                        cids.append(cid)
                        out.append(packed(elements))
                yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(out, pa.binary())], schema=SETS)

    return run


def packed(elements: np.ndarray) -> bytes:
    return elements.astype("<u8").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int64()), ("joint", pa.int64())])


def confirmed(percent: int):
    """Pairs with both sets -> those with 100 * shared >= percent * union."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows, last, left = [], None, None
                for a, b, x, y in zip(*(part.column(c).to_pylist() for c in ("a", "b", "x", "y")), strict=True):
                    if y is not last:
                        last, right = y, unpacked(y)
                    left = unpacked(x)
                    shared = len(left) + len(right) - len(np.unique(np.concatenate([left, right])))
                    union = len(left) + len(right) - shared
                    if 100 * shared >= percent * union:
                        rows.append((a, b, shared, union))
                columns = list(zip(*rows, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=LINKS)

    return run


def spanning_links(cids: np.ndarray, comp: np.ndarray, sets: list[np.ndarray], percent: int) -> pd.DataFrame:
    """Links among the sets that join components, from the sizes of all intersections."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    column = np.unique(np.concatenate(sets), return_inverse=True)[1]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for first in range(0, int(column[-1]) + 1, 4096):  # so many distinct elements at a time
        a, b = np.searchsorted(column, [first, first + 4096])
        who, where = np.unique(owner[a:b], return_inverse=True)
        has = np.zeros((len(who), 4096), np.float32)
        has[where, column[a:b] - first] = 1
        shared[np.ix_(who, who)] += has @ has.T
    linked = 100 * shared.astype(np.int64) >= percent * (sizes[:, None] + sizes[None, :] - shared.astype(np.int64))
    root = {c: c for c in set(comp.tolist())}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for i, j in zip(*np.nonzero(np.triu(linked & (comp[:, None] != comp[None, :]), 1)), strict=True):
        p, q = find(int(comp[i])), find(int(comp[j]))
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((min(cids[i], cids[j]), max(cids[i], cids[j])))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(cid, comp) of every linked class; comp is the least cid that can be reached.

    Each round takes the least label among the neighbours and then the label's own label, so the number of rounds
    grows with the logarithm of the longest chain.  Labels are written to the shared folder after each round.
    """
    both = written(links.select(F.col(a).alias("cid"), F.col(b).alias("to")).union(links.select(F.col(b), F.col(a))), "links")
    labels = written(both.groupBy("cid").agg(F.least("cid", F.min("to")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("cid").alias("to"), F.col("comp").alias("theirs")), "to").groupBy("cid").agg(F.min("theirs").alias("theirs"))
        nearer = labels.join(near, "cid").select("cid", F.col("comp").alias("old"), F.least("comp", "theirs").alias("mid"))
        jump = labels.select(F.col("cid").alias("mid"), F.col("comp").alias("far"))
        now = written(nearer.join(jump, "mid", "left").select("cid", "old", F.least("mid", F.coalesce("far", "mid")).alias("comp")), "labels")
        changed = now.where("comp <> old").limit(1).count()
        labels = now.select("cid", "comp")
        if not changed:
            return labels


class Deduplicator:
    """Near duplicates of a table; `result()` has one row for each row of it."""

    def __init__(self, docs: DataFrame, shingle_words: int = 5, percent: int = 80, bands: Bands = Bands(), id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None, crowd: int = 32, block: int = 1000):
        """`row_col` names a column of unique numbers, if there is one; else rows are numbered.

        Bands of more than `crowd` classes are compared in blocks of `block`; that changes the plan, not the links.

        Documents are linked where 100 * shared shingles >= percent * distinct shingles of both.

        A-Z are lower-cased, words split at the six ASCII blanks.  Null and blank texts have no shingles and no links.
        A row with a null id takes no part in links and is its own, with a null component.  Repeated rows are linked
        as copies, and one of them is kept.  Other columns are ignored; an empty table gives an empty result.
        """
        self.docs, self.size, self.percent, self.id_col, self.text_col = docs, shingle_words, percent, id_col, text_col
        self.crowd, self.block = crowd, block
        rows = texts(docs, id_col, text_col, (F.col(row_col) if row_col else F.monotonically_increasing_id()).cast("long").alias("row"))
        self.signed = written(rows.mapInArrow(sign(shingle_words, bands), SIGNED_DDL), "signed")
        first = F.min(F.struct("doc_id", "row"))
        classes = self.signed.where("same is not null and doc_id is not null").groupBy("same").agg(first.alias("first"), F.first("n").alias("n"), F.first("keys").alias("keys"))
        self.classes = written(classes.select(F.monotonically_increasing_id().alias("cid"), "same", "first.doc_id", "first.row", "n", "keys"), "classes")

    def alike(self, n: Column, m: Column) -> Column:
        """Sizes that allow the similarity."""
        return F.least(n, m) * 100 >= F.greatest(n, m) * self.percent

    def component_of(self) -> DataFrame:
        """(cid, comp) of every class."""
        banded = self.classes.select("cid", "n", F.explode("keys").alias("key"))
        heads = banded.groupBy("key").agg(F.min(F.struct("cid", "n")).alias("head"), F.count("*").alias("members")).where("members > 1")
        shared = written(banded.join(heads.select("key", "head"), "key"), "shared")
        stars = shared.where((F.col("cid") != F.col("head.cid")) & self.alike(F.col("n"), F.col("head.n"))).groupBy(F.col("cid").alias("b")).agg(F.min("head.cid").alias("a")).select("a", "b")
        wanted = shared.select("cid").distinct().join(self.classes.select("cid", "same", "doc_id"), "cid")
        bodies = texts(self.docs, self.id_col, self.text_col).join(wanted, F.col("id") == F.col("doc_id")).select("cid", "same", "body")
        self.sets = written(bodies.mapInArrow(full_sets(self.size), "cid long, elements binary"), "sets")
        tested = written(stars, "tested")
        found = written(self.confirm(tested), "links")
        comp = components(found)
        members = written(shared.select("key", "cid", "n").join(comp, "cid", "left").withColumn("comp", F.coalesce("comp", "cid")), "members")
        # Only bands whose members lie in more than one component.
        several = members.groupBy("key").agg(F.count("*").alias("members"), F.min("comp").alias("p"), F.max("comp").alias("q")).where("p < q").select("key", "members")
        members = written(members.join(several, "key"), "split")
        few = members.where(F.col("members") <= self.crowd)
        other = few.select("key", F.col("comp").alias("comp_b"), F.col("cid").alias("b"), F.col("n").alias("n_b"))
        pairs = few.join(other, "key").where((F.col("cid") < F.col("b")) & (F.col("comp") != F.col("comp_b")) & self.alike(F.col("n"), F.col("n_b")))
        pairs = pairs.select(F.col("cid").alias("a"), "b").distinct().join(tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
        more = self.confirm(pairs).select("a", "b").unionByName(self.confirm_crowded(members.where(F.col("members") > self.crowd)))
        # The second round's links join components of the first; a component pair counts once, however many links it has.
        label = lambda end: comp.select(F.col("cid").alias(end), F.col("comp").alias(f"comp_{end}"))
        between = more.join(label("a"), "a", "left").join(label("b"), "b", "left").select(F.coalesce("comp_a", "a").alias("p"), F.coalesce("comp_b", "b").alias("q"))
        joined = components(between.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct())
        first = self.classes.select("cid").join(comp, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        last = joined.select(F.col("cid").alias("comp"), F.col("comp").alias("further"))
        return first.join(last, "comp", "left").select("cid", F.coalesce("further", "comp").alias("comp"))

    def confirm_crowded(self, members: DataFrame) -> DataFrame:
        """Links inside crowded bands, without a row for each pair.

        A band's classes are dealt into blocks of about `block` and every two blocks meet in one task, which compares their
        classes and returns links that join different components.
        """
        blocks = F.ceil(F.col("members") / self.block)
        dealt = members.withColumn("mine", F.pmod(F.xxhash64("cid"), blocks)).withColumn("yours", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        dealt = dealt.select("key", F.least("mine", "yours").alias("i"), F.greatest("mine", "yours").alias("j"), "cid", "comp").join(self.sets, "cid")
        percent = self.percent

        def meet(frame):
            return spanning_links(frame["cid"].to_numpy(), frame["comp"].to_numpy(), [unpacked(e) for e in frame["elements"]], percent)

        return dealt.groupBy("key", "i", "j").applyInPandas(meet, "a long, b long")

    def confirm(self, pairs: DataFrame) -> DataFrame:
        with_a = pairs.join(self.sets.select(F.col("cid").alias("a"), F.col("elements").alias("x")), "a")
        with_both = with_a.join(self.sets.select(F.col("cid").alias("b"), F.col("elements").alias("y")), "b")
        return with_both.select("a", "b", "x", "y").mapInArrow(confirmed(self.percent), "a long, b long, shared long, joint long")

    def result(self) -> DataFrame:
        """doc_id, row, n_shingles, component_id (the smallest id in reach) and kept, true for one row of each component."""
        labelled = self.classes.select("cid", "same", F.struct("doc_id", "row").alias("first")).join(self.component_of(), "cid")
        best = labelled.groupBy("comp").agg(F.min("first").alias("best"))
        by_class = labelled.join(best, "comp").select("same", F.col("best.doc_id").alias("component_id"), F.col("best.row").alias("best_row"))
        rows = self.signed.select("doc_id", "row", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("same")).alias("same"))
        joined = rows.join(by_class, "same", "left")
        return joined.select("doc_id", "row", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce(F.col("row") == F.col("best_row"), F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """See `Deduplicator`; its result without row numbers, and kept for every row that has its component's id (or a null id)."""
    result = Deduplicator(docs, **options).result().drop("row")
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
