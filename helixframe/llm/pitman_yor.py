"""Hierarchical Pitman-Yor language model, seated by Gibbs sampling over the whole corpus.

Every word is a context and a dish of its own.  Words with at least the share `frequent` of the training tokens (at most
1 / frequent of them) are classes of their own, all others share one; the model of classes is what the restaurants of words
fall back on.  In it, a context restaurant stands for the word before; its customers are the class
bigrams of the corpus.  Each of its tables sends a customer to the parent that all contexts share.  Inside the class of
rarer words a third restaurant serves the words themselves; its base is a chain of bytes, learned from the words of the corpus,
that gives every string a probability of its own, so that known and unknown words together have a mass of at most 1.

A rarer word as the word before has a restaurant over all words, whose new tables ask the model of classes; a frequent one has
a restaurant over the rarer words, whose new tables ask the third restaurant.  Their dishes have one table each, so that a
count of dishes is all that has to be known of a restaurant; the restaurants of classes are seated by Gibbs sweeps.

A Gibbs sweep seats the customers of every (context, dish) anew, given the parent's probabilities and the context's number of
tables from the sweep before; then the parent is seated.  After the burn-in the predictive probabilities of the sweeps are
averaged.  Uniform numbers are hashes of (context, dish, sweep, step), so a task that runs again seats alike.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window as W, functions as F

from helixframe.llm.common import id_remainder, texts, written

U64 = np.uint64
END = 0  # code and hash of the end token
RARE = 0  # class of the rarer words; frequent ones count from 1


@dataclass(frozen=True)
class Settings:
    """frequent: least share of the training tokens for a word's own restaurant; burn_in, kept: sweeps; strength: of every restaurant."""

    frequent: float = 2e-5
    burn_in: int = 2
    kept: int = 3
    strength: float = 1.0
    block_tokens: int = 4_000_000
    seed: int = 11


# ---- seating ----


def uniforms(key: np.ndarray, step: int) -> np.ndarray:
    """A number in (0, 1) for each key and step."""
    x = key + U64((step * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return ((x ^ (x >> U64(31))) >> U64(11)).astype(float) * 2.0**-53 + 2.0**-54


def counts_with_mean(mean: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Poisson counts: by inversion for small means, by their normal limit for large ones."""
    out = np.maximum(0, np.rint(mean + np.sqrt(mean) * np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)))
    small = np.flatnonzero(mean < 20)
    if len(small):
        m, left = mean[small], u[small].copy()
        p, k, n = np.exp(-m), np.zeros(len(small)), 0
        open_ = left > p
        while open_.any() and n < 120:
            left = left - p
            n += 1
            p = p * m / n
            k[open_] = n
            open_ &= left > p
        out[small] = k
    return out


def seat(customers: np.ndarray, pull: np.ndarray, discount: float, key: np.ndarray) -> np.ndarray:
    """Tables of each dish after its customers have sat down one after the other.

    The i-th customer opens a table with probability pull / (pull + i - discount * tables), where pull is the weight of a
    new table with that dish.  From the 64th on, customers come in groups that double, and a group opens a
    Poisson number of tables with the integral of that rate as its mean; so the work grows with log(customers).
    """
    n = customers.astype(float)
    tables = np.minimum(n, 1.0)
    for i in range(1, min(64, int(n.max(initial=0)))):
        at = np.flatnonzero(n > i)
        tables[at] += uniforms(key[at], i) < pull[at] / (pull[at] + i - discount * tables[at])
    i, step = 64.0, 64
    while len(at := np.flatnonzero(n > i)):
        a, rest = pull[at], i - discount * tables[at]
        come = np.minimum(n[at], 2 * i) - i
        fresh = counts_with_mean(a * np.log1p(come / (a + rest)), uniforms(key[at], step), uniforms(key[at], step + 1))
        tables[at] += np.minimum(fresh, come)
        i, step = 2 * i, step + 2
    return tables


def pair_key(a: np.ndarray, b: np.ndarray, sweep: int, seed: int) -> np.ndarray:
    x = a.astype(U64) * U64(0xD6E8FEB86659FD93) + b.astype(U64) * U64(0xA0761D6478BD642F) + U64((sweep * 0xE7037ED1A0B428DB + seed) % 2**64)
    return (x ^ (x >> U64(32))) * U64(0x8EBC6AF09C88C6E3)


def discount_of(ones: float, twos: float) -> float:
    return float(np.clip(ones / (ones + 2 * twos), 0.1, 0.95)) if ones + twos else 0.5


@dataclass
class Sweep:
    """What one sweep leaves: the parent's probability of each class, each context's tables, and the rarer words' tables.

    `before` is the state that the sweep's customers were seated with; the same seats can be drawn again from it.
    """

    parent: np.ndarray
    context_tables: np.ndarray
    rare_tables: float
    before: Sweep | None = None


@dataclass
class Model:
    """The restaurants' small parts; counts of pairs and words stay in tables."""

    settings: Settings
    tokens: int
    words: int
    hashes: np.ndarray = field(default_factory=lambda: np.empty(0, U64))  # of the frequent words, ordered
    classes: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    spelling: np.ndarray = field(default_factory=lambda: np.full((STOP + 1, STOP + 1), -np.log10(STOP + 1.0)))  # log10 of (byte before, byte)
    context_customers: np.ndarray = field(default_factory=lambda: np.zeros(1))
    rare_customers: float = 0.0
    discount: float = 0.5
    rare_discount: float = 0.5
    word_discount: float = 0.5
    frequent_dishes: np.ndarray = field(default_factory=lambda: np.zeros(1))  # distinct rarer words after each class; unused for RARE
    sweeps: list[Sweep] = field(default_factory=list)

    def class_of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int32)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.classes[at], RARE).astype(np.int32)

    def new_table(self, s: Sweep, context: np.ndarray) -> np.ndarray:
        """Probability that a customer of the context sits down at a new table."""
        strength = self.settings.strength
        return (strength + self.discount * s.context_tables[context]) / (strength + self.context_customers[context])

    def unseen_pair(self, context: np.ndarray, dish: np.ndarray) -> np.ndarray:
        """Averaged probability of a dish that the context has no customer for."""
        return np.mean([self.new_table(s, context) * s.parent[dish] for s in self.sweeps], axis=0)

    def seen_pair(self, context: np.ndarray, dish: np.ndarray, customers: np.ndarray) -> np.ndarray:
        strength, total = self.settings.strength, 0.0
        for number, s in enumerate(self.sweeps):
            tables = self.seat_pairs(s.before, number, context, dish, customers)
            total = total + (customers - self.discount * tables) / (strength + self.context_customers[context]) + self.new_table(s, context) * s.parent[dish]
        return total / len(self.sweeps)

    def seat_pairs(self, state: Sweep, number: int, context: np.ndarray, dish: np.ndarray, customers: np.ndarray) -> np.ndarray:
        pull = (self.settings.strength + self.discount * state.context_tables[context]) * state.parent[dish]
        return seat(customers, pull, self.discount, pair_key(context, dish, number, self.settings.seed))

    def seat_rare(self, state: Sweep, number: int, hashes: np.ndarray, customers: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        pull = (self.settings.strength + self.rare_discount * state.rare_tables) * 10.0**spelled
        return seat(customers, pull, self.rare_discount, pair_key(hashes, hashes, number, self.settings.seed + 1))

    def rare_new(self, s: Sweep) -> float:
        return (self.settings.strength + self.rare_discount * s.rare_tables) / (self.settings.strength + self.rare_customers)

    def after_word(self, customers: np.ndarray, dishes: np.ndarray, n: np.ndarray, base: np.ndarray) -> np.ndarray:
        """log10 of the probability of a dish in a word's restaurant of `customers` and `dishes`; n: the dish's customers, base: log10 of its parent's probability."""
        strength, d = self.settings.strength, self.word_discount
        new = np.log10((strength + d * dishes) / (strength + customers)) + base
        return np.where(n > 0, np.log10(np.maximum((n - d) / (strength + customers) + 10.0**new, 1e-300)), new)

    def rare_word(self, hashes: np.ndarray, customers: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """log10 of the averaged probability of each word inside the class of rarer words; no customers: an unknown word.

        spelled: log10 of the word's base probability, which may lie below what a floating-point number holds.
        """
        if not self.sweeps:
            return spelled
        strength, seats, new = self.settings.strength, 0.0, 0.0
        for number, s in enumerate(self.sweeps):
            tables = self.seat_rare(s.before, number, hashes, customers, spelled)
            seats = seats + np.maximum(0, customers - self.rare_discount * tables) / (strength + self.rare_customers) / len(self.sweeps)
            new += self.rare_new(s) / len(self.sweeps)
        base = np.log10(new) + spelled
        return np.where(seats > 0, np.log10(np.maximum(seats + 10.0**base, 1e-300)), base)


# ---- spelling ----

STOP = 256  # stands before the first byte and behind the last one


def spelling_counts(words: list[bytes]) -> np.ndarray:
    """How often each byte (or STOP) follows each other one in the words; the end token is the word without bytes."""
    counts = np.zeros((STOP + 1) ** 2, np.int64)
    if words:
        before, after, _ = neighbours(words)
        counts += np.bincount(before * (STOP + 1) + after, minlength=len(counts))
    return counts


def neighbours(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(byte before, byte) of all places of the words, STOP at both ends, and where each word starts."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(sizes) - sizes
    after = np.full(int(sizes.sum()), STOP, np.int64)
    inside = np.ones(len(after), bool)
    inside[starts + sizes - 1] = False
    after[inside] = np.frombuffer(b"".join(words), np.uint8)
    before = np.r_[STOP, after[:-1]]
    return before, after, starts


def spelling_of(counts: np.ndarray, weight: float = 0.1) -> np.ndarray:
    """log10 of the chain's transitions; the probabilities of all strings of bytes sum to 1."""
    table = counts.reshape(STOP + 1, STOP + 1) + weight
    return np.log10(table / table.sum(axis=1, keepdims=True))


def spelled_log(words: list[bytes], spelling: np.ndarray) -> np.ndarray:
    """log10 of each word's probability as a string."""
    if not words:
        return np.zeros(0)
    before, after, starts = neighbours(words)
    return np.add.reduceat(spelling[before, after], starts)


# ---- pairs of words ----

PACKED_DDL = "part long, block long, contexts binary, sizes binary, pairs binary, n binary"
TOTALS_DDL = "block long, part long, totals binary, dishes binary, contexts binary, ones long, twos long"


def word_pair(context: np.ndarray, dish: np.ndarray) -> np.ndarray:
    """Hash of the hashes of two words."""
    x = context * U64(0xD6E8FEB86659FD93) + (dish ^ (dish >> U64(29))) * U64(0xA0761D6478BD642F) + U64(1)
    x = (x ^ (x >> U64(32))) * U64(0x8EBC6AF09C88C6E3)
    return x ^ (x >> U64(29))


def words_before(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The code before every token; a document's first token follows an end."""
    before = np.empty_like(codes)
    before[1:] = codes[:-1]
    before[np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64)] = END
    return before


def packed_pairs(codes: np.ndarray, lengths: np.ndarray, learned: np.ndarray, vocabulary: np.ndarray, classes: np.ndarray, parts: int):
    """(part, contexts, sizes, pairs, n): a block's distinct pairs with a rarer word, a context's one after the other, and how often each is learned.

    A rarer word's pairs are in one part (it has less than the share `frequent` of all tokens), a frequent one's are dealt over all.
    """
    before = words_before(codes, lengths)
    at = np.flatnonzero((classes[before] == RARE) | (classes[codes] == RARE))
    # A pair of codes has one number, so sorting numbers brings equal pairs together.
    key, n = counted_keys(before[at].astype(np.int64) * len(vocabulary) + codes[at], learned[at])
    context = key // len(vocabulary)
    pair = word_pair(vocabulary[context], vocabulary[key % len(vocabulary)])
    part = np.where(classes[context] == RARE, vocabulary[context], pair) % U64(parts)
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(parts, dtype=U64), "right")
    for p, (first, last) in enumerate(zip(np.r_[0, ends[:-1]], ends, strict=True)):
        rows = order[first:last]
        if len(rows):
            starts = np.flatnonzero(np.r_[True, context[rows][1:] != context[rows][:-1]])
            yield p, vocabulary[context[rows][starts]], np.diff(np.r_[starts, len(rows)]), pair[rows], n[rows]


def totalled(frequent: np.ndarray):
    """applyInArrow function: a part's pairs of all blocks to each block's totals and dishes of contexts, in the order sent; one row (block null) has the dishes of frequent contexts."""

    def run(rows: pa.Table) -> pa.Table:
        sent = [(r["block"], np.frombuffer(r["contexts"], U64), widened(r["sizes"]), np.frombuffer(r["pairs"], U64), widened(r["n"])) for r in rows.select(["block", "contexts", "sizes", "pairs", "n"]).to_pylist()]
        pair, which = np.unique(np.concatenate([s[3] for s in sent]), return_inverse=True)
        total = np.bincount(which, np.concatenate([s[4] for s in sent]), len(pair)).astype(np.int64)
        contexts, of = np.unique(np.concatenate([s[1] for s in sent]), return_inverse=True)
        of_pair = np.empty(len(pair), np.int64)
        of_pair[which] = np.repeat(of, np.concatenate([s[2] for s in sent]))
        dishes = np.bincount(of_pair[total > 0], minlength=len(contexts))
        out, i, j = [], 0, 0
        part = rows["part"][0].as_py()
        for block, mine, _, pairs, _ in sent:
            out.append((block, part, squeezed(total[which[j : j + len(pairs)]]), squeezed(dishes[of[i : i + len(mine)]]), None, 0, 0))
            i, j = i + len(mine), j + len(pairs)
        known = np.isin(contexts, frequent)
        out.append((None, part, None, squeezed(dishes[known]), contexts[known].tobytes(), int((total == 1).sum()), int((total == 2).sum())))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["block", "part", "totals", "dishes", "contexts", "ones", "twos"])

    return run


# ---- corpus in blocks ----

BLOCK = pa.schema([("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("learn", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())), ("codes", pa.binary()), ("vocabulary", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("words", pa.binary())])
BLOCK_DDL = "doc_ids array<long>, held array<boolean>, learn array<boolean>, lengths array<int>, codes binary, vocabulary array<long>, counts array<long>, words binary"


def squeezed(codes: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def widened(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(raw.T).view("<u4").ravel()


def respelt(data: bytes) -> list[bytes]:
    """The words of a block's vocabulary; the end token, the first one, has no bytes."""
    return zstandard.ZstdDecompressor().decompress(data).split(b" ")


class Numbers(dict):
    """Words by the order in which a block meets them, from 1."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self) + 1
        return value


def rows_of(batch: pa.RecordBatch, *names: str):
    """Rows of the columns, turned into Python values a few at a time."""
    for start in range(0, batch.num_rows, 500):
        piece = batch.slice(start, 500)
        yield from zip(*(piece.column(name).to_pylist() for name in names), strict=True)


def encoded(block_tokens: int):
    """mapInArrow function: rows of (id, learn, held, body) to blocks of documents with a vocabulary of their own."""

    def block(ids, held, learn, lengths, parts, numbers):
        codes = np.concatenate(parts)
        weight = np.repeat(np.array(learn, bool), lengths)
        counts = np.zeros(len(numbers) + 1, np.int64)
        for i in range(0, len(codes), SLICE):
            counts += np.bincount(codes[i : i + SLICE][weight[i : i + SLICE]], minlength=len(counts))
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) or 1 for w in numbers), U64, len(numbers))
        vocabulary = np.r_[U64(END), hashes].view(np.int64)
        spelt = zstandard.ZstdCompressor(level=3).compress(b" ".join([b"", *numbers]))
        row = ([ids], [held], [learn], [lengths], [squeezed(codes)], [vocabulary], [counts], [spelt])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, BLOCK.types, strict=True)], schema=BLOCK)

    def run(batches):
        fresh = lambda: ([], [], [], [], [], Numbers())
        ids, held, learn, lengths, parts, numbers = fresh()
        waiting = 0
        for batch in batches:
            for doc_id, learned, kept_out, body in rows_of(batch, "id", "learn", "held", "body"):
                words = (body or b"").lower().split()
                codes = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                parts.append(np.r_[codes, END].astype(np.int32))
                ids.append(doc_id)
                held.append(kept_out)
                learn.append(learned)
                lengths.append(len(words) + 1)
                waiting += len(words) + 1
                if waiting >= block_tokens:
                    yield block(ids, held, learn, lengths, parts, numbers)
                    ids, held, learn, lengths, parts, numbers = fresh()
                    waiting = 0
        if ids:
            yield block(ids, held, learn, lengths, parts, numbers)

    return run


def pair_keys(classes: np.ndarray, lengths: np.ndarray, end_class: int, k: int) -> np.ndarray:
    """context * k + dish of every token; a document's first token follows an end."""
    keys = np.empty(len(classes), np.int64)
    keys[1:] = classes[:-1]
    keys[np.r_[0, np.cumsum(lengths)[:-1]]] = end_class
    keys *= k
    keys += classes
    return keys


def counted_keys(keys: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and how many of each are learned; sorted in place of `keys`, as a block has millions."""
    keys *= 2
    keys += learned
    keys.sort()
    first = np.flatnonzero(np.r_[True, keys[1:] >> 1 != keys[:-1] >> 1]) if len(keys) else np.zeros(0, np.int64)
    n = np.add.reduceat(keys & 1, first) if len(keys) else np.zeros(0, np.int64)
    return keys[first] >> 1, n


SLICE = 250_000  # keys or tokens that are worked on at once


def by_slices(function, *columns: np.ndarray) -> np.ndarray:
    """`function` of the columns, a slice of their rows at a time."""
    starts = range(0, max(1, len(columns[0])), SLICE)
    return np.concatenate([function(*(c[i : i + SLICE] for c in columns)) for i in starts])


def document_slices(lengths: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of documents with about SLICE tokens, one document at least."""
    ends, out, start = np.cumsum(lengths), [], 0
    while start < len(lengths):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE, "right")))
        out.append((start, stop))
        start = stop
    return out


def listed(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


def with_totals(counts: DataFrame, *keys: str) -> DataFrame:
    """(block, ..., n) of the blocks' counts, with each key's sum over the blocks and a mark on one of its rows; without sums of 0.

    A key has one row in a block at most, so no key's rows are more than there are blocks.
    """
    same = W.partitionBy(*keys)
    rows = counts.withColumn("total", F.sum("n").over(same)).withColumn("first", F.row_number().over(same.orderBy("block")) == 1)
    return rows.where("total > 0").drop("n")


def entries_of(spelling: np.ndarray):
    """mapInArrow function: a block's vocabulary as rows, with the learned count and log10 of the spelling of each word."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                vocabulary = listed(batch, "vocabulary", row)
                size = len(vocabulary)
                spelled = spelled_log(respelt(batch.column("words")[row].as_py()), spelling)
                columns = [np.full(size, batch.column("block")[row].as_py()), np.arange(size, dtype=np.int32), vocabulary, listed(batch, "counts", row), spelled.astype(np.float32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "code", "hash", "n", "spelled"])

    return run


PAIR_DDL = "block long, context int, dish int, n long"


class LanguageModel:
    """Learned from a corpus; `scored()` has one row for each document of it."""

    def __init__(self, docs: DataFrame, held_out: int = 0, modulus: int = 10, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"):
        """Words are lower-cased (A-Z), split at the six ASCII blanks and followed by one end token.

        Documents whose crc32 remainder is `held_out` are not learned from; nor are rows with a null id, which count as not held out.
        A null text is empty: the end token alone.  Repeated rows are learned and scored each.  Where nothing can be
        learned, words have the probability of a uniform chain of bytes.  Other columns are ignored; an empty table gives an empty result.

        Texts are read once, into blocks of about `block_tokens` tokens.  What is shuffled is, for each block, its distinct words,
        its distinct class pairs, and packed the hashes of its distinct pairs with a rarer word, for which only totals come back; words are told apart by a 64-bit hash.  Only tables with one row for each frequent word
        (at most 1 / frequent) pass through the driver.
        """
        self.settings = settings
        remainder = id_remainder(id_col, modulus)
        rows = texts(docs, id_col, text_col, F.coalesce(remainder != held_out, F.lit(False)).alias("learn"), F.coalesce(remainder == held_out, F.lit(False)).alias("held"))
        self.blocks = written(rows.mapInArrow(encoded(settings.block_tokens), BLOCK_DDL).withColumn("block", F.monotonically_increasing_id()), "blocks")
        self.spelling = self.learn_spelling()
        entries = self.blocks.select("block", "vocabulary", "counts", "words").mapInArrow(entries_of(self.spelling), "block long, code int, hash long, n long, spelled float")
        # A block's entry for a word gets the word's count in the corpus; one entry of each word stands for it.
        self.entries = written(with_totals(entries, "hash"), "entries")
        self.words = self.entries.where("first").select("hash", F.col("total").alias("c"), "spelled")
        totals = self.words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        self.model = Model(settings, totals[0], totals[1], spelling=self.spelling)
        self.learn()
        self.learn_words()

    def learn_spelling(self) -> np.ndarray:
        """The chain of bytes from the learned words of every block; what the driver gets has a row for each pair of bytes."""

        def count(batches):
            total = np.zeros((STOP + 1) ** 2, np.int64)
            for batch in batches:
                for row in range(batch.num_rows):
                    words, counts = respelt(batch.column("words")[row].as_py()), listed(batch, "counts", row)
                    total += spelling_counts([w for w, n in zip(words, counts, strict=True) if n])
            pair = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int32)), pa.array(total[pair])], names=["pair", "n"])

        pairs = self.blocks.select("words", "counts").mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros((STOP + 1) ** 2)
        counts[pairs["pair"]] = pairs["n"]
        return spelling_of(counts)

    def learn(self) -> None:
        m, s = self.model, self.settings
        common = self.words.where(F.col("c") >= F.lit(max(1.0, s.frequent * m.tokens))).toPandas().sort_values("hash")  # at most 1 / frequent rows
        hashes = common["hash"].to_numpy(np.int64).view(U64)
        order = np.argsort(hashes)
        m.hashes, m.classes = hashes[order], np.arange(1, len(order) + 1, dtype=np.int32)
        k = len(order) + 1
        m.rare_customers = float(m.tokens - common["c"].sum())
        end_class = int(m.class_of(np.array([END], U64))[0])
        self.end_class = end_class

        def count_pairs(batches):
            for batch in batches:
                for row in range(batch.num_rows):
                    lengths, block = listed(batch, "lengths", row), batch.column("block")[row].as_py()
                    classes = m.class_of(listed(batch, "vocabulary", row).view(U64))[widened(batch.column("codes")[row].as_py())]
                    keys = pair_keys(classes, lengths, end_class, k)
                    del classes
                    key, n = counted_keys(keys, np.repeat(listed(batch, "learn", row), lengths))
                    del keys
                    for i in range(0, len(key), SLICE):
                        part, count = key[i : i + SLICE], n[i : i + SLICE]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block)), pa.array((part // k).astype(np.int32)), pa.array((part % k).astype(np.int32)), pa.array(count)], names=["block", "context", "dish", "n"])

        counted = self.blocks.select("block", "codes", "vocabulary", "lengths", "learn").mapInArrow(count_pairs, PAIR_DDL)
        self.block_pairs = written(with_totals(counted, "context", "dish"), "block-pairs")
        self.pairs = self.block_pairs.where("first").select("context", "dish", F.col("total").alias("n"))
        ones_and_twos = [F.sum(F.when(F.col("n") == i, 1).otherwise(0)) for i in (1, 2)]
        m.discount = discount_of(*[x or 0 for x in self.pairs.agg(*ones_and_twos).first()])
        rare = self.words.where(F.col("c") < F.lit(max(1.0, s.frequent * m.tokens))).withColumnRenamed("c", "n")
        m.rare_discount = discount_of(*[x or 0 for x in rare.agg(*ones_and_twos).first()])
        per_context = self.pairs.groupBy("context").agg(F.sum("n").alias("n"), F.count("*").alias("dishes")).toPandas()  # one row for each frequent word
        m.context_customers, tables = np.zeros(k), np.zeros(k)
        m.context_customers[per_context["context"]], tables[per_context["context"]] = per_context["n"], per_context["dishes"]
        state = Sweep(np.full(k, 1.0 / k), tables, float(rare.count()))
        parent_tables = 1.0
        for number in range(s.burn_in + s.kept):
            seed = number - s.burn_in
            by_context, by_dish = self.seat_pairs(state, seed)
            rare_tables = self.seat_rare(rare, state, seed) if m.rare_customers else 0.0
            # The parent's customers are the contexts' tables; its own base is uniform over the classes.
            pull = np.full(k, (s.strength + 0.5 * parent_tables) / k)
            own = seat(by_dish, pull, 0.5, pair_key(np.arange(k), np.arange(k), seed, s.seed + 2))
            parent_tables = own.sum()
            parent = (np.maximum(0, by_dish - 0.5 * own) + (s.strength + 0.5 * parent_tables) / k) / (s.strength + by_dish.sum())
            state = Sweep(parent, by_context, rare_tables, Sweep(state.parent, state.context_tables, state.rare_tables))
            if seed >= 0:
                m.sweeps.append(state)

    def learn_words(self) -> None:
        """Counts of pairs with a rarer word, sent packed and sent back as totals in the same order."""
        m = self.model
        self.parts = parts = max(1, self.blocks.count())

        def send(batches):
            for batch in batches:
                for row in range(batch.num_rows):
                    vocabulary, lengths = listed(batch, "vocabulary", row).view(U64), listed(batch, "lengths", row)
                    codes = widened(batch.column("codes")[row].as_py())
                    learned = np.repeat(listed(batch, "learn", row), lengths)
                    block = batch.column("block")[row].as_py()
                    for part, contexts, sizes, pairs, n in packed_pairs(codes, lengths, learned, vocabulary, m.class_of(vocabulary), parts):
                        values = ([part], [block], [contexts.tobytes()], [squeezed(sizes)], [pairs.tobytes()], [squeezed(n)])
                        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
                        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["part", "block", "contexts", "sizes", "pairs", "n"])

        sent = self.blocks.select("block", "codes", "vocabulary", "lengths", "learn").mapInArrow(send, PACKED_DDL)
        self.word_totals = written(sent.groupBy("part").applyInArrow(totalled(m.hashes[m.classes != RARE]), TOTALS_DDL), "word-pairs")

        def spread_out(batches):
            for batch in batches:
                for contexts, dishes in zip(batch.column("contexts").to_pylist(), batch.column("dishes").to_pylist(), strict=True):
                    yield pa.RecordBatch.from_arrays([pa.array(m.class_of(np.frombuffer(contexts, U64))), pa.array(widened(dishes).astype(np.int64))], names=["context", "n"])

        ours = self.word_totals.where("block IS NULL")
        m.word_discount = discount_of(*[x or 0 for x in ours.agg(F.sum("ones"), F.sum("twos")).first()])
        dishes = ours.select("contexts", "dishes").mapInArrow(spread_out, "context int, n long").groupBy("context").agg(F.sum("n").alias("n")).toPandas()  # one row for each frequent word
        m.frequent_dishes = np.zeros(len(m.context_customers))
        m.frequent_dishes[dishes["context"]] = dishes["n"]

    def seat_pairs(self, state: Sweep, number: int) -> tuple[np.ndarray, np.ndarray]:
        """One sweep over all pairs: tables by context and by dish."""
        m, k = self.model, len(self.model.context_customers)

        def run(batches):
            by = np.zeros((2, k))
            for batch in batches:
                context, dish, n = (batch.column(c).to_numpy() for c in ("context", "dish", "n"))
                tables = m.seat_pairs(state, number, context, dish, n)
                by[0] += np.bincount(context, tables, k)
                by[1] += np.bincount(dish, tables, k)
            kind, which = np.nonzero(by)
            yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(which.astype(np.int32)), pa.array(by[kind, which])], names=["kind", "class", "tables"])

        sums = self.pairs.mapInArrow(run, "kind int, class int, tables double").groupBy("kind", "class").agg(F.sum("tables").alias("tables")).toPandas()
        out = np.zeros((2, k))
        out[sums["kind"], sums["class"]] = sums["tables"]
        return out[0], out[1]

    def seat_rare(self, rare: DataFrame, state: Sweep, number: int) -> float:
        m = self.model

        def run(batches):
            total = 0.0
            for batch in batches:
                hashes = batch.column("hash").to_numpy().view(U64)
                spelled = batch.column("spelled").to_numpy().astype(float)
                total += m.seat_rare(state, number, hashes, batch.column("n").to_numpy(), spelled).sum()
            yield pa.RecordBatch.from_arrays([pa.array([total])], names=["tables"])

        return float(rare.mapInArrow(run, "tables double").agg(F.coalesce(F.sum("tables"), F.lit(0.0))).first()[0])

    def scored(self) -> DataFrame:
        """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every document."""
        m, k, end_class, parts = self.model, len(self.model.context_customers), self.end_class, self.parts

        # (part, key, n): a word of the block (-1 - its code) or a pair of classes, with its count in the corpus.
        of_words = self.entries.select(F.col("block").alias("part"), (-1 - F.col("code").cast("long")).alias("key"), F.col("total").alias("n"))
        of_pairs = self.block_pairs.select(F.col("block").alias("part"), (F.col("context").cast("long") * k + F.col("dish")).alias("key"), F.col("total").alias("n"))
        known = of_words.unionByName(of_pairs)

        def score(block: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
            out = []
            key, n = known["key"].to_numpy(), known["n"].to_numpy()
            code, count = -1 - key[key < 0], n[key < 0]
            order = np.argsort(key[key >= 0])
            n, key = n[key >= 0][order], key[key >= 0][order]
            pair_p = by_slices(lambda key, n: m.seen_pair(key // k, key % k, n.astype(float)), key, n) if len(key) else None
            for row in block.itertuples():
                lengths, codes = np.asarray(row.lengths), widened(row.codes)
                vocabulary = np.asarray(row.vocabulary, np.int64).view(U64)
                c = np.zeros(len(vocabulary))
                c[code] = count
                word_class = m.class_of(vocabulary)
                spelled = spelled_log(respelt(row.words), m.spelling).astype(np.float32).astype(float)
                word_log = np.where(word_class == RARE, by_slices(m.rare_word, vocabulary, c, spelled), 0.0)
                word_base = np.log10((c + 0.1) / (m.tokens + 0.1 * (m.words + 1)))
                # Totals of the block's pairs of words and dishes of its rarer contexts, in the order in which they were sent.
                back = {r["part"]: r for r in (row.returned if row.returned is not None else [])}
                pairs, totals, dishes = [np.zeros(0, U64)], [np.zeros(0, np.int64)], m.frequent_dishes[word_class]
                by_hash = np.argsort(vocabulary)
                learned = np.repeat(np.asarray(row.learn, bool), lengths)
                for part, contexts, _, pair, _ in packed_pairs(codes, lengths, learned, vocabulary, word_class, parts):
                    pairs.append(pair)
                    totals.append(widened(back[part]["totals"]))
                    at = by_hash[np.searchsorted(vocabulary[by_hash], contexts)]
                    own = word_class[at] == RARE
                    dishes[at[own]] = widened(back[part]["dishes"])[own]
                pairs, totals = np.concatenate(pairs), np.concatenate(totals)
                order = np.argsort(pairs)
                pairs, totals = pairs[order], totals[order]
                del order, learned
                to_rare = np.zeros(k)
                if len(key):
                    to_rare[key[key % k == RARE] // k] = n[key % k == RARE]
                customers = np.where(word_class == RARE, c, to_rare[word_class])
                bounds = np.r_[0, np.cumsum(lengths)]
                sums = [[], [], []]
                for first, last in document_slices(lengths):
                    part = codes[bounds[first] : bounds[last]]
                    token_key = pair_keys(word_class[part], lengths[first:last], end_class, k)
                    values = np.ones(len(token_key))
                    seen = np.zeros(len(token_key), bool)
                    if len(key):
                        at = np.minimum(np.searchsorted(key, token_key), len(key) - 1)
                        seen = key[at] == token_key
                        values[seen] = pair_p[at[seen]]
                    if m.sweeps:
                        values[~seen] = m.unseen_pair(token_key[~seen] // k, token_key[~seen] % k)
                    logs, before = np.log10(values), words_before(part, lengths[first:last])
                    at = np.flatnonzero((word_class[before] == RARE) | (word_class[part] == RARE))
                    if len(at):
                        b, w = before[at], part[at]
                        times = totals[np.searchsorted(pairs, word_pair(vocabulary[b], vocabulary[w]))]
                        rare = word_class[b] == RARE
                        after = m.after_word(customers[b], dishes[b], times, np.where(rare, logs[at], 0.0) + word_log[w])
                        logs[at] = np.where(rare, after, logs[at] + after)
                    start = bounds[first:last] - bounds[first]
                    for sum_, of_token in zip(sums, ((c > 0)[part].astype(np.int64), word_base[part], logs), strict=True):
                        sum_.append(np.add.reduceat(of_token, start))
                n_known, base, total = map(np.concatenate, sums)
                ids = pd.array([None if i is None or i != i else int(i) for i in row.doc_ids], "Int64")
                out.append(pd.DataFrame({"doc_id": ids, "held_out": np.asarray(row.held, bool), "n_tokens": lengths, "n_known": n_known, "train_tokens": m.tokens, "base_score": base, "score": total}))
            return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")})

        returned = self.word_totals.where("block IS NOT NULL").groupBy(F.col("block").alias("_b")).agg(F.collect_list(F.struct("part", "totals", "dishes")).alias("returned"))
        blocks = self.blocks.join(returned, F.col("block") == F.col("_b"), "left").select("block", "doc_ids", "held", "learn", "lengths", "codes", "vocabulary", "words", "returned")
        return blocks.groupBy("block").cogroup(known.groupBy("part")).applyInPandas(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_texts(docs: DataFrame, **options) -> DataFrame:
    """See `LanguageModel` and `LanguageModel.scored`."""
    return LanguageModel(docs, **options).scored()
