"""Maximal periodic runs of words, found by uniting suffix classes in the order of decreasing common prefixes.

A run is a stretch of words with smallest period q, at least twice q long, that no neighbouring word extends.  Its first word and
the word q later start suffixes with a common prefix of length - q words, which is at least q.  Kruskal's order brings such a pair
together: edges between neighbours of the suffix array are taken by decreasing common prefix (LCP), a union-find joins the
classes, and each class keeps its positions ordered.  When two classes become one at level l, every pair of positions that is
newly adjacent has a common prefix of exactly l words.  At a distance of l or less it seeds the run of that period; a position between
the two would have given the stretch a smaller period, so each run is seeded once, at its first word, with its smallest period.

A run of at least `least` words has an LCP of at least half as many, so only positions whose next least / 2 words occur twice in the
text enter the suffix array.  That filter is exact.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from helixframe.llm.common import texts

RUN = "struct<start:bigint,length:bigint,period:bigint>"
FIELDS = ["start", "length", "period"]


def repeated_windows(x: np.ndarray, end: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Positions whose next `width` words may occur again in the same text: all that do, and chance equals of a 64-bit hash."""
    at = np.flatnonzero(np.arange(len(x)) + width <= end)
    with np.errstate(over="ignore"):
        mixed = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        h = (doc[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        for k in range(width):
            h = (h ^ mixed[at + k]) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(31)
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return at[again]


def suffix_ranks(x: np.ndarray, end: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, inside each text; equal ranks at a level mean equal words up to there.

    Prefix doubling that sorts again only what the level before left equal.  A text's end comes before every word.
    """
    _, first = np.unique(doc * (int(x.max(initial=0)) + 1) + x, return_inverse=True)
    order = np.argsort(first, kind="stable")
    starts = np.r_[True, first[order[1:]] != first[order[:-1]]]
    rank = np.empty(len(x), np.int64)
    rank[order] = np.maximum.accumulate(np.where(starts, np.arange(len(x)), 0))
    levels, step = [rank], 1
    todo = order[~(starts & np.r_[starts[1:], True])]
    while len(todo):
        after = todo + step
        second = np.where(after < end[todo], rank[np.minimum(after, len(x) - 1)] + 1, 0)
        by = np.lexsort((second, rank[todo]))
        todo, second = todo[by], second[by]
        group = rank[todo]
        opens = np.r_[True, group[1:] != group[:-1]]
        parts = opens | np.r_[True, second[1:] != second[:-1]]
        place = np.arange(len(todo))
        rank = rank.copy()
        rank[todo] = group + np.maximum.accumulate(np.where(parts, place, 0)) - np.maximum.accumulate(np.where(opens, place, 0))
        levels.append(rank)
        todo = todo[~(parts & np.r_[parts[1:], True])]
        step *= 2
    return levels


def common_prefixes(levels: list[np.ndarray], end: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Words that the suffixes at i and j (pairwise, of one text) share."""
    i, j, total = i.copy(), j.copy(), np.zeros(len(i), np.int64)
    last_i, last_j, top = end[i], end[j], len(end) - 1
    for k in range(len(levels) - 1, -1, -1):
        inside = (i < last_i) & (j < last_j)
        same = inside & (levels[k][np.minimum(i, top)] == levels[k][np.minimum(j, top)])
        grown = same * (1 << k)
        i += grown
        j += grown
        total += grown
    return total


def united(edges: Iterator[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(i, period, lcp) of the newly adjacent positions no farther apart than their LCP; edges (i, j, lcp) by decreasing lcp."""
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    seeds = []
    for i, j, lcp in edges:
        while (up := parent.get(i, i)) != i:
            parent[i] = i = parent.get(up, up)
        while (up := parent.get(j, j)) != j:
            parent[j] = j = parent.get(up, up)
        large, small = members.get(i) or [i], members.get(j) or [j]
        if len(large) < len(small):
            i, j, large, small = j, i, small, large
        parent[j] = i
        members[i] = large
        members.pop(j, None)
        k, many = 0, len(small)
        while k < many:
            # All of `small` that fall into one gap of `large`: new neighbours stand only at the gap's ends.
            at = bisect_left(large, small[k])
            upto = k + 1
            if at < len(large):
                while upto < many and small[upto] < large[at]:
                    upto += 1
                if (p := large[at] - small[upto - 1]) <= lcp:
                    seeds.append((small[upto - 1], p, lcp))
            else:
                upto = many
            if at and (p := small[k] - large[at - 1]) <= lcp:
                seeds.append((large[at - 1], p, lcp))
            large[at:at] = small[k:upto]
            k = upto
    return seeds


def runs_of(texts_: list[list[bytes]], least: int = 12) -> list[np.ndarray]:
    """(runs, 3) start, length, period of each list of words, by start and then period."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(t) for t in texts_], np.int64)
    x = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts_)), np.int64, int(sizes.sum()))
    none = np.zeros((0, 3), np.int64)
    result = [none] * len(texts_)
    width = max(1, -(-least // 2))

    def layout(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        begin = np.cumsum(counts) - counts
        return np.repeat(begin, counts), np.repeat(begin + counts, counts), np.repeat(np.arange(len(counts)), counts)

    begin, end, doc = layout(sizes)
    active = repeated_windows(x, end, doc, width)
    if not len(active):
        return result
    # Only texts with a repeated window go on.
    wanted = np.zeros(len(texts_), bool)
    wanted[doc[active]] = True
    left = wanted[doc]
    moved = np.cumsum(left) - 1
    active, x = moved[active], x[left]
    chosen = np.flatnonzero(wanted)
    begin, end, doc = layout(sizes[chosen])
    levels = suffix_ranks(x, end, doc)
    active = active[np.argsort(levels[-1][active])]
    i, j = active[:-1], active[1:]
    near = doc[i] == doc[j]
    i, j = i[near], j[near]
    lcp = common_prefixes(levels, end, i, j)
    keep = lcp >= width
    i, j, lcp = i[keep], j[keep], lcp[keep]
    down = np.argsort(-lcp, kind="stable")
    seeds = united(zip(i[down].tolist(), j[down].tolist(), lcp[down].tolist(), strict=True))
    if not seeds:
        return result
    at, period, lcp = np.array(seeds, np.int64).T
    # Only the seed at a run's first word has no equal words before it; a window filtered away there would have been a repeat too.
    first = (at == begin[at]) | (x[at - 1] != x[at + period - 1])
    first &= period + lcp >= least
    at, period, lcp = at[first], period[first], lcp[first]
    found = np.stack([at - begin[at], period + lcp, period], axis=1)
    by = np.lexsort((period, at))
    found, owner = found[by], doc[at[by]]
    for d, rows in zip(*_split(owner, found), strict=True):
        result[chosen[d]] = rows
    return result


def _split(owner: np.ndarray, rows: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, int)
    return owner[cuts].tolist(), np.split(rows, cuts[1:]) if len(cuts) else []


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


def find_runs(docs: DataFrame, least: int = 12, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 4_000_000) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start, then period) and collapsed (text) of every row.

    Words are what stands between spaces and tabs to carriage returns (ASCII); runs have `least` words at least.
    A null text has no words, no runs and an empty collapsed text, as an empty one has.  Repeated and null ids are rows of their
    own; ties do not arise (a run is told by start and period).  A text is never cut: a very long one is one piece of work in its
    task, with memory in proportion to its words; shorter ones are worked on together, up to `batch_bytes`.
    Other columns are ignored.  An empty table gives an empty result.
    """
    rows = texts(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()

    def emitted(ids: pa.Array, bodies: list[bytes | None]) -> pa.RecordBatch:
        words = [(b or b"").split() for b in bodies]
        found = runs_of(words, least)
        flat = np.concatenate([*found, np.zeros((0, 3), np.int64)])
        offsets = pa.array(np.r_[0, np.cumsum([len(f) for f in found])], pa.int32())
        runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(flat[:, k].copy()) for k in range(3)], FIELDS))
        texts_ = pa.array([collapsed(w, f) for w, f in zip(words, found, strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays([ids, pa.array([len(w) for w in words], pa.int64()), runs, texts_], names=["id", "n_words", "runs", "collapsed"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, body = batch.column("id"), batch.column("body")
            start = held = 0
            for k in range(batch.num_rows):
                held += len(body[k].as_buffer() or b"") if body[k].is_valid else 0
                if held >= batch_bytes or k + 1 == batch.num_rows:
                    yield emitted(ids.slice(start, k + 1 - start), body.slice(start, k + 1 - start).to_pylist())
                    start, held = k + 1, 0

    found = rows.mapInArrow(work, f"id {id_type}, n_words bigint, runs array<{RUN}>, collapsed binary")
    return found.select(F.col("id").alias("doc_id"), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): in the texts whose crc32(id) ends in 0, the words from some place on repeat with some period.

    With h = crc32 of the decimal id and g = h // 10, of n words those from a = g % n on become word a + (i - a) % p, where
    p = 1 + (n - a) // (3 + g % 8).  Other texts, and those with a null id, stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), h.alias("h"), g.alias("g"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, F.filter(F.split("text", "[ \\x09-\\x0D]+"), lambda w: w != "")))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    a, rest = F.col("a").cast("int"), (F.col("n") - F.col("a")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil(rest / p).cast("int")))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), a), F.slice(tail, F.lit(1), rest)), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


def report(found: DataFrame) -> DataFrame:
    """The digest columns of `find_runs`: the longest run (ties: smallest start, then period) and hashes of runs and collapsed text."""
    longest = F.reduce(
        "runs", F.lit(None).cast(RUN),
        lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumn("longest", longest)
    best = F.col("longest")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
