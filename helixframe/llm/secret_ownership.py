"""Secret scan with corpus-wide ownership: widely copied examples apart from one owner's live-looking credentials.

Candidates are found row by row.  Their hashes are counted over the corpus by distinct repositories and owners;
a value that many owners have, or that few owners have in very many repositories, is an example or a fixture;
any other value that looks random is live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from helixframe.llm.common import per_text, texts, unused, written

# The base kinds, in their order.
ASSIGN = re.compile(r"""(?P<name>(?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?(?P<value>[A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE = (("assign", ASSIGN, 6), ("access", ACCESS, 20), ("hex", HEX, 24))  # with the shortest value of each
#: Further shapes of credentials: the prefix forms of public services, key blocks, signed tokens and long mixed strings.
MORE = (
    ("prefixed", re.compile(r"\b(?:gh[opsu]_[A-Za-z0-9]{30,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{30,})"), 0),
    ("jwt", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0),
    ("private_key", re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z]+ )?PRIVATE KEY-----"), 0),
    ("mixed", re.compile(r"[A-Za-z0-9+/_-]{24,}"), 0),
)
#: A mixed string has a digit, a capital and a small letter.
CLASSES = (re.compile(r"[0-9]"), re.compile(r"[A-Z]"), re.compile(r"[a-z]"))
ORDER = {kind: place for place, (kind, _, _) in enumerate(BASE + MORE)}


def entropy(value: str) -> float:
    """Bits per character of the value's own character frequencies."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values()) if value else 0.0


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of every base match: leftmost, non-overlapping in its kind, short values dropped."""
    found = []
    for kind, pattern, least in BASE:
        for m in pattern.finditer(text):
            value = m["value"] if kind == "assign" else m[0]
            if len(value) >= least:
                found.append((m.start(), m.end(), kind, value))
    return found


def more_spans(text: str) -> list[tuple[int, int, str, str]]:
    found = [(m.start(), m.end(), kind, m[0]) for kind, pattern, _ in MORE for m in pattern.finditer(text)]
    return [f for f in found if f[2] != "mixed" or all(c.search(f[3]) for c in CLASSES)]


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in sorted(spans, key=lambda s: (s[0], ORDER[s[2]], s[1])))


FOUND = pa.schema([
    ("doc_id", pa.int64()), ("owner", pa.string()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()),
    ("found", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value_hash", pa.string()), ("random", pa.bool_())]))),
])
FOUND_DDL = "doc_id long, owner string, n_assign long, n_access long, n_hex long, base_sha256 string, found array<struct<start:int,end:int,kind:string,value_hash:string,random:boolean>>"


def scan(min_entropy: float):
    def make():
        def one(doc_id, owner, body):
            text = (body or b"").decode("utf-8", "replace")
            base = base_spans(text)
            n = Counter(kind for _, _, kind, _ in base)
            spans = [
                {"start": a, "end": b, "kind": kind, "value_hash": hashlib.sha256(value.encode()).hexdigest()[:32], "random": kind == "private_key" or (len(value) >= 12 and entropy(value) >= min_entropy)}
                for a, b, kind, value in sorted(base + more_spans(text), key=lambda s: (s[0], ORDER[s[2]], s[1]))
            ]
            digest = hashlib.sha256(joined((a, b, kind) for a, b, kind, _ in base).encode()).hexdigest()
            return doc_id, owner, n["assign"], n["access"], n["hex"], digest, spans

        return one

    return make


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", common_owners: int = 3, copies_per_owner: int = 25, min_entropy: float = 2.8, row_col: str | None = None) -> DataFrame:
    """Every row of `docs` with its candidate spans and their ownership.

    Result: row (`row_col`, a column of unique numbers, or a running one), doc_id, n_assign, n_access, n_hex, base_sha256 and `secrets`, an array ordered by place of
    {start, end (code points, exclusive), kind, base, n_repos, n_owners, verdict}.  verdict is `example` from
    `common_owners` distinct owners on, or from `copies_per_owner` distinct repositories for each of its owners on, else `live` for a random-looking value (12 characters and `min_entropy` bits
    each), else `weak`.  Null texts are empty; a null owner or repository counts as one of its own; repeated rows
    of a repository count once for ownership but each row is returned; an empty table gives an empty result; other columns are ignored.

    Texts are scanned once.  Only hashes, ids and owners are shuffled: distinct (hash, repository) and (hash, owner)
    are reduced inside the map tasks first, so a value that a third of all rows hold costs a row a task.
    """
    cols = texts(docs, id_col, text_col, F.col(owner_col).cast("string").alias("owner"), F.col(repo_col).cast("string").alias("repo"), (F.col(row_col) if row_col else F.monotonically_increasing_id()).cast("long").alias("row"))
    scanned = written(cols.mapInArrow(_with_repo(min_entropy), FOUND_DDL + ", repo string, row long"), "secrets")
    hits = scanned.where(F.size("found") > 0).select("row", "owner", "repo", F.posexplode("found").alias("place", "f")).select("row", "owner", "repo", "place", "f.*")
    owners = hits.select("value_hash", "owner").distinct().groupBy("value_hash").agg(F.count("*").alias("n_owners"))
    repos = hits.select("value_hash", "repo").distinct().groupBy("value_hash").agg(F.count("*").alias("n_repos"))
    base = F.col("kind").isin([kind for kind, _, _ in BASE])
    verdict = F.when((F.col("n_owners") >= common_owners) | (F.col("n_repos") >= copies_per_owner * F.col("n_owners")), "example").when(F.col("random"), "live").otherwise("weak")
    judged = hits.join(owners.join(repos, "value_hash"), "value_hash").select(
        "row", F.struct("place", "start", "end", "kind", base.alias("base"), "n_repos", "n_owners", verdict.alias("verdict")).alias("s")
    )
    per_row = judged.groupBy("row").agg(F.array_sort(F.collect_list("s")).alias("secrets"))
    empty = F.array().cast("array<struct<place:int,start:int,end:int,kind:string,base:boolean,n_repos:bigint,n_owners:bigint,verdict:string>>")
    return scanned.join(per_row, "row", "left").select("row", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce("secrets", empty).alias("secrets"))


def _with_repo(min_entropy: float):
    schema = FOUND.append(pa.field("repo", pa.string())).append(pa.field("row", pa.int64()))
    plain = scan(min_entropy)

    def make():
        one = plain()
        return lambda doc_id, owner, body, repo, row: (*one(doc_id, owner, body), repo, row)

    return per_text(make, schema, ("id", "owner", "body", "repo", "row"))


def reported(found: DataFrame) -> DataFrame:
    """The digest columns: base spans always, added spans where the corpus says that they are live."""
    added = F.filter("secrets", lambda s: s["base"] | (s["verdict"] == "live"))
    as_text = F.array_join(F.transform(added, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda v: F.size(F.filter("secrets", lambda s: s["verdict"] == v)).cast("long")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", as_text.alias("spans"), count("live").alias("n_live"), count("example").alias("n_example"))


def mask_live(docs: DataFrame, found: DataFrame, row_col: str, text_col: str = "text", mark: str = "<secret>") -> DataFrame:
    """`docs` with the live spans of each text replaced by `mark`; examples and weak values stay.

    `found` is the result of `scan_secrets` over the same rows with the same `row_col`.  Overlapping spans are merged.
    """
    live = F.filter("secrets", lambda s: s["verdict"] == "live")
    row, masks = unused(docs, "found", "spans")
    spans = found.select(F.col("row").alias(row), F.transform(live, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"))).alias(masks)).where(F.size(masks) > 0)
    text = F.col(text_col)
    # Spans come ordered by start: each adds the text since the furthest end so far, and the mark where it starts anew.
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, s):
        fresh = s["a"] >= acc["at"]
        piece = F.when(fresh, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["a"] - acc["at"]), F.lit(mark))).otherwise(acc["out"])
        return F.struct(piece.alias("out"), F.greatest(acc["at"], s["b"]).alias("at"))

    masked = F.aggregate(masks, begin, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    joined_docs = docs.join(spans, F.col(row_col) == F.col(row), "left")
    return joined_docs.select(*[F.when(F.col(masks).isNull(), text).otherwise(masked).alias(c) if c == text_col else F.col(c) for c in docs.columns])
