"""Text, accession and JSON column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accession patterns.
SRA_PATTERN = r"\bSR[APXRS]\d+\b"
PROJECT_PATTERN = r"\bPRJ[EDN][A-Z]?\d+\b"
SAMPLE_PATTERN = r"\bSAM[END][A-Z]?\d+\b"
GEO_PATTERN = r"\bGS[EM]\d+\b"
RUN_PATTERN = r"\bSRR\d+\b"

STRINGS = "array<string>"


# What counts as white space at the ends of a value.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(value: Column | str) -> Column:
    """The value without white space of any kind at its ends."""
    return F.trim(value, F.lit(BLANKS))


def clean(value: Column) -> Column:
    """NULL becomes empty; surrounding blanks go."""
    return strip(F.coalesce(value.cast("string"), F.lit("")))


def squeeze(value: Column) -> Column:
    """Collapse runs of white space to one blank."""
    return strip(F.regexp_replace(value, r"\s+", " "))


def non_empty(values: Column) -> Column:
    """Trimmed, distinct, non-empty values in order of first appearance."""
    trimmed = F.transform(F.coalesce(values, F.array().cast(STRINGS)), lambda v: strip(F.coalesce(v, F.lit(""))))
    return F.array_distinct(F.filter(trimmed, lambda v: v != ""))


def join_parts(*parts: Column, sep: str = " ") -> Column:
    """Join the non-empty parts."""
    return F.array_join(F.filter(F.array(*[F.coalesce(p, F.lit("")) for p in parts]), lambda v: v != ""), sep)


def platform(value: Column) -> Column:
    """';'-separated platforms, bare numbers prefixed with GPL, joined by '; '."""
    parts = F.filter(F.transform(F.split(clean(value), ";"), lambda p: strip(p)), lambda p: p != "")
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^[0-9]+$"), F.concat(F.lit("GPL"), p)).otherwise(p)), "; ")


def mine(text: Column, pattern: str) -> Column:
    """Matches of an accession pattern, case ignored, distinct in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(clean(text), F.lit("(?i)" + pattern), 0))


def mine_sorted(text: Column, pattern: str) -> Column:
    """Matches in upper case, distinct and sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(clean(text), F.lit("(?i)" + pattern), 0), lambda p: F.upper(p))))


def split_accessions(value: Column, prefixes: tuple[str, ...]) -> Column:
    """',' or ';' separated items starting (case ignored) with one of the prefixes."""
    parts = F.transform(F.split(clean(value), "[;,]"), lambda p: strip(p))
    return F.filter(parts, lambda p: (p != "") & p.rlike("(?i)^(" + "|".join(prefixes) + ")"))


def count_runs(text: Column) -> Column:
    """Distinct run accessions in a text, NULL when there is none."""
    found = F.size(mine_sorted(text, RUN_PATTERN))
    return F.when(found > 0, found.cast("long"))


def capture(text: Column, pattern: str) -> Column:
    """First capture group, case ignored; empty when there is no match."""
    return strip(F.regexp_extract(F.coalesce(text, F.lit("")), "(?i)" + pattern, 1))


def sample_attributes(text: Column) -> Column:
    """'key: value || key=value' as a map; keys in lower case with '_', the last value of a key wins."""
    pieces = F.transform(F.split(clean(text), r"\|\|"), lambda c: F.regexp_replace(strip(c), "^;+|;+$", ""))

    def entry(piece):
        sep = F.when(F.instr(piece, ":") > 0, F.instr(piece, ":")).otherwise(F.instr(piece, "="))
        key = F.regexp_replace(F.lower(strip(piece.substr(F.lit(1), sep - 1))), " ", "_")
        return F.struct(F.when(sep > 0, key).otherwise("").alias("k"), strip(piece.substr(sep + 1, F.length(piece))).alias("v"))

    pairs = F.filter(F.transform(pieces, entry), lambda e: (e["k"] != "") & (e["v"] != ""))
    # Keep the last value of each key without relying on a session-wide duplicate-key policy.
    keys = F.array_distinct(F.transform(pairs, lambda e: e["k"]))
    last = F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda e: e["k"] == k), -1)["v"])
    return F.map_from_arrays(keys, last)


def link(template: str, accession: Column) -> Column:
    """Source link by prefix; empty for an empty accession."""
    return F.when(clean(accession) != "", F.concat(F.lit(template), accession)).otherwise("")


def goal(text: Column) -> Column:
    """Analysis goal keyword: ordered substring rules ('ml' matches inside other words, too)."""
    low = F.lower(clean(text))
    return (
        F.when(low == "", "general")
        .when(low.contains("wgcna"), "wgcna")
        .when(low.contains("validation"), "validation")
        .when(low.contains("machine") | low.contains("ml"), "machine_learning")
        .when(low.contains("deg") | low.contains("differential"), "differential_expression")
        .otherwise(F.replace(low, F.lit(" "), F.lit("_")))
    )


def file_formats(value: Column) -> Column:
    """Upper-case file formats of a ',' or ';' separated list, distinct in order."""
    return non_empty(F.transform(F.split(clean(value), "[;,]"), lambda p: F.upper(p)))


def has(text: Column, pattern: str) -> Column:
    return text.rlike("(?i)" + pattern)


def read_name(header: Column) -> Column:
    """Read identifier without its /1 or /2 mate suffix."""
    return F.regexp_replace(header, "/[12]$", "")


# Patterns that must not appear in shared text.
PRIVATE_PATTERNS = {
    "email": r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b",
    "credential": r"(?i)\b(?:api[_-]?key|token|password|secret)\s*[:=]\s*\S+",
    "path": r"(?:^|[^:\p{L}\p{N}_/])/[^/\s]+/[^/\s]+",  # a word character is one of any script; one inner folder is enough to tell a path
    "fasta": r"(?m)^\s*>[^\n]+\n\s*[ACGTRYSWKMBDHVNacgtryswkmbdhvn\s]{20,}",
    "sequence": r"^[ACGTNacgtn\s]{40,}$",
}


def privacy_flags(text: Column) -> Column:
    """Names of the private-content patterns found in a text."""
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(name)) for name, p in PRIVATE_PATTERNS.items()]))


def content_hash(**fields: Column) -> Column:
    """SHA-256 over the JSON of the fields in name order."""
    return F.sha2(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)])), 256)


def next_number(ids: Column, pattern: str) -> Column:
    """Aggregate: one more than the highest number captured by `pattern`; 1 when there is none."""
    number = F.when(ids.rlike(pattern), F.regexp_extract(ids, pattern, 1).cast("long"))
    return F.coalesce(F.max(number), F.lit(0)) + 1
