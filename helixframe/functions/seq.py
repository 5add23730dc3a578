"""Sequence and alignment column expressions.

Aligned blocks are half-open; positions on a reference are 1-based as in the alignment records.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Nucleotide letters and their complements.
IUPAC = "ACGTRYSWKMBDHVN"
IUPAC_COMPLEMENT = "TGCAYRSWMKVHDBN"

# Groups are repeated possessively: the engine then loops instead of recursing, however long the text is.
CIGAR = r"^(?:[1-9][0-9]*[MIDNSHP=X])++$"
OP = "struct<op:string,n:int,ref:bigint,query:bigint>"


# -- alignments ------------------------------------------------------------------------------------


def cigar_operations(cigar: Column) -> Column:
    """Array of (n, op); NULL for an invalid CIGAR."""
    pieces = F.regexp_extract_all(cigar, F.lit("[0-9]+[MIDNSHP=X]"), 0)
    ops = F.transform(pieces, lambda p: F.struct(p.substr(F.lit(1), F.length(p) - 1).cast("int").alias("n"), F.right(p, F.lit(1)).alias("op")))
    return F.when(cigar.rlike(CIGAR), ops)


def laid_operations(pos: Column, cigar: Column) -> Column:
    """CIGAR operations with the reference position and the 0-based query offset where each starts."""
    start = F.struct(pos.cast("long").alias("r"), F.lit(0).cast("long").alias("q"), F.array().cast(f"array<{OP}>").alias("out"))

    def step(acc, o):
        on_ref = o["op"].isin("M", "=", "X", "D", "N")
        on_query = o["op"].isin("M", "=", "X", "I", "S")
        item = F.struct(o["op"].alias("op"), o["n"].alias("n"), acc["r"].alias("ref"), acc["q"].alias("query"))
        return F.struct(
            (acc["r"] + F.when(on_ref, o["n"]).otherwise(0)).alias("r"),
            (acc["q"] + F.when(on_query, o["n"]).otherwise(0)).alias("q"),
            F.concat(acc["out"], F.array(item)).alias("out"),
        )

    return F.aggregate(cigar_operations(cigar), start, step, lambda acc: acc["out"])


def is_match(op: Column) -> Column:
    return op.isin("M", "=", "X")


def aligned_blocks(pos: Column, cigar: Column) -> Column:
    """Contiguous M/=/X stretches as half-open (start, end); every other operation breaks one."""
    ops = laid_operations(pos, cigar)
    start = F.array().cast("array<struct<start:bigint,end:bigint,open:boolean>>")

    def step(blocks, o):
        last = F.try_element_at(blocks, F.lit(-1))
        new = F.struct(o["ref"].alias("start"), (o["ref"] + o["n"]).alias("end"), F.lit(True).alias("open"))
        longer = F.struct(last["start"].alias("start"), (o["ref"] + o["n"]).alias("end"), F.lit(True).alias("open"))
        closed = F.struct(last["start"].alias("start"), last["end"].alias("end"), F.lit(False).alias("open"))
        body = F.slice(blocks, 1, F.size(blocks) - 1)
        none = F.size(blocks) == 0
        return (
            F.when(is_match(o["op"]) & (none | ~F.coalesce(last["open"], F.lit(False))), F.concat(blocks, F.array(new)))
            .when(is_match(o["op"]), F.concat(F.when(none, blocks).otherwise(body), F.array(longer)))
            .when(none, blocks)
            .otherwise(F.concat(F.when(none, blocks).otherwise(body), F.array(closed)))
        )

    done = F.aggregate(ops, start, step)
    return F.transform(done, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end")))


def reference_span(cigar: Column) -> Column:
    """Reference bases consumed."""
    return F.aggregate(
        cigar_operations(cigar), F.lit(0).cast("long"), lambda s, o: s + F.when(o["op"].isin("M", "=", "X", "D", "N"), o["n"]).otherwise(0)
    )


def query_length(cigar: Column) -> Column:
    """Query bases consumed; must equal the length of the read sequence."""
    return F.aggregate(
        cigar_operations(cigar), F.lit(0).cast("long"), lambda s, o: s + F.when(o["op"].isin("M", "=", "X", "I", "S"), o["n"]).otherwise(0)
    )


def query_offset(pos: Column, cigar: Column, at: Column) -> Column:
    """0-based query offset aligned to reference position `at`; NULL in a deletion, skip or outside."""
    start = F.struct(pos.cast("long").alias("r"), F.lit(0).cast("long").alias("q"), F.lit(None).cast("long").alias("hit"))

    def step(acc, o):
        here = is_match(o["op"]) & (acc["r"] <= at) & (at < acc["r"] + o["n"])
        return F.struct(
            (acc["r"] + F.when(o["op"].isin("M", "=", "X", "D", "N"), o["n"]).otherwise(0)).alias("r"),
            (acc["q"] + F.when(o["op"].isin("M", "=", "X", "I", "S"), o["n"]).otherwise(0)).alias("q"),
            F.coalesce(acc["hit"], F.when(here, acc["q"] + at - acc["r"])).alias("hit"),
        )

    return F.aggregate(cigar_operations(cigar), start, step, lambda acc: acc["hit"])


def phred(qual: Column, offset: Column) -> Column:
    """Base quality at a 0-based offset; NULL for missing ('*') or impossible values."""
    score = F.ascii(qual.substr(offset.cast("int") + 1, F.lit(1))) - 33
    return F.when((qual != "*") & score.between(0, 93), score)


def base_at_offset(seq: Column, qual: Column, offset: Column) -> Column:
    """(base, quality) at a query offset; both NULL when the read has no base there."""
    inside = offset.isNotNull() & (seq != "*") & (offset < F.length(seq))
    return F.struct(
        F.when(inside, F.upper(seq.substr(offset.cast("int") + 1, F.lit(1)))).alias("base"), F.when(inside, phred(qual, offset)).alias("quality")
    )


def template_key(read_group: Column, qname: Column) -> Column:
    return F.struct(F.coalesce(read_group, F.lit("")).alias("rg"), qname.alias("qname"))


def has_flag(flag: Column, mask: int) -> Column:
    return flag.bitwiseAND(mask) != 0


# -- nucleotides -----------------------------------------------------------------------------------


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(F.upper(seq), IUPAC, IUPAC_COMPLEMENT))


def letter_count(seq: Column, letters: str) -> Column:
    """Occurrences of any of the letters."""
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def base_counts(seq: Column) -> Column:
    s = F.upper(seq)
    counts = [letter_count(s, b).alias(b.lower()) for b in "ACGT"]
    return F.struct(F.length(s).alias("length"), *counts, letter_count(s, "RYSWKMBDHVN").alias("ambiguous"))


def gc_percent(seq: Column) -> Column:
    """GC percent over unambiguous bases, NULL when there is none."""
    s = F.upper(seq)
    return letter_count(s, "GC") / F.nullif(letter_count(s, "ACGT"), F.lit(0)) * 100


def windows(seq: Column, size: int = 500) -> Column:
    """Fixed windows as (start, piece); `start` is 0-based, the last piece may be short."""
    pieces = F.regexp_extract_all(seq, F.lit("[\\s\\S]{1,%d}" % size), 0)
    return F.transform(pieces, lambda p, i: F.struct((i * size).alias("start"), p.alias("piece")))


def runs_of(seq: Column, letters: str) -> Column:
    """Maximal runs of the given letters as 1-based closed (start, end).

    The sequence is cut at the run borders (zero-width look-around split), so work is linear in its length.
    """
    inside, border = f"[{letters}]", f"(?<=[{letters}])(?=[^{letters}])|(?<=[^{letters}])(?=[{letters}])"
    pieces = F.filter(F.split(seq, border), lambda p: p != "")
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc, p):
        after = (acc["at"] + F.length(p)).cast("int")
        item = F.array(F.struct(acc["at"].alias("start"), (after - 1).alias("end")))
        return F.struct(after.alias("at"), F.when(p.rlike("^" + inside), F.concat(acc["out"], item)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(pieces, start, step, lambda acc: acc["out"])


# -- translation -----------------------------------------------------------------------------------

# Differences of the public genetic codes from the standard one, and their stop codons.
STANDARD = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODE_CHANGES = {
    1: {},
    2: {"AGA": "*", "AGG": "*", "ATA": "M", "TGA": "W"},
    4: {"TGA": "W"},
    5: {"AGA": "S", "AGG": "S", "ATA": "M", "TGA": "W"},
    6: {"TAA": "Q", "TAG": "Q"},
    9: {"AAA": "N", "AGA": "S", "AGG": "S", "TGA": "W"},
    11: {},
    13: {"AGA": "G", "AGG": "G", "ATA": "M", "TGA": "W"},
}
START_CODONS = {
    1: ("TTG", "CTG", "ATG"),
    2: ("ATT", "ATC", "ATA", "ATG", "GTG"),
    4: ("TTA", "TTG", "CTG", "ATT", "ATC", "ATA", "ATG", "GTG"),
    5: ("TTG", "ATT", "ATC", "ATA", "ATG", "GTG"),
    6: ("ATG",),
    9: ("ATG", "GTG"),
    11: ("TTG", "CTG", "ATT", "ATC", "ATA", "ATG", "GTG"),
    13: ("TTG", "ATA", "ATG", "GTG"),
}


def codons(table: int) -> dict[str, str]:
    """Codon to amino acid ('*' for stops) of a genetic code."""
    order = [a + b + c for a in "TCAG" for b in "TCAG" for c in "TCAG"]
    return {**dict(zip(order, STANDARD)), **CODE_CHANGES[table]}


def stop_codons(table: int) -> list[str]:
    return [c for c, aa in codons(table).items() if aa == "*"]


def stop_prefixes(table: int) -> list[str]:
    """Incomplete stops that a poly-A tail completes: prefixes of a stop whose missing letters are A."""
    return sorted({c[:k] for c in stop_codons(table) for k in (1, 2) if set(c[k:]) == {"A"}})


def codon_list(seq: Column) -> Column:
    """Complete codons in frame, cut in one pass over the sequence."""
    return F.regexp_extract_all(seq, F.lit("(?s)..."), 0)


def translate(seq: Column, table: int = 5) -> Column:
    """Protein of the complete codons; a codon with any other letter than ACGT becomes X."""
    code = F.create_map(*[F.lit(x) for pair in codons(table).items() for x in pair])
    clean = F.translate(F.upper(seq), "U", "T")
    return F.array_join(F.transform(codon_list(clean), lambda c: F.coalesce(F.try_element_at(code, c), F.lit("X"))), "")


def ambiguous_codons(seq: Column) -> Column:
    """1-based numbers and start positions of the codons holding an ambiguous letter."""
    found = F.transform(codon_list(F.upper(seq)), lambda c, i: F.struct((i + 1).alias("codon"), (i * 3 + 1).alias("start"), c.alias("text")))
    return F.filter(found, lambda c: ~c["text"].rlike("^[ACGT]{3}$"))


# -- compound locations ----------------------------------------------------------------------------


def feature_length(segments: Column) -> Column:
    return F.aggregate(segments, F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])


def feature_span(segments: Column) -> Column:
    return F.struct(F.array_min(F.transform(segments, lambda s: s["start"])).alias("start"), F.array_max(F.transform(segments, lambda s: s["end"])).alias("end"))


def segment_overlap(a: Column, b: Column) -> Column:
    """Shared bases of two compound locations (half-open segments)."""
    def with_all(total, x):
        return F.aggregate(b, total, lambda s, y: s + F.greatest(F.lit(0).cast("long"), (F.least(x["end"], y["end"]) - F.greatest(x["start"], y["start"])).cast("long")))

    return F.aggregate(a, F.lit(0).cast("long"), with_all)


def coding_positions(segments: Column, strand: Column, codon_start: Column | int = 1) -> Column:
    """1-based genomic positions in transcription order, from the reading frame on.

    Segments are half-open and listed in transcription order; an empty one has no position.
    """
    def positions(s):
        held = F.when(strand < 0, F.sequence(s["end"], s["start"] + 1, F.lit(-1).cast("long"))).otherwise(F.sequence(s["start"] + 1, s["end"]))
        return F.when(s["end"] <= s["start"], F.array().cast("array<bigint>")).otherwise(held)

    every = F.flatten(F.transform(segments, positions))
    start = codon_start.cast("int") if isinstance(codon_start, Column) else F.lit(codon_start)
    return F.slice(every, start, F.size(every))


def segment_size(s: Column) -> Column:
    return F.greatest(s["end"] - s["start"], F.lit(0).cast("long"))


def place_of(segments: Column, strand: Column, nth: Column) -> Column:
    """1-based genomic position of the nth letter (from 0) of the segments, see `coding_positions`; NULL beyond them."""
    none = F.struct(F.lit(0).cast("long").alias("done"), F.lit(None).cast("long").alias("place"))

    def step(acc, s):
        inside = (nth >= acc["done"]) & (nth < acc["done"] + segment_size(s))
        place = F.when(strand < 0, s["end"] - (nth - acc["done"])).otherwise(s["start"] + 1 + nth - acc["done"])
        return F.struct((acc["done"] + segment_size(s)).alias("done"), F.when(inside, place).otherwise(acc["place"]).alias("place"))

    return F.aggregate(segments, none, step, lambda acc: acc["place"])


def letters_at(segments: Column, strand: Column, place: Column) -> Column:
    """Numbers (from 0) of the letters of the segments that lie at a 1-based genomic position; several where segments overlap."""
    none = F.struct(F.lit(0).cast("long").alias("done"), F.array().cast("array<bigint>").alias("found"))

    def step(acc, s):
        nth = acc["done"] + F.when(strand < 0, s["end"] - place).otherwise(place - s["start"] - 1)
        found = F.when((place > s["start"]) & (place <= s["end"]), F.concat(acc["found"], F.array(nth))).otherwise(acc["found"])
        return F.struct((acc["done"] + segment_size(s)).alias("done"), found.alias("found"))

    return F.aggregate(segments, none, step, lambda acc: acc["found"])


def extract(sequence: Column, segments: Column, strand: Column) -> Column:
    """Spliced sequence of a compound location in transcription orientation."""
    def piece(s):
        text = sequence.substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        return F.when(strand < 0, reverse_complement(text)).otherwise(text)

    return F.array_join(F.transform(segments, piece), "")


def anchor_region(left_length: Column, overlap: Column, total: Column, flank: int) -> Column:
    """Closed 1-based region over a join with `flank` own bases on both sides; NULL when it does not fit."""
    low, high = left_length - overlap - flank + 1, left_length + flank
    return F.when((low >= 1) & (high <= total), F.struct(low.alias("low"), high.alias("high")))
