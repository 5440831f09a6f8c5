"""Sequence functions: complements, codons, peptides, reading frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

STOPS = ("TAA", "TAG", "TGA")


def clean_genome(col: str) -> Column:
    """Upper case; everything but ACGT becomes N."""
    return F.upper(F.regexp_replace(col, "[^ATCGatcg]", "N"))


def reverse_complement(col: str) -> Column:
    return F.translate(F.reverse(F.upper(col)), "ACGT", "TGCA")


def codon_at(col: str, position: Column) -> Column:
    """Codon at a 1-based position; shorter at the end."""
    return F.substring(F.col(col), position, F.lit(3))


def codons(text: Column) -> Column:
    """The whole codons of a text, in order."""
    return F.regexp_extract_all(text, F.lit("(...)"), F.lit(1))


def first_of(found: Column, wanted: Sequence[str]) -> Column:
    """The 1-based place of the first codon that is ``wanted``, or null."""
    places = [F.nullif(F.array_position(found, w), F.lit(0)) for w in wanted]
    return F.least(*places) if len(places) > 1 else places[0]


def next_stop(col: str, start: Column) -> Column:
    """1-based position of the first in-frame stop codon at or after ``start``, or null."""
    return start + 3 * (first_of(codons(F.substring(F.col(col), start, F.length(col))), STOPS) - 1)


def peptide_length(col: str) -> Column:
    return F.length(F.regexp_replace(col, r"\*", ""))


def has_internal_stop(col: str) -> Column:
    """A stop before the last character."""
    at = F.instr(col, "*")
    return ((at > 0) & (at < F.length(col))).cast("int")


STARTS = ("ATG",)


def spliced(genome: str, parts: str, strand: str) -> Column:
    """The CDS of a model: its ``parts`` (structs with ``start`` and ``end``, closed, in ascending order) cut out of the genome and
    joined, reversed and complemented on the minus strand."""
    joined = F.array_join(F.transform(parts, lambda p: F.substring(F.col(genome), p["start"], p["end"] - p["start"] + 1)), "")
    return F.when(F.col(strand) == "-", F.translate(F.reverse(F.upper(joined)), "ACGT", "TGCA")).otherwise(F.upper(joined))


def end_codons(cds: Column, phase: Column | int = 0) -> tuple[Column, Column]:
    """First and last whole codon of a spliced CDS after ``phase`` bases are skipped."""
    frame = F.substring(cds, (phase if isinstance(phase, Column) else F.lit(phase)) + 1, F.length(cds))
    whole = F.floor(F.length(frame) / 3).cast("int") * 3
    return F.substring(frame, F.lit(1), F.lit(3)), F.when(whole > 0, F.substring(frame, whole - 2, F.lit(3))).otherwise("")


def previous_start(seq: str, position: Column) -> Column:
    """1-based position of the first start codon after the nearest in-frame stop upstream of ``position`` (and up to it), or
    null. Without a stop upstream the search reaches the sequence's beginning. Linear in the length of the sequence."""
    first = F.pmod(position - 1, F.lit(3)) + 1
    up_to = codons(F.substring(F.col(seq), first.cast("int"), (position - first + 3).cast("int")))
    before = F.slice(up_to, F.lit(1), F.floor((position - first) / 3).cast("int"))
    stop = F.coalesce(F.size(before) + 1 - first_of(F.reverse(before), STOPS), F.lit(0)).cast("int")
    behind = F.slice(up_to, stop + 1, F.greatest(F.size(up_to) - stop, F.lit(0)))
    return F.when(position >= 1, first + 3 * (stop + first_of(behind, STARTS) - 1))


def fill_plan(first: Column, last: Column) -> Column:
    """What a model lacks: ``none``, ``start``, ``stop`` or ``both``. The stop is looked for first, and a model is whole only if
    every end it lacks is found."""
    start, stop = first.isin(*STARTS), last.isin(*STOPS)
    return F.when(start & stop, "none").when(stop, "start").when(start, "stop").otherwise("both")


def clean_protein(col: str) -> Column:
    return F.translate(F.col(col), "*.", "")


def clean_header(col: str) -> Column:
    """A sequence name without slashes, up to the first blank."""
    return F.regexp_replace(F.regexp_extract(F.col(col), r"^(\S*)", 1), "/", "_")


def mate(col: str) -> Column:
    """1 or 2 from a read name that ends in ``/1`` or ``/2``, else null."""
    return F.nullif(F.regexp_extract(F.col(col), "/([12])$", 1), F.lit("")).cast("int")


def safe_name(col: str) -> Column:
    """A file name of a sequence name."""
    return F.regexp_replace(F.col(col), "[^A-Za-z0-9._-]", "_")


def split_region(col: str) -> list[Column]:
    """``seqid, start, end`` of a name ``<seqid>.<start>-<end>[.sam]``; sequence names may hold dots."""
    return [F.regexp_extract(F.col(col), r"^(?:.*/)?(.*)\.(\d+)-(\d+)(?:\.sam)?$", i + 1).alias(n) if i == 0 else F.regexp_extract(F.col(col), r"^(?:.*/)?(.*)\.(\d+)-(\d+)(?:\.sam)?$", i + 1).try_cast("long").alias(n) for i, n in enumerate(("seqid", "start", "end"))]


def feature_suffix(col: str) -> Column:
    """The kind of feature that an id names (``cds``, ``exon``, ``utr5p`` and so on with a number), or null."""
    kinds = "cds|exon|intron|utr5p|utr3p|five_prime_utr|three_prime_utr"
    return F.nullif(F.regexp_extract(F.lower(F.col(col)), rf"((?:{kinds})\.?\d*)", 1), F.lit(""))
