"""Sequence functions: every one is a Column expression inside codegen or a
higher-order function; none needs a Python worker.

Positions within transcripts and coding sequences are 0-based, genomic ones
1-based and inclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The genetic codes 1 and 2, amino acids in the order of bases TCAG.
BASES = "TCAG"
STANDARD_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
MITO_CODE = "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSS**VVVVAAAADDEEGGGG"
MITO_CONTIGS = ("chrM", "chrMT", "MT", "M")
# Complements of the IUPAC base letters.
IUPAC, COMPLEMENT = "ACGTUNRYSWKMBDHVacgtunryswkmbdhv", "TGCAANYRSWMKVHDBtgcaanyrswmkvhdb"
# Three-letter amino acid names.
THREE_LETTER = {
    "Ala": "A", "Arg": "R", "Asn": "N", "Asp": "D", "Cys": "C", "Gln": "Q", "Glu": "E", "Gly": "G", "His": "H", "Ile": "I",
    "Leu": "L", "Lys": "K", "Met": "M", "Phe": "F", "Pro": "P", "Ser": "S", "Thr": "T", "Trp": "W", "Tyr": "Y", "Val": "V", "Ter": "*", "Sec": "U",
}


def as_column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def codon_map(code: str = STANDARD_CODE) -> Column:
    codons = [a + b + c for a in BASES for b in BASES for c in BASES]
    return F.create_map(*(F.lit(x) for pair in zip(codons, code, strict=True) for x in pair))


def revcomp(seq: Column | str) -> Column:
    return F.reverse(F.translate(as_column(seq), IUPAC, COMPLEMENT))


def _indices(n: Column) -> Column:
    """0 to n - 1; empty for no n."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


#: All codons, with a mark between them, so that each is found at its own place only.
_CODONS = ".".join(a + b + c for a in BASES for b in BASES for c in BASES)


def _placed(code: str) -> str:
    """X for no place, then residues at their codons' places and X between."""
    return "X" + "XXX".join(code)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of the value, which is worked out once however often
    it is named: an expression that is named again is worked out again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def residues(nt: Column | str, code: Column | None = None, mito: Column | None = None, sec: Column | None = None) -> Column:
    """One residue for each whole codon: '*' for stop, X for a codon with other
    letters, U for a TGA codon whose index is in ``sec``."""
    bases = F.replace(F.upper(as_column(nt)), F.lit("U"), F.lit("T"))
    codes = F.lit(_placed(STANDARD_CODE))
    if mito is not None:
        codes = F.when(mito, _placed(MITO_CODE)).otherwise(codes)

    def one(codon: Column, i: Column) -> Column:
        aa = F.substring(codes, F.position(codon, F.lit(_CODONS)) + 1, F.lit(1))
        if code is not None:
            own = F.coalesce(F.try_element_at(code, codon), F.lit("X"))
            aa = own if mito is None else F.when(mito, aa).otherwise(own)
        return F.when((codon == "TGA") & F.array_contains(sec, i) & (aa == "*"), "U").otherwise(aa) if sec is not None else aa

    # one pass cuts the codons; a substring per codon would walk from the start each time
    return F.transform(F.regexp_extract_all(bases, F.lit("(?s)(.{3})"), F.lit(1)), one)


def letters(seq: Column) -> Column:
    """The characters as an array."""
    return F.filter(F.split(seq, ""), lambda c: c != "")


def translate_orf(nt: Column | str, mito: Column | None = None, sec: Column | None = None, to_stop: bool = True) -> Column:
    """struct(protein, stop_found, trailing_partial, ambiguous_codons,
    selenocysteines) of frame 0.  Ambiguous and Sec codons count up to the stop."""

    def told(read: Column, stop: Column) -> Column:
        protein = F.array_join(read, "")
        count = lambda p, aa: F.length(p) - F.length(F.replace(p, F.lit(aa), F.lit("")))
        return once(protein, lambda p: F.struct(
            p.alias("protein"),
            (stop > 0).alias("stop_found"),
            (F.length(as_column(nt)) % 3).alias("trailing_partial"),
            count(p, "X").alias("ambiguous_codons"),
            (count(p, "U") if sec is not None else F.lit(0)).alias("selenocysteines"),
        ))

    def upto(aas: Column, stop: Column) -> Column:
        return F.when(stop > 0, F.slice(aas, F.lit(1), stop.cast("int") - 1)).otherwise(aas) if to_stop else aas

    return once(residues(nt, mito=mito, sec=sec), lambda aas: once(F.array_position(aas, "*"), lambda stop: told(upto(aas, stop), stop)))


def protein_of(nt: Column | str, mito: Column | None = None, sec: Column | None = None) -> Column:
    return F.substring_index(F.array_join(residues(nt, mito=mito, sec=sec), ""), "*", 1)


def first_atg_offset(nt: Column | str, min_aa: int = 8) -> Column:
    """Offset of the first ATG whose reading frame gives at least ``min_aa``
    residues before a stop; null if there is none."""
    seq = F.upper(as_column(nt))
    starts = F.filter(_indices(F.length(seq) - 2), lambda i: F.substring(seq, i + 1, F.lit(3)) == "ATG")
    return F.get(F.filter(starts, lambda i: F.length(protein_of(F.substring(seq, i + 1, F.length(seq)))) >= min_aa), F.lit(0))


def peptide_window(protein: Column | str, pos0: Column, flank: int) -> Column:
    """struct(window, at): residues around a 0-based position, and where it is
    within them."""
    p = as_column(protein)
    start = F.greatest(F.lit(0), pos0 - flank)
    end = F.least(F.length(p), pos0 + flank + 1)
    return F.struct(F.substring(p, start + 1, F.greatest(F.lit(0), end - start)).alias("window"), (pos0 - start).alias("at"))


def first_difference(a: Column | str, b: Column | str) -> Column:
    """0-based index of the first difference, else the shorter length."""
    x, y = as_column(a), as_column(b)
    # beyond the shorter end one side is null, and so is the comparison
    at = F.array_position(F.zip_with(letters(x), letters(y), lambda p, q: F.coalesce(p != q, F.lit(False))), F.lit(True))
    return once(at, lambda n: F.when(n > 0, n.cast("int") - 1).otherwise(F.least(F.length(x), F.length(y))))


def hgvs_change(hgvs: Column | str) -> Column:
    """struct(ref, pos, alt) of a simple substitution in one- or three-letter
    form; null for everything else."""
    s = F.regexp_replace(F.trim(as_column(hgvs)), "^p\\.", "")
    names = "|".join(THREE_LETTER)
    table = F.create_map(*(F.lit(x) for pair in THREE_LETTER.items() for x in pair))
    three = f"^({names})([0-9]+)({names})$"
    one = "^([A-Za-z])([0-9]+)([ACDEFGHIKLMNPQRSTVWY*X])$"
    pick = lambda pattern, k: F.regexp_extract(s, pattern, k)
    made = lambda ref, pos, alt: F.struct(ref.alias("ref"), pos.cast("int").alias("pos"), alt.alias("alt"))
    return (
        F.when(s.rlike(three), made(F.try_element_at(table, pick(three, 1)), pick(three, 2), F.try_element_at(table, pick(three, 3))))
        .when(s.rlike(one), made(pick(one, 1), pick(one, 2), pick(one, 3)))
    )


def small_class(ref: Column | str, alt: Column | str) -> Column:
    r, a = F.length(as_column(ref)), F.length(as_column(alt))
    return F.when((r == 1) & (a == 1), "SNV").when(r == a, "MNV").otherwise("INDEL")


def left_anchored(ref: Column | str, alt: Column | str) -> Column:
    r, a = as_column(ref), as_column(alt)
    return (F.length(r) != F.length(a)) & (F.length(r) > 0) & (F.length(a) > 0) & (F.substring(r, 1, 1) == F.substring(a, 1, 1))


def consequence(ref_p: Column, alt_p: Column, ref_len: Column, alt_len: Column, alt_stop: Column) -> Column:
    """Effect of a coding change, in the order of the rules."""
    d = alt_len - ref_len
    lost = (F.length(alt_p) > 0) & (F.substring(ref_p, 1, 1) == "M") & (F.substring(alt_p, 1, 1) != "M")
    return (
        F.when(d % 3 != 0, "frameshift").when(ref_p == alt_p, "synonymous").when(lost, "start_lost")
        .when(d > 0, "inframe_insertion").when(d < 0, "inframe_deletion")
        .when((F.length(alt_p) < F.length(ref_p)) & alt_stop, "stop_gained")
        .when(F.length(alt_p) > F.length(ref_p), "stop_lost").otherwise("missense")
    )


def change_text(effect: Column, ref_p: Column, alt_p: Column, idx: Column) -> Column:
    """The protein change in short form; ``idx`` is the first difference."""
    at = lambda p: F.substring(p, idx + 1, F.lit(1))
    place = F.concat(F.lit("p."), at(ref_p), (idx + 1).cast("string"))
    in_ref, in_alt = idx < F.length(ref_p), idx < F.length(alt_p)
    return (
        F.when(effect == "synonymous", "p.(=)")
        .when((effect == "frameshift") & in_ref, F.concat(place, F.when(in_alt, at(alt_p)).otherwise("*"), F.lit("fs*"), (F.length(alt_p) - idx).cast("string")))
        .when((effect == "stop_gained") & in_ref, F.concat(place, F.lit("*")))
        .when(in_ref & in_alt, F.concat(place, at(alt_p)))
        .when(in_ref, F.concat(place, F.lit("del"))).otherwise("")
    )


def junction_offsets(exon_lengths: Column) -> Column:
    """Transcript offsets of the exon junctions: running sums but the last."""
    sums = F.aggregate(exon_lengths, F.array().cast("array<bigint>"), lambda acc, x: F.concat(acc, F.array((F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x).cast("bigint"))))
    n = F.size(exon_lengths)
    return F.when(n > 1, F.slice(sums, F.lit(1), F.greatest(F.lit(1), n - 1))).otherwise(F.array().cast("array<bigint>"))


NMD_BOUNDARY = 50


def nmd(stop_off: Column, exon_lengths: Column, variant_off: Column, delta: Column, stop_found: Column, boundary: int = NMD_BOUNDARY) -> Column:
    """struct(nmd, reason, distance): a stop more than ``boundary`` bases before
    the last junction, junctions after the variant shifted by its length
    change, is likely a target of decay."""
    junctions = F.transform(junction_offsets(exon_lengths), lambda j: F.when((delta != 0) & (j > variant_off), j + delta).otherwise(j))
    none = stop_off.isNull() | ~stop_found

    def told(last: Column) -> Column:
        distance = last - stop_off
        state = F.when(none, "no_stop").when(last.isNull(), "escapes").when(distance > boundary, "likely").otherwise("escapes")
        reason = (
            F.when(none, "").when(last.isNull(), "single_exon_transcript")
            .when(distance > boundary, F.concat(F.lit("stop_"), distance.cast("string"), F.lit("nt_upstream_of_last_junction")))
            .when(stop_off >= last, "stop_in_last_exon").otherwise(f"stop_within_{boundary}nt_of_last_junction")
        )
        return F.struct(state.alias("nmd"), reason.alias("reason"), F.when(~none, distance).alias("distance"))

    return once(F.try_element_at(junctions, F.lit(-1)), told)


# -- transcripts: exons are an array of struct(s, e) in transcription order --


def block_length(b: Column) -> Column:
    return b["e"] - b["s"] + 1


def total_length(blocks: Column) -> Column:
    return F.aggregate(blocks, F.lit(0).cast("bigint"), lambda acc, b: acc + block_length(b))


def genomic_to_tx(exons: Column, strand: Column, pos: Column) -> Column:
    """0-based transcript offset of a genomic position; null within introns."""
    start = F.struct(F.lit(0).cast("bigint").alias("run"), F.lit(None).cast("bigint").alias("at"))

    def step(acc: Column, b: Column) -> Column:
        inside = (b["s"] <= pos) & (pos <= b["e"])
        here = acc["run"] + F.when(strand == "+", pos - b["s"]).otherwise(b["e"] - pos)
        return F.struct((acc["run"] + block_length(b)).cast("bigint").alias("run"), F.coalesce(acc["at"], F.when(inside, here)).cast("bigint").alias("at"))

    return F.aggregate(exons, start, step, lambda acc: acc["at"])


def tx_to_genomic(exons: Column, strand: Column, offset: Column) -> Column:
    """The genomic position of a transcript offset: the inverse of the above."""
    start = F.struct(F.lit(0).cast("bigint").alias("run"), F.lit(None).cast("bigint").alias("at"))

    def step(acc: Column, b: Column) -> Column:
        k = offset - acc["run"]
        inside = (k >= 0) & (k < block_length(b))
        here = F.when(strand == "+", b["s"] + k).otherwise(b["e"] - k)
        return F.struct((acc["run"] + block_length(b)).cast("bigint").alias("run"), F.coalesce(acc["at"], F.when(inside, here)).cast("bigint").alias("at"))

    return F.aggregate(exons, start, step, lambda acc: acc["at"])


def cds_offset(exons: Column, cds: Column, strand: Column, phase: Column) -> Column:
    """Offset of the first translated base, the first block's frame included."""
    first = F.get(cds, F.lit(0))
    anchor = F.when(strand == "+", first["s"]).otherwise(first["e"])
    return genomic_to_tx(exons, strand, anchor) + phase


def tx_interval(exons: Column, strand: Column, pos: Column, n: Column) -> Column:
    """First transcript offset of n genomic bases from pos on, if all are
    exonic and adjacent on the transcript; else null."""
    ends = F.struct(genomic_to_tx(exons, strand, pos).alias("a"), genomic_to_tx(exons, strand, pos + n - 1).alias("b"))
    return once(ends, lambda x: F.when((n > 0) & (F.abs(x["b"] - x["a"]) + 1 == n), F.least(x["a"], x["b"])))


def sec_codons(exons: Column, strand: Column, sites: Column, cds_off: Column, variant_off: Column | None = None, delta: Column | None = None) -> Column:
    """Codon indices of selenocysteine sites, moved by one length change or
    dropped where it changes the codon itself."""
    at = F.filter(F.transform(sites, lambda g: genomic_to_tx(exons, strand, g)), lambda x: x.isNotNull())
    if variant_off is not None:
        hit = lambda x: (delta != 0) & (variant_off >= x) & (variant_off < x + 3)
        at = F.transform(F.filter(at, lambda x: ~hit(x)), lambda x: F.when((delta != 0) & (variant_off < x), x + delta).otherwise(x))
    rel = F.filter(F.transform(at, lambda x: x - cds_off), lambda r: (r >= 0) & (r % 3 == 0))
    return F.transform(rel, lambda r: F.floor(r / 3).cast("int"))


def bases_upto(exons: Column, strand: Column, pos: Column) -> Column:
    """Transcript bases from the 5' end through a breakpoint; an intronic one
    snaps to the end of the exon before it."""
    part = lambda b: F.when(strand == "+", F.greatest(F.lit(0), F.least(b["e"], pos) - b["s"] + 1)).otherwise(F.greatest(F.lit(0), b["e"] - F.greatest(b["s"], pos) + 1))
    return F.aggregate(exons, F.lit(0).cast("bigint"), lambda acc, b: (acc + part(b)).cast("bigint"))


def bases_before(exons: Column, strand: Column, pos: Column) -> Column:
    return bases_upto(exons, strand, pos) - genomic_to_tx(exons, strand, pos).isNotNull().cast("int")


def junctions(exons: Column) -> Column:
    """Introns as 'last base of an exon-first base of the next' texts."""
    ordered = F.array_sort(F.transform(exons, lambda b: F.struct(b["s"].alias("s"), b["e"].alias("e"))))
    pairs = F.zip_with(F.slice(ordered, F.lit(1), F.greatest(F.lit(0), F.size(ordered) - 1)), F.slice(ordered, F.lit(2), F.greatest(F.lit(0), F.size(ordered) - 1)), lambda a, b: F.concat_ws("-", a["e"].cast("string"), b["s"].cast("string")))
    return F.when(F.size(exons) > 1, pairs).otherwise(F.array().cast("array<string>"))


def splice(seq: Column, start: Column, length: Column, allele: Column) -> Column:
    return F.concat(F.substring(seq, F.lit(1), start.cast("int")), allele, F.substring(seq, (start + length + 1).cast("int"), F.length(seq)))


def splice_all(seq: Column, placements: Column) -> Column:
    """All placements (struct start, len, allele), from right to left; null if
    two overlap."""
    ordered = F.array_sort(placements, lambda a, b: F.when(a["start"] > b["start"], -1).when(a["start"] < b["start"], 1).otherwise(0))
    clash = F.exists(F.zip_with(F.slice(ordered, F.lit(1), F.greatest(F.lit(1), F.size(ordered) - 1)), F.slice(ordered, F.lit(2), F.greatest(F.lit(1), F.size(ordered) - 1)), lambda right, left: left["start"] + left["len"] > right["start"]), lambda x: F.coalesce(x, F.lit(False)))
    return F.when(~clash, F.aggregate(ordered, seq, lambda acc, p: splice(acc, p["start"], p["len"], p["allele"])))


def open_frames(nt: Column | str, min_aa: int = 30, require_atg: bool = True) -> Column:
    """Reading frames between stops in the three forward frames: an array of
    struct(length_key, frame, nt_start, nt_end, protein, started_at_atg,
    stop_found), longest first, then by frame and start."""
    seq = as_column(nt)
    none = F.array().cast("array<struct<length_key:int,frame:int,nt_start:int,nt_end:int,protein:string,started_at_atg:boolean,stop_found:boolean>>")
    found = []
    for frame in range(3):
        n = F.floor((F.length(seq) - frame) / 3)
        chunks = F.split(F.array_join(residues(F.substring(seq, F.lit(frame + 1), F.length(seq))), ""), "\\*")
        # one fold over the chunks carries the place; a lambda that named the whole translation would redo it for each chunk
        start = F.struct(F.lit(0).alias("at"), none.alias("orfs"))

        def step(acc: Column, c: Column) -> Column:
            frame_, n_ = scope
            skip = F.instr(c, "M") - 1 if require_atg else F.lit(0)
            kept = F.when(skip >= 0, F.substring(c, skip + 1, F.length(c))).otherwise("")
            begin = F.lit(frame_) + (acc["at"] + F.greatest(F.lit(0), skip)) * 3
            orf = F.struct((-F.length(kept)).cast("int").alias("length_key"), F.lit(frame_).alias("frame"), begin.cast("int").alias("nt_start"), (begin + F.length(kept) * 3).cast("int").alias("nt_end"), kept.alias("protein"), kept.startswith("M").alias("started_at_atg"), (acc["at"] + F.length(c) < n_).alias("stop_found"))
            more = F.when(F.length(kept) >= min_aa, F.concat(acc["orfs"], F.array(orf))).otherwise(acc["orfs"])
            return F.struct((acc["at"] + F.length(c) + 1).cast("int").alias("at"), more.alias("orfs"))

        scope = (frame, n)
        found.append(F.aggregate(chunks, start, step, lambda acc: acc["orfs"]))
    return F.array_sort(F.concat(*found))
