"""Identifiers and FASTA headers as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..species import Species
from .sequence import as_column


def sanitised(x: Column | str) -> Column:
    """Other characters become one underscore; none at the ends; NA for none."""
    clean = F.btrim(F.regexp_replace(as_column(x), "[^A-Za-z0-9_.:\\-]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit("NA"))


def wrapped(seq: Column | str, width: int = 60) -> Column:
    return F.regexp_replace(as_column(seq), f"(.{{{width}}})(?=.)", "$1\n")


def stated(confidence: Column | str) -> Column:
    """A confidence that says something; null for empty and not-a-number."""
    c = F.trim(as_column(confidence).cast("string"))
    return F.when(~F.lower(c).isin("", "nan", "none", "na", "."), c)


def joined(first: Column, fields: dict[str, Column]) -> Column:
    """The first word, then KEY=value for each field that is not null or empty."""
    parts = [F.when(F.length(v.cast("string")) > 0, F.concat(F.lit(f"{k}="), v.cast("string"))) for k, v in fields.items()]
    return F.concat_ws(" ", first, *parts)


def descriptive(r: dict[str, Column]) -> Column:
    return joined(r["seq_id"], {"VT": r["variant_class"], "CSQ": r["consequence"], "GN": r["gene"], "TX": r["transcript"], "CHANGE": r["protein_change"], "LOC": r["locus"], "CONF": stated(r["confidence"]), "SRC": r["source"]})


def uniprot(r: dict[str, Column], species: str = "HUMAN", os: str = "Homo sapiens", ox: int = 9606, reference: bool = False) -> Column:
    """The db|accession|entry grammar; reference entries carry no variant fields."""
    first = F.concat(F.lit("ref|" if reference else "var|"), r["serial"], F.lit("|"), sanitised(r["gene"]), F.lit(f"_{species}"))
    text = F.lit("reference protein") if reference else F.concat_ws(" ", r["gene"], r["protein_change"])
    base = {"OS": F.lit(os), "OX": F.lit(str(ox)), "GN": r["gene"]}
    more = {"TX": r["transcript"]} | ({} if reference else {"VT": r["variant_class"], "CSQ": r["consequence"], "LOC": r["locus"], "CONF": stated(r["confidence"]), "SRC": r["source"]})
    return joined(F.concat_ws(" ", first, text), base | more)


def uniprot_of(species: Species) -> Callable[[dict[str, Column]], Column]:
    """The same for an organism: reference entries by their class."""

    def render(r: dict[str, Column]) -> Column:
        own = {"species": species.entry_suffix, "os": species.scientific, "ox": species.taxon}
        return F.when(r["variant_class"] == "REFERENCE", uniprot(r, **own, reference=True)).otherwise(uniprot(r, **own))

    return render


def peff(r: dict[str, Column], prefix: str = "vt") -> Column:
    """The proteomics extended format: backslash keys with bracketed values."""
    field = lambda k, v: F.when(F.length(v.cast("string")) > 0, F.concat(F.lit(f"\\{k}="), v.cast("string")))
    return F.concat_ws(" ", F.concat(F.lit(f"{prefix}:"), sanitised(r["seq_id"])), field("PName", r["gene"]), field("GName", r["gene"]), field("Length", F.length(r["sequence"])), field("VariantSimple", r["protein_change"]), field("ProteoformDb", r["variant_class"]))


PEFF_FILE_HEADER = ("# PEFF 1.0", "# //")


def peff_file_header(species: Species, entries: int) -> list[str]:
    """The lines that come before the first entry of such a file."""
    return [PEFF_FILE_HEADER[0], "# DbName=varloom", "# Prefix=vt", "# DbVersion=1", f"# NumberOfEntries={entries}", "# SequenceType=AA", f"# SpecificKeys=ProteoformDb:class of the variant ({species.scientific})", PEFF_FILE_HEADER[1]]


def pvac(r: dict[str, Column]) -> Column:
    return F.concat_ws(".", F.lit("MT"), sanitised(r["gene"]), sanitised(r["transcript"]), sanitised(r["consequence"]), sanitised(r["protein_change"]))


def peptide_counts(r: dict[str, Column], normal: bool) -> Column:
    """What is said of an entry's classes and peptides behind its header."""
    also = F.when(F.length(r["also"]) > 0, F.concat(F.lit(" ALSO="), r["also"]))
    fields = {"NOVELPEP": "n_novel", "VARPEP": "n_variant_peptides", "NPEP": "n_peptides"} | ({"NORMPEP": "n_in_normal", "NOVELVSNORM": "n_novel_vs_normal", "VARPEPVSNORM": "n_variant_vs_normal"} if normal else {})
    return F.concat(F.coalesce(also, F.lit("")), *(F.concat(F.lit(f" {k}="), r[c]) for k, c in fields.items()))


# How headers of several tools name a gene, the most explicit first, and what a symbol looks like.
GENE_PATTERNS = ("\\bGN=([A-Za-z0-9_.\\-]+)", "\\bGName=([A-Za-z0-9_.\\-]+)", "gene_symbol:([A-Za-z0-9_.\\-]+)", "gene[:=]([A-Za-z0-9_.\\-]+)")
SYMBOL = "^[A-Z0-9]{2,}(--?[A-Z0-9]{2,})?$"


def gene_guess(header: Column | str) -> Column:
    """The gene that a foreign header seems to name: by a pattern, else the
    first word of capitals and digits that is no number; NA for none."""
    h = as_column(header)
    named = [F.nullif(F.regexp_extract(h, p, 1), F.lit("")) for p in GENE_PATTERNS]
    words = F.filter(F.split(h, "[|\\s.]"), lambda w: w.rlike(SYMBOL) & ~w.rlike("^[0-9]+$"))
    return F.coalesce(*named, F.get(words, F.lit(0)), F.lit("NA"))


def fusion_ends(locus: Column | str) -> Column:
    """struct(chrom1, pos1, chrom2, pos2) of chrom:pos::chrom:pos; null for
    other loci."""
    x = as_column(locus)
    pattern = "^(.+):([0-9]+)::(.+):([0-9]+)$"
    part = lambda i: F.regexp_extract(x, pattern, i)
    return F.when(x.rlike(pattern), F.struct(part(1).alias("chrom1"), part(2).cast("bigint").alias("pos1"), part(3).alias("chrom2"), part(4).cast("bigint").alias("pos2")))


def one_locus_note(locus: Column | str, window: int = 1_000_000) -> Column:
    """What speaks for a read-through: both ends on a chromosome, near each
    other; null otherwise."""
    e = fusion_ends(locus)
    gap = F.abs(e["pos2"] - e["pos1"])
    return F.when((e["chrom1"] == e["chrom2"]) & (gap <= window), F.concat(F.lit("ends "), F.round(gap / 1000).cast("bigint").cast("string"), F.lit(" kb apart on "), e["chrom1"], F.lit(": a read-through or an event within a cluster is likelier than a fusion of distant genes")))


STYLES = {"uniprot": uniprot, "peff": peff, "pvac": pvac, "descriptive": descriptive}


def header_map(header: Column | str) -> Column:
    """KEY=value words of a header; the last of a key wins."""
    pairs = F.regexp_extract_all(as_column(header), F.lit("(?:^|\\s)([A-Za-z]+=\\S*)"), F.lit(1))
    last = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda acc, p: F.map_concat(F.map_filter(acc, lambda k, _: k != F.substring_index(p, "=", 1)), F.create_map(F.substring_index(p, "=", 1), F.substr(p, F.instr(p, "=") + 1))))
    return last


def uniprot_fields(header: Column | str) -> Column:
    """db, accession, entry name, description and the usual keys of a header."""
    h = F.regexp_replace(as_column(header), "^>", "")
    key = lambda k: F.nullif(F.regexp_extract(h, f"(?:^|\\s){k}=(.*?)(?=\\s[A-Z]{{2}}=|$)", 1), F.lit(""))
    head = "^([a-z]{2,3})\\|([^|]+)\\|(\\S+)"
    return F.struct(
        F.regexp_extract(h, head, 1).alias("db"), F.regexp_extract(h, head, 2).alias("accession"), F.regexp_extract(h, head, 3).alias("entry_name"),
        F.trim(F.regexp_extract(h, head + "\\s*(.*?)(?=\\s[A-Z]{2}=|$)", 4)).alias("description"),
        *(key(k).alias(k.lower()) for k in ("OS", "OX", "GN", "PE", "SV")),
    )
