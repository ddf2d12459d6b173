"""Audits against a second computation, line by line."""

import gzip
import re
from collections import Counter, defaultdict

from fixture import build

from varloom.plans import audits
from varloom.sources import evidence


def as_counts(df):
    return {(r["what"], r["key"]): r["n"] for r in df.collect()}


def test_annotation_audit(spark, tmp_path):
    build(tmp_path)
    line = lambda chrom, kind, frame, attrs: "\t".join([chrom, "t", kind, "11", "40", ".", "+", frame, attrs])
    more = []
    for i, (chrom, gene, tags, frame) in enumerate((("chrX", "G1", ["basic", "MANE_Select"], "0"), ("chrY", "G1_PAR_Y", ["basic"], "0"), ("chr5", "G2", ["cds_start_NF", "cds_end_NF"], "2"), ("chr5", "G3", [], "1"), ("chrM", "G4", ["basic"], "0"))):
        a = f'gene_id "{gene}"; transcript_id "X{i}"; gene_name "N{i // 2}"; transcript_type "protein_coding"; ' + "".join(f'tag "{t}"; ' for t in tags)
        more += [line(chrom, "transcript", ".", a), line(chrom, "exon", ".", a), line(chrom, "CDS", frame, a), line(chrom, "stop_codon", "0", a)]
    text = "# head\n" + (tmp_path / "genes.gtf").read_text() + "\n".join([*more, "too\tshort"]) + "\n"
    (tmp_path / "a.gtf").write_text(text)
    want, first, genes = Counter(), {}, defaultdict(set)
    for x in text.splitlines():
        f = x.split("\t")
        if x.startswith("#") or len(f) < 9:
            continue
        get = lambda k: (re.findall(f'{k} "([^"]*)"', f[8]) or ["?"])[0]  # noqa: B023, E731
        want["feature", f[2]] += 1
        want["contig", f[0]] += 1
        tags = re.findall('tag "([^"]*)"', f[8])
        if f[2] == "CDS":
            want["frame", f[7]] += 1
            first.setdefault(get("transcript_id"), f[7])
            genes[get("gene_name")].add(get("gene_id"))
            want["mito_cds", ""] += f[0] == "chrM"
        if f[2] == "transcript":
            want["transcript_type", get("transcript_type")] += 1
            for t in tags:
                want["tag", t] += 1
            want["par_y", ""] += "PAR_Y" in get("gene_id")
            want["start_not_found", ""] += "cds_start_NF" in tags
            want["end_not_found", ""] += "cds_end_NF" in tags
    for frame in first.values():
        want["first_frame", frame] += frame != "0"
    want["ambiguous_gene_names", ""] = sum(len(g) > 1 for g in genes.values())
    assert as_counts(audits.annotation_audit(spark, str(tmp_path / "a.gtf"))) == {k: n for k, n in want.items() if n}
    assert want["ambiguous_gene_names", ""] == 2 and want["first_frame", "2"] == 1


def test_genome_and_proteome_audits(spark, tmp_path):
    contigs = {"chr1": "ACGTNNacgtn" * 40, "chr1_x_alt": "acgt", "chr2_y_random": "N" * 7, "chrUn_z": "ACG", "chrM": "aA"}
    (tmp_path / "g.fa").write_text("".join(f">{c} words\n" + "".join(s[i : i + 50] + "\n" for i in range(0, len(s), 50)) for c, s in contigs.items()))
    got = {r["contig"]: tuple(r)[1:] for r in audits.genome_audit(spark, str(tmp_path / "g.fa")).collect()}
    kinds = {"chr1": "primary", "chr1_x_alt": "alternative", "chr2_y_random": "unlocalised", "chrUn_z": "unplaced", "chrM": "mitochondrial"}
    assert got == {c: (len(s), sum(x.islower() for x in s), s.upper().count("N"), kinds[c]) for c, s in contigs.items()}
    (tmp_path / "p.fa").write_text(">sp|P1|A_H x OS=Homo sapiens OX=9606 GN=A PE=1 SV=1\nMUX\nAA\n>tr|P2-2|B_H x OS=y GN=A\nAAB\n>sp|P3|C_H x\nMB\n")
    assert as_counts(audits.proteome_audit(spark, str(tmp_path / "p.fa"))) == {
        ("database", "sp"): 2, ("database", "tr"): 1, ("field", "OS"): 2, ("field", "OX"): 1, ("field", "GN"): 2, ("field", "PE"): 1, ("field", "SV"): 1, ("isoform", ""): 1, ("wrapped", ""): 1, ("no_methionine", ""): 1,
        ("residue", "U"): 1, ("residue", "X"): 1, ("residue", "B"): 2, ("genes_of_several_entries", ""): 1,
    }


def test_gzip_is_known_by_its_bytes(spark, tmp_path):
    """Compressed files under any name are read, plain ones are left alone."""
    body = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\nchr1\t5\t.\tA\tC\t.\tPASS\t.\n"
    (tmp_path / "packed.vcf").write_bytes(gzip.compress(body.encode()))
    (tmp_path / "named.vcf.gz").write_bytes(gzip.compress(body.encode()))
    (tmp_path / "plain.vcf").write_text(body)
    (tmp_path / "empty.vcf").write_text("")
    for name, moved in (("packed.vcf", True), ("named.vcf.gz", False), ("plain.vcf", False), ("empty.vcf", False), ("absent.vcf", False)):
        path = evidence.readable(spark, str(tmp_path / name))
        assert (path != str(tmp_path / name)) == moved
        if name in ("packed.vcf", "named.vcf.gz", "plain.vcf"):
            assert [r["variant_id"] for r in evidence.read_vcf(spark, path).collect()] == ["chr1:5A>C"]
    assert evidence.readable(spark, str(tmp_path)) == str(tmp_path)
