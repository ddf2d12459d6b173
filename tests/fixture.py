"""A constructed genome whose proteins are known by construction."""

import random

CODONS = {"M": "ATG", "K": "AAA", "Q": "CAA", "Y": "TAC", "A": "GCT", "G": "GGT", "L": "CTG", "S": "TCT", "D": "GAT", "E": "GAA", "R": "CGT", "P": "CCT", "W": "TGG", "U": "TGA", "V": "GTT", "N": "AAC", "T": "ACT"}
PLUS = "MAKGQLYSDERPWVNTAGLLKSDEYYQRAAGVTNKLSDEPWQRAGGTVMKLSD"
MINUS = "MGKAYLQDERSPWTVNKGALLSDERYQKAAVTGNLKSDEPQWRGAGTVLMKSD"
SELENO = "MAGSUKLDERVTNAGSYKLAUGSDEKR"
MITO = "MAWGKLSDERVTNAGSYKLAAGSDEKRW"


def nt(protein, mito=False):
    return "".join("TGA" if c == "W" and mito else CODONS[c] for c in protein) + "TAA"


def revcomp(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def filler(n, seed):
    r = random.Random(seed)
    return "".join(r.choice("CT") for _ in range(n))


def build(folder):
    """Writes genome.fa and genes.gtf; returns facts the tests use."""
    contigs, gtf, facts = {}, [], {}

    def gene(name, chrom, strand, exons, cds, extra="", sec=()):
        a = f'gene_id "{name}.1"; transcript_id "T_{name}"; gene_name "{name}"; gene_type "protein_coding"; transcript_type "protein_coding"; tag "Ensembl_canonical"; {extra}'
        for kind, blocks in (("exon", exons), ("CDS", cds), ("Selenocysteine", sec)):
            for s, e in blocks:
                gtf.append("\t".join([chrom, "t", kind, str(s), str(e), ".", strand, "0" if kind == "CDS" else ".", a]))

    # plus strand, three exons with 60-base introns, 20 bases before the start and 30 after the stop
    m = filler(20, 1) + nt(PLUS) + filler(30, 2)
    cuts = [0, 80, 140, len(m)]
    seq, pos, ex = filler(100, 3), 101, []
    for i in range(3):
        piece = m[cuts[i] : cuts[i + 1]]
        ex.append((pos, pos + len(piece) - 1))
        seq += piece
        pos += len(piece)
        if i < 2:
            seq += filler(60, 10 + i)
            pos += 60
    contigs["chr1"] = seq + filler(100, 4)
    first, last = 20, 20 + 3 * (len(PLUS) + 1) - 1  # cds in transcript offsets

    def genomic(off):
        for (s, e), a in zip(ex, cuts):
            if off < a + e - s + 1:
                return s + off - a

    cds = [(max(s, genomic(first)), min(e, genomic(last))) for s, e in ex]
    gene("PLUS", "chr1", "+", ex, cds)
    facts["plus"] = {"exons": ex, "genomic": genomic, "cds": cds}

    m = filler(20, 5) + nt(MINUS) + filler(30, 6)
    whole = revcomp(m)
    contigs["chr2"] = filler(50, 7) + whole + filler(50, 8)
    end = 50 + len(m)
    gene("MINUS", "chr2", "-", [(51, end)], [(end - 20 - 3 * (len(MINUS) + 1) + 1, end - 20)])
    facts["minus_end"] = end

    m = filler(9, 9) + nt(SELENO) + filler(12, 12)
    contigs["chr3"] = filler(30, 13) + m + filler(30, 14)
    at = [31 + 9 + 3 * i for i, c in enumerate(SELENO) if c == "U"]
    gene("SELENO", "chr3", "+", [(31, 30 + len(m))], [(40, 39 + 3 * (len(SELENO) + 1))], sec=[(a, a + 2) for a in at])

    m = nt(MITO, True)
    contigs["chrM"] = filler(30, 15) + m + filler(30, 16)
    gene("MITO", "chrM", "+", [(31, 30 + len(m))], [(31, 30 + len(m))])

    (folder / "genome.fa").write_text("".join(f">{c}\n" + "\n".join(s[i : i + 60] for i in range(0, len(s), 60)) + "\n" for c, s in contigs.items()))
    (folder / "genes.gtf").write_text("\n".join(gtf) + "\n")
    facts["contigs"] = contigs
    return facts
