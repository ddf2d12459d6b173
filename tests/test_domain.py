"""Sources, annotation and builders on the constructed genome."""

import pytest
from fixture import MINUS, MITO, PLUS, SELENO, build
from pyspark.sql import functions as F

from varloom.session import use_checkpoints
from varloom.plans import annotate, build as B, checks, package
from varloom.sources import evidence, reference


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("genome")
    facts = build(folder)
    tx = reference.read_gtf(spark, str(folder / "genes.gtf")).cache()
    chunks = reference.genome(spark, str(folder / "genome.fa"), chunk=64).cache()
    seqs = reference.transcript_sequences(tx, chunks, chunk=64).cache()
    return {"tx": tx, "chunks": chunks, "seqs": seqs, "facts": facts, "folder": folder}


def variants(spark, rows):
    return spark.createDataFrame([(f"v{i}", *r, "", "SNV", "t", None) for i, r in enumerate(rows)], "variant_id string, chrom string, pos bigint, ref string, alt string, genes string, variant_class string, source string, confidence double")


def call(spark, world, *rows):
    found = B.small_variants(variants(spark, rows), world["tx"], world["seqs"]).collect()
    return {r["variant_id"]: r for r in found}


def test_proteins_by_construction(spark, world):
    t = world["tx"].join(world["seqs"], "tx_id").select("tx_id", B.S.translate_orf(F.expr("substring(tx_seq, cast(cds_off as int) + 1)"), B.is_mito("chrom"), B.S.sec_codons(F.col("exons"), F.col("strand"), F.col("sec_sites"), F.col("cds_off"))).alias("t"))
    got = {r["tx_id"]: r["t"]["protein"] for r in t.collect()}
    assert got == {"T_PLUS": PLUS, "T_MINUS": MINUS, "T_SELENO": SELENO, "T_MITO": MITO}


def test_small_variants(spark, world):
    g = world["facts"]["plus"]["genomic"]
    at = lambda aa: g(20 + 3 * (aa - 1))
    end = world["facts"]["minus_end"]
    minus_at = end - 20 - 3 * 2  # first base of codon 3 (K) on the minus strand
    got = call(
        spark, world,
        ("chr1", at(5), "C", "A"),  # Q5K
        ("chr1", at(7) + 2, "C", "A"),  # Y7*
        ("chr1", at(5) + 1, "AA", "A"),  # frameshift
        ("1", at(10), "GAA", "GAATTT"),  # in-frame insertion, contig without prefix
        ("chr2", minus_at, "T", "C"),  # AAA -> GAA on the minus strand: K3E
        ("chr1", at(3) + 2, "A", "G"),  # AAA -> AAG: synonymous
        ("chr1", g(5), "C", "T") if world["facts"]["contigs"]["chr1"][g(5) - 1] == "C" else ("chr1", g(5), "T", "C"),
    )
    assert got["v0"]["protein_change"] == "p.Q5K" and got["v0"]["consequence"] == "missense"
    assert got["v1"]["protein_change"] == "p.Y7*" and got["v1"]["consequence"] == "stop_gained"
    assert got["v2"]["consequence"] == "frameshift" and got["v2"]["protein_change"].startswith("p.Q5")
    assert got["v3"]["consequence"] == "inframe_insertion" and len(got["v3"]["sequence"]) == len(PLUS) + 1
    assert got["v4"]["protein_change"] == "p.K3E" and got["v4"]["sequence"] == MINUS[:2] + "E" + MINUS[3:]
    assert got["v5"]["consequence"] == "synonymous" and got["v5"]["protein_change"] == "p.(=)"
    assert got["v6"]["consequence"] == "5_prime_UTR" and got["v6"]["sequence"] == PLUS
    assert not any("REF_MISMATCH" in n for r in got.values() for n in r["notes"])


def test_ref_mismatch_is_a_note(spark, world):
    g = world["facts"]["plus"]["genomic"]
    r = call(spark, world, ("chr1", g(32), "G", "A"))["v0"]
    assert any(n.startswith("REF_MISMATCH") for n in r["notes"])


def test_anchor_outside_exon(spark, world):
    s, _ = world["facts"]["plus"]["exons"][1]
    seq = world["facts"]["contigs"]["chr1"]
    got = call(spark, world, ("chr1", s - 1, seq[s - 2 : s + 2], seq[s - 2]))
    assert "vcf_anchor_outside_cds" in got["v0"]["notes"] and got["v0"]["consequence"] == "inframe_deletion"


def test_intronic_gives_nothing(spark, world):
    _, e = world["facts"]["plus"]["exons"][0]
    v = variants(spark, [("chr1", e + 10, "C", "T"), ("chr9", 5, "C", "T")])
    assert B.small_variants(v, world["tx"], world["seqs"]).count() == 0
    outcomes = package.without_protein(v.select("variant_id", "variant_class", F.lit(0).alias("n_proteins"), F.lit("no_protein").alias("outcome"), F.lit("").alias("detail")), v, world["tx"])
    assert {r["variant_id"]: r["outcome"] for r in outcomes.collect()} == {"v0": "not_in_coding_exon", "v1": "no_coding_transcript_at_locus"}


def test_splicing_matches_and_constructs(spark, world):
    (s1, e1), (s2, e2), (s3, e3) = world["facts"]["plus"]["exons"]
    rows = [("known", "SE", [[e1, s2], [e2, s3]]), ("built", "RI", [[s1], [e1 + 1, s2 - 1], [e2]])]
    ev = spark.createDataFrame([(i, i, k, "PLUS.1", "chr1", "+", g, "t", None) for i, k, g in rows], "variant_id string, event_id string, event_type string, gene_id string, chrom string, strand string, groups array<array<bigint>>, source string, confidence double")
    got = {(r["variant_id"], r["consequence"]): r for r in B.splicing(ev, world["tx"], world["seqs"]).collect()}
    assert got["known", "SE_form1_annotated_isoform"]["sequence"] == PLUS
    assert not any(k[0] == "built" for k in got)


EVENT = "variant_id string, event_id string, event_type string, gene_id string, chrom string, strand string, groups array<array<bigint>>, source string, confidence double"


def test_isoform_is_built_where_none_is_annotated(spark, world):
    (s1, e1), (s2, e2), _ = world["facts"]["plus"]["exons"]
    ev = spark.createDataFrame([("ri", "ri", "RI", "PLUS", "chr1", "+", [[s1], [e1 - 3, s2 + 3], [e2]], "t", None)], EVENT)
    chunks = reference.genome(spark, str(world["folder"] / "genome.fa"))
    (r,) = B.splicing(ev, world["tx"], world["seqs"], chunks=chunks).collect()
    assert r["consequence"] == "RI_constructed_isoform" and len(r["sequence"]) == len(PLUS) + 20
    assert r["sequence"].startswith(PLUS[:20]) and r["sequence"].endswith(PLUS[20:])


def test_circle(spark, world):
    s2, e2 = world["facts"]["plus"]["exons"][1]
    c = spark.createDataFrame([("c", "chr1", s2, e2, "+", "PLUS", "t", None), ("none", "chr1", s2 + 1, e2, "+", "PLUS", "t", None)], "variant_id string, chrom string, start bigint, end bigint, strand string, gene string, source string, confidence double")
    chunks = reference.genome(spark, str(world["folder"] / "genome.fa"))
    (r,) = B.circles(c, world["tx"], chunks, require_atg=False).collect()
    assert r["variant_id"] == "c" and r["sequence"] == PLUS[20:40] * 3 and r["protein_change"] == "p.bsj@21"
    assert "crosses_backsplice_junction" in r["notes"] and "translation_cycles_2" in r["notes"]


def test_fusion(spark, world):
    _, e1 = world["facts"]["plus"]["exons"][0]
    pair = spark.createDataFrame([("f", "PLUS", "chr1", e1, "MINUS", "chr2", world["facts"]["minus_end"] - 20 - 60, "t", None)], "variant_id string, gene1 string, chrom1 string, pos1 bigint, gene2 string, chrom2 string, pos2 bigint, source string, confidence double")
    got = {r["gene"]: r for r in B.fusions(pair, world["tx"], world["seqs"]).collect()}
    r = got["PLUS--MINUS"]
    assert r["sequence"] == PLUS[:20] + MINUS[20:] and r["consequence"] == "in_frame_fusion" and r["protein_change"] == "p.junction@21"
    assert "junction_on_codon_boundary" in r["notes"] and "3p_native_frame" in r["notes"]


def test_sec_termination(spark, world):
    (r,) = B.sec_termination(world["tx"], world["seqs"], min_aa=3).collect()
    assert r["sequence"] == SELENO[: SELENO.index("U")]


def test_combinations_and_phase(spark, world):
    g = world["facts"]["plus"]["genomic"]
    schema = "variant_id string, chrom string, pos bigint, ref string, alt string, variant_class string, source string, phase_set string, haplotypes array<int>"
    one, two = ("chr1", g(20 + 12), "C", "A"), ("chr1", g(20 + 24), "G", "A")
    made = lambda *hs: spark.createDataFrame([(f"v{i}", *v, "SNV", "t", "1" if h is not None else "", [h] if h is not None else []) for i, (v, h) in enumerate(zip((one, two), hs))], schema)
    same = B.combinations(made(0, 0), world["tx"], world["seqs"]).collect()
    assert len(same) == 1 and same[0]["protein_change"] == "p.[Q5K;D9N]" and "phased" in same[0]["notes"]
    assert B.combinations(made(0, 1), world["tx"], world["seqs"]).count() == 0
    loose = B.combinations(made(None, None), world["tx"], world["seqs"]).collect()
    assert len(loose) == 1 and loose[0]["protein_change"] == "p.[Q5K(;)D9N]"


def test_frames_beside_coding_regions(spark, world):
    known = spark.createDataFrame([(PLUS,)], "sequence string")
    nc = B.noncanonical(world["tx"], world["seqs"], known, min_aa=3)
    assert all(r["variant_class"] == "NC_UTR" for r in nc.collect())


def test_vcf_scan(spark, tmp_path):
    p = tmp_path / "a.vcf"
    p.write_text("##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS\nchr1\t10\t.\tA\tC,<DEL>,G\t.\tPASS\tDP=3;AF=0.5,0.1\tGT:PS\t0|1:77\nchr1\t11\t.\tA\tT\t.\tLowQ\t.\tGT\t0/1\nchr1\t12\t.\ta\tt\t.\t.\tVAF=x\tGT\t1|1\n")
    rows = {r["variant_id"]: r for r in evidence.read_vcf(spark, str(p)).collect()}
    assert set(rows) == {"chr1:10A>C", "chr1:10A>G", "chr1:12A>T"}
    c, g, t = rows["chr1:10A>C"]["small"], rows["chr1:10A>G"]["small"], rows["chr1:12A>T"]["small"]
    assert (c["af"], c["phase_set"], c["haplotypes"]) == (0.5, "77", [1]) and (g["phase_set"], g["haplotypes"]) == ("", [])
    assert (t["af"], t["phase_set"], t["haplotypes"]) == (None, "*", [0, 1])
    assert evidence.read_vcf(spark, str(p), require_pass=False).count() == 4


def test_other_scans_and_first_wins(spark, tmp_path):
    (tmp_path / "f.csv").write_text("tag,Gene1,Gene2,Type,Validated,confidence,breakpoint1,breakpoint2\na,G1,G2,x,y,0.5,chr1:10,chr2:20\nb,G1,G2,x,y,nan,bad,chr2:20\n")
    (tmp_path / "s.csv").write_text("AS,dPSI,p_val\nG1;SE:chr1:10-20:30-40:+,0.3,nan\nnonsense,1,1\n")
    (tmp_path / "c.csv").write_text("circRNA,gene\nchr1:50-20,G1\n")
    (tmp_path / "e.txt").write_text("Chr\tStart\tEnd\tRef\tAlt\tFunc.refGene\tGene.refGene\tExonicFunc.refGene\tAAChange.refGene\nCHROM\tx\t.\t.\t.\t.\t.\t.\t.\nchr1\t5\t5\tA\tG\texonic\tG1\tnonsynonymous\tG1:T1:exon1:c.A1G:p.K1E\n")
    m = evidence.read_manifest(spark, {"fusion": str(tmp_path / "f.csv"), "splicing": str(tmp_path / "s.csv"), "circrna": str(tmp_path / "c.csv"), "rna_editing": str(tmp_path / "e.txt")})
    rows = {r["variant_class"]: r for r in m.collect()}
    assert set(rows) == {"FUSION", "AS_SE", "CIRCRNA", "RNA_EDITING"}
    assert rows["FUSION"]["confidence"] == 0.5 and rows["AS_SE"]["splice"]["groups"] == [[10, 20], [30, 40]] and rows["AS_SE"]["splice"]["p_val"] is None
    assert (rows["CIRCRNA"]["circle"]["start"], rows["CIRCRNA"]["circle"]["end"]) == (20, 50)
    assert rows["RNA_EDITING"]["edit"]["aachange"][0]["protein"] == "p.K1E"


def test_release_and_checks(spark, world, tmp_path):
    g = world["facts"]["plus"]["genomic"]
    v = variants(spark, [("chr1", g(32), "C", "A"), ("chr1", g(44), "G", "A"), ("chr1", g(28), "A", "G")])
    use_checkpoints(spark)
    made = B.small_variants(v, world["tx"], world["seqs"]).checkpoint()
    manifest = v.select("variant_id", "variant_class", F.struct(F.lit(None).cast("double").alias("af")).alias("small"))
    kept, outcomes = package.dispositions(manifest, made)
    assert {r["variant_id"]: r["outcome"] for r in outcomes.collect()} == {"v0": "protein_built", "v1": "protein_built", "v2": "protein_built"}
    _, strict = package.dispositions(manifest, made, keep_unchanged=False)
    assert {r["variant_id"]: (r["outcome"], r["n_proteins"]) for r in strict.collect()} == {"v0": ("protein_built", 1), "v1": ("protein_built", 1), "v2": ("synonymous_only", 0)}
    ordered = package.write_order(package.with_reference(kept)).cache()
    entry = package.entries(ordered)
    ref = spark.createDataFrame([(PLUS,)], "sequence string").select(F.explode(B.P.digest("sequence")).alias("p")).select(B.P.fold("p").alias("k"))
    peps = package.peptide_rows(entry, ref)
    full = package.annotated(entry, peps).cache()
    assert full.count() == 3 and full.where("n_novel > 0").count() == 2
    row = package.funnel(peps).first()
    assert row["novel_vs_reference"] >= row["not_in_normal_tissue"] >= row["variant_spanning"] >= row["proteotypic"] > 0
    package.write_release(spark, full, peps, ordered, str(tmp_path / "rel"))
    listed = spark.read.option("sep", "\t").csv(str(tmp_path / "rel/MANIFEST")).toDF("sha256", "file", "bytes")
    assert checks.i8_checksums(listed, package.checksums(spark, str(tmp_path / "rel"))).count() == 0
    assert checks.i2_disposition(manifest, outcomes).count() == 0 and checks.i4_unique(full).count() == 0
    faulty = outcomes.where("variant_id <> 'v1'")
    assert [r["check_name"] for r in checks.i2_disposition(manifest, faulty).collect()] == ["I2"]
    assert [r["check_name"] for r in checks.i4_unique(full.union(full)).collect()] == ["I4"]
    both = full.withColumn("is_decoy", F.lit(False)).unionByName(package.decoys(full))
    assert checks.i9_decoys(both).count() == 0 and checks.i9_decoys(both.where("NOT (is_decoy AND n_novel = 0)")).count() == 1
    fasta = reference.fasta(spark, str(tmp_path / "rel/target"))
    assert fasta.count() == 3 and checks.i5_layout(fasta).count() == 0
    states = checks.run_checks({"I4": lambda: checks.i4_unique(full)}, skip=("I5",))
    assert ("I4", "ok", "") in states and ("I5", "skip", "") in states
    with pytest.raises(ValueError):
        checks.run_checks({}, skip=("I99",))


def test_outcomes_follow_the_first_that_holds(spark):
    m = spark.createDataFrame([(i, "SNV", (af,)) for i, af in (("built", None), ("utr", 0.5), ("syn", 0.5), ("both", 0.5), ("short", 0.5), ("silent", 0.5), ("rare", 0.01), ("none", 0.5), ("bad", 0.5), ("mixed", 0.5))], "variant_id string, variant_class string, small struct<af:double>")
    long = "A" * 20
    rows = [("built", long, "missense", "G1.2"), ("built", "AA", "missense", "G1.2"), ("built", long, "synonymous", "G1.2"), ("utr", long, "5_prime_UTR", "G1"), ("utr", long, "3_prime_UTR", "G1"), ("syn", long, "synonymous", "G1"), ("both", long, "synonymous", "G1"), ("both", long, "5_prime_UTR", "G1"), ("short", "AA", "missense", "G1"), ("short", long, "missense", "G9"), ("silent", long, "missense", "G9"), ("rare", long, "missense", "G1"), ("mixed", "AA", "synonymous", "G1"), ("mixed", long, "synonymous", "")]
    records = spark.createDataFrame(rows, "variant_id string, sequence string, consequence string, gene string")
    kept, out = package.dispositions(m, records, 8, False, 0.1, spark.createDataFrame([("G1",)], "gene string"), spark.createDataFrame([("bad", "no position")], "variant_id string, detail string"))
    got = {r["variant_id"]: (r["outcome"], r["n_proteins"], r["detail"]) for r in out.collect()}
    assert got == {
        "built": ("protein_built", 1, "missense;synonymous"), "utr": ("utr_variant", 0, "3_prime_UTR;5_prime_UTR"), "syn": ("synonymous_only", 0, "no residue changes"), "both": ("synonymous_or_utr", 0, "5_prime_UTR;synonymous"), "short": ("below_min_length", 0, "<8 aa"),
        "silent": ("filtered", 0, "missense"), "rare": ("below_min_af", 0, "af=0.01<0.1"), "none": ("no_protein", 0, ""), "bad": ("error", 0, "no position"), "mixed": ("synonymous_only", 0, "no residue changes"),
    }
    assert [r["variant_id"] for r in kept.collect()] == ["built"]


def test_outcomes_of_versions_and_repeated_rows(spark):
    """A gene is expressed under its own version or without one; a variant that is there twice has its records once."""
    m = spark.createDataFrame([(i, "SNV", (af,)) for i, af in (("own", 0.5), ("other", 0.5), ("bare", 0.5), ("twice", 0.5), ("twice", 0.5), ("twice", 0.01))], "variant_id string, variant_class string, small struct<af:double>")
    rows = [(i, "A" * 20, "missense", g) for i, g in (("own", "G1.2"), ("other", "G1.3"), ("bare", "G2.7"), ("twice", "G2"), ("twice", None))]
    kept, out = package.dispositions(m, spark.createDataFrame(rows, "variant_id string, sequence string, consequence string, gene string"), 8, False, 0.1, spark.createDataFrame([("G1.2",), ("G2",), ("G2",), (None,)], "gene string"))
    assert sorted(map(tuple, out.select("variant_id", "outcome", "n_proteins").collect())) == [("bare", "protein_built", 1), ("other", "filtered", 0), ("own", "protein_built", 1), ("twice", "below_min_af", 0), ("twice", "protein_built", 2), ("twice", "protein_built", 2)]


def test_deletions_over_an_exon_end(spark, world):
    (s1, e1), (s2, _), _ = world["facts"]["plus"]["exons"]
    v = variants(spark, [("chr1", e1 - 1, "ACGT", "A"), ("chr1", s2 - 2, "ACG", "A"), ("chr1", e1 + 5, "A", "C")])
    none = v.select("variant_id", "variant_class", F.lit(0).alias("n_proteins"), F.lit("no_protein").alias("outcome"), F.lit("").alias("detail"))
    got = {r["variant_id"]: r["outcome"] for r in package.without_protein(none, v, world["tx"]).collect()}
    assert got == {"v0": "crosses_splice_junction", "v1": "not_in_coding_exon", "v2": "not_in_coding_exon"}


def test_candidates_by_name_and_place(spark, world):
    v = variants(spark, [("chr1", 150, "C", "A")]).withColumn("genes", F.lit("MINUS"))
    assert [r["tx_id"] for r in annotate.candidates(v, world["tx"]).collect()] == ["T_MINUS"]
    v = v.withColumn("genes", F.lit("NOSUCH,."))
    assert [r["tx_id"] for r in annotate.candidates(v, world["tx"]).collect()] == ["T_PLUS"]
