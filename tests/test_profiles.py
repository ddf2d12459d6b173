from fixture import build
from pyspark.sql import functions as F

from varloom.plans import profile, truth
from varloom.sources import reference


def test_profiles(spark, tmp_path):
    facts = build(tmp_path)
    g = {r["contig"]: r["length"] for r in profile.genome_audit(spark, str(tmp_path / "genome.fa")).collect()}
    assert g == {c: len(s) for c, s in facts["contigs"].items()}
    a = profile.gtf_audit(spark, str(tmp_path / "genes.gtf")).first()
    assert (a["transcripts"], a["coding"], a["n_exon"], a["n_selenocysteine"]) == (4, 4, 6, 2)
    f = profile.fasta_profile(spark, str(tmp_path / "genome.fa")).first()
    assert f["entries"] == 4 and f["not_nucleotide"] == 0 and f["width"] == 60
    (tmp_path / "r.bed").write_text("track x\nchr1\t0\t10\nchr1\t5\t8\nchr2\t1\t21\n")
    assert tuple(profile.region_profile(spark, str(tmp_path / "r.bed")).first()) == (3, 33, 3, 20, 10)
    (tmp_path / "a.vcf").write_text("##fileformat=VCFv4.2\nchr1\t1\t.\tA\tC\t.\tPASS\tDP=3\nchr1\t2\t.\tA\tAC\t.\tPASS\tDP=3;AF=1\n")
    v = {(r["what"], r["key"]): r["n"] for r in profile.vcf_profile(spark, str(tmp_path / "a.vcf")).collect()}
    assert v["chrom", "chr1"] == 2 and v["kind", "indel"] == 1 and v["info", "DP"] == 2 and v["info", "AF"] == 1
    (tmp_path / "p.fa").write_text(">sp|P1|A_HUMAN X OS=H OX=1 GN=AB PE=1 SV=1\nMKU\n>tr|P2|B_HUMAN Y OS=H OX=1 GN=AB PE=1 SV=1\nMK\nLL\n>bad header\nMM\n")
    p = reference.proteome(spark, str(tmp_path / "p.fa"))
    assert p.count() == 2 and [r["gene"] for r in profile.selenoprotein_genes(p).collect()] == ["AB"]
    assert profile.proteome_audit(p).first()["genes_with_several"] == 1


def test_truth_and_tools(spark):
    t = spark.createDataFrame([("chr1:5A>G", "p.Lys5Glu", "missense"), ("chr1:9A>G", "p.(Q9X)", "nonsense"), ("chr2:1A>G", "p.K1fs*3", "fs")], "locus string, change string, category string")
    o = spark.createDataFrame([("1:5A>G", ["p.K5E"]), ("1:9A>G", ["p.Q9*"]), ("2:1A>G", ["p.A1V"])], "locus string, changes array<string>")
    got = {r["category"]: (r["n_found"], r["recall"], r["precision"]) for r in truth.accuracy(truth.score(t, o)).collect()}
    assert got["missense"] == (1, 1.0, 1.0) and got["nonsense"] == (1, 1.0, 1.0) and got["fs"] == (0, 0.0, 0.0) and got["TOTAL"][0] == 2
    e = spark.createDataFrame([("a", "G1", "MKAAAAAAL"), ("b", "G1", "MKAAAAAAL"), ("a", "G2", "MMMMMMMMM"), ("b", "G2", "KKKKKKKKK")], "tool string, gene string, sequence string")
    assert [tuple(r) for r in truth.disagreeing_genes(e, ["a", "b"]).collect()] == [("a", "b", "G2")]
    assert {r["of"]: r["n_both"] for r in truth.tool_pairs(e).collect()} == {"sequences": 1, "kmers": 3}
    assert {r["tool"]: r["sequences"] for r in truth.tool_stats(e).collect()} == {"a": 2, "b": 2}
    s = spark.range(1).select(truth.spdi_fields(F.lit("NC_1:9:A:G")).alias("x"), truth.review_rank(F.lit("reviewed by expert panel")).alias("r")).first()
    assert (s["x"]["pos"], s["x"]["needs_anchor"], s["r"]) == (10, False, 3)
    ev, obs = spark.createDataFrame([("e", "j1"), ("e", "j2"), ("f", "j3")], "event_id string, junction string"), spark.createDataFrame([("j1", 5), ("j2", 2)], "junction string, tissues int")
    assert [tuple(r) for r in truth.normal_events(ev, obs).collect()] == [("e", 2)]
    seq = lambda *s: spark.createDataFrame([(x,) for x in s], "sequence string")
    assert truth.normal_peptides(seq("AAAAAAAK"), seq("AAAAAAAK")).count() == 0
