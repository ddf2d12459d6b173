"""Genome access, rows with faults, published and constructed cases, VCF with
its header, and what a written release says."""

import random

import pytest
from fixture import CODONS, MINUS, PLUS, build
from pyspark.sql import functions as F

from varloom import cli, config, release, runlog
from varloom.plans import checks, constructed, faults, package, truth
from varloom.sources import evidence, genome, reference


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    p = tmp_path_factory.mktemp("genome")
    found = build(p)
    transcripts = reference.read_gtf(spark, str(p / "genes.gtf")).cache()
    chunks = reference.genome(spark, str(p / "genome.fa")).cache()
    return found | {"folder": p, "transcripts": transcripts, "chunks": chunks, "sequences": reference.transcript_sequences(transcripts, chunks).cache()}


def split_small(spark, size, work):
    """Files are cut into splits of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")
        return work()
    finally:
        for n, x in zip(names, before, strict=True):
            spark.conf.set(n, x)


def test_genome_in_chunks_over_splits(spark, tmp_path):
    r = random.Random(3)
    contigs = {f"c{i}": "".join(r.choice("ACGTNacgt") for _ in range(n)) for i, n in enumerate((0, 1, 59, 60, 61, 500, 3_000, 64, 128, 7))}
    body = "".join(f">{c} text {c}\n" + "".join(s[i : i + 60] + "\n" for i in range(0, len(s), 60)) + ("# a remark\n" if c == "c3" else "") for c, s in contigs.items())
    (tmp_path / "g.fa").write_text("# first\nACGT\n" + body)
    (tmp_path / "crlf.fa").write_bytes(b">x y\r\nAC\r\nGT\r\n>z\r\n")
    for size in (90, 1 << 20):
        for chunk in (64, 1_000):
            rows = split_small(spark, size, lambda: genome.genome_chunks(spark, str(tmp_path / "g.fa"), chunk).collect())  # noqa: B023
            assert max(len(x["seq"]) for x in rows) <= chunk
            got = {}
            for x in sorted(rows, key=lambda x: x["chunk_no"]):
                assert x["chunk_no"] * chunk == len(got.setdefault(x["contig"], ""))
                got[x["contig"]] += x["seq"]
            assert got == {c: s.upper() for c, s in contigs.items() if s}
    assert [tuple(x) for x in genome.genome_chunks(spark, str(tmp_path / "crlf.fa")).collect()] == [("x", 0, "ACGT")]
    chunks = genome.genome_chunks(spark, str(tmp_path / "g.fa"), 64)
    assert {x["contig"]: x["length"] for x in genome.contig_lengths(chunks).collect()} == {c: len(s) for c, s in contigs.items() if s}
    asked = [(i, f"c{r.randrange(11)}", (a := r.randrange(-5, 600)), a + r.randrange(-3, 300)) for i in range(200)]
    got = dict(genome.fetched(spark.createDataFrame(asked, "i int, contig string, start int, end int"), "i", chunks, 64).collect())
    want = {i: "" if a > b else contigs.get(c, "").upper()[max(0, a - 1) : max(0, b)] for i, c, a, b in asked}
    assert got == {i: x for i, x in want.items() if x or asked[i][2] > asked[i][3]}


def test_contig_names(spark):
    contigs = spark.createDataFrame([("chr1",), ("2",), ("chrchr2",), ("MT",), ("chrUn",), ("1",)], "contig string")
    names = spark.createDataFrame([(x,) for x in ("chr1", "1", "chr2", "2", "chrchr2", "M", "chrM", "chrMT", "Un", "x", None)], "chrom string")
    got = dict(genome.resolved(names, "chrom", contigs).collect())
    assert got == {"chr1": "chr1", "1": "1", "chr2": "2", "2": "2", "chrchr2": "chrchr2", "M": "MT", "chrM": "MT", "chrMT": "MT", "Un": "chrUn", "x": None, None: None}


def test_spdi_gets_its_base_from_the_genome(spark, facts):
    seq = facts["contigs"]["chr1"]
    cases = {
        "NC_000001.11:104:A:G": ("chr1", 105, "A", "G"), "NC_000001.11:104:acg:": ("chr1", 104, seq[103] + "ACG", seq[103]), "NC_000001.11:104::TT": ("chr1", 104, seq[103], seq[103] + "TT"), "NC_012920.1:3:A:": ("chrM", 3, facts["contigs"]["chrM"][2] + "A", facts["contigs"]["chrM"][2]),
        "NC_000023.1:5:A:C": ("chrX", 6, "A", "C"), "NC_000001.11:1:A:": ("chr1", 1, seq[0] + "A", seq[0]),
    }
    wrong = {"NC_000001.11:0:A:": "no_base_before", "NC_000001.11:999999:A:": "no_base_before", "NC_000024.1:5:A:": "no_base_before", "NC_000025.1:5:A:C": "unknown_accession", "NT_1:5:A:C": "unknown_accession", "NC_000001.11:x:A:C": "not_readable", "NC_000001.11:5:A": "not_readable", "": "not_readable", None: "not_readable", "NC_000001.11:5:R:C": "not_bases", "NC_000001.11:5::": "no_change", "NC_000001.11:99999999999999999999:A:C": "not_readable"}
    rows = spark.createDataFrame([(x, 1) for x in [*cases, *wrong]], "spdi string, _x int").drop("_x")
    got = {r["spdi"]: r for r in constructed.spdi_to_vcf(rows, "spdi", facts["chunks"]).collect()}
    assert len(got) == len(cases) + len(wrong)
    for s, want in cases.items():
        assert (got[s]["chrom"], got[s]["pos"], got[s]["ref"], got[s]["alt"], got[s]["problem"]) == (*want, None), s
    for s, problem in wrong.items():
        assert (got[s]["problem"], got[s]["pos"], got[s]["alt"]) == (problem, None, None), s


def test_sites_of_published_changes(spark, facts):
    """Five changes on both strands are traced, each to the base that makes it."""
    plus, minus = facts["plus"]["genomic"], facts["minus_end"]
    site = {"PLUS": lambda k: plus(20 + k), "MINUS": lambda k: minus - 20 - k}
    # a lysine (AAA) read as E or R, an asparagine (AAC) as D or S, a tyrosine (TAC) as C
    asked = [("PLUS", "K3E", 0), ("PLUS", f"Y{PLUS.index('Y') + 1}C", 1), ("PLUS", f"p.N{PLUS.index('N') + 1}D", 0), ("MINUS", "K3R", 1), ("MINUS", f"N{MINUS.index('N') + 1}S", 1)]
    wrong = [("PLUS", "W3E", "another_residue"), ("PLUS", "K3W", "no_single_edit"), ("PLUS", "K999E", "beyond_the_end"), ("PLUS", "K0E", "beyond_the_end"), ("NOSUCH", "K3E", "no_coding_transcript"), ("PLUS", "Lys3", "not_readable"), ("PLUS", None, "not_readable"), (None, "K3E", "no_coding_transcript")]
    rows = spark.createDataFrame([(g, c) for g, c, _ in [*asked, *wrong]], "gene string, change string")
    got = {(r["gene"], r["change"]): r for r in constructed.editing_sites(rows, facts["transcripts"], facts["sequences"]).collect()}
    for gene, change, base in asked:
        r = got[gene, change]
        no = int("".join(c for c in change if c.isdigit()))
        assert r["problem"] is None and r["pos"] == site[gene](3 * (no - 1) + base), change
        contig = facts["contigs"][r["chrom"]]
        assert contig[r["pos"] - 1] == r["ref"] == ("A" if gene == "PLUS" else "T") and r["codon"] == CODONS[change.removeprefix("p.")[0]]
    for gene, change, problem in wrong:
        assert got[gene, change]["problem"] == problem and got[gene, change]["pos"] is None


def test_pairs_across_kinds_of_evidence(spark, facts):
    """An edit and a constructed substitution give peptides that neither has
    alone, and the builder of combinations makes the same protein."""
    from varloom.functions import peptides as P
    from varloom.plans import build as B

    site = facts["plus"]["genomic"](20 + 3 * PLUS.index("N") + 1)
    edits = spark.createDataFrame([("e", "chr1", site, "A", "G", "PLUS"), ("deep", "chr1", 5, "A", "G", ""), ("long", "chr1", site, "AC", "G", "PLUS")], "variant_id string, chrom string, pos bigint, ref string, alt string, genes string")
    got = constructed.cross_evidence(edits, facts["transcripts"], facts["sequences"]).collect()
    assert [r["variant_id"] for r in got] == ["e"]
    r = got[0]
    assert r["edited_residue"] == PLUS.index("N") != r["snv_residue"] and r["peptides"] == sorted(r["peptides"], key=lambda p: (len(p), p))
    assert facts["contigs"]["chr1"][r["snv_pos"] - 1] == r["snv_ref"] and constructed.SWAP[r["snv_ref"]] == r["snv_alt"]
    pair = spark.createDataFrame([("e", "chr1", site, "A", "G", "RNA_EDITING"), ("s", "chr1", r["snv_pos"], r["snv_ref"], r["snv_alt"], "SNV")], "variant_id string, chrom string, pos bigint, ref string, alt string, variant_class string").withColumns({"source": F.lit("x"), "phase_set": F.lit(""), "haplotypes": F.array().cast("array<int>")})
    combo = B.combinations(pair, facts["transcripts"], facts["sequences"]).first()
    assert "cross_evidence_RNA_EDITING+SNV" in combo["notes"]
    singles = B.small_variants(pair.withColumns({"genes": F.lit("PLUS"), "confidence": F.lit(None).cast("double")}), facts["transcripts"], facts["sequences"]).collect()
    digest = lambda s: set(spark.range(1).select(P.digest(F.lit(s)).alias("p")).first()["p"])
    alone = set().union(*(digest(x["sequence"]) for x in singles), digest(PLUS))
    assert set(r["peptides"]) <= digest(combo["sequence"]) and not set(r["peptides"]) & alone


def test_vcf_is_written_as_it_was_read(spark, tmp_path):
    head = '##fileformat=VCFv4.2\n##contig=<ID=chr1,length=500>\n##contig=<ID=chr2>\n##INFO=<ID=AF,Number=A,Type=Float,Description="Part, of \\"all\\"">\n##FILTER=<ID=low,Description="">\n##odd\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n'
    body = "".join(f"chr{1 + i % 2}\t{i}\t.\tA\tC\t.\tPASS\tAF=0.{i}\r\n" for i in range(300)) + "\n"
    (tmp_path / "a.vcf").write_bytes((head + body).encode())
    lines = split_small(spark, 200, lambda: evidence.whole_vcf(spark, str(tmp_path / "a.vcf")).cache())
    assert lines.where("header").count() == 7
    evidence.write_vcf(lines, str(tmp_path / "out"))
    assert b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*"))) == (head + body).encode()
    got = {(r["kind"], r["id"]): r for r in evidence.definitions(lines).collect()}
    assert set(got) == {("contig", "chr1"), ("contig", "chr2"), ("INFO", "AF"), ("FILTER", "low")}
    assert got["contig", "chr1"]["length"] == 500 and got["contig", "chr2"]["length"] is None
    assert (got["INFO", "AF"]["number"], got["INFO", "AF"]["type"], got["INFO", "AF"]["description"]) == ("A", "Float", 'Part, of \\"all\\"')


def test_one_bad_row_of_each_kind(spark, facts, tmp_path):
    """Among good rows, each bad one is one error; everything else is built."""
    g = facts["plus"]["genomic"]
    p = tmp_path / "in"
    p.mkdir()
    for name in ("genome.fa", "genes.gtf"):
        (p / name).write_bytes((facts["folder"] / name).read_bytes())
    with (p / "genes.gtf").open("a") as f:
        f.write('chr7\tt\texon\t5\t90\t.\t+\t.\tgene_id "LOST.1"; transcript_id "T_LOST"; gene_name "LOST"; transcript_type "protein_coding";\nchr7\tt\tCDS\t5\t90\t.\t+\t0\tgene_id "LOST.1"; transcript_id "T_LOST"; gene_name "LOST"; transcript_type "protein_coding";\n')
    (x, y), z = facts["plus"]["exons"][:2], facts["plus"]["exons"][2]
    big = 2**63 - 1
    (p / "a.vcf").write_text(f"##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\nchr1\t{g(32)}\t.\tC\tA\t.\tPASS\t.\nchr1\t{big}\t.\tC\tA\t.\tPASS\t.\nchr1\t0\t.\tC\tA\t.\tPASS\t.\nchr1\t{g(33)}\t.\tR\tA\t.\tPASS\t.\nchr7\t20\t.\tA\tC\t.\tPASS\t.\n")
    (p / "s.csv").write_text(f"AS,dPSI\nPLUS;SE:chr1:{x[1]}-{y[0]}:{y[1]}-{z[0]}:+,0.3\nPLUS;SE:chr1:{x[1]}-{big}:{y[1]}-{z[0]}:+,0.3\nPLUS;A3:chr1:1-2-3:4-5:+,0.3\n")
    (p / "f.csv").write_text(f"Gene1,Gene2,breakpoint1,breakpoint2\nPLUS,MINUS,chr1:{x[1]},chr2:{facts['minus_end'] - 80}\nPLUS,MINUS,chr1:99999999999999999999999,chr2:5\n,MINUS,chr1:{x[1]},chr2:70\n")
    cli.run(config.load(None, {"inputs.folder": str(p), "output.dir": str(tmp_path / "out")}), spark)
    rows = {r["variant_id"]: (r["outcome"], r["detail"]) for r in release.table(spark, f"{tmp_path}/out/variant_proteome_disposition").collect()}
    errors = {k: d for k, (o, d) in rows.items() if o == "error"}
    place = "a position is missing or on no contig"
    assert errors == {
        f"chr1:{big}C>A": place, "chr1:0C>A": place, f"chr1:{g(33)}R>A": "alleles are not bases", "chr7:20A>C": "the genome lacks the contig", f"PLUS;SE:chr1:{x[1]}-{big}:{y[1]}-{z[0]}:+": "coordinates of the event are missing or on no contig",
        "PLUS;A3:chr1:1-2-3:4-5:+": "coordinates of the event are missing or on no contig", "PLUS--MINUS::chr1::chr2:5": place, f"MINUS::chr1:{x[1]}::chr2:70": "a partner has no name",
    }
    assert {k for k, (o, _) in rows.items() if o == "protein_built"} >= {f"chr1:{g(32)}C>A"} and len(rows) == 11


def test_screen_of_empty_and_bare_manifests(spark):
    bare = spark.createDataFrame([("a",)], "variant_id string").select("variant_id", *(F.lit(None).cast(t).alias(k) for k, t in evidence.PAYLOADS.items()))
    sound, failed = faults.screened(bare)
    assert sound.count() == 0 and [tuple(r) for r in failed.collect()] == [("a", "no payload")]
    assert all(x.count() == 0 for x in faults.screened(bare.limit(0)))


def test_changes_that_a_release_shows(spark, tmp_path):
    """Provenance first; a header speaks for a locus that the provenance lacks."""
    rows = [("d1", [("chr1:5A>C", "p.K1E"), ("chr1:9A>C", "p.K2E")]), ("d2", [("chr1:5A>C", "p.(Lys1Arg)"), (None, "p.K9E"), ("chr2:1A>C", "")])]
    spark.createDataFrame(rows, "digest string, variants array<struct<locus:string,protein_change:string>>").write.json(f"{tmp_path}/provenance")
    (tmp_path / "target").mkdir()
    (tmp_path / "target" / "part-0.txt").write_text(">x VT=SNV CHANGE=p.W5R LOC=chr1:5A>C\nAAA\n>y VT=SNV CHANGE=p.G7S LOC=chr3:7G>A\nAAA\n>var|S|G_HUMAN G p.A4T OS=Homo sapiens LOC=chr4:4A>T\nAAA\n>z no locus\nAAA\n")
    got = {r["locus"]: r["changes"] for r in reference.observed_changes(spark, f"{tmp_path}/provenance", f"{tmp_path}/target").collect()}
    assert got == {"chr1:5A>C": ["p.(Lys1Arg)", "p.K1E"], "chr1:9A>C": ["p.K2E"], "chr3:7G>A": ["p.G7S"], "chr4:4A>T": ["p.A4T"]}
    assert set(dict(reference.observed_changes(spark, f"{tmp_path}/provenance").collect())) == {"chr1:5A>C", "chr1:9A>C"}
    found = truth.score(spark.createDataFrame([("1:5A>C", "p.Lys1Arg", "x"), ("chr3:7G>A", "G7S", "x"), ("chr4:4A>T", "A4S", "y")], "locus string, change string, category string"), reference.observed_changes(spark, f"{tmp_path}/provenance", f"{tmp_path}/target"))
    assert {r["locus"]: r["found"] for r in found.collect()} == {"1:5A>C": True, "chr3:7G>A": True, "chr4:4A>T": False}


def test_gate(spark):
    same = lambda *x: spark.createDataFrame([(f"t{i}", v) for i, v in enumerate(x)], "tx_id string, same boolean")
    status = lambda *x: spark.createDataFrame([(f"t{i}", v) for i, v in enumerate(x)], "transcript string, status string")
    held = lambda *args: [r["message"] for r in checks.gate(spark, *args).collect()]
    good, bad = status("identical", "offset_isoform"), status("divergent", "no_entry", "identical")
    # the annotation's own translations decide alone, whatever the proteome says
    assert held(same(True, True, True, False), bad, 0.7) == [] and held(same(True, False), good, 0.9) == ["1 of 2 agree with the translations, fewer than 90%"]
    # the proteome decides only where they have nothing to compare
    assert held(same(), bad, 0.9) == ["1 of 3 agree with the proteome entries, fewer than 90%"] and held(None, good, 0.9) == []
    assert held(None, None, 0.9) == [] and held(same(), None, 0.9) == []


def test_a_run_that_differs_too_much_has_its_own_exit_code(spark, facts, tmp_path):
    g = facts["plus"]["genomic"]
    (tmp_path / "a.vcf").write_text(f"##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\nchr1\t{g(32)}\t.\tC\tA\t.\tPASS\t.\n")
    (tmp_path / "t.fa").write_text(f">E|T_PLUS|g\nM{PLUS}\n")
    (tmp_path / "raw.bin").write_bytes(bytes(range(256)) * 9 + b"\r\n\x00no end")
    settings = {"inputs.small_variants": str(tmp_path / "a.vcf"), "reference.genome": str(facts["folder"] / "genome.fa"), "reference.annotation": str(facts["folder"] / "genes.gtf"), "reference.translations": str(tmp_path / "t.fa"), "output.dir": str(tmp_path / "out"), "output.extra_files": str(tmp_path / "raw.bin")}
    with pytest.raises(SystemExit) as stop:
        cli.run(config.load(None, settings), spark)
    assert stop.value.code == 3
    # extra files keep their bytes, and are among the checksums
    path = f"{tmp_path}/out/variant_proteome"
    assert (tmp_path / "out" / "variant_proteome" / "extra" / "raw.bin").read_bytes() == (tmp_path / "raw.bin").read_bytes()
    listed = {r["_c1"]: r["_c0"] for r in spark.read.option("sep", "\t").csv(f"{path}/MANIFEST").collect()}
    assert listed["extra/raw.bin"] == runlog.file_facts(str(tmp_path / "raw.bin"))["sha256"]
    streamed = {r["file"]: r["sha256"] for r in package.checksums(spark, path, most=100).collect()}
    assert streamed == listed


def test_search_space_without_decay(spark):
    entry = spark.createDataFrame([("a", "e1", "SNV", "MAAAAAAK", ["SNV"], "likely"), ("b", "e2", "SNV", "MCCCCCCK", ["SNV"], None), ("c", "e3", "SNV", "MDDDDDDK", ["SNV"], "unlikely")], "digest string, entry_id string, variant_class string, sequence string, classes array<string>, nmd string")
    none = spark.createDataFrame([], "k string")
    fields = ("digest", "entry_id", "classes")
    space = lambda e: {r["class"]: r["n_added"] for r in package.search_space(package.peptide_rows(e, none, fields=fields)).collect()}
    assert space(entry) == {"release": 3, "SNV": 3} and space(package.without_decay(entry)) == {"release": 2, "SNV": 2}


def test_gene_names_keep_their_digits(spark):
    """The place of a name in its list is no letter to trim off it."""
    from varloom.plans import annotate

    rows = spark.createDataFrame([("a", "CD40"), ("b", " IL10 ;B1,C2; NONE"), ("c", None), ("d", "")], "variant_id string, genes string")
    assert sorted(map(tuple, annotate.genes_of(rows).collect())) == [("a", "CD40"), ("b", "B1"), ("b", "C2"), ("b", "IL10")]
    counts = checks.class_counts(rows.withColumns({"variant_class": F.lit("SNV"), "confidence": F.lit(1.0)})).first()
    assert counts["n_genes"] == 5
