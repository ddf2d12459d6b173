"""A run with all references to a release, its reports and its audit; and the
converters, exports and small functions around it."""

import json
import random
import re

import pyarrow as pa
import pytest
from fixture import MINUS, PLUS, build
from pyspark.sql import functions as F

from varloom import cli, config, detect, release, runlog
from varloom.functions import compare, digestion, headers
from varloom.functions import peptides as P
from varloom.functions.frames import with_frames
from varloom.functions.sequence import open_frames
from varloom.operators import relational as R
from varloom.plans import exports, truth
from varloom.sources import reference, union
from varloom.species import KNOWN


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def text(spark, path):
    return [r["value"] for r in spark.read.text(path).collect()]


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    p = tmp_path_factory.mktemp("whole")
    facts = build(p)
    g = facts["plus"]["genomic"]
    (p / "a.vcf").write_text(f"##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\nchr1\t{g(32)}\t.\tC\tA\t.\tPASS\t.\nchr1\t{g(28)}\t.\tA\tG\t.\tPASS\tAF=0.4\nchr1\t{g(44)}\t.\tR\tA\t.\tPASS\t.\nchr9\t5\t.\tA\tC\t.\tPASS\t.\n")
    (p / "e.txt").write_text(f"Chr\tStart\tEnd\tRef\tAlt\tFunc.refGene\tGene.refGene\tExonicFunc.refGene\tAAChange.refGene\nchr1\t{g(26)}\t{g(26)}\tA\tG\texonic\tPLUS\tnonsynonymous\tPLUS:T_PLUS:exon1:c.A7G:p.K3E\n")
    (p / "proteome.fa").write_text(f">sp|P1|PLUS_MOUSE Plus OS=Mus musculus OX=10090 GN=PLUS PE=1 SV=1\n{PLUS}\n>sp|P2|OTHER_MOUSE Other OS=Mus musculus OX=10090 GN=OTHER PE=1 SV=1\nMKAAAAAAAAAAR\n")
    (p / "translations.fa").write_text(f">ENSP1|T_PLUS|g\n{PLUS}\n>ENSP2|T_MINUS|g\n{MINUS}*\n")
    (p / "normal.txt").write_text("# seen in normal tissue\nLDEPQNK\n")
    out = tmp_path_factory.mktemp("out")
    settings = {"inputs.folder": str(p), "reference.translations": str(p / "translations.fa"), "output.dir": str(out), "translate.species": "mouse", "translate.normal_peptides": str(p / "normal.txt"), "translate.keep_unchanged": "false", "inputs.small_variants": str(p / "a.vcf"), "reference.proteome": str(p / "proteome.fa"), "output.header_style": "descriptive"}
    states = cli.run(config.load(None, settings), spark)
    return states, f"{out}/variant_proteome", settings


def test_checks_read_what_was_written(spark, done):
    states, path, _ = done
    assert all(v.startswith("ok") for v in states.values()) and set(states) == {f"I{i}" for i in range(1, 10)}, states
    found, again = release.audit(spark, path.rsplit("/", 1)[0])
    assert found.path.endswith("variant_proteome") and {k for k, v in again.items() if v == "ok"} == {"I1", "I3", "I4", "I5", "I8", "I9"}
    assert release.locate(spark, path + "/nowhere").problems


def test_outcomes_and_tables(spark, done):
    _, path, _ = done
    out = {r["variant_id"]: r["outcome"] for r in release.table(spark, f"{path}_disposition").collect()}
    assert sorted(out.values()) == ["error", "no_coding_transcript_at_locus", "protein_built", "protein_built", "synonymous_only"]
    heads = release.headers(spark, f"{path}/target").collect()
    assert sum(h["entry_id"].startswith("sp|") for h in heads) == 1  # the other has its sequence among the entries
    assert any(" NOVELPEP=" in h["header"] and " NORMPEP=" in h["header"] for h in heads)
    assert release.headers(spark, f"{path}/target_decoy").where("header LIKE 'DECOY\\_%DECOY=1'").count() == len(heads)
    assert release.table(spark, f"{path}/peptide_candidates").count() > 0 and release.table(spark, f"{path}/records").count() >= 3
    assert {r["state"] for r in release.table(spark, f"{path}_validation/residues").collect()} == {"match"}
    assert {r["status"] for r in release.table(spark, f"{path}_validation/matches").collect()} == {"identical"}
    for name, words in (("input", "Variants by class"), ("recovery", "Outcomes by class"), ("validation", "identical")):
        assert any(words in line for line in text(spark, f"{path}_reports/{name}"))
    record = json.loads("\n".join(text(spark, f"{path}_run")))
    assert record["status"] == "ok" and record["inputs"]["genome"]["sha256"] and record["counters"]["records.small_variants"] > 0


def test_audit_finds_faults(spark, done, tmp_path):
    _, path, settings = done
    import shutil

    bad = tmp_path / "bad"
    shutil.copytree(path, bad)
    part = next(p for p in sorted((bad / "target").glob("part-*")) if p.stat().st_size)
    lines = part.read_text().splitlines()
    part.write_text("\n".join([*lines, lines[0], lines[1]]) + "\n")
    _, states = release.audit(spark, str(bad))
    assert states["I4"].startswith("FAIL") and states["I8"].startswith("FAIL") and states["I3"].startswith("FAIL")
    for wrong in ({"translate.species": "alien"}, {"translate.genetic_code": "11"}, {"translate.max_combined_fraction": "-1"}):
        with pytest.raises(SystemExit) as stop:
            cli.run(config.load(None, {**settings, **wrong, "output.dir": str(tmp_path)}), spark)
        assert stop.value.code == 2
    assert cli.inspect(spark, settings["reference.translations"])[0] == "# translations.fa"


def test_a_failing_builder_ends_the_run(spark, done, tmp_path, monkeypatch):
    """Only data of single rows become outcomes: a job that fails fails the run,
    and its record says so."""
    _, _, settings = done

    def broken(*_, **__):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(cli.B, "fusions", broken)
    with pytest.raises(RuntimeError, match="executor lost"):
        cli.run(config.load(None, {**settings, "output.dir": str(tmp_path)}), spark)
    record = json.loads("\n".join(text(spark, f"{tmp_path}/variant_proteome_run")))
    assert record["status"] == "error" and any("executor lost" in x for x in record["log"])
    assert not (tmp_path / "variant_proteome").exists()


def test_header_styles(spark):
    r = {k: F.lit(v) for k, v in {"serial": "SNV_1", "gene": "G", "protein_change": "p.K1E", "transcript": "T", "variant_class": "REFERENCE", "consequence": "x", "locus": "l", "confidence": "", "source": "s"}.items()}
    assert one(spark, headers.uniprot_of(KNOWN["mouse"])(r)) == "ref|SNV_1|G_MOUSE reference protein OS=Mus musculus OX=10090 GN=G TX=T"
    assert headers.peff_file_header(KNOWN["mouse"], 3)[0] == "# PEFF 1.0" and headers.peff_file_header(KNOWN["mouse"], 3)[-1] == "# //"
    for head, gene in (("x GN=ABC1 y", "ABC1"), ("MT.BRCA2.ENST1.missense", "MT"), ("|tp53|EGFR-ALK_x TP53", "TP53"), ("lower 123", "NA")):
        assert one(spark, headers.gene_guess(F.lit(head))) == gene
    assert one(spark, headers.fusion_ends(F.lit("chr1:5G>C"))) is None and tuple(one(spark, headers.fusion_ends(F.lit("chr1:5::chr2:7")))) == ("chr1", 5, "chr2", 7)
    assert "40 kb" in one(spark, headers.one_locus_note(F.lit("chr1:5::chr1:40005"))) and one(spark, headers.one_locus_note(F.lit("chr1:5::chr1:4000500"))) is None


def test_comparison_states():
    assert compare.compare_pair("AAA", "AAA").status == "identical" and compare.compare_pair("", "").status == "identical"
    body = "".join(random.Random(3).choices("ACDEFGHIKLMNPQRSTVWY", k=300))
    moved = compare.compare_pair("GGGG" + body[:150] + "W" + body[151:290], body)
    assert (moved.status, moved.offset) == ("offset_isoform", -4) and moved.first_diff in (1, 155)
    near = compare.compare_pair(body[:10] + ("W" if body[10] != "W" else "Y") + body[11:], body)
    assert near.status in ("offset_isoform", "near_identical") and near.n_diff == 1 and near.first_diff == 11
    assert compare.compare_pair(body, body[::-1]).status == "divergent"
    assert compare.shared_offset(*(__import__("numpy").frombuffer(b"ABABABABABABABAB", "u1") for _ in range(2)), 12) is None


def test_digestion_against_brute_force(spark):
    r = random.Random(2)
    seqs = ["".join(r.choice("AKRPAKR*MQ") for _ in range(r.randrange(0, 80))) for _ in range(150)] + ["", "*", None, "KKKK", "A" * 120]
    rows = [(i, s, r.randrange(1, 60) if i % 5 else None) for i, s in enumerate(seqs)]
    df = spark.createDataFrame(rows, "id int, s string, at int")
    got = {}
    for x in digestion.digested(df, "s", ["id"], 2, 2, 12, "at").collect():
        assert got.setdefault(x["id"], {}).setdefault(x["peptide"], x["spanning"]) == x["spanning"]
    for i, s, at in rows:
        s = (s or "").replace("*", "")
        f = [y for y in re.split(r"(?<=[KR])(?!P)", s) if y]
        want = {w for w in ("".join(f[a : a + m + 1]) for m in range(3) for a in range(len(f) - m)) if 2 <= len(w) <= 12}
        covers = lambda w: at is None or any(s[k : k + len(w)] == w for k in range(max(0, at - len(w)), at))  # noqa: B023, E731
        assert got.get(i, {}) == {w: covers(w) for w in want}
    sizes = {x["id"]: (x["n_peptides"], x["longest"]) for x in digestion.digest_sizes(df, "s", ["id"], 2, 2, 12).collect()}
    assert sizes == {i: (len(v), max(map(len, v))) for i, v in got.items()}
    mers = digestion.kmer_items(df.withColumn("s", F.coalesce("s", F.lit(""))), "s", "id", 3).distinct().groupBy("id").count().collect()
    for x in mers:
        s = (seqs[x["id"]] or "").replace("*", "")
        assert x["count"] == len({s[k : k + 3] for k in range(len(s) - 2)})
    assert digestion.Sequences(pa.array([], pa.string())).peptides(1, 1, 9)[0].size == 0
    assert [tuple(x) for x in one(spark, P.peptide_spans(F.lit("AAKCCRDDK"), 1, 1, 50))] == [(0, 3), (3, 6), (6, 9), (0, 6), (3, 9)]
    assert tuple(one(spark, P.peptide_bounds(F.lit("AAKCCRDDK"), F.lit(4), 1, 1, 50))) == (0, 6) and one(spark, P.peptide_bounds(F.lit("AAK"), F.lit(9), 1, 1, 50)) is None


def test_frames_equal_the_expression(spark):
    r = random.Random(4)
    rows = [(i, "".join(r.choice("ACGTUNacg") for _ in range(r.randrange(0, 300)))) for i in range(180)] + [(999, None)]
    df = spark.createDataFrame(rows, "i int, nt string")
    for atg in (True, False):
        made = with_frames(df, "nt", "f", 3, atg).select("i", "f", open_frames(F.coalesce("nt", F.lit("")), 3, atg).alias("g")).collect()
        assert all(x["f"] == x["g"] for x in made) and sum(len(x["f"]) for x in made) > 100


def test_dense_numbers_over_many_partitions(spark):
    rows = [(None if i % 11 == 0 else "one key" if i % 3 else f"k{i % 7}", i) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = R.dense_numbers(df, ["k"], ["v"], "n").collect()
        every = R.dense_numbers(df, [], ["v"], "n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(x["n"] == 1 + sum(k == x["k"] and v < x["v"] for k, v in rows) for x in got) and len(got) == 800
    assert all(x["n"] == x["v"] + 1 for x in every)


def test_union_tables(spark, tmp_path):
    known = ["chr1", "chr2", "chrM", "GL000194.1"]
    for name, want in (("1", "chr1"), ("chr2", "chr2"), ("MT", "chrM"), ("chr14_GL000194v1_random", "GL000194.1"), ("chr77", None)):
        assert one(spark, union.in_reference(F.lit(name), known)) == want
    (tmp_path / "s.csv").write_text("CHROM,POS,REF,ALT,detected_tool_count,detected_batch_count,Mutect2_file_count,Strelka2_file_count\n2,7,a,c,3,2,1,2\n1,9,A,G,2.0,1,0,0\n1,5,AT,A,2,1,1,\nchr88,5,A,G,9,9,1,1\n1,x,A,G,9,9,1,1\n1,6,A,G,1,1,1,1\n1,8,,G,2,2,1,1\n")
    rows = union.small_variants(spark, str(tmp_path / "s.csv"), known, 2, 1)
    assert {r["fate"]: r["n"] for r in union.fates(rows).collect()} == {"kept": 3, "contig": 1, "position": 1, "support": 1, "allele": 1}
    lines = [r["value"] for r in union.vcf_lines(rows).collect()]
    assert [x.split("\t")[:2] for x in lines[2:]] == [["chr1", "5"], ["chr1", "9"], ["chr2", "7"]] and lines[4].endswith("CALLERS=Mutect2|Strelka2") and "CALLERS=." in lines[3]
    (tmp_path / "e.tsv").write_text("CHROM\tPOS\tedit_type\tfile_support_count\tbatch_support_count\n1\t5\ta>g\t2\t1\n1\t6\tC>T\t2\t1\n1\t7\tT>C\t0\t1\n")
    assert {r["fate"]: r["n"] for r in union.fates(union.editing(spark, str(tmp_path / "e.tsv"), known)).collect()} == {"kept": 1, "other_change": 1, "support": 1}
    (tmp_path / "f.csv").write_text("gene1,gene2,chrom1,pos1,chrom2,pos2,file_support_count,caller\nA,B,1,5,2,9,3,y\nA,B,chr1,5,2,9,4,x\n")
    (f,) = union.fusions(spark, str(tmp_path / "f.csv"), known, 1, 8).collect()
    assert (f["breakpoint1"], f["confidence"], f["callers"]) == ("chr1:5", "0.5000", "x|y")
    assert one(spark, union.share_text(F.lit(1), F.lit(0))) == ""
    (tmp_path / "a.csv").write_text("AS,dPSI,file_support_count\nG;SE:chr1:1-2:3-4:+,0.2,3\nG;SE:chr1:1-2:3-4:+,-0.5,2\n")
    assert [(r["files"], r["dPSI"]) for r in union.splicing(spark, str(tmp_path / "a.csv"), 1, 4).collect()] == [(3, -0.5)]


def test_exports_and_crosscheck(spark):
    t = spark.createDataFrame([("chr1:5A>G", "G1", "p.K1E"), ("chr1:3T>C", "G2", "p.A2V"), ("x", "G3", "p.A1V")], "locus string, gene string, change string")
    assert [x["value"].split("\t")[1] for x in exports.truth_vcf(t).collect() if not x["value"].startswith("#")] == ["3", "5"]
    assert exports.truth_edits(t).count() == 2
    assert [x["value"] for x in exports.truth_lines(t.limit(1), ["a"]).collect()] == ["# a", "locus\tgene\tchange", "chr1:5A>G\tG1\tp.K1E"]
    p = spark.createDataFrame([("B",), ("A",), ("B",)], "p string")
    assert [x["value"] for x in exports.peptide_list(p).collect()] == ["A", "B"]
    e = spark.createDataFrame([("e", 2)], "event_id string, tissues int")
    assert [x["confidence"] for x in exports.normal_event_table(e, 8).collect()] == ["0.2500"] and [x["confidence"] for x in exports.normal_event_table(e, None).collect()] == [""]
    ours = spark.createDataFrame([("v", "T1.2", "missense"), ("w", "T9", "synonymous")], "variant_id string, transcript string, consequence string")
    theirs = spark.createDataFrame([("v", "T1.3", ["missense_variant", "splice_region_variant"]), ("v", "T2", ["stop_gained"]), ("w", "T2", ["synonymous_variant", "intron_variant"])], "variant_id string, transcript string, terms array<string>")
    assert {r["variant_id"]: (r["how"], r["agrees"]) for r in truth.consequence_crosscheck(ours, theirs).collect()} == {"v": ("shared_transcript", True), "w": ("most_severe", True)}
    listed = spark.createDataFrame([("e1", "1", "5A>G;7C>T"), ("e2", "chr1", "5A>G;bad")], "id string, chromosome string, DNA_change string")
    assert truth.combined_entries(truth.listed_changes(listed, "id", "chromosome", "DNA_change")).first()["n_combined"] == 1


def test_detection_by_content(tmp_path):
    for name, body, role in (("two.txt", "a\t1\t2\n", "unknown"), ("r.bed", "track x\nchr1\t0\t10\nchr1\t5\t8\nchr2\t1\t21\n", "regions"), ("f.tsv", "5'gene\t3'gene\tleft\tright\nA\tB\tchr1:5\tchr2:6\n", "fusion")):
        (tmp_path / name).write_text(body)
        assert detect.detect(tmp_path / name).role == role, name


def test_the_entry_imports_without_the_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    for keep_pipeline in (True, False):
        own = tmp_path / str(keep_pipeline)
        shutil.copytree(root / "varloom", own / "varloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        for name in ("__spark_entry__.py", *(["corpus_pipeline.py"] if keep_pipeline else [])):
            shutil.copy(root / name, own / name)
        code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(n.startswith('op1') for n in q); assert set(e.oracle_sql()) <= set(q)"
        subprocess.run([sys.executable, "-c", code], cwd=own, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(own), "HOME": str(tmp_path)}, timeout=120)
    assert reference is not None
