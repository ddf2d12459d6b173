"""The commands beside a run, from files to files."""

import json

import pytest
from fixture import build

from varloom import cli, tools
from varloom.plans import events
from varloom.sources import reference


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    p = tmp_path_factory.mktemp("tools")
    build(p)
    return p


def rows(spark, path, sep="\t"):
    return [r.asDict() for r in spark.read.option("sep", sep).option("header", True).csv(str(path)).collect()]


def gtf(chains, strand, gene):
    line = lambda t, s, e: f'chr5\tt\texon\t{s}\t{e}\t.\t{strand}\t.\tgene_id "{gene}"; transcript_id "{gene}{t}"; transcript_type "protein_coding";'
    return [line(t, s, e) for t, chain in enumerate(chains) for s, e in chain]


def test_events_of_every_kind_and_back(spark, folder, monkeypatch, capsys):
    """Ids, by strand, from transcripts; and the junctions that each needs."""
    chains = [[(1, 10), (21, 30), (41, 50), (61, 70)], [(1, 10), (41, 50), (61, 70)], [(1, 10), (21, 34), (41, 50), (61, 70)], [(1, 10), (36, 38), (61, 70)], [(3, 5), (41, 50), (61, 70)], [(1, 10), (21, 70)], [(1, 10), (21, 30), (41, 50), (81, 90)], [(1, 10), (45, 48), (61, 70)]]
    lines = gtf(chains, "+", "P") + gtf(chains, "-", "M") + gtf(chains[:1], "+", "ONE")
    (folder / "e.gtf").write_text("\n".join(lines) + "\n")
    monkeypatch.setattr(cli, "session", lambda: spark)
    assert cli.main(["events", str(folder / "e.gtf"), str(folder / "events")]) == 0
    counts = json.loads(capsys.readouterr().out)
    found = rows(spark, folder / "events")
    ids = {r["event_id"] for r in found}
    assert len(ids) == len(found) == sum(counts.values()) and set(counts) == {"SE", "A3", "A5", "RI", "MX", "AF", "AL"} and not any(r["gene"] == "ONE" for r in found)
    for gene, strand, five, three, first, last in (("P", "+", "A5", "A3", "AF", "AL"), ("M", "-", "A3", "A5", "AL", "AF")):
        assert {
            f"{gene};SE:chr5:10-21:30-41:{strand}", f"{gene};{three}:chr5:10-21:10-41:{strand}", f"{gene};{five}:chr5:34-41:30-41:{strand}", f"{gene};RI:chr5:21:30-41:70:{strand}", f"{gene};MX:chr5:10-36:38-61:10-45:48-61:{strand}",
            f"{gene};{first}:chr5:3:5-41:1:10-41:{strand}", f"{gene};{last}:chr5:50-61:70:50-81:90:{strand}",
        } <= ids
    need = {}
    for r in events.required_junctions(spark.read.option("sep", "\t").option("header", True).csv(str(folder / "events"))).collect():
        need.setdefault(r["event_id"], set()).add(r["junction"])
    assert set(need) == ids
    assert need["P;SE:chr5:10-21:30-41:+"] == {"chr5:10-21", "chr5:30-41", "chr5:10-41"} and need["M;RI:chr5:21:30-41:70:-"] == {"chr5:30-41"}
    assert need["M;AL:chr5:3:5-41:1:10-41:-"] == {"chr5:5-41", "chr5:10-41"}
    have = {f"chr5:{a[1]}-{b[0]}" for chain in chains for a, b in zip(chain, chain[1:], strict=False)}
    assert set().union(*need.values()) <= have
    # two tissues, one of which lacks a junction
    for name, some in (("t1", have), ("t2", have - {"chr5:10-21"})):
        text = "chrom\tstart\tend\n" + "".join(f"{j.split(':')[0]}\t{int(j.split(':')[1].split('-')[0]) + 1}\t{int(j.split('-')[1]) - 1}\n" for j in sorted(some))
        (folder / "junctions").mkdir(exist_ok=True)
        (folder / "junctions" / f"{name}.tsv").write_text(text)
    assert cli.main(["normal-events", str(folder / "events"), str(folder / "junctions"), str(folder / "normal"), "--of", "2"]) == 0
    normal = {r["AS"]: (r["confidence"], r["tissues"]) for r in rows(spark, folder / "normal", ",")}
    assert set(normal) == ids and normal["P;SE:chr5:10-21:30-41:+"] == ("0.5000", "1") and normal["P;RI:chr5:21:30-41:70:+"] == ("1.0000", "2")


def test_convert(spark, folder, monkeypatch, capsys):
    (folder / "u.csv").write_text("CHROM,POS,REF,ALT,detected_tool_count,detected_batch_count\n1,5,A,C,3,1\nchr2,9,g,t,1,1\nchr77,9,A,T,3,1\n1,x,A,T,3,1\n")
    (folder / "f.csv").write_text("gene1,gene2,chrom1,pos1,chrom2,pos2,file_support_count,caller\nA,B,1,5,2,9,1,x\nA,B,chr1,5,chr2,9,3,y\nC,D,1,5,2,9,1,x\n")
    monkeypatch.setattr(cli, "session", lambda: spark)
    assert cli.main(["convert", "small_variants", str(folder / "u.csv"), str(folder / "u"), str(folder / "genome.fa"), "--least", "2"]) == 0
    assert json.loads(capsys.readouterr().out) == {"kept": 1, "contig": 1, "support": 1, "position": 1}
    body = [x for p in sorted((folder / "u" / "kept").glob("part-*")) for x in p.read_text().splitlines() if not x.startswith("#")]
    assert [x.split("\t")[:5] for x in body] == [["chr1", "5", ".", "A", "C"]]
    assert tools.convert(spark, "fusion", str(folder / "f.csv"), str(folder / "f"), str(folder / "genome.fa"), 2, 4) == {"kept": 1}
    assert [(r["Gene1"], r["breakpoint1"], r["confidence"], r["callers"]) for r in rows(spark, folder / "f" / "kept", ",")] == [("A", "chr1:5", "0.7500", "x|y")]
    with pytest.raises(ValueError):
        tools.convert(spark, "other", "x", "y", str(folder / "genome.fa"))


def test_compare_score_and_crosscheck(spark, folder, monkeypatch, capsys):
    (folder / "a.fa").write_text(">x GN=ABC1\nMAAAAAAAAK\n>y GN=DEF2\nMCCCCCCCCK\n")
    (folder / "b.fa").write_text(">x GN=ABC1\nMAAAAAAAAK\n>y GN=DEF2\nMCCCCCCCCR\n")
    monkeypatch.setattr(cli, "session", lambda: spark)
    assert cli.main(["compare", str(folder / "cmp"), f"a={folder / 'a.fa'}", f"b={folder / 'b.fa'}"]) == 0
    assert "# Tool comparison" in capsys.readouterr().out
    assert rows(spark, folder / "cmp" / "disagreeing_genes") == [{"a": "a", "b": "b", "gene": "DEF2"}]
    (folder / "t.tsv").write_text("# a remark\nlocus\tgene\tchange\nchr1:5A>G\tG1\tp.K1E\nchr1:3AT>A\tG2\tp.K2fs\nodd\tG3\tp.K3E\n")
    assert cli.main(["truth-inputs", str(folder / "t.tsv"), str(folder / "inputs")]) == 0
    assert json.loads(capsys.readouterr().out) == {"small_variants": 2, "rna_editing": 1}
    assert rows(spark, folder / "inputs" / "rna_editing")[0]["Start"] == "5"
    release = folder / "release"
    spark.createDataFrame([("d", [("chr1:5A>C", "p.K1E")])], "digest string, variants array<struct<locus:string,protein_change:string>>").write.json(str(release / "provenance"))
    (release / "target").mkdir()
    (release / "target" / "part-0.txt").write_text(">y CHANGE=p.G7S LOC=chr3:7G>A\nAAA\n")
    (folder / "truth.tsv").write_text("# a remark\nlocus\tchange\tcategory\nchr1:5A>C\tp.Lys1Glu\tx\n3:7G>A\tp.G7S\tx\nchr4:1A>C\tp.A1C\ty\n")
    assert cli.main(["score", str(release), str(folder / "truth.tsv"), str(folder / "scored")]) == 0
    assert json.loads(capsys.readouterr().out) == {"x": [2, 2, 1.0, 1.0], "y": [1, 0, 0.0, None], "TOTAL": [3, 2, 2 / 3, 1.0]}
    tools.tsv(spark.createDataFrame([("v1", "T1.2", "missense"), ("v2", "T9", "synonymous"), (None, "T3", "reference")], "variant_id string, transcript string, consequence string"), str(release / "records"))
    (folder / "vep.tsv").write_text("variant_id\ttranscript\tterms\nv1\tT1.1\tmissense_variant&splice_region_variant\nv2\tT7\tstop_gained\n")
    assert cli.main(["crosscheck", str(release), str(folder / "vep.tsv"), str(folder / "checked")]) == 0
    assert json.loads(capsys.readouterr().out) == {"agree": 1, "compared": 2}
    assert reference.truth_table(spark, str(folder / "truth.tsv")).count() == 3
