"""Detection, configuration and a run from files to a checked release."""

import pytest
from fixture import build

from varloom import cli, config, detect
from varloom.species import species


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    p = tmp_path_factory.mktemp("inputs")
    facts = build(p)
    g = facts["plus"]["genomic"]
    (p / "a.vcf").write_text(f"##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\nchr1\t{g(32)}\t.\tC\tA\t.\tPASS\t.\nchr1\t{g(44)}\t.\tG\tA\t.\tPASS\tAF=0.4\n")
    (x, y), z = facts["plus"]["exons"][:2], facts["plus"]["exons"][2]
    (p / "s.csv").write_text(f"AS,dPSI\nPLUS;SE:chr1:{x[1]}-{y[0]}:{y[1]}-{z[0]}:+,0.3\n")
    (p / "f.csv").write_text(f"Gene1,Gene2,breakpoint1,breakpoint2\nPLUS,MINUS,chr1:{x[1]},chr2:{facts['minus_end'] - 80}\n")
    return p


def test_detect_and_plan(folder):
    roles = {d.path.name: d.role for d in detect.detect_folder(str(folder))}
    assert roles == {"a.vcf": "small_variants", "s.csv": "splicing", "f.csv": "fusion", "genome.fa": "genome", "genes.gtf": "annotation"}
    plan = detect.plan(detect.detect_folder(str(folder)))
    assert plan["problems"] == [] and plan["evidence_types"] == ["small_variants", "fusion", "splicing"]
    (folder / "b.vcf").write_text((folder / "a.vcf").read_text())
    assert any("both fit" in p for p in detect.plan(detect.detect_folder(str(folder)))["problems"])
    (folder / "b.vcf").unlink()
    assert "no genome found" in detect.plan([])["problems"]


def test_config(tmp_path):
    c = config.load(None, {"translate.min_aa": "9", "output.decoys": "reverse"})
    assert c.get("translate", "min_aa") == 9 and c.given == {"translate.min_aa", "output.decoys"}
    (tmp_path / "c.yml").write_text(c.text())
    assert config.load(str(tmp_path / "c.yml")).values == c.values
    for bad in ({"translate.min_a": 1}, {"output.decoys": "x"}, {"validate.min_translation_agreement": 2}, {"nosuch.key": 1}, {"translate.min_aa": "x"}):
        with pytest.raises(config.ConfigError):
            config.load(None, bad)
    assert config.read_plain("a:\n  b: 1 # x\n  c: null\n") == {"a": {"b": "1", "c": None}}
    assert species("mouse").taxon == 10090
    for bad in ({"name": "alien"}, {"name": "human", "nuclear_code": 11}):
        with pytest.raises(ValueError):
            species(bad.pop("name"), **bad)


def test_run(spark, folder, tmp_path):
    c = config.load(None, {"inputs.folder": str(folder), "output.dir": str(tmp_path)})
    from varloom.session import use_checkpoints

    use_checkpoints(spark)
    states = cli.run(c, spark)
    assert not any(v.startswith("FAIL") for v in states.values()), states
    rows = spark.read.option("sep", "\t").option("header", True).csv(f"{tmp_path}/variant_proteome/entries").collect()
    kinds = {r["variant_class"] for r in rows}
    assert {"SNV", "FUSION", "COMBO"} <= kinds
    out = {r["variant_id"]: r["outcome"] for r in spark.read.option("sep", "\t").option("header", True).csv(f"{tmp_path}/variant_proteome_disposition").collect()}
    assert set(out.values()) == {"protein_built"} and len(out) == 4
