"""Command line: detect, run and audit."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import functions as F

from . import config as C
from . import detect as D
from . import release, tools
from .functions import sequence as S
from .plans import build as B
from .plans import audits, checks, faults, package, profile, report
from .runlog import RunLog, human_bytes, write_lines
from .session import session, ship, use_checkpoints
from .sources import evidence, reference
from .species import species


class Refused(SystemExit):
    """A run that its settings or inputs don't allow: exit code 2."""

    code_ = 2

    def __init__(self, text: str):
        print(text, file=sys.stderr)
        super().__init__(self.code_)


class Differs(Refused):
    """A run whose proteins differ too much from the references': exit code 3."""

    code_ = 3


def run(cfg: C.RunConfig, spark=None) -> dict[str, str]:
    """The whole conversion; returns the state of each check.

    parse -> translate -> outcomes -> package -> validate -> checks; each step
    is a lazy plan but for the records, which are written because serials need
    them as they are.  A row that can't be read is an error of its own and the
    others are built; a builder that fails ends the run, and its record says so."""
    get = cfg.get
    log = RunLog("run", settings=cfg.values)
    code = get("translate", "genetic_code")
    try:
        organism = species(get("translate", "species"), **({} if code in (None, C.AUTO) else {"nuclear_code": int(code)}))
    except ValueError as e:
        raise Refused(str(e)) from None
    found = D.detect_folder(get("inputs", "folder")) if get("inputs", "folder") else []
    if get("reference", "dir"):
        found += D.detect_folder(get("reference", "dir"))
    explicit = {**{r: get("inputs", r) for r in D.EVIDENCE}, **{r: get("reference", r) for r in D.REFERENCE}}
    plan = D.plan(found, explicit)
    if plan["problems"] and not get("validate", "force"):
        raise Refused("\n".join(plan["problems"]))
    spark = ship(spark or session())
    use_checkpoints(spark)
    chosen = plan["selected"]
    for role, path in chosen.items():
        log.add_input(role, path)
    chosen = {role: evidence.readable(spark, path) for role, path in chosen.items()}
    manifest = evidence.read_manifest(spark, chosen)
    if get("translate", "classes"):
        manifest = manifest.where(F.col("variant_class").isin(get("translate", "classes")))
    if get("translate", "limit"):
        manifest = manifest.orderBy("variant_ord").limit(get("translate", "limit"))
    manifest = manifest.cache()
    transcripts = reference.read_gtf(spark, chosen["annotation"], coding_only=not get("translate", "include_noncanonical")).cache()
    chunks = reference.genome(spark, chosen["genome"])
    sequences = reference.transcript_sequences(transcripts, chunks).cache()
    path = f"{get('output', 'dir')}/{get('output', 'name')}"
    try:
        records, failed = made_records(cfg, manifest, transcripts, sequences, chunks, log)
    except Exception as e:
        log.say(f"a builder failed: {type(e).__name__}: {(str(e).splitlines() or [''])[0]}")
        write_lines(spark, log.record(spark, "error").splitlines(), f"{path}_run")
        raise
    too_many = combined_share(records, get("translate", "max_combined_fraction"))
    if too_many is not None:
        raise Refused(too_many)
    expressed = reference.expressed_genes(spark, get("translate", "expression"), get("translate", "min_expression")) if get("translate", "expression") else None
    kept, outcomes = package.dispositions(manifest, records.where("variant_id IS NOT NULL"), get("translate", "min_aa"), get("translate", "keep_unchanged"), get("translate", "min_af"), expressed, failed)
    small = small_variants_of(manifest)
    outcomes = package.without_protein(outcomes, small, transcripts).cache()
    ordered = package.write_order(package.with_reference(kept.unionByName(records.where("variant_id IS NULL")))).cache()
    proteins = reference.proteome(spark, chosen["proteome"]) if chosen.get("proteome") else None
    known = ordered.where("variant_class = 'REFERENCE'").select("sequence")
    if proteins is not None:
        known = known.union(proteins.select("sequence"))
    entry = package.entries(ordered)
    if get("output", "drop_nmd"):
        # before their peptides are counted
        entry = package.without_decay(entry)
    normal = reference.peptide_list(spark, get("translate", "normal_peptides")) if get("translate", "normal_peptides") else None
    peptides = package.peptide_rows(entry, package.peptide_keys(known), normal).cache()
    entry = package.annotated(entry, peptides, get("output", "drop_non_novel")).cache()
    extra = None
    if proteins is not None and get("output", "append_reference"):
        whole = reference.fasta(spark, chosen["proteome"]).select("header", "sequence").where(F.col("header").rlike("^(sp|tr)\\|"))
        extra = package.appended_reference(entry, whole)
    built = transcripts.join(ordered.where(F.col("consequence").endswith("_annotated_isoform")).select(F.col("transcript").alias("tx_id")).distinct(), "tx_id", "left_semi")
    package.write_release(spark, entry, peptides, ordered, path, get("output", "header_style"), get("output", "decoys"), organism, get("output", "split_by_type"), extra, normal is not None, built, tuple(get("output", "extra_files") or ()))
    outcomes.write.mode("overwrite").option("sep", "\t").option("header", True).csv(f"{path}_disposition")
    tables = validation(spark, manifest, ordered, proteins, chosen)
    for name, table in tables.items():
        package_rows(table).write.mode("overwrite").option("sep", "\t").option("header", True).csv(f"{path}_validation/{name}")
    least = get("validate", "min_translation_agreement")
    if get("output", "reports"):
        for name, lines in (("input", report.quality(manifest)), ("recovery", report.recovered(manifest, outcomes, records, entry)), ("validation", report.validated(tables, least))):
            write_lines(spark, lines, f"{path}_reports/{name}")
    more = {"I2": lambda: checks.i2_disposition(manifest, outcomes), "I7": lambda: checks.i7_unchanged(records)}
    if "translations" in tables:
        more["I6"] = lambda: checks.i6_agreement(tables["translations"], least)
    _, states = release.audit(spark, path, tuple(get("validate", "skip_invariant") or ()), more)
    differs = checks.gate(spark, tables.get("translations"), tables.get("agreement"), least).first()
    for row in outcomes.groupBy("variant_class", "outcome").count().collect():
        log.count(f"outcome.{row['variant_class']}.{row['outcome']}", row["count"])
    log.outputs.append(path)
    status = "error" if differs or any(v.startswith("FAIL") for v in states.values()) else "ok"
    if differs:
        log.say(differs["message"])
    write_lines(spark, log.record(spark, status).splitlines(), f"{path}_run")
    if differs and not get("validate", "force"):
        raise Differs(differs["message"])
    return states


def made_records(cfg: C.RunConfig, manifest, transcripts, sequences, chunks, log: RunLog):
    """(records, failed): each builder's records of the rows without a fault,
    written one builder at a time, and the faults of the others.  Whatever else
    fails ends the run."""
    spark = manifest.sparkSession
    sound, failed = faults.screened(manifest, faults.without_genome(transcripts, chunks))
    sound, failed = sound.cache(), failed.cache()
    made = None
    for kind, build in builders(cfg, sound, transcripts, sequences, chunks):
        done = build().checkpoint()
        log.count(f"records.{kind}", done.count())
        made = done if made is None else made.unionByName(done)
    for row in failed.groupBy("detail").count().collect():  # a row for each kind of fault
        log.count(f"error.{row['detail']}", row["count"])
    return (B.records(spark.createDataFrame([], "variant_id string")) if made is None else made), failed


def combined_share(records, most: float | None) -> str | None:
    """What speaks against the run if combinations are too large a share."""
    if most is None:
        return None
    n = records.agg(F.count("*").alias("all"), F.count_if(F.col("variant_class") == "COMBO").alias("combos")).first()
    share = n["combos"] / n["all"] if n["all"] else 0.0
    return f"combinations are {share:.2%} of the records ({n['combos']} of {n['all']}), more than translate.max_combined_fraction allows ({most:.2%})" if share > most else None


def validation(spark, manifest, ordered, proteins, chosen) -> dict:
    """Tables of what the references allow to compare: residues at edited
    sites, translations, and closest entries."""
    tables = {}
    if proteins is not None:
        edits = manifest.where("edit IS NOT NULL").select("variant_id", F.explode("edit.aachange").alias("x"))
        change = S.hgvs_change(F.col("x.protein"))
        sites = edits.select(F.col("variant_id").alias("site_id"), F.col("x.gene").alias("gene"), change.alias("c")).where("c IS NOT NULL")
        tables["residues"] = checks.residue_check(sites.select("site_id", "gene", F.col("c")["pos"].alias("pos"), F.col("c")["ref"].alias("residue")), proteins)
        own = ordered.where("variant_class = 'REFERENCE' OR consequence LIKE '%annotated_isoform'")
        tables["matches"] = checks.best_match(own, proteins)
        tables["agreement"] = checks.reference_matches(own, tables["matches"])
    if chosen.get("translations"):
        tables["translations"] = checks.translation_agreement(ordered, reference.translations(spark, chosen["translations"]))
    return tables


def package_rows(table):
    """A table's rows with its structs' fields as columns."""
    plain = [F.col(f"{f.name}.*") if f.dataType.typeName() == "struct" else F.col(f.name) for f in table.schema]
    return table.select(*plain)


def small_variants_of(manifest):
    """Small variants and edits in one shape."""
    small = F.coalesce("small", F.when(F.col("edit").isNotNull(), F.struct("edit.chrom", "edit.pos", "edit.ref", "edit.alt", F.lit(None).cast("string").alias("vcf_id"), F.lit(None).cast("string").alias("filter"), F.lit(None).cast("string").alias("info"), F.lit("").alias("phase_set"), F.array().cast("array<int>").alias("haplotypes"), F.lit(None).cast("double").alias("af"))))
    return manifest.withColumn("v", small).where("v IS NOT NULL AND v.ref RLIKE '^[ACGTN]+$' AND v.alt RLIKE '^[ACGTN]+$'").select("variant_id", "variant_class", "source", F.coalesce("genes", F.lit("")).alias("genes"), "confidence", "v.chrom", "v.pos", "v.ref", "v.alt", "v.phase_set", "v.haplotypes")


def builders(cfg: C.RunConfig, manifest, transcripts, sequences, chunks):
    """(kind, how) of each builder that the settings ask for."""
    get = lambda k: cfg.get("translate", k)
    small = small_variants_of(manifest)
    own = lambda kind, *cols: manifest.where(f"{kind} IS NOT NULL").select("variant_id", "source", "confidence", *cols)
    yield "small_variants", lambda: B.small_variants(small, transcripts, sequences, get("transcript_mode"))
    yield "fusions", lambda: B.fusions(own("fusion", "fusion.*"), transcripts, sequences)
    yield "splicing", lambda: B.splicing(own("splice", "splice.*"), transcripts, sequences, get("construct_isoforms"), chunks=chunks)
    yield "circles", lambda: B.circles(own("circle", "circle.*"), transcripts, chunks)
    if get("combine"):
        yield "combinations", lambda: B.combinations(small, transcripts, sequences, get("max_combined"), get("combine_missed_cleavages"), allow_unphased=get("allow_unphased"))
    if get("include_sec_termination"):
        yield "sec_termination", lambda: B.sec_termination(transcripts, sequences, get("min_aa"))
    if get("include_noncanonical"):
        known = transcripts.where("is_coding").join(sequences, "tx_id").select(B.S.protein_of(F.expr("substring(tx_seq, cast(cds_off as int) + 1)")).alias("sequence"))
        yield "noncanonical", lambda: B.noncanonical(transcripts, sequences, known, get("noncanonical_min_aa"), not get("noncanonical_any_start"))


PROFILES = {"small_variants": profile.vcf_profile, "genome": audits.genome_audit, "proteome": audits.proteome_audit, "translations": profile.translation_audit, "annotation": audits.annotation_audit, "regions": profile.region_profile}


def inspect(spark, path: str) -> list[str]:
    """What a file is, and the profile of its content."""
    found = D.detect(Path(path))
    lines = [f"# {found.path.name}", "", f"{found.role} ({found.why}), {human_bytes(found.path.stat().st_size)}"]
    if found.role in PROFILES:
        return lines + report.section("Profile", PROFILES[found.role](spark, path))
    if found.role in ("rna_editing", "fusion", "splicing", "circrna"):
        return lines + report.section("Profile", profile.table_profile(evidence.table(spark, path, evidence.separator(spark, path))))
    return lines


def _beside(args: argparse.Namespace) -> int:
    """The commands beside a run; what they count is printed as JSON."""
    spark = ship(session())
    given = {k: v for k, v in vars(args).items() if v is not None}
    if args.command == "convert":
        found = tools.convert(spark, args.kind, args.source, args.out, args.genome, given.get("least", 1), given.get("of", 0))
    elif args.command == "events":
        found = tools.annotated_events(spark, args.annotation, args.out)
    elif args.command == "normal-events":
        found = tools.seen_in_normal(spark, args.events, args.junctions, args.out, args.of)
    elif args.command == "compare":
        found = tools.compare(spark, dict(x.split("=", 1) for x in args.tools), args.out, given.get("k", 7))
    elif args.command == "score":
        found = tools.score(spark, args.release, args.truth, args.out)
    elif args.command == "truth-inputs":
        found = tools.truth_inputs(spark, args.truth, args.out)
    else:
        found = tools.crosscheck(spark, args.release, args.other, args.out)
    print("\n".join(found) if isinstance(found, list) else json.dumps(found, sort_keys=True))
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="varloom", description="Variants to proteins and peptides on Spark.")
    sub = parser.add_subparsers(dest="command", required=True)
    look = sub.add_parser("detect", help="say what the files of a folder are")
    look.add_argument("folder")
    look.add_argument("--json", action="store_true")
    go = sub.add_parser("run", help="convert a folder")
    go.add_argument("folder", nargs="?")
    go.add_argument("--config")
    go.add_argument("--set", action="append", default=[], metavar="SECTION.KEY=VALUE")
    check = sub.add_parser("audit", help="check a written release")
    check.add_argument("folder")
    check.add_argument("--skip", default="", help="checks to leave out, by comma")
    view = sub.add_parser("inspect", help="profile files")
    view.add_argument("files", nargs="+")
    beside = {
        "convert": ("a union table as the input of a run", ("kind", "source", "out", "genome"), ("least", "of")), "events": ("the alternative events of an annotation", ("annotation", "out"), ()), "normal-events": ("events whose junctions normal tissues show", ("events", "junctions", "out"), ("of",)),
        "compare": ("what the FASTA files of several tools share", ("out", "tools"), ("k",)), "score": ("a release against a truth set", ("release", "truth", "out"), ()), "truth-inputs": ("a truth set as inputs of a run", ("truth", "out"), ()), "crosscheck": ("a release's consequences against another annotator's", ("release", "other", "out"), ()),
    }
    for name, (said, needed, more) in beside.items():
        one = sub.add_parser(name, help=said)
        for word in needed:
            one.add_argument(word, **({"nargs": "+", "metavar": "NAME=FASTA"} if word == "tools" else {}))
        for word in more:
            one.add_argument(f"--{word}", type=int)
    args = parser.parse_args(argv)
    if args.command in beside:
        return _beside(args)
    if args.command == "detect":
        found = D.detect_folder(args.folder)
        plan = D.plan(found)
        rows = [{"file": d.path.name, "role": d.role, "confidence": d.confidence, "why": d.why} for d in found]
        print(json.dumps({"files": rows, **plan}, indent=1) if args.json else "\n".join(f"{r['role']:15} {r['confidence']:.2f} {r['file']} ({r['why']})" for r in rows))
        return int(bool(plan["problems"]))
    if args.command == "audit":
        found, states = release.audit(ship(session()), args.folder, tuple(x for x in args.skip.split(",") if x))
        print("\n".join([*found.problems, *(f"{k} {v}" for k, v in states.items())]))
        return int(bool(found.problems) or any(v.startswith("FAIL") for v in states.values()))
    if args.command == "inspect":
        spark = ship(session())
        print("\n".join(line for f in args.files for line in inspect(spark, f)))
        return 0
    overrides = dict(x.split("=", 1) for x in args.set)
    if args.folder:
        overrides["inputs.folder"] = args.folder
    try:
        states = run(C.load(args.config, overrides))
    except C.ConfigError as e:
        print(e, file=sys.stderr)
        return 2
    print("\n".join(f"{k} {v}" for k, v in states.items()))
    return int(any(v.startswith("FAIL") for v in states.values()))


if __name__ == "__main__":
    sys.exit(main())
