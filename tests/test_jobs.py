"""The jobs: results, reruns, growing input, and their command lines."""

import json
import random
import re
from collections import defaultdict
from pathlib import Path

import pytest

from jobs import common, normal_background, peptide_library
from varloom.functions import packing

SCHEMA = "doc_id bigint, text string, source string, tissue string, batch int, k string"


def residues(text):
    return re.sub("[^ACDEFGHIKLMNPQRSTVWY]", "", re.sub("[^A-Za-z]", "", text or "").upper())


def peptides(seq, missed=2, least=6, most=50):
    parts = [x for x in re.split("(?<=[KR])(?!P)", seq) if x]
    found = {"".join(parts[i : j + 1]) for i in range(len(parts)) for j in range(i, min(i + missed + 1, len(parts)))}
    return {p for p in found if least <= len(p) <= most}


def fold(p):
    return p.replace("I", "L")


def decoy(p):
    return "".join(x[:-1][::-1] + x[-1] if x[-1] in "KR" else x[::-1] for x in re.split("(?<=[KR])(?!P)", p) if x)


def rows_of(n, start=0):
    words = ["MAGKIL", "SDERPW", "vntag llkSDEYYQR", "AAGVTNK", "I", "L", "PEPTIDEK", "x-9 bjz"]
    return [(start + i, " ".join(words[(i * 7 + j * j + start) % len(words)] for j in range(i % 9)) if i % 13 else None, ["a", "b", None, "", "007"][i % 5] if i % 3 else "hot", "t", i, "k") for i in range(n)]


def background_of(rows):
    found = defaultdict(list)
    for r in rows:
        for k in {fold(p) for p in peptides(residues(r[1]))}:
            found[r[2] or "unnamed", k].append(r[0])
    return {key: (len(ids), min(ids)) for key, ids in found.items()}


def as_background(df):
    return {(r["tissue"], r["k"]): (r["n_samples"], r["first_id"]) for r in df.collect()}


def test_library_equals_brute_force_and_reruns(spark, tmp_path):
    rows = rows_of(120)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/entries")
    spark.createDataFrame([(1, "MAGKLLSDERPW PEPTLDEK"), (2, None)], "item int, text string").write.parquet(f"{tmp_path}/reference")
    known = {fold(p) for p in peptides(residues("MAGKLLSDERPW PEPTLDEK"))}
    want = defaultdict(list)
    for r in rows:
        for p in peptides(residues(r[1])):
            if fold(p) not in known:
                want[fold(p)].append((r[0], p, r[2] or "unnamed"))
    out = f"{tmp_path}/out"
    first = peptide_library.build(spark, f"{tmp_path}/entries", f"{tmp_path}/reference", out)
    assert first["entries"] == 120 and first["reference"] == 2 and first["library"] == len(want) > 20
    for _ in range(2):
        got = {r["k"]: r for r in peptide_library.read(spark, out).collect()}
        assert set(got) == set(want)
        for k, found in want.items():
            entry, peptide, group = min(found)
            n = len({f[0] for f in found})
            assert (got[k]["entry_id"], got[k]["peptide"], got[k]["group"], got[k]["n_entries"], got[k]["proteotypic"], got[k]["decoy"]) == (entry, peptide, group, n, n == 1, decoy(peptide))
        counts = {r["group"]: (r["n_keys"], r["n_proteotypic"]) for r in spark.read.parquet(f"{out}/groups").collect()}
        assert sum(n for n, _ in counts.values()) == len(want) and "unnamed" in counts
        assert peptide_library.build(spark, f"{tmp_path}/entries", f"{tmp_path}/reference", out) == first
    # groups that are gone leave no partition behind
    spark.createDataFrame(rows[:2], SCHEMA).write.mode("overwrite").parquet(f"{tmp_path}/entries")
    peptide_library.build(spark, f"{tmp_path}/entries", f"{tmp_path}/reference", out)
    assert {r["entry_id"] for r in peptide_library.read(spark, out).collect()} <= {0, 1}


def disk_of(spark):
    """Bytes of shuffle files written so far."""
    return spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()


def test_library_in_turns_of_odd_entries(spark):
    """Ids that repeat, are null or text, groups that differ for an id: the same
    rows as by brute force, in several turns and buckets."""
    rows = [(None if i % 7 == 3 else f"e{i % 19}", text, group) for i, text, group, *_ in rows_of(150)]
    known = {fold(p) for p in peptides(residues("MAGKLLSDERPW PEPTLDEK"))}
    want = defaultdict(set)
    for i, text, group in rows:
        for p in peptides(residues(text)):
            if fold(p) not in known:
                want[fold(p)].add((i or "", p, group or "unnamed"))
    entries = spark.createDataFrame(rows, "doc_id string, text string, source string").repartition(3)
    reference = spark.createDataFrame([("MAGKLLSDERPW PEPTLDEK",), (None,)], "text string")
    cfg, cut = peptide_library.Settings(), packing.Cut(buckets=7, passes=3)
    turns = [peptide_library.library(entries, reference, cfg, cut, turn).collect() for turn in range(3)]
    got = {r["k"]: (r["entry_id"] or "", r["peptide"], r["group"], r["n_entries"], r["decoy"]) for turn in turns for r in turn}
    assert sum(map(len, turns)) == len(got) and min(map(len, turns)) > 0
    assert got == {k: (*min(found), len({f[0] for f in found}), decoy(min(found)[1])) for k, found in want.items()}


def test_library_takes_little_disk(spark, tmp_path):
    """Shuffle files under 2.5 bytes and a library under 7 bytes for a letter of
    the entries (32 and 12 when each peptide was moved as a row)."""
    r = random.Random(6)
    words = ["".join(r.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(r.randrange(2, 9))) for _ in range(4000)]
    rows = [(i, " ".join(r.choice(words) for _ in range(400)), f"g{i % 3}") for i in range(600)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(f"{tmp_path}/entries")
    spark.createDataFrame([("MAGK",)], "text string").write.parquet(f"{tmp_path}/reference")
    letters, before = sum(len(residues(t)) for _, t, _ in rows), disk_of(spark)
    done = peptide_library.build(spark, f"{tmp_path}/entries", f"{tmp_path}/reference", f"{tmp_path}/out")
    assert done["library"] == len({fold(p) for _, t, _ in rows for p in peptides(residues(t))})
    moved, kept = disk_of(spark) - before, sum(f.stat().st_size for f in Path(f"{tmp_path}/out/library").rglob("*.parquet"))
    assert (moved / letters < 2.5, kept / letters < 7) == (True, True), (moved / letters, kept / letters)


def test_background_takes_only_what_is_new(spark, tmp_path):
    folder, out = f"{tmp_path}/samples", f"{tmp_path}/out"
    one, two, late = rows_of(60), rows_of(40, 1_000), rows_of(9, -50)
    spark.createDataFrame(one, SCHEMA).repartition(3).write.parquet(folder)
    done = normal_background.update(spark, folder, out)
    assert (done["samples"], done["batches"]) == (60, 1)
    assert as_background(normal_background.read(spark, out)) == background_of(one)
    # nothing new: nothing is read, and all stays
    assert normal_background.update(spark, folder, out) == {"samples": 0, "batches": 0, "background": done["background"]}
    # more files, with smaller ids and known tissues
    spark.createDataFrame(two + late, SCHEMA).repartition(2).write.mode("append").parquet(folder)
    again = normal_background.update(spark, folder, out, normal_background.Settings(files_per_batch=1))
    assert again["samples"] == 49 and again["batches"] >= 2
    want = background_of(one + two + late)
    assert as_background(normal_background.read(spark, out)) == want
    tissues = defaultdict(set)
    for tissue, k in want:
        tissues[k].add(tissue)
    for least in (1, 3):
        keys = {r["k"] for r in normal_background.normal_keys(normal_background.read(spark, out), least).collect()}
        assert keys == {k for k, t in tissues.items() if len(t) >= least}


def test_background_after_a_failed_batch(spark, tmp_path, monkeypatch):
    folder, out = f"{tmp_path}/samples", f"{tmp_path}/out"
    rows = rows_of(50)
    spark.createDataFrame(rows, SCHEMA).write.parquet(folder)
    whole = normal_background.merged

    def failing(parts):
        raise RuntimeError("lost")

    # the parts are written, the background isn't, and the batch is not marked as done
    monkeypatch.setattr(normal_background, "merged", failing)
    with pytest.raises(Exception, match="lost"):
        normal_background.update(spark, folder, out)
    monkeypatch.setattr(normal_background, "merged", whole)
    assert normal_background.update(spark, folder, out)["batches"] == 1
    assert as_background(normal_background.read(spark, out)) == background_of(rows)


def test_jobs_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none")
    assert peptide_library.build(spark, f"{tmp_path}/none", f"{tmp_path}/none", f"{tmp_path}/a")["library"] == 0
    done = normal_background.update(spark, f"{tmp_path}/none", f"{tmp_path}/b")
    assert done["samples"] == 0 and done["background"] == 0


def test_settings_and_command_line(spark, tmp_path, monkeypatch, capsys):
    for name, kind in (("peptide_library", peptide_library.Settings), ("normal_background", normal_background.Settings)):
        text = spark.read.option("wholetext", True).text(str(Path(__file__).resolve().parents[1] / "jobs" / f"{name}.json")).head()[0]
        assert common.settings(kind, text) == kind()
        assert common.settings(kind, None) == kind()
        for bad in ({"nosuch": 1}, {"least_length": "6"}, {"least_length": True}):
            with pytest.raises(ValueError):
                common.settings(kind, json.dumps(bad))
    spark.createDataFrame(rows_of(20), SCHEMA).write.parquet(f"{tmp_path}/samples")
    (tmp_path / "c.json").write_text('{"least_length": 8}')
    # the command line makes and stops a session; here the tests' own serves
    monkeypatch.setattr(common, "session", lambda master: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    work = lambda s, args, cfg: normal_background.update(s, args.samples, args.out, cfg)
    assert common.main("normal_background", normal_background.Settings, work, {"samples": "", "out": ""}, ["--samples", f"{tmp_path}/samples", "--out", f"{tmp_path}/out", "--config", f"{tmp_path}/c.json"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["samples"] == 20
    assert min(len(r["k"]) for r in normal_background.read(spark, f"{tmp_path}/out").collect()) == 8


def test_what_follows_from_a_peptide_is_not_moved(spark):
    df = spark.createDataFrame([(1, "MAGICKPEPTIDER", "s")], "doc_id bigint, text string, source string")
    plan = peptide_library.library(df, df, peptide_library.Settings())._jdf.queryExecution().optimizedPlan().toString()
    assert "decoy" not in plan[plan.index("RebalancePartitions") :]


def test_samples_are_dealt_and_keys_are_moved_once(spark, tmp_path):
    spark.createDataFrame(rows_of(30), SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/samples")
    plan = normal_background.counted(spark.read.parquet(f"{tmp_path}/samples"), normal_background.Settings())._jdf.queryExecution().executedPlan().toString()
    above, below = plan[: plan.index("MapInArrow")], plan[plan.index("MapInArrow") :]
    assert above.count("Exchange hashpartitioning(tissue") == above.count("Exchange ") == 1 and "Exchange RoundRobinPartitioning" in below


def test_only_tissues_of_several_batches_are_summed_again(spark, tmp_path, monkeypatch):
    folder, out = f"{tmp_path}/samples", f"{tmp_path}/out"
    one, two = [r for r in rows_of(40) if r[2] != "hot"], [r for r in rows_of(40, 500) if r[2] in ("hot", "b")]
    summed, whole = [], normal_background.merged
    monkeypatch.setattr(normal_background, "merged", lambda parts: (summed.append({r["tissue"] for r in parts.select("tissue").distinct().collect()}), whole(parts))[1])
    for some in (one, two):
        spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        normal_background.update(spark, folder, out)
    assert summed == [set(), {"b"}] and as_background(normal_background.read(spark, out)) == background_of(one + two)
