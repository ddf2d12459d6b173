"""The generic queries against their SQL, and the relational operators against
brute force."""

import glob
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from varloom.functions import compare, headers, peptides as P, sequence as S
from varloom.functions.decoys import shuffle_one
from varloom.operators import relational as R
from varloom.plans import generic

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or v != v:
        return None
    return round(v, 6) if isinstance(v, float) else v


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(generic.ORACLE_SQL))
def test_query_equals_sql(spark, oracle, name):
    df = generic.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(x) for x in r) for r in df.select(columns).collect()), key=repr)
    rel = oracle.sql(generic.ORACLE_SQL[name])
    assert sorted(rel.columns) == columns
    order = [rel.columns.index(c) for c in columns]
    theirs = sorted((tuple(plain(r[i]) for i in order) for r in rel.fetchall()), key=repr)
    assert ours == theirs


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_interval_and_overlap_join(spark):
    r = random.Random(1)
    pts = [(i, r.randrange(3), r.randrange(2_000)) for i in range(200)]
    ivs = [(i, r.randrange(3), a, a + r.randrange(400)) for i, a in ((i, r.randrange(2_000)) for i in range(80))]
    p = spark.createDataFrame(pts, "i int, c int, pos bigint")
    v = spark.createDataFrame(ivs, "j int, d int, s bigint, e bigint")
    got = sorted((x["i"], x["j"]) for x in R.interval_join(p, v, "pos", "s", "e", [("c", "d")], width=64).collect())
    assert got == sorted((i, j) for i, c, pos in pts for j, d, s, e in ivs if c == d and s <= pos <= e)
    w = v.select(F.col("j").alias("k"), F.col("d").alias("f"), F.col("s").alias("s2"), F.col("e").alias("e2"))
    got = sorted((x["j"], x["k"]) for x in R.overlap_join(v, w, ("s", "e"), ("s2", "e2"), [("d", "f")], width=64).collect())
    assert got == sorted((a[0], b[0]) for a in ivs for b in ivs if a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3])


def test_interval_pairs_equal_brute_force(spark):
    r = random.Random(3)
    pts = [(i if i % 9 else None, r.choice((0, 1, None)), r.choice((5, 70, 200, -40, None))) for i in range(300)]
    ivs = [(i, r.randrange(2), a, a + r.choice((-1, 0, 3, 150))) for i, a in ((i, r.randrange(-60, 220)) for i in range(60))]
    p = spark.createDataFrame(pts, "i int, c int, pos bigint")
    v = spark.createDataFrame(ivs, "j int, d int, s bigint, e bigint")
    met = R.interval_pairs(p, v, "pos", "s", "e", [("c", "d")], width=64, block=7)
    joined = R.interval_join(p, v, "pos", "s", "e", [("c", "d")], width=64)
    assert met.dtypes == joined.dtypes
    want = [(i, c, pos, j, d, s, e) for i, c, pos in pts for j, d, s, e in ivs if c == d and pos is not None and s <= pos <= e]
    assert sorted(map(str, map(tuple, met.collect()))) == sorted(map(str, want))
    # points without further columns keep their number
    bare = R.interval_pairs(p.drop("i"), v, "pos", "s", "e", [("c", "d")], width=64, block=7)
    assert sorted(map(tuple, bare.collect())) == sorted(x[1:] for x in want)


def test_pairs_of_copies_take_little_space(spark, tmp_path):
    """40 copies of 50 places under 400 intervals each: their pairs are written
    in less than 0.4 bytes each (0.96 by interval_join), wherever the copies stand."""
    spark.range(100_000).selectExpr("id AS p_partkey", "50 AS p_size", "'b' AS p_brand", "'t' AS p_type").write.parquet(f"{tmp_path}/part.parquet")
    inverse = pow(91, -1, 100_000)
    keys = [pos * inverse % 100_000 + 100_000 * i for pos in range(50_200, 51_200, 20) for i in range(40)]
    random.Random(4).shuffle(keys)
    spark.createDataFrame([(k,) for k in keys], "o_orderkey bigint").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    generic.interval_lookup(spark, str(tmp_path)).write.parquet(f"{tmp_path}/out")
    got = spark.read.parquet(f"{tmp_path}/out")
    n = got.count()
    assert n == got.distinct().count() == 40 * 50 * 401
    assert sum(x.stat().st_size for x in (tmp_path / "out").glob("*.parquet")) < 0.4 * n


def test_first_over_equals_brute_force(spark):
    r = random.Random(2)
    pts = [(i // 2, i // 2 % 3, (i // 2 * 7) % 90 - 20) for i in range(300)]  # each point twice
    ivs = [(i, r.randrange(3), a, a + r.choice((-1, 0, 3, 40, 200)), r.choice("xyz")) for i, a in ((i, r.randrange(-60, 80)) for i in range(150))]
    p = spark.createDataFrame(pts, "i int, c int, pos bigint")
    v = spark.createDataFrame(ivs, "j int, d int, s bigint, e bigint, g string")
    got = R.first_over(p, v, "pos", "s", "e", [("c", "d")], "g", [F.col("s") - F.col("e"), F.col("j")], ["j"], levels=4)
    best = {}
    for i, c, pos in pts:
        for j, d, s, e, g in ivs:
            if c == d and s <= pos <= e:
                best[i, g] = min(best.get((i, g), (1, 0)), (s - e, j))
    assert sorted((x["i"], x["g"], x["j"]) for x in got.collect()) == sorted((i, g, j) for (i, g), (_, j) in best.items())


def test_crowded_places_form_no_pairs(spark, tmp_path):
    """2,000 transcripts over 2,000 variants of one place: some rows, not millions."""
    spark.range(2_000).selectExpr("id * 100000 AS p_partkey", "concat('b', id % 2) AS p_brand", "'PROMO' AS p_type", "CAST(40 AS INT) AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(2_000).selectExpr("id * 100000 AS o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    df = generic.QUERIES["representative_pick"](spark, str(tmp_path))
    assert {tuple(x)[1:] for x in df.collect()} == {("b0", 0), ("b1", 100_000)} and df.count() == 4_000
    assert "BroadcastHashJoin" not in plan_of(df) and "tx_offset" not in plan_of(df) and ">= st" not in plan_of(df)


@pytest.mark.parametrize("name", ["event_pairs", "event_ids", "event_junctions", "terminal_event_pairs", "circ_orfs", "combo_translate", "fusion_chimeras", "sec_translate"])
def test_rows_of_a_small_file_stay_off_the_driver(spark, name):
    from varloom.plans import derived  # noqa: F401

    assert "Broadcast" not in plan_of(generic.QUERIES[name](spark, SF))


def test_a_small_file_is_worked_on_by_all_tasks(spark):
    df = generic.QUERIES["translate_orf"](spark, SF)
    assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_dense_numbers_divide_and_median(spark):
    rows = [(random.Random(i).choice("ab"), i) for i in range(101)]
    df = spark.createDataFrame(rows, "k string, v int")
    for r in R.dense_numbers(df, ["k"], ["v"], "n").collect():
        assert r["n"] == 1 + sum(k == r["k"] and v < r["v"] for k, v in rows)
    med = {r["k"]: r["upper_median"] for r in R.upper_median(df, ["k"], "v").collect()}
    for k in "ab":
        own = sorted(v for x, v in rows if x == k)
        assert med[k] == own[len(own) // 2]
    req = spark.createDataFrame([("e1", "x"), ("e1", "y"), ("e2", "z")], "e string, j string")
    seen = spark.createDataFrame([("x",), ("y",), ("y",)], "j string")
    assert [tuple(r) for r in R.divide(req, "e", "j", seen, "j").collect()] == [("e1", 2)]
    whole, parts = spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([(1, "a"), (1, "b"), (3, "a")], "id int, part string")
    assert tuple(R.partition_faults(whole, parts, "id", "part").first()) == (1, 1, 1)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_sequence_functions(spark):
    assert one(spark, S.revcomp(F.lit("ACGTNrya"))) == "tryNACGT"
    t = one(spark, S.translate_orf(F.lit("ATGNNNTGATAAGG"), sec=F.array(F.lit(2))))
    assert (t["protein"], t["stop_found"], t["trailing_partial"], t["ambiguous_codons"], t["selenocysteines"]) == ("MXU", True, 2, 1, 1)
    assert one(spark, S.protein_of(F.lit("ATGTGATAA"), mito=F.lit(True))) == "MW"
    assert one(spark, S.translate_orf(F.lit("")))["protein"] == "" and one(spark, S.protein_of(F.lit("TAAATG"))) == ""
    assert one(spark, S.first_atg_offset(F.lit("ATGTAACCATGGCTGCTTAA"), 3)) == 8
    assert one(spark, S.first_difference(F.lit("abc"), F.lit("abcd"))) == 3 and one(spark, S.first_difference(F.lit("axc"), F.lit("abcd"))) == 1
    assert tuple(one(spark, S.hgvs_change(F.lit("p.Lys509Glu")))) == ("K", 509, "E") and tuple(one(spark, S.hgvs_change(F.lit("K5*")))) == ("K", 5, "*")
    assert one(spark, S.hgvs_change(F.lit("p.K5fs"))) is None
    assert tuple(one(spark, S.peptide_window(F.lit("ABCDEFG"), F.lit(1), 2))) == ("ABCD", 1)
    n = one(spark, S.nmd(F.lit(10), F.array(F.lit(100), F.lit(200), F.lit(50)), F.lit(5), F.lit(0), F.lit(True)))
    assert (n["nmd"], n["distance"]) == ("likely", 290)
    assert one(spark, S.junction_offsets(F.array(F.lit(100), F.lit(200), F.lit(50)))) == [100, 300]
    assert one(spark, S.nmd(F.lit(10), F.array(F.lit(100)), F.lit(5), F.lit(0), F.lit(True)))["reason"] == "single_exon_transcript"
    ex = F.array(F.struct(F.lit(21).alias("s"), F.lit(30).alias("e")), F.struct(F.lit(1).alias("s"), F.lit(10).alias("e")))
    for off in range(20):
        pos = one(spark, S.tx_to_genomic(ex, F.lit("-"), F.lit(off)))
        assert pos == (30 - off if off < 10 else 20 - off) and one(spark, S.genomic_to_tx(ex, F.lit("-"), F.lit(pos))) == off


def test_peptides_and_headers(spark):
    assert one(spark, P.fragments(F.lit("AKPRGK"))) == ["AKPR", "GK"]
    assert sorted(one(spark, P.digest(F.lit("AAKCCRDDK"), 1, 1, 50))) == ["AAK", "AAKCCR", "CCR", "CCRDDK", "DDK"]
    assert one(spark, P.pseudo_reverse_decoy(F.lit("ABKCDREF"))) == "BAKDCRFE"
    assert sorted(one(spark, P.kmers(F.lit("ABAB*A"), 3))) == ["ABA", "BAB"]
    near = P.around(F.lit("A" * 60 + "PEPTIDE" + "C" * 60), F.lit(63))
    assert one(spark, P.spans(near["window"], F.lit("PEPTIDE"), near["at"])) and not one(spark, P.spans(near["window"], F.lit("CCCCCC"), near["at"]))
    d = shuffle_one("ACDEFKGHPILMRNQ")
    assert d != "ACDEFKGHPILMRNQ" and d[5] == "K" and d[8] == "P" and d[12] == "R" and d[-1] == "Q" and sorted(d[:6]) == sorted("ACDEFK") and sorted(shuffle_one("ABCDEFGHK")) == sorted("ABCDEFGHK")
    assert one(spark, headers.sanitised(F.lit(" a b/c "))) == "a_b_c" and one(spark, headers.sanitised(F.lit("//"))) == "NA"
    assert one(spark, headers.wrapped(F.lit("A" * 61))) == "A" * 60 + "\nA"
    assert one(spark, headers.header_map(F.lit("x VT=SNV GN=A VT=MNV"))) == {"VT": "MNV", "GN": "A"}
    u = one(spark, headers.uniprot_fields(F.lit("sp|P1|A_HUMAN Some protein OS=Homo sapiens OX=9606 GN=AB PE=1 SV=2")))
    assert (u["accession"], u["description"], u["os"], u["gn"]) == ("P1", "Some protein", "Homo sapiens", "AB")
    body = "ACDEFGHIKLMNPQRSTVWY" * 3 + "WYVTSRQPNMLKIHGFEDCA"
    assert (lambda c: (c.status, c.identity, c.offset))(compare.compare_pair("GG" + body[:50] + "W" + body[51:], body + "TT")) == ("offset_isoform", 0.9875, -2)
    state = lambda a, b: compare.compare_pair(a, b).status
    assert state("MABC", "ABC") == "identical_after_met_trim" and compare.compare_pair("ABCDEF", "CDE").offset == -2 and state("ABCDEF", "CDE") == "isoform_extension" and state("AAAA", "CCCC") == "divergent"


def test_documents_of_one_file_are_worked_on_by_all_tasks(spark):
    assert generic.entries(spark, SF).rdd.getNumPartitions() >= R.TASKS_A_CORE * spark.sparkContext.defaultParallelism


def test_records_of_outcomes_are_moved_by_gene_and_by_variant_alone(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = plan_of(generic.QUERIES["disposition"](spark, SF))
    finally:
        spark.conf.set(name, old)
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # records twice, genes three times (distinct, by name, to be met), variants and their faults once each
    assert len(moved) <= 7 and plan.count("SortMergeJoin") == 3


def test_kmers_of_each_owner_equal_brute_force(spark):
    """Owners that take turns in a batch, texts shorter than a k-mer and rows without an owner."""
    from varloom.functions import digestion

    rows = [(o, "".join("ACDEKR"[(i * i + j * 7 + j * j) % 6] for j in range(i % 11))) for i, o in enumerate(["a", "b", None, "c", "a"] * 12)] + [("a", None)]
    got = digestion.kmer_items(spark.createDataFrame(rows, "o string, s string").coalesce(1), "s", "o", 3).collect()
    number = lambda m: sum((ord(x) - 64) << 5 * i for i, x in enumerate(reversed(m)))
    want = {(o, number(s[i : i + 3])) for o, s in rows if o and s for i in range(len(s) - 2)}
    assert sorted(map(tuple, got)) == sorted(want)


def test_variants_are_placed_and_read_once(spark):
    """Each work of a variant's row stands once in the plan: a translation of
    either sequence, and the places of both ends with and without an anchor
    (32 and 18 of them before)."""
    from varloom.plans import derived  # noqa: F401

    plan = generic.QUERIES["variant_proteins"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    rows = plan[: plan.index("Join")]
    assert rows.count("regexp_extract_all") == 2 and rows.count("aggregate(exons") <= 8


def test_translation_equals_brute_force(spark):
    r = random.Random(5)
    table = {a + b + c: S.STANDARD_CODE[16 * i + 4 * j + k] for i, a in enumerate(S.BASES) for j, b in enumerate(S.BASES) for k, c in enumerate(S.BASES)}
    mito = {c: S.MITO_CODE[i] for i, c in enumerate(table)}
    rows = [(n, None if n == 0 else "".join(r.choice("ACGTACGTACGTUacgtN.é") for _ in range(r.randrange(40))), n % 3 == 0, None if n % 7 == 1 else [i for i in range(12) if r.random() < 0.3]) for n in range(300)]
    made = S.translate_orf("s", F.col("m"), F.col("sec"))
    got = {x["n"]: x["x"] for x in spark.createDataFrame(rows, "n int, s string, m boolean, sec array<int>").select("n", made.alias("x")).collect()}
    for n, s, m, sec in rows[1:]:
        bases = s.upper().replace("U", "T")
        codons = [bases[i : i + 3] for i in range(0, len(bases) // 3 * 3, 3)]
        aas = "".join("U" if (mito if m else table).get(c) == "*" and c == "TGA" and i in (sec or []) else (mito if m else table).get(c, "X") for i, c in enumerate(codons))
        read = aas.split("*")[0]
        assert tuple(got[n]) == (read, "*" in aas, len(s) % 3, read.count("X"), read.count("U"))
    assert got[0]["protein"] is None


def test_a_sequence_style_variant_is_read_once(spark):
    """Its text is cut once for the rows that meet the genome and once for
    others, after they are dealt (59 times before, and before that too)."""
    from varloom.plans import derived  # noqa: F401

    plan = generic.QUERIES["spdi_variants"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2 and plan.rindex("split(") < plan.rindex("RepartitionByExpression [l_orderkey")
