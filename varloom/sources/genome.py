"""A genome as rows of fixed-size chunks, and what is read from it by place.

A FASTA file is read by splits.  A pass over each split gives pieces of
sequence of a chunk's length at most, each with its place after the last header
of its split; a row for each split says which contig a split begins in and how
far; so a piece gets its place in its contig, and pieces are cut and joined to
chunks.  No row holds more than a chunk, or than a line of the file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.relational import merged

#: Bases of a genome chunk.
CHUNK = 1 << 16
# Spellings of the mitochondrial contig.
MITO_NAMES = ("chrM", "MT", "M", "chrMT")


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): lines, with the start of the split they are in; a
    split's lines come in order."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def sequence_pieces(spark: SparkSession, path: str, size: int = CHUNK, upper: bool = True) -> DataFrame:
    """(file, block, seg, header, at, seq): runs of bases under a header.  The
    run before a split's first header is 0 and has no header; ``at`` counts the
    run's bases before the piece.  Lines that begin with # are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: tuple[str, int] | None = None
        seg, header, at = 0, None, 0
        held: list[str] = []
        n_held = 0
        rows: list[tuple] = []

        def flush(all_: bool) -> None:
            nonlocal at, held, n_held
            text = "".join(held)
            end = len(text) if all_ else len(text) // size * size
            rows.extend((*place, seg, header, at + i, text[i : min(i + size, end)]) for i in range(0, end, size))
            if not text and all_ and header is not None and at == 0:
                rows.append((*place, seg, header, 0, ""))
            at += end
            held = [text[end:]] if end < len(text) else []
            n_held = len(text) - end

        def given() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()), strict=True)], ["file", "block", "seg", "header", "at", "seq"])

        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks, lines = batch.column("file"), batch.column("block").to_numpy(), batch.column("value")
            head = pc.starts_with(lines, ">").to_numpy(zero_copy_only=False)
            new = np.zeros(batch.num_rows, bool)
            new[1:] = (blocks[1:] != blocks[:-1]) | pc.not_equal(files.slice(1), files.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            new[0] = place != (files[0].as_py(), int(blocks[0]))
            clean = pc.replace_substring_regex(pc.if_else(pc.starts_with(lines, "#"), "", lines), r"\s", "")
            clean = pc.utf8_upper(clean) if upper else clean
            cuts = np.unique(np.concatenate([[0], np.flatnonzero(head | new), [batch.num_rows]]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if new[a]:
                    if place is not None:
                        flush(True)
                    place, seg, header, at = (files[a].as_py(), int(blocks[a])), 0, None, 0
                if head[a]:
                    flush(True)
                    seg, header, at = seg + 1, lines[a].as_py()[1:].rstrip("\r"), 0
                    a += 1
                body = clean.slice(a, b - a).to_pylist()
                held += body
                n_held += sum(map(len, body))
                if n_held >= size:
                    flush(False)
                if len(rows) * size >= 1 << 24:
                    yield given()
        if place is not None:
            flush(True)
        yield given()

    return placed_lines(spark, path).mapInArrow(run, "file string, block bigint, seg bigint, header string, at bigint, seq string")


def placed_pieces(pieces: DataFrame) -> DataFrame:
    """(file, header, pos, seq): pieces with their 0-based place in their
    contig, whichever split its header is in."""
    runs = pieces.groupBy("file", "block", "seg").agg(F.max("header").alias("header"), F.sum(F.length("seq")).alias("n"))
    last = F.max_by(F.struct("header", "n"), "seg").alias("last")
    split = runs.groupBy("file", "block").agg(F.sum("n").alias("n"), last)
    # a row for each split of a file
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("n").over(before), F.lit(0))
    begun = split.withColumn("total", total).withColumn("begin", F.when(F.col("last.header").isNotNull(), F.col("total") + F.col("n") - F.col("last.n")))
    carried = begun.select("file", "block", F.last("last.header", True).over(before).alias("open"), (F.col("total") - F.last("begin", True).over(before)).alias("done"))
    joined = pieces.where(F.length("seq") > 0).join(carried, ["file", "block"])
    first = F.col("seg") == 0
    return joined.select("file", F.when(first, F.col("open")).otherwise(F.col("header")).alias("header"), (F.col("at") + F.when(first, F.col("done")).otherwise(0)).alias("pos"), "seq").where("header IS NOT NULL")


def genome_chunks(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """(contig, chunk_no, seq): a contig is the first word of its header."""
    pieces = placed_pieces(sequence_pieces(spark, path, chunk)).withColumn("contig", F.substring_index("header", " ", 1))
    last = F.col("pos") + F.length("seq") - 1
    numbered = pieces.select("file", "contig", "pos", "seq", F.explode(F.sequence(F.floor(F.col("pos") / chunk), F.floor(last / chunk))).alias("chunk_no"))
    start = F.greatest(F.col("pos"), F.col("chunk_no") * chunk)
    cut = F.substring("seq", (start - F.col("pos") + 1).cast("int"), (F.lit(chunk) - start % chunk).cast("int"))
    parts = numbered.select("file", "contig", F.col("chunk_no").cast("int").alias("chunk_no"), F.struct(start.alias("at"), cut.alias("seq")).alias("part"))
    whole = parts.groupBy("file", "contig", "chunk_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["seq"]), "").alias("seq"))
    return whole.select("contig", "chunk_no", "seq")


def contig_lengths(chunks: DataFrame) -> DataFrame:
    """(contig, length)."""
    return chunks.groupBy("contig").agg(F.sum(F.length("seq")).alias("length"))


def contig_names(contigs: DataFrame) -> DataFrame:
    """(alias, contig): every spelling that a contig answers to.  Its own name
    comes first, then the name with or without ``chr``, then, for the
    mitochondrial one, its other spellings."""
    c = F.col("contig")
    other = F.when(c.startswith("chr"), F.substring(c, F.lit(4), F.length(c))).otherwise(F.concat(F.lit("chr"), c))
    mito = F.when(c.isin(*MITO_NAMES), F.array(*(F.lit(m) for m in MITO_NAMES))).otherwise(F.array().cast("array<string>"))
    tiers = F.concat(F.array(F.struct(c.alias("alias"), F.lit(1).alias("tier")), F.struct(other.alias("alias"), F.lit(2).alias("tier"))), F.transform(mito, lambda m: F.struct(m.alias("alias"), F.lit(3).alias("tier"))))
    every = contigs.select("contig").distinct().select("contig", F.explode(tiers).alias("t")).select("t.alias", "t.tier", "contig").where("alias <> ''")
    return every.groupBy("alias").agg(F.min(F.struct("tier", "contig")).alias("x")).select("alias", "x.contig")


def resolved(rows: DataFrame, chrom: str, contigs: DataFrame, name: str = "contig") -> DataFrame:
    """The rows with the contig that their name stands for; null for none."""
    names = contig_names(contigs).withColumnsRenamed({"alias": "_alias", "contig": "_contig"})
    return rows.join(names, F.col(chrom) == F.col("_alias"), "left").withColumn(name, F.col("_contig")).drop("_alias", "_contig")


def fetched(ranges: DataFrame, key: str, chunks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(key, bases) of ranges (key, contig, start, end), 1-based and inclusive:
    what the contig has of them.  An empty range has empty bases; a range that
    has nothing in any contig is left out."""
    empty = ranges.where("start > end").select(key, F.lit("").alias("bases"))
    some = ranges.where("start <= end AND end >= 1").withColumn("start", F.greatest(F.lit(1), "start"))
    parts = some.select(key, "contig", "start", "end", F.explode(F.sequence(F.floor((F.col("start") - 1) / chunk).cast("int"), F.floor((F.col("end") - 1) / chunk).cast("int"))).alias("chunk_no"))
    base = F.col("chunk_no").cast("bigint") * chunk
    first, last = F.greatest(F.col("start"), base + 1), F.least(F.col("end"), base + chunk)
    cut = F.substring("seq", (first - base).cast("int"), (last - first + 1).cast("int"))
    pieces = parts.join(merged(chunks), ["contig", "chunk_no"]).select(key, F.struct("chunk_no", cut.alias("seq")).alias("p"))
    return pieces.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["seq"]), "").alias("bases")).where("bases <> ''").unionByName(empty)


def base_at(rows: DataFrame, contig: str, pos: Column, chunks: DataFrame, name: str, chunk: int = CHUNK) -> DataFrame:
    """The rows with the base at a 1-based place; null where there is none."""
    held = chunks.select(F.col("contig").alias("_c"), F.col("chunk_no").alias("_n"), F.col("seq").alias("_s"))
    at = rows.withColumn("_pos", pos)
    joined = at.join(merged(held), (F.col(contig) == F.col("_c")) & (F.floor((F.col("_pos") - 1) / chunk) == F.col("_n")), "left")
    found = F.substring("_s", ((F.col("_pos") - 1) % chunk + 1).cast("int"), F.lit(1))
    return joined.withColumn(name, F.nullif(found, F.lit(""))).drop("_c", "_n", "_s", "_pos")
