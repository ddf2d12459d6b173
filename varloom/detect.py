"""What a file is, by its content; and which files a run will use.

Driver-side: a look at the first part of each file, never at its name but for
breaking ties.  Two good candidates for a role are a refusal and not a pick.
"""

from __future__ import annotations

import gzip
import re
import zlib
from dataclasses import dataclass, field
from pathlib import Path

from .sources.evidence import EVENT

HEAD = 256 * 1024
EVIDENCE = ("small_variants", "rna_editing", "fusion", "splicing", "circrna")
REFERENCE = ("genome", "annotation", "proteome", "translations")
CLOSE = 0.05


@dataclass
class Detection:
    path: Path
    role: str
    confidence: float
    why: str
    records: int = 0
    detail: dict = field(default_factory=dict)


def head_of(path: Path, size: int = HEAD) -> bytes:
    raw = path.open("rb").read(size)
    if raw[:2] == b"\x1f\x8b":
        try:
            return zlib.decompressobj(31).decompress(raw, size)
        except zlib.error:
            return b""
    return raw


def detect(path: Path) -> Detection:
    raw = head_of(path)
    made = lambda role, c, why, **d: Detection(path, role, c, why, detail=d)
    if raw[:4] in (b"CSI\x01", b"TBI\x01") or path.suffix in (".tbi", ".csi", ".fai", ".bai"):
        return made("index", 1.0, "index magic or suffix")
    if raw[:4] == b"PK\x03\x04":
        return made("unknown", 1.0, "zip archive")
    text = raw.decode("utf-8", "replace")
    lines = [x for x in text.splitlines() if x.strip()]
    if not lines:
        return made("unknown", 0.0, "empty")
    if lines[0].startswith("##fileformat=VCF"):
        return made("small_variants", 1.0, "VCF header", build=build_of(lines))
    if lines[0].startswith(">") or (lines[0].startswith("#") and any(x.startswith(">") for x in lines[:5])):
        headers = [x for x in lines if x.startswith(">")]
        letters = set("".join(x for x in lines[1:200] if x[0] not in ">#").upper())
        if letters and letters <= set("ACGTUN"):
            return made("genome", 0.95, "nucleotide letters")
        if re.match(r">(sp|tr)\|[^|]+\|\S+", headers[0]):
            return made("proteome", 0.98, "proteome header grammar")
        if re.match(r">\S*(ENSP|ENST)", headers[0]):
            return made("translations", 0.98, "transcript ids in headers")
        return made("proteome", 0.6, "protein letters")
    body = [x for x in lines if not x.startswith("#")]
    if any('transcript_id "' in x for x in body[:50]):
        return made("annotation", 0.97, "transcript_id attributes")
    sep = "\t" if lines[0].count("\t") >= lines[0].count(",") else ","
    columns = [c.strip() for c in lines[0].lstrip("#").split(sep)]
    rows = [x.split(sep) for x in lines[1:41]]
    if any(c.startswith("Func.") for c in columns) and "Chr" in columns:
        at = {c: i for i, c in enumerate(columns)}
        changes = {(r[at["Ref"]], r[at["Alt"]]) for r in rows if "Ref" in at and "Alt" in at and len(r) == len(columns) and r[at["Ref"]] in "ACGT"}
        edits = changes <= {("A", "G"), ("T", "C")}
        return made("rna_editing", 0.98 if edits else 0.75, "annotated variant table")
    circle = re.compile(r"^\w+:\d+[-|]\d+")
    if any(re.fullmatch(r"circ(rna)?(_id)?", c, re.IGNORECASE) for c in columns):
        return made("circrna", 0.97, "circle column")
    if rows and sum(any(circle.match(x) for x in r[:4]) for r in rows) >= max(2, len(rows) // 2) and not any("breakpoint" in c.lower() for c in columns):
        return made("circrna", 0.95, "circle ids")
    if rows and sum(any(re.match(EVENT, x.strip()) for x in r[:4]) for r in rows) >= max(1 if len(rows) < 3 else 2, len(rows) // 2):
        return made("splicing", 0.97, "event ids")
    genes = [c for c in columns if re.match(r"(?i)gene_?[12ab]\b|[53](?:'|_?prime)?[ _.-]?(?:end[ _.-]?)?gene|gene[ _.-]?[53](?:'|_?prime)?$|(?:left|right)[ _.-]?gene", c)]
    points = [i for i in range(len(columns)) if rows and all(re.match(r"^\w+:\d+$", r[i].strip()) for r in rows[:5] if len(r) > i)]
    if len(genes) >= 2 and len(points) >= 2:
        return made("fusion", 0.95, "two genes and two breakpoints")
    cells = [x.split("\t") for x in body if not x.startswith(("track", "browser"))]
    sound = [c for c in cells if len(c) >= 3 and c[1].isdigit() and c[2].isdigit() and int(c[1]) <= int(c[2])]
    # a table may have two whole numbers in a row by chance
    if len(cells) >= 3 and len(sound) >= 0.95 * len(cells):
        return made("regions", 0.9, "intervals")
    return made("unknown", 0.0, "no rule fits")


def build_of(lines: list[str]) -> str | None:
    """The genome build by the length of the first chromosome."""
    # Lengths of the first human chromosome.
    known = {"248956422": "GRCh38", "249250621": "GRCh37"}
    for x in lines:
        m = re.match(r"##contig=<ID=(?:chr)?1,length=(\d+)", x)
        if m:
            return known.get(m[1])
    return None


def count_records(path: Path, most: int = 5_000_000) -> int:
    opener = gzip.open if path.open("rb").read(2) == b"\x1f\x8b" else open
    n = 0
    with opener(path, "rb") as f:
        for line in f:
            n += not line.startswith(b"#")
            if n >= most:
                break
    return n


def detect_folder(folder: str) -> list[Detection]:
    return [detect(p) for p in sorted(Path(folder).iterdir()) if p.is_file() and not p.name.startswith(".")]


def plan(found: list[Detection], explicit: dict[str, str] | None = None) -> dict:
    """The file of each role, alternatives, and what speaks against a run."""
    selected, alternatives, problems = {}, {}, []
    for role in (*EVIDENCE, *REFERENCE):
        if (explicit or {}).get(role) not in (None, "auto"):
            selected[role] = str(explicit[role])
            continue
        group = sorted((d for d in found if d.role == role), key=lambda d: (d.path.suffix == ".gz", -d.confidence, -d.records, d.path.name))
        if not group:
            continue
        stem = lambda d: d.path.name.removesuffix(".gz")
        rivals = [d for d in group[1:] if abs(d.confidence - group[0].confidence) <= CLOSE and stem(d) != stem(group[0])]
        if rivals:
            problems.append(f"{role}: {group[0].path.name} and {rivals[0].path.name} both fit; name one")
        selected[role] = str(group[0].path)
        alternatives[role] = [str(d.path) for d in group[1:]]
    if not set(selected) & set(EVIDENCE):
        problems.append("no evidence input found")
    problems += [f"no {role} found" for role in ("genome", "annotation") if role not in selected]
    builds = {d.detail.get("build") for d in found if d.detail.get("build")}
    if len(builds) > 1:
        problems.append(f"inputs of different builds: {', '.join(sorted(builds))}")
    return {"selected": selected, "alternatives": alternatives, "problems": problems, "evidence_types": [r for r in EVIDENCE if r in selected]}
