"""Run configuration: typed keys with defaults; defaults < file < command line."""

from __future__ import annotations

import difflib
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

try:
    import yaml
except ImportError:  # YAML is optional: the plain form below is read without it
    yaml = None

AUTO = "auto"


@dataclass(frozen=True)
class Key:
    kind: type
    default: Any = None
    choices: tuple = ()


KEYS: dict[str, dict[str, Key]] = {
    "inputs": {k: Key(str) for k in ("folder", "small_variants", "rna_editing", "fusion", "splicing", "circrna")},
    "reference": {k: Key(str) for k in ("dir", "genome", "annotation", "proteome", "translations")},
    "translate": {
        "transcript_mode": Key(str, "all", ("all", "representative")), "keep_unchanged": Key(bool, True), "genetic_code": Key(str, AUTO), "species": Key(str, "human"), "include_noncanonical": Key(bool, False), "noncanonical_min_aa": Key(int, 30), "noncanonical_any_start": Key(bool, False),
        "expression": Key(str), "min_expression": Key(float, 0.0), "include_sec_termination": Key(bool, False), "construct_isoforms": Key(bool, True), "combine": Key(bool, True), "max_combined": Key(int, 8), "combine_missed_cleavages": Key(int, 2), "allow_unphased": Key(bool, True), "min_af": Key(float), "min_aa": Key(int, 8), "classes": Key(list), "limit": Key(int), "max_combined_fraction": Key(float), "normal_peptides": Key(str),
    },
    "output": {"dir": Key(str, "varloom_output"), "name": Key(str, "variant_proteome"), "header_style": Key(str, "uniprot", ("uniprot", "peff", "pvac", "descriptive")), "decoys": Key(str, "pseudo_reverse", ("none", "reverse", "pseudo_reverse", "shuffle")), "split_by_type": Key(bool, True), "append_reference": Key(bool, True), "drop_nmd": Key(bool, False), "drop_non_novel": Key(bool, False), "reports": Key(bool, True), "extra_files": Key(list)},
    "validate": {"min_translation_agreement": Key(float, 0.9), "skip_invariant": Key(list), "force": Key(bool, False)},
}


class ConfigError(ValueError):
    pass


def coerce(name: str, value: Any, key: Key) -> Any:
    if value is None:
        return None
    if key.kind is bool:
        if isinstance(value, bool):
            return value
        text = str(value).lower()
        if text in ("true", "yes", "on", "1", "false", "no", "off", "0"):
            return text in ("true", "yes", "on", "1")
        raise ConfigError(f"{name}: {value!r} is not true or false")
    if key.kind is list:
        return [str(x).strip() for x in (value if isinstance(value, list) else str(value).split(",")) if str(x).strip()]
    try:
        made = key.kind(value)
    except (TypeError, ValueError):
        raise ConfigError(f"{name}: {value!r} is no {key.kind.__name__}") from None
    if key.choices and made not in key.choices:
        raise ConfigError(f"{name}: {made!r} is none of {', '.join(map(str, key.choices))}")
    return made


@dataclass
class RunConfig:
    values: dict[str, dict[str, Any]] = field(default_factory=dict)
    given: set[str] = field(default_factory=set)

    def get(self, section: str, key: str) -> Any:
        return self.values[section][key]

    def text(self) -> str:
        """The configuration in the plain form that ``read_plain`` reads."""
        show = lambda v: "null" if v is None else ",".join(v) if isinstance(v, list) else str(v).lower() if isinstance(v, bool) else str(v)
        return "".join(f"{s}:\n" + "".join(f"  {k}: {show(v)}\n" for k, v in keys.items()) for s, keys in self.values.items())


def read_plain(text: str) -> dict[str, dict[str, Any]]:
    """Two levels of ``key: value``; # starts a comment; other shapes are errors."""
    out: dict[str, dict[str, Any]] = {}
    section = None
    for n, raw in enumerate(text.splitlines(), 1):
        line = raw.split(" #")[0].rstrip()
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        key, colon, value = line.strip().partition(":")
        if not colon:
            raise ConfigError(f"line {n}: no colon in {line.strip()!r}")
        value = value.strip().strip("\"'")
        if not line[0].isspace():
            section = key
            out[section] = {}
            if value:
                raise ConfigError(f"line {n}: {key} is a section and takes no value")
        elif section is None:
            raise ConfigError(f"line {n}: {key} stands in no section")
        else:
            out[section][key] = None if value in ("", "null", "~") else value
    return out


def load(path: str | None = None, overrides: dict[str, Any] | None = None) -> RunConfig:
    """Defaults, then the file, then ``section.key`` overrides.  Unknown names
    are refused with the nearest known one."""
    raw: dict[str, dict[str, Any]] = {}
    if path:
        text = Path(path).read_text()
        raw = (yaml.safe_load(text) or {}) if yaml else read_plain(text)
    for dotted, value in (overrides or {}).items():
        section, _, key = dotted.partition(".")
        if value is not None:
            raw.setdefault(section, {})[key] = value
    config = RunConfig({s: {k: v.default for k, v in keys.items()} for s, keys in KEYS.items()})
    for section, keys in raw.items():
        if section not in KEYS:
            raise ConfigError(f"unknown section {section!r}{_nearest(section, KEYS)}")
        for key, value in (keys or {}).items():
            if key not in KEYS[section]:
                raise ConfigError(f"unknown key {section}.{key}{_nearest(key, KEYS[section])}")
            config.values[section][key] = coerce(f"{section}.{key}", value, KEYS[section][key])
            config.given.add(f"{section}.{key}")
    rate = config.get("validate", "min_translation_agreement")
    if not 0 <= rate <= 1:
        raise ConfigError(f"validate.min_translation_agreement: {rate} is not between 0 and 1")
    return config


def _nearest(name: str, known: dict) -> str:
    close = difflib.get_close_matches(name, known, 1)
    return f" (the nearest is {close[0]})" if close else ""
