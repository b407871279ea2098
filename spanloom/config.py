"""Settings of the quotation pipeline; all are literals in the plan."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class NormRules:
    """Which rules of the Arabic profile are on."""

    drop_tatweel: bool = True
    drop_marks: bool = True
    unify_alef: bool = True
    unify_ya: bool = True
    unify_ta_marbuta: bool = True
    unify_hamza: bool = True
    letters_only: bool = True

    def all_on(self) -> bool:
        return all(getattr(self, f.name) for f in fields(self))


# The defaults that results must agree with.
@dataclass(frozen=True)
class Config:
    rules: NormRules = field(default_factory=NormRules)
    bigram_df_cap: int | None = 50
    min_score: float = 78.0
    accept: float = 0.82
    review: float = 0.70
    primary_boost: float = 0.03
    min_standalone: int = 3
    ambiguity_delta: float = 2.0
    ambiguity_penalty: float = 0.12
    same_span: float = 0.6
    max_gap_words: int = 4
    extend_score: float = 72.0
    recover_accept: float = 0.82
    max_chain: int = 12
    max_pops: int | None = 5000
    budget_base: int = 2
    keep_review: bool = True
    keep_repeats: bool = False
    write_text: bool = True
    replace_with: str = "quoted"
    open_mark: str = "﴿ "
    close_mark: str = " ﴾"


# The sections and keys of a settings file, and what they set here.
SECTIONS: dict[str, dict[str, str]] = {
    "normalization": {
        "remove_diacritics": "drop_marks", "remove_tatweel": "drop_tatweel", "normalize_alef": "unify_alef", "normalize_hamza": "unify_hamza",
        "normalize_ta_marbuta": "unify_ta_marbuta", "normalize_alef_maqsura": "unify_ya", "strip_non_arabic": "letters_only",
    },
    "retrieval": {"bigram_df_cap": "bigram_df_cap"},
    "verification": {
        "min_partial_score": "min_score", "accept_threshold": "accept", "review_threshold": "review", "primary_surah_boost": "primary_boost",
        "min_standalone_tokens": "min_standalone", "ambiguity_delta": "ambiguity_delta", "ambiguity_penalty": "ambiguity_penalty",
    },
    "multiverse": {"max_gap_words": "max_gap_words", "extend_threshold": "extend_score", "max_chain": "max_chain"},
    "output": {"write_enriched_text": "write_text", "replace_with": "replace_with", "keep_review_matches": "keep_review", "open_marker": "open_mark", "close_marker": "close_mark"},
}
# Keys of such files that no result depends on.
WITHOUT_EFFECT = {"window_size", "window_step", "bm25_top_k", "min_verse_tokens", "backend", "search_margin_tokens"}


def _read_yaml(path: str | Path) -> dict[str, Any]:
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("a YAML reader is needed for a settings file") from e
    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def _flat(values: dict[str, Any]) -> dict[str, Any]:
    """A sectioned file's values under the names they have here; other keys stay as they are."""
    out: dict[str, Any] = {}
    for key, value in values.items():
        if key == "paths":
            continue
        if key not in SECTIONS:
            out[key] = value
            continue
        for k, v in (value or {}).items():
            if k in WITHOUT_EFFECT:
                continue
            if k not in SECTIONS[key]:
                raise ValueError(f"unknown settings: {key}.{k}")
            if key == "normalization":
                out.setdefault("rules", {})[SECTIONS[key][k]] = v
            else:
                out[SECTIONS[key][k]] = v * 100.0 if k == "extend_threshold" else v
    if out.get("replace_with") == "full_ayah":
        out["replace_with"] = "full"
    return out


def load_config(path: str | Path | None = None, **changes: Any) -> Config:
    """Defaults, then a YAML file (sectioned, or with top-level keys of the names here), then ``changes``."""
    values = (_flat(_read_yaml(path)) if path is not None else {}) | changes
    known = {f.name for f in fields(Config)}
    if wrong := set(values) - known:
        raise ValueError(f"unknown settings: {sorted(wrong)}")
    if isinstance(values.get("rules"), dict):
        values["rules"] = NormRules(**values["rules"])
    return Config(**values)


def load_paths(path: str | Path, root: str | Path = ".") -> dict[str, str]:
    """The paths of a settings file; relative ones are below ``root``, URIs stay as they are."""
    given = _read_yaml(path).get("paths") or {}
    return {k: str(v) if "://" in str(v) else str(Path(root) / v) for k, v in given.items()}
