"""Settings: frozen dataclasses, deep-merged from dictionaries or YAML-like files."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field
from pathlib import Path

from .operators.parse import FEATURE_SOURCES, check_sources


#: Runs of word characters; words and single marks; the latter with unknown words split.
TOKENIZERS = ("regex", "words", "vocab")


@dataclass(frozen=True)
class Preprocessing:
    strictness: int = 2
    tokenizer: str = "regex"
    preserve_case: bool = False
    remove_punctuation: bool = False
    normalize_unicode: bool = True
    min_token_length: int = 0
    max_token_length: int = 30
    #: Kinds of questions that the question reader takes; all if not given.
    question_types: tuple[str, ...] | None = None
    #: Words taken from each word list.
    vocab_limit: int = 500_000

    def options(self) -> dict:
        return {k: getattr(self, k) for k in ("strictness", "preserve_case", "remove_punctuation", "normalize_unicode")}


@dataclass(frozen=True)
class Parser:
    parsers: tuple[str, ...] = ("rules",)
    sources: dict[str, str] = field(default_factory=lambda: dict(FEATURE_SOURCES))
    min_tokens: int = 3
    max_tokens: int = 50
    min_nodes: int = 3
    max_nodes: int = 50
    max_trees: int = 10


@dataclass(frozen=True)
class Output:
    layout: str = "infonce"
    paired: bool = True
    self_paired: bool = True
    label_map: dict[str, float] | None = None
    normalize: tuple[float, float] | None = None


@dataclass(frozen=True)
class Sharding:
    train: float = 0.8
    dev: float = 0.1
    test: float = 0.1
    seed: int = 42
    shard_size: int = 500
    min_trees: int = 2


@dataclass(frozen=True)
class Config:
    preprocessing: Preprocessing = Preprocessing()
    parser: Parser = Parser()
    output: Output = Output()
    sharding: Sharding = Sharding()

    def __post_init__(self) -> None:
        p, s = self.parser, self.sharding
        check_sources(p.sources, list(p.parsers))
        if self.preprocessing.tokenizer not in TOKENIZERS:
            raise ValueError(f"tokenizer {self.preprocessing.tokenizer!r} is none of {TOKENIZERS}")
        if abs(s.train + s.dev + s.test - 1) > 0.001:
            raise ValueError("the split's shares don't add up to 1")
        if s.shard_size < 1:
            raise ValueError("shard_size must be at least 1")
        if not 0 < p.min_tokens <= p.max_tokens or not 0 < p.min_nodes <= p.max_nodes:
            raise ValueError("bounds of tokens or nodes are out of order")


def deep_merge(base: dict, over: dict) -> dict:
    """``over`` laid over ``base`` at every depth; neither is changed."""
    out = dict(base)
    for k, v in over.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load_config(*overrides: dict | str | Path) -> Config:
    """Defaults, then each override: a dictionary, or the path of a JSON or YAML file. Unknown keys are errors."""
    merged = dataclasses.asdict(Config())
    for over in overrides:
        merged = deep_merge(merged, over if isinstance(over, dict) else _read(Path(over)))
    sections = {f.name: type(f.default) for f in dataclasses.fields(Config)}
    if unknown := set(merged) - set(sections):
        raise ValueError(f"unknown sections: {sorted(unknown)}")
    made = {}
    for name, kind in sections.items():
        given = merged[name]
        if unknown := set(given) - {f.name for f in dataclasses.fields(kind)}:
            raise ValueError(f"unknown settings in {name}: {sorted(unknown)}")
        made[name] = kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})
    return Config(**made)


def _read(path: Path) -> dict:
    text = path.read_text()
    if path.suffix == ".json":
        return json.loads(text)
    import yaml

    return yaml.safe_load(text) or {}
