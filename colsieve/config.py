"""Settings: defaults, then a file, then COLSIEVE_* variables, then explicit values."""

from __future__ import annotations

import json
import os
import warnings
from dataclasses import asdict, dataclass, field, fields, is_dataclass, replace
from pathlib import Path

# Accepted spellings of the range modes.


@dataclass(frozen=True)
class IO:
    parquet_glob: str = ""
    output_dir: str = "output"
    descriptor_columns: tuple[str, ...] | None = None
    n_metadata: int = 6


@dataclass(frozen=True)
class Preprocessing:
    primary_id_col: str = "CID"
    smiles_col: str = "SMILES::Absolute"
    inchi_col: str = "InChI::Standard"
    std_core: bool = True
    use_normalizer: bool = False
    use_reionizer: bool = False
    use_metal_disconnector: bool = False
    keep_largest_fragment: bool = False


@dataclass(frozen=True)
class Descriptor:
    descriptor_include: tuple[str, ...] = ()
    descriptor_exclude: tuple[str, ...] = ()
    per_record_timeout_sec: float = 60.0


@dataclass(frozen=True)
class Filtering:
    sample_per_file: int | None = None
    variance_threshold: float = 0.002
    max_missing_ratio: float = 0.5
    min_effective_n: int = 100
    trim_lower: float = 0.025
    trim_upper: float = 0.975
    cdf_points: int = 1000
    quantile_strategy: str = "exact"
    spearman_threshold: float = 0.95
    vif_threshold: float = 10.0
    nonlinear_threshold: float = 0.30
    r: int = 8
    hsic_D: int = 50
    rdc_d: int = 20
    rdc_seeds: int = 10
    w_hsic: float = 0.5
    w_rdc: float = 0.5
    force_recompute: bool = False

    def __post_init__(self):
        for name in ("trim_lower", "trim_upper"):
            value = getattr(self, name)
            if value > 1.0:
                warnings.warn(f"{name}={value} taken as percent", UserWarning, stacklevel=2)
                object.__setattr__(self, name, value / 100.0)
        if not 0.0 <= self.trim_lower < self.trim_upper <= 1.0:
            raise ValueError(f"trim bounds {self.trim_lower}, {self.trim_upper} must rise within [0, 1]")
        for name in ("variance_threshold", "max_missing_ratio"):
            if not 0.0 <= getattr(self, name) <= 1.0:
                raise ValueError(f"{name} must be in [0, 1]")
        if self.w_hsic < 0 or self.w_rdc < 0 or self.w_hsic + self.w_rdc == 0:
            raise ValueError("fusion weights must be non-negative and not both zero")


@dataclass(frozen=True)
class System:
    random_seed: int = 42
    checkpoint: bool = True
    verbose: bool = False


@dataclass(frozen=True)
class Config:
    io: IO = field(default_factory=IO)
    preprocessing: Preprocessing = field(default_factory=Preprocessing)
    descriptor: Descriptor = field(default_factory=Descriptor)
    filtering: Filtering = field(default_factory=Filtering)
    system: System = field(default_factory=System)


PREFIX = "COLSIEVE_"


def unknown_keys(values: dict) -> list[str]:
    """Dotted names in a nested dict that no setting has."""
    known = {f"{s.name}.{f.name}" for s in fields(Config) for f in fields(getattr(Config(), s.name))}
    given = [f"{s}.{k}" for s, inner in values.items() for k in (inner if isinstance(inner, dict) else [""])]
    return sorted(k for k in given if k not in known)


def set_path(config: Config, path: str, value) -> Config:
    """A copy with one dotted setting changed."""
    section, _, name = path.partition(".")
    part = getattr(config, section, None)
    if not is_dataclass(part) or name not in {f.name for f in fields(part)}:
        raise KeyError(f"unknown setting {path!r}")
    if isinstance(value, list):
        value = tuple(value)
    return replace(config, **{section: replace(part, **{name: value})})


def load(path: str | None = None, env: dict | None = None, **overrides) -> Config:
    """Overrides use ``section__name=value``; variables ``COLSIEVE_SECTION__NAME`` (JSON or text)."""
    config = Config()
    if path:
        text = Path(path).read_text(encoding="utf-8")
        if path.endswith((".yml", ".yaml")):
            import yaml

            values = yaml.safe_load(text) or {}
        else:
            values = json.loads(text)
        bad = unknown_keys(values)
        if bad:
            raise KeyError(f"unknown settings in {path}: {', '.join(bad)}")
        for section, inner in values.items():
            for name, value in inner.items():
                config = set_path(config, f"{section}.{name}", value)
    names = {f"{s.name}.{f.name}".lower(): f"{s.name}.{f.name}"
             for s in fields(Config) for f in fields(getattr(Config(), s.name))}
    for key, text in (os.environ if env is None else env).items():
        if key.startswith(PREFIX):
            dotted = key[len(PREFIX):].replace("__", ".", 1).lower()
            try:
                value = json.loads(text)
            except ValueError:
                value = text
            config = set_path(config, names.get(dotted, dotted), value)
    for key, value in overrides.items():
        config = set_path(config, key.replace("__", ".", 1), value)
    return config


def save(config: Config, path: str) -> None:
    values = asdict(config)
    if path.endswith((".yml", ".yaml")):
        import yaml

        values = json.loads(json.dumps(values))
        text = yaml.safe_dump(values, sort_keys=False)
    else:
        text = json.dumps(values, indent=2)
    Path(path).write_text(text, encoding="utf-8")


def difference(a: Config, b: Config) -> dict[str, tuple]:
    """Settings in which two configurations differ."""
    left, right = asdict(a), asdict(b)
    return {
        f"{s}.{k}": (left[s][k], right[s][k])
        for s in left for k in left[s] if left[s][k] != right[s][k]
    }
