"""Record text to numeric features: a registry of expressions, and a guarded row function."""

from __future__ import annotations

import signal
import threading
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colsieve.functions.text import final_status, finite, with_inchi_prefix
from colsieve.sources.tables import METADATA

Feature = Callable[[Column], Column]


def _count(pattern: str) -> Feature:
    return lambda c: F.regexp_count(c, F.lit(pattern)).cast("double")


# Features of a plain text; they stand in where no structure toolkit is installed.
TEXT_FEATURES: dict[str, Feature] = {
    "n_chars": lambda c: F.length(c).cast("double"),
    "n_words": _count(r"[^ \t\r\n]+"),
    "n_digits": _count("[0-9]"),
    "n_upper": _count("[A-Z]"),
    "n_lines": lambda c: (F.regexp_count(c, F.lit("\n")) + 1).cast("double"),
    "upper_ratio": lambda c: F.try_divide(
        F.regexp_count(c, F.lit("[A-Z]")).cast("double"), F.length(c).cast("double")
    ),
}

# Counts that can be read from a SMILES string without building the molecule.
_ATOM = r"\[[^\]]*\]|Br|Cl|[BCNOPSFIbcnops]"
SMILES_FEATURES: dict[str, Feature] = {
    "HeavyAtomCount": lambda c: (
        F.regexp_count(c, F.lit(_ATOM)) - F.regexp_count(c, F.lit(r"\[[0-9]*H[+-]?\]"))
    ).cast("double"),
    "NitrogenCount": _count(r"N(?![aebdiop])|n(?![a-z])"),
    "OxygenCount": _count(r"O(?![s])|o(?![a-z])"),
    "HalogenCount": _count(r"F(?![emlr])|Cl|Br|I(?![nr])"),
    "DoubleBondCount": _count("="),
    "TripleBondCount": _count("#"),
    "FragmentCount": lambda c: (F.regexp_count(c, F.lit(r"\.")) + 1).cast("double"),
}


def choose(
    registry: dict[str, Feature], include: list[str] | None = None, exclude: list[str] | None = None
) -> dict[str, Feature]:
    return {
        k: v for k, v in registry.items()
        if (not include or k in include) and k not in (exclude or [])
    }


def with_features(df: DataFrame, source: str, registry: dict[str, Feature]) -> DataFrame:
    """One double column per feature; a value that is not finite is NULL."""
    return df.select("*", *[finite(f(F.col(source))).alias(n) for n, f in registry.items()])


def parse_source(smiles: Column, inchi: Column) -> Column:
    """Which text a structure would be built from: smiles, else inchi_fallback, else none."""
    given = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return F.when(given(smiles), "smiles").when(given(inchi), "inchi_fallback").otherwise("none")


def describe(
    df: DataFrame, smiles: str, inchi: str | None, record: str,
    registry: dict[str, Feature] = SMILES_FEATURES, source_file: Column | None = None,
) -> DataFrame:
    """Records as descriptor rows: six text columns, then the features."""
    other = F.col(f"`{inchi}`") if inchi else F.lit(None).cast("string")
    text = F.col(f"`{smiles}`")
    source = parse_source(text, other)
    structure = F.when(source == "smiles", F.trim(text)).when(
        source == "inchi_fallback", with_inchi_prefix(other)
    )
    status = F.when(source == "none", "failed(parsing)").otherwise("success")
    base = df.select(
        F.col(f"`{record}`").cast("string").alias("CID"), text.alias("isomeric_smiles"),
        structure.alias("standardized_smiles"), source.alias("parse_source"),
        final_status(status, source, source != "none").alias("standardization_status"),
        (F.lit(None).cast("string") if source_file is None else source_file).alias("source_file"),
    )
    return with_features(base, "standardized_smiles", registry)


class _Late(BaseException):
    """Not an Exception, so that a descriptor function that catches those can't swallow it."""


def _within(seconds: float, call: Callable, value):
    """Run one call under an interval timer (worker processes run it in their main thread)."""
    if seconds <= 0:
        return call(value)

    def stop(*_):
        raise _Late

    before = signal.signal(signal.SIGALRM, stop)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        return call(value)
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def apply_guarded(
    df: DataFrame, source: str, names: list[str],
    make: Callable[[], Callable[[str], dict[str, float]]], timeout: float = 30.0,
) -> DataFrame:
    """Run a Python descriptor function per record, with a time limit each.

    ``make`` builds the function once per task (for toolkits that are slow to start). A call
    that runs too long gives status ``failed(skip)`` and empty features, one that raises
    ``failed(descriptor)``; the rest of the data goes on.
    """
    schema = T.StructType(
        [*df.schema.fields, T.StructField("descriptor_status", T.StringType()),
         *[T.StructField(n, T.DoubleType()) for n in names]]
    )

    def run(frames):
        if timeout > 0 and threading.current_thread() is not threading.main_thread():
            raise RuntimeError("a time limit needs the main thread of its worker process")
        call = make()
        for frame in frames:
            status, rows = [], []
            for value in frame[source]:
                try:
                    found = _within(timeout, call, value)
                    status.append("success")
                except _Late:
                    found = {}
                    status.append("failed(skip)")
                except Exception:  # one bad record must not end the task
                    found = {}
                    status.append("failed(descriptor)")
                rows.append([found.get(n) for n in names])
            out = frame.assign(descriptor_status=status)
            values = pd.DataFrame(rows, columns=names, index=frame.index)
            for n in names:
                numbers = pd.to_numeric(values[n], errors="coerce")
                out[n] = numbers.where(numbers.abs() != float("inf"))
            yield out

    wide = df.mapInPandas(run, schema)
    return wide.select(
        *df.columns, "descriptor_status", *[finite(F.col(f"`{n}`")).alias(n) for n in names]
    )


def toolkit_available() -> bool:
    """Whether the optional structure toolkit can be imported on this machine."""
    try:
        import rdkit  # noqa: F401
    except ImportError:
        return False
    return True


def toolkit_names() -> list[str]:
    from rdkit.Chem import Descriptors

    return [name for name, _ in Descriptors.descList]


def declared_schema(registry: dict[str, Feature] = SMILES_FEATURES) -> list[str]:
    """Master schema from what the registry and the toolkit declare, without reading data."""
    names = list(registry)
    if toolkit_available():
        taken = {n.lower() for n in names}
        names += [n for n in toolkit_names() if n.lower() not in taken]
    return [*METADATA, *names]


def toolkit_descriptors() -> Callable[[str], dict[str, float]]:
    """Descriptor function backed by the toolkit; pass to ``apply_guarded``."""
    from rdkit import Chem
    from rdkit.Chem import Descriptors

    def describe_one(smiles: str) -> dict[str, float]:
        molecule = Chem.MolFromSmiles(smiles) if smiles else None
        if molecule is None:
            return {}
        found = {}
        for name, function in Descriptors.descList:
            try:
                found[name] = float(function(molecule))
            except Exception:  # a single descriptor may not apply
                found[name] = None
        return found

    return describe_one


__all__ = [
    "METADATA", "TEXT_FEATURES", "SMILES_FEATURES", "choose", "with_features", "parse_source",
    "describe", "apply_guarded", "toolkit_available", "toolkit_names", "declared_schema", "toolkit_descriptors",
]
