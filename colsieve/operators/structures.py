"""Parsing and standardising structures with a pluggable toolkit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colsieve.functions.text import final_status


@dataclass
class Toolkit:
    """What the engine needs of a structure library; every reader may raise or return None."""

    read_smiles: Callable[[str], object]
    read_inchi: Callable[[str], object]
    write: Callable[[object], str]
    check: Callable[[object], object]
    steps: list[tuple[str, Callable[[object], object]]] = field(default_factory=list)


def _read(reader: Callable[[str], object], text: str | None):
    text = (text or "").strip()
    if not text:
        return None
    try:
        return reader(text)
    except Exception:  # unreadable text counts as no structure
        return None


def _prefixed(inchi: str | None) -> str | None:
    text = (inchi or "").strip()
    return text if not text or text.startswith("InChI=") else f"InChI={text}"


def standardise(toolkit: Toolkit, structure) -> tuple[object | None, str]:
    """Apply the steps in order; a failing step is skipped and named in the status."""
    if structure is None:
        return None, "failed(parsing)"
    skipped = []
    for name, step in toolkit.steps:
        try:
            structure = step(structure)
        except Exception:  # the step does not apply to this structure
            skipped.append(name)
    try:
        structure = toolkit.check(structure)
    except Exception:  # nothing usable is left
        return None, f"failed({','.join([*skipped, 'FinalSanitize'])})"
    return structure, f"partial_success({','.join(skipped)})" if skipped else "success"


def resolve(toolkit: Toolkit, smiles: str | None, inchi: str | None) -> tuple[str | None, str, str]:
    """Standardised text, parse source and raw status of one record."""
    structure, source = _read(toolkit.read_smiles, smiles), "smiles"
    if structure is None:
        structure, source = _read(toolkit.read_inchi, _prefixed(inchi)), "inchi_fallback"
    if structure is None:
        source = "none"
    done, status = standardise(toolkit, structure)
    if done is None and source == "smiles":
        again, second = standardise(toolkit, _read(toolkit.read_inchi, _prefixed(inchi)))
        if again is not None:
            done, status, source = again, f"recovered_via_inchi({second})", "inchi_fallback_after_std"
    return (toolkit.write(done) if done is not None else None), source, status


def with_structures(
    df: DataFrame, smiles: str, inchi: str, make: Callable[[], Toolkit]
) -> DataFrame:
    """Add standardized_smiles, parse_source and standardization_status.

    ``make`` builds the toolkit once per task.
    """
    added = ["standardized_smiles", "parse_source", "_raw_status"]
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.StringType()) for c in added]])

    def run(frames):
        toolkit = make()
        for frame in frames:
            found = [resolve(toolkit, s, i) for s, i in zip(frame[smiles], frame[inchi])]
            yield frame.assign(**{c: [f[k] for f in found] for k, c in enumerate(added)})

    status = final_status(
        F.col("_raw_status"), F.col("parse_source"), F.col("standardized_smiles").isNotNull()
    )
    return df.mapInPandas(run, schema).withColumn("standardization_status", status).drop("_raw_status")


def rdkit_toolkit(
    core: bool = True, normalizer: bool = False, reionizer: bool = False, metals: bool = False,
    largest_fragment: bool = False,
) -> Toolkit:
    """A toolkit on RDKit, where it is installed."""
    from rdkit import Chem
    from rdkit.Chem.MolStandardize import rdMolStandardize

    options = [
        (core, "Cleanup", lambda: rdMolStandardize.Cleanup),
        (normalizer, "Normalizer", lambda: rdMolStandardize.Normalizer().normalize),
        (reionizer, "Reionizer", lambda: rdMolStandardize.Reionizer().reionize),
        (metals, "MetalDisconnector", lambda: rdMolStandardize.MetalDisconnector().Disconnect),
        (largest_fragment, "LargestFragment", lambda: rdMolStandardize.LargestFragmentChooser().choose),
    ]

    def check(molecule):
        Chem.SanitizeMol(molecule)
        return molecule

    return Toolkit(
        read_smiles=Chem.MolFromSmiles, read_inchi=Chem.MolFromInchi, write=Chem.MolToSmiles,
        check=check, steps=[(name, build()) for wanted, name, build in options if wanted],
    )
