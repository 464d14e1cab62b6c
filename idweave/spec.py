"""Typed configuration: rules, thresholds and edge-case choices."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from idweave.functions.normalize import FAMILY, FULL, GIVEN

@dataclass(frozen=True)
class Rule:
    """One exact composite-key rule. ``unique`` first drops registry rows that share the key."""

    label: str
    keys: tuple[str, ...]
    unique: bool = False


@dataclass(frozen=True)
class FuzzyRule:
    """Name comparison inside a block.

    ``equal``  columns on which both sides agree; any number, at least one
    ``date``   column of dates: the same with ``days`` = 0, otherwise strictly less than ``days``
               apart. None: the rule has no date
    ``names``  columns of given names, surnames and full name
    """

    label: str
    equal: tuple[str, ...] = ("p_sexo",)
    date: str | None = "p_fecha_nac"
    days: int = 0
    names: tuple[str, str, str] = (GIVEN, FAMILY, FULL)

    def __post_init__(self) -> None:
        if not self.equal:
            raise ValueError("a fuzzy rule needs a block column")
        if self.days < 0 or (self.days > 0 and self.date is None):
            raise ValueError("days are 0 or more, and need a date column")

    @property
    def block(self) -> tuple[str, ...]:
        return (*self.equal, *([self.date] if self.date else []))


# Labels, their key columns and their order, most trusted first.
RULES: tuple[Rule, ...] = (
    Rule("id_cedula_nombre_apell", ("p_cedula", "p_nombres", "p_apellidos")),
    Rule("id_cedula_nombreyapllido", ("p_cedula", "p_nombres_apellidos")),
    Rule("id_cedula_sexo_fna", ("p_cedula", "p_sexo", "p_fecha_nac")),
    Rule("id_nombre_apell_sexo_fnac", ("p_nombres", "p_apellidos", "p_sexo", "p_fecha_nac")),
    Rule("id_nombreyapell_sexo_fnac", ("p_nombres_apellidos", "p_sexo", "p_fecha_nac")),
    Rule("id_cedula_iniciales_sexo", ("p_cedula", "iniciales", "p_sexo")),
    Rule("id_apell_sexo_fnac", ("p_apellidos", "p_sexo", "p_fecha_nac"), unique=True),
    Rule("id_cedulma_fna_sexo", ("p_cedula_mad", "p_fecha_nac", "p_sexo"), unique=True),
    Rule("id_cedulpa_fna_sexo", ("p_cedula_pad", "p_fecha_nac", "p_sexo"), unique=True),
    Rule("id_cedulma_nombre_apell", ("p_cedula_mad", "p_nombres", "p_apellidos")),
    Rule("id_cedulma_nombreyapell", ("p_cedula_mad", "p_nombres_apellidos")),
    Rule("id_cedulpa_nombre_apell", ("p_cedula_pad", "p_nombres", "p_apellidos")),
    Rule("id_cedulpa_nombreyapell", ("p_cedula_pad", "p_nombres_apellidos")),
    Rule("id_cedulma_iniciale_sexo", ("p_cedula_mad", "iniciales", "p_sexo"), unique=True),
    Rule("id_cedulpa_iniciale_sexo", ("p_cedula_pad", "iniciales", "p_sexo"), unique=True),
    Rule("id_cedulma_apell", ("p_cedula_mad", "p_apellidos"), unique=True),
    Rule("id_cedulpa_apell", ("p_cedula_pad", "p_apellidos"), unique=True),
)

FUZZY_RULES: tuple[FuzzyRule, ...] = (
    FuzzyRule("idif_sexo_fna_N_A", days=0),
    FuzzyRule("idif_sexo_fna_N_A_30", days=30),
)

# Labels of the residual stage.
LABEL_RESIDUAL = "match cedula"
LABEL_NOT_FOUND = "no encontrado"

# Distance given to a pair that cannot be compared, and the acceptance bound.
UNCOMPARABLE = 0.8
THRESHOLD = 0.20


def usable(requested: Sequence[str], pivot_columns: Iterable[str], registry_columns: Iterable[str]) -> list[str]:
    """Requested concepts that both tables have, in the requested order."""
    pivot_columns, registry_columns = set(pivot_columns), set(registry_columns)
    return [c for c in dict.fromkeys(requested) if c in pivot_columns and c in registry_columns]


def applicable(rules: Sequence[Rule], columns: Iterable[str]) -> list[Rule]:
    """Exact rules whose key columns are all present."""
    columns = set(columns)
    if not columns:
        raise ValueError("no linkage columns: the mapping yields none that both tables have")
    return [r for r in rules if columns.issuperset(r.keys)]


def applicable_fuzzy(rules: Sequence[FuzzyRule], columns: Iterable[str]) -> list[FuzzyRule]:
    """Fuzzy rules whose block columns and full name are present."""
    columns = set(columns)
    return [r for r in rules if columns.issuperset(r.block) and r.names[2] in columns]


@dataclass(frozen=True)
class LinkageSpec:
    """Everything ``link`` needs to know besides the two tables.

    ``columns``               requested concepts (see ``sources.mapping.linkage_columns``)
    ``threshold``             a score below it is a match; at most the distance of uncomparable names
    ``drop_matched``          take matched people out of the registry before the fuzzy stage
    ``null_key_is_duplicate`` registry rows that share a null key count as duplicates
    ``names_from``            "shrunk": matched names come from the registry after the uniqueness
                              checks; "full": from the whole registry
    ``row_key_unique``        the caller vouches that ``id_hash`` is unique and not null, which
                              saves the shuffle that otherwise makes row ids safe
    """

    columns: tuple[str, ...]
    rules: tuple[Rule, ...] = RULES
    fuzzy_rules: tuple[FuzzyRule, ...] = FUZZY_RULES
    threshold: float = THRESHOLD
    drop_matched: bool = False
    null_key_is_duplicate: bool = True
    names_from: str = "shrunk"
    row_key: str = "id_hash"
    row_key_unique: bool = False
    time_columns: tuple[str, ...] = field(default=("p_fecha_nac", "p_fecha_de_fatte"))

    def __post_init__(self) -> None:
        if not 0 < self.threshold <= UNCOMPARABLE:
            raise ValueError(f"threshold must be in (0, {UNCOMPARABLE}]")
        if self.names_from not in ("shrunk", "full"):
            raise ValueError("names_from must be 'shrunk' or 'full'")
