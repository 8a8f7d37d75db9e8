"""Run parameters. Every job takes them as arguments; these are the defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (must equal the original pipeline's settings for equal results) ---
# Situation descriptions that mark a balance month as "in default".
DEFAULT_SITUATIONS = (
    "Inadimplente",
    "Inscrita em Dívida Ativa da União",
    "Baixada como Prejuízo",
)
# Label horizon (months), vintage width (months), crop-year cut-off month.
HORIZON = 18
N_DELTAS = 24
CROP_YEAR_CUTOFF_MONTH = 7
# Dimensions of the business aggregates, in display order.
BUSINESS_DIMS = ("safra", "uf", "finalidade", "atividade", "produto")
# --- end of fixed values ---

KEYS = ("ref_bacen", "nu_ordem", "mutuario")
OP_KEYS = ("ref_bacen", "nu_ordem")
BORROWER_KEYS = ("ref_bacen", "mutuario")
GROUP = "mutuario"


def target_name(horizon: int = HORIZON) -> str:
    return f"target_{horizon}m"


@dataclass(frozen=True)
class SilverOptions:
    date_format: str = "%d/%m/%Y"
    decimal_separator: str = "."
    name_heuristics: bool = True


@dataclass(frozen=True)
class ModelingOptions:
    horizon: int = HORIZON
    n_splits: int = 5
    random_state: int = 42
    max_rows: int = 4_000_000
    sample_seed: int = 42
    naive_segment: str = "uf"
    max_categories: int = 30
    max_null_frac: float = 0.95
    crop_year_cutoff_month: int = CROP_YEAR_CUTOFF_MONTH
    min_train_safras: int = 1
    min_test_rows: int = 50
    value_column: str = "VL_PARC_CREDITO"
    features: tuple = field(default_factory=tuple)  # empty = all registered
