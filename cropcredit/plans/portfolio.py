"""The gold layer of one portfolio as lazily-built DataFrames sharing sub-plans.

One aggregation over balances x operations at the operation grain yields the label,
the first-default month and (optionally) every operation feature; the borrower
fan-out is applied last. Everything downstream (modelling table, business aggregates,
vintage curve) reuses these frames.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcredit.config import (
    CROP_YEAR_CUTOFF_MONTH, DEFAULT_SITUATIONS, HORIZON, KEYS, N_DELTAS, target_name,
)
from cropcredit.operators import business as B
from cropcredit.operators import features as FE
from cropcredit.operators import labels as L
from cropcredit.operators import vintage as VT
from cropcredit.session import written

BUSINESS_FEATURES = ("uf", "finalidade", "atividade", "produto")


class Portfolio:
    def __init__(self, silver: dict, horizon: int = HORIZON, n_deltas: int = N_DELTAS,
                 situations=DEFAULT_SITUATIONS, cutoff_month: int = CROP_YEAR_CUTOFF_MONTH,
                 value_col: str = "VL_PARC_CREDITO", features=None):
        self.silver = silver
        self.horizon = horizon
        self.n_deltas = n_deltas
        self.situations = situations
        self.cutoff_month = cutoff_month
        self.value_col = value_col
        self.features = FE.select_features(features)
        self.target_col = target_name(horizon)

    # --- operation grain ---------------------------------------------------------
    @cached_property
    def op_labels(self) -> DataFrame:
        """(ref_bacen, nu_ordem, target, first_default, in_window)."""
        s = self.silver
        return L.operation_labels(s["saldos"], s["operacao_basica"], s["situacao_operacao"],
                                  self.horizon, self.n_deltas, self.situations)

    def _held_features(self, names) -> FE.Held:
        """One row per operation key, features held as places."""
        s = self.silver
        # dealt by key while narrow: rows are not shuffled again for the reduction
        return FE.held_operations(s["operacao_basica"], s, list(names), dealt=True).reduced(FE.OP)

    def op_features(self, names) -> DataFrame:
        """(ref_bacen, nu_ordem, features): one value per operation key (min, like "any value")."""
        held = self._held_features(names)
        return held.rows.select(*FE.OP, *held.plain())

    def _held_grain(self, names) -> FE.Held:
        """op_labels with operation features, joined 1:1 on the key both are aggregated by."""
        labels = self.op_labels.select("ref_bacen", "nu_ordem", self.target_col)
        if not names:
            return FE.Held(labels, [], FE.Places({}))
        held = self._held_features(names)
        return FE.Held(labels.join(held.rows, [*FE.OP]), held.names, held.places)

    def op_grain(self, names) -> DataFrame:
        """op_labels with operation features."""
        held = self._held_grain(names)
        return held.rows.select(*FE.OP, self.target_col, *held.plain())

    def _with_safra(self, op: DataFrame, value_col=None) -> DataFrame:
        saf = B.crop_year_map(self.silver["operacao_basica"], self.cutoff_month, value_col)
        return op.join(saf, ["ref_bacen", "nu_ordem"], "left")

    @cached_property
    def _held_borrowers(self) -> FE.Held:
        """Distinct (ref_bacen, mutuario) + borrower features, held as places."""
        names = [f.name for f in self.features if f.keys == FE.BORROWER]
        return FE.held_borrowers(self.silver["mutuarios"], self.silver, names)

    @cached_property
    def borrower_pairs(self) -> DataFrame:
        return L.borrowers(self.silver["mutuarios"])

    # --- gold tables ---------------------------------------------------------------
    def target(self) -> DataFrame:
        t = self.target_col
        return L.fan_out(self.op_labels.select("ref_bacen", "nu_ordem", t), self.borrower_pairs).select(*KEYS, t)

    def first_default(self) -> DataFrame:
        ol = self.op_labels.where(F.col("in_window").isNotNull())
        return L.fan_out(ol.select("ref_bacen", "nu_ordem", "first_default"), self.borrower_pairs).select(
            *KEYS, "first_default")

    def _op_vintage(self, source: DataFrame) -> DataFrame:
        return source.where(F.col("in_window").isNotNull()).select("ref_bacen", "nu_ordem", "first_default")

    def vintage(self) -> DataFrame:
        v = L.fan_out(self._op_vintage(self.op_labels), self.borrower_pairs)
        return v.select(*KEYS, *L.vintage_columns("first_default", self.n_deltas))

    def modelling_base(self, safra: bool = False) -> DataFrame:
        """Keys, target and features; with ``safra`` also the crop year, attached at the operation
        grain. The borrower fan-out is the last join."""
        op, of = self._held_grain([f.name for f in self.features if f.keys == FE.OP]), self._held_borrowers
        rows = self._with_safra(op.rows) if safra else op.rows
        safra = ["safra"] if safra else []
        # operations are shuffled by contract with places; texts are put in after the fan-out
        rows = rows.join(of.rows.withColumnsRenamed({c: f"_b{c}" for c in of.columns}), "ref_bacen", "inner")
        rows = rows.select(*KEYS, self.target_col, *op.plain(), *safra, *[f"_b{c}" for c in of.columns])
        borrower = FE.Held(rows.withColumnsRenamed({f"_b{c}": c for c in of.columns}), of.names, of.places)
        rows = borrower.rows.select(*KEYS, self.target_col, *op.names, *borrower.plain(), *safra)
        return rows.select(*KEYS, self.target_col, *[f.name for f in self.features], *safra)

    def feature_table(self, name: str) -> DataFrame:
        s = self.silver
        return FE.feature_table(name, self.op_labels.select("ref_bacen", "nu_ordem"), self.borrower_pairs,
                                s["operacao_basica"], s["mutuarios"], s)

    def feature_tables(self) -> dict:
        """Every feature as a table of its own, by file name; the label keys they share are written once."""
        s = self.silver
        keys, pairs = written(self.op_labels.select("ref_bacen", "nu_ordem"), "label-keys"), written(self.borrower_pairs, "pairs")
        return {f.file: FE.feature_table(f.name, keys, pairs, s["operacao_basica"], s["mutuarios"], s) for f in self.features}

    # --- business ------------------------------------------------------------------
    def operation_base(self) -> DataFrame:
        """Operations that made it into the modelling table (have a borrower), with the
        business dimensions, default flag, crop year and credit value. Computed before
        the borrower fan-out: every borrower of an operation shares these values."""
        refs = self.borrower_pairs.select("ref_bacen").distinct()
        op = self.op_grain(list(BUSINESS_FEATURES)).join(refs, "ref_bacen", "left_semi").select(
            "ref_bacen", "nu_ordem", *BUSINESS_FEATURES, F.col(self.target_col).alias("inadimplente"))
        return self._with_safra(op, self.value_col)

    def aggregates(self) -> DataFrame:
        return B.aggregates(self.operation_base())

    def vintage_long(self) -> DataFrame:
        """The vintage matrix with a row per month: keys, delta, inadimplente. Months are the last expansion."""
        v = L.fan_out(self._op_vintage(self.op_labels), self.borrower_pairs)
        return VT.long_form(v, KEYS, self.n_deltas)

    def _event_histogram(self) -> DataFrame:
        """First defaults by crop year over borrower rows: each operation weighs as many rows as its contract has
        distinct borrowers, without the fan-out."""
        n = self.borrower_pairs.groupBy("ref_bacen").agg(F.count("*").alias("_w"))
        v = self._with_safra(self._op_vintage(self.op_labels)).where(F.col("safra").isNotNull())
        return VT.event_histogram(v.join(n, "ref_bacen"), ["safra"], weight="_w")

    def life_table(self) -> DataFrame:
        return VT.life_table(self._event_histogram(), ["safra"], self.n_deltas)

    def vintage_curve(self) -> DataFrame:
        """Mean cumulative default per delta by crop year over the borrower-level matrix."""
        return VT.curve(self.life_table(), ["safra"], self.n_deltas)


def scoring_base(silver, segment: str = "uf", horizon: int = HORIZON,
                 cutoff_month: int = CROP_YEAR_CUTOFF_MONTH) -> DataFrame:
    """(keys, target, segment feature, safra) - the modelling table restricted to the
    naive model's segment, with the crop year of the operation."""
    return Portfolio(silver, horizon=horizon, cutoff_month=cutoff_month, features=[segment]).modelling_base(safra=True)


def training_base(silver, horizon: int = HORIZON, cutoff_month: int = CROP_YEAR_CUTOFF_MONTH) -> DataFrame:
    """Modelling table with every feature and the operation's crop year."""
    return Portfolio(silver, horizon=horizon, cutoff_month=cutoff_month).modelling_base(safra=True)
