"""Default label and vintage matrix from monthly balances.

Grain of the outputs is (ref_bacen, nu_ordem, mutuario). The original builds the
balance x operation x borrower fan-out first and aggregates it; the borrower join does
not change a row's month delta or status, so every borrower of a contract gets the
same value. We therefore aggregate at the operation grain (ref_bacen, nu_ordem) and
fan out to borrowers last: the fan-out is never shuffled or aggregated, which matters
when one contract carries a large share of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcredit.config import DEFAULT_SITUATIONS, HORIZON, N_DELTAS, target_name
from cropcredit.functions.columns import month_delta, month_number
from cropcredit.operators.skew import PLACE, hot_keys, numbered, spread_join
from cropcredit.session import counted_broadcast, written

K = ("ref_bacen", "nu_ordem", "mutuario")


def default_codes(situacao: DataFrame, situations: Sequence[str] = DEFAULT_SITUATIONS) -> DataFrame:
    """Status codes whose description is one of ``situations`` (distinct)."""
    return (
        situacao.where(F.col("DESCRICAO").isin(list(situations)))
        .select(F.col("`#CODIGO`").alias("cod"))
        .distinct()
    )


def flagged_balances(saldos: DataFrame, codes: DataFrame) -> DataFrame:
    """Balances with ``situacao`` = 1 when the status is a default code, else 0 (NULL -> 0)."""
    # counted, not estimated: the estimate of a domain derived from large tables follows those, and a shuffle by status
    # sends most balances to the task of one status
    c = counted_broadcast(written(codes.select("cod", F.lit(1).alias("_is_default")), "default-codes"))
    s = saldos.select(
        F.col("`#REF_BACEN`").alias("ref_bacen"),
        F.col("NU_ORDEM").alias("nu_ordem"),
        "ANO_BASE",
        "MES_BASE",
        F.col("CD_SITUACAO_OPERACAO").alias("_status"),
        *([PLACE] if PLACE in saldos.columns else []),
    )
    return s.join(c, s["_status"] == c["cod"], "left").select(
        "ref_bacen",
        "nu_ordem",
        "ANO_BASE",
        "MES_BASE",
        F.coalesce("_is_default", F.lit(0)).alias("situacao"),
        *([PLACE] if PLACE in saldos.columns else []),
    )


def operations(operacao: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return operacao.select(
        F.col("`#REF_BACEN`").alias("ref_bacen"),
        F.col("NU_ORDEM").alias("nu_ordem"),
        "DT_EMISSAO",
        *extra,
    )


def borrowers(mutuarios: DataFrame) -> DataFrame:
    """Distinct (ref_bacen, mutuario) pairs of the bridge."""
    return mutuarios.select(
        F.col("REF_BACEN").alias("ref_bacen"), F.col("CD_CPF_CNPJ").alias("mutuario")
    ).dropDuplicates(["ref_bacen", "mutuario"])


def observation_base(saldos, operacao, mutuarios, situacao, situations=DEFAULT_SITUATIONS) -> DataFrame:
    """The original observation base: balance x operation x every borrower of the
    contract (inner joins, deliberate fan-out), with month delta and default flag.
    Contracts and operations that hold many rows are cut into pieces (``operators.skew``)."""
    balances = flagged_balances(numbered(saldos), default_codes(situacao, situations))
    op = operations(numbered(operacao), [PLACE])
    mut = numbered(mutuarios).select(F.col("REF_BACEN").alias("ref_bacen"), F.col("CD_CPF_CNPJ").alias("mutuario"), PLACE)
    by_op, by_ref = ["ref_bacen", "nu_ordem"], ["ref_bacen"]
    j = spread_join(balances, op, by_op, hot_keys(balances.select(*by_op), op.select(*by_op), by_op))
    j = spread_join(j, mut, by_ref, hot_keys(balances.select(*by_ref), mut.select(*by_ref), by_ref))
    return j.select(
        "ref_bacen",
        "nu_ordem",
        "mutuario",
        month_delta("DT_EMISSAO", "ANO_BASE", "MES_BASE").alias("delta"),
        "situacao",
    )


def monthly_flags(saldos: DataFrame, situacao: DataFrame, situations: Sequence[str] = DEFAULT_SITUATIONS) -> DataFrame:
    """(ref_bacen, nu_ordem, month, situacao): the highest flag of each month (a number, NULL if it can't be parsed).
    Reduced map-side, so an operation with very many balances joins with one row per month."""
    fb = flagged_balances(saldos, default_codes(situacao, situations)).withColumn("month", month_number("ANO_BASE", "MES_BASE"))
    return fb.groupBy("ref_bacen", "nu_ordem", "month").agg(F.max("situacao").alias("situacao"))


def operation_labels(saldos: DataFrame, operacao: DataFrame, situacao: DataFrame, horizon: int = HORIZON,
                     n_deltas: int = N_DELTAS, situations: Sequence[str] = DEFAULT_SITUATIONS) -> DataFrame:
    """One row per (ref_bacen, nu_ordem) present in balances joined to operations, integers only:

    target        max(flag where 0 <= delta <= horizon, else 0)
    first_default min(delta where flag = 1 and 0 <= delta <= n_deltas)
    in_window     1 when any delta falls in 0..n_deltas (vintage keeps only those keys)
    """
    op = operations(operacao)
    j = monthly_flags(saldos, situacao, situations).join(op, ["ref_bacen", "nu_ordem"], "inner").withColumn(
        "_delta", (F.col("month") - month_number(F.year("DT_EMISSAO"), F.month("DT_EMISSAO"))).cast("int"))
    delta = F.col("_delta")
    in_h = delta.between(0, horizon)
    in_n = delta.between(0, n_deltas)
    return j.groupBy("ref_bacen", "nu_ordem").agg(
        F.max(F.when(in_h, F.col("situacao")).otherwise(0)).alias(target_name(horizon)),
        F.min(F.when(in_n & (F.col("situacao") == 1), delta)).alias("first_default"),
        F.max(F.when(in_n, F.lit(1))).alias("in_window"),
    )


def fan_out(op_grain: DataFrame, borrower_pairs: DataFrame) -> DataFrame:
    """Attach every borrower of the contract (inner join on ref_bacen)."""
    return op_grain.join(borrower_pairs, "ref_bacen", "inner")


def vintage_columns(first_default: str, n_deltas: int) -> list:
    fd = F.col(first_default)
    return [
        F.when(fd.isNotNull() & (F.lit(d) >= fd), 1).otherwise(0).alias(str(d))
        for d in range(n_deltas + 1)
    ]


def label_summary(target: DataFrame, column: str) -> DataFrame:
    """Row count and mean of the label (the original's sanity log line)."""
    return target.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(column).alias("rate"))
