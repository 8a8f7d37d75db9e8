"""Raw-text rendering of operation fields, the way a bronze file carries them, for
exercising the typed projection over whole tables.

Variants rotate over (ref_bacen + nu_ordem): plain and zero-padded day/month dates, a
quoted and space-padded date, an impossible date, a date with a time part; values
with comma decimals with and without a '.' thousands group, quoted, blank and junk
('12d'); texts padded with spaces, NBSP or a tab, quoted, and an empty quoted string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcredit.sources.bronze import typed_select

NBSP, TAB = " ", "\t"


def rendered_operations(operacao: DataFrame) -> DataFrame:
    v = (F.col("`#REF_BACEN`") + F.col("NU_ORDEM")) % 5
    v6 = (F.col("`#REF_BACEN`") + F.col("NU_ORDEM")) % 6
    dt = F.col("DT_EMISSAO")
    d, m, y = F.dayofmonth(dt).cast("string"), F.month(dt).cast("string"), F.year(dt).cast("string")
    dd, mm = F.lpad(d, 2, "0"), F.lpad(m, 2, "0")
    date_txt = (
        F.when(v == 0, F.concat(d, F.lit("/"), m, F.lit("/"), y))
        .when(v == 1, F.concat(dd, F.lit("/"), mm, F.lit("/"), y))
        .when(v == 2, F.concat(F.lit('  "'), dd, F.lit("/"), mm, F.lit("/"), y, F.lit('" ')))
        .when(v == 3, F.concat(F.lit("31/02/"), y))
        .otherwise(F.concat(dd, F.lit("/"), mm, F.lit("/"), y, F.lit(" 00:00:00")))
    )
    cents = F.round(F.col("VL_PARC_CREDITO") * 100).cast("long")
    ip, fp = F.expr("CAST(round(VL_PARC_CREDITO * 100) AS BIGINT) div 100"), F.lpad((cents % 100).cast("string"), 2, "0")
    grouped = F.when(
        ip >= 1000,
        F.concat((ip / 1000).cast("long").cast("string"), F.lit("."),
                 F.lpad((ip % 1000).cast("string"), 3, "0"), F.lit(","), fp),
    ).otherwise(F.concat(ip.cast("string"), F.lit(","), fp))
    val_txt = (
        F.when(v == 0, grouped)
        .when(v == 1, F.concat(ip.cast("string"), F.lit(","), fp))
        .when(v == 2, F.concat(F.lit(' "'), ip.cast("string"), F.lit(","), fp, F.lit('"  ')))
        .when(v == 3, F.lit(""))
        .otherwise(F.concat(ip.cast("string"), F.lit("d")))
    )
    name = F.col("CD_ESTADO")
    txt = (
        F.when(v6 == 0, name)
        .when(v6 == 1, F.concat(F.lit("  "), name, F.lit("  ")))
        .when(v6 == 2, F.concat(F.lit('"'), name, F.lit('"')))
        .when(v6 == 3, F.lit('""'))
        .when(v6 == 4, F.concat(F.lit(NBSP), name, F.lit(NBSP)))
        .otherwise(F.concat(F.lit(TAB), name))
    )
    return operacao.select(
        F.col("`#REF_BACEN`").cast("string").alias("#REF_BACEN"),
        F.col("NU_ORDEM").cast("string").alias("NU_ORDEM"),
        date_txt.alias("DT_EMISSAO"),
        val_txt.alias("VL_PARC_CREDITO"),
        txt.alias("CD_ESTADO"),
    )


def typed_operations(operacao: DataFrame) -> DataFrame:
    raw = rendered_operations(operacao)
    t = typed_select(raw, date_format="%d/%m/%Y", decimal_separator=",")
    return t.drop("_source_object", "_loaded_at")
