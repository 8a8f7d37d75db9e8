"""Silver credit tables derived from the driver's TPC-H-like parquet tables.

The driver ships star-schema tables, not credit microdata, so each silver table the
jobs expect is a Spark view over them (the role mapping). Every view reads the whole
driver tables, so job cost grows with the data:

  Keys keep the driver's integer types (ref_bacen = l_orderkey, nu_ordem = l_linenumber,
  mutuario = l_suppkey): the jobs are key-type agnostic and integer keys hash and sort
  faster than their text renderings. Codes are text, as in the credit domains.

  operacao_basica  one row per (l_orderkey, l_linenumber): contract = order, sub-operation =
                   line number; issue date = o_orderdate; credit value = sum(l_extendedprice);
                   the state is the ordering customer's nation, codes are part keys modulo the
                   number of descriptions
  saldos           one balance month per lineitem: month of l_shipdate, status l_returnflag
  mutuarios        contract <-> borrower bridge at lineitem grain (borrower = supplier),
                   so repeated (order, supplier) pairs are real duplicate bridge rows
  situacao_operacao   status domain over the return flags present in lineitem
  empreendimento      enterprise domain = part, with the real descriptions by part key
  code domains        the real descriptions of each feature's rules, by part key
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropcredit.operators import features as FE
from cropcredit.session import ensure_checkpoint_dir, sized_broadcast

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Status code -> description for the balance status domain (R marks default).
STATUS_DESCRIPTIONS = {"R": "Inadimplente", "A": "Adimplente", "N": "Normal"}

# Code domain -> (feature whose rules name its descriptions, code column of the operation or bridge).
CODE_DOMAINS = {
    "categoria_emitente": "cat_emitente", "tipo_seguro": "tipo_seguro", "tipo_irrigacao": "tipo_irrigacao",
    "fase_ciclo_producao": "tipo_ciclo", "tipo_integracao": "tipo_integracao", "instrumento_credito": "instrum_credito",
    "fonte_recursos": "fonte_recurso", "tipo_beneficiario": "tp_produtor", "tipo_agricultura": "tipo_agricultura",
}


def descriptions(feature: str, column: str = "DESCRICAO") -> list:
    """What a domain column holds, by code: every description the feature's rules name for it, one
    that none names, and NULL. Codes are a driver key modulo the length, so every class, the guards
    and the order of the rules are met."""
    rules = FE.BY_NAME[feature].recode.rules if FE.BY_NAME[feature].recode else ()
    named = {v for _, clauses in rules for c in clauses if column in c for v in getattr(c[column], "values", c[column])}
    return [*sorted(named), "Não listado", None]


def _pick(values: list, key: str) -> F.Column:
    """values[key modulo length], as one SQL expression."""
    texts = ", ".join("CAST(NULL AS STRING)" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return F.expr(f"element_at(array({texts}), CAST(({key}) % {len(values)} AS INT) + 1)")


def _code(feature: str, key: str) -> F.Column:
    return F.expr(f"CAST(({key}) % {len(descriptions(feature))} AS STRING)")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> F.Column:
    return F.col(c).cast("string")


def operacao_basica(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    # Aggregate lines to the operation grain first (map-side partial aggregation), then
    # attach order attributes: a hot order key is split by AQE in the join.
    lines = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_partkey").alias("partkey"),
        F.round(F.sum("l_extendedprice"), 2).alias("VL_PARC_CREDITO"),
        F.max("l_tax").alias("VL_JUROS"),
        F.max("l_discount").alias("VL_ALIQ_PROAGRO"),
        F.round(F.sum("l_quantity"), 2).alias("VL_AREA_INFORMADA"),
    )
    nation = sized_broadcast(read_table(spark, sf_dir, "nation"))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = (
        read_table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        .join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    )
    j = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    return j.select(
        F.col("l_orderkey").alias("#REF_BACEN"),
        F.col("l_linenumber").alias("NU_ORDEM"),
        _code("cat_emitente", "partkey").alias("CD_CATEG_EMITENTE"),
        _code("instrum_credito", "partkey").alias("CD_INST_CREDITO"),
        _code("fonte_recurso", "partkey").alias("CD_FONTE_RECURSO"),
        F.col("n_name").alias("CD_ESTADO"),
        _code("tipo_seguro", "partkey").alias("CD_TIPO_SEGURO"),
        _s("partkey").alias("CD_EMPREENDIMENTO"),
        _pick(descriptions("programa", "CD_PROGRAMA"), "partkey").alias("CD_PROGRAMA"),
        _code("tipo_irrigacao", "partkey").alias("CD_TIPO_IRRIGACAO"),
        _code("tipo_agricultura", "partkey").alias("CD_TIPO_AGRICULTURA"),
        _code("tipo_ciclo", "partkey").alias("CD_FASE_CICLO_PRODUCAO"),
        _code("tipo_integracao", "c_nationkey").alias("CD_TIPO_INTGR_CONSOR"),
        F.col("o_orderdate").cast("date").alias("DT_EMISSAO"),
        "VL_ALIQ_PROAGRO",
        "VL_JUROS",
        "VL_AREA_INFORMADA",
        "VL_PARC_CREDITO",
    )


def saldos(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("#REF_BACEN"),
        F.col("l_linenumber").alias("NU_ORDEM"),
        F.year("l_shipdate").cast("string").alias("ANO_BASE"),
        F.month("l_shipdate").cast("string").alias("MES_BASE"),
        F.col("l_returnflag").alias("CD_SITUACAO_OPERACAO"),
    )


def mutuarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("REF_BACEN"),
        F.col("l_suppkey").alias("CD_CPF_CNPJ"),
        _code("tp_produtor", "l_suppkey").alias("CD_TIPO_BENEFICIARIO"),
    )


def situacao_operacao(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = read_table(spark, sf_dir, "lineitem").select("l_returnflag").distinct()
    desc = F.lit(None).cast("string")
    for code, text in STATUS_DESCRIPTIONS.items():
        desc = F.when(F.col("l_returnflag") == code, F.lit(text)).otherwise(desc)
    return flags.select(F.col("l_returnflag").alias("#CODIGO"), desc.alias("DESCRICAO"))


def empreendimento(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        _s("p_partkey").alias("#CODIGO"),
        _pick(descriptions("finalidade", "FINALIDADE"), "p_partkey").alias("FINALIDADE"),
        _pick(descriptions("atividade", "ATIVIDADE"), "p_partkey").alias("ATIVIDADE"),
        _pick(descriptions("modalidade", "MODALIDADE"), "p_partkey div 2").alias("MODALIDADE"),
        _pick(descriptions("produto", "PRODUTO"), "p_partkey").alias("PRODUTO"),
        _pick(descriptions("produto", "VARIEDADE"), "p_partkey div 5").alias("VARIEDADE"),
        _s("p_size").alias("CESTA"),
    )


def code_domain(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """(#CODIGO, DESCRICAO) for the codes that part keys give; codes joined as integers carry zeros."""
    feature = CODE_DOMAINS[name]
    values = descriptions(feature)
    codes = read_table(spark, sf_dir, "part").select(F.expr(f"CAST(p_partkey % {len(values)} AS STRING)").alias("c")).distinct()
    code = F.lpad("c", 4, "0") if FE.BY_NAME[feature].int_code else F.col("c")
    return codes.select(code.alias("#CODIGO"), _pick(values, "CAST(c AS INT)").alias("DESCRICAO"))


def complemento_renegociacoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renegotiated operations with their municipality code; some codes are in no domain."""
    li = read_table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return li.groupBy(F.col("l_orderkey").alias("#REF_BACEN"), F.col("l_linenumber").alias("NU_ORDEM")).agg(
        (F.min("l_suppkey") % 30).cast("string").alias("CD_IBGE_MUNICIPIO"))


def municipios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation").select(_s("n_nationkey").alias("COD_MUNICIPIO_IBGE"), F.col("n_name").alias("NOME_MUNICIPIO"))


# The operation table (an aggregation and three joins) is written once per application and state of
# its sources; balances and bridge are projections and stay views, like the small code domains.
MATERIALIZED = {"operacao_basica": ("lineitem", "orders", "customer", "nation")}
_WRITTEN: dict = {}


def _state(spark: SparkSession, sf_dir: str, tables) -> tuple:
    """Modification times of driver tables: a rewritten source is written anew."""
    out = []
    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        out.append(path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getModificationTime())
    return tuple(out)


def materialized(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Write the view once to the shared folder as parquet, read it back."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name, _state(spark, sf_dir, MATERIALIZED[name]))
    if key not in _WRITTEN:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/silver/{uuid.uuid4().hex}/{name}.parquet"
        build(spark, sf_dir).write.parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])


class SilverViews(Mapping):
    """Silver tables by name, each built on first access (building a PySpark plan
    costs analyzer round-trips, so unused views are never built). With ``materialize``
    the large ones are written once and read back as parquet."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark, self.sf_dir, self.materialize = spark, sf_dir, materialize
        self._built: dict = {}
        self._makers = {
            "operacao_basica": operacao_basica,
            "saldos": saldos,
            "mutuarios": mutuarios,
            "situacao_operacao": situacao_operacao,
            "empreendimento": empreendimento,
            "complemento_renegociacoes": complemento_renegociacoes,
            "municipios": municipios,
        }
        for name in CODE_DOMAINS:
            self._makers[name] = lambda sp, d, n=name: code_domain(sp, d, n)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            maker = self._makers[name]
            if self.materialize and name in MATERIALIZED:
                self._built[name] = materialized(self.spark, self.sf_dir, name, maker)
            else:
                self._built[name] = maker(self.spark, self.sf_dir)
        return self._built[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self):
        return len(self._makers)


def silver_tables(spark: SparkSession, sf_dir: str, materialize: bool = True) -> SilverViews:
    """All silver tables the gold jobs read, keyed by their silver table name."""
    return SilverViews(spark, sf_dir, materialize)
