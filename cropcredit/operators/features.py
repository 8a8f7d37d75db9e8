"""Model features: operation/borrower codes joined to domain tables and recoded.

Two forms are offered:

* :func:`feature_table` - one feature at the label grain with the original's inner-join
  semantics (an unmatched code drops the row; duplicate domain codes duplicate rows).
* :func:`operation_features` / :func:`borrower_features` - all features in one pass over
  the operations (resp. the bridge). Each domain table is recoded once on its own
  (tiny) rows, reduced to one row per code and broadcast-joined (left) to the big side,
  so no per-feature rescans and no per-row CASE chains over hundreds of literals. An
  unmatched code gives NULL, which is what the consolidated table holds in the original.
  Rows are shuffled with places in the lists of values instead of texts (:class:`Places`).
"""

from __future__ import annotations

from collections import OrderedDict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from cropcredit.operators import feature_rules as R
from cropcredit.operators.recode import Recode, to_column
from cropcredit.session import counted_broadcast, sized_broadcast, written

#: Codes of a domain (with a few texts each) that are broadcast at most; more are joined by a shuffle.
DOMAIN_ROWS = 50_000
#: Values of a feature that are listed at most; a feature of more is carried as its text.
CODED_VALUES = 1_000
#: Domain maps written at a time.
CONCURRENT_DOMAINS = 4

OP = ("ref_bacen", "nu_ordem")
BORROWER = ("ref_bacen", "mutuario")


@dataclass(frozen=True)
class Feature:
    name: str  # column name in the modelling table
    file: str  # name of its per-feature table
    kind: str  # "cat" or "num"
    keys: tuple  # OP or BORROWER
    code: str | None = None  # code (or value) column on the operation / bridge row
    domain: str | None = None  # silver domain table joined on the code
    int_code: bool = False  # join on integer-cast codes ('0001' = 1)
    recode: Recode | None = None  # None = pass ``value`` through
    value: str | None = None  # passthrough column (domain column, or source column)
    domain_cols: tuple = field(default_factory=tuple)


E = "empreendimento"
# Registry, in the original's order.
FEATURES = (
    Feature("tp_produtor", "tp_produtor", "cat", BORROWER, "CD_TIPO_BENEFICIARIO", "tipo_beneficiario",
            True, R.TP_PRODUTOR),
    Feature("cat_emitente", "cat_emitente", "cat", OP, "CD_CATEG_EMITENTE", "categoria_emitente", False,
            R.CAT_EMITENTE),
    Feature("instrum_credito", "instrum_credito", "cat", OP, "CD_INST_CREDITO", "instrumento_credito", True,
            R.INSTRUM_CREDITO),
    Feature("fonte_recurso", "fonte_recurso", "cat", OP, "CD_FONTE_RECURSO", "fonte_recursos", True,
            R.FONTE_RECURSO),
    Feature("uf", "uf_operacao", "cat", OP, "CD_ESTADO", value="CD_ESTADO"),
    Feature("tipo_seguro", "tipo_seguro", "cat", OP, "CD_TIPO_SEGURO", "tipo_seguro", True, R.TIPO_SEGURO),
    Feature("finalidade", "finalidade", "cat", OP, "CD_EMPREENDIMENTO", E, False, R.FINALIDADE),
    Feature("atividade", "atividade", "cat", OP, "CD_EMPREENDIMENTO", E, False, R.ATIVIDADE),
    Feature("modalidade", "modalidade", "cat", OP, "CD_EMPREENDIMENTO", E, False, R.MODALIDADE),
    Feature("produto", "produto", "cat", OP, "CD_EMPREENDIMENTO", E, False, R.PRODUTO),
    Feature("cesta_cultivo", "cesta_cultivo", "cat", OP, "CD_EMPREENDIMENTO", E, False, value="CESTA"),
    Feature("programa", "programa", "cat", OP, "CD_PROGRAMA", recode=R.PROGRAMA),
    Feature("tipo_irrigacao", "tipo_irrigacao", "cat", OP, "CD_TIPO_IRRIGACAO", "tipo_irrigacao", False,
            R.TIPO_IRRIGACAO),
    Feature("tipo_agricultura", "tipo_agricultura", "cat", OP, "CD_TIPO_AGRICULTURA", "tipo_agricultura",
            False, R.TIPO_AGRICULTURA),
    Feature("tipo_ciclo", "tipo_ciclo", "cat", OP, "CD_FASE_CICLO_PRODUCAO", "fase_ciclo_producao", False,
            R.TIPO_CICLO),
    Feature("tipo_integracao", "tipo_integracao", "cat", OP, "CD_TIPO_INTGR_CONSOR", "tipo_integracao",
            False, value="DESCRICAO"),
    Feature("aliq_proagro", "aliquota_proagro", "num", OP, "VL_ALIQ_PROAGRO", value="VL_ALIQ_PROAGRO"),
    Feature("juros", "juros", "num", OP, "VL_JUROS", value="VL_JUROS"),
    Feature("area_informada", "area_informada", "num", OP, "VL_AREA_INFORMADA", value="VL_AREA_INFORMADA"),
)
BY_NAME = {f.name: f for f in FEATURES}
CAT_FEATURES = tuple(f.name for f in FEATURES if f.kind == "cat")
NUM_FEATURES = tuple(f.name for f in FEATURES if f.kind == "num")
ALL_FEATURES = tuple(f.name for f in FEATURES)


def select_features(only=None, warn=print) -> list[Feature]:
    """Registered features to build; unknown names are warned about and skipped."""
    if only is None:
        return list(FEATURES)
    out = []
    for name in only:
        if name in BY_NAME:
            out.append(BY_NAME[name])
        else:
            warn(f"feature {name!r} has no registered definition - skipped")
    return out


def _value_expr(f: Feature):
    if f.recode is not None:
        return to_column(f.recode)
    return F.col(f.value)


def _code_key(c, int_code: bool):
    return c.try_cast("int") if int_code else c


def _domain_rows(domains: dict, f: Feature) -> DataFrame:
    """(_code, the feature's value): recoded on the domain's own rows, written and counted."""
    rows = domains[f.domain].select(_code_key(F.col("`#CODIGO`"), f.int_code).alias("_code"), _value_expr(f).alias(f.name))
    return counted_broadcast(written(rows.where(F.col("_code").isNotNull()), f"domain-{f.name}"), DOMAIN_ROWS)


def _groups(features):
    """Features of one (domain, code column, cast) share one join. A text that is made of the row's own code alone has the
    codes that occur as its domain (no domain name)."""
    groups = OrderedDict()
    for f in features:
        own = f.kind == "cat" and (f.recode.columns() if f.recode else {f.value}) == {f.code}
        if f.domain or own:
            groups.setdefault((f.domain, f.code, f.int_code), []).append(f)
    return groups


@dataclass
class Places:
    """How features are held while rows are shuffled: each is its place (from 1, 0 is NULL) in the sorted list of its values,
    and places are packed in whole numbers. The least place is the least text."""

    values: dict  # feature -> its sorted values

    def __post_init__(self):
        self.at, word, used = {}, 0, 0  # feature -> (word, shift, mask)
        for name, values in self.values.items():
            bits = len(values).bit_length()
            if used + bits > 31:
                word, used = word + 1, 0
            self.at[name] = (word, used, (1 << bits) - 1)
            used += bits
        self.words = [f"_w{i}" for i in range(word + 1)] if self.values else []

    def packed(self, place) -> list:
        """The words of rows, where ``place`` gives a feature's place (None: not there)."""
        parts: dict = {w: [] for w in self.words}
        for name, (word, shift, _) in self.at.items():
            p = place(name)
            if p is not None:
                parts[self.words[word]].append(F.shiftleft(F.coalesce(p, F.lit(0)), shift))
        return [reduce(Column.bitwiseOR, found, F.lit(0)).alias(w) for w, found in parts.items()]

    def _bits(self, name: str) -> Column:
        word, shift, mask = self.at[name]
        return F.shiftrightunsigned(self.words[word], shift).bitwiseAND(F.lit(mask))

    def place(self, name: str) -> Column:
        return F.nullif(self._bits(name), F.lit(0))

    def found(self, name: str, text: Column) -> Column:
        return F.array_position(F.array(*[F.lit(v) for v in self.values[name]]).cast("array<string>"), text).cast("int")

    def text(self, name: str) -> Column:
        # short on purpose: generated methods of over 8,000 bytes are never compiled, which made the fan-out six times slower
        return F.get(F.array(F.lit(None).cast("string"), *[F.lit(v) for v in self.values[name]]), self._bits(name))


@dataclass
class Held:
    """Rows whose features are held as places, or as they are (numbers, texts of very many values)."""

    rows: DataFrame
    names: list
    places: Places

    @property
    def columns(self) -> list:
        return [*self.places.words, *[n for n in self.names if n not in self.places.values]]

    def plain(self) -> list:
        """The features themselves, in order."""
        return [(self.places.text(n) if n in self.places.values else F.col(n)).alias(n) for n in self.names]

    def reduced(self, keys) -> "Held":
        """One row per key: the least value of every feature that is not NULL."""
        least = [F.min(self.places.place(n) if n in self.places.values else F.col(n)).alias(n) for n in self.names]
        rows = self.rows.groupBy(*keys).agg(*least)
        packed = self.places.packed(F.col)
        return Held(rows.select(*keys, *packed, *[n for n in self.names if n not in self.places.values]), self.names, self.places)


def _map_values(mapped: DataFrame, features) -> dict:
    """feature -> its sorted values in a domain map, of the features with at most ``CODED_VALUES``; no more reach the driver."""
    pairs = F.array(*[F.struct(F.lit(f.name).alias("feature"), F.col(f"_f_{f.name}").cast("string").alias("v")) for f in features])
    pairs = mapped.select(F.inline(pairs)).where(F.col("v").isNotNull()).distinct()
    r = F.row_number().over(W.partitionBy("feature").orderBy("v"))
    found: dict = {f.name: [] for f in features}
    for row in pairs.withColumn("r", r).where(F.col("r") <= CODED_VALUES + 1).orderBy("feature", "r").collect():
        found[row["feature"]].append(row["v"])
    return {name: values for name, values in found.items() if len(values) <= CODED_VALUES}


def _attach(base: DataFrame, features, domains: dict, keys: dict, keep=(), deal=()) -> Held:
    """(keys, keep, features) of the rows, one recoded domain map joined per group; ``keys``: name -> column. Maps are written and
    counted: small ones are broadcast, then rows hold places instead of texts and codes; large ones are joined by a shuffle.
    In the end rows are dealt by the columns ``deal``, if any: an aggregation by these columns needs no other shuffle."""

    def build(i, domain, code, int_code, fs):
        key = F.col("`#CODIGO`") if domain else F.col(code)
        rows = domains[domain] if domain else base.select(code).distinct()
        mapped = rows.select(_code_key(key, int_code).alias(f"_k{i}"), *[_value_expr(f).cast("string").alias(f"_f_{f.name}") for f in fs])
        if domain:
            # one row per code (duplicate codes: min, NULLs skipped - like "any value")
            mapped = mapped.where(F.col(f"_k{i}").isNotNull())
            mapped = mapped.groupBy(f"_k{i}").agg(*[F.min(f"_f_{f.name}").alias(f"_f_{f.name}") for f in fs])
        mapped = written(mapped, f"domain-{domain or code}")
        return mapped, mapped.count(), _map_values(mapped, fs)

    groups = [(i, domain, code, int_code, fs) for i, ((domain, code, int_code), fs) in enumerate(_groups(features).items())]
    with ThreadPoolExecutor(max_workers=CONCURRENT_DOMAINS) as pool:  # each map is a few small jobs
        own = inheritable_thread_target(base.sparkSession)
        found = list(pool.map(own(lambda g: build(*g)), groups))
    small, large, held = [], [], {}
    for (i, domain, code, int_code, fs), (mapped, rows, values) in zip(groups, found):
        if domain or rows <= DOMAIN_ROWS:  # more codes of its own: the row's own text
            held |= values
            (small if rows <= DOMAIN_ROWS else large).append((i, domain, code, int_code, fs, mapped))
    places = Places({f.name: held[f.name] for f in features if f.name in held})
    texts = {f.name for *_, fs, _ in (*small, *large) for f in fs if f.name not in held}  # of too many values: carried as they are

    def words(group):
        i, *_, fs, mapped = group
        mine = {f.name: places.found(f.name, F.col(f"_f_{f.name}")) for f in fs if f.name in held}
        columns = [c.alias(f"_m{i}{w}") for c, w in zip(places.packed(mine.get), places.words)] if mine else []
        return mapped.select(f"_k{i}", *columns, *[F.col(f"_f_{f.name}").alias(f.name) for f in fs if f.name in texts]), bool(mine)

    def joined(rows, group, on, how):
        """``rows`` with the map's features; a code that is not in the map has none."""
        i, domain, _, _, fs, _ = group
        mapped, some = words(group)
        mapped = F.broadcast(mapped) if how == "broadcast" else mapped.hint("merge")
        on = on == F.col(f"_k{i}") if domain else on.eqNullSafe(F.col(f"_k{i}"))
        return rows.join(mapped, on, "left"), [i] if some else []

    def merged(maps, before):
        return [reduce(Column.bitwiseOR, [F.coalesce(F.col(f"_m{i}{w}"), F.lit(0)) for i in maps], F.col(w) if before else F.lit(0)).alias(w)
                for w in places.words]

    mapped_names = {f.name for *_, fs, _ in (*small, *large) for f in fs}
    rows, maps, carried = base, [], [f for f in features if f.name not in mapped_names]
    for g in small:
        rows, some = joined(rows, g, _code_key(F.col(g[2]), g[3]), "broadcast")
        maps += some
    at_hand = [_value_expr(f).alias(f.name) for f in carried] + [f.name for *_, fs, _ in small for f in fs if f.name in texts]
    codes = list(dict.fromkeys(code for _, _, code, *_ in large))
    rows = rows.select(*[c.alias(n) for n, c in keys.items()], *keep, *codes, *merged(maps, False), *at_hand)
    names = [*keys, *keep, *places.words, *[f.name for f in carried], *[f.name for *_, fs, _ in small for f in fs if f.name in texts]]
    for k, g in enumerate(large):
        rows, some = joined(rows, g, _code_key(F.col(g[2]), g[3]), "merge")
        left = [c for c in codes if c in {code for _, _, code, *_ in large[k + 1:]}]
        fresh = [f.name for f in g[4] if f.name in texts]
        rows = rows.select(*[c for c in names if c not in places.words], *left, *merged(some, True), *fresh)
        names += fresh
    if deal:
        rows = rows.repartition(*deal)
    return Held(rows, [f.name for f in features], places)


def held_operations(operacao: DataFrame, domains: dict, only=None, keep=(), dealt: bool = False) -> Held:
    """(ref_bacen, nu_ordem, *keep) with the operation-grain features held as places. Not deduplicated: duplicate keys stay;
    ``dealt``: they are in one partition."""
    fs = [f for f in select_features(only) if f.keys == OP]
    keys = {"ref_bacen": F.col("`#REF_BACEN`"), "nu_ordem": F.col("NU_ORDEM")}
    return _attach(operacao, fs, domains, keys, keep, OP if dealt else ())


def operation_features(operacao: DataFrame, domains: dict, only=None, keep=(), dealt: bool = False) -> DataFrame:
    """(ref_bacen, nu_ordem, *keep, <operation-grain features>). Small domain maps are broadcast, large ones joined by a
    shuffle. Not deduplicated: duplicate keys stay; ``dealt``: they are in one partition."""
    held = held_operations(operacao, domains, only, keep, dealt)
    return held.rows.select(*OP, *keep, *held.plain())


def held_borrowers(mutuarios: DataFrame, domains: dict, only=None) -> Held:
    """(ref_bacen, mutuario) with the borrower features held as places, one row per distinct pair; duplicate bridge rows are
    reduced with ``min``."""
    fs = [f for f in select_features(only) if f.keys == BORROWER]
    held = _attach(mutuarios, fs, domains, {"ref_bacen": F.col("REF_BACEN"), "mutuario": F.col("CD_CPF_CNPJ")})
    if fs:
        return held.reduced(BORROWER)
    return Held(held.rows.dropDuplicates([*BORROWER]), [], held.places)


def borrower_features(mutuarios: DataFrame, domains: dict, only=None) -> DataFrame:
    """(ref_bacen, mutuario, <borrower features>), one row per distinct pair; duplicate
    bridge rows are reduced with ``min``."""
    held = held_borrowers(mutuarios, domains, only)
    return held.rows.select(*BORROWER, *held.plain())


def feature_table(name: str, operations: DataFrame, pairs: DataFrame, operacao: DataFrame, mutuarios: DataFrame,
                  domains: dict) -> DataFrame:
    """One feature at the label grain with the original's semantics: label keys
    inner-joined to the source row and to the domain code. Output: 3 keys + value.

    ``operations``: the labels' (ref_bacen, nu_ordem), ``pairs``: their distinct (ref_bacen,
    mutuario). Operation attributes are attached at that grain; the fan-out comes last."""
    f = BY_NAME[name]
    if f.keys == OP:
        src = operacao.select(
            F.col("`#REF_BACEN`").alias("ref_bacen"), F.col("NU_ORDEM").alias("nu_ordem"), F.col(f.code)
        )
        j = operations.join(src, ["ref_bacen", "nu_ordem"], "inner")
    else:
        src = mutuarios.select(
            F.col("REF_BACEN").alias("ref_bacen"), F.col("CD_CPF_CNPJ").alias("mutuario"), F.col(f.code)
        )
        j = pairs.join(src, ["ref_bacen", "mutuario"], "inner")
    if f.domain:
        d = _domain_rows(domains, f)
        j = j.join(d, _code_key(F.col(f.code), f.int_code) == F.col("_code"), "inner")
    value = F.col(f.name) if f.domain else _value_expr(f).alias(f.name)
    if f.keys == OP:
        j = j.select("ref_bacen", "nu_ordem", value).join(pairs, "ref_bacen")
    else:
        j = j.select("ref_bacen", "mutuario", value).join(operations, "ref_bacen")
    return j.select("ref_bacen", "nu_ordem", "mutuario", f.name)


def municipio_feature(target: DataFrame, complemento: DataFrame, municipios: DataFrame,
                      target_col: str = "target_18m") -> DataFrame:
    """Exploratory feature outside the registry: municipality name of the operation
    through the renegotiation complement (both joins inner, value passed through).
    Output: ref_bacen, nu_ordem, <target>, municipio."""
    comp = complemento.select(
        F.col("`#REF_BACEN`").alias("ref_bacen"), F.col("NU_ORDEM").alias("nu_ordem"),
        F.col("CD_IBGE_MUNICIPIO").alias("_cod"))
    muni = municipios.select(F.col("COD_MUNICIPIO_IBGE").alias("_cod"), F.col("NOME_MUNICIPIO").alias("municipio"))
    j = target.select("ref_bacen", "nu_ordem", target_col).join(comp, ["ref_bacen", "nu_ordem"], "inner")
    return j.join(sized_broadcast(muni), "_cod", "inner").select("ref_bacen", "nu_ordem", target_col, "municipio")
