"""Reference SQL (DuckDB dialect) for the registered queries.

Written independently of the Spark plans, in the plain shape of the original jobs
(fan-out first, group afterwards, one inner-join chain per feature), over the same
driver tables. The driver runs these side by side with the Spark queries.
"""

from __future__ import annotations

from cropcredit.config import DEFAULT_SITUATIONS
from cropcredit.operators import features as FE
from cropcredit.operators.recode import Keep, Not, to_sql
from cropcredit.sources.driver_tables import CODE_DOMAINS, descriptions

H, N, CUT = 18, 24, 7


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else _lit(v) for v in values) + "]"


def _pick(values, key: str) -> str:
    return f"{_list(values)}[({key}) % {len(values)} + 1]"


def _code(feature: str, key: str) -> str:
    return f"CAST(({key}) % {len(descriptions(feature))} AS VARCHAR)"


def _domain(name: str, feature: str) -> str:
    values = descriptions(feature)
    code = "lpad(CAST(c AS VARCHAR), 4, '0')" if FE.BY_NAME[feature].int_code else "CAST(c AS VARCHAR)"
    return f"""{name} AS (SELECT {code} AS "#CODIGO", {_pick(values, 'c')} AS DESCRICAO
  FROM (SELECT DISTINCT p_partkey % {len(values)} AS c FROM part))"""


SILVER = f"""
op_lines AS (
  SELECT l_orderkey, l_linenumber, min(l_partkey) AS partkey,
         round(sum(l_extendedprice), 2) AS VL_PARC_CREDITO, max(l_tax) AS VL_JUROS,
         max(l_discount) AS VL_ALIQ_PROAGRO, round(sum(l_quantity), 2) AS VL_AREA_INFORMADA
  FROM lineitem GROUP BY l_orderkey, l_linenumber
),
ord AS (
  SELECT o_orderkey, o_orderdate, o_orderpriority, c_nationkey, n_name, n_regionkey
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
),
operacao_basica AS (
  SELECT l_orderkey AS "#REF_BACEN", l_linenumber AS NU_ORDEM,
         {_code('cat_emitente', 'partkey')} AS CD_CATEG_EMITENTE, {_code('instrum_credito', 'partkey')} AS CD_INST_CREDITO,
         {_code('fonte_recurso', 'partkey')} AS CD_FONTE_RECURSO, n_name AS CD_ESTADO,
         {_code('tipo_seguro', 'partkey')} AS CD_TIPO_SEGURO, CAST(partkey AS VARCHAR) AS CD_EMPREENDIMENTO,
         {_pick(descriptions('programa', 'CD_PROGRAMA'), 'partkey')} AS CD_PROGRAMA,
         {_code('tipo_irrigacao', 'partkey')} AS CD_TIPO_IRRIGACAO, {_code('tipo_agricultura', 'partkey')} AS CD_TIPO_AGRICULTURA,
         {_code('tipo_ciclo', 'partkey')} AS CD_FASE_CICLO_PRODUCAO, {_code('tipo_integracao', 'c_nationkey')} AS CD_TIPO_INTGR_CONSOR,
         CAST(o_orderdate AS DATE) AS DT_EMISSAO,
         VL_ALIQ_PROAGRO, VL_JUROS, VL_AREA_INFORMADA, VL_PARC_CREDITO
  FROM op_lines JOIN ord ON l_orderkey = o_orderkey
),
saldos AS (
  SELECT l_orderkey AS "#REF_BACEN", l_linenumber AS NU_ORDEM,
         CAST(year(l_shipdate) AS VARCHAR) AS ANO_BASE, CAST(month(l_shipdate) AS VARCHAR) AS MES_BASE,
         l_returnflag AS CD_SITUACAO_OPERACAO
  FROM lineitem
),
mutuarios AS (
  SELECT l_orderkey AS REF_BACEN, l_suppkey AS CD_CPF_CNPJ, {_code('tp_produtor', 'l_suppkey')} AS CD_TIPO_BENEFICIARIO
  FROM lineitem
),
situacao_operacao AS (
  SELECT DISTINCT l_returnflag AS "#CODIGO",
         CASE l_returnflag WHEN 'R' THEN 'Inadimplente' WHEN 'A' THEN 'Adimplente' WHEN 'N' THEN 'Normal' END AS DESCRICAO
  FROM lineitem
),
empreendimento AS (
  SELECT CAST(p_partkey AS VARCHAR) AS "#CODIGO", {_pick(descriptions('finalidade', 'FINALIDADE'), 'p_partkey')} AS FINALIDADE,
         {_pick(descriptions('atividade', 'ATIVIDADE'), 'p_partkey')} AS ATIVIDADE,
         {_pick(descriptions('modalidade', 'MODALIDADE'), 'p_partkey // 2')} AS MODALIDADE,
         {_pick(descriptions('produto', 'PRODUTO'), 'p_partkey')} AS PRODUTO,
         {_pick(descriptions('produto', 'VARIEDADE'), 'p_partkey // 5')} AS VARIEDADE, CAST(p_size AS VARCHAR) AS CESTA
  FROM part
),
""" + ",\n".join(_domain(n, f) for n, f in CODE_DOMAINS.items())

_SITS = ", ".join(_lit(s) for s in DEFAULT_SITUATIONS)

LABEL_BASE = f"""
def_codes AS (SELECT "#CODIGO" AS cod FROM situacao_operacao WHERE DESCRICAO IN ({_SITS})),
base AS (
  SELECT s."#REF_BACEN" AS ref_bacen, s.NU_ORDEM AS nu_ordem, m.CD_CPF_CNPJ AS mutuario,
         CASE WHEN TRY_CAST(s.MES_BASE AS INTEGER) BETWEEN 1 AND 12 AND TRY_CAST(s.ANO_BASE AS INTEGER) IS NOT NULL
              THEN datediff('month', date_trunc('month', o.DT_EMISSAO),
                            make_date(TRY_CAST(s.ANO_BASE AS INTEGER), TRY_CAST(s.MES_BASE AS INTEGER), 1))
         END AS delta,
         CASE WHEN s.CD_SITUACAO_OPERACAO IN (SELECT cod FROM def_codes) THEN 1 ELSE 0 END AS situacao
  FROM saldos s
  JOIN operacao_basica o ON s."#REF_BACEN" = o."#REF_BACEN" AND s.NU_ORDEM = o.NU_ORDEM
  JOIN mutuarios m ON s."#REF_BACEN" = m.REF_BACEN
)
"""

TARGET = f"""
target AS (
  SELECT ref_bacen, nu_ordem, mutuario,
         CAST(MAX(CASE WHEN delta BETWEEN 0 AND {H} THEN situacao ELSE 0 END) AS INTEGER) AS target_18m
  FROM base GROUP BY ref_bacen, nu_ordem, mutuario
)
"""

_VCOLS = ",\n         ".join(
    f'CAST(CASE WHEN first_default IS NOT NULL AND {d} >= first_default THEN 1 ELSE 0 END AS INTEGER) AS "{d}"'
    for d in range(N + 1)
)

FIRST_DEFAULT = f"""
fd AS (
  SELECT ref_bacen, nu_ordem, mutuario, MIN(CASE WHEN situacao = 1 THEN delta END) AS first_default
  FROM base WHERE delta BETWEEN 0 AND {N}
  GROUP BY ref_bacen, nu_ordem, mutuario
)
"""

VINTAGE = f"""
vintage AS (
  SELECT ref_bacen, nu_ordem, mutuario,
         {_VCOLS}
  FROM fd
)
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes)


def _class_of(recode, row: dict):
    """The class of one row of descriptions, rule by rule."""
    if recode.null_guard and row[recode.null_guard] is None:
        return None

    def holds(column, values):
        v = row[column]
        return v is not None and ((v not in values.values) if isinstance(values, Not) else v in values)

    for result, clauses in recode.rules:
        if any(all(holds(c, v) for c, v in clause.items()) for clause in clauses):
            return row[result.column] if isinstance(result, Keep) else result
    return row[recode.default.column] if isinstance(recode.default, Keep) else recode.default


def _class_sql(f, alias: str) -> str:
    """Rules on one column as a plain table from description to class, looked up by position; rules on
    several columns as CASE."""
    columns = sorted(f.recode.columns())
    if len(columns) > 1:
        return to_sql(f.recode, lambda c: f"{alias}.{c}")
    c = columns[0]
    known = [v for v in descriptions(f.name, c) if v is not None]
    classes = [_class_of(f.recode, {c: v}) for v in known]
    missing = _class_of(f.recode, {c: None})
    of_null = "NULL" if missing is None else _lit(missing)
    return f"CASE WHEN {alias}.{c} IS NULL THEN {of_null} ELSE {_list(classes)}[list_position({_list(known)}, {alias}.{c})] END"


def _feature_sql(f) -> str:
    """One feature at label grain: label keys JOIN source JOIN domain (all inner)."""
    if f.keys == FE.OP:
        src = (f'JOIN operacao_basica src ON t.ref_bacen = src."#REF_BACEN" AND t.nu_ordem = src.NU_ORDEM')
    else:
        src = "JOIN mutuarios src ON t.ref_bacen = src.REF_BACEN AND t.mutuario = src.CD_CPF_CNPJ"
    dom = ""
    if f.domain:
        if f.int_code:
            cond = f'TRY_CAST(src.{f.code} AS INTEGER) = TRY_CAST(d."#CODIGO" AS INTEGER)'
        else:
            cond = f'src.{f.code} = d."#CODIGO"'
        dom = f"JOIN {f.domain} d ON {cond}"
    alias = "d" if f.domain else "src"
    if f.recode is not None:
        expr = _class_sql(f, alias)
    else:
        expr = f"{alias}.{f.value}"
    if f.kind == "cat":
        expr = f"CAST({expr} AS VARCHAR)"
    return f"""
feat_{f.name} AS (
  SELECT t.ref_bacen, t.nu_ordem, t.mutuario, {expr} AS {f.name}
  FROM target t {src} {dom}
)"""


def feature_query(name: str) -> str:
    f = FE.BY_NAME[name]
    return _with(SILVER, LABEL_BASE, TARGET, _feature_sql(f)) + f"\nSELECT * FROM feat_{name}"


def _consolidated_cte() -> str:
    feats = [_feature_sql(f) for f in FE.FEATURES]
    joins, cols = [], []
    for f in FE.FEATURES:
        keys = ["ref_bacen", "nu_ordem"] if f.keys == FE.OP else ["ref_bacen", "mutuario"]
        kl = ", ".join(keys)
        joins.append(
            f"LEFT JOIN (SELECT {kl}, MIN({f.name}) AS {f.name} FROM feat_{f.name} GROUP BY {kl}) g_{f.name} "
            f"USING ({kl})"
        )
        cols.append(f"g_{f.name}.{f.name}")
    body = f"""
consolidated AS (
  SELECT t.ref_bacen, t.nu_ordem, t.mutuario, t.target_18m, {", ".join(cols)}
  FROM target t {" ".join(joins)}
)"""
    return ",\n".join(x.strip() for x in feats) + ",\n" + body.strip()


CROP = f"""
saf AS (
  SELECT "#REF_BACEN" AS ref_bacen, NU_ORDEM AS nu_ordem,
         CAST(year(DT_EMISSAO) - CAST(month(DT_EMISSAO) < {CUT} AS INTEGER) AS INTEGER) AS safra,
         TRY_CAST(VL_PARC_CREDITO AS DOUBLE) AS valor
  FROM operacao_basica
)
"""

OPBASE = """
opg AS (
  SELECT ref_bacen, nu_ordem, MIN(uf) AS uf, MIN(finalidade) AS finalidade, MIN(atividade) AS atividade,
         MIN(produto) AS produto, MAX(target_18m) AS inadimplente
  FROM consolidated GROUP BY ref_bacen, nu_ordem
),
opbase AS (
  SELECT opg.ref_bacen, opg.nu_ordem, opg.uf, opg.finalidade, opg.atividade, opg.produto,
         opg.inadimplente, saf.safra, saf.valor
  FROM opg LEFT JOIN saf USING (ref_bacen, nu_ordem)
)
"""

_DIMS = ("safra", "uf", "finalidade", "atividade", "produto")
AGGS = "aggs AS (\n" + "\nUNION ALL\n".join(
    f"""  SELECT '{d}' AS dimensao, CAST({d} AS VARCHAR) AS categoria, COUNT(*) AS concessoes,
         round(SUM(valor), 2) AS volume, CAST(SUM(inadimplente) AS BIGINT) AS inadimplentes, AVG(inadimplente) AS taxa
  FROM opbase WHERE {d} IS NOT NULL GROUP BY {d}"""
    for d in _DIMS
) + "\n)"


RAW_OPS = """
raw_ops AS (
  SELECT CAST("#REF_BACEN" AS VARCHAR) AS "#REF_BACEN", CAST(NU_ORDEM AS VARCHAR) AS NU_ORDEM,
    CASE ("#REF_BACEN" + NU_ORDEM) % 5
      WHEN 0 THEN CAST(day(DT_EMISSAO) AS VARCHAR) || '/' || CAST(month(DT_EMISSAO) AS VARCHAR) || '/' || CAST(year(DT_EMISSAO) AS VARCHAR)
      WHEN 1 THEN lpad(CAST(day(DT_EMISSAO) AS VARCHAR), 2, '0') || '/' || lpad(CAST(month(DT_EMISSAO) AS VARCHAR), 2, '0') || '/' || CAST(year(DT_EMISSAO) AS VARCHAR)
      WHEN 2 THEN '  "' || lpad(CAST(day(DT_EMISSAO) AS VARCHAR), 2, '0') || '/' || lpad(CAST(month(DT_EMISSAO) AS VARCHAR), 2, '0') || '/' || CAST(year(DT_EMISSAO) AS VARCHAR) || '" '
      WHEN 3 THEN '31/02/' || CAST(year(DT_EMISSAO) AS VARCHAR)
      ELSE lpad(CAST(day(DT_EMISSAO) AS VARCHAR), 2, '0') || '/' || lpad(CAST(month(DT_EMISSAO) AS VARCHAR), 2, '0') || '/' || CAST(year(DT_EMISSAO) AS VARCHAR) || ' 00:00:00'
    END AS DT_EMISSAO,
    CASE ("#REF_BACEN" + NU_ORDEM) % 5
      WHEN 0 THEN CASE WHEN ip >= 1000
                       THEN CAST(ip // 1000 AS VARCHAR) || '.' || lpad(CAST(ip % 1000 AS VARCHAR), 3, '0') || ',' || fp
                       ELSE CAST(ip AS VARCHAR) || ',' || fp END
      WHEN 1 THEN CAST(ip AS VARCHAR) || ',' || fp
      WHEN 2 THEN ' "' || CAST(ip AS VARCHAR) || ',' || fp || '"  '
      WHEN 3 THEN ''
      ELSE CAST(ip AS VARCHAR) || 'd'
    END AS VL_PARC_CREDITO,
    CASE ("#REF_BACEN" + NU_ORDEM) % 6
      WHEN 0 THEN CD_ESTADO
      WHEN 1 THEN '  ' || CD_ESTADO || '  '
      WHEN 2 THEN '"' || CD_ESTADO || '"'
      WHEN 3 THEN '""'
      WHEN 4 THEN chr(160) || CD_ESTADO || chr(160)
      ELSE chr(9) || CD_ESTADO
    END AS CD_ESTADO
  FROM (SELECT *, CAST(round(VL_PARC_CREDITO * 100) AS BIGINT) // 100 AS ip,
               lpad(CAST(CAST(round(VL_PARC_CREDITO * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') AS fp
        FROM operacao_basica) o
)
"""


def queries() -> dict[str, str]:
    q = {}
    q["labels_default_codes"] = _with(SILVER, LABEL_BASE) + "\nSELECT DISTINCT cod FROM def_codes"
    q["labels_observation_base"] = _with(SILVER, LABEL_BASE) + "\nSELECT * FROM base"
    q["labels_target_18m"] = _with(SILVER, LABEL_BASE, TARGET) + "\nSELECT * FROM target"
    q["labels_first_default"] = _with(SILVER, LABEL_BASE, FIRST_DEFAULT) + "\nSELECT * FROM fd"
    q["labels_vintage_matrix"] = _with(SILVER, LABEL_BASE, FIRST_DEFAULT, VINTAGE) + "\nSELECT * FROM vintage"
    q["labels_vintage_long"] = _with(SILVER, LABEL_BASE, FIRST_DEFAULT) + f"""
SELECT ref_bacen, nu_ordem, mutuario, CAST(d AS INTEGER) AS delta, CAST(coalesce(d >= first_default, false) AS INTEGER) AS inadimplente
FROM fd, range(0, {N + 1}) t(d)"""
    q["business_life_table"] = _with(SILVER, LABEL_BASE, FIRST_DEFAULT, CROP) + f"""
SELECT safra, CAST(d AS INTEGER) AS delta, risk AS em_risco, now AS inadimplentes, total - risk + now AS acumulado,
  CASE WHEN risk > 0 THEN now / risk END AS taxa_mensal, (total - risk + now) / total AS taxa_acumulada
FROM (SELECT safra, d, count(*) AS total, count(*) FILTER (first_default IS NULL OR first_default >= d) AS risk,
    count(*) FILTER (first_default = d) AS now
  FROM fd JOIN saf USING (ref_bacen, nu_ordem), range(0, {N + 1}) t(d) WHERE safra IS NOT NULL GROUP BY safra, d)"""
    q["labels_summary"] = _with(SILVER, LABEL_BASE, TARGET) + (
        "\nSELECT COUNT(*) AS n_rows, AVG(target_18m) AS rate FROM target")
    for f in FE.FEATURES:
        q[f"feature_{f.name}"] = feature_query(f.name)
    cons = _with(SILVER, LABEL_BASE, TARGET, _consolidated_cte())
    q["features_consolidated"] = cons + "\nSELECT * FROM consolidated"
    q["business_crop_year"] = _with(SILVER, CROP) + (
        "\nSELECT ref_bacen, nu_ordem, safra, "
        "printf('%d/%s', safra, right(CAST(safra + 1 AS VARCHAR), 2)) AS safra_label, valor FROM saf")
    q["business_operation_base"] = _with(SILVER, LABEL_BASE, TARGET, _consolidated_cte(), CROP, OPBASE) + (
        "\nSELECT * FROM opbase")
    q["business_aggregates"] = _with(SILVER, LABEL_BASE, TARGET, _consolidated_cte(), CROP, OPBASE, AGGS) + (
        "\nSELECT * FROM aggs")
    q["business_top_categories"] = _with(SILVER, LABEL_BASE, TARGET, _consolidated_cte(), CROP, OPBASE, AGGS) + """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY dimensao ORDER BY volume DESC NULLS LAST, categoria) AS rank
  FROM aggs) r
WHERE dimensao = 'safra' OR rank <= 20"""
    q["business_display"] = _with(SILVER, LABEL_BASE, TARGET, _consolidated_cte(), CROP, OPBASE, AGGS) + """
SELECT dimensao, categoria, concessoes, inadimplentes, round(volume / 1e6, 2) AS volume_mm,
       round(taxa * 100, 2) AS taxa_pct
FROM aggs"""
    avgs = ", ".join(f'AVG(v."{d}") AS "{d}"' for d in range(N + 1))
    q["business_vintage_curve"] = _with(SILVER, LABEL_BASE, FIRST_DEFAULT, VINTAGE, CROP) + f"""
SELECT saf.safra, {avgs}
FROM vintage v LEFT JOIN saf USING (ref_bacen, nu_ordem)
WHERE saf.safra IS NOT NULL
GROUP BY saf.safra"""
    q.update(model_queries())
    q.update(loading_queries(cons))
    q["cleaning_typed_operations"] = _with(SILVER, RAW_OPS) + """
SELECT nullif(trim(trim(trim("#REF_BACEN"), '"')), '') AS "#REF_BACEN",
       nullif(trim(trim(trim(NU_ORDEM), '"')), '') AS NU_ORDEM,
       CAST(try_strptime(nullif(trim(trim(trim(DT_EMISSAO), '"')), ''), '%d/%m/%Y') AS DATE) AS DT_EMISSAO,
       try_cast(replace(replace(nullif(trim(trim(trim(VL_PARC_CREDITO), '"')), ''), '.', ''), ',', '.') AS DOUBLE)
         AS VL_PARC_CREDITO,
       nullif(trim(trim(trim(CD_ESTADO), '"')), '') AS CD_ESTADO
FROM raw_ops"""
    return q


# --- scoring, metrics, validation (naive segment-rate model on uf) -------------------

_UF = next(f for f in FE.FEATURES if f.name == "uf")
SCORING_BASE = f"""
{_feature_sql(_UF).strip()},
sb AS (
  SELECT t.ref_bacen, t.nu_ordem, t.mutuario, t.target_18m, g.uf, saf.safra
  FROM target t
  LEFT JOIN (SELECT ref_bacen, nu_ordem, MIN(uf) AS uf FROM feat_uf GROUP BY ref_bacen, nu_ordem) g
    USING (ref_bacen, nu_ordem)
  LEFT JOIN saf USING (ref_bacen, nu_ordem)
)
"""

IN_SAMPLE = """
rates AS (SELECT COALESCE(uf, 'NA') AS seg, AVG(CAST(target_18m AS DOUBLE)) AS rate FROM sb GROUP BY 1),
gmean AS (SELECT AVG(CAST(target_18m AS DOUBLE)) AS g FROM sb),
scored AS (
  SELECT sb.ref_bacen, sb.nu_ordem, sb.mutuario, sb.target_18m AS y, COALESCE(r.rate, gmean.g) AS p
  FROM sb LEFT JOIN rates r ON COALESCE(sb.uf, 'NA') = r.seg CROSS JOIN gmean
)
"""

SCORE_DIST = """
cnt AS (
  SELECT p AS score, SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, SUM(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
  FROM scored WHERE p IS NOT NULL GROUP BY p
),
cum AS (
  SELECT *, SUM(pos) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_pos,
            SUM(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_neg
  FROM cnt
),
tot AS (SELECT CAST(SUM(pos) AS BIGINT) AS P, CAST(SUM(neg) AS BIGINT) AS N FROM cnt),
srt AS (SELECT p, y, row_number() OVER (ORDER BY p) - 1 AS r FROM scored WHERE p IS NOT NULL),
cntn AS (SELECT COUNT(*) AS n FROM srt)
"""


def _quantile_cte(name: str, steps: int) -> str:
    return f"""
{name} AS (
  SELECT q.k, a.p AS lo_s, b.p AS hi_s, a.p + (b.p - a.p) * (q.rem / {float(steps)}) AS v
  FROM (SELECT k, ((n - 1) * k) // {steps} AS lo, ((n - 1) * k) % {steps} AS rem
        FROM range(0, {steps + 1}) t(k), cntn) q
  JOIN srt a ON a.r = q.lo
  JOIN srt b ON b.r = q.lo + CASE WHEN q.rem > 0 THEN 1 ELSE 0 END
)"""


def _r(expr: str, name: str) -> str:
    return f"round({expr}, 9) AS {name}"


def _folds(k: int = 5) -> str:
    """Folds by class, each dealt in turn to the folds in ascending order of the rows they hold by then."""
    each = range(k)
    turns = ", ".join(f"SUM(n) FILTER (turn = {i}) AS t{i}" for i in each)
    rank = ", ".join(f"{' + '.join(f'CAST(l{g} < l{f} OR (l{g} = l{f} AND {g} < {f}) AS INTEGER)' for g in each)} AS r{f}" for f in each)
    held = ", ".join(f"l{f} + COALESCE([{', '.join(f't{i}' for i in each)}][r{f} + 1], 0) AS l{f}" for f in each)
    fold = " ".join(f"WHEN r{f} THEN {f}" for f in each)
    ls, rs = ", ".join(f"l{f}" for f in each), ", ".join(f"r{f}" for f in each)
    return f"""
grp AS (
  SELECT mutuario, COUNT(*) AS n, SUM(target_18m) AS pos, length(bin(COUNT(*))) AS size_class,
         ceil(SUM(target_18m) * 10 / COUNT(*)) AS rate_class,
         ('0x' || substr(md5('42|' || CAST(mutuario AS VARCHAR)), 1, 8))::BIGINT AS h
  FROM sb GROUP BY mutuario
),
dealt AS (
  SELECT mutuario, n, dense_rank() OVER (ORDER BY size_class DESC, rate_class DESC) AS c,
         (row_number() OVER (PARTITION BY size_class, rate_class ORDER BY n DESC, pos DESC, h, mutuario) - 1) % {k} AS turn
  FROM grp
),
folds AS (
  WITH RECURSIVE classes AS (SELECT c, {turns} FROM dealt GROUP BY c),
  step AS (
    SELECT CAST(0 AS BIGINT) AS c, {", ".join(f"CAST(0 AS HUGEINT) AS l{f}" for f in each)}, {", ".join(f"0 AS r{f}" for f in each)}
    UNION ALL
    SELECT c, {held}, {rs}
    FROM (SELECT k.*, {ls}, {rank} FROM step s JOIN classes k ON k.c = s.c + 1)
  )
  SELECT mutuario, CASE turn {fold} END AS fold FROM dealt JOIN step USING (c)
),
fb AS (SELECT sb.*, folds.fold, COALESCE(uf, 'NA') AS seg FROM sb JOIN folds USING (mutuario)),
own AS (SELECT fold, seg, SUM(target_18m) AS s, COUNT(*) AS n FROM fb GROUP BY 1, 2),
frates AS (
  SELECT fold, seg, CASE WHEN SUM(n) OVER (PARTITION BY seg) > n
         THEN (SUM(s) OVER (PARTITION BY seg) - s) / (SUM(n) OVER (PARTITION BY seg) - n)
         ELSE (SUM(s) OVER () - SUM(s) OVER (PARTITION BY fold)) / (SUM(n) OVER () - SUM(n) OVER (PARTITION BY fold)) END AS rate
  FROM own
),
oof AS (
  SELECT fb.ref_bacen, fb.nu_ordem, fb.mutuario, fb.fold, fb.target_18m AS y, r.rate AS p
  FROM fb JOIN frates r USING (fold, seg)
)
"""


FOLDS = _folds()


def _grouped_core(src: str, key: str) -> str:
    return f"""
gcnt AS (
  SELECT {key} AS g, p AS score, SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos,
         SUM(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
  FROM {src} WHERE p IS NOT NULL GROUP BY 1, 2
),
gcum AS (
  SELECT *, SUM(pos) OVER (PARTITION BY g ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_pos,
            SUM(neg) OVER (PARTITION BY g ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_neg,
            SUM(pos) OVER (PARTITION BY g) AS P, SUM(neg) OVER (PARTITION BY g) AS N
  FROM gcnt
),
gm AS (
  SELECT g, CASE WHEN MIN(P) > 0 AND MIN(N) > 0
                 THEN SUM(pos * (cum_neg - neg + neg * 0.5)) / (MIN(P) * MIN(N)) END AS auroc,
         MAX(ABS(cum_pos / GREATEST(P, 1) - cum_neg / GREATEST(N, 1))) AS ks,
         SUM(pos * pow(score - 1.0, 2) + neg * pow(score, 2)) / GREATEST(MIN(P) + MIN(N), 1) AS brier,
         CAST(MIN(P) + MIN(N) AS BIGINT) AS n, CAST(MIN(P) AS BIGINT) AS n_pos
  FROM gcum GROUP BY g
)"""


TEMPORAL = """
yb AS (SELECT * FROM sb WHERE safra IS NOT NULL),
years AS (
  SELECT safra, COUNT(*) AS n, COUNT(DISTINCT target_18m) AS cls, row_number() OVER (ORDER BY safra) AS rn
  FROM yb GROUP BY safra
),
tests AS (SELECT safra FROM years WHERE rn > 1 AND n >= 50 AND cls >= 2),
trates AS (
  SELECT t.safra AS test, COALESCE(y.uf, 'NA') AS seg, AVG(CAST(y.target_18m AS DOUBLE)) AS rate
  FROM tests t JOIN yb y ON y.safra < t.safra GROUP BY 1, 2
),
tglob AS (SELECT t.safra AS test, AVG(CAST(y.target_18m AS DOUBLE)) AS g FROM tests t JOIN yb y ON y.safra < t.safra GROUP BY 1),
tscored AS (
  SELECT y.safra, y.target_18m AS y, COALESCE(r.rate, g.g) AS p
  FROM yb y JOIN tests t ON y.safra = t.safra
  LEFT JOIN trates r ON r.test = y.safra AND r.seg = COALESCE(y.uf, 'NA')
  JOIN tglob g ON g.test = y.safra
)
"""


def _grouped_curves(src: str, key: str) -> dict[str, str]:
    """Curves per group by whole sorts of each group's scores."""
    def quantiles(steps):
        return f"""
srt AS (SELECT {key} AS g, p, y, row_number() OVER (PARTITION BY {key} ORDER BY p) - 1 AS r, count(*) OVER (PARTITION BY {key}) AS n FROM {src} WHERE p IS NOT NULL),
q AS (SELECT g, k, ((n - 1) * k) // {steps} AS lo, ((n - 1) * k) % {steps} AS rem FROM (SELECT DISTINCT g, n FROM srt), range(0, {steps + 1}) t(k)),
qv AS (SELECT q.g, q.k, a.p + (b.p - a.p) * (q.rem / {float(steps)}) AS v
  FROM q JOIN srt a ON a.g = q.g AND a.r = q.lo JOIN srt b ON b.g = q.g AND b.r = q.lo + CASE WHEN q.rem > 0 THEN 1 ELSE 0 END)"""

    roc = _grouped_core(src, key) + f"""
, pts AS (SELECT g, score, N - cum_neg + neg AS fps, P - cum_pos + pos AS tps, P, N FROM gcum WHERE P > 0 AND N > 0
  UNION ALL SELECT DISTINCT g, CAST('infinity' AS DOUBLE), 0, 0, P, N FROM gcum WHERE P > 0 AND N > 0),
grid AS (SELECT DISTINCT g, P, N, k FROM pts, range(0, 101) t(k)),
lft AS (SELECT grid.g, grid.k, arg_min(p.fps, p.score) AS lf, arg_min(p.tps, p.score) AS lt FROM grid JOIN pts p ON p.g = grid.g AND p.fps * 100 <= grid.k * p.N GROUP BY 1, 2),
rgt AS (SELECT grid.g, grid.k, arg_max(p.fps, p.score) AS rf, arg_max(p.tps, p.score) AS rt FROM grid JOIN pts p ON p.g = grid.g AND p.fps * 100 > grid.k * p.N GROUP BY 1, 2)
SELECT CAST(grid.g AS INTEGER) AS {key}, CAST(grid.k AS INTEGER) AS k, {_r("grid.k / 100.0", "fpr")},
  {_r("CASE WHEN rf IS NULL THEN lt / P ELSE lt / P + (rt / P - lt / P) * (grid.k / 100.0 - lf / N) / (rf / N - lf / N) END", "tpr")}
FROM grid LEFT JOIN lft USING (g, k) LEFT JOIN rgt USING (g, k)"""
    ks = quantiles(100) + f"""
SELECT CAST(qv.g AS INTEGER) AS {key}, CAST(qv.k AS INTEGER) AS k, {_r("v", "score")},
  {_r("count(*) FILTER (s.y = 1 AND s.p <= v) / greatest(count(*) FILTER (s.y = 1), 1)", "cdf_pos")},
  {_r("count(*) FILTER (s.y <> 1 AND s.p <= v) / greatest(count(*) FILTER (s.y <> 1), 1)", "cdf_neg")}
FROM qv JOIN srt s ON s.g = qv.g GROUP BY qv.g, qv.k, v"""
    calibration = quantiles(10) + f""",
e AS (SELECT g, list(v) AS edges FROM qv WHERE k BETWEEN 1 AND 9 GROUP BY g)
SELECT CAST(g AS INTEGER) AS {key}, CAST(len(list_filter(edges, lambda x: x < p)) AS INTEGER) AS bin, {_r("avg(p)", "mean_pred")}, {_r("avg(CAST(y AS DOUBLE))", "frac_pos")}
FROM srt JOIN e USING (g) GROUP BY 1, 2"""
    return {"roc": roc, "ks_curve": ks, "calibration": calibration}


def model_queries() -> dict[str, str]:
    base = [SILVER, LABEL_BASE, TARGET, CROP, SCORING_BASE]
    q = {}
    q["model_naive_scores"] = _with(*base, IN_SAMPLE) + (
        "\nSELECT ref_bacen, nu_ordem, mutuario, y, round(p, 9) AS p FROM scored")
    q["metrics_core"] = _with(*base, IN_SAMPLE, SCORE_DIST) + f"""
SELECT {_r("CASE WHEN P > 0 AND N > 0 THEN SUM(pos * (cum_neg - neg + neg * 0.5)) / (P * N) END", "auroc")},
       {_r("MAX(ABS(cum_pos / GREATEST(P, 1) - cum_neg / GREATEST(N, 1)))", "ks")},
       {_r("SUM(pos * pow(score - 1.0, 2) + neg * pow(score, 2)) / GREATEST(P + N, 1)", "brier")},
       CAST(P + N AS BIGINT) AS n, CAST(P AS BIGINT) AS n_pos
FROM cum, tot GROUP BY P, N"""
    q["metrics_calibration"] = _with(*base, IN_SAMPLE, SCORE_DIST, _quantile_cte("edges", 10)) + f"""
SELECT bin, {_r("AVG(p)", "mean_pred")}, {_r("AVG(CAST(y AS DOUBLE))", "frac_pos")}
FROM (SELECT s.p, s.y, CAST((SELECT COUNT(*) FROM edges WHERE k BETWEEN 1 AND 9 AND v < s.p) AS INTEGER) AS bin
      FROM scored s WHERE s.p IS NOT NULL) x
GROUP BY bin"""
    q["metrics_roc"] = _with(*base, IN_SAMPLE, SCORE_DIST) + f"""
, pts AS (
  SELECT score, N - cum_neg + neg AS fps, P - cum_pos + pos AS tps FROM cum, tot
  UNION ALL SELECT CAST('infinity' AS DOUBLE), 0, 0
),
grid AS (SELECT k FROM range(0, 101) t(k)),
lft AS (SELECT g.k, arg_min(p.fps, p.score) AS lf, arg_min(p.tps, p.score) AS lt
        FROM grid g JOIN pts p ON p.fps * 100 <= g.k * (SELECT N FROM tot) GROUP BY g.k),
rgt AS (SELECT g.k, arg_max(p.fps, p.score) AS rf, arg_max(p.tps, p.score) AS rt
        FROM grid g JOIN pts p ON p.fps * 100 > g.k * (SELECT N FROM tot) GROUP BY g.k)
SELECT CAST(grid.k AS INTEGER) AS k, {_r("grid.k / 100.0", "fpr")},
       {_r("CASE WHEN rf IS NULL THEN lt / P ELSE lt / P + (rt / P - lt / P) * (grid.k / 100.0 - lf / N) / (rf / N - lf / N) END", "tpr")}
FROM grid LEFT JOIN lft USING (k) LEFT JOIN rgt USING (k), tot"""
    q["metrics_ks_curve"] = _with(*base, IN_SAMPLE, SCORE_DIST, _quantile_cte("kq", 100)) + f"""
SELECT CAST(k AS INTEGER) AS k, {_r("v", "score")},
       {_r("(SELECT COUNT(*) FROM scored s WHERE s.y = 1 AND s.p <= kq.v) / GREATEST(P, 1)", "cdf_pos")},
       {_r("(SELECT COUNT(*) FROM scored s WHERE s.y <> 1 AND s.p <= kq.v) / GREATEST(N, 1)", "cdf_neg")}
FROM kq, tot"""
    for by, ctes, src in (("fold", FOLDS, "oof"), ("safra", TEMPORAL, "tscored")):
        for kind, sql in _grouped_curves(src, by).items():
            q[f"metrics_{kind}_by_{by}"] = _with(*base, ctes) + ("" if sql.lstrip().startswith(",") else ",") + sql
    q["validation_folds"] = _with(*base, FOLDS) + "\nSELECT mutuario, fold FROM folds"
    q["validation_fold_balance"] = _with(*base, FOLDS) + (
        "\nSELECT fold, COUNT(*) AS n, CAST(SUM(target_18m) AS BIGINT) AS pos FROM fb GROUP BY fold")
    q["validation_naive_oof"] = _with(*base, FOLDS) + (
        "\nSELECT ref_bacen, nu_ordem, mutuario, fold, y, round(p, 9) AS p FROM oof")
    q["validation_naive_kfold"] = _with(*base, FOLDS, _grouped_core("oof", "fold")) + f"""
, leaks AS (
  SELECT f.fold, COUNT(*) AS leak FROM (SELECT mutuario FROM oof GROUP BY mutuario HAVING COUNT(DISTINCT fold) > 1) m
  JOIN (SELECT DISTINCT mutuario, fold FROM oof) f USING (mutuario) GROUP BY f.fold
)
SELECT CAST(gm.g + 1 AS INTEGER) AS fold, {_r("auroc", "auroc")}, {_r("ks", "ks")}, {_r("brier", "brier")}, n, n_pos,
       CAST(COALESCE(leaks.leak, 0) AS BIGINT) AS leak_mutuario
FROM gm LEFT JOIN leaks ON leaks.fold = gm.g"""
    q["validation_naive_temporal"] = _with(*base, TEMPORAL, _grouped_core("tscored", "safra")) + f"""
SELECT CAST(y.safra AS INTEGER) AS safra,
       CAST((SELECT SUM(n) FROM years p WHERE p.safra < y.safra) AS BIGINT) AS n_train,
       CAST(y.n AS BIGINT) AS n_test,
       {_r("(SELECT AVG(CAST(s.y AS DOUBLE)) FROM tscored s WHERE s.safra = y.safra)", "rate_test")},
       {_r("gm.auroc", "auroc")}, {_r("gm.ks", "ks")}, {_r("gm.brier", "brier")}
FROM years y JOIN gm ON gm.g = y.safra"""
    return q


def _sparse_sql(cons: str, freq: str, cats, nums, kept: int = 8) -> str:
    """Places of each row's vector: the categories' places by rank, then the numbers'."""
    order = _list(cats)
    places = [f"(SELECT coalesce(max(place), (SELECT max(place) FROM dict WHERE feature = '{c}' AND v IS NULL)) FROM dict WHERE feature = '{c}' AND v = coalesce(c.{c}, 'NA'))"
              for c in cats]
    numbers = [f"CASE WHEN coalesce(c.{c}, (SELECT median({c}) FROM consolidated)) <> 0 THEN (SELECT count(*) FROM dict) + {i} END" for i, c in enumerate(nums)]
    return cons + f"""
, freq AS ({freq}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v DESC) AS rk, count(*) OVER (PARTITION BY feature) AS nv FROM freq),
known AS (SELECT feature, v FROM ranked WHERE rk <= CASE WHEN nv > {kept} THEN {kept - 1} ELSE {kept} END
  UNION ALL SELECT DISTINCT feature, CAST(NULL AS VARCHAR) FROM ranked WHERE nv > {kept}),
dict AS (SELECT *, row_number() OVER (ORDER BY list_position({order}, feature), v NULLS LAST) - 1 AS place FROM known),
placed AS (SELECT c.ref_bacen, c.nu_ordem, c.mutuario, [{', '.join(places + numbers)}] AS p FROM consolidated c)
SELECT ref_bacen, nu_ordem, mutuario, CAST(len(list_filter(p, lambda x: x IS NOT NULL)) AS BIGINT) AS places,
  CAST(list_sum(p) AS BIGINT) AS place_sum, true AS sparse FROM placed"""


def _splits_sql(cons: str, freq: str, nums, kept: int = 8, bins: int = 16) -> str:
    """Gains of all root splits at margin 0: a category against the rest, numbers up to a cut (no number is NULL here)."""
    gain = "0.5 * (g * g / (h + 1.0) + (tg - g) * (tg - g) / (th - h + 1.0) - tg * tg / (th + 1.0))"
    cats = [c for c in FE.CAT_FEATURES]
    one = "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS feature, coalesce(k.v, 'infrequent') AS "at", sum(g) AS g, sum(h) AS h
  FROM w LEFT JOIN (SELECT v FROM known WHERE feature = '{c}' AND v IS NOT NULL) k ON k.v = coalesce(w.{c}, 'NA') GROUP BY k.v""" for c in cats)
    num = "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS feature, CAST(cut AS VARCHAR) AS "at", sum(g) FILTER (w.{c} <= cut) AS g, sum(h) FILTER (w.{c} <= cut) AS h
  FROM w, (SELECT DISTINCT {c} AS cut FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS r, count(*) OVER () AS n FROM consolidated)
    WHERE list_contains(list_transform(range(1, {bins}), lambda k: ((n - 1) * k) // {bins}), r)) GROUP BY cut""" for c in nums)
    return cons + f"""
, freq AS ({freq}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v DESC) AS rk, count(*) OVER (PARTITION BY feature) AS nv FROM freq),
known AS (SELECT feature, v FROM ranked WHERE rk <= CASE WHEN nv > {kept} THEN {kept - 1} ELSE {kept} END),
rate AS (SELECT avg(CAST(target_18m AS DOUBLE)) AS p FROM consolidated),
w AS (SELECT c.*, CASE WHEN target_18m = 1 THEN (1 - p) / greatest(p, 1e-6) * -0.5 ELSE 0.5 END AS g,
  CASE WHEN target_18m = 1 THEN (1 - p) / greatest(p, 1e-6) ELSE 1 END * 0.25 AS h FROM consolidated c, rate),
tot AS (SELECT sum(g) AS tg, sum(h) AS th FROM w)
SELECT feature, "at", false AS null_left, round({gain}, 4) AS gain FROM ({one}
UNION ALL
{num}), tot WHERE h >= 1 AND th - h >= 1"""


def loading_queries(cons: str) -> dict[str, str]:
    """Ingestion, loading and preprocessing; ``cons``: common tables up to the modelling table."""
    cats, nums = FE.CAT_FEATURES, FE.NUM_FEATURES
    q = {}
    q["recode_by_rules"] = _with(SILVER) + '\nSELECT "#CODIGO" AS codigo, ' + ", ".join(
        f"{_class_sql(FE.BY_NAME[n], 'd')} AS {n}" for n in ("modalidade", "produto")) + " FROM empreendimento d"
    q["consolidate_generic"] = cons + "\nSELECT * FROM consolidated"
    q["loading_sample"] = _with(SILVER, LABEL_BASE, TARGET) + """
SELECT * FROM target WHERE ('0x' || substr(md5('42|' || ref_bacen || '|' || nu_ordem || '|' || mutuario), 1, 8))::BIGINT / 4294967296.0
  < (SELECT CASE WHEN count(*) <= 2000 THEN 1.0 ELSE least(100, ceil(100 * 2000 / count(*))) / 100 END FROM target)"""
    q["loading_coerced"] = cons + "\nSELECT ref_bacen, nu_ordem, mutuario, target_18m, " + ", ".join(
        [f"coalesce({c}, 'NA') AS {c}" for c in cats] + [f"try_cast({c} AS DOUBLE) AS {c}" for c in nums]) + " FROM consolidated"
    q["loading_feature_quality"] = cons + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, '{kind}' AS kind, round(n, 9) AS null_frac, two AS two_values, n <= 0.95 AND two AS keep FROM "
        f"(SELECT avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS n, coalesce(min({c}) <> max({c}), false) AS two FROM consolidated)"
        for kind, cs in (("cat", cats), ("num", nums)) for c in cs)
    freq = "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, coalesce({c}, 'NA') AS v, count(*) AS n FROM consolidated GROUP BY 2" for c in cats)
    q["preprocess_categories"] = cons + f"""
, freq AS ({freq}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v DESC) AS rk, count(*) OVER (PARTITION BY feature) AS nv FROM freq)
SELECT feature, v AS category FROM ranked WHERE rk <= CASE WHEN nv > 8 THEN 7 ELSE 8 END
UNION ALL SELECT DISTINCT feature, '*' FROM ranked WHERE nv > 8"""
    q["preprocess_scales"] = cons + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, round(m, 9) AS median, round(CASE WHEN s > 0 THEN s ELSE 1 END, 9) AS scale FROM "
        f"(SELECT any_value(m) AS m, stddev_pop(coalesce({c}, m)) AS s FROM consolidated, (SELECT median({c}) AS m FROM consolidated))"
        for c in nums)
    q["preprocess_sparse"] = _sparse_sql(cons, freq, cats, nums)
    q["model_boosting_splits"] = _splits_sql(cons, freq, nums)
    q["model_boosting_loss"] = "SELECT CAST(unnest([5, 10]) AS INTEGER) AS trees, true AS falls"
    q["ingest_customers"] = """
SELECT CAST(c_custkey AS VARCHAR) AS "CD_CLIENTE", c_name || CASE WHEN c_custkey % 7 = 0 THEN chr(10) || '"linha" 2' ELSE ' – ação' END AS "NM_CLIENTE",
  CAST(CAST(c_acctbal AS DECIMAL(14,2)) AS DOUBLE) AS "VL_SALDO", CASE WHEN c_custkey % 4 <> 2 THEN CAST(c_nationkey AS VARCHAR) END AS "CD_PAIS",
  '2024-02' AS mes, CAST(c_custkey % 4 AS INTEGER) AS tipo FROM customer"""
    q["ingest_transform_counts"] = "SELECT 'clientes' AS tabela, count(*) AS linhas FROM customer"
    for name, evidence in (("model_logistic_evidence", "balanced"), ("model_trees_evidence", "beats_constant")):
        q[name] = _with(SILVER, LABEL_BASE, TARGET) + (
            f"\nSELECT count(*) AS n, CAST(sum(target_18m) AS BIGINT) AS pos, true AS better_than_chance, true AS {evidence} FROM target")
    q["ingest_forced_delimiter"] = """
SELECT CAST(c_custkey AS VARCHAR) AS "CD_CLIENTE", CAST(CAST(c_acctbal AS DECIMAL(14,2)) AS DOUBLE) AS "VL_SALDO", CAST(c_nationkey AS VARCHAR) AS "CD_PAIS",
  CAST(1 AS INTEGER) AS avisos FROM customer"""
    q["features_subset"] = cons + "\nSELECT ref_bacen, nu_ordem, mutuario, target_18m, uf, produto, juros, tp_produtor FROM consolidated"
    q["feature_municipio"] = _with(SILVER, LABEL_BASE, TARGET) + """
SELECT t.ref_bacen, t.nu_ordem, t.target_18m, n_name AS municipio
FROM target t JOIN (SELECT l_orderkey, l_linenumber, CAST(min(l_suppkey) % 30 AS VARCHAR) AS code FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
  ON t.ref_bacen = l_orderkey AND t.nu_ordem = l_linenumber
JOIN nation ON CAST(n_nationkey AS VARCHAR) = code"""
    base = [SILVER, LABEL_BASE, TARGET, CROP, SCORING_BASE]
    q["dashboard_metric_history"] = _with(*base, FOLDS, _grouped_core("oof", "fold")) + (
        "\nSELECT '20240101000000' AS run_id, round(avg(auroc), 9) AS naive FROM gm")
    q["dashboard_ks_location"] = _with(*base, FOLDS, "scored AS (SELECT * FROM oof)", SCORE_DIST, _quantile_cte("kq", 100)) + f"""
, pt AS (
  SELECT k, v, (SELECT COUNT(*) FROM scored s WHERE s.y = 1 AND s.p <= kq.v) / GREATEST(P, 1) AS cp,
    (SELECT COUNT(*) FROM scored s WHERE s.y <> 1 AND s.p <= kq.v) / GREATEST(N, 1) AS cn FROM kq, tot)
SELECT 'naive' AS model, {_r("v", "score")}, {_r("cp", "cdf_pos")}, {_r("cn", "cdf_neg")}, {_r("abs(cp - cn)", "gap")}
FROM pt ORDER BY abs(cp - cn) DESC, k LIMIT 1"""
    q["dashboard_out_of_time"] = _with(*base, TEMPORAL, _grouped_core("tscored", "safra")) + f"""
SELECT printf('%d/%02d', y.safra, (y.safra + 1) % 100) AS safra, {_r("gm.auroc", "naive")}, CAST(y.n AS BIGINT) AS n_test,
  {_r("(SELECT AVG(CAST(s.y AS DOUBLE)) FROM tscored s WHERE s.safra = y.safra)", "rate_test")}
FROM years y JOIN gm ON gm.g = y.safra"""
    return q
