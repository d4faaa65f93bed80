"""DuckDB SQL oracles for the named queries.

The SQL is assembled from small fragment helpers that mirror the column
functions, over the same parquet views (``events``, ``lineitem``, ...).
Doubles are rounded to 6 places, timestamps rendered as text, counts BIGINT.
"""

from __future__ import annotations

import math
import re

from campo.operators.advice import TEXTS
from campo.plans import queries as Q
from campo.schema import (K_IDEAL, LIMITES, N_IDEAL, NOISE_SD, NPK_SD, P_IDEAL, PH_OPT,
                          PH_SD, TEMP_OPT, TEMP_SD, UMIDADE_OPT, UMIDADE_SD)

TS = "'%Y-%m-%d %H:%M:%S'"
OFFSET_RE = r"'(Z|[+-]\d{2}:?\d{2})$'"


def d(x: float) -> str:
    """A DOUBLE literal (scientific notation is DOUBLE in DuckDB)."""
    return format(float(x), ".17e")


def relu(x):
    return f"(CASE WHEN ({x}) > 0 THEN ({x}) WHEN ({x}) IS NOT NULL THEN {d(0)} END)"


def clip(x, lo, hi):
    return f"(CASE WHEN ({x}) < {d(lo)} THEN {d(lo)} WHEN ({x}) > {d(hi)} THEN {d(hi)} ELSE ({x}) END)"


def bell(x, opt, sd):
    z = f"((CAST({x} AS DOUBLE) - {d(opt)}) / {d(sd)})"
    return f"exp({d(-0.5)} * {z} * {z})"


def md5_hex32(s, start):
    return f"CAST(CAST(('0x' || substr(md5({s}), {start}, 8)) AS BIGINT) AS DOUBLE)"


def noise(key, stream, sd, seed=42):
    s = f"concat_ws('|', '{seed}', CAST({key} AS VARCHAR), '{stream}')"
    u1 = f"(({md5_hex32(s, 1)} + {d(0.5)}) / {d(4294967296.0)})"
    u2 = f"(({md5_hex32(s, 9)} + {d(0.5)}) / {d(4294967296.0)})"
    return f"(sqrt({d(-2.0)} * ln({u1})) * cos({d(2 * math.pi)} * {u2}) * {d(sd)})"


def target_sql(noisy: bool) -> dict:
    def eps(name):
        return noise("id_leitura", name, NOISE_SD[name]) if noisy else d(0)
    fnpk = (f"((({bell('n', N_IDEAL, NPK_SD)}) + ({bell('p', P_IDEAL, NPK_SD)})) "
            f"+ ({bell('k', K_IDEAL, NPK_SD)})) / {d(3)}")
    rend = (f"{d(80)} * {bell('umidade', UMIDADE_OPT, UMIDADE_SD)} * {bell('ph', PH_OPT, PH_SD)}"
            f" * ({fnpk}) * {bell('temperatura', TEMP_OPT, TEMP_SD)}")
    vol = (f"{relu(d(65) + ' - umidade')} * {d(0.8)} + {d(0.15)} * "
           f"{relu('temperatura - ' + d(20))}")
    fert = (f"({relu(d(N_IDEAL) + ' - CAST(n AS DOUBLE)')} + {relu(d(P_IDEAL) + ' - CAST(p AS DOUBLE)')}"
            f" + {relu(d(K_IDEAL) + ' - CAST(k AS DOUBLE)')}) / {d(190)} * {d(100)}")
    return {
        "rendimento": clip(f"{rend} + {eps('rendimento')}", 0, 80),
        "volume_irrigacao": clip(f"{vol} + {eps('volume_irrigacao')}", 0, 40),
        "necessidade_fertilizacao": clip(f"{fert} + {eps('necessidade_fertilizacao')}", 0, 100),
    }


def parse_ts(x):
    return f"TRY_CAST(regexp_replace(trim({x}), {OFFSET_RE}, '') AS TIMESTAMP)"


def deficit(col, ideal):
    return relu(f"({d(ideal)} - CAST({col} AS DOUBLE)) / {d(ideal)}")


NUTRIENT = (f"(CASE WHEN greatest({deficit('n', N_IDEAL)}, {deficit('p', P_IDEAL)}, "
            f"{deficit('k', K_IDEAL)}) IS NULL OR greatest({deficit('n', N_IDEAL)}, "
            f"{deficit('p', P_IDEAL)}, {deficit('k', K_IDEAL)}) <= 0 THEN '' "
            f"WHEN {deficit('n', N_IDEAL)} = greatest({deficit('n', N_IDEAL)}, {deficit('p', P_IDEAL)}, {deficit('k', K_IDEAL)}) THEN 'N' "
            f"WHEN {deficit('p', P_IDEAL)} = greatest({deficit('n', N_IDEAL)}, {deficit('p', P_IDEAL)}, {deficit('k', K_IDEAL)}) THEN 'P' "
            f"WHEN {deficit('k', K_IDEAL)} = greatest({deficit('n', N_IDEAL)}, {deficit('p', P_IDEAL)}, {deficit('k', K_IDEAL)}) THEN 'K' "
            f"ELSE '' END)")

READINGS = f"""
ev AS (SELECT event_id, ts, user_id, event_type, CAST(round(value * {d(100)}) AS BIGINT) AS v, props
       FROM events),
readings AS (
  SELECT event_id AS id_leitura,
         'p' || CAST(user_id % 3 + 1 AS VARCHAR) AS id_pivo,
         {d(20)} + ((7 * v + event_id) % 7000) / {d(100)} AS umidade,
         {d(10)} + ((v + 37 * user_id) % 3000) / {d(100)} AS temperatura,
         CASE WHEN event_id % 97 = 0 THEN NULL
              ELSE {d(4.5)} + ((3 * v + 53 * user_id + event_id) % 400) / {d(100)} END AS ph,
         CAST((v + user_id) % 141 AS INTEGER) AS n,
         CAST((7 * v + event_id) % 146 AS INTEGER) AS p,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_id % 101 = 0 THEN NULL
              WHEN event_type IN ('click', 'purchase', 'signup') AND event_id % 5 = 0 THEN ' on '
              WHEN event_type IN ('click', 'purchase', 'signup') THEN 'ON'
              ELSE 'OFF' END AS estado_bomba,
         CASE WHEN event_id % 89 = 0 THEN 'bad' ELSE strftime(ts, {TS}) END AS capturado_em
  FROM ev),
feat AS (
  SELECT id_leitura, id_pivo, umidade, temperatura, ph, n, p, k, estado_bomba,
         {parse_ts('capturado_em')} AS capturado_em
  FROM readings),
feat2 AS (
  SELECT *, CAST(hour(capturado_em) AS INTEGER) AS hora,
         CAST(isodow(capturado_em) - 1 AS INTEGER) AS dia_semana,
         COALESCE(CAST(upper(trim(estado_bomba)) = 'ON' AS INTEGER), 0) AS estado_bomba_bin
  FROM feat),
prepared AS (
  SELECT *, {target_sql(False)['rendimento']} AS rendimento,
         {target_sql(False)['volume_irrigacao']} AS volume_irrigacao,
         {target_sql(False)['necessidade_fertilizacao']} AS necessidade_fertilizacao
  FROM feat2),
prepared_noise AS (
  SELECT *, {target_sql(True)['rendimento']} AS rendimento,
         {target_sql(True)['volume_irrigacao']} AS volume_irrigacao,
         {target_sql(True)['necessidade_fertilizacao']} AS necessidade_fertilizacao
  FROM feat2)"""


def with_readings(body: str, extra: str = "") -> str:
    return f"WITH {READINGS}{(',' + extra) if extra else ''}\n{body}"


def r6(x):
    # ten places first: a last-bit difference can't decide a tie at six
    return f"round(round({x}, 10), 6)"


# ------------------------------------------------------------------ helpers
def mean_sql(x):
    return f"avg(CAST({x} AS DOUBLE))"


def describe_sql(src, cols):
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS coluna, count(x) AS count, {r6(mean_sql('x'))} AS mean, "
            f"{r6('stddev_samp(x)')} AS std, {r6('min(x)')} AS min, "
            f"{r6('quantile_cont(x, 0.25)')} AS q25, {r6('quantile_cont(x, 0.5)')} AS q50, "
            f"{r6('quantile_cont(x, 0.75)')} AS q75, {r6('max(x)')} AS max "
            f"FROM (SELECT {x} AS x FROM {src} WHERE {c} IS NOT NULL AND NOT isnan({x}))")
    return "\nUNION ALL\n".join(parts)


def corr_sql(src, cols):
    aggs, items = [], []
    k = 0
    for i, a in enumerate(cols):
        for b in cols[i:]:
            xa, xb = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
            sa = f"stddev_pop(CASE WHEN {xb} IS NOT NULL THEN {xa} END)"
            sb = f"stddev_pop(CASE WHEN {xa} IS NOT NULL THEN {xb} END)"
            aggs.append(f"CASE WHEN ({sa}) * ({sb}) = 0 THEN NULL "
                        f"ELSE covar_pop({xa}, {xb}) / (({sa}) * ({sb})) END AS c{k}")
            items.append(f"{{'var_x': '{a}', 'var_y': '{b}', 'corr': c{k}}}")
            if a != b:
                items.append(f"{{'var_x': '{b}', 'var_y': '{a}', 'corr': c{k}}}")
            k += 1
    return (f"SELECT s.var_x AS var_x, s.var_y AS var_y, round(s.corr, 6) AS corr FROM ("
            f"SELECT unnest([{', '.join(items)}]) AS s FROM (SELECT {', '.join(aggs)} FROM {src}))")


def hist_sql(src, col, bins=30):
    x = f"CAST({col} AS DOUBLE)"
    return f"""
hv AS (SELECT {x} AS x FROM {src} WHERE {col} IS NOT NULL AND NOT isnan({x})),
hb AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / {d(bins)} AS w FROM hv),
hc AS (SELECT CAST(CASE WHEN w > 0 THEN least(floor((x - lo) / w), {bins - 1}) ELSE 0 END AS INTEGER) AS bin,
              count(*) AS contagem FROM hv, hb GROUP BY 1),
hg AS (SELECT lo, w, CAST(unnest(range(0, {bins})) AS INTEGER) AS bin FROM hb)""", f"""
SELECT '{col}' AS coluna, hg.bin AS bin, round(lo + hg.bin * w, 6) AS inicio,
       round(lo + (hg.bin + 1) * w, 6) AS fim, COALESCE(hc.contagem, 0) AS contagem
FROM hg LEFT JOIN hc ON hg.bin = hc.bin"""


def box_sql(src, cols):
    ctes, parts = [], []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        ctes.append(f"bv_{c} AS (SELECT {x} AS x FROM {src} WHERE {c} IS NOT NULL AND NOT isnan({x}))")
        ctes.append(f"bq_{c} AS (SELECT q1, med, q3, q3 - q1 AS iqr, q1 - {d(1.5)} * (q3 - q1) AS lo, "
                    f"q3 + {d(1.5)} * (q3 - q1) AS hi FROM (SELECT quantile_cont(x, 0.25) AS q1, "
                    f"quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3 FROM bv_{c}))")
        inner = "(x >= lo AND x <= hi)"
        parts.append(
            f"SELECT '{c}' AS coluna, {r6('q1')} AS q1, {r6('med')} AS mediana, {r6('q3')} AS q3, "
            f"{r6('iqr')} AS iqr, {r6(f'min(CASE WHEN {inner} THEN x END)')} AS bigode_inf, "
            f"{r6(f'max(CASE WHEN {inner} THEN x END)')} AS bigode_sup, "
            f"count(CASE WHEN NOT {inner} THEN 1 END) AS outliers "
            f"FROM bv_{c}, bq_{c} GROUP BY q1, med, q3, iqr")
    return ",\n".join(ctes), "\nUNION ALL\n".join(parts)


def advice_items(src, vol="volume_irrigacao", fert="necessidade_fertilizacao",
                 rend="rendimento", ph="ph"):
    """Rows (id_leitura, ord, code, value, detail) of the R05 rules, unfired rules as NULL code."""
    return f"""
SELECT id_leitura, 1 AS ord, CASE WHEN {vol} > 5 THEN 'IRRIGAR' WHEN {vol} <= 1 THEN 'SOLO_ADEQUADO'
       WHEN {vol} IS NOT NULL THEN 'IRRIGACAO_LEVE' END AS code, {vol} AS value, CAST(NULL AS VARCHAR) AS detail FROM {src}
UNION ALL
SELECT id_leitura, 2, CASE WHEN {fert} > 50 THEN 'ADUBAR' END, {fert},
       CASE WHEN {NUTRIENT} <> '' THEN {NUTRIENT} END FROM {src}
UNION ALL
SELECT id_leitura, 3, CASE WHEN {rend} < 40 THEN 'RENDIMENTO_BAIXO' END, {rend}, NULL FROM {src}
UNION ALL
SELECT id_leitura, 4, CASE WHEN {ph} < 6 THEN 'PH_ACIDO' WHEN {ph} > 7 THEN 'PH_ALCALINO' END, {ph}, NULL FROM {src}"""


def positioned(items_cte):
    return (f"SELECT id_leitura, CAST(row_number() OVER (PARTITION BY id_leitura ORDER BY ord) - 1 AS INTEGER) "
            f"AS posicao, code, round(value, 6) AS value, detail FROM {items_cte} WHERE code IS NOT NULL")


def text_sql(template):
    """An advice text with its value to a fixed number of places (halves of the
    shortest decimal form up) and its detail."""
    parts = []
    for piece in re.split(r"(\{[^}]*\})", template):
        if piece == "{d}":
            parts.append("detail")
        elif piece.startswith("{"):
            places = piece[4]
            parts.append(f"CAST(CAST(round(CAST(CAST(value AS VARCHAR) AS DECIMAL(38, 20)), {places}) AS DECIMAL(38, {places})) AS VARCHAR)")
        elif piece:
            parts.append("'" + piece.replace("'", "''") + "'")
    return " || ".join(parts)


QUALITY_RULES = (
    [(f"{c}_ausente", f"{c} IS NULL") for c in ("temperatura", "n", "p", "k")]
    + [(f"{c}_fora_da_faixa",
        f"(isnan(CAST({c} AS DOUBLE)) OR {c} < {d(lo)} OR {c} > {d(hi)})")
       for c, (lo, hi) in LIMITES.items()]
    + [("id_pivo_invalido", "NOT COALESCE(lower(trim(id_pivo)) IN ('p1', 'p2', 'p3'), false)"),
       ("capturado_em_invalido", f"(capturado_em IS NOT NULL AND {parse_ts('capturado_em')} IS NULL)")]
)


# ------------------------------------------------------------------ oracles
PUMP_ON_AVG = "avg(CAST(COALESCE(upper(estado_bomba) = 'ON', false) AS DOUBLE))"


def _build() -> dict[str, str]:
    o: dict[str, str] = {}
    T = target_sql

    o["advice_by_pivot"] = with_readings(
        "SELECT p.id_pivo, i.code, count(*) AS ocorrencias FROM items i JOIN prepared p USING (id_leitura) "
        "WHERE i.code IS NOT NULL GROUP BY p.id_pivo, i.code",
        f"items AS ({advice_items('prepared')})")

    o["features_time_pump"] = with_readings(
        f"SELECT id_leitura, strftime(capturado_em, {TS}) AS capturado_em, hora, dia_semana, "
        f"estado_bomba_bin FROM feat2")

    o["pump_lenient"] = with_readings(
        "SELECT id_leitura, estado_bomba, COALESCE(CAST(upper(trim(estado_bomba)) IN "
        "('ON', '1', 'TRUE', 'LIGADA') AS INTEGER), 0) AS bomba_leniente FROM readings")

    o["time_defaults"] = with_readings(
        "SELECT id_leitura, capturado_em, COALESCE(hora, CAST(hour(t) AS INTEGER), 12) AS hora, "
        "COALESCE(CAST(isodow(t) - 1 AS INTEGER), 0) AS dia_semana "
        f"FROM (SELECT *, {parse_ts('capturado_em')} AS t FROM tv)",
        "tv AS (SELECT id_leitura, CASE WHEN id_pivo = 'p1' THEN replace(capturado_em, ' ', 'T') || '-03:00' "
        "WHEN id_pivo = 'p2' THEN replace(capturado_em, ' ', 'T') || 'Z' ELSE capturado_em END AS capturado_em, "
        "CAST(CASE WHEN estado_bomba = 'OFF' THEN k % 24 END AS INTEGER) AS hora FROM readings)")

    onehot = with_readings(
        "SELECT id_leitura, id_pivo, " + ", ".join(
            f"CAST(lower(trim(id_pivo)) = '{v}' AS INTEGER) AS id_pivo_{v}" for v in ("p1", "p2", "p3"))
        + " FROM readings")
    o["onehot_pivot"] = onehot
    o["onehot_observed"] = onehot

    cols3 = ["rendimento", "volume_irrigacao", "necessidade_fertilizacao"]
    o["targets_clean"] = with_readings(
        "SELECT id_leitura, " + ", ".join(f"{r6(c)} AS {c}" for c in cols3) + " FROM prepared")
    o["targets_noise"] = with_readings(
        "SELECT id_leitura, " + ", ".join(f"{r6(c)} AS {c}" for c in cols3) + " FROM prepared_noise")

    o["period_of_day"] = with_readings(
        "SELECT id_leitura, hora, CASE WHEN hora BETWEEN 6 AND 11 THEN 'manhã' "
        "WHEN hora BETWEEN 12 AND 17 THEN 'tarde' WHEN hora IS NOT NULL THEN 'noite' END AS periodo FROM feat2")

    good = f"(umidade BETWEEN {d(55)} AND {d(70)} AND ph BETWEEN {d(6)} AND {d(7)})"
    bad = f"(umidade < {d(40)} OR ph < {d(4.5)})"
    o["cohort_yield"] = with_readings(
        f"SELECT {r6(f'avg(CASE WHEN {good} THEN rendimento END)')} AS media_solo_bom, "
        f"{r6(f'avg(CASE WHEN {bad} THEN rendimento END)')} AS media_solo_ruim, "
        f"count(CASE WHEN {good} THEN 1 END) AS n_solo_bom, "
        f"count(CASE WHEN {bad} THEN 1 END) AS n_solo_ruim FROM prepared")

    any_bad = " OR ".join(f"COALESCE({cond}, false)" for _, cond in QUALITY_RULES)
    o["quality_split"] = with_readings(
        "\nUNION ALL\n".join(
            [f"SELECT '{name}' AS motivo, count(*) AS leituras FROM readings WHERE {cond} HAVING count(*) > 0"
             for name, cond in QUALITY_RULES]
            + [f"SELECT 'valida' AS motivo, count(*) AS leituras FROM readings WHERE NOT ({any_bad}) "
               f"HAVING count(*) > 0"]))

    o["fill_defaults"] = with_readings(
        f"SELECT id_leitura, {r6(f'COALESCE(umidade, {d(60)})')} AS umidade, "
        f"{r6(f'COALESCE(ph, {d(6.5)})')} AS ph, COALESCE(hora, 12) AS hora, "
        f"COALESCE(dia_semana, 0) AS dia_semana FROM prepared")

    o["pivot_filter"] = with_readings(
        "SELECT id_leitura, id_pivo, umidade FROM readings WHERE id_pivo = 'p2'")

    o["ordered_head"] = with_readings(
        f"SELECT id_leitura, id_pivo, strftime(capturado_em, {TS}) AS capturado_em, umidade FROM feat "
        f"ORDER BY feat.capturado_em ASC NULLS LAST, id_leitura ASC LIMIT {Q.HEAD_N}")
    o["latest_n"] = with_readings(
        f"SELECT id_leitura, id_pivo, strftime(capturado_em, {TS}) AS capturado_em, umidade FROM feat "
        f"ORDER BY feat.capturado_em DESC NULLS LAST, id_leitura DESC LIMIT {Q.LATEST_N}")
    o["row_count"] = with_readings("SELECT count(*) AS linhas FROM readings")

    o["kpis"] = with_readings(
        f"SELECT {r6(mean_sql('umidade'))} AS umidade_media, "
        f"{r6(mean_sql('temperatura'))} AS temperatura_media, "
        f"{r6(mean_sql('ph'))} AS ph_medio, "
        f"{r6(PUMP_ON_AVG)} AS bomba_ligada "
        f"FROM readings")
    o["npk_means"] = with_readings("\nUNION ALL\n".join(
        f"SELECT '{c}' AS nutriente, {r6(f'avg({c})')} AS valor FROM readings" for c in "npk"))
    o["pump_counts"] = with_readings(
        "SELECT CASE WHEN s = '1' THEN 'ON' WHEN s = '0' THEN 'OFF' ELSE s END AS estado, "
        "count(*) AS contagem FROM (SELECT upper(COALESCE(estado_bomba, 'nan')) AS s FROM readings) GROUP BY 1")

    o["describe_readings"] = with_readings(describe_sql("prepared", Q.PROCESSED_NUMERIC))
    o["describe_stored"] = with_readings("\nUNION ALL\n".join(
        f"SELECT id_pivo, '{c}' AS coluna, count(x) AS count, {r6(mean_sql('x'))} AS mean, {r6('stddev_samp(x)')} AS std, "
        f"{r6('min(x)')} AS min, {r6('max(x)')} AS max, CASE WHEN count(x) > 0 THEN true END AS quartis_certos "
        f"FROM (SELECT id_pivo, CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END AS x FROM prepared) GROUP BY id_pivo"
        for c in Q.PROCESSED_NUMERIC))
    o["describe_lineitem"] = describe_sql("lineitem", Q.LINEITEM_NUMERIC)

    rcols = ["id_pivo", "umidade", "temperatura", "ph", "n", "p", "k", "estado_bomba", "capturado_em"]

    def miss(c):
        if c in ("umidade", "temperatura", "ph"):
            return f"{c} IS NULL OR isnan({c})"
        return f"{c} IS NULL"
    o["null_counts"] = with_readings("\nUNION ALL\n".join(
        f"SELECT '{c}' AS coluna, count(*) FILTER (WHERE {miss(c)}) AS nulos FROM readings" for c in rcols))

    o["pivots"] = with_readings("SELECT DISTINCT id_pivo AS valor FROM readings WHERE id_pivo IS NOT NULL")
    o["time_span"] = with_readings(
        f"SELECT strftime(min(capturado_em), {TS}) AS inicio, strftime(max(capturado_em), {TS}) AS fim FROM feat")

    o["shape_readings"] = with_readings(
        "SELECT count(*) AS linhas, 10 AS colunas, 'id_leitura:bigint,id_pivo:string,umidade:double,"
        "temperatura:double,ph:double,n:int,p:int,k:int,estado_bomba:string,capturado_em:string' AS tipos "
        "FROM readings")
    o["series_buckets"] = with_readings("\nUNION ALL\n".join(
        f"SELECT strftime(date_trunc('hour', capturado_em), {TS}) AS periodo, '{c}' AS variavel, "
        f"{r6(f'avg({c})')} AS valor FROM feat WHERE capturado_em IS NOT NULL GROUP BY 1"
        for c in ("umidade", "temperatura")))
    o["corr_readings"] = with_readings(corr_sql("prepared", Q.PROCESSED_NUMERIC))
    o["corr_lineitem"] = corr_sql("lineitem", Q.LINEITEM_NUMERIC)

    ctes, body = hist_sql("readings", "ph")
    o["hist_ph"] = with_readings(body, ctes.strip())
    ctes, body = hist_sql("prepared_noise", "volume_irrigacao")
    o["hist_volume"] = with_readings(body, ctes.strip())

    ctes, body = box_sql("readings", Q.READING_STATS)
    o["box_sensors"] = with_readings(body, ctes)

    o["ph_band"] = with_readings(
        f"SELECT {r6(f'avg(CAST(ph BETWEEN {d(6)} AND {d(7)} AS DOUBLE))')} AS fracao_faixa_boa, "
        f"count(ph) AS leituras_ph FROM readings")

    clean_t = T(False)
    pairs = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS alvo, {t} AS y, {clean_t[t]} AS y_hat FROM prepared_noise" for t in cols3)
    o["regression_metrics"] = with_readings(
        f"SELECT alvo, count(e) AS n, {r6('avg(abs(e))')} AS mae, {r6('avg(e * e)')} AS mse, "
        f"{r6('sqrt(avg(e * e))')} AS rmse, "
        f"{r6(f'CASE WHEN count(e) = 0 THEN NULL WHEN var_pop(yy) * count(e) = 0 THEN (CASE WHEN sum(e * e) = 0 THEN {d(1)} ELSE {d(0)} END) ELSE {d(1)} - sum(e * e) / (var_pop(yy) * count(e)) END')} AS r2 "
        f"FROM (SELECT alvo, CASE WHEN y IS NOT NULL AND y_hat IS NOT NULL THEN y - y_hat END AS e, "
        f"CASE WHEN y IS NOT NULL AND y_hat IS NOT NULL THEN y END AS yy FROM pairs) GROUP BY alvo",
        f"pairs AS ({pairs})")

    o["yield_trend"] = with_readings(
        f"SELECT strftime(date_trunc('day', capturado_em), {TS}) AS periodo, {r6('avg(rendimento)')} AS media, "
        f"count(*) AS leituras FROM prepared WHERE capturado_em IS NOT NULL GROUP BY 1")
    o["yield_by_pivot"] = with_readings(
        f"SELECT id_pivo, {r6('avg(rendimento)')} AS rendimento_medio, "
        f"{r6('avg(volume_irrigacao)')} AS volume_irrigacao_medio, count(*) AS leituras "
        f"FROM prepared_noise GROUP BY id_pivo")
    o["series_long"] = with_readings("\nUNION ALL\n".join(
        f"SELECT id_leitura, strftime(capturado_em, {TS}) AS capturado_em, '{c}' AS variavel, "
        f"{r6(c)} AS valor FROM feat WHERE capturado_em IS NOT NULL" for c in ("umidade", "temperatura")))
    o["scatter_points"] = with_readings(
        f"SELECT id_leitura, {r6('umidade')} AS umidade, {r6('temperatura')} AS temperatura, "
        f"estado_bomba AS cor FROM readings")

    bucket = (f"CAST(CAST(('0x' || substr(md5(concat_ws('|', '42', CAST(id_leitura AS VARCHAR))), 1, 8)) "
              f"AS BIGINT) % 100 AS INTEGER)")
    o["split_buckets"] = with_readings(
        "SELECT CASE WHEN b < 80 THEN 'treino' ELSE 'teste' END AS conjunto, "
        "CASE WHEN b < 80 THEN CAST(b % 5 AS INTEGER) END AS fold, count(*) AS linhas "
        f"FROM (SELECT {bucket} AS b FROM readings) GROUP BY 1, 2")
    o["fixed_sample"] = with_readings(
        "SELECT id_leitura, id_pivo FROM readings ORDER BY md5(concat_ws('|', '42', CAST(id_leitura AS VARCHAR))), "
        f"id_leitura LIMIT {Q.SAMPLE_N}")
    o["stub_predictions"] = with_readings(
        "SELECT id_leitura, " + ", ".join(f"{d(0)} AS pred_{t}" for t in
                                          ["rendimento", "volume_irrigacao", "necessidade_fertilizacao",
                                           "umidade", "ph"])
        + ", 'stub' AS fonte_modelo FROM readings")

    train = f"tr AS (SELECT umidade AS x, volume_irrigacao AS y, {bucket.replace('id_leitura', 'prepared.id_leitura')} AS b, id_leitura FROM prepared)"
    line = """
sums AS (SELECT avg(x) AS xm, avg(y) AS ym, regr_sxy(y, x) AS sxy, regr_sxx(y, x) AS sxx FROM tr WHERE b < 80),
lines AS (SELECT modelo, sxy / (sxx + alpha) AS a, ym - sxy / (sxx + alpha) * xm AS c
          FROM sums, (SELECT 'linear_regression' AS modelo, CAST(0 AS DOUBLE) AS alpha UNION ALL SELECT 'ridge', CAST(10 AS DOUBLE))),
pts AS (SELECT modelo, a, c, id_leitura, y, a * x + c AS yhat FROM tr, lines WHERE b >= 80)"""
    o["fit_one_feature"] = with_readings(
        f"SELECT modelo, {r6('a')} AS inclinacao, {r6('c')} AS intercepto, count(*) AS n_teste, {r6('avg(abs(y - yhat))')} AS mae, "
        f"{r6('avg((y - yhat) * (y - yhat))')} AS mse, {r6('sqrt(avg((y - yhat) * (y - yhat)))')} AS rmse, "
        f"{r6('1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*))')} AS r2 FROM pts GROUP BY modelo, a, c", f"{train}, {line}")
    o["one_feature_points"] = with_readings(
        f"SELECT id_leitura, {r6('y')} AS real, {r6('yhat')} AS previsto, {r6('y - yhat')} AS residuo FROM pts "
        "WHERE modelo = 'linear_regression'", f"{train}, {line}")
    part = "CASE WHEN b < 80 THEN CAST(b % 5 AS INTEGER) ELSE -1 END AS parte"
    pairs = " UNION ALL ".join(
        f"SELECT parte, '{a}' AS var_x, '{b}' AS var_y, count(*) AS n, {r6(f'avg({a})')} AS media_x, {r6(f'covar_pop({a}, {b})')} AS cov "
        "FROM mo GROUP BY parte" for a in Q.MOMENT_COLUMNS for b in Q.MOMENT_COLUMNS)
    o["linear_moments"] = with_readings(
        pairs, f"mo AS (SELECT {', '.join(Q.MOMENT_COLUMNS)}, {part} FROM (SELECT *, {bucket.replace('id_leitura', 'prepared.id_leitura')} AS b "
        f"FROM prepared) WHERE {' AND '.join(f'{c} IS NOT NULL' for c in Q.MOMENT_COLUMNS)})")
    o["cv_one_feature"] = with_readings(
        f"SELECT alpha, {r6('avg(r2)')} AS cv_r2 FROM (SELECT alpha, f, 1 - sum((y - a * x - c) * (y - a * x - c)) / (var_pop(y) * count(*)) AS r2 "
        "FROM fits JOIN tr ON tr.b < 80 AND tr.b % 5 = f GROUP BY alpha, f) GROUP BY alpha",
        train + """,
fits AS (SELECT alpha, f, sxy / (sxx + alpha) AS a, ym - sxy / (sxx + alpha) * xm AS c FROM (
    SELECT f, avg(x) AS xm, avg(y) AS ym, regr_sxy(y, x) AS sxy, regr_sxx(y, x) AS sxx FROM tr, range(5) AS folds(f) WHERE b < 80 AND b % 5 <> f GROUP BY f),
  (SELECT unnest([0.0, 0.1, 1.0, 10.0])::DOUBLE AS alpha))""")
    o["stream_ingest"] = with_readings(
        f"SELECT id_leitura, id_pivo, umidade, strftime(capturado_em, {TS}) AS capturado_em FROM feat")
    spoilt = """
spoilt AS (SELECT * REPLACE (
  CASE WHEN id_leitura % 31 = 0 THEN NULL WHEN id_leitura % 37 = 0 THEN 'p9' WHEN id_leitura % 41 = 0 THEN ' P2 ' ELSE id_pivo END AS id_pivo,
  CASE WHEN id_leitura % 43 = 0 THEN 101.5 WHEN id_leitura % 47 = 0 THEN CAST('NaN' AS DOUBLE) ELSE umidade END AS umidade,
  CASE WHEN id_leitura % 53 = 0 THEN -11.0 WHEN id_leitura % 59 = 0 THEN NULL ELSE temperatura END AS temperatura,
  CASE WHEN id_leitura % 61 = 0 THEN 14.5 ELSE ph END AS ph,
  CASE WHEN id_leitura % 67 = 0 THEN NULL WHEN id_leitura % 71 = 0 THEN 201 ELSE n END AS n,
  CASE WHEN id_leitura % 73 = 0 THEN NULL WHEN id_leitura % 79 = 0 THEN -1 ELSE p END AS p,
  CASE WHEN id_leitura % 83 = 0 THEN NULL WHEN id_leitura % 103 = 0 THEN 500 ELSE k END AS k,
  CASE WHEN id_leitura % 11 = 0 THEN '1' WHEN id_leitura % 13 = 0 THEN 'true' WHEN id_leitura % 17 = 0 THEN ' Ligada' ELSE estado_bomba END AS estado_bomba)
  FROM readings)"""
    limits = {"temperatura": (-10, 60), "n": (0, 200), "p": (0, 200), "k": (0, 200), "umidade": (0, 100), "ph": (0, 14)}
    reasons = [(f"{c}_ausente", f"{c} IS NULL") for c in ("temperatura", "n", "p", "k")]
    reasons += [(f"{c}_fora_da_faixa", f"(isnan(CAST({c} AS DOUBLE)) OR {c} < {lo} OR {c} > {hi})") for c, (lo, hi) in limits.items()]
    reasons += [("id_pivo_invalido", "NOT coalesce(lower(trim(id_pivo)) IN ('p1', 'p2', 'p3'), FALSE)"),
                ("capturado_em_invalido", f"capturado_em IS NOT NULL AND {parse_ts('capturado_em')} IS NULL")]
    listed = " UNION ALL ".join(f"SELECT id_leitura, '{k}' AS motivo FROM spoilt WHERE {w}" for k, w in reasons)
    o["quality_split_dirty"] = with_readings(
        "SELECT coalesce(r.motivo, 'valida') AS motivo, count(*) AS leituras FROM spoilt s "
        "LEFT JOIN why r ON r.id_leitura = s.id_leitura GROUP BY 1", f"{spoilt}, why AS ({listed})")
    zero = lambda c: f"round(coalesce(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, 0), 6) AS {c}"
    dummies = ", ".join(f"CAST(coalesce(lower(trim(id_pivo)) = 'p{i}', FALSE) AS INTEGER) AS id_pivo_p{i}" for i in (1, 2, 3))
    o["spoilt_flags"] = with_readings(
        f"SELECT id_leitura, coalesce(id_pivo, 'p1') AS id_pivo, {dummies}, "
        "CAST(coalesce(upper(trim(estado_bomba)) IN ('ON', '1', 'TRUE', 'LIGADA'), FALSE) AS INTEGER) AS bomba, "
        f"{zero('umidade')}, {zero('temperatura')}, {zero('ph')}, coalesce(n, 0) AS n, coalesce(p, 0) AS p, coalesce(k, 0) AS k "
        "FROM spoilt", spoilt)
    o["advice_full"] = with_readings(positioned("items"), f"items AS ({advice_items('prepared')})")

    serv = f"""
SELECT id_leitura, 1 AS ord, CASE WHEN volume_irrigacao > 5 THEN 'SERV_IRRIGAR' END AS code,
       volume_irrigacao AS value, CAST(NULL AS VARCHAR) AS detail FROM prepared
UNION ALL SELECT id_leitura, 2, CASE WHEN necessidade_fertilizacao > 50 THEN 'SERV_ADUBAR' END,
       necessidade_fertilizacao, NULL FROM prepared
UNION ALL SELECT id_leitura, 3, CASE WHEN umidade < 55 THEN 'SERV_UMIDADE_BAIXA' END, umidade, NULL FROM prepared
UNION ALL SELECT id_leitura, 4, CASE WHEN ph < 6 OR ph > 7 THEN 'SERV_PH_FORA' END, ph, NULL FROM prepared"""
    o["advice_service"] = with_readings(
        positioned("allitems"),
        f"sitems AS ({serv}),\nallitems AS (SELECT * FROM sitems UNION ALL "
        "SELECT id_leitura, 0, 'SERV_MANTER', CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR) FROM prepared p "
        "WHERE NOT EXISTS (SELECT 1 FROM sitems s WHERE s.id_leitura = p.id_leitura AND s.code IS NOT NULL))")

    dash_src = ("dsrc AS (SELECT *, CASE WHEN estado_bomba_bin = 0 THEN volume_irrigacao END AS vol_prev "
                "FROM prepared)")
    fb = """
SELECT id_leitura, 1 AS ord, CASE WHEN vol_prev > 5 THEN 'PAINEL_IRRIGAR'
       WHEN vol_prev IS NOT NULL THEN 'PAINEL_UMIDADE_OK' END AS code,
       CASE WHEN vol_prev > 5 THEN vol_prev END AS value, CAST(NULL AS VARCHAR) AS detail FROM nomain
UNION ALL SELECT id_leitura, 2, CASE WHEN necessidade_fertilizacao > 50 THEN 'PAINEL_FERT_ALTA'
       WHEN necessidade_fertilizacao > 20 THEN 'PAINEL_FERT_MODERADA'
       WHEN necessidade_fertilizacao IS NOT NULL THEN 'PAINEL_NUTRICAO_OK' END,
       CASE WHEN necessidade_fertilizacao > 20 THEN necessidade_fertilizacao END, NULL FROM nomain
UNION ALL SELECT id_leitura, 3, CASE WHEN rendimento IS NOT NULL THEN 'PAINEL_RENDIMENTO' END,
       rendimento, NULL FROM nomain"""
    o["advice_dashboard"] = with_readings(
        positioned("allitems"),
        f"{dash_src},\nmitems AS ({advice_items('dsrc', vol='vol_prev')}),\n"
        "nomain AS (SELECT * FROM dsrc d WHERE NOT EXISTS (SELECT 1 FROM mitems m WHERE m.id_leitura = d.id_leitura "
        "AND m.code IS NOT NULL)),\n"
        f"fitems AS ({fb}),\n"
        "allitems AS (SELECT * FROM mitems UNION ALL SELECT * FROM fitems UNION ALL "
        "SELECT id_leitura, 0, 'PAINEL_SEM_PREVISAO', CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR) FROM nomain n "
        "WHERE NOT EXISTS (SELECT 1 FROM fitems f WHERE f.id_leitura = n.id_leitura AND f.code IS NOT NULL))")

    o["advice_volume"] = with_readings(
        "SELECT p.id_pivo, CAST(CAST(p.capturado_em AS DATE) AS VARCHAR) AS dia, i.code, count(*) AS ocorrencias "
        "FROM items i JOIN prepared p USING (id_leitura) WHERE i.code IS NOT NULL GROUP BY 1, 2, 3",
        f"items AS ({advice_items('prepared')})")

    o["nutrient_argmax"] = with_readings(
        f"SELECT id_leitura, {r6(deficit('n', N_IDEAL))} AS deficit_n, {r6(deficit('p', P_IDEAL))} AS deficit_p, "
        f"{r6(deficit('k', K_IDEAL))} AS deficit_k, {NUTRIENT} AS nutriente FROM readings")

    o["stream_trend"] = with_readings(
        f"SELECT id_pivo, strftime(dia, {TS}) AS periodo, {r6('avg(rendimento)')} AS media, count(*) AS leituras "
        "FROM (SELECT *, date_trunc('day', capturado_em) AS dia FROM prepared WHERE capturado_em IS NOT NULL) "
        "WHERE dia + INTERVAL 1 DAY <= (SELECT max(capturado_em) - INTERVAL 1 DAY FROM prepared) GROUP BY id_pivo, dia")
    o["csv_strict"] = with_readings(
        f"SELECT id_pivo, {r6('umidade')} AS umidade, {r6('temperatura')} AS temperatura, {r6('ph')} AS ph, n, p, k, estado_bomba, "
        "capturado_em FROM readings WHERE ph IS NOT NULL")
    cells = {"umidade": "id_leitura % 43 = 0", "n": "id_leitura % 71 = 0", "k": "id_leitura % 103 = 0", "ph": "ph IS NULL"}
    whole = " AND ".join(f"NOT ({w})" for w in cells.values())
    spoilt_cells = f"SELECT 'valida' AS motivo, count(*) AS linhas FROM readings WHERE {whole} HAVING count(*) > 0" + "".join(
        f" UNION ALL SELECT '{c}', count(*) FROM readings WHERE {w} HAVING count(*) > 0" for c, w in cells.items())
    o["csv_quarantine"] = with_readings(spoilt_cells)
    o["stream_csv"] = with_readings(f"{spoilt_cells} UNION ALL SELECT 'acumulado', count(*) FROM readings WHERE {whole}")
    o["processed_roundtrip"] = with_readings(" UNION ALL ".join(
        f"SELECT '{f}' AS forma, id_leitura, estado_bomba, {r6('ph')} AS ph, k, hora, estado_bomba_bin, strftime(capturado_em, {TS}) AS capturado_em, "
        f"{r6('rendimento')} AS rendimento, {r6('necessidade_fertilizacao')} AS necessidade_fertilizacao FROM prepared" for f in ("parquet", "csv")))
    o["source_fallback"] = with_readings(
        "SELECT id_pivo, 'csv:/cheio' AS fonte, count(*) AS linhas, count(capturado_em) AS com_hora, "
        f"{r6('avg(umidade)')} AS umidade_media, CAST(sum(k) AS BIGINT) AS k_total FROM feat GROUP BY id_pivo")
    o["table_loads"] = with_readings(
        f"SELECT id_pivo, count(*) AS linhas, count(*) AS chaves, {r6('avg(umidade)')} AS umidade_media, "
        f"strftime(max(capturado_em), {TS}) AS ultima, count(*) AS escritas FROM feat GROUP BY id_pivo")
    fitted = ", ".join(
        f"({r6(f'a_{t} * umidade + c_{t}')}) AS pred_{t}" for t in Q.STORED_TARGETS)
    sums = ", ".join(f"regr_slope({t}, umidade) AS a_{t}, regr_intercept({t}, umidade) AS c_{t}" for t in Q.STORED_TARGETS)
    o["stored_model_stream"] = with_readings(
        "SELECT id_leitura, pred_volume_irrigacao, pred_rendimento, CAST(1 + CAST(pred_rendimento < 40 AS INTEGER) "
        "+ coalesce(CAST(ph < 6 OR ph > 7 AS INTEGER), 0) AS INTEGER) AS n_sugestoes "
        f"FROM (SELECT id_leitura, ph, {fitted} FROM readings, line2)",
        f"line2 AS (SELECT {sums} FROM "
        f"(SELECT *, {bucket.replace('id_leitura', 'prepared.id_leitura')} AS b FROM prepared) WHERE b < 80)")
    # all rules one after another: the main list, the service's, the dashboard's
    sets = [advice_items("prepared"), serv, fb.replace("vol_prev", "volume_irrigacao").replace("nomain", "prepared")]
    listed = " UNION ALL ".join(f"SELECT id_leitura, {10 * i} + ord AS ord, code, value, detail FROM ({q})" for i, q in enumerate(sets))
    keep = ("SELECT id_leitura, 15 AS ord, 'SERV_MANTER' AS code, CAST(NULL AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS detail FROM prepared "
            "WHERE id_leitura NOT IN (SELECT id_leitura FROM said WHERE ord BETWEEN 10 AND 19 AND code IS NOT NULL) "
            "UNION ALL SELECT id_leitura, 25, 'PAINEL_SEM_PREVISAO', NULL, NULL FROM prepared "
            "WHERE id_leitura NOT IN (SELECT id_leitura FROM said WHERE ord >= 20 AND code IS NOT NULL)")
    words = " ".join(f"WHEN '{code}' THEN {text_sql(text)}" for code, text in TEXTS.items() if code != "ADUBAR_SUFIXO")
    o["advice_text"] = with_readings(
        "SELECT id_leitura, CAST(row_number() OVER (PARTITION BY id_leitura ORDER BY ord) - 1 AS INTEGER) AS posicao, code, "
        f"CASE code {words} END || CASE WHEN code = 'ADUBAR' AND detail IS NOT NULL THEN {text_sql(TEXTS['ADUBAR_SUFIXO'])} ELSE '' END AS text "
        "FROM (SELECT * FROM said UNION ALL SELECT * FROM quiet) WHERE code IS NOT NULL", f"said AS ({listed}), quiet AS ({keep})")
    cell = lambda c: (f"CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0 ELSE CAST(least(floor(({c} - min({c}) OVER ()) "  # noqa: E731
                      f"/ (max({c}) OVER () - min({c}) OVER ()) * {d(50)}), 49) AS INTEGER) END")
    o["density_cells"] = with_readings(
        "SELECT cor, celula_x, celula_y, count(*) AS pontos FROM (SELECT estado_bomba AS cor, "
        f"{cell('umidade')} AS celula_x, {cell('temperatura')} AS celula_y FROM readings "
        "WHERE umidade IS NOT NULL AND temperatura IS NOT NULL) GROUP BY 1, 2, 3")
    o["series_extremes"] = with_readings(" UNION ALL ".join(
        f"SELECT strftime(date_trunc('hour', capturado_em), {TS}) AS periodo, '{c}' AS variavel, "
        f"{r6(f'first({c} ORDER BY capturado_em, id_leitura)')} AS primeiro, {r6(f'last({c} ORDER BY capturado_em, id_leitura)')} AS ultimo, "
        f"{r6(f'min({c})')} AS menor, {r6(f'max({c})')} AS maior, count(*) AS pontos "
        f"FROM feat WHERE capturado_em IS NOT NULL AND {c} IS NOT NULL GROUP BY 1" for c in ("umidade", "temperatura")))
    return o


ORACLE = _build()
