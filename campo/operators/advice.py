"""Management-advice rules (R01–R08) as column expressions.

Each rule yields an array of zero or one ``struct(code, value, detail, text)``;
a reading's advice is ``concat(rule1, rule2, ...)`` in rule order, so the
whole rule set is one narrow, code-generated projection (no lambda
functions) that also runs on a stream.  Exploding uses the *outer* form plus
a null filter: a plain ``explode`` of the column makes Catalyst infer
``size(list) > 0`` and push it, with the whole rule expression inlined, below
every projection down to the scan.

Rules are applied to unrounded values; rounding is an output step.
Text is produced with the JVM formatter, which rounds exact binary ties
(0.25 -> "0.3") and shortest-form ties ("18.45" -> "18.5") half-up where the
original application printed "0.2" / "18.4"; the numeric ``value`` field is
the exact one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campo.functions import argmax_label, as_col, fmt, relative_deficit
from campo.schema import (K_IDEAL, LIMIAR_FERTILIZAR, LIMIAR_FERTILIZAR_MODERADO,
                          LIMIAR_IRRIGAR_MM, LIMIAR_RENDIMENTO_BAIXO,
                          LIMIAR_SOLO_ADEQUADO_MM, LIMIAR_UMIDADE_BAIXA, N_IDEAL,
                          P_IDEAL, PH_BOM_MAX, PH_BOM_MIN)

# --------------------------------------------------------------------------
# Advice texts of the original application (Portuguese), with
# their number formats.  {v} is the rule's value, {d} its detail.
# --------------------------------------------------------------------------
TEXTS = {
    "IRRIGAR": ("Irrigação recomendada: aplicar aproximadamente {v:.1f} mm "
                "para aproximar a umidade do alvo de 65%."),
    "SOLO_ADEQUADO": "Solo com umidade adequada: não é necessário irrigar no momento.",
    "IRRIGACAO_LEVE": ("Irrigação leve opcional: déficit estimado de {v:.1f} mm "
                       "(dentro de uma faixa tolerável)."),
    "ADUBAR": ("Adubação NPK recomendada: índice de necessidade de fertilização "
               "em {v:.0f}/100 (alto)."),
    "ADUBAR_SUFIXO": " O nutriente mais deficiente é {d}.",
    "RENDIMENTO_BAIXO": ("Atenção: rendimento previsto baixo ({v:.1f} sacas/ha). "
                         "Revise pH e umidade do solo para destravar a produtividade."),
    "PH_ACIDO": ("pH ácido ({v:.1f}): recomenda-se calagem para elevar o pH à "
                 "faixa ideal de 6.0–7.0."),
    "PH_ALCALINO": ("pH alcalino ({v:.1f}): recomenda-se correção (ex.: enxofre "
                    "elementar) para retornar à faixa ideal de 6.0–7.0."),
    # service fallback set
    "SERV_IRRIGAR": "Irrigar aproximadamente {v:.1f} mm para repor a umidade do solo.",
    "SERV_ADUBAR": ("Necessidade de fertilização elevada (índice {v:.0f}/100): "
                    "avaliar reposição de NPK."),
    "SERV_UMIDADE_BAIXA": "Umidade prevista baixa ({v:.1f}%); priorizar irrigação.",
    "SERV_PH_FORA": "pH previsto fora da faixa ideal (6.0–7.0): valor {v:.2f}. Corrigir solo.",
    "SERV_MANTER": "Condições dentro das faixas ideais; manter o manejo atual.",
    # dashboard fallback set
    "PAINEL_IRRIGAR": "Irrigar: aplicar ~{v:.1f} mm para repor a umidade do solo.",
    "PAINEL_UMIDADE_OK": "Umidade adequada: irrigacao nao prioritaria no momento.",
    "PAINEL_FERT_ALTA": ("Fertilizacao alta (indice {v:.0f}): reforcar NPK conforme "
                         "analise de solo."),
    "PAINEL_FERT_MODERADA": ("Fertilizacao moderada (indice {v:.0f}): ajuste pontual "
                             "de nutrientes."),
    "PAINEL_NUTRICAO_OK": "Nutricao equilibrada: manter o plano de adubacao atual.",
    "PAINEL_RENDIMENTO": "Rendimento estimado: {v:.1f} sacas/ha.",
    "PAINEL_SEM_PREVISAO": "Gere previsoes na aba anterior para receber sugestoes de manejo.",
}

def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def _text(code: str, value: Column | None = None, detail: Column | None = None) -> Column:
    """Render TEXTS[code] with JVM formatting of {v:.Nf} and plain {d}."""
    tpl = TEXTS[code]
    parts: list[Column] = []
    rest = tpl
    while rest:
        i = rest.find("{")
        if i < 0:
            parts.append(F.lit(rest))
            break
        if i:
            parts.append(F.lit(rest[:i]))
        j = rest.index("}", i)
        spec = rest[i + 1:j]
        if spec.startswith("v:."):
            parts.append(fmt(value, int(spec[3])))
        elif spec == "d":
            parts.append(detail)
        rest = rest[j + 1:]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


ITEMS = "array<struct<code:string,value:double,detail:string,text:string>>"


def _none() -> Column:
    return F.array().cast(ITEMS)


def _one(code: str, value: Column | None = None, detail: Column | None = None,
         text: Column | None = None) -> Column:
    return F.array(_item(code, value, detail, text))


def _item(code: str, value: Column | None = None, detail: Column | None = None,
          text: Column | None = None) -> Column:
    return F.struct(
        F.lit(code).alias("code"),
        (value.cast("double") if value is not None else _null("double")).alias("value"),
        (detail if detail is not None else _null("string")).alias("detail"),
        (text if text is not None else _text(code, value, detail)).alias("text"),
    )


def _opt(c):
    return None if c is None else as_col(c)


def most_deficient_nutrient(n="n", p="p", k="k") -> Column:
    """M07 + M08: N, P or K with the largest relative deficit; '' if none."""
    return argmax_label([("N", relative_deficit(as_col(n), N_IDEAL)),
                         ("P", relative_deficit(as_col(p), P_IDEAL)),
                         ("K", relative_deficit(as_col(k), K_IDEAL))])


def _words(text: bool) -> dict:
    """Arguments of an item without its text, for counts by code."""
    return {} if text else {"text": F.lit("")}


def rule_irrigation(volume, text: bool = True) -> Column:
    """> 5 mm irrigate; <= 1 mm adequate; otherwise light; NULL silent."""
    v, w = as_col(volume), _words(text)
    return (F.when(v > LIMIAR_IRRIGAR_MM, _one("IRRIGAR", v, **w))
            .when(v <= LIMIAR_SOLO_ADEQUADO_MM, _one("SOLO_ADEQUADO", v, **w))
            .when(v.isNotNull(), _one("IRRIGACAO_LEVE", v, **w))
            .otherwise(_none()))


def rule_fertilise(necessity, n="n", p="p", k="k", text: bool = True) -> Column:
    """Necessity > 50, naming the most deficient nutrient of the reading."""
    v = as_col(necessity)
    if not text:
        return F.when(v > LIMIAR_FERTILIZAR, _one("ADUBAR", v, **_words(text))).otherwise(_none())
    nut = most_deficient_nutrient(n, p, k)
    words = F.concat(_text("ADUBAR", v),
                    F.when(nut != "", _text("ADUBAR_SUFIXO", detail=nut)).otherwise(F.lit("")))
    return F.when(v > LIMIAR_FERTILIZAR,
                  _one("ADUBAR", v, F.when(nut != "", nut), words)).otherwise(_none())


def rule_low_yield(yield_, text: bool = True) -> Column:
    """Predicted yield < 40."""
    v = as_col(yield_)
    return F.when(v < LIMIAR_RENDIMENTO_BAIXO, _one("RENDIMENTO_BAIXO", v, **_words(text))).otherwise(_none())


def rule_ph(ph_pred=None, ph_reading="ph", text: bool = True) -> Column:
    """Acid < 6.0, alkaline > 7.0; predicted pH first, else the reading."""
    cands = [c for c in (_opt(ph_pred), _opt(ph_reading)) if c is not None]
    v = F.coalesce(*cands) if len(cands) > 1 else cands[0]
    return (F.when(v < PH_BOM_MIN, _one("PH_ACIDO", v, **_words(text)))
            .when(v > PH_BOM_MAX, _one("PH_ALCALINO", v, **_words(text)))
            .otherwise(_none()))


def advice(volume="volume_irrigacao", necessity="necessidade_fertilizacao",
           yield_="rendimento", ph_pred=None, ph_reading="ph",
           n="n", p="p", k="k", text: bool = True) -> Column:
    """The full advice list in rule order R01, R02, R03, R04.

    Pass ``None`` for a prediction that is not available: its rule is silent
    (as when a model is missing).  ``text=False`` leaves texts and details out,
    for counts by code.
    """
    rules = []
    if volume is not None:
        rules.append(rule_irrigation(volume, text))
    if necessity is not None:
        rules.append(rule_fertilise(necessity, n, p, k, text))
    if yield_ is not None:
        rules.append(rule_low_yield(yield_, text))
    if ph_pred is not None or ph_reading is not None:
        rules.append(rule_ph(ph_pred, ph_reading, text))
    if not rules:
        return _none()
    return F.concat(*rules) if len(rules) > 1 else rules[0]


def advice_service(volume="volume_irrigacao", necessity="necessidade_fertilizacao",
                   umidade="umidade", ph="ph") -> Column:
    """The service's fallback rule set; 'keep' when nothing fires."""
    vol, fert, um, p = (as_col(volume), as_col(necessity), as_col(umidade), as_col(ph))
    fired = F.concat(
        F.when(vol > LIMIAR_IRRIGAR_MM, _one("SERV_IRRIGAR", vol)).otherwise(_none()),
        F.when(fert > LIMIAR_FERTILIZAR, _one("SERV_ADUBAR", fert)).otherwise(_none()),
        F.when(um < LIMIAR_UMIDADE_BAIXA, _one("SERV_UMIDADE_BAIXA", um)).otherwise(_none()),
        F.when((p < PH_BOM_MIN) | (p > PH_BOM_MAX), _one("SERV_PH_FORA", p)).otherwise(_none()),
    )
    return F.when(F.size(fired) == 0, F.array(_item("SERV_MANTER"))).otherwise(fired)


def advice_dashboard_fallback(volume="volume_irrigacao",
                              necessity="necessidade_fertilizacao",
                              yield_="rendimento") -> Column:
    """R07 rule set on its own."""
    vol, fert, y = as_col(volume), as_col(necessity), as_col(yield_)
    fired = F.concat(
        F.when(vol > LIMIAR_IRRIGAR_MM, _one("PAINEL_IRRIGAR", vol))
         .when(vol.isNotNull(), _one("PAINEL_UMIDADE_OK")).otherwise(_none()),
        F.when(fert > LIMIAR_FERTILIZAR, _one("PAINEL_FERT_ALTA", fert))
         .when(fert > LIMIAR_FERTILIZAR_MODERADO, _one("PAINEL_FERT_MODERADA", fert))
         .when(fert.isNotNull(), _one("PAINEL_NUTRICAO_OK")).otherwise(_none()),
        F.when(y.isNotNull(), _one("PAINEL_RENDIMENTO", y)).otherwise(_none()),
    )
    return F.when(F.size(fired) == 0, F.array(_item("PAINEL_SEM_PREVISAO"))).otherwise(fired)


def advice_dashboard(volume="volume_irrigacao", necessity="necessidade_fertilizacao",
                     yield_="rendimento", ph_pred=None, ph_reading="ph",
                     n="n", p="p", k="k") -> Column:
    """The main rule list, or the dashboard fallback set when it is empty."""
    main = advice(volume, necessity, yield_, ph_pred, ph_reading, n, p, k)
    return F.when(F.size(main) == 0,
                  advice_dashboard_fallback(volume, necessity, yield_)).otherwise(main)


def with_advice(df: DataFrame, out: str = "sugestoes", **kw) -> DataFrame:
    """Attach the R05 list to every reading."""
    return df.withColumn(out, advice(**kw))


def advice_long(df: DataFrame, keys=("id_leitura",), col: str = "sugestoes") -> DataFrame:
    """Exploded form: one row per (reading, position) with the item fields."""
    return (df.select(*keys, F.posexplode_outer(col).alias("posicao", "item"))
            .where(F.col("item").isNotNull())
            .select(*keys, "posicao", "item.code", "item.value", "item.detail", "item.text"))


def advice_volume(df: DataFrame, by=("id_pivo",), col: str = "sugestoes",
                  day: str | None = "capturado_em") -> DataFrame:
    """Number of advice items per code (and pivot / day).

    explode -> partial hash aggregate -> shuffle on the small group key.
    """
    groups = [F.col(b) for b in by]
    if day:
        groups.append(F.to_date(day).alias("dia"))
    return (df.select(*groups, F.explode_outer(col).alias("item"))
            .where(F.col("item").isNotNull())
            .groupBy(*([b for b in by] + (["dia"] if day else [])), F.col("item.code").alias("code"))
            .agg(F.count(F.lit(1)).alias("ocorrencias")))
