"""Aggregations A01–A17.

Design notes for scale:
* Global aggregates (KPIs, correlations, bounds) are single ``agg`` calls:
  partial aggregation on every partition, one tiny final merge.
* Quantiles are exact without moving the data: a sketch brackets every wanted
  rank, one more scan counts the rows below each bracket, and only the few
  values inside a bracket are gathered and ranked.
* Joins against per-column bounds / quartiles use frames whose size is the
  number of columns (or bins) — a proven bound — so broadcasting them is safe.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campo.functions import column_mean, nan_to_null



def _long(df: DataFrame, cols: Sequence[str], name: str = "coluna",
          value: str = "x") -> DataFrame:
    """Unpivot ``cols`` into (coluna, x) doubles, NULL and NaN dropped."""
    arr = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value))
                    for c in cols])
    return (df.select(F.explode(arr).alias("_s")).select(f"_s.{name}", f"_s.{value}")
            .where(F.col(value).isNotNull() & ~F.isnan(value)))


# ---------------------------------------------------------------- A01–A03, A12
def kpis(df: DataFrame, col: str = "estado_bomba") -> DataFrame:
    """Mean humidity, temperature, pH and the share of readings with the
    pump on.  As in the original dashboard the text is upper-cased but not
    trimmed (" on " is not ON), a numeric column counts 1 as on, and a missing
    state counts as off."""
    c = F.col(col)
    if df.schema[col].dataType.typeName() in ("string",):
        on = F.upper(c) == F.lit("ON")
    else:
        on = c == F.lit(1)
    return df.agg(column_mean("umidade").alias("umidade_media"),
                  column_mean("temperatura").alias("temperatura_media"),
                  column_mean("ph").alias("ph_medio"),
                  F.avg(F.coalesce(on, F.lit(False)).cast("double")).alias("bomba_ligada"))


def npk_means(df: DataFrame) -> DataFrame:
    """Mean N, P, K as (nutriente, valor) rows."""
    wide = df.agg(F.avg("n").alias("n"), F.avg("p").alias("p"), F.avg("k").alias("k"))
    return wide.unpivot([], ["n", "p", "k"], "nutriente", "valor")


def pump_counts(df: DataFrame, col: str = "estado_bomba") -> DataFrame:
    """Value counts of the pump state (1 -> ON, 0 -> OFF), descending.

    Text is upper-cased (not trimmed) and a missing state counts as 'NAN',
    as the original dashboard did via ``astype(str)``.
    """
    s = F.upper(F.coalesce(F.col(col).cast("string"), F.lit("nan")))
    s = F.when(s == "1", "ON").when(s == "0", "OFF").otherwise(s)
    return (df.select(s.alias("estado")).groupBy("estado")
            .agg(F.count(F.lit(1)).alias("contagem"))
            .orderBy(F.desc("contagem"), "estado"))


def ph_band_share(df: DataFrame, col: str = "ph", lo: float = 6.0, hi: float = 7.0) -> DataFrame:
    """Share of (non-missing) readings with pH inside [lo, hi]."""
    x = F.col(col)
    return df.agg(F.avg(x.between(lo, hi).cast("double")).alias("fracao_faixa_boa"),
                  F.count(x).alias("leituras_ph"))


# ---------------------------------------------------------------- quantiles
SKETCH_ACCURACY = 10_000     # rank error of the bracketing sketch: n / accuracy
BRACKET_ROWS = 20_000        # a bracket with more rows is bracketed again


def _clean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns as doubles named c0, c1, ..., NaN as NULL."""
    return df.select(*[nan_to_null(c).alias(f"c{i}") for i, c in enumerate(cols)])


def _brackets(vals: DataFrame, cols: Sequence[str], probs: Sequence[float],
              extra: Sequence = ()) -> tuple[dict, dict]:
    """Per (column, prob): (low, high, rows below low, wanted ranks), such that
    the wanted ranks lie inside [low, high]; and the ``extra`` aggregates.

    One scan for the sketches, one for the counts, and two more only for
    brackets that hold more than ``BRACKET_ROWS`` rows.  All scalars: columns x
    probs values reach the driver."""
    eps = 2.0 / SKETCH_ACCURACY
    clip = lambda q: min(1.0, max(0.0, q))
    aggs = list(extra)
    for i, _ in enumerate(cols):
        v = F.col(f"c{i}")
        aggs += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
                 F.percentile_approx(v, [clip(q + e) for q in probs for e in (-eps, eps)],
                                     SKETCH_ACCURACY).alias(f"s{i}")]
    first = vals.agg(*aggs).first()
    out, todo = {}, {}
    for i, _ in enumerate(cols):
        n = first[f"n{i}"]
        if not n:
            continue
        for j, q in enumerate(probs):
            h = (n - 1) * float(q)
            ranks = (int(math.floor(h)), int(math.ceil(h)), h - math.floor(h))
            low = first[f"lo{i}"] if q - eps <= 0 else first[f"s{i}"][2 * j]
            high = first[f"hi{i}"] if q + eps >= 1 else first[f"s{i}"][2 * j + 1]
            todo[i, j] = (low, high, ranks, None)
    while todo:
        keys = list(todo)
        aggs = []
        for k, (i, j) in enumerate(keys):
            low, high = todo[i, j][:2]
            v = F.col(f"c{i}")
            aggs += [F.count(F.when(v < F.lit(low), 1)).alias(f"b{k}"),
                     F.count(F.when(v.between(F.lit(low), F.lit(high)), 1)).alias(f"w{k}")]
        got = vals.agg(*aggs).first()
        again = []
        for k, key in enumerate(keys):
            low, high, ranks, seen = todo.pop(key)
            below, inside = got[f"b{k}"], got[f"w{k}"]
            if below > ranks[0] or below + inside <= ranks[1]:  # sketch missed: take the whole column
                todo[key] = (first[f"lo{key[0]}"], first[f"hi{key[0]}"], ranks, None)
            elif inside <= BRACKET_ROWS or low == high or seen == (low, high):
                out[key] = (low, high, below, ranks)
            else:
                again.append((key, low, high, below, inside, ranks))
        if again:
            aggs = []
            for k, (key, low, high, below, inside, ranks) in enumerate(again):
                v = F.col(f"c{key[0]}")
                near = [clip((ranks[0] - below) / inside - eps), clip((ranks[1] - below + 1) / inside + eps)]
                aggs.append(F.percentile_approx(F.when(v.between(F.lit(low), F.lit(high)), v), near,
                                                SKETCH_ACCURACY).alias(f"s{k}"))
            got = vals.agg(*aggs).first()
            for k, (key, low, high, *_, ranks) in enumerate(again):
                todo[key] = (*got[f"s{k}"], ranks, (low, high))
    return out, first.asDict()


def _picked(vals: DataFrame, cols: Sequence[str], probs: Sequence[float], brackets: dict) -> DataFrame:
    """(coluna, q, valor) from the values inside the brackets."""
    spark = vals.sparkSession
    schema = "g int, coluna string, q double, below long, lo long, hi long, f double"
    rows = [(g, cols[i], float(probs[j]), below, ranks[0], ranks[1], float(ranks[2]))
            for g, ((i, j), (_, _, below, ranks)) in enumerate(brackets.items())]
    wanted = spark.createDataFrame(rows, schema)
    if not rows:
        return wanted.select("coluna", "q", F.lit(None).cast("double").alias("valor"))
    inside = F.array_compact(F.array(*[
        F.when(F.col(f"c{i}").between(F.lit(low), F.lit(high)),
               F.struct(F.lit(g).alias("g"), F.col(f"c{i}").alias("x")))
        for g, ((i, _), (low, high, *_rest)) in enumerate(brackets.items())]))
    counts = (vals.select(F.explode(inside).alias("s")).groupBy("s.g", "s.x")
              .agg(F.count(F.lit(1)).alias("c")))
    upto = Window.partitionBy("g").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("cum", F.sum("c").over(upto))
    met = ranked.join(F.broadcast(wanted), "g")  # one row per column and prob
    end, begin = F.col("below") + F.col("cum"), F.col("below") + F.col("cum") - F.col("c")
    at = lambda r: F.max(F.when((begin <= F.col(r)) & (F.col(r) < end), F.col("x")))
    two = met.groupBy("coluna", "q").agg(at("lo").alias("x0"), at("hi").alias("x1"), F.first("f").alias("f"))
    return two.select("coluna", "q", (F.col("x0") + F.col("f") * (F.col("x1") - F.col("x0"))).alias("valor"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation (the 'linear' / ``quantile_cont``
    definition): h = (n-1)q, value = x[floor h] + (h - floor h)(x[ceil h] - x[floor h]).

    Returns (coluna, q, valor); see :func:`_brackets`.  A column without
    values has no row."""
    cols = list(cols)
    vals = _clean(df, cols)
    return _picked(vals, cols, probs, _brackets(vals, cols, probs)[0])


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     accuracy: int = 10000) -> DataFrame:
    """Sketch-based quantiles (bounded memory per task), same output shape."""
    qs = [float(q) for q in probs]
    wide = _long(df, cols).groupBy("coluna").agg(
        F.percentile_approx("x", qs, accuracy).alias("v"))
    return wide.select("coluna", F.posexplode("v").alias("i", "valor")).select(
        "coluna", F.element_at(F.array(*[F.lit(q) for q in qs]), F.col("i") + 1).alias("q"),
        "valor")


def quantiles(df, cols, probs, exact: bool = True, **kw) -> DataFrame:
    return exact_quantiles(df, cols, probs, **kw) if exact else approx_quantiles(df, cols, probs)


# ---------------------------------------------------------------- A04–A08
def describe(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (linear), max per column.

    Long form: one row per column (a column without values gets count 0).

    Exact form: counts, means, sample deviations, extremes and the quartiles'
    brackets come from one scan, the counts below the brackets from a second,
    the quartiles from the values inside them.  ``exact=False`` uses sketch
    quantiles."""
    cols = list(cols)
    spark = df.sparkSession
    vals = _clean(df, cols)
    if exact:
        moments = [m for i, _ in enumerate(cols) for m in (
            F.avg(f"c{i}").alias(f"mean{i}"), F.stddev_samp(f"c{i}").alias(f"std{i}"))]
        brackets, first = _brackets(vals, cols, [0.25, 0.5, 0.75], moments)
        rows = [(i, c, first[f"n{i}"], first[f"mean{i}"], first[f"std{i}"], first[f"lo{i}"], first[f"hi{i}"])
                for i, c in enumerate(cols)]
        q = _picked(vals, cols, [0.25, 0.5, 0.75], brackets)
        base = spark.createDataFrame(rows, "i int, coluna string, count long, mean double, std double, min double, max double")
    else:
        wide = vals.agg(*[F.struct(
            F.lit(i).alias("i"), F.lit(c).alias("coluna"), F.count(f"c{i}").alias("count"), F.avg(f"c{i}").alias("mean"),
            F.stddev_samp(f"c{i}").alias("std"), F.min(f"c{i}").alias("min"), F.max(f"c{i}").alias("max")).alias(f"s{i}")
            for i, c in enumerate(cols)])
        base = wide.select(F.explode(F.array(*[f"s{i}" for i, _ in enumerate(cols)])).alias("s")).select("s.*")
        q = approx_quantiles(df, cols, [0.25, 0.5, 0.75])
    qw = (q.groupBy("coluna").agg(
        F.max(F.when(F.col("q") == 0.25, F.col("valor"))).alias("q25"),
        F.max(F.when(F.col("q") == 0.5, F.col("valor"))).alias("q50"),
        F.max(F.when(F.col("q") == 0.75, F.col("valor"))).alias("q75")))
    # one row per column: a bounded broadcast
    return (base.join(F.broadcast(qw), "coluna", "left")
            .select("coluna", "count", "mean", "std", "min", "q25", "q50", "q75", "max"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Number of missing values per column (NaN counts as missing)."""
    cols = list(cols or df.columns)

    def missing(c):
        x = F.col(c)
        dt = df.schema[c].dataType.typeName()
        isnan = F.isnan(x) if dt in ("double", "float") else F.lit(False)
        return F.sum((x.isNull() | isnan).cast("bigint"))

    wide = df.agg(*[missing(c).alias(c) for c in cols])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("coluna"), F.col(f"`{c}`").alias("nulos")) for c in cols
    ])).alias("s")).select("s.*")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values, sorted."""
    return (df.select(F.col(col).alias("valor")).where(F.col("valor").isNotNull())
            .distinct().orderBy("valor"))


def time_span(df: DataFrame, col: str = "capturado_em") -> DataFrame:
    """First and last capture time."""
    return df.agg(F.min(col).alias("inicio"), F.max(col).alias("fim"))


def shape(df: DataFrame) -> DataFrame:
    """Row count, column count and the schema's types (types need no job)."""
    types = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)
    return df.agg(F.count(F.lit(1)).alias("linhas")).select(
        "linhas", F.lit(len(df.columns)).alias("colunas"), F.lit(types).alias("tipos"))


# ---------------------------------------------------------------- A09
def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, pairwise complete.

    One scan: each partition multiplies blocks of values, their squares and
    their presence into one matrix of sums (:mod:`campo.operators.moments`).  A
    constant column gives NULL (pandas gives NaN).  Long form (var_x, var_y,
    corr), both orders and the diagonal.
    """
    from campo.operators.moments import correlations, pair_sums
    cols = list(cols)
    corr = correlations(pair_sums(df, cols))
    rows = [(a, b, corr[i][j]) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "var_x string, var_y string, corr double")


# ---------------------------------------------------------------- A10, A11
def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """A10: equal-width histogram over [min, max], last bin closed, empty bins
    included.  The bounds come from one scalar subquery (one aggregate,
    evaluated once and shipped to every task as a value), so no join is
    needed: two passes over the column in total."""
    x = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    # one scalar subquery for both bounds: a single pass, reused by every reference
    bounds = vals.select(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    w = (hi - lo) / F.lit(float(bins))
    b = F.when(w > 0, F.least(F.floor((F.col("x") - lo) / w), F.lit(bins - 1))
               ).otherwise(F.lit(0)).cast("int")
    counts = vals.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("contagem"))
    spark = df.sparkSession
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    # counts has at most `bins` rows: a bounded broadcast
    return (grid.join(F.broadcast(counts), "bin", "left")
            .where(lo.isNotNull())
            .select(F.lit(col).alias("coluna"), "bin",
                    (lo + F.col("bin") * w).alias("inicio"),
                    (lo + (F.col("bin") + 1) * w).alias("fim"),
                    F.coalesce("contagem", F.lit(0)).cast("bigint").alias("contagem")))


def box_summary(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Quartiles, IQR, whiskers at the extreme inliers within 1.5 IQR and
    the number of outliers, per column with values.

    Quartiles as in :func:`describe`; the fences are then numbers, and whiskers
    and outliers of all columns come from one aggregate over the columns."""
    cols = list(cols)
    found: dict[str, dict[float, float]] = {}
    for r in quantiles(df, cols, [0.25, 0.5, 0.75], exact).collect():  # columns x 3 rows
        found.setdefault(r["coluna"], {})[r["q"]] = r["valor"]
    fences, aggs = {}, []
    vals = _clean(df, cols)
    for i, c in enumerate(cols):
        if c not in found:
            continue
        q1, q3 = found[c][0.25], found[c][0.75]
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        fences[i] = (q1, found[c][0.5], q3)
        x = F.col(f"c{i}")
        inner = x.between(F.lit(low), F.lit(high))
        aggs += [F.min(F.when(inner, x)).alias(f"a{i}"), F.max(F.when(inner, x)).alias(f"z{i}"), F.count(F.when(~inner, 1)).alias(f"o{i}")]
    got = vals.agg(*aggs).first() if aggs else None
    rows = [(cols[i], q1, q2, q3, q3 - q1, got[f"a{i}"], got[f"z{i}"], got[f"o{i}"]) for i, (q1, q2, q3) in fences.items()]
    return df.sparkSession.createDataFrame(rows, "coluna string, q1 double, mediana double, q3 double, iqr double, bigode_inf double, "
                                                 "bigode_sup double, outliers long")


# ---------------------------------------------------------------- A13
def regression_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE, R² in one aggregate (optionally per group).

    R² = 1 - SSE / SST with SST = n·var_pop(y); a constant truth gives 1.0
    for a perfect fit and 0.0 otherwise.
    """
    e = F.col(y).cast("double") - F.col(yhat).cast("double")
    valid = F.col(y).isNotNull() & F.col(yhat).isNotNull()
    yy = F.when(valid, F.col(y).cast("double"))
    ee = F.when(valid, e)
    aggs = [F.count(ee).alias("n"), F.avg(F.abs(ee)).alias("mae"),
            F.avg(ee * ee).alias("mse"), F.sum(ee * ee).alias("_sse"),
            F.var_pop(yy).alias("_var")]
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    sst = F.col("_var") * F.col("n")
    # constant truth: 1.0 for a perfect fit, else 0.0 (finite, as the
    # original's metric library reports it); no rows: NULL
    r2 = (F.when(F.col("n") == 0, F.lit(None).cast("double"))
          .when(sst == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("_sse") / sst))
    return g.select(*by, "n", "mae", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"))


# ---------------------------------------------------------------- A14–A17
def trend(df: DataFrame, value: str = "rendimento", ts: str = "capturado_em",
          unit: str = "day", by: Sequence[str] = ()) -> DataFrame:
    """Mean of a target per time bucket (and group)."""
    bucket = F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz").alias("periodo")
    return (df.where(F.col(ts).isNotNull())
            .groupBy(*by, bucket)
            .agg(F.avg(value).alias("media"), F.count(F.lit(1)).alias("leituras")))


def per_pivot(df: DataFrame, by: str = "id_pivo",
              values: Sequence[str] = ("rendimento", "volume_irrigacao"),
              totals: bool = False) -> DataFrame:
    """Per-pivot comparison of productivity and irrigation (means, and
    optionally totals)."""
    tot = [F.sum(v).alias(f"{v}_total") for v in values] if totals else []
    return df.groupBy(by).agg(*[F.avg(v).alias(f"{v}_medio") for v in values], *tot,
                              F.count(F.lit(1)).alias("leituras"))


def series_long(df: DataFrame, ts: str = "capturado_em",
                values: Sequence[str] = ("umidade", "temperatura"),
                key: str = "id_leitura") -> DataFrame:
    """(time, variable, value) ordered by capture time (distributed sort)."""
    return (df.where(F.col(ts).isNotNull())
            .unpivot([key, ts], list(values), "variavel", "valor")
            .orderBy(ts, key, "variavel"))


def series_buckets(df: DataFrame, ts: str = "capturado_em",
                   values: Sequence[str] = ("umidade", "temperatura"),
                   unit: str = "hour") -> DataFrame:
    """A16, large-data form: per-bucket means instead of every point."""
    bucket = F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz").alias("periodo")
    return (df.where(F.col(ts).isNotNull()).groupBy(bucket)
            .agg(*[F.avg(v).alias(v) for v in values])
            .unpivot(["periodo"], list(values), "variavel", "valor"))


def scatter_points(df: DataFrame, x: str = "umidade", y: str = "temperatura",
                   color: str = "estado_bomba", key: str = "id_leitura",
                   fraction: float | None = None, seed: int = 42) -> DataFrame:
    """Point set for a scatter plot; optional deterministic hash sample
    (same rows on every run, independent of partitioning)."""
    out = df.select(key, x, y, F.col(color).alias("cor"))
    if fraction is not None:
        from campo.functions import hash_bucket
        out = out.where(hash_bucket(key, 1_000_000, seed) < int(fraction * 1_000_000))
    return out


def density_cells(df: DataFrame, x: str = "umidade", y: str = "temperatura",
                  color: str = "estado_bomba", bins: int = 50) -> DataFrame:
    """A17, large-data form: points per cell of a ``bins`` x ``bins`` grid over
    the observed ranges, and per colour.  At most ``bins``² rows a colour come
    back whatever the table.  A row without ``x`` or ``y`` is no point; a range
    of one value is cell 0.  Two scans: the ranges, then the counts (combined in
    every task before the shuffle)."""
    points = df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(x).cast("double")) & ~F.isnan(F.col(y).cast("double")))
    lo_x, hi_x, lo_y, hi_y = points.agg(F.min(x).cast("double"), F.max(x).cast("double"),
                                        F.min(y).cast("double"), F.max(y).cast("double")).first()

    def cell(c, lo, hi):
        if lo is None or hi == lo:
            return F.lit(0)
        at = (F.col(c).cast("double") - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))
        return F.least(F.floor(at), F.lit(bins - 1)).cast("int")

    return (points.groupBy(F.col(color).alias("cor"), cell(x, lo_x, hi_x).alias("celula_x"), cell(y, lo_y, hi_y).alias("celula_y"))
            .agg(F.count(F.lit(1)).alias("pontos")))


def series_extremes(df: DataFrame, ts: str = "capturado_em",
                    values: Sequence[str] = ("umidade", "temperatura"),
                    unit: str = "hour", key: str = "id_leitura") -> DataFrame:
    """A16, large-data form that keeps spikes: first, last, least and greatest
    value per time bucket and variable, and how many there are.  Equal times go
    by the key; a missing value is no point.  One partial aggregate."""
    bucket = F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz").alias("periodo")
    at = F.struct(ts, key)
    return (df.where(F.col(ts).isNotNull())
            .select(ts, key, *[F.col(v).cast("double").alias(v) for v in values])
            .unpivot([key, ts], list(values), "variavel", "valor").where(F.col("valor").isNotNull())
            .groupBy(bucket, "variavel")
            .agg(F.min_by("valor", at).alias("primeiro"), F.max_by("valor", at).alias("ultimo"),
                 F.min("valor").alias("menor"), F.max("valor").alias("maior"), F.count(F.lit(1)).alias("pontos")))
