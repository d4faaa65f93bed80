"""Personal data by candidate gradient boosting, with DataFrame functions only.

Generators (regular expressions) propose overlapping spans of several kinds.
Base kinds are settled by their format: an e-mail address, an IP address with
parts up to 255, a card number that passes the Luhn test, a phone number of 9
to 15 digits.  Candidates of the other kinds (``contact``: masked address,
``number``, ``secret``) are seen in two views that share no feature: the format
of the match, and the words and marks around it.  Each view settles some
candidates on its own (a secret's word before it, a known key prefix), and
boosted trees on the features of the other view learn from these: the format
trees from what the context settles, the context trees from what the format
settles; valid and failed matches of the base kinds are examples for both.  The
trees fit on about ``SAMPLE`` distinct matches with context of each kind, so
that a rare kind is learnt beside a frequent one.

A candidate is added if a view settles it, or if one of the two trees'
probabilities reaches its kind's threshold.  Thresholds are calibrated for
precision against the other view's labels, on all candidates of the matches held
back from fitting (a quarter, by hash).

Offsets count code points, the end is exclusive.  Null text counts as empty and
has no spans.  Added spans that touch a base span are left out.  A kind without
a threshold, and every kind where all candidates to fit are of one class, adds
the candidates that a view settles and no others.

The patterns take each run of characters once (possessive parts, and a start
only at a run's start or where the last match ended), so that their time grows
with the text's length and long runs need no stack; they match what the plain
patterns match.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campo.llm.common import stage, text_of

SAMPLE = 20_000        #: distinct matches with context of a kind the trees are trained on, about
PRECISION = 0.97       #: of candidates above a kind's threshold, by the other view's labels
NEVER = 2.0            #: threshold that no probability reaches
BINS = 50
BEFORE, AFTER = 24, 8  #: characters of context

#: name, pattern, whether a text may hold it (cheap test), settled by format
GENERATORS = [
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "at", True),
    ("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", "digit", True),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", "digit", True),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "plus", True),
    ("contact", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++", "masked", False),
    ("number", r"(?:\G|(?<![0-9A-Za-z.+-]))\(?[0-9]{2,5}\)?[\x20./-][0-9]{2,5}(?:[\x20./-][0-9]{2,6})++", "digit", False),
    ("secret", r"(?:\G|(?<![A-Za-z0-9_+/=-]))(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{12,}+", "digit", False),
]
KINDS = [g[0] for g in GENERATORS]
BASE = [g[0] for g in GENERATORS if g[3]]
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
SECRET_WORDS = r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key)"
CONTACT_WORDS = r"(?i)(?:phone|tel|call|mobile|fax|contact|mail|ssn|iban|account)"


def _hit(kind: str):
    """A match and the text before it, as a struct."""
    return lambda match, before: F.struct(
        F.lit(kind).alias("kind"), match.alias("match"), F.length(before).alias("gap"),
        F.right(before, F.lit(BEFORE)).alias("tail"), F.left(before, F.lit(AFTER)).alias("head"))


def candidates(docs: DataFrame) -> DataFrame:
    """One row per document: row (key), doc_id, hits: per generator and match
    the matched text, and length and edges of the text before it; the last
    entry of a generator has the text after its last match."""
    text = F.col("text")
    may = {"at": F.contains(text, F.lit("@")), "plus": F.contains(text, F.lit("+")), "digit": F.col("digit"),
           "masked": F.contains(F.lower(text), F.lit("at]")) | F.contains(F.lower(text), F.lit("at)"))}
    hits = []
    for kind, pattern, test, _ in GENERATORS:
        found = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1), _hit(kind))
        hits.append(F.when(may[test], found))
    base = docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"))
    base = base.withColumn("digit", text.rlike("[0-9]"))
    hits = F.flatten(F.filter(F.array(*hits), lambda x: x.isNotNull() & (F.size(x) > 1)))
    return base.select("row", "doc_id", hits.alias("hits"))


def spans(found: DataFrame) -> DataFrame:
    """One row per candidate: row, kind, start, end, match, before, after,
    valid (settled by its format)."""
    each = found.where(F.size("hits") > 0).select("row", F.posexplode("hits").alias("nth", "hit")).select("row", "nth", "hit.*")
    order = Window.partitionBy("row", "kind").orderBy("nth")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("end", F.sum(F.col("gap") + F.coalesce(F.length("match"), F.lit(0))).over(upto))
    each = each.withColumn("after", F.lead("head").over(order)).where(F.col("match").isNotNull())
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.length(digits)
    at = lambda i: F.substring(digits, n - i + 1, F.lit(1)).cast("int")
    luhn = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda total, i: total + F.when(
        i % 2 == 1, at(i)).otherwise(at(i) * 2 - F.when(at(i) > 4, 9).otherwise(0)))
    valid = (F.when(F.col("kind") == "email", True)
             .when(F.col("kind") == "ip", F.col("match").rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
             .when(F.col("kind") == "card", F.when((n >= 12) & (n <= 19), luhn % 10 == 0).otherwise(False))
             .when(F.col("kind") == "phone", (n >= 9) & (n <= 15)).otherwise(False))
    return each.select("row", "kind", (F.col("end") - F.length("match")).alias("start"), "end", "match",
                       F.col("tail").alias("before"), F.coalesce("after", F.lit("")).alias("after"), valid.alias("valid"))


def _share(text: str, members: str) -> Column:
    return F.regexp_count(text, F.lit(members)) / F.greatest(F.length(text), F.lit(1))


VIEWS = ("format", "context")


def featured(each: DataFrame) -> DataFrame:
    """Features of both views as doubles (``format_*`` of the match, ``context_*``
    of what is around it), ``by_format`` and ``by_context`` (whether the view
    settles the candidate), and each view's training label: what the other one
    says, for a base kind whether the match is valid."""
    # a word and '=' in front of a secret are its context
    core = F.when(F.col("kind") == "secret", F.regexp_replace("match", r"^[A-Za-z_-]{2,}=(?=[^=])", "")).otherwise(F.col("match"))
    each = each.withColumn("core", core).withColumn("lead", F.concat("before", F.expr("left(match, length(match) - length(core))")))
    kinds = {k: F.col("kind") == k for k in KINDS}
    format_view = {
        "length": F.least(F.length("core"), F.lit(200)), "digits": _share("core", "[0-9]"), "upper": _share("core", "[A-Z]"),
        "lower": _share("core", "[a-z]"), "hex": _share("core", "[0-9a-f]"), "marks": _share("core", "[^0-9A-Za-z]"),
        "changes": F.regexp_count("core", F.lit("[0-9][A-Za-z]|[A-Za-z][0-9]")) / F.greatest(F.length("core"), F.lit(1)),
        "groups": F.regexp_count("core", F.lit("[0-9]+")), "plus": F.col("core").startswith("+"), **kinds}
    context_view = {
        "space": (F.col("lead") == "") | F.col("lead").rlike(r"[\s\"'(]$"), "assign": F.col("lead").rlike(r"[=:]\s*[\"']?$"),
        "secret_word": F.col("lead").rlike(SECRET_WORDS), "contact_word": F.col("before").rlike(CONTACT_WORDS),
        "stop": F.col("after").rlike(r"^[\s.,;:)\"']|^$"), **kinds}
    secret, contact, number = kinds["secret"], kinds["contact"], kinds["number"]
    by_format = (secret & F.col("core").rlike(r"^(?:AKIA|ASIA)[0-9A-Z]{16}$")) | contact
    by_context = (secret & F.concat("before", "match").rlike(SECRET_WORDS + r"\W{0,6}\w+$")) | (
        contact & F.col("before").rlike(CONTACT_WORDS + r"\W{0,4}$")) | (
        number & F.col("before").rlike(CONTACT_WORDS + r"\W{0,4}$") & (F.regexp_count("match", F.lit("[0-9]")) >= 9))
    base = F.col("kind").isin(BASE)
    double = lambda view, name: [v.cast("double").alias(f"{name}_{k}") for k, v in view.items()]
    return each.select("*", *double(format_view, "format"), *double(context_view, "context"),
                       by_format.alias("by_format"), by_context.alias("by_context"),
                       F.when(base, F.col("valid")).otherwise(by_context).cast("double").alias("label_format"),
                       F.when(base, F.col("valid")).otherwise(by_format).cast("double").alias("label_context"))


def _held() -> Column:
    """Whether a match is held back from fitting, with all its candidates."""
    return F.pmod(F.xxhash64("match", F.lit(3)), F.lit(4)) == 0


def _by_kind(values: dict, otherwise: Column) -> Column:
    return reduce(lambda c, kv: F.when(F.col("kind") == kv[0], kv[1]).otherwise(c), values.items(), otherwise)


def sampled(each: DataFrame) -> DataFrame:
    """About ``SAMPLE`` distinct matches with context of each kind, or all if
    there are fewer, taken by hash out of the matches that are not held."""
    fit = each.where(~_held())
    example = F.xxhash64("kind", "match", "before", "after")
    sizes = fit.groupBy("kind").agg(F.approx_count_distinct(example).alias("n")).collect()  # a row a kind
    share = _by_kind({r["kind"]: F.lit(SAMPLE / max(r["n"], 1)) for r in sizes}, F.lit(1.0))
    return fit.where(F.shiftrightunsigned(example, 11) * 2.0 ** -53 < share).select("kind", "match", "before", "after", "valid").distinct()


def train(each: DataFrame) -> dict:
    """Boosted trees of each view that has two classes to learn."""
    sample = stage(featured(sampled(each)), "pii-sample")
    out = {}
    for view in VIEWS:
        if sample.select(f"label_{view}").distinct().count() < 2:
            continue
        names = [c for c in sample.columns if c.startswith(view + "_")]
        assemble = VectorAssembler(inputCols=names, outputCol="features")
        trees = GBTClassifier(featuresCol="features", labelCol=f"label_{view}", maxIter=12, maxDepth=4, seed=5)
        out[view] = assemble, trees.fit(assemble.transform(sample))
    return out


def thresholds(held: DataFrame) -> dict[str, float]:
    """The threshold of each kind that has candidates in ``held`` (kind, p, label)."""
    bins = held.groupBy("kind", F.floor(F.col("p") * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")).collect()
    out = {}
    for kind in {r["kind"] for r in bins}:
        n = good = 0
        out[kind] = NEVER
        for r in sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["bin"]):
            n, good = n + r["n"], good + r["good"]
            if good < PRECISION * n:
                break
            out[kind] = r["bin"] / BINS
    return out


def added(each: DataFrame) -> DataFrame:
    """The candidates of the kinds not settled by format that are spans."""
    models = train(each)
    others = featured(each.where(~F.col("kind").isin(BASE)))
    chances = [F.col(f"p_{v}") for v in models]
    others = stage(scored(others, models).select(
        "row", "kind", "start", "end", *chances, *[f"label_{v}" for v in VIEWS], (F.col("by_format") | F.col("by_context")).alias("settled"),
        _held().alias("held")), "pii-scores")
    reached = F.col("settled")
    for view in models:
        limits = thresholds(others.where("held").select("kind", F.col(f"p_{view}").alias("p"), F.col(f"label_{view}").alias("label")))
        reached = reached | _by_kind({k: F.col(f"p_{view}") >= t for k, t in limits.items()}, F.lit(False))
    return others.where(reached)


def scored(features: DataFrame, models: dict) -> DataFrame:
    """``features`` with p_format and p_context, as far as there are trees."""
    for view, (assemble, trees) in models.items():
        features = trees.transform(assemble.transform(features)).withColumn(f"p_{view}", vector_to_array("probability")[1])
        features = features.drop("features", "rawPrediction", "probability", "prediction")
    return features


def _joined(array: Column) -> Column:
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is(kind: str):
    return lambda s: s["kind"] == kind


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, and the counts of added spans n_contact, n_number,
    n_secret."""
    found = stage(candidates(docs), "pii-hits")
    each = stage(spans(found), "pii-spans")
    rank = reduce(lambda c, k: c.when(F.col("kind") == k, KINDS.index(k)), KINDS[1:], F.when(F.col("kind") == KINDS[0], 0))
    span = F.struct("start", rank.alias("rank"), "kind", "end")
    chosen = each.where("valid").select("row", F.lit(True).alias("base"), span.alias("span"))
    chosen = chosen.union(added(each).select("row", F.lit(False).alias("base"), span.alias("span")))
    lists = chosen.groupBy(F.col("row").alias("of")).agg(
        F.array_sort(F.collect_list(F.when(F.col("base"), F.col("span")))).alias("base"),
        F.collect_list(F.when(~F.col("base"), F.col("span"))).alias("extra"))
    lists = lists.withColumn("extra", F.filter("extra", lambda x: ~F.exists(
        F.col("base"), lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"]))))
    out = found.select("row", "doc_id").join(lists, F.col("row") == F.col("of"), "left")
    empty = F.expr("cast(array() as array<struct<start:bigint,rank:int,kind:string,end:bigint>>)")
    base, extra = F.coalesce("base", empty), F.coalesce("extra", empty)
    counts = [F.size(F.filter(base, _is(k))).cast("long").alias(f"n_{k}") for k in BASE]
    more = [F.size(F.filter(extra, _is(k))).cast("long").alias(f"n_{k}") for k in KINDS if k not in BASE]
    return out.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                      _joined(F.array_sort(F.concat(base, extra))).alias("spans"), *more)
