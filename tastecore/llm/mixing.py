"""Mixing documents to target weights of soft domains, with DataFrame operations only.

A classifier learned from a labelled table gives every document posteriors over domains. Rates (how often
a document is taken, 0 or more) are found so that the expected tokens of each domain,
sum(rate * tokens * posterior), match the targets: least squares by projected gradient, starting from
one rate for all. With t tokens, the step is taken in the metric of the tokens, rate -= p . g, and residuals
are measured in the metric M^-1, M = sum(t p p') / sum(t) over the documents whose rate is not 0, in which
the steepest step has length 1 (halved after one that was too long); where targets can be met, the
solution meets them in any metric. One step needs K + K (K + 1) / 2 sums over all documents for K domains. A
document's rate follows from its posteriors and the steps' g alone, so the steps are kept, not the rates.

Edge cases: a null text is an empty one, with 0 tokens; it gets a rate but adds nothing. Labels that are null
or name no document teach nothing. A domain that is labelled but has no text in `docs` has posterior 0 and can't be asked
for: its weight goes to the others in proportion. Targets that non-negative rates can't meet leave a `residual`, stated
with `converged` next to the rates. Without any labelled text, or without tokens, every rate is 1. A
single domain has posterior 1. Repeated rows are documents of their own. Extra columns are passed by.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastecore.plans.staging import stage

WORDS, COUNTS, SHARES, RAW, PROBABILITY, BEST = (f"_mix_{x}" for x in ("words", "counts", "shares", "raw", "probability", "best"))
TOKENS, POSTERIORS = "_mix_tokens", "_mix_posteriors"


@dataclass(frozen=True)
class DomainClassifier:
    """`learned`: the places of the domains that had text, in the order of the model's classes."""

    domains: tuple[str, ...]
    model: PipelineModel | None
    learned: tuple[int, ...] = ()


def _words(text: Column) -> Column:
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+")


def learn_domains(
    docs: DataFrame, labels: DataFrame, domain: Column, rows_per_domain: int = 4_000, features: int = 1 << 12
) -> DomainClassifier:
    """Multinomial logistic regression on word shares.

    `domain` names the domain of a row of `labels` (with doc_id). Fitted on about `rows_per_domain`
    labelled rows of each domain, chosen by a hash of doc_id over the whole table.
    """
    named = labels.select(F.col("doc_id").alias("_id"), domain.cast("string").alias("_domain")).filter("_id is not null and _domain is not null")
    sizes = {r["_domain"]: r["count"] for r in named.groupBy("_domain").count().collect()}
    if not sizes:
        return DomainClassifier((), None)
    domains = tuple(sorted(sizes))
    shares = F.create_map(*[F.lit(x) for d, n in sizes.items() for x in (d, min(1.0, rows_per_domain / n))])
    number = F.create_map(*[F.lit(x) for i, d in enumerate(domains) for x in (d, float(i))])
    draw = F.pmod(F.xxhash64(F.lit("domain"), "_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = named.filter(draw < shares[F.col("_domain")]).select("_id", number[F.col("_domain")].alias("label"))
    # Broadcast bound: about rows_per_domain rows of each domain.
    text = docs.filter("text is not null").select("doc_id", _words(F.col("text")).alias(WORDS))
    sample = stage(text.join(F.broadcast(drawn), F.col("doc_id") == F.col("_id")).select(WORDS, "label"), "labelled")
    learned = tuple(sorted(int(r["label"]) for r in sample.select("label").distinct().collect()))
    if len(learned) < 2:
        return DomainClassifier(domains if learned else (), None, learned)
    places = F.create_map(*[F.lit(x) for place, i in enumerate(learned) for x in (float(i), float(place))])
    steps = [
        HashingTF(inputCol=WORDS, outputCol=COUNTS, numFeatures=features),
        Normalizer(inputCol=COUNTS, outputCol=SHARES, p=1.0),
        LogisticRegression(
            featuresCol=SHARES, labelCol="label", family="multinomial", maxIter=30, regParam=1e-4,
            rawPredictionCol=RAW, probabilityCol=PROBABILITY, predictionCol=BEST,
        ),
    ]
    return DomainClassifier(domains, Pipeline(stages=steps).fit(sample.withColumn("label", places[F.col("label")])), learned)


def with_posteriors(docs: DataFrame, classifier: DomainClassifier) -> DataFrame:
    """`docs` with its number of tokens and its posteriors, one per domain."""
    words = F.col(WORDS)
    # Texts are cut once: an empty first or last word stands before or after white space.
    tokens = F.size(words) - (F.get(words, F.lit(0)) == "").cast("int") - ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("int")
    docs = docs.withColumn(WORDS, _words(F.col("text"))).withColumn(TOKENS, tokens.cast("double"))
    if classifier.model is None:
        ones = [F.lit(1.0 if i in classifier.learned else 0.0) for i in range(len(classifier.domains))]
        return docs.withColumn(POSTERIORS, F.array(*ones).cast("array<double>")).drop(WORDS)
    scored = classifier.model.transform(docs).withColumn(SHARES, vector_to_array(PROBABILITY))
    # No transform over the places: Catalyst would move the whole model into its lambda, and run it once per domain.
    known = [F.get(SHARES, F.lit(classifier.learned.index(i))) if i in classifier.learned else F.lit(0.0) for i in range(len(classifier.domains))]
    return scored.withColumn(POSTERIORS, F.array(*known)).drop(WORDS, COUNTS, SHARES, RAW, PROBABILITY, BEST)


@dataclass(frozen=True)
class Rates:
    start: float
    steps: tuple[tuple[float, ...], ...]
    residual: tuple[float, ...]  # of each domain, as a share of all tokens
    converged: bool = True

    def column(self) -> Column:
        """The rate of a row with posteriors."""
        if not self.steps:
            return F.lit(self.start)
        steps = F.array(*[F.array(*map(F.lit, g)) for g in self.steps])

        def step(rate: Column, g: Column) -> Column:
            down = sum((F.get(g, F.lit(k)) * F.get(POSTERIORS, F.lit(k)) for k in range(len(self.residual))), F.lit(0.0))
            return F.greatest(F.lit(0.0), rate - down)

        return F.aggregate(steps, F.lit(self.start), step)


def solve(scored: DataFrame, targets: np.ndarray, tolerance: float = 1e-5, most: int = 100) -> Rates:
    """Rates for which the tokens of every domain come to `targets` (in tokens), within `tolerance` of all tokens."""
    size = len(targets)
    t, p = F.col(TOKENS), [F.get(POSTERIORS, F.lit(k)) for k in range(size)]
    total = scored.agg(F.sum(t)).head()[0] or 0.0
    if not size or not total:
        return Rates(1.0, (), ())
    moving = F.when(F.col("rate") > 0, t).otherwise(F.lit(0.0))
    sums = [F.sum(F.col("rate") * t * p[k]).alias(f"e{k}") for k in range(size)]
    sums += [F.sum(moving * p[i] * p[j]).alias(f"m{i}_{j}") for i in range(size) for j in range(i, size)]
    start, steps, before = float(targets.sum() / total), [], np.inf
    while True:
        rates = Rates(start, tuple(steps), (0.0,) * size)
        row = scored.withColumn("rate", rates.column()).agg(*sums).head()
        residual = (np.array([row[f"e{k}"] for k in range(size)]) - targets) / total
        error = float(np.abs(residual).max())
        if error <= tolerance or len(steps) == most:
            return Rates(start, tuple(steps), tuple(float(x) for x in residual), error <= tolerance)
        gram = np.array([[row[f"m{min(i, j)}_{max(i, j)}"] for j in range(size)] for i in range(size)]) / total
        length = 1.0 if error < before else 0.5  # rows that come back above 0 can make a step too long
        steps.append(tuple(float(x) for x in length * np.linalg.solve(gram + 1e-9 * np.eye(size), residual)))
        before = error


def _target_tokens(weights: Mapping[str, float], classifier: DomainClassifier, budget: float) -> np.ndarray:
    """The domains that were learned share the budget."""
    wanted = np.array([weights.get(d, 0.0) if i in classifier.learned else 0.0 for i, d in enumerate(classifier.domains)])
    return budget * wanted / wanted.sum() if wanted.sum() else np.zeros(len(wanted))


def find_rates(scored: DataFrame, classifier: DomainClassifier, weights: Mapping[str, float], share: float) -> Rates:
    """Rates for a mix of `share` times the corpus' tokens; `scored` is stored, as every step reads it.

    `weights` are the domains' parts of the mix; domains without a weight are to get no tokens.
    """
    total = scored.agg(F.sum(TOKENS)).head()[0] or 0.0
    return solve(scored, _target_tokens(weights, classifier, share * total))


def document_rates(docs: DataFrame, classifier: DomainClassifier, weights: Mapping[str, float], share: float) -> DataFrame:
    """doc_id, n_tokens, posteriors, rate, copies (the rate rounded up or down by a hash of doc_id), residual and converged:
    the largest share of the tokens by which a domain misses its target, and whether that is within the tolerance."""
    scored = stage(with_posteriors(docs.select("doc_id", "text"), classifier).select("doc_id", TOKENS, POSTERIORS), "posteriors")
    rates = find_rates(scored, classifier, weights, share)
    return scored.select(
        "doc_id", F.col(TOKENS).cast("long").alias("n_tokens"), F.col(POSTERIORS).alias("posteriors"), rates.column().alias("rate")
    ).withColumns({
        "copies": _copies(F.col("rate"), F.col("doc_id")),
        "residual": F.lit(max((abs(x) for x in rates.residual), default=0.0)), "converged": F.lit(rates.converged),
    })


def _copies(rate: Column, key: Column) -> Column:
    draw = F.pmod(F.xxhash64(F.lit("copies"), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + draw).cast("int")


def mixed(docs: DataFrame, classifier: DomainClassifier, weights: Mapping[str, float], share: float) -> DataFrame:
    """The rows of `docs`, each as often as its rate says: not at all, once or several times."""
    # Stored with its posteriors: as expressions they would be repeated in every use of the rate.
    scored = stage(with_posteriors(docs, classifier), "scored")
    rates = find_rates(scored, classifier, weights, share)
    taken = scored.withColumn("_mix_copies", _copies(rates.column(), F.col("doc_id"))).filter("_mix_copies > 0")
    return taken.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*docs.columns)
