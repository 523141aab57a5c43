"""Rates at which documents are taken so that domains reach target shares of the tokens.

The domain of a document is known only for a labelled table; for all others a classifier learned from
it gives the chance of each domain, and a document counts for every domain by that chance. The rates
are those nonnegative numbers, above 1 where a domain is scarce, for which the expected tokens of every
domain are closest to the targets,
found by projected gradient steps of which each is one aggregation over the documents' chances.

Everything here is DataFrame operations; the driver sees a handful of sums per step.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.runtime import materialize, scratch_scope

_LABELLED = 50_000  # labels that the model is learned from, about
_BROADCAST_WORDS = 200_000  # telling words up to which they are broadcast
_SURE = 4.0  # standard deviations by which a word's count must differ to be evidence
_PRIOR = 2.0  # occurrences that pull a word towards its overall frequency
_STRENGTH = 6.0  # largest weight of one word, as a logarithm of odds
_BINS = 12  # of the logarithm of odds, on either side of 0


def domain_of_labels(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Domain of a labelled row: junk, toxic or clean; null where a label is missing."""
    return (
        F.when(F.col(quality) == 0, "junk").when(F.col(toxic) == 1, "toxic")
        .when((F.col(quality) == 1) & (F.col(toxic) == 0), "clean")
    )


def _words(text: str) -> Column:
    raw = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[ \t\n\x0B\f\r]+")
    return F.filter(raw, lambda w: w != "")


def _with_words(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``__words`` (their number) and ``__hashes``: of the different words, and of two traits.

    The traits are how often words repeat and how many words hold other characters than letters,
    in eighths; as words of their own they let the classifier see what single words do not show.
    """
    def named(words: Column, different: Column) -> Column:
        marked = F.size(F.filter(different, lambda w: w.rlike("[^\\p{L}.,]")))
        eighths = [
            F.floor(8 * F.size(different) / F.greatest(F.size(words), F.lit(1))),
            F.floor(8 * marked / F.greatest(F.size(different), F.lit(1))),
        ]
        traits = [F.concat(F.lit(f"\n{i} "), part.cast("string")) for i, part in enumerate(eighths)]
        hashes = F.transform(F.concat(different, F.array(*traits)), lambda w: F.xxhash64(w))
        return F.struct(F.size(words).cast("long").alias("n"), hashes.alias("hashes"))

    held = _once(_words(text), lambda words: _once(F.array_distinct(words), lambda d: named(words, d)))
    # One generated row per row, so that the words are not split again for each of the two fields.
    plain = [F.col(f"`{c}`") for c in docs.columns]
    found = docs.select(*plain, F.explode(F.array(held)).alias("__held"))
    return found.select(*plain, F.col("__held.n").alias("__words"), F.col("__held.hashes").alias("__hashes"))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def fit_domains(
    docs: DataFrame, labelled: DataFrame, domains: list[str], id_column: str = "doc_id",
    text_column: str = "text", domain_column: str = "domain", sample: int = _LABELLED,
    broadcast_words: int = _BROADCAST_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """Telling words, and one row of ``__prior`` and ``__chances``, learned from labelled documents.

    Of more than ``sample`` labels, about that many are taken by a hash of their ids: a bounded number,
    so that they are broadcast and the documents are not shuffled. An equal label given again counts once.

    A word weighs only where the documents of some domain hold it far more or less often than
    documents at large, so that chance does not add up over long texts. All words that do have a row
    each; up to ``broadcast_words`` of them are broadcast, more are joined by a shuffle. ``__prior`` is the log
    frequency of each domain, and ``__chances`` the share of labelled documents that are of a domain,
    by the logarithm of odds that the words alone give it.
    """
    known = labelled.where(F.col(domain_column).isin(domains)).select(
        F.col(id_column).alias("__id"), F.col(domain_column).alias("__domain")
    ).distinct()
    known = materialize(known, "domain-labels")
    share = min(1.0, sample / max(known.count(), 1))
    known = known.where(F.pmod(F.xxhash64(F.lit("labels"), "__id"), F.lit(1 << 30)) < share * (1 << 30))
    held = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("__text"))
    held = materialize(
        _with_words(held.join(F.broadcast(known), "__id").select("__domain", "__text"), "__text").select(
            "__domain", "__hashes", F.monotonically_increasing_id().alias("__row")
        ), "domain-documents"
    )
    of_domain = [F.col("__domain") == d for d in domains]
    zero = F.lit(0.0)
    # One row.
    totals = held.agg(F.array(*[F.coalesce(F.sum(c.cast("double")), zero) for c in of_domain]).alias("docs"))
    totals = materialize(totals, "domain-totals")
    all_docs = F.aggregate("docs", zero, lambda a, x: a + x)

    cells = held.select("__domain", F.explode("__hashes").alias("hash"))
    counts = cells.groupBy("hash").agg(
        F.array(*[F.sum(c.cast("double")) for c in of_domain]).alias("n"), F.count(F.lit(1)).alias("all")
    )
    counts = counts.crossJoin(F.broadcast(totals))
    share = F.col("all") / all_docs

    def surprise(n: Column, of: Column) -> Column:
        return F.abs(n - of * share) / F.sqrt(of * share + 1)

    def weight(n: Column, of: Column) -> Column:
        ratio = F.log((n + _PRIOR * share) / (of + _PRIOR) / share)
        weak = surprise(n, of) <= _SURE
        return F.when(weak, zero).otherwise(F.greatest(F.least(ratio, F.lit(_STRENGTH)), F.lit(-_STRENGTH)))

    told = counts.withColumn("sure", F.array_max(F.zip_with("n", "docs", surprise)))
    told = told.where(F.col("sure") > _SURE).select("hash", F.zip_with("n", "docs", weight).alias("w"))
    weights = told.select("hash", *[F.col("w")[i].alias(f"__w{i}") for i in range(len(domains))])
    weights = materialize(weights, "domain-words")
    prior = totals.select(F.transform("docs", lambda x: F.log((x + 1) / (all_docs + len(domains)))).alias("__prior"))
    prior = materialize(prior, "domain-prior")

    # How often the odds are right, by their size.
    bins = _odds(held, weights, prior, len(domains), broadcast_words)
    bins = bins.select("__domain", F.posexplode("__odds").alias("i", "at"))
    # At most one row per domain and bin.
    measured = bins.groupBy("i", "at").agg(
        F.array(*[F.sum((F.col("__domain") == d).cast("double")) for d in domains]).alias("right"),
        F.count(F.lit(1)).cast("double").alias("all"),
    )
    measured = materialize(measured, "domain-bins")
    columns = []
    for i in range(len(domains)):
        for at in range(2 * _BINS + 1):
            here = (F.col("i") == i) & (F.col("at") == at)
            right = F.coalesce(F.max(F.when(here, F.col("right")[i])), zero)
            every = F.coalesce(F.max(F.when(here, F.col("all"))), zero)
            columns.append((F.struct(right.alias("right"), every.alias("all")), F.exp(F.col("__prior")[i])))
    counted = measured.agg(F.array(*[c for c, _ in columns]).alias("cells"))
    rated = counted.crossJoin(F.broadcast(prior))
    chances = [
        (F.col("cells")[j]["right"] + base) / (F.col("cells")[j]["all"] + 1) for j, (_, base) in enumerate(columns)
    ]
    rated = rated.select("__prior", F.array(*chances).alias("__chances"))
    return weights, materialize(rated, "domain-chances")


def _odds(
    docs: DataFrame, weights: DataFrame, prior: DataFrame, n_domains: int, broadcast_words: int = _BROADCAST_WORDS
) -> DataFrame:
    """Adds ``__odds``: for each domain the bin of the logarithm of its odds, from the telling words.

    ``docs`` is a written table with ``__row`` and ``__hashes``. Words of a row are in one task, so
    their weights are added up before the sums of rows, and only those, are shuffled, unless there are
    more telling words than may be broadcast. ``weights`` is a written table.
    """
    names = [f"__w{i}" for i in range(n_domains)]
    words = docs.select("__row", F.explode("__hashes").alias("hash"))
    if weights.count() <= broadcast_words:
        weights = F.broadcast(weights)
    found = words.join(weights, "hash").groupBy("__row").agg(*[F.sum(w).alias(w) for w in names])
    joined = docs.drop("__hashes").join(found, "__row", "left").crossJoin(F.broadcast(prior))
    logs = [F.coalesce(F.col(w), F.lit(0.0)) + F.col("__prior")[i] for i, w in enumerate(names)]
    bins = []
    for i, own in enumerate(logs):
        others = [x for j, x in enumerate(logs) if j != i] or [own - 50]
        best = F.greatest(*others) if len(others) > 1 else others[0]
        odds = F.greatest(F.least(own - best, F.lit(float(_BINS))), F.lit(-float(_BINS)))
        bins.append(F.round(odds).cast("int") + _BINS)
    return joined.withColumn("__odds", F.array(*bins)).drop(*names, *prior.columns)


def domain_posteriors(
    docs: DataFrame, model: tuple[DataFrame, DataFrame], domains: list[str], text_column: str = "text",
    broadcast_words: int = _BROADCAST_WORDS,
) -> DataFrame:
    """Every row with ``n_tokens`` (words of the text) and ``p_<domain>``, which add up to 1.

    A text without words, or null, has no tokens and the frequencies of the labels. The table is
    written once, so that the numbers of its rows stay what they are.
    """
    weights, chances = model
    kept = [f"`{c}`" for c in docs.columns if c != text_column]
    numbered = _with_words(docs, text_column).select(
        *kept, "__words", "__hashes", F.monotonically_increasing_id().alias("__row")
    )
    numbered = materialize(numbered, "domain-words-of-documents")
    scored = _odds(numbered, weights, chances.select("__prior"), len(domains), broadcast_words)
    scored = scored.crossJoin(F.broadcast(chances))
    width = 2 * _BINS + 1
    raw = [F.col("__chances")[i * width + F.col("__odds")[i]] for i in range(len(domains))]
    raw = [F.when(F.col("__words") == 0, F.exp(F.col("__prior")[i])).otherwise(x) for i, x in enumerate(raw)]
    total = sum(raw[1:], raw[0])
    shares = [(x / total).alias(f"p_{d}") for x, d in zip(raw, domains)]
    return scored.select(*kept, F.col("__words").alias("n_tokens"), *shares)


@dataclass(frozen=True)
class Fit:
    """The rate of a row as an expression of its ``p_<domain>`` columns, and how far it gets.

    ``wanted`` and ``reached`` are the tokens of each domain, ``present`` those before.
    """

    rate: Column
    present: dict[str, float]
    wanted: dict[str, float]
    reached: dict[str, float]

    def shares(self) -> dict[str, tuple[float, float]]:
        """The wanted and the reached share of each domain of all tokens."""
        wanted, reached = sum(self.wanted.values()) or 1.0, sum(self.reached.values()) or 1.0
        return {d: (self.wanted[d] / wanted, self.reached[d] / reached) for d in self.wanted}

    def short(self, tolerance: float = 0.01) -> dict[str, tuple[float, float]]:
        """The shares of the domains whose tokens are off their target by more than ``tolerance`` of it."""
        off = [d for d, t in self.wanted.items() if abs(self.reached[d] - t) > tolerance * t]
        return {d: s for d, s in self.shares().items() if d in off}


def fit_rates(
    docs: DataFrame, weights: Mapping[str, float], anchor: str, steps: int = 60, tolerance: float = 1e-4
) -> Fit:
    """Rates for the targets of ``weights``, and the tokens that they reach.

    With ``s`` the present tokens of a domain and ``T`` its target, the rates minimise the sum of
    ``(expected - T)^2 / s``. A step takes from each rate the mean of the relative surpluses of its
    domains by their chances, which is the gradient measured per token, and cuts it at 0. The
    matrix of these steps is stochastic, so that a step of length 1 never overshoots.
    The ``anchor`` domain is to keep the tokens it has, and the others get theirs by ``weights`` in
    proportion, with rates above 1 where they have fewer. The steps end when the root of the weighted
    mean square of the relative surpluses is below ``tolerance``, when it hardly falls any more, or after
    ``steps``; targets that are not reached then (of a domain without tokens, or one that the classifier
    hardly tells from others) are in ``Fit.short``.
    """
    domains = list(weights)
    tokens = F.col("n_tokens")

    # Rows of equal chances have equal rates. There are only as many different ones as bins of the
    # odds combine to, whatever the number of documents, so the steps go over those.
    cells = docs.groupBy(*[f"p_{d}" for d in domains]).agg(F.sum("n_tokens").alias("n_tokens"))
    cells = materialize(cells.coalesce(1), "mixing-cells")
    chances = [F.col(f"p_{d}") for d in domains]

    def totals(rate: Column) -> list[float]:
        rated = cells.select(*[f"p_{d}" for d in domains], "n_tokens", rate.alias("rate"))
        sums = [F.sum(F.col("rate") * tokens * p) for p in chances]
        return [x or 0.0 for x in rated.agg(*sums).first()]

    present = totals(F.lit(1.0))
    budget = present[domains.index(anchor)] / weights[anchor]
    targets = [weights[d] * budget for d in domains]
    past: list[list[float]] = []

    def rate() -> Column:
        """The rate after the steps so far: a loop over their surpluses, so that the plan stays as small as it is."""
        if not past:
            return F.lit(1.0)
        surpluses = F.array(*[F.array(*map(F.lit, step)) for step in past])

        def after(r: Column, step: Column) -> Column:
            slope = sum((p * step[i] for i, p in enumerate(chances)), F.lit(0.0))
            return F.greatest(r - slope, F.lit(0.0))

        return F.aggregate(surpluses, F.lit(1.0), after)

    before, reached = math.inf, present
    for _ in range(steps):
        surplus = [(x - t) / s if s > 0 else 0.0 for x, t, s in zip(reached, targets, present)]
        loss = sum(e * e * s for e, s in zip(surplus, present)) / max(sum(present), 1.0)
        if loss < tolerance**2 or before - loss <= 1e-4 * loss:
            break
        before = loss
        past.append(surplus)
        reached = totals(rate())
    return Fit(rate(), *(dict(zip(domains, x)) for x in (present, targets, reached)))


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    weights: Mapping[str, float],
    anchor: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    domain_column: str = "domain",
    columns: list[str] | None = None,
    sample: int = _LABELLED,
    broadcast_words: int = _BROADCAST_WORDS,
) -> DataFrame:
    """Every row with ``n_tokens``, ``p_<domain>``, ``rate`` and ``copies``.

    ``copies`` is the rate rounded down or up by a hash of the row's id and text, so that its mean is the
    rate and every run agrees. ``columns`` are the input columns to keep, all by default; those
    called like an added one are replaced. Without labels every domain is as likely as the others; an
    empty table gives no rows; repeated rows get the same rate each. The classifier learns from about
    ``sample`` labels; up to ``broadcast_words`` words that it goes by are broadcast. Where the tokens of a domain end more
    than a hundredth off their target, a warning names its wanted and reached share; ``shares`` has those of all.
    """
    domains = list(weights)
    added = {"n_tokens", "rate", "copies", *(f"p_{d}" for d in domains)}
    kept = [c for c in (columns or docs.columns) if c.lower() not in added]
    draw = F.pmod(F.xxhash64(F.lit("copies"), id_column, text_column), F.lit(1 << 30)) / float(1 << 30)
    # What the chances come from is deleted behind them; the rows with their chances stay.
    with scratch_scope(docs.sparkSession):
        model = fit_domains(docs, labelled, domains, id_column, text_column, domain_column, sample, broadcast_words)
        plain = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text_column).alias("__in_text"), draw.alias("__draw"))
        found = domain_posteriors(plain, model, domains, "__in_text", broadcast_words)
        found = materialize(found, "mixing-posteriors", lasting=True)
        fit = fit_rates(found, weights, anchor)
    if fit.short():
        named = ", ".join(f"{d} {t:.4f} wanted, {x:.4f} reached" for d, (t, x) in fit.short().items())
        warnings.warn(f"mixing ends short of its targets; shares of the tokens: {named}", stacklevel=2)
    rated = found.withColumn("rate", fit.rate)
    more = (F.col("__draw") < F.col("rate") - F.floor("rate")).cast("long")
    return rated.withColumn("copies", F.floor("rate").cast("long") + more).drop("__draw")


def shares(mixed: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """One row per domain: ``domain``, and its shares of the tokens ``wanted``, ``reached`` by the rates and
    ``dealt`` by the copies, each null where there are no tokens at all.
    """
    total = sum(weights.values())

    def share(by: str, d: str) -> Column:
        tokens = F.col("n_tokens") * F.col(by)
        every = F.sum(tokens)
        return F.when(every > 0, F.sum(tokens * F.col(f"p_{d}")) / every)

    rows = [
        F.struct(
            F.lit(d).alias("domain"), F.lit(w / total).alias("wanted"),
            share("rate", d).alias("reached"), share("copies", d).alias("dealt"),
        )
        for d, w in weights.items()
    ]
    return mixed.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def taken(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The rows in the numbers their ``copies`` say."""
    whole = mixed.where("copies > 0")
    return whole.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(*columns)
