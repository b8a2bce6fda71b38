"""Mixing to target weights by soft domain membership, in DataFrame functions alone.

1. A classifier learned from a labelled table (naive Bayes over BUCKETS hashed words, log-likelihoods
   tempered by the root of the text's length) gives every document a posterior over the domains.
2. A document's rate is how often it is to be seen. Rates r >= 0 are fitted by projected gradient so
   that the expected tokens of each domain, sum_i r_i * tokens_i * posterior_ik, match their targets in the
   least-squares sense. The loss of domain k is weighted by 1 / g_k and document i's step by 1 / tokens_i
   (g_k: the domain's share at rate 1), for which a step of 1 always descends. One step is one aggregation of
   as many sums as domains; a document's rate after any number of steps follows from its posterior and the
   steps' few numbers, so no state of the documents is kept or shuffled. If the steps do not reach the
   targets, a damped Newton method on the same problem's dual, of one step's form, is tried.
3. Copies: the whole part of the rate, and one more with the rest as probability, decided by a hash.

Learning uses at most `max_rows` labelled rows (20,000: those with the smallest hash of the id); its
counts, domains x BUCKETS at most, reach the driver, as do each step's sums. Everything else covers all rows.

Defined results: null or empty text has no tokens and the prior as posterior; rows are treated one by
one, so repeated rows each count; a null id is allowed; labelled rows without domain are ignored; without
labelled rows there is no domain and every rate is 1; other columns are ignored or kept.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrum.llm.common import written

BUCKETS = 4096
MAX_DOMAINS = 64
MISS = 0.001  # largest distance of a share from its target that counts as met
_SPACE = "[\\x20\\x09-\\x0D]+"


def _buckets(text: Column) -> Column:
    """The hash bucket of each word, lower case."""
    words = F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), _SPACE), lambda w: w != "")
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


@dataclass(frozen=True)
class Classifier:
    domains: tuple[str, ...]
    prior: tuple[float, ...]  # logarithms
    words: tuple[tuple[float, ...], ...]  # by domain and bucket, logarithms

    def posteriors(self, buckets: Column) -> Column:
        """array<double> by domain, of an array of word buckets."""
        temper = F.sqrt(F.greatest(F.size(buckets), F.lit(1)).cast("double"))

        def total(k: int) -> Column:
            table = F.split(F.lit(",".join(map(repr, self.words[k]))), ",").cast("array<double>")  # folded to a constant
            return F.lit(self.prior[k]) + F.aggregate(buckets, F.lit(0.0), lambda a, b: a + F.get(table, b)) / temper

        scores = F.array(*map(total, range(len(self.domains))))
        shifted = F.element_at(F.transform(F.array(scores), lambda s: F.transform(s, lambda x: F.exp(x - F.array_max(s)))), 1)
        return F.element_at(F.transform(F.array(shifted), lambda s: F.transform(s, lambda x: x / F.aggregate(s, F.lit(0.0), lambda a, y: a + y))), 1)


def learn(docs: DataFrame, labelled: DataFrame, id_column: str = "doc_id", text: str = "text", domain: str = "domain", max_rows: int = 20_000) -> Classifier:
    """labelled has (id, domain). The sample of ids has at most max_rows rows, so its broadcast is bounded."""
    sample = labelled.select(labelled[id_column].cast("long").alias("id"), labelled[domain].cast("string").alias("domain")).where("id IS NOT NULL AND domain IS NOT NULL")
    sample = sample.orderBy(F.xxhash64("id"), "id", "domain").limit(max_rows)
    texts = docs.select(docs[id_column].cast("long").alias("id"), docs[text].alias("text"))
    rows = texts.join(F.broadcast(sample), "id")
    found = rows.select("domain", F.explode_outer(_buckets(F.col("text"))).alias("bucket")).groupBy("domain", "bucket").count().collect()
    sizes = {r.domain: r["count"] for r in rows.groupBy("domain").count().collect()}
    domains = tuple(sorted(sizes))
    if len(domains) > MAX_DOMAINS:
        raise ValueError(f"{len(domains)} domains; at most {MAX_DOMAINS}")
    counts = {d: [0.5] * BUCKETS for d in domains}
    for r in found:
        if r.bucket is not None:
            counts[r.domain][r.bucket] += r["count"]
    everything = sum(sizes.values())
    return Classifier(domains, tuple(math.log(sizes[d] / everything) for d in domains), tuple(tuple(round(math.log(c / sum(counts[d])), 6) for c in counts[d]) for d in domains))


@dataclass(frozen=True)
class Rates:
    """The fit: what a rate is as a function of a posterior, and how close the totals came."""

    steps: tuple[tuple[float, ...], ...]
    scale: float
    targets: tuple[float, ...]  # shares
    reached: tuple[float, ...]
    floor: float = 0.0  # least rate of the projection, before scaling

    def of(self, posterior: Column) -> Column:
        return _rate(posterior, self.steps, self.floor) * F.lit(self.scale)

    def miss(self) -> float:
        """The largest distance of a share from its target."""
        return max((abs(a - b) for a, b in zip(self.targets, self.reached, strict=True)), default=0.0)

    def checked(self) -> Rates:
        """The same, with a warning if a target is missed by more than MISS."""
        if self.miss() > MISS:
            warnings.warn(f"no rates found that meet the targets: wanted shares {self.targets}, reached {self.reached}", RuntimeWarning, stacklevel=2)
        return self


def _rate(posterior: Column, steps: tuple[tuple[float, ...], ...], floor: float = 0.0) -> Column:
    """Rate 1, then every step followed by the projection on rates of `floor` or more."""
    table = F.split(F.lit(",".join(repr(x) for step in steps for x in step)), ",").cast("array<double>") if steps else None
    if table is None:
        return F.lit(1.0)
    n = len(steps[0])
    move = lambda t: F.aggregate(F.zip_with(posterior, F.slice(table, t * n + 1, n), lambda p, v: p * v), F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(steps) - 1)), F.lit(1.0), lambda r, t: F.greatest(F.lit(floor), r - move(t)))


def fit(members: DataFrame, domains: int, targets: list[float] | None = None, temper: float = 0.7, least_rate: float | None = None, max_steps: int = 40, tolerance: float = 1e-6) -> Rates:
    """Fit rates on rows (tokens, posterior). `targets` are the domains' wanted shares of all tokens;
    by default their shares raised to `temper`, as usual for several languages. With least_rate the
    rates are that or more, for mixes that lose no document: they are scaled so that the smallest is that (the
    shares stay). If few documents would make that a large factor, the projection is on rates over a
    bound instead; no domain's share falls below its share at rate 1 times the bound, so the bound is half
    the least ratio of target and share, or less until the targets are met. Whether they are, miss() tells."""
    def sums(steps: tuple, floor: float = 0.0) -> list[float]:
        weight = F.col("tokens") * _rate(F.col("posterior"), steps, floor)
        row = members.agg(*(F.coalesce(F.sum(weight * F.get("posterior", F.lit(k))), F.lit(0.0)).alias(f"s{k}") for k in range(domains))).first()
        return [float(x) for x in row]

    now = sums(()) if domains else []
    size = sum(now)
    if not size:
        return Rates((), 1.0, (), ())
    share = [x / size for x in now]
    wanted = targets or [s**temper for s in share]
    if len(wanted) != domains or min(wanted) < 0 or not sum(wanted):
        raise ValueError("targets: one share for each domain, 0 or more")
    wanted = [w / sum(wanted) for w in wanted]

    def descend(floor: float) -> Rates:
        steps: tuple[tuple[float, ...], ...] = ()
        at = now
        while len(steps) < max_steps:
            rest = [x / size - w for x, w in zip(at, wanted, strict=True)]
            if max(map(abs, rest)) < tolerance:
                break
            steps += (tuple(r / s if s else 0.0 for r, s in zip(rest, share, strict=True)),)
            at = sums(steps, floor)
        slow = Rates(steps, 1.0, tuple(wanted), tuple(x / size for x in at), floor)
        return slow if slow.miss() < tolerance else min(slow, newton(floor), key=Rates.miss)

    def newton(floor: float) -> Rates:
        """One step u in place of many, for posteriors that hardly differ: rates max(floor, 1 - posterior * u)."""
        goal, u = np.array(wanted), np.zeros(domains)
        at = np.array(now) / size
        for _ in range(max_steps):
            if np.abs(at - goal).max() < tolerance:
                break
            rate = _rate(F.col("posterior"), (tuple(u.tolist()),), floor)
            free = F.when(rate > floor, F.col("tokens")).otherwise(0)
            pairs = [(k, m) for k in range(domains) for m in range(k + 1)]
            row = members.agg(*(F.sum(free * F.get("posterior", F.lit(k)) * F.get("posterior", F.lit(m))).alias(f"h{k}_{m}") for k, m in pairs)).first()
            slope = np.zeros((domains, domains))
            for (k, m), x in zip(pairs, row, strict=True):
                slope[k, m] = slope[m, k] = x / size
            way, factor = np.linalg.pinv(slope, rcond=1e-9) @ (at - goal), 1.0
            while factor > 1 / 64:
                tried = np.array(sums((tuple((u + factor * way).tolist()),), floor)) / size
                if np.linalg.norm(tried - goal) < (1 - factor / 100) * np.linalg.norm(at - goal):
                    break
                factor /= 2
            else:
                break  # no step comes closer
            u, at = u + factor * way, tried
        return Rates((tuple(u.tolist()),), 1.0, tuple(wanted), tuple(at.tolist()), floor)

    found = descend(0.0)
    if least_rate is None:
        return found
    smallest = members.where("tokens > 0").agg(F.min(found.of(F.col("posterior"))).alias("r")).first()["r"]
    bound = min(w / s for w, s in zip(wanted, share, strict=True) if s) / 2
    if not bound:
        raise ValueError("a domain with target 0 has documents, and none may be lost")
    if smallest >= bound and found.miss() <= MISS:
        return replace(found, scale=least_rate / smallest)
    tried: list[Rates] = []
    for floor in (bound, bound / 2, bound / 4, bound / 8):
        tried.append(descend(floor))
        if tried[-1].miss() <= MISS:
            break
    found = min(tried, key=lambda r: max(MISS, r.miss()))
    return replace(found, scale=least_rate / found.floor)


def membership(docs: DataFrame, model: Classifier, text: str = "text", keep: str = "*") -> DataFrame:
    """docs' columns as struct `row` (or one column `keep`), with tokens (words) and posterior."""
    kept = F.struct("*") if keep == "*" else F.col(keep)
    rows = docs.select(kept.alias("row"), _buckets(docs[text]).alias("buckets"))
    return rows.select("row", F.size("buckets").cast("long").alias("tokens"), model.posteriors(F.col("buckets")).alias("posterior"))


def copies(rate: Column, *by: Column) -> Column:
    """How many copies of a row: the rate, rounded up or down by a hash of `by` so that it holds on average."""
    whole = F.floor(rate)
    chance = F.pmod(F.xxhash64(F.lit("copies"), *by), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (whole + F.when(chance < rate - whole, 1).otherwise(0)).cast("int")


def rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, id_column: str = "doc_id", text: str = "text", least_rate: float | None = None, domain: str = "domain") -> tuple[DataFrame, Classifier, Rates]:
    """(doc_id, tokens, posterior, rate, copies) for every row, the classifier and the fit. The small table
    of tokens and posteriors is written to the shared folder, as each step reads it."""
    model = learn(docs, labelled, id_column, text, domain)
    if not model.domains:
        rows = docs.select(docs[id_column].cast("long").alias("doc_id"), F.size(_buckets(docs[text])).cast("long").alias("tokens"), F.array().cast("array<double>").alias("posterior"), F.lit(1.0).alias("rate"), F.lit(1).alias("copies"))
        return rows, model, Rates((), 1.0, (), ())
    members = written(membership(docs, model, text, id_column), "membership")
    found = fit(members, len(model.domains), [targets.get(d, 0.0) for d in model.domains] if targets else None, least_rate=least_rate)
    rows = members.select(F.col("row").cast("long").alias("doc_id"), "tokens", "posterior", found.of(F.col("posterior")).alias("rate"))
    return rows.withColumn("copies", copies(F.col("rate"), F.col("doc_id"), F.col("tokens"))), model, found


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, id_column: str = "doc_id", text: str = "text", domain: str = "domain") -> DataFrame:
    """The rows of mix()."""
    return mix(docs, labelled, targets, id_column, text, domain)[0]


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, id_column: str = "doc_id", text: str = "text", domain: str = "domain") -> tuple[DataFrame, Rates]:
    """docs with every row as often as its rate says, at least once (least_rate 1), and the fit with the target
    and reached shares. No document is lost; a ValueError says so if a target of 0 rules that out, a warning
    gives the shares if no rates were found that meet the targets."""
    _, model, found = rates(docs, labelled, targets, id_column, text, 1.0, domain)
    if not model.domains:
        return docs, found
    found.checked()
    rows = membership(docs, model, text)
    rate = found.of(F.col("posterior"))
    rows = rows.select("row", F.greatest(F.lit(1), copies(rate, F.col("row").getField(id_column).cast("long"), F.col("tokens"))).alias("copies"))
    rows = rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return rows.select(*(F.col("row").getField(name).alias(name) for name in docs.columns)), found
