"""Quality classifier: evidence of the document combined with empirical-Bayes posteriors of its host and path.

Two questions are answered for each document, whether it is of low quality and whether it is toxic. A logistic model
over surface measures and indicator words gives the document's evidence as a log likelihood ratio; it is fitted on at
most SAMPLE labelled rows, those with the smallest hash of their id. Site rates come from grouped sums of the model's
probabilities over all documents: a host's rate is shrunk towards the global rate, a path's towards its host's, by
strengths that the spread between sites itself suggests, so sparse sites lean on what lies above them. A document's
posterior log odds are its path's log odds plus its own evidence; it is rejected if either posterior exceeds one half.

Defined results: a null text is empty; null hosts and paths are sites of their own; without labels of both kinds a
question has no evidence and rejects nothing; labels of unknown documents and null labels are not used; of repeated
labels the worse counts; rows that repeat an id are judged each by its own text.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import NO_ID, lookup, map_arrow, original_id, stored, text_mark, unused

SAMPLE = 20_000
INDICATORS, LEAST_WEIGHT = 2000, 2.0
PENALTY, STRENGTH = 1.0, (1.0, 10_000.0)
QUESTIONS = ("low", "toxic")

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'")
_UPPER, _DIGITS, _SPACE = bytes(range(65, 91)), bytes(range(48, 58)), bytes((9, 10, 11, 12, 13, 32))


def words(body: bytes) -> list[bytes]:
    return body.translate(_LETTERS).split()


def measures(body: bytes, found: list[bytes]) -> list[float]:
    """Surface measures of a text and its words."""
    size, n = max(1, len(body.translate(None, _SPACE))), max(1, len(found))
    share = lambda kind: (len(body) - len(body.translate(None, kind))) / size
    repeats = sum(a == b for a, b in zip(found, found[1:])) / n
    lines = body.split(b"\n")
    return [math.log1p(len(found)), share(_SYMBOLS), share(_UPPER), share(_DIGITS), body.count(b"|") / n, len(set(found)) / n / (1 + 0.1 * math.log(n)),
            repeats, min(size / n, 30.0), len(lines) / n, len(set(lines)) / len(lines)]


MEASURES = 10


def indicators(sample: DataFrame) -> list[dict[bytes, float]]:
    """For each question, the words that speak for a yes: at most INDICATORS, with their log odds.

    A word must be far likelier under a yes (LEAST_WEIGHT) and its association beyond what the best of as many words
    would show by chance. ``sample`` has body, low, toxic (0, 1 or null)."""
    def count(batch: pa.RecordBatch):
        seen: dict[bytes, list[int]] = {}
        for body, low, toxic in zip(*(c.to_pylist() for c in batch.columns)):
            for w in set(words(body)):
                own = seen.setdefault(w, [0, 0, 0, 0])
                if low is not None:
                    own[low] += 1
                if toxic is not None:
                    own[2 + toxic] += 1
        yield {"word": list(seen), **{f"n{k}": [v[k] for v in seen.values()] for k in range(4)}}

    counts = map_arrow(sample.select("body", "low", "toxic"), count, "word binary, n0 long, n1 long, n2 long, n3 long")
    counts = stored(counts.groupBy("word").agg(*(F.sum(f"n{k}").alias(f"n{k}") for k in range(4))).filter("n1 + n3 > 1"), "words")
    vocabulary = counts.count()
    sizes = sample.agg(*(F.count_if(F.col(q) == v).alias(f"{q}{v}") for q in QUESTIONS for v in (0, 1))).first()
    out = []
    for q, no, yes in (("low", "n0", "n1"), ("toxic", "n2", "n3")):
        a, b = float(sizes[f"{q}1"]), float(sizes[f"{q}0"])
        if not a or not b:
            out.append({})
            continue
        weight = F.log((F.col(yes) + 0.5) / (a + 1)) - F.log((F.col(no) + 0.5) / (b + 1))
        part = lambda n, total, share: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (share * total))).otherwise(0.0)
        share = (F.col(yes) + F.col(no)) / (a + b)
        strength = 2 * (part(yes, a, share) + part(no, b, share))
        best = counts.select("word", weight.alias("weight"), strength.alias("strength")).filter(
            (F.col("weight") >= LEAST_WEIGHT) & (F.col("strength") > 2 * math.log(max(vocabulary, 1)) + 6))
        out.append({bytes(r["word"]): r["weight"] for r in best.orderBy(F.col("strength").desc(), "word").limit(INDICATORS).collect()})
    return out


def _features(body: bytes, lists: list[dict[bytes, float]]) -> list[float]:
    found = words(body)
    row, distinct = measures(body, found), set(found)
    for weights in lists:
        own = [weights[w] for w in distinct if w in weights] if len(distinct) < len(weights) else [x for w, x in weights.items() if w in distinct]
        row += [max(own, default=0.0), math.log1p(len(own))]
    return row


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Means, scales, weights (the first the intercept) and the log odds of y, by Newton steps with an L2 penalty."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = np.c_[np.ones(len(x)), np.clip((x - mean) / scale, -10, 10)]
    w, ridge = np.zeros(z.shape[1]), np.r_[1e-3, np.full(x.shape[1], PENALTY)]
    loss = lambda w: np.logaddexp(0, -(2 * y - 1) * (z @ w)).sum() + (ridge * w * w).sum() / 2
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return mean, scale, w, math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))


class Model:
    """Evidence of a text, one log likelihood ratio and one probability per question."""

    def __init__(self, lists: list[dict[bytes, float]], fits: list):
        self.lists, self.fits = lists, fits

    def __call__(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        x = np.array([_features(b, self.lists) for b in bodies]).reshape(len(bodies), MEASURES + 2 * len(QUESTIONS))
        evidence, chance = np.zeros((len(bodies), len(QUESTIONS))), np.zeros((len(bodies), len(QUESTIONS)))
        for k, fit in enumerate(self.fits):
            if fit is not None:
                mean, scale, w, odds = fit
                log_odds = w[0] + np.clip((x - mean) / scale, -10, 10) @ w[1:]
                evidence[:, k] = log_odds - odds
                chance[:, k] = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
        return evidence, chance


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """``docs`` has id and body; ``labels`` doc_id, quality, toxic. At most ``sample`` labelled rows are used."""
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        (1 - F.min(F.when(F.col("quality").isin(0, 1), F.col("quality")))).alias("low"), F.max(F.when(F.col("toxic").isin(0, 1), F.col("toxic"))).alias("toxic"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample)  # at most `sample` rows of three numbers: a bounded broadcast
    labelled = stored(docs.select("id", "body").join(F.broadcast(chosen), "id").select("body", F.col("low").cast("int").alias("low"), F.col("toxic").cast("int").alias("toxic")), "labelled")
    lists = indicators(labelled)

    def measured(batch: pa.RecordBatch):
        yield {"x": [_features(b, lists) for b in batch.column(0).to_pylist()], "low": batch.column(1), "toxic": batch.column(2)}

    rows = map_arrow(labelled, measured, "x array<double>, low int, toxic int").toArrow()
    fits = []
    for q in QUESTIONS:
        y = rows.column(q).to_numpy().astype(float) if rows.num_rows else np.zeros(0)
        given = ~np.isnan(y)
        if len({*y[given].tolist()}) < 2:
            fits.append(None)
            continue
        x = np.array(rows.column("x").to_pylist())[given]
        fits.append(_logistic(x, y[given]))
    return Model(lists, fits)


def _shrunk(sites: DataFrame, level: str, towards: str, question: str):
    """Rates of a level's sites shrunk towards ``towards``; the strength is found by moments over all sites."""
    n, s = F.col(f"{level}_rows"), F.col(f"{level}_{question}")
    centre = F.col(towards)
    spread = sites.select(F.sum(n).alias("n"), F.count("*").alias("k"), F.sum(n * F.pow(s / n - centre, 2)).alias("between"),
                          F.sum(n * centre * (1 - centre)).alias("within")).first()
    if not spread["n"]:
        return F.lit(0.0)
    within = max(spread["within"] / spread["n"], 1e-12)
    between = max(spread["between"] / spread["n"] - within * spread["k"] / spread["n"], 1e-12)
    strength = min(max(within / between - 1, STRENGTH[0]), STRENGTH[1])
    return (s + strength * centre) / (n + strength)


def site_rates(scored: DataFrame) -> DataFrame:
    """Per (host, path): row counts and the posterior rate of each question at both levels; stored."""
    sums = [F.sum(q).alias(f"path_{q}") for q in QUESTIONS]
    paths = stored(scored.groupBy("site", "host", "path").agg(F.count("*").alias("path_rows"), *sums), "paths")
    hosts = paths.groupBy("host").agg(F.sum("path_rows").alias("host_rows"), *(F.sum(f"path_{q}").alias(f"host_{q}") for q in QUESTIONS))
    whole = paths.agg(F.sum("path_rows").alias("n"), *(F.sum(f"path_{q}").alias(q) for q in QUESTIONS)).first()
    n = whole["n"] or 0
    hosts = stored(hosts.select("*", *(F.lit((whole[q] or 0.0) / n if n else 0.0).alias(f"global_{q}") for q in QUESTIONS)), "hosts")
    hosts = stored(hosts.select("host", "host_rows", *(_shrunk(hosts, "host", f"global_{q}", q).alias(f"host_rate_{q}") for q in QUESTIONS)), "host-rates")
    sites = stored(paths.join(hosts, "host"), "sites")
    return stored(sites.select("site", "path_rows", *(F.col(f"host_rate_{q}") for q in QUESTIONS),
                               *(_shrunk(sites, "path", f"host_rate_{q}", q).alias(f"path_rate_{q}") for q in QUESTIONS)), "site-rates")


def host_and_path(source, lang):
    """A url's host and first folder; any other source is a host, whose paths are its languages."""
    source = F.coalesce(source.cast("string"), F.lit(""))
    parts = F.regexp_extract(source, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    folder = F.regexp_extract(source, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]*)", 1)
    return F.when(parts != "", F.lower(parts)).otherwise(source), F.when(parts != "", folder).otherwise(F.coalesce(lang.cast("string"), F.lit("")))


def judged(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
           sample: int = SAMPLE) -> DataFrame:
    """Per row: ``id``, ``mark`` (of the text), host, path, the posterior probabilities ``p_low`` and ``p_toxic``, the site's
    rates, and ``accepted``."""
    host, path = host_and_path(F.col(f"`{source}`"), F.col(f"`{lang}`"))
    docs = df.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_ID)).alias("id"), host.alias("host"), path.alias("path"),
                     F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("body"))
    model = df.sparkSession.sparkContext.broadcast(fit(docs.filter(F.col("id") != NO_ID), labels, sample))

    def evidence(batch: pa.RecordBatch):
        found, chance = model.value(batch.column(4).to_pylist())
        columns = {"id": batch.column(0), "mark": batch.column(1), "host": batch.column(2), "path": batch.column(3)}
        yield columns | {f"own_{q}": found[:, k] for k, q in enumerate(QUESTIONS)} | {q: chance[:, k] for k, q in enumerate(QUESTIONS)}

    numbers = ", ".join([f"own_{q} double" for q in QUESTIONS] + [f"{q} double" for q in QUESTIONS])
    scored = map_arrow(docs.select("id", text_mark(F.col("body")).alias("mark"), "host", "path", "body"), evidence, f"id long, mark binary, host string, path string, {numbers}")
    scored = stored(scored.withColumn("site", F.xxhash64("host", "path")), "scored")
    total = scored.count()
    out = lookup(scored, site_rates(scored), "site", "path_rows", total)
    for q in QUESTIONS:
        rate = F.least(F.greatest(F.col(f"path_rate_{q}"), F.lit(1e-9)), F.lit(1 - 1e-9))
        out = out.withColumn(f"p_{q}", 1 / (1 + F.exp(-F.least(F.greatest(F.col(f"own_{q}") + F.log(rate / (1 - rate)), F.lit(-500.0)), F.lit(500.0)))))
    return out.withColumn("accepted", (F.col("p_low") <= 0.5) & (F.col("p_toxic") <= 0.5))


def classify(df: DataFrame, labels: DataFrame, key: str = "doc_id", **columns) -> DataFrame:
    """Per row: the id, host, path, host and path rates, p_low, p_toxic, accepted."""
    rates = [f"{level}_rate_{q}" for level in ("host", "path") for q in QUESTIONS]
    return judged(df, labels, key, **columns).select(original_id().alias(key), "host", "path", *rates, "p_low", "p_toxic", "accepted")


def keep_accepted(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **columns) -> DataFrame:
    """The accepted rows of ``df``, all columns as they are."""
    own, mark = unused(df, "id", "mark")
    rejected = judged(df, labels, key, text, **columns).filter("NOT accepted").select(F.col("id").alias(own), F.col("mark").alias(mark)).distinct()
    marked = df.withColumn(own, F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_ID)))
    marked = marked.withColumn(mark, text_mark(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))
    return marked.join(rejected, [own, mark], "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
