"""Quality classifier: document evidence with hierarchical empirical Bayes over sites.

Two logistic models, for low quality and for toxicity, are fitted on a bounded
sample of labelled documents (``SAMPLE``, the least hashes of the ids). Each text of an
id counts once, however many rows hold it, and an id with several labels is bad if one says so. Their
features are shares of characters and words, and the presence of words chosen
by a chi-squared test. Every document gets the probability that it is bad.
Spark sums these probabilities per path and host; the spread between sites
beyond chance gives the strength of the priors, so that a sparse path is drawn to
its host and a sparse host to the global rate. A document's evidence is combined
with the rate of its path, itself left out, and it is kept below ``REJECT``.

Null text counts as empty; a text without words is bad. A null host or path is
a site of its own. Repeated rows are judged alike, each on its own; texts of any length are
judged whole. An empty table gives no rows. Without labels of both kinds a model finds nothing bad.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import LOWER, SPACE, byte_set, drop, filled, saved, signed, slices
from .common import text_bytes, word_hashes, words

#: Labelled documents that the models are fitted on, at most.
SAMPLE = 20_000
#: Words each model may use, the smallest number of documents of one, and its chi-squared.
WORDS = 200
LEAST_DOCS = 5
LEAST_CHI2 = 20.0
#: Probability of being bad from which a document is rejected.
REJECT = 0.5
#: Surface features of a text.
SURFACE = 7
#: Weight of the penalty on coefficients.
RIDGE = 1.0

_SYMBOL = byte_set(*b"!#$%&*+/<=>@[\\]^_`{|}~")
_UPPER = byte_set(*range(65, 91))
_LETTER = byte_set(*range(65, 91), *range(97, 123), *range(128, 256))
_DIGIT = byte_set(*range(48, 58))
#: Marks at a word's ends are not part of the word, for the lexical features.
_EDGE = byte_set(*(c for c in range(33, 127) if not (48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123)))


@dataclass(frozen=True)
class Model:
    """Coefficients over the surface features and over the sorted hashes of the chosen words."""

    words: np.ndarray
    surface: np.ndarray
    lexical: np.ndarray
    bias: np.ndarray


def _shares(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(table[data], out=total[1:])
    return np.diff(total[offsets])


def features(column: pa.Array):
    """Surface features per row, and hashes of all words with the rows' ranges.

    The surface features: shares of symbols, capitals and digits, of words that
    repeat the one before, of words without a letter or digit, and two of length.
    """
    data, offsets = text_bytes(column)
    starts, ends, at = words(data, offsets, SPACE)
    n = np.diff(at)
    if not len(data):
        return np.zeros((len(n), SURFACE)), np.zeros(0, np.int64), at
    lower = LOWER[data]
    exact = word_hashes(lower, starts, ends)
    first, last = starts.copy(), ends.copy()
    # The public word lists have no marks; three at either end are enough to strip.
    for _ in range(4):
        first += _EDGE[lower[np.minimum(first, len(lower) - 1)]] & (first < last)
        last -= (last > first) & _EDGE[lower[np.maximum(last - 1, 0)]]
    bare = first >= last
    lexical = signed(word_hashes(lower, first, np.maximum(first, last)))
    again = np.zeros(len(exact), bool)
    again[1:] = exact[1:] == exact[:-1]
    again[at[:-1][n > 0]] = False

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[at])

    size = np.maximum(np.diff(offsets), 1)
    letters = np.maximum(_shares(data, offsets, _LETTER), 1)
    count = np.maximum(n, 1)
    surface = np.column_stack(
        [
            10 * _shares(data, offsets, _SYMBOL) / size,
            10 * _shares(data, offsets, _UPPER) / letters,
            10 * _shares(data, offsets, _DIGIT) / size,
            10 * per_row(again) / count,
            10 * per_row(bare) / count,
            np.log1p(n) / 5,
            size / count / 10,
        ]
    )
    return np.clip(surface, 0, 10), lexical, at


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 25) -> np.ndarray:
    """Logistic regression by Newton's method; the last coefficient is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        change = np.linalg.solve(hessian, gradient)
        w -= change
        if np.abs(change).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE) -> Model:
    """Fit both models; ``labels`` has ``doc_id``, ``quality`` and ``toxic``."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    chosen = (
        known.agg(F.max(F.col("quality") == 0).alias("low"), F.max(F.col("toxic") == 1).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # At most ``sample`` rows of an id and two flags, and of an id and a hash: bounded whatever the tables' size.
    texts = docs.select("doc_id", F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("hash"))
    texts = texts.join(F.broadcast(chosen), "doc_id")
    picks = texts.select("doc_id", "hash").distinct().orderBy(F.xxhash64("doc_id", "hash"), "doc_id", "hash").limit(sample)
    labelled = texts.join(F.broadcast(picks), ["doc_id", "hash"]).dropDuplicates(["doc_id", "hash"])

    def described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            surface, lexical, at = features(batch.column("text"))
            sets = [np.unique(lexical[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.record_batch(
                [
                    batch.column("low"),
                    batch.column("toxic"),
                    pa.array(list(surface), pa.list_(pa.float64())),
                    pa.array(sets, pa.list_(pa.int64())),
                ],
                names=["low", "toxic", "surface", "words"],
            )

    rows = saved(
        labelled.mapInArrow(described, "low boolean, toxic boolean, surface array<double>, words array<bigint>"),
        "quality-sample",
        keep=False,
    )
    flag = {y: F.coalesce(F.col(y), F.lit(False)).cast("double") for y in ("low", "toxic")}
    sums = rows.select(F.count(F.lit(1)), *(F.sum(c) for c in flag.values())).first()
    total, positive = sums[0], [x or 0.0 for x in sums[1:]]
    by_word = rows.select(F.explode("words").alias("word"), *(c.alias(y) for y, c in flag.items())).groupBy("word")
    counted = by_word.agg(F.count(F.lit(1)).alias("n"), F.sum("low").alias("low"), F.sum("toxic").alias("toxic"))
    picked: set[int] = set()
    for y, hits in zip(flag, positive, strict=True):
        if not 0 < hits < total:
            continue
        expected = F.col("n") * F.lit(hits / total)
        off = F.greatest(F.abs(F.col(y) - expected) - F.lit(0.5), F.lit(0.0))
        spread = expected * F.lit(1 - hits / total) * (F.lit(1.0) - F.col("n") / F.lit(float(total)))
        best = (
            counted.where((F.col("n") >= LEAST_DOCS) & (F.col("n") < total))
            .select("word", (off * off / spread).alias("chi2"))
            .where(F.col("chi2") >= LEAST_CHI2)
            .orderBy(F.col("chi2").desc(), "word")
            .limit(WORDS)
        )
        picked |= {r["word"] for r in best.collect()}
    chosen_words = np.array(sorted(picked), np.int64)

    def reduced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = batch.column("words").to_pylist()
            kept = [np.flatnonzero(np.isin(chosen_words, s)) for s in sets]
            yield pa.record_batch(
                [*batch.columns[:3], pa.array(kept, pa.list_(pa.int64()))], names=batch.schema.names
            )

    small = rows.mapInArrow(reduced, rows.schema).toArrow()
    drop(rows)
    n = small.num_rows
    surface = np.array(small["surface"].to_pylist(), float).reshape(n, SURFACE)
    x = np.zeros((n, surface.shape[1] + len(chosen_words)), np.float64)
    x[:, : surface.shape[1]] = surface
    for i, at in enumerate(small["words"].to_pylist()):
        x[i, surface.shape[1] + np.array(at, int)] = 1
    wide = SURFACE
    heads = []
    for name in ("low", "toxic"):
        y = np.array([bool(v) for v in small[name].to_pylist()], float)
        if n and 0 < y.sum() < n:
            heads.append(fit(x, y))
        else:
            heads.append(np.append(np.zeros(wide + len(chosen_words)), -30.0))
    w = np.array(heads)
    return Model(chosen_words, w[:, :wide], w[:, wide:-1], w[:, -1])


def probability(column: pa.Array, model: Model) -> np.ndarray:
    """How probable it is from its text alone that a document is bad."""
    surface, lexical, at = features(column)
    score = surface @ model.surface.T + model.bias
    if len(model.words) and len(lexical):
        place = np.minimum(np.searchsorted(model.words, lexical), len(model.words) - 1)
        hit = np.flatnonzero(model.words[place] == lexical)
        row = np.searchsorted(at, hit, "right") - 1
        pairs = np.unique(row * len(model.words) + place[hit])  # presence, not counts
        for k in range(2):
            score[:, k] += np.bincount(
                pairs // len(model.words), model.lexical[k, pairs % len(model.words)], len(score)
            )
    p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    bad = 1 - (1 - p[:, 0]) * (1 - p[:, 1])
    bad[np.diff(at) == 0] = 1.0
    return np.clip(bad, 1e-9, 1 - 1e-9)


P, HOST, PATH = "_worklens_text_bad", "_worklens_host", "_worklens_path"
#: Columns that ``classify`` adds; no other table has such names.
BAD, KEEP = "_worklens_bad", "_worklens_keep"


def evidence(docs: DataFrame, model: Model, host: Column, path: Column, text: str = "text") -> DataFrame:
    """``docs`` with the text's probability and the two levels of its site."""
    named = docs.withColumns({HOST: _level(host), PATH: _level(path)})
    schema = StructType([*named.schema.fields, StructField(P, DoubleType())])

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            p = probability(filled(batch.column(text)), model)
            yield pa.record_batch([*batch.columns, pa.array(p)], names=[*batch.schema.names, P])

    return named.mapInArrow(judged, schema)


def _level(site: Column) -> Column:
    # A null is a site beside all texts, the empty one included.
    return F.coalesce(F.concat(F.lit("="), site.cast("string")), F.lit("?"))


def _strength(groups: DataFrame, rate: Column) -> float:
    """Prior weight in documents, from the spread of the groups' means about ``rate`` beyond chance.

    By moments over all groups: sum of n * (mean - rate)^2 is on average the
    within-group variance per group plus n times the variance between groups.
    """
    mean = F.col("bad") / F.col("n")
    row = groups.select(
        F.sum(F.col("n") * (mean - rate) ** 2).alias("between"),
        F.sum((F.col("square") / F.col("n") - mean**2)).alias("within"),
        F.sum("n").alias("n"),
        (F.sum("bad") / F.sum("n")).alias("mean"),
    ).first()
    if not row["n"]:
        return 1.0
    variance = max(0.0, row["between"] - row["within"]) / row["n"]
    spread = row["mean"] * (1 - row["mean"])
    return float(np.clip(spread / variance - 1 if variance > 0 else 1e6, 2.0, 1e6))


def sites(judged: DataFrame) -> DataFrame:
    """For every path its documents, their summed probabilities and the prior from above it.

    One row per path. The three levels come from one grouped aggregation, combined
    before its shuffle, so a host with a third of all documents costs no more.
    """
    sums = (F.count(F.lit(1)).alias("n"), F.sum(P).alias("bad"), F.sum(F.col(P) ** 2).alias("square"))
    by_path = saved(judged.groupBy(HOST, PATH).agg(*sums), "quality-paths")
    by_host = by_path.groupBy(HOST).agg(*(F.sum(c).alias(c) for c in ("n", "bad", "square")))
    top = by_path.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    # half a document of either kind keeps the global rate inside (0, 1)
    overall = ((top["bad"] or 0) + 0.5) / ((top["n"] or 0) + 1)
    weight = _strength(by_host, F.lit(overall))
    hosts = by_host.select(
        HOST, ((F.col("bad") + F.lit(weight * overall)) / (F.col("n") + F.lit(weight))).alias("host_rate")
    )
    paths = by_path.join(hosts, HOST)
    inner = _strength(paths, F.col("host_rate"))
    return paths.select(
        HOST, PATH, F.col("n").alias("_worklens_n"), F.col("bad").alias("_worklens_sum"),
        F.col("host_rate").alias("_worklens_prior"), F.lit(inner).alias("_worklens_weight"),
        F.lit(overall).alias("_worklens_rate"),
    )


def _logit(p: Column) -> Column:
    return F.log(p / (F.lit(1.0) - p))


def classify(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, text: str = "text", reject: float = REJECT
) -> DataFrame:
    """``docs`` with ``BAD``, the combined probability, and ``KEEP``.

    The texts are read once for the sites and once for the result; only the
    sums per path are shuffled and joined, by Spark's choice of join.
    """
    model = train(docs, labels, text)
    needed = docs.select(F.col(text), host.alias(HOST), path.alias(PATH))
    small = evidence(needed, model, F.col(HOST), F.col(PATH), text).select(HOST, PATH, P)
    by_site = saved(sites(small), "quality-sites")
    rows = evidence(docs, model, host, path, text).join(by_site, [HOST, PATH], "left")
    rate = (F.col("_worklens_sum") - F.col(P) + F.col("_worklens_weight") * F.col("_worklens_prior")) / (
        F.col("_worklens_n") - 1 + F.col("_worklens_weight")
    )
    rate = F.least(F.greatest(rate, F.lit(1e-6)), F.lit(1 - 1e-6))
    total = _logit(F.col(P)) + _logit(rate) - _logit(F.col("_worklens_rate"))
    bad = F.lit(1.0) / (F.lit(1.0) + F.exp(-total))
    return rows.select(*(F.col(f"`{n}`") for n in docs.columns), bad.alias(BAD)).withColumn(
        KEEP, F.col(BAD) < F.lit(reject)
    )
