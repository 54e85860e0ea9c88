"""Operator 8: toxicity categories by a chain of linear models.

Categories are predicted one after another; each model sees the terms and the earlier
categories' probabilities. In training those are out-of-fold predictions, so a later model
meets them with the error they have on unseen texts. Terms are words and beginnings of
words, which stand for the many compounds of a stem that are too rare by themselves; every
language has its own ranking, so that a small one is not crowded out. Terms are chosen and
models fitted on at most ``SAMPLE`` labelled documents (chosen by a hash of their id);
scoring runs over whole texts in Arrow batches. The threshold is the one with the best F1 on
the out-of-fold predictions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatledger.llm.components import stored
from seatledger.llm.quality import SAMPLE, training_sample

#: Terms that the models see, documents of a language's sample a term must be in, letters of beginnings.
VOCABULARY, LEAST_DOCS, PREFIXES = 400, 3, (3, 5, 7)
FOLDS, RIDGE, STEPS = 5, 1.0, 8
#: Threshold without labels of both kinds.
ACCEPT = 0.5

#: The narrower categories. ``labels`` has no kinds of toxicity, so these are term groups: the first
#: and second group of toxic terms that occur together in the sample, found for every language.
GROUPS = ("terms_1", "terms_2")
#: Toxic terms of a language that are grouped; their least chi-square, and as a part of the strongest one's.
GROUPED, LEAST_CHI, LEAST_PART = 48, 15.0, 0.05

_BREAKS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> set[bytes]:
    """Distinct words: runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return set(text.encode().lower().translate(_BREAKS).split()) if text else set()


def forms(word: bytes) -> list[bytes]:
    """The word and its beginnings, these with a star, which no word holds."""
    letters = word.decode()
    return [word, *(f"{letters[:n]}*".encode() for n in PREFIXES if len(letters) > n)]


@F.arrow_udf(T.ArrayType(T.StringType()))
def text_terms(texts: pa.Array) -> pa.Array:
    own = ({f.decode() for w in terms(t) for f in forms(w)} for t in texts.to_pylist())
    return pa.array([sorted(x) for x in own], pa.list_(pa.string()))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the last is the intercept) of ridge logistic regression by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-3
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x.T * (p * (1 - p))) @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def _probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


@dataclass
class Chain:
    names: Sequence[str]
    words: Mapping[bytes, int]
    weights: Sequence[np.ndarray]
    accept: float = ACCEPT

    def presence(self, texts: Sequence[str | None]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.words)))
        own = [terms(t) for t in texts]
        places = {w: [self.words[f] for f in forms(w) if f in self.words] for w in set().union(*own)}
        places = {w: at for w, at in places.items() if at}
        for k, words in enumerate(own):
            for word in places.keys() & words:
                x[k, places[word]] = 1
        return x

    def predict(self, x: np.ndarray) -> list[np.ndarray]:
        """Probabilities of all categories in the order of the chain."""
        out: list[np.ndarray] = []
        for w in self.weights:
            out.append(_probability(np.column_stack([x, *out]), w))
        return out


def best_threshold(guess: np.ndarray, y: np.ndarray) -> float:
    """Threshold with the best F1, in the middle of the gap below the last one accepted; ``ACCEPT`` when all labels agree."""
    if not len(y) or y.min() == y.max():
        return ACCEPT
    order = np.argsort(-guess, kind="stable")
    found = guess[order]
    ends = np.flatnonzero(np.append(found[1:] < found[:-1], True))
    f1 = 2 * np.cumsum(y[order])[ends] / (ends + 1 + y.sum())
    last = ends[int(np.argmax(f1))]
    return float((found[last] + found[last + 1]) / 2 if last + 1 < len(found) else found[last])


def term_groups(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Group 0 or 1 of each term (-1: not toxic) by co-occurrence in the toxic documents of one language.

    Terms are split by the sign of the leading component of their correlations, so terms of one
    group occur together; group 0 is in more documents. A single term is group 0.
    """
    group = np.full(x.shape[1], -1)
    n, p = len(x), toxic.sum()
    if not 0 < p < n or not x.shape[1]:
        return group
    hits, df = toxic @ x, x.sum(axis=0)
    chi = n * (hits * n - df * p) ** 2 / (np.maximum(df * (n - df), 1) * p * (n - p))
    enough = (hits >= LEAST_DOCS) & (2 * hits * n > df * (n + p)) & (chi >= LEAST_CHI)
    strong = np.flatnonzero(enough & (chi >= LEAST_PART * chi[enough].max(initial=0)))
    strong = strong[np.lexsort((strong, -chi[strong]))][:GROUPED]
    if not len(strong):
        return group
    held = x[np.ix_(toxic > 0, strong)]
    centred = held - held.mean(axis=0)
    norm = np.sqrt((centred**2).sum(axis=0))
    centred /= np.where(norm > 0, norm, 1)
    _, vectors = np.linalg.eigh(centred.T @ centred)
    first = vectors[:, -1] >= 0
    if first.all() or not first.any():
        first = vectors[:, -1] >= np.median(vectors[:, -1])
    if held[:, ~first].any(axis=1).sum() > held[:, first].any(axis=1).sum():
        first = ~first
    group[strong] = np.where(first, 0, 1)
    return group


def category_labels(x: np.ndarray, toxic: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """Weak labels of ``GROUPS``, one column each: toxic documents with a term of the group of their language."""
    out = np.zeros((len(x), len(GROUPS)))
    for lang in np.unique(langs):
        rows = np.flatnonzero(langs == lang)
        group = term_groups(x[rows], toxic[rows])
        for j in range(len(GROUPS)):
            out[rows, j] = toxic[rows] * (x[rows][:, group == j].any(axis=1))
    return out


def fit_chain(names: Sequence[str], words: Mapping[bytes, int], x: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> Chain:
    """Fit the models of a chain; column j of ``labels`` belongs to name j."""
    seen, weights, guess = x, [], np.zeros(len(x))
    for j in range(len(names)):
        y, guess = labels[:, j], np.zeros(len(x))
        for k in range(FOLDS):
            out = fold == k
            if out.any() and not out.all():
                guess[out] = _probability(seen[out], _logistic(seen[~out], y[~out]))
        weights.append(_logistic(seen, y))
        seen = np.column_stack([seen, guess])
    return Chain(list(names), dict(words), weights, best_threshold(guess, labels[:, -1]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """Chain of the grouped categories and, last, ``toxic`` as ``labels`` has it."""
    names = [*GROUPS, "toxic"]
    chosen = F.broadcast(training_sample(labels, "toxic", sample))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("?")) if "lang" in docs.columns else F.lit("?")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", lang.alias("lang"))
    # A document in several rows trains by the least of them: at most as many rows as the sample has ids.
    one = texts.join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("text", "lang")).alias("_r"))
    rows = one.select("doc_id", "label", "_r.*").select("doc_id", "lang", "label", text_terms("text").alias("terms"))
    rows = stored(rows, "terms")
    if rows.isEmpty():
        return Chain(names, {}, [np.zeros(1 + j) for j in range(len(names))])
    # Squared correlation of a term with toxicity within its language, from counts over the sample.
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("label").alias("p"))
    each = rows.select("lang", F.explode("terms").alias("term"), "label")
    counts = each.groupBy("lang", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("label").alias("hits")).where(F.col("df") >= LEAST_DOCS)
    excess = F.col("hits") * F.col("n") - F.col("df") * F.col("p")
    strength = F.pow(excess, 2) / (F.col("df") * (F.col("n") - F.col("df") + 1))
    ranked = counts.join(F.broadcast(sizes), "lang").where(excess > 0).select(
        "term", F.row_number().over(Window.partitionBy("lang").orderBy(strength.desc(), "term")).alias("rank")
    ).where(F.col("rank") <= VOCABULARY)
    best = ranked.groupBy("term").agg(F.min("rank").alias("rank")).orderBy("rank", "term").limit(VOCABULARY)
    words = [r["term"] for r in best.collect()]
    vocabulary = {w.encode(): k for k, w in enumerate(words)}
    known = F.filter("terms", lambda t: t.isin(words)) if words else F.array().cast("array<string>")
    fold = F.floor(F.crc32(F.col("doc_id").cast("string")) / FOLDS) % FOLDS
    table = rows.select("doc_id", "lang", fold.alias("fold"), known.alias("terms"), "label").toArrow().sort_by("doc_id")
    x = np.zeros((table.num_rows, len(words)))
    for k, own in enumerate(table.column("terms").to_pylist()):
        x[k, [vocabulary[t.encode()] for t in own]] = 1
    toxic = table.column("label").to_numpy()
    narrower = category_labels(x, toxic, np.array(table.column("lang").to_pylist(), dtype=object).astype(str))
    return fit_chain(names, vocabulary, x, np.column_stack([narrower, toxic]), table.column("fold").to_numpy())


def category_scores(chain: Chain, text: Column) -> Column:
    fields = [f"p_{n}" for n in chain.names]

    @F.arrow_udf(", ".join(f"{f} double" for f in fields))
    def score(texts: pa.Array) -> pa.Array:
        parts = [pa.StructArray.from_arrays([pa.array([], pa.float64())] * len(fields), fields)]
        for lo in range(0, len(texts), 1000):
            found = chain.predict(chain.presence(texts.slice(lo, 1000).to_pylist()))
            parts.append(pa.StructArray.from_arrays([pa.array(p) for p in found], fields))
        return pa.concat_arrays(parts)

    return score(text)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, p_terms_1, p_terms_2, p_toxic, toxic`` for every row of ``docs``.

    ``toxic`` is 1 from the chain's threshold on (a half without labels of both kinds). Null and empty texts have no words. Labels
    that are null are left out, the held-out fold of operator 1 never trains; without usable
    labels every probability is a half. Rows without id are scored like others, repeated
    rows alike; other columns are ignored.
    """
    chain = train(docs, labels)
    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), category_scores(chain, F.col("text")).alias("_p"))
    return scored.select("doc_id", "_p.*").withColumn("toxic", (F.col("p_toxic") >= chain.accept).cast("int"))
