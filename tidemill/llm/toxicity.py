"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. Lexicon. Words and word beginnings of the fitting rows are counted by toxic and clean documents in a
   grouped aggregation; the ``ENTRIES`` that tell most become lexicon entries.
2. Voters. The ``VOTERS`` best entries and a few patterns (shouting, exclamation marks, signs, repeated words,
   direct address) each vote or abstain on a document; the given label is one more voter, absent from rows without one.
3. Label model. Expectation maximisation over labelled and other rows estimates how often each voter speaks on toxic and on
   clean documents, how often the given label is right in either class, and the correlations of the votes within either; the
   voters' weights come from these, so voters that repeat each other count once. It yields a posterior for each row.
4. Classifier. A logistic regression on entry counts and patterns is fitted to the posteriors of the labelled rows. It alone
   scores documents, from their whole texts.

``fit_rows`` bounds the labelled rows that are fitted on, ``more_rows`` those without a label: a share of them by hash of
``doc_id``, close to that many where there are more. Everything else covers all rows. What the driver holds is bounded by both and
``ENTRIES``.
Labels are learnt only from rows whose crc32 of ``doc_id`` as text leaves another remainder than 1 by 3.
The score reads the text and nothing else.

Defined results: a null text counts as empty and scores like one without evidence; rows without ``doc_id`` are
scored and not held out; repeated rows score alike; of several labels of a document the
highest counts; null labels count for nothing. Without toxic or without clean labels the score is the share of toxic
ones (0.5 without any). An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.llm.common import stored, table, text_of
from tidemill.storage import scratch_released

ENTRIES, VOTERS = 400, 60
#: Toxic documents that an entry must be seen in.
SUPPORT = 3
#: Nats of log likelihood that an entry must gain: among ten thousands of words, chance alone gives fewer.
LEAST_GAIN = 9.0
#: How often a given label is taken to be right at first, and how many rows that belief counts for beside the rows themselves.
LABEL_TRUST, BELIEF = 0.98, 20
#: Rows of the fit that are held as long numbers at once.
FITTED_AT_ONCE = 4096
#: Words whose entries a task remembers before it begins anew.
REMEMBERED = 150_000
LETTERS = re.compile(r"[^\W\d_]+")
ADDRESS = frozenset("you your du dein euch tu vous ton toi usted".split())
PATTERNS = ("shouting", "exclaims", "signs", "repeats", "address")


def words_of(text: str) -> Counter:
    return Counter(LETTERS.findall(text.lower()))


def entries_of(word: str) -> list[str]:
    """What a word may be listed under: itself, and its first four and five letters."""
    return [word, *(word[:n] + "*" for n in (4, 5) if len(word) > n)]


def patterns_of(text: str, words: Counter) -> list[float]:
    n, total = max(1, len(text)), max(1, words.total())
    letters = sum(len(w) * k for w, k in words.items())
    return [
        float(text.isupper()),
        min(1.0, 20 * text.count("!") / n),
        1 - min(n, letters + text.count(" ")) / n,
        max(words.values(), default=0) / total,
        min(1.0, 10 * sum(words[w] for w in ADDRESS) / total),
    ]


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fitting_rows(spark: SparkSession, docs: DataFrame, labels: DataFrame, fit_rows: int, more_rows: int) -> DataFrame:
    """``text, toxic`` of the labelled rows to fit on, and of some without label (null), none of them held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out())
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    below = lambda share: F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))
    picked = known.where(below(min(1.0, fit_rows / max(1, known.count()))))
    texts = docs.select("doc_id", text_of().alias("text"))
    # About fit_rows rows of two numbers: the parameter is the bound of the broadcast.
    fit = texts.join(F.broadcast(picked), "doc_id").select("text", "toxic")
    some = below(min(1.0, more_rows / max(1, docs.count())))
    others = texts.where(F.col("doc_id").isNotNull() & some).where(~held_out())
    others = others.join(F.broadcast(known.where(some).select("doc_id")), "doc_id", "left_anti")
    return stored(spark, fit.union(others.select("text", F.lit(None).cast("int"))), "fit")


def lexicon(fit: DataFrame, n_rows: int, n_toxic: int) -> list[str]:
    """The entries that tell most about the label, best first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen, toxic = Counter(), Counter()
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                own = {e for w in words_of(text) for e in entries_of(w)}
                seen.update(own)
                if label:
                    toxic.update(own)
            yield pd.DataFrame({"entry": list(seen), "seen": list(seen.values()), "toxic": [toxic[e] for e in seen]})

    base = n_toxic / n_rows
    counts = fit.mapInPandas(count, "entry string, seen long, toxic long").groupBy("entry").agg(
        F.sum("seen").alias("seen"), F.sum("toxic").alias("toxic")
    )
    # The gain in log likelihood by knowing the entry, signed by direction; only entries of toxic texts are listed.
    share = (F.col("toxic") + base) / (F.col("seen") + 1)
    clean = F.col("seen") - F.col("toxic")
    gain = F.col("toxic") * F.log(share / base) + clean * F.log((1 - share) / (1 - base))
    best = (
        counts.where((F.col("toxic") >= SUPPORT) & (share > 3 * base))
        .select("entry", gain.alias("gain"))
        .where(F.col("gain") >= LEAST_GAIN)
        .orderBy(F.desc("gain"), "entry")
        .limit(ENTRIES)
    )
    return [r["entry"] for r in best.collect()]


class Reader:
    """Reads a text into the lexicon's counts and the patterns."""

    def __init__(self, entries: list[str]):
        self.place = {e: i for i, e in enumerate(entries)}
        self.of_word: dict[str, tuple[int, ...]] = {}

    def read(self, text: str) -> tuple[dict[int, int], list[float]]:
        words, found = words_of(text), {}
        for word, n in words.items():
            places = self.of_word.get(word)
            if places is None:
                if len(self.of_word) > REMEMBERED:
                    self.of_word.clear()
                places = self.of_word[word] = tuple(self.place[e] for e in entries_of(word) if e in self.place)
            for i in places:
                found[i] = found.get(i, 0) + n
        return found, patterns_of(text, words)

    def row(self, text: str) -> np.ndarray:
        """Features of the classifier: damped counts, patterns, and 1."""
        found, patterns = self.read(text)
        row = np.zeros(len(self.place) + len(PATTERNS) + 1, np.float32)
        for i, n in found.items():
            row[i] = 1 + math.log(n)
        row[len(self.place) : -1] = patterns
        row[-1] = 1
        return row


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, dict]:
    """Posteriors of the rows from votes (rows x voters, 0 or 1) and from labels as one more voter, which abstains where it is nan.

    The model: voter ``i`` speaks with rate ``toxic[i]`` or ``clean[i]`` and is silent else, and either is evidence. Votes are
    correlated within either class; a voter's log ratios are divided by one plus its positive correlations
    with the others, so voters that repeat each other count once. The given label is a voter whose accuracy in either
    class is estimated like the rest, from ``LABEL_TRUST`` on; rows without one are told by the other voters alone.
    """
    given = ~np.isnan(labels)
    says = np.where(given, labels > 0, False)
    base = float(np.clip(says[given].mean() if given.any() else 0.5, 1e-4, 1 - 1e-4))
    posterior = np.where(given, np.where(says, LABEL_TRUST, 1 - LABEL_TRUST), base)
    for _ in range(rounds):
        prior = float(np.clip(posterior.mean(), 1e-4, 1 - 1e-4))
        toxic = (posterior @ votes + 1) / (posterior.sum() + 2)
        clean = ((1 - posterior) @ votes + 1) / ((1 - posterior).sum() + 2)
        # How often the label is right in either class.
        hit = (posterior[given & says].sum() + BELIEF * LABEL_TRUST) / (posterior[given].sum() + BELIEF)
        pass_ = ((1 - posterior)[given & ~says].sum() + BELIEF * LABEL_TRUST) / ((1 - posterior)[given].sum() + BELIEF)
        told = np.where(says, math.log(hit / (1 - pass_)), math.log((1 - hit) / pass_)) * given
        covariance = prior * np.cov(votes.T, aweights=posterior, ddof=0)
        covariance += (1 - prior) * np.cov(votes.T, aweights=1 - posterior, ddof=0)
        scale = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
        correlation = covariance / np.outer(scale, scale)
        alike = 1 + np.maximum(correlation - np.eye(len(scale)), 0).sum(axis=1)
        weights, silence = np.log(toxic / clean) / alike, np.log((1 - toxic) / (1 - clean)) / alike
        odds = math.log(prior / (1 - prior)) + votes @ (weights - silence) + silence.sum() + told
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        done = np.abs(new - posterior).max() < 1e-6
        posterior = new
        if done:
            break
    accuracy = prior * toxic / (prior * toxic + (1 - prior) * clean)
    return posterior, {"accuracy": accuracy, "correlation": correlation, "weights": weights, "label": (hit, pass_)}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 40) -> np.ndarray:
    """Weights by Newton steps; the last column is the constant and is not shrunk. ``x`` stays in its short numbers."""
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(rounds):
        slope, curve = keep * w, np.diag(keep)
        for at in range(0, len(x), FITTED_AT_ONCE):
            some, truth = x[at : at + FITTED_AT_ONCE].astype(np.float64), y[at : at + FITTED_AT_ONCE]
            p = 1 / (1 + np.exp(-np.clip(some @ w, -30, 30)))
            slope = some.T @ (p - truth) + slope
            curve = (some * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ some + curve
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """Entries and weights; enough to score any text."""

    def __init__(self, entries: list[str], weights: np.ndarray):
        self.entries, self.weights = entries, np.asarray(weights, np.float64)

    def scores(self, reader: Reader, texts: list[str]) -> list[float]:
        n, w, out = len(self.entries), self.weights.tolist(), []
        for text in texts:
            found, patterns = reader.read(text)
            z = w[-1] + sum(w[i] * (1 + math.log(k)) for i, k in found.items())
            z += sum(w[n + j] * p for j, p in enumerate(patterns))
            out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        return out


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, fit_rows: int = 24_000, more_rows: int = 8_000) -> Model:
    """Fitted on about ``fit_rows`` labelled rows and ``more_rows`` others: the lexicon by the labelled ones, the rest by all."""
    with scratch_released(spark):
        return _trained(fitting_rows(spark, docs, labels, fit_rows, more_rows))


def _trained(fit: DataFrame) -> Model:
    n_rows, n_toxic = fit.agg(F.count("toxic"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if n_toxic in (0, n_rows):
        share = n_toxic / n_rows if n_rows else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model([], np.array([0.0] * len(PATTERNS) + [math.log(share / (1 - share))]))
    entries = lexicon(fit.where("toxic is not null"), n_rows, n_toxic)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(entries)
        for batch in batches:
            rows = [reader.row(t).astype(np.float16).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"row": rows, "toxic": batch["toxic"]})

    # fit_rows + more_rows rows of ENTRIES small numbers.
    got = fit.mapInPandas(read, "row binary, toxic int").toPandas()
    x = np.frombuffer(b"".join(got["row"]), np.float16).reshape(len(got), -1)
    y = got["toxic"].to_numpy(np.float64)
    del got
    n = len(entries)
    patterns = x[:, n:-1].astype(np.float32)
    votes = np.concatenate((x[:, : min(n, VOTERS)] > 0, patterns > np.maximum(0.05, np.quantile(patterns, 0.9, axis=0))), axis=1)
    posterior, _ = label_model(votes.astype(np.float64), y)
    labelled = ~np.isnan(y)  # where nothing but votes tells, a toxic text without a listed word would teach that it is clean
    return Model(entries, fit_logistic(x[labelled], posterior[labelled]))


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(model.entries)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": model.scores(reader, list(batch["text"]))})

    texts = docs.select("doc_id", held_out().alias("held_out"), text_of().alias("text"))
    kind = dict(texts.dtypes)["doc_id"]
    scored = texts.mapInPandas(score, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity_score(model: Model, text: str = "text") -> Column:
    """The score as a column; for filters on documents of any columns."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(Reader(model.entries), list(texts)), dtype="float64")

    return score(text_of(text))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train(spark, docs, table(spark, sf_dir, "labels")))


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLES: dict[str, str] = {}
