"""Toxicity by weak supervision.

Words that go with the label in a bounded labelled sample become lexicon voters;
pattern voters join them, and one that takes a text without lexicon words for clean.
A generative label model, which sees the votes and no label, estimates by EM how each
voter votes on toxic and on clean texts, and which voters go together beyond what the
class explains; such voters share one vote.  Its posteriors are the labels from which a
logistic regression is trained; it scores every text.

Labels are read only where crc32(doc_id as text) mod 4 isn't 2.  The labelled
sample's bound is ``SAMPLE`` texts (those with the least hashes of their ids, and of
their texts); what reaches the driver is the words and features of that sample.

Defined results: null text is empty and gets the score of a text without any
sign; rows without a label count as unlabelled; a text's labels, where its copies or
an id's rows differ, are averaged; repeated rows get equal scores;
an empty documents table gives no rows; with no usable label of one class every
score is the labels' rate (0 if there are none), and the pipeline keeps every document.
"""

from __future__ import annotations

import math
import operator
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import materialize, spread, table

SAMPLE = 20_000
THRESHOLD = 0.3
#: A word becomes a voter if it is in so many sampled texts, and the lower bound of its toxic share is so high.
LEAST_TEXTS, LEAST_SHARE = 5, 0.5
#: Voters correlated above this, given the class, share a vote; at first, with no class known, above the other.
CORRELATED, ALIKE = 0.5, 0.9
RIDGE = 2e-5
#: Count that every vote of every voter starts with.
SMOOTH = 0.3
#: Rows that are worked on at once on the driver.
CHUNK = 2048
WORD = re.compile(r"[^\W\d_]+")
UPPER = re.compile("[A-Z\u00c0-\u00d6\u00d8-\u00de]")
PATTERNS = ("shouting", "exclaiming", "repeating", "addressing")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def text_features(text: str, index: dict[str, int]) -> tuple[list[int], list[float]]:
    """The places of the text's lexicon words, and the patterns' strengths."""
    words = WORD.findall(text.lower())
    strength = [0.0] * len(PATTERNS)
    if text:
        # of all characters: upper-case letters, exclamation marks; of all words: those that follow themselves, second person
        strength[0] = len(UPPER.findall(text)) / len(text)
        strength[1] = text.count("!") / len(text)
        if words:
            strength[2] = sum(map(operator.eq, words, islice(words, 1, None))) / len(words)
            strength[3] = sum(map(words.count, ("you", "your", "u"))) / len(words)
    return sorted({index[w] for w in index.keys() & words}), strength


#: From which strength on a pattern votes.
VOTES_FROM = np.array([0.3, 0.01, 0.2, 0.05])


def votes_of(hits: list[list[int]], strengths: np.ndarray, n_words: int) -> np.ndarray:
    """(n, voters) of 1 (toxic), -1 (clean), 0 (no vote): lexicon words, patterns, and one that takes texts without lexicon words for clean."""
    out = np.zeros((len(hits), n_words + len(PATTERNS) + 1), dtype=np.int8)
    out[np.repeat(np.arange(len(hits)), [len(h) for h in hits]), [i for h in hits for i in h]] = 1
    out[:, n_words:-1] = strengths >= VOTES_FROM
    out[:, -1] = [-(not h) for h in hits]
    return out


def chunks_of(n: int):
    return (slice(i, i + CHUNK) for i in range(0, n, CHUNK))


def vote_shares(votes: np.ndarray, posterior: np.ndarray) -> np.ndarray:
    """(2 classes, voters, 3): how often each voter says -1, 0, 1 on texts of a class."""
    count = np.full((2, votes.shape[1], 3), float(SMOOTH))
    for part in chunks_of(len(votes)):
        both = np.stack([1 - posterior[part], posterior[part]])
        count[:, :, 0] += both @ (votes[part] < 0)
        count[:, :, 2] += both @ (votes[part] > 0)
    count[:, :, 1] += np.array([[len(votes) - posterior.sum()], [posterior.sum()]]) - count[:, :, 0] - count[:, :, 2] + 2 * SMOOTH
    return count / count.sum(axis=2, keepdims=True)


def em(votes: np.ndarray, weight: np.ndarray, posterior: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Posteriors of the toxic class after so many rounds, voters independent given the class but for their weights."""
    for _ in range(rounds):
        prior = np.clip(posterior.mean(), 1e-3, 1 - 1e-3)
        share = np.log(vote_shares(votes, posterior))
        ratio = weight[:, None] * (share[1] - share[0])
        score = np.concatenate([(votes[part] > 0) @ (ratio[:, 2] - ratio[:, 1]) + (votes[part] < 0) @ (ratio[:, 0] - ratio[:, 1]) for part in chunks_of(len(votes))])
        posterior = 1 / (1 + np.exp(-np.clip(score + ratio[:, 1].sum() + np.log(prior / (1 - prior)), -30, 30)))
    return posterior


def correlations(votes: np.ndarray, posterior: np.ndarray | None) -> np.ndarray:
    """Correlations of voters beyond what the classes explain, or beyond their means without a posterior."""
    of = np.full(len(votes), 0.5) if posterior is None else posterior
    sides = np.stack([1 - of, of], axis=1)
    mean = np.zeros((2, votes.shape[1]))
    for part in chunks_of(len(votes)):
        mean += sides[part].T @ votes[part]
    mean /= np.maximum(sides.sum(axis=0), 1e-9)[:, None]
    product = np.zeros((votes.shape[1], votes.shape[1]))
    for part in chunks_of(len(votes)):
        rest = votes[part] - sides[part] @ mean
        product += rest.T @ rest
    size = np.sqrt(np.diag(product))
    return product / np.maximum(np.outer(size, size), 1e-9)


def label_model(votes: np.ndarray, rounds: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors of the toxic class, each voter's accuracy, and its weight (1 / the size of its group of correlated voters).

    No label goes in.  EM starts from whether any voter says toxic; voters that are nearly
    the same share a vote at once, others as they turn out to be correlated given the classes found.
    """
    start = np.where((votes > 0).any(axis=1), 0.9, 0.1)
    posterior, limit = None, ALIKE
    for _ in range(rounds):
        weight = 1 / np.maximum((correlations(votes, posterior) > limit).sum(axis=0), 1)
        posterior, limit = em(votes, weight, start), CORRELATED
    right = posterior @ (votes > 0) + (1 - posterior) @ (votes < 0)
    return posterior, right / np.maximum((votes != 0).sum(axis=0), 1), weight


def inputs(votes: np.ndarray, strengths: np.ndarray) -> np.ndarray:
    """The classifier's inputs: lexicon words, whether there is any, the patterns' strengths, and a one."""
    words = votes[:, : votes.shape[1] - len(PATTERNS) - 1] > 0
    return np.concatenate([words, words.any(axis=1, keepdims=True), strengths, np.ones((len(votes), 1))], axis=1)


def logistic(votes: np.ndarray, strengths: np.ndarray, target: np.ndarray, ridge: float = RIDGE, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression on soft targets, the bias last, by Newton's method."""
    n, size = len(votes), votes.shape[1] + 1
    w, rate = np.zeros(size), np.clip(target.mean(), 1e-3, 1 - 1e-3)
    w[-1] = np.log(rate / (1 - rate))
    penalty = np.full(size, ridge * n)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        gradient, hessian = penalty * w, np.diag(penalty)
        for part in chunks_of(n):
            z = inputs(votes[part], strengths[part])
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            gradient += z.T @ (p - target[part])
            hessian += (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z
        step = np.linalg.solve(hessian, gradient)
        w = w - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


def lexicon(train: DataFrame) -> list[str]:
    """The words whose texts are toxic surely enough, by the lower bound of the share; the sample bounds them."""
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != ""))
    counts = train.select("toxic", F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("k")).where(F.col("n") >= LEAST_TEXTS)
    n, p, z = F.col("n"), F.col("k") / F.col("n"), 2.0
    bound = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return sorted(r["word"] for r in counts.where(bound > LEAST_SHARE).select("word").collect())


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", size: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``size`` labelled texts outside the held-out part: each text once, with the share of its labels that are toxic."""
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = usable.groupBy("doc_id").agg(F.avg((F.col(label) > 0).cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)  # bounded, so it may be broadcast
    found = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    return found.groupBy("text").agg(F.avg("toxic").alias("toxic")).orderBy(F.xxhash64("text"), "text").limit(size)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> dict:
    """The lexicon's index, and the classifier's weights: of the words, of any word, of the patterns, and the bias."""
    sample = materialize(labelled_sample(docs, labels, label), "toxicity")
    index = {w: i for i, w in enumerate(lexicon(sample))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, strengths = zip(*(text_features(t, index) for t in batch.column(0).to_pylist())) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.list_(pa.int32())), pa.array(strengths, pa.list_(pa.float64())), batch.column(1)], ["hits", "strengths", "toxic"])

    rows = spread(sample).mapInArrow(run, "hits array<int>, strengths array<double>, toxic double").collect()  # at most SAMPLE rows
    rows.sort(key=lambda r: (r["hits"], r["strengths"], r["toxic"]))  # whatever order they came in
    given = np.array([r["toxic"] for r in rows])
    if not len(given) or given.min() >= 0.5 or given.max() < 0.5:
        return {"index": index, "weights": None, "rate": float(given.mean()) if len(given) else 0.0}
    strengths = np.array([r["strengths"] for r in rows])
    votes = votes_of([r["hits"] for r in rows], strengths, len(index))
    posterior, accuracy, weight = label_model(votes)
    return {"index": index, "weights": logistic(votes, strengths, posterior), "accuracy": accuracy, "voter_weight": weight, "agreement": float(((posterior >= 0.5) == (given >= 0.5)).mean())}


def scorer(model: dict):
    """A text's score under a trained model."""
    index, weights = model["index"], model["weights"]
    if weights is None:
        return lambda text: model["rate"]
    words, rest = weights[: len(index)], weights[len(index) :].tolist()

    def score_of(text: str) -> float:
        hits, strengths = text_features(text, index)
        raw = rest[-1] + float(words[hits].sum()) + (rest[0] if hits else 0.0) + sum(map(operator.mul, rest[1:-1], strengths))
        return 1 / (1 + math.exp(-min(max(raw, -30.0), 30.0)))

    return score_of


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = scorer(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([score_of(t.as_py() or "") for t in batch.column(1)], pa.float64())], ["doc_id", "score"])

    return spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))).mapInArrow(run, "doc_id long, score double")


def op6_toxicity_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose score is below the threshold, all columns kept; all documents where nothing could be learnt."""
    model = train(docs, table(spark, sf_dir, "labels"))
    if model["weights"] is None:
        return docs
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = scorer(model)
        for batch in batches:
            yield batch.filter(pa.array([score_of(t.as_py() or "") < THRESHOLD for t in batch.column(place)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
