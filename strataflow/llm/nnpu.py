"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other training text is unlabelled, some of it toxic.
With the share of toxic text (the class prior) pi, the risk on negatives is estimated as
R_u(-) - pi * R_p(-), which overfits once it drops below zero; there the step goes the other way,
as in Kiryo et al., 2017. The classifier is linear in the presence of hashed words and hashed
beginnings of words, so that a few toxic words count alike in a short and in a very long text, and
inflected forms count as their stem.

The unlabelled side is the whole corpus: which words serve as features follows from counts over all
of it, and each step's risk and gradient are sums over all of it, of which tasks add up their shares.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import U64, Words, extend, map_slices, slices, spread, text_bytes, written
from strataflow.llm.samples import held_out, labelled_ids

BUCKETS = 1 << 20


#: Bytes of the word beginnings that count besides whole words.
STEMS = (4, 5, 6, 7, 8)


def _word_buckets(column: pa.Array, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(owner, bucket) of each distinct hashed word and stem of each text; only those with a place, if given."""
    words = Words(*text_bytes(column))
    owners, found = words.owners(), []
    for at, hashes in ((slice(None), words.hashes), *map(words.stems, STEMS)):
        owner, bucket = owners[at], (hashes >> U64(44)).astype(np.int64)
        if place is not None:
            used = place[bucket] >= 0
            owner, bucket = owner[used], bucket[used]
        found.append(owner * BUCKETS + bucket)
    joint = np.unique(np.concatenate(found))
    return joint // BUCKETS, joint % BUCKETS


@dataclass(frozen=True)
class ToxicModel:
    """Weights of the chosen word buckets and the bias; ``place`` finds a bucket's weight, -1 for none."""

    place: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        owner, bucket = _word_buckets(column, self.place)
        logit = np.bincount(owner, self.weights[self.place[bucket]], minlength=len(column)) + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def enough(positives: int) -> float:
    """Positives in which a word must occur to be a feature."""
    return max(3, 0.002 * positives)


def choose_words(in_p: np.ndarray, positives: int, in_u: np.ndarray, unlabelled: int, prior: float, features: int) -> np.ndarray:
    """Place of each bucket among the features, -1 for none, from the numbers of texts that have it."""
    p, u = (in_p + 0.5) / (positives + 1), (in_u + 0.5) / (unlabelled + 1)
    # Share of a bucket's texts that are positive, if prior * p of all texts are: how pure it is.
    purity = np.minimum(prior * p / u, 1)
    chosen = np.flatnonzero((in_p >= enough(positives)) & (purity >= min(0.5, 3 * prior)))
    chosen = chosen[np.argsort(-(purity * np.sqrt(in_p))[chosen], kind="stable")][:features]
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    return place


def pull(owner: np.ndarray, at: np.ndarray, times: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
    """Gradient by weights and bias of the texts' summed scores, and the sum itself; text k counts ``times[k]`` times."""
    s = 1 / (1 + np.exp(-np.clip(np.bincount(owner, w[at], minlength=len(times)) + b, -30, 30)))
    slope = times * s * (1 - s)
    return np.concatenate([np.bincount(at, slope[owner], minlength=len(w)), [slope.sum(), (times * s).sum()]])


def descend(width: int, of_positive: Callable, of_unlabelled: Callable, prior: float, steps: int = 40, rate: float = 0.3, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam on the non-negative risk with the sigmoid loss.

    Both functions give the gradient of the mean score by weights and bias, and the mean score.
    """
    w, b = np.full(width, 1.0), -2.0
    moment, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        positive, unlabelled = of_positive(w, b), of_unlabelled(w, b)
        negative = unlabelled - prior * positive  # of scoring as positive what isn't, and its gradient
        grad = (-negative if negative[-1] < 0 else negative - prior * positive)[:-1]
        grad[:-1] += decay * w
        moment = 0.9 * moment + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        move = rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def _matrix(texts: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    at = place[np.concatenate(texts).astype(np.int64)]
    return owner[at >= 0], at[at >= 0], np.full(len(texts), 1 / len(texts))


def _nothing_learnt() -> ToxicModel:
    return ToxicModel(np.full(BUCKETS, -1, np.int32), np.zeros(0), -3.0)


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, features: int = 2048, steps: int = 40, rate: float = 0.3) -> ToxicModel:
    """The fit of ``train_toxicity`` on bucket sets in memory.

    Without positives or unlabelled texts every score is below one half.
    """
    if not positive or not unlabelled:
        return _nothing_learnt()
    count = lambda texts: np.bincount(np.concatenate(texts).astype(np.int64), minlength=BUCKETS)
    place = choose_words(count(positive), len(positive), count(unlabelled), len(unlabelled), prior, features)
    parts = [_matrix(positive, place), _matrix(unlabelled, place)]
    w, b = descend(int(place.max()) + 1, *[lambda w, b, part=part: pull(*part, w, b) for part in parts], prior, steps, rate)
    return ToxicModel(place, w, b)


def _bucket_sets(docs: DataFrame, ids: DataFrame) -> list[np.ndarray]:
    def sets(batch: pa.RecordBatch):
        owner, bucket = _word_buckets(batch.column("text"))
        parts = np.split(bucket.astype("<u4"), np.searchsorted(owner, np.arange(1, batch.num_rows)))
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in parts], pa.binary())], ["set"])

    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi").select("text")
    return [np.frombuffer(x[0], "<u4") for x in map_slices(chosen, "text", sets, "set binary").distinct().collect()]


def _sums(rows: DataFrame, width: int) -> np.ndarray:
    """``rows`` of (place, value) from all tasks, added up by place."""
    out = np.zeros(width)
    for place, value in rows.groupBy("place").agg(F.sum("value")).collect():
        out[place] = value
    return out


def _totals(values: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(values)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(values[at], pa.float64())], ["place", "value"])


def _texts_with(docs: DataFrame, wanted: np.ndarray) -> np.ndarray:
    """Of each wanted bucket the number of texts that have it; last, the number of texts."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches):
        place = np.full(BUCKETS, -1, np.int32)
        place[shared.value] = np.arange(len(shared.value))
        total = np.zeros(len(shared.value) + 1)
        for batch in batches:
            for part in slices(batch, "text"):
                _, bucket = _word_buckets(part.column("text"), place)
                total[:-1] += np.bincount(place[bucket], minlength=len(total) - 1)
                total[-1] += part.num_rows
        yield _totals(total)

    return _sums(spread(docs.select("text")).mapInArrow(count, "place long, value double"), len(wanted) + 1)


def _feature_sets(docs: DataFrame, place: np.ndarray) -> DataFrame:
    """(set, texts): the sets of features that texts have, and how many have each; written once, read at every step."""
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def sets(batch: pa.RecordBatch):
        owner, bucket = _word_buckets(batch.column("text"), shared.value)
        parts = np.split(shared.value[bucket].astype("<u2"), np.searchsorted(owner, np.arange(1, batch.num_rows)))
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in parts], pa.binary())], ["set"])

    return written(map_slices(docs.select("text"), "text", sets, "set binary").groupBy("set").agg(F.count("*").alias("texts")), "toxic-sets")


def _mean_pull(sets: DataFrame, texts: float) -> Callable:
    """The gradient of the mean score over all of ``sets``, and that mean, by one pass."""

    def of(w: np.ndarray, b: float) -> np.ndarray:
        shared = sets.sparkSession.sparkContext.broadcast((w, b))

        def run(batches):
            w, b = shared.value
            total = np.zeros(len(w) + 2)
            for batch in batches:
                column = batch.column("set").cast(pa.large_binary())
                _, offsets, data = column.buffers()
                offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
                at = np.frombuffer(data, "<u2", count=(offsets[-1] - offsets[0]) // 2, offset=int(offsets[0])) if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.int64)
                total += pull(np.repeat(np.arange(len(column)), np.diff(offsets) // 2), at.astype(np.int64), batch.column("texts").to_numpy() / texts, w, b)
            yield _totals(total)

        out = _sums(sets.mapInArrow(run, "place long, value double"), len(w) + 2)
        shared.destroy()
        return out

    return of


def train_toxicity(docs: DataFrame, labels: DataFrame, most_positive: int = 6000, features: int = 2048, steps: int = 40) -> ToxicModel:
    """Fit on at most ``most_positive`` labelled toxic texts and on all other text as unlabelled.

    The prior is the share of toxic rows among all labelled ones. Neither side uses a held-out row, or
    one without an id. Texts of the same words count once among the positives, as often as they come
    among the unlabelled. Nulls are empty texts, very long texts count whole. Each step is a pass over
    the texts' feature sets, written once. Without positives or other texts nothing is learnt.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out())
    prior = float(min(max(known.agg(F.avg("toxic")).first()[0] or 0.01, 0.001), 0.9))
    positive = _bucket_sets(docs, labelled_ids(labels, "toxic", 1, most_positive, 11))
    if not positive:
        return _nothing_learnt()
    in_p = np.bincount(np.concatenate(positive).astype(np.int64), minlength=BUCKETS)
    wanted = np.flatnonzero(in_p >= enough(len(positive)))
    unlabelled = docs.where(~held_out()).select("text")
    counts = _texts_with(unlabelled, wanted)
    in_u = np.zeros(BUCKETS)
    in_u[wanted] = counts[:-1]
    place = choose_words(in_p, len(positive), in_u, int(counts[-1]), prior, features)
    part = _matrix(positive, place)
    w, b = descend(int(place.max()) + 1, lambda w, b: pull(*part, w, b), _mean_pull(_feature_sets(unlabelled, place), counts[-1]), prior, steps)
    return ToxicModel(place, w, b)


def score_toxicity(docs: DataFrame, model: ToxicModel, threshold: float = 0.5, carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``; from the whole text, null as empty, however long. No shuffle.

    Repeated rows each give a row, equal texts equal scores; columns of those names are replaced; an
    empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch):
        s = shared.value.scores(batch.column("text"))
        return {"score": pa.array(s), "predicted": pa.array((s >= threshold).astype(np.int32))}

    return extend(docs, score, "score double, predicted int", carry)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; an empty text scores by the bias alone.

    Null ids are held out. All else as in ``train_toxicity`` and ``score_toxicity``; other columns are ignored.
    """
    model = train_toxicity(docs, labels)
    return score_toxicity(docs.select("doc_id", "text"), model, carry=["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")
