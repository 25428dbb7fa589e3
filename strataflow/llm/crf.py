"""Document quality from line labels of a linear-chain conditional random field.

Every line is good or bad, by features of itself and of its neighbours and by the label before
it. Documents' labels stand in for their lines' in training. A document's quality is the mean of
its lines' marginal probabilities of being good, from forward-backward, weighted by length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import ALNUM, SPACED, Words, extend, hash_spans, line_spans, map_slices, seen_before, text_bytes, written
from strataflow.llm.samples import held_out, labelled_ids

_kind = np.zeros(256, np.int64)
_kind[48:58] = 1  # digits
_kind[65:91] = 2  # capitals
_kind[97:123] = _kind[0x80:] = 3  # other letters, and whatever isn't ASCII
_kind[list(b".,;:!?'\"()-")] = 4  # marks of prose
_kind[list(b"#*$%&|<>{}[]=_/\\^~`@+")] = 5  # symbols
_kind[list(b" \t\r\n\x0b\x0c")] = 6
KINDS = 7
OWN = KINDS + 11


def _per_line(flags: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(flags)
    return np.searchsorted(at, ends) - np.searchsorted(at, begins)


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, weights, first): a row for each line with its own and its neighbours' features."""
    data, offsets = text_bytes(column)
    begins, ends, first = line_spans(data, offsets)
    n, size = len(begins), np.maximum(ends - begins, 1)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    kind = _kind[data]
    counts = np.stack([_per_line(kind == k, begins, ends) for k in range(KINDS)], 1)
    spaced, words = Words(data, offsets, SPACED), Words(data, offsets, ALNUM)
    tokens = _per_line_spans(spaced, begins, ends)
    bare = tokens - np.minimum(_per_line_spans(words, begins, ends), tokens)
    again, _ = seen_before(hash_spans(data, begins, ends), owner)
    repeated, _ = seen_before(spaced.hashes, spaced.owners())
    flags = np.zeros(len(data), bool)
    flags[spaced.begins[repeated]] = True
    adjacent = np.zeros(len(data), bool)
    if len(spaced.hashes) > 1:
        adjacent[spaced.begins[1:][spaced.hashes[1:] == spaced.hashes[:-1]]] = True
    some = np.maximum(tokens, 1)
    last = data[np.maximum(ends - 1, 0).clip(max=max(len(data) - 1, 0))] if len(data) else np.zeros(n, np.uint8)
    full = ends > begins
    ending = np.isin(last, np.frombuffer(b".!?\"')", np.uint8)) & full
    ending_symbol = (kind[np.maximum(ends - 1, 0).clip(max=max(len(data) - 1, 0))] == 5) & full if len(data) else np.zeros(n, bool)
    own = np.concatenate(
        [
            counts / size[:, None],
            np.stack(
                [
                    np.log1p(ends - begins) / 5,
                    np.log1p(tokens) / 4,
                    (ends - begins) / some / 10,
                    bare / some,
                    again & full,
                    _per_line(flags, begins, ends) / some,
                    _per_line(adjacent, begins, ends) / some,
                    ending,
                    ending_symbol,
                    ~full,
                    np.minimum(counts[:, 5] / some, 3),
                ],
                1,
            ),
        ],
        1,
    ).astype(np.float64)
    before, after = np.zeros_like(own), np.zeros_like(own)
    inner = owner[1:] == owner[:-1]
    before[1:][inner] = own[:-1][inner]
    after[:-1][inner] = own[1:][inner]
    edge = np.zeros((n, 3))
    edge[:, 0] = 1
    edge[first[:-1], 1] = 1
    edge[first[1:] - 1, 2] = 1
    return np.concatenate([own, before, after, edge], 1), size.astype(np.float64), first


def _per_line_spans(words: Words, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.searchsorted(words.begins, ends) - np.searchsorted(words.begins, begins)


WIDTH = 3 * OWN + 3


def forward_backward(unary: np.ndarray, pair: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(marginals, expected transitions, log normaliser of each chain) for chains one after another.

    All chains advance together, the longest first, so each step works on a shrinking front.
    """
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    starts, lengths = first[:-1][order], sizes[order]
    peak = unary.max(1, keepdims=True)
    psi, trans = np.exp(unary - peak), np.exp(pair)
    alpha, beta, scale = np.empty_like(psi), np.ones_like(psi), np.ones(len(unary))
    active = [int(np.searchsorted(-lengths, -t, "left")) for t in range(int(lengths[0]) if len(lengths) else 0)]
    for t, n in enumerate(active):
        at = starts[:n] + t
        a = psi[at] if t == 0 else (alpha[at - 1] @ trans) * psi[at]
        total = a.sum(1)
        alpha[at], scale[at] = a / total[:, None], total
    for t in range(len(active) - 1, 0, -1):
        at = starts[: active[t]] + t
        beta[at - 1] = (beta[at] * psi[at] / scale[at, None]) @ trans.T
    marginal = alpha * beta
    marginal /= marginal.sum(1, keepdims=True)
    linked = np.ones(len(unary), bool)
    linked[first[:-1]] = False
    to = np.flatnonzero(linked)
    expected = np.einsum("ti,tj->ij", alpha[to - 1], psi[to] * beta[to] / scale[to, None]) * trans
    log_z = np.add.reduceat(np.log(scale) + peak[:, 0], first[:-1]) if len(sizes) else np.zeros(0)
    return marginal, expected, log_z


@dataclass(frozen=True)
class LineModel:
    """Weights of line features for state good (bad has none) and the transitions between states."""

    weights: np.ndarray
    pair: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def unary(self, features: np.ndarray) -> np.ndarray:
        good = ((features - self.mean) / self.spread) @ self.weights
        return np.stack([np.zeros(len(good)), good], 1)

    def scores(self, column: pa.Array) -> np.ndarray:
        if not len(column):
            return np.zeros(0)
        features, weights, first = line_features(column)
        good = forward_backward(self.unary(features), self.pair, first)[0][:, 1]
        return np.add.reduceat(good * weights, first[:-1]) / np.add.reduceat(weights, first[:-1])


def fit_crf(features: np.ndarray, first: np.ndarray, labels: np.ndarray, steps: int = 150, rate: float = 0.08, decay: float = 1e-3) -> LineModel:
    """Adam on the mean log-likelihood of the lines, both classes weighing the same.

    Without documents of both classes every line is as likely good as the classes say.
    """
    mean, spread = np.zeros(WIDTH), np.ones(WIDTH)
    if not len(labels) or labels.min() == labels.max():
        weights = np.zeros(WIDTH)
        weights[3 * OWN] = 3.0 if len(labels) and labels[0] else 0.0 if not len(labels) else -3.0
        return LineModel(weights, np.zeros((2, 2)), mean, spread)
    mean[: 3 * OWN] = features[:, : 3 * OWN].mean(0)
    spread[: 3 * OWN] = features[:, : 3 * OWN].std(0) + 1e-3
    x = (features - mean) / spread
    sizes = np.diff(first)
    y = np.repeat(labels, sizes).astype(int)
    share = np.array([sizes[labels == k].sum() for k in (0, 1)], float)
    theta = np.zeros(WIDTH + 4)
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    lines = [x[y == k] for k in (0, 1)]
    firsts = [np.concatenate([[0], np.cumsum(sizes[labels == k])]) for k in (0, 1)]
    for step in range(1, steps + 1):
        w, pair = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
        grad = np.zeros_like(theta)
        for k, part in enumerate(lines):
            good = part @ w
            marginal, expected, _ = forward_backward(np.stack([np.zeros(len(good)), good], 1), pair, firsts[k])
            seen = np.zeros((2, 2))
            seen[k, k] = len(part) - (len(firsts[k]) - 1)
            weight = 0.5 / share[k]
            grad[:WIDTH] -= weight * (part.T @ (k - marginal[:, 1]))
            grad[WIDTH:] -= weight * (seen - expected).ravel()
        grad += decay * theta
        moment = 0.9 * moment + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        theta = theta - rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return LineModel(theta[:WIDTH], theta[WIDTH:].reshape(2, 2), mean, spread)


def stretches(first: np.ndarray, marks: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Chains cut into stretches of at most ``longest`` lines, each with its document's mark; no line is left out."""
    begins = [np.arange(a, b, longest) for a, b in zip(first[:-1], first[1:])]
    return np.append(np.concatenate([*begins, np.zeros(0, np.int64)]), first[-1]).astype(np.int64), np.repeat(marks, [len(x) for x in begins])


def training_rows(docs: DataFrame, labels: DataFrame, most: int, most_bytes: int) -> DataFrame:
    """(quality, text) of at most ``most`` labelled documents of each class, and of about ``most_bytes`` bytes.

    They are drawn by hashed id outside the held-out part. A line counts as 64 bytes more. An id whose
    texts take over a quarter of the bound alone is passed over, so that no one document is the sample.
    """
    ids = [labelled_ids(labels, "quality", k, most, 21 + k).withColumn("_quality", F.lit(k)) for k in (0, 1)]
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text) + 64 * (1 + F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))))
    sized = docs.select("doc_id", "text").join(F.broadcast(ids[0].unionByName(ids[1])), "doc_id").withColumn("_size", size.cast("long"))
    sized = written(sized.where(F.col("_size") <= most_bytes // 4), "quality-sample")
    by_id = sized.groupBy("_quality", "doc_id").agg(F.sum("_size").alias("_all")).where(F.col("_all") <= most_bytes // 4)
    so_far = F.sum("_all").over(Window.partitionBy("_quality").orderBy(F.xxhash64(F.lit(23), "doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    kept = by_id.withColumn("_so_far", so_far).where(F.col("_so_far") <= most_bytes).select("doc_id")
    return sized.join(F.broadcast(kept), "doc_id", "left_semi").select(F.col("_quality").alias("quality"), "text")


def train_quality(docs: DataFrame, labels: DataFrame, most: int = 1500, most_bytes: int = 16 << 20, longest: int = 120) -> LineModel:
    """Fit on all lines of at most ``most`` labelled documents and ``most_bytes`` of each class, held-out rows left out.

    Training cuts chains into stretches of ``longest`` lines, whose neighbours' features stay; scores
    go over whole documents. Null texts count as one empty line, repeated rows count as often as they
    come, ids with both labels not at all. Without documents of both classes see ``fit_crf``.
    """

    def lines(batch: pa.RecordBatch):
        features, _, first = line_features(batch.column("text"))
        out = [features[a:b].astype("<f4").tobytes() for a, b in zip(first[:-1], first[1:])]
        return pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(out, pa.binary())], ["quality", "lines"])

    sample = training_rows(docs, labels, most, most_bytes)
    rows = sorted((r[0], bytes(r[1])) for r in map_slices(sample, "text", lines, "quality int, lines binary").collect())
    found = [np.frombuffer(x, "<f4").reshape(-1, WIDTH) for _, x in rows]
    first = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
    features = np.concatenate(found).astype(np.float64) if found else np.zeros((0, WIDTH))
    return fit_crf(features, *stretches(first, np.array([k for k, _ in rows], int), longest))


def score_quality(docs: DataFrame, model: LineModel, threshold: float = 0.3, carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher is better) and ``predicted`` (1: good). No shuffle.

    Null and empty texts count as one empty line; very long texts are scored whole. Repeated rows each
    give a row, equal texts equal scores; columns of those names are replaced; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch):
        s = shared.value.scores(batch.column("text"))
        return {"score": pa.array(s), "predicted": pa.array((s >= threshold).astype(np.int32))}

    return extend(docs, score, "score double, predicted int", carry, limit=1 << 20)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; null ids are held out. All else as in ``train_quality`` and ``score_quality``."""
    model = train_quality(docs, labels)
    return score_quality(docs.select("doc_id", "text"), model, carry=["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")
