"""Toxicity by a linear-chain conditional random field.

Token labels come from document labels: a word whose contexts lie almost only in toxic documents is a
toxic token there. A context is the pair of words around it, so copies of a document count once. The
field has two states; a token is described by how its word, its word's beginning and its neighbours
lean, in classes, by counts of the *other* half of the sample, so the field learns how far such a
leaning can be trusted on documents it has not seen. Forward-backward gives each token's marginal,
exact over texts of any length; marginals are aggregated to a document score by a logistic layer, and
tokens above one half are the offending offsets.

The field is fitted in numpy on the driver to a sample bounded by :class:`ToxicConfig`.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import documents, remainder, slices

_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class ToxicConfig:
    #: Bound of the sample: about so many documents of each label, none longer than so many characters.
    toxic_rows: int = 2500
    clean_rows: int = 3500
    longest: int = 20_000
    #: Tokens the field is fitted to, and how many gradient steps are taken.
    field_tokens: int = 300_000
    steps: int = 120
    #: What makes a word a toxic token: distinct contexts in toxic documents, and their share.
    least_contexts: int = 4
    least_share: float = 0.9
    prefix: int = 6


#: Leaning classes are cut at these log-odds over the prior; an unknown word leans by 0.
EDGES = np.array([-2.0, -0.7, -0.2, 0.2, 0.7, 1.5, 2.2, 3.0, 4.0])
BINS = len(EDGES) + 1


def _lower_in_place(text: str) -> str:
    """Lower case with every character at its place; the few that grow in lower case stay as they are."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def words_of(text: str) -> list[str]:
    """The words at the places that the offsets of a score refer to."""
    return _WORD.findall(_lower_in_place(text))


@dataclass
class Leanings:
    """How far words and beginnings lean to toxic documents, as classes."""

    word: dict[str, int]
    begin: dict[str, int]
    prefix: int

    def of(self, word: str) -> int:
        """One class for word, beginning and length: below BINS * BINS * 3."""
        neutral = int(np.searchsorted(EDGES, 0.0))
        size = 0 if len(word) < 4 else 1 if len(word) < 9 else 2
        begin = self.begin.get(word[: self.prefix], neutral) if len(word) >= self.prefix else neutral
        return (self.word.get(word, neutral) * BINS + begin) * 3 + size


def _contexts(docs: Sequence[list[str]], labels: Sequence[int]) -> tuple[list[str], np.ndarray]:
    """Words, and in how many distinct contexts each stands in clean and in toxic documents."""
    ids: dict[str, int] = {}
    flat = np.fromiter((ids.setdefault(w, len(ids)) for d in docs for w in d), np.int64, sum(map(len, docs)))
    if not len(flat):
        return [], np.zeros((0, 2))
    sizes = [len(d) for d in docs]
    owner, toxic = np.repeat(np.arange(len(docs)), sizes), np.repeat(np.array(labels, np.int64), sizes)
    edge = np.r_[True, owner[1:] != owner[:-1]]
    before = np.where(edge, -1, np.r_[-1, flat[:-1]]).astype(np.uint64)
    after = np.where(np.r_[edge[1:], True], -1, np.r_[flat[1:], -1]).astype(np.uint64)
    code = (before * np.uint64(0x9E3779B97F4A7C15) ^ (after + np.uint64(7)) * np.uint64(0xC2B2AE3D27D4EB4F))
    code = (code ^ (code >> np.uint64(29))) + flat.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    first = np.unique((code << np.uint64(1)) | toxic.astype(np.uint64), return_index=True)[1]
    counts = np.zeros((len(ids), 2))
    np.add.at(counts, (flat[first], toxic[first]), 1)
    return list(ids), counts


def _lean(keys: Sequence[str], counts: np.ndarray, prior: float, least: int = 2) -> dict[str, int]:
    keep = np.flatnonzero((counts[:, 1] >= least) | (counts[:, 0] >= 20))
    p = (counts[keep, 1] + 4 * prior) / (counts[keep].sum(1) + 4)
    bins = np.searchsorted(EDGES, np.log(p / (1 - p)) - np.log(prior / (1 - prior)))
    neutral = int(np.searchsorted(EDGES, 0.0))
    return {keys[k]: b for k, b in zip(keep.tolist(), bins.tolist()) if b != neutral}


def _leanings(docs: Sequence[list[str]], labels: Sequence[int], config: ToxicConfig) -> Leanings:
    words, counts = _contexts(docs, labels)
    total = counts.sum(0) + 1
    prior = float(np.clip(total[1] / total.sum(), 1e-4, 0.9999))
    ids: dict[str, int] = {}
    long = [(k, ids.setdefault(w[: config.prefix], len(ids))) for k, w in enumerate(words) if len(w) >= config.prefix]
    begin = np.zeros((len(ids), 2))
    if long:
        np.add.at(begin, [j for _, j in long], counts[[k for k, _ in long]])
    return Leanings(_lean(words, counts, prior), _lean(list(ids), begin, prior), config.prefix)


def _scan(m: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Row vectors first @ m[0] @ ... @ m[t], each scaled to sum one, for every t.

    The chain is folded into columns: all columns advance together, once to get their products, and
    once more from the vector that the columns before them lead to.
    """
    n = len(m)
    length = max(1, int(np.sqrt(n)))
    wide = -(-n // length)
    folded = np.concatenate([m, np.broadcast_to(np.eye(2), (wide * length - n, 2, 2))]).reshape(wide, length, 2, 2)
    folded = np.ascontiguousarray(folded.transpose(1, 2, 3, 0))  # step, from, to, column
    p00, p01, p10, p11 = np.ones(wide), np.zeros(wide), np.zeros(wide), np.ones(wide)
    for s in folded:
        p00, p01 = p00 * s[0, 0] + p01 * s[1, 0], p00 * s[0, 1] + p01 * s[1, 1]
        p10, p11 = p10 * s[0, 0] + p11 * s[1, 0], p10 * s[0, 1] + p11 * s[1, 1]
        scale = 1 / (p00 + p01 + p10 + p11)
        p00, p01, p10, p11 = p00 * scale, p01 * scale, p10 * scale, p11 * scale
    enter = np.empty((2, wide))
    a, b = float(first[0]), float(first[1])
    for k, (q00, q01, q10, q11) in enumerate(zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist())):
        enter[0, k], enter[1, k] = a, b
        a, b = a * q00 + b * q10, a * q01 + b * q11
        a, b = a / (a + b), b / (a + b)
    out = np.empty((length, 2, wide))
    a, b = enter
    for t, s in enumerate(folded):
        a, b = a * s[0, 0] + b * s[1, 0], a * s[0, 1] + b * s[1, 1]
        scale = 1 / (a + b)
        a, b = a * scale, b * scale
        out[t, 0], out[t, 1] = a, b
    return out.transpose(2, 0, 1).reshape(-1, 2)[:n]


def forward_backward(
    emission: np.ndarray, starts: np.ndarray, transition: np.ndarray, with_pairs: bool = True
) -> tuple[np.ndarray, np.ndarray | None]:
    """Marginals of state 1 at each token, and of each pair of states over each step (zero into a text's start).

    emission: log-odds of state 1; starts: whether a token begins a text; transition: log-potentials, a
    text starts from state 0.
    """
    step = np.exp(transition)
    e = np.exp(np.clip(emission, -30, 30))
    m = np.empty((len(e), 2, 2))
    m[:, :, 0] = step[:, 0]
    m[:, :, 1] = step[:, 1] * e[:, None]
    m[starts] = m[starts][:, :1, :]  # the state before a text is always 0
    ahead = _scan(m, np.array([1.0, 0.0]))
    # Backward: the same scan over the transposed steps in reverse; past a text's end all is one.
    back = m[::-1].transpose(0, 2, 1)
    behind = np.empty_like(ahead)
    behind[-1] = 0.5
    if len(e) > 1:
        behind[:-1] = _scan(back[:-1], np.array([0.5, 0.5]))[::-1]
    both = ahead * behind
    both /= both.sum(1, keepdims=True)
    if not with_pairs:
        return both[:, 1], None
    pairs = np.empty((len(e), 2, 2))
    pairs[0] = 0
    pairs[1:] = ahead[:-1, :, None] * m[1:] * behind[1:, None, :]
    pairs[1:] /= pairs[1:].sum((1, 2), keepdims=True)
    pairs[starts] = 0
    return both[:, 1], pairs


@dataclass
class Field:
    """Weights of the field: per class of the token, of the one before and the one after; transitions."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    transition: np.ndarray

    def emission(self, classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        e = self.own[classes]
        if len(e) > 1:
            e[1:] += np.where(starts[1:], 0, self.before[classes[:-1]])
            e[:-1] += np.where(starts[1:], 0, self.after[classes[1:]])
        return e


CLASSES = BINS * BINS * 3


def _design() -> np.ndarray:
    """Class to its one-hot parts: word leaning, beginning's leaning, length."""
    c = np.arange(CLASSES)
    return np.concatenate([np.eye(BINS)[c // (BINS * 3)], np.eye(BINS)[c // 3 % BINS], np.eye(3)[c % 3]], axis=1)


def fit_field(classes: np.ndarray, starts: np.ndarray, tags: np.ndarray, steps: int) -> Field:
    """Penalised maximum likelihood by adaptive gradient steps on exact expected counts."""
    design, lean = _design(), np.eye(BINS)[np.arange(CLASSES) // (BINS * 3)]
    sizes = (design.shape[1], BINS, BINS, 4)
    theta, mean, var = np.zeros(sum(sizes)), np.zeros(sum(sizes)), np.zeros(sum(sizes))
    theta[: BINS] = np.linspace(-3, 3, BINS)
    cut = np.cumsum(sizes)[:-1]
    n = len(classes)
    inner = ~starts[1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (tags[:-1][inner], tags[1:][inner]), 1)
    np.add.at(seen, (np.zeros(int(starts.sum()), int), tags[starts]), 1)
    for k in range(1, steps + 1):
        a, b, c, d = np.split(theta, cut)
        field = Field(design @ a, lean @ b, lean @ c, d.reshape(2, 2))
        p, pairs = forward_backward(field.emission(classes, starts), starts, field.transition)
        gap = tags - p
        by_class = lambda x, w: np.bincount(x, w, CLASSES)
        expected = pairs.sum(0)
        expected[0] += [(1 - p[starts]).sum(), p[starts].sum()]
        grad = np.concatenate([
            design.T @ by_class(classes, gap), lean.T @ by_class(classes[:-1], gap[1:] * inner),
            lean.T @ by_class(classes[1:], gap[:-1] * inner), (seen - expected).ravel(),
        ]) / n * 100 - 1e-3 * theta
        mean = 0.9 * mean + 0.1 * grad
        var = 0.98 * var + 0.02 * grad**2
        theta += 0.15 * (1 - k / (steps + 1)) * (mean / (1 - 0.9**k)) / (np.sqrt(var / (1 - 0.98**k)) + 1e-8)
    a, b, c, d = np.split(theta, cut)
    return Field(design @ a, lean @ b, lean @ c, d.reshape(2, 2))


def document_features(marginals: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
    """Constant, largest marginal, log of the expected tokens, odds that none is toxic, log length."""
    top = np.zeros(docs)
    np.maximum.at(top, owner, marginals)
    none = np.bincount(owner, -np.log1p(-np.minimum(marginals, 1 - 1e-9)), docs)
    total, n = np.bincount(owner, marginals, docs), np.bincount(owner, minlength=docs)
    return np.stack([np.ones(docs), top, np.log1p(total), np.minimum(none, 20) / 5, np.log1p(n) / 10], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (p - y) + 0.1 * w)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass
class ToxicModel:
    leanings: Leanings | None = None
    field: Field | None = None
    layer: np.ndarray | None = None
    constant: float = 0.0

    def classes(self) -> _Classes:
        return _Classes(self.leanings)


class _Classes(dict):
    """Class of each word, kept for the next time; emptied when full."""

    def __init__(self, leanings: Leanings):
        self.leanings = leanings

    def __missing__(self, word: str) -> int:
        if len(self) > 250_000:
            self.clear()
        self[word] = found = self.leanings.of(word)
        return found


def _flat(docs: Sequence[list[str]], classes: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all tokens, whether each starts a text, and the text of each."""
    sizes = [len(d) for d in docs]
    flat = np.fromiter((classes[w] for d in docs for w in d), np.int32, sum(sizes))
    owner = np.repeat(np.arange(len(docs)), sizes)
    return flat, np.r_[True, owner[1:] != owner[:-1]][: len(owner)], owner


def fit(rows: Sequence[tuple[int | None, str, int]], config: ToxicConfig = ToxicConfig()) -> ToxicModel:
    """Fit to (doc_id, text, toxic) rows; equal texts count once, the rows' order does not matter."""
    rows = {(t, y): i for i, t, y in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2]))}
    # By a hash of the text, so what the field is fitted to is a random part.
    rows = sorted(rows.items(), key=lambda r: (zlib.crc32(r[0][0].encode("utf-8", "replace")), r[0]))
    docs, labels = [words_of(t) for (t, _), _ in rows], [y for (_, y), _ in rows]
    if len(set(labels)) < 2:
        return ToxicModel(constant=float(labels[0]) if labels else 0.0)
    fold = np.array([zlib.crc32(t.encode("utf-8", "replace")) % 2 for (t, _), _ in rows])
    pick = lambda x, f: [d for d, k in zip(x, fold) if k == f]
    words, counts = _contexts(docs, labels)
    toxic = (counts[:, 1] >= config.least_contexts) & (counts[:, 1] >= config.least_share * counts.sum(1))
    terms = {words[k] for k in np.flatnonzero(toxic)}
    del words, counts
    parts = []
    for f in (0, 1):
        other = _leanings(pick(docs, 1 - f), pick(labels, 1 - f), config)
        own, y = pick(docs, f), pick(labels, f)
        flat, starts, owner = _flat(own, _Classes(other))
        tags = np.fromiter((w in terms and t == 1 for d, t in zip(own, y) for w in d), np.int64, len(flat))
        parts.append((flat, starts, owner, tags, np.array(y)))
    half = config.field_tokens // 2
    field = fit_field(*[np.concatenate([p[k][:half] for p in parts]) for k in (0, 1, 3)], config.steps)
    x, y = [], []
    for flat, starts, owner, _, label in parts:
        p = forward_backward(field.emission(flat, starts), starts, field.transition, False)[0] if len(flat) else np.zeros(0)
        x.append(document_features(p, owner, len(label)))
        y.append(label)
    return ToxicModel(_leanings(docs, labels, config), field, _logistic(np.concatenate(x), np.concatenate(y)))


def score(model: ToxicModel, texts: Sequence[str], classes: dict | None = None, most: int = 1 << 17) -> tuple[list[float], list[str]]:
    """Score and offending offsets (start:end in code points, comma-joined) of each text."""
    if model.field is None:
        return [model.constant] * len(texts), [""] * len(texts)
    classes = model.classes() if classes is None else classes
    scores, spans, at = [], [], 0
    while at < len(texts):
        docs, size = [], 0
        while at + len(docs) < len(texts) and (not docs or size < most):
            docs.append(words_of(texts[at + len(docs)]))
            size += len(docs[-1])
        flat, starts, owner = _flat(docs, classes)
        p = forward_backward(model.field.emission(flat, starts), starts, model.field.transition, False)[0] if len(flat) else np.zeros(0)
        z = document_features(p, owner, len(docs)) @ model.layer
        scores += (1 / (1 + np.exp(-np.clip(z, -30, 30)))).tolist()
        hits: dict[int, list[int]] = {}
        first = np.searchsorted(owner, np.arange(len(docs)))
        for t in np.flatnonzero(p >= 0.5).tolist():
            hits.setdefault(int(owner[t]), []).append(t - int(first[owner[t]]))
        for k in range(len(docs)):
            found = []
            if k in hits:
                places = [m.span() for m in _WORD.finditer(_lower_in_place(texts[at + k]))]
                found = [f"{places[t][0]}:{places[t][1]}" for t in hits[k]]
            spans.append(",".join(found))
        at += len(docs)
    return scores, spans


def _scores(model: ToxicModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = model.classes() if model.field else None
        for batch in slices(batches):
            scores, spans = score(model, batch.column(2).to_pylist(), classes)
            columns = [
                batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(spans, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted", "spans"])

    return run


def fit_on(docs: DataFrame, labels: DataFrame, config: ToxicConfig = ToxicConfig(), modulus: int = 5) -> ToxicModel:
    """Fit to a bounded sample of the labelled rows whose remainder is not 0.

    The sample is chosen among the labels, by hashed id, so many of each label; texts are fetched by
    joining its ids, whose number the configuration bounds, as a broadcast.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id", modulus) != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    wanted = {1: config.toxic_rows, 0: config.clean_rows}
    share = F.lit(0.0)
    for y, n in counts.items():
        share = F.when(F.col("toxic") == y, F.lit(min(1.0, wanted[y] / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    ids = known.where(drawn < share).orderBy(F.xxhash64("doc_id")).limit(2 * sum(wanted.values()))
    texts = documents(docs).where(F.length("text") <= config.longest)
    rows = texts.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "toxic").collect()
    return fit([tuple(r) for r in rows], config)


def score_documents(docs: DataFrame, model: ToxicModel, modulus: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, spans.

    A null text is empty; a text without a word gets the score of no evidence. Without both labels to
    learn from every score is the one label's value (0 without any). Repeated rows repeat. A label
    given twice counts as toxic if either is.
    """
    rows = documents(docs).select("doc_id", (remainder("doc_id", modulus) == 0).alias("held_out"), "text")
    return rows.mapInArrow(_scores(model), "doc_id long, held_out boolean, score double, predicted int, spans string")
