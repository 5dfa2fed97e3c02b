"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's subwords are the 2, 3 and 4 byte pieces of its words, hashed into a table of embeddings; the
mean embedding goes through one linear layer. Both are trained by stochastic gradient descent in
numpy, on the driver, from a sample bounded by :class:`LangConfig`. Mean and layer are linear, so the
trained model folds into one row of class weights per bucket, and executors score whole texts by
adding rows. Probabilities are calibrated by a temperature on sample rows kept aside, and the
rejection threshold is the score that all but ``reject_share`` of their right answers reach, or a
little over chance if that is less, so short texts are kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import remainder, slices

UNKNOWN = "und"


@dataclass(frozen=True)
class LangConfig:
    #: Bound of the training sample: about so many rows of a language, none longer than so many characters.
    rows_per_lang: int = 800
    longest: int = 20_000
    buckets_log2: int = 16
    dim: int = 16
    steps: int = 1000
    pieces: int = 256
    batch: int = 32
    rate: float = 0.5
    aside: float = 0.15
    reject_share: float = 0.0005
    #: A text is never rejected whose best score is this many times chance.
    over_chance: float = 1.25
    seed: int = 5


@dataclass
class LangModel:
    langs: list[str] = field(default_factory=list)
    table: np.ndarray | None = None
    bias: np.ndarray | None = None
    temperature: float = 1.0
    reject_below: float = 0.0
    bits: int = 16


#: Letters in lower case, bytes of other scripts as they are, everything else a space.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)
_MAYBE = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m[0].isalpha() for m in _MAYBE.finditer(text))


def subwords(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every subword of all texts, text after text for each length; and the text of each."""
    data = _FOLD[np.frombuffer(b" " + b"  ".join(texts) + b" ", np.uint8)]
    owner = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    keep = np.r_[True, (data[1:] != 32) | (data[:-1] != 32) | (owner[1:] != owner[:-1])]
    data, owner = data[keep].astype(np.uint32), owner[keep]
    h, out, who = data, [], []
    for n in range(2, 5):
        h = h[:-1] * np.uint32(0x01000193) + data[n - 1 :] + np.uint32(n)
        inside = owner[n - 1 :] == owner[: len(h)]
        out.append(((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits))[inside])
        who.append(owner[: len(h)][inside])
    return np.concatenate(out), np.concatenate(who)


def _groups(texts: list[bytes], most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    at = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t) > most:
            yield at, k
            at, size = k, 0
        size += len(t)
    if size or at < len(texts):
        yield at, len(texts)


def logits(model: LangModel, texts: list[bytes]) -> np.ndarray:
    """Class logits of each text over all its subwords."""
    out = np.zeros((len(texts), len(model.langs)))
    for lo, hi in _groups(texts):
        bucket, owner = subwords(texts[lo:hi], model.bits)
        n = np.bincount(owner, minlength=hi - lo)
        for c in range(len(model.langs)):
            out[lo:hi, c] = np.bincount(owner, model.table[bucket, c], hi - lo) / np.maximum(n, 1)
    return out + model.bias


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(texts: list[str], labels: list[str], config: LangConfig = LangConfig()) -> LangModel:
    """Train on (text, language) pairs; the order of the pairs is part of the result."""
    pairs = [(t.encode("utf-8", "replace"), y) for t, y in zip(texts, labels) if has_letter(t)]
    langs = sorted({y for _, y in pairs})
    model = LangModel(langs, bits=config.buckets_log2)
    if not langs:
        return model
    rng = np.random.default_rng(config.seed)
    y = np.array([langs.index(x) for _, x in pairs])
    small = np.uint16 if config.buckets_log2 <= 16 else np.uint32
    pieces = [subwords([t], config.buckets_log2)[0].astype(small) for t, _ in pairs]
    aside = rng.random(len(pairs)) < config.aside
    train = np.flatnonzero(~aside) if (~aside).any() else np.arange(len(pairs))
    share = np.bincount(y[train], minlength=len(langs))
    weight = len(train) / np.maximum(share, 1) / len(langs)
    table = rng.normal(0, 1 / config.dim, (1 << config.buckets_log2, config.dim))
    layer, bias = np.zeros((config.dim, len(langs))), np.zeros(len(langs))
    for done in range(config.steps):
        rows = train[rng.integers(0, len(train), config.batch)]
        drawn = np.stack([pieces[r][rng.integers(0, len(pieces[r]), config.pieces)] for r in rows])
        mean = table[drawn].mean(1)
        grad = _softmax(mean @ layer + bias)
        grad[np.arange(len(rows)), y[rows]] -= 1
        grad *= weight[y[rows], None]
        rate = config.rate * (1 - done / config.steps)
        back = grad @ layer.T * (-rate / config.pieces)
        layer -= rate * mean.T @ grad / len(rows)
        bias -= rate * grad.mean(0)
        np.add.at(table, drawn.ravel(), np.repeat(back, config.pieces, axis=0))
    model.table, model.bias = (table @ layer).astype(np.float32), bias
    judged = np.flatnonzero(aside) if aside.any() else train
    z = logits(model, [pairs[k][0] for k in judged])
    loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(judged)), y[judged]] + 1e-12).mean()
    model.temperature = float(min(np.geomspace(0.2, 5, 41), key=loss))
    p = _softmax(z / model.temperature)
    right = p.max(1)[p.argmax(1) == y[judged]]
    if len(right):
        model.reject_below = float(min(config.over_chance / len(langs), np.quantile(right, config.reject_share)))
    return model


def predict(model: LangModel, texts: list[str | None]) -> tuple[list[str], list[float]]:
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    at = [k for k, t in enumerate(texts) if model.langs and has_letter(t)]
    if at:
        p = _softmax(logits(model, [texts[k].encode("utf-8", "replace") for k in at]) / model.temperature)
        for k, c, s in zip(at, p.argmax(1).tolist(), p.max(1).tolist()):
            langs[k], scores[k] = model.langs[c], s
    return langs, scores


def fit_on(docs: DataFrame, config: LangConfig = LangConfig(), held_out: int = 2, modulus: int = 4) -> LangModel:
    """Train on a bounded sample of the labelled rows outside the held-out remainder.

    Languages are counted over all rows; each gives the rows whose hashed id falls under its share.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
        & (remainder("doc_id", modulus) != held_out) & (F.length("text") <= config.longest)
    )
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return LangModel()
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, config.rows_per_lang / n))]), F.col("lang"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(drawn < share).collect()
    sample.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"], r["text"], r["lang"]))
    return fit([r["text"] for r in sample], [r["lang"] for r in sample], config)


def _predictions(model: LangModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs, scores = predict(model, batch.column(2).to_pylist())
            columns = [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: LangModel, held_out: int = 2, modulus: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, rejected.

    A text that is null or has no letter is ``und`` with score 0 and rejected; so is every text when
    nothing could be learned. Otherwise lang_pred is the best learned value (ties: first by name) and
    rejected says whether its calibrated score stays under the model's threshold. Repeated rows give
    repeated rows; a null id counts as empty text in the remainder.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (remainder("doc_id", modulus) == held_out).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    found = rows.mapInArrow(_predictions(model), "doc_id long, held_out boolean, lang_pred string, score double")
    return found.withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("score") < model.reject_below))


def _accepted(model: LangModel, at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs, scores = predict(model, batch.column(at).to_pylist())
            stays = [x != UNKNOWN and s >= model.reject_below for x, s in zip(langs, scores)]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return run


def drop_rejected(docs: DataFrame, model: LangModel) -> DataFrame:
    """``docs`` without the rows that :func:`identify` rejects, in the same pass over the texts."""
    return docs.mapInArrow(_accepted(model, docs.columns.index("text")), docs.schema)
