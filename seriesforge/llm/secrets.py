"""Secrets: exact rules, and a character convolutional network over everything that could be one.

The rules (assignments to a telling name, access key ids, long hexadecimal runs) give the labelled
findings; their spans always stand. A candidate is every run of ``LEAST`` or more characters that keys
are written in. What the network sees is a candidate in windows of ``BODY`` characters with ``BEFORE``
characters in front and ``AFTER`` behind; a longer run has several windows and counts by its best one.

The network (numpy: embedding, one convolution, maxima over the three parts and a mean over the body,
logistic output; Adam) is trained on every candidate of the corpus, copies once, by its first window:
findings of the rules, candidates no rule touches, and findings and harmless runs generated in public
formats and set into contexts of the corpus, so that it has to look at the run itself and not only for
the names the rules know. The windows are dealt to parts of about ``PART`` by a hash; each part does an
epoch from the same weights, and the weights of all parts are averaged, by rows, for the next one. On
the windows kept aside in every part the scores are calibrated (slope and offset of the logit), and each
shape of candidate gets the highest threshold at which ``recall`` of its labelled findings are still found.

Texts are scanned once. The windows of the candidates are stored and scored from there.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import documents, materialize, slices

KINDS = ("assign", "access", "hex", "learned")
BASE = 3
LEAST, BEFORE, BODY, AFTER, WIDTH = 16, 24, 48, 16, 5
SPAN = BEFORE + BODY + AFTER
SHAPES = ("hex", "digits", "letters", "mixed")
Span = tuple[int, int, int]  # start, kind, end

# Possessive runs never give a character back: none of the patterns needs it, and scans stay linear.
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]++")
_HEX = re.compile(r"[0-9a-f]{24,}+")  # a run is found at its start, so this is every run of 24 or more
_RUN = re.compile(rf"[A-Za-z0-9+/_.=-]{{{LEAST},}}+")
# What a text must hold to be looked at; linear and in C++.
_ANY = rf"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]|[A-Za-z0-9+/_.=-]{{{LEAST}}}"""


@dataclass(frozen=True)
class SecretConfig:
    """Sizes of the network and its training, and the target of the thresholds."""

    generated: int = 2_500  # generated findings at least, and as many harmless runs; beyond, one for four windows no rule touches
    aside: float = 0.25
    recall: float = 0.95
    filters: int = 24
    embedding: int = 12
    epochs: int = 8
    seed: int = 7


def base_spans(text: str) -> list[Span]:
    """Spans of the exact rules, by start and kind; failing matches are dropped, not tried again."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def shape_of(run: str) -> int:
    if not run.strip("0123456789abcdefABCDEF"):
        return 0 if run.strip("0123456789") else 1
    return 3 if any(c in string.digits for c in run) else 2


def windows(text: str, start: int, end: int) -> list[str]:
    """The run in its context, cut into bodies of BODY characters; parts that are too short are filled with NUL."""
    out = []
    for at in range(start, end, BODY):
        body = text[at : min(end, at + BODY)]
        stop = at + len(body)
        out.append(text[max(0, at - BEFORE) : at].rjust(BEFORE, "\0") + body.ljust(BODY, "\0") + text[stop : stop + AFTER].ljust(AFTER, "\0"))
    return out


def candidates(text: str, base: list[Span]) -> list[tuple[int, int, bool]]:
    """Every run that could be a secret: start, end, and whether a rule's span touches it."""
    out, k = [], 0
    spans = sorted((s, e) for s, _, e in base)
    for m in _RUN.finditer(text):
        while k < len(spans) and spans[k][1] <= m.start():
            k += 1
        # Spans of different kinds may overlap, so the next few are looked at.
        touched = any(s < m.end() and e > m.start() for s, e in spans[max(0, k - 2) : k + 3])
        out.append((m.start(), m.end(), touched))
    return out


# --- the network -------------------------------------------------------------------------------------

_IDS = np.full(128, 96, np.uint8)
_IDS[32:127] = np.arange(1, 96)
_IDS[0] = 0
VOCABULARY = 98


def ids_of(texts: list[str]) -> np.ndarray:
    """Character ids, one row a window: NUL 0, printable ASCII, other ASCII, all else."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(texts), SPAN)
    return np.where(codes < 128, _IDS[np.minimum(codes, 127)], 97).astype(np.uint8)


# Places of the convolution that begin in each part.
_PARTS = ((0, BEFORE - WIDTH + 1), (BEFORE, BEFORE + BODY - WIDTH + 1), (BEFORE + BODY, SPAN - WIDTH + 1))


@dataclass
class Network:
    embed: np.ndarray  # VOCABULARY x embedding; NUL stays zero
    kernel: np.ndarray  # WIDTH * embedding x filters
    bias: np.ndarray
    dense: np.ndarray  # 4 * filters
    offset: np.ndarray  # one number
    slope: float = 1.0  # calibration of the logit
    shift: float = 0.0
    thresholds: tuple[float, ...] = (0.5,) * len(SHAPES)

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.kernel, self.bias, self.dense, self.offset]

    def logits(self, ids: np.ndarray, rows: int = 256) -> np.ndarray:
        """Scores before calibration. Embedding and kernel are one table a place, so this is lookups and sums."""
        filters = len(self.bias)
        tables = np.einsum("ve,wef->wvf", self.embed, self.kernel.reshape(WIDTH, -1, filters)).astype(np.float32)
        out = []
        for at in range(0, len(ids), rows):
            part = ids[at : at + rows]
            hidden = np.broadcast_to(self.bias.astype(np.float32), (len(part), SPAN - WIDTH + 1, filters)).copy()
            for w in range(WIDTH):
                hidden += tables[w][part[:, w : SPAN - WIDTH + 1 + w]]
            out.append(pooled(np.maximum(hidden, 0)) @ self.dense + self.offset[0])
        return np.concatenate(out) if out else np.zeros(0)

    def probabilities(self, ids: np.ndarray) -> np.ndarray:
        return self.calibrated(self.logits(ids))

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -50, 50)))


def pooled(hidden: np.ndarray) -> np.ndarray:
    """Maxima over the three parts and the mean over the body."""
    return np.concatenate([hidden[:, a:b].max(1) for a, b in _PARTS] + [hidden[:, _PARTS[1][0] : _PARTS[1][1]].mean(1)], axis=1)


def gradients(net: Network, ids: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Weighted log loss and its gradient in the weights."""
    n, filters, places = len(ids), len(net.bias), SPAN - WIDTH + 1
    embedded = net.embed[ids]
    columns = np.concatenate([embedded[:, w : places + w] for w in range(WIDTH)], axis=2)
    before = columns @ net.kernel + net.bias
    hidden = np.maximum(before, 0)
    features = pooled(hidden)
    p = 1 / (1 + np.exp(-np.clip(features @ net.dense + net.offset[0], -50, 50)))
    loss = -(weight * (truth * np.log(p + 1e-12) + (1 - truth) * np.log(1 - p + 1e-12))).mean()
    up = weight * (p - truth) / n
    down = np.zeros_like(hidden)
    back = up[:, None] * net.dense
    rows, fs = np.arange(n)[:, None], np.arange(filters)[None]
    for k, (a, b) in enumerate(_PARTS):
        down[rows, a + hidden[:, a:b].argmax(1), fs] += back[:, k * filters : (k + 1) * filters]
    a, b = _PARTS[1]
    down[:, a:b] += back[:, None, 3 * filters :] / (b - a)
    down *= before > 0
    flat = down.reshape(-1, filters)
    kernel = columns.reshape(-1, columns.shape[2]).T @ flat
    to_columns = (flat @ net.kernel.T).reshape(columns.shape)
    size, at_place = net.embed.shape[1], np.zeros_like(embedded)
    for w in range(WIDTH):
        at_place[:, w : places + w] += to_columns[:, :, w * size : (w + 1) * size]
    flat_ids = ids.ravel()
    embed = np.stack([np.bincount(flat_ids, at_place[:, :, d].ravel(), VOCABULARY) for d in range(size)], axis=1)
    embed[0] = 0
    return loss, [embed, kernel, flat.sum(0), features.T @ up, np.array([up.sum()])]


def fresh_network(cfg: SecretConfig) -> Network:
    rng = np.random.default_rng(cfg.seed)
    net = Network(rng.normal(0, 0.3, (VOCABULARY, cfg.embedding)), rng.normal(0, (2 / (WIDTH * cfg.embedding)) ** 0.5, (WIDTH * cfg.embedding, cfg.filters)),
                  np.zeros(cfg.filters), rng.normal(0, 0.1, 4 * cfg.filters), np.zeros(1))
    net.embed[0] = 0
    return net


def run_epoch(state: list[np.ndarray], epoch: int, part: int, ids: np.ndarray, truth: np.ndarray, weight: np.ndarray, cfg: SecretConfig) -> list[np.ndarray]:
    """Adam over shuffled batches of 128 windows: weights, first and second moments, before and after."""
    state = [w.copy() for w in state]
    net, size = Network(*state[: len(state) // 3]), len(state) // 3
    rate, batches = 4e-3 * (1 - epoch / cfg.epochs), range(0, len(ids), 128)
    order, step = np.random.default_rng([cfg.seed, part, epoch]).permutation(len(ids)), epoch * len(batches)
    for at in batches:
        batch, step = order[at : at + 128], step + 1
        for w, g, m, v in zip(net.weights(), gradients(net, ids[batch], truth[batch], weight[batch])[1], state[size : 2 * size], state[2 * size :]):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return state


def calibrate(net: Network, scored: DataFrame, steps: int = 100) -> None:
    """Slope and offset of the logit of (logit, truth) rows by Newton steps, a little pulled towards 1 and 0."""
    ab, x, y = np.array([1.0, 0.0]), F.col("logit"), F.col("truth")
    for _ in range(steps):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), x * float(ab[0]) + float(ab[1])))))
        bend = p * (1 - p)
        sums = [v or 0.0 for v in scored.agg(*[F.sum(c) for c in (x * (p - y), p - y, bend * x * x, bend * x, bend)]).first()]
        grad = np.array(sums[:2]) + ab - [1, 0]
        move = np.linalg.solve(np.array([[sums[2], sums[3]], [sums[3], sums[4]]]) + np.eye(2), grad)
        ab -= move
        if np.abs(move).max() < 1e-8:
            break
    net.slope, net.shift = max(float(ab[0]), 1e-3), float(ab[1])


def fit_thresholds(net: Network, scored: DataFrame, recall: float) -> tuple[float, ...]:
    """``thresholds`` of (logit, truth, shape) rows; no shape's scores are brought together, ranks are right to one in a million."""
    found = scored.where("truth > 0")
    n = {r["shape"]: r["count"] for r in found.groupBy("shape").count().collect()}

    def at(count: int):
        return F.lit((int((1 - recall) * count) + 0.5) / max(count, 1)), F.lit(1_000_000)

    every, *own = found.agg(F.percentile_approx("logit", *at(sum(n.values()))), *[
        F.percentile_approx(F.when(F.col("shape") == k, F.col("logit")), *at(n.get(k, 0))) for k in range(len(SHAPES))]).first()
    chosen = [own[k] if n.get(k, 0) >= 20 else every for k in range(len(SHAPES))]
    return tuple(0.5 if logit is None else float(net.calibrated(np.array([logit]))[0]) for logit in chosen)


def thresholds(score: np.ndarray, truth: np.ndarray, shape: np.ndarray, recall: float) -> tuple[float, ...]:
    """For each shape the highest threshold that still finds ``recall`` of its findings; shapes without any take that of all."""
    def highest(found: np.ndarray) -> float:
        found = np.sort(found)
        return float(found[int((1 - recall) * len(found))]) if len(found) else 0.5

    every = highest(score[truth > 0])
    return tuple(highest(score[(truth > 0) & (shape == k)]) if ((truth > 0) & (shape == k)).sum() >= 20 else every for k in range(len(SHAPES)))


# --- generated findings and harmless runs --------------------------------------------------------------

_ALNUM, _HEXES = string.ascii_letters + string.digits, "0123456789abcdef"
# Public formats of keys: prefix, alphabet, length.
FORMATS = (
    ("ghp_", _ALNUM, 36), ("github_pat_", _ALNUM + "_", 60), ("sk_live_", _ALNUM, 24), ("rk_live_", _ALNUM, 24), ("xoxb-", string.digits + "-", 24),
    ("glpat-", _ALNUM + "_-", 20), ("AIza", _ALNUM + "_-", 35), ("SG.", _ALNUM + "_-", 43), ("npm_", _ALNUM, 36), ("ASIA", string.ascii_uppercase + string.digits, 16),
    ("eyJhbGciOiJIUzI1NiJ9.", _ALNUM + "_-", 60), ("", _ALNUM + "/+", 40), ("", _ALNUM, 32), ("", _ALNUM, 24), ("", _HEXES.upper(), 32), ("", _HEXES, 22),
)
KEY_CONTEXTS = ("pwd=", "auth: ", "Authorization: Bearer ", "credential=", "private_key: ", "client_id=", "key=", "passphrase: ", "export KEY=", "-u admin:")
HARMLESS_JOINS = ("-", "_", "/", ".")


def _words(rng: np.random.Generator, pool: list[str], least: int) -> list[str]:
    out: list[str] = []
    while sum(map(len, out)) + len(out) < least:
        out.append(pool[rng.integers(len(pool))])
    return out


def generated_finding(rng: np.random.Generator) -> str:
    prefix, letters, length = FORMATS[rng.integers(len(FORMATS))]
    return prefix + "".join(letters[k] for k in rng.integers(len(letters), size=length + int(rng.integers(0, 3))))


def generated_harmless(rng: np.random.Generator, pool: list[str]) -> str:
    kind = rng.integers(8)
    if kind == 0:  # paths, slugs and dotted names
        return HARMLESS_JOINS[rng.integers(4)].join(_words(rng, pool, 18))
    if kind == 1:  # camel case
        return "".join(w.capitalize() for w in _words(rng, pool, 18))
    if kind == 2:  # rules and fillers
        return "-=_.+/x0"[rng.integers(8)] * int(rng.integers(16, 60))
    if kind == 3:  # numbers
        return "".join(string.digits[k] for k in rng.integers(10, size=rng.integers(16, 24)))
    if kind == 4:  # dates and versions
        y, m, d, h = rng.integers(1990, 2030), rng.integers(1, 13), rng.integers(1, 29), rng.integers(24)
        return f"{y}-{m:02}-{d:02}T{h:02}.{m:02}.{d:02}" if h % 2 else f"release-{y}.{m}.{d}-build{h}"
    if kind == 5:  # addresses
        return "/".join(["www." + pool[rng.integers(len(pool))] + ".com", *_words(rng, pool, 12)])
    if kind == 6:  # file names with numbers
        return "_".join(_words(rng, pool, 12)) + f"_{rng.integers(10000):04}.tar.gz"
    return "".join(_words(rng, pool, 16))  # long words


def planted(run: str, context: str, key: str = "") -> str:
    """The first window of ``run`` in the context of another window, behind ``key``."""
    left, right = context[:BEFORE].replace("\0", " "), context[BEFORE + BODY :].replace("\0", " ")
    text = left + key + run + " " + right.lstrip(_ALNUM + "+/_.=-")
    return windows(text, BEFORE + len(key), BEFORE + len(key) + len(run))[0]


def training_set(found: list[str], other: list[str], cfg: SecretConfig) -> tuple[list[str], np.ndarray]:
    """Windows and labels: findings and others, then generated ones in contexts of the others."""
    rng = np.random.default_rng(cfg.seed)
    contexts = other or ["\0" * SPAN]
    pool = sorted({w for x in contexts for w in re.findall("[a-z]{3,10}", x)})[:5000] or ["lorem", "ipsum", "dolor", "amet"]
    texts, truth = [*found, *other], [1] * len(found) + [0] * len(other)
    def add(run: str, key: str, label: int) -> None:
        texts.append(planted(run, contexts[rng.integers(len(contexts))], key))
        truth.append(label)

    for k in range(cfg.generated):
        key = KEY_CONTEXTS[rng.integers(len(KEY_CONTEXTS))] if k % 2 else ""
        add(generated_finding(rng), key, 1)
        # Harmless runs behind telling names, too, and findings of the rules away from theirs.
        add(generated_harmless(rng, pool), key if k % 8 == 1 else "", 0)
        if found and k % 4 == 0:
            add(found[rng.integers(len(found))][BEFORE : BEFORE + BODY].rstrip("\0"), "", 1)
    return texts, np.array(truth, float)


# --- Spark ---------------------------------------------------------------------------------------------

_BASE = pa.list_(pa.struct([("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64())]))
_CANDIDATES = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("shape", pa.int32()), ("touched", pa.bool_()), ("windows", pa.list_(pa.string()))]))
_SCHEMA = "doc_id long, base array<struct<s:long,k:int,e:long>>, runs array<struct<s:long,e:long,shape:int,touched:boolean,windows:array<string>>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        any_ = pc.match_substring_regex(batch.column(1), _ANY).to_pylist()
        spans, runs = [], []
        for text, look in zip(batch.column(1), any_):
            if not look:
                spans.append([])
                runs.append([])
                continue
            text = text.as_py()
            base = base_spans(text)
            spans.append([{"s": s, "k": k, "e": e} for s, k, e in base])
            runs.append([{"s": s, "e": e, "shape": shape_of(text[s:e]), "touched": t, "windows": windows(text, s, e)} for s, e, t in candidates(text, base)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _BASE), pa.array(runs, _CANDIDATES)], ["doc_id", "base", "runs"])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base, runs): the rules' spans and all candidates of every whole text."""
    return documents(docs).mapInArrow(_scan, _SCHEMA)


PART = 20_000  # windows that train together


def _training_part(cfg: SecretConfig, parts: int) -> Callable[[pa.Table], pa.Table]:
    """The windows of one part with generated ones in their contexts, as arrays in one row."""
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        rows = sorted((w, t) for w, t in zip(table.column("window").to_pylist(), table.column("touched").to_pylist()) if w is not None)
        found, other = [w for w, t in rows if t], [w for w, t in rows if not t]
        made = max(-(-cfg.generated // parts), len(other) // 4)
        texts, truth = training_set(found, other, replace(cfg, generated=made, seed=cfg.seed + part))
        shape = np.array([shape_of(x[BEFORE : BEFORE + BODY].rstrip("\0")) for x in texts], np.uint8)
        aside = np.random.default_rng([cfg.seed + 1, part]).random(len(texts)) < cfg.aside
        arrays = ids_of(texts), truth.astype(np.uint8), shape, aside.astype(np.uint8)
        return pa.table({"part": [part], "n": [len(texts)], "positive": [int(truth.sum())], **{k: pa.array([a.tobytes()], pa.binary()) for k, a in zip(_ARRAYS, arrays)}})
    return run


_ARRAYS = ("ids", "truth", "shape", "aside")
_PART_SCHEMA = "part long, n long, positive long, ids binary, truth binary, shape binary, aside binary"


def _parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray]]]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, truth, shape, aside = (np.frombuffer(row[k], np.uint8) for k in _ARRAYS)
            yield row["part"], [ids.reshape(-1, SPAN), truth.astype(float), shape, aside > 0]


def _epoch(state: list[np.ndarray], epoch: int, share: float, cfg: SecretConfig, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, (ids, truth, _, aside) in _parts_of(batches):
        weight = np.where(truth > 0, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
        after = run_epoch(state, epoch, part, ids[~aside], truth[~aside], weight[~aside], cfg)
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([int((~aside).sum())]), pa.array([np.concatenate([w.ravel() for w in after]).tobytes()])], ["part", "n", "state"])


def _aside(net: Network, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, (ids, truth, shape, aside) in _parts_of(batches):
        logit = net.logits(ids[aside]).astype(float)
        yield pa.RecordBatch.from_arrays([pa.array(logit), pa.array(truth[aside]), pa.array(shape[aside].astype(np.int32))], ["logit", "truth", "shape"])


def fit_on(scanned: DataFrame, cfg: SecretConfig = SecretConfig(), part_rows: int = PART) -> Network:
    """Network, calibration and thresholds from every candidate of a scanned table, copies once."""
    spark = scanned.sparkSession
    windows = materialize(scanned.select(F.explode("runs").alias("r")).select(
        "r.touched", F.element_at("r.windows", 1).alias("window")).distinct(), "secret-windows")
    parts = max(1, -(-windows.count() // part_rows))
    dealt = windows.withColumn("part", F.pmod(F.xxhash64("window"), F.lit(parts)))
    # A row without a window stands for each part, so that there is one even without any candidate.
    every = dealt.unionByName(spark.range(parts).select(F.col("id").alias("part"), F.lit(None).cast("boolean").alias("touched"), F.lit(None).cast("string").alias("window")))
    training = materialize(every.groupBy("part").applyInArrow(_training_part(cfg, parts), _PART_SCHEMA).repartitionByRange(parts, "part"), "secret-training")
    n, positive = training.agg(F.sum("n"), F.sum("positive")).first()
    net = fresh_network(cfg)
    state = [*net.weights(), *(np.zeros_like(w) for _ in range(2) for w in net.weights())]
    cuts = np.cumsum([w.size for w in state])[:-1]
    for epoch in range(cfg.epochs):
        run = partial(_epoch, state, epoch, positive / n, cfg)
        total, rows = 0.0, 0
        # One set of weights a part, in the order of the parts, so that sums do not depend on which ends first.
        for r in sorted(training.mapInArrow(run, "part long, n long, state binary").collect()):
            total, rows = total + r["n"] * np.frombuffer(r["state"]), rows + r["n"]
        state = [w.reshape(old.shape).copy() for w, old in zip(np.split(total / rows, cuts), state)]
    net = Network(*state[: len(state) // 3])
    scored = materialize(training.mapInArrow(partial(_aside, net), "logit double, truth double, shape int"), "secret-aside")
    calibrate(net, scored)
    net.thresholds = fit_thresholds(net, scored, cfg.recall)
    return net


def _score(net: Network, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    least = np.array(net.thresholds)
    for batch in slices(batches):
        runs = batch.column(1).to_pylist()
        new = [r for found in runs for r in found if not r["touched"]]
        good: list[bool] = []
        for at in range(0, len(new), 512):
            part = new[at : at + 512]
            score = net.probabilities(ids_of([w for r in part for w in r["windows"]]))
            starts = np.cumsum([0] + [len(r["windows"]) for r in part])[:-1]
            best = np.maximum.reduceat(score, starts)
            good += (best >= least[[r["shape"] for r in part]]).tolist()
        kept = iter(good)
        added = [[{"s": r["s"], "k": BASE, "e": r["e"]} for r in found if not r["touched"] and next(kept)] for found in runs]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(added, _BASE)], ["doc_id", "base", "added"])


def find_in(scanned: DataFrame, net: Network) -> DataFrame:
    """(doc_id, base, added) of a scanned table."""
    span = "array<struct<s:long,k:int,e:long>>"
    return scanned.select("doc_id", "runs", "base").mapInArrow(partial(_score, net), f"doc_id long, base {span}, added {span}")


def find_secrets(docs: DataFrame, cfg: SecretConfig = SecretConfig()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Counts and digest are of the rules' spans; ``spans`` holds those and the candidates the network
    accepts (kind ``learned``), as kind:start:end (code points, end exclusive) by start, then kind. A
    null or empty text has no span: zeros, the digest of the empty string and an empty string. Repeated
    rows repeat; other columns are ignored; an empty table has no rows. Without any finding in the
    corpus the network learns from generated ones alone.
    """
    scanned = materialize(scan(docs), "secret-candidates")
    found = find_in(scanned, fit_on(scanned, cfg))
    span = lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x.k + 1), x.s, x.e)
    joined = lambda spans: F.array_join(F.transform(F.array_sort(spans), span), ",")
    n = lambda k: F.size(F.filter("base", lambda x: x.k == k)).cast("long")
    return found.select(
        "doc_id", *[n(k).alias(f"n_{KINDS[k]}") for k in range(BASE)],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"))
