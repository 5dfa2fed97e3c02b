"""Personal data by weak supervision.

Exact rules find e-mail addresses, IP addresses, card and phone numbers; these spans always stand.
Looser patterns propose further spans (secrets, long identifiers, national ids, local phone numbers).
Four labelers vote yes, no or nothing on every span: its shape, a gazetteer (issuers, areas, key
names, top-level domains), its context, and its composition. Votes are counted over the whole corpus
by pattern, of which there is a bounded number; expectation-maximisation on the counts estimates how
reliable each labeler is, without any truth, and a logistic classifier over votes, kind, length and
digit share is trained on the resulting soft labels. Proposals it accepts are added.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import documents, materialize, slices

KINDS = ("email", "ip", "card", "phone", "secret", "number", "national_id", "local_phone")
BASE = 4
Span = tuple[int, int, int]  # start, kind, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Possessive runs never give a character back: none of the patterns needs it, and scans stay linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,}+")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
_ANY = re.compile(r"[0-9@]|[A-Za-z0-9_+/-]{20}")
_NOT_DIGIT = re.compile(r"[^0-9]+")

# Gazetteers.
KEY_NAMES = ("token", "key", "secret", "password", "passwd", "pwd", "auth", "bearer", "credential")
CUES = {
    "email": ("mail", "contact", "write", "reach"), "ip": ("host", "server", "address", "ip "),
    "card": ("card", "visa", "credit", "pay"), "phone": ("call", "phone", "tel", "fax", "mobile"),
    "secret": KEY_NAMES, "number": ("card", "account", "iban", "passport", "member"),
    "national_id": ("ssn", "social", "tax", "security"), "local_phone": ("call", "phone", "tel", "fax", "mobile"),
}
NO_CUES = ("order", "isbn", "issn", "version", "page", "invoice", "sha", "md5", "commit", "checksum")
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info")
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, found from each @: linear in the text."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out.append((start, match.end()))
            done = match.end()
        else:
            done = at + 1
        at = text.find("@", max(at + 1, done))
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    """Groups of four numbers in each dotted run, all of at most 255."""
    out = []
    for m in _DOTTED.finditer(text):
        if m[0].count(".") >= 3:
            at, parts = m.start(), m[0].split(".")
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                end = at + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                    out.append((at, end))
                at = end + 1
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the exact rules, by start and kind."""
    if "@" not in text and not any(d in text for d in "0123456789"):
        return []
    out = [(s, 0, e) for s, e in emails(text)] + [(s, 1, e) for s, e in addresses(text)]
    for m in _DIGITS.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def proposals(text: str, base: list[Span]) -> list[Span]:
    """Spans of the loose patterns that touch neither a base span nor an earlier proposal."""
    found = [(m.start(), 4, m.end()) for m in _SECRET.finditer(text)]
    found += [(m.start(), 6, m.end()) for m in _NATIONAL.finditer(text)]
    found += [(m.start(), 7, m.end()) for m in _LOCAL_PHONE.finditer(text)]
    for m in _DIGITS.finditer(text):
        if 9 <= len(m[0].replace(" ", "").replace("-", "")) <= 19:
            found.append((m.start(), 5, m.end()))
    out, taken = [], sorted((s, e) for s, _, e in base)
    for s, k, e in sorted(found, key=lambda x: (x[0], -x[2], -x[1])):
        while taken and taken[0][1] <= s:
            taken.pop(0)
        if (not taken or taken[0][0] >= e) and (not out or out[-1][2] <= s):
            out.append((s, k, e))
    return out


def pattern(text: str, span: Span) -> int:
    """Votes of the four labelers, kind, length and digit share of a span, as one number."""
    start, kind, end = span
    body, before = text[start:end], text[max(0, start - 30) : start].lower()
    digits = _NOT_DIGIT.sub("", body)
    share = len(digits) / (end - start)
    name = KINDS[kind]
    shape = 1
    if name == "secret":
        mixed = bool(digits) + any(c.islower() for c in body) + any(c.isupper() for c in body)
        hexa = len(body) in (32, 40, 64) and not body.strip("0123456789abcdef")
        shape = 1 if hexa or mixed == 3 else -1 if not digits else 0
    elif name == "number":
        shape = 1 if len(digits) in (15, 16) and len(body) in (len(digits), len(digits) + 3) else 0
    if name == "email":
        gazetteer = 1 if body.rsplit(".", 1)[1].lower() in DOMAINS else 0
    elif name in ("card", "number"):
        gazetteer = 1 if digits.startswith(ISSUERS) else -1
    elif name == "secret":
        gazetteer = 1 if any(k in before for k in KEY_NAMES) else 0
    elif name == "national_id":
        gazetteer = -1 if digits[:3] in ("000", "666") or digits[0] == "9" else 1
    elif name == "ip":
        gazetteer = -1 if digits.startswith("0") else 0
    else:
        gazetteer = -1 if digits[-10:-7] in ("000", "999") else 0
    cue = any(k in before for k in CUES[name]) or name == "secret" and before.rstrip(" \"'")[-1:] in ("=", ":")
    context = -1 if any(k in before for k in NO_CUES) else 1 if cue else 0
    if name == "secret":
        composition = 1 if 0.1 <= share <= 0.9 and len(set(body)) >= 8 else -1
    else:
        composition = 1 if name == "email" or len(set(digits)) >= 3 else -1
    code = kind
    for vote in (shape, gazetteer, context, composition):
        code = code * 3 + vote + 1
    return (code * 4 + min(3, (end - start) // 12)) * 3 + min(2, int(share * 3))


def decode(code: int) -> tuple[int, tuple[int, ...], int, int]:
    """Kind, votes, length class and digit class of a pattern."""
    code, share = divmod(code, 3)
    code, length = divmod(code, 4)
    votes = []
    for _ in range(4):
        code, v = divmod(code, 3)
        votes.append(v - 1)
    return code, tuple(reversed(votes)), length, share


def reliabilities(votes: np.ndarray, kind: np.ndarray, count: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns: (labeler x [right on yes, right on no]) and each pattern's posterior of yes."""
    right, prior = np.full((votes.shape[1], 2), 0.8), np.full(len(KINDS), 0.5)
    said = votes != 0
    for _ in range(rounds):
        yes = np.where(votes > 0, right[:, 0], 1 - right[:, 0])
        no = np.where(votes > 0, 1 - right[:, 1], right[:, 1])
        up = np.log(prior[kind]) + (np.log(yes) * said).sum(1)
        down = np.log(1 - prior[kind]) + (np.log(no) * said).sum(1)
        post = 1 / (1 + np.exp(np.clip(down - up, -50, 50)))
        w1, w0 = count * post, count * (1 - post)
        # Pseudo-counts of 8 right and 2 wrong: a labeler is better than chance until data say otherwise.
        new = np.stack([
            (8 + ((votes > 0) * w1[:, None]).sum(0)) / (10 + (said * w1[:, None]).sum(0)),
            (8 + ((votes < 0) * w0[:, None]).sum(0)) / (10 + (said * w0[:, None]).sum(0)),
        ], axis=1)
        prior = (1 + np.bincount(kind, w1, len(KINDS))) / (2 + np.bincount(kind, count, len(KINDS)))
        done = np.abs(new - right).max() < 1e-9
        right = new
        if done:
            break
    return right, post


def train(counts: Mapping[int, int], steps: int = 400) -> dict[int, float]:
    """Probability of personal data for each pattern, from how often each occurs in the corpus."""
    if not counts:
        return {}
    codes = sorted(counts)
    parts = [decode(c) for c in codes]
    kind = np.array([p[0] for p in parts])
    votes = np.array([p[1] for p in parts])
    n = np.array([counts[c] for c in codes], float)
    soft = reliabilities(votes, kind, n)[1]
    x = np.concatenate(
        [np.eye(3)[votes[:, j] + 1] for j in range(4)]
        + [np.eye(len(KINDS))[kind], np.eye(4)[[p[2] for p in parts]], np.eye(3)[[p[3] for p in parts]]], axis=1)
    weight, share = np.zeros(x.shape[1]), n / n.sum()
    for _ in range(steps):  # Newton steps on the ridge-penalised log loss
        p = 1 / (1 + np.exp(-x @ weight))
        grad = x.T @ (share * (p - soft)) + 1e-4 * weight
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(x.shape[1])
        step = np.linalg.solve(curve, grad)
        weight -= step
        if np.abs(step).max() < 1e-8:
            break
    return dict(zip(codes, (1 / (1 + np.exp(-x @ weight))).tolist()))


_SPANS = pa.list_(pa.struct([("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64()), ("p", pa.int32())]))


def _found(text: str) -> tuple[list[Span], list[Span]]:
    if not _ANY.search(text):
        return [], []
    base = base_spans(text)
    return base, proposals(text, base)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = []
        for text in batch.column(1).to_pylist():
            base, more = _found(text)
            rows.append([{"s": s, "k": k, "e": e, "p": pattern(text, (s, k, e))} for s, k, e in base + more])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _SPANS)], ["doc_id", "found"])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, found): base spans and proposals of every whole text with their patterns."""
    return documents(docs).mapInArrow(_scan, "doc_id long, found array<struct<s:long,k:int,e:long,p:int>>")


def accepted(found: DataFrame, least: float = 0.5) -> list[int]:
    """Patterns the classifier accepts; at most some thousand patterns exist."""
    counts = found.select(F.explode("found.p").alias("p")).groupBy("p").count().collect()
    return sorted(c for c, p in train({r["p"]: r["count"] for r in counts}).items() if p >= least)


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and digest are of the base spans; ``spans`` holds base and accepted spans as
    kind:start:end (code points, end exclusive) by start, then kind. A null or empty text has no
    span: zeros, the digest of the empty string and an empty string. Repeated rows repeat.
    """
    found = materialize(scan(docs), "spans")
    good = accepted(found)
    span = lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x.k + 1), x.s, x.e)
    joined = lambda spans: F.array_join(F.transform(F.array_sort(spans), span), ",")
    base = F.filter("found", lambda x: x.k < BASE)
    every = F.filter("found", lambda x: (x.k < BASE) | x.p.isin(good)) if good else base
    n = lambda k: F.size(F.filter("found", lambda x: x.k == k)).cast("long")
    return found.select(
        "doc_id", *[n(k).alias(f"n_{KINDS[k]}") for k in range(BASE)],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(every).alias("spans"),
    )


def redact(text: str, good: frozenset[int]) -> str:
    """The text with every base span and accepted proposal replaced by its kind in brackets."""
    base, more = _found(text)
    spans = sorted(base + [x for x in more if pattern(text, x) in good])
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]]) if spans else text


def _redactions(good: frozenset[int], text_at: int, chars_at: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            old = batch.column(text_at).to_pylist()
            new = [t if t is None else redact(t, good) for t in old]
            columns = list(batch.columns)
            columns[text_at] = pa.array(new, pa.string())
            if chars_at is not None:
                chars = batch.column(chars_at).to_pylist()
                columns[chars_at] = pa.array([n if a is b else len(b) for n, a, b in zip(chars, old, new)], pa.int64())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return run


def redact_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in every text and ``n_chars``, if there, following suit."""
    good = frozenset(accepted(materialize(scan(docs), "spans")))
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    if chars is not None:
        docs = docs.withColumn("n_chars", F.col("n_chars").cast("long"))
    return docs.mapInArrow(_redactions(good, docs.columns.index("text"), chars), docs.schema)
