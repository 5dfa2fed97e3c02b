import hashlib
import random
import re

import numpy as np

from seriesforge.llm import pii
from tests.llm.fixtures import TEXTS, documents, edge_documents, empty_documents, frame, rows

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(d):
    n = [int(c) for c in d[::-1]]
    return (sum(n[::2]) + sum(sum(divmod(2 * x, 10)) for x in n[1::2])) % 10 == 0


def plain(text):
    out = []
    for kind, p in enumerate(PATTERNS):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == 2 and not (14 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == 3 and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_rules_equal_the_plain_patterns():
    rng = random.Random(4)
    for alphabet in ("a1@.2 -+()9%5", "0123456789. -+", "ab@.-"):
        for _ in range(4000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40)))
            assert pii.base_spans(t) == plain(t), t


def test_long_texts_take_linear_time():
    for t in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 150_000, "x_" * 150_000):
        pii._found(t)


def check(got, texts):
    for (i, *n, digest, spans), t in zip(got, texts):
        base = plain(t)
        assert n == [sum(k == kind for _, k, _ in base) for kind in range(4)]
        listed = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert digest == hashlib.sha256(",".join(listed).encode()).hexdigest()
        every = spans.split(",") if spans else []
        assert set(listed) <= set(every)
        keys = [(int(x.split(":")[1]), pii.KINDS.index(x.split(":")[0])) for x in every]
        assert keys == sorted(keys)


def test_documents(spark):
    data = frame(spark, "/root/testdata/sf0.01").set_index("doc_id")
    got = rows(pii.find_pii(documents(spark, "/root/testdata/sf0.01")))
    assert len(got) == len(data)
    check(got, [data.text[r[0]] for r in got])
    # Planted secrets are found though no rule names them.
    secrets = {i for i, t in data.text.items() if t and re.search('token = "[0-9a-f]{40}"', t)}
    assert secrets and secrets == {r[0] for r in got if "secret:" in r[-1]}


def test_edges_and_empty_table(spark):
    got = rows(pii.find_pii(edge_documents(spark)))
    assert len(got) == len(TEXTS) and all(r[1:5] == (0, 0, 0, 0) and r[-1] == "" for r in got)
    assert rows(pii.find_pii(empty_documents(spark))) == []


def test_em_finds_which_labelers_to_trust():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    right = (0.95, 0.9, 0.85, 0.55)
    votes = np.stack([np.where(rng.random(4000) < r, truth, ~truth) * 2 - 1 for r in right], axis=1)
    votes[rng.random(votes.shape) < 0.2] = 0
    found, post = pii.reliabilities(votes, np.zeros(4000, int), np.ones(4000))
    # Nearly as good as knowing the reliabilities.
    weight = np.log(np.array(right) / (1 - np.array(right)))
    best = (votes @ weight + np.log(0.4 / 0.6) > 0) == truth
    assert ((post > 0.5) == truth).mean() > best.mean() - 0.01
    assert np.abs(found.mean(1) - right).max() < 0.05


def test_patterns_decode():
    for text, span in (("call +1 (523) 555-1055 now", (5, 3, 22)), ('key = "' + "ab12" * 10 + '"', (7, 4, 47))):
        kind, votes, length, share = pii.decode(pii.pattern(text, span))
        assert kind == span[1] and len(votes) == 4 and set(votes) <= {-1, 0, 1}


def test_redaction_replaces_exactly_the_spans_found(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    left = pii.redact_pii(docs)
    assert left.columns == docs.columns
    spans = {r[0]: r[-1] for r in rows(pii.find_pii(docs))}
    both = left.join(docs.selectExpr("doc_id", "text as old", "n_chars as old_n"), "doc_id").collect()
    assert len(both) == docs.count()
    for r in both:
        out, at = "", 0
        for kind, s, e in (x.split(":") for x in spans[r.doc_id].split(",") if x):
            if int(s) >= at:
                out += r.old[at : int(s)] + f"[{kind.upper()}]"
            at = max(at, int(e))
        assert r.text == out + r.old[at:] and not plain(r.text)
        assert r.n_chars == (len(r.text) if spans[r.doc_id] else r.old_n)
