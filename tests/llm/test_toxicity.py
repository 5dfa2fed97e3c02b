import itertools
import re
import zlib

import numpy as np

from seriesforge.llm import toxicity
from tests.llm.fixtures import TEXTS, documents, edge_documents, empty_documents, frame, rows

SF = "/root/testdata/sf0.01"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    for _ in range(40):
        n = int(rng.integers(1, 10))
        e, starts, tr = rng.normal(size=n) * 2, rng.random(n) < 0.3, rng.normal(size=(2, 2))
        starts[0] = True
        single, pair, z = np.zeros(n), np.zeros((n, 2, 2)), 0.0
        for s in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(e[t] * s[t] + tr[0 if starts[t] else s[t - 1], s[t]] for t in range(n)))
            z += w
            for t in range(n):
                single[t] += w * s[t]
                if not starts[t]:
                    pair[t, s[t - 1], s[t]] += w
        got, pairs = toxicity.forward_backward(e, starts, tr)
        assert np.allclose(got, single / z) and np.allclose(pairs, pair / z)


def test_long_chains_are_stable():
    e = np.random.default_rng(1).normal(size=200_000) * 8
    p, _ = toxicity.forward_backward(e, np.arange(len(e)) == 0, np.array([[2.0, -2.0], [-2.0, 2.0]]))
    assert np.isfinite(p).all() and p.min() >= 0 and p.max() <= 1


def test_held_out_documents(spark):
    docs, labels = documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit_on(docs, labels)
    found = toxicity.score_documents(docs, model).join(labels.select("doc_id", "toxic"), "doc_id").toPandas()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]).all()
    assert found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.5)).all()
    # The few hundred labels here teach the commonest words; TOXIC_SF tests learn from more.
    held = found[found.held_out]
    clean, toxic = held[held.toxic == 0].score.to_numpy(), held[held.toxic == 1].score.to_numpy()
    auc = (toxic[:, None] > clean).mean() + (toxic[:, None] == clean).mean() / 2
    assert auc > 0.8 and (clean >= 0.5).mean() < 0.03


def test_more_labels_teach_almost_all(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit_on(docs, labels)
    held = toxicity.score_documents(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), model)
    held = held.where("held_out").join(labels.select("doc_id", "toxic"), "doc_id").toPandas()
    assert held[held.toxic == 1].predicted.mean() > 0.8 and held[held.toxic == 0].predicted.mean() < 0.01
    texts = frame(spark, sf).set_index("doc_id").text
    for i, spans in held[held.predicted == 1][["doc_id", "spans"]].itertuples(index=False):
        for span in spans.split(",") if spans else []:
            s, e = map(int, span.split(":"))
            assert re.fullmatch(r"[^\W\d_]+", texts[i][s:e])


def test_edges_and_nothing_to_learn(spark):
    labels = spark.createDataFrame([(0, 1, None), (4, 0, 0), (None, 1, 1), (6, 0, 1), (6, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit_on(edge_documents(spark), labels)
    found = rows(toxicity.score_documents(edge_documents(spark), model))
    assert len(found) == len(TEXTS) and all(0 <= r[2] <= 1 for r in found)
    none = toxicity.fit_on(empty_documents(spark), labels.limit(0))
    assert {r[2:4] for r in rows(toxicity.score_documents(edge_documents(spark), none))} == {(0.0, 0)}
    assert rows(toxicity.score_documents(empty_documents(spark), none)) == []


def test_copies_of_a_toxic_document_teach_once():
    rng = np.random.default_rng(0)

    def words(n):
        return ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n)]

    clean = [(k, " ".join(words(30)), 0) for k in range(200)]
    toxic = [(1000 + k, " ".join([*words(12), "clown", *words(12), "clown"]), 1) for k in range(60)]
    copies = [(2000 + k, "ordinary words about gardens and rivers", 1) for k in range(500)]
    scores, spans = toxicity.score(toxicity.fit(clean + toxic + copies), ["a house with a clown inside", "gardens and rivers of the house", ""])
    assert scores[0] > 0.5 > scores[1] and spans == ["15:20", "", ""]


def lettered(toxic, clean, n=200, seed=0):
    """Texts of random words that begin alike by label; toxic ones hold a word of their own twice."""
    rng = np.random.default_rng(seed)

    def words(m):
        return ["".join(rng.choice(list("bcdefgh"), 5)) for _ in range(m)]

    rows = [(k, " ".join([clean, *words(30)]), 0) for k in range(n)]
    return rows + [(n + k, " ".join([toxic, *words(12), "clown", *words(12), "clown"]), 1) for k in range(n // 2)]


def test_offsets_after_letters_that_grow_in_lower_case():
    model = toxicity.fit(lettered("begin", "begin"))
    text = "\u0130stanbul \u0130zmir house with a clown"
    _, (spans,) = toxicity.score(model, [text])
    assert [text[slice(*map(int, x.split(":")))] for x in spans.split(",")] == ["clown"]


def test_the_field_is_fitted_to_a_random_part(monkeypatch):
    seen = []
    fit = toxicity.fit_field
    monkeypatch.setattr(toxicity, "fit_field", lambda c, s, tags, n: (seen.append(int(tags.sum())), fit(c, s, tags, n))[1])
    toxicity.fit(lettered("zz", "aa"), toxicity.ToxicConfig(field_tokens=1000))
    assert seen[0] > 0  # toxic texts come last in the alphabet
