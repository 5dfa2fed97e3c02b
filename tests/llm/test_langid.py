import zlib

from seriesforge.llm import langid
from tests.llm.fixtures import TEXTS, documents, edge_documents, empty_documents, rows


def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    model = langid.fit_on(docs)
    found = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]).all()
    held = found[found.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.99
    assert held.score.between(0, 1).all()
    # Clean documents stay.
    assert (~held.rejected).mean() > 0.99


def test_a_prediction_takes_the_text_alone(spark):
    docs = documents(spark)
    model = langid.fit_on(docs)
    got = rows(langid.identify(docs, model).select("doc_id", "lang_pred", "score"))
    changed = docs.selectExpr("doc_id", "text", "'xx' as lang", "cast(null as string) as source")
    assert rows(langid.identify(changed, model).select("doc_id", "lang_pred", "score")) == got


def test_edges(spark):
    model = langid.fit_on(documents(spark))
    found = rows(langid.identify(edge_documents(spark), model))
    assert len(found) == len(TEXTS)
    for i, held, lang, score, rejected in found:
        texts = [t for j, t in TEXTS if j == i]
        if all(not t or not any(c.isalpha() for c in t) for t in texts):
            assert (lang, score, rejected) == ("und", 0.0, True)
        elif len(texts) == 1:
            assert lang in model.langs and 0 < score <= 1
        assert held == (zlib.crc32(b"" if i is None else str(i).encode()) % 4 == 2)


def test_nothing_to_learn(spark):
    model = langid.fit_on(empty_documents(spark))
    assert rows(langid.identify(empty_documents(spark), model)) == []
    assert {r[2] for r in rows(langid.identify(edge_documents(spark), model))} == {"und"}


def test_subwords_are_those_of_each_text_alone():
    texts = [b"Hello, World", b"x", b"12 34", "été".encode()]
    together, owner = langid.subwords(texts, 16)
    for k, t in enumerate(texts):
        assert sorted(together[owner == k]) == sorted(langid.subwords([t], 16)[0])


def test_calibrated_rejection():
    data = [(f"{w} {w}x {w}y" * 3, lang) for lang, ws in (("aa", "kapo tami nuro".split()), ("bb", "schrift wurst dorf".split())) for w in ws for _ in range(30)]
    model = langid.fit([t for t, _ in data], [y for _, y in data])
    langs, scores = langid.predict(model, ["kapo tami", "wurst dorf", None, "!!"])
    assert langs == ["aa", "bb", "und", "und"] and scores[2:] == [0.0, 0.0]
    assert 0 < model.reject_below <= 1.25 / 2


def test_rejected_documents_go(spark):
    docs = edge_documents(spark)
    model = langid.fit_on(documents(spark))
    left = langid.drop_rejected(docs, model)
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    assert left.count() == langid.identify(docs, model).where("not rejected").count()


