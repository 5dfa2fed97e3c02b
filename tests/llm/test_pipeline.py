import __spark_entry__ as entry
import corpus_pipeline
from seriesforge.llm import catalog, exact_dedup, langid, packing, pii, simhash
from tests.llm.fixtures import TEXTS, documents, edge_documents, empty_documents, rows
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"


def test_queries_are_registered():
    names = entry.queries()
    assert [n for n in names if n.startswith("op")] == list(catalog.QUERIES) and "pipeline" in names
    assert {n.split("_")[0] for n in catalog.QUERIES} == {f"op{k}" for k in range(1, 11)}
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


def test_exact_dedup_matches_sql(spark):
    assert compare(catalog.op4_exact_dedup(spark, SF), connect(SF), catalog.ORACLES["op4_exact_dedup"]) is None


def brute_force(docs):
    """The stages by their operators' row-wise parts and plain Python groups."""
    model = langid.fit_on(docs)
    left = [(r.doc_id, r.text) for r in docs.collect()]
    langs, scores = langid.predict(model, [t for _, t in left])
    left = [x for x, lang, s in zip(left, langs, scores) if lang != "und" and s >= model.reject_below]
    first = {}
    for i, t in sorted(left):
        first.setdefault(" ".join(t.replace("\n", " ").replace("\t", " ").split(" ")), (i, t))
    left = sorted(first.values())
    prints = [simhash.fingerprint(t) % 2**64 for _, t in left]
    component = list(range(len(left)))
    for a in range(len(left)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                low, high = sorted((component[a], component[b]))
                component = [low if c == high else c for c in component]
    left = [x for k, x in enumerate(left) if component[k] == k]
    counts = {}
    for _, t in left:
        base, more = pii._found(t)
        for span in base + more:
            code = pii.pattern(t, span)
            counts[code] = counts.get(code, 0) + 1
    accepted = frozenset(c for c, p in pii.train(counts).items() if p >= 0.5)
    words = packing.WordIds(packing.default_tokenizer())
    out = []
    for i, t in left:
        ids = words.ids(pii.redact(t, accepted)) + packing.pack_ids([1])
        out += [(i, k, at // 4, min(4096, (len(ids) - at) // 4)) for k, at in enumerate(range(0, len(ids), 4 * 4096))]
    return sorted(out)


def test_pipeline_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, sf)
    assert sorted((r.doc_id, r.piece, r.start, r.length) for r in got.collect()) == brute_force(documents(spark, sf))


def test_each_stage_takes_its_predecessors_columns_and_awkward_rows(spark):
    docs = edge_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF)
        assert left.columns == docs.columns, name
        assert left.count() <= len(TEXTS)
        assert rows(stage(spark, empty_documents(spark), SF)) == []
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, SF).select("doc_id").distinct().count() == len({i for i, _ in TEXTS})
    assert exact_dedup.drop_copies(docs).count() <= docs.count()
