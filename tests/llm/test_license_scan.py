import random
import re
from itertools import combinations

from seriesforge.llm import license_scan as ls
from tests.llm.fixtures import TEXTS, documents, edge_documents, empty_documents, frame, rows

READY = ls.prepare(ls.TEMPLATES)


def test_patience_anchors_are_the_longest_increasing_run():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(0, 9)
        pairs = list(enumerate(rng.sample(range(20), n)))
        got = ls._increasing(pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:]))
        longest = max((len(c) for k in range(n + 1) for c in combinations(pairs, k) if all(a[1] < b[1] for a, b in zip(c, c[1:]))), default=0)
        assert len(got) == longest


def test_alignments_are_true_and_complete_for_an_unbroken_copy():
    rng = random.Random(2)
    for _ in range(500):
        words = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 14))]
        template = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))]
        pairs = ls.align(words, template)
        assert all(words[i] == template[j] for i, j in pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
        assert [j for _, j in ls.align(template, template)] == list(range(len(template)))
        tight = ls.tighten(pairs, words)
        assert [words[i] for i, _ in tight] == [words[i] for i, _ in pairs]


def test_changed_repeated_and_broken_notices():
    mit = ls.TEMPLATES["MIT"]
    found = ls.scan_text(f"x {mit} {mit} released nothing", READY)
    assert [(m[2], m[0]) for m in found] == [("MIT", 2), ("MIT", 3 + len(mit))]
    grant = ls.TEMPLATES["MIT-grant"]
    (m,) = ls.scan_text("intro " + grant.replace("hereby ", "").replace(" merge,", " fuse,").upper(), READY)
    assert m[2] == "MIT-grant" and m[3] == m[4] - 2
    assert ls.scan_text("Permission is granted to any person.", READY) == []


def test_documents_against_the_literal_notices(spark):
    data = frame(spark, "/root/testdata/sf0.01")
    got = {r[0]: r for r in rows(ls.license_scan(documents(spark, "/root/testdata/sf0.01")))}
    assert len(got) == len(data)
    for i, t in zip(data.doc_id, data.text):
        plain = sorted((m.start(), n) for n, p in list(ls.TEMPLATES.items())[:5] for m in re.finditer(re.escape(p.rstrip(".")), t or ""))
        assert [(m.start, m.license) for m in got[i][4]] == plain
        assert got[i][1] == len(plain) and got[i][3] == (1.0 if plain else 0.0)


def test_edges_and_empty_table(spark):
    got = rows(ls.license_scan(edge_documents(spark)))
    assert len(got) == len(TEXTS) and all(r[1:] == (0, "", 0.0, []) for r in got)
    assert rows(ls.license_scan(empty_documents(spark))) == []
    long = "license " * 20_000 + ls.TEMPLATES["GPL-3.0"]
    assert [m[2] for m in ls.scan_text(long, READY)] == ["GPL-3.0"]


def test_each_of_many_adjacent_copies():
    for name in ls.TEMPLATES:
        for k in (3, 7):
            text = " ".join([ls.TEMPLATES[name]] * k)
            assert [(m[2], m[3]) for m in ls.scan_text(text, READY)] == [(name, len(ls.words_of(ls.TEMPLATES[name])))] * k


def test_a_long_insertion_does_not_hide_a_notice():
    grant = ls.TEMPLATES["MIT-grant"]
    half = grant.index("to deal")
    for n in (5, 20, 40, 90):
        text = "before it " + grant[:half] + "".join(f"foreign{k} " for k in range(n)) + grant[half:] + " after it"
        assert [(m[2], m[3], m[4], m[0]) for m in ls.scan_text(text, READY)] == [("MIT-grant", *[len(ls.words_of(grant))] * 2, 10)]


def test_coverage_is_of_the_whole_notice_and_neighbours_have_their_names():
    for name, text in ls.TEMPLATES.items():
        (m,) = ls.scan_text(f"before it {text} after it", READY)
        assert m[2] == name and m[3] == m[4] == len(ls.words_of(text))
    for name in ("MIT-grant", "BSD-3-Clause", "GPL-header"):
        first = ls.TEMPLATES[name][:150]
        assert all(m[2] != name for m in ls.scan_text(first, READY))
    for name in ("MPL-2.0-header", "ISC", "ISC-grant", "Unlicense-text", "CC0-1.0-notice", "GPL-2.0", "CC-BY-SA-4.0"):
        assert name in ls.TEMPLATES
