"""Patience alignment against a longest common subsequence, and planted notices."""

from __future__ import annotations

import random
from pathlib import Path

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferry.llm import licenses as lic


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdef"), max_size=20), st.lists(st.sampled_from("abcdef"), max_size=20))
def test_alignment_is_a_common_subsequence(a, b):
    pairs = lic.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert len(pairs) <= lcs(a, b)


@settings(max_examples=100, deadline=None)
@given(st.permutations(range(9)))
def test_increasing_is_longest(order):
    best = lic._increasing(list(enumerate(order)))
    assert len(best) == lcs(range(9), order)


def test_full_match_when_words_are_unique():
    a = [f"w{i}" for i in range(30)]
    b = ["x", *a[:10], "y", *a[12:], "z"]
    assert len(lic.align(a, b)) == 28


def test_planted_notices_in_long_texts():
    rng = random.Random(2)
    scan = lic.Scanner(lic.TEMPLATES, lic.MIN_COVERAGE, lic.MIN_PAIRS).scan
    filler = [f"the of license version {k}" for k in range(200)]
    for name, some in lic.TEMPLATES.items():
        for k, template in enumerate(some):
            for trial in range(6):
                w = template.split()
                if trial >= 3:  # a word in eight changed, added or left out
                    w = [x for x in w for x in ([x] if rng.random() > 0.125 else rng.choice([["zzz"], [], [x, "yyy"]]))]
                if len(w) < 10 and trial >= 3:
                    continue
                before, after = rng.choices(filler, k=20), rng.choices(filler, k=20)
                text = " ".join([*before, "\n// " + " ".join(w).upper() + "\n", *after])
                hits = scan(text)
                assert [(h.license, h.template) for h in hits] == [(name, k)], (name, k, trial, hits)
                first = sum(len(lic.words(x)) for x in before)
                assert abs(hits[0].start - first) <= 3 and hits[0].coverage >= lic.MIN_COVERAGE


def test_two_notices_and_none():
    scan = lic.Scanner(lic.TEMPLATES, lic.MIN_COVERAGE, lic.MIN_PAIRS).scan
    mit, cc = lic.TEMPLATES["MIT"][0], lic.TEMPLATES["CC-BY-NC-4.0"][0]
    assert [h.license for h in scan(f"{mit} some words between {cc} and {mit}")] == ["MIT", "CC-BY-NC-4.0", "MIT"]
    assert scan("the license of this version under the general public") == [] and scan("") == [] and scan(None) == []


def test_adjacent_copies_are_all_found():
    """2 to 5 copies next to each other, inside prose and at its end, whole and with a word changed."""
    scan = lic.Scanner(lic.TEMPLATES, lic.MIN_COVERAGE, lic.MIN_PAIRS).scan
    prose = [f"word{k}" for k in range(12)]
    for name, some in lic.TEMPLATES.items():
        for k, template in enumerate(some):
            w = template.split()
            size = len(lic.words(template))
            spoilt = [*w[: len(w) // 3], "zzz", *w[len(w) // 3 + 1 :]] if size > 20 else w
            for copies in range(2, 6):
                for one in (w, spoilt):
                    for before, gap, after in ((4, 0, 8), (0, 0, 0), (5, 1, 0), (0, 2, 9)):
                        text = " ".join(prose[:before] + (one + prose[:gap]) * copies + prose[:after])
                        hits = scan(text)
                        assert [(h.license, h.template) for h in hits] == [(name, k)] * copies, (text, hits)
                        step = size + gap
                        assert [h.start for h in hits] == [before + c * step for c in range(copies)]
                        assert [h.end for h in hits] == [before + c * step + size - 1 for c in range(copies)]


def test_near_misses_are_not_the_license():
    gpl = lic.TEMPLATES["GPL-3.0"][1]
    cc = "This work is licensed under a Creative Commons {} 4.0 International License."
    scan = lic.Scanner(lic.all_templates(), lic.MIN_COVERAGE, lic.MIN_PAIRS).scan
    for text, want in (
        ("Released under the BSD License.", []),
        ("Released under the GPL License.", []),
        ("Licensed under CC BY 3.0.", []),
        ("Licensed under CC BY ND 4.0.", []),
        ("Licensed under CC BY-ND 4.0.", ["CC-BY-ND-4.0"]),
        ("Licensed under CC BY-NC-ND 4.0.", ["CC-BY-NC-ND-4.0"]),
        ("Licensed under the Apache License, Version 1.1.", ["Apache-1.1"]),
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]),
        ("This work is licensed under the GNU General Public License, version 1.", []),
        ("This work is licensed under the GNU General Public License.", ["GPL-2.0|GPL-3.0"]),
        (gpl.replace("version 3", "version 1"), []),
        (cc.format("Attribution"), ["CC-BY-4.0"]),
        (cc.format("Attribution-NonCommercial"), ["CC-BY-NC-4.0"]),
        (cc.format("Attribution Share Alike"), []),
        (cc.format("Attribution").replace("4.0", "3.0"), []),
        (gpl, ["GPL-3.0"]),
        (gpl.replace("version 3", "version 2"), ["GPL-2.0"]),
        (gpl.replace("GNU General", "GNU Lesser General"), ["LGPL-3.0"]),
        (gpl.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1"), ["LGPL-2.1"]),
        (gpl.replace("GNU General", "GNU Affero General"), ["AGPL-3.0"]),
    ):
        assert [h.license for h in scan(f"some words before {text} and after it")] == want, text


def test_whole_texts_are_told_apart():
    folder = Path(lic.__file__).parent / "license_texts"
    texts = {p.stem: p.read_text(encoding="utf-8") for p in folder.glob("*.txt")}
    assert all(len(lic.words(t)) >= lic.WHOLE for t in texts.values())
    scan = lic.Scanner(lic.all_templates(), lic.MIN_COVERAGE, lic.MIN_PAIRS).scan
    assert len(texts) == 13
    for name, text in texts.items():
        for copies in (1, 2):
            hits = scan("some words before " + f"{text} " * copies + "and after it")
            assert [h.license for h in hits] == [name] * copies, (name, [h.license for h in hits])
            assert all(h.coverage == 1.0 for h in hits)
    agpl = texts["GPL-3.0"].replace("GNU GENERAL PUBLIC LICENSE\n", "GNU AFFERO GENERAL PUBLIC LICENSE\n")
    agpl = agpl.replace("13. Use with the GNU Affero", "13. Remote Network Interaction; Use with the GNU")
    assert agpl.count("Remote Network Interaction") == 1
    assert not any(h.license == "GPL-3.0" and h.matched > 1000 for h in scan(agpl))


def test_a_tie_names_both():
    two = {"X-1": ("one two three four five six",), "X-2": ("one two three four five seven",)}
    scan = lic.Scanner(two, lic.MIN_COVERAGE, lic.MIN_PAIRS).scan
    assert [h.license for h in scan("a one two three four five b")] == ["X-1|X-2"]
    assert [h.license for h in scan("a one two three four five seven b")] == ["X-2"]


def test_query_against_brute_force(spark):
    """Every template against every window of its length, at sf0.01."""
    sf = "/root/testdata/sf0.01"
    want = set()
    templates = [(n, lic.words(t)) for n, some in lic.TEMPLATES.items() for t in some]
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        w = lic.words(r.text)
        for at in range(len(w)):
            if w[at] in ("licensed", "released", "this", "permission", "redistribution"):
                for name, t in templates:
                    if len(lic.align(t, w[at : at + len(t)])) == len(t):
                        want.add((r.doc_id, name))
    got = lic.op6_license_scan(spark, sf).collect()
    assert {(r.doc_id, r.license) for r in got if r.coverage == 1.0} == want and len(want) > 10


def test_cases(spark, make_docs):
    mit = lic.TEMPLATES["MIT"][0]
    rows = [(1, mit), (1, mit), (2, None), (3, ""), (None, f"x {mit}"), (4, "the license " * 40_000 + mit)]
    docs = make_docs(rows).withColumn("license", F.lit("mine"))
    out = lic.license_hits(docs).collect()
    assert sorted(((r.doc_id, r.license, r.whole_text) for r in out), key=str) == sorted(
        [(1, "MIT", True), (1, "MIT", True), (None, "MIT", False), (4, "MIT", False)], key=str
    )
    assert lic.license_hits(make_docs([]).limit(0)).collect() == []
