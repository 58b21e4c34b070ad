"""Source divergence, SimHash near-duplicates and the filter interaction audit against their definitions."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from llm_rows import AWKWARD, texts
from oracle_check import compare, duck
from quoteline.llm import filter_audit, simhash_dedup, source_divergence
from quoteline.llm.common import table

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_source_divergence", "op13_filter_audit"])
def test_query_matches_oracle(sp, name):
    assert compare(sp, duck(SMALL), name, E.queries()[name], E.oracle_sql()[name], SMALL)


# --- source divergence -------------------------------------------------------------------------

WORDS = "the The of über naïve a1b x_y Zeit _ 42 日本 end's".split()


def _sources(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "ß", "", None])
        text = rng.choice([None, "", " ".join(rng.choices(WORDS, k=rng.randrange(1, 30)))]) if i % 5 == 0 else (
            " ".join(rng.choices(WORDS, weights=range(1, len(WORDS) + 1), k=rng.randrange(1, 30))))
        rows.append((text, lang, source))
    return rows + [("nothing kept here", "fr", "s1"), ("1 2 3", "fr", "s2"), (None, "es", "alone")]


def _divergence(sp, rows, **more):
    df = sp.createDataFrame(rows, "text string, lang string, source string")
    return {tuple(r) for r in source_divergence.audit(df, **more).collect()}


@pytest.mark.parametrize("sizes", [{}, {"block": 1, "slice_terms": 3}, {"block": 2, "slice_terms": 5}])
def test_divergence_is_its_definition(sp, sizes):
    rows = _sources(150)
    want = source_divergence.brute_force(rows)
    assert _divergence(sp, rows, **sizes) == want
    assert ("fr", "s1", "pair", "s2", 0, 1) in want and not any(r[0] == "es" for r in want)
    assert {r[2] for r in want} == {"pair", "term"}


def test_divergence_counts_are_handed_on_in_parts(monkeypatch):
    rows = [(lang or "", source or "", (text or "").encode()) for text, lang, source in _sources(120, seed=2)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["lang", "source", "text"])

    def counted():
        sums, parts = Counter(), 0
        for out in source_divergence._count(iter([batch])):
            parts += 1
            for r in out.to_pylist():
                sums[r["lang"], r["source"], r["term"], "n"] += r["n"]
                sums[r["lang"], r["source"], r["term"], "d"] += r["d"]
        return sums, parts

    whole, few = counted()
    monkeypatch.setattr(source_divergence, "HELD_TERMS", 20)
    split, many = counted()
    monkeypatch.setattr(source_divergence, "HELD_BYTES", 1)
    assert whole == split == counted()[0] and few < many < counted()[1]


def test_divergence_of_awkward_and_no_rows(sp, awkward, nothing):
    rows = [(t, "en", "s") for _, t in AWKWARD]
    got = {tuple(r) for r in source_divergence.audit(awkward, min_docs=1).collect()}
    assert got == source_divergence.brute_force(rows, 1)
    found = source_divergence.audit(nothing)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"] and found.count() == 0


def test_terms_are_the_pattern(sp):
    assert source_divergence.terms_of("Aé-B_c\x00d 1e[f]ZÉ".encode()) == ["aé".encode(), b"b", b"c", b"d", b"e", b"f", "zÉ".encode()]


# --- SimHash -----------------------------------------------------------------------------------


def _simhash(df, **more):
    return sorted(map(tuple, simhash_dedup.near_duplicates(df, **more).collect()), key=str)


def _near_texts(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for d in range(60):
        base = rng.choices(words, k=rng.choice([1, 2, 3, 40, 200]))
        rows.append((d, " ".join(base)))
        for c in range(rng.randrange(4)):
            copy = list(base)
            for _ in range(c):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((1000 + 10 * d + c, " \t".join(copy).upper() if c == 1 else "\n".join(copy)))
    return rows


@pytest.mark.parametrize("more", [{}, {"dense": 2}, {"split": 1}, {"dense": 1, "split": 3, "groups": 3}])
def test_simhash_is_its_definition(sp, more):
    rows = _near_texts() + AWKWARD
    got = _simhash(texts(sp, rows), **more)
    assert got == sorted(simhash_dedup.brute_force(rows), key=str)
    assert len({c for _, _, c in got}) < len({f for _, f, _ in got})  # some links join different fingerprints


def test_simhash_of_awkward_and_no_rows(sp, awkward, nothing):
    assert _simhash(awkward) == sorted(simhash_dedup.brute_force(AWKWARD), key=str)
    found = simhash_dedup.near_duplicates(nothing)
    assert found.columns == ["doc_id", "fingerprint", "component_id"] and found.count() == 0


def test_simhash_component_without_an_id(sp):
    got = _simhash(texts(sp, [(None, "one two three four"), (None, "one two three four"), (7, "quite another text here")]))
    assert [c for d, _, c in got if d is None] == [None, None] and (7 in [c for _, _, c in got])


def test_embedding_bounds_the_distance_and_grids_meet():
    rng = np.random.default_rng(5)
    fp = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    bits = rng.integers(0, 64, (2, 500)).astype(np.uint64)
    other = fp ^ (np.uint64(1) << bits[0]) ^ (np.uint64(1) << bits[1])
    counts = lambda x: np.stack([np.bitwise_count(x >> np.uint64(2 * i) & np.uint64(3)) for i in range(32)]).astype(int)
    a, b = simhash_dedup.embed(fp), simhash_dedup.embed(other)
    assert (np.bitwise_count(a ^ b) == np.abs(counts(fp) - counts(other)).sum(0)).all()
    assert (np.bitwise_count(a ^ b) <= np.bitwise_count(fp ^ other)).all()
    masks = np.array(simhash_dedup.grids(), np.int64).view(np.uint64)
    assert len(masks) == 15 and ((a[:, None] & masks) == (b[:, None] & masks)).any(1).all()


def test_links_of_a_large_cell_are_those_of_a_small_one():
    rng = np.random.default_rng(6)
    centre = rng.integers(0, 1 << 63, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (5, 400)).astype(np.uint64))
    fp = np.unique(centre ^ np.bitwise_or.reduce(flips, axis=0))
    cell = np.zeros(len(fp), np.int64)
    small = simhash_dedup.links(cell, fp)
    large = simhash_dedup.links(cell, fp, dense=1)
    assert len(small[0]) and all((x == y).all() for x, y in zip(small, large))


def test_components_of_a_long_chain(sp):
    rng = random.Random(8)
    order = list(range(200))
    rng.shuffle(order)
    chain = sp.createDataFrame(list(zip(order, order[1:])) + [(500, 501), (600, 600)], "u long, v long")
    got = {(r["u"], r["v"]) for r in simhash_dedup.components(chain).collect()}
    assert got == {(i, 0) for i in range(1, 200)} | {(501, 500)}


def test_simhash_query_covers_its_table(sp):
    rows = [tuple(r) for r in table(sp, SMALL, "documents").select("doc_id", "text").collect()]
    got = E.queries()["op12_simhash_dedup"](sp, SMALL)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(simhash_dedup.brute_force(rows), key=str)


# --- filter audit ------------------------------------------------------------------------------


def _audit(sp, rows, labels):
    docs = sp.createDataFrame(rows, "doc_id long, text string, source string")
    marks = sp.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {tuple(r) for r in filter_audit.audit(docs, marks).collect()}


def test_filter_audit_is_its_definition(sp):
    rng = random.Random(9)
    rows, labels = [], []
    for d in range(150):
        words = [rng.choice(["word", "Word", f"w{rng.randrange(90)}", "A", "50%"]) for _ in range(rng.choice([0, 10, 49, 50, 51, 80]))]
        if rng.random() < 0.5:
            words = [f"u{i}" for i in range(rng.choice([49, 50, 60]))]
        text = rng.choice([None, " ".join(words), "\t".join(words) + rng.choice(["", "#", " \x0b"])])
        rows.append((rng.choice([d, d, d // 2, None]), text, rng.choice(["a", "b", "", None])))
        if d % 3:
            labels.append((d, rng.choice([0, 1, None]), rng.choice([0, 1, None])))
    labels += [(0, 1, 1), (0, 0, 0), (None, 1, 1), (9999, 1, 0)]
    got = _audit(sp, rows, labels)
    assert got == filter_audit.brute_force(rows, labels)
    assert len(got) == 3 * 600


def test_filter_audit_of_awkward_and_no_rows(sp, awkward, nothing):
    labels = sp.createDataFrame([(5, 1, 0, "x"), (7, 0, 1, "y")], "doc_id long, quality int, toxic int, text string")
    got = {tuple(r) for r in filter_audit.audit(awkward, labels).collect()}
    assert got == filter_audit.brute_force([(d, t, "s") for d, t in AWKWARD], [(5, 1, 0), (7, 0, 1)])
    assert filter_audit.audit(nothing, labels).count() == 0
    none = {tuple(r) for r in filter_audit.audit(awkward, labels.limit(0)).collect()}
    assert len(none) == 600 and all(r[7:9] == (0, 0) for r in none)


def test_survivors_of_every_set():
    rng = np.random.default_rng(10)
    masks = np.arange(32)
    amounts = rng.integers(0, 50, (32, 3))
    got = filter_audit.survivors(masks, amounts)
    assert all((got[s] == amounts[masks & s == 0].sum(0)).all() for s in range(32))
    assert sorted(filter_audit.GRAY_CODE) == list(range(32))
