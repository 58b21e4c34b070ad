import random

import numpy as np
import pytest

from quoteline.llm import line_dedup, near_dedup, substring_dedup
from quoteline.llm.common import table

from llm_rows import AWKWARD, texts

SMALL = "/root/testdata/sf0.001"


def _by_text(rows):
    return sorted((tuple(r) for r in rows), key=str)


def _passages(seed=3, n=150):
    rnd = random.Random(seed)
    voc = ["a", "b", "the", "of"] + [f"w{i}" for i in range(200)]
    shared = [" ".join(rnd.choices(voc, k=rnd.randint(18, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            q = rnd.random()
            parts.append(rnd.choice(shared) if q < 0.4 else " ".join([rnd.choice(voc)] * rnd.randint(1, 70)) if q < 0.5
                         else " ".join([rnd.choice(voc), rnd.choice(voc)] * rnd.randint(1, 40)) if q < 0.6
                         else " ".join(rnd.choices(voc, k=rnd.randint(1, 60))))
        rows.append((rnd.choice([i, i, i, 5, None]), rnd.choice([" ", "\n", "\t "]).join(parts)))
    return rows + [(1000, None), (1001, ""), (1002, rows[0][1]), (1003, rows[1][1])]


@pytest.mark.parametrize("chunk_bytes", [10**9, 3000])
def test_substrings_against_brute_force(sp, chunk_bytes):
    rows = _passages()
    got = substring_dedup.remove_repeats(texts(sp, rows), chunk_bytes=chunk_bytes).collect()
    want = substring_dedup.brute_force(rows)
    assert _by_text(got) == _by_text(want)
    assert sum(r[2] for r in want) > 1000


def test_substrings_of_the_documents(sp):
    docs = table(sp, SMALL, "documents")
    got = substring_dedup.remove_repeats(docs, chunk_bytes=50_000).collect()
    assert _by_text(got) == _by_text(substring_dedup.brute_force([tuple(r) for r in docs.select("doc_id", "text").collect()]))


def test_parse_names_equal_interiors_equally():
    """Whatever surrounds a passage, the symbols that depend on its words only are the same."""
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, 40).astype(np.uint64)
    passage = words[rng.integers(0, 40, 60)]
    found = []
    for _ in range(5):
        a, b = words[rng.integers(0, 40, rng.integers(0, 30))], words[rng.integers(0, 40, rng.integers(0, 30))]
        text = np.concatenate((a, passage, b))
        name, lo, hi = substring_dedup.parse(text, np.zeros(len(text), np.int64), 4)
        inside = (lo >= len(a)) & (hi < len(a) + 60)
        found.append({(int(s), int(x) - len(a)) for s, x in zip(name[inside], lo[inside], strict=True)})
    # a symbol that is inside in two texts is the same in both
    spans = [{x for _, x in f} for f in found]
    for f, s in zip(found, spans, strict=True):
        for g, t in zip(found, spans, strict=True):
            both = s & t
            assert {p for p in f if p[1] in both} == {p for p in g if p[1] in both}


def _lines(seed=7):
    rnd = random.Random(seed)
    voc = ["a", "b"] + [f"w{i}" for i in range(40)]
    base = [[rnd.choice(voc) for _ in range(rnd.choice([1, 2, 9, 10, 11, 12, 20]))] for _ in range(20)]
    base += [["a"] * 12, ["a", "b"] * 6]

    def line():
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2])):
            q, i = rnd.random(), rnd.randrange(len(w) + 1)
            if q < 0.4 and i < len(w):
                w[i] = rnd.choice(voc)
            elif q < 0.7 and len(w) > 1 and i < len(w):
                del w[i]
            else:
                w.insert(i, rnd.choice(voc))
        return rnd.choice([" ", "  "]).join(w) + rnd.choice(["", "\r", " "])

    rows = [(rnd.choice([i, i, i, 7, None]), "\n".join(line() if rnd.random() < 0.9 else "" for _ in range(rnd.randint(0, 6))))
            for i in range(120)]
    return rows + [(500, None), (501, ""), (502, "\n\n"), (503, rows[0][1])]


@pytest.mark.parametrize("chunk_bytes", [10**9, 500])
def test_lines_against_brute_force(sp, chunk_bytes):
    rows = _lines()
    got = line_dedup.remove_repeated_lines(texts(sp, rows), chunk_bytes=chunk_bytes, digest=True).collect()
    want = line_dedup.brute_force(rows)
    assert _by_text(got) == _by_text(want)
    assert 100 < sum(r[2] for r in want) < sum(r[1] for r in want)


def test_lines_keep_all_columns(sp, awkward):
    out = line_dedup.remove_repeated_lines(awkward)
    assert out.columns == [*awkward.columns, "n_lines_", "n_removed"]
    rows = {r["source"]: r for r in out.collect()}
    assert out.count() == len(AWKWARD) and rows
    kept = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (5, "a") in kept and (5, "") in kept  # the second of two equal rows has lost its line
    assert (1, None) in kept and (2, "") in kept and (3, " \n\t ") in kept


def test_empty_tables(sp, nothing):
    assert substring_dedup.remove_repeats(nothing).count() == 0
    assert line_dedup.remove_repeated_lines(nothing).count() == 0
    assert line_dedup.remove_repeated_lines(nothing, digest=True).count() == 0
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_awkward_rows(sp, awkward):
    assert _by_text(substring_dedup.remove_repeats(awkward).collect()) == _by_text(substring_dedup.brute_force(AWKWARD))
    found = near_dedup.classes(near_dedup.near_duplicates(awkward)).collect()
    assert len(found) == len(AWKWARD)
    assert {r["doc_id"]: r["class_id"] for r in found if r["doc_id"] is not None} == {
        1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 7: 7, 8: 8, 9: 9, 10: 10, 11: 11, -3: -3}
    stay = near_dedup.one_of_each(awkward)
    assert stay.columns == awkward.columns
    assert sorted(r["doc_id"] for r in stay.collect() if r["doc_id"] is not None) == [-3, 1, 3, 4, 5, 7, 8, 9, 10, 11]


def _copies(seed=5, n=150):
    rnd = random.Random(seed)
    voc = [f"w{i}" for i in range(2000)]
    base = [[rnd.choice(voc) for _ in range(rnd.choice([3, 8, 30, 80, 150]))] for _ in range(15)]
    rows = []
    for i in range(n):
        w = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 6)):
            w[rnd.randrange(len(w))] = rnd.choice(voc)
        rows.append((i, rnd.choice([" ", "\n"]).join(w)))
    return rows + [(1000, None), (1001, ""), (1002, "  "), (1003, rows[3][1]), (1004, "the " * 500), (1005, "the " * 480)]


def test_near_copies_against_brute_force(sp):
    rows = _copies()
    got = sorted(tuple(r)[:2] for r in near_dedup.classes(near_dedup.near_duplicates(texts(sp, rows))).collect())
    want = sorted(near_dedup.brute_force(rows))
    assert got == want
    assert len({c for _, c in want}) < len(rows) - 20
    stay = near_dedup.one_of_each(texts(sp, rows)).collect()
    assert sorted(r["doc_id"] for r in stay) == sorted({c for _, c in want})


def test_samples_estimate_the_weighted_similarity():
    rng = np.random.default_rng(2)
    idf = near_dedup.idf_table(np.zeros(near_dedup.CELLS), 10)
    for n, change in ((400, 40), (60, 4), (12, 1)):
        agree, true = [], []
        for _ in range(30):
            words = [f"v{i}" for i in rng.integers(0, 10**6, n)]
            other = list(words)
            for i in rng.integers(0, n, change):
                other[i] = f"x{i}"
            a, b = " ".join(words), " ".join(other)
            doc, hashes, tf = near_dedup.shingles([a, b])
            s = near_dedup.signatures(doc, hashes, near_dedup.weights(hashes, tf, idf), 2, 128)
            agree.append((s[0] == s[1]).mean())
            true.append(near_dedup.similarity(a, b, idf))
        assert abs(np.mean(agree) - np.mean(true)) < 0.03


def test_samples_of_uneven_weights():
    """Shingles that weigh much in both texts beside many light ones in one: weighted similarity 0.85, 0.53 of the
    shingles."""
    rng = np.random.default_rng(3)
    w = np.concatenate((np.full(45, 1 + np.log(50)), np.ones(40))) * np.log1p(4)
    true = w[:45].sum() / w.sum()
    agree, met = [], []
    for _ in range(60):
        heavy, light = np.sort(rng.integers(1, 2**63, 45)).astype(np.uint64), rng.integers(1, 2**63, 40).astype(np.uint64)
        doc = np.repeat([0, 1], [85, 45])
        s = near_dedup.signatures(doc, np.concatenate((heavy, light, heavy)), np.concatenate((w, w[:45])), 2, near_dedup.SAMPLES)
        keys = near_dedup.band_keys(s[:, : near_dedup.ROWS * near_dedup.BANDS], near_dedup.ROWS)
        agree.append((s[0] == s[1]).mean())
        met.append((keys[0] == keys[1]).any())
    assert abs(np.mean(agree) - true) < 0.01 and min(agree) >= near_dedup.MIN_AGREE and all(met)


def test_samples_follow_the_definition():
    """One sample after the other, shingle by shingle, and the same sample whatever the other texts of the slice."""
    rng = np.random.default_rng(4)
    hashes = np.sort(rng.integers(1, 2**63, 30)).astype(np.uint64)
    w = rng.uniform(0.1, 20, 30)
    doc = np.repeat([0, 2], [10, 20])
    got = near_dedup.signatures(doc, hashes, w, 4, 5)
    assert not got[[1, 3]].any() and got[[0, 2]].all()
    for d in (0, 2):
        own = doc == d
        assert (near_dedup.signatures(np.zeros(own.sum(), int), hashes[own], w[own], 1, 5)[0] == got[d]).all()
    m = (1 << 64) - 1
    for k in range(5):
        best = []
        for h, v in zip(hashes[:10].tolist(), w[:10].tolist(), strict=True):
            x = (h + (k + 1) * near_dedup._GOLDEN) & m
            x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & m
            x = ((x ^ x >> 27) * 0x94D049BB133111EB) & m
            r, c, beta = near_dedup._R[x >> 48], near_dedup._LN_C[x >> 16 & 0xFFFF], near_dedup._BETA[x >> 32 & 0xFFFF]
            t = np.floor(np.log(v) / r + beta)
            ln_y = r * (t - beta)
            best.append(c - ln_y - r)
        name = near_dedup.mix(np.array([min(best)]).view(np.uint64))
        exact = near_dedup.signatures(doc[:10], hashes[:10], w[:10], 1, 5)[0, k]
        near = np.array([min(best)])
        # the same number up to the order of the sums
        same = [near_dedup.mix(np.nextafter(near, near + s).view(np.uint64))[0] for s in (-1, 1)] + [name[0]]
        two = [near_dedup.mix(np.nextafter(np.nextafter(near, near + s), near + s).view(np.uint64))[0] for s in (-1, 1)]
        assert exact in same + two
    g = near_dedup._gamma_draws(0)  # mean and variance of Gamma(2, 1) are 2
    assert abs(g.mean() - 2) < 0.03 and abs(g.var() - 2) < 0.1


def test_near_copies_of_uneven_weights(sp):
    """Pairs of texts with a passage said 50 times; one of them has words more, said once."""
    rnd = random.Random(8)
    rows = []
    for i in range(20):
        often = " ".join([" ".join(f"p{i}_{k}" for k in range(45))] * 50)
        rows += [(2 * i, often), (2 * i + 1, often + " " + " ".join(f"q{rnd.randrange(10**9)}" for _ in range(36)))]
    want = sorted(near_dedup.brute_force(rows))
    assert len({c for _, c in want}) == 20
    assert sorted(tuple(r)[:2] for r in near_dedup.classes(near_dedup.near_duplicates(texts(sp, rows))).collect()) == want


@pytest.mark.parametrize("bits", [1 << 24, 1 << 15, 32])
def test_texts_of_wanted_nodes_only(sp, bits):
    rows = [(i, f"some text {i % 300}") for i in range(400)]
    source = near_dedup.with_nodes(texts(sp, rows))
    wanted = source.where("row_id % 7 = 0").select("node").distinct()
    got = [(bytes(r["node"]), r["text"]) for r in near_dedup._texts_of(source, wanted, bits).collect()]
    keep = {bytes(r["node"]) for r in wanted.collect()}
    want = {(bytes(r["node"]), r["text"]) for r in source.collect() if bytes(r["node"]) in keep}
    assert len(got) == len(want) and set(got) == want
    assert near_dedup._texts_of(source, wanted.limit(0), bits).count() == 0


def test_bitmaps_are_met_before_texts_are_exchanged(sp):
    source = near_dedup.with_nodes(texts(sp, [(i, f"some text {i}") for i in range(3000)]))
    wanted = source.where("row_id < 30").select("node")
    before = sp.conf.get("spark.sql.autoBroadcastJoinThreshold")
    sp.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = near_dedup._texts_of(source, wanted)._jdf.queryExecution().executedPlan().toString()
    finally:
        sp.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert 0 < plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_parities_never_exclude_a_similar_pair():
    rnd = random.Random(8)
    idf = near_dedup.idf_table(np.array([rnd.choice([0, 10, 400]) for _ in range(1 << 10)] * (near_dedup.CELLS >> 10)), 1000)
    reach, below = [], []
    for _ in range(300):
        a = rnd.choices(range(60 if rnd.random() < 0.2 else 5000), k=rnd.randint(5, 300))
        b = [rnd.randint(0, 5000) if rnd.random() < 0.02 * rnd.random() else w for w in a]
        two = [" ".join(map(str, x)) for x in (a, b + a[: rnd.randint(0, 9)])]
        doc, hashes, tf = near_dedup.shingles(two)
        total = np.bincount(doc, weights=near_dedup.weights(hashes, tf, idf), minlength=2)
        x, y = near_dedup.parities(doc, hashes, idf, 2)
        apart = np.unpackbits((x ^ y).view(np.uint8)).reshape(len(near_dedup.FLOORS), -1).sum(axis=1) @ near_dedup.FLOORS
        ok = apart * 1.8 <= total.sum() * 0.2 * (1 + 1e-9) + 1e-9
        (reach if near_dedup.similarity(*two, idf) >= 0.8 else below).append(ok)
    assert len(reach) > 50 and all(reach)
    assert len(below) > 50 and not all(below)


def test_shingles_are_sorted_text_by_text(monkeypatch):
    texts = ["b a b a b a b a", None, "one two", "", "c d e f g h c d e f g x", "b a b a b a b a"]
    # no sort over all texts at once, whose index array and two passes took half of the time
    monkeypatch.setattr(near_dedup.np, "lexsort", None)
    doc, hashes, tf = near_dedup.shingles(texts)
    want = []
    for i, text in enumerate(texts):
        _, own, n = near_dedup.shingles([text])
        assert (np.diff(own.view(np.uint64).astype(object)) > 0).all()
        want += [(i, h, k) for h, k in zip(own.tolist(), n.tolist(), strict=True)]
    assert list(zip(doc.tolist(), hashes.tolist(), tf.tolist(), strict=True)) == want
    assert [int(tf[doc == i].sum()) for i in range(6)] == [4, 0, 1, 0, 8, 4]
    assert [int((doc == i).sum()) for i in range(6)] == [2, 0, 1, 0, 7, 2]
