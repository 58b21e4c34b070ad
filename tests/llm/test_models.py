import math
import random
import zlib

import numpy as np
import pytest

from quoteline.llm import ann_search, decontamination, language_id, quality
from quoteline.llm.common import table

from llm_rows import AWKWARD, texts

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# --- language ------------------------------------------------------------------------------------


def test_languages_of_held_out_documents(sp):
    docs = table(sp, MEDIUM, "documents")
    got = language_id.identify(docs).collect()
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert len(got) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.98


def _slow_bits(train: list[bytes], text: bytes, alphabet: set) -> float:
    """Code length by the definition, one byte at a time."""
    counts: dict[bytes, dict[int, int]] = {}
    for t in train:
        t = b"\n\n\n" + t
        for i in range(3, len(t)):
            for k in range(4):
                own = counts.setdefault(t[i - k : i], {})
                own[t[i]] = own.get(t[i], 0) + 1

    def p(context: bytes, b: int) -> float:
        own = counts.get(context, {})
        n, d = sum(own.values()), len(own)
        base = p(context[1:], b) if context else 1 / 256
        if b in own:
            return own[b] / (n + d)
        return (d / (n + d) if own else 1.0) * base

    t = b"\n\n\n" + text
    return sum(-math.log2(p(t[i - 3 : i], t[i])) for i in range(3, len(t)))


def test_code_lengths_follow_the_definition(sp):
    rnd = random.Random(1)
    own = {k: ["".join(rnd.choices(a, k=80)) for _ in range(6)] for k, a in (("x", "abc \n"), ("y", "abd e"))}
    rows = [(i, t, k) for i, (k, t) in enumerate((k, t) for k, ts in own.items() for t in ts)]
    model = language_id.train(sp.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["x", "y"]
    for text in ("abcab dd", "e", "zzz", "ab\nca\n", "ééa"):
        got = model.code_lengths([text.encode()])[0]
        for k, lang in enumerate(model.languages):
            want = _slow_bits([t.encode() for t in own[lang]], text.encode(), set())
            assert got[k] == pytest.approx(want, rel=1e-5)


def test_many_languages_keep_their_contexts(sp):
    """Sixty languages of the same letters: the code lengths in the last ones follow the definition."""
    rnd = random.Random(2)
    own = {f"l{i:02}": ["".join(rnd.choices("abcdefgh ", weights=[rnd.random() ** 3 + 0.01 for _ in range(9)], k=150))
                        for _ in range(4)] for i in range(60)}
    rows = [(i, t, k) for i, (k, t) in enumerate((k, t) for k, ts in own.items() for t in ts)]
    model = language_id.train(sp.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts_ = ["abc hged", "", *own["l59"][:2], *own["l07"][:2]]
    got = model.code_lengths([t.encode() for t in texts_])
    for k in (0, 7, 59):
        for i, text in enumerate(texts_):
            assert got[i, k] == pytest.approx(_slow_bits([t.encode() for t in own[model.languages[k]]], text.encode(), set()))
    assert got[2:].argmin(1).tolist() == [59, 59, 7, 7]


def test_language_edge_cases(sp, awkward, nothing):
    docs = awkward.unionByName(table(sp, SMALL, "documents"), allowMissingColumns=True)
    got = {(r["doc_id"], r["lang_pred"]) for r in language_id.identify(docs).where("doc_id IN (1, 2, 3, 4)").collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "und")} <= got
    assert language_id.identify(nothing).count() == 0
    unlabelled = sp.createDataFrame([(1, "some text", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in language_id.identify(unlabelled).collect()} == {("und", 0.0)}
    model = language_id.train(table(sp, SMALL, "documents"))
    kept = language_id.keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert not {1, 2, 3, 4} & {r["doc_id"] for r in kept.where("source = 's'").collect()}
    assert kept.where("source <> 's'").count() == table(sp, SMALL, "documents").count()


# --- quality -------------------------------------------------------------------------------------


def test_quality_of_held_out_documents(sp):
    docs, labels = table(sp, MEDIUM, "documents"), table(sp, MEDIUM, "labels")
    got = quality.score_quality(docs, labels)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got.collect())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    good, bad = ([r["score"] for r in rows if r["quality"] == k] for k in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.95


def test_rules_as_columns_equal_rules_in_numpy(sp):
    docs, labels = table(sp, SMALL, "documents"), table(sp, SMALL, "labels")
    stats = quality.text_statistics(docs).join(labels, "doc_id").orderBy("doc_id").toPandas()
    x = stats[list(quality.STATS)].to_numpy()
    model = quality.fit(x, stats["quality"].to_numpy(dtype=float))
    assert model.rules or model.linear
    frame = sp.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["i", *quality.STATS])
    got = [r["s"] for r in frame.select("i", model.expression(list(quality.STATS)).alias("s")).orderBy("i").collect()]
    assert np.allclose(got, model.scores(x))


def test_quality_edge_cases(sp, awkward, nothing):
    labels = sp.createDataFrame([(7, 1), (8, None), (None, 0)], "doc_id long, quality int")
    got = quality.score_quality(awkward, labels).collect()
    assert len(got) == len(AWKWARD) and len({r["score"] for r in got}) == 1  # one label only
    none = sp.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.score_quality(awkward, none).collect()} == {0.5}
    assert quality.score_quality(nothing, labels).count() == 0
    assert np.isfinite(quality.statistics([t for _, t in AWKWARD])).all()


def _slow_statistics(text: str | None) -> list[float]:
    """The numbers of quality.STATS one by one."""
    raw = (text or "").encode()
    words, lines = raw.split(), [ln.split() for ln in raw.split(b"\n")]
    lines = [ln for ln in lines if ln]

    def kind(b: int) -> str:
        c = chr(b)
        if b >= 128:
            return "high"
        return ("upper" if "A" <= c <= "Z" else "lower" if "a" <= c <= "z" else "digit" if "0" <= c <= "9" else
                "space" if c in " \t\n\v\f\r" else "mark" if c in ".,;:!?'\"()-" else "other")

    def share(name):
        return sum(kind(b) == name for b in raw) / max(len(raw), 1)

    def of_words(test):
        return sum(map(test, words)) / max(len(words), 1)

    w, n_lines = max(len(words), 1), max(len(lines), 1)
    return [math.log1p(len(raw)), math.log1p(len(words)), math.log1p(len(lines)), sum(map(len, words)) / w, of_words(lambda x: len(x) > 15),
            share("upper"), share("lower"), share("digit"), share("space"), share("mark"), sum(raw.count(c) for c in b".!?") / w,
            raw.count(b"|") / w, share("other"), share("high"), len(set(words)) / w, max(map(words.count, set(words)), default=0) / w,
            sum(a == b for a, b in zip(words, words[1:], strict=False)) / w, len({tuple(sorted(ln)) for ln in lines}) / n_lines,
            sum(len(ln) < 4 for ln in lines) / n_lines, of_words(lambda x: len(x) > 1 and kind(x[0]) == kind(x[1]) == "upper"),
            of_words(lambda x: kind(x[-1]) in ("other", "digit")), len(words) / n_lines]


def test_statistics_follow_their_definitions(sp):
    sample = [r["text"] for r in table(sp, SMALL, "documents").limit(60).collect()]
    rnd = random.Random(9)
    made = ["".join(rnd.choices("AB ab\n .,|#1é", k=rnd.randint(0, 80))) for _ in range(80)]
    texts_ = [t for _, t in AWKWARD if t is None or len(t) < 1000] + sample + made
    got = quality.statistics(texts_)
    for row, text in zip(got, texts_, strict=True):
        assert dict(zip(quality.STATS, row, strict=True)) == pytest.approx(dict(zip(quality.STATS, _slow_statistics(text), strict=True)))


def test_an_id_on_many_rows_is_learnt_once(sp, monkeypatch):
    """A labelled id on many rows with other texts gives one training row, whatever the order of the rows."""
    rows = [(1, f"text number {i} of many " * (i % 5 + 1)) for i in range(400)] + [(k, f"plain {k} words") for k in range(2, 40)]
    labels = sp.createDataFrame([(k, k % 2) for k in range(1, 40)] * 2, "doc_id long, quality int")
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y, *a: (seen.append((x, y)), fit(x, y, *a))[1])
    got = quality.score_quality(texts(sp, rows), labels)
    assert got.count() == len(rows)
    quality.score_quality(texts(sp, rows[::-1]).repartition(3), labels)
    own = [k for k in range(1, 40) if zlib.crc32(str(k).encode()) % 5 != 0]
    assert all(x.shape == (len(own), len(quality.STATS)) for x, _ in seen)
    assert (seen[0][0] == seen[1][0]).all() and (seen[0][1] == seen[1][1]).all()


# --- nearest neighbours ----------------------------------------------------------------------------


def test_recall_against_brute_force(sp):
    vectors = table(sp, MEDIUM, "embeddings")
    want = ann_search.brute_force([tuple(r) for r in vectors.select("vec_id", "embedding").collect()])
    got: dict = {}
    for r in ann_search.nearest(vectors, block=100, queries_each=4).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert got.keys() == want.keys() and all(sorted(v) == [1, 2, 3, 4, 5] for v in got.values())
    found = sum(len({i for i, _ in v.values()} & {i for i, _ in want[q]}) for q, v in got.items())
    assert found / sum(map(len, want.values())) >= 0.9


def test_index_returns_every_code_within_the_radius():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 256, (500, 5)).astype(np.uint8)
    index = ann_search.MultiIndex(codes)
    bits = np.unpackbits(codes, axis=1)
    for radius in (0, 3, 9, 14, 40):
        for q in range(0, 500, 100):
            want = np.flatnonzero((bits != bits[q]).sum(1) <= radius)
            assert index.within(codes[q], radius).tolist() == want.tolist()


def test_vectors_edge_cases(sp):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, None), (100, [nan, 1.0]),
            (150, [1.0, None]), (5, [inf, 1.0]), (200, [-1.0, 0.0]), (6, [1.0, 0.0, 0.0]), (None, [1.0, 1.0]),
            *[(k, [3.0, 4.0]) for k in range(300, 320)]]
    vectors = sp.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, node string, rank int")
    got: dict = {}
    for r in ann_search.nearest(vectors).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = ann_search.brute_force(rows)
    assert got.keys() == want.keys() == {0, 50, 200, 300}
    for q, found in got.items():
        assert [(i, pytest.approx(s)) for _, i, s in sorted(found)] == want[q]
    few = ann_search.nearest(vectors.where("vec_id IN (0, 2)")).collect()
    assert [(r["query_id"], r["vec_id"]) for r in few] == [(0, 2)]
    assert ann_search.nearest(vectors.where("vec_id IN (0)")).count() == 0
    assert ann_search.nearest(vectors.where("vec_id IN (3, 4)")).count() == 0


def test_repeated_rows_and_lengths_against_brute_force(sp):
    """Repeated query rows, ids with several vectors (near by the nearest one), one vector on many ids, two lengths."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.integers(-4, 5, 3 + 2 * (i % 5 == 0)).astype(float).tolist()) for i in range(160)]
    rows += [rows[50], rows[50], rows[100], rows[7], rows[14]]  # row 50 three times
    rows += [(i, rng.integers(-4, 5, 3 + 2 * (i % 2)).astype(float).tolist()) for i in (0, 50, 50, 3, 3, 3, 9)]
    rows += [(200 + i, rows[1][1]) for i in range(20)] + [(11, (np.array(rows[1][1]) * 2).tolist())] * 3
    rows += [(12, (np.array(rows[50][1]) + rng.normal(0, 0.01, len(rows[50][1]))).tolist()) for _ in range(10)]
    want = ann_search.brute_force(rows)
    vectors = sp.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for block, each in ((8192, 2048), (20, 2)):
        got: dict = {}
        for r in ann_search.nearest(vectors, target=1.0, block=block, queries_each=each).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        assert got.keys() == want.keys() == {0, 50, 100, 150, 200}
        for q, found in got.items():
            assert [r for r, _, _ in sorted(found)] == [1, 2, 3, 4, 5]
            assert len({i for _, i, _ in found}) == 5
            # every neighbour has its true score; a neighbour beyond the learnt radius may be missed
            assert [s for _, _, s in sorted(found)] == pytest.approx([s for _, s in want[q]], abs=0.35)
            hits = {i for _, i, _ in found} & {i for i, _ in want[q]}
            assert len(hits) >= 4 and all(s == pytest.approx(dict(want[q])[i]) for _, i, s in found if i in hits)


# --- decontamination -------------------------------------------------------------------------------

ITEMS = [(1, "What is the capital of the old land, and who does rule it today?"), (2, "Short item!"), (3, "..."), (4, None),
         (5, "one two three four five six seven eight nine ten"), (6, "one two three four five six seven eight nine ten"),
         (None, "no id"), (10, "É-mail ÀB c")]


def _contaminated():
    rnd = random.Random(4)
    rows = list(AWKWARD)
    for i in range(100, 160):
        words = [rnd.choice(["one", "two", "x", "y"]) for _ in range(rnd.randint(0, 20))]
        if rnd.random() < 0.5:
            item = decontamination.normalised_words(rnd.choice(ITEMS)[1] or "")
            a = rnd.randint(0, max(0, len(item) - 10))
            at = rnd.randint(0, len(words))
            words[at:at] = [w.decode().upper() for w in item[a : a + rnd.randint(8, 14)]]
        rows.append((i, rnd.choice([" ", ", ", "\n-"]).join(words)))
    return rows


@pytest.mark.parametrize("block_bytes", [8_000_000, 60])
def test_contamination_against_brute_force(sp, block_bytes):
    rows = _contaminated()
    bench = sp.createDataFrame(ITEMS, "item_id long, text string")
    found = decontamination.find_contamination(texts(sp, rows), bench, block_bytes=block_bytes)
    got = sorted((tuple(r) for r in decontamination.digests(found).collect()), key=str)
    want = decontamination.brute_force(rows, [i for i in ITEMS if i[0] is not None])
    assert got == sorted(want, key=str)
    assert 5 < sum(r[5] for r in want) < len(rows)
    # the spans are the hit words in the original text
    for r, (_, text) in ((r, next(x for x in rows if x[0] == r["doc_id"])) for r in found.where("n_hit > 0").collect()):
        cut = [decontamination.normalised_words(text[s["start"]:s["end"]]) for s in r["spans"]]
        assert sum(map(len, cut)) == r["n_hit"]
    stay = decontamination.without_contaminated(texts(sp, rows), bench, block_bytes=block_bytes)
    assert sorted((tuple(r) for r in stay.collect()), key=str) == sorted(
        (row for row, w in zip(rows, want, strict=True) if not w[5]), key=str)


def test_contamination_of_empty_tables(sp, nothing, awkward):
    bench = sp.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.find_contamination(nothing, bench).count() == 0
    empty = sp.createDataFrame([], "item_id long, text string")
    assert decontamination.find_contamination(awkward, empty).where("n_hit > 0").count() == 0
    assert decontamination.without_contaminated(awkward, empty).columns == awkward.columns


@pytest.mark.parametrize("block_bytes", [8_000_000, 60])
def test_contamination_by_items_without_id(sp, tmp_path, block_bytes):
    """The query's call against its SQL: a passage of an item with a null id is a hit."""
    import duckdb

    from quoteline.llm.queries import ORACLES

    nameless = [*ITEMS, (None, "A passage whose row has lost its id but is still in the test set, twelve")]
    rows = [(1, "no id here"), (2, "x " + nameless[-1][1] + " y"), (3, "no id, short item"), (4, "clean"), (5, None)]
    bench = sp.createDataFrame(nameless, "item_id long, text string")
    con = duckdb.connect()
    for name, cols, data in (("documents", "doc_id", rows), ("benchmark", "item_id", nameless)):
        con.execute(f"CREATE TABLE {name} ({cols} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", data)
    want = sorted(con.execute(ORACLES["op4_decontamination"]).fetchall())
    assert [r[5] for r in want] == [True, True, True, False, False] and want[2][3] == 2
    found = decontamination.find_contamination(texts(sp, rows), bench, block_bytes=block_bytes, null_items=True)
    assert sorted(tuple(r) for r in decontamination.digests(found).collect()) == want
    stay = decontamination.without_contaminated(texts(sp, rows), bench, block_bytes=block_bytes, null_items=True)
    assert sorted(r["doc_id"] for r in stay.collect()) == [4, 5]
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    texts(sp, rows).write.parquet(f"{tmp_path}/documents.parquet")
    from quoteline.llm.queries import op4_decontamination
    assert sorted(tuple(r) for r in op4_decontamination(sp, str(tmp_path)).collect()) == want
