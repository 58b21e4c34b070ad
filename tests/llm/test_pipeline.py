import hashlib
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from oracle_check import compare, duck  # noqa: E402
from quoteline.llm import decontamination, line_dedup, near_dedup  # noqa: E402
from quoteline.llm.common import table, tokenizer_path  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_registered():
    names = E.queries()
    assert [n for n in names if n.startswith("op")] and {f"op{i}" for i in range(1, 14)} == {
        n.split("_")[0] for n in names if n.startswith("op")}
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op4_decontamination", "op8_substring_dedup"])
def test_query_matches_oracle(sp, name):
    assert compare(sp, duck(SMALL), name, E.queries()[name], E.oracle_sql()[name], SMALL)


@pytest.mark.parametrize("name", ["op1_line_dedup", "op2_ann_search", "op3_token_store", "op5_language_id", "op6_quality",
                                  "op7_token_counts", "op9_near_dedup", "op10_sentencepiece"])
def test_query_covers_its_table(sp, name):
    got = E.queries()[name](sp, SMALL)
    if name == "op2_ann_search":
        assert got.count() == 5 * table(sp, SMALL, "embeddings").where("vec_id % 50 = 0").count()
    else:
        assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == sorted(
            r["doc_id"] for r in table(sp, SMALL, "documents").select("doc_id").collect())


def _stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_against_brute_force(sp):
    """Each stage on its predecessor's rows, held against the definition."""
    docs = table(sp, SMALL, "documents")
    columns = docs.columns
    kept = _stage("language")(sp, docs, SMALL)
    assert kept.columns == columns and kept.count() == docs.count()  # every text here has letters and a language
    rows = [tuple(r) for r in kept.select("doc_id", "text").collect()]

    lines = _stage("lines")(sp, kept, SMALL)
    assert lines.columns == columns
    got = {r["doc_id"]: r for r in lines.collect()}
    want = {r[0]: r for r in line_dedup.brute_force(rows)}
    assert set(got) == {d for d, r in want.items() if r[2] < r[1] or not r[1]}
    for d, r in got.items():
        assert hashlib.sha256(r["text"].encode()).hexdigest() == want[d][3]
        assert r["n_chars"] == len(r["text"])

    near = _stage("near_duplicates")(sp, lines, SMALL)
    assert near.columns == columns
    classes = near_dedup.brute_force([(r["doc_id"], r["text"]) for r in got.values()])
    assert sorted(r["doc_id"] for r in near.collect()) == sorted({c for _, c in classes})

    clean = _stage("benchmark")(sp, near, SMALL)
    items = [tuple(r) for r in table(sp, SMALL, "benchmark").collect()]
    left = [(r["doc_id"], r["text"]) for r in near.collect()]
    hits = decontamination.brute_force(left, items)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(h[0] for h in hits if not h[5])

    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    out = {r["doc_id"]: r for r in _stage("sentencepiece")(sp, clean, SMALL).collect()}
    for r in clean.collect():
        ids = lib.encode(r["text"])
        assert out[r["doc_id"]]["n_tokens"] == len(ids)
        assert out[r["doc_id"]]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_stages_take_awkward_and_empty_rows(sp, awkward, nothing):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(sp, docs, SMALL)
            assert out.count() <= docs.count()
            if name != "sentencepiece":
                assert out.columns == docs.columns
                assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
