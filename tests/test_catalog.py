import pytest
from pyspark.sql import functions as F

from quoteline.operators import catalog as cat

# The stub catalogue of the behaviour tests: two modules, two datasets and one feature set.
ANALYSES = [("m1", "EventCount"), ("m2", "Liquid")]
DATASETS = [("d1", "AB00", None), ("d2", "CD01", None), ("f1", "FeatSet01", "m1")]
LINEAGE = [("f1", "d1"), ("f1", "d2")]


@pytest.fixture()
def stub(spark):
    return (
        spark.createDataFrame(DATASETS, "id string, name string, module_id string"),
        spark.createDataFrame(ANALYSES, "id string, name string"),
        spark.createDataFrame(LINEAGE, "left_fs_id string, right_ds_id string"),
    )


def _names(df):
    return sorted(r["name"] for r in df.collect())


def test_search_modules(spark, stub):
    _, analyses, _ = stub
    assert _names(cat.search_modules(analyses, "EventCo")) == ["EventCount"]
    assert _names(cat.search_modules(analyses, "Ev")) == ["EventCount"]
    assert _names(cat.search_modules(analyses, "Liq")) == ["Liquid"]
    assert _names(cat.search_modules(analyses, "")) == ["EventCount", "Liquid"]
    assert _names(cat.search_modules(analyses, "liq")) == ["Liquid"]  # case-insensitive


def test_search_datasets(spark, stub):
    datasets, analyses, lineage = stub
    find = lambda p: _names(cat.search_datasets(datasets, analyses, lineage, p))
    assert find("AB") == ["AB00"]
    assert find("CD") == ["CD01"]
    assert find("Feat") == ["FeatSet01"]
    assert find("") == ["AB00", "CD01", "FeatSet01"]
    # contains-match: 'A' also finds FeatSet01 (the real search is not a prefix search)
    assert find("A") == ["AB00", "FeatSet01"]
    rows = {r["name"]: r for r in cat.search_datasets(datasets, analyses, lineage, "").collect()}
    assert rows["FeatSet01"]["module_name"] == "EventCount" and rows["FeatSet01"]["n_parents"] == 2
    assert rows["AB00"]["module_name"] is None and rows["AB00"]["n_parents"] == 0


def test_parents_and_derived(spark, stub):
    datasets, _, lineage = stub
    parents = cat.dataset_parents(datasets, lineage).collect()
    assert [(r["name"], r["parent_names"], r["n_parents"]) for r in parents] == [("FeatSet01", ["AB00", "CD01"], 2)]
    derived = {r["name"]: r["n_derived"] for r in cat.dataset_derived(datasets, lineage).collect()}
    assert derived == {"AB00": 1, "CD01": 1}


def test_resolve_inputs(spark, stub):
    datasets, _, _ = stub
    got = cat.resolve_inputs(datasets, cat.requested_names(spark, ["AB00", "FeatSet01"]))
    assert sorted((r["name"], r["id"]) for r in got.collect()) == [("AB00", "d1"), ("FeatSet01", "f1")]
    with pytest.raises(Exception, match="input dataset not found: dataset0"):
        cat.resolve_inputs(datasets, cat.requested_names(spark, ["AB00", "dataset0"])).collect()
    unchecked = cat.resolve_inputs(datasets, cat.requested_names(spark, ["AB00", "dataset0"]), check=False)
    assert [r["name"] for r in unchecked.collect()] == ["AB00"]


def test_latest_state(spark):
    log = spark.createDataFrame(
        [("a", 1, 1, False), ("a", 2, 1, True), ("b", 1, 1, True), ("b", 1, 2, False), ("c", 5, 1, False)],
        "k string, ts int, seq int, drop boolean",
    )
    got = cat.latest_state(log, "k", ["ts", "seq"], F.col("drop"), ["ts", "seq"])
    assert sorted(tuple(r) for r in got.collect()) == [("b", 1, 2), ("c", 5, 1)]


def test_parent_pages_of_a_large_set(spark):
    """More parents than a page: no array is longer than one, and the pages follow each other in order."""
    n = 2_500
    datasets = spark.range(n + 3).selectExpr("id", "concat('d', lpad(CAST(id * 7 % 100 AS STRING), 3, '0')) AS name")
    lineage = (spark.range(n).selectExpr(f"{n}L AS left_fs_id", "id AS right_ds_id")
               .unionByName(spark.createDataFrame([(n + 1, 5), (n + 1, 6), (n + 1, 99_999), (77_777, 5)], "left_fs_id long, right_ds_id long")))
    names = {r["id"]: r["name"] for r in datasets.collect()}
    pages = {(r["id"], r["page"]): r for r in cat.parent_pages(datasets, lineage, 100).collect()}
    assert sorted(pages) == [(n, p) for p in range(25)] + [(n + 1, 0)]
    assert all(len(r["parent_names"]) <= 100 for r in pages.values())
    whole = [x for p in range(25) for x in pages[n, p]["parent_names"]]
    assert whole == sorted(names[i] for i in range(n)) and {r["n_parents"] for r in pages.values()} == {n, 2}
    assert pages[n + 1, 0]["parent_names"] == sorted([names[5], names[6]])
    first = {r["id"]: r for r in cat.dataset_parents(datasets, lineage, 100).collect()}
    assert first[n]["parent_names"] == whole[:100] and first[n]["n_parents"] == n
    assert first[n + 1]["n_parents"] == 2 and len(first) == 2
    with pytest.raises(ValueError):
        cat.parent_pages(datasets, lineage, 0)


def test_datasets_are_not_broadcast_on_an_estimate(spark, workdir):
    from quoteline.sources.registry import Catalog

    catalog = Catalog(spark, f"{workdir}/catalog")
    catalog.record_datasets(spark.range(20).selectExpr("concat('d', id) AS name", "'' AS filepath"))
    ids = [catalog.dataset(n)["id"] for n in ("d1", "d2")]
    catalog.create_relation(ids[0], ids[1:])
    catalog.snapshot()
    assert "BroadcastHashJoin" not in catalog.lineage()._jdf.queryExecution().executedPlan().toString()
    assert [[r["left_fs_id"], r["right_ds_id"]] for r in catalog.lineage().collect()] == [ids]
    rows = {r["name"]: r["parent_names"] for r in catalog.list_datasets().collect()}
    assert len(rows) == 20 and {n: p for n, p in rows.items() if p} == {"d1": ["d2"]}
