import json
import os

import pytest

from quoteline.plans.runner import register_builtin_modules, run_analysis, test_analysis as dry_run
from quoteline.functions.paths import PathNameError
from quoteline.sources.importing import import_dataset
from quoteline.sources.registry import Catalog
from quoteline.operators.catalog import CatalogError
from quoteline.sources.schemas import CANCELS_SCHEMA, ORDERS_SCHEMA
from quoteline.sources.sinks import save_dataset, save_features

ORDERS = [
    (1, 1, 1, 1000, 1250, 66, 10, 5, 0, None, None, 1),
    (2, 1, 1, 1050, 1250, 66, 10, 7, 0, None, None, 1),
    (3, 1, 1, 800, 1250, 83, 11, 4, 0, None, None, 1),
]


@pytest.fixture()
def book_source(spark, workdir):
    """A source folder with per-day files for each table."""
    src = f"{workdir}/incoming/AB00.h5"
    orders = spark.createDataFrame(ORDERS, ORDERS_SCHEMA)
    orders.where("created < 1000").write.parquet(f"{src}/ORDERS/day=1")
    orders.where("created >= 1000").write.parquet(f"{src}/ORDERS/day=2")
    spark.createDataFrame([(1, None, None, 1, 1100, 66, 10, 5)],
                          "id int, past_id int, new_id int, ob_id int, timestamp long, side int, price int, quantity int"
                          ).write.parquet(f"{src}/CANCELS/day=1")
    spark.createDataFrame([(1, 1, 1, 1, 1100, 66, 5, 10, 1, 2)],
                          "id int, ref int, o_id int, ob_id int, timestamp long, side int, quantity int, price int, p_id int, cp_id int"
                          ).write.parquet(f"{src}/TRADES/day=1")
    return src


def test_module_registration(spark, workdir):
    catalog = Catalog(spark, f"{workdir}/catalog")
    register_builtin_modules(catalog)
    assert catalog.module("EventCount") is not None
    with pytest.raises(RuntimeError):
        catalog.register_module("EventCount", "quoteline.plans.modules:event_count_module")
    catalog.drop_module("Liquid")
    assert catalog.module("Liquid") is None
    with pytest.raises(RuntimeError):
        catalog.drop_module("Liquid")
    # a dropped name can be registered again
    catalog.register_module("Liquid", "quoteline.plans.modules:liquidity_curve_module")
    assert sorted(r["name"] for r in catalog.analyses().collect()) == ["EventCount", "Liquid"]


def test_import_run_and_save(spark, workdir, book_source):
    catalog = Catalog(spark, f"{workdir}/catalog")
    register_builtin_modules(catalog)
    written = import_dataset(spark, catalog, [book_source], f"{workdir}/files", "demo", "details")
    assert sorted(written) == ["AB00_CANCELS", "AB00_ORDERS", "AB00_TRADES"]
    assert written["AB00_ORDERS"].startswith(f"{workdir}/files/import-")
    assert catalog.dataset("AB00_ORDERS")["filepath"] == written["AB00_ORDERS"]
    orders = spark.read.parquet(written["AB00_ORDERS"])
    assert orders.schema == ORDERS_SCHEMA and orders.count() == 3
    # each written file is sorted by time (row-group statistics stay narrow)
    import glob

    import pyarrow.parquet as pq
    for f in glob.glob(f"{written['AB00_ORDERS']}/*.parquet"):
        created = pq.read_table(f, columns=["created"]).column("created").to_pylist()
        assert created == sorted(created)
    # a second import of the same source is refused before anything is written
    with pytest.raises(RuntimeError, match="name taken"):
        import_dataset(spark, catalog, [book_source], f"{workdir}/files2")
    assert not os.path.exists(f"{workdir}/files2")

    params = {"start_time": 1000, "end_time": 1300, "interval": 100}
    dry = dry_run(spark, "quoteline.plans.modules:event_count_module", params, ["AB00_ORDERS"], catalog=catalog)
    assert [tuple(r) for r in dry.collect()] == [(1000, 2)]
    curve = run_analysis(spark, catalog, "Liquid", params, ["AB00_ORDERS"])
    assert [r["timestamp"] for r in curve.collect()] == [1000, 1100, 1200]

    saved = run_analysis(spark, catalog, "EventCount", params, ["AB00_ORDERS"],
                         save={"target_dir": f"{workdir}/features", "name": "feat"})
    assert sorted(tuple(r) for r in saved.collect()) == [(1000, 2)]
    fs = catalog.dataset("feat")
    assert fs["filepath"] == f"{workdir}/features/feat.parquet"
    assert json.loads(fs["module_parameters"]) == params
    assert fs["module_id"] == catalog.module("EventCount")["id"]
    lineage = catalog.lineage().collect()
    assert [(r["left_fs_id"], r["right_ds_id"]) for r in lineage] == [(fs["id"], catalog.dataset("AB00_ORDERS")["id"])]

    with pytest.raises(RuntimeError, match="name taken"):
        run_analysis(spark, catalog, "EventCount", params, ["AB00_ORDERS"],
                     save={"target_dir": f"{workdir}/features", "name": "feat"})
    with pytest.raises(RuntimeError, match="needs a name"):
        run_analysis(spark, catalog, "EventCount", params, ["AB00_ORDERS"], save={})
    default = run_analysis(spark, catalog, "EventCount", params, ["AB00_ORDERS"], save={"name": "feat2"})
    assert default.count() == 1
    assert catalog.dataset("feat2")["filepath"] == f"{workdir}/catalog/features/feat2.parquet"

    listing = {r["name"]: r for r in catalog.list_datasets().collect()}
    assert sorted(listing) == ["AB00_CANCELS", "AB00_ORDERS", "AB00_TRADES", "feat", "feat2"]
    assert listing["feat"]["module_name"] == "EventCount" and listing["feat"]["parent_names"] == ["AB00_ORDERS"]
    assert json.loads(listing["feat"]["module_parameters"]) == params
    assert listing["AB00_ORDERS"]["module_name"] is None and listing["AB00_ORDERS"]["parent_names"] is None
    assert listing["AB00_ORDERS"]["description"] == "demo"
    assert [r["name"] for r in catalog.list_datasets("ab00_o").collect()] == ["AB00_ORDERS"]
    assert [r["name"] for r in catalog.list_modules("Ev").collect()] == ["EventCount"]
    assert [r["name"] for r in catalog.list_modules().collect()] == ["EventCount", "Liquid"]
    resolved = catalog.resolve(["AB00_ORDERS", "feat"]).select("name", "filepath").collect()
    assert sorted(r["name"] for r in resolved) == ["AB00_ORDERS", "feat"]
    with pytest.raises(Exception, match="input dataset not found: nope"):
        catalog.resolve(["AB00_ORDERS", "nope"]).collect()
    catalog.drop_dataset("AB00_ORDERS")
    assert catalog.lineage().count() == 0
    with pytest.raises(RuntimeError):
        catalog.drop_dataset("AB00_ORDERS")


def test_run_errors(spark, workdir):
    catalog = Catalog(spark, f"{workdir}/catalog")
    register_builtin_modules(catalog)
    catalog.create_dataset("present", f"{workdir}/nowhere", "")
    params = {"start_time": 0, "end_time": 1, "interval": 1}
    with pytest.raises(RuntimeError, match="no module named"):
        run_analysis(spark, catalog, "unlisted", params, ["present"])
    with pytest.raises(RuntimeError, match="absent_a"):
        run_analysis(spark, catalog, "EventCount", params, ["absent_a", "absent_b"])
    with pytest.raises(RuntimeError, match="absent_a"):
        run_analysis(spark, catalog, "EventCount", params, ["present", "absent_a"])
    for args in ({}, {"module_name": "EventCount"}, {"module_name": "EventCount", "params": params},
                 {"params": params, "inputs": ["present"]},
                 {"module_name": "EventCount", "inputs": ["present"]}):
        with pytest.raises(RuntimeError):
            run_analysis(spark, catalog, **args)


def test_sink_checks_leave_no_orphans(spark, workdir):
    catalog = Catalog(spark, f"{workdir}/catalog")
    register_builtin_modules(catalog)
    df = spark.createDataFrame(ORDERS, ORDERS_SCHEMA)
    path = save_dataset(catalog, df, f"{workdir}/files", "orders", "/path/to/file.h5", "d", "x")
    assert path == f"{workdir}/files/file/file_ORDERS.parquet"
    assert catalog.dataset("file_ORDERS")["identifier"] == "file"
    with pytest.raises(RuntimeError, match="name taken"):
        save_dataset(catalog, df, f"{workdir}/other", "orders", "/path/to/file.h5")
    with pytest.raises(PathNameError):
        save_dataset(catalog, df, f"{workdir}/other", "orders", "wrong/path/or/a-b.h5")
    with pytest.raises(RuntimeError, match="no module named"):
        save_features(catalog, df, f"{workdir}/other", "feat", "unlisted", {}, ["file_ORDERS"])
    with pytest.raises(RuntimeError, match="not found"):
        save_features(catalog, df, f"{workdir}/other", "feat", "EventCount", {}, ["missing_parent"])
    assert not os.path.exists(f"{workdir}/other")
    # a target on an unknown file system (a wrong container) fails the write; nothing is recorded
    with pytest.raises(RuntimeError, match="cannot write"):
        save_dataset(catalog, df, "nosuchfs://bucket", "orders", "/path/to/other.h5")
    assert catalog.dataset("other_ORDERS") is None
    with pytest.raises(RuntimeError, match="cannot write"):
        save_features(catalog, df, "nosuchfs://bucket", "feat", "EventCount", {}, ["file_ORDERS"])
    assert catalog.dataset("feat") is None
    # parents may be given as dataset paths: the base name is the dataset name
    save_features(catalog, df, f"{workdir}/feats", "feat", "EventCount", {"level": 3}, [path])
    assert catalog.lineage().count() == 1
    with pytest.raises(RuntimeError, match="name taken"):
        save_features(catalog, df, f"{workdir}/feats2", "feat", "EventCount", {}, [path])


def test_dry_run_of_a_function(spark):
    df = spark.createDataFrame(ORDERS, ORDERS_SCHEMA)
    out = dry_run(spark, "quoteline.plans.modules:event_count_module",
                  {"start_time": 1000, "end_time": 1300, "interval": 100}, {"x": df})
    assert [tuple(r) for r in out.collect()] == [(1000, 2)]
    with pytest.raises(RuntimeError):
        dry_run(spark, "no.such.module:fn", {}, {"x": df})


def test_csv_source_uses_fixed_schema(spark, workdir):
    src = f"{workdir}/incoming/CD01.csv"
    os.makedirs(f"{src}/ORDERS/2012-10-02")
    with open(f"{src}/ORDERS/2012-10-02/part.csv", "w") as fh:
        fh.write("1,1,1,1000,1250,66,10,5,0,,,1\n2,1,1,1050,0,83,11,7,0,,,1\n")
    catalog = Catalog(spark, f"{workdir}/catalog")
    written = import_dataset(spark, catalog, [src], f"{workdir}/files", fmt="csv", tables=["ORDERS"],
                             layout="by_source")
    back = spark.read.parquet(written["CD01_ORDERS"])
    assert back.schema == ORDERS_SCHEMA
    assert sorted(tuple(r) for r in back.collect()) == [
        (1, 1, 1, 1000, 1250, 66, 10, 5, 0, None, None, 1), (2, 1, 1, 1050, 0, 83, 11, 7, 0, None, None, 1)]


def test_partitioned_import_of_many_sources(spark, workdir):
    sources = []
    for ident, n in (("AB00", 2), ("CD01", 3)):
        src = f"{workdir}/incoming/{ident}.h5"
        rows = [(k, 1, 1, 1000 + k, 1250, 66, 10, 5, 0, None, None, 1) for k in range(n)]
        spark.createDataFrame(rows, ORDERS_SCHEMA).write.parquet(f"{src}/ORDERS/day=1")
        sources.append(src)
    catalog = Catalog(spark, f"{workdir}/catalog")
    written = import_dataset(spark, catalog, sources, f"{workdir}/files", tables=["ORDERS"], layout="partitioned")
    assert sorted(written) == ["AB00_ORDERS", "CD01_ORDERS"]
    assert all(p.endswith(f"/ORDERS/identifier={n[:4]}") for n, p in written.items())
    for name, n in (("AB00_ORDERS", 2), ("CD01_ORDERS", 3)):
        back = spark.read.parquet(catalog.dataset(name)["filepath"])
        assert back.schema == ORDERS_SCHEMA and back.count() == n
    with pytest.raises(RuntimeError, match="name taken"):
        import_dataset(spark, catalog, sources[:1], f"{workdir}/files", tables=["ORDERS"], layout="partitioned")


def _book(spark, folder, rows, tables=("ORDERS", "CANCELS")):
    spark.createDataFrame(rows, ORDERS_SCHEMA).write.parquet(f"{folder}/ORDERS/d")
    if "CANCELS" in tables:
        spark.createDataFrame([(1, None, None, 1, 1100, 66, 10, 5)], CANCELS_SCHEMA).write.parquet(f"{folder}/CANCELS/d")


@pytest.mark.parametrize("layout", ["partitioned", "by_source"])
def test_failed_import_leaves_nothing_and_can_be_retried(spark, workdir, layout):
    src = f"{workdir}/in/EF02.h5"
    _book(spark, src, ORDERS, tables=("ORDERS",))
    catalog = Catalog(spark, f"{workdir}/catalog")
    with pytest.raises(CatalogError, match="CANCELS"):
        import_dataset(spark, catalog, [src], f"{workdir}/files", tables=["ORDERS", "CANCELS"], layout=layout)
    assert catalog.datasets().count() == 0 and not os.path.exists(f"{workdir}/files")
    spark.createDataFrame([(1, None, None, 1, 1100, 66, 10, 5)], CANCELS_SCHEMA).write.parquet(f"{src}/CANCELS/d")
    import_dataset(spark, catalog, [src], tables=["ORDERS", "CANCELS"], layout=layout)  # the default target
    row = catalog.dataset("EF02_ORDERS")
    assert row["filepath"].startswith(f"{workdir}/catalog/files/import-")
    assert spark.read.parquet(row["filepath"]).count() == len(ORDERS)


def test_import_write_failure_records_nothing(spark, workdir):
    src = f"{workdir}/in/EF02.h5"
    _book(spark, src, ORDERS)
    catalog = Catalog(spark, f"{workdir}/catalog")
    with pytest.raises(CatalogError, match="cannot write"):
        import_dataset(spark, catalog, [src], "nosuchfs://bucket", tables=["ORDERS"])
    assert catalog.datasets().count() == 0


def test_missing_columns_and_bad_text_fail_the_import(spark, workdir):
    catalog = Catalog(spark, f"{workdir}/catalog")
    spark.range(3).write.parquet(f"{workdir}/in/AA01.h5/ORDERS/d")
    with pytest.raises(CatalogError, match="missing columns"):
        import_dataset(spark, catalog, [f"{workdir}/in/AA01.h5"], tables=["ORDERS"])
    for n, line in enumerate(("1,1,1,1000,1250,66,abc,5,0,,,1", "1,1,1,1000,1250,66,10,99999999999,0,,,1",
                              "id,ref,ob_id,created,destroyed,side,price,quantity,is_round,past_id,new_id,p_id")):
        src = f"{workdir}/in/BB0{n}.csv"
        os.makedirs(f"{src}/ORDERS")
        with open(f"{src}/ORDERS/part.csv", "w") as fh:
            fh.write(line + "\n")
        with pytest.raises(CatalogError):
            import_dataset(spark, catalog, [src], fmt="csv", tables=["ORDERS"])
    assert catalog.datasets().count() == 0


def test_import_deals_a_large_source_over_tasks(spark, workdir):
    import glob

    src = f"{workdir}/in/HOT1.h5"
    rows = [(k, 1, 1, 1000 + k, 0, 66, 10, 5, 0, None, None, 1) for k in range(4000)]
    spark.createDataFrame(rows, ORDERS_SCHEMA).coalesce(1).write.parquet(f"{src}/ORDERS/d")
    catalog = Catalog(spark, f"{workdir}/catalog")
    path = import_dataset(spark, catalog, [src], tables=["ORDERS"], partitions=4)["HOT1_ORDERS"]
    assert len(glob.glob(f"{path}/*.parquet")) == 4 and spark.read.parquet(path).count() == 4000


def test_every_missing_name_is_reported(spark, workdir):
    catalog = Catalog(spark, f"{workdir}/catalog")
    names = [f"nowhere_{i:02d}" for i in range(30)]
    with pytest.raises(CatalogError) as caught:
        catalog.lookup(names)
    assert all(n in str(caught.value) for n in names)


def test_bulk_record_and_compaction(spark, workdir):
    catalog = Catalog(spark, f"{workdir}/catalog")
    rows = spark.createDataFrame([("x1", "p/1"), ("x2", "p/2")], "name string, filepath string")
    catalog.record_datasets(rows)
    with pytest.raises(CatalogError, match="x1"):
        catalog.record_datasets(rows.limit(1))
    with pytest.raises(CatalogError):
        catalog.record_datasets(spark.createDataFrame([("y", "a"), ("y", "b")], "name string, filepath string"))
    catalog.drop_dataset("x2")
    moved = catalog.compact(f"{workdir}/compacted")
    assert [r["name"] for r in moved.list_datasets().collect()] == ["x1"]
    moved.create_dataset("x2", "p/3", "")
    assert moved.dataset("x2")["filepath"] == "p/3"


def test_compaction_writes_files_by_rows(spark, workdir):
    catalog = Catalog(spark, f"{workdir}/catalog")
    catalog.record_datasets(spark.range(200).selectExpr("concat('d', id) AS name", "concat('p/', id) AS filepath"))
    moved = catalog.compact(f"{workdir}/compacted", file_rows=70)
    files = spark.read.parquet(moved.path("datasets")).inputFiles()
    assert len(files) == 3
    assert sorted(r["name"] for r in moved.list_datasets().collect()) == sorted(f"d{i}" for i in range(200))
    whole = catalog.compact(f"{workdir}/whole")
    assert len(spark.read.parquet(whole.path("datasets")).inputFiles()) == 1


def test_search_treats_a_backslash_as_itself(spark):
    from quoteline.operators.catalog import search_modules

    names = spark.createDataFrame([("a\\b",), ("ab",), ("A\\Bc",)], "name string")
    assert sorted(r["name"] for r in search_modules(names, "a\\b").collect()) == ["A\\Bc", "a\\b"]


def test_sql_over_leaves_no_view(spark):
    from quoteline.plans.runner import sql_over

    spark.range(3).createOrReplaceTempView("ORDERS")
    got = sql_over(spark, {"ORDERS": spark.range(10)}, "SELECT count(*) AS n FROM {ORDERS} WHERE id >= :low", {"low": 4})
    assert got.first()["n"] == 6 and spark.table("ORDERS").count() == 3
    spark.catalog.dropTempView("ORDERS")


def _many_sources(spark, folder, sizes):
    """Sources of the given numbers of rows, laid out by one write."""
    rows = [(k, 1, 1, 1000 + k, 0, 66, 10, 5, 0, None, None, 1, name) for name, n in sizes.items() for k in range(n)]
    columns = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in ORDERS_SCHEMA.fields] + ["src string"])
    spark.createDataFrame(rows, columns).coalesce(3).write.partitionBy("src").parquet(f"{folder}/all")
    for name in sizes:
        os.makedirs(f"{folder}/{name}.h5/ORDERS")
        os.rename(f"{folder}/all/src={name}", f"{folder}/{name}.h5/ORDERS/d")
    return [f"{folder}/{name}.h5" for name in sizes]


def _files(path):
    import glob

    return len(glob.glob(f"{path}/*.parquet"))


def test_dealt_import_writes_few_files_a_source(spark, workdir):
    """A source with half of the rows is spread over half of the tasks, each small one is one file."""
    sizes = {f"S{i:02d}": 20 for i in range(30)} | {"HOT1": 600}
    catalog = Catalog(spark, f"{workdir}/catalog")
    written = import_dataset(spark, catalog, _many_sources(spark, f"{workdir}/in", sizes), tables=["ORDERS"], partitions=8)
    assert {n: _files(p) for n, p in written.items()} == {f"{s}_ORDERS": 4 if s == "HOT1" else 1 for s in sizes}
    for s, n in sizes.items():
        assert spark.read.parquet(catalog.dataset(f"{s}_ORDERS")["filepath"]).count() == n


def test_rebalanced_import_splits_large_and_joins_small_sources(spark, workdir):
    sizes = {f"S{i:02d}": 20 for i in range(12)} | {"HOT1": 20_000}
    sources = _many_sources(spark, f"{workdir}/in", sizes)
    # a file is a task here, as Spark splits a large exchange by the tasks that have written it
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.files.maxPartitionBytes": "20k",
                "spark.sql.files.openCostInBytes": "20k"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        written = import_dataset(spark, Catalog(spark, f"{workdir}/catalog"), sources, tables=["ORDERS"])
    finally:
        for key in settings:
            spark.conf.unset(key)
    files = {n: _files(p) for n, p in written.items()}
    assert files.pop("HOT1_ORDERS") > 1 and set(files.values()) == {1}
    assert spark.read.parquet(written["HOT1_ORDERS"]).count() == 20_000


def test_import_jobs_do_not_grow_with_the_sources(spark, workdir):
    tracker = spark.sparkContext.statusTracker()

    def jobs(n):
        group = f"import-{n}-{os.path.basename(workdir)}"
        sources = _many_sources(spark, f"{workdir}/in{n}", {f"N{n}x{i}": 3 for i in range(n)})
        catalog = Catalog(spark, f"{workdir}/catalog{n}")
        spark.sparkContext.setJobGroup(group, "import")
        try:
            written = import_dataset(spark, catalog, sources, tables=["ORDERS"])
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(written) == n and catalog.datasets().count() == n
        return len(tracker.getJobIdsForGroup(group))

    # one job more than that: Spark lists more than 32 folders with a job of its own
    few, many = jobs(2), jobs(60)
    assert many <= few + 4


def test_import_finds_a_column_that_single_files_lack(spark, workdir):
    sources = _many_sources(spark, f"{workdir}/in", {"AA": 3, "BB": 3})
    spark.read.parquet(f"{sources[1]}/ORDERS/d").drop("price").write.parquet(f"{sources[1]}/ORDERS/e")
    catalog = Catalog(spark, f"{workdir}/catalog")
    with pytest.raises(CatalogError, match="missing columns .*price.*BB.h5/ORDERS/e"):
        import_dataset(spark, catalog, sources, tables=["ORDERS"])
    assert catalog.datasets().count() == 0


def test_import_takes_integers_of_different_widths(spark, workdir):
    sources = _many_sources(spark, f"{workdir}/in", {"AA": 3, "BB": 2})
    narrow = spark.read.parquet(f"{sources[1]}/ORDERS/d")
    narrow.selectExpr(*(f"cast({c} as bigint) as {c.upper()}" for c in narrow.columns)).write.parquet(f"{workdir}/in/CC.h5/ORDERS/d")
    written = import_dataset(spark, Catalog(spark, f"{workdir}/catalog"), [*sources, f"{workdir}/in/CC.h5"], tables=["ORDERS"])
    back = spark.read.parquet(written["CC_ORDERS"])
    assert back.schema == ORDERS_SCHEMA and sorted(r["id"] for r in back.collect()) == [0, 1]


def test_sources_without_rows_share_an_empty_dataset(spark, workdir):
    sources = _many_sources(spark, f"{workdir}/in", {"AA": 3})
    for name in ("E1", "E2"):
        spark.createDataFrame([], ORDERS_SCHEMA).write.parquet(f"{workdir}/in/{name}.h5/ORDERS/d")
        sources.append(f"{workdir}/in/{name}.h5")
    catalog = Catalog(spark, f"{workdir}/catalog")
    import_dataset(spark, catalog, sources, tables=["ORDERS"])
    for name, n in (("AA", 3), ("E1", 0), ("E2", 0)):
        back = spark.read.parquet(catalog.dataset(f"{name}_ORDERS")["filepath"])
        assert back.schema == ORDERS_SCHEMA and back.count() == n


def test_every_missing_source_folder_is_reported(spark, workdir):
    sources = _many_sources(spark, f"{workdir}/in", {"AA": 1, "BB": 1, "CC": 1})
    with pytest.raises(CatalogError) as caught:
        import_dataset(spark, Catalog(spark, f"{workdir}/catalog"), sources, tables=["ORDERS", "TRADES"])
    assert all(f"{s}/TRADES" in str(caught.value) for s in sources)


def test_second_of_two_writers_is_refused(spark, workdir):
    """Both check the name while it is free; the one that records later is told that it is taken."""
    df = spark.createDataFrame(ORDERS, ORDERS_SCHEMA)
    one, two = Catalog(spark, f"{workdir}/catalog"), Catalog(spark, f"{workdir}/catalog")
    register_builtin_modules(one)
    one.create_dataset("parent", "p", "")
    known = two.known(["a", "parent"], ["EventCount"])  # the second writer's check
    version = two.version("datasets")
    two.check_new_datasets(["b"])
    save_features(one, df, f"{workdir}/one", "a", "EventCount", {}, ["parent"])
    one.create_datasets([dict(name="b", filepath="b1", schema="")])
    with pytest.raises(CatalogError, match="name taken: a"):
        save_features(two, df, f"{workdir}/two", "a", "EventCount", {}, ["parent"], known=known)
    with pytest.raises(CatalogError, match="name taken: b"):
        two.create_datasets([dict(name="b", filepath="b2", schema="")], checked=version)
    with pytest.raises(CatalogError, match="name taken: EventCount"):
        two.register_module("EventCount", "x:y")
    assert two.dataset("a")["filepath"] == f"{workdir}/one/a.parquet" and two.dataset("b")["filepath"] == "b1"
    assert one.log("datasets").where("name in ('a', 'b')").count() == 2


def test_writers_take_turns(spark, workdir):
    from concurrent.futures import ThreadPoolExecutor

    def record(i):
        try:
            Catalog(spark, f"{workdir}/catalog").create_dataset("same", f"path{i}", "")
            return i
        except CatalogError:
            return None

    with ThreadPoolExecutor(4) as pool:
        winners = [i for i in pool.map(record, range(4)) if i is not None]
    catalog = Catalog(spark, f"{workdir}/catalog", lock_wait=0.2)
    assert len(winners) == 1 and catalog.dataset("same")["filepath"] == f"path{winners[0]}"
    other = Catalog(spark, f"{workdir}/catalog")
    with other.writing():
        with pytest.raises(CatalogError, match="being changed by"):
            catalog.create_dataset("late", "p", "")
    catalog.create_dataset("late", "p", "")
    # the lock of a writer that died
    assert other._create("gone", "_lock")
    catalog.break_lock()
    catalog.drop_dataset("late")


def test_snapshot_and_tail_give_the_same_state(spark, workdir):
    catalog = Catalog(spark, f"{workdir}/catalog")
    register_builtin_modules(catalog)
    df = spark.createDataFrame(ORDERS, ORDERS_SCHEMA)
    for name in ("a", "b", "c"):
        catalog.create_dataset(name, f"p/{name}", "")
    save_features(catalog, df, f"{workdir}/f", "feat", "EventCount", {"k": 1}, ["a", "b"])
    catalog.drop_dataset("c")

    def state():
        return (sorted((r["name"], r["id"], r["filepath"]) for r in catalog.datasets().collect()),
                sorted((r["name"], r["id"]) for r in catalog.analyses().collect()),
                sorted(map(tuple, catalog.lineage().collect())))

    before = state()
    assert catalog.generation() == 0 and catalog.snapshot() == 1 and state() == before
    old = {f for f in spark.read.parquet(catalog.path("datasets")).inputFiles()}
    assert not old & set(catalog.log("datasets").inputFiles())  # the earlier log is not read any more
    catalog.drop_dataset("b")
    catalog.drop_module("Liquid")
    catalog.create_dataset("c", "p/c2", "")
    with pytest.raises(CatalogError, match="name taken"):
        catalog.create_dataset("a", "p", "")
    catalog.record_datasets(spark.createDataFrame([("bulk", "p/bulk")], "name string, filepath string"))
    assert catalog.dataset("c")["filepath"] == "p/c2" and catalog.dataset("b") is None
    middle = state()
    assert [n for n, *_ in middle[0]] == ["a", "bulk", "c", "feat"] and len(middle[2]) == 1
    # a snapshot that died before its marker is never read, and the next one takes its place
    spark.createDataFrame(df.limit(1).collect(), df.schema).write.parquet(f"{workdir}/catalog/snapshot-2/datasets")
    assert state() == middle and catalog.snapshot() == 2 and state() == middle
    assert Catalog(spark, f"{workdir}/catalog").known(["a", "b"]).inputs(["a"])["a"]["filepath"] == "p/a"


def test_orphans_are_listed_and_written_over(spark, workdir, monkeypatch):
    from quoteline.sources.sinks import orphan_folders

    catalog = Catalog(spark, f"{workdir}/catalog")
    register_builtin_modules(catalog)
    df = spark.createDataFrame(ORDERS, ORDERS_SCHEMA)
    files = f"{workdir}/files"
    assert orphan_folders(catalog, files).count() == 0  # nothing there yet
    save_dataset(catalog, df, files, "orders", "/in/AB00.h5")
    save_dataset(catalog, df, f"file:{files}/", "trades", "/in/AB00.h5")
    with monkeypatch.context() as m:  # the run dies after the write
        m.setattr(Catalog, "create_datasets", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            save_features(catalog, df, files, "feat", "EventCount", {}, ["AB00_ORDERS"])
        with pytest.raises(KeyboardInterrupt):
            import_source = f"{workdir}/in/EF02.h5"
            _book(spark, import_source, ORDERS)
            import_dataset(spark, catalog, [import_source], files, tables=["ORDERS"])
    found = {r["folder"]: r for r in orphan_folders(catalog, files).collect()}
    lost = [f for f in found if f.startswith(f"{files}/import-") and f.endswith("/ORDERS/identifier=EF02")]
    assert len(lost) == 1 and set(found) == {f"{files}/feat.parquet", lost[0]}
    assert all(r["files"] > 0 and r["bytes"] > 0 for r in found.values())
    with pytest.raises(RuntimeError, match="cannot write"):
        save_features(catalog, df, files, "feat", "EventCount", {}, ["AB00_ORDERS"])
    path = save_features(catalog, df.limit(2), files, "feat", "EventCount", {}, ["AB00_ORDERS"], over_orphan=True)
    assert spark.read.parquet(path).count() == 2
    assert [r["folder"] for r in orphan_folders(catalog, files).collect()] == lost
    # what is recorded is never written over
    catalog.create_dataset("elsewhere", f"file:{files}/other.parquet/part", "")
    for name in ("other",):
        with pytest.raises(RuntimeError, match="a recorded dataset lies there"):
            save_features(catalog, df, files, name, "EventCount", {}, ["AB00_ORDERS"], over_orphan=True)
    catalog.drop_dataset("AB00_TRADES")
    assert f"{files}/AB00/AB00_TRADES.parquet" in {r["folder"] for r in orphan_folders(catalog, files).collect()}


def test_more_rows_take_more_writing_tasks(spark, monkeypatch):
    from quoteline.sources import importing

    monkeypatch.setattr(importing, "TASK_ROWS", 500)
    rows = spark.range(10_000).selectExpr("IF(id % 3 = 0, 'a', 'b') AS identifier", "id")
    dealt = importing.deal_by_source(rows, 4)
    sizes = dealt.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert sum(sizes) == 10_000 and max(sizes) <= 2 * 500 + 100  # two sources may share a task
    assert dealt.distinct().count() == 10_000
    assert importing.deal_by_source(rows.limit(1_500), 4).rdd.getNumPartitions() == 4
