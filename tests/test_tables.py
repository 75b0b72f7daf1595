import pytest
from pyspark.sql import functions as F

from docfold.sources import tables as T
from docfold.specs import Column, TableSpec
from tests.conftest import rows
from tests.test_landing import BROKEN

COLUMNS = (
    Column("id", "bigint", required=True),
    Column("name", width=5),
    Column("loaded", "timestamp_ntz", default="localtimestamp()"),
)
PLAIN = TableSpec("plain", COLUMNS, ("id",))
RANGED = TableSpec("ranged", COLUMNS, ("id",), ranges=4)
BUCKETED = TableSpec("bucketed", COLUMNS, ("id",), buckets=4)
SLICED = TableSpec("sliced", COLUMNS, ("id",), slices=4)


@pytest.fixture
def db(spark, request):
    name = f"db_{request.node.name.split('[')[0]}"
    T.create_database(spark, name)
    return name


def frame(spark, data):
    return spark.createDataFrame(data, "id bigint, name string")


def test_create_replace_and_default(spark, db):
    T.create_table(spark, db, PLAIN)
    assert T.scan(spark, db, "plain").count() == 0
    T.replace_table(spark, db, PLAIN, frame(spark, [(1, "a"), (2, None)]))
    stored = T.scan(spark, db, "plain")
    assert rows(stored.select("id", "name")) == [(1, "a"), (2, None)]
    assert stored.where("loaded is null").count() == 0
    T.create_table(spark, db, PLAIN)
    assert T.scan(spark, db, "plain").count() == 0 and T.versions(spark, db, "plain") == [3]


@pytest.mark.parametrize("bad", [(None, "a"), (1, "too long")])
def test_refused_rows_leave_the_old_version(spark, db, bad):
    T.create_table(spark, db, PLAIN)
    T.replace_table(spark, db, PLAIN, frame(spark, [(7, "old")]))
    before = T.versions(spark, db, "plain")
    with pytest.raises(BROKEN):
        T.replace_table(spark, db, PLAIN, frame(spark, [bad]))
    assert T.versions(spark, db, "plain") == before
    assert rows(T.scan(spark, db, "plain").select("id", "name")) == [(7, "old")]


@pytest.mark.parametrize("spec", [PLAIN, BUCKETED, SLICED, RANGED], ids=lambda s: s.name)
def test_upsert_and_insert_only(spark, db, spec):
    T.create_table(spark, db, spec)
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    T.upsert_table(spark, db, spec, frame(spark, [(1, "a"), (2, "b")]).withColumn("loaded", stamp))
    reader = T.scan(spark, db, spec.name)
    T.upsert_table(spark, db, spec, frame(spark, [(2, None), (3, "c")]).withColumn("loaded", stamp))
    assert rows(T.scan(spark, db, spec.name).select("id", "name")) == [(1, "a"), (2, None), (3, "c")]
    assert rows(reader.select("id", "name")) == [(1, "a"), (2, "b")]
    T.insert_only_table(spark, db, spec, frame(spark, [(3, "x"), (4, "d")]).withColumn("loaded", stamp))
    assert rows(T.scan(spark, db, spec.name).select("id", "name")) == [(1, "a"), (2, None), (3, "c"), (4, "d")]
    T.upsert_table(spark, db, spec, frame(spark, [(4, "D")]), update_cols=["name"])
    assert rows(T.scan(spark, db, spec.name).where("id = 4").select("name")) == [("D",)]


def test_bucketed_merge_does_not_shuffle_the_stored_side(spark, db):
    from docfold.operators.merge import upsert

    T.create_table(spark, db, BUCKETED)
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    T.replace_table(spark, db, BUCKETED, frame(spark, [(i, "a") for i in range(50)]).withColumn("loaded", stamp))
    source = frame(spark, [(1, "b")]).withColumn("loaded", stamp).repartition(4, "id")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = upsert(T.scan(spark, db, "bucketed"), source, ["id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    stored = plan[plan.index("Join"):]
    assert "Bucketed: true" in stored
    left = stored[: stored.index("Bucketed: true")]
    assert "Exchange" not in left


def test_old_versions(spark, db):
    T.create_table(spark, db, PLAIN)
    for i in range(12):
        T.replace_table(spark, db, PLAIN, frame(spark, [(i, "a")]))
    assert T.versions(spark, db, "plain") == list(range(1, 14))
    T.drop_old_versions(spark, db, PLAIN, keep=2)
    assert T.versions(spark, db, "plain") == [12, 13]
    assert rows(T.scan(spark, db, "plain").select("id")) == [(11,)]


def test_sliced_merge_rewrites_only_what_it_touches(spark, db):
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    spec = TableSpec("narrow", COLUMNS, ("id",), slices=16)
    T.replace_table(spark, db, spec, frame(spark, [(i, "a") for i in range(200)]).withColumn("loaded", stamp))

    before = set(T.files(spark, db, "narrow"))
    T.upsert_table(spark, db, spec, frame(spark, [(7, "b")]).withColumn("loaded", stamp))
    after = set(T.files(spark, db, "narrow"))
    assert len(before) == 16 and len(before - after) == len(after - before) == 1
    stored = {r.id: r.name for r in T.scan(spark, db, "narrow").collect()}
    assert {r.id: r.name for r in spark.table(f"{db}.narrow").collect()} == stored
    assert stored == {i: "b" if i == 7 else "a" for i in range(200)}
    with pytest.raises(BROKEN):
        T.upsert_table(spark, db, spec, frame(spark, [(7, "too long")]).withColumn("loaded", stamp))
    assert {r.id: r.name for r in T.scan(spark, db, "narrow").collect()} == stored
    T.upsert_table(spark, db, spec, frame(spark, []).withColumn("loaded", stamp))
    assert T.scan(spark, db, "narrow").columns == ["id", "name", "loaded"]


def test_one_layout_per_table():
    with pytest.raises(ValueError):
        TableSpec("t", COLUMNS, ("id",), buckets=2, slices=2)


def test_key_checks_on_a_bucketed_table_need_no_shuffle(spark, db):
    from docfold.operators.checks import run_suite, unique

    T.create_table(spark, db, BUCKETED)
    T.replace_table(spark, db, BUCKETED, frame(spark, [(i % 40, "a") for i in range(50)]))
    results = run_suite([unique(T.scan(spark, db, "bucketed"), ["id"], "PK", "bucketed")])
    assert "hashpartitioning(id" not in results._jdf.queryExecution().executedPlan().toString()
    assert results.first().measure == 20


def test_parts_follow_the_size_of_the_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x" * 1000)
    assert T.parts_for(spark, str(tmp_path), part_bytes=90) == 12
    assert T.parts_for(spark, str(tmp_path)) == 8


@pytest.mark.parametrize("filled", [False, True])
@pytest.mark.parametrize("spec", [PLAIN, BUCKETED, SLICED, RANGED], ids=lambda s: s.name)
def test_merges_behave_alike_on_empty_and_filled_tables(spark, db, spec, filled):
    spec = TableSpec(spec.name, (*COLUMNS[:2], Column("loaded", default="'new'")), ("id",), buckets=spec.buckets, slices=spec.slices, ranges=spec.ranges)
    T.create_table(spark, db, spec)
    stored = [(9, "old", "then")] if filled else []
    if filled:
        T.replace_table(spark, db, spec, spark.createDataFrame(stored, "id bigint, name string, loaded string"))
    with pytest.raises(ValueError, match="nope"):
        T.upsert_table(spark, db, spec, frame(spark, [(1, "a")]), update_cols=["nope"])
    with pytest.raises(ValueError, match="no column id"):
        T.upsert_table(spark, db, spec, spark.createDataFrame([("a",)], "name string"))
    T.upsert_table(spark, db, spec, frame(spark, [(1, "a")]))
    T.insert_only_table(spark, db, spec, frame(spark, [(2, "b"), (1, "not taken")]))
    assert rows(T.scan(spark, db, spec.name)) == sorted([(1, "a", "new"), (2, "b", "new"), *stored])
    T.upsert_table(spark, db, spec, frame(spark, [(9, "kept")]))
    assert rows(T.scan(spark, db, spec.name).where("id = 9")) == [(9, "kept", "then" if filled else "new")]


@pytest.mark.parametrize("spec", [PLAIN, BUCKETED, SLICED, RANGED], ids=lambda s: s.name)
def test_repeated_stored_keys_are_all_updated(spark, db, spec):
    T.create_table(spark, db, spec)
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    T.replace_table(spark, db, spec, frame(spark, [(1, "a"), (1, "b"), (2, "x")]).withColumn("loaded", stamp))
    T.upsert_table(spark, db, spec, frame(spark, [(1, "new")]).withColumn("loaded", stamp))
    assert rows(T.scan(spark, db, spec.name).select("id", "name")) == [(1, "new"), (1, "new"), (2, "x")]


def test_lost_update_is_refused(spark, db):
    T.create_table(spark, db, PLAIN)
    base = T.versions(spark, db, "plain")[-1]
    T.replace_table(spark, db, PLAIN, frame(spark, [(1, "first")]))
    with pytest.raises(T.ConcurrentWriteError):
        T.replace_table(spark, db, PLAIN, frame(spark, [(1, "late")]), base=base)
    assert rows(T.scan(spark, db, "plain").select("id", "name")) == [(1, "first")]


def test_threads_merge_into_sliced_tables(spark, db):
    from concurrent.futures import ThreadPoolExecutor

    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    specs = [TableSpec(f"sliced{i}", COLUMNS[:2], ("id",), slices=4) for i in range(3)]
    for spec in specs:
        T.create_table(spark, db, spec)
        T.replace_table(spark, db, spec, frame(spark, [(i, "old") for i in range(40)]))
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda spec: T.upsert_table(spark, db, spec, frame(spark, [(3, "new"), (50, "more")])), specs))
    for spec in specs:
        assert rows(T.scan(spark, db, spec.name)) == sorted([*((i, "new" if i == 3 else "old") for i in range(40)), (50, "more")])
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def stamped(spark, data):
    return frame(spark, data).withColumn("loaded", F.lit("2024-01-01").cast("timestamp_ntz"))


@pytest.mark.parametrize("spec", [PLAIN, BUCKETED, SLICED, RANGED], ids=lambda s: s.name)
@pytest.mark.parametrize("late", ["replace", "upsert", "insert"])
def test_of_two_writers_with_one_base_one_is_refused(spark, db, spec, late, monkeypatch):
    """The second writer reads, merges and publishes while the first one writes; the first one must not hide its rows."""
    T.create_table(spark, db, spec)
    T.replace_table(spark, db, spec, stamped(spark, [(0, "z"), (1, "y")]))
    publish, done = T._publish, []

    def delayed(*args):
        if not done:
            done.append(True)
            T.upsert_table(spark, db, spec, stamped(spark, [(2, "B")]))
        return publish(*args)

    monkeypatch.setattr(T, "_publish", delayed)
    with pytest.raises(T.ConcurrentWriteError):
        if late == "replace":
            T.replace_table(spark, db, spec, stamped(spark, [(0, "z"), (1, "A")]), base=T.versions(spark, db, spec.name)[-1])
        elif late == "upsert":
            T.upsert_table(spark, db, spec, stamped(spark, [(1, "A")]))
        else:
            T.insert_only_table(spark, db, spec, stamped(spark, [(3, "C")]))
    want = [(0, "z"), (1, "y"), (2, "B")]
    for name in (spec.name, f"{spec.name}__v{T.versions(spark, db, spec.name)[-1]}"):
        assert rows(spark.table(f"{db}.{name}").select("id", "name")) == want
    T.upsert_table(spark, db, spec, stamped(spark, [(1, "A")]))
    assert rows(T.scan(spark, db, spec.name).select("id", "name")) == [(0, "z"), (1, "A"), (2, "B")]
    T.drop_old_versions(spark, db, spec, keep=1)
    left = [r.tableName for r in spark.sql(f"SHOW TABLES IN {db} LIKE '{spec.name}__d*'").collect()]
    assert sorted(left) == sorted(p.data for p in T.parts_of(spark, db, spec.name, T.versions(spark, db, spec.name)[-1]))


def test_a_writer_that_died_blocks_nobody(spark, db, monkeypatch):
    T.create_table(spark, db, PLAIN)
    T.replace_table(spark, db, PLAIN, stamped(spark, [(1, "a")]))
    data = T._declare(spark, db, PLAIN, T.versions(spark, db, "plain")[-1] + 1)  # and never publishes
    T.upsert_table(spark, db, PLAIN, stamped(spark, [(2, "b")]))
    assert rows(T.scan(spark, db, "plain").select("id")) == [(1,), (2,)]
    T.drop_old_versions(spark, db, PLAIN, keep=2)
    assert not spark.catalog.tableExists(f"{db}.{data}")


def test_threads_with_one_base_publish_once(spark, db):
    from concurrent.futures import ThreadPoolExecutor

    T.create_table(spark, db, PLAIN)
    T.replace_table(spark, db, PLAIN, stamped(spark, [(0, "z")]))

    def write(i):
        try:
            T.upsert_table(spark, db, PLAIN, stamped(spark, [(i, "new")]))
            return i
        except T.ConcurrentWriteError:
            return None

    with ThreadPoolExecutor(4) as pool:
        done = [i for i in pool.map(write, range(1, 5)) if i]
    assert done and rows(T.scan(spark, db, "plain").select("id")) == [(0,), *((i,) for i in sorted(done))]


def test_merge_rewrites_only_files_with_a_key_of_the_source(spark, db):
    spec = TableSpec("long", COLUMNS, ("id",), ranges=10)
    T.replace_table(spark, db, spec, stamped(spark, [(i, "a") for i in range(1000)]))
    before = set(T.files(spark, db, "long"))
    assert len(before) == 10
    T.upsert_table(spark, db, spec, stamped(spark, [(995, "b"), (2000, "c")]))
    after = set(T.files(spark, db, "long"))
    assert len(before - after) == 1 and len(after & before) == 9
    T.insert_only_table(spark, db, spec, stamped(spark, [(5, "no"), (3000, "d")]))
    assert after < set(T.files(spark, db, "long"))
    T.upsert_table(spark, db, spec, stamped(spark, [(2000, "e"), (995, "f")]), update_cols=["name"])
    stored = {r.id: r.name for r in T.scan(spark, db, "long").collect()}
    assert stored == {i: "a" for i in range(1000)} | {995: "f", 2000: "e", 3000: "d"}
    T.upsert_table(spark, db, spec, stamped(spark, [(i, "g") for i in range(0, 1000, 10)]))  # touches most: written anew
    assert len(T.parts_of(spark, db, "long", T.versions(spark, db, "long")[-1])) == 1
    assert T.scan(spark, db, "long").where("name = 'g'").count() == 100 and T.scan(spark, db, "long").count() == 1002


@pytest.mark.parametrize("spec", [PLAIN, SLICED], ids=lambda s: s.name)
def test_many_merges_stay_within_the_bound_on_parts(spark, db, spec, monkeypatch):
    monkeypatch.setattr(T, "MAX_PARTS", 3)
    T.create_table(spark, db, spec)
    for i in range(8):
        T.insert_only_table(spark, db, spec, stamped(spark, [(i, "a"), (i + 1, "b")]))
        assert len(T.parts_of(spark, db, spec.name, T.versions(spark, db, spec.name)[-1])) <= 3
    assert rows(T.scan(spark, db, spec.name).select("id")) == [(i,) for i in range(9)]


def test_rows_without_a_key_are_spread_over_slices(spark, db):
    spec = TableSpec("loose", (Column("id", "bigint"), Column("name")), ("id",), slices=8)
    T.create_table(spark, db, spec)
    T.replace_table(spark, db, spec, frame(spark, [(None, f"n{i}") for i in range(200)] + [(1, "a")]))
    assert len(T.files(spark, db, "loose")) == 8
    T.upsert_table(spark, db, spec, frame(spark, [(1, "b"), (None, "more")]))
    assert T.scan(spark, db, "loose").count() == 202
    assert rows(T.scan(spark, db, "loose").where("id = 1")) == [(1, "b")]
