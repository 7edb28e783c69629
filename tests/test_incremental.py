"""Batches merged into stored marts, against one run over everything."""

import random

import pytest
from pyspark.sql import functions as F

from plaudit.operators import cube as K, keys, seen, words as W
from plaudit.plans import incremental as I
from plaudit.plans.silver import to_silver
from plaudit.sources import snapshots
from plaudit.sources.raw import BRONZE_COLUMNS
from tests.conftest import plan

SCHEMA = ", ".join(f"{c} string" for c in BRONZE_COLUMNS)


def invented(seed, n=120):
    r = random.Random(seed)
    names = ["Steel Plate", "Blue Gizmo", "Gear Rod", "ring", None, "Ünlü"]
    row = lambda: (r.choice(names), r.choice(["?10.50", "1,200", "N/A", "99"]), r.choice("12345x"), r.choice(["Nan", "fine", None]), r.choice(["good thing", "bad bad thing", "!!", None, "so so phone"]))
    return [row() for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def state_of(version, rows):
    return {name: rows(version.read(name)) for name in I.STATE}


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "shop")


def test_batches_equal_one_run(spark, rows, root):
    first, second = invented(1), invented(2)
    second += first[:50] + second[:20]  # delivered before, and twice in one batch
    before = I.apply_batch(spark, root, frame(spark, first), "a")
    after = I.apply_batch(spark, root, frame(spark, second), "b")
    silver = to_silver(frame(spark, first + second))
    whole = I.deltas(silver)
    assert state_of(after, rows) == {name: rows(df.select(*after.read(name).columns)) for name, df in whole.items()}
    assert {n: after.read(n).schema for n in I.STATE} == {n: before.read(n).schema for n in I.STATE}
    assert rows(after.read("silver")) == rows(silver)
    assert rows(I.products_of(after, 2)) == rows(K.products(silver, 2)) and rows(I.cube_of(after)) == rows(K.published_cube(K.cube(silver)))
    distinct = set(first), set(second) - set(first)
    counts = {r["batch"]: (r["delivered"], r["distinct_rows"], r["added"]) for r in after.read("batches").collect()}
    assert counts == {"a": (len(first), len(distinct[0]), len(distinct[0])), "b": (len(second), len(set(second)), len(distinct[1]))}
    # the version before is still there, whole
    assert state_of(snapshots.at_version(spark, root, before.version), rows) == state_of(before, rows)


def test_old_rows_add_nothing_and_texts_are_not_read(spark, rows, root, monkeypatch):
    batch = invented(3)
    before = I.apply_batch(spark, root, frame(spark, batch), "a")
    read = []
    monkeypatch.setattr(snapshots.Snapshot, "read", lambda self, name, old=snapshots.Snapshot.read: read.append(name) or old(self, name))
    after = I.apply_batch(spark, root, frame(spark, batch[::-1]), "again")
    assert "silver" not in read and {"digests", "bloom", "cube"} <= set(read)
    assert after.version == before.version + 1 and state_of(after, rows) == state_of(before, rows)
    assert after.read("digests").count() == len(set(batch)) == before.read("digests").count()


def test_a_repeated_batch_is_merged_once(spark, rows, root):
    sink = I.batch_sink(root, "inbox")
    sink(frame(spark, invented(4)), 0)
    one = snapshots.latest(spark, root)
    sink(frame(spark, invented(4)), 0)
    assert snapshots.latest(spark, root) == one
    sink(frame(spark, invented(5)), 1)
    assert snapshots.latest(spark, root).batches == {"inbox-0", "inbox-1"}


def test_keys_stay(spark, root):
    I.apply_batch(spark, root, frame(spark, [r for r in invented(6) if r[0] != "Gear Rod"]), "a")
    old = {tuple(r)[1:]: r[0] for r in snapshots.latest(spark, root).read("product_keys").collect()}
    digests = {r["digest"]: r["row_key"] for r in snapshots.latest(spark, root).read("digests").collect()}
    after = I.apply_batch(spark, root, frame(spark, invented(7)), "b")
    new = {tuple(r)[1:]: r[0] for r in after.read("product_keys").collect()}
    assert old.items() <= new.items() and sorted(new.values()) == list(range(1, len(new) + 1)) and len(new) > len(old)
    later = {r["digest"]: r["row_key"] for r in after.read("digests").collect()}
    assert digests.items() <= later.items() and sorted(later.values()) == list(range(1, len(later) + 1))


def test_extended_keys_are_null_safe(spark, rows):
    members = lambda *x: spark.createDataFrame([(a, b, 1) for a, b in x], "name string, kind string, more int")
    one = keys.extend_keys(None, members(("b", None), ("a", "x"), ("a", "x")), ["name", "kind"], "key")
    two = keys.extend_keys(one, members(("b", None), (None, None), ("0", "y")), ["name", "kind"], "key")
    assert rows(two) == sorted([(1, "a", "x"), (2, "b", None), (3, None, None), (4, "0", "y")], key=repr)


def test_a_run_killed_between_tables_leaves_the_version_before(spark, rows, root, monkeypatch):
    I.apply_batch(spark, root, frame(spark, invented(8)), "a")
    before = snapshots.latest(spark, root)
    for killed_at in ("words", "silver", "manifests"):

        def write(df, path, *args, old=snapshots.write_table, **options):
            if killed_at in path:
                raise OSError("killed")
            old(df, path, *args, **options)

        with monkeypatch.context() as patch:
            patch.setattr(snapshots, "write_table", write)
            with pytest.raises(OSError):
                I.apply_batch(spark, root, frame(spark, invented(9)), "b")
        assert snapshots.latest(spark, root) == before
    # a manifest that was begun and not finished counts for nothing
    spark.range(1).write.parquet(f"{root}/manifests/v{before.version + 1:010d}")
    (marker,) = __import__("pathlib").Path(root).glob(f"manifests/v{before.version + 1:010d}/_SUCCESS")
    marker.unlink()
    assert snapshots.latest(spark, root) == before
    after = I.apply_batch(spark, root, frame(spark, invented(9)), "b")
    assert after.version == before.version + 2 and "b" in after.batches
    assert state_of(before, rows) == state_of(snapshots.at_version(spark, root, before.version), rows)


def test_empty_batches(spark, rows, root):
    empty = frame(spark, invented(1)).limit(0)
    one = I.apply_batch(spark, root, empty, "none")
    assert all(one.read(name).count() == 0 for name in ("silver", "digests", *I.STATE))
    two = I.apply_batch(spark, root, frame(spark, invented(2)), "some")
    three = I.apply_batch(spark, root, empty, "none again")
    assert state_of(two, rows) == state_of(three, rows) and two.read("silver").count() > 0
    with pytest.raises(KeyError):
        three.read("nothing")


def test_filter_never_misses_a_digest(spark, monkeypatch):
    digests = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    old, new = digests.limit(2000), digests
    for slots in (1, 7):
        stored = seen.bloom(old, slots)
        found = {r.digest for r in seen.maybe_seen(new, stored, slots).collect()}
        assert {r.digest for r in old.collect()} <= found and len(found) < 2100
        half = seen.merged_bloom(seen.bloom(old.limit(500), slots), stored)
        assert sorted(map(tuple, half.collect())) == sorted(map(tuple, stored.collect()))


def test_store_is_asked_by_bucket(spark, root):
    version = I.apply_batch(spark, root, frame(spark, invented(1)), "a")
    asked = spark.range(1).select(F.lit("x").alias("digest"))
    text = plan(seen.seen_before(asked, version.read("digests"), version.read("bloom")))
    assert "review_text" not in text and "bucket" in text
    one = snapshots.compact(I.apply_batch(spark, root, frame(spark, invented(2)), "b"), "digests", "bucket")
    assert len(one.tables["digests"]) == 1 and len(one.tables["silver"]) == 2
