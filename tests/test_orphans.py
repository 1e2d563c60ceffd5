import datetime as d
import random

from roadloom.operators.orphans import ReferenceLedger, orphan_cases
from tests.conftest import rows

T = [d.datetime(2024, 1 + k // 20, 1 + k % 20) for k in range(60)]


def tables(spark, node=(), way=(), relation=(), road=(), junction=(), member=(), conn=(), link=()):
    make = spark.createDataFrame
    return {
        "osm_node": make(list(node), "map_id long, node_id long, loaded_at timestamp_ntz, color string"), "osm_way": make(list(way), "map_id long, way_id long, loaded_at timestamp_ntz, deleted_at timestamp_ntz"),
        "osm_relation": make(list(relation), "map_id long, rel_id long, loaded_at timestamp_ntz, deleted_at timestamp_ntz"), "road": make(list(road), "map_id long, road_id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz"),
        "junction": make(list(junction), "map_id long, junction_id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz"),
        "osm_member": make(list(member), "member_id long, map_id long, mtype string, ref string, loaded_at timestamp_ntz"), "junction_connection": make(list(conn), "connection_id long, map_id long, connecting_road string, loaded_at timestamp_ntz"),
        "road_link": make(list(link), "link_id long, map_id long, element_type string, element_id string, loaded_at timestamp_ntz"),
    }


def test_reasons(spark):
    t = tables(
        spark,
        node=[(1, 5, T[3], None)], way=[(1, 5, T[0], None), (1, 6, T[0], None), (1, 6, T[9], T[8]), (1, 7, T[0], T[0]), (1, 7, T[9], None)], road=[(1, "08", T[0], None), (1, "9", T[8], None), (2, "10", T[0], None)],
        member=[(1, 1, "way", " 5", T[5]), (2, 1, " WAY", "6", T[5]), (3, 1, "way", "7", T[5]), (4, 1, "node", "5", T[1]), (5, 1, "node", "99", T[25]), (6, 1, "node", "x1", T[5]), (7, 1, None, "5", T[5]), (8, 1, "way", " ", T[5]), (9, 1, "way", "99", T[1]), (9, 1, "way", None, T[5])],
        conn=[(1, 1, "8", T[5]), (2, 1, "9", T[5]), (3, 1, "10", T[5]), (4, 1, "", T[5])], link=[(1, 1, "junction", "8", T[5]), (2, 1, "Road ", "0009", T[9]), (3, 1, "signal", "1", T[5])],
    )
    want = [
        ("osm_member", 2, "deleted", "2024-01"), ("osm_member", 4, "late", "2024-01"), ("osm_member", 5, "missing", "2024-02"), ("osm_member", 6, "missing", "2024-01"),
        ("junction_connection", 2, "late", "2024-01"), ("junction_connection", 3, "missing", "2024-01"), ("road_link", 1, "missing", "2024-01"), ("road_link", 3, "missing", "2024-01"),
    ]
    for steps in (1, 2, 5):
        assert rows(orphan_cases(spark, t, steps)) == sorted(want, key=str)


def test_empty(spark):
    assert orphan_cases(spark, tables(spark)).count() == 0


def test_late_files_in_any_order_and_reopening(spark):
    rng = random.Random(1)
    ways = [(1, rng.randint(1, 30), rng.choice(T), rng.choice([None, None, T[0]])) for _ in range(80)]
    ways = list({(m, w, at): (m, w, at, gone) for m, w, at, gone in ways}.values())
    members = [(i, 1, "way", str(1 if i % 3 else rng.randint(1, 40)), rng.choice(T)) for i in range(90)]
    whole = tables(spark, way=ways, member=members)
    want = rows(orphan_cases(spark, whole, 1))
    from roadloom.operators.orphans import map_parents, map_references

    ledger = ReferenceLedger(spark)
    rng.shuffle(ways), rng.shuffle(members)
    for k in range(3):
        part = tables(spark, way=ways[k::3], member=members[k::3])
        ledger.advance(map_parents(part), map_references(part))
    from pyspark.sql import functions as F

    assert rows(ledger.cases().select("ref_table", "ref_id", "reason", F.date_format("loaded_at", "yyyy-MM"))) == want
    assert sum(r["orphans"] for r in ledger.snapshot().collect()) == len(want)


def test_a_step_reads_what_its_keys_touch(spark, tmp_path, monkeypatch):
    from roadloom import storage
    from roadloom.operators.orphans import map_parents, map_references

    n = 6000
    ways = [(1, k, T[0], None) for k in range(1, n)]
    members = [(k, 1, "way", str(k * 2), T[3]) for k in range(1, n)]  # half of them missing
    ledger = ReferenceLedger(spark, str(tmp_path / "state"), buckets=128)
    part = tables(spark, way=ways, member=members)
    ledger.advance(map_parents(part), map_references(part), batch=0)
    assert ledger.cases().count() == n // 2
    seen, real = [], storage.Tables.read

    def read(self, schema, table, name, buckets=None):
        df = real(self, schema, table, name, buckets)
        if name == "1" and table != "counts":
            seen.append(df.inputFiles())
        return df

    monkeypatch.setattr(storage.Tables, "read", read)
    # five missing ways arrive, three ways are deleted, two references are new
    part = tables(spark, way=[(1, n + 2 * k, T[5], None) for k in range(5)] + [(1, 2 * k, T[9], T[9]) for k in (1, 2, 3)], member=[(n, 1, "way", "4", T[9]), (n + 1, 1, "way", "9", T[9])])
    ledger.advance(map_parents(part), map_references(part), batch=1)
    monkeypatch.undo()
    paths = {f for files in seen for f in files}
    touched = sum(spark.read.parquet(f).count() for f in paths)
    total = sum(spark.read.parquet(str(tmp_path / "state" / t / "1")).count() for t in ("parents", "refs", "uses"))
    assert 0 < touched < total / 5
    got = {r["ref_id"]: r["reason"] for r in ledger.cases().collect()}
    assert {k: got.get(k) for k in (1, 2, 3, n, n + 1)} == {1: "deleted", 2: "deleted", 3: "deleted", n: "deleted", n + 1: None}
    assert {got[n // 2 + k] for k in range(5)} == {"late"} and got[n // 2 + 5] == "missing"
    assert sum(r["orphans"] for r in ledger.snapshot().collect()) == len(got)
    # a batch that comes again changes nothing, and a ledger opened anew goes on from the last whole step
    ledger.advance(map_parents(part), map_references(part), batch=1)
    assert ledger.step == 2
    again = ReferenceLedger(spark, str(tmp_path / "state"))
    assert again.buckets == 128 and again.batch == 1 and rows(again.cases()) == rows(ledger.cases())
    part = tables(spark, way=[(1, 2, T[12], None)], member=[(n, 1, "way", None, T[12])])
    again.advance(map_parents(part), map_references(part), batch=2)
    got = {r["ref_id"]: r["reason"] for r in again.cases().collect()}
    assert got.get(1) is None and got.get(n) is None and got[2] == "deleted"
    assert sorted({r["step"] for r in again.snapshots().collect()}) == [1, 2, 3]


def test_many_steps_with_folding(spark, monkeypatch):
    from roadloom.operators import orphans

    monkeypatch.setattr(orphans, "COMPACT", 3)
    rng = random.Random(8)
    ways = list({(1, w, at): (1, w, at, gone) for w, at, gone in ((rng.randint(1, 12), rng.choice(T), rng.choice([None, None, T[0]])) for _ in range(60))}.values())
    members = list({(i, at): (i, 1, rng.choice(["way", "way", None, "node"]), rng.choice(["1", "7", "15", "x", None]), at) for i, at in ((rng.randint(1, 25), rng.choice(T)) for _ in range(80))}.values())
    rng.shuffle(ways), rng.shuffle(members)
    ledger = ReferenceLedger(spark, buckets=4)
    for k in range(8):
        part = tables(spark, way=ways[k::8], member=members[k::8])
        ledger.advance(orphans.map_parents(part), orphans.map_references(part))
    want = rows(orphan_cases(spark, tables(spark, way=ways, member=members), 1))
    from pyspark.sql import functions as F

    assert rows(ledger.cases().select("ref_table", "ref_id", "reason", F.date_format("loaded_at", "yyyy-MM"))) == want
    assert max(map(len, ledger.live.values())) < 4
    assert sum(r["orphans"] for r in ledger.snapshot().collect()) == len(want)


def test_null_keys(spark):
    t = tables(spark, way=[(None, 5, T[0], None), (1, None, T[0], None)], member=[(None, 1, "way", "5", T[1]), (3, None, "way", "5", T[1]), (4, 1, "way", "5", None)])
    want = [("osm_member", None, "missing", "2024-01"), ("osm_member", 3, "missing", "2024-01"), ("osm_member", 4, "missing", None)]
    for steps in (1, 3):
        assert rows(orphan_cases(spark, t, steps)) == sorted(want, key=str)


def test_folding_is_by_hash_and_takes_the_greatest_row(spark):
    from roadloom.operators.orphans import PARENT_SCHEMA, fold_parents

    rng = random.Random(3)
    data = [("way", 1, rng.randint(1, 60), rng.choice([None, *T[:3]]), rng.choice([None, *T[:3]]), rng.choice([True, False, None])) for _ in range(200)]
    df = spark.createDataFrame(data, PARENT_SCHEMA).repartition(3)
    want = {}
    for key in {r[:3] for r in data}:
        own = [r[3:] for r in data if r[:3] == key]
        _, last, gone = max(own, key=lambda r: (r[1] is not None, r[1] or T[0], r[2] is not None, r[2] or False))
        want[key] = (min((r[0] for r in own if r[0]), default=None), last, gone)
    for got in (fold_parents(df), fold_parents(fold_parents(df).unionByName(df))):
        assert {tuple(r[:3]): tuple(r[3:]) for r in got.collect()} == want
    plan = fold_parents(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_a_later_step_reads_its_records_once(spark, monkeypatch):
    from roadloom import storage
    from roadloom.operators.orphans import map_parents, map_references

    part = tables(spark, way=[(1, k, T[0], None) for k in range(9)], member=[(k, 1, "way", str(2 * k), T[1]) for k in range(9)])
    ledger = ReferenceLedger(spark)
    ledger.advance(map_parents(part), map_references(part))
    reads, plans, real = {}, {}, storage.Tables.write

    def write(self, df, table, name):
        plan = df._jdf.queryExecution()
        reads[table], plans[table] = plan.optimizedPlan().collectLeaves().size(), plan.executedPlan().toString()
        real(self, df, table, name)

    monkeypatch.setattr(storage.Tables, "write", write)
    part = tables(spark, way=[(1, 2, T[5], T[5]), (1, 10, T[5], None)], member=[(3, 1, "way", "5", T[6]), (20, 1, "way", "99", T[6])])
    ledger.advance(map_parents(part), map_references(part))
    assert reads["parents"] <= 6  # five tables that arrive, one part of the state
    assert "SortAggregate" not in plans["uses"]  # one part holds a use once
    want = {1: "deleted", 5: "late", 6: "missing", 7: "missing", 8: "missing", 20: "missing"}
    assert {r["ref_id"]: r["reason"] for r in ledger.cases().collect()} == want
    assert sum(r["orphans"] for r in ledger.snapshot().collect()) == len(want)
