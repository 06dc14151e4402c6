"""Version numbers are claimed, not taken over; bases keep what readers open small and lose no row."""

import os
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target

from tableload.plans import ledger
from tableload.session import take_name


def one(spark, i):
    return spark.range(i, i + 1)


def values(df):
    return sorted(r[0] for r in df.collect())


def bases(warehouse):
    folder = f"{warehouse.root}/bases/ns=ns/table=t"
    return sorted(int(n.split("=")[1]) for n in os.listdir(folder) if n.startswith("base=")) if os.path.isdir(folder) else []


def test_bases_and_tail_hold_every_version(spark, warehouse, monkeypatch):
    monkeypatch.setattr(ledger, "SPAN", 3)
    table = warehouse.table("ns", "t")
    for i in range(14):
        table.load(one(spark, i), load_id=f"l{i}")
    assert [e.seq for e in table.entries()] == list(range(1, 15))
    assert bases(warehouse)[-1] == 12 and len(bases(warehouse)) == ledger.BASES
    assert len(ledger._spans(spark, warehouse.root, "ns", "t")[1]) == 2, "one base and one span"
    assert values(table.read()) == list(range(14)) and values(table.read(as_of=4)) == [0, 1, 2, 3]
    assert values(table.read(since=10)) == [10, 11, 12, 13] and table.load(one(spark, 99), load_id="l2").seq == 3
    assert [(r["table"], r["rows"]) for r in warehouse.list_tables("ns").collect()] == [("t", 14)]


def test_a_number_whose_writer_may_live_holds_the_base_back(spark, warehouse, monkeypatch):
    monkeypatch.setattr(ledger, "SPAN", 3)
    table = warehouse.table("ns", "t")
    for i in range(2):
        table.load(one(spark, i))
    entry = table.entries()[-1]
    assert ledger.claim(spark, warehouse.root, "ns", "t", 3) == 3  # a writer that is slow to publish
    for i in range(2, 7):
        table.load(one(spark, i))
    assert bases(warehouse) == [3] and [e.seq for e in table.entries()] == [1, 2, 4, 5, 6, 7, 8]
    ledger.publish(spark, warehouse.root, ledger.replace(entry, seq=3, load_id="late", op="alter", rows=0))
    assert 3 in [e.seq for e in table.entries()]
    table.load(one(spark, 7))
    assert bases(warehouse)[-1] == 9 and values(table.read()) == list(range(8))


def test_a_number_of_a_dead_writer_stays_unused(spark, warehouse, monkeypatch):
    monkeypatch.setattr(ledger, "SPAN", 3)
    table = warehouse.table("ns", "t")
    table.load(one(spark, 0))
    number = ledger.claim(spark, warehouse.root, "ns", "t", 2)
    old = time.time() - 2 * ledger.CLAIM_SECONDS
    os.utime(f"{warehouse.root}/claims/ns=ns/table=t/span=0/{number}", (old, old))
    for i in range(1, 5):
        table.load(one(spark, i))
    assert bases(warehouse)[-1] == 6 and [e.seq for e in table.entries()] == [1, 3, 4, 5, 6]


def test_a_name_is_taken_once(spark, tmp_path):
    take = inheritable_thread_target(spark)(lambda i: take_name(spark, f"{tmp_path}/names/{i % 5}"))
    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(take, range(60))) == 5


def test_writers_at_a_time_take_numbers_of_their_own(spark, warehouse):
    table = warehouse.table("ns", "t")
    table.load(one(spark, 100))
    load = inheritable_thread_target(spark)(lambda i: table.load(one(spark, i), load_id=f"w{i}"))
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(load, range(6)))
    assert [e.seq for e in table.entries()] == list(range(1, 8)) and values(table.read()) == [0, 1, 2, 3, 4, 5, 100]


def test_two_attempts_of_one_load_count_once(spark, warehouse):
    table = warehouse.table("ns", "t")
    entry = table.load(one(spark, 1), load_id="x")
    ledger.publish(spark, warehouse.root, ledger.replace(entry, seq=2), "x~again")
    assert values(table.read()) == [1] and table.count(exact=False) == 1


def test_many_versions_cost_little_more_than_few(spark, warehouse):
    """Loads into, and ledger reads of, a table with 2,000 versions take less than twice the time of one with 20."""
    took = {}
    for versions in (20, 2000):
        table = warehouse.table("ns", f"t{versions}")
        first = table.load(one(spark, 0), load_id="first")
        rows = ledger.ledger_frame(spark, warehouse.root, "ns", table.name)
        more = rows.join(spark.range(2, versions + 1)).selectExpr(
            "namespace", "table", "id as seq", "concat('tag-', id) as load_id", "'tag' as op", "0L as rows", "1L as total_rows", "path", "props", "published_at", "schema_json", "partition_by"
        )
        span = versions // ledger.SPAN * ledger.SPAN
        if span:
            ledger._write_base(spark, warehouse.root, "ns", table.name, span, rows.unionByName(more).filter(f"seq < {span}"))
            for i in range(span, versions + 1):  # the tail is one file each
                entry = ledger.replace(first, seq=i, op="tag", load_id=f"tag-{i}", rows=0, path="")
                ledger.publish(spark, warehouse.root, entry)
        else:
            for i in range(2, versions + 1):
                ledger.publish(spark, warehouse.root, ledger.replace(first, seq=i, op="tag", load_id=f"tag-{i}", rows=0, path=""))
        times = []
        for i in range(4):
            started = time.monotonic()
            table.load(one(spark, i + 1))
            times.append(time.monotonic() - started)
        assert len(table.entries()) == versions + 4
        took[versions] = sorted(times)[1]
    assert took[2000] < 2 * took[20], took
