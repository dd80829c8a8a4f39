import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fundscope.llm import sharding as sh
from fundscope.llm.common import work_path


def place(spark, docs, shards=8):
    records = sh.sized(docs)
    one = sh.first_map(spark, shards)
    grown = sh.grown_map(one, shards).select("vslot", F.col("shard").alias("grown"))
    return sh.assign(records, sh.cell_totals(records), one).join(grown, "vslot").collect()


def test_law_sizes_and_positions(spark, make_docs, odd_rows, clashing):
    rows = odd_rows + [(i, f"text {i}" * (i % 7)) for i in range(100, 900)]
    got = place(spark, clashing(make_docs(rows)))
    assert len(got) == len(rows)
    want = sorted(((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()))
                   for r in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == want
    positions = defaultdict(list)
    for r in got:
        key = "" if r.doc_id is None else str(r.doc_id)
        vslot = int(hashlib.md5(key.encode()).hexdigest()[:8], 16) % sh.SLOTS
        assert r.vslot == vslot and r.shard == vslot * 8 // sh.SLOTS
        assert r.grown in (r.shard, 8)
        positions[r.shard].append(r.slot)
    for found in positions.values():
        assert sorted(found) == list(range(len(found)))
    assert {r.grown for r in got} == set(range(9))


def test_bytes_of_a_slot(spark, make_docs):
    got = place(spark, make_docs([(1, "abc"), (1, "defgh"), (2, None)]))
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add(r.vslot_bytes)
    assert by_id[1] == {4 + 6} and by_id[2] == {1}


def test_stored_versions_and_rebalancing(spark):
    path = work_path(spark, "maps")
    one = sh.first_map(spark, 4, slots=64)
    sh.write_map(one, path)
    sizes = spark.range(64).select(F.col("id").cast("int").alias("vslot"),
                                   F.when(F.col("id") < 16, 100).otherwise(10).alias("bytes"))
    sh.write_map(sh.rebalanced_map(sh.read_map(spark, path), sizes, 4), path)
    new = sh.read_map(spark, path)
    assert sh.read_map(spark, path, 1).count() == 64 == new.count()
    assert {r.version for r in new.collect()} == {2}
    load = [r.b for r in new.join(sizes, "vslot").groupBy("shard").agg(F.sum("bytes").alias("b"))
            .collect()]
    assert max(load) - min(load) <= 100 and sum(load) == 16 * 100 + 48 * 10
    moved = new.alias("n").join(one.alias("o"), "vslot").where("n.shard <> o.shard").count()
    assert 0 < moved < 32


def test_bounds_and_empty_table(spark, make_docs):
    with pytest.raises(ValueError):
        sh.first_map(spark, 0)
    assert place(spark, make_docs([])) == []


def test_native_plan(spark, make_docs, capsys):
    records = sh.sized(make_docs([(1, "a")]))
    sh.assign(records, sh.cell_totals(records), sh.first_map(spark, 8)).explain()
    assert "Python" not in capsys.readouterr().out
