"""State in parts by key, key registers, ledgers, counts taken while writing, working folders."""

import os
from datetime import date

import pytest
from conftest import values
from pyspark.sql import functions as F

from orderflow.operators import dedupe, quality, state
from orderflow.sources.keyed import KeyedTable, KeyRegister, key_part
from orderflow.sources.scratch import new_folder, released, staged
from orderflow.sources.writers import write_facts

DAYS = [date(2024, 1, d) for d in range(1, 6)]


def keyed(spark, n=200, parts=8):
    rows = spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit("old").alias("v"))
    table = KeyedTable(spark, new_folder(spark, "keyed"), "k", rows.schema, parts)
    table.write(rows, DAYS[0])
    return table


def files(table, before=None):
    return {r[0]: (r[1], r[2]) for r in table.read(before, places=True).select("_metadata.file_path", "_metadata.file_modification_time", "key_part").distinct().collect()}


def test_only_touched_parts_are_written(spark):
    table = keyed(spark)
    first = files(table)
    new = spark.createDataFrame([("3", "new"), ("1000", "new")], "k string, v string")
    touched = table.merge(new, lambda old, rows: state.replace_rows(old, rows, "k"), DAYS[1])
    assert touched == table.parts_of(new) and 1 <= len(touched) <= 2
    kept = {p: f for p, f in first.items() if f[1] not in touched}
    after = files(table)
    assert kept.items() <= after.items() and len({f[1] for f in after.values()}) == 8
    want = {str(i): "old" for i in range(200)} | {"3": "new", "1000": "new"}
    assert dict(values(table.read())) == want and table.read().count() == 201
    assert table.read(DAYS[1]).filter("v = 'new'").count() == 0  # the state before the run is as it was
    assert {int(r.p) for r in table.read().select(key_part(F.col("k"), 8).alias("p")).distinct().collect()} == set(range(8))


def test_a_repeated_run_replaces_its_own_part(spark):
    table, fold = keyed(spark), lambda old, rows: state.replace_rows(old, rows, "k")
    one, two = (spark.createDataFrame([(k, "new")], "k string, v string") for k in ("3", "4"))
    table.merge(one, fold, DAYS[1])
    table.merge(two, fold, DAYS[1])
    assert values(table.read().filter("v = 'new'")) == [("4", "new")]
    table.merge(one.limit(0), fold, DAYS[1])
    assert table.read().filter("v = 'new'").count() == 0 and table.read().count() == 200


def test_an_unfinished_run_is_not_read(spark):
    table = keyed(spark)
    table.merge(spark.createDataFrame([("3", "new")], "k string, v string"), lambda old, rows: state.replace_rows(old, rows, "k"), DAYS[1])
    os.remove(f"{table.path}/run_date={DAYS[1]}/_SUCCESS")
    assert table.read().filter("v = 'new'").count() == 0 and table.read().count() == 200


def test_no_state_yet(spark):
    rows = spark.createDataFrame([(None, "x"), ("", "y"), ("a", "z")], "k string, v string")
    table = KeyedTable(spark, new_folder(spark, "keyed"), "k", rows.schema, 4)
    assert table.read().count() == 0 and table.folders() == {}
    table.merge(rows, lambda old, new: old.unionByName(new), DAYS[0])
    assert values(table.read()) == values(rows)
    assert len(table.parts_of(rows.filter("k is null or k = ''"))) == 1


def test_key_register(spark):
    keys = KeyRegister(spark, new_folder(spark, "register"), "k", "d")
    days = spark.createDataFrame([("2024-01-01",), (None,)], "d string")
    assert keys.read(days).count() == 0
    keys.append(spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "k string, d string"), DAYS[0])
    keys.append(spark.createDataFrame([("c", "2024-01-01")], "k string, d string"), DAYS[1])
    assert values(keys.read(days)) == [("a", "2024-01-01"), ("c", "2024-01-01")]
    assert values(keys.read(days, DAYS[1])) == [("a", "2024-01-01")]
    plan = keys.read(staged(days, "days"))._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan
    keys.append(spark.createDataFrame([("d", "2024-01-01")], "k string, d string"), DAYS[1])
    assert values(keys.read(days), "k") == [("a",), ("d",)]


def test_key_ledger_tells_copies_from_conflicts(spark):
    nest = "k string, a string, b string, c array<struct<x:string,y:string>>"
    rows = [("one", "1", None, [("x", None)]), ("copy", "1", None, [("x", None)]), ("copy", "1", None, [("x", None)]),
            ("null moved", "1", None, None), ("null moved", None, "1", None), ("nested null moved", "1", None, [("x", None)]),
            ("nested null moved", "1", None, [(None, "x")]), ("null or none", "1", "", []), ("null or none", "1", "", None),
            ("three", "1", "2", []), ("three", "1", "2", []), ("three", "1", "3", []), (None, "1", None, None), (None, "2", None, None)]
    df = spark.createDataFrame(rows, nest)
    found = {r.k: (r.row_count, r.conflicting) for r in dedupe.key_ledger(df, ["k"]).collect()}
    assert found == {"one": (1, False), "copy": (2, False), "null moved": (2, True), "nested null moved": (2, True), "null or none": (2, True),
                     "three": (3, True), None: (2, True)}
    assert values(dedupe.key_conflicts(df, ["k"]), "k") == [(None,), ("nested null moved",), ("null moved",), ("null or none",), ("three",)]
    plan = dedupe.key_ledger(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
    assert dedupe.key_ledger(df.select("k"), ["k"]).filter("conflicting").count() == 0
    for parts in (1, 5):
        assert dedupe.dedupe_by(df.repartition(parts), ["k"]).count() == 7
    kept = [values(dedupe.dedupe_by(df.repartition(n), ["k"])) for n in (1, 3, 8)]
    assert kept[0] == kept[1] == kept[2]


def test_counts_are_taken_while_writing(spark):
    path, counts = new_folder(spark, "counted"), quality.RunCounts()
    rows = spark.range(100).select("id", F.date_format(F.date_add(F.lit(DAYS[0]), (F.col("id") % 3).cast("int")), "yyyy-MM-dd").alias("day"))
    staged(counts.watch(rows, all=None, even=F.col("id") % 2 == 0, none=F.lit(None).cast("boolean")), "counted")
    write_facts(rows.filter("id < 10"), path, "day", watch=lambda df: counts.watch(df, facts=None))
    write_facts(rows.filter("id < 0"), path, "day", watch=lambda df: counts.watch(df, nothing=None))
    staged(counts.watch(rows.join(rows.limit(0).select("id"), "id"), empty=None), "counted")
    counts.put(given=3)
    assert counts.rows() == {"all": 100, "even": 50, "none": 0, "facts": 10, "nothing": 0, "empty": 0, "given": 3}
    assert values(counts.report(spark, ["even", "facts"])) == [("even", 50), ("facts", 10)]


def test_staged_tables_go_with_their_block(spark):
    before = set(os.listdir(os.path.dirname(new_folder(spark, "x"))))
    with pytest.raises(ValueError), released(spark):
        staged(spark.range(3), "outer")
        with released(spark):
            assert staged(spark.range(3), "inner").count() == 3
            raise ValueError
    assert set(os.listdir(os.path.dirname(new_folder(spark, "x")))) == before
