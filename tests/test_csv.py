"""CSV files cut into splits: the same records as Spark's one-task reader."""

import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roundbook.sources import ingest as IN
from roundbook.sources.csv_records import csv_records, lines_of, parsed, plan_splits, states, text_schema, used_cells
from roundbook.sources.lookup import read_lookup

ONE_TASK = dict(header=False, multiLine=True, quote='"', escape='"', mode="PERMISSIVE")


@pytest.fixture()
def small_splits(spark):
    """Splits of a few bytes, so that most records cross one."""

    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _write(path, text):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return path


def fuzzed(seed, end="\n", width=4):
    """A CSV text with line breaks, commas and doubled quotes in quoted cells, quotes
    inside unquoted cells, empty cells, empty lines, short rows."""
    rng = random.Random(seed)

    def cell(first):
        kind = rng.random()
        body = "".join(rng.choice(["a", "b", "é", "日", " ", "x1", ";", "'"]) for _ in range(rng.randint(0, 6)))
        if kind < 0.35:
            inner = "".join(rng.choice(["a", ",", end, end + end, '""', " ", "long " * 4, "é"]) for _ in range(rng.randint(0, 6)))
            return f'"{inner}"'
        if kind < 0.45:
            return "q" + body + '"' + body  # not at the start: an ordinary character
        return body if body or not first else "k"

    lines = [",".join(cell(i == 0) for i in range(width if rng.random() < 0.9 else rng.randint(1, width))) for _ in range(rng.randint(1, 25))]
    text = "".join(x + end + (end if rng.random() < 0.05 else "") for x in ["h1,h2,h3,h4"[: 3 * width - 1], *lines])
    return text if rng.random() < 0.7 else text.rstrip("\r\n")


@pytest.mark.parametrize("seed", range(6))
def test_equals_the_one_task_reader(spark, small_splits, tmpdir_path, seed):
    end = "\r\n" if seed % 3 == 2 else "\n"
    path = _write(os.path.join(tmpdir_path, "f.csv"), fuzzed(seed, end))
    expected = [tuple(r) for r in spark.read.options(**ONE_TASK).schema(text_schema(4)).csv(path).collect()]
    for size in (23, 1 << 20):
        small_splits(size)
        records = csv_records(spark, path)
        got = records.select("row", parsed(F.col("record"), text_schema(4)).alias("c")).select("row", "c.*").orderBy("row").collect()
        assert [r["row"] for r in got] == list(range(len(expected)))
        assert [tuple(r)[1:] for r in got] == expected


def test_one_quoted_file_is_read_by_several_tasks(spark, small_splits, tmpdir_path):
    rows = "".join(f'{i},"text\n{i}, with ""quotes""\n",{i * 2}\n' for i in range(3000))
    path = _write(os.path.join(tmpdir_path, "big.csv"), "n,t,m\n" + rows)
    small_splits(8192)
    records = csv_records(spark, path)
    tasks = records.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 4
    lookup = read_lookup(spark, path)
    got = lookup.orderBy("__row_id").collect()
    assert [r["__row_id"] for r in got] == list(range(1, 3001))
    assert [int(r["n"]) for r in got] == list(range(3000)) and got[7]["t"] == 'text\n7, with "quotes"\n'


def test_a_record_longer_than_many_splits_and_an_open_quote(spark, small_splits, tmpdir_path):
    path = _write(os.path.join(tmpdir_path, "long.csv"), 'a,b\n1,"' + "x\n" * 100 + '"\n2,y\n3,"open\nto the end\n')
    small_splits(40)
    got = [r["record"] for r in csv_records(spark, path).orderBy("row").collect()]
    assert got == ["a,b", '1,"' + "x\n" * 100 + '"', "2,y", '3,"open\nto the end']


def test_several_files_are_numbered_each(spark, small_splits, tmpdir_path):
    for name, n in (("a", 3), ("b", 5)):
        _write(os.path.join(tmpdir_path, f"{name}.csv"), "h\n" + '"x\ny"\n' * n)
    small_splits(9)
    got = csv_records(spark, f"{tmpdir_path}/*.csv").groupBy("file").agg(F.sort_array(F.collect_list("row")).alias("rows")).collect()
    assert sorted(r["rows"] for r in got) == [[0, 1, 2, 3], [0, 1, 2, 3, 4, 5]]


def test_states_are_those_of_a_loop():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 50):
        opens, stays, inside = rng.random(n) < 0.4, rng.random(n) < 0.6, bool(rng.random() < 0.5)
        state, expected = inside, [inside]
        for o, s in zip(opens, stays):
            state = bool(s if state else o)
            expected.append(state)
        assert states(opens, stays, inside).tolist() == expected


def test_line_functions(spark, tmpdir_path):
    """Long lines with many cells and many doubled quotes match without a deep stack."""
    cases = {'a,"b': (True, False), 'a"b': (False, True), "": (False, True), '"a""b': (True, True), '"a","b"': (False, True),
             'x"x,"y"z,w': (False, False), '",' + '"' : (False, True), '"' + '""' * 50_000: (True, False), ",".join(['"x"'] * 20_000): (False, False), "c" * 200_000 + '",': (False, False)}
    path = _write(os.path.join(tmpdir_path, "l.csv"), "\n".join(cases) + "\n")
    got = {r["value"]: (r["opens"], r["stays"]) for r in lines_of(spark, path).collect()}

    def loop(line, state):
        for c in line:
            if state == "Q":
                state = "E" if c == '"' else "Q"
            elif state == "E" and c == '"':
                state = "Q"
            elif c == ",":
                state = "S"
            elif state == "S" and c == '"':
                state = "Q"
            else:
                state = "U"
        return state == "Q"

    assert got == {line: (loop(line, "S"), loop(line, "Q")) for line in cases}


def test_splits_that_changed_are_an_error(spark, small_splits, tmpdir_path):
    path = _write(os.path.join(tmpdir_path, "f.csv"), "a,b\n" * 50)
    small_splits(20)
    records = csv_records(spark, path)
    small_splits(33)
    with pytest.raises(Exception, match="read it again"):
        records.collect()
    assert len(plan_splits(lines_of(spark, path))) > 1


def test_used_cells(spark):
    cases = {"": 0, "a": 1, ",a": 2, "a,b,,": 2, '"a,b",c': 2, '"a""",x"y,': 2, ',"",': 2, '"open, to the end': 1, ",,": 0}
    rows = spark.createDataFrame([(k,) for k in cases], "record string").select("record", used_cells(F.col("record")).alias("n")).collect()
    assert {r["record"]: r["n"] for r in rows} == cases


def test_columns_of_other_collections_are_inferred(spark, tmpdir_path):
    path = _write(os.path.join(tmpdir_path, "people.csv"), 'id,when,big,share,flag,note,none\n1,2024-01-02,3000000000,0.5,true,"a,b",\n2,,5,2,false,1,\n')
    df = IN.read_collection(spark, path, "people")
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("id", "int"), ("when", "date"), ("big", "bigint"), ("share", "double"), ("flag", "boolean"), ("note", "string"), ("none", "string")]
    assert df.orderBy("id").first()["when"] == dt.date(2024, 1, 2)
    one_task = spark.read.options(**ONE_TASK | {"header": True}, inferSchema=True).csv(path)
    assert sorted(map(tuple, one_task.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_a_write_that_dies_is_neither_read_nor_present(spark, tmpdir_path):
    root, day = f"{tmpdir_path}/wh/t", dt.date(2024, 1, 1)

    @F.udf("int")
    def fails(n):
        if n == 99:
            raise ValueError("killed")
        return n

    rows = spark.range(100).repartition(4)
    with pytest.raises(Exception, match="killed"):
        IN.write_snapshot(rows.select(fails("id").alias("x")), root, day)
    os.makedirs(f"{root}/snapshot_date=2024-01-01/v-{0:020d}-dead/_temporary/0", exist_ok=True)
    spark.range(3).write.mode("overwrite").parquet(f"{root}/snapshot_date=2024-01-01/v-{1:020d}-dead")
    os.remove(f"{root}/snapshot_date=2024-01-01/v-{1:020d}-dead/_SUCCESS")  # all files there, not yet published
    assert IN.published(spark, root) == {} and IN.collections_in(spark, f"{tmpdir_path}/wh") == []
    with pytest.raises(ValueError):
        IN.read_table(spark, f"{tmpdir_path}/wh", "t")
    IN.write_snapshot(spark.range(5), root, day)  # not taken as present
    assert IN.read_table(spark, f"{tmpdir_path}/wh", "t").count() == 5
    with pytest.raises(Exception, match="killed"):
        IN.write_snapshot(rows.select(fails("id").alias("x")), root, day, mode="overwrite")
    assert IN.read_table(spark, f"{tmpdir_path}/wh", "t").count() == 5  # the old version stays
    with pytest.raises(ValueError):
        IN.write_snapshot(spark.range(1), root, day, mode="error")
    IN.write_snapshot(spark.range(7), root, day, mode="overwrite")
    assert IN.read_latest(spark, f"{tmpdir_path}/wh", "t").count() == 7


def test_a_snapshot_of_another_writer_is_read(spark, tmpdir_path):
    spark.range(4).write.parquet(f"{tmpdir_path}/t/snapshot_date=2024-01-01")
    spark.range(2).withColumn("batch_id", F.lit(0)).write.partitionBy("batch_id").parquet(f"{tmpdir_path}/s/snapshot_date=2024-01-01")
    assert IN.read_table(spark, tmpdir_path, "t").count() == 4 and IN.read_table(spark, tmpdir_path, "s").count() == 2
    IN.write_snapshot(spark.range(6), f"{tmpdir_path}/t", dt.date(2024, 1, 1), mode="overwrite")
    IN.write_snapshot(spark.range(1), f"{tmpdir_path}/t", dt.date(2024, 2, 1))
    assert IN.read_table(spark, tmpdir_path, "t").groupBy("snapshot_date").count().orderBy("snapshot_date").collect()[0]["count"] == 6
    assert IN.snapshot_dates(spark, tmpdir_path, "t") == [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]


def test_malformed_values_are_counted_while_writing(spark, small_splits, tmpdir_path):
    head = "funding_round_identifier.uuid,investor_identifier.value,is_lead_investor,money_invested.value_usd\n"
    path = _write(os.path.join(tmpdir_path, "investments.csv"), head + 'r1,"Z\ned",true,abc\nr2,Abe,perhaps,5\nr3,Bo,,\n' * 200)
    small_splits(500)
    for mode, rows, bad in (("ignore", 600, 400), ("ignore", 600, None), ("overwrite", 600, 400)):
        row = IN.import_snapshot(spark, {"investments": path}, f"{tmpdir_path}/wh", dt.date(2024, 1, 2), mode).first()
        assert (row["status"], row["rows"], row["malformed"]) == ("ok", rows, bad)
    assert IN.read_latest(spark, f"{tmpdir_path}/wh", "investments").where("investor_name = 'Z\\ned' AND amount_usd IS NULL").count() == 200
