from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lift.plans.load import load_tables
from lift.sources import tables
from lift.sources.shared import materialise, shared_folder

from conftest import as_tuples


def write(path, text):
    path.write_text(text)
    return str(path)


def test_last_row_of_a_key_wins_within_and_across_loads(spark, tmp_path):
    first = write(tmp_path / "a.csv", "id,v\n1,x\n2,b\n1,y\n")
    second = write(tmp_path / "b.csv", "id,v\n2,c\n3,d\n2,e\n")
    tables.load_csv(spark, first, "upsert_a", "id")
    assert as_tuples(spark.table("upsert_a")) == [(1, "y"), (2, "b")]
    tables.load_csv(spark, second, "upsert_a", "id")
    assert as_tuples(spark.table("upsert_a")) == [(1, "y"), (2, "e"), (3, "d")]


def test_files_of_one_load_count_in_path_order(spark, tmp_path):
    paths = [write(tmp_path / f"part-{i}.csv", f"id,v\n1,{i}\n" + "".join(f"{10 + j},0\n" for j in range(50 * (5 - i)))) for i in range(5)]
    tables.load_csv(spark, paths[::-1], "upsert_order", "id")
    assert spark.table("upsert_order").where("id = 1").first()["v"] == 4


def test_one_file_read_in_many_splits_keeps_its_order(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,v\n" + "".join(f"{i % 100},{i}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        assert spark.read.csv(path).rdd.getNumPartitions() > 10
        tables.load_csv(spark, path, "upsert_split", "id")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert as_tuples(spark.table("upsert_split")) == [(i, 19_900 + i) for i in range(100)]


def test_composite_key_given_as_text(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b,v\n1,1,x\n1,2,y\n1,1,z\n")
    tables.load_csv(spark, path, "upsert_pair", "a, b")
    assert as_tuples(spark.table("upsert_pair")) == [(1, 1, "z"), (1, 2, "y")]


def test_later_loads_go_by_position_into_the_first_schema(spark, tmp_path):
    tables.load_csv(spark, write(tmp_path / "a.csv", "id,v\n1,2.5\n"), "upsert_pos", "id")
    tables.load_csv(spark, write(tmp_path / "b.csv", "other,names\n2,3\n"), "upsert_pos", "id")
    assert as_tuples(spark.table("upsert_pos")) == [(1, 2.5), (2, 3.0)]
    assert spark.table("upsert_pos").columns == ["id", "v"]


def test_empty_fields_are_null_also_in_the_key(spark, tmp_path):
    tables.load_csv(spark, write(tmp_path / "a.csv", "id,v\n,1\n,2\n5,\n"), "upsert_null", "id")
    assert as_tuples(spark.table("upsert_null")) == [(5, None), (None, 2)]
    tables.load_csv(spark, write(tmp_path / "b.csv", "id,v\n,3\n"), "upsert_null", "id")
    assert as_tuples(spark.table("upsert_null")) == [(5, None), (None, 3)]


def test_hot_key_in_a_load(spark, pieces):
    pieces(4)
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"), F.col("id").alias("seq"), F.lit("v").alias("v"))
    tables.upsert(rows.withColumn("ord", F.col("seq")), "upsert_hot", "key", order="ord")
    assert spark.table("upsert_hot").count() == 20_001
    assert spark.table("upsert_hot").where("key = -1").first()["seq"] == 29_997


def test_wrong_arity_stops_the_read(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,v\n1,x\n2\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        tables.load_csv(spark, path, "upsert_bad", "id")
    assert not spark.catalog.tableExists("upsert_bad")


def test_inferred_types(spark, tmp_path):
    path = write(tmp_path / "a.csv", "i,f,t,b,d\n1,1.5,x,true,2001-01-01\n2,2,y,false,2001-01-02\n")
    types = [field.dataType.simpleString() for field in tables.infer_csv_schema(spark, path).fields]
    assert types == ["bigint", "double", "string", "boolean", "string"]


def test_type_seen_only_late_in_the_file(spark, tmp_path):
    path = write(tmp_path / "a.csv", "i\n" + "1\n" * 100 + "x\n")
    assert tables.infer_csv_schema(spark, path).simpleString() == "struct<i:string>"


def test_quoted_line_breaks_need_multi_line(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,v\n1,"a\nb"\n2,"say ""hi"""\n')
    tables.load_csv(spark, path, "upsert_lines", "id", multi_line=True)
    assert as_tuples(spark.table("upsert_lines")) == [(1, "a\nb"), (2, 'say "hi"')]


def test_types_are_found_in_one_read(spark, tmp_path):
    rows = ["+5,1e3,TRUE,9223372036854775807,,x1", "-7,.5,false,99999999999999999999,,", ",NaN,,1,,2.5", "0,-Infinity,true,2,,3"]
    path = write(tmp_path / "a.csv", "i,f,b,big,none,t\n" + "\n".join(rows) + "\n")
    assert tables.infer_csv_schema(spark, path).simpleString() == "struct<i:bigint,f:double,b:boolean,big:string,none:string,t:string>"
    read = spark.read.csv(path, header=True, schema=tables.infer_csv_schema(spark, path), mode="FAILFAST")
    assert read.select("i", "f", "b").collect()[0] == (5, 1000.0, True)
    empty = write(tmp_path / "b.csv", "i,t\n")
    assert tables.infer_csv_schema(spark, empty).simpleString() == "struct<i:string,t:string>"


def test_a_first_load_reads_its_files_once(spark, tmp_path, monkeypatch):
    path = write(tmp_path / "a.csv", "id,v,w\n1,2.5,true\n2,3,false\n1,4,true\n")
    reads = []
    monkeypatch.setattr(tables, "read_csv_in_order", lambda *a, _read=tables.read_csv_in_order, **how: reads.append(a) or _read(*a, **how))
    monkeypatch.setattr(tables, "infer_csv_schema", None)
    tables.load_csv(spark, path, "upsert_once", "id")
    assert as_tuples(spark.table("upsert_once")) == [(1, 4.0, True), (2, 3.0, False)] and len(reads) == 1
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        tables.load_csv(spark, write(tmp_path / "b.csv", "id,v\n1\n"), "upsert_once_bad", "id")


def files_by_part(spark, table):
    rows = spark.table(table).select(tables.PART, F.col("_metadata.file_path").alias("file")).distinct().collect()
    return {part: {r["file"] for r in rows if r[tables.PART] == part} for part in {r[tables.PART] for r in rows}}


@pytest.mark.parametrize("buckets", [None, 8])
def test_a_load_rewrites_only_the_parts_it_meets(spark, buckets):
    rows = spark.range(400).select("id", (F.col("id") * 2).alias("v"), F.lit("a").alias("t"))
    table = f"parted_{buckets or 0}"
    tables.upsert(rows, table, "id", parts=4, buckets=buckets)
    assert tables.part_count(spark, table) == 4 and tables.unique_key(spark, table) == ["id"] and tables.bucket_count(spark, table) == buckets
    before = files_by_part(spark, table)
    assert len(before) == 4
    load = spark.range(400).where(tables.part_of(["id"], 4) == 2).limit(5).select("id", F.lit(-1).cast("long").alias("v"), F.lit("b").alias("t"))
    ids = [r["id"] for r in load.collect()]
    tables.upsert(spark.createDataFrame([(i, -1, "b") for i in ids], "id long, v long, t string"), table, "id")
    after = files_by_part(spark, table)
    assert {part for part in before if before[part] != after[part]} == {2}
    assert as_tuples(tables.keyed_table(spark, table)) == [(i, -1 if i in ids else 2 * i, "b" if i in ids else "a") for i in range(400)]
    # new keys, and a load that meets nothing
    tables.upsert(spark.createDataFrame([(1000, 1, "c")], "id long, v long, t string"), table, "id")
    assert tables.keyed_table(spark, table).count() == 401
    settled = files_by_part(spark, table)
    tables.upsert(spark.createDataFrame([], "id long, v long, t string"), table, "id")
    assert files_by_part(spark, table) == settled
    if buckets:  # still one file per bucket, and no shuffle before a join on the key
        assert sum(len(files) for files in settled.values()) == buckets
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            one, two = (tables.keyed_table(spark, table).alias(name) for name in "xy")
            assert "Exchange" not in one.join(two, "id")._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_parts_of_null_and_composite_keys(spark):
    rows = [(1, "a", 1), (1, None, 2), (None, "a", 3), (None, None, 4)]
    tables.upsert(spark.createDataFrame(rows, "a int, b string, v int"), "parted_pair", "a, b", parts=3)
    tables.upsert(spark.createDataFrame([(None, None, 5), (1, None, 6), (2, "z", 7)], "a int, b string, v int"), "parted_pair", "a, b")
    assert as_tuples(tables.keyed_table(spark, "parted_pair")) == [(1, "a", 1), (1, None, 6), (2, "z", 7), (None, "a", 3), (None, None, 5)]


def test_another_number_of_parts_writes_the_table_anew(spark):
    rows = spark.range(50).select("id", F.lit(1).alias("v"))
    tables.upsert(rows, "parted_more", "id")
    assert tables.part_count(spark, "parted_more") is None
    for parts in (2, 5, None):
        tables.upsert(spark.createDataFrame([(7, parts or 9)], "id long, v int"), "parted_more", "id", parts=parts)
        assert tables.part_count(spark, "parted_more") == (parts or 5)
    assert tables.keyed_table(spark, "parted_more").columns == ["id", "v"]
    assert as_tuples(tables.keyed_table(spark, "parted_more").where("v <> 1")) == [(7, 9)]
    with pytest.raises(ValueError, match="divide"):
        tables.upsert(rows, "parted_odd", "id", parts=3, buckets=8)


def test_a_replaced_table_is_not_vouched_for(spark):
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.upsert(rows, "vouched", "k")
    known = tables.CatalogTables(spark)
    assert known.unique_by("vouched", "k") and not known.unique_by("vouched", "v") and not known.unique_by("nowhere", "k")
    tables.replace_load(rows.unionAll(rows), "vouched")
    assert not known.unique_by("vouched", "k")


def test_replace_load_keeps_duplicates_and_drops_the_old_rows(spark):
    tables.replace_load(spark.createDataFrame([(1, "a")], "k int, v string"), "replaced")
    tables.replace_load(spark.createDataFrame([(2, "b"), (2, "b")], "k int, v string"), "replaced")
    assert as_tuples(spark.table("replaced")) == [(2, "b"), (2, "b")]


def test_widths(spark):
    df = spark.createDataFrame([("abc", 10, None), ("é", 7, None)], "t string, n int, e string")
    assert as_tuples(tables.column_widths(df)) == [("e", None), ("n", 2), ("t", 3)]


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "`T.Col` int, Plain int")
    assert tables.lower_names(df).columns == ["t.col", "plain"]
    assert tables.strip_prefixes(df).columns == ["Col", "Plain"]


def test_execute_drops_a_table(spark):
    tables.replace_load(spark.range(1), "to_drop")
    tables.execute(spark, "drop table to_drop")
    assert not spark.catalog.tableExists("to_drop")


def test_save_scores_writes_both_sinks(spark, tmp_path):
    scored = spark.createDataFrame([(1, 0.25, "x"), (2, 1 / 3, "y")], "id long, pred double, other string")
    path = str(tmp_path / "scores")
    tables.save_scores(scored, path, id_column="id", table="scores_kept")
    tables.save_scores(scored.where("id = 2").withColumn("pred", F.lit(0.5)), path, id_column="id", table="scores_kept")
    assert as_tuples(spark.read.csv(path, header=True, schema="id long, pred double")) == [(2, 0.5)]
    assert as_tuples(spark.table("scores_kept")) == [(1, 0.25), (2, 0.5)]


def test_load_tables_buckets_by_key(spark, tmp_path):
    files = {f"loaded_{name}": write(tmp_path / f"{name}.csv", "id,v\n1,2\n3,4\n") for name in "ab"}
    load_tables(spark, files, "id", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.table("loaded_a").join(spark.table("loaded_b"), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    kept = materialise(spark.range(3), "kept")
    assert kept.inputFiles() and all(shared_folder(spark) in path for path in kept.inputFiles())


def test_a_bucketed_table_stays_bucketed(spark, tmp_path):
    first, second = write(tmp_path / "a.csv", "id,v\n1,x\n2,y\n"), write(tmp_path / "b.csv", "id,v\n2,z\n3,q\n")
    tables.load_csv(spark, first, "upsert_buckets", "id", buckets=3)
    tables.load_csv(spark, second, "upsert_buckets", "id")
    assert tables.bucket_count(spark, "upsert_buckets") == 3
    assert as_tuples(spark.table("upsert_buckets")) == [(1, "x"), (2, "z"), (3, "q")]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("upsert_buckets_")]


def test_types_of_an_external_table(spark):
    df = spark.createDataFrame([(1, 2, True, 1.5, "abc")], "a tinyint, b long, c boolean, d float, `e f` string")
    typed, types = tables.external_types(df)
    assert types == "`a` TINYINT, `b` BIGINT, `c` TINYINT, `d` FLOAT, `e f` VARCHAR(3)"
    assert as_tuples(typed) == [(1, 2, 1, 1.5, "abc")]


def test_remainders_divide_all_whole_numbers(spark):
    predicates = tables.remainder_predicates("n", 3)
    rows = spark.createDataFrame([(n,) for n in [*range(-7, 8), None]], "n int")
    rows.createOrReplaceTempView("remainders")
    met = [spark.sql(f"select n from remainders where {p}").collect() for p in predicates]
    assert sorted((r["n"] for part in met for r in part), key=str) == sorted([*range(-7, 8), None], key=str)
    assert len(predicates) == 3 and tables.remainder_predicates("n", 1) == ["1 = 1"]


def test_bounds_are_asked_of_the_query(spark):
    spark.range(5, 20).createOrReplaceTempView("bounded")
    assert tuple(spark.sql(tables.bounds_query("select id as n from bounded where id > 6", "n")).first()) == (7, 19)


def test_a_partition_column_needs_its_bounds(spark):
    with pytest.raises(ValueError, match="partitions"):
        tables.read_jdbc(spark, "jdbc:none", "select 1", partition_column="id")
    with pytest.raises(ValueError, match="partitions"):
        tables.read_jdbc(spark, "jdbc:none", "select 1", spread_by="hash(id)")
