import pytest

import entry_data as data
from conftest import bag
from tierflow.schemas import RAW_COLUMNS, raw_schema
from tierflow.sources import (
    drop_table,
    exists,
    external_table,
    import_tables,
    load_csv,
    publish,
    read_csv,
    read_jdbc,
    read_raw,
    read_table,
    recover,
    remainder_predicates,
    rename_table,
    replace_folder,
    save_table,
    scratch,
    settled,
    shared_folder,
    use_database,
    write_silver,
)
from tierflow.settings import tune
from tierflow.sources.csvfile import multiline_files, spans_lines

# A quoted comma, a doubled quote, a quoted number, an empty and a quoted empty value, blanks
# that belong to the value.
QUOTED = '''"Club Name",Ground %,"Since.",Pets
Otters,"Wharf 3, East","1901",
"Owls ""B""",Barn,1950,""
Larks,,"2,000",  two
'''


def write(path, content):
    path.write_text(content, encoding="utf-8", newline="")
    return str(path)


def test_read_csv(spark, tmp_path):
    df = read_csv(spark, write(tmp_path / "t.csv", QUOTED))
    assert df.columns == ["club_name", "ground_", "since", "pets"]
    assert {t for _, t in df.dtypes} == {"string"}
    assert bag(df.select("club_name", "ground_", "since", "pets")) == bag(
        spark.createDataFrame(
            [("Otters", "Wharf 3, East", "1901", None), ('Owls "B"', "Barn", "1950", ""),
             ("Larks", None, "2,000", "  two")],
            df.schema,
        )
    )


def test_files_with_other_headers_are_an_error(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    write(folder / "1.csv", "a,b\n1,2\n")
    write(folder / "2.csv", "b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(folder)).collect()
    write(folder / "2.csv", "A,b\n3,4\n")
    assert bag(read_csv(spark, str(folder))) == [("1", "2"), ("3", "4")]


def test_only_files_with_line_breaks_are_read_whole(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    write(folder / "1.csv", 'a,b\n1,"x\ny"\n')
    write(folder / "2.csv", "a,b\n2,z\n")
    assert [f.rsplit("/")[-1] for f in multiline_files(spark, str(folder))] == ["1.csv"]
    assert bag(read_csv(spark, str(folder))) == [("1", "x\ny"), ("2", "z")]


def test_the_stand_in_for_empty_values_is_no_value(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a,b\n\ue000\ue000\ue000,2\n")
    with pytest.raises(ValueError, match="stand for empty"):
        read_csv(spark, path)


def test_read_csv_with_line_breaks(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'a,b\n1,"x\ny"\n2,z\n')
    assert spans_lines(spark, path)
    assert bag(read_csv(spark, path)) == [("1", "x\ny"), ("2", "z")]
    plain = write(tmp_path / "p.csv", 'a,b\n1,"x,y"\n2,z\n')
    assert not spans_lines(spark, plain)
    assert bag(read_csv(spark, plain)) == [("1", "x,y"), ("2", "z")]


def test_read_csv_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="header"):
        read_csv(spark, write(tmp_path / "empty.csv", ""))
    with pytest.raises(ValueError, match="twice"):
        read_csv(spark, write(tmp_path / "twice.csv", "a b,A B\n1,2\n"))
    with pytest.raises(ValueError, match="empty"):
        read_csv(spark, write(tmp_path / "blank.csv", "a,\n1,2\n"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "missing.csv"))
    ragged = read_csv(spark, write(tmp_path / "ragged.csv", "a,b\n1,2,3\n"))
    with pytest.raises(Exception, match="MALFORMED"):
        ragged.collect()


def test_load_csv_appends(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a,b\n1,2\n")
    load_csv(spark, path, "loaded_csv")
    assert bag(load_csv(spark, path, "loaded_csv")) == [("1", "2"), ("1", "2")]
    drop_table(spark, "loaded_csv")
    located = load_csv(spark, path, "located_csv", location=str(tmp_path / "there"))
    assert bag(located) == bag(spark.read.parquet(str(tmp_path / "there")))
    drop_table(spark, "located_csv")


def test_catalog(spark, tmp_path):
    use_database(spark, "tiers")
    df = spark.createDataFrame([("1",)], "player_id string")
    df.write.parquet(str(tmp_path / "raw"))
    table = external_table(spark, "raw_rushing", raw_schema("rushing"), str(tmp_path / "raw"))
    assert table.columns == raw_schema("rushing").names
    assert table.first().player_id == "1" and table.first().fumbles is None
    save_table(df, "old_name")
    save_table(df, "old_name", mode="append")
    assert rename_table(spark, "old_name", "new_name", comment="PK: player's id").count() == 2
    assert spark.catalog.getTable("new_name").description == "PK: player's id"
    assert read_table(spark, "new_name").count() == 2
    drop_table(spark, "new_name")
    drop_table(spark, "new_name")
    assert not spark.catalog.tableExists("new_name")
    drop_table(spark, "raw_rushing")
    spark.catalog.setCurrentDatabase("default")


def test_read_raw_ignores_other_columns(spark, tmp_path):
    spark.createDataFrame([("1", "x")], "player_id string, other string").write.parquet(
        str(tmp_path / "raw")
    )
    row = read_raw(spark, "returns", str(tmp_path / "raw")).first()
    assert row.player_id == "1" and row.name is None and "other" not in row


def test_publish(spark, tmp_path):
    one, folder = spark.range(1).toDF("k"), str(tmp_path)
    publish({"t": one}, folder, "append")
    publish({"t": one}, folder, "append")
    assert spark.read.orc(f"{folder}/t").count() == 2
    publish({"t": one}, folder)
    assert spark.read.orc(f"{folder}/t").count() == 1
    with pytest.raises(ValueError):
        publish({"t": one}, folder, "ignore")


def test_replace_folder_by_rows_read_from_it(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).write.parquet(path)
    replace_folder(spark.read.parquet(path).selectExpr("id * 2 as id"), path)
    assert bag(spark.read.parquet(path)) == [(0,), (2,), (4,), (6,)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_failed_replacement_leaves_the_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).write.parquet(path)
    broken = spark.read.parquet(path).selectExpr("raise_error('no') as id")
    with pytest.raises(Exception, match="no"):
        replace_folder(broken, path)
    assert spark.read.parquet(path).count() == 4


def test_recover(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t__old"))
    path = str(tmp_path / "t")
    recover(spark, path)
    assert exists(spark, path) and spark.read.parquet(path).count() == 3
    recover(spark, path)
    assert spark.read.parquet(path).count() == 3


def test_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(base)
    assert shared_folder(spark) != shared_folder(spark)


def test_scratch_is_deleted(spark):
    with scratch(spark) as folder:
        df = settled(spark.range(3), f"{folder}/t")
        assert bag(df) == [(0,), (1,), (2,)] and "Range" not in str(df._jdf.queryExecution())
    assert not exists(spark, folder)
    with pytest.raises(ZeroDivisionError), scratch(spark) as folder:
        settled(spark.range(3), f"{folder}/t")
        raise ZeroDivisionError
    assert not exists(spark, folder)


def test_remainder_predicates_take_each_row_once(spark):
    hashes = [None, 0, 1, 2, 3, -1, -2, -3, -4, 9, -9, 2**62, -(2**62)]
    df = spark.createDataFrame([(h,) for h in hashes], "h long")
    parts = [[r.h for r in df.filter(p).collect()] for p in remainder_predicates("h", 4)]
    assert sorted(map(str, sum(parts, []))) == sorted(map(str, hashes))
    assert None in parts[0] and all(parts)


class Recorder:
    """Stands in for a session: keeps the arguments of ``spark.read.jdbc``."""

    def __init__(self, limits=None):
        self.calls, self.writes, self.limits = [], [], limits

    @property
    def read(self):
        return self

    @property
    def write(self):
        return self

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        return self

    def first(self):
        return self.limits

    def mode(self, mode):
        self.writes.append(mode)
        return self

    def parquet(self, path):
        self.writes.append(path)


def test_read_jdbc_arguments():
    props = {"user": "u"}
    one = Recorder()
    read_jdbc(one, "jdbc:x", "t", props)
    assert one.calls == [("t", {"properties": props})]
    split = Recorder(limits=(1, 9))
    read_jdbc(split, "jdbc:x", "t", props, partition_column="id", num_partitions=4)
    assert "min(id)" in split.calls[0][0]
    assert split.calls[1][1] == {
        "column": "id", "lowerBound": 1, "upperBound": 10, "numPartitions": 4, "properties": props,
    }
    empty = Recorder(limits=(None, None))
    read_jdbc(empty, "jdbc:x", "t", props, partition_column="id")
    assert empty.calls[1] == ("t", {"properties": props})
    parts = remainder_predicates("hashtext(player_id)", 2)
    many = Recorder()
    read_jdbc(many, "jdbc:x", "t", props, predicates=parts)
    assert many.calls[0][1]["predicates"] == parts
    with pytest.raises(ValueError):
        read_jdbc(many, "jdbc:x", "t", props, predicates=parts, partition_column="id")


def test_import_tables_arguments():
    spark = Recorder()
    import_tables(spark, "jdbc:x", {}, {"a": "/raw/a", "b": "/raw/b"}, mode="overwrite",
                  splits={"b": {"predicates": ["1 = 1"]}})
    assert [t for t, _ in spark.calls] == ["a", "b"]
    assert spark.calls[1][1]["predicates"] == ["1 = 1"]
    assert spark.writes == ["overwrite", "/raw/a", "overwrite", "/raw/b"]


def rows_by_task(df):
    counts = df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    return [n for n in counts if n]


def test_a_table_written_by_one_task_is_read_by_several(spark, tmp_path):
    """A file of one row group is one task to its readers, however large it is."""
    write_silver(spark.range(0, 600_000, 1, 1), str(tmp_path / "t"))
    assert sorted(rows_by_task(spark.read.parquet(str(tmp_path / "t")))) == [100_000, 250_000, 250_000]


def test_tune_makes_splits_small(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        tune(spark)
        assert spark.conf.get(name) == f"{8 << 20}b"
        spark.conf.set(name, "1000000")
        tune(spark)
        assert spark.conf.get(name) == "1000000"
    finally:
        spark.conf.set(name, before)


def test_a_source_of_one_row_group_is_spread(spark, tmp_path, monkeypatch):
    """The same rows, from tasks of about ``TASK_ROWS`` rows; small sources stay as they are."""
    spark.range(0, 1000, 1, 1).selectExpr("id AS s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    select = ("supplier", ["s_suppkey * 2 AS twice"])
    assert rows_by_task(data.derived(spark, str(tmp_path), select)) == [1000]
    monkeypatch.setattr(data, "_tasks", {})
    monkeypatch.setattr(data.tasks_needed, "__defaults__", (300,))
    found = data.derived(spark, str(tmp_path), select)
    assert len(rows_by_task(found)) == 4
    assert bag(found) == [(2 * i,) for i in sorted(range(1000), key=lambda i: repr((2 * i,)))]
    empty = spark.range(0)
    assert data.tasks_needed(empty) is None


@pytest.mark.parametrize("category", ["passing", "players", "kicking"])
def test_a_raw_table_reads_its_source_once(spark, tmp_path, category):
    """The rows are those of all its selects."""
    spark.range(40).selectExpr(
        "id AS c_custkey", "'n' AS c_name", "CAST(id % 5 AS int) AS c_nationkey", "1.5D AS c_acctbal", "'m' AS c_mktsegment",
    ).union(spark.sql("SELECT 7L, NULL, 1, 2D, NULL")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(60).selectExpr(
        "id AS l_orderkey", "id % 7 AS l_partkey", "CASE WHEN id <> 9 THEN id % 5 END AS l_suppkey", "1 AS l_linenumber",
        "CAST(id AS double) AS l_quantity", "id * 100D AS l_extendedprice", "'A' AS l_returnflag",
        "timestamp'1990-01-01 00:00:00' AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    selects = data.raw_selects(category)
    found = data.raw(spark, str(tmp_path), category)
    assert tuple(found.columns) == RAW_COLUMNS[category]
    every = [data.derived(spark, str(tmp_path), s) for s in selects]
    assert bag(found) == sorted((row for part in every for row in bag(part)), key=repr)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def test_a_source_of_many_tasks_is_not_shuffled_to_be_written(spark, tmp_path, monkeypatch):
    spark.range(0, 4000, 1, 10).selectExpr("id AS s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(data, "_tasks", {})
    monkeypatch.setattr(data.tasks_needed, "__defaults__", (300,))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")  # each file a task
        held, passed = (data.spread(spark, str(tmp_path), "supplier", row_by_row=r) for r in (False, True))
        assert len(rows_by_task(held)) == 14 and sorted(rows_by_task(passed)) == [400] * 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_tune_lets_shuffles_grow(spark):
    """However few partitions the session has, those of a large shuffle stay small."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        tune(spark)
        assert spark.conf.get(name) == "1000"
        spark.conf.set(name, "16")
        tune(spark)
        assert spark.conf.get(name) == "16"
    finally:
        spark.conf.unset(name)
        if before is not None:
            spark.conf.set(name, before)


def test_tune_merges_shuffles_to_small_tasks(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.getAll.get(name)
    try:
        spark.conf.unset(name)
        tune(spark)
        assert spark.conf.get(name) == f"{16 << 20}b"
        spark.conf.set(name, "1000000")
        tune(spark)
        assert spark.conf.get(name) == "1000000"
    finally:
        spark.conf.unset(name)
        if before is not None:
            spark.conf.set(name, before)
