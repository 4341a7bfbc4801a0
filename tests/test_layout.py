import pytest
from pyspark.sql import functions as F

from lakeops.operators import layout, swaps
from lakeops.operators.layout import _cuts, _rank, cluster_by, compact, file_ranges


@pytest.fixture
def table(spark, tmp_path):
    """300 rows in 12 files; partitioned by ``p`` below ``parts``."""
    rows = spark.range(300).select("id", (F.col("id") % 3).alias("p")).repartition(4)
    rows.write.parquet(str(tmp_path / "plain"))
    rows.write.partitionBy("p").parquet(str(tmp_path / "parts"))
    return tmp_path


def files(path):
    return sorted(str(f.relative_to(path)) for f in path.rglob("*.parquet"))


def total(spark, path):
    return tuple(spark.read.parquet(str(path)).agg(F.count(F.lit(1)), F.sum("id")).first())


def test_compaction_keeps_rows_and_hidden_files(spark, table):
    plain = table / "plain"
    (plain / "_schema").mkdir()
    (plain / "_schema" / "x").write_text("kept")
    assert compact(spark, str(plain)) == 1
    assert len(files(plain)) == 1 and total(spark, plain) == (300, 44850)
    assert (plain / "_schema" / "x").read_text() == "kept"
    assert [p.name for p in table.iterdir() if "swap" in p.name] == []


def test_one_partition_is_compacted_apart(spark, table):
    parts = table / "parts"
    before = files(parts)
    compact(spark, str(parts), where="p = 1", partition_by=["p"])
    after = files(parts)
    assert [f for f in after if "p=1" not in f] == [f for f in before if "p=1" not in f]
    assert len([f for f in after if "p=1" in f]) == 1 and total(spark, parts) == (300, 44850)


class Death(Exception):
    pass


@pytest.mark.parametrize("steps", [0, 1, 2, 3])
@pytest.mark.parametrize("where", [None, "p > 0"])
def test_a_swap_that_dies_between_its_steps(spark, table, monkeypatch, steps, where):
    parts, done, rename = table / "parts", [], swaps.Files.rename

    def dying(self, src, dst):
        if len(done) == steps:
            raise Death
        done.append(src)
        rename(self, src, dst)

    monkeypatch.setattr(swaps.Files, "rename", dying)
    args = {"where": where, "partition_by": ["p"]}
    if where is None and steps > 1:
        compact(spark, str(parts), **args)  # two renames are all there is
    else:
        with pytest.raises(Death):
            compact(spark, str(parts), **args)
    monkeypatch.setattr(swaps.Files, "rename", rename)
    assert swaps.recover(spark, str(parts)) == (0 if where is None and steps > 1 else 1)
    assert total(spark, parts) == (300, 44850) and swaps.recover(spark, str(parts)) == 0
    assert len([f for f in files(parts) if "p=1" in f]) == 1  # the new files are in place


def test_a_write_that_dies_leaves_the_table(spark, table):
    def dying(path):
        spark.range(5).write.parquet(path)
        raise Death

    with pytest.raises(Death):
        swaps.replace_folder(spark, str(table / "plain"), dying)
    assert total(spark, table / "plain") == (300, 44850)
    assert swaps.recover(spark, str(table / "plain")) == 1 and total(spark, table / "plain") == (300, 44850)


def test_folders_of_a_stream_are_refused(spark, table):
    (table / "plain" / "_spark_metadata").mkdir()
    with pytest.raises(ValueError, match="stream"):
        swaps.replace_folder(spark, str(table / "plain"), lambda path: None)


@pytest.mark.parametrize("kind", ["bigint", "string", "double", "date", "timestamp", "decimal(20,2)", "boolean"])
def test_ranks_are_the_number_of_borders_passed(spark, kind):
    values = {"date": "date_add(date'2030-01-01', id)", "timestamp": "timestamp_seconds(id * 1000)",
              "boolean": "id % 2 = 0"}.get(kind, f"cast(id as {kind})")
    df = spark.range(2000).selectExpr(f"if(id % 50 = 0, null, {values.replace('id', 'int(id)') if kind == 'date' else values}) AS v")
    cuts = _cuts(df, ["v"], 16)["v"]
    assert len(cuts) == (1 if kind == "boolean" else 15) and cuts == sorted(cuts)
    got = df.select("v", _rank(F.col("v"), cuts).alias("r")).collect()
    assert all(r.r == (0 if r.v is None else sum(c <= r.v for c in cuts)) for r in got)


def test_one_hot_value_is_one_border(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("v"))
    cuts = _cuts(df, ["v"], 32)["v"]
    assert len(cuts) == len(set(cuts)) and 7 in cuts


def test_clustered_files_are_narrow_in_every_key(spark, tmp_path):
    df = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"),
                                    F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).cast("string").alias("b"), "id")
    cluster_by(df, ["a", "b"], 16).write.parquet(str(tmp_path / "z"))
    ranges = file_ranges(spark.read.parquet(str(tmp_path / "z")), ["a"]).collect()
    assert sum(r.rows for r in ranges) == 20_000 and len(ranges) == 16
    assert sum(r.max_a - r.min_a for r in ranges) / len(ranges) < 550  # 999 without clustering, 250 for perfect squares


def test_borders_come_from_a_pass_over_all_files_side_by_side(spark, monkeypatch):
    plans, settle = [], layout.settle
    monkeypatch.setattr(layout, "settle", lambda df, label: plans.append(df._jdf.queryExecution().toString()) or settle(df, label))
    cuts = _cuts(spark.range(0, 4000, 1, 8).withColumnRenamed("id", "v"), ["v"], 16)["v"]
    assert len(cuts) == 15 and all(abs(c - 250 * (k + 1)) < 120 for k, c in enumerate(cuts))
    assert "Coalesce 1" not in plans[0] and "Exchange" in plans[0]  # only the sample goes to one task


def test_partitions_are_written_without_a_sort(spark, table, monkeypatch):
    found, replace = [], layout.replace_folder

    def noted(spark, path, write, inner):
        found.append(int(write.__self__._spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")))
        replace(spark, path, write, inner)

    monkeypatch.setattr(layout, "replace_folder", noted)
    compact(spark, str(table / "parts"), partition_by=["p"])
    assert found == [layout.WRITERS] and total(spark, table / "parts") == (300, 44850)


@pytest.mark.parametrize("parts", [3, 4, 5, 40])
def test_unsorted_writes_of_few_and_many_partitions(spark, tmp_path, parts):
    rows = layout.unsorted_writes(spark).range(2000).select("id", (F.col("id") % parts).alias("p"))
    rows.repartition(6).write.partitionBy("p").parquet(str(tmp_path / "t"))
    assert len(files(tmp_path / "t")) == 6 * parts
    got = spark.read.parquet(str(tmp_path / "t"))
    assert got.where(f"p = id % {parts}").count() == got.count() == got.select("id").distinct().count() == 2000


@pytest.mark.parametrize("n", [2, 12])
def test_compacted_files_stay_near_the_target(spark, tmp_path, n):
    path = tmp_path / "t"
    spark.range(20_000 * n).select(F.xxhash64("id").alias("h")).repartition(4 * n).write.parquet(str(path))
    size = max(f.stat().st_size for f in path.rglob("*.parquet"))
    compact(spark, str(path), target := 4 * size)
    sizes = [f.stat().st_size for f in path.rglob("*.parquet")]
    assert n <= len(sizes) <= 2 * n and max(sizes) <= 1.1 * target  # whatever the table's size
