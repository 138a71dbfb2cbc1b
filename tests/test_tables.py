import os

import pytest
from pyspark.sql import functions as F

from gridmill import Band, IncompatibleTable, Raster
from gridmill.operators import tiling
from gridmill.plans.load import load_raster
from gridmill.sources import tables
from gridmill.sources.tables import BlockTable

RASTER = Raster((Band("v", "int16"),), 10, 4, 4, 16, 16, overviews=(2, 4)).sized(64, 48)


@pytest.fixture
def pixels(spark):
    return spark.range(64 * 48).selectExpr(
        "id % 64 AS px", "id div 64 AS py", "CAST(id % 500 AS short) AS v"
    )


@pytest.fixture
def table(spark, tmp_path):
    return BlockTable(spark, str(tmp_path / "blocks"))


def test_load_and_read(spark, pixels, table):
    assert not table.exists() and table.is_empty() and table.metadata() is None
    report = load_raster(pixels, RASTER, table, exact_stats=True, compress=True)
    assert report == {"expected": 12 + 4 + 1, "written": 17, "empty": 0}
    assert table.exists() and not table.is_empty()
    rows = table.read()
    assert rows.columns == ["block", "metadata", "v"]
    assert rows.count() == 18 and rows.where("block = 0 AND v IS NULL").count() == 1
    assert rows.where("block <> 0 AND metadata IS NOT NULL").isEmpty()
    doc = table.metadata()
    assert doc["num_blocks"] == 12 and doc["bands"][0]["stats"]["count"] == 64 * 48
    assert table.metadata_rows().first().num_pixels == 64 * 48
    back = tiling.decode(table.data(), RASTER, compressed=True).where("z = 10")
    assert back.where("v = ((gy - 64) * 64 + (gx - 64)) % 500").count() == 64 * 48
    assert table.records(3).count() == 3 and table.records().count() == 10
    first = table.records(3, ordered=True).collect()
    assert [r.block for r in first] == sorted(r.block for r in first) and first[0].metadata
    facts = {r.column: (r.type, r.rows, r.non_null) for r in table.describe().collect()}
    assert facts == {
        "block": ("bigint", 18, 18), "metadata": ("string", 18, 1), "v": ("binary", 18, 17)
    }


def test_modes(spark, pixels, table):
    load_raster(pixels, RASTER, table, basic_stats=True)
    with pytest.raises(FileExistsError):
        load_raster(pixels, RASTER, table, basic_stats=True)
    assert table.data().count() == 17
    load_raster(pixels, RASTER, table, mode="overwrite", basic_stats=True)
    assert table.data().count() == 17 and table.duplicates().isEmpty()
    load_raster(pixels, RASTER, table, mode="append", basic_stats=True)
    assert table.data().count() == 34 and table.duplicates().count() == 17
    assert table.metadata()["num_blocks"] == 24
    with pytest.raises(ValueError, match="Invalid write mode"):
        load_raster(pixels, RASTER, table, mode="replace", basic_stats=True)
    table.drop()
    assert not table.exists()


def test_append_to_nothing_is_a_new_table(pixels, table):
    load_raster(pixels, RASTER, table, mode="append", basic_stats=True)
    assert table.data().count() == 17


def test_a_lost_metadata_row_is_mended(pixels, table):
    load_raster(pixels, RASTER, table, basic_stats=True)
    doc = table.metadata()
    live = table._live()
    table._commit(live["number"] + 1, live["loads"], "{}")
    assert table.exists() and table.metadata() == {}
    table.refresh_metadata()
    assert table.metadata()["bounds"] == doc["bounds"]


def test_a_failed_commit_changes_nothing(pixels, table, monkeypatch):
    load_raster(pixels, RASTER, table, basic_stats=True)
    doc, files = table.metadata(), table.read().inputFiles()

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(BlockTable, "_commit", lost)
    for mode in ("append", "overwrite"):
        with pytest.raises(OSError, match="lost"):
            load_raster(pixels, RASTER, table, mode=mode, basic_stats=True)
    assert table.metadata() == doc and table.read().inputFiles() == files
    assert table.data().count() == 17
    assert len(os.listdir(f"{table.path}/data")) == 1


def test_a_reader_keeps_its_state_during_an_overwrite(spark, pixels, table):
    load_raster(pixels, RASTER, table, basic_stats=True)
    before = table.read()
    load_raster(pixels.where("px < 16"), RASTER.sized(16, 40), table, mode="overwrite", basic_stats=True)
    assert before.count() == 18 and table.read().count() < 18
    table.vacuum()
    assert len(os.listdir(f"{table.path}/data")) == len(table._commits()) == 1
    assert table.read().where("block = 0").count() == 1


def test_commits_by_two_writers(pixels, table):
    load_raster(pixels, RASTER, table, load="a", basic_stats=True)
    number = table._live()["number"]
    assert table._commit(number + 1, {"x": "y"}, "{}")
    assert not table._commit(number + 1, {"z": "y"}, "{}")
    assert table._live()["loads"] == {"x": "y"}


def test_a_commit_half_written_is_passed_over(pixels, table):
    load_raster(pixels, RASTER, table, basic_stats=True)
    with open(f"{table.path}/_live/{table._live()['number'] + 1:012d}.json", "w") as file:
        file.write('{"number": 2, "loa')
    assert table.data().count() == 17


def test_a_load_written_again_counts_once(pixels, table):
    load_raster(pixels, RASTER, table, load="a", exact_stats=True)
    load_raster(pixels, RASTER, table, mode="append", load="b", exact_stats=True)
    before = table.metadata()
    load_raster(pixels, RASTER, table, mode="append", load="b", exact_stats=True)
    assert table.data().count() == 34
    after = table.metadata()
    assert after["num_blocks"] == before["num_blocks"] == 24
    assert after["bands"][0]["stats"]["count"] == before["bands"][0]["stats"]["count"]


def test_incompatible_append_writes_nothing(pixels, table):
    load_raster(pixels, RASTER, table, exact_stats=True, basic_stats=True)
    before, doc = table.data().count(), table.metadata()
    other = Raster((Band("v", "int16"),), 11, 4, 4, 16, 16)
    with pytest.raises(IncompatibleTable, match="block resolution"):
        load_raster(pixels, other, table, mode="append", exact_stats=True, basic_stats=True)
    named = Raster((Band("w", "int16"),), 10, 4, 4, 16, 16)
    with pytest.raises(IncompatibleTable, match="bands"):
        load_raster(
            pixels.withColumnRenamed("v", "w"), named, table, mode="append", basic_stats=True
        )
    assert table.data().count() == before and table.metadata() == doc


def test_a_failed_overwrite_leaves_the_old_table(spark, pixels, table, tmp_path):
    load_raster(pixels, RASTER, table, basic_stats=True)
    doc = table.metadata()
    broken = tiling.blocks(pixels, RASTER).withColumn(
        "v", F.when(F.col("block") > 0, F.raise_error(F.lit("lost"))).cast("binary")
    )
    with pytest.raises(Exception, match="lost"):
        table.write(broken, "{}", mode="overwrite")
    assert table.metadata() == doc and table.data().count() == 17
    assert os.listdir(tmp_path) == ["blocks"]


def test_reserved_names(pixels, table):
    raster = Raster((Band("Block", "int16"),), 10, 4, 4, 16, 16)
    with pytest.raises(ValueError, match="column names itself"):
        load_raster(pixels.withColumnRenamed("v", "Block"), raster, table)


def test_rows_are_clustered(spark, pixels, table):
    load_raster(pixels, RASTER, table, basic_stats=True, parallelism=3)
    files = (
        table.data()
        .withColumn("file", F.input_file_name())
        .groupBy("file")
        .agg(F.min("block").alias("lo"), F.max("block").alias("hi"))
        .orderBy("lo")
        .collect()
    )
    assert 1 < len(files) <= 3
    assert all(a.hi < b.lo for a, b in zip(files, files[1:]))


def test_filters_reach_the_files(pixels, table):
    load_raster(pixels, RASTER, table, basic_stats=True)
    plan = table.read().where("block = 0").select("metadata")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(block,0)" in text
    scan = table.data().select("block")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<block:bigint>" in scan


def test_chunks(pixels, table):
    load_raster(pixels, RASTER, table, basic_stats=True, chunk_size=5, parallelism=1)
    files = table.data().select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    assert sorted(r["count"] for r in files) == [2, 5, 5, 5]


def test_insert(pixels, table):
    load_raster(pixels, RASTER, table, basic_stats=True)
    table.insert([{"block": 5, "v": b"ab"}, {"block": 6, "v": None}])
    assert table.data().where("block IN (5, 6)").count() == 2
    with pytest.raises(ValueError, match="not in the table"):
        table.insert([{"block": 5, "other": 1}])
    with pytest.raises(ValueError, match="metadata"):
        table.insert([{"block": 5, "metadata": "{}"}])


def test_sql(spark, pixels, table):
    load_raster(pixels, RASTER, table, basic_stats=True)
    rows = tables.run_sql(
        spark, "SELECT count(*) AS n FROM {t} WHERE block > :low", {"t": table.read()}, low=0
    )
    assert rows.first().n == 17
    text = "it's `quoted` \\"
    assert tables.run_sql(spark, "SELECT :x AS x", x=text).first().x == text
    table.register("some_blocks")
    assert spark.sql("SELECT * FROM some_blocks WHERE block = 0").count() == 1
    assert tables.quote_name("a.b`c.d") == "`a`.`b``c`.`d`"
    assert tables.quote_name("`a`.`b c`") == "`a`.`b c`"


def test_catalog_table(spark, pixels):
    tables.save_as_table(tiling.blocks(pixels, RASTER), "saved_blocks", "1.0+X")
    assert spark.catalog.tableExists("saved_blocks")
    facts = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES saved_blocks").collect()}
    assert facts["gridmill"] == "1_0_x"
    spark.sql("DROP TABLE saved_blocks")


def test_bands_loaded_apart(spark, pixels):
    raster = Raster((Band("a", "int16", nodata=0), Band("b", "int16", nodata=0)), 10, 4, 4, 16, 16)
    both = pixels.selectExpr("px", "py", "IF(px < 16, 0S, v) AS a", "IF(py < 16, 0S, v) AS b")
    apart = [tiling.base_blocks(both, raster.select(n)) for n in ("a", "b")]
    merged, whole = tiling.merge_bands(apart), tiling.base_blocks(both, raster)
    assert merged.exceptAll(whole).isEmpty() and merged.count() == whole.count()


def test_bands_of_repeated_blocks_are_not_multiplied(spark):
    a = spark.createDataFrame([(1, b"x"), (1, b"y"), (1, b"z"), (2, b"w")], "block long, a binary")
    b = spark.createDataFrame([(1, b"p"), (1, b"q"), (3, None)], "block long, b binary")
    rows = tiling.merge_bands([a, b]).collect()
    assert sorted(r.block for r in rows) == [1, 1, 1, 2, 3]
    assert sorted(bytes(r.a) for r in rows if r.a) == [b"w", b"x", b"y", b"z"]
    assert sorted(bytes(r.b) for r in rows if r.b) == [b"p", b"q"]


def test_catalog_table(spark, pixels):
    table = tables.CatalogTable(spark, "spark_catalog.default.blocks_of_a_raster")
    table.drop()
    assert not table.exists() and table.is_empty() and table.metadata() is None
    report = load_raster(pixels, RASTER, table, load="a", basic_stats=True, version="1.0+X")
    assert report["written"] == table.data().count() == 17
    assert table.exists() and not table.is_empty()
    assert table.properties()["version"] == "1_0_x"
    with pytest.raises(FileExistsError):
        load_raster(pixels, RASTER, table, basic_stats=True)
    load_raster(pixels, RASTER, table, mode="append", load="b", basic_stats=True)
    load_raster(pixels, RASTER, table, mode="append", load="b", basic_stats=True)
    assert table.data().count() == 34 and table.metadata()["num_blocks"] == 24
    other = Raster((Band("v", "int16"),), 11, 4, 4, 16, 16)
    with pytest.raises(IncompatibleTable):
        load_raster(pixels, other, table, mode="append", basic_stats=True)
    first = table.records(1, ordered=True).first()
    assert first.block == 0 and first.metadata
    assert {r["column"]: r["rows"] for r in table.describe().collect()}["v"] == 35
    table.vacuum()
    assert table.data().count() == 34
    load_raster(pixels, RASTER, table, mode="overwrite", basic_stats=True)
    table.vacuum()
    held = spark.table("blocks_of_a_raster")
    assert table.data().count() == 17 and held.select("load").distinct().count() == 1
    table.insert([{"block": 5, "v": b"it's"}])
    assert table.data().count() == 18
    table.drop()
    assert not table.exists()
