from __future__ import annotations

import json
import uuid
from pathlib import Path

import pytest

from farewind import schemas, scratch, sinks, sources
from farewind.scratch import new_folder
from tests.fixture_rows import FARE_ROWS, QUOTE_ROWS


def write(folder: str, name: str, text: str) -> str:
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text(text)
    return folder


HEADER = ",".join(schemas.FARE.names)


def test_fare_files(spark):
    lines = [",".join(map(str, row)) for row in FARE_ROWS]
    odd = lines[0].rsplit(",", 1)[0] + ",x"
    path = write(new_folder(spark, "csv"), "a.csv", "\n".join([HEADER, *lines, odd, ""]))
    rows = [tuple(r) for r in sources.read_fares_csv(spark, path).collect()]
    assert rows == [*FARE_ROWS, (*FARE_ROWS[0][:-1], None)]


def test_inferred_files(spark):
    path = write(new_folder(spark, "csv"), "a.csv", "name,n\na,1\nb,2\n")
    assert dict(sources.read_csv_inferred(spark, path).dtypes) == {"name": "string", "n": "int"}
    raw = sources.read_csv_inferred(spark, path, header=False)
    assert raw.columns == ["_c0", "_c1"] and raw.count() == 3


STATE = [
    "4b1", "SWR1 ", "CH", 1700000000, 1700000005, 8.5, 47.4, 1000, False, 200.5, 90.0, None,
    [3, 14], 1010.5, "1000", True, 0,
]


@pytest.mark.parametrize("indent", [None, 2])
def test_state_documents(spark, indent):
    short = ["4b2", None, "CH"]
    odd = ["4b3", "X", "CH", "soon", 5.7, "east", 1, None, "maybe", None, None, None, "no", 1, 7, 0, 1]
    text = json.dumps({"time": 1, "states": [STATE, short, odd]}, indent=indent)
    path = write(new_folder(spark, "docs"), "a.json", text + "\n")
    df = sources.read_state_documents(spark, path, multi_line=indent is not None)
    assert df.schema == schemas.STATE
    rows = [tuple(r) for r in df.collect()]
    assert rows[0] == tuple(STATE)
    assert rows[1] == ("4b2", None, "CH", *[None] * 14)
    assert rows[2][:3] == ("4b3", "X", "CH") and rows[2][3] is None and rows[2][5] is None
    assert rows[2][8] is None and rows[2][14] == "7"


def test_documents_without_states(spark):
    path = write(new_folder(spark, "docs"), "a.json", '{"time": 1, "states": null}\n')
    assert sources.read_state_documents(spark, path).count() == 0


def test_malformed_documents(spark):
    lines = [json.dumps({"time": 1, "states": [STATE]}), '{"time": 2, "states": [[', '{"time": 3, "states": null}']
    path = write(new_folder(spark, "docs"), "a.json", "\n".join(lines) + "\n")
    assert sources.read_state_documents(spark, path).count() == 1
    kept = sources.read_state_documents(spark, path, on_malformed="keep")
    assert sorted((r.icao24 or "", r.document or "") for r in kept.collect()) == [("", lines[1]), (STATE[0], "")]
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_state_documents(spark, path, on_malformed="fail").collect()
    with pytest.raises(ValueError):
        sources.read_state_documents(spark, path, on_malformed="guess")


def test_release_leaves_nothing(spark):
    before = scratch._made.pop(spark.sparkContext.applicationId, [])
    path = Path(new_folder(spark, "gone"))
    sinks.write_table(spark.range(3), str(path))
    other = scratch.stored(spark.range(5), "gone").inputFiles()[0]
    assert path.exists() and scratch.release(spark) == 2
    assert not path.exists() and not Path(other.removeprefix("file://")).exists()
    scratch._made[spark.sparkContext.applicationId] = before


def test_path_tables(spark):
    df = sources.rows_to_df(spark, FARE_ROWS, schemas.FARE)
    path = new_folder(spark, "fares")
    for _ in range(2):
        sinks.write_table(df, path, partition_by=["Source"])
    sinks.write_table(df, path, mode="append", partition_by=["Source"])
    assert sources.read_table(spark, path).count() == 10


def test_catalog_tables(spark):
    name = f"quotes_{uuid.uuid4().hex}"
    sinks.ensure_table(spark, name, schemas.QUOTE, path=new_folder(spark, name))
    sinks.ensure_table(spark, name, schemas.QUOTE)
    assert sources.read_table(spark, name).schema == schemas.QUOTE
    rows = sources.rows_to_df(spark, [(*r[::-1],) for r in QUOTE_ROWS],
                              "price decimal(10,2), destination string, source string,"
                              " flight_departure string")
    sinks.append_rows(rows.selectExpr("*", "timestamp'2024-01-01' AS updatedTime"), name)
    stored = sources.read_table(spark, name)
    assert {(r.flight_departure, r.source, r.destination, r.price) for r in stored.collect()} == set(
        QUOTE_ROWS
    )
    copy = f"copy_{uuid.uuid4().hex}"
    for _ in range(2):
        sinks.save_as_table(stored, copy, path=new_folder(spark, copy))
    assert sources.read_table(spark, copy).count() == 24
    sources.register_view(stored, "quotes_view")
    assert spark.sql("SELECT count(*) FROM quotes_view").first()[0] == 24
    sinks.drop_tables(spark, [name, copy, "never_there"])
    assert not spark.catalog.tableExists(name) and not spark.catalog.tableExists(copy)


class _Session:
    """Just the parts of a session that the scratch folder depends on."""

    class sparkContext:
        master, applicationId = "spark://somewhere:7077", "app"

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, name, default):
        return self.settings.get(name, default)


def test_scratch_is_shared_on_a_cluster():
    named = _Session(**{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert scratch.new_folder(named, "x").startswith("hdfs:///shared/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_root(_Session())


def test_a_table_is_replaced_by_its_own_rows(spark):
    name, path = f"own_{uuid.uuid4().hex}", f"{new_folder(spark, 'own')}/table"
    sinks.replace_table(spark.range(5).selectExpr("id", "id * 10 AS price"), name, path)
    before = spark.table(name)
    assert before.count() == 5
    for _ in range(2):
        sinks.replace_table(spark.table(name).filter("id > 0").selectExpr("id", "price + 1 AS price"), name)
    assert sorted(map(tuple, spark.table(name).collect())) == [(i, 10 * i + 2) for i in range(1, 5)]
    assert sorted(map(tuple, before.collect())) == [(i, 10 * i) for i in range(5)]  # opened before
    spark.range(1).write.parquet(f"{path}-generation-dead")  # a run that died before the switch
    assert spark.table(name).count() == 4
    assert sinks.drop_generations(spark, name) == 3 and sinks.drop_generations(spark, name) == 0
    assert spark.table(name).count() == 4
    with pytest.raises(ValueError, match="columns differ"):
        sinks.replace_table(spark.range(3), name)
    sinks.drop_tables(spark, [name])


def test_partitioned_writes_have_few_files_and_split_crowded_folders(spark):
    rows = spark.range(0, 300_000, 1, 16).selectExpr("if(id % 3 = 0, 'hot', concat('c', id % 20)) AS country", "uuid() AS v")
    path = new_folder(spark, "by-country")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1m")
    try:
        sinks.write_table(rows, path, partition_by=["country"])
    finally:
        spark.conf.set(name, before)
    files: dict[str, int] = {}
    for file in spark.read.parquet(path).inputFiles():
        country = file.partition("country=")[2].partition("/")[0]
        files[country] = files.get(country, 0) + 1
    assert spark.read.parquet(path).count() == 300_000
    # 16 tasks would write 16 files each; a folder has more than one only if it shares a piece
    assert files["hot"] > 2 and sum(files.values()) - files["hot"] <= 60
