"""Inputs that once gave wrong, empty or failed results."""

from pyspark.sql import functions as F

from tallywood.functions.text import id_time, size_in_bytes
from tallywood.operators import appstats, usage
from tallywood.sources.inventory import list_files
from tallywood.sources.log_files import read_log_lines

SHAPE = "file_path string, value string"
APP = "application_1500000000001_0001"
NAMES = [f"container_1500000000001_0001_01_00000{n}" for n in (1, 2)]


def line(level="INFO", text="x"):
    return f"17/01/02 03:04:05 {level} a.B: {text}"


def test_lines_without_container_or_application(spark):
    lines = spark.createDataFrame(
        [
            (f"/logs/{APP}/{NAMES[0]}.log", line()),
            (f"/logs/{APP}/{NAMES[1]}.log", line()),
            (f"/logs/{APP}/{NAMES[1]}.log", line()),
            (f"/logs/{APP}/launch.log", line()),
            ("/var/syslog", line("ERROR")),
        ],
        SHAPE,
    )
    found = usage.container_roles(lines).first()
    assert (found["num_lines"], found["num_containers"], found["master_lines"], found["executor_lines"]) == (4, 2, 1, 2)
    rates = {r["container_id"]: (r["num_lines"], r["error_lines"]) for r in usage.error_rates(lines, by="container_id").collect()}
    assert rates == {None: (1, 0), NAMES[0]: (1, 0), NAMES[1]: (2, 0)}


def test_numbers_beyond_their_type(spark):
    huge = spark.sql("SELECT '9000000000000000000' AS id, '99999999999999.0' AS size, 'GB' AS unit")
    assert huge.select(id_time(F.col("id"))).first()[0] is None
    assert huge.select(size_in_bytes(F.col("size"), F.col("unit"))).first()[0] is None
    assert huge.select(size_in_bytes(F.lit("1.5"), F.lit("KB"))).first()[0] == 1536


def test_every_component(spark):
    lines = spark.createDataFrame([("f", f"17/01/02 03:04:05 INFO c{i}: x") for i in range(50)], SHAPE)
    assert appstats.component_counts(lines).count() == 50
    assert appstats.top_components(lines).count() == 20


def test_folders_of_any_depth(spark, tmp_path):
    deep = tmp_path / APP / "more"
    deep.mkdir(parents=True)
    (deep / f"{NAMES[0]}.log").write_text("one\ntwo\n")
    assert read_log_lines(spark, str(tmp_path)).count() == 2
    assert list_files(spark, str(tmp_path)).agg(F.sum("bytes")).first()[0] == 8
