import os

from pyspark.sql import functions as F

from tiersmith.plans import medallion as md
from tiersmith.session import fresh_path
from tiersmith.sources import files as fs
from tiersmith.streaming import incremental_silver

HEADER = "Row ID,Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,Country,City\n"


def csv(spark, lines):
    folder = fresh_path(spark, "feed")
    os.makedirs(folder)
    with open(os.path.join(folder, "part.csv"), "w") as fh:
        fh.write(HEADER + "".join(lines))
    return folder


DAY1 = ["1,O1,05/01/2018,07/01/2018,Std,C1,Ann Lee,Consumer,US,Boston\n",
        "1,O1,05/01/2018,08/01/2018,Std,C1,Ann Lee,Consumer,US,Boston\n",
        "2,O2,06/01/2018,07/01/2018,Std,C2,Bo Li,Consumer,US,Boston\n"]
DAY3 = ["3,O3,08/01/2018,09/01/2018,Std,C1,Ann Lee,Consumer,US,Boston\n",
        "4,O4,bad,09/01/2018,Std,C1,Ann Lee,Consumer,US,Boston\n"]


def test_incremental_silver_processes_only_new_days(spark):
    bronze = fresh_path(spark, "bronze_inc")
    silver = fresh_path(spark, "silver_inc")
    md.ingest_bronze(spark, csv(spark, DAY1), bronze, on_bad_date="null")
    ckpt = incremental_silver(spark, bronze, silver)
    first = fs.read_layer(spark, silver)
    assert sorted(r.row_id for r in first.collect()) == [1, 2]
    batch = md.silver_frame(fs.read_layer(spark, bronze))
    assert sorted(map(tuple, first.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))
    # a second delivery appends new bronze files; only their days are rebuilt
    day5 = os.path.join(silver, "year=2018", "month=1", "day=5")
    stamp = {f: os.path.getmtime(os.path.join(day5, f)) for f in os.listdir(day5)}
    src2 = fs.read_csv(spark, csv(spark, DAY3))
    fs.write_partitioned(md.bronze_frame(src2, on_bad_date="null"), bronze, mode="append")
    incremental_silver(spark, bronze, silver, ckpt)
    after = fs.read_layer(spark, silver)
    assert sorted(r.row_id for r in after.collect()) == [1, 2, 3]
    assert {f: os.path.getmtime(os.path.join(day5, f)) for f in os.listdir(day5)} == stamp
    assert after.filter(F.col("row_id") == 1).first().ship_date.day == 7


def test_query_runs_in_three_micro_batches(spark, monkeypatch):
    """Whatever the number of day folders, a later batch meets silver of an earlier one."""
    from tiersmith.plans import registry

    bronze = fresh_path(spark, "bronze_batches")
    lines = [f"{i},O{i},{i + 1:02d}/01/2018,28/02/2018,Std,C1,Ann Lee,Consumer,US,Boston\n" for i in range(9)]
    md.ingest_bronze(spark, csv(spark, lines + lines[:2]), bronze, on_bad_date="null")
    checkpoints = []
    monkeypatch.setattr(registry, "_bronze_path", lambda spark, sf_dir: bronze)
    monkeypatch.setattr(registry, "incremental_silver", lambda *a, **k: checkpoints.append(incremental_silver(*a, **k)))
    assert registry.q_incremental_silver(spark, "").count() == 9
    commits = os.listdir(os.path.join(checkpoints[0].removeprefix("file:"), "commits"))
    assert sum(c.isdigit() for c in commits) == 3
