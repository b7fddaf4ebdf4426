"""Sources and sinks on small hand-made files written to a scratch folder."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from tarmac.operators import stations as st
from tarmac.sources import airports as ap
from tarmac.sources import flights as fs
from tarmac.sources import months as mo
from tarmac.sources import sinks
from tarmac.sources import weather as ws
from tarmac.sources.ledger import complete_months, recorded
from tarmac.sources.paths import require_paths
from tarmac.streaming import ingest_monthly_drops

HDR = ('"Year","Month","DayofMonth","FlightDate","IATA_CODE_Reporting_Airline",'
       '"Flight_Number_Reporting_Airline","Origin","OriginCityName","Dest","CRSDepTime",'
       '"DepDelay","Cancelled"')


def _month_csv(path, year, month, rows):
    lines = [HDR] + [f'{year},{month},{d},"{year}-{month:02d}-{d:02d}","AA","{n}","JFK",'
                     f'"New York, NY","LAX","{hhmm}",{delay},{canc}'
                     for d, n, hhmm, delay, canc in rows]
    path.write_text("\n".join(lines) + "\n")


def test_flights_csv_roundtrip(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    _month_csv(land / "m1.csv", 2022, 1, [(1, 10, "0005", -3.0, 0.0), (2, 11, "2400", 12.0, 0.0)])
    # a file with another column order still maps by name
    (land / "m2.csv").write_text(
        '"Month","Year","DayofMonth","FlightDate","IATA_CODE_Reporting_Airline",'
        '"Flight_Number_Reporting_Airline","Origin","Dest","CRSDepTime","DepDelay","Cancelled"\n'
        '2,2022,3,"2022-02-03","DL","7","ATL","BOS"," 600",,1.00\n')
    df = fs.read_flights_csv(spark, str(land))
    rows = {r["flight_number"]: r for r in df.collect()}
    assert rows["10"]["crs_dep_time"] == "0005" and rows["10"]["dep_delay"] == -3.0
    assert rows["7"]["year"] == 2022 and rows["7"]["month"] == 2
    assert rows["7"]["crs_dep_time"] == "600" and rows["7"]["dep_delay"] is None
    assert rows["7"]["origin"] == "ATL"
    out = str(tmp_path / "parquet")
    fs.write_flights(df, out)
    back = fs.read_flights(spark, out, months=[(2022, 1)])
    assert back.count() == 2
    assert mo.existing_months(spark, out).isEmpty()  # data without a record is pending
    with recorded(spark, out, [(2022, 1), (2022, 2), (2022, 5)]):
        assert mo.existing_months(spark, out).isEmpty()
    existing = mo.existing_months(spark, out)
    pend = mo.pending_months(mo.month_range(spark, "2022-01", "2022-03"), existing)
    assert [(r.year, r.month) for r in pend.collect()] == [(2022, 3)]
    assert mo.pending_months(mo.month_range(spark, "2022-01", "2022-03"), existing,
                             overwrite=True).count() == 3


def test_stream_ingest_only_new_files(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    _month_csv(land / "2022_1.csv", 2022, 1, [(1, 1, "0700", 1.0, 0.0)])
    assert ingest_monthly_drops(spark, str(land), out, ck) == 1
    _month_csv(land / "2022_2.csv", 2022, 2, [(1, 2, "0800", 2.0, 0.0), (2, 3, "0900", 3.0, 0.0)])
    assert ingest_monthly_drops(spark, str(land), out, ck) == 1       # only the new file
    got = spark.read.parquet(out).groupBy("month").count().orderBy("month").collect()
    assert [(r.month, r["count"]) for r in got] == [(1, 1), (2, 2)]
    assert ingest_monthly_drops(spark, str(land), out, ck) == 0       # nothing new


def test_csv_folder_with_space_wide_files_and_blank_names(spark, tmp_path):
    from tarmac.sources.csvmap import read_csv_files
    land = tmp_path / "on time [x]+1"
    land.mkdir()
    wide = [f"c{i}" for i in range(200)]
    (land / "wide file.csv").write_text(",".join(wide) + "\n" + ",".join(str(i) for i in range(200)) + "\n")
    (land / "blank.csv").write_text('c0,,c2,c2,\n1,2,3,4,5\nYear,x,y,z,\n')
    (land / "empty.csv").write_text("")
    rows = {(r.c0, r.c2): r for r in read_csv_files(spark, str(land)).collect()}
    assert set(rows) == {("0", "2"), ("1", "3"), ("Year", "y")}
    assert rows["0", "2"].c199 == "199" and rows["1", "3"].c199 is None and rows["1", "3"].c2_2 == "4"
    assert rows["0", "2"]["_file"].endswith("/on time [x]+1/wide file.csv")
    _month_csv(land / "m 1.csv", 2022, 1, [(1, 10, "0005", -3.0, 0.0)])
    got = fs.read_flights_csv(spark, str(land / "m 1.csv")).collect()
    assert len(got) == 1 and got[0].OriginCityName == "New York, NY" and got[0].flight_number == "10"


def test_two_thousand_files_with_three_headers(spark, tmp_path):
    """Headers come from one job; the driver opens no file and sends no list of files."""
    from tarmac.sources.csvmap import read_csv_files
    heads = ["id,a,b", "b,id", "id,x y,a"]
    rows = {0: "{k},a{k},b{k}", 1: "b{k},{k}", 2: "{k},x{k},a{k}"}
    for k in range(2000):
        folder = tmp_path / "land" / f"d{k % 7}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"f{k}.csv").write_text(heads[k % 3] + "\n" + rows[k % 3].format(k=k) + "\n")
    (tmp_path / "land" / "_temporary").mkdir()
    (tmp_path / "land" / "_temporary" / "half.csv").write_text("id,a\n-1,z\n")
    gateway = spark.sparkContext._gateway._gateway_client
    sent, send = [], type(gateway).send_command
    try:
        type(gateway).send_command = lambda self, *a, **kw: (sent.append(1), send(self, *a, **kw))[1]
        df = read_csv_files(spark, str(tmp_path / "land"))
    finally:
        type(gateway).send_command = send
    assert len(sent) < 2000
    got = {int(r.id): r for r in df.collect()}
    assert set(got) == set(range(2000)) and set(df.columns) == {"_file", "id", "a", "b", "x y"}
    for k, r in got.items():
        assert (r.a, r.b, r["x y"]) == ((f"a{k}", f"b{k}", None), (None, f"b{k}", None), (f"a{k}", None, f"x{k}"))[k % 3]
        assert r["_file"].endswith(f"/d{k % 7}/f{k}.csv")


def test_only_wanted_stations_are_opened(spark, tmp_path):
    """Files of other stations are broken: reading them would fail or show."""
    for s in ("A1", "B2"):
        with gzip.open(tmp_path / f"{s}.csv.gz", "wt") as f:
            f.write(f"year,month,day,hour,temp\n2022,1,1,{len(s)},{ord(s[0])}\n")
    (tmp_path / "C3.csv.gz").write_bytes(b"this is no gzip file")
    want = spark.createDataFrame([("A1",), ("B2",), ("Z9",)], "station_id string")
    got = ws.read_weather(spark, str(tmp_path), stations=want)
    assert {(r.station_id, r.temp) for r in got.collect()} == {("A1", 65.0), ("B2", 66.0)}
    (tmp_path / "C3.csv.gz").unlink()
    old, ws.MAX_PICKED = ws.MAX_PICKED, 1
    try:
        far = ws.read_weather(spark, str(tmp_path), stations=want.where("station_id <> 'B2'"))
        assert {r.station_id for r in far.collect()} == {"A1"}
    finally:
        ws.MAX_PICKED = old


def test_ledger_holds_failed_and_repeated_runs(spark, tmp_path):
    root = str(tmp_path / "root")
    months = lambda: {(r.year, r.month) for r in complete_months(spark, root).collect()}
    assert months() == set()
    with recorded(spark, root, [(2022, 1), (2022, 2)]) as first:
        pass
    assert months() == {(2022, 1), (2022, 2)}
    with pytest.raises(RuntimeError):
        with recorded(spark, root, [(2022, 2), (2022, 3)]):
            raise RuntimeError("lost")
    assert months() == {(2022, 1)}  # the month that was being replaced is pending again
    with recorded(spark, root, [(2022, 2)], {(2022, 2): "from"}) as again:
        pass
    rows = {(r.year, r.month): (r.run, r.source) for r in complete_months(spark, root).collect()}
    assert rows == {(2022, 1): (first, None), (2022, 2): (again, "from")}


def test_stream_and_batch_share_a_root(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    out = str(tmp_path / "out")
    _month_csv(land / "jan.csv", 2022, 1, [(1, 1, "0700", 1.0, 0.0)])
    with recorded(spark, out, [(2022, 1)]):
        fs.write_flights(fs.read_flights_csv(spark, str(land)), out)
    _month_csv(land / "more.csv", 2022, 1, [(2, 2, "0700", 1.0, 0.0), (3, 3, "0700", 1.0, 0.0)])
    _month_csv(land / "feb.csv", 2022, 2, [(2, 4, "0700", 1.0, 0.0)])
    ingest_monthly_drops(spark, str(land), out, str(tmp_path / "ck"))
    assert {r.flight_number for r in fs.read_flights(spark, out).collect()} == {"1", "2", "3", "4"}
    assert fs.read_flights(spark, out).count() == 4
    assert {(r.year, r.month) for r in mo.existing_months(spark, out).collect()} == {(2022, 1), (2022, 2)}


def test_stream_keeps_every_file_of_a_month(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for k in range(6):
        _month_csv(land / f"part {k}.csv", 2022, 1, [(k + 1, k, "0700", 1.0, 0.0)])
    ingest_monthly_drops(spark, str(land), out, ck, files_per_batch=2)
    assert spark.read.parquet(out).count() == 6
    _month_csv(land / "late.csv", 2022, 1, [(9, 99, "0700", 1.0, 0.0)])
    ingest_monthly_drops(spark, str(land), out, ck)
    assert spark.read.parquet(out).count() == 7
    # the same files through a new checkpoint write the same rows again
    ingest_monthly_drops(spark, str(land), out, str(tmp_path / "ck2"), files_per_batch=1)
    assert spark.read.parquet(out).count() == 7


def test_airports_and_stations(spark, tmp_path):
    a = tmp_path / "airports.dat"
    a.write_text('1,"Kennedy","New York","United States","JFK","KJFK",40.6,-73.7,13,-5,"A",'
                 '"America/New_York","airport","x"\n'
                 '2,"Nowhere","X","Y",\\N,"ZZZZ",0,0,0,0,"U",\\N,"airport","x"\n'
                 '3,"Empty zone","X","Y","EEE","KEEE",0,0,0,0,"U","","airport","x"\n')
    air = ap.read_airports(spark, str(a))
    rows = air.collect()
    assert rows[1]["iata"] == "\\N" and rows[1]["tz"] == "\\N"
    assert [r.iata for r in st.sentinel_filter(air).collect()] == ["JFK"]
    js = tmp_path / "stations.json.gz"
    with gzip.open(js, "wt") as f:
        json.dump([{"id": "72503", "identifiers": {"icao": "kjfk", "wmo": "1"}},
                   {"id": "00001", "identifiers": {"icao": None}}], f)
    cache = str(tmp_path / "stations.parquet")
    s = ap.read_stations(spark, str(js), cache)
    assert sorted(r.id for r in s.collect()) == ["00001", "72503"]
    assert ap.read_stations(spark, str(js), cache).count() == 2       # cache hit
    assert "wmo" in str(spark.read.parquet(cache).schema)             # the whole dictionary
    smap = st.station_map(st.sentinel_filter(air), s).collect()
    assert [(r.iata, r.station_id) for r in smap] == [("JFK", "72503")]
    flights = spark.createDataFrame([("JFK",)], "origin string")
    assert st.airport_xwalk(air, flights, s).count() == 0             # case-sensitive


def test_weather_files_with_missing_columns(spark, tmp_path):
    d = tmp_path / "2022"
    d.mkdir()
    with gzip.open(d / "72503.csv.gz", "wt") as f:
        f.write("year,month,day,hour,temp,dwpt,rhum,prcp,snow,wdir,wspd,wpgt,pres,tsun,coco\n"
                "2022,1,1,0,1.5,,80,0,,200,10,,1010,,3\n2022,2,1,0,2.0,,80,0,,200,10,,1010,,3\n")
    with gzip.open(d / "72504.csv.gz", "wt") as f:       # no tsun, other order
        f.write("year,month,day,hour,coco,temp,rhum,prcp,wdir,wspd,pres\n"
                "2022,1,1,5,7,-3.0,50,1.2,90,5,1000\n")
    w = ws.read_weather(spark, [str(d / "72503.csv.gz"), str(d / "72504.csv.gz")], 2022, 1)
    rows = {r.station_id: r for r in w.collect()}
    assert set(rows) == {"72503", "72504"}
    assert rows["72504"]["tsun"] is None and rows["72504"]["temp"] == -3.0
    assert rows["72504"]["coco"] == 7
    assert str(rows["72503"]["time"]) == "2022-01-01 00:00:00"
    assert dict(w.dtypes)["tsun"] == "double"


def test_sinks_and_guards(spark, tmp_path):
    m = spark.createDataFrame([("a", "test", 3, 1.5)], "model string, split string, n long, mae double")
    p = str(tmp_path / "metrics")
    sinks.write_small_csv(m, p)
    both = sinks.append_metrics(spark, m.withColumn("model", F.lit("b")), p,
                                "model string, split string, n long, mae double")
    assert sorted(r.model for r in both.collect()) == ["a", "b"]
    with pytest.raises(ValueError, match="no train feature at"):
        require_paths(spark, [str(tmp_path / "nope")], "train feature")


def test_model_persistence_roundtrip(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, y double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             LinearRegression(labelCol="y")]).fit(df)
    path = str(tmp_path / "model")
    sinks.save_model(spark, model, path, {"levels": {"carrier": ["AA", "other"]}, "best_lambda": 0.1})
    back, meta = sinks.load_model(spark, path)
    assert meta["best_lambda"] == 0.1 and meta["levels"]["carrier"] == ["AA", "other"]
    pred = back.transform(df).select("prediction").first()[0]
    assert abs(pred - 1.0) < 1e-6


def test_a_month_of_flights_is_written_by_several_tasks(spark, tmp_path):
    from tarmac.plans.registry import QUERIES
    (spark.range(0, 20_000, 1, 8).selectExpr("id as event_id", "timestamp_seconds(1704067200 + id % 86400) as ts", "'AA' as event_type",
                                             "id as user_id", "cast(id % 90 as double) as value")
     .write.parquet(str(tmp_path / "events.parquet")))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "40k")
    try:
        back = QUERIES["flights_csv_roundtrip"](spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len({f.rpartition("/")[2] for f in back.inputFiles()}) > 2
    assert [r.flight_id for r in back.select("flight_id").orderBy("flight_id").collect()] == list(range(20_000))
    assert {(r.year, r.month) for r in back.select("year", "month").distinct().collect()} == {(2024, 1)}
