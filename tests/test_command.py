"""The start command: months and flags reach the jobs."""

import json

import pytest

from tarmac import __main__ as cmd


@pytest.fixture
def landed(spark, tmp_path):
    head = '"Year","Month","DayofMonth","FlightDate","IATA_CODE_Reporting_Airline","Flight_Number_Reporting_Airline","Origin","Dest","CRSDepTime","DepDelay","Cancelled"'
    land = tmp_path / "land"
    land.mkdir()
    for m in (1, 2, 3):
        (land / f"m{m}.csv").write_text(head + f'\n2022,{m},5,"2022-{m:02d}-05","AA","{m}","JFK","LAX","0700",{m}.00,0.00\n')
    (tmp_path / "airports.dat").write_text('1,"Kennedy","NY","US","JFK","KJFK",0,0,0,0,"A","America/New_York","airport","x"\n')
    (tmp_path / "stations.json").write_text(json.dumps([{"id": "72503", "identifiers": {"icao": "KJFK"}}]))
    (tmp_path / "72503.csv").write_text("year,month,day,hour,temp\n2022,1,5,12,1.0\n2022,2,5,12,2.0\n")
    return tmp_path


def call(spark, *argv):
    return cmd.run(cmd.parser().parse_args([str(a) for a in argv]), spark)


def test_stages_from_the_command_line(spark, landed):
    p = landed
    where = ["--airports", p / "airports.dat", "--stations", p / "stations.json"]
    ingest = ["ingest", "--start", "2022-01", "--end", "2022-2", "--flights-csv", p / "land", "--flights", p / "flights",
              "--weather-files", p / "72503.csv", "--weather", p / "weather", *where]
    assert call(spark, *ingest, "--coverage") == [(2022, 1), (2022, 2)]
    assert call(spark, *ingest) == [] and call(spark, *ingest, "--overwrite") == [(2022, 1), (2022, 2)]
    features = ["features", "--start", "2022-01", "--end", "2022-02", "--flights", p / "flights", "--weather", p / "weather",
                *where, "--features", p / "features", "--checks", p / "checks"]
    assert call(spark, *features) == [(2022, 1), (2022, 2)] and call(spark, *features) == []
    assert {(r.month, r.temp) for r in spark.read.parquet(str(p / "features")).collect()} == {(1, 1.0), (2, 2.0)}
    assert spark.read.option("header", True).csv(str(p / "checks" / "count")).first().n == "2"
    tables = call(spark, "eda", "--start", "2022-01", "--end", "2022-12", "--features", p / "features", "--out", p / "eda", "--min-flights", 1)
    assert len(tables) == 15
    assert [r.n for r in spark.read.option("header", True).csv(tables["airport_summary"]).collect()] == ["2"]


def test_bad_months_are_refused(spark, landed):
    for bad in ("2022", "2022-13", "22-01", "2022-00"):
        with pytest.raises(SystemExit):
            cmd.parser().parse_args(["eda", "--start", bad, "--end", "2022-01", "--features", "f", "--out", "o"])
    with pytest.raises(ValueError, match="after"):
        call(spark, "eda", "--start", "2022-02", "--end", "2022-01", "--features", "f", "--out", "o")
    assert cmd._months("2021-11", "2022-02") == [(2021, 11), (2021, 12), (2022, 1), (2022, 2)]
