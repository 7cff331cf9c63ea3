"""Record parsers on made-up lines (FIXTURES.md): good, header and bad rows."""

from tessera.sources import parsers as P

from conftest import lines_df

FLIGHT_HEADER = ("Year,Month,DayofMonth,DayOfWeek,DepTime,CRSDepTime,ArrTime,CRSArrTime,"
                 "UniqueCarrier,FlightNum,TailNum,ActualElapsedTime,CRSElapsedTime,AirTime,"
                 "ArrDelay,DepDelay,Origin,Dest,Distance,TaxiIn,TaxiOut,Cancelled,"
                 "CancellationCode,Diverted,CarrierDelay,WeatherDelay,NASDelay,SecurityDelay,"
                 "LateAircraftDelay")
FLIGHTS = [
    FLIGHT_HEADER,
    "2008,1,3,4,1003,955,1211,1225,AS,335,N100XX,128,150,116,-14,8,SEA,LAX,954,4,8,0,,0,NA,NA,NA,NA,NA",
    "2008,1,4,5,NA,700,NA,930,AS,18,N100YY,NA,150,NA,NA,NA,LAX,SEA,954,NA,NA,1,A,0,NA,NA,NA,NA,NA",
    "2008,1,5,6,10x3,955,1211,1225,AS,9,N1,128,150,116,0,0,SEA,PDX,129,4,8,0,,0,0,0,0,0,0",
    "2008,1,5,6,1003,955,1211,1225,AS,9,N1,128,150,116,0,0,SEA,PDX,129,4,8,0,,0,,,,,",
]


def test_flights(spark):
    good, bad = P.parse_flights(lines_df(spark, FLIGHTS))
    rows = good.orderBy("flightNum").collect()
    assert len(rows) == 3
    by_num = {r["flightNum"]: r for r in rows}
    r = by_num[335]
    assert r["date"].asDict() == {"year": 2008, "month": 1, "dayOfMonth": 3, "dayOfWeek": 4}
    assert r["times"]["depTime"] == 1003 and r["times"]["actualElapsedTime"] == 128
    assert r["times"]["taxiOut"] == 8 and r["distance"] == 954
    assert (r["origin"], r["dest"], r["tailNum"]) == ("SEA", "LAX", "N100XX")
    assert r["carrierDelay"] == -1 and r["cancellationCode"] == ""
    r = by_num[18]
    assert r["canceled"] == 1 and r["cancellationCode"] == "A" and r["times"]["depTime"] == -1
    assert by_num[9]["times"]["depTime"] == -1          # "10x3" is not an int
    assert len(good.columns) == 16
    reasons = sorted(x["reason"] for x in bad.collect())
    assert reasons == ["bad", "header"]
    assert good.count() + bad.count() == len(FLIGHTS)


def test_flights_missing_null(spark):
    good, _ = P.parse_flights(lines_df(spark, FLIGHTS[2:3]), missing=None)
    assert good.first()["times"]["depTime"] is None


def test_airports(spark):
    lines = ['"iata","airport","city","state","country","lat","long"',
             '"AAA","First Field","Alpha","WA","USA",47.1,-122.2',
             '"BBB","Second Field",NA,NA,"Palau",7.3,134.5',
             '"CCC","Bad \\"Q\\" Field","Gamma","OR","USA",45.0,-123.0',
             '"DDD","Dash Field","D","OR","USA",--,-123.0']
    good, bad = P.parse_airports(lines_df(spark, lines))
    rows = {r["iata"]: r for r in good.collect()}
    assert set(rows) == {"AAA", "BBB"}
    assert rows["BBB"]["city"] == "NA" and abs(rows["AAA"]["latitude"] - 47.1) < 1e-5
    assert sorted(r["reason"] for r in bad.collect()) == ["bad", "bad", "header"]


def test_carriers_planes_abbrev(spark):
    good, bad = P.parse_carriers(lines_df(spark, ["Code,Description", '"AS","Alaska Airlines Inc."', "junk"]))
    assert [tuple(r) for r in good.collect()] == [("AS", "Alaska Airlines Inc.")]
    assert bad.count() == 2
    planes = ["tailnum,type,manufacturer,issue_date,model,status,aircraft_type,engine_type,year",
              "N10ZZ",
              "N100XX,Corporation,BOEING,01/02/2003,737-890,Valid,Fixed Wing Multi-Engine,Turbo-Fan,2003",
              "N200XX,Corporation,BOEING,01/02/2003,737-890,Valid,Fixed Wing Multi-Engine,Turbo-Fan,None",
              "X100,Corporation,BOEING,01/02/2003,737-890,Valid,Fixed Wing,Turbo-Fan,2003"]
    good, bad = P.parse_planes(lines_df(spark, planes))
    rows = {r["tailNum"]: r for r in good.collect()}
    assert rows["N10ZZ"]["year"] == 0 and rows["N10ZZ"]["kind"] == ""
    assert rows["N100XX"]["year"] == 2003 and rows["N100XX"]["engineType"] == "Turbo-Fan"
    assert rows["N200XX"]["year"] == -1
    assert sorted(r["reason"] for r in bad.collect()) == ["bad", "header"]
    good, bad = P.parse_abbreviations(lines_df(spark, ["Gen\tGenesis", "a,b\tbad", "noTab"]))
    assert [tuple(r) for r in good.collect()] == [("Gen", "Genesis")]
    assert bad.count() == 2


def test_pairs_ratings_movies_vectors(spark):
    good, bad = P.parse_pairs(lines_df(spark, ["(doc1,Hello World)", "  (d2 , x)  ", "oops"]))
    assert sorted(tuple(r) for r in good.collect()) == [("d2", " x"), ("doc1", "hello world")]
    assert bad.count() == 1
    good, bad = P.parse_ratings(lines_df(spark, ["0::2::3::1424380312", "1::5::1.0", "bad"]))
    assert sorted(tuple(r) for r in good.collect()) == [(0, 2, 3.0), (1, 5, 1.0)]
    assert bad.count() == 1
    good, bad = P.parse_movies(lines_df(spark, ["1::Movie 1::Action|Comedy", "2::only two"]))
    assert good.first()["genres"] == ["Action", "Comedy"]
    assert bad.count() == 1
    good, bad = P.parse_vectors(lines_df(spark, ["0.0 0.0 0.0", "", "9.1 9.1 9.1", "1 x 2"]))
    assert [list(r["features"]) for r in good.collect()] == [[0.0, 0.0, 0.0], [9.1, 9.1, 9.1]]
    assert bad.count() == 1


def test_flight_lines_are_split_once(spark):
    from pyspark.sql import functions as F
    lines = spark.range(3).select(F.concat_ws(",", *[F.col("id").cast("string")] * 30).alias("value"))
    good = P.parse_flights(lines).good.select("date.*", "times.*", "flightNum", "origin", "distance")
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    assert [tuple(r)[:2] for r in good.orderBy("flightNum").collect()] == [(0, 0), (1, 1), (2, 2)]


def test_odd_ints_are_cast_as_before(spark):
    from pyspark.sql import functions as F
    from tessera.functions.strings import java_trim, to_int
    odd = [None, "", " ", "NA", "10x3", "7", " 7 ", "\t-7\n", "+7", "+", "-", "--7", "7.0", ".5", "1e3", "007", "\x7f7\x7f",
           "7 7", "2147483647", "2147483648", "-2147483648", "-2147483649", "99999999999999999999", "٣", "\x857", "0x1"]
    rows = spark.createDataFrame([(x,) for x in odd], "v string")
    got = rows.select(to_int("v").alias("a"), F.coalesce(java_trim("v").try_cast("int"), F.lit(-1)).alias("b"),
                      to_int("v", None).alias("c"), java_trim("v").try_cast("int").alias("d")).collect()
    assert [(r.a, r.c) for r in got] == [(r.b, r.d) for r in got]
