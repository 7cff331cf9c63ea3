"""Catalog tables over delimited files (in-memory catalog)."""

import os

from tessera.operators import catalog as cat


def test_external_and_partitioned_tables(spark, tmp):
    air = os.path.join(tmp, "airports")
    os.makedirs(air)
    with open(os.path.join(air, "a.csv"), "w") as f:
        f.write("AAA,First,Alpha,WA,USA,47.1,-122.2\nBBB,Second,Beta,NA,Palau,7.3,134.5\n")
    cols = ("iata STRING, airport STRING, city STRING, state STRING, country STRING, "
            "lat DOUBLE, long DOUBLE")
    cat.create_external_table(spark, "airports_t", cols, air, options={"sep": ","})
    cat.create_external_table(spark, "airports_t", cols, air, options={"sep": ","})  # if absent
    assert "airports_t" in [r["tableName"] for r in cat.show_tables(spark).collect()]
    assert spark.sql("SELECT country, COUNT(*) AS c FROM airports_t GROUP BY country").count() == 2
    for mode in ("", "EXTENDED", "FORMATTED"):
        assert cat.describe(spark, "airports_t", mode).count() >= 7
    fl = os.path.join(tmp, "flights2")
    cat.create_external_table(
        spark, "flights2", "depTime INT, arrTime INT, uniqueCarrier STRING, flightNum INT, "
        "origin STRING, dest STRING, depYear STRING, depMonth STRING, depDay STRING",
        fl, options={"sep": "|"}, partitioned_by=["depYear", "depMonth", "depDay"])
    day = os.path.join(fl, "depYear=2008", "depMonth=01", "depDay=03")
    os.makedirs(day)
    with open(os.path.join(day, "part-0.csv"), "w") as f:
        f.write("1003|1211|AS|335|SEA|LAX\n")
    cat.add_partition(spark, "flights2", {"depYear": "2008", "depMonth": "01", "depDay": "03"}, day)
    cat.add_partition(spark, "flights2", {"depYear": "2008", "depMonth": "01", "depDay": "03"}, day)
    parts = [r[0] for r in cat.show_partitions(spark, "flights2").collect()]
    assert parts == ["depYear=2008/depMonth=01/depDay=03"]
    r = spark.sql("SELECT * FROM flights2 WHERE depDay = '03'").first()
    assert (r["flightNum"], r["depMonth"]) == (335, "01")
    cat.drop_table(spark, "airports_t")
    cat.drop_table(spark, "flights2")
    assert os.path.exists(os.path.join(air, "a.csv"))       # external data stays
