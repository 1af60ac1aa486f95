import json

from kestrel.operators import traffic as tr
from kestrel.sources.files import read_traffic_json

SCHEMA = "ORIGIN_COUNTRY_NAME string, DEST_COUNTRY_NAME string, COUNT long, YEAR int"


def _t(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_outwardness_hand_rows(spark):
    # US->MX 30, US->BR 70, MX->US 20, BR->US 80, US->US 500
    t = _t(spark, [("US", "MX", 30, 2010), ("US", "BR", 70, 2010), ("MX", "US", 20, 2010),
                   ("BR", "US", 80, 2010), ("US", "US", 500, 2010)])
    rows = tr.outwardness(t, "US").collect()
    assert [r.COUNTRY_NAME for r in rows] == ["BR", "MX"]
    assert [(round(r.DEST_FREQUENCY, 9), round(r.ORIGIN_FREQUENCY, 9), round(r.OUTWARDNESS, 9))
            for r in rows] == [(70.0, 80.0, -10.0), (30.0, 20.0, 10.0)]


def test_outwardness_shares_sum_to_100_and_full_keeps_one_way(spark):
    t = _t(spark, [("US", "MX", 30, 2010), ("US", "FR", 10, 2011), ("MX", "US", 20, 2010),
                   ("DE", "US", 5, 2012)])
    full = {r.COUNTRY_NAME: r for r in tr.outwardness(t, "US", how="full").collect()}
    assert set(full) == {"MX", "FR", "DE"}
    assert abs(sum(r.DEST_FREQUENCY or 0 for r in full.values()) - 100) < 1e-9
    assert abs(sum(r.ORIGIN_FREQUENCY or 0 for r in full.values()) - 100) < 1e-9
    assert full["FR"].ORIGIN_FREQUENCY is None and full["DE"].DEST_FREQUENCY is None
    inner = tr.outwardness(t, "US").collect()
    assert [r.COUNTRY_NAME for r in inner] == ["MX"]


def test_key_zone_pivot_keeps_listed_columns(spark):
    t = _t(spark, [("US", "MX", 5, 2010)])
    out = tr.key_zone_pivot(t, "US", ["MX", "RU"])
    assert out.columns == ["YEAR", "MX", "RU"]
    assert [tuple(r) for r in out.collect()] == [(2010, 5, None)]


def test_domestic_and_rows_per_year(spark):
    t = _t(spark, [("US", "US", 5, 2010), ("US", "MX", 1, 2010), ("US", "US", 7, 2011)])
    assert tr.domestic_routes(t, "US").count() == 2
    assert sorted(tuple(r) for r in tr.rows_per_year(t).collect()) == [(2010, 2), (2011, 1)]


def test_read_traffic_json_takes_year_from_file_name(spark, tmp_path):
    for year, rows in {2010: [("US", "MX", 3)], 2011: [("MX", "US", 4), ("US", "US", 9)]}.items():
        with open(tmp_path / f"{year}.json", "w") as f:
            for o, d, c in rows:
                f.write(json.dumps({"ORIGIN_COUNTRY_NAME": o, "DEST_COUNTRY_NAME": d,
                                    "count": c}) + "\n")
    df = read_traffic_json(spark, str(tmp_path), [2010, 2011])
    assert df.columns == ["ORIGIN_COUNTRY_NAME", "DEST_COUNTRY_NAME", "COUNT", "YEAR"]
    assert sorted(tuple(r) for r in df.collect()) == [
        ("MX", "US", 4, 2011), ("US", "MX", 3, 2010), ("US", "US", 9, 2011)]
    assert dict(df.dtypes)["COUNT"] == "bigint" and dict(df.dtypes)["YEAR"] == "int"

