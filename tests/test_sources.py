import datetime as dt

import pytest
from conftest import day, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.operators import signals, star
from shelfcast.sinks import Release, read_table, write_by_month, write_table
from shelfcast.sources import (
    Database,
    Intake,
    RejectCounts,
    check_rejects,
    count_rejects,
    read_csv,
    read_csv_text,
    read_weather,
    weather,
)
from shelfcast.sources.weather import file_profile, read_lines

HEADER = ",".join([schemas.WEATHER_TIME, *schemas.WEATHER_MEASURES])
TOP = "latitude,longitude,timezone\n-0.18,-78.5,GMT-5\n\n"


def _csv(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_by_name_with_extra_columns_and_bad_values(spark, tmp_path):
    path = _csv(
        tmp_path,
        "train.csv",
        "id,onpromotion,date,store_nbr,item_nbr,unit_sales\n"
        "0,,2013-01-01,25,103665,7.0\n"
        "1,True,2013-01-02,25,x,-1\n"
        "2,False,someday,26,105574,0.125\n"
        "3,maybe,,,,\n",
    )
    assert rows(read_csv(spark, path, schemas.SALES)) == sorted(
        [
            (day("2013-01-01"), 25, 103665, 7.0, None),
            (day("2013-01-02"), 25, None, -1.0, True),
            (None, 26, 105574, 0.125, False),
            (None, None, None, None, None),
        ],
        key=repr,
    )
    rejects = count_rejects(read_csv_text(spark, path), schemas.SALES).first()
    assert rejects.asDict() == {
        "date": 1, "store_nbr": 0, "item_nbr": 1, "unit_sales": 0, "onpromotion": 1,
    }


def test_csv_reads_only_contract_columns(spark, tmp_path):
    path = _csv(tmp_path, "oil.csv", "date,note,dcoilwtico\n2013-01-01,a,93.1\n2013-01-02,b,\n")
    oil = read_csv(spark, path, schemas.OIL)
    assert rows(oil) == [(day("2013-01-01"), 93.1), (day("2013-01-02"), None)]
    scan = oil._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<date:string,dcoilwtico:string>" in scan


def test_csv_glob_and_missing_columns(spark, tmp_path):
    for i in (1, 2):
        _csv(tmp_path, f"oil{i}.csv", f"date,dcoilwtico\n2013-01-0{i},{i}\n")
    found = read_csv(spark, f"{tmp_path}/*.csv", schemas.OIL)
    assert rows(found) == [(day("2013-01-01"), 1.0), (day("2013-01-02"), 2.0)]
    with pytest.raises(ValueError, match="store_nbr"):
        read_csv(spark, f"{tmp_path}/*.csv", schemas.TRANSACTIONS)
    _csv(tmp_path, "oil3.csv", "dcoilwtico,date\n3,2013-01-03\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, f"{tmp_path}/*.csv", schemas.OIL).collect()


def _weather(folder):
    _csv(
        folder,
        "El Carmen.csv",
        f"{TOP}{HEADER}\n2013-01-01 0:00,10,0.5,0.25,80,9\n2013-01-01 13:00,20,,0,60,21\n"
        "2013-01-02 0:00,5,0,0,90,4\n",
    )
    _csv(folder, "Quito.csv", f"{HEADER}\n2013-01-01 9:00,1,2,3,4,bad\n")
    return str(folder / "*.csv")


def test_weather_files(spark, tmp_path):
    hourly = read_weather(spark, _weather(tmp_path))
    assert hourly.columns == ["ts", "date", "city_norm", *schemas.WEATHER_MEASURES.values()]
    stamp = dt.datetime(2013, 1, 1, 13)
    found = {(row.city_norm, row.ts): row for row in hourly.collect()}
    assert len(found) == 4
    assert found["el carmen", stamp].temp_c == 20.0
    assert found["el carmen", stamp].precip_mm is None
    assert found["quito", dt.datetime(2013, 1, 1, 9)].apparent_c is None
    daily = {(r.city_norm, str(r.date)): r for r in signals.weather_daily(hourly).collect()}
    assert daily["el carmen", "2013-01-01"].temp_avg_c == 15.0
    assert daily["el carmen", "2013-01-01"].precip_total_mm == 0.5
    lines = read_lines(spark, _weather(tmp_path))
    profile = {r.file.rsplit("/", 1)[1]: r for r in file_profile(lines).collect()}
    assert (profile["Quito.csv"].lines, profile["Quito.csv"].data_lines) == (2, 1)
    assert profile["El%20Carmen.csv"].header == HEADER
    assert {r.lost_lines for r in profile.values()} == {0}


def test_weather_times_of_any_shape_are_read_and_others_counted(spark, tmp_path):
    accepted = {
        "2013-01-01 0:00": "2013-01-01 00:00:00",
        "2013-01-01 09:05": "2013-01-01 09:05:00",
        " 2013-01-01 23:59": "2013-01-01 23:59:00",
        "2013-01-02 10:20:30": "2013-01-02 10:20:30",
        "2013-01-03T10:20": "2013-01-03 10:20:00",
        "2013-01-04T10:20:30.5": "2013-01-04 10:20:30.500000",
        '"2013-01-05 1:00"': "2013-01-05 01:00:00",
    }
    refused = [
        "2013", "2013-01-01", "2013-01-01 24:00", "2013-13-01 1:00", "2013-02-30 1:00", "10:00", "noon",
    ]
    lines = [f"{time},1,2,3,4,5" for time in (*refused, *accepted)]
    path = _csv(tmp_path, "Loja.csv", "\n".join([TOP, HEADER, *lines, "", " "]) + "\n")
    found = sorted(str(row.ts) for row in read_weather(spark, path, lost_share=0.5).collect())
    assert found == sorted(accepted.values())
    with pytest.raises(ValueError, match="Loja.csv: 7 of 17"):
        read_weather(spark, path)


def test_weather_file_without_a_readable_time_fails(spark, tmp_path):
    lost = _csv(tmp_path, "Loja.csv", f"{TOP}{HEADER}\n01/02/2013 1:00,1,2,3,4,5\n")
    with pytest.raises(ValueError, match="without a time"):
        read_weather(spark, lost)


def test_items_keep_their_spelling_of_yes(spark, tmp_path):
    for yes, no in (("1.0", "0.0"), ("True", "False"), ("1", "0")):
        path = _csv(
            tmp_path, f"items{yes}.csv",
            f"item_nbr,family,class,perishable\n7.0,A,10,{yes}\n8,B,20,{no}\n",
        )
        items = read_csv(spark, path, schemas.ITEMS)
        assert rows(star.item_dimension(items)) == [(7, "A", 10, True)]


def test_rejects_are_counted_while_writing_and_fail_above_a_share(spark, tmp_path):
    path = _csv(tmp_path, "oil.csv", "date,dcoilwtico\n2013-01-01,1\nsomeday,x\n,2\n")
    counts = RejectCounts()
    write_table(counts.read_csv(spark, path, schemas.OIL, "oil"), str(tmp_path / "oil"))
    rejects = counts.table(spark)
    assert rows(rejects) == [("oil", "date", 1, 3), ("oil", "dcoilwtico", 1, 3)]
    check_rejects(rejects, 0.34)
    with pytest.raises(ValueError, match="dcoilwtico"):
        check_rejects(rejects, 0.3)


def test_weather_dates_do_not_depend_on_the_time_zone(spark, tmp_path, conf):
    path = _weather(tmp_path)
    expected = rows(read_weather(spark, path).select("ts", "date"))
    conf("spark.sql.session.timeZone", "America/Guayaquil")
    assert rows(read_weather(spark, path).select("ts", "date")) == expected


def test_weather_columns_are_found_by_name(spark, tmp_path):
    names = list(schemas.WEATHER_MEASURES)
    header = ",".join(["Time", "extra (%)", *reversed(names)])
    _csv(tmp_path, "Loja.csv", f"{TOP}{header}\n2013-01-01 0:00,99,5,4,3,2,1\n")
    row = read_weather(spark, str(tmp_path)).first()
    assert [row[short] for short in schemas.WEATHER_MEASURES.values()] == [1, 2, 3, 4, 5]


def test_weather_errors(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_weather(spark, f"{tmp_path}/*.csv")
    path = _weather(tmp_path)
    _csv(tmp_path, "Manta.csv", TOP + "2013-01-01 0:00,1,2,3,4,5\n")
    with pytest.raises(ValueError, match="header line in .*Manta.csv"):
        read_weather(spark, path)
    _csv(tmp_path, "Manta.csv", "time,rain (mm)\n")
    with pytest.raises(ValueError, match="different headers"):
        read_weather(spark, path)
    only = _csv(tmp_path, "Manta.csv", "time,rain (mm)\n")
    with pytest.raises(ValueError, match="lacks columns"):
        read_weather(spark, only)


def test_parquet_by_month(spark, tmp_path):
    data = [(day(f"2024-{m:02d}-03"), float(m), 2024, m) for m in (1, 2, 2, 12)]
    df = spark.createDataFrame(data, "date date, y double, year int, month int")
    path = str(tmp_path / "by_month")
    write_by_month(df, path)
    write_by_month(df, path)
    back = read_table(spark, path)
    assert back.schema.simpleString() == "struct<date:date,y:double,year:int,month:int>"
    assert rows(back) == rows(df)
    pruned = back.filter("year = 2024 AND month = 2")
    text = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text
    assert pruned.count() == 2


def test_parquet_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 2):
        write_table(spark.range(n), path)
    assert read_table(spark, path).count() == 2
    assert read_table(spark, path, spark.range(1).schema).count() == 2


class Recorder:
    """Stands in for a Spark reader or writer; keeps what it was asked for."""

    def __init__(self):
        self.read = self.write = self
        self.asked = {}

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **options):
        self.asked.update(options)
        return self

    def mode(self, name):
        self.asked["mode"] = name
        return self

    def load(self):
        return self.asked

    def save(self):
        pass

    def jdbc(self, url, table, **how):
        return {"url": url, "table": table, **how}


ENV = {
    "SHELFCAST_JDBC_URL": "jdbc:x://h/d",
    "SHELFCAST_JDBC_DRIVER": "x.Driver",
    "SHELFCAST_JDBC_USER": "u",
    "SHELFCAST_JDBC_PASSWORD": "secret",
    "SHELFCAST_JDBC_SCHEMA": "retail",
}


def test_database_settings():
    database = Database.from_env(env=ENV)
    assert "secret" not in repr(database)
    assert database.options("fact_sales") == {
        "url": "jdbc:x://h/d",
        "driver": "x.Driver",
        "dbtable": "retail.fact_sales",
        "user": "u",
        "password": "secret",
    }
    assert database.table("other.t") == "other.t"
    assert Database("jdbc:x:d", "x.Driver").options("t") == {
        "url": "jdbc:x:d", "driver": "x.Driver", "dbtable": "t",
    }


def test_database_reads():
    database = Database.from_env(env=ENV)
    plain = database.read(Recorder(), "dim_item")
    assert plain["dbtable"] == "retail.dim_item"
    assert "partitionColumn" not in plain
    split = database.read_split(Recorder(), "fact_sales")
    wanted = {
        "partitionColumn": "store_id", "lowerBound": "1", "upperBound": "54", "numPartitions": "8",
    }
    assert wanted.items() <= split.items()
    other = Database.from_env(
        env=ENV, fact_key="id", fact_bounds=(5, 900), fact_partitions=70, write_connections=3
    )
    wanted = {
        "partitionColumn": "id", "lowerBound": "5", "upperBound": "900", "numPartitions": "70",
    }
    assert wanted.items() <= other.read_fact(Recorder(), "fact_sales").items()
    written = Recorder()
    other.overwrite(written, "dim_item")
    assert written.asked["numPartitions"] == "3"
    parts = Database.from_env(env=ENV, fact_predicates=("a", "b"))
    assert parts.read_fact(Recorder(), "fact_sales")["predicates"] == ["a", "b"]
    ranges = ["store_id < 9", "store_id >= 9 OR store_id IS NULL"]
    by_range = database.read_where(Recorder(), "fact_sales", ranges)
    assert (by_range["table"], by_range["predicates"]) == ("retail.fact_sales", ranges)
    assert "dbtable" not in by_range["properties"]


def test_database_writes(spark, monkeypatch):
    database = Database.from_env(env=ENV)
    plain, bulk = Recorder(), Recorder()
    database.overwrite(plain, "dim_item")
    database.overwrite(bulk, "fact_sales_enriched", transactions=False)
    assert (plain.asked["mode"], plain.asked["format"]) == ("overwrite", "jdbc")
    assert {"batchsize": "5000", "numPartitions": "8"}.items() <= plain.asked.items()
    assert "isolationLevel" not in plain.asked
    assert bulk.asked["isolationLevel"] == "NONE"

    written = []
    monkeypatch.setattr(Database, "overwrite", lambda self, df, name: written.append((df, name)))
    database.check(spark)
    assert [(rows(df), name) for df, name in written] == [([("shelfcast", 1)], "connection_check")]


def test_database_tables_for_the_jobs(spark, monkeypatch):
    """Large tables are read in ranges, small ones over one connection."""
    from shelfcast.plans import features, ingest

    asked = {}

    def reader(kind):
        def read(self, session, name):
            asked[name] = kind
            return session.createDataFrame([("2024-01-01 10:00:00", "Quito ")], "date string, city_norm string")

        return read

    monkeypatch.setattr(Database, "read", reader("whole"))
    monkeypatch.setattr(Database, "read_fact", reader("ranges"))
    database = Database.from_env(env=ENV)
    loaded = ingest.load_star(spark, database)
    assert rows(loaded.fact_sales.select("date")) == [(day("2024-01-01"),)]
    found = features.load_features(spark, database)
    assert rows(found.oil.select("date")) == [(day("2024-01-01"),)]
    assert rows(found.weather) == [(day("2024-01-01"), "quito")]
    # stored on the way, so joins with them are planned by their size
    for table in (loaded.dim_item, loaded.dim_store, found.weather):
        size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        assert int(str(size)) < 10_000
    split = {name for name, kind in asked.items() if kind == "ranges"}
    assert split == {"fact_sales", "feat_transactions_daily"}
    assert len(asked) == 7


def test_every_bad_value_is_kept_with_its_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "x,date,store_nbr,item_nbr,unit_sales,onpromotion\n"
        ",2013-01-01,1,7.0,2,\n"
        ",2013-13-01,one,7,2,maybe\n"
        ",2013-01-01,1,7\n"
        ",2013-01-01,1,7,1,True,9,9\n",
        encoding="utf-8",
    )
    (tmp_path / "b.csv").write_text(
        "x,date,store_nbr,item_nbr,unit_sales,onpromotion\n,2013-01-01,1,7,1,5\n", encoding="utf-8"
    )
    intake = Intake()
    read = intake.read_csv(spark, f"{tmp_path}/*.csv", schemas.SALES, "sales")
    assert rows(read) == rows(read_csv(spark, f"{tmp_path}/*.csv", schemas.SALES))
    bad = intake.bad_values()
    assert rows(bad.withColumn("file", F.right("file", F.lit(5)))) == sorted(
        [
            ("sales", "a.csv", "date", "2013-13-01"),
            ("sales", "a.csv", "store_nbr", "one"),
            ("sales", "a.csv", "onpromotion", "maybe"),
            ("sales", "a.csv", "(line)", ",2013-01-01,1,7"),
            ("sales", "a.csv", "(line)", ",2013-01-01,1,7,1,True,9,9"),
            ("sales", "b.csv", "onpromotion", "5"),
        ],
        key=repr,
    )
    assert {r.column: (r.rejected, r.rows) for r in intake.counts().collect()} == {
        "date": (1, 5),
        "store_nbr": (1, 5),
        "item_nbr": (0, 5),
        "unit_sales": (0, 5),
        "onpromotion": (2, 5),
        "(line)": (2, 5),
    }
    (tmp_path / "c.csv").write_text("x,date\n", encoding="utf-8")
    with pytest.raises(ValueError, match="missing columns"):
        intake.read_csv(spark, f"{tmp_path}/c.csv", schemas.SALES, "sales")


def test_weather_lines_lost_without_a_header(spark, tmp_path):
    names = [schemas.WEATHER_TIME, *schemas.WEATHER_MEASURES]
    good = "2016-01-01 1:00,1,2,3,4,5"
    (tmp_path / "Quito.csv").write_text(f"2016-01-01,1\n{good}\nbroken\n", encoding="utf-8")
    with pytest.raises(ValueError, match="Quito.csv: 2 of 3"):
        read_weather(spark, f"{tmp_path}/*.csv", names)
    assert read_weather(spark, f"{tmp_path}/*.csv", names, lost_share=0.7).count() == 1
    (tmp_path / "Quito.csv").write_text(f"{good}\n{good.replace('4', 'x')}\n", encoding="utf-8")
    assert read_weather(spark, f"{tmp_path}/*.csv", names).count() == 2
    lines = weather.read_lines(spark, f"{tmp_path}/*.csv")
    assert [r[2:] for r in rows(weather.bad_values(lines, names))] == [(names[4], "x")]


def test_tables_are_published_together_or_not_at_all(spark, tmp_path, monkeypatch):
    out = str(tmp_path)

    def stored(name):
        return read_table(spark, f"{out}/{name}").first()[0]

    for version in (1, 2):
        with Release(spark, out) as release:
            for name in ("a", "b"):
                release.write(spark.createDataFrame([(version,)], "v int"), name)
            release.publish("a", "b")
        assert stored("a") == stored("b") == version
    with pytest.raises(RuntimeError), Release(spark, out) as release:
        release.write(spark.createDataFrame([(3,)], "v int"), "a")
        raise RuntimeError("a check failed")
    assert stored("a") == 2
    with pytest.raises(OSError, match="cannot move"), Release(spark, out) as release:
        release.write(spark.createDataFrame([(3,)], "v int"), "a")
        release.publish("a", "b")  # b was never written
    assert stored("a") == stored("b") == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]
