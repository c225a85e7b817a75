"""The batch jobs, from raw files to the training table."""

import datetime as dt
import os
import random
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.__main__ import main
from shelfcast.plans import audit, boosting, features, ingest, training
from shelfcast.session import run_folder
from shelfcast.sinks import read_table, write_table

START = dt.date(2016, 1, 1)
DAYS = 60


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    rng = random.Random(7)
    raw, out = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("out")
    dates = [START + dt.timedelta(days=i) for i in range(DAYS)]

    def write(name, header, lines):
        (raw / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")

    write("items.csv", "item_nbr,family,class,perishable",
          ["1,DAIRY,10,1", "2,BREAD/BAKERY,20,1", "3,CLEANING,30,0"])
    write("stores.csv", "store_nbr,city,state,type,cluster",
          ["1,El Carmen,Manabi,A,1", "2,Quito,Pichincha,D,13"])
    sales = [
        f"{d},{s},{i},{rng.randrange(-20, 200) / 8},{rng.choice(['True', 'False', ''])}"
        for d in dates for s in (1, 2) for i in (1, 2, 3)
    ]
    write("train.csv", "id,date,store_nbr,item_nbr,unit_sales,onpromotion",
          [f"{n},{line}" for n, line in enumerate(sales)])
    write("oil.csv", "date,dcoilwtico", [f"{d},{'' if d.day == 1 else 40 + d.day}" for d in dates])
    write("transactions.csv", "date,store_nbr,transactions",
          [f"{d},{s},{d.day * s}" for d in dates[::2] for s in (1, 2)])
    write("holidays_events.csv", "date,type,locale,locale_name,description,transferred",
          [f"{dates[9]},Holiday,National,Ecuador,x,False", f"{dates[9]},Event,Local,Quito,y,True"])
    header = ",".join([schemas.WEATHER_TIME, *schemas.WEATHER_MEASURES])
    (raw / "weather").mkdir()
    for city in ("El Carmen", "Quito"):
        lines = [f"{d} {h}:00,{h},0.5,0,80,{h + 1}" for d in dates for h in (0, 6, 12, 18)]
        write(f"weather/{city}.csv", f"latitude,longitude\n-0.2,-78.5\n\n{header}", lines)
    return str(raw), str(out)


def test_jobs_end_to_end(spark, folders, capsys):
    raw, out = folders
    main(["ingest", "--raw", raw, "--out", out])
    main(["weather", "--raw", f"{raw}/weather", "--out", out])
    main(["features", "--raw", raw, "--out", out])
    for job in ("enrich", "base", "train", "forecast", "evaluate", "check-weather", "audit"):
        main([job, "--out", out])

    tables, signals = ingest.read_star(spark, out), features.read_features(spark, out)
    fact = tables.fact_sales
    assert fact.columns == schemas.FACT_SALES
    assert fact.filter("item_id = 3 OR unit_sales < 0").count() == 0
    assert signals.weather.count() == 2 * DAYS
    assert signals.holidays.count() == 1

    enriched = read_table(spark, f"{out}/fact_sales_enriched")
    assert enriched.columns == schemas.ENRICHED_SALES
    assert enriched.count() == fact.count()
    assert enriched.filter("temp_avg_c IS NULL").count() == 0
    assert {r.temp_avg_c for r in enriched.select("temp_avg_c").distinct().collect()} == {9.0}

    base = read_table(spark, f"{out}/model_base")
    assert base.columns == schemas.MODEL_BASE

    table = read_table(spark, f"{out}/model_train")
    assert table.columns[-2:] == ["year", "month"]
    assert sorted(table.columns) == sorted(schemas.MODEL_TRAIN)
    lengths = fact.groupBy("store_id", "item_id").count().collect()
    assert table.count() == sum(max(0, row["count"] - 28) for row in lengths)

    for name in (
        "forecasts", "forecast_errors", "feature_importance", "weather_rows_per_city",
        "error_interval", "permutation_importance", "adjusted_effects", "backtest_errors",
        "smoothed_demand", "monthly_sketches",
    ):
        assert read_table(spark, f"{out}/{name}").count()
    rejects = read_table(spark, f"{out}/ingest_rejects").unionAll(
        read_table(spark, f"{out}/feature_rejects")
    )
    assert {r.rejected for r in rejects.collect()} == {0}
    assert {r.input for r in rejects.collect()} == {
        "items", "stores", "sales", "oil", "transactions", "holidays",
    }
    assert {r.lost_lines for r in read_table(spark, f"{out}/weather_files").collect()} == {0}
    assert not os.path.exists(run_folder(spark).removeprefix("file:"))

    shown = capsys.readouterr().out
    assert "moving_average" in shown and "boosted" in shown and "lag_1" in shown
    assert "el carmen" in shown and "fact_sales" in shown and "temp_avg_c: double" in shown

    counts = dict(rows(audit.row_counts(tables, signals, enriched=enriched)))
    assert counts["enriched"] == counts["fact_sales"]


def test_copies_are_compared_whatever_their_order(spark, folders):
    stages = audit.stages(
        ingest.read_star(spark, folders[1]), features.read_features(spark, folders[1])
    )
    moved = {name: table.orderBy(F.rand(3)) for name, table in stages.items()}
    audit.check_copies(stages, moved)
    moved["oil"] = moved["oil"].limit(3)
    with pytest.raises(ValueError, match=r"differ: \['oil'\]"):
        audit.check_copies(stages, moved)


def test_updates_of_the_training_table(spark, folders, tmp_path):
    raw, out = folders
    for name in ("dim_item", "dim_store", "fact_sales", *features.TABLES.values()):
        write_table(read_table(spark, f"{out}/{name}"), f"{tmp_path}/{name}")
    whole = read_table(spark, f"{out}/model_train")
    for more in (["--monthly"], ["--since", "2016-02-10"]):
        main(["train", "--out", str(tmp_path), *more])
        found = read_table(spark, f"{tmp_path}/model_train")
        assert rows(found.select(whole.columns)) == rows(whole)


def test_weather_with_known_columns(spark, folders, tmp_path):
    raw, out = folders
    columns = ",".join([schemas.WEATHER_TIME, *schemas.WEATHER_MEASURES])
    main(["weather", "--raw", f"{raw}/weather", "--out", str(tmp_path), "--columns", columns])
    assert rows(read_table(spark, f"{tmp_path}/weather_daily")) == rows(
        read_table(spark, f"{out}/weather_daily")
    )


def test_boosted_forecast(spark, folders):
    table = read_table(spark, f"{folders[1]}/model_train")
    fit = boosting.fit(table, trees=3, depth=2)
    assert set(fit.importances()) == set(boosting.FEATURES)
    assert sum(fit.importances().values()) == pytest.approx(1.0)
    cut = boosting.split_date(table)
    assert fit.forecasts.count() == table.filter(table.date > cut).count() > 0
    assert set(boosting.ENCODED) <= set(boosting.FEATURES)
    lost = {r.feature: r.importance for r in fit.permutation_importance().collect()}
    assert set(lost) == set(boosting.FEATURES)
    unused = [name for name, worth in fit.importances().items() if worth == 0]
    assert unused and all(lost[name] == pytest.approx(0, abs=1e-9) for name in unused)
    assert max(lost.values()) > 0
    overall = {r.model: r.n for r in fit.comparison().collect() if r.family == "(all)"}
    assert set(overall) == {"naive", "seasonal_naive", "moving_average", "boosted"}
    assert set(overall.values()) == {fit.forecasts.count()}


def test_train_refuses_signals_that_multiply_sales(spark, folders, tmp_path):
    raw, out = folders
    tables, signals = ingest.read_star(spark, out), features.read_features(spark, out)
    twice = features.FeatureTables(
        signals.oil.unionAll(signals.oil), signals.transactions, signals.holidays, signals.weather
    )
    audit.check_unique(tables, signals)
    with pytest.raises(ValueError, match="'oil', 'repeated_keys': 60"):
        audit.check_unique(tables, twice)


def test_two_spellings_of_a_city_are_found_by_the_key_check(spark, folders, tmp_path):
    raw, out = folders
    signals = features.read_features(spark, out)
    for field, name in features.TABLES.items():
        table = getattr(signals, field)
        if field == "weather":
            again = table.withColumn("city_norm", F.initcap("city_norm"))
            table = table.unionAll(again.where("city_norm = 'Quito'"))
        write_table(table, f"{tmp_path}/{name}")
    twice = features.read_features(spark, str(tmp_path))
    with pytest.raises(ValueError, match="'weather', 'repeated_keys': 60"):
        audit.check_unique(ingest.read_star(spark, out), twice)


def test_daily_sales_that_repeat_a_date_fail(spark, folders, tmp_path):
    tables = ingest.read_star(spark, folders[1])
    signals = features.read_features(spark, folders[1])
    training.run_training(spark, tables, signals, str(tmp_path), daily=True)
    first = tables.fact_sales.where("store_id = 1 AND item_id = 1").orderBy("date").limit(1)
    twice = replace(tables, fact_sales=tables.fact_sales.unionAll(first))
    with pytest.raises(Exception, match="a series repeats a date"):
        training.run_training(spark, twice, signals, str(tmp_path), daily=True)


def test_values_that_do_not_parse_fail_the_job(spark, folders, tmp_path):
    raw, out = folders
    for name in ("items.csv", "stores.csv", "train.csv"):
        text = open(f"{raw}/{name}", encoding="utf-8").read()
        (tmp_path / name).write_text(text.replace("True", "maybe"), encoding="utf-8")
    with pytest.raises(ValueError, match="onpromotion"):
        ingest.run(spark, str(tmp_path), str(tmp_path / "out"))
    assert sorted(os.listdir(tmp_path / "out")) == ["ingest_quarantine", "ingest_rejects"]
    ingest.run(spark, str(tmp_path), str(tmp_path / "out"), reject_share=0.6)
    bad = read_table(spark, str(tmp_path / "out" / "ingest_quarantine"))
    assert {(r.input, r.column, r.text) for r in bad.collect()} == {("sales", "onpromotion", "maybe")}


def test_a_failed_job_leaves_the_stored_tables(spark, folders, tmp_path):
    raw, _ = folders
    (tmp_path / "raw" / "weather").mkdir(parents=True)
    for path, _, names in os.walk(raw):
        for name in names:
            text = open(f"{path}/{name}", encoding="utf-8").read()
            target = tmp_path / "raw" / os.path.relpath(path, raw) / name
            target.write_text(text, encoding="utf-8")
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    jobs = {
        "train.csv": lambda: ingest.run(spark, raw, out),
        "weather/Quito.csv": lambda: features.run_weather(spark, f"{raw}/weather", out),
        "oil.csv": lambda: features.run(spark, raw, out),
    }
    for job in jobs.values():
        job()
    reports = ("rejects", "quarantine", "files")
    names = [name for name in os.listdir(out) if not name.endswith(reports)]
    before = {name: rows(read_table(spark, f"{out}/{name}")) for name in names}
    files = {name: sorted(os.listdir(f"{out}/{name}")) for name in names}
    for name, job in jobs.items():
        path = tmp_path / "raw" / name
        path.write_text(path.read_text(encoding="utf-8").replace("2016-01-1", "16/1/1"), "utf-8")
        with pytest.raises(ValueError):
            job()
    assert {name: sorted(os.listdir(f"{out}/{name}")) for name in names} == files
    assert {name: rows(read_table(spark, f"{out}/{name}")) for name in names} == before
    for name in ("ingest", "feature", "weather"):
        bad = read_table(spark, f"{out}/{name}_quarantine")
        assert bad.where("text LIKE '16/1/1%'").count() > 0


def test_rejects_of_sales_that_nothing_joins(spark, tmp_path):
    for name, text in {
        "items.csv": "item_nbr,family,class,perishable\n1,A,1,0\n",
        "stores.csv": "store_nbr,city,state,type,cluster\n1,Q,P,A,1\n",
        "train.csv": "date,store_nbr,item_nbr,unit_sales,onpromotion\n2013-01-01,1,x,2,\n",
    }.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    built = ingest.run(spark, str(tmp_path), str(tmp_path / "out"), reject_share=1)
    assert built.fact_sales.count() == 0
    rejects = read_table(spark, str(tmp_path / "out" / "ingest_rejects"))
    assert rows(rejects.where("rejected > 0")) == [("sales", "item_nbr", 1, 1)]


def test_job_arguments():
    for arguments in (["ingest", "--out", "x"], ["train"], ["nothing", "--out", "x"]):
        with pytest.raises(SystemExit):
            main(arguments)
