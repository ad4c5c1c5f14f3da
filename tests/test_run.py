"""Whole runs from seeds to checked marts, and the lifetime of what they store."""

import os
from datetime import datetime

import pytest

from martflow import workspace
from martflow.bindings import agri
from martflow.bindings.testdata import Binding
from martflow.operators.quality import CheckFailed, NotNull
from martflow.plans.run import run_marts

SMALL = "/root/testdata/sf0.001"
AS_OF = datetime(2001, 1, 1)


@pytest.fixture
def given(spark):
    b = Binding(spark, SMALL).shared()
    return b.records, b.seeds


def stored(spark):
    folder = f"{workspace.shared_root(spark).removeprefix('file:')}/martflow"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_a_run_stores_the_marts_and_nothing_else(spark, given, path):
    before = stored(spark)
    done = run_marts(*given, AS_OF, path("marts"))
    assert stored(spark) == before
    for name, where in done.paths.items():
        mart = spark.read.parquet(where)
        assert mart.columns == agri.MARTS[name] and mart.count()
    assert not done.warnings and done.results.where("violations > 0").isEmpty()


def test_a_repeated_key_warns(spark, given, path):
    records, seeds = given
    twice = seeds | {"weather": seeds["weather"].unionByName(seeds["weather"])}
    assert run_marts(records, twice, AS_OF, path("marts")).warnings == ["unique(stg_weather.weather_id): 5"]


def test_an_error_stops_before_anything_is_built(spark, given, path):
    records, seeds = given
    before = stored(spark)
    twice = seeds | {"soil": seeds["soil"].unionByName(seeds["soil"])}
    with pytest.raises(CheckFailed, match="stg_soil.soil_id"):
        run_marts(records, twice, AS_OF, path("marts"), severity="error")
    assert not os.path.exists(path("marts")) and stored(spark) == before


def test_a_mart_that_breaks_its_checks_fails_the_run(spark, given, path):
    with pytest.raises(CheckFailed, match="yield_change_from_previous_year"):
        run_marts(
            *given, AS_OF, path("marts"),
            mart_checks={"seasonal_performance": [NotNull("yield_change_from_previous_year", "error")]},
        )


def test_nested_folders_go_one_by_one(spark):
    with workspace.run_folder(spark) as outer:
        kept = workspace.materialise(spark.range(3), "outer")
        with workspace.run_folder(spark) as inner:
            workspace.materialise(spark.range(3), "inner")
            assert inner.startswith(outer)
        assert kept.count() == 3 and not os.path.exists(inner)
    assert not os.path.exists(outer)
