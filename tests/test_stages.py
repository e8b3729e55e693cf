"""Stored stages: a run that is started again repeats nothing that it has committed."""

import json

import pytest
from pyspark.sql import functions as F

from shelfwright.plans import everything
from shelfwright.plans.everything import StageTables, run_stages
from shelfwright.schemas import CAPTURES, REVIEWED
from shelfwright.sources import versions

NAMES = ["raw", "validated", "settled", "clean", "mapping", "final", "target"]


@pytest.fixture(scope="module")
def inputs(spark):
    payload = json.dumps({"data": [{"name": n, "url_path": n, "thumbnail_url": f"i{n}"} for n in "abc"]})
    captures = spark.createDataFrame([(c, "k", 0, "tiki", 1, payload, "") for c in ("vay", "quan", "")], CAPTURES)
    rows = [("1", "vay", "i1", "approved", 0), ("2", "vay", "i2", "rejected", 1), ("3", "quan", "i3", "approved", 0)]
    reviewed = spark.createDataFrame(rows, "id string, category string, original_image_url string, human_status string, ord long")
    reviewed = reviewed.select(*[F.col(c) if c in reviewed.columns else F.lit("").alias(c) for c in REVIEWED], "ord")
    results = spark.createDataFrame(
        [(c, 0, f"https://{c}", f"{c}/10000", False) for c in ("vay", "quan")], "category string, ord long, secure_url string, public_id string, failed boolean"
    )
    return captures, reviewed, results


def start(spark, root, inputs, run_id="r1"):
    captures, reviewed, results = inputs
    StageTables(spark, root, "seed").commit("reviewed", lambda: reviewed)
    tables = StageTables(spark, root, run_id)
    return tables, run_stages(tables, captures, "tiki", None, results, "NOW", auto_pass=True)


def contents(spark, root):
    tables = StageTables(spark, root, "-")
    return {n: sorted(map(str, (r.asDict() for r in tables.read(n).collect()))) for n in NAMES}


@pytest.fixture(scope="module")
def whole(spark, inputs, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("whole"))
    start(spark, root, inputs)
    return contents(spark, root)


def test_a_second_start_repeats_nothing(spark, tmp_path, inputs):
    root = str(tmp_path / "s")
    tables, run = start(spark, root, inputs)
    assert tables.done == NAMES and not tables.repeated
    assert (run.raw.count(), run.validated.count(), run.clean.count(), run.inserted.count()) == (9, 9, 2, 2)
    assert run.counts.first().asDict() == {"inserted": 2, "existed": 0, "skipped": 0}
    before, numbers = contents(spark, root), [versions.latest(spark, f"{root}/{n}") for n in NAMES]
    again, second = start(spark, root, inputs)
    assert again.repeated == NAMES and not again.done
    assert contents(spark, root) == before and [versions.latest(spark, f"{root}/{n}") for n in NAMES] == numbers
    assert second.inserted.count() == 2 and {r.category for r in second.raw.collect()} == {"", "quan", "vay"}
    # Another run finds everything stored: no new rows, no new documents.
    later, third = start(spark, root, inputs, "r2")
    assert later.done == NAMES and third.inserted.count() == 0 and later.added("raw").count() == 0
    assert contents(spark, root)["raw"] == before["raw"] and contents(spark, root)["target"] == before["target"]


@pytest.mark.parametrize("stage", ["published_tables", "import_documents"])
def test_a_run_goes_on_where_it_stopped(spark, tmp_path, inputs, monkeypatch, stage, whole):
    root, real = str(tmp_path / "stopped"), getattr(everything, stage)

    def stops(*args, **kwargs):
        raise KeyboardInterrupt

    monkeypatch.setattr(everything, stage, stops)
    with pytest.raises(KeyboardInterrupt):
        start(spark, root, inputs)
    monkeypatch.setattr(everything, stage, real)
    tables, _ = start(spark, root, inputs)
    assert tables.done and tables.repeated + tables.done == NAMES
    assert contents(spark, root) == whole
