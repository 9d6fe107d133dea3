"""Landed files (CSV, CSV, JSON array, CSV) -> warehouse equals the same
inputs taken directly; the CLI writes every layer and passes its tests."""

import json
import os
import tempfile

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables not present")


def test_from_files_matches_generated(spark):
    from marquee.config import Scope
    from marquee.plans.warehouse import Warehouse
    from marquee.sources.adapter import generated_raw

    raw = generated_raw(spark, SF)
    d = tempfile.mkdtemp(prefix="landed-")
    raw.movies_main.orderBy("ingest_seq").drop("ingest_seq").coalesce(1).write.options(header=True, escape='"').csv(f"{d}/movies")
    raw.movie_extended.orderBy("ingest_seq").drop("ingest_seq").coalesce(1).write.options(header=True, escape='"').csv(f"{d}/ext")
    raw.benchmark.coalesce(1).write.options(header=True, escape='"').csv(f"{d}/bench")
    rows = [r.asDict(recursive=True) for r in raw.ratings.collect()]          # small fixture file
    with open(f"{d}/ratings.json", "w") as f:
        json.dump(rows, f)
    files = Warehouse.from_files(spark, f"{d}/movies", f"{d}/ext", f"{d}/ratings.json", f"{d}/bench",
                                 scope=Scope.generated())
    direct = Warehouse.from_generated(spark, SF)
    for name in ("fact_genre_budget_roi", "fact_movie_market_coverage", "dim_company"):
        assert sorted(getattr(files, name).collect()) == sorted(getattr(direct, name).collect()), name

    from marquee.cli import main
    out = tempfile.mkdtemp(prefix="wh-")
    code = main(["--movies", f"{d}/movies", "--extended", f"{d}/ext", "--ratings", f"{d}/ratings.json",
                 "--benchmark", f"{d}/bench", "--out", out, "--min-revenue", "100000"])
    assert code == 0
    assert spark.read.parquet(f"{out}/gold/fact_genre_budget_roi").count() > 0
