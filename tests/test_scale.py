"""Landing files of the registered queries end before one task would have too much to read."""

import pytest

from citymart.plans import bindings as B
from citymart.plans import queries as Q

LINES, DOCS = 60, 40


@pytest.fixture
def tables(spark, tmp_path):
    made = {
        "region": [(0, "north")],
        "nation": [(0, "one", 0)],
        "supplier": [(1, "s1", 0, 5.0)],
        "documents": [(i, f'a "b",\n{i} ' * 20, "en", "web", 9) for i in range(DOCS)],
    }
    for name, rows in made.items():
        spark.createDataFrame(rows, B.TABLES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = spark.range(LINES).selectExpr(
        "id l_orderkey", "1L l_partkey", "1L l_suppkey", "1 l_linenumber", "2D l_quantity", "3D l_extendedprice",
        "0D l_discount", "0.1D l_tax", "'A' l_returnflag", "'O' l_linestatus", "timestamp_ntz'2020-01-01' l_shipdate",
    )
    lines.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    return tmp_path


@pytest.fixture
def staged(monkeypatch, tmp_path):
    monkeypatch.setattr(Q, "staged_path", lambda spark, name: f"{tmp_path}/staged-{name}")
    return tmp_path


def test_listing_files_are_compressed_and_bounded(spark, tables, staged, monkeypatch):
    monkeypatch.setattr(Q, "LANDING_RECORDS", 10)
    found = Q.format_listings_json(spark, str(tables))
    files = list((staged / "staged-landing-listings").glob("part-*"))
    assert len(files) == LINES / 10 and all(f.name.endswith(".json.gz") for f in files)
    assert found.count() == found.select("property_code").distinct().count() == LINES


def test_csv_files_are_bounded(spark, tables, staged, monkeypatch):
    monkeypatch.setattr(Q, "LANDING_BYTES", 1_000)
    found = Q.folder_csv(spark, str(tables)).collect()
    files = list((staged / "staged-folder").glob("*.csv"))
    assert len(files) >= DOCS / 5 and max(f.stat().st_size for f in files) < 2_000
    assert sorted((r["doc_id"], r["text"]) for r in found) == [(i, f'a "b",\n{i} ' * 20) for i in range(DOCS)]
