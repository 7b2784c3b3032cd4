"""Whole runs over small landing files that hold the awkward cases."""

import json

import pytest
from pyspark.sql import functions as F

from citymart.operators import regress, validate
from citymart.plans import exploitation, formatting, training, validation
from citymart.sources import files, reports, schemas, tables

DISTRICTS = {"Alta": ["Nord", "Sud"], "Baixa": ["Port"]}


def listing(code, district, neighborhood, price, size, **extra):
    return {
        "propertyCode": code,
        "url": f"u/{code}",
        "district": district,
        "neighborhood": neighborhood,
        "address": "a",
        "municipality": "m",
        "propertyType": "flat",
        "detailedType": {"typology": "flat"},
        "size": size,
        "rooms": 2,
        "bathrooms": 1,
        "status": "good",
        "price": price,
        "priceByArea": price / size if size else None,
        **extra,
    }


@pytest.fixture(scope="module")
def zones(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("zones")
    land = root / "landing"
    for folder in ("idealista", "income", "cultural-sites"):
        (land / folder).mkdir(parents=True)
    rows = []
    for i in range(60):
        neighborhood = ["Nord", "Sud", "Port"][i % 3]
        district = "Baixa" if neighborhood == "Port" else "Alta"
        rows.append(
            listing(
                str(i), district, neighborhood, 100_000.0 + 1000 * i, 50.0 + i, floor=str(i % 5), latitude=41.0 + i
            )
        )
    rows.append(listing("p", "Alta", "Nord", 90_000.0, 45.9, parkingSpace={"hasParkingSpace": True}, floor="bj"))
    rows.append(listing("no-price", "Alta", "Nord", 0.0, 50.0))
    rows.append(listing("no-size", "Alta", "Nord", 1000.0, 0.0))
    rows.append(listing("no-district", None, "Nord", 1000.0, 10.0))
    rows.append(listing("outlier", "Alta", "Nord", 2_000_000.0, 10.0))
    (land / "idealista" / "a.json").write_text(json.dumps(rows[:30]))
    (land / "idealista" / "b.json").write_text(json.dumps(rows[30:], indent=1))
    (land / "idealista" / "empty.json").write_text("[]")
    header = '"Any","Codi_Districte","Nom_Districte","Codi_Barri","Nom_Barri","Població","Índex RFD Barcelona = 100"\n'
    (land / "income" / "1.csv").write_text(
        header
        + '2016,1,"Alta",1,"Nord",1000,"60.5"\n2016,1,"Alta",2,"Sud",2000,"90"\n'
        + '2016,2,"Baixa",3,"Port",0,"130"\n',
        encoding="utf-8",
    )
    (land / "income" / "2.csv").write_text(
        header
        + '2017,1,"Alta",1,"Nord",1100,"70"\n2017,1,"Alta",2,"Sud",2100,"-"\n'
        + '2017,2,"Baixa",3,"Port",0,"121"\n2017,99,"No consta",99,"No consta",,"-"\n',
        encoding="utf-8",
    )
    head = "_id,name,institution_name,addresses_district_id,addresses_district_name,addresses_neighborhood_name,"
    head += "geo_epgs_4326_y,geo_epgs_4326_x,values_category,values_value\n"
    (land / "cultural-sites" / "s.csv").write_text(
        head
        + "1,A,i,1,Alta,Nord,41.1,2.1,art,museum\n2,B,i,1,Alta,Nord,,,art,gallery\n"
        + "3,C,i,2,Baixa,Port,41.2,2.2,,library\n4,,i,2,Baixa,Port,41.2,2.2,art,library\n"
    )
    return {k: str(root / k) for k in ("landing", "formatted", "exploitation", "output", "model")}


@pytest.fixture(scope="module")
def formatted(spark, zones):
    validate.assert_required(formatting.landing_presence(spark, zones["landing"]))
    return formatting.run_formatting(spark, zones["landing"], zones["formatted"])


@pytest.fixture(scope="module")
def exploited(spark, zones, formatted):
    return exploitation.run_exploitation(spark, zones["formatted"], zones["exploitation"])


def by_dataset(status):
    return {r["dataset"]: r for r in status.collect()}


def test_formatting(spark, zones, formatted):
    status = by_dataset(formatted)
    assert {k: (v["status"], v["record_count"], v["column_count"]) for k, v in status.items()} == {
        "idealista": ("success", 62, 22),
        "income": ("success", 7, 9),
        "cultural_sites": ("success", 3, 12),
    }
    listings = tables.read_mart(spark, zones["formatted"], "idealista")
    assert listings.schema.simpleString() == spark.createDataFrame([], schemas.FORMATTED["idealista"]).schema.simpleString()
    row = listings.filter("property_code = 'p'").first()
    assert (row["size_m2"], row["has_parking"], row["latitude"], row["is_exterior"]) == (45, True, 0.0, False)
    assert row["detailed_type"] == "{null, flat}"
    income = tables.read_mart(spark, zones["formatted"], "income")
    unknown = income.filter("district_code = 99").first()
    assert (unknown["population"], unknown["income_index_bcn_100"], unknown["year"]) == (None, None, 2017)
    site = tables.read_mart(spark, zones["formatted"], "cultural_sites").filter("site_id = '2'").first()
    assert (site["latitude"], site["longitude"]) == (0.0, 0.0)


def test_partition_is_pruned(spark, zones, formatted):
    alta = tables.read_mart(spark, zones["formatted"], "idealista").filter("district = 'Alta'")
    plan = alta._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(district" in plan
    assert alta.count() == 42


def test_marts(spark, zones, exploited):
    status = by_dataset(exploited)
    assert all(r["status"] == "success" for r in status.values())
    assert {n: r["column_count"] for n, r in status.items()} == {
        "property_analytics": 14,
        "property_type_analytics": 5,
        "socioeconomic_district_analytics": 12,
        "socioeconomic_neighborhood_analytics": 8,
        "income_quintiles": 4,
        "cultural_district_analytics": 7,
        "cultural_neighborhood_analytics": 8,
        "cultural_category_analytics": 3,
        "integrated_analytics": 17,
    }
    zone = zones["exploitation"]
    socio = {r["neighborhood_name"]: r for r in tables.read_mart(spark, zone, "socioeconomic_neighborhood_analytics").collect()}
    # Sud has no index in its newest year, so its last known year counts.
    assert (socio["Sud"]["data_year"], socio["Nord"]["data_year"]) == (2016, 2017)
    bands = {r["neighborhood_name"]: r["income_quintile"] for r in tables.read_mart(spark, zone, "income_quintiles").collect()}
    assert bands == {"Nord": "Q1_Lowest", "Sud": "Q3_Medium", "Port": "Q5_Highest"}
    culture = {r["neighborhood"]: r for r in tables.read_mart(spark, zone, "cultural_neighborhood_analytics").collect()}
    assert culture["Nord"]["cultural_sites_per_1000_residents"] == 1.82
    assert culture["Port"]["cultural_sites_per_1000_residents"] == 0.0
    district = {r["district"]: r for r in tables.read_mart(spark, zone, "cultural_district_analytics").collect()}
    assert district["Baixa"]["cultural_sites_per_1000_residents"] is None
    one = tables.read_mart(spark, zone, "socioeconomic_district_analytics").filter("district_name = 'Baixa'").first()
    assert one["income_inequality_cv"] is None
    integrated = {r["neighborhood"]: r for r in tables.read_mart(spark, zone, "integrated_analytics").collect()}
    assert set(integrated) == {"Nord", "Sud", "Port"}
    assert integrated["Sud"]["attractiveness_score"] is None
    nord = integrated["Nord"]
    assert nord["total_properties"] == 21
    assert nord["market_accessibility"] == "Low"
    assert nord["affordability_ratio"] == round(nord["median_price_eur"] / 70000, 2)


def test_gates(spark, formatted, exploited):
    gate = validate.row_count_gate(formatted)
    assert {r["dataset"]: r["gate"] for r in gate.collect()} == dict.fromkeys(("idealista", "income", "cultural_sites"), "FAIL")
    with pytest.raises(validate.GateError, match="cultural_sites, idealista, income"):
        validate.assert_gate(gate)
    validate.assert_gate(validate.row_count_gate(formatted, {"income": 7}))
    validate.assert_gate(validate.required_mart_gate(exploited))
    with pytest.raises(validate.GateError, match="nothing"):
        validate.assert_gate(validate.required_mart_gate(exploited, ["nothing"]))


def test_validation_report(spark, zones, formatted, exploited):
    validation.run_validation(spark, zones["formatted"], zones["exploitation"], zones["output"])
    report = reports.read_reports(spark, f"{zones['output']}/*validation_report*").first()
    assert report["executive_summary"]["overall_status"] == "PASSED"
    assert report["executive_summary"]["total_datasets_validated"] == 12
    zone = report["zone_summary"]
    assert (zone["formatted_zone"]["successful_loads"], zone["exploitation_zone"]["successful_loads"]) == (3, 9)
    assert zone["formatted_zone"]["total_records"] == 72
    assert report["recommendations"] == ["✅ All validations passed. Data pipeline is healthy."]
    kpis = report["kpi_summary"].asDict(recursive=True)
    assert kpis["integration_quality"]["total_records"] == 3
    assert kpis["cultural_accessibility"]["total_cultural_sites"] == 3
    assert sorted(len(metrics) for metrics in kpis.values()) == [2, 3, 3, 4]
    assert report["data_quality_details"]["idealista"]["negative_prices"] == 0
    income = report["detailed_results"]["formatted_zone_details"]["income"]
    assert (income["status"], income["record_count"], income["null_count"]) == ("success", 7, 3)


def test_missing_dataset_does_not_stop_the_rest(spark, zones, tmp_path):
    land = tmp_path / "landing"
    (land / "income").mkdir(parents=True)
    source = f"{zones['landing']}/income/1.csv"
    (land / "income" / "1.csv").write_bytes(open(source, "rb").read())
    status = by_dataset(formatting.run_formatting(spark, str(land), str(tmp_path / "f")))
    assert (status["income"]["status"], status["income"]["record_count"]) == ("success", 3)
    assert status["idealista"]["status"] == status["cultural_sites"]["status"] == "error"
    with pytest.raises(validate.GateError, match="cultural-sites, idealista"):
        validate.assert_required(formatting.landing_presence(spark, str(land)))
    summary = validate.run_summary(formatting.run_formatting(spark, str(land), str(tmp_path / "g"))).first()
    assert (summary["total_datasets"], summary["successful_loads"], summary["total_records"]) == (3, 1, 3)


def test_broken_table_is_one_error_row(spark, zones, exploited, tmp_path):
    (tmp_path / "good").mkdir()
    spark.range(3).write.parquet(str(tmp_path / "good" / "a"))
    (tmp_path / "good" / "broken").mkdir()
    (tmp_path / "good" / "broken" / "x.parquet").write_text("this is not parquet")
    status = by_dataset(validate.validate_zone(spark, "z", str(tmp_path / "good"), ["a", "broken", "absent"]))
    assert {n: r["status"] for n, r in status.items()} == {"a": "success", "broken": "error", "absent": "error"}
    assert status["broken"]["error"]


def test_overwrite_replaces_all_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "v int, k string"), path, ["k"])
    assert spark.read.parquet(path).count() == 3
    tables.write_table(spark.createDataFrame([(9, "c", 1.0)], "v int, k string, extra double"), path, ["k"])
    assert [tuple(r) for r in tables.read_table(spark, path).select("v", "extra", "k").collect()] == [(9, 1.0, "c")]


def test_pipeline_report(spark, zones, formatted, exploited):
    score = validate.quality_score(formatted, validate.check_zone(spark, formatted))
    presence = formatting.landing_presence(spark, zones["landing"])
    row = validate.pipeline_report(presence, formatted, exploited, score, "run-1", "2025-01-01").first()
    assert (row["landing_zone_datasets"], row["formatted_datasets"], row["analytics_datasets"]) == (3, 3, 9)
    assert (row["total_records_processed"], row["status"], row["quality_score"]) == (72, "PASSED", 100.0)


def test_zone_inventory(spark, zones, exploited, tmp_path):
    rows = {
        r["zone"]: r
        for r in files.zone_inventory(
            spark, {"landing": zones["landing"], "formatted": zones["formatted"], "gone": str(tmp_path / "gone")}
        ).collect()
    }
    assert (rows["landing"]["file_count"], rows["landing"]["dir_count"]) == (6, 3)
    assert rows["landing"]["latest_modification"] is not None
    assert rows["formatted"]["total_size_mb"] > 0
    assert (rows["gone"]["exists"], rows["gone"]["file_count"], rows["gone"]["latest_modification"]) == (False, 0, None)
    found = {r["dataset"] for r in files.list_tables(spark, zones["exploitation"]).collect()}
    assert found == set(schemas.EXPLOITATION)
    assert files.list_tables(spark, zones["exploitation"], "_delta_log").count() == 0
    counts = {r["dataset"]: r["file_count"] for r in files.table_file_counts(spark, zones["exploitation"]).collect()}
    assert counts["income_quintiles"] >= 1


def test_training(spark, zones, formatted):
    from pyspark.ml import PipelineModel

    ranking = training.run_training(spark, zones["formatted"], zones["model"], trees=5)
    rows = ranking.collect()
    assert sorted(r["model"] for r in rows) == ["LinearRegression", "RandomForestRegressor"]
    assert rows[0]["rmse"] <= rows[1]["rmse"]
    model = PipelineModel.load(f"{zones['model']}/model")
    listings = tables.read_mart(spark, zones["formatted"], "idealista")
    scored = model.transform(regress.model_rows(listings, keep=["property_code"]))
    # Two listings have no plain floor number: one is "bj", the outlier has none and gets 0.
    assert scored.count() == 61
    assert spark.read.parquet(f"{zones['model']}/example").count() == 5
    assert scored.filter(F.col("prediction").isNull()).count() == 0
