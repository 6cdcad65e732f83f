"""The two survey specs from CSV to export, on small tables with planted defects."""

import csv
import random
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import lookup
from tidemark.plans import labour_survey
from tidemark.plans.clean import Hierarchy
from tidemark.plans.run import Input, run_all, run_dataset

N = 60


def persons():
    """One row per person; every third has a main job, every sixth a second one."""
    draw = random.Random(8)
    table = []
    for i in range(N):
        works, second = i % 3 == 0, i % 6 == 0
        row = {
            "hhid": f"{i // 3:05d}", "member": i % 3 + 1, "weight": round(draw.uniform(1, 9), 4),
            "region": f"{i % 9 + 1:02d}", "panelid": i % 4, "q1_03": "Male" if i % 2 else "Female",
            "q1_04": 20 + i % 40, "q1_11": "Yes" if i % 2 else "No",
            "q1_12": "Public" if i % 2 else None, "q1_13": "Primary" if i % 2 else None,
            "q2_01": "Yes" if i % 5 == 0 else "No", "q2_02": "Painting" if i % 5 == 0 else None,
            "q2_03": "Yes" if i % 5 == 0 else None, "q2_04": "Yes" if works else None, "q2_05": None,
            "q2_06": None, "q2_07": None, "q2_10": None, "q2_14": None, "q2_15": None,
            "q3_01": ("Yes" if second else "No") if works else None,
            "q3_16": "Employee" if works else None,
            "q3_03": 40 if works else None, "q3_04": 10 if second else None,
            "q3_05": 50 if second else None,
            **{f"q3_07_{d}": (8 if d < 6 else 0) if works else None for d in range(1, 8)},
            "q3_08": 10 if second else None, "q3_09": 40 if works else None,
            "q3_10": 50 if second else None,
            "q3_15b": None, "q3_30": "TAXI DRIVER" if works else None, "q3_31": None, "q3_32": None, "q3_33": None,
            "isic_code": "4921" if works else None, "isco_code": "8322" if works else None,
            **{c: None for c in labour_survey.MONEY_COLUMNS},
        }
        if works:
            row["q6_01"] = 100_000 + 1000 * i
        table.append(row)
    table[0]["q1_04"] = -1
    table[3].update(q3_03=99)
    table[6].update(q3_05=99)  # also a raw mismatch
    table[9].update(q3_07_1=-1)
    table[12].update(q3_05=51)  # off by one: tolerated, but recomputed
    table[15].update(isic_code="729", isco_code="110")
    table[18].update(isco_code="61111", q3_08=-1)
    table[21].update(q3_30="TAXI DRIIVER")
    table[24].update(q2_04=None)  # coded without evidence of a job
    table[27].update(q2_04=None, q2_06=1)  # evidence by the screening code
    table[30].update(q6_01=9_000_000)
    table[33].update(q3_03="many")  # lost in the cast
    table[1].update(q1_12=None)  # incidental
    return table


def declared(column):
    if column in ("weight",):
        return "double", ""
    if column in ("hhid", "region", "isic_code", "isco_code"):
        return "str5", ""
    if column in labour_survey.PERSONS.free_text:
        return "str80", ""
    if column in labour_survey.MONEY_COLUMNS:
        return "long", ""
    if column in ("q3_05", "q3_09", "q3_10", "panelid"):
        return "int", ""
    numeric = ("member", "q1_04", "q2_06", "q3_03", "q3_04", "q3_08", *labour_survey.DAILY_HOURS)
    return "byte", "" if column in numeric else "answers"


def write(path, table, labels=None):
    columns = list(table[0])
    with open(path / "data.csv", "w", newline="") as out:
        writer = csv.DictWriter(out, columns)
        writer.writeheader()
        writer.writerows(table)
    with open(path / "dictionary.csv", "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(["column", "description", "type", "choices"])
        for c in columns:
            writer.writerow([c, f'Question "{c}",\nas asked', *(labels or declared)(c)])
    return str(path / "data.csv"), str(path / "dictionary.csv")


@pytest.fixture(scope="module")
def hierarchies(spark):
    industry = spark.createDataFrame(
        [("49", "H Transportation and storage"), ("07", "B Mining and quarrying")], "Code string, Section string"
    )
    occupation = spark.createDataFrame(
        [(1, "0", "Armed forces"), (1, "6", "Skilled farm workers"), (1, "8", "Machine operators")],
        "Level int, Code string, Title string",
    )
    majors = lookup.major_group_labels(occupation)
    return {
        "industry": Hierarchy(lookup.division_sections(industry), lookup.section_labels(industry)),
        "occupation": Hierarchy(majors.select(F.col("group_code").alias("group_key"), "group_code"), majors),
    }


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory, hierarchies):
    folder = tmp_path_factory.mktemp("persons")
    table = persons()
    data, dictionary = write(folder, [*table, table[5]])  # one repeated person
    spec = replace(labour_survey.PERSONS, expected_rows=N + 1, expected_entities=N // 3)
    return run_dataset(spark, Input(spec, data, dictionary), str(folder / "out"), hierarchies)


def report(spark, paths, name):
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(paths[name])


def test_coercion(spark, result):
    lost = report(spark, result, "coercion_report").filter("n_new_nulls <> '0'")
    assert rows(lost, "column", "n_new_nulls") == [("q3_03", "1")]


def test_diagnosis(spark, result):
    ranges = report(spark, result, "diagnosis_range_summary").filter("n_flagged <> '0'")
    assert rows(ranges, "column", "is_sentinel", "sentinel_value") == [("q1_04", "true", "-1.0")]
    assert report(spark, result, "diagnosis_duplicates").count() == 2
    gates = {r["dependent_col"]: r for r in report(spark, result, "diagnosis_gate_split").collect()}
    assert gates["q1_12"]["n_incidental"] == "1" and gates["q3_04"]["pct_structural"] == "100.0"
    pairs = report(spark, result, "diagnosis_near_duplicates")
    assert rows(pairs, "column", "value_a", "count_a", "value_b", "similarity") == [
        ("q3_30", "TAXI DRIVER", "19", "TAXI DRIIVER", "0.983")
    ]
    assert report(spark, result, "diagnosis_casing").filter("casing_consistent = 'false'").count() == 0


def test_cleaning_counts(spark, result):
    got = {(r["step"], r["item"]): int(r["value"]) for r in report(spark, result, "cleaning_metrics").collect()}
    assert got[("dedup", "rows dropped")] == 1
    assert got[("dedup", "rows kept")] == N
    assert got[("raw_consistency", "usual_hours_mismatch")] == 1
    assert got[("sentinel", "q1_04")] == 1
    assert got[("sentinel", "q3_03")] == 1
    assert got[("sentinel", "q3_05")] == 1
    assert got[("sentinel", "q3_07_1")] == 1
    assert got[("sentinel", "q3_08")] == 1
    # q3_09 loses row 9; q3_10 loses row 18; q3_05 gains row 6 and changes row 12
    assert got[("derived_total", "q3_09")] == 1
    assert got[("derived_total", "q3_10")] == 1
    assert got[("derived_total", "q3_05")] == 2
    assert got[("flags", "rules")] == 2
    assert got[("variants_merged", "q3_30")] == 1
    assert got[("rows_consolidated", "q3_30")] == 1
    assert got[("n_coded", "isic_code")] == got[("n_classified", "isic_code")] == 20
    assert got[("n_classified", "isco_code")] == 20


def test_flags(spark, result):
    flags = rows(report(spark, result, "flags"), "hhid", "member", "rule_name", "detail")
    assert [(h, r) for h, _, r, _ in flags] == [
        ("00008", "employment_skip_violation"),
        ("00010", "monetary_outlier_q6_01"),
    ]
    assert flags[1][3].startswith("q6_01=9000000.0 outside IQR bounds [")


def test_codes_and_text_in_the_cleaned_layer(spark, result):
    cleaned = spark.read.parquet(result["cleaned"])
    groups = {(r["isic_code"], r["isic_section"], r["isco_code"], r["isco_major_group"]) for r in cleaned.collect()}
    assert ("729", "B", "110", "0") in groups and ("4921", "H", "61111", "6") in groups
    assert cleaned.filter("q3_30 = 'TAXI DRIIVER'").count() == 0
    assert dict(cleaned.dtypes)["q3_03"] == "tinyint"


def test_imputation_and_rederived_totals(spark, result):
    ledger = {r["variable"]: (r["n_imputed"], r["fill_value"]) for r in report(spark, result, "imputation_ledger").collect()}
    assert ledger["q1_04"][0] == "1"
    assert ledger["q3_03"] == ("2", "40")
    assert ledger["q3_07_1"] == ("1", "8")
    assert ledger["q3_08"] == ("1", "10")
    changed = dict(rows(report(spark, result, "rederived_totals")))
    assert changed == {"q3_09": "1", "q3_10": "1", "q3_05": "0"}
    final = spark.read.parquet(result["final"])
    assert final.filter("q3_16 IS NOT NULL AND (q3_03 IS NULL OR q3_09 IS NULL)").count() == 0
    assert final.filter("q3_16 IS NULL AND q3_03 IS NOT NULL").count() == 0


def test_documents(spark, result):
    dictionary = {r["variable"]: r for r in report(spark, result, "data_dictionary").collect()}
    assert dictionary["q1_03"]["type"] == "category"
    assert dictionary["q1_03"]["value_set_or_range"] == "Female; Male"
    assert dictionary["q1_04"]["imputation_treatment"] == "Filled with the median, 1 row(s)"
    assert dictionary["isco_code"]["imputation_treatment"].startswith("Left empty")
    assert dictionary["isic_section"]["pct_missing_raw"] == "N/A (derived column)"
    assert dictionary["q3_04"]["notes"] == "Asked only if q3_01 is Yes."
    assert dictionary["q1_04_imputed"]["label"].endswith(": filled (yes or no)")
    inventory = {(r["variable"], r["issue"]): r["count"] for r in report(spark, result, "problem_inventory").collect()}
    assert inventory[("isic_code", "leading zero lost")] == "1"
    assert inventory[("isco_code", "not 4 characters")] == "2"
    assert [c for (v, _), c in inventory.items() if v == "panelid"] == [str(N + 1)]


def test_export_keeps_labels(spark, result):
    final = spark.read.parquet(result["final"])
    assert final.schema["q1_03"].metadata["label"] == 'Question "q1_03",\nas asked'
    assert final.schema["q1_04_imputed"].metadata["value_labels"]["1"] == "Imputed"
    assert dict(final.dtypes)["q1_04_imputed"] == "tinyint"
    assert rows(report(spark, result, "round_trip"), "same_content") == [("true",)]


def emigrants(spark, folder):
    table = [
        {"hhid": f"{i}", "emig": 1, "weight": 1.5, "q7_06": -1 if i == 0 else 30 + i,
         "q7_08": "MECHANIC" if i % 2 else "MECHANICS", "q7_15": "SALESPERSON" if i else "SALES PERSON"}
        for i in range(8)
    ]
    kinds = {"hhid": "str5", "weight": "double", "q7_08": "str51", "q7_15": "str65"}
    return write(folder, table, lambda c: (kinds.get(c, "byte"), ""))


def test_emigrants(spark, tmp_path):
    data, dictionary = emigrants(spark, tmp_path)
    paths = run_all(spark, [Input(labour_survey.EMIGRANTS, data, dictionary)], str(tmp_path / "out"))["emig"]
    final = spark.read.parquet(paths["final"])
    # 0.978 stays apart, 0.983 is merged
    assert {r["q7_08"] for r in final.collect()} == {"MECHANIC", "MECHANICS"}
    assert {r["q7_15"] for r in final.collect()} == {"SALESPERSON"}
    assert rows(final.filter("q7_06_imputed = 1"), "q7_06") == [(34,)]


def test_wrong_counts_stop_the_run(spark, tmp_path):
    data, dictionary = emigrants(spark, tmp_path)
    spec = replace(labour_survey.EMIGRANTS, expected_rows=9)
    with pytest.raises(ValueError, match="rows: 8 instead of 9"):
        run_all(spark, [Input(spec, data, dictionary)], str(tmp_path / "out"))


def test_unknown_columns_stop_the_run(spark, tmp_path):
    data, dictionary = emigrants(spark, tmp_path)
    with open(dictionary, "a") as out:
        out.write("q7_99,Not there,byte,\n")
    with pytest.raises(ValueError, match="q7_99"):
        run_all(spark, [Input(labour_survey.EMIGRANTS, data, dictionary)], str(tmp_path / "out"))
