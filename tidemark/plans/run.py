"""The full run over one or more datasets: every stage reads a layer and writes the next."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import document, impute, rules, typing
from tidemark.plans.clean import Hierarchy, clean
from tidemark.plans.diagnose import diagnose
from tidemark.plans.report import report_facts
from tidemark.session import release
from tidemark.sources import tables
from tidemark.spec import DatasetSpec


# Reports that are written at the same time: each is a small job that leaves most of a cluster idle.
REPORTS_AT_ONCE = 4


@dataclass(frozen=True)
class Input:
    spec: DatasetSpec
    csv: str
    dictionary: str
    multi_line: bool = False
    # a CSV made for this run alone: it is deleted as soon as the raw layer holds its rows
    staged: bool = False


def impute_stage(cleaned: DataFrame, spec: DatasetSpec) -> tuple[DataFrame, list[impute.Fill]]:
    """Fill by rule, then derive the totals again from the filled parts."""
    fills = impute.fit_medians(cleaned, spec.impute) if spec.impute else []
    filled = impute.impute(cleaned, fills) if fills else cleaned
    return (rules.recompute_totals(filled, spec.derived) if spec.derived else filled), fills


def rederived_totals(cleaned: DataFrame, spec: DatasetSpec, fills: list[impute.Fill]) -> DataFrame:
    """``column, n_changed``: totals that change once their parts are filled."""
    filled = impute.impute(cleaned, fills) if fills else cleaned
    return rules.change_counts(filled, rules.derived_totals(filled, spec.derived))


def run_dataset(
    spark: SparkSession, source: Input, root: str, hierarchies: Mapping[str, Hierarchy] | None = None
) -> dict[str, str]:
    """Ingest to export.  Stops at the first failed check.  Returns the path of each result.

    Layers follow each other.  Reports only read layers that are written, so they are written beside
    the main line, a few at a time; the export waits until they are there, the run ends when all are,
    and an error in one is raised.
    """
    written: list[Future] = []
    with ThreadPoolExecutor(REPORTS_AT_ONCE) as pool:
        try:
            paths = _stages(spark, source, root, hierarchies, pool, written)
        except BaseException:
            for report in written:
                report.cancel()
            raise
        for report in written:
            report.result()
    return paths


def _stages(
    spark: SparkSession,
    source: Input,
    root: str,
    hierarchies: Mapping[str, Hierarchy] | None,
    pool: ThreadPoolExecutor,
    written: list[Future],
) -> dict[str, str]:
    spec = source.spec
    base = f"{root.rstrip('/')}/{spec.name}"
    paths: dict[str, str] = {}

    def layer(name: str, df: DataFrame) -> DataFrame:
        paths[name] = f"{base}/{name}"
        found = tables.write_layer(df, paths[name])
        release(spark)
        return found

    def report(name: str, df: DataFrame) -> None:
        paths[name] = f"{base}/{name}"
        written.append(pool.submit(inheritable_thread_target(spark)(tables.write_report_csv), df, paths[name]))

    # ingest
    dictionary = tables.read_dictionary(spark, source.dictionary)
    plan = typing.column_types(dictionary)
    header = spark.read.option("header", True).csv(source.csv).columns
    typing.check_contract(spec.name, header, dictionary)
    raw = layer("raw", tables.read_text_csv(spark, source.csv, header, multi_line=source.multi_line))
    counts = typing.count_check(raw, spec.entity, spec.expected_rows, spec.expected_entities)
    typing.require_counts(spec.name, counts)
    if source.staged:
        tables.delete(spark, source.csv)
    report("count_check", counts)

    # type
    report("coercion_report", typing.coercion_report(raw, plan))
    typed = layer("typed", typing.apply_types(raw, plan))

    # diagnose
    found = diagnose(typed, spec)
    for name, table in {**found.tables(), **found.distributions}.items():
        report(f"diagnosis_{name.replace(' ', '_').replace('(', '').replace(')', '')}", table)

    # clean
    result = clean(typed, spec, hierarchies, found.near_duplicates, found.repeated, found.n_rows)
    release(spark)
    cleaned = layer("cleaned", result.table)
    report("cleaning_metrics", result.metrics)
    report("flags", result.flags)
    report("problem_inventory", document.problem_inventory(typed, spec, found.inventory))

    # impute
    filled, fills = impute_stage(cleaned, spec)
    imputed = layer("imputed", filled)
    if fills:
        report("imputation_ledger", impute.imputation_ledger(imputed, fills))
    if spec.derived:
        # the totals as cleaned, against the totals derived from the filled parts
        report("rederived_totals", rederived_totals(cleaned, spec, fills))

    # document
    descriptions = {p.column: p.description for p in plan}
    report(
        "data_dictionary",
        document.data_dictionary(spec, typed, cleaned, imputed, descriptions, found.null_counts),
    )
    report("report_facts", report_facts(spec, typed, cleaned, imputed, fills, result.kept, result.flags, found))

    # the reports were the last to read the rows before cleaning; the export then has their room
    for waiting in written:
        waiting.result()
    release(spark, *([] if result.kept is typed else [result.kept]))

    # export
    labels = document.column_labels(spark, imputed.columns, descriptions, spec.derived_labels)
    paths["final"] = f"{base}/final"
    report("round_trip", tables.export_table(imputed, labels, paths["final"]))
    return paths


def run_all(
    spark: SparkSession,
    sources: Sequence[Input],
    root: str,
    hierarchies: Mapping[str, Hierarchy] | None = None,
) -> dict[str, dict[str, str]]:
    """Every dataset in turn; an error in one stops the run."""
    return {s.spec.name: run_dataset(spark, s, root, hierarchies) for s in sources}
