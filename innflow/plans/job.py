"""The whole run, in order: ingest -> clean + load -> checks (hard gate) -> marts -> model tests.

Every write is a full refresh (overwrite), so a re-run from the same raw
extracts gives the same tables; ``publish_job`` runs it into a version of its own
and lets readers see that version only when everything has passed.  Each stage reads what the previous stage
wrote, so a lost executor re-reads files instead of recomputing lineage.

Layout under ``out_dir``::

    bronze/<table>/                   raw text + _source_file, _ingested_at, _seq
    warehouse/<table>/                typed tables + loaded_at, _copies (written by the cleaning)
    warehouse/rejected_records/       partitioned by source_table
    checks/  tests/                   one row per check / model test
    marts/<model>/                    fct_reservations, dim_guests, agg_property_performance
    _stage/                           classified tables (raw text + types + reason)
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innflow.plans import marts as M
from innflow.plans.checks import GateFailed, contract_tests, gate, warehouse_checks
from innflow.plans.entities import LOAD_ORDER, Cleaned, transform_all
from innflow.plans.roles import RAW_COLUMNS
from innflow.sources.files import read_raw_csv, write_with_count
from innflow.sources.versions import Version, VersionedStore

TABLES = ("guests", "properties", "rooms", "reservations", "payments")


@dataclass
class RunReport:
    bronze_rows: dict = field(default_factory=dict)
    warehouse_rows: dict = field(default_factory=dict)
    rejected_rows: int = 0
    checks: list = field(default_factory=list)
    tests: list = field(default_factory=list)
    mart_rows: dict = field(default_factory=dict)


def ingest(spark: SparkSession, raw_dir: str, out_dir: str, report: RunReport) -> dict[str, DataFrame]:
    """Copy every raw extract verbatim into bronze (text columns + lineage); missing extract -> error."""
    bronze = {}
    for t in TABLES:
        df = read_raw_csv(spark, raw_dir, t)
        missing = [c for c in RAW_COLUMNS[t] if c not in df.columns]
        if missing:
            raise ValueError(f"{t}: extract lacks columns {missing}")
        path = f"{out_dir}/bronze/{t}"
        report.bronze_rows[t] = write_with_count(df, path, f"bronze_{t}")
        bronze[t] = spark.read.parquet(path)
    report.bronze_rows["total"] = sum(report.bronze_rows.values())
    return bronze


def load(cleaned: Cleaned, out_dir: str, report: RunReport) -> dict[str, DataFrame]:
    """The warehouse tables were written by the cleaning (parents first, with ``loaded_at`` and the
    ``_copies`` audit column); count them from the footers and write the quarantine table."""
    spark = cleaned.properties.classified.sparkSession
    now = F.current_timestamp().cast("timestamp_ntz")
    tables = {}
    for t in LOAD_ORDER:
        written = spark.read.parquet(f"{out_dir}/warehouse/{t}")
        report.warehouse_rows[t] = written.count()
        tables[t] = written.drop("loaded_at", "_copies")
    rejects = cleaned.rejects.select(
        F.sha2(F.concat_ws("|", "source_table", "_seq"), 256).alias("id"),
        "source_table", "raw_record", "rejection_reason", now.alias("rejected_at"),
    )
    report.rejected_rows = write_with_count(rejects, f"{out_dir}/warehouse/rejected_records", "rejected",
                                            partition_by="source_table")
    return tables


def run_job(spark: SparkSession, raw_dir: str, out_dir: str, build_marts: bool = True) -> RunReport:
    """Run every stage; raises ``GateFailed`` (marts untouched) when a warehouse check fails."""
    report = RunReport()
    bronze = ingest(spark, raw_dir, out_dir, report)
    cleaned = transform_all(bronze, run_dir=f"{out_dir}/_stage", kept_dir=f"{out_dir}/warehouse")
    tables = load(cleaned, out_dir, report)

    checks = warehouse_checks(tables)
    write_with_count(checks, f"{out_dir}/checks", "checks")
    report.checks = [r.asDict() for r in spark.read.parquet(f"{out_dir}/checks").collect()]
    gate(spark.read.parquet(f"{out_dir}/checks"))  # raises GateFailed: nothing downstream runs

    if not build_marts:
        return report
    for name, view in M.STAGING.items():
        view(tables).createOrReplaceTempView(name)
    for name, build in M.MARTS.items():
        report.mart_rows[name] = write_with_count(build(tables), f"{out_dir}/marts/{name}", name)
    written = {n: spark.read.parquet(f"{out_dir}/marts/{n}") for n in M.MARTS}
    models = {name: view(tables) for name, view in M.STAGING.items()}
    models.update(written)
    write_with_count(contract_tests(models), f"{out_dir}/tests", "tests")
    report.tests = [r.asDict() for r in spark.read.parquet(f"{out_dir}/tests").collect()]
    failed = [t for t in report.tests if t["status"] != "PASS"]
    if failed:
        raise GateFailed(f"{len(failed)} model tests failed: {failed[:5]}")
    return report


def publish_job(spark: SparkSession, raw_dir: str, root: str) -> tuple[Version, RunReport]:
    """The whole run into a draft folder, published as one version of the store at ``root`` once gate and model tests have passed.

    A run that dies or fails in any stage publishes nothing, so readers keep the version before it.
    """
    draft = VersionedStore(spark, root).begin()
    report = run_job(spark, raw_dir, draft.path)
    places = [*(f"bronze/{t}" for t in TABLES), *(f"warehouse/{t}" for t in LOAD_ORDER), "warehouse/rejected_records",
              "checks", "tests", *(f"marts/{m}" for m in M.MARTS)]
    for place in places:
        draft.add(place.replace("/", "."), place)
    return draft.publish(), report


__all__ = ["run_job", "publish_job", "ingest", "load", "RunReport", "GateFailed"]
