"""The jobs of the lake: ingest, conform, report, validate, present.

A job writes its tables, each once, to a new version of its layer, reads them back and runs its rules
on what was written; no plan is worked out again for a check.  Only if no rule is violated does the
version become the current one, with all its tables at the same time (see ``sources.versions``); a run that
fails or is killed leaves the last good version.  A violated rule raises :class:`RuleViolation`.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spanlake import names as n
from spanlake.functions.months import month_count
from spanlake.operators import quality as q
from spanlake.operators.fusion import fused, lake_rules
from spanlake.operators.intervals import Roles
from spanlake.operators.latest import latest_per_key, with_soft_delete, with_time
from spanlake.operators.report import monthly_report, present as presented, report_summary
from spanlake.operators.scope import judge_links, with_snapshot_columns
from spanlake.operators.split import (
    clean_periods,
    is_valid,
    reject_reason,
    reject_reason_counts,
    unknown_validity,
)
from spanlake.plans.layout import InputFiles, Layout, inside
from spanlake.sources.files import read_csv, with_load_columns, write_observed
from spanlake.sources.records import read_csv_records
from spanlake.sources.schemas import period_schema, snapshot_schema
from spanlake.sources.versions import TABLE, Draft, Folder, current, read_current

VALID, REJECTED, MISMATCHED, UNKNOWN = "valid", "rejected", "mismatched", "unknown"

Metrics = dict[str, "int | float | str | None"]


class RuleViolation(RuntimeError):
    """At least one rule of a layer is violated."""


@dataclass(frozen=True)
class LayerResult:
    layer: str
    metrics: Metrics
    violated: dict[str, int]

    @property
    def status(self) -> str:
        return "FAILED" if self.violated else "SUCCESS"

    def __str__(self) -> str:
        shown = " ".join(f"{name}={value}" for name, value in self.metrics.items())
        return f"LAYER={self.layer} STATUS={self.status} {shown}"


def _conclude(layer: str, metrics: Metrics, *rules: DataFrame) -> LayerResult:
    """Run the rules in one job, print the status line, raise if one is violated."""
    found = {r["rule"]: r["violations"] for r in q.violations(*rules).collect()}
    if layer == "VALIDATE":
        metrics = {"ERROR_ROWS": sum(found.values()), **metrics}
    result = LayerResult(layer, metrics, {rule: v for rule, v in found.items() if v})
    print(result, flush=True)
    if result.violated:
        raise RuleViolation(f"{result}: {result.violated}")
    return result


def _seen(observation: Observation) -> dict[str, int | str | None]:
    """What was observed; nothing where the plan turned out empty and Spark left the node out."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


def _ledger(result: LayerResult, origin: dict) -> dict:
    """What a published version notes: what it was made from, and what the job counted."""
    return {"origin": origin, "layer": result.layer, "metrics": result.metrics}


def _made_before(spark: SparkSession, out_dir: str, origin: dict, resume: bool) -> LayerResult | None:
    """The result of the run that published the layer, if it had the same input and options."""
    note = current(spark, out_dir).note
    if not resume or origin["input"] in ("", []) or note.get("origin") != origin:
        return None
    result = LayerResult(note["layer"], note["metrics"], {})
    print(f"{result} (unchanged)", flush=True)
    return result


def ingest(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    expected: dict[str, int] | None = None,
    files: InputFiles = InputFiles(),
    layout: Layout = Layout(),
    multi_line: bool = False,
    check_header: bool = False,
    corrupt_column: str | None = None,
    required: bool = False,
    resume: bool = False,
) -> LayerResult:
    """CSV files to Parquet as they are, with load columns.

    ``expected`` optionally gives the row counts of ``snapshots`` and ``periods``.
    ``corrupt_column`` keeps the text of records that do not fit; ``required`` makes a snapshot
    without id a violation.  With ``resume`` files that the published version was made from, by name,
    length and time, are not read again.
    """
    folder = Folder(spark, in_dir)
    origin = {
        "input": folder.state(files.snapshots) + folder.state(files.periods),
        "options": [expected, multi_line, check_header, corrupt_column, required, *asdict(layout).values()],
    }
    before = _made_before(spark, out_dir, origin, resume)
    if before is not None:
        return before
    with Draft(spark, out_dir) as new:
        result = _ingested(
            new, in_dir, expected, files, layout, multi_line, check_header, corrupt_column, required
        )
        new.publish(_ledger(result, origin))
    return result


def _ingested(
    new: Draft,
    in_dir: str,
    expected: dict[str, int] | None,
    files: InputFiles,
    layout: Layout,
    multi_line: bool,
    check_header: bool,
    corrupt_column: str | None,
    required: bool,
) -> LayerResult:
    spark, metrics, rules = new.spark, {}, []
    for table, metric, file, folder, schema in (
        ("snapshots", "MASTER_ROWS", files.snapshots, layout.snapshots, snapshot_schema()),
        ("periods", "DETAIL_ROWS", files.periods, layout.periods, period_schema()),
    ):
        if multi_line and not check_header:
            raw = read_csv_records(spark, inside(in_dir, file), schema, corrupt_column)
        else:  # A header is checked by the reader that takes whole files.
            raw = read_csv(
                spark, inside(in_dir, file), schema, multi_line, corrupt_column, check_header
            )
        loaded = with_load_columns(raw, file)
        sent, written = write_observed(loaded, new.path(folder))
        metrics[metric] = written
        rules.append(q.row_difference(spark, f"{table}: written rows", written, sent))
        if expected is not None and table in expected:
            rules.append(
                q.row_difference(spark, f"{table}: expected rows", written, expected[table])
            )
        rows = new.added(folder, loaded.schema)
        if required and table == "snapshots":
            rules.append(q.null_keys(rows, n.ID))
        if corrupt_column is not None:
            metrics[f"{metric.split('_')[0]}_CORRUPT"] = rows.where(
                F.col(corrupt_column).isNotNull()
            ).count()
    return _conclude("BRONZE", metrics, *rules)


def conform(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    layout: Layout = Layout(),
    keep_unknown: bool = True,
    parse_time: bool = False,
    resume: bool = False,
) -> LayerResult:
    """Latest snapshot per person; its periods, cleaned and split into valid rows and rejects.

    The periods are scanned, linked and judged once.  Each period of a kept snapshot is valid,
    rejected, mismatched (its worker is not the snapshot's) or, with ``keep_unknown=False``, of
    unknown validity because a month is missing; the last two are counted and not published.
    ``parse_time`` orders the snapshots by the parsed creation time instead of its text.
    """
    bronze = current(spark, in_dir)
    origin = {
        "input": bronze.name, "options": [keep_unknown, parse_time, *asdict(layout).values()]
    }
    before = _made_before(spark, out_dir, origin, resume)
    if before is not None:
        return before
    raw_snapshots = bronze.read(layout.snapshots)
    raw_periods = clean_periods(bronze.read(layout.periods))
    newest = (
        latest_per_key(with_time(raw_snapshots), order=("_time", n.ID)).drop("_time")
        if parse_time
        else latest_per_key(raw_snapshots)
    )
    # The names of the tables that the fates lead to; rows of the last two are kept beside them.
    table_of = {
        VALID: layout.periods, REJECTED: layout.rejects, MISMATCHED: MISMATCHED, UNKNOWN: UNKNOWN,
    }
    with Draft(spark, out_dir) as new:
        latest = new.write(with_soft_delete(newest), layout.snapshots)
        read = Observation()
        linked = judge_links(raw_periods.observe(read, F.count(F.lit(1)).alias("rows")), latest)
        fate = F.when(~F.col("_same_worker"), table_of[MISMATCHED]).when(is_valid(), table_of[VALID])
        if not keep_unknown:
            fate = fate.when(unknown_validity(), table_of[UNKNOWN])
        judged = linked.withColumns(
            {
                TABLE: fate.otherwise(table_of[REJECTED]),
                n.REJECT_REASON: reject_reason(unknown=keep_unknown),
            }
        ).drop("_same_worker")
        reasoned = [*raw_periods.columns, n.REJECT_REASON]
        made = new.write_split(
            judged,
            {
                layout.periods: raw_periods.columns, layout.rejects: reasoned,
                MISMATCHED: raw_periods.columns, UNKNOWN: raw_periods.columns,
            },
        )
        valid, rejects = made[layout.periods], made[layout.rejects]
        counts = {f: made[table].count() for f, table in table_of.items()}
        reasons = {
            f"REJECTED[{r[n.REJECT_REASON]}]": r["rows"]
            for r in reject_reason_counts(rejects).orderBy(n.REJECT_REASON).collect()
        }
        result = _conclude(
            "SILVER",
            {
                "MASTER_READ": raw_snapshots.count(),
                "DETAIL_READ": _seen(read).get("rows", 0),
                "MASTER_ROWS": latest.count(),
                "DETAIL_SCOPED": sum(counts.values()),
                "DETAIL_ROWS": counts[VALID],
                "DETAIL_REJECTED": counts[REJECTED],
                "DETAIL_MISMATCHED": counts[MISMATCHED],
                **({} if keep_unknown else {"DETAIL_UNKNOWN": counts[UNKNOWN]}),
                **reasons,
            },
            q.duplicate_keys("persons with several snapshots", latest, [n.PERSON]),
            q.latest_parity(raw_snapshots, latest),
            q.orphan_rows(valid, latest),
        )
        new.publish(_ledger(result, origin))
    return result


def report(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    layout: Layout = Layout(),
    roles: Roles = Roles(),
    resume: bool = False,
) -> LayerResult:
    """Monthly report over the gap-free axis of the valid periods.

    The periods are scanned once: their number and bounds are observed while the report is written.
    """
    silver = current(spark, in_dir)
    origin = {
        "input": silver.name, "options": [*asdict(layout).values(), *asdict(roles).values()]
    }
    before = _made_before(spark, out_dir, origin, resume)
    if before is not None:
        return before
    latest = silver.read(layout.snapshots)
    seen = Observation()
    periods = silver.read(layout.periods).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.min(roles.start).alias("first"),
        F.max(roles.end).alias("last"),
    )
    rows = with_snapshot_columns(periods, latest, [roles.person])
    with Draft(spark, out_dir) as new:
        written = new.write(monthly_report(rows, None, roles, checked=True), layout.report)
        summary, found = report_summary(written).first().asDict(), _seen(seen)
        first, last = found.get("first"), found.get("last")
        months, expected = written.count(), month_count(first, last)
        result = _conclude(
            "GOLD",
            {
                "DETAIL_ROWS": found.get("rows", 0),
                "FIRST_MONTH": first,
                "LAST_MONTH": last,
                "MONTHS": months,
                **summary,
            },
            q.empty_axis(written),
            q.row_difference(spark, q.INCOMPLETE, months, expected),
            q.duplicate_months(written),
            q.negative_totals(written),
        )
        new.publish(_ledger(result, origin))
    return result


def validate(
    spark: SparkSession,
    lake_dir: str,
    silver: str = "silver",
    gold: str = "gold",
    layout: Layout = Layout(),
) -> LayerResult:
    """Check the written silver and gold tables against each other."""
    conformed = current(spark, inside(lake_dir, silver))
    latest, periods = conformed.read(layout.snapshots), conformed.read(layout.periods)
    written = read_current(spark, inside(lake_dir, gold), layout.report)
    return _conclude(
        "VALIDATE",
        {
            "MASTER_ROWS": latest.count(),
            "DETAIL_ROWS": periods.count(),
            "MONTHS": written.count(),
        },
        fused({"snapshots": latest, "periods": periods, "report": written}, lake_rules()),
    )


def present(
    spark: SparkSession, gold_dir: str, out_dir: str, layout: Layout = Layout()
) -> DataFrame:
    """The written report for readers, as one CSV file: a row per month."""
    shown = presented(read_current(spark, gold_dir, layout.report))
    path = inside(out_dir, layout.presented)
    shown.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
    return spark.read.option("header", "true").csv(path)


def run_all(
    spark: SparkSession,
    in_dir: str,
    lake_dir: str,
    expected: dict[str, int] | None = None,
    files: InputFiles = InputFiles(),
    layout: Layout = Layout(),
    multi_line: bool = False,
    check_header: bool = False,
    corrupt_column: str | None = None,
    required: bool = False,
    keep_unknown: bool = True,
    parse_time: bool = False,
    resume: bool = False,
) -> list[LayerResult]:
    """The four jobs in order; the first violated rule stops the run.

    With ``resume`` a layer whose published version was made from the current input with the same options is
    left as it is: a chain that stopped goes on where it did, and unchanged input is only validated.
    """
    bronze, silver, gold = (inside(lake_dir, name) for name in ("bronze", "silver", "gold"))
    return [
        ingest(
            spark, in_dir, bronze, expected, files, layout,
            multi_line, check_header, corrupt_column, required, resume,
        ),
        conform(spark, bronze, silver, layout, keep_unknown, parse_time, resume),
        report(spark, silver, gold, layout, resume=resume),
        validate(spark, lake_dir, layout=layout),
    ]
