"""Stage audit and failure path.

Every stage row count is gathered with ``DataFrame.observe`` so counting
rides along the job's own action instead of re-running stages.  Audit events
keep the 7 fields of the warehouse audit call and can be appended to a
Parquet audit table.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = ("ETL_DATE int, JOB_ID int, SEVERITY int, ROW_COUNT long, SP_NAME string, "
                "PACKAGE_NAME string, MESSAGE string, LOGGED_AT timestamp")


@dataclass
class AuditEvent:
    ETL_DATE: int
    JOB_ID: int
    SEVERITY: int
    ROW_COUNT: int
    SP_NAME: str
    PACKAGE_NAME: str
    MESSAGE: str
    LOGGED_AT: dt.datetime = field(default_factory=dt.datetime.now)


@dataclass
class AuditLog:
    etl_date: int
    job_id: int = 0
    sp_name: str = ""
    package_name: str = ""
    sink: str | None = None
    events: list[AuditEvent] = field(default_factory=list)
    _pending: list[tuple[str, Observation]] = field(default_factory=list)
    _stored: int = 0

    def log(self, message: str, rows: int = 0, severity: int = 0) -> None:
        self.events.append(AuditEvent(self.etl_date, self.job_id, severity, int(rows),
                                      self.sp_name, self.package_name, message))

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Attach a row counter to ``df``; logged by ``collect_stages`` after the action."""
        obs = Observation(f"audit_{len(self._pending)}_{name}")
        self._pending.append((name, obs))
        return df.observe(obs, F.count(F.lit(1)).alias("rows"))

    def collect_stages(self) -> None:
        for name, obs in self._pending:
            self.log(name, obs.get.get("rows", 0))
        self._pending.clear()

    def to_df(self, spark: SparkSession, since: int = 0) -> DataFrame:
        return spark.createDataFrame([tuple(asdict(e).values()) for e in self.events[since:]], AUDIT_SCHEMA)

    def append_to(self, spark: SparkSession, path: str) -> None:
        self.to_df(spark).write.mode("append").parquet(path)

    def store(self, spark: SparkSession | None) -> None:
        """Append the events not yet stored to the sink (nothing without one)."""
        if self.sink and spark is not None and self._stored < len(self.events):
            self.to_df(spark, self._stored).coalesce(1).write.mode("append").parquet(self.sink)
            self._stored = len(self.events)


def run_job(audit: AuditLog, name: str, body, spark: SparkSession | None = None):
    """Run ``body()`` between start/end audit rows; on error audit and re-raise.

    Rows are stored in the audit's sink at the start, at the end, and on an error
    before it goes on; a sink that fails then doesn't hide the job's own error.
    """
    spark = spark or SparkSession.getActiveSession()
    audit.log(f"Start of {name}")
    audit.store(spark)
    try:
        result = body()
    except Exception as exc:  # audit then propagate, as the warehouse job does
        audit.log(f"{name} failed: {exc}", severity=1)
        try:
            audit.store(spark)
        except Exception as also:
            exc.add_note(f"the audit sink {audit.sink} failed too: {also}")
        raise
    audit.log("Procedure Completed Successfully")
    audit.store(spark)
    return result
