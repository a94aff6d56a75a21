"""The frame of a load job (I5): lease, recovery, audit, reload, rejects."""

from __future__ import annotations

import getpass
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.functions.clock import RunClock
from daybook.operators.audit import AuditLog, run_job
from daybook.operators.lineage import LINEAGE_COLUMNS, read_window_stamps, stamp_lineage
from daybook.operators.quarantine import Quarantine
from daybook.operators.reload import lease, recover_reload, stamp_run, write_reload
from daybook.session import job_settings

#: Differ from run to run without a restatement.
RUN_COLUMNS = ("EXTRACT_DATE_ID", *LINEAGE_COLUMNS)


def load_window(spark: SparkSession, name: str, audit: AuditLog, target: str, clock: RunClock, restatement: bool,
                quarantine: Quarantine, window: Callable[[], DataFrame], lineage_user: str | None = None) -> int:
    """Runs ``window()`` into ``target``; 0, or the audited error.

    Audit rows: a reload that was finished for an earlier run, the rows deleted, the stages, the rows inserted, rejects by feed and field, and the
    restatement if asked for.  With ``lineage_user`` rows carry their first and last stamp and user, otherwise the load
    stamp alone."""
    def stamped(fresh):
        if lineage_user is None:
            return stamp_run(fresh)
        return stamp_lineage(fresh, read_window_stamps(spark, target, clock.expiration_id), lineage_user)

    def body():
        if recover_reload(spark, target):
            audit.log("Finished the reload of an earlier run")
        stats = write_reload(spark, stamped(window()), target, clock.expiration_id, restatement=RUN_COLUMNS if restatement else None)
        audit.log(f"Delete from target where PERIOD >= {clock.expiration_id}", rows=stats["deleted"])
        audit.collect_stages()
        for (feed, field), n in sorted(quarantine.collect().items()):
            audit.log(f"Rejects of {feed}: {field}", rows=n)
        quarantine.store(spark)
        for state in ("added", "changed", "gone", "same") if restatement else ():
            audit.log(f"Restatement: {state}", rows=stats[state])
        audit.log(f"Reloaded partitions: {stats['written']} written, {stats['dropped']} dropped", rows=stats["rows"])
        return 0

    def held():
        with lease(spark, target, f"{name} of {getpass.getuser()}, extract {clock.extract_id}"):
            return body()

    with job_settings(spark):
        return run_job(audit, name, held, spark)
