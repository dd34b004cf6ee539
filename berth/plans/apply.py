"""Apply a rename plan to the files of a landing zone.

A run is a journal in the shared checkpoint folder, written ahead of what it says:

* **planned**: the changes, frozen as parquet. If an executor is lost, a recomputed plan
  would list a folder already half renamed, so all later steps read this copy;
* **moved**: every source has its temporary name, derived from the run id and its own name;
* **done**: every temporary file has its destination; the journal is removed.

Both steps are idempotent jobs over the frozen changes (``foreachPartition``), and the
second starts only behind the mark of the first, so a chain ``a → b, b → c`` never
overwrites anything. A run that stops anywhere is finished by :func:`recover`, which every
further run calls first: from the marks it knows the step, and each step skips what is done.
A journal without complete changes has moved nothing and is dropped.

Paths go through ``pyarrow.fs``, so local, HDFS or object-store folders are handled alike.
Destinations were resolved in the plan against the complete listing; a file that takes one
in the meantime stops the job, and a file that appears under the name of a moved source
stays where it is: nothing is overwritten.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from berth.session import delete_folder, ensure_checkpoint_dir
from berth.sources.files import file_system

_CHANGES = "dir string, src string, dst string"


def _exists(fs, path: str) -> bool:
    from pyarrow import fs as pafs
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def _tmp_name(run_id: str, src: str) -> str:
    return f".berth-{run_id}-{hashlib.sha1(src.encode('utf-8')).hexdigest()}.tmp"


def _phase1(run_id: str):
    def run(rows):
        for r in rows:
            fs, d = file_system(r["dir"])
            src, tmp = f"{d}/{r['src']}", f"{d}/{_tmp_name(run_id, r['src'])}"
            if _exists(fs, tmp):
                continue  # done by an earlier attempt
            if not _exists(fs, src):
                raise FileNotFoundError(src)
            fs.move(src, tmp)
    return run


def _phase2(run_id: str):
    def run(rows):
        for r in rows:
            fs, d = file_system(r["dir"])
            tmp = f"{d}/{_tmp_name(run_id, r['src'])}"
            if not _exists(fs, tmp):
                continue  # done by an earlier attempt
            dst = f"{d}/{r['dst']}"
            if _exists(fs, dst):  # the plan saw every file, so this one came later
                raise FileExistsError(dst)
            fs.move(tmp, dst)
    return run


class Journal:
    """The journal of one run, in ``<shared folder>/berth-renames/<run id>``."""

    def __init__(self, spark: SparkSession, run_id: str):
        self.spark, self.run_id = spark, run_id
        self.path = f"{_home(spark)}/{run_id}"

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def reached(self, state: str) -> bool:
        fs, path = self._at("changes/_SUCCESS" if state == "planned" else state)
        return fs.exists(path)

    def mark(self, state: str) -> None:
        fs, path = self._at(state)
        fs.create(path, True).close()

    def plan(self, changes: DataFrame) -> None:
        changes.select("dir", "src", "dst").write.mode("errorifexists").parquet(f"{self.path}/changes")

    def changes(self) -> DataFrame:
        return self.spark.read.schema(_CHANGES).parquet(f"{self.path}/changes")

    def finish(self) -> DataFrame:
        """Do what is left of the run; returns its changes."""
        changes = self.changes()
        if not self.reached("moved"):
            changes.foreachPartition(_phase1(self.run_id))
            self.mark("moved")
        if not self.reached("done"):
            changes.foreachPartition(_phase2(self.run_id))
            self.mark("done")
        changes = changes.checkpoint(eager=True)
        delete_folder(self.spark, self.path)
        return changes


def _home(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/berth-renames"


def recover(spark: SparkSession) -> list[str]:
    """Finish every run whose journal is still there; returns their ids."""
    home = spark._jvm.org.apache.hadoop.fs.Path(_home(spark))
    fs = home.getFileSystem(spark._jsc.hadoopConfiguration())
    finished = []
    for found in sorted(s.getPath().getName() for s in fs.listStatus(home)) if fs.exists(home) else []:
        journal = Journal(spark, found)
        if journal.reached("planned"):
            journal.finish()
            finished.append(found)
        else:  # it stopped while the plan was written
            delete_folder(spark, journal.path)
    return finished


def apply_plan(spark: SparkSession, plan: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rename ``dir/src`` to ``dir/dst`` for every changed row of ``plan``; returns the changes.
    The plan must come from a listing taken after :func:`recover`."""
    journal = Journal(spark, run_id or uuid.uuid4().hex[:12])
    journal.plan(plan.where(F.col("src") != F.col("dst")))
    return journal.finish()
