"""Current folders of the stored tables.

Every run writes into folders of its own (``run=<id>`` below the table).  What a table consists of is named by the newest
manifest, a small file that appears by one rename when all tables of a run are written.  Until then readers see the tables
of the run before; a run that dies leaves folders that no manifest names.
"""

import json
import logging
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

MANIFESTS = "_manifests"
RUN = "run"


class ConcurrentRun(RuntimeError):
    """Another run has published its tables since this one began."""


@dataclass(frozen=True)
class Manifest:
    """``folders``: table -> its folders, relative to the table's own; ``options``: what the run was made with."""

    number: int = 0
    folders: Mapping[str, Sequence[str]] = field(default_factory=dict)
    options: Mapping[str, object] = field(default_factory=dict)


def new_run() -> str:
    return uuid.uuid4().hex


class _Files:
    """The few file operations, by the file system that Spark itself uses for ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self.root = spark._jvm, str(root).rstrip("/")
        self._fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def list(self, name: str, depth: int = 1) -> list[str]:
        """Folders and files ``depth`` levels below ``name``, relative to it, in order."""
        found = self._fs.globStatus(self.path("/".join([name, *["*"] * depth])))
        return sorted("/".join(str(s.getPath().toString()).split("/")[-depth:]) for s in found or [])

    def write_once(self, name: str, text: str) -> bool:
        """Write a file under a name of its own and rename it; False if ``name`` is taken."""
        own = self.path(f"{name}.{new_run()}.tmp")
        out = self._fs.create(own, False)
        out.write(bytearray(text.encode()))
        out.close()
        if not self._fs.exists(self.path(name)) and self._fs.rename(own, self.path(name)):
            return True
        self._fs.delete(own, False)
        return False

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)


def current(spark: SparkSession, root: str) -> Manifest | None:
    """The newest manifest; None where no run has published any."""
    names = [n for n in _Files(spark, root).list(MANIFESTS) if n.endswith(".json")]
    if not names:
        return None
    return _read(spark, root, names[-1])


def _read(spark: SparkSession, root: str, name: str) -> Manifest:
    text = spark.read.text(f"{str(root).rstrip('/')}/{MANIFESTS}/{name}", wholetext=True).first()[0]
    return Manifest(int(name.removesuffix(".json")), **json.loads(text))


def publish(spark: SparkSession, root: str, before: Manifest | None, folders: Mapping[str, Sequence[str]],
            options: Mapping[str, object]) -> Manifest:
    """Make ``folders`` the current ones, if ``before`` still is the newest manifest."""
    after = Manifest((before.number if before else 0) + 1, dict(folders), dict(options))
    text = json.dumps({"folders": after.folders, "options": after.options}, indent=1)
    if not _Files(spark, root).write_once(f"{MANIFESTS}/{after.number:012d}.json", text):
        raise ConcurrentRun(f"{root} has a manifest {after.number} already")
    log.info("published manifest %d of %s", after.number, root)
    return after


def folders_of(spark: SparkSession, root: str, table: str, run: str, partition_by: Sequence[str] = ()) -> list[str]:
    """The folders that a run wrote of a table, relative to it: one per partition, or the run's own."""
    if not partition_by:
        return [f"{RUN}={run}"]
    found = _Files(spark, root).list(f"{table}/{RUN}={run}", depth=len(partition_by))
    return [f"{RUN}={run}/{name}" for name in found if all("=" in part for part in name.split("/"))]


def partition_of(folder: str) -> str:
    """What a folder holds, whichever run wrote it: ``year=2024/month=5``."""
    return folder.split("/", 1)[1] if "/" in folder else ""


def replaced(old: Iterable[str], new: Iterable[str]) -> list[str]:
    """The folders of a table in which the partitions of ``new`` stand in for those of ``old``."""
    taken = {partition_of(f) for f in new}
    return [f for f in old if partition_of(f) not in taken] + list(new)


def open_folders(spark: SparkSession, root: str, table: str, folders: Sequence[str]) -> DataFrame | None:
    """The rows of the folders, partition columns included; None where there are no files."""
    base = f"{str(root).rstrip('/')}/{table}"
    if not folders:
        return None
    try:
        df = spark.read.option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None
    return df.drop(RUN)


def drop_unreferenced(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete the runs' folders that none of the newest ``keep`` manifests names, and older manifests; returns the folders.

    Not to be called while a run writes or a reader still uses an older manifest.
    """
    files = _Files(spark, root)
    names = [n for n in files.list(MANIFESTS) if n.endswith(".json")]
    named: dict[str, set[str]] = {}
    for name in names[-keep:]:
        for table, folders in _read(spark, root, name).folders.items():
            named.setdefault(table, set()).update(folders)
    gone = []
    for table, folders in named.items():
        for run in files.list(table):
            if not run.startswith(f"{RUN}="):
                continue
            live = [f for f in folders if f == run or f.startswith(f"{run}/")]
            if not live:
                gone.append(f"{table}/{run}")
                continue
            depth = live[0].count("/")
            if depth:
                gone += [f"{table}/{run}/{p}" for p in files.list(f"{table}/{run}", depth) if "=" in p and f"{run}/{p}" not in live]
    for name in names[:-keep]:
        files.delete(f"{MANIFESTS}/{name}")
    for folder in gone:
        files.delete(folder)
    return gone
