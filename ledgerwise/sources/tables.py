"""Reading and writing the curated and quarantine Parquet tables.

    <table>/_data/snap=<time>-<id>/<partition>=<value>/part-*.parquet
    <table>/_published/<version>

A write puts its files into a new ``snap=`` folder, by Spark's partitioned
Parquet writer, and then publishes one small pointer file that names the
snapshot of every partition. A table is what its highest version says, so a
write that dies at any step changes nothing.

A :class:`Table` is opened at one version and writes against it: publishing
fails with :class:`ConcurrentWrite` if any other version came in between, and
the caller runs again on the new state. The pointer appears by a rename that
does not replace, which is atomic on HDFS and alike; on a store without such a
rename, writers of one table have to take turns. A snapshot that does not hold
every partition value its write has seen is not published. Files that no recent
version names are deleted only once they are GRACE_SECONDS old, so neither a
slow writer nor a reader of the version before loses any.

A folder with Parquet files or partitions and no pointer is read as a plain
table, and replaced as a whole by the next write. Any other non-empty folder is
an error; an absent or empty one is an empty table.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from typing import Dict, Iterable, List, Optional, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from ledgerwise import constants as C
from ledgerwise.functions import ts_literal

DATA, PUBLISHED, NULL_VALUE = "_data", "_published", "__HIVE_DEFAULT_PARTITION__"
#: More than the longest write of a table takes.
GRACE_SECONDS = 24 * 3600


# --- file system -------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _entries(spark: SparkSession, path: str) -> Dict[str, float]:
    """A folder's entries and their times in seconds; none if it is absent."""
    fs, p = _fs(spark, path)
    return {e.getPath().getName(): e.getModificationTime() / 1000 for e in fs.listStatus(p)} if fs.exists(p) else {}


def _read_small(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, name: str, text: str) -> bool:
    """A new file, complete from the moment it has its name; False if the name
    is taken."""
    fs, hidden = _fs(spark, f"{path}/.{uuid.uuid4().hex}")
    stream = fs.create(hidden, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    never_replace = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(hidden, jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), never_replace)
    except Exception:
        if name in _entries(spark, path):
            return False
        raise
    return True


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch folder of ``spark.checkpoint.dir``. A session that
    names none is an error, except one on this machine only (tests), which
    gets a private folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="ledgerwise-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared scratch root."""
    return f"{scratch_root(spark)}/ledgerwise/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, in a way that the optimizer knows it."""
    return spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


# --- tables --------------------------------------------------------------------


class ConcurrentWrite(RuntimeError):
    """Another writer has published since the table was opened."""


class Table:
    """A stored table at the version it had when it was opened (0: none yet).

    ``folders`` names the snapshot of every partition. ``order`` sorts rows
    inside files; ``options`` go to the Parquet writer."""

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, partition_by: str, order: Sequence[str] = (), options: Optional[Dict[str, str]] = None
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.partition_by, self.order, self.options = partition_by, order, options or {}
        versions = self._versions()
        self.version, self.folders = (versions[-1], self._pointer(versions[-1])) if versions else (0, {})
        visible = [n for n in _entries(spark, self.path) if not n.startswith(("_", "."))]
        self.plain = not versions and bool(visible)
        if self.plain and not all("=" in n or n.endswith(".parquet") for n in visible):
            raise ValueError(f"{path} is neither empty nor a table: {', '.join(visible[:5])}")

    def _versions(self) -> List[int]:
        return sorted(int(n) for n in _entries(self.spark, f"{self.path}/{PUBLISHED}") if n.isdigit())

    def _pointer(self, version: int) -> Dict[str, str]:
        lines = _read_small(self.spark, f"{self.path}/{PUBLISHED}/{version:010d}").split("\n")
        return dict(line.split("\t") for line in lines if "\t" in line)

    def frame(self, values: Optional[Iterable] = None) -> DataFrame:
        """The rows, or those of some partition values: other partitions are
        neither listed nor opened. Without a row, an empty frame of the schema.
        The schema is given, so no file footer is read to infer it."""
        wanted = None if values is None else {f"{self.partition_by}={NULL_VALUE if v is None else v}" for v in values}
        if self.plain:
            base = self.path
            roots = [base] if wanted is None else [f"{base}/{n}" for n in _entries(self.spark, base) if n in wanted]
        else:
            base = f"{self.path}/{DATA}"
            own = {f: s for f, s in self.folders.items() if wanted is None or f in wanted}
            snaps = set(own.values())
            missing = snaps - set(_entries(self.spark, base)) if snaps else set()
            if missing:
                raise ValueError(f"{self.path}: version {self.version} names missing data: {', '.join(sorted(missing)[:5])}")
            # a snapshot that is named alone has no superseded partition
            whole = wanted is None and len(snaps) == 1
            roots = [f"{base}/{s}" for s in snaps] if whole else [f"{base}/{s}/{f}" for f, s in own.items()]
        if not roots:
            return empty(self.spark, self.schema)
        return self.spark.read.schema(self.schema).option("basePath", base).parquet(*roots).select(*self.schema.fieldNames())

    def replace(self, df: DataFrame, *metrics: Column) -> Dict:
        """Make ``df`` (which may read this table) the whole table; the observed ``metrics``."""
        return self._write(df, {}, metrics)

    def update(self, df: DataFrame, *metrics: Column) -> Dict:
        """Make ``df`` the new content of the partitions it has."""
        if self.plain:
            raise ValueError("a plain Parquet table has to be replaced as a whole first")
        return self._write(df, self.folders, metrics)

    def _write(self, df: DataFrame, kept: Dict[str, str], metrics: Sequence[Column]) -> Dict:
        # Rows are rebalanced on the partition column: AQE splits a hot value
        # over several tasks and merges small ones. Metrics are observed after
        # that, in the final stage, which cannot count a row twice.
        snap, seen = f"snap={int(time.time())}-{uuid.uuid4().hex}", Observation()
        value = F.coalesce(F.nullif(F.col(self.partition_by).cast("string"), F.lit("")), F.lit(NULL_VALUE))
        out = df.select(*self.schema.fieldNames()).hint("rebalance", self.partition_by)
        out = out.observe(seen, F.collect_set(value).alias("__values"), *metrics).sortWithinPartitions(self.partition_by, *self.order)
        out.write.options(**self.options).partitionBy(self.partition_by).parquet(f"{self.path}/{DATA}/{snap}")
        counts = dict(seen.get)
        written = [n for n in _entries(self.spark, f"{self.path}/{DATA}/{snap}") if "=" in n]
        if len(written) != len(counts.pop("__values")):
            raise ValueError(f"{self.path}: {snap} lacks partitions that were written")
        self._publish({**kept, **{f: snap for f in written}})
        return counts

    def _publish(self, folders: Dict[str, str]) -> None:
        text = "".join(f"{f}\t{s}\n" for f, s in sorted(folders.items()))
        newest = max(self._versions(), default=0)
        if newest != self.version or not _create(self.spark, f"{self.path}/{PUBLISHED}", f"{self.version + 1:010d}", text):
            raise ConcurrentWrite(f"{self.path}: version {self.version} was read, and another was published since")
        before, self.version, self.folders, self.plain = self.folders, self.version + 1, folders, False
        self._clean({*before.values(), *folders.values()})

    def _clean(self, named: Iterable[str]) -> None:
        old = time.time() - GRACE_SECONDS
        for name in _entries(self.spark, f"{self.path}/{DATA}"):
            begun = name.removeprefix("snap=").split("-")[0]
            if name not in named and begun.isdigit() and int(begun) < old:
                _delete(self.spark, f"{self.path}/{DATA}/{name}")
        for name, changed in _entries(self.spark, f"{self.path}/{PUBLISHED}").items():
            if changed < old and not (name.isdigit() and int(name) >= self.version - 1):
                _delete(self.spark, f"{self.path}/{PUBLISHED}/{name}")
        for name in _entries(self.spark, self.path):  # a plain table that the pointer has replaced
            if not name.startswith(("_", ".")):
                _delete(self.spark, f"{self.path}/{name}")


# --- curated and quarantine --------------------------------------------------

#: Distinct ids that a file's Bloom filter is made for, unless the writer knows
#: better: 1.2 KB; and the most, that is 1.2 MB a row group.
FILE_IDS, MAX_FILE_IDS = 1 << 10, 1 << 20


QUARANTINE_SCHEMA = StructType(
    [StructField(c, StringType()) for c in [*C.QUARANTINE_COLUMNS, "run_scenario"]] + [StructField("quarantined_at", TimestampNTZType())]
)


def curated_table(spark: SparkSession, path: str, file_ids: int = FILE_IDS) -> Table:
    """The curated table, partitioned by business date. Files are sorted by id
    and carry a Bloom filter of their ids, made for ``file_ids`` of them: a lookup
    of one id skips the row groups that cannot have it."""
    from ledgerwise.operators.scd2 import CURATED_SCHEMA

    lookup = {
        "parquet.bloom.filter.enabled#transaction_id": "true",
        "parquet.bloom.filter.expected.ndv#transaction_id": str(min(max(file_ids, FILE_IDS), MAX_FILE_IDS)),
    }
    return Table(spark, path, CURATED_SCHEMA, "transaction_date", ["transaction_id"], lookup)


def quarantine_table(spark: SparkSession, path: str) -> Table:
    """The quarantine table, partitioned by flag."""
    return Table(spark, path, QUARANTINE_SCHEMA, "dq_flag")


#: Lines of a compressed text file: about 8 MB of NDJSON before compression.
LINES_PER_FILE = 50_000


def read_curated(spark: SparkSession, path: str, dates: Optional[Iterable] = None) -> DataFrame:
    return curated_table(spark, path).frame(dates)


def write_curated(df: DataFrame, path: str, *metrics: Column) -> Dict:
    """Replace the curated table."""
    return curated_table(df.sparkSession, path).replace(df, *metrics)


def read_quarantine(spark: SparkSession, path: str, flags: Optional[Iterable[str]] = None) -> DataFrame:
    return quarantine_table(spark, path).frame(flags)


def write_quarantine(quarantine: DataFrame, path: str, run_scenario: str, run_ts, *metrics: Column) -> Dict:
    """Replace the quarantine table. The whole table is replaced, so flags of
    an earlier run that are absent now do not linger."""
    rows = quarantine.withColumn("run_scenario", F.lit(run_scenario)).withColumn("quarantined_at", ts_literal(run_ts))
    return quarantine_table(quarantine.sparkSession, path).replace(rows, *metrics)


def write_text_lines(lines: DataFrame, path: str, line_col: str = "value") -> None:
    """Write one column of text lines as NDJSON files (tests and demos): gzip,
    and as that cannot be split, many files."""
    lines.select(line_col).write.mode("overwrite").option("maxRecordsPerFile", LINES_PER_FILE).text(path, compression="gzip")
