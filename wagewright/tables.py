"""The seven tables with versions: merges that rewrite only what they touch, and commit only onto what they have read.

A table is dealt into parts by a hash of its first key. A version is a manifest that names the folder of every part; a
merge writes new folders for the parts it touches and then commits the next manifest, which must not exist yet. If
another writer was first, its parts tell what to do: if they aren't ours, our folders are named in the version after
it; else the merge is done again over that version. So no writer's rows are lost, and a reader sees a version whole.

The commit is a rename that fails if the target exists, which is atomic on HDFS and within a local file system.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.operators.history import insert_or_ignore, replace_children, upsert
from wagewright.schema import TABLES, conform, fields

KEYS = {
    "companies": ["company_id"], "ats_registry": ["company_id"], "locations": ["location_id"], "jobs": ["job_key"], "job_locations": ["job_key", "location_raw"], "crawl_runs": ["run_id"], "searches": ["search_id"],
}
PARTS = 64


class ConflictError(RuntimeError):
    """Other writers were first as often as a merge was tried."""


class Table:
    def __init__(self, spark: SparkSession, root: str, name: str, parts: int = PARTS):
        self.spark, self.name, self.path, self.parts = spark, name, f"{root}/{name}", parts
        self.schema, self.keys = fields(TABLES[name]), KEYS[name]

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The number of the last version, 0 before the first commit."""
        log = self._path("log")
        names = [s.getPath().getName() for s in self._files().listStatus(log)] if self._files().exists(log) else []
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def manifest(self, version: int) -> dict[str, str]:
        """The folder of each part that has rows."""
        if not version:
            return {}
        return json.loads(self.spark.read.text(f"{self.path}/log/{version}.json", wholetext=True).first()["value"])

    def read(self, version: int | None = None, parts: list[str] | None = None) -> DataFrame:
        """A version's rows (the last one's), or those of some parts."""
        held = self.manifest(self.version() if version is None else version)
        folders = [f"{self.path}/data/{folder}/part={p}" for p, folder in held.items() if parts is None or p in parts]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def _commit(self, version: int, held: dict[str, str]) -> bool:
        """Whether this version is ours; if not somebody else's is there."""
        jvm = self.spark._jvm
        draft, final = self._path(f"log/draft-{uuid.uuid4().hex}"), self._path(f"log/{version}.json")
        out = self._files().create(draft, False)
        out.write(bytearray(json.dumps(held).encode()))
        out.close()
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, final, none)
        except Py4JJavaError as e:
            self._files().delete(draft, False)
            if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
                return False
            raise
        return True

    def _part(self):
        return F.pmod(F.xxhash64(self.keys[0]), F.lit(self.parts)).cast("string")

    def change(self, new: DataFrame, made: Callable[[DataFrame, DataFrame], DataFrame], attempts: int = 5) -> int:
        """The version that has made(own rows, new) in place of the parts that new touches."""
        new = conform(new, self.name)
        touched = sorted(r["p"] for r in new.select(self._part().alias("p")).distinct().collect())  # at most PARTS
        if not touched:
            return self.version()
        base = self.version()
        for _ in range(attempts):
            folder = uuid.uuid4().hex
            after = conform(made(self.read(base, touched), new), self.name)
            after.withColumn("part", self._part()).repartition("part").write.partitionBy("part").parquet(f"{self.path}/data/{folder}")
            there = {s.getPath().getName().removeprefix("part=") for s in self._files().listStatus(self._path(f"data/{folder}"))}
            onto = base
            while True:
                held = {p: f for p, f in self.manifest(onto).items() if p not in touched} | {p: folder for p in touched if p in there}
                if self._commit(onto + 1, held):
                    return onto + 1
                last = self.version()
                if any(self._folder(base, p) != self._folder(last, p) for p in touched):
                    break  # they have changed our parts
                onto = last
            self._files().delete(self._path(f"data/{folder}"), True)
            base = last
        raise ConflictError(f"{self.name}: no merge in {attempts} attempts was the first")

    def _folder(self, version: int, part: str) -> str | None:
        return self.manifest(version).get(part)

    def upsert(self, new: DataFrame) -> int:
        """Rows of new added or, for a known key, in place of its own, NULLs too."""
        return self.change(new, lambda old, rows: upsert(old, rows, self.keys))

    def insert_or_ignore(self, new: DataFrame, order: str) -> int:
        """Rows of unknown keys added, the first by order of each."""
        return self.change(new, lambda old, rows: insert_or_ignore(old, rows, self.keys, order))

    def replace_children(self, new: DataFrame) -> int:
        """All rows of the parents (first key) in new replaced by new."""
        return self.change(new, lambda old, rows: replace_children(old, rows, self.keys[0]))

    def vacuum(self, keep: int = 2) -> int:
        """How many folders were removed that none of the last ``keep`` versions names. Not while others are writing."""
        last = self.version()
        named = {f for v in range(max(1, last - keep + 1), last + 1) for f in self.manifest(v).values()}
        data = self._path("data")
        folders = [s.getPath() for s in self._files().listStatus(data)] if self._files().exists(data) else []
        unused = [f for f in folders if f.getName() not in named]
        for folder in unused:
            self._files().delete(folder, True)
        return len(unused)
