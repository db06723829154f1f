"""What has been loaded into a table: a record for each load, written before its append and sealed after it.

A load reserves its ids by creating a file that must not exist yet, named by the first of them. When its rows
are written it is sealed with the table's new size and the days it touched. Ids and totals follow from the
seals alone. A load that ended in between, wherever it stopped, left a record without a seal: the next load
counts what it wrote, by its ids and days, and seals it. The files lie in ``_loads`` below the table, which no
reader takes for data. One table takes one load at a time.
"""

import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "_loads"


class Seal(NamedTuple):
    """A finished load: its ids from ``first_id``, the next free id, the table's rows after it, its days (None: all)."""

    first_id: int
    next_id: int
    total: int
    days: list[str] | None


class Files:
    """Small files in one folder, through Spark's own file system, so any store works."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        if not self.fs.exists(self.path(self.folder)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(self.folder)))

    def read(self, name: str) -> dict | None:
        """The file's content; None when it was not written to its end."""
        at = self.path(f"{self.folder}/{name}")
        stream = self.fs.open(at)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            return json.loads(text)
        except ValueError:
            return None
        finally:
            stream.close()

    def write(self, name: str, content: dict, replace: bool = False) -> None:
        """Create the file; an existing one is an error unless it is to be replaced."""
        stream = self.fs.create(self.path(f"{self.folder}/{name}"), replace)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()


def location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]


class Ledger:
    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table
        self.files = Files(spark, f"{location(spark, table)}/{FOLDER}")

    def _written(self, first_id: int, begun: dict | None) -> list:
        """Rows by day that a load without a seal has written: those with its ids, on its days."""
        if begun is None:  # it ended before it had reserved anything, so it wrote nothing
            return []
        inside = F.col("id").between(first_id, first_id + begun["rows"] - 1)
        days = F.col("event_date").between(*[F.lit(begun[d]).cast("date") for d in ("first_day", "last_day")])
        rows: DataFrame = self.spark.table(self.table).where(inside & days)
        return rows.groupBy("event_date").agg(F.count(F.lit(1)).alias("n")).collect()

    def seals(self) -> list[Seal]:
        """All loads in order; those without a seal are counted and sealed. The first is what was there before any."""
        names = self.files.names()
        done = {n.removesuffix(".done") for n in names if n.endswith(".done")}
        out: list[Seal] = []
        if not names:
            last, rows = self.spark.table(self.table).agg(F.max("id"), F.count(F.lit(1))).first()
            self._seal(Seal(0, 1 if last is None else last + 1, rows, None))
            return self.seals()
        for key in sorted({n.rsplit(".", 1)[0] for n in names}):
            content = self.files.read(f"{key}.done") if key in done else None
            if content is None:
                begun = self.files.read(f"{key}.begun") if f"{key}.begun" in names else None
                if int(key) == 0:
                    self.files.fs.delete(self.files.path(f"{self.files.folder}/{key}.done"), False)
                    return self.seals()
                written = self._written(int(key), begun)
                after = int(key) + (begun["rows"] if begun else 1)
                seal = Seal(int(key), after, out[-1].total + sum(r["n"] for r in written), sorted(str(r["event_date"]) for r in written))
                self._seal(seal)
            else:
                seal = Seal(**content)
            out.append(seal)
        return out

    def begin(self, first_id: int, rows: int, days: list[str]) -> None:
        """Reserve ``rows`` ids. Fails when another load has just done so."""
        self.files.write(f"{first_id:020d}.begun", {"rows": rows, "first_day": min(days), "last_day": max(days)})

    def _seal(self, seal: Seal) -> None:
        self.files.write(f"{seal.first_id:020d}.done", seal._asdict(), replace=True)

    def end(self, first_id: int, rows: int, total: int, days: list[str]) -> None:
        self._seal(Seal(first_id, first_id + rows, total, sorted(days)))
