"""Write, audit, publish: readers see a new version of a table only once it was checked.

Rows are written as a version of their partitions beside the ones in use, then checked, and
only then made visible, together with the removal of partitions that have no rows any more.
What readers see is a view that names the version of every partition; replacing the view is
one catalog operation, so there is no moment with half of a change, and a failing audit or a
lost job leaves the view as it was. Versions that no view names are removed by ``vacuum``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "_version"
#: Partition values in one property of the view, as catalogs bound a property's length.
PROPERTY_VALUES = 200


class AuditFailed(RuntimeError):
    """Names the checks that a version did not pass; nothing was published."""


@dataclass(frozen=True)
class PublishedTable:
    """``name`` is the view readers use, ``name``__versions the table behind it.

    ``partition`` is a column of dates, or of months as ``yyyyMM``; ``key`` must be unique
    within a version. ``date_col`` says which partition a row belongs in; left out, that is
    not checked.
    """

    spark: SparkSession
    name: str
    partition: str
    key: tuple[str, ...]
    date_col: str | None = None

    @property
    def store(self) -> str:
        return f"{self.name}__versions"

    def stage(self, df: DataFrame) -> str:
        """Write rows as a new version that no reader sees; returns its name. Null
        partition values are not accepted."""
        version = uuid.uuid4().hex
        missing = F.raise_error(F.lit(f"null in {self.partition}"))
        value = F.when(F.col(self.partition).isNull(), missing.cast(df.schema[self.partition].dataType)).otherwise(F.col(self.partition))
        rows = df.withColumn(self.partition, value).withColumn(VERSION, F.lit(version)).hint("rebalance", self.partition)
        if self.spark.catalog.tableExists(self.store):
            columns = self.spark.table(self.store).columns
            rows.select(*columns).write.insertInto(self.store)
        else:
            rows.write.partitionBy(VERSION, self.partition).saveAsTable(self.store)
        return version

    def staged(self, version: str) -> DataFrame:
        return self.spark.table(self.store).filter(F.col(VERSION) == version).drop(VERSION)

    def _misplaced(self) -> Column:
        day = F.col(self.date_col).cast("date")
        belongs = F.date_format(day, "yyyyMM") == F.col(self.partition).cast("string")
        if dict(self.spark.table(self.store).dtypes)[self.partition] == "date":
            belongs = day == F.col(self.partition)
        return ~F.coalesce(belongs, F.lit(False))

    def audit(self, version: str, least_rows: int = 1, scope: Iterable[object] = ()) -> DataFrame:
        """(check, partition, found, ok) of a version: ``rows`` per partition (at least
        ``least_rows``), ``duplicates`` (rows whose key occurred before), ``misplaced`` (rows
        that belong in another partition), and ``outside`` (rows of partitions that are not
        in ``scope``, if one is given)."""
        rows = self.staged(version)
        part = F.col(self.partition).cast("string").alias("partition")
        measures = {"rows": F.count(F.lit(1))}
        measures["misplaced"] = F.count(F.when(self._misplaced(), 1)) if self.date_col else F.lit(0).cast("long")
        named = [str(v) for v in scope]
        outside = ~F.col(self.partition).cast("string").isin(named) if named else F.lit(False)
        measures["outside"] = F.count(F.when(outside, 1))
        per_part = rows.groupBy(part).agg(*[e.alias(n) for n, e in measures.items()])
        # Keys are counted once over the version; the repeats of a key are told with its least partition.
        per_key = rows.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n"), F.min(part).alias("partition")).filter("n > 1")
        repeats = per_key.groupBy("partition").agg(F.sum(F.col("n") - 1).alias("found"))
        checks = [
            per_part.select(F.lit(n).alias("check"), "partition", F.col(n).alias("found"), ok)
            for n, ok in (
                ("rows", (F.col("rows") >= least_rows).alias("ok")),
                ("misplaced", (F.col("misplaced") == 0).alias("ok")),
                ("outside", (F.col("outside") == 0).alias("ok")),
            )
        ]
        found = repeats.select(F.lit("duplicates").alias("check"), "partition", "found", F.lit(False).alias("ok"))
        for check in checks:
            found = found.unionByName(check)
        return found

    def versions(self) -> dict[str, str]:
        """The version that readers see of each partition value."""
        if not self.spark.catalog.tableExists(self.name):
            return {}
        found: dict[str, str] = {}
        for row in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect():  # bounded by the partitions
            if row["key"].startswith("partitions."):
                found |= dict.fromkeys(filter(None, row["value"].split(",")), row["key"].split(".")[1])
        return found

    def _show(self, versions: dict[str, str]) -> None:
        """Replace the view: one catalog operation."""
        by_version: dict[str, list[str]] = {}
        for value, version in sorted(versions.items()):
            if not re.fullmatch(r"[\w.: -]+", value):
                raise ValueError(f"partition value {value!r}")
            by_version.setdefault(version, []).append(value)
        kind = dict(self.spark.table(self.store).dtypes)[self.partition]
        columns = [c for c in self.spark.table(self.store).columns if c != VERSION]
        terms = [
            f"({VERSION} = '{version}' AND `{self.partition}` IN ({', '.join(f"CAST('{v}' AS {kind})" for v in values)}))"
            for version, values in by_version.items()
        ]
        properties = ", ".join(
            f"'partitions.{version}.{at}' = '{','.join(values[at : at + PROPERTY_VALUES])}'"
            for version, values in by_version.items()
            for at in range(0, len(values), PROPERTY_VALUES)
        )
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} {f'TBLPROPERTIES ({properties})' if properties else ''} AS "
            f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {self.store} WHERE {' OR '.join(terms) or 'false'}"
        )

    def publish(self, version: str, scope: Sequence[object] = (), audit: DataFrame | None = None) -> None:
        """Make a version visible if its audit has no fault.

        Its partitions replace the ones in use; partitions in ``scope`` without rows in it go
        at the same moment; all others stay. ``audit`` is that of :meth:`audit`, made with
        default limits if left out.
        """
        report = self.audit(version, scope=scope) if audit is None else audit
        faults = report.filter(~F.col("ok")).groupBy("check").agg(F.sum("found").alias("n")).orderBy("check").collect()
        if faults:
            raise AuditFailed(", ".join(f"{r['check']}: {r['n']}" for r in faults))
        listed = self.spark.sql(f"SHOW PARTITIONS {self.store} PARTITION ({VERSION} = '{version}')").collect()
        written = [r[0].split(f"{self.partition}=", 1)[1] for r in listed]
        kept = {v: at for v, at in self.versions().items() if v not in {str(s) for s in scope}}
        self._show(kept | dict.fromkeys(written, version))

    def replace(self, df: DataFrame, scope: Sequence[object] = ()) -> None:
        """Stage, audit and publish."""
        self.publish(self.stage(df), scope)

    def vacuum(self) -> int:
        """Drop the partitions that no reader sees; returns their number. To be run when no
        other version is being staged."""
        seen = set(self.versions().items())
        gone = 0
        for row in self.spark.sql(f"SHOW PARTITIONS {self.store}").collect():  # bounded by the partitions
            version, value = (part.split("=", 1)[1] for part in row[0].split("/", 1))
            if (value, version) not in seen:
                self.spark.sql(f"ALTER TABLE {self.store} DROP IF EXISTS PARTITION ({VERSION} = '{version}', `{self.partition}` = '{value}')")
                gone += 1
        return gone

    def drop(self) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.store}")
