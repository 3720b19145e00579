"""Day-partitioned Parquet tables and cell tables, in versions."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.keys import region_of
from footfall.operators.cells import latest_cells, merged_cells
from footfall.schemas import CELL_SCHEMA
from footfall.session import discard, materialize
from footfall.sinks import versions
from footfall.sinks.versions import Conflict, File, Version, folder_of, hadoop_path

CELLS = "all"  # stands for the day of a table without days
FOLD_AFTER = 16
# A lookup leaves out row groups whose filter does not know the key; spans of the key leave out files before.
BLOOM = {"parquet.bloom.filter.enabled#rowkey": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def publish(spark: SparkSession, root: str, day: str, files: list[File], folders: dict[str, int]) -> Version:
    """Make finished files the day's current version, whatever it was before."""
    while True:
        try:
            return versions.commit(spark, root, day, versions.current(spark, root, day), files, folders)
        except Conflict:  # replaced by another writer meanwhile: this one comes after it
            continue


def write_day(rows: DataFrame, root: str, day: str, key: str | None = None) -> str:
    """Replace one day of a table, also when the rerun has no rows for it; returns the new version's folder.

    With ``key``, which the rows should be sorted by, each file's span of it is kept with the version.
    """
    spark, folder = rows.sparkSession, folder_of(day, uuid.uuid4().hex)
    rows.drop("day").write.options(**BLOOM).parquet(f"{root.rstrip('/')}/{folder}")
    files = versions.written_files(spark, root, [folder], key)[folder]
    publish(spark, root, day, files, {folder: len(files)} if key else {})
    return f"{root.rstrip('/')}/{folder}"


def write_days(rows: DataFrame, root: str, *order: str) -> None:
    """Replace every day that ``rows`` holds and keep the others: for backfills.

    Rows are ranged by day and the columns of ``order`` and sorted, so a heavy day spans several files, each of a
    narrow range of the order: a point lookup then skips most files and row groups. The spans of the first column of
    ``order`` are kept with the version.
    """
    spark, root, version = rows.sparkSession, root.rstrip("/"), uuid.uuid4().hex
    ranged = rows.withColumn("version", F.lit(version)).repartitionByRange("day", *order)
    writer = ranged.sortWithinPartitions("day", *order).write.options(**BLOOM).mode("append").partitionBy("day", "version")
    writer.parquet(root)
    top, fs = hadoop_path(spark, root)
    days = [s.getPath().getName().removeprefix("day=") for s in fs.listStatus(top) if s.getPath().getName().startswith("day=")]
    mine = [f for f in (folder_of(day, version) for day in days) if fs.exists(hadoop_path(spark, f"{root}/{f}")[0])]
    for folder, files in versions.written_files(spark, root, mine, order[0] if order else None).items():
        publish(spark, root, folder.split("/")[0].removeprefix("day="), files, {folder: len(files)} if order else {})


def append_day(rows: DataFrame, root: str, day: str) -> Version:
    """Add rows to a day as one more folder; nothing that is there is read or written."""
    spark, folder = rows.sparkSession, folder_of(day, uuid.uuid4().hex)
    rows.drop("day").write.options(**BLOOM).parquet(f"{root.rstrip('/')}/{folder}")
    while True:
        base = versions.current(spark, root, day)
        try:
            return versions.commit(spark, root, day, base, [*base.files, File(folder)], {})
        except Conflict:
            continue


def upsert_days(rows: DataFrame, root: str, merge: Callable[[DataFrame], DataFrame], key: str = "rowkey") -> None:
    """Merge rows into the days they belong to: late log lines into loaded days, for instance.

    ``merge`` makes the stored rows out of old and new ones, such that merging in two steps is merging once. Only files
    in whose span of ``key`` a new row falls are read and written anew, as files of a new folder; the others are taken
    over as they are. A key between two spans belongs to the file before. A day that another writer changed meanwhile is
    merged again with what that one left.
    """
    spark, root = rows.sparkSession, root.rstrip("/")
    news = materialize(merge(rows), "news")
    todo = sorted(r[0] for r in news.select("day").distinct().collect())  # days: a file each in any case
    place_key = F.concat_ws("~", "day", key)
    try:
        while todo:
            base = {day: versions.current(spark, root, day) for day in todo}
            spans = [(d, f) for d in todo for f in sorted((f for f in base[d].files if f.low is not None), key=lambda f: f.low)]
            # The first file of a day takes all keys before its own, too.
            bounds = [d if i == 0 or spans[i - 1][0] != d else f"{d}~{f.low}" for i, (d, f) in enumerate(spans)]
            mine = news.where(F.col("day").isin(todo))
            known = mine.where(F.col("day").isin(sorted({d for d, _ in spans}))).select(place_key.alias("place"))
            # One number per file at most.
            hit = {r[0] - 1 for r in known.select(region_of("place", bounds).alias("n")).distinct().collect()}
            old = [f for i, (_, f) in enumerate(spans) if i in hit] + [f for d in todo for f in base[d].files if f.low is None]
            kept = {d: [f for i, (x, f) in enumerate(spans) if x == d and i not in hit] for d in todo}
            folders = {name: n for d in todo for name, n in base[d].folders.items()}
            full = T.StructType([*news.schema.fields, T.StructField("version", T.StringType())])
            stored = versions.read(spark, root, full, Version(0, [], folders), old)
            both = mine if stored is None else merge(stored.select(*news.columns).unionByName(mine))
            version = uuid.uuid4().hex
            ranged = both.withColumn("version", F.lit(version)).repartitionByRange("day", key)
            writer = ranged.sortWithinPartitions("day", key).write.options(**BLOOM).mode("append")
            writer.partitionBy("day", "version").parquet(root)
            late, written = [], versions.written_files(spark, root, [folder_of(day, version) for day in todo], key)
            for day in todo:
                folder = folder_of(day, version)
                files = written[folder]
                try:
                    versions.commit(spark, root, day, base[day], kept[day] + files, {folder: len(files)})
                except Conflict:
                    path, fs = hadoop_path(spark, f"{root}/{folder}")
                    fs.delete(path, True)
                    late.append(day)
            todo = late
    finally:
        discard(news)


def write_report(rows: DataFrame, root: str, day: str) -> str:
    """A small result table as one file per day."""
    return write_day(rows.coalesce(1), root, day)


def read_days(
    spark: SparkSession, root: str, schema: T.StructType | str, day: str | None = None, key: str | None = None,
    prefix: str | None = None,
) -> DataFrame:
    """The table's current days, or one of them, with ``day`` as text; a filter on it prunes folders.

    With ``key`` or ``prefix``, only rows whose ``rowkey`` is it, or begins with it, from the files that may hold them.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    held = versions.all_current(spark, root) if day is None else {day: versions.current(spark, root, day)}
    files, folders = [], {}
    for version in held.values():
        files += versions.holding(version.files, key, prefix)
        folders |= version.folders
    full = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    rows = versions.read(spark, root, full, Version(0, files, folders), files)
    rows = spark.createDataFrame([], schema) if rows is None else rows.select(*schema.names)
    return _with_keys(rows, key, prefix)


def _with_keys(rows: DataFrame, key: str | None, prefix: str | None) -> DataFrame:
    if key is not None:
        rows = rows.where(F.col("rowkey") == key)
    return rows if prefix is None else rows.where(F.col("rowkey").startswith(prefix))


def _store_cells(cells: DataFrame, root: str, run: int = 0) -> tuple[list[File], dict[str, int]]:
    """Write cells in key order, one folder per family, so that a scan of a family opens only its own."""
    folder = folder_of(CELLS, uuid.uuid4().hex)
    ordered = cells.repartitionByRange("family", "rowkey", "qualifier").sortWithinPartitions("family", "rowkey", "qualifier")
    ordered.write.options(**BLOOM).partitionBy("family").parquet(f"{root.rstrip('/')}/{folder}")
    files = versions.written_files(cells.sparkSession, root, [folder], "rowkey", run)[folder]
    return files, {folder: len(files)}


def write_cells(cells: DataFrame, root: str) -> None:
    """Replace a cell table. Versions of the table are kept like a day's."""
    publish(cells.sparkSession, root, CELLS, *_store_cells(cells, root))


def read_cells(
    spark: SparkSession, root: str, family: str | None = None, key: str | None = None, prefix: str | None = None
) -> DataFrame:
    """The current version of a cell table, puts merged in; or a family, a row, the rows of a key prefix of it.

    With ``key`` or ``prefix`` only files whose span of row keys may hold one are opened.
    """
    version = versions.current(spark, root, CELLS)
    files = versions.holding(version.files, key, prefix)

    def cells(of: list[File]) -> DataFrame | None:
        found = versions.read(spark, root, CELL_SCHEMA, version, of)
        if found is None:
            return None
        found = found.select(*CELL_SCHEMA.names)
        return _with_keys(found if family is None else found.where(F.col("family") == family), key, prefix)

    base, runs = cells([f for f in files if not f.run]), cells([f for f in files if f.run])
    if base is None:
        base = spark.createDataFrame([], CELL_SCHEMA)
    return base if runs is None else merged_cells(base, runs)


def put_cells(spark: SparkSession, root: str, changes: DataFrame, fold_after: int = FOLD_AFTER) -> None:
    """Put changes into a stored cell table: they are written as a sorted run beside it, and merged when it is read.

    A put costs what it changes. Puts of several writers are all kept: the one that comes late joins its run to the
    version it finds. Every ``fold_after`` runs they are folded into the table (0: never).
    """
    files, folders = _store_cells(latest_cells(changes.select(*CELL_SCHEMA.names)).select(*CELL_SCHEMA.names), root)
    while True:
        base = versions.current(spark, root, CELLS)
        run = max([0, *base.runs()]) + 1
        try:
            made = versions.commit(spark, root, CELLS, base, base.files + [f._replace(run=run) for f in files], folders)
            break
        except Conflict:
            continue
    if fold_after and len(made.runs()) >= fold_after:
        fold_cells(spark, root)


def fold_cells(spark: SparkSession, root: str) -> None:
    """Write the table with its runs merged in as its new base. Runs that are put meanwhile stay runs."""
    while True:
        base = versions.current(spark, root, CELLS)
        if not base.runs():
            return
        files, folders = _store_cells(read_cells(spark, root), root)
        while True:
            now = versions.current(spark, root, CELLS)
            if [f for f in now.files if not f.run] != [f for f in base.files if not f.run]:
                break  # replaced or folded by another writer: begin again
            later = [f for f in now.files if f.run and f not in base.files]
            try:
                versions.commit(spark, root, CELLS, now, files + later, folders)
                return
            except Conflict:
                continue


def read_family(spark: SparkSession, root: str, family: str) -> DataFrame:
    return read_cells(spark, root, family)


def _name(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_cell_table(spark: SparkSession, name: str, root: str, families: list[str]) -> None:
    """Create a cell table in the catalog, one partition per family, unless it exists."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} "
        "(rowkey STRING, qualifier STRING, ts BIGINT, value STRING, family STRING) "
        f"USING parquet PARTITIONED BY (family) LOCATION {_name(root)}"
    )
    for family in families:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (family = {_name(family)})")


def publish_cells(spark: SparkSession, name: str, root: str) -> None:
    """Make the current version of the cell table at ``root`` what SQL reads under ``name``.

    Puts are folded, then each family's partition is pointed at the version's folder; a family that the version has
    and the catalog has not is added, one that has no cells any more becomes empty. Families switch one after another,
    and SQL reads the version named last until this is called again, so call it after each write.
    """
    fold_cells(spark, root)
    version, root = versions.current(spark, root, CELLS), root.rstrip("/")
    found = {}
    for file in version.files:
        folder = file.path.rsplit("/", 1)[0]
        found[unquote(folder.rsplit("/family=", 1)[1])] = f"{root}/{folder}"
    listed = {unquote(r.partition.removeprefix("family=")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for family in sorted(listed | found.keys()):
        place = found.get(family)
        if place is None:
            place = f"{root}/no_cells"
            path, fs = hadoop_path(spark, place)
            fs.mkdirs(path)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (family = {_name(family)}) LOCATION {_name(place)}")
        spark.sql(f"ALTER TABLE {name} PARTITION (family = {_name(family)}) SET LOCATION {_name(place)}")
    spark.catalog.refreshTable(name)


def list_families(spark: SparkSession) -> DataFrame:
    """Every partitioned table of the current database with its families."""
    found = []  # metadata: a row per table and family
    for table in spark.catalog.listTables():
        if table.tableType not in ("MANAGED", "EXTERNAL"):
            continue
        columns = spark.catalog.listColumns(table.name)
        if any(c.isPartition and c.name == "family" for c in columns):
            for row in spark.sql(f"SHOW PARTITIONS {table.name}").collect():
                found.append((table.name, unquote(row.partition.removeprefix("family="))))
    return spark.createDataFrame(found, "table string, family string")
