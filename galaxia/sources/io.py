"""S1-S12 (scans, sinks, schema/table helpers) and the stored gold state.

``GoldStore`` keeps each incremental table as Parquet partitioned by a hash
bucket of its merge key, in numbered version folders; a small JSON manifest
names, per table and bucket, the version that is current.  A batch reads only
the buckets its keys fall in (partition pruning), merges them, writes the new
buckets to a new version folder and then replaces the manifest -- the single
publish step.  A crash before it leaves the previous state untouched; rerunning
the batch is harmless because every merge is keyed.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import rules as R
from ..operators.ids import packed, packed_ids, shown
from ..session import scratch_scope
from . import schemas

# ------------------------------------------------------------------ S1 - S12


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header row, quoted fields, explicit schema (a UTF-8
    byte-order mark at the start is dropped by the reader).  An empty field is
    NULL, as in the reference's CSV reader.  ``multi_line`` is for tables whose
    text holds line breaks (reviews): such a file is read by one task."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", multi_line)
            .option("escape", '"').option("mode", "PERMISSIVE").csv(path))


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The well-formed rows, and the quarantine: every other line whole with its
    reason (``fields``: too few, too many or an open quote; ``value``: a field that is
    not of its column's type) and the file it came from.  Lines of nothing but blanks
    are no rows, nor, with ``header``, lines that hold the column names.  Lines hold no
    line breaks; for a table with such texts use :func:`read_csv`.

    Lines are parsed whole, whatever columns are asked for later: a scan that parses
    some columns only would not see what is wrong with the others."""
    names = schema.fieldNames()
    bad = "__line"
    while bad in names:
        bad += "_"
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}

    def parsed(kinds: list[str]):
        ddl = ", ".join(f"`{n}` {k}" for n, k in zip([*names, bad], [*kinds, "string"], strict=True))
        return F.from_csv("line", ddl, options)

    texts = parsed(["string"] * len(names))
    lines = (spark.read.text(path).select(F.regexp_replace("value", "^\ufeff", "").alias("line"), F.input_file_name().alias("file"))
             .where(F.trim("line") != ""))
    if header:
        same = [texts[n].eqNullSafe(F.lit(n)) for n in names]
        lines = lines.where(~(texts[bad].isNull() & reduce(lambda a, b: a & b, same)))
    rows = lines.withColumn("row", parsed([f.dataType.simpleString() for f in schema.fields]))
    quarantine = rows.where(F.col("row")[bad].isNotNull()).select(
        "line", F.when(texts[bad].isNotNull(), "fields").otherwise("value").alias("reason"), "file")
    return rows.where(F.col("row")[bad].isNull()).select([F.col("row")[n].alias(n) for n in names]), quarantine


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or a Parquet folder when given a path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.read.table(name_or_path)


def read_source_changes(spark: SparkSession, url: str, table: str, watermark, properties: dict,
                        partition_column: str | None = None, lower: int | None = None,
                        upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Rows of a relational source table changed after ``watermark``;
    the predicate runs inside the source and the read is split over
    ``partition_column`` ranges so it is parallel."""
    wm = "" if watermark is None else f" WHERE last_modified_at > '{watermark}'"
    query = f"(SELECT * FROM {table}{wm}) AS changes"
    if partition_column:
        return spark.read.jdbc(url, query, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions or spark.sparkContext.defaultParallelism, properties=properties)
    return spark.read.jdbc(url, query, properties=properties)


def bronze_ingest(df: DataFrame, table: str, now=None) -> DataFrame:
    """Land a source table unchanged, stamped with the load time and its name."""
    stamp = R.ts_lit(now) if now is not None else F.localtimestamp()
    return df.withColumns({"ingested_at": stamp, "Source_Table": F.lit(table)})


def silver_stamp(df: DataFrame, source_table: str, now=None) -> DataFrame:
    """P5 + P6: the silver load columns."""
    stamp = R.ts_lit(now) if now is not None else F.localtimestamp()
    return df.withColumns({"silver_loaded_date": stamp, "silver_source_table": F.lit(source_table)})


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by=None) -> None:
    """Append to or replace a Parquet table (replace = overwrite
    with the explicit schema of ``df``)."""
    w = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Export as CSV with a header, no row-index column; quotes doubled
    inside quoted fields, blanks kept, '' and NULL kept apart."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict) -> None:
    """Append to a relational table."""
    df.write.mode("append").jdbc(url, table, properties=properties)


def ensure_schema(spark: SparkSession, name: str) -> None:
    """Create a namespace when missing."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def clear_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """Empty a table, keeping its schema."""
    schemas.empty(spark, schema).write.mode("overwrite").parquet(path)


# ------------------------------------------------------------------ stored state

# Bucket column of each stored table (the first column of its merge key), or
# None for tables that are small by construction (one row per source table).
BUCKET_KEY = {
    "dim_customers": "customer_id", "dim_sellers": "seller_id", "dim_products": "product_id",
    "fact_orders": "order_id", "fact_order_items": "order_id", "fact_order_payments": "order_id",
    "fact_order_reviews": "review_id",
    "parked_orders": "order_id", "parked_order_items": "order_id", "parked_order_payments": "order_id",
    "parked_order_reviews": "review_id", "control": None,
}


class GoldStore:
    """Versioned, bucketed Parquet state under ``root`` (any Hadoop file system)."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64,
                 workers: int = 4):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.workers = workers   # independent tables are built and written concurrently
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- manifest
    def _read_text(self, path: str) -> str | None:
        p = self._Path(path)
        if not self._fs.exists(p):
            return None
        stream = self._fs.open(p)
        try:
            reader = self.spark._jvm.java.io.BufferedReader(
                self.spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines, line = [], reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()

    def manifest(self) -> dict:
        """The newest published manifest (manifests are written once, numbered)."""
        d = self._Path(f"{self.root}/_manifests")
        if not self._fs.exists(d):
            return {"version": 0, "tables": {}, "applied": []}
        names = [st.getPath().getName() for st in self._fs.listStatus(d)]
        done = sorted(n for n in names if n.endswith(".json"))
        if not done:
            return {"version": 0, "tables": {}, "applied": []}
        return json.loads(self._read_text(f"{self.root}/_manifests/{done[-1]}"))

    def _publish(self, manifest: dict) -> None:
        """The single publish step: write the manifest under a temporary name,
        then rename it to its numbered name (an atomic rename to a new name)."""
        tmp = self._Path(f"{self.root}/_manifests/.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(tmp, True)
        try:
            out.write(bytearray(json.dumps(manifest, sort_keys=True).encode("utf-8")))
        finally:
            out.close()
        final = self._Path(f"{self.root}/_manifests/{manifest['version']:012d}.json")
        if not self._fs.rename(tmp, final):
            raise RuntimeError(f"could not publish manifest version {manifest['version']}")

    # -- tables
    def _bucket(self, df: DataFrame, key: str):
        """The bucket of each row of ``df``, by the text of its key."""
        text = R.unpack_id(key) if key in packed_ids(df) else F.col(key)
        return F.pmod(F.xxhash64(text), F.lit(self.buckets)).cast("int")

    def _bucket_of(self, value: str):
        """The bucket of one key value (as a column expression)."""
        return F.pmod(F.xxhash64(F.lit(value)), F.lit(self.buckets)).cast("int")

    def _schema(self, table: str) -> StructType:
        if table == "control":
            return schemas.CONTROL
        if table.startswith("parked_"):
            return schemas.SILVER[table[len("parked_"):]]
        return schemas.stored(table)

    def read(self, table: str, buckets=None, manifest: dict | None = None) -> DataFrame:
        """The current published rows of ``table`` (only ``buckets`` when given)."""
        return self._read(table, buckets, manifest).drop(schemas.VERSION)

    def _read(self, table: str, buckets=None, manifest: dict | None = None) -> DataFrame:
        """The rows as they are stored, with their change time."""
        m = (manifest or self.manifest())["tables"].get(table)
        schema = self._schema(table)
        if not m or not m["parts"]:
            return schemas.empty(self.spark, schema)
        if BUCKET_KEY.get(table) is None:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/v={m['parts']['all']}")
        parts = {int(b): v for b, v in m["parts"].items()}
        if buckets is not None:
            parts = {b: v for b, v in parts.items() if b in set(buckets)}
        if not parts:
            return schemas.empty(self.spark, schema)
        paths = [f"{self.root}/{table}/v={v}/bucket={b}" for b, v in sorted(parts.items())]
        return self.spark.read.schema(schema).parquet(*paths)

    def _by_bucket(self, df: DataFrame, key: str) -> DataFrame:
        """The rows with their bucket.  One shuffle groups them by it, so each bucket gets a
        few files; rebalance lets AQE join small buckets and split one that a hot key
        fills.  The shuffle carries packed ids."""
        df = packed(df)
        return shown(df.withColumn("bucket", self._bucket(df, key)).hint("rebalance", "bucket"))

    def _write(self, table: str, df: DataFrame, version: int, entry: dict) -> dict:
        """Write ``df`` as version ``version`` of ``table``; return the manifest entry."""
        # no two writers share a folder: whoever publishes first wins, and the other's
        # files are never looked at
        version = f"{version}-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{table}/v={version}"
        key = BUCKET_KEY.get(table)
        entry = {"parts": dict(entry.get("parts", {})), "max_sk": entry.get("max_sk", 0)}
        if key is None:
            df.write.mode("overwrite").parquet(path)
            entry["parts"] = {"all": version}
            return entry
        (self._by_bucket(df, key).write.mode("overwrite").option("compression", "zstd")
             .partitionBy("bucket").parquet(path))
        for st in self._fs.listStatus(self._Path(path)):
            name = st.getPath().getName()
            if name.startswith("bucket="):
                entry["parts"][name[len("bucket="):]] = version
        sk = schemas.GOLD_KEYS.get(table, (None,))[0]
        if sk:   # a scan of this one column
            written = self.spark.read.schema(self._schema(table)).parquet(path).agg(F.max(sk)).first()[0]
            entry["max_sk"] = max(int(written or 0), int(entry["max_sk"] or 0))
        return entry

    def publish_initial(self, state: dict[str, DataFrame], tables=None, medians: dict | None = None) -> dict:
        """Write a whole state (e.g. ``initial_load``) as one new version;
        ``medians`` (``Params.observed`` of the load) are kept for later batches.
        Batch ids applied before belong to the state this one replaces, so they
        are forgotten."""
        m = self.manifest()
        v = m["version"] + 1
        new = {"version": v, "tables": dict(m["tables"]), "applied": [],
               "medians": {**m.get("medians", {}), **(medians or {})}}
        names = list(tables or BUCKET_KEY)
        written = self._parallel(names, lambda t: self._write(t, state[t], v, {}))
        new["tables"].update(written)
        new["medians"].update(medians or {})   # filled while the tables were built
        self._publish(new)
        return new

    def _parallel(self, names, fn) -> dict:
        from ..plans.lazy import build_all
        return build_all(names, fn, self.workers)

    def state(self, manifest: dict | None = None) -> dict[str, DataFrame]:
        from ..plans.incremental import Lazy
        m = manifest or self.manifest()
        return Lazy({t: (lambda t=t: self._read(t, manifest=m)) for t in BUCKET_KEY})

    def run_batch(self, changes: dict[str, DataFrame], params, now, batch_id=None) -> dict:
        """I4 against the stored state: each upsert reads only the buckets its
        rows fall in (partition-pruned), writes them to a new version folder,
        and the manifest is replaced once at the end.  A batch id already
        applied is skipped (exactly-once effect).  Intermediate tables of the
        batch live in their own scratch folder, removed after publishing."""
        m = self.manifest()
        if batch_id is not None and batch_id in m.get("applied", []):
            return m
        with scratch_scope(self.spark, "batch"):   # nothing published refers to the intermediate tables
            return self._run_batch(m, changes, params, now, batch_id)

    def _run_batch(self, m: dict, changes, params, now, batch_id) -> dict:
        from ..operators.merge import UPDATE_COLS, upsert
        from ..plans import incremental as I

        import dataclasses
        v = m["version"] + 1
        work = {"version": v, "tables": dict(m["tables"]), "applied": list(m.get("applied", [])),
                "medians": dict(m.get("medians", {}))}
        # a batch whose column has no value at all falls back to the last published median
        params = dataclasses.replace(params, fallback_medians={**work["medians"], **params.fallback_medians},
                                     observed={})

        def merge(table: str, target_full: DataFrame, rows: DataFrame) -> DataFrame:
            key = BUCKET_KEY[table]
            sk, keys = schemas.GOLD_KEYS[table]
            touched = [r[0] for r in rows.select(self._bucket(rows, key)).distinct().collect()]  # <= buckets
            if not touched:
                return target_full
            entry = work["tables"].get(table, {})
            target = packed(self._read(table, buckets=touched, manifest=work))
            merged = upsert(target, rows, keys, UPDATE_COLS[table], sk, start_sk=entry.get("max_sk", 0))
            work["tables"][table] = self._write(table, merged, v, entry)
            return self.read(table, manifest=work)

        def lookup(table: str, rows: DataFrame, key: str, full: DataFrame) -> DataFrame:
            # parents are bucketed by exactly this key: read only the buckets of the batch's keys
            touched = [r[0] for r in rows.select(self._bucket(rows, key)).distinct().collect()]  # <= buckets
            return self.read(table, buckets=touched, manifest=work)

        new_state = I.run_batch(self.state(m), changes, params, now, merge=merge, lookup=lookup)
        # the merges write their buckets as they run (dependencies resolve
        # through the lazy state); parked rows and control are written whole
        merged = ["dim_customers", *I.REFRESHED.values(), "fact_orders", "fact_order_items", "fact_order_payments",
                  "fact_order_reviews"]
        rest = ["parked_orders", "parked_order_items", "parked_order_payments", "parked_order_reviews",
                "control"]

        def build(t):
            df = new_state[t]
            return None if t in merged else self._write(t, df, v, {})
        for t, entry in self._parallel(merged + rest, build).items():
            if entry is not None:
                work["tables"][t] = entry
        if batch_id is not None:
            work["applied"].append(batch_id)
        work["medians"].update(params.observed)
        self._publish(work)
        return work

