"""Block tables in Parquet: rows ``block, metadata, <band bytes>``, clustered by block.

A table is a folder. Every load writes its rows to a new folder ``data/load=...`` and its document
beside it in ``docs/load=...``, and if asked for a summary of its values in ``summaries/load=...``.
What counts is the list of live loads in ``_live``: a small file per
commit, written last, with the folders of the live loads and the table's merged document. Readers
take the newest. So no data is ever moved or overwritten, a load that fails leaves the table as it
was, and a load written again replaces itself. ``vacuum`` removes folders that no list names.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.errors import IncompatibleTable
from gridmill.operators import metadata as meta
from gridmill.operators import summaries
from gridmill.operators.tiling import merge_copies
from gridmill.spec import check_names

MODES = ("error", "overwrite", "append")
PARTS = ("data", "docs", "summaries")
MOST_TRIES = 20  # to commit while others do
PROPERTY_SIZE = 3000  # characters of a table property

META_SCHEMA = T.StructType(
    [
        T.StructField("block", T.LongType(), False),
        T.StructField("metadata", T.StringType()),
    ]
)


def clustered(blocks: DataFrame, parallelism: int | None = None) -> DataFrame:
    """Spread rows by ranges of their block and sort them, so that readers can skip row groups."""
    how_many = [] if parallelism is None else [parallelism]
    return blocks.repartitionByRange(*how_many, "block").sortWithinPartitions("block")


def quote_name(name: str) -> str:
    """A dotted table name as a quoted SQL identifier. Parts may be quoted already; other back-ticks
    belong to the name and are doubled."""
    quoted = len(name) > 1 and all(
        len(part) > 2 and part[0] == part[-1] == "`" for part in name.split(".")
    )
    parts = [part[1:-1] if quoted else part.replace("`", "``") for part in name.split(".")]
    return ".".join(f"`{part}`" for part in parts)


def run_sql(spark: SparkSession, query: str, views: dict | None = None, **values) -> DataFrame:
    """Run SQL over DataFrames; ``{name}`` stands for a frame and ``:name`` for a value."""
    return spark.sql(query, args=values or None, **(views or {}))


def save_as_table(blocks: DataFrame, name: str, version: str, mode: str = "error") -> None:
    """Save blocks as a catalog table that carries a version label."""
    spark = blocks.sparkSession
    clustered(blocks).write.mode(mode).format("parquet").saveAsTable(name)
    label = blocks.sparkSession.range(1).select(meta.label_text(F.lit(version))).first()[0]
    spark.sql(
        f"ALTER TABLE {quote_name(name)} SET TBLPROPERTIES ('gridmill' = '{label}')"
    )


class BlockTable:
    """A block table under a path of any file system Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- files ---------------------------------------------------------------

    def _fs(self, path):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return target.getFileSystem(conf), target

    def _commits(self) -> list[str]:
        """The names of the commits, oldest first."""
        fs, target = self._fs(f"{self.path}/_live")
        if not fs.exists(target):
            return []
        return sorted(f.getPath().getName() for f in fs.listStatus(target))

    def _live(self) -> dict | None:
        """The newest whole commit: ``number, loads`` (folder by load id) and ``metadata``."""
        tools = self.spark._jvm.org.apache.commons.io.IOUtils
        for name in reversed(self._commits()):
            fs, target = self._fs(f"{self.path}/_live/{name}")
            stream = fs.open(target)
            try:
                return json.loads(tools.toString(stream, "UTF-8"))
            except json.JSONDecodeError:  # the writer has not finished it
                continue
            finally:
                stream.close()
        return None

    def _commit(self, number: int, loads: dict[str, str], metadata: str) -> bool:
        """Write a commit unless another writer took its number."""
        fs, target = self._fs(f"{self.path}/_live/{number:012d}.json")
        try:
            stream = fs.create(target, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in str(error.java_exception) or fs.exists(target):
                return False
            raise
        body = {"number": number, "loads": loads, "metadata": metadata}
        stream.write(bytearray(json.dumps(body).encode()))
        stream.close()
        return True

    def exists(self) -> bool:
        return self._live() is not None

    def drop(self) -> None:
        fs, target = self._fs(self.path)
        if fs.exists(target) and not fs.delete(target, True):
            raise OSError(f"Table {self.path} could not be removed")

    def vacuum(self) -> None:
        """Remove the folders that the newest commit does not name, and older commits.

        Not while others write, or read an older state.
        """
        live = self._live()
        if live is None:
            return
        keep = set(live["loads"].values())
        for part in PARTS:
            fs, root = self._fs(f"{self.path}/{part}")
            for status in fs.listStatus(root) if fs.exists(root) else []:
                if status.getPath().getName() not in keep:
                    fs.delete(status.getPath(), True)
        for name in self._commits():
            if name < f"{live['number']:012d}.json":
                fs, target = self._fs(f"{self.path}/_live/{name}")
                fs.delete(target, False)

    # -- reading -------------------------------------------------------------

    def _folders(self, part: str, loads: dict[str, str]) -> list[str]:
        return [f"{self.path}/{part}/{folder}" for folder in dict.fromkeys(loads.values())]

    def data(self) -> DataFrame:
        """The data rows ``block, <bands>``, without the metadata row."""
        return self._data(self._known())

    def _known(self) -> dict:
        live = self._live()
        if live is None:
            raise FileNotFoundError(f"There is no table at {self.path}")
        return live

    def _data(self, live: dict) -> DataFrame:
        return self.spark.read.parquet(*self._folders("data", live["loads"]))

    def read(self) -> DataFrame:
        """The whole table: data rows with null metadata, and the metadata row with block 0."""
        live = self._known()
        data = self._data(live)
        bands = [f for f in data.schema.fields if f.name != "block"]
        names = [F.col(f.name) for f in bands]
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in bands]
        rows = data.select("block", F.lit(None).cast("string").alias("metadata"), *names)
        return rows.union(self._row(live["metadata"]).select("block", "metadata", *empty))

    def metadata_rows(self) -> DataFrame:
        """The parsed document as one row; no row if the table has none."""
        row = self.read().where("block = 0").select(meta.parse(F.col("metadata")).alias("d"))
        return row.select("d.*")

    def metadata(self) -> dict | None:
        live = self._live()
        return None if live is None else json.loads(live["metadata"])

    def is_empty(self) -> bool:
        return not self.exists() or self.data().isEmpty()

    def records(self, limit: int = 10, ordered: bool = False) -> DataFrame:
        """Some rows of the table, or the first by block.

        For the first, their ids are found from the block column alone, and bands are then read
        only where files and row groups may hold them.
        """
        rows = self.read()
        if not ordered:
            return rows.limit(limit)
        last = rows.select("block").orderBy("block").limit(limit).agg(F.max("block")).first()[0]
        return rows.where(F.col("block") <= last).orderBy("block").limit(limit)

    def describe(self) -> DataFrame:
        """Rows ``column, type, rows, non_null`` for every column, in one pass."""
        table = self.read()
        counts = table.agg(F.count("*").alias("n"), *[F.count(c).alias(c) for c in table.columns])
        facts = F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(f.name).alias("column"),
                    F.lit(f.dataType.simpleString()).alias("type"),
                    F.col("n").alias("rows"),
                    F.col(f.name).alias("non_null"),
                )
                for i, f in enumerate(table.schema.fields)
            ]
        )
        return counts.select(F.explode(facts).alias("f")).select("f.*")

    def duplicates(self) -> DataFrame:
        """Blocks that more than one row has; appends do not merge tiles."""
        return self.data().groupBy("block").count().where("count > 1")

    def register(self, view: str) -> None:
        self.read().createOrReplaceTempView(view)

    # -- writing -------------------------------------------------------------

    def write(
        self,
        blocks: DataFrame,
        document: str,
        mode: str = "error",
        load: str | None = None,
        chunk_size: int | None = None,
        parallelism: int | None = None,
        is_clustered: bool = False,
        summary: DataFrame | None = None,
    ) -> str:
        """Write a load and return its id.

        ``mode`` says what to do if rows exist: ``error``, ``overwrite`` or ``append``. Readers see
        the new rows, the new document and the ``summary`` together, once all are written.
        """
        if mode not in MODES:
            raise ValueError(f"Invalid write mode {mode}")
        check_names([c for c in blocks.columns if c != "block"])
        if not is_clustered:
            blocks = clustered(blocks, parallelism)
        load = load or uuid.uuid4().hex
        filled = not self.is_empty()
        if filled and mode == "error":
            raise FileExistsError(f"Table {self.path} already exists and is not empty")
        if filled and mode == "append":
            self.check_fit(document, load)
        folder = f"load={load}-{uuid.uuid4().hex}"
        try:
            self._write_load(folder, blocks, document, chunk_size)
            if summary is not None:
                self._write_summary(folder, summary)
            self._add(load, folder, document, append=mode == "append")
        except BaseException:
            self._remove(folder)
            raise
        return load

    def load_rows(self, load: str) -> int:
        live = self._known()
        return self._data(live | {"loads": {load: live["loads"][load]}}).count()

    def _remove(self, folder: str) -> None:
        for part in PARTS:
            fs, left = self._fs(f"{self.path}/{part}/{folder}")
            fs.delete(left, True)

    def _write_load(self, folder, blocks, document, chunk_size):
        writer = blocks.write
        if chunk_size:
            writer = writer.option("maxRecordsPerFile", chunk_size)
        writer.parquet(f"{self.path}/data/{folder}")
        if document is not None:
            self._row(document).write.parquet(f"{self.path}/docs/{folder}")

    def _write_summary(self, folder: str, summary: DataFrame) -> None:
        summary.coalesce(1).write.parquet(f"{self.path}/summaries/{folder}")

    def summary(self) -> DataFrame | None:
        """The merged summary of all live loads; none if a load was written without one."""
        return self._summary(self._known()["loads"])

    def _summary(self, loads: dict[str, str]) -> DataFrame | None:
        folders = self._folders("summaries", loads)
        if not all(self._fs(f)[0].exists(self._fs(f)[1]) for f in folders):
            return None
        rows = self.spark.read.schema(summaries.SUMMARY).parquet(*folders)
        return summaries.merge(rows)

    def loaded_rows(self) -> DataFrame:
        """The data rows with ``end_x`` and ``end_y``, where the pixels of their load end, in pixels
        of the whole world at the table's resolution."""
        live = self._known()
        docs = self._documents(live["loads"]).withColumn("d", meta.parse(F.col("metadata")))
        return self._placed(live).join(docs.select("folder", *meta.pixel_ends("d")), "folder", "left")

    def set_statistics(self, records: dict[str, dict]) -> None:
        """Put statistics of bands into the table's document, fields by band name, and commit it."""
        live = self._known()
        document = json.loads(live["metadata"])
        for band in document["bands"]:
            band["stats"] |= records.get(band["name"], {})
        if not self._commit(live["number"] + 1, live["loads"], json.dumps(document)):
            raise OSError(f"Another writer changed {self.path}")

    def _add(self, load: str, folder: str, document: str | None, append: bool) -> None:
        """Commit a load whose files are written. An append merges its document with the table's;
        only a load that replaces itself has the documents of all loads merged anew."""
        for _ in range(MOST_TRIES):
            live = self._live() or {"number": 0, "loads": {}, "metadata": None}
            loads = dict(live["loads"]) if append else {}
            again = load in loads
            loads[load] = folder
            if document is None:
                merged = live["metadata"]
            elif len(loads) == 1:
                merged = document
            elif again:
                merged = self._merged(loads)
            else:
                merged = self._merge_two(live["metadata"], document)
            if self._commit(live["number"] + 1, loads, merged):
                return
        raise OSError(f"Other writers kept changing {self.path}")

    def _row(self, document: str) -> DataFrame:
        block, text = F.lit(0).cast("long").alias("block"), F.lit(document).alias("metadata")
        return self.spark.range(0, 1, 1, 1).select(block, text)

    def check_fit(self, document: str, load: str | None = None) -> None:
        """Refuse a document whose facts do not fit those of the table's other loads."""
        live = self._live()
        if live is None or not set(live["loads"]) - {load}:
            return
        pair = self.spark.createDataFrame(
            [(document, live["metadata"])], "new string, old string"
        )
        problem = meta.check(pair).first().problem
        if problem is not None:
            raise IncompatibleTable(problem)

    def _merge_two(self, old: str, new: str) -> str:
        pair = self.spark.createDataFrame([(0, old), (1, new)], "place int, metadata string")
        return meta.merge(pair, "place").first().metadata

    def _merged(self, loads: dict[str, str]) -> str:
        """The merged documents of all loads, in the order in which they were first committed."""
        order = self._order(loads)
        placed = self._documents(loads).join(F.broadcast(order), "folder")
        return meta.merge(placed, "place").first().metadata

    def _order(self, loads: dict[str, str]) -> DataFrame:
        places = [(folder, i) for i, folder in enumerate(dict.fromkeys(loads.values()))]
        return self.spark.createDataFrame(places, "folder string, place int")

    def _placed(self, live: dict) -> DataFrame:
        """The data rows with the ``folder`` of their load."""
        name = F.regexp_extract("_metadata.file_path", r"/data/([^/]+)/", 1)
        return self._data(live).select("*", name.alias("folder"))

    def compact(self, raster, compressed: bool = False, load: str | None = None) -> int:
        """Merge blocks that several loads have (see ``tiling.merge_copies``; later loads win) and
        return how many folders were written anew: only those that share blocks, with ``load`` only
        those that share blocks with it. Documents stay as they are, so the counts of blocks and
        pixels remain those of the loaded extents."""
        live = self._known()
        ids = self._placed(live).select("block", "folder")
        wanted = F.col("n") > 1
        if load is not None:
            own = F.col("folder") == live["loads"][load]
            edge = ids.where(own).agg(F.min("block"), F.max("block")).first()
            ids = ids.where(F.col("block").between(*edge))
            wanted &= F.col("touched")
        else:
            own = F.lit(True)
        blocks = ids.groupBy("block").agg(F.count("*").alias("n"), F.max(own).alias("touched"))
        shared = ids.join(blocks.where(wanted).select("block"), "block", "left_semi")
        folders = {r["folder"] for r in shared.select("folder").distinct().collect()}
        if not folders:
            return 0
        order = self._order(live["loads"])
        rows = self._placed(live).where(F.col("folder").isin(list(folders)))
        rows = rows.join(F.broadcast(order), "folder")
        folder = f"load=compact-{uuid.uuid4().hex}"
        some = {k: f for k, f in live["loads"].items() if f in folders}
        merged = clustered(merge_copies(rows, raster, "place", compressed))
        try:
            self._write_load(folder, merged, self._merged(some), None)
            summary = self._summary(some)
            if summary is not None:
                self._write_summary(folder, summary)
            loads = {k: folder if f in folders else f for k, f in live["loads"].items()}
            if not self._commit(live["number"] + 1, loads, live["metadata"]):
                raise OSError(f"Another writer changed {self.path}")
        except BaseException:
            self._remove(folder)
            raise
        return len(folders)

    def _documents(self, loads: dict[str, str]) -> DataFrame:
        """The documents of loads, as rows ``folder, metadata``; rows put in by hand have none."""
        there = [f for f in self._folders("docs", loads) if self._fs(f)[0].exists(self._fs(f)[1])]
        name = F.regexp_extract("_metadata.file_path", r"/docs/([^/]+)/", 1)
        docs = self.spark.read.schema(META_SCHEMA).parquet(*there)
        return docs.select(name.alias("folder"), "metadata")

    def refresh_metadata(self) -> None:
        """Merge the documents of all loads anew."""
        live = self._known()
        self._commit(live["number"] + 1, live["loads"], self._merged(live["loads"]))

    def insert(self, rows: list[dict], load: str | None = None) -> None:
        """Append a few rows given as dicts with the table's columns.

        The metadata row is not one of them: it follows from the loads, so a value for it is refused.
        """
        live = self._known()
        schema = self._data(live).schema
        unknown = {k for r in rows for k in r} - set(schema.names)
        if unknown:
            raise ValueError(f"Columns {sorted(unknown)} are not in the table")
        tuples = [tuple(r.get(c) for c in schema.names) for r in rows]
        load = load or uuid.uuid4().hex
        folder = f"load={load}-{uuid.uuid4().hex}"
        self._write_load(folder, self.spark.createDataFrame(tuples, schema), None, None)
        self._add(load, folder, None, append=True)


class CatalogTable(BlockTable):
    """A block table in Spark's catalog, under a name like ``catalog.schema.table``.

    Loads are partitions; the document of a load is its row of block 0. The list of live loads, the
    merged document and the version label are table properties, set in one statement. The catalog
    has no compare-and-set, so only one writer may commit at a time.
    """

    def __init__(self, spark: SparkSession, name: str):
        super().__init__(spark, name)
        self.name = quote_name(name)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.path)

    def properties(self) -> dict[str, str]:
        if not self.exists():
            return {}
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()
        return {r["key"]: r["value"] for r in rows}

    def _live(self) -> dict | None:
        found = self.properties()
        parts = [found[f"gridmill.live.{i}"] for i in range(int(found.get("gridmill.live", 0)))]
        return json.loads("".join(parts)) if parts else None

    def _commit(self, number: int, loads: dict[str, str], metadata: str) -> bool:
        body = json.dumps({"number": number, "loads": loads, "metadata": metadata})
        parts = [body[i : i + PROPERTY_SIZE] for i in range(0, len(body), PROPERTY_SIZE)]
        facts = {"gridmill.live": str(len(parts))}
        facts |= {f"gridmill.live.{i}": part for i, part in enumerate(parts)}
        if metadata:
            versions = [b["stats"]["version"] for b in json.loads(metadata).get("bands") or []]
            text = F.lit(next((v for v in versions if v), ""))
            facts["version"] = self.spark.range(1).select(meta.label_text(text)).first()[0]
        self._set(facts)
        return True

    def _set(self, facts: dict[str, str]) -> None:
        quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
        listed = ", ".join(f"{quote(k)} = {quote(v)}" for k, v in facts.items())
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ({listed})")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def vacuum(self) -> None:
        live = self._live()
        if live is None:
            return
        held = self.spark.table(self.path).select("load").distinct().collect()
        for folder in {r["load"] for r in held} - set(live["loads"].values()):
            self._remove(folder)

    def _remove(self, folder: str) -> None:
        if self.exists():
            spec = f"PARTITION (load = '{folder}')"
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {spec}")

    def _data(self, live: dict) -> DataFrame:
        rows = self.spark.table(self.path)
        ours = F.col("load").isin(list(live["loads"].values()))
        return rows.where(ours & (F.col("block") != 0)).drop("metadata", "load")

    def _write_summary(self, folder: str, summary: DataFrame) -> None:
        raise NotImplementedError("Summaries are kept by tables under a path")

    def _summary(self, loads: dict[str, str]) -> DataFrame | None:
        return None

    def _placed(self, live: dict) -> DataFrame:
        rows = self.spark.table(self.path).where("block <> 0")
        ours = F.col("load").isin(list(live["loads"].values()))
        return rows.where(ours).withColumnRenamed("load", "folder").drop("metadata")

    def _documents(self, loads: dict[str, str]) -> DataFrame:
        rows = self.spark.table(self.path).where("block = 0")
        ours = F.col("load").isin(list(loads.values()))
        return rows.where(ours).select(F.col("load").alias("folder"), "metadata")

    def _write_load(self, folder, blocks, document, chunk_size):
        bands = [c for c in blocks.columns if c != "block"]
        if not self.exists():
            columns = ", ".join(f"`{b}` {blocks.schema[b].dataType.simpleString()}" for b in bands)
            self.spark.sql(
                f"CREATE TABLE {self.name} (block BIGINT, metadata STRING, {columns}, load STRING)"
                " USING parquet PARTITIONED BY (load)"
            )
        columns = self.spark.table(self.path).columns

        def put(rows, size=None):
            rows = rows.withColumn("load", F.lit(folder)).select(*columns)
            writer = rows.write.option("maxRecordsPerFile", size) if size else rows.write
            writer.mode("append").insertInto(self.path)

        put(blocks.withColumn("metadata", F.lit(None).cast("string")), chunk_size)
        if document is not None:
            kinds = {b: F.lit(None).cast(blocks.schema[b].dataType) for b in bands}
            put(self._row(document).withColumns(kinds))
