"""Table and raster sources and sinks through Spark's readers and writers."""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapair.functions.columns import clean
from terrapair.sources import stores

#: Bytes of a file that are hashed at once.
CHUNK = 8 << 20


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which a cluster must name; a local session gets one of its own."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-"))
    return spark.conf.get("spark.checkpoint.dir")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def load(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet or CSV by its name, with NaN and infinities as nulls."""
    reader = spark.read.schema(schema) if schema else spark.read
    if ".csv" in path.lower():
        reader = reader.option("header", True)
        return clean((reader if schema else reader.option("inferSchema", True)).csv(path))
    if ".json" in path.lower():
        return clean(reader.json(path))
    return clean(reader.parquet(path))


def save(df: DataFrame, path: str, kind: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Write a table; CSV has a header. Returns the path with its suffix."""
    path = path if path.endswith(f".{kind}") else f"{path}.{kind}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    (w.option("header", True) if kind == "csv" else w).format(kind).save(path)
    return path


def find(spark: SparkSession, folder: str, stem: str, kinds: Sequence[str] = ("parquet", "csv", "json")) -> str | None:
    """The table `stem` in a folder, by preference of kinds."""
    return next((p for k in kinds if exists(spark, p := f"{folder.rstrip('/')}/{stem}.{k}")), None)


def find_tiles(spark: SparkSession, folders: Sequence[str], pattern: str) -> list[str]:
    """Paths that match a glob below folders, at any depth, once each and sorted."""
    found: set[str] = set()
    for folder in folders:
        if exists(spark, folder):
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
            found |= {r[0] for r in files.select("path").distinct().collect()}  # the columns are file listings, nothing is read
    return sorted(found)


def _uri(spark: SparkSession, path: str) -> str:
    """A path with its file system, written in one way."""
    fs, p = _fs(spark, path)
    return re.sub(r"^(\w+):/+", r"\1:/", fs.makeQualified(p).toUri().toString())


def tile_name(path: str) -> str:
    """A tile's file or folder name without its kind."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return re.sub(r"\.(parquet|csv|json)$", "", name, flags=re.IGNORECASE)


def _merged(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """The tiles in as few scans as their schemas allow: one where these can be merged."""
    if not all(".parquet" in p.lower() or "." not in p.rstrip("/").rsplit("/", 1)[-1] for p in paths):
        return [load(spark, p) for p in paths]
    every = spark.read.option("mergeSchema", True)
    try:
        return [clean(every.parquet(*paths))]
    except Exception as e:  # bands of one name whose types differ
        if "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
    kinds: dict[str, list[str]] = {}
    for p in paths:
        kinds.setdefault(spark.read.parquet(p).schema.json(), []).append(p)
    return [clean(every.parquet(*group)) for group in kinds.values()]


def load_tiles(spark: SparkSession, paths: Sequence[str], keys: Sequence[str] = ("x_utm", "y_utm")) -> DataFrame:
    """Tiles as one pixel table: union with missing bands as nulls; of repeated positions the
    first cell of the tile that `paths` lists first counts.

    A tile without `source_tile` values is named after its file or folder; equal names get their parent
    folder's before them. Bands of unequal numeric types become doubles.
    """
    from terrapair.operators.extract import first_per_key

    if not paths:
        raise FileNotFoundError("no tiles")
    paths = list(dict.fromkeys(paths))
    names = [tile_name(p) for p in paths]
    names = [n if names.count(n) == 1 else "/".join([*p.rstrip("/").split("/")[-2:-1], n]) for n, p in zip(names, paths)]
    parts = [x.select("*", F.col("_metadata.file_path").alias("_file")) for x in _merged(spark, paths)]
    kinds: dict[str, set[str]] = {}
    for x in parts:
        for c, t in x.dtypes:
            kinds.setdefault(c, set()).add(t)
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    wide = {c for c, t in kinds.items() if len(t) > 1 and t <= numbers}
    parts = [x.withColumns({c: F.col(f"`{c}`").cast("double") for c in wide & set(x.columns)}) for x in parts]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # the driver's own listing says which tile a file belongs to
    tiles = sorted(((_uri(spark, p).rstrip("/"), i, n) for i, (p, n) in enumerate(zip(paths, names))), reverse=True)
    files = [(_uri(spark, f), *next((i, n) for t, i, n in tiles if f"{_uri(spark, f)}/".startswith(f"{t}/"))) for x in parts for f in x.inputFiles()]
    listed = spark.createDataFrame(files, "_file string, _at int, _name string")
    every = every.withColumn("_file", F.regexp_replace("_file", r"^(\w+):/+", "$1:/")).join(listed, "_file").drop("_file")
    every = every.withColumn("source_tile", F.coalesce("source_tile", "_name") if "source_tile" in every.columns else F.col("_name")).drop("_name")
    order = ["_at", *(c for c in ("source_tile", "grid_row", "grid_col") if c in every.columns)]
    return first_per_key(every, keys, order).drop("_at")


def write_json(spark: SparkSession, path: str, obj: dict) -> None:
    """A report or manifest, to any Hadoop file system."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(obj, indent=2, default=str).encode()))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str) -> dict | None:
    """A report, None if there is no such file."""
    if not exists(spark, path):
        return None
    rows = spark.read.text(path, wholetext=True).collect()
    return json.loads(rows[0][0])


def checksums(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, length, sha256) of the files of a folder, hashed by the executors in pieces of CHUNK bytes, whatever their size.

    In a store that Arrow can't open a file is one value, of 2 GB at most. Spark lists no empty files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    listed = files.select("path", "length")
    if not stores.seekable(listed):
        return files.select("path", "length", F.sha2("content", 256).alias("sha256"))
    return listed.mapInArrow(_digests, "path string, length long, sha256 string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = []
        for path in batch.column("path").to_pylist():
            h = hashlib.sha256()
            with stores.opened(path) as f:
                while piece := f.read(CHUNK):
                    h.update(piece)
            sums.append(h.hexdigest())
        yield pa.record_batch([batch.column("path"), batch.column("length"), pa.array(sums, pa.string())], names=["path", "length", "sha256"])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def resolve_band(names: Sequence[str], name: str | None = None, index: int | None = None) -> str:
    """A band by exact name, then without case, else by its 1-based index."""
    if name is not None:
        if name in names:
            return name
        same = [n for n in names if n.lower() == name.lower()]
        if same:
            return same[0]
    if index is not None and 1 <= index <= len(names):
        return names[index - 1]
    raise ValueError(f"no band {name or index} among {list(names)}")


def edges_from_wkt(df: DataFrame, wkt: str = "wkt", poly_id: str = "poly_id") -> DataFrame:
    """Polygons in WKT to the edge list (poly_id, ring_id, edge_id, x0, y0, x1, y1).

    POLYGON and MULTIPOLYGON with holes; null and empty geometries give no edges. String
    and array functions only.
    """
    rings = F.filter(F.transform(F.split(F.regexp_replace(F.col(wkt), r"(?i)^\s*(MULTI)?POLYGON\s*", ""), r"\)\s*,?"), lambda s: F.trim(F.regexp_replace(s, r"[(]", ""))), lambda s: F.length(s) > 0)
    ring = df.where(F.col(wkt).isNotNull() & ~F.upper(wkt).contains("EMPTY")).select(poly_id, F.posexplode(rings).alias("ring_id", "ring"))
    points = F.transform(F.split("ring", r"\s*,\s*"), lambda p: F.transform(F.split(F.trim(p), r"\s+"), lambda v: v.try_cast("double")))
    edge = F.transform(F.sequence(F.lit(0), F.size("points") - 2), lambda i: F.struct(F.get("points", i).alias("a"), F.get("points", i + 1).alias("b")))
    out = ring.withColumn("points", points).where(F.size("points") >= 2).select(poly_id, "ring_id", F.posexplode(edge).alias("edge_id", "e"))
    return out.select(poly_id, "ring_id", "edge_id", F.col("e.a")[0].alias("x0"), F.col("e.a")[1].alias("y0"), F.col("e.b")[0].alias("x1"), F.col("e.b")[1].alias("y1"))
