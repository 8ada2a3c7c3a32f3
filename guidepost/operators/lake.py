"""Reading the directories that path resolution found."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.functions import column, free_name
from guidepost.plans import MAX_BROADCAST_BYTES, broadcast_if_small
from guidepost.sources import snapshot

# Scheme and host of a path: empty for a path of the default store, "s3a://bucket" for
# another, "file:" or "file://" where the scheme needs no host.
STORE = "^([A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?)?"

# Characters that Spark reports as percent escapes in file paths.
ESCAPED = "% \"#<>?[\\]^`{|}"

# Fixed value: the directory name that stands for a null in a partitioned table.
NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"

# What Spark says if files' types or directories' partitions do not go together.
UNLIKE = re.compile("MERGE|CONFLICTING_DIRECTORY_STRUCTURES")

# The path of a partition below its table.
PARTITIONS = "^(/[^/=]+=[^/]*)+$"

# Characters that would make a path a pattern.
PATTERN = re.compile(r"([\\\[\]{}*?])")

ASKED_AT_ONCE = 32
NAMES_AT_ONCE = 1024

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _escape(path: Column) -> Column:
    for char in ESCAPED:
        path = F.replace(path, F.lit(char), F.lit(f"%{ord(char):02X}"))
    return path


def _depth(inner: Column) -> Column:
    return F.regexp_count(inner, F.lit("/"))


def _upto(inner: Column, depth: Column) -> Column:
    """The first ``depth`` levels of a path."""
    return F.call_function("substring_index", inner, F.lit("/"), depth + 1)


def _owned_directories(paths: DataFrame, root: str | None) -> DataFrame:
    """Each directory once, as ``store`` and ``inner`` path, with the extractions that own it."""
    full = F.col("directory")
    if root is not None:
        full = F.concat(F.lit(root.rstrip("/") + "/"), F.ltrim(full, F.lit("/")))
    store = F.regexp_extract(full, STORE, 0)
    inner = F.regexp_replace(F.regexp_replace(full, STORE, ""), "/+", "/")
    return (
        paths.select(
            "extraction_id",
            F.regexp_replace(store, "//$", "").alias("store"),
            F.rtrim(inner, F.lit("/")).alias("inner"),
        )
        .groupBy("store", "inner")
        .agg(F.collect_set("extraction_id").alias("owners"))
    )


def _above(owned: DataFrame, itself: bool) -> DataFrame:
    """``store``, ``inner`` and ``above``: a row for each directory above one, and for itself."""
    last = _depth(F.col("inner"))
    levels = F.sequence(F.lit(0), last if itself else last - 1)
    steps = owned.where(last > 0).select("store", "inner", F.explode(levels).alias("level"))
    return steps.select("store", "inner", _upto(F.col("inner"), F.col("level")).alias("above"))


def _nested(owned: DataFrame) -> DataFrame:
    """``owned`` with the owners of the resolved directories above added to each one's own, and
    ``covered``: whether there is such a directory, so that reading that one reads this one too.

    Spark reads the directories below one if they are partitions, ``key=value``.
    """
    below = F.expr("substring(inner, length(above) + 1)")
    others = owned.select("store", F.col("inner").alias("above"), F.col("owners").alias("more"))
    from_above = (
        _above(owned, itself=False)
        .where(below.rlike(PARTITIONS))
        .join(others, ["store", "above"])
        .groupBy("store", "inner")
        .agg(F.array_distinct(F.flatten(F.collect_list("more"))).alias("more"))
    )
    found = owned.join(from_above, ["store", "inner"], "left")
    owners = F.array_union("owners", F.coalesce("more", F.array().cast(owned.schema["owners"].dataType)))
    return found.select(
        "store", "inner", owners.alias("owners"), F.col("more").isNotNull().alias("covered")
    )


def _exist(spark: SparkSession, directories: list[str]) -> list[bool]:
    """Which directories are there; asked in parallel, as stores take their time to answer."""
    jvm = spark.sparkContext._jvm
    settings = spark.sparkContext._jsc.hadoopConfiguration()

    def ask(directory: str) -> bool:
        path = jvm.org.apache.hadoop.fs.Path(directory)
        return path.getFileSystem(settings).exists(path)

    with ThreadPoolExecutor(ASKED_AT_ONCE) as pool:
        return list(pool.map(ask, directories))


def _refuse_delta(spark: SparkSession, owned: DataFrame) -> None:
    """End if a directory, or one above it, is a Delta table. The directories above are made
    distinct on the cluster, so each is asked for once, and come to the driver some at a time."""
    above = _above(owned, itself=True).select("store", "above").distinct()
    names = (row["store"] + row["above"] for row in above.toLocalIterator())
    while some := list(islice(names, NAMES_AT_ONCE)):
        logged = _exist(spark, [f"{name}/_delta_log" for name in some])
        if any(logged):
            example = some[logged.index(True)]
            raise ValueError(
                f"{example!r} is a Delta table: pass format='delta' and its partition_columns"
            )


def read_resolved(
    spark: SparkSession,
    paths: DataFrame,
    root: str | None = None,
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    missing: str = "error",
    format: str = "parquet",
    partition_columns: Sequence[str] = (),
) -> DataFrame:
    """Rows of the files below the directories in ``paths``, each with the ``extraction_id`` that
    asked for its directory; a row appears once for each of them.

    Directories are absolute, or relative to ``root``; their names are taken as they are, without
    patterns. A null directory is an error. There are two ways of reading them:

    By name. The distinct names come to the driver, as Spark lists files there; data rows and the
    extractions of a directory do not. A directory that is not there is an error, or left out with
    ``missing="skip"``. To a directory belong its own files and those of the partitions
    (``key=value``) below it; a partition that is resolved itself is read once, by the same scan, and
    its rows have the extractions of both. Without ``schema`` the result has the columns of all
    directories, whichever comes first; a column that only some have is null in the others, and
    types that differ are widened, while reading where the parquet reader can. ``options`` go to the
    reader, e.g. ``basePath`` to keep partition columns. ``format`` names the files' format; a
    directory at or below a transaction log of Delta Lake is refused as parquet, since its files also hold
    rows that were removed.

    By key, with ``partition_columns``: ``root`` is one table whose directories are ``key=value`` for
    these columns, in this order, and each directory names the values of all or of the first
    of them. The table is read at its root and joined with the keys, so no name comes to
    the driver, and Spark leaves out the other partitions at run time (as long as the keys
    may be broadcast). ``format="delta"`` needs this form, as such a table is only read
    whole. A directory that is not there has no rows.
    """
    if missing not in ("error", "skip"):
        raise ValueError(f"missing must be 'error' or 'skip', not {missing!r}")
    reader = spark.read.format(format).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    if partition_columns:
        if root is None:
            raise ValueError("partition_columns need the root of the table")
        if format == "parquet":
            at_root = paths.select("extraction_id", F.lit("").alias("directory")).limit(1)
            _refuse_delta(spark, _owned_directories(at_root, root))
            reader = reader.option("mergeSchema", "true")
        return _by_key(reader.load(root), paths, root, partition_columns, max_broadcast_bytes)
    if format == "delta":
        raise ValueError("format='delta' needs root and partition_columns")

    owned = snapshot(_nested(_owned_directories(paths, root)), "directories")
    names: dict[str, list[str]] = {}
    depths: dict[str, set[int]] = {}
    everything = []
    for row in owned.select("store", "inner", "covered").toLocalIterator():
        store, inner = row["store"], row["inner"]
        if inner is None:
            raise ValueError("a resolved directory is null")
        if not inner.startswith("/"):
            raise ValueError(f"directory {store + inner!r} is relative: pass root")
        everything.append(store + inner)
        depths.setdefault(store, set()).add(inner.count("/"))
        if not row["covered"]:
            names.setdefault(store, []).append(store + inner)
    there = dict(zip(everything, _exist(spark, everything)))
    absent = sorted(name for name in everything if not there[name])
    if absent and missing == "error":
        raise FileNotFoundError(f"{len(absent)} directories are not there, e.g. {absent[:5]}")
    if len(absent) == len(everything):
        raise LookupError("no directory was resolved, so there is nothing to read")
    if format == "parquet":
        _refuse_delta(spark, owned)

    reads = []
    for store, own in names.items():
        # Where a covering directory is not there, neither are those below it.
        known = sorted(name for name in own if there[name])
        owners = owned.where(F.col("store") == F.lit(store))
        for data in _read_all(reader, known, schema is None, format):
            reads.append(_with_extraction(data, owners, depths[store], max_broadcast_bytes))
    return _united(reads)


def _alike(reader: DataFrameReader, names: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """The directories, dealt to groups whose files' columns and partitions go together.

    A Spark job merges the columns of all files; if types differ, each half is tried by itself. Names
    are sorted and types mostly change once in time, so a change among n directories takes some
    2 log n jobs.
    """
    try:
        return [(reader.option("mergeSchema", "true").load(names).schema, names)]
    except (PySparkException, Py4JJavaError) as error:
        if not UNLIKE.search(str(error).upper()) or len(names) == 1:
            raise
    middle = len(names) // 2
    groups: list[tuple[T.StructType, list[str]]] = []
    for kinds, own in _alike(reader, names[:middle]) + _alike(reader, names[middle:]):
        same = next((found for other, found in groups if other == kinds), None)
        if same is None:
            groups.append((kinds, list(own)))
        else:
            same += own
    return groups


def _is_read_as(own: T.DataType, wide: T.DataType) -> bool:
    """Whether the parquet reader gives values of one type as the other, without loss."""
    if own == wide:
        return True
    if isinstance(own, WHOLE):
        if isinstance(wide, WHOLE):
            return WHOLE.index(type(own)) < WHOLE.index(type(wide))
        if isinstance(wide, T.DecimalType):
            digits = 20 if isinstance(own, T.LongType) else 10
            return wide.precision - wide.scale >= digits
        return isinstance(wide, T.DoubleType) and not isinstance(own, T.LongType)
    if isinstance(own, T.DecimalType) and isinstance(wide, T.DecimalType):
        whole = wide.precision - wide.scale >= own.precision - own.scale
        return whole and wide.scale >= own.scale
    return isinstance(own, T.FloatType) and isinstance(wide, T.DoubleType)


def _read_all(
    reader: DataFrameReader, directories: list[str], infer: bool, format: str
) -> list[DataFrame]:
    """The directories in one read; if types differ in a way that the reader cannot bridge, a read for
    each set of columns and types."""
    names = [PATTERN.sub(r"\\\1", name) for name in directories]
    if not names:
        return []
    if not infer:
        return [reader.load(names)]
    groups = _alike(reader, names)
    if len(groups) == 1:
        return [reader.option("mergeSchema", "true").load(names)]
    parts = [reader.schema(kinds).load(own) for kinds, own in groups]
    wide = _united(parts).schema
    bridged = format == "parquet" and all(
        _is_read_as(field.dataType, wide[field.name].dataType)
        for kinds, _ in groups
        for field in kinds
    )
    if bridged:
        try:
            return [reader.schema(wide).load(names)]
        except (PySparkException, Py4JJavaError) as error:
            if not UNLIKE.search(str(error).upper()):
                raise
    return parts


def _united(parts: list[DataFrame]) -> DataFrame:
    """All rows under all columns; where types differ, Spark's union finds the wider one, and text
    is wider than anything else."""
    texts = {f.name for df in parts for f in df.schema if isinstance(f.dataType, T.StringType)}
    as_text = [
        df.withColumns({
            f.name: column(f.name).cast("string")
            for f in df.schema
            if f.name in texts and not isinstance(f.dataType, T.StringType)
        })
        for df in parts
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), as_text)


def _refuse_own_ids(data: DataFrame) -> None:
    if "extraction_id" in {name.lower() for name in data.columns}:
        raise ValueError("the files have a column extraction_id of their own")


def _with_extraction(
    data: DataFrame, owned: DataFrame, depths: set[int], max_bytes: int
) -> DataFrame:
    """Rows with the extractions of the deepest resolved directory above their file.

    Its path is a prefix of the file's, cut at one of the depths that resolved directories
    have; there is a join for each of these depths, mostly one.
    """
    _refuse_own_ids(data)
    file_path = F.col("_metadata.file_path")
    # Spark spells out the store of a path that names none or part of it. One path tells how.
    example = data.select(file_path.alias("path")).first()
    store = re.match(STORE, example["path"]).group() if example else ""
    place = free_name(data, "file_path")
    matched, found = data.withColumn(place, file_path), []
    for depth in sorted(depths, reverse=True):
        directory, ids = (free_name(data, f"{name}_{depth}") for name in ("directory", "owners"))
        owners = owned.where(_depth(F.col("inner")) == depth).select(
            F.concat(F.lit(store), _escape(F.col("inner"))).alias(directory),
            F.col("owners").alias(ids),
        )
        prefix = F.substring_index(column(place), "/", store.count("/") + depth + 1)
        matched = matched.withColumn(directory, prefix).join(
            broadcast_if_small(owners, max_bytes), directory, "left"
        )
        found.append(column(ids))
    # Every file lies below a directory that was asked for; a row without one must not get lost.
    unowned = F.raise_error(F.concat(F.lit("no extraction owns "), column(place)))
    each = F.explode(F.coalesce(*found, unowned.cast(owned.schema["owners"].dataType)))
    return matched.select(
        *[column(name) for name in data.columns], each.alias("extraction_id")
    )


def _keys(paths: DataFrame, root: str, names: Sequence[str]) -> DataFrame:
    """Each directory once: ``levels``, the values of its keys as texts, and its owners."""
    inner = F.regexp_replace(F.col("directory"), "/+", "/")
    base = re.sub("/+$", "", root)
    below = F.when(F.startswith(inner, F.lit(base + "/")), F.substring(inner, len(base) + 1, 1 << 30))
    parts = F.split(F.trim(F.coalesce(below, inner), F.lit("/")), "/")

    def value(i: int, name: str) -> Column:
        part = F.get(parts, F.lit(i))
        bad = F.raise_error(F.concat(F.lit(f"not a directory of {name}: "), F.col("directory")))
        escaped = F.replace(F.substring_index(part, "=", -1), F.lit("+"), F.lit("%2B"))
        text = F.url_decode(escaped)
        return (
            F.when(part.isNull() & (i > 0), F.lit(None).cast("string"))
            .when(F.coalesce(~F.startswith(part, F.lit(f"{name}=")), F.lit(True)), bad.cast("string"))
            .when(text != NULL_DIRECTORY, text)
        )

    values = {f"key_{i}": value(i, name) for i, name in enumerate(names)}
    deep = F.size(parts) > len(names)
    too_deep = F.raise_error(F.concat(F.lit("deeper than the partitions: "), F.col("directory")))
    return (
        paths.withColumns(values)
        .withColumn("levels", F.when(deep, too_deep.cast("int")).otherwise(F.size(parts)))
        .groupBy("levels", *values)
        .agg(F.collect_set("extraction_id").alias("owners"))
    )


def _by_key(
    data: DataFrame, paths: DataFrame, root: str, names: Sequence[str], max_bytes: int
) -> DataFrame:
    _refuse_own_ids(data)
    keys = snapshot(_keys(paths, root, names), "keys")
    # Keys that all directories name are joined by equality, so they prune partitions.
    told = keys.agg(
        F.min("levels").alias("levels"),
        *[F.count_if(F.col(f"key_{i}").isNull()).alias(f"nulls_{i}") for i in range(len(names))],
    ).first()
    if told["levels"] is None:
        raise LookupError("no directory was resolved, so there is nothing to read")
    # The comparison also tells Spark that the keys are a selection.
    side = broadcast_if_small(keys, max_bytes).where(F.col("levels") >= told["levels"])
    renamed = {c: free_name(data, c) for c in keys.columns}
    side = side.withColumnsRenamed(renamed)
    condition = F.lit(True)
    for i, name in enumerate(names):
        kind = data.schema[name].dataType
        own = column(renamed[f"key_{i}"]).try_cast(kind)
        if not told[f"nulls_{i}"]:
            match = column(name) == own
        else:
            match = column(name).eqNullSafe(own)
        if i >= told["levels"]:
            match = (column(renamed["levels"]) <= i) | match
        condition = condition & match
    each = F.explode(column(renamed["owners"])).alias("extraction_id")
    joined = data.join(side, condition)
    return joined.select(*[column(name) for name in data.columns], each)

