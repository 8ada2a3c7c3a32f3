"""Tables that are published version by version.

A version is written to a folder of its own and becomes the current one when a small file gets its final
name, by one rename that never replaces another file. Readers see the old version
until then and the new one afterwards; of two writers that start from the same version the
second one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from guidepost.sources.tables import write_table

POINTERS = "versions"


@dataclass(frozen=True)
class Version:
    """A published state: its number (from 1), its folder below the root, the run that made it, and
    the types of its tables' columns, by the table's name."""

    number: int
    folder: str
    run: str | None = None
    tables: Mapping[str, str] = field(default_factory=dict)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def published_versions(spark: SparkSession, root: str) -> list[Version]:
    """All versions, the current one last; a line for each publication."""
    folder = f"{root.rstrip('/')}/{POINTERS}"
    path = _path(spark, folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return []
    lines = spark.read.text(folder, pathGlobFilter="[0-9]*").collect()
    return sorted((Version(**json.loads(r["value"])) for r in lines), key=lambda v: v.number)


def read_version(
    spark: SparkSession, root: str, name: str = "table", version: Version | None = None
) -> DataFrame:
    """A table of the given version, or of the current one."""
    if version is None:
        versions = published_versions(spark, root)
        if not versions:
            raise LookupError(f"nothing is published below {root!r}")
        version = versions[-1]
    if name not in version.tables:
        raise LookupError(f"version {version.number} has no table {name!r}")
    path = f"{root.rstrip('/')}/{version.folder}/{name}"
    return spark.read.schema(version.tables[name]).parquet(path)


def publish(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, DataFrame],
    after: int,
    run: str | None = None,
) -> Version:
    """Write ``tables`` as the version after number ``after`` (0: the first) and make it current.

    If another writer has published that version meanwhile, nothing changes and it is an error; the
    folder that was written is deleted.
    """
    root = root.rstrip("/")
    number = after + 1
    folder = f"data-{number:012}-{uuid.uuid4().hex}"
    kinds = {name: df.schema.toDDL() for name, df in tables.items()}
    version = Version(number, folder, run, kinds)
    for name, df in tables.items():
        write_table(df, f"{root}/{folder}/{name}")
    jvm = spark.sparkContext._jvm
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    waiting = _path(spark, f"{root}/{POINTERS}/_{folder}")
    files = waiting.getFileSystem(settings)
    out = files.create(waiting)
    out.write(bytearray(json.dumps(asdict(version)).encode()))
    out.close()
    final = _path(spark, f"{root}/{POINTERS}/{number:012}")
    gateway = spark.sparkContext._gateway
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), settings)
    try:
        context.rename(waiting, final, options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error):
            raise
        files.delete(waiting, False)
        files.delete(_path(spark, f"{root}/{folder}"), True)
        raise RuntimeError(f"another writer has published version {number} of {root!r}") from None
    return version
