from __future__ import annotations

import json
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from guidepost.sources.tables import JdbcSource, ParquetSource, read_table, write_table


@dataclass(frozen=True)
class ControlTable:
    table: str
    schema: str = "dbo"
    source: str = "settings"


# Tables of the control databases. "settings" is the database of the targets,
# "lake" the one that indexes the lake.
CONTROL_TABLES = {
    "targets": ControlTable("GeneracionArchivos", "Configuracion"),
    "extractions": ControlTable("Extracciones", "Configuracion"),
    "partition_index": ControlTable("IndexDatalake", source="lake"),
    "source_columns": ControlTable("ColumnasOrigen", "Configuracion"),
    "destination_columns": ControlTable("ColumnasDestino", "Configuracion"),
    "durations": ControlTable("DuracionISO", "Configuracion"),
    "granularities": ControlTable("Granularidad", "Configuracion"),
    "standard_values": ControlTable("EstandarizacionRegistros", "Configuracion"),
    "token_sources": ControlTable("ConfiguracionColumnasOrigen", source="lake"),
    "token_destinations": ControlTable("ConfiguracionColumnasDestino", source="lake"),
    "token_extractions": ControlTable("ConfiguracionExtracciones", source="lake"),
    "periods": ControlTable("Periodicidad", "Configuracion"),
    "executions": ControlTable("Ejecucion", "Configuracion"),
    "calendar": ControlTable("Tiempo", source="lake"),
    "published_files": ControlTable("Archivo", "Dato"),
    "publications": ControlTable("PublicacionRegulatoria", "Configuracion"),
    "classifications": ControlTable("ClasificacionRegulatoria", "Configuracion"),
}

# Column names of the control databases and the names the operators use.
SOURCE_NAMES = {
    "IdConfiguracionGeneracionArchivos": "target_id",
    "Tema": "theme",
    "NombreArchivoDestino": "target_name",
    "SelectXM": "select_template",
    "ValorDeltaInicial": "delta_value_start",
    "ValorDeltaFinal": "delta_value_end",
    "IdPeriodicidad": "period_id",
    "IntervaloPeriodicidad": "period_interval",
    "IdColumnaDestino": "dest_column_id",
    "IdColumnaVersion": "version_column_id",
    "DatoObligatorio": "mandatory_data",
    "IdDuracionISO": "duration_id",
    "IndRegulatorio": "regulatory_flag",
    "IdConfiguracionClasificacionRegulatoria": "classification_id",
    "IdExtraccion": "extraction_id",
    "Proyecto": "project",
    "NombreExtraccion": "extraction_name",
    "FechaDeltaInicial": "delta_start",
    "FechaDeltaFinal": "delta_end",
    "Directorio": "directory",
    "Ano": "year",
    "Mes": "month",
    "Dia": "day",
    "Hora": "hour",
    "DeltaLake": "delta_flag",
    "NombreColumnaOrigen": "source_name",
    "NombreColumnaDestino": "dest_name",
    "TipoDato": "data_type",
    "CodigoISO8601": "iso_code",
    "Periodicidad": "period",
    "ValorObjetivo": "target_value",
    "NumeracionColumna": "column_number",
    "IdGeneracionArchivo": "target_id",
    "DiaSemana": "weekday",
    "IndDiaHabil": "business_day_flag",
    "NombreColumnaVersion": "version_name",
    "TokenColumna": "token",
    "CriterioCalidad": "criterion",
    "FormulaCalificacion": "formula",
    "DescSolucion": "fix_text",
    "FechaVigInicial": "valid_from",
    "FechaVigFinal": "valid_to",
    "Columnas": "columns",
    "CodError": "error_code",
    "DescError": "error_text",
    "GranularidadCalidad": "granularity",
    "NumeroReglaActualidad": "rule_number",
}


def load_catalog(
    spark: SparkSession,
    sources: Mapping[str, ParquetSource | JdbcSource],
    tables: Mapping[str, ControlTable] = CONTROL_TABLES,
    names: Mapping[str, str] = SOURCE_NAMES,
) -> dict[str, DataFrame]:
    """The control tables by role, under the operators' column names.

    Nothing but table metadata is read. Columns that ``names`` does not list keep theirs.
    """
    return {
        role: read_table(spark, sources, entry.table, entry.schema, entry.source)
        .withColumnsRenamed(dict(names))
        for role, entry in tables.items()
    }


MANIFEST = "manifest"
STORED_AT_ONCE = 8


def store_catalog(tables: Mapping[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """The tables as they are now, stored below ``path``: one state for all lookups.

    They are written several at a time, so the state of a database is that of a short while; the manifest
    with each table's columns is written last, so a state without one is not complete.
    """
    if not tables:
        raise ValueError("there are no tables to store")
    spark = next(iter(tables.values())).sparkSession

    def store(role: str) -> tuple[str, str]:
        write_table(tables[role], f"{path}/{role}")
        return role, tables[role].schema.json()

    with ThreadPoolExecutor(STORED_AT_ONCE) as pool:
        stored = list(pool.map(store, sorted(tables)))
    # A row for each control table.
    manifest = spark.createDataFrame(stored, "role string, columns string").coalesce(1)
    write_table(manifest, f"{path}/{MANIFEST}")
    return open_catalog(spark, path)


def open_catalog(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables that ``store_catalog`` stored below ``path``."""
    manifest = spark.read.schema("role string, columns string").parquet(f"{path}/{MANIFEST}")
    return {
        row["role"]: spark.read.schema(T.StructType.fromJson(json.loads(row["columns"]))).parquet(
            f"{path}/{row['role']}"
        )
        for row in manifest.collect()
    }


def to_source_names(df: DataFrame) -> DataFrame:
    """A result under the column names of the control databases."""
    originals: dict[str, str] = {}
    for original, name in SOURCE_NAMES.items():
        originals.setdefault(name, original)
    return df.withColumnsRenamed(originals)
