"""Checks that stop a job before it writes into the wrong shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchloom import contract as C


class GateError(ValueError):
    """A job must not start or must not publish."""


def leaf_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted paths of all leaves; elements of arrays of structs count as fields."""
    paths = []
    for f in schema.fields:
        kind = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        path = prefix + f.name
        paths += leaf_paths(kind, path + ".") if isinstance(kind, T.StructType) else [path]
    return paths


def missing_paths(schema: T.StructType, required: list[str]) -> list[str]:
    present = set(leaf_paths(schema))
    return sorted(p for p in required if p not in present)


def require_compatible(schema: T.StructType) -> None:
    """The target must hold every path the jobs write, and the stored-only payload as text."""
    missing = missing_paths(schema, C.REQUIRED_PATHS)
    for path in C.STORED_ONLY_PATHS:
        if path not in schema.fieldNames() or not isinstance(schema[path].dataType, T.StringType):
            missing.append(f"{path} (stored only)")
    if missing:
        raise GateError(f"document table lacks {missing}")


def require_reader_fields(schema: T.StructType) -> None:
    """Every field the reader asks for is written."""
    missing = missing_paths(schema, C.READER_PATHS)
    if missing:
        raise GateError(f"reader fields not written: {missing}")


def require_window(from_unix: int, to_unix: int) -> None:
    if from_unix > to_unix:
        raise GateError(f"window starts at {from_unix} after its end {to_unix}")


def require_lag(lag: int) -> None:
    if lag <= 0:
        raise GateError("lag must be positive: rows still being committed would be skipped")


def require_contract(version: int) -> None:
    if version < C.CONTRACT_VERSION:
        raise GateError(f"contract version {version} carries no access list")


def require_shard_names(names: list[str]) -> None:
    bad = [n for n in names if not n or not all(ch.isascii() and (ch.isalnum() or ch == "_") for ch in n)]
    if bad:
        raise GateError(f"unsafe table names {bad}")


def path_coverage(docs: DataFrame, required: list[str]) -> DataFrame:
    """Per required path whether the table declares it and how many documents fill it."""
    present = set(leaf_paths(docs.schema))
    filled = [
        (F.count_if(F.size(F.array_compact(F.col(p))) > 0) if ".msgs." in p else F.count(F.col(p))).alias(f"c{i}")
        if p in present
        else F.lit(0).cast("bigint").alias(f"c{i}")
        for i, p in enumerate(required)
    ]
    rows = F.array(
        *[
            F.struct(F.lit(p).alias("path"), F.lit(p in present).alias("declared"), F.col(f"c{i}").alias("documents"))
            for i, p in enumerate(required)
        ]
    )
    return docs.agg(*filled).select(F.inline(rows))
