"""Feature definitions: one declaration for expressions, row functions, batch functions and models."""

from __future__ import annotations

import dis
import hashlib
import re
import types
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from accrete.functions.vectors import check_length

# How a feature is computed, in rising order of cost.
COLUMN = "column"  # Spark expression over the input columns
ROW = "row"  # Python function of one row's values
BATCH = "batch"  # function RecordBatch -> RecordBatch with the column of the feature's name
MODEL = "model"  # class made once per worker process, then called per batch or row
DEFAULT_TIERS = {COLUMN: 1, ROW: 1, BATCH: 2, MODEL: 3}


# Bytes of fixed-length output that one batch may hold.
OUTPUT_BYTES = 256 * 1024 * 1024

_models: dict[str, Any] = {}


def _model(fingerprint: str, code: Callable[[], Any]) -> Any:
    """The model of this worker process, made on first use; of models only the last one is kept."""
    if fingerprint not in _models:
        _models.clear()
        _models[fingerprint] = code()
    return _models[fingerprint]


def _package(code: Any) -> str:
    return (getattr(code, "__module__", None) or "").split(".")[0]


def _told(value: Any, package: str, above: tuple[int, ...]) -> Any:
    """What `value` does, as nested tuples of plain values; see `FeatureDef.fingerprint`."""
    if value is None or value is Ellipsis or isinstance(value, (bool, int, float, complex, str, bytes)):
        return (type(value).__name__, value)
    if id(value) in above:
        return ("again", getattr(value, "__qualname__", ""))
    tell = lambda v: _told(v, package, (*above, id(value)))
    if isinstance(value, (tuple, list)):
        return (type(value).__name__, *map(tell, value))
    if isinstance(value, (set, frozenset)):
        return (type(value).__name__, *sorted(map(tell, value), key=repr))
    if isinstance(value, Mapping):
        return ("mapping", *((tell(k), tell(v)) for k, v in value.items()))
    if isinstance(value, (np.ndarray, np.generic)):
        if value.dtype.hasobject:
            raise TypeError("an array of objects has no fingerprint; give the feature a version")
        return ("array", value.dtype.str, value.shape, hashlib.sha256(np.ascontiguousarray(value).tobytes()).hexdigest())
    if isinstance(value, re.Pattern):
        return ("pattern", value.pattern, value.flags)
    if isinstance(value, types.CodeType):
        return ("code", value.co_code.hex(), value.co_names, value.co_varnames, tuple(map(tell, value.co_consts)))
    if isinstance(value, types.MethodType):
        return ("method", tell(value.__func__), tell(value.__self__))
    if isinstance(value, types.ModuleType):
        return ("module", value.__name__)
    own = _package(value) == package
    if isinstance(value, types.FunctionType) and own:
        names, members = _names(value.__code__)
        used = {n: value.__globals__[n] for n in names if n in value.__globals__}
        # A module of the package stands for those of its members that the code names.
        inside = [
            (f"{n}.{m}", getattr(v, m)) for n, v in used.items()
            if isinstance(v, types.ModuleType) and v.__name__.split(".")[0] == package for m in members if hasattr(v, m)
        ]
        cells = [c.cell_contents for c in value.__closure__ or ()]
        return ("function", tell(value.__code__), tell(value.__defaults__), tell(value.__kwdefaults__), tell(cells),
                *((n, tell(v)) for n, v in [*sorted(used.items()), *inside]))
    if isinstance(value, type) and own:
        parts = {
            k: v for k, v in vars(value).items()
            if not (k.startswith("__") and k.endswith("__")) or isinstance(v, types.FunctionType)
        }
        return ("class", value.__qualname__, *map(tell, value.__bases__), *((k, tell(v)) for k, v in parts.items()))
    if isinstance(value, (staticmethod, classmethod)):
        return (type(value).__name__, tell(value.__func__))
    if isinstance(value, property):
        return ("property", tell(value.fget))
    if isinstance(value, (type, types.FunctionType, types.BuiltinFunctionType)):
        return ("name", value.__module__, value.__qualname__)
    if isinstance(value, FeatureDef):
        return ("feature", value.name, value.data_type, value.inputs, value.version or tell(value.code))
    if type(value).__reduce_ex__ is not object.__reduce_ex__ or not hasattr(value, "__dict__"):
        raise TypeError(f"a {type(value).__name__} has no fingerprint; give the feature a version")
    return ("object", tell(type(value)), tell(vars(value)))


def _names(code: types.CodeType) -> tuple[list[str], list[str]]:
    """Global names, and names of members, that the code and the functions inside it refer to."""
    names, members = set(), set()
    for step in dis.get_instructions(code):
        if step.opname in ("LOAD_GLOBAL", "LOAD_NAME"):
            names.add(step.argval)
        elif step.opname in ("LOAD_ATTR", "LOAD_METHOD"):
            members.add(step.argval)
        elif isinstance(step.argval, types.CodeType):
            inner = _names(step.argval)
            names.update(inner[0])
            members.update(inner[1])
    return sorted(names), sorted(members)


@dataclass(frozen=True)
class FeatureDef:
    """A feature column: what it reads, its type, and the code that fills it.

    `length` fixes the number of values of a list feature; `half` rounds them to half precision,
    and with type `binary` packs them as half-precision bytes (a quarter of `array<double>`). A model
    class is made once per worker process; if it has a method `batch`, that gets record batches of
    the inputs, else the object is called per row.
    """

    name: str
    data_type: str
    inputs: tuple[str, ...]
    code: Callable[..., Any]
    kind: str = ROW
    tier: int = 1
    length: int | None = None
    half: bool = False
    batch_size: int | None = None
    version: str | None = None
    profile: Any = field(default=None, compare=False)

    @property
    def spark_type(self) -> T.DataType:
        return T.DataType.fromDDL(self.data_type)

    def fingerprint(self) -> str:
        """Changes whenever the name, type, inputs, or what the code computes with changes: its
        instructions, constants, defaults and captured values, and functions and classes of its own
        package that it calls. With a `version` that text stands for the code. Values that cannot be
        told apart for certain are refused; give a `version` then."""
        code = ("version", self.version) if self.version is not None else _told(self.code, _package(self.code), ())
        told = (self.name, self.data_type, self.inputs, self.kind, self.length, self.half, code)
        return hashlib.sha256(repr(told).encode()).hexdigest()[:16]

    def apply(self, df: DataFrame, key: str) -> DataFrame:
        """(key, value) for every row of `df`; only the inputs are read."""
        kept = df.select(*dict.fromkeys([key, *self.inputs]))
        if self.kind == COLUMN:
            made = kept.select(key, self.code(*[F.col(c) for c in self.inputs]).cast(self.spark_type).alias(self.name))
        elif self.kind == ROW:
            call = F.udf(self.code, self.spark_type, useArrow=True)
            made = kept.select(key, call(*[F.col(c) for c in self.inputs]).alias(self.name))
        else:
            made = self._in_workers(kept, key)
        if self.length is not None and self.data_type != "binary":
            made = made.select(key, check_length(F.col(self.name), self.length, self.name).alias(self.name))
        return made

    def _in_workers(self, kept: DataFrame, key: str) -> DataFrame:
        name, inputs, kind, code = self.name, list(self.inputs), self.kind, self.code
        arrow_type = to_arrow_type(self.spark_type)
        schema = T.StructType([kept.schema[key], T.StructField(name, self.spark_type)])
        pack = self._packer()
        width = 2 if self.data_type == "binary" else 8
        bounded = max(1, OUTPUT_BYTES // (width * self.length)) if self.length else None
        size, fingerprint = self.batch_size or bounded, self.fingerprint()

        def run(batches):
            model = _model(fingerprint, code) if kind == MODEL else None
            for whole in batches:
                step = size or max(whole.num_rows, 1)
                for at in range(0, whole.num_rows, step):
                    batch = whole.slice(at, step)
                    if kind == BATCH:
                        values = pack(code(batch.select(inputs)).column(name))
                    elif hasattr(model, "batch"):
                        values = pack(model.batch(batch.select(inputs)))
                    else:
                        rows = zip(*[batch.column(c).to_pylist() for c in inputs])
                        values = pack([model(*row) for row in rows])
                    if not isinstance(values, pa.Array):
                        values = pa.array(values, arrow_type)
                    elif values.type != arrow_type:
                        values = values.cast(arrow_type)
                    yield pa.RecordBatch.from_arrays([batch.column(key), values], names=[key, name])

        return kept.mapInArrow(run, schema, profile=self.profile)

    def _packer(self):
        length, half, packed = self.length, self.half, self.data_type == "binary"

        def pack(values):
            if not half:
                return values
            if isinstance(values, pa.Array):
                values = [row.values.to_numpy(zero_copy_only=False) if row.is_valid else None for row in values]
            out = []
            for row in values:
                if row is not None:
                    row = np.asarray(row, np.float32).astype(np.float16)
                    if length is not None and row.size != length:
                        raise ValueError(f"expected {length} values, got {row.size}")
                    row = row.tobytes() if packed else row.astype(np.float32)
                out.append(row)
            return out

        return pack


def feature(data_type: str, inputs: list[str], kind: str = ROW, name: str | None = None, tier: int | None = None, **options):
    """Decorator that turns a function or class into a `FeatureDef`."""

    def wrap(code) -> FeatureDef:
        return FeatureDef(
            name or code.__name__, data_type, tuple(inputs), code, kind, tier or DEFAULT_TIERS[kind], **options
        )

    return wrap


def in_dependency_order(features: list[FeatureDef]) -> list[FeatureDef]:
    """Features so that each comes after the ones it reads."""
    by_name = {f.name: f for f in features}
    done: dict[str, FeatureDef] = {}

    def visit(f: FeatureDef, above: tuple[str, ...]) -> None:
        if f.name in above:
            raise ValueError("features read each other: " + " -> ".join([*above, f.name]))
        for column in f.inputs:
            if column in by_name:
                visit(by_name[column], (*above, f.name))
        done.setdefault(f.name, f)

    for f in features:
        visit(f, ())
    return list(done.values())
