"""Explicit schemas: nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

from .fixed_values import VISIT_COLUMNS

_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()


def _struct(*pairs, required: frozenset[str] = frozenset()) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in pairs])


RAW_VISITS = _struct(
    ("fecha_atencion", T.DateType()),
    ("codigo_clinica", _S),
    ("distrito", _S),
    ("grupo_edad", _S),
    ("diagnostico_cie10", _S),
    ("num_atenciones", _L),
    ("_numero_fila", _L),
    ("_archivo_origen", _S),
    ("_cargado_en", T.TimestampNTZType()),
    required=frozenset((*VISIT_COLUMNS, "_numero_fila", "_archivo_origen")),
)

RAW_AIR = _struct(
    ("fecha", T.DateType()),
    ("estacion_id", _S),
    ("estacion_nombre", _S),
    ("latitud", _D),
    ("longitud", _D),
    ("sensor_id", _S),
    ("parametro", _S),
    ("unidad", _S),
    ("valor_promedio", _D),
    ("cobertura_pct", _D),
    ("n_observaciones", _L),
    ("fuente", _S),
    ("_archivo_origen", _S),
    ("_cargado_en", T.TimestampNTZType()),
    required=frozenset(("fecha", "estacion_id", "sensor_id", "parametro", "fuente", "_archivo_origen")),
)

# one JSON line per measured day and sensor, as landed in the raw layer
AIR_LINES = T.StructType([f for f in RAW_AIR.fields if not f.name.startswith("_")])

STAGED_VISITS = _struct(*((c, _S) for c in VISIT_COLUMNS), ("_numero_fila", _S))

DISTRICTS = _struct(
    ("ubigeo", _S), ("distrito", _S), ("zona", _S), ("latitud", _D), ("longitud", _D),
    required=frozenset(("ubigeo",)),
)
ALIASES = _struct(("alias_normalizado", _S), ("ubigeo", _S), required=frozenset(("alias_normalizado", "ubigeo")))

_API_PARAMETER = _struct(("id", _L), ("name", _S), ("units", _S), ("displayName", _S))
_API_INSTANT = _struct(("utc", _S), ("local", _S))

API_LOCATION = _struct(
    ("id", _L),
    ("name", _S),
    ("isMobile", T.BooleanType()),
    ("coordinates", _struct(("latitude", _D), ("longitude", _D))),
    ("datetimeLast", _API_INSTANT),
    ("sensors", T.ArrayType(_struct(("id", _L), ("name", _S), ("parameter", _API_PARAMETER)))),
)
API_LOCATIONS_PAGE = _struct(("results", T.ArrayType(API_LOCATION)))

API_DAY_ITEM = _struct(
    ("value", _D),
    ("flagInfo", _struct(("hasFlags", T.BooleanType()))),
    ("parameter", _API_PARAMETER),
    (
        "period",
        _struct(("label", _S), ("interval", _S), ("datetimeFrom", _API_INSTANT), ("datetimeTo", _API_INSTANT)),
    ),
    (
        "coverage",
        _struct(
            ("expectedCount", _L),
            ("expectedInterval", _S),
            ("observedCount", _L),
            ("observedInterval", _S),
            ("percentComplete", _D),
            ("percentCoverage", _D),
        ),
    ),
)
API_DAYS_PAGE = _struct(("results", T.ArrayType(API_DAY_ITEM)))
