"""The declared checks of every table (41, counting the reconciliation)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import AGE_GROUPS, AIR_CATEGORIES, AIR_SOURCES, ZONES
from ..operators.quality import (
    WARN,
    RowRule,
    SameTotals,
    SetRule,
    TableChecks,
    Total,
    domain_rule,
    is_null,
    negative,
    not_accepted,
    orphans,
    out_of_range,
    parent_rule,
    repeated_values,
    unique_rule,
)
from ..operators.reconcile import reconcile_totals
from ..params import DEFAULTS, Parameters
from .models import VISIT_KEY, Models

AMBIENT_RANGE = (0, 1000)  # fixed values: physically possible PM2.5, µg/m³


def _filled(*columns: str) -> tuple[RowRule, ...]:
    return tuple(RowRule(f"no_nulo_{c}", is_null(c)) for c in columns)


def _not_negative(column: str) -> RowRule:
    return RowRule(f"no_negativo_{column}", negative(column), (column,))


def _in_range(column: str, low: float, high: float) -> RowRule:
    return RowRule(f"rango_{column}", out_of_range(column, low, high), (column,))


def declared_checks(models: Models, params: Parameters = DEFAULTS) -> list[TableChecks]:
    m = models
    mapped = m.visits.join(m.aliases, F.col("distrito_reportado") == F.col("alias_normalizado"))
    return [
        TableChecks(
            "distritos",
            m.districts,
            _filled("ubigeo"),
            (
                SetRule("unico_ubigeo", repeated_values(m.districts, "ubigeo")),
                SetRule("dominio_zona", not_accepted(m.districts, "zona", ZONES)),
            ),
        ),
        TableChecks(
            "alias_distritos",
            m.aliases,
            _filled("alias_normalizado", "ubigeo"),
            (
                SetRule("unico_alias_normalizado", repeated_values(m.aliases, "alias_normalizado")),
                SetRule("relacion_ubigeo", orphans(m.aliases, "ubigeo", m.districts, "ubigeo")),
            ),
        ),
        TableChecks(
            "stg_atenciones",
            m.visits,
            (*_filled("fecha_atencion", "distrito_reportado", "num_atenciones"), _not_negative("num_atenciones")),
            (
                unique_rule("combinacion_unica", m.visits, VISIT_KEY),
                parent_rule(
                    "distritos_sin_mapear", m.visits, "distrito_reportado", m.aliases, "alias_normalizado", WARN
                ),
                domain_rule("dominio_grupo_edad", m.visits, "grupo_edad", AGE_GROUPS),
            ),
            day="fecha_atencion",
        ),
        TableChecks(
            "stg_mediciones_aire",
            m.air,
            (*_filled("fecha", "estacion_id", "pm25_promedio_24h"), _in_range("pm25_promedio_24h", *AMBIENT_RANGE)),
            (
                unique_rule("combinacion_unica", m.air, ["fecha", "estacion_id"]),
                domain_rule("dominio_fuente", m.air, "fuente", AIR_SOURCES),
            ),
            day="fecha",
        ),
        TableChecks(
            "int_atenciones_distrito_dia",
            m.district_visits,
            (*_filled("ubigeo", "total_atenciones"), _not_negative("total_atenciones")),
            (
                unique_rule("combinacion_unica", m.district_visits, ["fecha", "ubigeo"]),
                parent_rule("relacion_ubigeo", m.district_visits, "ubigeo", m.districts, "ubigeo"),
            ),
            day="fecha",
        ),
        TableChecks(
            "int_pm25_distrito_dia",
            m.district_air,
            (_in_range("distancia_estacion_km", 0, params.station_radius_km), *_filled("pm25_promedio_24h")),
            (unique_rule("combinacion_unica", m.district_air, ["fecha", "ubigeo"]),),
            day="fecha",
        ),
        TableChecks(
            "dim_distrito",
            m.districts,
            _filled("ubigeo"),
            (SetRule("unico_ubigeo", repeated_values(m.districts, "ubigeo")),),
        ),
        TableChecks(
            "fct_distrito_dia",
            m.fact,
            (
                *_filled("fecha", "ubigeo", "total_atenciones", "categoria_aire", "alerta_salud_publica"),
                _not_negative("total_atenciones"),
                _in_range("pm25_promedio_24h", *AMBIENT_RANGE),
            ),
            (
                unique_rule("combinacion_unica", m.fact, ["fecha", "ubigeo"]),
                parent_rule("relacion_ubigeo", m.fact, "ubigeo", m.districts, "ubigeo"),
                domain_rule("dominio_categoria_aire", m.fact, "categoria_aire", AIR_CATEGORIES),
            ),
            day="fecha",
        ),
        TableChecks(
            "conciliacion",
            m.fact,
            (),
            (
                SetRule(
                    "conciliacion_atenciones",
                    reconcile_totals(
                        mapped, "fecha_atencion", "num_atenciones", m.fact, "fecha", "total_atenciones"
                    ),
                    by_day=SameTotals(
                        Total(
                            "stg_atenciones", m.visits, "fecha_atencion", "num_atenciones", "distrito_reportado",
                            m.aliases.select("alias_normalizado"),
                        ),
                        Total("fct_distrito_dia", m.fact, "fecha", "total_atenciones"),
                    ),
                ),
            ),
            day="fecha",
        ),
    ]
