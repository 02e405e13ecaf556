"""Fixed values of the data contract.

Everything in this module is a literal that results depend on: accepted column
spellings, code domains, place catalogues, thresholds and message texts. They
are data, not logic, and are kept together so that a change is one diff.
"""

from __future__ import annotations

# --- fixed values: columns of the daily visits file, in file order -----------
VISIT_COLUMNS = (
    "fecha_atencion",
    "codigo_clinica",
    "distrito",
    "grupo_edad",
    "diagnostico_cie10",
    "num_atenciones",
)

# --- fixed values: normalised header spelling -> canonical column ------------
HEADER_SYNONYMS = {
    "fecha_atencion": "fecha_atencion",
    "fecha": "fecha_atencion",
    "codigo_clinica": "codigo_clinica",
    "cod_clinica": "codigo_clinica",
    "clinica": "codigo_clinica",
    "distrito": "distrito",
    "distrito_paciente": "distrito",
    "grupo_edad": "grupo_edad",
    "grupo_etario": "grupo_edad",
    "diagnostico_cie10": "diagnostico_cie10",
    "cie10": "diagnostico_cie10",
    "diagnostico": "diagnostico_cie10",
    "num_atenciones": "num_atenciones",
    "n_atenciones": "num_atenciones",
    "nro_atenciones": "num_atenciones",
    "atenciones": "num_atenciones",
}

# --- fixed values: field separators, in tie-break order ----------------------
SEPARATORS = (";", ",", "|", "\t")

# --- fixed values: code domains ----------------------------------------------
AGE_GROUPS = ("0-4", "5-17", "18-59", "60+")
YOUNG_GROUP = "0-4"
OLDER_GROUP = "60+"
ASTHMA_CODES = ("J45",)
PNEUMONIA_CODES = ("J12", "J13", "J14", "J15", "J16", "J17", "J18")
POLLUTANT = "pm25"
AIR_SOURCES = ("openaq", "simulada")
ZONES = ("Lima Centro", "Lima Norte", "Lima Este", "Lima Sur")

# --- fixed values: shapes of codes and counts, digits of any script ----------
DIAGNOSIS_SHAPE = r"^J\p{Nd}{2}(\.\p{Nd}{1,2})?$"
COUNT_SHAPE = r"^\p{Nd}+(\.0+)?$"

# --- fixed values: rejection reasons; {} is the value or the column -----------
REASON_BAD_DATE = "fecha invalida '{}'"
REASON_OTHER_DAY = "fecha {} distinta al dia procesado"
REASON_EMPTY = "{} vacio"
REASON_NOT_IN_DOMAIN = "grupo_edad invalido '{}'"
REASON_BAD_DIAGNOSIS = "diagnostico_cie10 no respiratorio o invalido '{}'"
REASON_BAD_COUNT = "num_atenciones invalido '{}'"
REASON_SEPARATOR = "; "
MISSING_VALUE = "None"  # how a field that the record does not reach is shown

# --- fixed values: air categories ---------------------------------------------
NO_COVERAGE = "SIN_COBERTURA"
WITHIN_GUIDE = "DENTRO_GUIA_OMS"
OVER_GUIDE = "SOBRE_GUIA_OMS"
OVER_STANDARD = "SOBRE_ECA_PERU"
AIR_CATEGORIES = (WITHIN_GUIDE, OVER_GUIDE, OVER_STANDARD, NO_COVERAGE)
CATEGORY_LABELS = {
    WITHIN_GUIDE: "Dentro de la guia OMS",
    OVER_GUIDE: "Sobre la guia OMS",
    OVER_STANDARD: "Sobre el ECA Peru",
    NO_COVERAGE: "Sin estacion cercana",
}

# --- fixed values: letters folded by text normalisation ------------------------
ACCENTED = "áéíóúüñÁÉÍÓÚÜÑ"
UNACCENTED = "aeiouunAEIOUUN"

# --- fixed values: lake layers and the days each one is kept -------------------
LAKE_LAYERS = ("raw", "staged", "cuarentena", "reportes")
RETENTION_DAYS = {"cuarentena": 90, "staged": 180, "raw": 730}

# --- fixed values: columns loaded into the raw tables ---------------------------
RAW_VISIT_COLUMNS = (*VISIT_COLUMNS, "_numero_fila", "_archivo_origen")
RAW_AIR_COLUMNS = (
    "fecha",
    "estacion_id",
    "estacion_nombre",
    "latitud",
    "longitud",
    "sensor_id",
    "parametro",
    "unidad",
    "valor_promedio",
    "cobertura_pct",
    "n_observaciones",
    "fuente",
    "_archivo_origen",
)

# --- fixed values: columns of the daily report ----------------------------------
REPORT_COLUMNS = (
    "distrito",
    "zona",
    "total_atenciones",
    "atenciones_menores_5",
    "atenciones_adultos_mayores",
    "pm25_promedio_24h",
    "categoria_aire",
    "variacion_vs_7d_pct",
    "alerta_salud_publica",
)

# --- fixed values: report texts ---------------------------------------------------
REPORT_TITLE = "Reporte diario"
REPORT_TABLE_HEAD = (
    "| Distrito | Zona | Atenciones | <5 años | 60+ | PM2.5 (µg/m³) "
    "| Calidad del aire | Var. vs 7 dias | Alerta |"
)
REPORT_TABLE_RULE = "|---|---|---:|---:|---:|---:|---|---:|---|"
REPORT_PLACES = "- Distritos analizados: **{}**"
REPORT_VISITS = "- Atenciones respiratorias reportadas: **{}**"
REPORT_MEASURED = "- Distritos con medicion de PM2.5: **{}**"
REPORT_WORST = "- Mayor PM2.5 del dia: **{} µg/m³** en {}"
REPORT_ALERTS = "- Distritos en ALERTA de salud publica: **{}**"
REPORT_ALERT_LIST = "  - {}"
REPORT_YES, REPORT_NO, REPORT_NONE = "SI", "no", "-"
REPORT_CRITERIA = (
    "Criterios: guia OMS 2021 PM2.5 24 h = 15 µg/m³; ECA Peru PM2.5 24 h = 50 µg/m³. "
    "Alerta = aire sobre la guia OMS y atenciones al menos 20% sobre el promedio de "
    "los 7 dias previos."
)

# --- fixed values: place catalogue (code, name, zone, latitude, longitude) --------
DISTRICTS = (
    ("150101", "Lima (Cercado)", "Lima Centro", -12.0464, -77.0428),
    ("150103", "Ate", "Lima Este", -12.0262, -76.9180),
    ("150106", "Carabayllo", "Lima Norte", -11.8700, -77.0300),
    ("150110", "Comas", "Lima Norte", -11.9400, -77.0600),
    ("150122", "Miraflores", "Lima Centro", -12.1211, -77.0297),
    ("150125", "Puente Piedra", "Lima Norte", -11.8667, -77.0750),
    ("150130", "San Borja", "Lima Centro", -12.1080, -76.9990),
    ("150132", "San Juan de Lurigancho", "Lima Este", -11.9800, -76.9900),
    ("150135", "San Martin de Porres", "Lima Norte", -12.0100, -77.0800),
    ("150137", "Santa Anita", "Lima Este", -12.0430, -76.9710),
    ("150142", "Villa El Salvador", "Lima Sur", -12.2130, -76.9420),
    ("150143", "Villa Maria del Triunfo", "Lima Sur", -12.1600, -76.9400),
)

# --- fixed values: normalised spelling -> place code --------------------------------
DISTRICT_ALIASES = (
    ("LIMA", "150101"),
    ("CERCADO DE LIMA", "150101"),
    ("LIMA (CERCADO)", "150101"),
    ("ATE", "150103"),
    ("ATE VITARTE", "150103"),
    ("ATE-VITARTE", "150103"),
    ("CARABAYLLO", "150106"),
    ("COMAS", "150110"),
    ("MIRAFLORES", "150122"),
    ("PUENTE PIEDRA", "150125"),
    ("PTE. PIEDRA", "150125"),
    ("SAN BORJA", "150130"),
    ("SAN JUAN DE LURIGANCHO", "150132"),
    ("S.J.L.", "150132"),
    ("SJL", "150132"),
    ("SAN MARTIN DE PORRES", "150135"),
    ("S.M.P.", "150135"),
    ("SMP", "150135"),
    ("SANTA ANITA", "150137"),
    ("STA. ANITA", "150137"),
    ("VILLA EL SALVADOR", "150142"),
    ("V.E.S.", "150142"),
    ("VES", "150142"),
    ("VILLA MARIA DEL TRIUNFO", "150143"),
    ("V.M.T.", "150143"),
    ("VMT", "150143"),
)
