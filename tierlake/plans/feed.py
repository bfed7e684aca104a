"""The driver tables as raw, dirty clinic extracts.

Customers become patients, orders appointments, events clinical events, and order lines billing
lines, every table in full and every column as text. The statements use only syntax that Spark
and DuckDB share, so queries and their oracles start from the same rows; everything after this
point is expressed independently on each side. Patients and appointments come in two versions
each, as first registered and as last updated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierlake.operators.entity import EntitySpec

DRIVER_TABLES = ("nation", "customer", "part", "orders", "lineitem", "events")

_PATIENTS = """
SELECT
  CASE WHEN c_custkey % 223 = 11 THEN 'nan' WHEN c_custkey % 227 = 13 THEN '  '
       ELSE ' ' || CAST(c_custkey AS STRING) END AS id_paciente,
  CASE c_nationkey % 4 WHEN 0 THEN 'CC' WHEN 1 THEN 'TI' WHEN 2 THEN 'CE' ELSE 'PAS' END AS tipo_documento,
  CASE WHEN c_custkey % 29 = 3 THEN CAST(1000000 + c_custkey AS STRING) || '.0'
       WHEN c_custkey % 31 = 5 THEN CAST(1 + c_custkey AS STRING) || 'E3'
       WHEN c_custkey % 37 = 9 THEN '00' || CAST(c_custkey AS STRING)
       ELSE CAST(1000000 + c_custkey * 7 AS STRING) END AS numero_documento,
  ' ' || c_name || ' ' AS nombres,
  c_mktsegment || '-' || CAST(c_nationkey AS STRING) AS apellidos,
  CASE WHEN c_custkey % 97 = 4 THEN '00:00:00' WHEN c_custkey % 101 = 6 THEN 'abc' WHEN c_custkey % 103 = 8 THEN 'NaT'
       ELSE CAST(DATE '1940-01-01' + CAST((c_custkey * 37) % 20000 AS INT) AS STRING) || ' 00:00:00' END AS fecha_nacimiento,
  CASE WHEN c_custkey % 107 = 2 THEN 'X' WHEN c_custkey % 109 = 3 THEN NULL
       WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sexo,
  c_mktsegment AS aseguradora,
  CASE WHEN c_custkey % 53 = 1 THEN 'None' WHEN c_custkey % 59 = 2 THEN '' ELSE n_name END AS ciudad,
  CASE WHEN version = 1 AND c_acctbal < 2500 THEN 'Inactivo' ELSE 'Activo' END AS estado,
  CAST(DATE '1995-01-01' + CAST(c_custkey % 365 AS INT) AS STRING) || ' 00:00:00' AS creado_en,
  CASE WHEN c_custkey % 113 = 5 THEN 'nan'
       ELSE CAST(DATE '1995-01-01' + CAST(c_custkey % 365 + version * (c_custkey % 20) AS INT) AS STRING) || ' 00:00:00'
       END AS actualizado_en
FROM (SELECT c.*, 0 AS version FROM {customer} c UNION ALL SELECT c.*, 1 AS version FROM {customer} c) v
JOIN {nation} n ON c_nationkey = n_nationkey
"""

_APPOINTMENTS = """
SELECT
  CASE WHEN o_orderkey % 499 = 17 THEN 'NULL' ELSE CAST(o_orderkey AS STRING) END AS id_cita,
  CASE WHEN o_orderkey % 101 = 5 THEN CAST(o_custkey + 9000000 AS STRING) WHEN o_orderkey % 103 = 7 THEN NULL
       ELSE CAST(o_custkey AS STRING) || ' ' END AS id_paciente,
  CASE WHEN o_orderkey % 61 = 3 THEN 'None' ELSE 'PR' || CAST(o_orderkey % 40 AS STRING) END AS id_profesional,
  CASE WHEN o_orderkey % 131 = 8 THEN 'nan' ELSE o_orderpriority END AS especialidad,
  CASE WHEN o_orderkey % 41 = 4 THEN '' ELSE 'SEDE ' || CAST(o_custkey % 9 AS STRING) END AS sede,
  CASE WHEN o_orderkey % 89 = 1 THEN 'abc' WHEN o_orderkey % 83 = 2 THEN '10:30:00' WHEN o_orderkey % 79 = 3 THEN '2026'
       ELSE CAST(o_orderdate AS STRING) END AS fecha_hora_cita,
  CASE o_orderkey % 5 WHEN 0 THEN 'Consulta' WHEN 1 THEN 'Valoración' WHEN 2 THEN 'Control'
       WHEN 3 THEN 'Procedimiento' ELSE 'Urgencia' END AS tipo_cita,
  CASE WHEN version = 0 THEN 'Programada' WHEN o_orderkey % 149 = 6 THEN 'Reprogramada'
       WHEN o_orderstatus = 'F' THEN 'Atendida' WHEN o_orderstatus = 'O' THEN 'Programada'
       WHEN o_orderkey % 2 = 0 THEN 'Cancelada' ELSE 'No asistió' END AS estado_cita,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'MOT' || CAST(o_orderkey % 5 AS STRING) END AS motivo_cancelacion,
  CAST(o_orderdate AS STRING) AS creado_en,
  CASE WHEN o_orderkey % 157 = 9 THEN 'nan'
       ELSE CAST(CAST(o_orderdate AS DATE) + CAST(version * (o_orderkey % 30) AS INT) AS STRING) || ' 00:00:00'
       END AS actualizado_en
FROM (SELECT o.*, 0 AS version FROM {orders} o UNION ALL SELECT o.*, 1 AS version FROM {orders} o) v
"""

_EVENTS = """
SELECT
  CASE WHEN event_id % 503 = 19 THEN 'null' ELSE CAST(event_id AS STRING) END AS id_evento,
  CASE WHEN event_id % 71 = 4 THEN NULL
       ELSE CAST(CASE WHEN event_id % 2 = 0 THEN first_order ELSE last_order END
                 + CASE WHEN event_id % 67 = 1 THEN 9000000 ELSE 0 END AS STRING) END AS id_cita,
  CASE WHEN event_id % 73 = 2 THEN CAST(user_id + 9000000 AS STRING) WHEN event_id % 79 = 3 THEN CAST(user_id + 1 AS STRING)
       ELSE CAST(user_id AS STRING) END AS id_paciente,
  CASE event_type WHEN 'view' THEN 'Signos vitales' WHEN 'click' THEN 'Diagnóstico' WHEN 'purchase' THEN 'Procedimiento'
       WHEN 'error' THEN 'Resultado laboratorio' ELSE 'Medicamento' END AS tipo_evento,
  'C' || CAST(event_id % 100 AS STRING) AS codigo_evento,
  props AS descripcion_evento,
  CASE WHEN event_id % 89 = 7 THEN 'sin hora' ELSE CAST(ts AS STRING) END AS fecha_hora_evento,
  CASE WHEN event_id % 97 = 5 THEN 'abc' WHEN event_id % 2 = 0 THEN 'nan'
       ELSE CAST(CAST(value AS DECIMAL(18,4)) AS STRING) END AS valor_resultado,
  CASE WHEN event_id % 2 = 0 THEN 'None' ELSE 'mg' END AS unidad_resultado,
  CASE WHEN event_id % 10 = 0 THEN 'Pendiente' WHEN event_id % 10 = 1 THEN 'Cancelado' ELSE 'Finalizado' END AS estado_evento,
  CAST(CAST(ts AS DATE) AS STRING) || ' 00:00:00' AS creado_en,
  CASE WHEN event_id % 151 = 3 THEN CAST(CAST(ts AS DATE) - 1 AS STRING) || ' 00:00:00'
       ELSE CAST(CAST(ts AS DATE) + CAST(event_id % 3 AS INT) AS STRING) || ' 00:00:00' END AS actualizado_en
FROM {events} e
JOIN (SELECT o_custkey, MIN(o_orderkey) AS first_order, MAX(o_orderkey) AS last_order FROM {orders} GROUP BY o_custkey) f
  ON user_id = o_custkey
"""

_BILLING = """
SELECT
  CASE WHEN k % 509 = 23 THEN 'NaT' ELSE CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END AS id_factura,
  CASE WHEN k % 107 = 3 THEN CAST(o_custkey + 9000000 AS STRING) ELSE CAST(o_custkey AS STRING) END AS id_paciente,
  CASE WHEN k % 109 = 4 THEN CAST(l_orderkey + 9000000 AS STRING) WHEN k % 113 = 5 THEN NULL
       ELSE CAST(l_orderkey AS STRING) END AS id_cita,
  p_type AS tipo_servicio,
  CASE WHEN k % 127 = 6 THEN 'nan' ELSE 'EPS ' || CAST(l_suppkey % 6 AS STRING) END AS pagador,
  CASE WHEN k % 137 = 7 THEN '2026' ELSE CAST(l_shipdate AS STRING) END AS fecha_factura,
  CASE WHEN k % 89 = 2 THEN '-' ELSE '' END || CAST(gross AS STRING) AS valor_bruto,
  CASE WHEN k % 97 = 3 THEN 'N/A' ELSE CAST(discount AS STRING) END AS valor_descuento,
  CAST(CASE WHEN k % 83 = 1 THEN gross - discount + CAST(0.01 AS DECIMAL(18,2)) ELSE gross - discount END AS STRING) AS valor_neto,
  CASE WHEN l_returnflag = 'A' THEN 'Pagado' WHEN l_returnflag = 'N' THEN 'Pendiente'
       WHEN l_partkey % 2 = 0 THEN 'Pago parcial' ELSE 'Cancelado' END AS estado_pago,
  CAST(l_shipdate AS STRING) AS creado_en,
  CAST(CAST(l_shipdate AS DATE) + CAST(l_partkey % 30 AS INT) AS STRING) || ' 00:00:00' AS actualizado_en
FROM (
  SELECT l.*, l_orderkey * 7 + l_linenumber AS k,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS gross,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS discount
  FROM {lineitem} l) v
JOIN {orders} o ON l_orderkey = o_orderkey
JOIN {part} p ON l_partkey = p_partkey
"""

STATEMENTS = {
    "pacientes": _PATIENTS,
    "citas": _APPOINTMENTS,
    "eventos_clinicos": _EVENTS,
    "facturacion": _BILLING,
}


#: Tables of files between these sizes have fewer row groups than a cluster has cores, and one task reads a
#: row group. Rows of smaller tables take no time; larger ones are dealt by their row groups.
DEALT_FROM_BYTES, DEALT_TO_BYTES = 4 << 20, 128 << 20


def _table(spark: SparkSession, tables_dir: str, name: str) -> DataFrame:
    """A driver table. Rows of a few row groups are dealt by key, so that all cores derive text from them."""
    rows = spark.read.parquet(f"{tables_dir}/{name}.parquet")
    size = rows._jdf.queryExecution().analyzed().stats().sizeInBytes()
    if DEALT_FROM_BYTES <= size < DEALT_TO_BYTES:
        return rows.repartition(spark.sparkContext.defaultParallelism, rows.columns[0])
    return rows


def raw_entity(spark: SparkSession, tables_dir: str, spec: EntitySpec | str) -> DataFrame:
    """Raw text rows of one entity, derived from the driver tables in a folder."""
    name = spec if isinstance(spec, str) else spec.name
    statement = STATEMENTS[name]
    used = {t: _table(spark, tables_dir, t) for t in DRIVER_TABLES if f"{{{t}}}" in statement}
    return spark.sql(statement, **used)


def raw_entity_sql(name: str) -> str:
    """The same rows for a database where the driver tables are views of their own names."""
    return STATEMENTS[name].format(**{t: t for t in DRIVER_TABLES})
