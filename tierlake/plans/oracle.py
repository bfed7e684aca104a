"""Each registered query as SQL for DuckDB, written independently of the Spark plans."""

from __future__ import annotations

import re

from tierlake.plans.feed import STATEMENTS, raw_entity_sql

_TOKENS = "('', 'nan', 'None', 'NaT', 'null', 'NULL')"
_RUN_AT = "TIMESTAMP '2002-01-01 00:00:00'"
_BATCH = "20020101_000000_cafe0001"
_MARK = "TIMESTAMP '1998-06-30 00:00:00'"

_COLUMNS = {
    "pacientes": "id_paciente tipo_documento numero_documento nombres apellidos fecha_nacimiento sexo aseguradora ciudad estado creado_en actualizado_en",
    "citas": "id_cita id_paciente id_profesional especialidad sede fecha_hora_cita tipo_cita estado_cita motivo_cancelacion creado_en actualizado_en",
    "eventos_clinicos": "id_evento id_cita id_paciente tipo_evento codigo_evento descripcion_evento fecha_hora_evento valor_resultado unidad_resultado estado_evento creado_en actualizado_en",
    "facturacion": "id_factura id_paciente id_cita tipo_servicio pagador fecha_factura valor_bruto valor_descuento valor_neto estado_pago creado_en actualizado_en",
}
_PK = {"pacientes": "id_paciente", "citas": "id_cita", "eventos_clinicos": "id_evento", "facturacion": "id_factura"}


def _missing(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) IN {_TOKENS})"


def _text(c: str) -> str:
    return f"(CASE WHEN {_missing(c)} THEN NULL ELSE trim({c}) END)"


def _known(c: str) -> str:
    return f"coalesce({_text(c)}, 'DESCONOCIDO')"


def _stamp(c: str) -> str:
    t = _text(c)
    return f"(CASE WHEN regexp_matches({t}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_cast({t} AS TIMESTAMP) END)"


def _amount(c: str, scale: int = 2) -> str:
    return f"try_cast({c} AS DECIMAL(18,{scale}))"


def _document(c: str) -> str:
    t = _text(c)
    return (
        f"(CASE WHEN (regexp_full_match({t}, '[0-9]+[.]0+') OR regexp_full_match({t}, '[0-9]+([.][0-9]+)?[eE][+]?[0-9]+'))"
        f" AND try_cast({t} AS DECIMAL(38,12)) = try_cast(try_cast({t} AS DECIMAL(38,0)) AS DECIMAL(38,12))"
        f" THEN CAST(try_cast({t} AS DECIMAL(38,0)) AS VARCHAR) ELSE {t} END)"
    )


def _age(c: str) -> str:
    return f"CAST(floor(date_diff('day', {c}, DATE '2002-01-01') / 365.25) AS INTEGER)"


def _key(c: str) -> str:
    return f"CAST(strftime({c}, '%Y%m%d') AS INTEGER)"


def _date(c: str, name: str | None = None) -> str:
    return f"CAST({c} AS VARCHAR) AS {name or c}"


def _time(c: str, name: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {name or c}"


def _real(c: str, name: str | None = None) -> str:
    return f"CAST({c} AS DOUBLE) AS {name or c}"


def _padded(pad: int) -> str:
    """The key of the keyed pseudonyms, filled up to a hash block and xor-ed with a pad, as a blob."""
    block = b"key of the comparison".ljust(64, b"\0")
    return "'" + "".join(f"\\x{b ^ pad:02X}" for b in block) + "'::BLOB"


def _int(c: str, name: str) -> str:
    return f"CAST({c} AS BIGINT) AS {name}"


def _round(a: str, b: str, digits: int) -> str:
    """a / b rounded half away from zero in exact integer arithmetic; NULL when b is zero."""
    scale = 10**digits
    a, b = f"CAST({a} AS HUGEINT)", f"CAST({b} AS HUGEINT)"
    half_up = f"(2 * abs({a}) * {scale} + {b}) // (2 * {b})"
    return f"(CASE WHEN {b} <> 0 THEN sign({a}) * CAST({half_up} AS DOUBLE) / {scale} END)"


def _cents(c: str) -> str:
    return f"CAST({c} * 100 AS HUGEINT)"


def _round_money(a: str, b: str) -> str:
    """Cents over rows, as money rounded to cents."""
    cents = _cents(a)
    half_up = f"(2 * abs({cents}) + CAST({b} AS HUGEINT)) // (2 * CAST({b} AS HUGEINT))"
    return f"(CASE WHEN {b} <> 0 THEN sign({cents}) * CAST({half_up} AS DOUBLE) / 100 END)"


def _bronze(name: str) -> str:
    columns = _COLUMNS[name].split()
    content = ", ".join(f"coalesce({c}, '')" for c in columns)
    return (
        f"SELECT *, sha256(concat_ws('|', {content})) AS _row_hash, {_stamp('actualizado_en')} AS _cursor"
        f" FROM raw_{name}"
    )


def _latest(name: str) -> str:
    pk = _PK[name]
    return (
        f"SELECT * FROM clean_{name} QUALIFY row_number() OVER"
        f" (PARTITION BY {pk} ORDER BY actualizado_en DESC NULLS LAST, _row_hash) = 1"
    )


# Named steps; a query pulls in the ones it mentions.
_STEPS: dict[str, str] = {f"raw_{n}": raw_entity_sql(n) for n in STATEMENTS}
_STEPS |= {f"loaded_{n}": _bronze(n) for n in STATEMENTS}
_STEPS |= {f"bronze_{n}": f"SELECT * FROM loaded_{n} WHERE NOT {_missing(_PK[n])}" for n in STATEMENTS}
_STEPS |= {f"latest_{n}": _latest(n) for n in STATEMENTS}
_AUDIT = f"{_stamp('creado_en')} AS creado_en, {_stamp('actualizado_en')} AS actualizado_en, _row_hash"
_STEPS["clean_pacientes"] = f"""
SELECT *, {_age('fecha_nacimiento')} AS edad_anios, had_date AND fecha_nacimiento IS NULL AS bad_date FROM (
  SELECT {_text('id_paciente')} AS id_paciente, {_text('tipo_documento')} AS tipo_documento,
    {_document('numero_documento')} AS numero_documento, {_text('nombres')} AS nombres, {_text('apellidos')} AS apellidos,
    CAST({_stamp('fecha_nacimiento')} AS DATE) AS fecha_nacimiento, NOT {_missing('fecha_nacimiento')} AS had_date,
    {_text('sexo')} AS sexo, {_text('aseguradora')} AS aseguradora, {_known('ciudad')} AS ciudad, {_text('estado')} AS estado,
    {_AUDIT}
  FROM bronze_pacientes)"""
_STEPS["clean_citas"] = f"""
SELECT * REPLACE (CASE WHEN es_cita_cancelada THEN motivo_cancelacion END AS motivo_cancelacion),
  es_cita_cancelada AND motivo_cancelacion IS NULL AS motivo_cancelacion_faltante FROM (
  SELECT *, estado_cita = 'Cancelada' AS es_cita_cancelada, estado_cita = 'No asistió' AS es_no_asistencia,
    estado_cita = 'Atendida' AS es_cita_atendida, id_profesional IS NULL AS sin_profesional_asignado,
    CAST(fecha_hora_cita AS DATE) AS fecha_cita FROM (
    SELECT {_text('id_cita')} AS id_cita, {_text('id_paciente')} AS id_paciente, {_text('id_profesional')} AS id_profesional,
      {_text('especialidad')} AS especialidad, {_known('sede')} AS sede, {_stamp('fecha_hora_cita')} AS fecha_hora_cita,
      {_text('tipo_cita')} AS tipo_cita, {_text('estado_cita')} AS estado_cita,
      {_text('motivo_cancelacion')} AS motivo_cancelacion, {_AUDIT}
    FROM bronze_citas))"""
_STEPS["clean_eventos_clinicos"] = f"""
SELECT *, valor_resultado IS NOT NULL AS tiene_resultado FROM (
  SELECT {_text('id_evento')} AS id_evento, {_text('id_cita')} AS id_cita, {_text('id_paciente')} AS id_paciente,
    {_text('tipo_evento')} AS tipo_evento, {_text('codigo_evento')} AS codigo_evento,
    {_text('descripcion_evento')} AS descripcion_evento, {_stamp('fecha_hora_evento')} AS fecha_hora_evento,
    {_amount(_text('valor_resultado'), 4)} AS valor_resultado, {_text('unidad_resultado')} AS unidad_resultado,
    {_text('estado_evento')} AS estado_evento, {_AUDIT}
  FROM bronze_eventos_clinicos)"""
_STEPS["clean_facturacion"] = f"""
SELECT *, CAST(fecha_factura AS DATE) AS fecha_factura_date, estado_pago = 'Cancelado' AS es_factura_anulada,
  CASE WHEN estado_pago IN ('Pendiente', 'Pago parcial') THEN valor_neto ELSE 0 END AS monto_cartera,
  round(valor_bruto - valor_descuento, 2) = round(valor_neto, 2) AS ecuacion_financiera_ok,
  valor_bruto >= 0 AND valor_descuento >= 0 AND valor_neto >= 0 AS montos_no_negativos FROM (
  SELECT {_text('id_factura')} AS id_factura, {_text('id_paciente')} AS id_paciente, {_text('id_cita')} AS id_cita,
    {_text('tipo_servicio')} AS tipo_servicio, {_known('pagador')} AS pagador, {_stamp('fecha_factura')} AS fecha_factura,
    {_amount('valor_bruto')} AS valor_bruto, {_amount('valor_descuento')} AS valor_descuento, {_amount('valor_neto')} AS valor_neto,
    {_text('estado_pago')} AS estado_pago, {_AUDIT}
  FROM bronze_facturacion)"""
_STEPS["tagged_pacientes"] = """
SELECT *, CASE WHEN id_paciente IS NULL THEN 'PK id_paciente nula' WHEN bad_date THEN 'fecha_nacimiento no parseable'
  WHEN sexo NOT IN ('F', 'M') THEN 'sexo fuera de dominio F/M' END AS _reject_reason FROM latest_pacientes"""
_STEPS["tagged_citas"] = """
SELECT l.*, CASE WHEN p.id_paciente IS NULL THEN 'FK id_paciente inexistente'
  WHEN l.id_cita IS NULL OR l.fecha_hora_cita IS NULL THEN 'PK o fecha_hora_cita inválida' END AS _reject_reason
FROM latest_citas l LEFT JOIN silver_pacientes p ON l.id_paciente = p.id_paciente"""
_STEPS["tagged_eventos_clinicos"] = """
SELECT l.*, l.id_paciente = c.id_paciente AS paciente_coherente_con_cita,
  CASE WHEN c.id_cita IS NULL THEN 'FK id_cita inexistente' WHEN p.id_paciente IS NULL THEN 'FK id_paciente inexistente'
    WHEN l.id_paciente <> c.id_paciente THEN 'id_paciente no coincide con cita'
    WHEN l.id_evento IS NULL OR l.fecha_hora_evento IS NULL THEN 'PK o fecha_hora_evento inválida' END AS _reject_reason
FROM latest_eventos_clinicos l LEFT JOIN silver_citas c ON l.id_cita = c.id_cita
LEFT JOIN silver_pacientes p ON l.id_paciente = p.id_paciente"""
_STEPS["tagged_facturacion"] = """
SELECT l.*, CASE WHEN p.id_paciente IS NULL THEN 'FK id_paciente inexistente' WHEN c.id_cita IS NULL THEN 'FK id_cita inexistente'
    WHEN coalesce(NOT ecuacion_financiera_ok, TRUE) OR coalesce(NOT montos_no_negativos, TRUE) THEN 'Regla financiera o montos negativos'
    WHEN l.id_factura IS NULL OR l.fecha_factura IS NULL THEN 'PK o fecha_factura inválida' END AS _reject_reason
FROM latest_facturacion l LEFT JOIN silver_pacientes p ON l.id_paciente = p.id_paciente
LEFT JOIN silver_citas c ON l.id_cita = c.id_cita"""
_STEPS |= {f"silver_{n}": f"SELECT * FROM tagged_{n} WHERE _reject_reason IS NULL" for n in STATEMENTS}
_STEPS["calendar"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS sk_fecha, CAST(d AS DATE) AS fecha, CAST(year(d) AS INTEGER) AS anio,
  CAST(month(d) AS INTEGER) AS mes
FROM (SELECT unnest(generate_series(make_timestamp(y, 1, 1, 0, 0, 0), make_timestamp(y, 12, 31, 0, 0, 0), INTERVAL 1 DAY)) AS d FROM (
  SELECT DISTINCT CAST(year(t) AS BIGINT) AS y FROM (SELECT fecha_cita AS t FROM silver_citas
    UNION ALL SELECT fecha_factura_date FROM silver_facturacion UNION ALL SELECT CAST(fecha_hora_evento AS DATE) FROM silver_eventos_clinicos)
  WHERE t IS NOT NULL))"""
_STEPS["dim_pac"] = """
SELECT row_number() OVER (ORDER BY id_paciente) AS sk_paciente, id_paciente, tipo_documento,
  sha256(numero_documento) AS numero_documento_hash, sexo, aseguradora, ciudad, estado AS estado_paciente,
  fecha_nacimiento, edad_anios FROM silver_pacientes"""


def _lookup_dim(entity: str, column: str) -> str:
    return (
        f"SELECT nombre, row_number() OVER (ORDER BY nombre) AS sk FROM"
        f" (SELECT DISTINCT {column} AS nombre FROM silver_{entity} WHERE {column} IS NOT NULL)"
    )


_LOOKUPS = {
    "especialidad": "citas",
    "sede": "citas",
    "tipo_evento": "eventos_clinicos",
    "tipo_servicio": "facturacion",
    "pagador": "facturacion",
}
_STEPS |= {f"dim_{c}": _lookup_dim(e, c) for c, e in _LOOKUPS.items()}
_STEPS["fact_cit"] = f"""
SELECT c.id_cita, c.id_paciente, c.especialidad, c.sede, c.tipo_cita, c.estado_cita, c.fecha_hora_cita, c.fecha_cita,
  p.sk_paciente, e.sk AS sk_especialidad, s.sk AS sk_sede, {_key('c.fecha_cita')} AS sk_fecha_cita,
  CAST(c.es_cita_atendida AS INTEGER) AS es_atendida, CAST(c.es_cita_cancelada AS INTEGER) AS es_cancelada,
  CAST(c.es_no_asistencia AS INTEGER) AS es_no_asistencia
FROM silver_citas c JOIN dim_pac p ON c.id_paciente = p.id_paciente
LEFT JOIN dim_especialidad e ON c.especialidad = e.nombre LEFT JOIN dim_sede s ON c.sede = s.nombre"""
_STEPS["fact_eve"] = f"""
SELECT v.id_evento, v.id_cita, v.tipo_evento, v.estado_evento, v.fecha_hora_evento, v.valor_resultado, p.sk_paciente,
  t.sk AS sk_tipo_evento, {_key('v.fecha_hora_evento')} AS sk_fecha_evento, CAST(v.tiene_resultado AS INTEGER) AS tiene_resultado
FROM silver_eventos_clinicos v JOIN dim_pac p ON v.id_paciente = p.id_paciente LEFT JOIN dim_tipo_evento t ON v.tipo_evento = t.nombre"""
_STEPS["fact_fac"] = f"""
SELECT f.id_factura, f.id_cita, f.tipo_servicio, f.pagador, f.fecha_factura, f.fecha_factura_date, f.valor_bruto,
  f.valor_descuento, f.valor_neto, f.monto_cartera, f.estado_pago, p.sk_paciente, s.sk AS sk_tipo_servicio, g.sk AS sk_pagador,
  {_key('f.fecha_factura_date')} AS sk_fecha_factura, CAST(f.es_factura_anulada AS INTEGER) AS es_factura_anulada
FROM silver_facturacion f JOIN dim_pac p ON f.id_paciente = p.id_paciente
LEFT JOIN dim_tipo_servicio s ON f.tipo_servicio = s.nombre LEFT JOIN dim_pagador g ON f.pagador = g.nombre"""
_STEPS |= {
    name: f"SELECT *, CAST({key} // 10000 AS INTEGER) AS anio, CAST({key} // 100 % 100 AS INTEGER) AS mes FROM {fact}"
    for name, fact, key in (
        ("visits", "fact_cit", "sk_fecha_cita"),
        ("bills", "fact_fac", "sk_fecha_factura"),
        ("monthly_events", "fact_eve", "sk_fecha_evento"),
    )
}
_STEPS["old_citas"] = f"""
SELECT * FROM clean_citas WHERE actualizado_en <= {_MARK}
QUALIFY row_number() OVER (PARTITION BY id_cita ORDER BY actualizado_en DESC, _row_hash) = 1"""
_STEPS["new_citas"] = f"""
SELECT * FROM clean_citas WHERE actualizado_en > {_MARK}
QUALIFY row_number() OVER (PARTITION BY id_cita ORDER BY actualizado_en DESC, _row_hash) = 1"""
_STEPS["first_pacientes"] = """
SELECT * FROM clean_pacientes
QUALIFY row_number() OVER (PARTITION BY id_paciente ORDER BY actualizado_en NULLS LAST, estado, _row_hash) = 1"""
_STEPS["moved_pacientes"] = """
SELECT f.id_paciente, f.ciudad AS c1, f.estado AS e1, f.aseguradora AS a1, s.ciudad AS c2, s.estado AS e2, s.aseguradora AS a2,
  (f.ciudad, f.estado, f.aseguradora) IS DISTINCT FROM (s.ciudad, s.estado, s.aseguradora) AS moved
FROM first_pacientes f JOIN latest_pacientes s ON f.id_paciente = s.id_paciente"""


def _versions(source: str, attributes: str, at: str) -> str:
    """Intervals of a key's attributes from all rows of a source, by the rows' own times."""
    return f"""SELECT id_paciente, {attributes}, t AS valid_from, lead(t) OVER (PARTITION BY id_paciente ORDER BY t) AS valid_to
      FROM (SELECT *, lag(v) OVER w IS NOT DISTINCT FROM v AND lag(t) OVER w IS NOT NULL AS same
        FROM (SELECT id_paciente, {attributes}, {at} AS t, ROW({attributes}) AS v FROM {source} WHERE id_paciente IS NOT NULL AND {at} IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY id_paciente, {at} ORDER BY _row_hash) = 1)
        WINDOW w AS (PARTITION BY id_paciente ORDER BY t)) WHERE NOT same"""


_STEPS["patient_versions"] = _versions("clean_pacientes", "ciudad, estado, aseguradora", "actualizado_en")
_STEPS["payer_versions"] = _versions("silver_facturacion", "pagador", "fecha_factura")
_STEPS["merged_citas"] = """
SELECT * FROM new_citas UNION ALL SELECT * FROM old_citas WHERE id_cita NOT IN (SELECT id_cita FROM new_citas)"""


def _sql(final: str) -> str:
    """The final statement with every step it depends on, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _STEPS:
            if name not in order and re.search(rf"\b{name}\b", text) and text is not _STEPS[name]:
                visit(_STEPS[name])
                if name not in order:
                    order.append(name)

    visit(final)
    if not order:
        return final
    steps = ",\n".join(f"{name} AS MATERIALIZED ({_STEPS[name]})" for name in order)
    return f"WITH {steps}\n{final}"


def _per_entity(template: str, label: str = "_entity") -> str:
    parts = [template.format(n=n, pk=_PK[n]) for n in STATEMENTS]
    return " UNION ALL ".join(f"SELECT '{n}' AS {label}, * FROM ({p})" for n, p in zip(STATEMENTS, parts))


def _rates(by: str) -> str:
    closed = "(sum(es_atendida) + sum(es_cancelada) + sum(es_no_asistencia))"
    return f"""SELECT {by}, count(*) AS total_citas, {_round('sum(es_atendida)', closed, 4)} AS tasa_asistencia,
      {_round('sum(es_cancelada)', 'count(*)', 4)} AS tasa_cancelacion,
      {_round('sum(es_no_asistencia)', 'count(*)', 4)} AS tasa_no_asistencia,
      {_round('sum(es_atendida)', 'count(*)', 4)} AS atendidas_sobre_total FROM visits GROUP BY {by}"""


_LIVE = "sum(CASE WHEN es_factura_anulada = 0 THEN valor_neto ELSE 0 END)"


def _totals(by: str, source: str) -> str:
    return f"""SELECT {by}, {_real('sum(valor_bruto)', 'bruto')}, {_real('sum(valor_descuento)', 'descuento')},
      {_real('sum(valor_neto)', 'neto')}, {_real(_LIVE, 'ingreso_neto')}, {_real('sum(monto_cartera)', 'cartera_pendiente')},
      count(*) AS lineas_factura, {_round(_cents('sum(valor_descuento)'), _cents('sum(valor_bruto)'), 4)} AS pct_descuento,
      {_round_money(_LIVE, 'count(*)')} AS ticket_vigente, {_round_money('sum(valor_neto)', 'count(*)')} AS ticket_total
      FROM {source} GROUP BY {by}"""


def _completion(by: str, source: str = "fact_eve") -> str:
    select, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""SELECT {select}count(*) AS total_eventos,
      {_round("count(*) FILTER (WHERE estado_evento = 'Finalizado')", 'count(*)', 4)} AS pct_finalizados,
      {_round('sum(tiene_resultado)', 'count(*)', 4)} AS pct_con_resultado FROM {source} {group}"""


_SUMMARY = f"""
SELECT coalesce(c.anio, f.anio) AS anio, coalesce(c.mes, f.mes) AS mes, coalesce(total, 0) AS total_citas,
  {_int('coalesce(att, 0)', 'citas_atendidas')}, {_int('coalesce(can, 0)', 'citas_canceladas')},
  {_int('coalesce(mis, 0)', 'citas_no_asistencia')},
  {_round('coalesce(att, 0)', '(coalesce(att, 0) + coalesce(can, 0) + coalesce(mis, 0))', 4)} AS tasa_asistencia,
  {_round('coalesce(can, 0)', 'coalesce(total, 0)', 4)} AS tasa_cancelacion,
  {_real('coalesce(income, 0)', 'ingreso_neto')}, {_real('coalesce(due, 0)', 'cartera_pendiente')},
  {_round_money('coalesce(income, 0)', 'coalesce(n, 0)')} AS ticket_promedio
FROM (SELECT anio, mes, count(DISTINCT id_cita) AS total, sum(es_atendida) AS att, sum(es_cancelada) AS can,
        sum(es_no_asistencia) AS mis FROM visits WHERE {{known}} GROUP BY ALL) c
FULL JOIN (SELECT anio, mes, {_LIVE} AS income, sum(monto_cartera) AS due, count(id_factura) AS n FROM bills WHERE {{known}} GROUP BY ALL) f
  ON c.anio = f.anio AND c.mes = f.mes"""

_SHAPE = """CASE WHEN {t} IS NULL THEN 'missing'
  WHEN regexp_full_match({t}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([ T][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}([.][0-9]+)?)?)?') THEN 'date'
  WHEN regexp_full_match({t}, '[0-9]{{1,2}}:[0-9]{{2}}(:[0-9]{{2}}([.][0-9]+)?)?') THEN 'time'
  WHEN regexp_full_match({t}, '[+-]?[0-9]+') THEN 'integer'
  WHEN regexp_full_match({t}, '[+-]?([0-9]+[.][0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN 'decimal' ELSE 'text' END"""


def _shapes(entity: str, column: str) -> str:
    shape = _SHAPE.format(t=_text(column))
    return f"SELECT {shape} AS shape, count(*) AS rows, '{column}' AS \"column\" FROM raw_{entity} GROUP BY ALL"


def _cover(parents: str, children: str, column: str, label: str) -> str:
    key = _text(column)
    return f"""SELECT (SELECT count(*) FROM loaded_{parents}) AS parents, count(DISTINCT {key}) AS parents_with_children,
      count(*) AS children, {_round('count(*)', f'count(DISTINCT {key})', 2)} AS mean_children, '{label}' AS relation
      FROM loaded_{children}"""


def _orphans(child: str, parent: str, key: str, label: str) -> str:
    return (
        f"SELECT count(*) AS rows, '{label}' AS \"check\" FROM latest_{child} c"
        f" WHERE NOT EXISTS (SELECT 1 FROM latest_{parent} p WHERE p.{key} = c.{key})"
    )


def _zero_checks() -> str:
    """Checks that hold by construction of the layers, with their severities."""
    names = list(STATEMENTS)
    crit = [f"{q}-{n}" for q in ("Q-B00", "Q-B01", "Q-B02", "Q-B03", "Q-S01") for n in names]
    crit += ["Q-S02", "Q-S03", "Q-S04", "Q-S05", "Q-S06", "Q-S07", "Q-S08", "Q-S09", "Q-S10", "Q-G02", "Q-G04"]
    crit += [f"{q}-{f}" for q in ("Q-G01", "Q-G03") for f in ("fact_citas", "fact_eventos_clinicos", "fact_facturacion")]
    rows = ", ".join(f"('{c}', 'CRIT')" for c in crit)
    return f"SELECT check_id, severity, CAST(0 AS DOUBLE) AS metric_value FROM (VALUES {rows}) v(check_id, severity)"


def _measured(check_id: str, severity: str, metric: str, source: str) -> str:
    return f"SELECT '{check_id}', '{severity}', CAST(round({metric}, 6) AS DOUBLE) FROM {source}"


def _quality() -> str:
    parts = [_zero_checks()]
    for n in STATEMENTS:
        parts.append(_measured(f"Q-O02-{n}", "WARN", "count(*) FILTER (WHERE actualizado_en < creado_en)", f"silver_{n}"))
        kept = f"(SELECT count(*) FROM silver_{n}) / count(DISTINCT {_text(_PK[n])})"
        parts.append(_measured(f"Q-SLA-{n}", "WARN", kept, f"bronze_{n}"))
    known_states = "('Atendida', 'Programada', 'Cancelada', 'No asistió')"
    parts += [
        *[_measured(f"Q-COUNT-{n}", "CRIT", "count(*)", f"silver_{n}") for n in STATEMENTS],
        *[f"SELECT 'Q-G05-{f}', 'WARN', 0.0" for f in ("fact_citas", "fact_eventos_clinicos", "fact_facturacion")],
        _measured("Q-S11", "WARN", "count(*) FILTER (WHERE sexo NOT IN ('F', 'M'))", "silver_pacientes"),
        _measured("Q-S14", "INFO", "count(*) FILTER (WHERE ciudad <> 'DESCONOCIDO') / count(*)", "silver_pacientes"),
        _measured("Q-S12", "WARN", f"count(*) FILTER (WHERE estado_cita NOT IN {known_states})", "silver_citas"),
        _measured("Q-S13", "WARN", "count(*) FILTER (WHERE motivo_cancelacion_faltante)", "silver_citas"),
        _measured("Q-S15", "INFO", "count(*) FILTER (WHERE tiene_resultado) / count(*)", "silver_eventos_clinicos"),
    ]
    bands = " ".join(
        f"WHEN check_id = 'Q-COUNT-{n}' THEN metric_value BETWEEN {keys} // 2 AND {keys}"
        for n in STATEMENTS
        for keys in [f"(SELECT count(DISTINCT {_text(_PK[n])}) FROM bronze_{n})"]
    )
    rule = f"""CASE {bands} WHEN check_id LIKE 'Q-SLA-%' THEN metric_value >= 0.99 WHEN check_id = 'Q-S14' THEN metric_value >= 0.98
      WHEN check_id = 'Q-S15' THEN metric_value >= 0.5 ELSE metric_value = 0 END"""
    body = " UNION ALL ".join(parts)
    return f"SELECT replace(check_id, 'Q-SLA-', 'Q-SLA-silver.') AS check_id, severity, metric_value, {rule} AS passed FROM ({body})"


def _has(key: str, digit: str) -> str:
    return f"starts_with(md5({key}), '{digit}')"


_STEPS["hurt_citas"] = f"""
SELECT * REPLACE (CASE WHEN {_has('id_cita', '2')} THEN 'nobody' ELSE id_paciente END AS id_paciente,
  CASE WHEN {_has('id_cita', '3')} THEN 'Otra' ELSE estado_cita END AS estado_cita)
FROM (SELECT * FROM silver_citas UNION ALL SELECT * FROM silver_citas WHERE {_has('id_cita', '1')})"""
_STEPS["hurt_eventos"] = f"""
SELECT * REPLACE (CASE WHEN {_has('id_evento', '4')} THEN 'none' ELSE id_cita END AS id_cita,
  CASE WHEN {_has('id_evento', '5')} THEN 'nobody' ELSE id_paciente END AS id_paciente) FROM silver_eventos_clinicos"""
_STEPS["hurt_bills"] = f"""
SELECT * REPLACE (CASE WHEN {_has('id_factura', '6')} THEN valor_neto + 1 ELSE valor_neto END AS valor_neto,
  CASE WHEN {_has('id_factura', '7')} THEN -1 ELSE valor_bruto END AS valor_bruto,
  CASE WHEN {_has('id_factura', '8')} THEN 'none' ELSE id_cita END AS id_cita) FROM silver_facturacion"""


def _failures() -> str:
    sizes = {"pacientes": "silver_pacientes", "citas": "hurt_citas", "eventos_clinicos": "hurt_eventos", "facturacion": "hurt_bills"}
    facts = {"fact_citas": ("fact_cit", "id_cita"), "fact_eventos_clinicos": ("fact_eve", "id_evento"), "fact_facturacion": ("fact_fac", "id_factura")}
    facts_of = dict(zip(facts, list(sizes.values())[1:]))
    checks = {}
    for n, table in sizes.items():
        checks[f"Q-B00-{n}"] = "SELECT 0"
        checks[f"Q-B02-{n}"] = f"SELECT count(*) FROM bronze_{n} WHERE {_has('_row_hash', '9')}"
        checks[f"Q-B03-{n}"] = f"SELECT count(*) FROM bronze_{n} WHERE {_has('_row_hash', 'a')}"
        checks[f"Q-S01-{n}"] = f"SELECT count({_PK[n]}) - count(DISTINCT {_PK[n]}) FROM {table}"
        checks[f"Q-COUNT-{n}"] = f"SELECT count(*) FROM {table}"
    orphan = "SELECT count(*) FROM {0} WHERE {2} NOT IN (SELECT {2} FROM {1})"
    checks |= {
        "Q-S02": orphan.format("hurt_citas", "silver_pacientes", "id_paciente"),
        "Q-S03": orphan.format("hurt_eventos", "hurt_citas", "id_cita"),
        "Q-S04": orphan.format("hurt_eventos", "silver_pacientes", "id_paciente"),
        "Q-S05": "SELECT count(*) FROM hurt_eventos e JOIN hurt_citas v ON e.id_cita = v.id_cita WHERE e.id_paciente <> v.id_paciente",
        "Q-S06": orphan.format("hurt_bills", "hurt_citas", "id_cita"),
        "Q-S07": orphan.format("hurt_bills", "silver_pacientes", "id_paciente"),
        "Q-S08": "SELECT count(*) FROM hurt_bills WHERE round(valor_bruto - valor_descuento, 2) <> round(valor_neto, 2)",
        "Q-S09": "SELECT count(*) FROM hurt_bills WHERE valor_bruto < 0 OR valor_descuento < 0 OR valor_neto < 0",
        "Q-S12": "SELECT count(*) FROM hurt_citas WHERE estado_cita NOT IN ('Atendida', 'Programada', 'Cancelada', 'No asistió')",
    }
    for name, (step, pk) in facts.items():
        checks[f"Q-G01-{name}"] = (
            f"SELECT (SELECT count(*) FROM {facts_of[name]}) - (SELECT count(*) FROM {step} WHERE NOT {_has(pk, 'b')})"
        )
        checks[f"Q-G03-{name}"] = f"SELECT count(*) FROM {step} WHERE {_has(pk, 'c')}"
    rows = " UNION ALL ".join(f"SELECT '{k}' AS check_id, CAST(({v}) AS DOUBLE) AS metric_value" for k, v in checks.items())
    return f"SELECT check_id, metric_value, check_id NOT LIKE 'Q-COUNT-%' AND metric_value = 0 AS passed FROM ({rows})"


_REJECTS = " UNION ALL ".join(
    [
        "SELECT 'pacientes' AS _entity, _reject_reason, id_paciente, NULL AS id_cita, NULL AS id_evento, NULL AS id_factura, NULL AS valor_bruto FROM tagged_pacientes WHERE _reject_reason IS NOT NULL",
        "SELECT 'citas', _reject_reason, id_paciente, id_cita, NULL, NULL, NULL FROM tagged_citas WHERE _reject_reason IS NOT NULL",
        "SELECT 'eventos_clinicos', _reject_reason, id_paciente, id_cita, id_evento, NULL, NULL FROM tagged_eventos_clinicos WHERE _reject_reason IS NOT NULL",
        "SELECT 'facturacion', _reject_reason, id_paciente, id_cita, NULL, id_factura, CAST(valor_bruto AS DOUBLE) FROM tagged_facturacion WHERE _reject_reason IS NOT NULL",
    ]
)
_REASON_BRONZE = "'PK vacía o inválida: {pk}'"


def _patients(extra: str = "") -> str:
    return f"""SELECT sk_paciente, id_paciente, tipo_documento, numero_documento_hash, sexo, aseguradora, ciudad, estado_paciente,
      {_date('fecha_nacimiento')}, edad_anios{extra} FROM dim_pac"""


def _merged(source: str) -> str:
    return f"SELECT id_cita, estado_cita, {_time('actualizado_en')}, _row_hash FROM {source}"

_PAYERS = f"""SELECT id_paciente, pagador, {_time('valid_from', '_valid_from')}, {_time('valid_to', '_valid_to')},
  valid_to IS NULL AS _is_current FROM payer_versions"""


def _finals() -> dict[str, str]:
    days = "SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem"
    finals = {
        "orders_read_as_text": "SELECT " + ", ".join(
            f"CAST({c} AS VARCHAR) AS {c}"
            for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
        ) + " FROM orders",
        "lineage_and_row_hash": f"SELECT id_factura, _row_hash, '{_BATCH}' AS _batch_id, 'facturacion' AS _source_file, {_time(_RUN_AT, '_ingested_at')} FROM loaded_facturacion",
        "quarantine_counts": _per_entity(
            "SELECT count(*) FILTER (WHERE {pk} IS NOT NULL AND trim({pk}) NOT IN " + _TOKENS + ") AS valid,"
            " count(*) FILTER (WHERE {pk} IS NULL OR trim({pk}) IN " + _TOKENS + ") AS quarantined FROM loaded_{n}"
        ),
        "quarantine_rows": " UNION ALL ".join(
            f"SELECT '{n}' AS _entity, {_REASON_BRONZE.format(pk=_PK[n])} AS _reject_reason, _row_hash, "
            + ", ".join(
                f"{c} AS {c}" if c in _COLUMNS[n].split() else f"NULL AS {c}"
                for c in ("id_paciente", "id_cita", "id_evento", "id_factura")
            )
            + f" FROM loaded_{n} WHERE {_missing(_PK[n])}"
            for n in STATEMENTS
        ),
        "calendar_from_data": f"""SELECT {_key('d')} AS sk_fecha, CAST(CAST(d AS DATE) AS VARCHAR) AS fecha, CAST(year(d) AS INTEGER) AS anio,
            CAST(month(d) AS INTEGER) AS mes, CAST(quarter(d) AS INTEGER) AS trimestre, monthname(d) AS nombre_mes, dayofweek(d) IN (0, 6) AS es_fin_semana
            FROM (SELECT unnest(generate_series(make_timestamp(y, 1, 1, 0, 0, 0), make_timestamp(y, 12, 31, 0, 0, 0), INTERVAL 1 DAY)) AS d FROM
              (SELECT DISTINCT CAST(year(CAST(d AS DATE)) AS BIGINT) AS y FROM ({days}) WHERE d IS NOT NULL))""",
        "text_cleaning": f"""SELECT {_missing('id_cita')} AS key_missing, {_text('id_cita')} AS id_cita, {_text('id_paciente')} AS id_paciente,
            {_text('id_profesional')} AS id_profesional, {_known('sede')} AS sede FROM raw_citas""",
        "timestamp_parsing": f"""SELECT id_cita, fecha_hora_cita, {_time(_stamp('fecha_hora_cita'), 'stamp')},
            CAST(CAST({_stamp('fecha_hora_cita')} AS DATE) AS VARCHAR) AS day FROM raw_citas""",
        "money_parsing": "SELECT id_factura, " + ", ".join(
            _real(_amount(c), c) for c in ("valor_bruto", "valor_descuento", "valor_neto")
        ) + " FROM raw_facturacion",
        "measure_parsing": f"SELECT id_evento, {_real(_amount(_text('valor_resultado'), 4), 'valor')} FROM raw_eventos_clinicos",
        "canonical_documents": f"SELECT numero_documento, {_document('numero_documento')} AS canonical FROM raw_pacientes",
        "state_domain": f"""SELECT CASE WHEN e IS NULL OR e IN ('Atendida', 'Programada', 'Cancelada', 'No asistió') THEN e ELSE 'OTRO' END AS estado,
            count(*) AS rows FROM (SELECT {_text('estado_cita')} AS e FROM raw_citas) GROUP BY 1""",
        "zoned_times_to_utc": f"SELECT event_id, {_time('ts + INTERVAL 5 HOUR', 'from_offset')}, {_time('ts + INTERVAL 5 HOUR', 'from_zone')} FROM events",
        "ages_and_pseudonyms": f"""SELECT {_age(f"CAST({_stamp('fecha_nacimiento')} AS DATE)")} AS age, sha256({_text('numero_documento')}) AS document_hash,
            sha256('s1-' || {_text('numero_documento')}) AS salted_hash FROM raw_pacientes""",
        "keyed_pseudonyms": f"""SELECT d AS document, sha256({_padded(0x5C)} || unhex(sha256({_padded(0x36)} || encode(d)))) AS document_hash
            FROM (SELECT {_text('numero_documento')} AS d FROM raw_pacientes)""",
        "clean_pacientes": f"""SELECT * EXCLUDE (had_date, bad_date, creado_en, actualizado_en, fecha_nacimiento),
            bad_date AS _bad_birth_date, {_date('fecha_nacimiento')}, {_time('creado_en')}, {_time('actualizado_en')} FROM clean_pacientes""",
        "clean_citas": f"""SELECT * EXCLUDE (creado_en, actualizado_en, fecha_hora_cita, fecha_cita), {_time('creado_en')}, {_time('actualizado_en')},
            {_time('fecha_hora_cita')}, {_date('fecha_cita')} FROM clean_citas""",
        "clean_eventos": f"""SELECT * EXCLUDE (creado_en, actualizado_en, fecha_hora_evento, valor_resultado), {_time('creado_en')},
            {_time('actualizado_en')}, {_time('fecha_hora_evento')}, {_real('valor_resultado')} FROM clean_eventos_clinicos""",
        "clean_facturacion": f"""SELECT * EXCLUDE (creado_en, actualizado_en, fecha_factura, fecha_factura_date, valor_bruto, valor_descuento, valor_neto, monto_cartera),
            {_time('creado_en')}, {_time('actualizado_en')}, {_time('fecha_factura')}, {_date('fecha_factura_date')}, {_real('valor_bruto')},
            {_real('valor_descuento')}, {_real('valor_neto')}, {_real('monto_cartera')} FROM clean_facturacion""",
        "latest_citas": _merged("latest_citas"),
        "latest_facturacion": f"SELECT id_factura, {_real('valor_neto')}, {_time('actualizado_en')}, _row_hash FROM latest_facturacion",
        "tagged_pacientes": f"SELECT id_paciente, sexo, {_date('fecha_nacimiento')}, _reject_reason FROM tagged_pacientes",
        "tagged_citas": f"SELECT id_cita, id_paciente, {_time('fecha_hora_cita')}, _reject_reason FROM tagged_citas",
        "tagged_eventos": "SELECT id_evento, id_cita, id_paciente, paciente_coherente_con_cita, _reject_reason FROM tagged_eventos_clinicos",
        "tagged_facturacion": f"SELECT id_factura, id_cita, id_paciente, {_real('valor_neto')}, _reject_reason FROM tagged_facturacion",
        "rejects_by_reason": f"SELECT _entity, _reject_reason, count(*) AS rows FROM ({_REJECTS}) GROUP BY ALL",
        "rejects_of_all_entities": _REJECTS,
        "row_conservation": _per_entity(
            "SELECT (SELECT count(*) FROM bronze_{n}) AS rows_in, count(*) FILTER (WHERE _reject_reason IS NULL) AS valid,"
            " count(*) FILTER (WHERE _reject_reason IS NOT NULL) AS rejected,"
            " (SELECT count(*) - count(DISTINCT trim({pk})) FROM bronze_{n}) AS superseded FROM tagged_{n}"
        ),
        "appointments_of_known_patients": "SELECT id_cita, id_paciente FROM latest_citas WHERE id_paciente IN (SELECT id_paciente FROM silver_pacientes)",
        "orphan_appointments": "SELECT id_cita, id_paciente FROM latest_citas c WHERE NOT EXISTS (SELECT 1 FROM silver_pacientes p WHERE p.id_paciente = c.id_paciente)",
        "colocated_orphans": " UNION ALL ".join(
            f"""SELECT '{n}' AS _entity, found, CAST(sum(rows) AS BIGINT) AS rows, count(*) AS keys FROM
              (SELECT {k}, count(*) AS rows, {k} IN (SELECT {k} FROM silver_{p}) AS found FROM tagged_{n} WHERE {k} IS NOT NULL GROUP BY {k}) GROUP BY found"""
            for n, p, k in (("citas", "pacientes", "id_paciente"), ("eventos_clinicos", "citas", "id_cita"), ("facturacion", "citas", "id_cita"))
        ),
        "event_patient_coherence": "SELECT l.id_paciente = c.id_paciente AS paciente_coherente_con_cita, count(*) AS rows FROM latest_eventos_clinicos l LEFT JOIN silver_citas c ON l.id_cita = c.id_cita GROUP BY 1",
        "incremental_rows": f"SELECT id_cita, {_time('_cursor')}, _row_hash FROM bronze_citas WHERE _cursor > {_MARK}",
        "incremental_rows_with_lookback": f"SELECT CAST(CAST(_cursor AS DATE) AS VARCHAR) AS day, count(*) AS rows FROM bronze_citas WHERE _cursor > {_MARK} - INTERVAL 30 DAY GROUP BY 1",
        "upsert_appointments": _merged("merged_citas"),
        "upsert_appointments_twice": _merged("merged_citas"),
        "delta_merged_appointments": f"""SELECT * FROM ({_merged("merged_citas")}) CROSS JOIN (VALUES ('deltas'), ('folded')) v(state)""",
        "delta_deleted_appointments": _merged("new_citas") + " UNION ALL "
        + _merged("old_citas WHERE estado_cita <> 'Programada' AND id_cita NOT IN (SELECT id_cita FROM new_citas)"),
        "upsert_only_changed": f"""SELECT CASE WHEN estado_cita = 'Cancelada' THEN '20020102_000000_cafe0002' ELSE '{_BATCH}' END AS _batch_id,
            estado_cita, count(*) AS rows FROM old_citas GROUP BY ALL""",
        "soft_deleted_patients": """SELECT id_paciente, id_paciente IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderdate > TIMESTAMP '2001-03-31') AS _is_active
            FROM silver_pacientes""",
        "watermarks_by_layer": " UNION ALL ".join(
            f"SELECT 'bronze' AS layer, '{n}' AS source_table, {_time('max(_cursor)', 'last_watermark')} FROM bronze_{n}"
            f" UNION ALL SELECT 'silver', '{n}', '1970-01-01 00:00:00.000000'"
            for n in STATEMENTS
        ),
        "patient_history": """SELECT id_paciente, c1 AS ciudad, e1 AS estado, a1 AS aseguradora, '1995-01-01 00:00:00.000000' AS _valid_from,
              CASE WHEN moved THEN '1996-01-01 00:00:00.000000' END AS _valid_to, NOT moved AS _is_current FROM moved_pacientes
            UNION ALL SELECT id_paciente, c2, e2, a2, '1996-01-01 00:00:00.000000', NULL, TRUE FROM moved_pacientes WHERE moved""",
        "patient_history_out_of_order": f"""SELECT id_paciente, ciudad, estado, aseguradora, {_time('valid_from', '_valid_from')},
            {_time('valid_to', '_valid_to')}, valid_to IS NULL AS _is_current FROM patient_versions""",
        "payer_history": _PAYERS,
        "payer_history_split": _PAYERS,
        "fact_appointment_versions": f"""SELECT id_cita, f.id_paciente, {_time('fecha_hora_cita')}, v.estado, g.pagador,
              sha256(v.id_paciente || '|' || strftime(v.valid_from, '%Y-%m-%d %H:%M:%S.%f')) AS version_paciente
            FROM fact_cit f ASOF LEFT JOIN patient_versions v ON f.id_paciente = v.id_paciente AND f.fecha_hora_cita >= v.valid_from
            ASOF LEFT JOIN payer_versions g ON f.id_paciente = g.id_paciente AND f.fecha_hora_cita >= g.valid_from""",
        "dim_patients": _patients(", '2002-01-01 00:00:00.000000' AS _valid_from"),
        "dim_patients_for_bi": _patients(),
        "dim_lookups": " UNION ALL ".join(f"SELECT '{c}' AS dimension, nombre, sk FROM dim_{c}" for c in _LOOKUPS),
        "dim_document_numbers": "SELECT id_factura, row_number() OVER (ORDER BY id_factura) AS sk_factura FROM silver_facturacion",
        "stable_patient_keys": """SELECT id_paciente, aseguradora, row_number() OVER (ORDER BY CASE WHEN aseguradora < 'G' THEN 0 ELSE 1 END, id_paciente) AS sk_paciente
            FROM silver_pacientes""",
        "fact_appointments": f"SELECT * EXCLUDE (fecha_hora_cita, fecha_cita), {_time('fecha_hora_cita')}, {_date('fecha_cita')} FROM fact_cit",
        "fact_clinical_events": f"SELECT * EXCLUDE (fecha_hora_evento, valor_resultado), {_time('fecha_hora_evento')}, {_real('valor_resultado')} FROM fact_eve",
        "fact_billing": f"""SELECT * EXCLUDE (fecha_factura, fecha_factura_date, valor_bruto, valor_descuento, valor_neto, monto_cartera), {_time('fecha_factura')},
            {_date('fecha_factura_date')}, {_real('valor_bruto')}, {_real('valor_descuento')}, {_real('valor_neto')}, {_real('monto_cartera')} FROM fact_fac""",
        "kpi_appointment_operations": f"""SELECT CAST(fecha_cita AS VARCHAR) AS fecha_cita, k.anio, k.mes, especialidad, sede, estado_cita, count(*) AS total_citas,
            {_int('sum(es_atendida)', 'citas_atendidas')}, {_int('sum(es_cancelada)', 'citas_canceladas')}, {_int('sum(es_no_asistencia)', 'citas_no_asistencia')}
            FROM fact_cit f LEFT JOIN calendar k ON f.sk_fecha_cita = k.sk_fecha GROUP BY f.fecha_cita, k.anio, k.mes, especialidad, sede, estado_cita""",
        "kpi_billing_monthly": f"""SELECT k.anio, k.mes, pagador, tipo_servicio, {_real('sum(valor_bruto)', 'total_bruto')}, {_real('sum(valor_descuento)', 'total_descuento')},
            {_real('sum(valor_neto)', 'total_neto')}, {_real(_LIVE, 'ingreso_neto_vigente')}, {_real('sum(monto_cartera)', 'cartera_pendiente')},
            count(*) AS lineas_factura FROM fact_fac f LEFT JOIN calendar k ON f.sk_fecha_factura = k.sk_fecha GROUP BY k.anio, k.mes, pagador, tipo_servicio""",
        "kpi_monthly_summary": _SUMMARY.format(known="anio IS NOT NULL"),
        "summary_outside_calendar": _SUMMARY.format(known="anio BETWEEN 1995 AND 2000"),
        "kpi_monthly_summary_distinct": _SUMMARY.format(known="anio IS NOT NULL"),
        "job_stored_summary": _SUMMARY.format(known="anio IS NOT NULL"),
        "kpi_active_patients": "SELECT count(DISTINCT id_paciente) AS pacientes_activos FROM dim_pac WHERE estado_paciente = 'Activo'",
        "kpi_rates_by_month_and_site": _rates("anio, mes, sede"),
        "kpi_rates_by_month_and_specialty": _rates("anio, mes, especialidad"),
        "kpi_appointments_by_state": "SELECT anio, mes, estado_cita, count(*) AS total FROM visits GROUP BY ALL",
        "kpi_appointments_by_type": "SELECT tipo_cita, count(*) AS total FROM fact_cit GROUP BY ALL",
        "kpi_appointments_by_site": "SELECT sede, count(*) AS total FROM fact_cit GROUP BY ALL",
        "kpi_appointments_by_specialty": "SELECT especialidad, count(*) AS total FROM fact_cit GROUP BY ALL",
        "kpi_top_specialties": "SELECT especialidad, count(*) AS total FROM fact_cit WHERE especialidad IS NOT NULL GROUP BY ALL ORDER BY total DESC, especialidad LIMIT 5",
        "kpi_appointment_reach": f"""SELECT anio, mes, count(*) AS total_citas, count(DISTINCT id_paciente) AS pacientes_con_cita,
            {_round('count(*)', 'count(DISTINCT id_paciente)', 4)} AS citas_por_paciente FROM visits GROUP BY anio, mes""",
        "kpi_events_by_type": _completion("tipo_evento"),
        "kpi_events_total": _completion(""),
        "kpi_events_by_month": _completion("anio, mes", "monthly_events"),
        "kpi_events_per_appointment_by_month": f"""SELECT anio, mes, count(*) AS total_eventos, count(DISTINCT id_cita) AS citas_con_evento,
            {_round('count(*)', 'count(DISTINCT id_cita)', 4)} AS eventos_por_cita FROM monthly_events GROUP BY anio, mes""",
        "kpi_events_per_appointment": f"""SELECT tipo_evento, count(*) AS total_eventos, count(DISTINCT id_cita) AS citas_con_evento,
            {_round('count(*)', 'count(DISTINCT id_cita)', 4)} AS eventos_por_cita FROM fact_eve GROUP BY tipo_evento""",
        "kpi_documented_appointments": f"""SELECT anio, mes, count(*) AS citas_atendidas, count(*) FILTER (WHERE seen) AS citas_con_evento,
            {_round('count(*) FILTER (WHERE seen)', 'count(*)', 4)} AS cobertura_clinica
            FROM (SELECT anio, mes, id_cita IN (SELECT id_cita FROM fact_eve) AS seen FROM visits WHERE es_atendida = 1) GROUP BY anio, mes""",
        "kpi_appointment_to_event_time": f"""SELECT tipo_evento, count(*) AS total_eventos, round(sum(s) / count(*) / 3600, 2) AS horas_promedio,
            min(s) AS segundos_min, max(s) AS segundos_max FROM (SELECT v.tipo_evento,
              CAST(floor(epoch(v.fecha_hora_evento)) AS BIGINT) - CAST(floor(epoch(c.fecha_hora_cita)) AS BIGINT) AS s
              FROM fact_eve v JOIN fact_cit c ON v.id_cita = c.id_cita) GROUP BY tipo_evento""",
        "kpi_billing_by_payer": _totals("pagador", "fact_fac"),
        "kpi_billing_by_service": _totals("tipo_servicio", "fact_fac"),
        "kpi_billing_by_month": _totals("anio, mes", "bills"),
        "kpi_invoices_by_payment_state": "SELECT estado_pago, count(*) AS total FROM fact_fac GROUP BY ALL",
        "kpi_billing_per_attended_appointment": f"""SELECT anio, mes, count(*) AS citas_atendidas, {_real('sum(net)', 'neto_atendidas')},
            {_round_money('sum(net)', 'count(*)')} AS neto_por_cita_atendida FROM
            (SELECT anio, mes, coalesce((SELECT sum(valor_neto) FROM fact_fac b WHERE b.id_cita = v.id_cita), 0) AS net FROM visits v WHERE es_atendida = 1)
            GROUP BY anio, mes""",
        "kpi_patients_by_insurer": "SELECT aseguradora, count(*) AS total FROM dim_pac GROUP BY ALL",
        "kpi_patients_by_city": "SELECT ciudad, count(*) AS total FROM dim_pac WHERE ciudad <> 'DESCONOCIDO' GROUP BY ALL",
        "kpi_patients_without_appointments": "SELECT id_paciente FROM dim_pac WHERE id_paciente NOT IN (SELECT id_paciente FROM fact_cit WHERE fecha_cita >= DATE '2001-01-01')",
        "kpi_mean_age_by_specialty": """SELECT especialidad, count(*) AS pacientes, round(avg(edad_anios), 4) AS edad_promedio FROM
            (SELECT DISTINCT especialidad, id_paciente FROM fact_cit WHERE es_atendida = 1) a JOIN dim_pac p ON a.id_paciente = p.id_paciente GROUP BY especialidad""",
        "profile_missing_values": "SELECT " + ", ".join(
            f"count(*) FILTER (WHERE {_missing(c)}) AS {c}" for c in _COLUMNS["citas"].split()
        ) + " FROM raw_citas",
        "profile_duplicates": _per_entity(
            "SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT {pk} FROM loaded_{n})) AS distinct_keys,"
            " count(*) - (SELECT count(*) FROM (SELECT DISTINCT {pk} FROM loaded_{n})) AS duplicates FROM loaded_{n}"
        ),
        "profile_cardinality": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) AS distinct_values FROM (SELECT DISTINCT {c} FROM loaded_citas)"
            for c in ("id_cita", "id_paciente", "id_profesional", "especialidad", "sede", "tipo_cita", "estado_cita")
        ),
        "profile_top_values": "SELECT pagador AS value, count(*) AS rows FROM raw_facturacion GROUP BY 1 ORDER BY rows DESC, value NULLS FIRST LIMIT 5",
        "profile_time_ranges": " UNION ALL ".join(
            f"SELECT '{e}' AS _entity, {_time(f'min({_stamp(c)})', 'first')}, {_time(f'max({_stamp(c)})', 'last')} FROM loaded_{e}"
            for e, c in {
                "pacientes": "fecha_nacimiento",
                "citas": "fecha_hora_cita",
                "eventos_clinicos": "fecha_hora_evento",
                "facturacion": "fecha_factura",
            }.items()
        ),
        "profile_coverage": " UNION ALL ".join(
            [
                _cover("pacientes", "citas", "id_paciente", "patients with appointments"),
                _cover("citas", "eventos_clinicos", "id_cita", "appointments with events"),
                _cover("citas", "facturacion", "id_cita", "appointments with bills"),
            ]
        ),
        "profile_value_shapes": " UNION ALL ".join(
            [
                _shapes("pacientes", "fecha_nacimiento"),
                _shapes("pacientes", "numero_documento"),
                _shapes("eventos_clinicos", "valor_resultado"),
            ]
        ),
        "profile_batches": _per_entity("SELECT CAST(count(*) > 0 AS BIGINT) AS batches FROM bronze_{n}"),
        "profile_unbalanced_rows": """SELECT id_factura, valor_bruto, valor_descuento, valor_neto FROM loaded_facturacion
            WHERE round(try_cast(valor_bruto AS DOUBLE) - try_cast(valor_descuento AS DOUBLE), 2) <> round(try_cast(valor_neto AS DOUBLE), 2)""",
        "profile_preview": "SELECT id_cita, id_paciente, estado_cita FROM tagged_citas ORDER BY md5(id_cita), id_cita, id_paciente, estado_cita LIMIT 20",
        "profile_integrity": " UNION ALL ".join(
            [
                _orphans("citas", "pacientes", "id_paciente", "appointments without patient"),
                _orphans("eventos_clinicos", "citas", "id_cita", "events without appointment"),
                _orphans("eventos_clinicos", "pacientes", "id_paciente", "events without patient"),
                _orphans("facturacion", "citas", "id_cita", "bills without appointment"),
                "SELECT count(*), 'event patient differs' FROM latest_eventos_clinicos e JOIN latest_citas c ON e.id_cita = c.id_cita WHERE e.id_paciente <> c.id_paciente",
                """SELECT count(*), 'unbalanced bills' FROM loaded_facturacion WHERE round(try_cast(valor_bruto AS DOUBLE) - try_cast(valor_descuento AS DOUBLE), 2)
                   <> round(try_cast(valor_neto AS DOUBLE), 2)""",
            ]
        ),
        "job_quality_report": _quality(),
        "job_quality_failures": _failures(),
        "job_quality_failures_alone": f"""SELECT 'Q-S10' AS check_id, CAST(count(*) AS DOUBLE) AS metric_value, count(*) = 0 AS passed
              FROM silver_pacientes WHERE fecha_nacimiento IS NOT NULL AND {_has('id_paciente', '1')}
            UNION ALL SELECT 'Q-G02', CAST(count(*) AS DOUBLE), count(*) = 0 FROM fact_fac WHERE valor_neto IS NOT NULL AND {_has('id_factura', '2')}
            UNION ALL SELECT 'Q-G04', 3.0, false""",
        "open_rejects_of_five_entities": f"""SELECT _entity, '{_BATCH}' AS _batch_id, _reject_reason, id_paciente, id_cita, id_evento, id_factura,
              NULL AS s_name, valor_bruto, CAST(NULL AS DOUBLE) AS s_acctbal, CAST(NULL AS BIGINT) AS s_nationkey FROM ({_REJECTS})
            UNION ALL SELECT 'proveedores', '{_BATCH}', 'Saldo negativo', NULL, NULL, NULL, NULL, s_name, NULL, CAST(s_acctbal AS DOUBLE), s_nationkey
            FROM supplier WHERE s_acctbal < 0""",
        "kpi_distinct_patients_merged": " UNION ALL ".join(
            f"SELECT '{grain}' AS grain, {period} AS periodo, {group} AS grupo, count(DISTINCT id_paciente) AS exact, true AS within_error"
            f" FROM (SELECT *, {_key('fecha_hora_cita')} AS day FROM fact_cit) WHERE day IS NOT NULL GROUP BY ALL"
            for grain, period, group in (
                ("month and site", "CAST(day // 100 AS INTEGER)", "sede"),
                ("year and specialty", "CAST(day // 10000 AS INTEGER)", "especialidad"),
                ("all", "CAST(NULL AS INTEGER)", "CAST(NULL AS VARCHAR)"),
            )
        ),
        "job_rejects_table": f"SELECT _entity, '{_BATCH}' AS _batch_id, _reject_reason, id_paciente, id_cita, id_evento, id_factura FROM ({_REJECTS})",
        "job_run_health": f"""SELECT 'rejected_rows' AS metric, CAST(count(*) AS VARCHAR) AS value FROM ({_REJECTS})
            UNION ALL SELECT 'failed_critical_checks', '0' UNION ALL SELECT 'last_successful_load', 'true'""",
        "job_full_load_rows": " UNION ALL ".join(
            [f"SELECT 'silver.{n}' AS table_name, count(*) AS rows FROM silver_{n}" for n in STATEMENTS]
            + [f"SELECT 'bronze.{n}', count(*) FROM bronze_{n}" for n in STATEMENTS]
            + [
                "SELECT 'gold.fact_citas', count(*) FROM fact_cit",
                "SELECT 'gold.fact_eventos_clinicos', count(*) FROM fact_eve",
                "SELECT 'gold.fact_facturacion', count(*) FROM fact_fac",
                "SELECT 'gold.dim_paciente', count(*) FROM dim_pac",
                "SELECT 'gold.dim_tiempo', count(*) FROM calendar",
                f"SELECT 'silver.rejects', count(*) FROM ({_REJECTS})",
                "SELECT 'bronze.quarantine', (" + " + ".join(
                    f"(SELECT count(*) FROM loaded_{n} WHERE {_missing(_PK[n])})" for n in STATEMENTS
                ) + ")",
            ]
        ),
        "job_published_tables": f"""SELECT 'silver.rejects' AS table_name, count(*) AS rows FROM ({_REJECTS})
            UNION ALL SELECT 'bronze.quarantine', ({" + ".join(f"(SELECT count(*) FROM loaded_{n} WHERE {_missing(_PK[n])})" for n in STATEMENTS)})
            UNION ALL SELECT 'gold.dim_paciente_bi', count(*) FROM dim_pac
            UNION ALL SELECT 'gold.v_kpi_resumen', count(*) FROM ({_SUMMARY.format(known="anio IS NOT NULL")})
            UNION ALL SELECT 'ops.ingestion_watermark', 8""",
        "job_incremental_state": " UNION ALL ".join(
            f"SELECT '{n}' AS _entity, {_PK[n]} AS key, _row_hash FROM silver_{n}" for n in STATEMENTS
        ),
        "incremental_gold_facts": """SELECT 'fact_citas' AS fact, f.id_cita AS key, p.id_paciente AS patient, f.especialidad AS value FROM fact_cit f JOIN dim_pac p USING (sk_paciente)
            UNION ALL SELECT 'fact_eventos_clinicos', f.id_evento, p.id_paciente, f.tipo_evento FROM fact_eve f JOIN dim_pac p USING (sk_paciente)
            UNION ALL SELECT 'fact_facturacion', f.id_factura, p.id_paciente, f.tipo_servicio FROM fact_fac f JOIN dim_pac p USING (sk_paciente)""",
        "reconciled_contents": """SELECT copy, key_group, count(*) FILTER (WHERE side = 1) AS left_rows, count(*) FILTER (WHERE side = 2) AS right_rows FROM (
              SELECT copy, side, substr(md5(k), 1, 2) AS key_group, md5(k) LIKE '1%' AND side = 2 AS hurt, k FROM (
                SELECT copy, 1 AS side, id_factura AS k FROM fact_fac, (VALUES ('renamed'), ('exchanged')) v(copy)
                UNION ALL SELECT 'exchanged', 2, id_factura FROM fact_fac
                UNION ALL SELECT 'renamed', 2, CASE WHEN md5(id_factura) LIKE '1%' THEN id_factura || 'x' ELSE id_factura END FROM fact_fac))
            GROUP BY copy, key_group
            HAVING copy = 'exchanged' AND bool_or(hurt)
              OR copy = 'renamed' AND list_sort(list(k) FILTER (WHERE side = 1)) IS DISTINCT FROM list_sort(list(k) FILTER (WHERE side = 2))""",
        "kpi_appointment_rates_all_grains": f"""SELECT CAST(grouping_id(anio, mes, sede, especialidad, estado_cita, tipo_cita) AS BIGINT) AS grain,
            anio, mes, sede, especialidad, estado_cita, tipo_cita, count(*) AS total_citas,
            {_round('sum(es_atendida)', '(sum(es_atendida) + sum(es_cancelada) + sum(es_no_asistencia))', 4)} AS tasa_asistencia,
            {_round('sum(es_cancelada)', 'count(*)', 4)} AS tasa_cancelacion, {_round('sum(es_no_asistencia)', 'count(*)', 4)} AS tasa_no_asistencia
            FROM visits GROUP BY GROUPING SETS ((anio, mes, sede), (anio, mes, especialidad), (anio, mes, estado_cita), (anio, mes),
              (tipo_cita), (sede), (especialidad), ())""",
        "job_with_empty_entity": """SELECT 'silver.pacientes' AS table_name, count(*) AS rows FROM silver_pacientes
            UNION ALL SELECT 'silver.citas', count(*) FROM silver_citas UNION ALL SELECT 'gold.fact_citas', count(*) FROM fact_cit
            UNION ALL SELECT n, 0 FROM (VALUES ('silver.eventos_clinicos'), ('silver.facturacion'), ('gold.fact_eventos_clinicos'), ('gold.fact_facturacion')) v(n)""",
        "snapshot_partition_replaced": f"""SELECT b AS _batch_id, (SELECT count(*) FROM bronze_pacientes) AS rows
            FROM (VALUES ('{_BATCH}'), ('20020102_000000_cafe0002')) v(b)""",
        "curve_clustered_lookups": """SELECT 'patient' AS side, id_cita, id_paciente, sk_paciente, sk_fecha_cita FROM fact_cit
              WHERE sk_paciente = (SELECT sk_paciente FROM fact_cit GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
            UNION ALL SELECT 'month', id_cita, id_paciente, sk_paciente, sk_fecha_cita FROM fact_cit
              WHERE sk_fecha_cita // 100 = (SELECT sk_fecha_cita // 100 FROM fact_cit GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)""",
        "clustered_fact_rows": f"SELECT CAST(year(fecha_cita) AS INTEGER) AS anio, count(*) AS rows, {_int('sum(sk_paciente)', 'key_sum')} FROM fact_cit GROUP BY 1",
        "arrivals_out_of_order": f"""WITH d AS (SELECT o_orderkey, o_orderdate, CASE WHEN year(o_orderdate) < 1998 THEN 1
              WHEN year(o_orderdate) IN (1999, 2000) THEN 2 ELSE 3 END AS delivery FROM orders),
            m AS (SELECT max(o_orderdate) - INTERVAL 500 DAY AS mark FROM d WHERE delivery < 3),
            third AS (SELECT o_orderkey, o_orderdate, 3 AS delivery, delivery = 2 AS again, o_orderdate <= mark AS late FROM d, m WHERE delivery > 1)
            SELECT 'taken' AS side, o_orderkey, {_time('o_orderdate')}, delivery FROM d WHERE delivery < 3
            UNION ALL SELECT CASE WHEN late THEN 'late' ELSE 'taken' END, o_orderkey, {_time('o_orderdate')}, delivery
            FROM third WHERE late OR NOT again""",
        "streamed_appointments": f"""SELECT id_cita, estado_cita, {_time('_cursor')}, _row_hash FROM bronze_citas
            QUALIFY row_number() OVER (PARTITION BY id_cita ORDER BY _cursor DESC NULLS LAST, _row_hash) = 1""",
        "job_incremental_runs": f"""SELECT r AS run, _entity, CASE WHEN r = 1 AND _entity = 'citas' THEN late_raw ELSE 0 END AS rows_read,
            CASE WHEN r = 1 AND _entity = 'citas' THEN late_clean ELSE 0 END AS rows_cleaned
            FROM (VALUES (1), (2)) v(r), (VALUES {', '.join(f"('{n}')" for n in STATEMENTS)}) e(_entity),
            (SELECT (SELECT count(*) FROM loaded_citas WHERE _cursor > {_reached()}) AS late_raw,
              (SELECT count(DISTINCT trim(id_cita)) FROM bronze_citas WHERE _cursor > {_reached()}) AS late_clean)""",
    }
    finals |= {
        "job_view_appointments": finals["kpi_appointment_operations"],
        "job_view_billing": finals["kpi_billing_monthly"],
        "incremental_gold_operations": finals["kpi_appointment_operations"],
        "incremental_gold_billing": finals["kpi_billing_monthly"],
        "incremental_gold_summary": finals["kpi_monthly_summary"],
    }
    return finals


def _reached() -> str:
    return f"(SELECT max(_cursor) FROM loaded_citas WHERE _cursor <= {_MARK})"


def oracles() -> dict[str, str]:
    return {name: _sql(final) for name, final in _finals().items()}
