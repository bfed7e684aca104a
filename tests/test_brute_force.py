"""Random dirty rows through cleaning, dedupe and validation, against plain Python."""

import random
from decimal import Decimal, InvalidOperation

from clinic import extract
from tierlake.operators.entity import add_lineage, clean, latest, split_missing_keys, tag
from tierlake.operators.skew import heavy_keys
from tierlake.plans.entities import BY_NAME

MISSING = ("", " ", "nan", "None", None)
STAMPS = ("2026-01-01 00:00:00", "2026-02-01 00:00:00", "2026-03-01", "abc", "10:00:00", None)
AMOUNTS = ("100", "90.00", "10", "100", "10", "-1", "N/A", "0.005")


def text(value):
    return None if value is None or value.strip() in ("", "nan", "None", "NaT", "null", "NULL") else value.strip()


def stamp(value):
    value = text(value)
    return value[:10] if value is not None and value[:4].isdigit() and value[4:5] == "-" else None


def cents(value):
    try:
        return Decimal(value.strip()).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
    except (InvalidOperation, AttributeError):
        return None


def reason(row, patients, visits):
    if text(row["id_paciente"]) not in patients:
        return "FK id_paciente inexistente"
    if text(row["id_cita"]) not in visits:
        return "FK id_cita inexistente"
    gross, discount, net = (cents(row[c]) for c in ("valor_bruto", "valor_descuento", "valor_neto"))
    if None in (gross, discount, net) or gross - discount != net or min(gross, discount, net) < 0:
        return "Regla financiera o montos negativos"
    if stamp(row["fecha_factura"]) is None:
        return "PK o fecha_factura inválida"
    return None


def test_billing_matches_brute_force(spark, run):
    rng = random.Random(7)
    spec = BY_NAME["facturacion"]
    rows = []
    for i in range(800):
        hot = rng.random() < 0.4
        gross, discount = rng.choice(AMOUNTS), rng.choice(AMOUNTS)
        exact = cents(gross) is not None and cents(discount) is not None and rng.random() < 0.6
        rows.append(
            {
                "id_factura": rng.choice([f"f{rng.randrange(300)}", f" f{rng.randrange(300)} ", rng.choice(MISSING)]),
                "id_paciente": "p0" if hot else rng.choice([f"p{rng.randrange(6)}"] * 5 + [rng.choice(MISSING)]),
                "id_cita": "zz" if hot and rng.random() < 0.3 else rng.choice([f"c{rng.randrange(7)}"] * 5 + [None]),
                "valor_bruto": gross,
                "valor_descuento": discount,
                "valor_neto": str(cents(gross) - cents(discount)) if exact else rng.choice(AMOUNTS),
                "fecha_factura": rng.choice(STAMPS[:3]) if rng.random() < 0.8 else rng.choice(STAMPS),
                "actualizado_en": f"2026-01-01 00:{i // 60:02d}:{i % 60:02d}" if rng.random() < 0.9 else "nan",
            }
        )
    patients, visits = {f"p{i}" for i in range(5)}, {f"c{i}" for i in range(6)}

    keyed = [r for r in rows if text(r["id_factura"]) is not None]
    expected = {}
    for key in {text(r["id_factura"]) for r in keyed}:
        same = [r for r in keyed if text(r["id_factura"]) == key]
        dated = [r for r in same if text(r["actualizado_en"])]
        # Without any cursor the row hash decides, which plain Python leaves to the engine.
        if dated:
            expected[key] = reason(max(dated, key=lambda r: r["actualizado_en"]), patients, visits)

    loaded = add_lineage(extract(spark, spec.name, rows), run, "f", spec.cursor)
    valid, quarantine = split_missing_keys(loaded, spec.pk)
    assert quarantine.count() == len(rows) - len(keyed)
    parents = {
        "pacientes": spark.createDataFrame([(p,) for p in sorted(patients)], "id_paciente STRING"),
        "citas": spark.createDataFrame([(v,) for v in sorted(visits)], "id_cita STRING"),
    }
    newest = latest(spec, clean(spec, valid, run))
    heavy = {c: heavy_keys(newest, c, 2) for c in ("id_paciente", "id_cita")}
    for lists in (None, heavy):
        tagged = tag(spec, newest, parents, lists)
        found = {r.id_factura: r._reject_reason for r in tagged.select("id_factura", "_reject_reason").collect()}
        assert set(found) == {text(r["id_factura"]) for r in keyed}
        assert {k: found[k] for k in expected} == expected
        assert len(set(expected.values())) == 5
