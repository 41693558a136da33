"""P1 parse_readings / P2 quarantine / P3 initial flags.

Raw messages (seq, value STRING) are parsed once with ``try_parse_json`` into
a VARIANT and read with typed ``try_variant_get``; everything stays JVM-side
and codegen'd. Acceptance follows the lenient typed getters of the source
system: numbers may arrive as numeric strings, a long is truncated from a
fractional number, a boolean may be the string true/false in any case, the
device must be a JSON string. A missing, null, duplicated or ill-typed key, or
text that is not a JSON object, sends the message to quarantine with a reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..schema import MESSAGE_PLACE, READING_COLUMNS, SENSORS

_MALFORMED = "malformed"
_FIELD_ORDER = ("ts", "device", "co", "humidity", "light", "lpg", "motion", "smoke", "temp")
_NUMERIC = {"ts": "decimal(38,9)", **{s: "double" for s in SENSORS}}


def _staged_sql() -> list[str]:
    """Per field the typed value and its text form."""
    out = []
    for name in _FIELD_ORDER:
        if name in _NUMERIC:
            out.append(f"try_variant_get(_v, '$.{name}', '{_NUMERIC[name]}') AS _x_{name}")
        out.append(f"try_variant_get(_v, '$.{name}', 'string') AS _t_{name}")
    return out


def _kind_sql(name: str) -> str:
    return f"schema_of_variant(try_variant_get(_v, '$.{name}', 'variant'))"


def _valid_sql(name: str) -> tuple[str, str]:
    """(value, valid) as SQL over the staged columns."""
    if name == "device":
        return "_t_device", f"coalesce({_kind_sql('device')} = 'STRING', false)"
    if name in ("light", "motion"):
        # a JSON boolean reads as true/false; a string must read true/false
        return (f"lower(_t_{name}) = 'true'",
                f"coalesce(lower(_t_{name}) IN ('true', 'false'), false)")
    if name == "ts":
        # a string is plain digits; a number is truncated, and one beyond the range is NULL,
        # never an error. Only a text that is not plain digits asks for its kind
        return ("try_cast(_x_ts AS BIGINT)",
                "(try_cast(_x_ts AS BIGINT) IS NOT NULL AND CASE WHEN _t_ts RLIKE '^[+-]?[0-9]+$' THEN true "
                f"ELSE NOT coalesce({_kind_sql('ts')} IN ('STRING', 'BOOLEAN'), true) END)")
    # a string spells a number or one of these specials; the text of a JSON number always
    # does, that of a JSON boolean never
    return (f"_x_{name}", f"(_x_{name} IS NOT NULL AND _t_{name} RLIKE "
            "'^([+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|[+-]?Infinity|NaN)$')")


def _place(raw: DataFrame) -> list[str]:
    """Where a message came from, if the source says so: with ``seq``, which then is an offset
    within it, the order of a device's messages."""
    return [c for c in MESSAGE_PLACE if c in raw.columns]


def _parsed(raw: DataFrame) -> DataFrame:
    """Parse once, read each field once, then decide. The decision is emitted
    through a one-element ``inline`` so that a later filter on ``reason``
    cannot be pushed below it and re-inline the parse into the predicate
    (which would repeat the parse per reference and outgrow codegen)."""
    place = _place(raw)
    staged = (raw.selectExpr("seq", *place, "value", "try_parse_json(value) AS _v")
              .selectExpr("seq", *place, "value", "_v", *_staged_sql()))
    checked = {n: _valid_sql(n) for n in _FIELD_ORDER}
    all_ok = " AND ".join(checked[n][1] for n in _FIELD_ORDER)
    # the whole-object check only runs for messages that already failed
    reason = (f"CASE WHEN {all_ok} THEN CAST(NULL AS STRING) "
              f"WHEN _v IS NULL OR NOT startswith(schema_of_variant(_v), 'OBJECT') "
              f"THEN '{_MALFORMED}' "
              + " ".join(f"WHEN NOT {checked[n][1]} THEN 'invalid field: {n}'" for n in _FIELD_ORDER)
              + " END")
    fields = ", ".join(f"'{n}', {checked[n][0]}" for n in _FIELD_ORDER)
    return staged.selectExpr(
        "seq", *place, "value", f"inline(array(named_struct({fields}, 'reason', {reason})))")


def parse_messages(raw: DataFrame) -> DataFrame:
    """Every message once: the columns of a reading, ``topic`` and ``partition`` where the source
    has them, ``value`` (the raw text) and ``reason``, which is null for good messages and tags
    the bad ones, whose other fields do not count."""
    return _parsed(raw).selectExpr(
        *[f"false AS {c}" if c in ("rejected", "suspicious") else c for c in READING_COLUMNS], *_place(raw),
        "value", "reason")


def parse_readings(raw: DataFrame) -> DataFrame:
    """Good messages as readings (both flags false), with ``topic`` and ``partition`` where the
    source has them."""
    return _parsed(raw).where("reason IS NULL").selectExpr(
        *[f"false AS {c}" if c in ("rejected", "suspicious") else c for c in READING_COLUMNS], *_place(raw))


def quarantine(raw: DataFrame) -> DataFrame:
    """Malformed messages with the raw text and the first reason."""
    return _parsed(raw).where("reason IS NOT NULL").select("seq", "value", "reason")


# ---------------------------------------------------------------------------
# Rendering readings as messages (the test feed of the parse queries)
# ---------------------------------------------------------------------------
def readings_as_messages(readings: DataFrame, damage_every: int = 50) -> DataFrame:
    """(seq, value) JSON messages for ``readings``. Every ``damage_every``-th
    message is altered in one of ten ways, picked by (seq div damage_every) % 10:
    0 key co missing, 1 device as a number, 2 truncated text, 3 light as 1,
    4 ts as a numeric string, 5 co as a numeric string, 6 an extra key,
    7 light as "TRUE", 8 smoke null, 9 temp duplicated. Kinds 4-7 are
    accepted by the parser, the others quarantined."""
    every = int(damage_every)
    kind = f"CASE WHEN seq % {every} = 0 THEN (seq div {every}) % 10 ELSE -1 END"

    def num(c):
        return f"CAST({c} AS STRING)"

    def quoted(x):
        return f"concat('\"', {x}, '\"')"

    def boolean(c):
        return f"CASE WHEN {c} THEN 'true' ELSE 'false' END"

    parts = [
        f"concat('\"ts\":', CASE WHEN _k = 4 THEN {quoted(num('ts'))} ELSE {num('ts')} END)",
        f"concat('\"device\":', CASE WHEN _k = 1 THEN CAST(seq % 7 AS STRING)"
        f" ELSE {quoted('device')} END)",
        f"CASE WHEN _k = 0 THEN NULL ELSE concat('\"co\":', CASE WHEN _k = 5"
        f" THEN {quoted(num('co'))} ELSE {num('co')} END) END",
        f"concat('\"humidity\":', {num('humidity')})",
        f"concat('\"light\":', CASE WHEN _k = 3 THEN '1' WHEN _k = 7 THEN '\"TRUE\"'"
        f" ELSE {boolean('light')} END)",
        f"concat('\"lpg\":', {num('lpg')})",
        f"concat('\"motion\":', {boolean('motion')})",
        f"concat('\"smoke\":', CASE WHEN _k = 8 THEN 'null' ELSE {num('smoke')} END)",
        f"concat('\"temp\":', {num('temp')})",
        f"CASE WHEN _k = 9 THEN concat('\"temp\":', {num('temp')}) END",
        "CASE WHEN _k = 6 THEN '\"fw\":\"1.2\"' END",
    ]
    body = f"concat('{{', concat_ws(',', {', '.join(parts)}), '}}')"
    return (readings.selectExpr("*", f"{kind} AS _k")
            .selectExpr("seq", f"{body} AS _t", "_k")
            .selectExpr("seq", "CASE WHEN _k = 2 THEN substr(_t, 1, length(_t) - 1)"
                               " ELSE _t END AS value"))
