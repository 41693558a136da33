"""Format-preserving pseudonyms by a keyed Feistel network, in DataFrame operations only.

Found and permuted: card numbers (13 to 19 digits, or groups of four; with ``luhn`` only
where the Luhn check holds, and every four groups of a longer row are tried), phone numbers, IPv4 addresses
(octets checked), calendar dates (checked against the calendar), the local parts of e-mail
addresses and hexadecimal secrets of 32 or more digits. A value is permuted within its own
format: digits stay digits, a number keeps its length and whether its Luhn check holds, an
address stays an address, a date stays a date of 1900 to 2099. The permutation depends on
the key and the value alone, so equal values stay equal across documents and different
ones stay different.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import apart

ROUNDS = 8
#: 1900-01-01 to 2099-12-31 has 73049 = 17 x 4297 days: the two halves of the date network.
DAY_ONE, DAYS = "1900-01-01", (17, 4297)

_L, _R = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
PATTERNS = {
    "email": r"(?<![0-9A-Za-z._%+-])[0-9A-Za-z_%+-]+(?:\.[0-9A-Za-z_%+-]+)*@(?:[0-9A-Za-z-]+\.)+[A-Za-z]{2,}",
    "phone": r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}" + _R,
    "date": _L + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4})" + _R,
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "card": _L + r"[0-9]{4}(?:[ -][0-9]{4}){3}" + _R + "|" + _L + r"[0-9]{13,19}" + _R,
    "secret": _L + r"(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})" + _R,
}
ANY = "|".join(PATTERNS.values())
#: rows of four or more groups are one match where each four of them are checked
_ROWS = {**PATTERNS, "card": PATTERNS["card"].replace("){3}", "){3,}")}


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _network(pair: str, key: str, a_mod: str, b_mod: str) -> str:
    """Feistel over numbers: ``pair`` is struct(a, b); a and b are moved in turn."""
    prf = "cast(conv(substr(sha2(concat_ws('|', {k}, '{s}', {n}, i, {v}), 256), 1, 14), 16, 10) AS bigint)"
    return (f"aggregate(sequence(1, {ROUNDS}), {pair}, (p, i) -> CASE WHEN i % 2 = 1 "
            f"THEN struct((p.a + {prf.format(k=key, s='a', n=a_mod, v='p.b')}) % {a_mod} AS a, p.b AS b) "
            f"ELSE struct(p.a AS a, (p.b + {prf.format(k=key, s='b', n=b_mod, v='p.a')}) % {b_mod} AS b) END)")


def _digits(d: str, key: str) -> str:
    """Permutes a string of 2 to 32 digits among those of its length."""
    half = f"(length({d}) div 2)"
    return (f"array_join(transform(array({_network(f'struct(cast(substr({d}, 1, {half}) AS bigint) AS a, cast(substr({d}, {half} + 1) AS bigint) AS b)', key, f'cast(pow(10, {half}) AS bigint)', f'cast(pow(10, length({d}) - {half}) AS bigint)')}), "
            f"r -> concat(lpad(string(r.a), {half}, '0'), lpad(string(r.b), length({d}) - {half}, '0'))), '')")


def _spread(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced, in order, by those of ``digits``."""
    return (f"aggregate(split({shape}, ''), struct('' AS s, 0 AS n), (z, c) -> CASE WHEN c RLIKE '^[0-9]$' "
            f"THEN struct(z.s || substr({digits}, z.n + 1, 1) AS s, z.n + 1 AS n) "
            f"ELSE struct(z.s || c AS s, z.n AS n) END, z -> z.s)")


def _luhn(d: str) -> str:
    """The check digit that makes ``d`` || digit valid."""
    return (f"((10 - aggregate(sequence(1, length({d})), 0, (z, j) -> z + aggregate(array(int(substr({d}, -j, 1)) "
            f"* (1 + j % 2)), 0, (y, t) -> int(y + t div 10 + t % 10))) % 10) % 10)")


def _card(v: str, key: str) -> str:
    d = "regexp_replace(x.v, '[^0-9]', '')"
    body = f"substr({d}, 1, length({d}) - 1)"
    moved = _digits("y.b", key)
    last = f"((({_luhn('w')}) + y.o) % 10)"
    # the offset of the last digit from its Luhn digit is kept: valid stays valid, and one-to-one
    digits = (f"element_at(transform(transform(array(struct({v} AS v)), x -> struct({body} AS b, "
              f"pmod(int(right({d}, 1)) - {_luhn(body)}, 10) AS o)), y -> element_at(transform(array({moved}), "
              f"w -> concat(w, {last})), 1)), 1)")
    return f"element_at(transform(array({digits}), g -> {_spread(v, 'g')}), 1)"


def _chars(s: str, key: str) -> str:
    """Class-preserving Feistel over characters: digits, small and capital letters move
    within their class; in hexadecimal text (``hex`` strings) within the sixteen digits."""
    def moved(own: str, other: str) -> str:
        h = f"sha2(concat_ws('|', {key}, 'c', i, length({own}), {other}), 256)"
        by = f"(ascii(substr({h}, 1 + (2 * j) % 64, 1)) * 37 + ascii(substr({h}, 2 + (2 * j) % 64, 1)) + j div 32)"
        c = f"substr({own}, j + 1, 1)"
        shift = (lambda a, n: f"char(ascii('{a}') + pmod(ascii({c}) - ascii('{a}') + {by}, {n}))")
        return (f"CASE WHEN length({own}) = 0 THEN '' ELSE array_join(transform(sequence(0, length({own}) - 1), j -> CASE "
                f"WHEN {c} RLIKE '^[0-9]$' THEN {shift('0', 10)} WHEN {c} RLIKE '^[a-f]$' THEN {shift('a', 6)} "
                f"WHEN {c} RLIKE '^[g-z]$' THEN {shift('g', 20)} WHEN {c} RLIKE '^[A-F]$' THEN {shift('A', 6)} "
                f"WHEN {c} RLIKE '^[G-Z]$' THEN {shift('G', 20)} ELSE {c} END), '') END")
    return (f"aggregate(sequence(1, {ROUNDS}), struct(substr({s}, 1, length({s}) div 2) AS a, "
            f"substr({s}, length({s}) div 2 + 1) AS b), (p, i) -> CASE WHEN i % 2 = 1 "
            f"THEN struct({moved('p.a', 'p.b')} AS a, p.b AS b) "
            f"ELSE struct(p.a AS a, {moved('p.b', 'p.a')} AS b) END, p -> concat(p.a, p.b))")


def _ip(v: str, key: str) -> str:
    o = f"transform(split({v}, '[.]'), e -> int(e))"
    return (f"element_at(transform(array({_network(f'struct(cast({o}[0] * 256 + {o}[1] AS bigint) AS a, cast({o}[2] * 256 + {o}[3] AS bigint) AS b)', key, '65536L', '65536L')}), "
            f"r -> concat_ws('.', r.a div 256, r.a % 256, r.b div 256, r.b % 256)), 1)")


def _date_of(v: str) -> str:
    return (f"CASE WHEN {v} RLIKE '^[0-9]{{4}}-' THEN to_date(try_to_timestamp({v}, 'yyyy-MM-dd')) "
            f"ELSE to_date(try_to_timestamp(replace({v}, '.', '/'), 'dd/MM/yyyy')) END")


def _date(v: str, key: str) -> str:
    a, b = DAYS
    n = f"cast(datediff({_date_of(v)}, date'{DAY_ONE}') AS bigint)"
    moved = (f"element_at(transform(array({_network(f'struct({n} div {b} AS a, {n} % {b} AS b)', key, f'{a}L', f'{b}L')}), "
             f"r -> date_add(date'{DAY_ONE}', cast(r.a * {b} + r.b AS int))), 1)")
    return (f"element_at(transform(array({moved}), d -> date_format(d, CASE WHEN {v} RLIKE '-' THEN 'yyyy-MM-dd' "
            f"WHEN {v} RLIKE '/' THEN 'dd/MM/yyyy' ELSE 'dd.MM.yyyy' END)), 1)")


def _kind(m: str) -> str:
    whole = {k: _lit(f"^(?:{p})$") for k, p in PATTERNS.items()}
    return (f"CASE WHEN {m} RLIKE {whole['email']} THEN 'email' WHEN {m} RLIKE {whole['phone']} THEN 'phone' "
            f"WHEN {m} RLIKE {whole['ip']} THEN CASE WHEN forall(split({m}, '[.]'), e -> int(e) < 256) THEN 'ip' END "
            f"WHEN {m} RLIKE {whole['date']} THEN CASE WHEN ({_date_of(m)}) BETWEEN date'1900-01-01' AND date'2099-12-31' THEN 'date' END "
            f"WHEN {m} RLIKE {whole['card']} THEN 'card' ELSE 'secret' END")


def _valid(d: str) -> str:
    return f"int(right({d}, 1)) = {_luhn(f'substr({d}, 1, length({d}) - 1)')}"


def _parts(m: str) -> str:
    """struct<v, kind> of the match ``m`` in turn: one, or of a row of groups the cards and
    what stands between them. Numbers without a valid Luhn check have no kind."""
    card = f"element_at(transform(array(regexp_replace({{v}}, '[^0-9]', '')), d -> {_valid('d')}), 1)"
    four = f"substr({m}, 5 * i + 1, 19)"
    row = (f"aggregate(sequence(0, (length({m}) - 4) div 5), "
           "struct(cast(array() AS array<struct<v: string, kind: string>>) AS o, 0 AS skip), (z, i) -> CASE "
           "WHEN z.skip > 0 THEN struct(z.o AS o, z.skip - 1 AS skip) "
           f"WHEN length({four}) = 19 AND {card.format(v=four)} THEN struct(concat(z.o, array("
           f"struct(substr({m}, 5 * i, int(i > 0)) AS v, cast(null AS string) AS kind), "
           f"struct({four} AS v, 'card' AS kind))) AS o, 3 AS skip) "
           f"ELSE struct(concat(z.o, array(struct(substr({m}, 5 * i + int(i = 0), 4 + int(i > 0)) AS v, "
           "cast(null AS string) AS kind))) AS o, 0 AS skip) END, z -> z.o)")
    one = f"array(struct({m} AS v, {{kind}} AS kind))"
    none = one.format(kind="cast(null AS string)")
    return (f"CASE WHEN {m} RLIKE '^[0-9]{{4}}([ -][0-9]{{4}}){{3,}}$' THEN element_at(transform(array({row}), r -> "
            f"CASE WHEN exists(r, x -> x.kind IS NOT NULL) THEN r ELSE {none} END), 1) "
            f"WHEN {m} RLIKE '^[0-9]{{13,19}}$' AND NOT {card.format(v=m)} THEN {none} "
            f"ELSE {one.format(kind=_kind(m))} END")


def _replace(h: str, key: str) -> str:
    v = f"{h}.v"
    local = f"regexp_extract({v}, '^([^@]+)@', 1)"
    prefix = f"regexp_extract({v}, '^([+][0-9]+)', 1)"
    rest = f"substr({v}, length({prefix}) + 1)"
    number = f"regexp_replace({rest}, '[^0-9]', '')"
    bare = f"regexp_extract({v}, '^[+][0-9]+$', 0)"
    phone = (f"CASE WHEN {bare} <> '' THEN concat('+', {_digits(f'substr({v}, 2)', key)}) ELSE concat({prefix}, "
             f"element_at(transform(array({_digits(number, key)}), g -> {_spread(rest, 'g')}), 1)) END")
    return (f"CASE {h}.kind WHEN 'email' THEN concat({_chars(local, key)}, regexp_extract({v}, '@.*$', 0)) "
            f"WHEN 'phone' THEN {phone} WHEN 'ip' THEN {_ip(v, key)} WHEN 'date' THEN {_date(v, key)} "
            f"WHEN 'card' THEN {_card(v, key)} WHEN 'secret' THEN {_chars(v, key)} ELSE {v} END")


def pseudonymise(docs: DataFrame, key: str, luhn: bool = True) -> DataFrame:
    """All columns of ``docs`` with the values in ``text`` replaced, plus ``pii`` (array of
    struct<kind, value>: the pseudonyms in order; kind null: looked like one, not valid,
    left alone). Numbers are cards only where the Luhn check holds (``luhn`` False takes every
    card-like number). Equal values get equal pseudonyms in every row. Null text stays null with
    an empty array; null ids and repeated rows stay as they are; texts are replaced whole,
    whatever their length; an empty table gives no rows. Extra columns pass through whatever
    their names, a column named ``pii`` is replaced."""
    return apart(docs.drop("pii"), lambda d: _replaced(d, key, luhn))


def _replaced(docs: DataFrame, key: str, luhn: bool) -> DataFrame:
    any_ = _lit("|".join(_ROWS.values()) if luhn else ANY)
    parts = _parts("m") if luhn else f"array(struct(m AS v, {_kind('m')} AS kind))"
    found = docs.withColumn("_h", F.expr(
        f"transform(regexp_extract_all(coalesce(text, ''), {any_}, 0), m -> {parts})"))
    moved = found.withColumn("_p", F.expr(
        f"transform(_h, g -> transform(g, h -> struct(h.kind AS kind, {_replace('h', _lit(key))} AS value)))"))
    return moved.withColumn("pii", F.expr(
        "flatten(transform(_p, g -> filter(g, p -> size(g) = 1 OR p.kind IS NOT NULL)))")).withColumn("text", F.expr(
        f"CASE WHEN size(_p) = 0 THEN text ELSE array_join(flatten(zip_with(split(text, {any_}, -1), _p, "
        f"(s, g) -> CASE WHEN g IS NULL THEN array(s) ELSE concat(array(s), transform(g, p -> p.value)) END)), '') END")) \
        .select(*docs.columns, "pii")
