"""Format-preserving pseudonyms for personal data.  DataFrame functions only.

Numbers that pass their check (cards: Luhn; IBANs: modulus 97; IPv4: octets; social security numbers:
areas, groups and serials that are given out; phone numbers: shape) and calendar dates go through a keyed
Feistel network over exactly the values of their format: separators, length and check digits stay valid,
and equal values get equal pseudonyms in every document.  E-mail addresses and secrets (a long value
after token, key, password and the like) have no number to permute; they get keyed digests instead.
What fails its check, such as a 16-digit number that is no card number, stays as it is.  Cards are looked for at
every number, in the groupings that cards are printed in; only those that pass their check take the text, so what
stands in or beside a number that fails is found as if the number were not there.

Null texts stay null and empty texts empty; a text without personal data is returned unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Dates from 1800-01-01 on, as day = 400 * x + y with x and y below 400.
DATE_BASE, DATE_SIDE = "1800-01-01", 400

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
DATE = r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
BEFORE_CARD, AFTER_CARD = r"(?<![A-Za-z0-9-])", r"(?![A-Za-z0-9]|-[0-9]{2}-[0-9]{2}(?![0-9]))"
#: Group 1 of a match of no width is a candidate, so candidates may overlap.  A number with three digits behind it is one of 16 with
#: its verification number, or one of 19.
CARDS = tuple(
    f"{BEFORE_CARD}(?=({grouping}){after})"
    for grouping, after in (
        (r"[0-9]{13,19}|[0-9]{4}(?:[ -]?[0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{3}", AFTER_CARD),
        (r"[0-9]{4}(?:[ -]?[0-9]{4}){3}[ -][0-9]{3}|[0-9]{6}[ -][0-9]{13}|[0-9]{4}(?:[ -][0-9]{3}){3}", r"(?![A-Za-z0-9]|[ /-][0-9])"),
    )
)
PHONE = (
    r"(?<![A-Za-z0-9+])(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-]?[0-9]{4}"
    r"|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){3,5})(?![0-9])"
)
SECRET = (
    r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]{16})"
    r"(?<=(?i:token|secret|password|passwd|api[_-]?key)[\"']? {0,2}[=:] {0,2}[\"']?)[A-Za-z0-9_-]+"
)
#: Without cards, which stand between the two where a text holds any.
FIRST, LAST = "|".join((EMAIL, SECRET, IBAN, IPV4, DATE, SSN)), PHONE


def _lit(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class _Sql:
    """SQL text of the pseudonym of one match; `m` is SQL text of the match."""

    def __init__(self, key: str):
        self.key = _lit(key)

    def hashed(self, kind: str, turn: str, value: str) -> str:
        """60 keyed bits."""
        return f"CAST(conv(substr(sha2(concat_ws(':', {self.key}, '{kind}', {turn}, {value}), 256), 1, 15), 16, 10) AS BIGINT)"

    def feistel(self, kind: str, x: str, y: str, a: str, b: str) -> str:
        """Struct (x, y) after the rounds, a permutation of the pairs with x < a and y < b."""
        return (
            f"aggregate(sequence(1, {ROUNDS}), named_struct('x', CAST({x} AS BIGINT), 'y', CAST({y} AS BIGINT)), (s, i) -> "
            f"named_struct('x', if(i % 2 = 1, (s.x + {self.hashed(kind, 'i', 's.y')} % {a}) % {a}, s.x), "
            f"'y', if(i % 2 = 0, (s.y + {self.hashed(kind, 'i', 's.x')} % {b}) % {b}, s.y)))"
        )

    def digits(self, kind: str, d: str) -> str:
        """The permuted digit string, of the same length (2 to 36)."""
        u = f"(length({d}) div 2)"
        power = lambda n: f"CAST(rpad('1', {n} + 1, '0') AS BIGINT)"
        v = f"(length({d}) - {u})"
        pair = self.feistel(f"{kind}", f"substr({d}, 1, {u})", f"substr({d}, {u} + 1)", power(u), power(v))
        return f"element_at(transform(array({pair}), t -> concat(lpad(CAST(t.x AS STRING), {u}, '0'), lpad(CAST(t.y AS STRING), {v}, '0'))), 1)"

    @staticmethod
    def only_digits(m: str) -> str:
        return f"regexp_replace({m}, '[^0-9]', '')"

    @staticmethod
    def refilled(m: str, digits: str) -> str:
        """The match with its digits replaced in turn."""
        return (
            f"element_at(transform(array({digits}), q -> array_join(transform(sequence(1, length({m})), c -> "
            f"if(substr({m}, c, 1) BETWEEN '0' AND '9', substr(q, length(regexp_replace(substr({m}, 1, c), '[^0-9]', '')), 1), substr({m}, c, 1))), '')), 1)"
        )

    @staticmethod
    def luhn(d: str) -> str:
        """Luhn sum of a digit string followed by its check digit's place."""
        return (
            f"aggregate(sequence(1, length({d})), 0, (a, k) -> a + element_at(if((length({d}) - k) % 2 = 0, "
            f"array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9), array(0, 1, 2, 3, 4, 5, 6, 7, 8, 9)), CAST(substr({d}, k, 1) AS INT) + 1))"
        )

    def is_card(self, m: str) -> str:
        d = self.only_digits(m)
        body = f"substr({d}, 1, length({d}) - 1)"
        return f"({self.luhn(body)} + CAST(substr({d}, -1) AS INT)) % 10 = 0"

    def card(self, m: str) -> str:
        """First digit kept, the others permuted, check digit anew."""
        d = self.only_digits(m)
        valid = self.is_card(m)
        new = f"concat(substr({d}, 1, 1), {self.digits('card', f'substr({d}, 2, length({d}) - 2)')})"
        checked = f"element_at(transform(array({new}), b -> concat(b, CAST((10 - {self.luhn('b')} % 10) % 10 AS STRING))), 1)"
        return f"if({valid}, {self.refilled(m, checked)}, {m})"

    def phone(self, m: str) -> str:
        """The last ten digits permuted; a country code stays."""
        d = self.only_digits(m)
        kept = f"greatest(length({d}) - 10, 0)"
        return self.refilled(m, f"concat(substr({d}, 1, {kept}), {self.digits('phone', f'substr({d}, {kept} + 1)')})")

    def ipv4(self, m: str) -> str:
        octet = lambda k: f"CAST(split({m}, '[.]')[{k}] AS INT)"
        pair = self.feistel("ip", f"{octet(0)} * 256 + {octet(1)}", f"{octet(2)} * 256 + {octet(3)}", "65536", "65536")
        valid = " AND ".join(f"{octet(k)} <= 255" for k in range(4))
        new = f"element_at(transform(array({pair}), t -> concat_ws('.', t.x div 256, t.x % 256, t.y div 256, t.y % 256)), 1)"
        return f"if({valid}, {new}, {m})"

    def ssn(self, m: str) -> str:
        """Areas 001-665 and 667-899, groups 01-99, serials 0001-9999."""
        part = lambda k: f"CAST(split({m}, '-')[{k}] AS BIGINT)"
        valid = f"{part(0)} BETWEEN 1 AND 899 AND {part(0)} <> 666 AND {part(1)} > 0 AND {part(2)} > 0"
        pair = self.feistel("ssn", f"{part(0)} - if({part(0)} > 666, 2, 1)", f"({part(1)} - 1) * 9999 + {part(2)} - 1", "898", "989901")
        new = (
            f"element_at(transform(array({pair}), t -> concat_ws('-', lpad(CAST(t.x + if(t.x >= 665, 2, 1) AS STRING), 3, '0'), "
            f"lpad(CAST(t.y div 9999 + 1 AS STRING), 2, '0'), lpad(CAST(t.y % 9999 + 1 AS STRING), 4, '0'))), 1)"
        )
        return f"if({valid}, {new}, {m})"

    def date(self, m: str) -> str:
        """Year first with dashes, else day (or month, where only that is a date) first; the form stays."""
        part = lambda k: f"CAST(split({m}, '[/.-]')[{k}] AS INT)"
        iso = f"{m} LIKE '____-__-__'"
        month_first = f"{part(0)} <= 12 AND {part(1)} > 12"
        y = f"if({iso}, {part(0)}, {part(2)})"
        mo = f"if({iso}, {part(1)}, if({month_first}, {part(0)}, {part(1)}))"
        d = f"if({iso}, {part(2)}, if({month_first}, {part(1)}, {part(0)}))"
        fits = f"{mo} BETWEEN 1 AND 12 AND {y} BETWEEN 1800 AND 2237 AND {d} BETWEEN 1 AND day(last_day(make_date(if({y} > 0, {y}, 1), greatest(1, least(12, {mo})), 1)))"
        day = f"datediff(make_date({y}, {mo}, {d}), DATE'{DATE_BASE}')"
        pair = self.feistel("date", f"{day} div {DATE_SIDE}", f"{day} % {DATE_SIDE}", str(DATE_SIDE), str(DATE_SIDE))
        sep = f"substr(regexp_replace({m}, '[0-9]', ''), 1, 1)"
        new = (
            f"element_at(transform(array({pair}), t -> element_at(transform(array(date_add(DATE'{DATE_BASE}', CAST(t.x * {DATE_SIDE} + t.y AS INT))), n -> "
            f"if({iso}, CAST(n AS STRING), concat_ws({sep}, if({month_first}, lpad(CAST(month(n) AS STRING), 2, '0'), lpad(CAST(day(n) AS STRING), 2, '0')), "
            f"if({month_first}, lpad(CAST(day(n) AS STRING), 2, '0'), lpad(CAST(month(n) AS STRING), 2, '0')), CAST(year(n) AS STRING)))), 1)), 1)"
        )
        return f"if({fits}, {new}, {m})"

    def iban(self, m: str) -> str:
        """Digits of the account part permuted, check digits anew."""
        flat = f"regexp_replace({m}, ' ', '')"
        mod = lambda s: (
            f"aggregate(split({s}, ''), 0, (a, c) -> if(c = '', a, if(c BETWEEN '0' AND '9', (a * 10 + CAST(if(c BETWEEN '0' AND '9', c, '0') AS INT)) % 97, (a * 100 + ascii(c) - 55) % 97)))"
        )
        valid = f"{mod(f'concat(substr({flat}, 5), substr({flat}, 1, 4))')} = 1 AND length({self.only_digits(f'substr({flat}, 5)')}) >= 4"
        account = self.refilled(f"substr({flat}, 5)", self.digits("iban", self.only_digits(f"substr({flat}, 5)")))
        country = f"substr({flat}, 1, 2)"
        check = f"lpad(CAST(98 - {mod(f'''concat(w, {country}, '00')''')} AS STRING), 2, '0')"
        whole = f"element_at(transform(array({account}), w -> concat({country}, {check}, w)), 1)"
        spaced = (
            f"element_at(transform(array({whole}), z -> array_join(transform(sequence(1, length({m})), c -> if(substr({m}, c, 1) = ' ', ' ', "
            f"substr(z, length(regexp_replace(substr({m}, 1, c), ' ', '')), 1))), '')), 1)"
        )
        return f"if({valid}, {spaced}, {m})"

    def email(self, m: str) -> str:
        return f"concat('u', substr(sha2(concat_ws(':', {self.key}, 'email', lower({m})), 256), 1, 12), '@mail.invalid')"

    def secret(self, m: str) -> str:
        """Keyed hexadecimal digits, as many as the secret has characters."""
        return f"substr(repeat(sha2(concat_ws(':', {self.key}, 'secret', {m}), 256), length({m}) div 64 + 1), 1, length({m}))"

    def any(self, m: str) -> str:
        return (
            f"CASE WHEN {m} LIKE '%@%' THEN {self.email(m)} "
            f"WHEN {m} RLIKE {_lit(r'^[0-9]{1,3}(?:[.][0-9]{1,3}){3}$')} THEN {self.ipv4(m)} "
            f"WHEN {m} RLIKE {_lit(r'^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([/.])[0-9]{1,2}[/.][0-9]{4})$')} THEN {self.date(m)} "
            f"WHEN {m} RLIKE {_lit(r'^[0-9]{3}-[0-9]{2}-[0-9]{4}$')} THEN {self.ssn(m)} "
            f"WHEN {m} RLIKE {_lit(r'^[0-9](?:[ -]?[0-9]){12,18}$')} THEN {self.card(m)} "
            f"WHEN {m} RLIKE {_lit(r'^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?$')} AND {m} RLIKE '[0-9]{{4}}' THEN {self.iban(m)} "
            f"WHEN {m} RLIKE {_lit(r'^[+(0-9][-+() .0-9]*$')} THEN {self.phone(m)} "
            f"ELSE {self.secret(m)} END"
        )


def pseudonym(match: str, key: str) -> Column:
    """The pseudonym of a column that holds one match each."""
    return F.expr(_Sql(key).any(match))


def pseudonymised(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """The rows with their text pseudonymised; `count` names a column for the number of values replaced (it takes the place of
    a column of that name)."""
    name = "_text"
    plain = _lit(f"{FIRST}|{LAST}")
    found = f"if(_any IS NULL, regexp_extract_all({name}, {plain}, 0), regexp_extract_all({name}, _any, 0))"
    pieces = f"if(_any IS NULL, split({name}, {plain}, -1), split({name}, _any, -1))"
    numbers = ", ".join(f"regexp_extract_all({name}, {_lit(c)}, 1)" for c in CARDS)
    cards = f"array_distinct(filter(concat({numbers}), c -> {_Sql(key).is_card('c')}))"
    quick = f"{name} RLIKE {_lit('[0-9@]|(?i:token|secret|passw|key)')}"
    work = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text"))
    work = work.withColumn("_cards", F.expr(f"if({name} RLIKE '[0-9](?:[ -]?[0-9]){{12}}', {cards}, NULL)"))
    with_cards = f"concat({_lit(f'{FIRST}|{BEFORE_CARD}(?:')}, array_join(_cards, '|'), {_lit(f'){AFTER_CARD}|{LAST}')})"
    work = work.withColumn("_any", F.expr(f"if(_cards IS NULL OR size(_cards) = 0, NULL, {with_cards})"))
    work = work.withColumn("_pii", F.expr(f"if({quick}, transform({found}, m -> named_struct('was', m, 'now', {_Sql(key).any('m')})), NULL)"))
    out = F.expr(f"if(_pii IS NULL OR size(_pii) = 0, {name}, array_join(zip_with({pieces}, _pii, (p, r) -> concat(p, coalesce(r.now, ''))), ''))")
    columns = [out.alias(c) if c == text else F.col(f"_row.`{c}`") for c in docs.columns if c != count]
    if count is not None:
        columns.append(F.expr("CAST(coalesce(size(filter(_pii, r -> r.was <> r.now)), 0) AS BIGINT)").alias(count))
    return work.select(*columns)
