"""Format-preserving Feistel pseudonyms of personal data, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rounds of every Feistel network here.
ROUNDS = 8
#: Days from 1600-01-01 to 2399-12-31 (two Gregorian cycles) and their factors, the two halves of a date.
FIRST_DAY, DAYS_A, DAYS_B = "1600-01-01", 378, 773
#: Most steps of a walk on to the next valid value; of days one in 2.5 goes on, of other kinds far fewer.
WALK = 64

#: Countries by the length of their IBANs.
LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU",
}
#: Of the countries with a fixed length just that many characters, so that a following word isn't taken along.
KNOWN = "|".join(
    f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in LENGTHS.items()
)

#: What is looked for, in the order in which one pattern tries them at each place. No part may start or end inside a word
#: or number. All repetitions are possessive or bounded, so a text is read in linear time.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}+[A-Za-z]{2,24}+(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?=[0-9A-Fa-f]{0,63}[0-9])(?=[0-9]{0,63}[A-Fa-f])[0-9A-Fa-f]{32,64}+(?![A-Za-z0-9])",
    "iban": rf"(?<![A-Za-z0-9])(?:{KNOWN})(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3}+)?(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/-]|\.[0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,4}+(?![0-9])"
    r"|(?<![0-9A-Za-z(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9]|[.-][0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}+|[0-9]{4}(?:[ -][0-9]{4}){2,7}(?:[ -][0-9]{1,3}(?![./][0-9]))?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())


def _let(value: str, name: str, body: str) -> str:
    """SQL: body with a name for a value that it uses more than once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _chars(s: str) -> str:
    return f"filter(split({s}, ''), c -> c <> '')"


def _number(text: str, digits: int) -> str:
    """SQL: a non-negative number from the keyed digest of a text."""
    return f"cast(conv(substr(sha2({text}, 256), 1, {digits}), 16, 10) as bigint)"


def _shifted(s: str, other: str, key: str, turn: str, hexadecimal: bool, letters: int) -> str:
    """SQL: every letter and digit of s moved on within its alphabet by a keyed amount that depends on the other half."""
    amount = _number(f"concat_ws('|', '{key}', {turn}, i, {other})", 12)
    alphabets = ((48, 10, "0", "9"), (97, letters, "a", chr(96 + letters)), (65, letters, "A", chr(64 + letters)))
    cases = " ".join(f"when c between '{a}' and '{z}' then chr({base} + (ascii(c) - {base} + {amount} % {n}) % {n})" for base, n, a, z in alphabets)
    if hexadecimal:  # one alphabet of sixteen, in lower case
        return f"array_join(transform({_chars(s)}, (c, i) -> lower(conv((cast(conv(c, 16, 10) as int) + {amount} % 16) % 16, 10, 16))), '')"
    return f"array_join(transform({_chars(s)}, (c, i) -> case {cases} else c end), '')"


def permuted(s: str, key: str, hexadecimal: bool = False, letters: int = 26) -> str:
    """SQL: keyed permutation of the strings of one format: digits stay digits, letters letters of their case (of the first `letters`), all
    else stays. An alternating Feistel network over the left and right half, whose characters shift by amounts drawn from the other half."""
    step = (
        "if(turn % 2 = 0, "
        f"named_struct('l', {_shifted('x.l', 'x.r', key, 'turn', hexadecimal, letters)}, 'r', x.r), "
        f"named_struct('l', x.l, 'r', {_shifted('x.r', 'x.l', key, 'turn', hexadecimal, letters)}))"
    )
    start = "named_struct('l', left(w, cast(length(w) / 2 as int)), 'r', substr(w, cast(length(w) / 2 as int) + 1))"
    return _let(s, "w", f"aggregate(sequence(1, {ROUNDS}), {start}, (x, turn) -> {step}, x -> concat(x.l, x.r))")


def _two(a: str, b: str, na: int, nb: int, key: str, body: str) -> str:
    """SQL: body over x.l in 0..na-1 and x.r in 0..nb-1, the keyed permutation of the numbers a and b."""
    left = _number(f"concat_ws('|', '{key}', turn, x.r)", 12)
    right = _number(f"concat_ws('|', '{key}', turn, x.l)", 12)
    step = (
        f"if(turn % 2 = 0, named_struct('l', (x.l + {left}) % {na}, 'r', x.r), named_struct('l', x.l, 'r', (x.r + {right}) % {nb}))"
    )
    start = f"named_struct('l', cast({a} as bigint), 'r', cast({b} as bigint))"
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (x, turn) -> {step}, x -> {body})"


def _walked(start: str, step: str, valid: str) -> str:
    """SQL: a permutation (step, of y) walked on from a valid value to the next valid one, which permutes the valid values alone."""
    return f"aggregate(sequence(1, {WALK}), {start}, (y, j) -> if(j > 1 and {valid}, y, {step}), y -> y)"


def _single(c: str, key: str) -> str:
    """SQL: keyed permutation of one character within its alphabet, by a Feistel network over two halves of the alphabet's number."""
    cases = []
    for base, n, a, z in ((48, 10, "0", "9"), (97, 26, "a", "z"), (65, 26, "A", "Z")):
        half = n // 2
        at = _two(f"(ascii({c}) - {base}) div {half}", f"(ascii({c}) - {base}) % {half}", 2, half, key, f"x.l * {half} + x.r")
        cases.append(f"when {c} between '{a}' and '{z}' then chr({base} + {at})")
    return f"case {' '.join(cases)} else {c} end"


def _luhn(digits: str) -> str:
    """SQL: Luhn sum of a string of digits whose last one counts once."""
    d = "(ascii(c) - 48)"
    doubled = f"if({d} > 4, 2 * {d} - 9, 2 * {d})"
    return f"aggregate(transform(reverse({_chars(digits)}), (c, i) -> if(i % 2 = 1, {doubled}, {d})), 0, (t, v) -> t + v)"


def _check97(iban: str) -> str:
    """SQL: an IBAN without blanks, its first four characters moved to the end, letters as numbers, modulo 97."""
    moved = f"concat(substr({iban}, 5), left({iban}, 4))"
    value = "if(c between '0' and '9', (t * 10 + ascii(c) - 48) % 97, (t * 100 + ascii(c) - 55) % 97)"
    return f"aggregate({_chars(moved)}, cast(0 as bigint), (t, c) -> cast({value} as bigint))"


def _refill(layout: str, symbols: str, kind: str) -> str:
    """SQL: a layout's characters of the kind replaced in order by those of a string of as many."""
    nth = f"length(regexp_replace(left({layout}, i + 1), '[^{kind}]', ''))"
    return f"array_join(transform({_chars(layout)}, (c, i) -> if(c rlike '[{kind}]', substr({symbols}, {nth}, 1), c)), '')"


def _date(m: str, pattern: str, key: str) -> str:
    day = f"datediff(try_to_date({m}, '{pattern}'), date'{FIRST_DAY}')"
    back = f"date_format(date_add(date'{FIRST_DAY}', cast(x.l * {DAYS_B} + x.r as int)), '{pattern}')"
    out = _two(f"n div {DAYS_B}", f"n % {DAYS_B}", DAYS_A, DAYS_B, key + "date", back)
    return _let(f"cast({day} as bigint)", "n", f"if(n between 0 and {DAYS_A * DAYS_B - 1}, {out}, {m})")


def _late_date(m: str, key: str) -> str:
    """SQL: MM/dd/yyyy whose day is no month. The permutation of days is walked on until it gives such a day again, so that what comes out
    is no other value's dd/MM/yyyy."""
    step = _two(f"y div {DAYS_B}", f"y % {DAYS_B}", DAYS_A, DAYS_B, key + "date", f"x.l * {DAYS_B} + x.r")
    day = f"date_add(date'{FIRST_DAY}', cast(%s as int))"
    walk = f"aggregate(sequence(1, {WALK}), n, (y, j) -> if(j > 1 and day({day % 'y'}) > 12, y, {step}), y -> date_format({day % 'y'}, 'MM/dd/yyyy'))"
    first = f"cast(datediff(try_to_date({m}, 'MM/dd/yyyy'), date'{FIRST_DAY}') as bigint)"
    return _let(first, "n", f"if(n between 0 and {DAYS_A * DAYS_B - 1}, {walk}, {m})")


def _parts(m: str) -> str:
    """SQL: the parts of m from its start to its end or to a separator, longest first."""
    return f"transform(filter(sequence(0, length({m}) - 1), k -> k = 0 or substr({m}, length({m}) - k + 1, 1) rlike '[ .-]'), k -> left({m}, length({m}) - k))"


def _longest(m: str, valid: str, out: str) -> str:
    """SQL: the longest part s of m from its start to its end or to a separator that is valid replaced by out; m where there is none."""
    return _let(f"get(filter({_parts(m)}, s -> {valid}), 0)", "s", f"if(s is null, {m}, concat({out}, substr({m}, length(s) + 1)))")


def _longest_inside(m: str, valid: str, out: str) -> str:
    """SQL: the same for parts that start at m's start or after a separator; of equally long ones the first."""
    begins = f"filter(sequence(1, length({m})), b -> b = 1 or substr({m}, b - 1, 1) rlike '[ .-]')"
    parts = f"flatten(transform({begins}, b -> transform({_parts(f'substr({m}, b)')}, s -> named_struct('n', -length(s), 'b', b, 's', s))))"
    found = f"array_min(filter({parts}, z -> exists(array(z.s), s -> {valid})))"
    whole = f"concat(left({m}, z.b - 1), {_let('z.s', 's', out)}, substr({m}, z.b + length(z.s)))"
    return _let(found, "z", f"if(z is null, {m}, {whole})")


def pseudonym(m: str, key: str) -> str:
    """SQL: the pseudonym of one match, or of its longest valid part, or the match itself where nothing in it passes validation."""
    digits = "regexp_replace(s, '[^0-9]', '')"
    body = f"concat(p, cast((10 - {_luhn("concat(p, '0')")} % 10) % 10 as string))"
    card = _let(permuted("left(d, length(d) - 1)", key + "card"), "p", body)
    card = _let(digits, "d", _let(card, "q", _refill("s", "q", "0-9")))
    card = _longest_inside(m, _let(digits, "d", f"length(d) between 13 and 19 and {_luhn('d')} % 10 = 0"), card)
    octets = "filter(transform(split({m}, '[.]'), o -> cast(o as int)), o -> o <= 255)".replace("{m}", m)
    dotted = "concat_ws('.', x.l div 256, x.l % 256, x.r div 256, x.r % 256)"
    ip = _two("o[0] * 256 + o[1]", "o[2] * 256 + o[3]", 65536, 65536, key + "ip", dotted)
    ip = _let(octets, "o", f"if(size(o) = 4, {ip}, {m})")
    iban = _let(permuted("substr(d, 5)", key + "iban"), "p", f"concat(left(d, 2), lpad(cast(98 - {_check97("concat(left(d, 2), '00', p)")} as string), 2, '0'), p)")
    iban = _let("replace(s, ' ', '')", "d", _let(iban, "q", _refill("s", "q", "A-Z0-9")))
    own = "substr(d, 3, 2) between '02' and '98'"  # 00, 01 and 99 would say the same as 97, 98 and 02
    iban = _longest(m, _let("replace(s, ' ', '')", "d", f"length(d) between 15 and 34 and {own} and {_check97('d')} = 1"), iban)
    # a phone keeps its country code; its last ten digits (fewer in short ones) are permuted
    tail = "least(10, length(d) - if(s like '+%', 1, 0))"
    phone = _let(permuted(f"right(d, {tail})", key + "phone"), "p", "concat(left(d, length(d) - length(p)), p)")
    phone = _let(digits, "d", _let(phone, "q", _refill("s", "q", "0-9")))
    phone = _longest(m, f"length({digits}) between 8 and 15", phone)
    digits = digits.replace("(s,", f"({m},")
    ssn = "not (y rlike '^(000|666|9)|^[0-9]{3}00|0000$')"
    ssn = _let(digits, "d", f"if({ssn.replace('y rlike', 'd rlike')}, {_let(_walked('d', permuted('y', key + 'ssn'), ssn), 'q', _refill(m, 'q', '0-9'))}, {m})")
    name = f"substring_index({m}, '@', 1)"
    name = _let(name, "n", f"if(length(n) = 1, {_single('n', key + 'email')}, {permuted('n', key + 'email')})")
    email = f"concat({name}, '@', substring_index({m}, '@', -1))"
    # a secret has digits and letters; with letters of both cases each keeps its place and case
    both = "y rlike '[0-9]' and y rlike '[a-f]'"
    secret = _walked(f"lower({m})", permuted("y", key + "secret", hexadecimal=True), both)
    secret = f"if({m} rlike '[A-F]', upper({secret}), {secret})"
    secret = f"if({m} rlike '[A-F]' and {m} rlike '[a-f]', {permuted(m, key + 'secret', letters=6)}, {secret})"
    return (
        f"case when {m} like '%@%' then {email} "
        f"when {m} rlike '^[0-9A-Fa-f]{{32,64}}$' then {secret} "
        f"when {m} rlike '^[A-Z]{{2}}[0-9]{{2}}' then {iban} "
        f"when {m} rlike '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' then {_date(m, 'yyyy-MM-dd', key)} "
        f"when {m} rlike '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$' and try_to_date({m}, 'dd/MM/yyyy') is null then {_late_date(m, key)} "
        f"when {m} rlike '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$' then {_date(m, 'dd/MM/yyyy', key)} "
        f"when {m} rlike '^[0-9]{{2}}[.][0-9]{{2}}[.][0-9]{{4}}$' then {_date(m, 'dd.MM.yyyy', key)} "
        f"when {m} rlike '^[0-9.]+$' and {m} like '%.%.%.%' then {ip} "
        f"when {m} rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' then {ssn} "
        f"when {m} rlike '^[+(]|^[0-9]{{3}}[ .-][0-9]{{3}}[ .-][0-9]{{4}}$' then {phone} "
        f"else {card} end"
    )


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text with pseudonyms, n_found (validated values replaced).

    E-mail names, phone numbers, social security numbers (area, group and serial not zero), payment cards (Luhn), IBANs (modulo 97),
    IPv4 addresses, calendar dates from 1600 to 2399 and long hexadecimal secrets are replaced by a permutation within their format
    under the key, so equal values have equal pseudonyms in all documents and different ones different. What comes out is valid again:
    cards keep a valid check digit, IBANs their country and valid check digits (02 to 98), phones their country code, dates are dates, and
    where the Feistel network leaves the valid values (security numbers, secrets, late dates) it is walked on to the next one. Slashed
    dates are dd/MM/yyyy, or MM/dd/yyyy where that fails. Of cards, IBANs and phones the longest valid part up to a separator counts; cards
    may also start after one. What fails validation stays.

    Whole texts, one pass, no shuffle. Null texts stay null with 0 found; empty texts, repeated rows and empty tables come back as they
    are. The key is 1 to 64 letters and digits.
    """
    if not key.isalnum() or not key.isascii() or len(key) > 64:
        raise ValueError("the key is 1 to 64 ASCII letters and digits")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    some = F.col("text").rlike("[0-9@]")  # every kind has a digit or an @
    hits = F.when(some, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
    docs = docs.withColumn("hits", hits)
    docs = docs.withColumn("names", F.when(F.size("hits") > 0, F.expr(f"transform(hits, m -> {pseudonym('m', key)})")))
    pieces = F.split("text", PATTERN, -1)
    joined = F.array_join(F.zip_with(pieces, F.concat("names", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    changed = F.size(F.filter(F.zip_with("hits", "names", lambda a, b: a != b), lambda x: x))
    got = F.col("names").isNotNull()
    return docs.select(
        "doc_id",
        F.when(got, joined).otherwise(F.col("text")).alias("text"),
        F.when(got, changed).otherwise(0).cast("long").alias("n_found"),
    )
