r"""Pseudonyms for personal data that keep the format: keyed Feistel permutations of validated numbers and dates.

DataFrame functions only.  Mail addresses, secrets and IBANs are found first, the other formats in the text between
them; what validates is replaced, the rest of the text stays byte for byte.  Equal values get equal pseudonyms under one key, in whichever document they stand, and different
values of a format get different ones:

* payment cards (13 to 19 digits, Luhn): all digits but the last are permuted, the check digit is computed anew; in a
  longer run of digit groups (a card beside its expiry or other numbers) each span of whole groups is tried, cards'
  usual groupings first, then longer spans;
* IBANs (their country's length, or one unspaced word; mod 97): the account's digits are permuted, letters stay, check
  digits are computed anew;
* phones (``+`` and 8 to 15 digits, or the 3-3-4 form): digits after the country code;
* social security numbers (3-2-4, no area 000, 666, 9xx, no zero group or serial): the 9 digits;
* IPv4 addresses: the 32 bits;
* dates (``YYYY-MM-DD``, ``DD.MM.YYYY``, ``MM/DD/YYYY``) from 1900-01-01 on, 272 x 272 days: the day's number.

Mail addresses and secrets (access keys, ``password=`` and the like with a digit in the value) have no such format:
keyed digests take their place, of the same shape and also equal for equal values.

Rounds are taken by ``aggregate`` over the round numbers with SHA-256 of key, format, round and half as the round
function.  Whoever has the key can undo the permutations; it is a parameter and never in the result.

Cases: a null text stays null, an empty one empty; texts of any length are handled whole; repeated rows are alike;
further columns stay; a column ``n_pii`` of the input is replaced.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 10
#: Session setting that names the key.
KEY_SETTING = "spark.merchant_signals.pii.key"

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@[\p{L}\p{M}\p{N}-]++(?:\.[\p{L}\p{M}\p{N}-]++)+"
ACCESS_KEY = r"\bAKIA[0-9A-Z]{16}\b"
SECRET = r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key))[=:](?=\S*[0-9])\S{5,}[^\s.,;:!?)\]}\"'>]"
#: Lengths of the countries' IBANs.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    25: "AO|CV|GW|LY|MZ|PT|ST", 26: "DZ|IR|IS|TR", 27: "BI|CF|CG|CM|DJ|FR|GA|GQ|GR|IT|KM|MC|MG|MR|SM|TD",
    28: "AL|AZ|BF|BJ|BY|CI|CY|DO|GT|HN|HU|LB|MA|ML|NE|NI|PL|SN|SV|TG", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC",
    32: "LC", 33: "RU"}


def _ibans(stop: str) -> str:
    """IBANs of their country's length, in groups of four; no group starts what ``stop`` matches."""
    def form(n: int, countries: str) -> str:
        last = f"(?: ?{stop}[A-Z0-9]{{{n % 4}}})" if n % 4 else ""
        return f"(?:{countries})[0-9]{{2}}(?: ?{stop}[A-Z0-9]{{4}}){{{n // 4 - 1}}}{last}"

    return rf"\b(?:{'|'.join(form(n, c) for n, c in IBAN_LENGTHS.items())})\b"


IBAN = rf"(?:{_ibans(f'(?!{_ibans(str())})')}|\b[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{8,31}}\b)"
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
DATE = r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = (r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])"
         r"|(?<![0-9(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9.-])[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}(?![0-9-])")
#: Groups of digits, 13 or more in all, up to a group at which a value of another format starts.
CARD = rf"(?<![0-9])[0-9](?:[0-9]|[ -](?!{IPV4}|{DATE}|{SSN}|{PHONE.replace(chr(92) + '1', chr(92) + 'k<sep>').replace('([ .-])', '(?<sep>[ .-])')})[0-9]){{12,}}+"
#: What validates or is replaced in any case; what is looked for between such values.
FIRST_PATTERN = "|".join([EMAIL, ACCESS_KEY, SECRET, IBAN])
PATTERN = "|".join([IPV4, DATE, SSN, PHONE, CARD])
#: Groupings that cards are written in.
CARD_FORM = r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})[ -]?$"

#: Days of the permuted range, 272 x 272, and its first.
DAY_SIDE, FIRST_DAY = 272, "1900-01-01"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _round(key: str, kind: Column | str, i: Column, half: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    h = F.sha2(F.concat_ws("|", F.lit(key), kind, i.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def _feistel(key: str, kind: Column | str, a: Column, b: Column, size_a: Column, size_b: Column) -> Column:
    """Permutes the pair (a, b) of 0 <= a < size_a, 0 <= b < size_b."""
    def step(s: Column, i: Column) -> Column:
        size = F.when(i % 2 == 0, size_a).otherwise(size_b)
        return F.struct(s["b"].alias("a"), ((s["a"] + _round(key, kind, i, s["b"])) % size).alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, step)


def permuted_digits(key: str, kind: str, d: Column) -> Column:
    """Another string of as many digits (2 to 34)."""
    n = F.length(d)
    u = (n / 2).cast("int")
    size = lambda k: F.rpad(F.lit("1"), k + 1, "0").cast("long")
    out = _feistel(key, F.concat(F.lit(kind), n.cast("string")), F.substring(d, F.lit(1), u).cast("long"),
                   F.substring(d, u + 1, n).cast("long"), size(u), size(n - u))
    joined = F.transform(F.array(out), lambda s: F.concat(F.lpad(s["a"].cast("string"), u, "0"),
                                                          F.lpad(s["b"].cast("string"), n - u, "0")))
    return F.when(n >= 2, joined[0]).otherwise(d)


def _with_digits(form: Column, d: Column) -> Column:
    """``form`` with its digits replaced by those of ``d``, in order."""
    chars = F.transform(F.sequence(F.lit(1), F.length(form)), lambda i: F.struct(
        F.substring(form, i, F.lit(1)).alias("c"), F.length(_digits(F.substring(form, F.lit(1), i))).alias("k")))
    return F.array_join(F.transform(chars, lambda x: F.when(x["c"].rlike("^[0-9]$"), F.substring(d, x["k"], F.lit(1)))
                                    .otherwise(x["c"])), "")


def luhn_digit(body: Column) -> Column:
    """The check digit that follows ``body``."""
    def value(i: Column) -> Column:
        d = F.substring(body, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((F.length(body) - i) % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(body)), F.lit(0), lambda a, i: a + value(i))
    return ((F.lit(10) - total % 10) % 10).cast("string")


def _let(value: Column, f) -> Column:
    """``f`` of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


def _counted(text: Column, n: Column) -> Column:
    return F.struct(text.alias("t"), n.cast("long").alias("n"))


def _card(key: str, m: Column) -> Column:
    """The run of groups with its cards replaced, and their number."""
    def masked(span: Column) -> Column:
        def new(d: Column) -> Column:
            body = _let(permuted_digits(key, "card", F.substring(d, F.lit(1), F.length(d) - 1)), lambda b: F.concat(b, luhn_digit(b)))
            return _let(body, lambda x: _with_digits(span, x))

        return _let(_digits(span), new)

    def spans(group: Column, i: Column) -> Column:
        """Of the spans that start with a group, those that are cards: last group and whether the grouping is usual."""
        near = F.transform(F.sequence(F.lit(1), F.least(F.lit(19), F.size(group) - i)), lambda n: F.struct(
            n.alias("n"), F.array_join(F.slice(group, i + 1, n), "").alias("span")))
        valid = F.filter(near, lambda x: _let(_digits(x["span"]), lambda d: F.when(
            F.length(d).between(13, 19), luhn_digit(F.substring(d, F.lit(1), F.length(d) - 1)) == F.substring(d, F.length(d), F.lit(1)))
            .otherwise(False)))
        return F.transform(valid, lambda x: F.struct(x["n"].alias("n"), x["span"].rlike(CARD_FORM).alias("usual")))

    def chosen(found: Column) -> Column:
        """First group and number of groups of each card: usual groupings before others, longer before shorter."""
        usual = lambda x: x["usual"]

        def best(own: Column, i: Column) -> Column:
            free = F.filter(own, lambda x: ~F.exists(F.flatten(F.slice(found, i + 2, x["n"] - 1)), usual))
            return F.coalesce(F.array_max(F.filter(own, usual))["n"], F.array_max(free)["n"], F.lit(0))

        def step(s: Column, x: Column) -> Column:
            take = (x["n"] > 0) & (x["i"] >= s["end"])
            return F.struct(F.when(take, x["i"] + x["n"]).otherwise(s["end"]).alias("end"),
                            F.when(take, F.concat(s["all"], F.array(x))).otherwise(s["all"]).alias("all"))

        each = F.filter(F.transform(found, lambda own, i: F.struct(i.alias("i"), best(own, i).alias("n"))), lambda x: x["n"] > 0)
        start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<i:int,n:int>>").alias("all"))
        return F.aggregate(each, start, step, lambda s: s["all"])

    def written(group: Column, cards: Column) -> Column:
        end = lambda k: F.when(k > 0, F.get(cards, k - 1)["i"] + F.get(cards, k - 1)["n"]).otherwise(0)
        between = lambda lo, n: F.array_join(F.slice(group, lo + 1, n), "")
        parts = F.transform(cards, lambda c, k: F.concat(between(end(k), c["i"] - end(k)), masked(between(c["i"], c["n"]))))
        last = end(F.size(cards))
        return _counted(F.concat(F.array_join(parts, ""), between(last, F.size(group) - last)), F.size(cards))

    def run(group: Column) -> Column:
        found = F.transform(group, lambda g, i: spans(group, i))
        return _let(_let(found, chosen), lambda cards: written(group, cards))

    return _let(F.regexp_extract_all(m, F.lit("[0-9]+[ -]?"), F.lit(0)), run)


def _mod97(s: Column) -> Column:
    def step(a: Column, i: Column) -> Column:
        c = F.substring(s, i, F.lit(1))
        return F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), step)


def _iban(key: str, m: Column) -> Column:
    def masked(s: Column) -> Column:
        country, account = F.substring(s, F.lit(1), F.lit(2)), F.substring(s, F.lit(5), F.length(s))
        new = _let(permuted_digits(key, "iban", _digits(account)), lambda d: _with_digits(account, d))
        full = _let(new, lambda x: F.concat(F.lpad((F.lit(98) - _mod97(F.concat(x, country, F.lit("00")))).cast("string"), 2, "0"), _digits(x)))
        right = _mod97(F.concat(account, F.substring(s, F.lit(1), F.lit(4)))) == 1
        return F.when(right & (F.length(_digits(account)) >= 6), _let(full, lambda d: _with_digits(m, d))).otherwise(m)

    return _let(F.regexp_replace(m, " ", ""), masked)


def _phone(key: str, m: Column) -> Column:
    code = F.regexp_extract(m, r"^\+(?:[0-9]{1,3}(?=[ .(-])|[0-9]{2})", 0)
    rest = F.substring(m, F.length(code) + 1, F.length(m))
    n = F.length(_digits(m))
    return F.when((n >= 8) & (n <= 15), F.concat(code, _let(permuted_digits(key, "phone", _digits(rest)), lambda d: _with_digits(rest, d)))).otherwise(m)


def _ssn(key: str, m: Column) -> Column:
    right = ~m.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.when(right, _let(permuted_digits(key, "ssn", _digits(m)), lambda d: _with_digits(m, d))).otherwise(m)


def _ipv4(key: str, m: Column) -> Column:
    def masked(o: Column) -> Column:
        out = _feistel(key, "ipv4", o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536))
        byte = lambda v, k: F.pmod((v / k).cast("long"), F.lit(256)).cast("string")
        joined = _let(out, lambda s: F.concat_ws(".", byte(s["a"], 256), byte(s["a"], 1), byte(s["b"], 256), byte(s["b"], 1)))
        return F.when(F.forall(o, lambda x: x < 256), joined).otherwise(m)

    return _let(F.transform(F.split(m, r"\."), lambda x: x.cast("int")), masked)


def _date(key: str, m: Column) -> Column:
    form = F.when(m.rlike("-"), F.lit("yyyy-MM-dd")).when(m.rlike("/"), F.lit("MM/dd/yyyy")).otherwise(F.lit("dd.MM.yyyy"))
    year = F.when(m.rlike("-"), F.substring(m, 1, 4)).otherwise(F.substring(m, 7, 4))
    month = F.when(m.rlike("/"), F.substring(m, 1, 2)).when(m.rlike("-"), F.substring(m, 6, 2)).otherwise(F.substring(m, 4, 2))
    day = F.when(m.rlike("/"), F.substring(m, 4, 2)).when(m.rlike("-"), F.substring(m, 9, 2)).otherwise(F.substring(m, 1, 2))
    number = F.datediff(F.concat_ws("-", year, month, day).try_cast("date"), F.lit(FIRST_DAY).cast("date"))

    def masked(x: Column) -> Column:
        out = _feistel(key, "date", (x / DAY_SIDE).cast("long"), x % DAY_SIDE, F.lit(DAY_SIDE), F.lit(DAY_SIDE))
        new = _let(out, lambda s: F.date_add(F.lit(FIRST_DAY).cast("date"), (s["a"] * DAY_SIDE + s["b"]).cast("int")))
        text = _let(new, lambda d: F.when(form == "yyyy-MM-dd", F.date_format(d, "yyyy-MM-dd"))
                    .when(form == "MM/dd/yyyy", F.date_format(d, "MM/dd/yyyy")).otherwise(F.date_format(d, "dd.MM.yyyy")))
        return F.when((x >= 0) & (x < DAY_SIDE * DAY_SIDE), text).otherwise(m)

    return _let(number, masked)


def _digest(key: str, kind: str, m: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), m), 256)


def _email(key: str, m: Column) -> Column:
    h = _digest(key, "email", F.lower(m))
    return F.concat(F.lit("u"), F.substring(h, 1, 12), F.lit("@"), F.substring(h, 13, 8), F.lit(".example"))


def _access_key(key: str, m: Column) -> Column:
    return F.concat(F.lit("AKIA"), F.upper(F.substring(_digest(key, "access-key", m), 1, 16)))


def _secret(key: str, m: Column) -> Column:
    name = F.regexp_extract(m, r"^[^=:]*[=:]", 0)
    value = F.substring(m, F.length(name) + 1, F.length(m))
    return F.concat(name, F.substring(_digest(key, "secret", value), F.lit(1), F.least(F.length(value), F.lit(64))))


def _whole(m: Column, pattern: str) -> Column:
    return m.rlike(f"^(?:{pattern})$")


def first_pseudonym(key: str, m: Column) -> Column:
    """What stands for a match of FIRST_PATTERN: another value of its format, or null if it doesn't validate."""
    iban = _let(_iban(key, m), lambda x: F.when(x != m, x))
    return (F.when(m.contains("@") & _whole(m, EMAIL), _email(key, m)).when(_whole(m, ACCESS_KEY), _access_key(key, m))
            .when(_whole(m, SECRET), _secret(key, m)).otherwise(iban))


def pseudonym(key: str, m: Column) -> Column:
    """What stands for a match of PATTERN, and the number of values replaced: other values of the format, or the match
    if nothing in it validates."""
    other = (F.when(_whole(m, IPV4), _ipv4(key, m)).when(_whole(m, DATE), _date(key, m))
             .when(_whole(m, SSN), _ssn(key, m)).when(_whole(m, PHONE), _phone(key, m)))
    return _let(other, lambda x: F.when(x.isNull(), _card(key, m)).otherwise(_counted(x, (x != m).cast("int"))))


def _scanned(key: str, text: Column) -> Column:
    """A text's values of PATTERN replaced, and their number."""
    def joined(new: Column) -> Column:
        parts = F.zip_with(F.split(text, PATTERN, -1), new, lambda p, x: F.concat(p, F.coalesce(x["t"], F.lit(""))))
        return _counted(F.array_join(parts, ""), F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x["n"]))

    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    return _let(F.transform(found, lambda m: pseudonym(key, m)), joined)


def key_of(spark: SparkSession) -> str:
    """The session's key.  Where none is set, a random one, kept in the setting: values stay linked in this application
    and nobody can undo the permutations later."""
    if not spark.conf.get(KEY_SETTING, None):
        spark.conf.set(KEY_SETTING, secrets.token_hex(32))
    return spark.conf.get(KEY_SETTING)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The text with pseudonyms, and n_pii, the number of values replaced."""
    kept = [c for c in docs.columns if c.lower() != "n_pii"]
    text = F.col(text_col).cast("string")
    none = F.array().cast("array<string>")
    found = docs.select(*kept, F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(FIRST_PATTERN), F.lit(0)))
                        .otherwise(none).alias("__m"))
    new = found.select(*kept, "__m", F.transform("__m", lambda m: first_pseudonym(key, m)).alias("__n"))
    # a match that doesn't validate is text like what stands around it
    pieces = F.when(F.size("__m") > 0, F.flatten(F.zip_with(F.split(text, FIRST_PATTERN, -1), "__m", lambda p, m: F.array(p, F.coalesce(m, F.lit(""))))))
    done = F.filter(F.transform("__n", lambda x, k: F.struct((2 * k + 1).alias("k"), x.alias("x"))), lambda d: d["x"].isNotNull())
    new = new.select(*kept, pieces.alias("__p"), done.alias("__d"))
    low = lambda k: F.when(k > 0, F.get("__d", k - 1)["k"] + 1).otherwise(0)
    between = F.transform(F.sequence(F.lit(0), F.size("__d")), lambda k: F.array_join(
        F.slice("__p", low(k) + 1, F.coalesce(F.get("__d", k)["k"], F.size("__p")) - low(k)), ""))
    plain = F.when(F.size("__d") > 0, between).otherwise(F.array(text))
    scanned = F.when(text.rlike("[0-9@]"), F.transform(plain, lambda p: _scanned(key, p)))
    new = new.select(*kept, "__d", scanned.alias("__s"))
    whole = F.array_join(F.zip_with("__s", "__d", lambda p, d: F.concat(p["t"], F.coalesce(d["x"], F.lit("")))), "")
    n = F.size("__d") + F.coalesce(F.aggregate("__s", F.lit(0).cast("long"), lambda a, x: a + x["n"]), F.lit(0))
    return new.select(*[F.coalesce(whole, text).alias(c) if c == text_col else F.col(c) for c in kept], n.cast("long").alias("n_pii"))
