"""Format-preserving pseudonyms for personal data. DataFrame operations only.

Numbers and dates that pass their check are permuted within their format by a
keyed Feistel network, so the same value gets the same pseudonym in every
document, different values get different ones, and the key's owner can invert it:

* payment cards (13 to 19 digits, Luhn): all digits but the last are permuted,
  the check digit is computed anew; separators stay. Where a row of numbers
  fails the check as a whole, the cards in it (4-4-4-4, 4-6-5, 4-6-4, 4-3-3-3 or
  unbroken digits) are found one by one, and dates, telephone and social
  security numbers beside them;
* telephone numbers (+country (area) number, or 3-3-4 digits): the digits
  after the country code are permuted, signs stay;
* social security numbers 3-2-4 (no 000, 666, 9xx area, no zero group);
* IPv4 addresses (four octets up to 255): permuted as 32-bit numbers;
* dates (year-month-day, day/month/year or day.month.year that exist):
  permuted among the days from 1900-01-01 to 2099-12-31, same format;
* mail addresses: the letters and digits of the name become others, keyed by
  the address; its length, signs and the domain stay;
* secrets (an assignment of token, key, secret or password): letters and
  digits likewise.

The network works on numbers below 2^2h by halves of h bits and walks on
until the value is inside its domain (cycle walking), or on decimal digits by
halves. Rounds are keyed sha2 values. Everything is a SQL expression; a text is cut
at its matches, the matches are mapped and put back.

Null texts stay null, empty ones empty; texts without digits or signs of a
match are returned as they are. Very long texts are read whole. Repeated rows
map alike. A missing key is an error. Other columns stay; ``text`` is
replaced, ``n_pii`` and ``kinds`` are added or replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsift.llm.common import own_names

ROUNDS = 8
MAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"
SECRET = r"(?<=(?i:token|secret|key|passwd|password)\s{0,3}[=:]\s{0,3}[\"']?)[A-Za-z0-9_\-/+]{16,}"
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"
DATE = r"(?<!\d)(?:(?:19|20)\d\d-\d\d-\d\d|\d\d/\d\d/(?:19|20)\d\d|\d\d\.\d\d\.(?:19|20)\d\d)(?!\d)"
SSN = r"(?<![\d\-])(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?![\d\-])"
#: Digits with at most one sign between them: a card, or something that holds one.
RUN = r"(?<!\d)\d(?:[ \-]?\d){12,}+(?!\d)"
#: The usual groupings of cards, looked for within a run that is none as a whole.
GROUPED = r"\d{13,19}|\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{4}|\d{4}[ \-]\d{6}[ \-]\d{4,5}|\d{4}[ \-]\d{3}[ \-]\d{3}[ \-]\d{3}"
PHONE = r"\+\d{1,3}[ .\-]?\(?\d{2,4}\)?(?:[ .\-]?\d{2,4}){2,3}(?!\d)|(?<!\d)\(?\d{3}\)?[ .\-]\d{3}[ .\-]\d{4}(?!\d)"
KINDS = [("mail", MAIL), ("secret", SECRET), ("ip", IP), ("date", DATE), ("ssn", SSN), ("phone", PHONE), ("card", RUN)]
ALL = "|".join(f"(?:{p})" for _, p in KINDS)
ALL_SECRET = "|".join(f"({p})" if k == "secret" else f"(?:{p})" for k, p in KINDS)
WITHIN = "|".join(f"(?:{p})" for p in (DATE, SSN, PHONE))
DAYS = 73049  # 1900-01-01 to 2099-12-31


def _hash(key: str, tag: Column | str, r: Column, half: Column, modulus: Column) -> Column:
    """A keyed round value below ``modulus``."""
    tag = F.lit(tag) if isinstance(tag, str) else tag
    digest = F.sha2(F.concat_ws(":", F.lit(key), tag, r.cast("string"), half.cast("string"), modulus.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), modulus)


def _rounds(backwards: bool) -> Column:
    return F.array(*[F.lit(r) for r in (range(ROUNDS - 1, -1, -1) if backwards else range(ROUNDS))])


def feistel(value: Column, a: Column, b: Column, key: str, tag: Column | str, backwards: bool = False) -> Column:
    """A permutation of the numbers below a * b: halves modulo a and b take
    turns in being shifted by a keyed hash of the other."""
    start = F.struct(F.floor(value / b).cast("long").alias("l"), F.pmod(value, b).cast("long").alias("r"))
    sign = -1 if backwards else 1

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        left = F.when(even, F.pmod(s["l"] + sign * _hash(key, tag, i, s["r"], a), a)).otherwise(s["l"])
        right = F.when(even, s["r"]).otherwise(F.pmod(s["r"] + sign * _hash(key, tag, i, s["l"], b), b))
        return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    return F.aggregate(_rounds(backwards), start, step, lambda s: s["l"] * b + s["r"])


def _long(x: Column) -> Column:
    return x.cast("long")


def digits(d: Column, key: str, tag: str, backwards: bool = False) -> Column:
    """A permutation of strings of n digits (2 to 18), n kept."""
    n = F.length(d)
    a, b = _long(F.pow(F.lit(10.0), F.floor(n / 2))), _long(F.pow(F.lit(10.0), n - F.floor(n / 2)))
    # a * b can be past 2^53: split the string, not the number
    half = F.floor(n / 2).cast("int")
    start = F.struct(_long(F.substr(d, F.lit(1), half)).alias("l"), _long(F.substr(d, half + 1)).alias("r"))
    sign = -1 if backwards else 1

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        left = F.when(even, F.pmod(s["l"] + sign * _hash(key, tag, i, s["r"], a), a)).otherwise(s["l"])
        right = F.when(even, s["r"]).otherwise(F.pmod(s["r"] + sign * _hash(key, tag, i, s["l"], b), b))
        return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    done = F.aggregate(_rounds(backwards), start, step, lambda s: F.concat(F.lpad(s["l"].cast("string"), half, "0"), F.lpad(s["r"].cast("string"), n - half, "0")))
    return done


def luhn(d: Column) -> Column:
    """The Luhn sum of all digits modulo 10 (0: valid), from the right."""
    n = F.length(d)

    def step(acc: Column, i: Column) -> Column:
        x = F.substr(d, i, F.lit(1)).cast("int")
        twice = F.pmod(n - i, F.lit(2)) == 1
        return (acc + F.when(twice, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x)).cast("int")

    return F.pmod(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step), F.lit(10))


def _refill(template: Column, d: Column) -> Column:
    """The digits ``d`` in the places of the template's digits."""
    def step(acc: Column, c: Column) -> Column:
        isd = c.between("0", "9")
        return F.struct(F.concat(acc["out"], F.when(isd, F.substr(d, acc["i"], F.lit(1))).otherwise(c)).alias("out"), (acc["i"] + F.when(isd, 1).otherwise(0)).cast("int").alias("i"))

    return F.aggregate(F.split(template, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("i")), step, lambda s: s["out"])


def _scramble(value: Column, salt: Column, key: str, tag: str) -> Column:
    """Letters and digits become others of their kind, by a keyed hash of the
    whole value and the place."""
    def step(acc: Column, c: Column) -> Column:
        h = _hash(key, tag, acc["i"], salt, F.lit(260))
        pick = lambda alphabet, n: F.substr(F.lit(alphabet), F.pmod(h, F.lit(n)).cast("int") + 1, F.lit(1))
        new = F.when(c.between("0", "9"), pick("0123456789", 10)).when(c.between("a", "z"), pick("abcdefghijklmnopqrstuvwxyz", 26)).when(c.between("A", "Z"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 26)).otherwise(c)
        return F.struct(F.concat(acc["out"], new).alias("out"), (acc["i"] + 1).cast("int").alias("i"))

    return F.aggregate(F.split(value, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("i")), step, lambda s: s["out"])


def _only_digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def _card(m: Column, key: str, back: bool) -> Column:
    d = _only_digits(m)
    body = digits(F.substr(d, F.lit(1), F.length(d) - 1), key, "card", back)
    check = F.pmod(F.lit(10) - luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    return _refill(m, F.concat(body, check))


def _phone(m: Column, key: str, back: bool) -> Column:
    lead = F.regexp_extract(m, r"^(\+\d{1,3}(?=[ .\-(]))?", 0)
    rest = F.substr(m, F.length(lead) + 1)
    return F.concat(lead, _refill(rest, digits(_only_digits(rest), key, "phone", back)))


def _ip(m: Column, key: str, back: bool) -> Column:
    p = F.split(m, r"\.")
    v = F.aggregate(p, F.lit(0).cast("long"), lambda s, x: s * 256 + x.cast("long"))
    w = feistel(v, F.lit(65536), F.lit(65536), key, "ip", back)
    return F.concat_ws(".", *[F.pmod(F.shiftright(w, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])


def _day(m: Column) -> Column:
    part = lambda *a: F.concat_ws("-", *[F.substr(m, F.lit(i), F.lit(n)) for i, n in a])
    iso = F.when(F.substr(m, F.lit(5), F.lit(1)) == "-", m).otherwise(part((7, 4), (4, 2), (1, 2)))
    return F.datediff(F.try_to_date(iso, "yyyy-MM-dd"), F.lit("1900-01-01").cast("date"))


def _date(m: Column, key: str, back: bool) -> Column:
    # cycle walking in 271 x 270 = 73,170 >= 73,049 days: three turns leave less than one day in 10^8 outside
    one = lambda v: feistel(v, F.lit(271), F.lit(270), key, "date", back)
    day = F.aggregate(F.sequence(F.lit(1), F.lit(6)), one(_day(m).cast("long")), lambda v, _: F.when(v < DAYS, v).otherwise(one(v)))
    iso = F.date_add(F.lit("1900-01-01").cast("date"), day.cast("int"))
    form = F.when(F.substr(m, F.lit(5), F.lit(1)) == "-", F.date_format(iso, "yyyy-MM-dd")).when(F.substr(m, F.lit(3), F.lit(1)) == "/", F.date_format(iso, "dd/MM/yyyy")).otherwise(F.date_format(iso, "dd.MM.yyyy"))
    return form


def _ssn(m: Column, key: str, back: bool) -> Column:
    """Areas 001-665 and 667-899, groups 01-99, serials 0001-9999."""
    area, group, serial = (F.substr(m, F.lit(i), F.lit(n)).cast("long") for i, n in ((1, 3), (5, 2), (8, 4)))
    v = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9999 + serial - 1
    w = feistel(v, F.lit(898 * 99), F.lit(9999), key, "ssn", back)
    top = F.floor(w / 9999).cast("long")
    a = F.floor(top / 99).cast("long") + 1
    pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
    return F.concat_ws("-", pad(a + F.when(a >= 666, 1).otherwise(0), 3), pad(F.pmod(top, F.lit(99)) + 1, 2), pad(F.pmod(w, F.lit(9999)) + 1, 4))


def kind_of(m: Column) -> Column:
    """The kind of a match, null where its check fails."""
    whole = lambda p: m.rlike(f"^(?:{p})$")
    return (
        F.when(F.instr(m, "@") > 0, "mail")
        .when(whole(IP), "ip")
        .when(whole(DATE), F.when(_day(m).between(0, DAYS - 1), "date"))
        .when(whole(SSN), "ssn")
        .when(whole(PHONE), "phone")
        .when(whole(RUN), F.when(F.length(_only_digits(m)) <= 19, F.when(luhn(_only_digits(m)) == 0, "card")))
        .otherwise("secret")
    )


def _cut(m: Column) -> Column:
    """The pieces of a text between and at dates, social security and telephone
    numbers, as (m, k); k is null for what is none."""
    piece = lambda x, k: F.struct(x.alias("m"), k.cast("string").alias("k"))
    both = lambda a, b: F.array(piece(a, F.lit(None)), piece(F.coalesce(b, F.lit("")), F.when(b.isNotNull(), kind_of(b))))
    return F.flatten(F.zip_with(F.split(m, WITHIN, -1), F.regexp_extract_all(m, F.lit(f"({WITHIN})"), F.lit(1)), both))


def _within(m: Column) -> Column:
    """The pieces of a run of digits that is no card: cards in one of the usual
    groupings wherever they start, and what ``_cut`` finds beside them."""
    tried = F.regexp_extract_all(m, F.lit(rf"(?<!\d)(?=((?:{GROUPED})(?!\d)))"), F.lit(1))
    kind = "array<struct<m:string,k:string>>"
    piece = lambda x, k: F.array(F.struct(x.alias("m"), F.lit(k).cast("string").alias("k"))).cast(kind)

    def step(s: Column, c: Column) -> Column:
        at = F.regexp_instr(s["rest"], F.concat(F.lit(r"(?<!\d)"), c, F.lit(r"(?!\d)")))
        more = F.concat(s["out"], piece(F.substr(s["rest"], F.lit(1), at - 1), None), piece(c, "card"))
        taken = F.struct(more.alias("out"), F.substr(s["rest"], at + F.length(c)).alias("rest"))
        return F.when(at > 0, taken).otherwise(s)  # else it overlaps the card before

    start = F.struct(F.array().cast(kind).alias("out"), m.alias("rest"))
    pieces = F.aggregate(F.filter(tried, lambda c: luhn(_only_digits(c)) == 0), start, step, lambda s: F.concat(s["out"], piece(s["rest"], None)))
    return F.flatten(F.transform(pieces, lambda x: F.when(x["k"].isNull(), _cut(x["m"])).otherwise(F.array(x))))


def pseudonym(m: Column, kind: Column, key: str, backwards: bool = False) -> Column:
    """The pseudonym of a match of a kind (cards, phones, ssn, ip and dates
    can be turned back)."""
    name = F.substring_index(m, "@", 1)
    return (
        F.when(kind == "mail", F.concat(_scramble(name, m, key, "mail"), F.lit("@"), F.substring_index(m, "@", -1)))
        .when(kind == "ip", _ip(m, key, backwards))
        .when(kind == "date", _date(m, key, backwards))
        .when(kind == "ssn", _ssn(m, key, backwards))
        .when(kind == "phone", _phone(m, key, backwards))
        .when(kind == "card", _card(m, key, backwards))
        .when(kind == "secret", _scramble(m, m, key, "secret"))
        .otherwise(m)
    )


@own_names
def pseudonymise(docs: DataFrame, key: str, text: str = "text", backwards: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, ``n_pii`` and ``kinds``."""
    if not key:
        raise ValueError("a key is needed")
    keep = [c for c in docs.columns if c.lower() not in ("n_pii", "kinds")]
    t = F.col(text).cast("string")
    likely = t.rlike(r"\d[ .\-/)]?[ (]?\d|@|[=:]")
    found = F.when(likely, F.regexp_extract_all(t, F.lit(f"({ALL})"), F.lit(1)))
    rows = docs.select(*keep, found.alias("__m"))
    rows = rows.withColumn("__k", F.transform("__m", kind_of))
    # runs of digits that fail their check: secrets, or runs with other numbers in them
    odd = F.exists(F.arrays_zip("__m", "__k"), lambda x: x["__k"].isNull() & x["__m"].rlike(f"^{RUN}$"))
    rows = rows.withColumn("__s", F.when(odd, F.regexp_extract_all(t, F.lit(ALL_SECRET), F.lit(1))))

    def pieces(m: Column, i: Column) -> Column:
        k = F.get("__k", i)
        one = lambda k: F.array(F.struct(m.alias("m"), k.alias("k")))
        return F.when(k.isNotNull() | F.col("__s").isNull(), one(k)).when(F.get("__s", i) != "", one(F.lit("secret"))).when(m.rlike(f"^{RUN}$"), _within(m)).otherwise(one(k))

    rows = rows.withColumn("__t", F.transform("__m", pieces))
    rows = rows.withColumn("__p", F.when(F.size("__m") > 0, F.transform("__t", lambda x: F.array_join(F.transform(x, lambda y: F.coalesce(pseudonym(y["m"], y["k"], key, backwards), y["m"])), ""))))
    parts = F.split(t, ALL, -1)
    joined = F.when(F.size("__m") > 0, F.array_join(F.zip_with(parts, F.concat("__p", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")).otherwise(t)
    valid = F.filter(F.transform(F.flatten("__t"), lambda x: x["k"]), lambda k: k.isNotNull())
    return rows.select(
        *[joined.alias(c) if c == text else F.col(c) for c in keep],
        F.coalesce(F.when(F.size("__m") > 0, F.size(valid)), F.lit(0)).cast("long").alias("n_pii"),
        F.coalesce(F.when(F.size("__m") > 0, F.array_sort(F.array_distinct(valid))), F.array().cast("array<string>")).alias("kinds"),
    )
