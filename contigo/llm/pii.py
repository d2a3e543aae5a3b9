"""Personal data replaced by surrogates of the same type and format, by a keyed one-to-one mapping.

Detected: e-mail addresses, telephone numbers (international; national ones with brackets, a leading
0 or 1, or in groups of 3, 3 and 4 digits), IPv4 and IPv6 addresses, payment card numbers (with a valid
check digit), IBANs (with a valid check number), US social security numbers, MAC addresses,
secrets assigned to a key word (token, key, password, ...) with quotes or without, long hexadecimal or prefixed access
keys, dates of birth after words that say so, street addresses, and personal names: after a title, with a
listed given name before them, and every later or earlier mention of a word of such a name in the same text.

Every type has a finite set of values of the same format. A keyed Feistel network permutes
that set (values outside it are walked over), so the surrogate of an entity

* is the same wherever the entity stands, in any document and on any executor (coreference);
* is never the surrogate of another entity (distinctness), without a table of all entities;
* is not the entity itself: the step of the permuted order has no fixed point;
* keeps length, separators, letter case, script (Latin, Greek, Cyrillic; vowels stay vowels),
  check digits, address class and country; listed given names keep their gender, and other names
  their last letter, which marks it in many languages. Names are mapped word by word, so that a
  surname alone has the surrogate that it has after a given name.

``collisions`` checks that over a whole corpus all the same, by grouping distinct hashed
entities by surrogate (``op9_pii_surrogates`` runs it and returns ``n_shared``), and within each
document ``n_collisions`` counts surrogates that two entities share or that stand elsewhere in the text.

Where a surrogate would equal another entity of the same text, that is no collision of
surrogates: the other is replaced as well. Where it equals text that stays, the text is of
another kind, and ``n_collisions`` says so.

Edge cases: null stays null with 0 entities, empty texts stay empty; texts without entities are
returned as they are; repeated rows, and rows with equal or null ids, get results of their own;
of patterns that begin at one place the first in ``PATTERNS`` counts; an empty table gives no rows;
other columns aren't read. Very long texts are scanned whole, left to right.
"""

from __future__ import annotations

import bisect
import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Staging, lean, read_table

#: Stands for a secret of the caller's own; whoever knows it can undo the mapping.
DEMO_KEY = b"replace this key"
#: The session's setting that holds it.
KEY_SETTING = "spark.contigo.pii.key"
ROUNDS = 6
#: Rows whose old and new texts a worker holds at once.
SLICE = 1000


class Mapping:
    """A keyed permutation without fixed points of 0 .. n - 1, for each n and purpose."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, purpose: bytes, k: int, x: int, bits: int) -> int:
        size = -(-bits // 8)
        data, out = purpose + bytes([k]) + x.to_bytes(-(-max(x.bit_length(), 1) // 8), "big"), b""
        while len(out) < size:
            out += hashlib.blake2b(data + len(out).to_bytes(4, "big"), key=self.key, digest_size=min(64, size)).digest()
        return int.from_bytes(out[:size], "big") & (1 << bits) - 1

    def _permute(self, purpose: bytes, n: int, x: int, back: bool) -> int:
        half = max(1, -(-(n - 1).bit_length() // 2))
        mask = (1 << half) - 1
        while True:  # walk until inside
            a, b = x >> half, x & mask
            for k in range(ROUNDS):
                if back:
                    a, b = b ^ self._round(purpose, ROUNDS - 1 - k, a, half), a
                else:
                    a, b = b, a ^ self._round(purpose, k, b, half)
            x = a << half | b
            if x < n:
                return x

    def step(self, purpose: bytes, n: int, x: int) -> int:
        """The value after x in a secret order."""
        if n < 2:
            return x
        return self._permute(purpose, n, (self._permute(purpose, n, x, False) + 1) % n, True)

    def walk(self, purpose: bytes, n: int, x: int, ok: Callable[[int], bool]) -> int:
        """The next value in the secret order that is ok; x is."""
        y = self.step(purpose, n, x)
        while not ok(y):
            y = self.step(purpose, n, y)
        return y


#: Alphabets: a character is replaced by one of its own. Fixed values.
ALPHABETS = (
    "0123456789",
    "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ",
    "àáâãäåæèéêëìíîïòóôõöøùúûü", "çñýÿðþß", "ÀÁÂÃÄÅÆÈÉÊËÌÍÎÏÒÓÔÕÖØÙÚÛÜ", "ÇÑÝÐÞ",
    "αεηιουω", "βγδζθκλμνξπρσςτφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь", "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩЪЬ",
)
_PLACE = {c: (a, k) for a in ALPHABETS for k, c in enumerate(a)}
_HEX = {"0123456789abcdef": "abcdef", "0123456789ABCDEF": "ABCDEF"}

#: Given names by gender and script; those of one list stand in for each other. Fixed values.
GIVEN = (
    "Adam Alan Albert Carlos Charles Daniel David Eric Felix Frank George Hans Henry Jack Jacques James Jean John Jorge José Juan Karl Louis Luis Mark Martin Michael Miguel Otto Paul Pedro Peter Philip Pierre Richard Robert Stefan Thomas Walter William",
    "Alice Ana Anna Anne Barbara Carmen Catherine Charlotte Claire Clara Elena Elizabeth Emily Emma Eva Greta Helen Ingrid Isabel Jane Jeanne Julia Karen Laura Linda Lucia Maria Marie Martha Mary Monika Nancy Olga Rosa Sarah Sofia Sophie Susan Teresa Ursula",
    "Александр Алексей Андрей Борис Виктор Владимир Дмитрий Иван Михаил Николай Олег Пётр Сергей Юрий",
    "Анна Вера Галина Екатерина Елена Ирина Мария Наталья Нина Ольга Светлана Татьяна Юлия",
    "Αλέξανδρος Γιώργος Δημήτρης Ιωάννης Κώστας Νίκος Παύλος Πέτρος",
    "Άννα Αικατερίνη Ελένη Ευαγγελία Ιωάννα Μαρία Σοφία",
)
_GIVEN = {n: (names.split(), k) for names in GIVEN for k, n in enumerate(names.split())}
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Señor Señora Sr Sra Monsieur Madame Mme г-н г-жа κ."


def _by_shape(m: Mapping, purpose: bytes, text: str, hexadecimal: bool = False) -> str:
    """Every character replaced by one of its alphabet, all at once; other characters stay."""
    kinds = [(c, *(_hex_place(c, text) if hexadecimal else _PLACE.get(c, ("", 0)))) for c in text]
    n, x = 1, 0
    for _, a, k in kinds:
        if a:
            n, x = n * len(a), x * len(a) + k
    x = m.step(purpose + b"|" + "".join(a[:1] or c for c, a, _ in kinds).encode(), n, x)
    out = []
    for c, a, _ in reversed(kinds):
        if a:
            x, k = divmod(x, len(a))
            c = a[k]
        out.append(c)
    return "".join(reversed(out))


def _hex_place(c: str, text: str) -> tuple[str, int]:
    a = "0123456789ABCDEF" if re.search("[A-F]", text) and not re.search("[a-f]", text) else "0123456789abcdef"
    return (a, a.index(c)) if c in a else ("", 0)


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _refill(text: str, digits: str) -> str:
    at = iter(digits)
    return re.sub(r"\d", lambda _: next(at), text)


def luhn(digits: str) -> int:
    """The check sum modulo 10 of a number with its check digit; 0 if valid."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10


def iban_rest(text: str) -> int:
    """An IBAN's check: 1 if valid."""
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _email(m: Mapping, text: str) -> str:
    local, _, host = text.rpartition("@")
    labels = host.split(".")
    keep = 2 if labels[-2:-1] == ["example"] else 1  # reserved domains stay, and so does the top level
    head = ".".join(labels[:-keep])
    new = _by_shape(m, b"email", f"{local}@{head}") if head else _by_shape(m, b"email", local) + "@"
    return ".".join(x for x in (new, *labels[-keep:])) if head else new + ".".join(labels)


def _phone(m: Mapping, text: str) -> str:
    digits = _digits(text)
    if text.startswith("+"):
        country = len(re.match(r"\+(\d*)", text)[1])
        country = country if country <= 3 else 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGITS else 3
    else:  # 0 and 1 before a national number stay
        country = 1 if re.match(r"\(?0|1[ .\-(]", text) else 0
    own = digits[country:]
    zero = not text.startswith("+") and digits[country - 1 : country] != "1"  # whether (another) 0 leads must stay
    fictional = len(own) == 10 and own[3:6] == "555"
    if fictional:  # an exchange for examples stays one
        own = own[:3] + own[6:]
    kind = lambda x: len(own) == 10 and f"{x:010d}"[3:6] == "555"
    x = m.walk(b"phone%d%d" % (country, fictional) + digits[:country].encode(), 10 ** len(own), int(own), lambda y: (fictional or kind(y) == kind(int(own))) and (not zero or (y < 10 ** (len(own) - 1)) == (own[0] == "0")))
    own = f"{x:0{len(own)}d}"
    return _refill(text, digits[:country] + (own[:3] + "555" + own[3:] if fictional else own))


def _ip_class(x: int) -> int:
    a, b = x >> 24, x >> 16 & 255
    return 1 if a == 10 else 2 if (a, b) == (192, 168) else 3 if a == 172 and 16 <= b < 32 else 4 if a == 127 else 5 if (a, b) == (169, 254) else 6 if a >= 224 else 7 if a == 0 else 0


_IP_BASE = {1: (10 << 24, 1 << 24), 2: (192 << 24 | 168 << 16, 1 << 16), 3: (172 << 24 | 16 << 16, 1 << 20), 4: (127 << 24, 1 << 24), 5: (169 << 24 | 254 << 16, 1 << 16), 6: (224 << 24, 1 << 29), 7: (0, 1 << 24)}


def _ip(m: Mapping, text: str) -> str:
    a, b, c, d = map(int, text.split("."))
    x = a << 24 | b << 16 | c << 8 | d
    kind = _ip_class(x)
    if kind:
        base, n = _IP_BASE[kind]
        x = base + m.step(b"ip%d" % kind, n, x - base)
    else:
        x = m.walk(b"ip", 1 << 32, x, lambda y: not _ip_class(y))
    return f"{x >> 24}.{x >> 16 & 255}.{x >> 8 & 255}.{x & 255}"


def _card(m: Mapping, text: str) -> str:
    digits = _digits(text)
    n = len(digits) - 2  # the first digit tells the network, the last one checks
    body = digits[0] + f"{m.step(b'card' + digits[:1].encode(), 10**n, int(digits[1:-1])):0{n}d}"
    return _refill(text, body + str(-luhn(body + "0") % 10))


def _iban(m: Mapping, text: str) -> str:
    plain = text.replace(" ", "").upper()
    rest = _by_shape(m, b"iban" + plain[:2].encode(), plain[4:])
    new = plain[:2] + f"{98 - iban_rest(plain[:2] + '00' + rest):02d}" + rest
    at = iter(new)
    return "".join(c if c == " " else next(at) for c in text)


def _ssn_ok(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def _ssn(m: Mapping, text: str) -> str:
    return _refill(text, f"{m.walk(b'ssn', 10**9, int(_digits(text)), lambda y: _ssn_ok(f'{y:09d}')):09d}")


def _name(m: Mapping, text: str) -> str:
    out = []
    for word in text.split(" "):
        if word in _GIVEN:
            names, k = _GIVEN[word]
            out.append(names[m.step(b"given" + names[0].encode(), len(names), k)])
        else:
            keep = 1 if len(word) > 2 else 0
            purpose = b"name" + word[len(word) - keep :].encode()
            change = lambda w: _by_shape(m, purpose, w[: len(w) - keep]) + w[len(w) - keep :]  # noqa: B023, E731
            new = change(word)
            while new in _GIVEN:
                new = change(new)
            out.append(new)
    return " ".join(out)


def _ip6(m: Mapping, text: str) -> str:
    head, colon, rest = text.partition(":")  # the first group tells the kind of address
    return head + colon + _by_shape(m, b"ip6" + head.lower().encode(), rest, hexadecimal=True)


def _birth(m: Mapping, text: str) -> str:
    """Numbers up to 12 stay so, and so do those from 13 to 28, so that the order of day and month doesn't matter; days from 29 on go with months
    that have them; years stay within their decade."""
    parts = re.findall(r"\d+", text)
    numbers = [int(x) for x in parts]
    year = next((k for k, x in enumerate(parts) if len(x) == 4), len(parts) - 1)
    days = [x for k, x in enumerate(numbers) if k != year]
    late = max(days) > 28
    february = late and (2 in days or re.search("(?i)f[eé][bv]", text) is not None)
    months = [1, 3, 5, 7, 8, 10, 12] if 31 in days else [1, *range(3, 13)]
    sets = []
    for k, x in enumerate(numbers):
        if k == year:
            sets.append([x] if february else [x // 10 * 10 + d for d in range(10)])
        elif late and 0 < x < 13:
            sets.append([x] if february or x not in months else months)
        else:
            sets.append(list(range(1, 13)) if 0 < x < 13 else list(range(13, 29)) if 12 < x < 29 else [x])
    n, k = 1, 0
    for x, values in zip(numbers, sets):
        n, k = n * len(values), k * len(values) + values.index(x)
    k, out = m.step(b"birth" + repr([v[0] for v in sets]).encode() + re.sub(r"\d", "0", text).encode(), n, k), []
    for values in reversed(sets):
        k, i = divmod(k, len(values))
        out.append(values[i])
    at = iter(reversed(out))
    return re.sub(r"\d+", lambda x: f"{next(at):0{len(x[0])}d}", text)


def _street(m: Mapping, text: str) -> str:
    def change(x: re.Match) -> str:
        word = x[0]
        if word in STREET_WORDS:
            return word
        tail = next((t for t in STREET_TAILS if word.endswith(t) and word != t), "")
        return _by_shape(m, b"street", word[: len(word) - len(tail)]) + tail

    return re.sub(r"\w+", change, text)


_HEXES = re.compile(r"[0-9a-f]+|[0-9A-F]+")


def _secret(m: Mapping, text: str) -> str:
    if _HEXES.fullmatch(text):
        return _by_shape(m, b"secret", text, hexadecimal=True)
    head = re.match(r"(?:AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-|AIza)?", text)[0]
    return head + _by_shape(m, b"secret" + head.encode(), text[len(head) :])


def _mac(m: Mapping, text: str) -> str:
    return _by_shape(m, b"mac", text, hexadecimal=True)


#: Country codes of two digits; 1 and 7 stand alone, all others have three. Fixed values.
TWO_DIGITS = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())

_KEY_WORD = r"(?i:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|authorization|auth)"
#: A character of a value without quotes: marks only before another one.
_BARE = r"(?:[^\s\"'`<>,;&(){}\[\].:!?=]|[.:!?=](?=[^\s\"'`<>,;&(){}\[\]]))"

#: Words and endings of street names, in English, German, French and Spanish. Fixed values.
STREET_WORDS = set("Street St Avenue Ave Road Rd Lane Ln Boulevard Blvd Drive Court Square Terrace rue Rue avenue boulevard Calle Avenida Plaza de la del du des".split())
STREET_TAILS = ("straße", "strasse", "gasse", "allee", "platz", "weg")
_WORD = r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+"
_MONTH = r"(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sept?(?:ember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?|Januar|Februar|März|Mai|Juni|Juli|Oktober|Dezember|janvier|février|mars|avril|mai|juin|juillet|août|septembre|octobre|novembre|décembre|enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|octubre|noviembre|diciembre)"
_DATE = r"(?:(?:19|20)\d\d-\d\d-\d\d|\d{1,2}([./\-])\d{1,2}%s(?:19|20)?\d\d|\d{1,2}\.? (?:de )?" + _MONTH + r"(?: de)?,? (?:19|20)\d\d|" + _MONTH + r" \d{1,2},? (?:19|20)\d\d)(?!\d)"

#: type -> pattern; of those that begin at one place the first one counts. An entity is group 1 where there is one.
PATTERNS = {
    "email": r"[A-Za-z0-9_.+\-À-ÖØ-öø-ÿ]+@(?:[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}",
    "secret": _KEY_WORD + r"(?:\w*[\"']?\s*(?::=|=>|[:=])\s*[\"']([^\s\"']{6,})[\"']|(?![A-Za-z])(?:[_-]?\w+)?[\"']?\s*(?::=|=>|=(?!=)|:(?=\s*(?i:bearer\s+|basic\s+)?" + _BARE + r"*\d))\s*(?i:bearer\s+|basic\s+)?(" + _BARE + r"{6,}+)(?![(\[])|(?<=password)[ \t]*:[ \t]+(" + _BARE + r"{6,}+)(?=[ \t]*(?:[\r\n]|\Z)))",
    "access_key": r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9\-]{10,}|AIza[A-Za-z0-9_\-]{35}|[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9])",
    "mac": r"(?<![\w:])(?:[0-9A-F]{2}:){5}[0-9A-F]{2}(?![\w:])|(?<![\w:])(?:[0-9a-f]{2}:){5}[0-9a-f]{2}(?![\w:])",
    "ip6": r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:]|\.\d)",
    "birth": r"(?i:\b(?:born(?: on)?|date of birth|dob|birth ?date|geboren(?: am)?|geburtsdatum|née? le|date de naissance|nacid[oa] el|fecha de nacimiento))\s*:?\s+(" + _DATE % r"\2" + ")",
    "street": r"(?<![\w.,\-])\d{1,5} (?:" + _WORD + r" ){1,3}(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Boulevard|Blvd|Drive|Court|Square|Terrace)(?!\w)|(?<!\w)[A-ZÄÖÜ][a-zäöüß]+(?:straße|strasse|gasse|allee|platz|weg) \d{1,4}[a-z]?(?!\w)|(?<![\w.,\-])\d{1,4},? (?:rue|avenue|boulevard) (?:de la |du |des |de )?" + _WORD + r"(?!\w)|(?<!\w)(?:Calle|Avenida|Plaza) (?:de la |del |de )?" + _WORD + r",? \d{1,4}(?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "card": r"(?<![\w.\-])\d(?:[ \-]?\d){12,18}(?![\w\-]|\.\d)",
    "phone": "|".join((
        r"(?<![\w+])\+(?:1(?:\)?[ .\-/]?\(?\d){10}|[1-9]\d{7,14}|[1-9](?:\)?[ .\-/]?\(?\d){6,14})(?!\d)",
        r"(?<![\w+])(?:1[ .\-]?)?\(\d{2,5}\)[ .\-/]?(?:\d{3,4}[ .\-/]\d{3,4}|\d{6,8}|\d{2}(?:[ .\-/]\d{2}){2,4})(?![\w\-])",
        r"(?<![\w.+\-])(?:1[ .\-])?\d{3}[ .\-]\d{3}[ .\-]\d{4}(?![\w\-]|\.\d)",
        r"(?<![\w.,+\-/:])(?!0\d[./\-]\d\d[./\-](?:19|20)\d\d)0(?:0[1-9](?:[ .\-/]?\d){7,12}|[1-9](?:(?:[ .\-/](?=\d\d))?\d){7,10})(?![\w\-]|\.\d)",
    )),
    "name": r"(?<!\w)(?:" + "|".join(re.escape(t) for t in TITLES.split()) + r")\.? ((?:[A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΫА-ЯЁ][a-zß-öø-ÿά-ώа-яё]+)(?:[ ][A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΫА-ЯЁ][a-zß-öø-ÿά-ώа-яё]+)?)",
}


def _is_ip6(text: str) -> bool:
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return text.count(":") > 2 and any(c.isdigit() for c in text) and len(set(text)) > 2


_CHECK: dict[str, Callable[[str], bool]] = {
    "card": lambda t: 13 <= len(_digits(t)) <= 19 and luhn(_digits(t)) == 0 and len(set(_digits(t))) > 1,
    "iban": lambda t: iban_rest(t.replace(" ", "")) == 1,
    "ssn": lambda t: _ssn_ok(_digits(t)),
    "ip6": lambda t: _is_ip6(t),
}
_MAKE = {"email": _email, "secret": _secret, "access_key": _secret, "mac": _mac, "iban": _iban, "ip": _ip, "ssn": _ssn, "card": _card, "phone": _phone, "name": _name, "ip6": _ip6, "birth": _birth, "street": _street}
#: Without the pattern's own groups, whose numbers differ in one long pattern; a date's two separators are compared by _ONE.
_ALL = re.compile("|".join(f"(?P<{k}>{p.replace(chr(92) + '2', '[./' + chr(92) + '-]')})" for k, p in PATTERNS.items() if k != "name"))
_NAMES = re.compile(PATTERNS["name"])
_CAPITAL = r"[A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΫА-ЯЁ][a-zß-öø-ÿά-ώа-яё]+"
_FULL_NAMES = re.compile(r"(?<!\w)(?:" + "|".join(sorted(_GIVEN, key=len, reverse=True)) + r") " + _CAPITAL + r"(?!\w)")
_GIVEN_WORD = re.compile(r"(?<!\w)(?:" + "|".join(sorted(_GIVEN, key=len, reverse=True)) + r") [A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΫА-ЯЁ]")
_ONE = {k: re.compile(p) for k, p in PATTERNS.items()}
#: Without one of these a text holds no entity: digits, an address sign, a title before a capital, or a key word.
_ANY = re.compile(r"[0-9@]|::|" + _KEY_WORD)
_TITLE = re.compile("|".join(re.escape(t) for t in TITLES.split()))


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, type) of the entities, in order, not overlapping."""
    out: list[tuple[int, int, str]] = []
    if _ANY.search(text):
        at = 0
        while m := _ALL.search(text, at):
            kind = m.lastgroup
            at = m.end()
            if kind in ("secret", "birth"):
                inner = _ONE[kind].match(text, m.start())
                if inner is None:
                    at = m.start() + 1
                    continue
                start, end = inner.span(1 if kind == "birth" else inner.lastindex)
            else:
                start, end = m.span(kind)
            if kind in _CHECK and not _CHECK[kind](text[start:end]):
                if kind == "card" and (phone := _ONE["phone"].match(text, start)):
                    out.append((start, at := phone.end(), "phone"))
                else:
                    at = _next_part(text, m.start(), kind, out)
                continue
            out.append((start, end, kind))
    spans = [m.span(1) for m in _NAMES.finditer(text)] if _TITLE.search(text) else []
    if _GIVEN_WORD.search(text):
        spans += [m.span() for m in _FULL_NAMES.finditer(text)]
    if spans:
        words = {w for a, b in spans for w in text[a:b].split(" ") if len(w) > 2}
        if words:  # other mentions
            spans += [m.span() for m in re.finditer(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, words))) + r")(?!\w)", text)]
        taken = sorted((a, b) for a, b, _ in out)
        for a, b in sorted(set(spans), key=lambda x: (x[0], -x[1])):
            k = bisect.bisect_left(taken, (b,))
            if not k or taken[k - 1][1] <= a:
                bisect.insort(taken, (a, b))
                out.append((a, b, "name"))
        out.sort()
    return out


def _next_part(text: str, start: int, kind: str, out: list) -> int:
    """Where to look on after a number that fails its check: two numbers side by side may each pass on their own."""
    if kind != "card":
        return start + 1
    whole = _ONE["card"].match(text, start)
    end = whole.end() if whole else start + 1
    parts = [(m.start(), m.end()) for m in re.finditer(r"\d+", text[start:end])]
    for a, b in parts:
        if b - a >= 13 and _CHECK["card"](text[start + a : start + b]):
            out.append((start + a, start + b, "card"))
    return end if any(b - a >= 13 for a, b in parts) or len(parts) == 1 else start + parts[0][1]


def surrogates(text: str, mapping: Mapping, known: dict | None = None) -> tuple[str, list[tuple[str, str, str]]]:
    """The text with surrogates, and (type, entity, surrogate) of each entity."""
    out, done, at = [], [], 0
    known = {} if known is None else known
    for a, b, kind in find(text):
        entity = text[a:b]
        if (new := known.get((kind, entity))) is None:
            if len(known) > 50_000:
                known.clear()
            new = known[kind, entity] = _MAKE[kind](mapping, entity)
        out += [text[at:a], new]
        done.append((kind, entity, new))
        at = b
    return ("".join([*out, text[at:]]) if done else text), done


def _replaced(key: bytes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapping, known = Mapping(key), {}
        kind = pa.list_(pa.struct([("type", pa.string()), ("entity_hash", pa.int64()), ("surrogate", pa.string())]))
        hashed = lambda t, e: int.from_bytes(hashlib.blake2b(f"{t}|{e}".encode(), key=mapping.key, digest_size=8).digest(), "big", signed=True)
        for batch in batches:
            texts, counts, clashes, found = [], [], [], []
            for text in batch.column(1).to_pylist():
                new, done = surrogates(text, mapping, known) if text is not None else (None, [])
                pairs = {(t, e): s for t, e, s in done}
                clash = len(pairs) - len({(t, s) for (t, _), s in pairs.items()})
                if done:
                    clash += sum(1 for (_, e), s in pairs.items() if new.count(s) > sum(x[2].count(s) for x in done))
                texts.append(new)
                counts.append(len(done))
                clashes.append(clash)
                found.append([{"type": t, "entity_hash": hashed(t, e), "surrogate": s} for (t, e), s in pairs.items()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(clashes, pa.int64()), pa.array(found, kind)], ["doc_id", "text", "n_entities", "n_collisions", "entities"])

    return run


_SCHEMA = "doc_id long, text string, n_entities long, n_collisions long, entities array<struct<type string, entity_hash long, surrogate string>>"


def replace_pii(docs: DataFrame, key: bytes = DEMO_KEY) -> DataFrame:
    """doc_id, text, n_entities, n_collisions, entities (type, keyed hash, surrogate of each distinct one)."""
    return docs.select("doc_id", "text").mapInArrow(lean(_replaced(key)), _SCHEMA)


def collisions(replaced: DataFrame) -> DataFrame:
    """type, surrogate, n of surrogates that more than one entity has anywhere in the corpus: no rows, if the mapping is what it says."""
    each = replaced.select(F.explode("entities").alias("e")).select("e.*").distinct()
    return each.groupBy("type", "surrogate").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def with_surrogates(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """The rows of docs with surrogates in their text, and n_chars, if there is one, as of the new text. No join: the other columns go along."""
    names, rest = docs.columns, [c for c in docs.columns if c not in ("doc_id", "text")]
    schema, key = docs.schema, key_of(docs.sparkSession) if key is None else key

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapping, known = Mapping(key), {}
        for batch in (whole.slice(k, SLICE) for whole in batches for k in range(0, whole.num_rows, SLICE)):
            at = batch.schema.get_field_index("text")
            new = [surrogates(t, mapping, known)[0] if t is not None else None for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(new, pa.string())
            if "n_chars" in rest:
                k = batch.schema.get_field_index("n_chars")
                columns[k] = pa.array([None if t is None else len(t) for t in new], batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(lean(run), schema)


def key_of(spark: SparkSession) -> bytes:
    """The caller's key from the session's setting, the demonstration's where none is set."""
    return spark.conf.get(KEY_SETTING, DEMO_KEY.decode()).encode()


def with_shared(replaced: DataFrame) -> DataFrame:
    """The rows (doc_id, entities, ...) of a written table with n_shared: how many of their entities have a surrogate that another entity has anywhere."""
    shared = collisions(replaced)
    if not shared.limit(1).count():
        return replaced.withColumn("n_shared", F.lit(0).cast("long"))
    each = replaced.select("doc_id", F.explode("entities").alias("e")).select("doc_id", "e.type", "e.surrogate")
    n = each.join(shared.select("type", "surrogate"), ["type", "surrogate"]).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_shared"))
    return replaced.join(n, "doc_id", "left").withColumn("n_shared", F.coalesce("n_shared", F.lit(0)))


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = with_shared(Staging(spark, "pii").write(replace_pii(read_table(spark, sf_dir, "documents"), key_of(spark)), "replaced"))
    return out.select("doc_id", "text", "n_entities", "n_collisions", "n_shared", F.array_join(F.array_sort(F.array_distinct(F.transform("entities", lambda e: e["type"]))), ",").alias("types"))
