"""PII: surrogates for detected entities.

Every entity is replaced by a keyed surrogate of its own type, script and format. Numbers, keys and addresses go through a
keyed Feistel permutation of all strings of their form (digits stay digits, hex stays hex, a card keeps its issuer digit
and its Luhn remainder, an address its punctuation, a telephone number its country code), so distinct entities get
distinct surrogates by construction and one entity gets the same surrogate wherever it occurs. First names are permuted
inside the list of their gender and script; family names keep case and the pattern of vowels and consonants of their script,
and Slavic ones their ending, so that both genders of a name share the surrogate's stem. IBANs keep country and valid
check digits. A name that is found once in a document is replaced wherever it stands alone in it.
Letters of other scripts, and accented ones, are permuted among their like: letters of their script and case near them in
Unicode, accented Latin ones apart by vowels and consonants.

The check for collisions covers the whole corpus: distinct entities and their surrogates are joined on the surrogate; one
that equals an entity of the input is drawn again under the next tweaks until it equals neither an entity nor another's
surrogate. A format that the input fills so far that no draw is free any more (about half its strings) falls back on one
permutation for all its entities: they stay distinct by construction and, where a draw allows it, none keeps its own
value, but a surrogate may then equal another entity of the input. The few redrawn ones reach the tasks as a broadcast
up to a stated size and by a join on the document beyond it.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, shuffle_partitions, table

DEMO_KEY = b"not a secret: pass a key of your own"  # of the registered query alone; operators have no default
BROADCAST_ENTITIES, DRAWS, DRAW_ROWS = 100_000, 16, 20_000
_HEX = re.compile(r"(?=.*\d)(?=.*[a-f])[0-9a-f]+")

# first names by script and gender (fixed values)
NAMES = {
    ("latin", "f"): "Alice Amelia Barbara Carmen Charlotte Claire Elena Elizabeth Emma Florence Hannah Helen Isabelle Jessica Julia Karen Laura Linda Lucia Margaret Maria Martha Nancy Olivia Patricia Rebecca Sarah Sofia Susan Victoria Aisha Anjali Fatima Priya Yuki Mei Ananya Leila Ingrid Chloe Camille Giulia Ursula Sabine Petra Monika Ewa Agnieszka Zainab Amina".split(),
    ("latin", "m"): "Andrew Anthony Antoine Carlos Charles Daniel David Edward Felix Frank George Henry James John Joseph Juan Kevin Klaus Louis Mark Michael Pablo Patrick Paul Peter Richard Robert Stephen Thomas William Mohammed Ahmed Ali Omar Wei Hiroshi Kenji Raj Arjun Vikram Sanjay Ivan Sergei Dmitri Jan Piotr Lars Sven Jürgen Wolfgang Stefan Pierre Giovanni Marco Diego Luis Hans".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("cyrillic", "m"): "Алексей Андрей Борис Виктор Владимир Дмитрий Иван Михаил Николай Павел Сергей Юрий".split(),
}
# endings of family names by gender (fixed values)
ENDINGS = tuple(sorted(("ov", "ova", "ev", "eva", "ski", "ska", "sky", "skaya", "ов", "ова", "ев", "ева", "ин", "ина", "ский", "ская"), key=len, reverse=True))
VOWELS = {"latin": "aeiou", "cyrillic": "аеиоуыэюя"}
CONSONANTS = {"latin": "bcdfghjklmnpqrstvwxyz", "cyrillic": "бвгджзклмнпрстфхцчшщ"}
_GENDER = {name: key for key, names in NAMES.items() for name in names}
_FIRST = "|".join(sorted(_GENDER, key=len, reverse=True))
# letters that are dealt out whole; others go by pages of 256
BLOCKS = ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0x20000, 0x2A6DF))
_TITLE = r"(?:Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.? "
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

# what is looked for, first match counts
PATTERNS = (
    ("email", r"(?<![\w.+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-])"),
    ("secret", r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b[\"']?\s?[=:]\s?[\"']?)(?P<secret>[A-Za-z0-9_\-/+]{8,})"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("aws_key", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"),
    ("hex_key", r"(?<![A-Za-z0-9])(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{32,64}(?![A-Za-z0-9])"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\w)|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\w)|(?<![\w.-])\d{3}(?P<sep>[-.])\d{3}(?P=sep)\d{4}(?![\w-])"),
    ("card", r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])"),
    ("ipv6", r"(?<![\w:.])(?=[0-9A-Fa-f:]*\d)[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*:(?::?[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)(?![\w:])"),
    ("ip", rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)"),
    ("name", rf"(?:(?<=\b){_TITLE})?\b(?P<first>{_FIRST}) (?P<last>[^\W\d_a-zа-яß][^\W\d_]+)|(?<=\b){_TITLE}(?P<only>[^\W\d_a-z][^\W\d_]+)"),
)
FINDER = re.compile("|".join(f"(?P<t_{kind}>{pattern})" for kind, pattern in PATTERNS if kind != "name"))
NAME = re.compile(dict(PATTERNS)["name"])
_SIGN, _CAPITALS = re.compile(r"[@\d]|AKIA|ASIA|(?i:pass|pwd|secret|token|key)"), re.compile(r"[A-ZА-Я]\w+")
_CUES = frozenset([*_GENDER, "Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Mme", "Sr", "Sra"])


_OTHER_DIGIT = re.compile(r"(?![0-9])\d")
# the decimal digits of all other scripts, each to its ASCII digit
_DIGITS = {c: str(int(chr(c))) for c in range(0x80, 0x20000) if chr(c).isdecimal()}


def fold(text: str) -> str:
    """The text with every script's decimal digits as ASCII ones, place by place."""
    return text if text.isascii() or not _OTHER_DIGIT.search(text) else text.translate(_DIGITS)


def in_script_of(value: str, made: str) -> str:
    """``made`` with its digits in the scripts of the digits that stand at their places in ``value``."""
    return "".join(chr(ord(v) - int(v) + int(m)) if v.isdecimal() and m.isdecimal() else m for v, m in zip(value, made, strict=True))


def find(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, type, value) of the entities in order; names give one entity for each of their parts. Digits of any script count."""
    if not text:
        return []
    whole, text = text, fold(text)
    found = _find(text)
    return found if whole is text else [(a, b, kind, whole[a:b]) for a, b, kind, _ in found]


def _find(text: str) -> list[tuple[int, int, str, str]]:
    out = []
    m = FINDER.search(text) if _SIGN.search(text) else None
    while m:
        kind = next(k for k, _ in PATTERNS if k != "name" and m[f"t_{k}"] is not None)
        fits = _VALID.get(kind, lambda v: True)(m[0])
        if fits:
            span = m.span("secret") if kind == "secret" else m.span()
            out.append((*span, kind, text[span[0] : span[1]]))
        m = FINDER.search(text, m.end() if fits else m.start() + 1)
    if not _CUES.isdisjoint(_CAPITALS.findall(text)):
        named = [(*m.span(part), what, m[part]) for m in NAME.finditer(text) for part, what in (("first", "first_name"), ("last", "last_name"), ("only", "last_name")) if m[part] is not None]
        if named:
            kinds = {n[3]: n[2] for n in reversed(named)}
            again = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(kinds, key=len, reverse=True)))})(?!\w)")
            at = {n[0] for n in named}
            named += [(*m.span(), kinds[m[0]], m[0]) for m in again.finditer(text) if m.start() not in at]
            taken = sorted((a, b) for a, b, _, _ in out)
            starts = [a for a, _ in taken]

            def free(a: int, b: int) -> bool:
                i = bisect_left(starts, b) - 1
                return i < 0 or taken[i][1] <= a

            out = sorted(out + [n for n in named if free(n[0], n[1])])
    return out


def mod97(iban: str) -> int:
    """The remainder that check digits bring to 1: country and check digits last, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _address(value: str) -> bool:
    try:
        return value.count(":") >= 2 and ipaddress.IPv6Address(value) is not None
    except ValueError:
        return False


def luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


_VALID = {
    "card": lambda v: luhn(re.sub(r"\D", "", v)) == 0 or re.fullmatch(r"\d{16}", v) is not None,
    "iban": lambda v: 15 <= len(v.replace(" ", "")) <= 34 and mod97(v.replace(" ", "")) == 1,
    "ipv6": _address,
}


class Surrogates:
    """Keyed permutations of each type's strings."""

    def __init__(self, key: bytes):
        if not key:
            raise ValueError("surrogates need a key: whoever knows it can undo them")
        self.key = key
        self.letters: dict[str, str] = {}

    def _word(self, *parts) -> int:
        return int.from_bytes(hmac.new(self.key, "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), hashlib.sha256).digest(), "big")

    def _permute(self, x: int, size_a: int, size_b: int, *tweak) -> int:
        """A Feistel permutation of 0 .. size_a * size_b - 1."""
        a, b = divmod(x, size_b)
        for r in range(0, 8, 2):
            a = (a + self._word(*tweak, r, b)) % size_a
            b = (b + self._word(*tweak, r + 1, a)) % size_b
        return a * size_b + b

    def string(self, s: str, alphabets: list[str], *tweak, fits=lambda s: True) -> str:
        """Permutes the strings whose i-th character is of the i-th alphabet; walks the cycle until ``fits`` is as it was."""
        if not s:
            return s
        half = len(s) // 2
        sizes = [len(a) for a in alphabets]
        size_a = size_b = 1
        for n in sizes[:half]:
            size_a *= n
        for n in sizes[half:]:
            size_b *= n
        x = 0
        for c, n, a in zip(s, sizes, alphabets, strict=True):
            x = x * n + a.index(c)
        was = fits(s)
        start = x
        while True:
            x = self._permute(x, size_a, size_b, len(s), *tweak)
            y, out = x, []
            for a, n in zip(reversed(alphabets), reversed(sizes), strict=True):
                y, i = divmod(y, n)
                out.append(a[i])
            made = "".join(reversed(out))
            if fits(made) == was or x == start:
                return made

    def _classes(self, s: str, *tweak, fits=lambda s: True) -> str:
        """Letters stay letters of their case, digits digits, everything else stays."""
        kinds = [next((a for a in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c in a), None) for c in s]
        body = "".join(c for c, k in zip(s, kinds, strict=True) if k)
        form = "".join("." if k else c for c, k in zip(s, kinds, strict=True))

        def whole(b: str) -> str:
            it = iter(b)
            return "".join(next(it) if k else c for c, k in zip(s, kinds, strict=True))

        return whole(self.string(body, [k for k in kinds if k], form, "".join(k[0] for k in kinds if k), *tweak, fits=lambda b: fits(whole(b))))

    def of(self, kind: str, value: str, attempt: int = 0) -> str:
        plain = fold(value)
        made = self._of(kind, plain, attempt)
        return made if plain == value else in_script_of(value, made)

    def _of(self, kind: str, value: str, attempt: int) -> str:
        if kind == "email":
            local, _, host = value.rpartition("@")
            name, _, top = host.rpartition(".")
            return self._classes(f"{local}@{name}", kind, top.lower(), attempt) + f".{top}"
        if kind == "ip":
            good = lambda s: all(len(x) == len(str(int(x))) and int(x) < 256 for x in s.split(".")) and s[0] != "0"
            return self._classes(value, kind, attempt, fits=good)
        if kind == "iban":
            plain = value.replace(" ", "")
            body = self._classes(plain[4:], kind, plain[:2], attempt)
            made = iter(plain[:2] + f"{98 - mod97(plain[:2] + '00' + body):02d}" + body)
            return "".join(" " if c == " " else next(made) for c in value)
        if kind == "ipv6":
            hexes = "0123456789ABCDEF" if value.upper() == value else "0123456789abcdef"
            same = value if hexes[10] == "A" else value.lower()
            body = [(i, hexes[1:] if c != "0" and (not i or same[i - 1] == ":") else hexes) for i, c in enumerate(same) if c != ":"]
            form = re.sub("[^:]", "x", same) + "".join("1" if len(a) < 16 else "0" for _, a in body)
            made = self.string("".join(same[i] for i, _ in body), [a for _, a in body], kind, form, attempt, fits=lambda b: any(c.isdigit() for c in b))
            it = iter(made)
            return "".join(":" if c == ":" else next(it) for c in same)
        if kind == "phone":
            head = re.match(r"\+\d{1,3}", value)
            cut = head.end() if head else 0
            first = [m.start() for m in re.finditer(r"(?<!\d)\d", value[cut:])][:2]
            good = lambda s: all(s[i] not in "01" for i in first)
            return value[:cut] + self._classes(value[cut:], kind, value[:cut], attempt, fits=good)
        if kind == "card":
            digits = re.sub(r"\D", "", value)
            body = self.string(digits[1:-1], ["0123456789"] * (len(digits) - 2), kind, digits[0], luhn(digits), attempt)
            made = digits[0] + body
            last = next(c for c in "0123456789" if luhn(made + c) == luhn(digits))
            it = iter(made + last)
            return "".join(next(it) if c.isdigit() else c for c in value)
        if kind == "ssn":
            return self._classes(value, kind, attempt, fits=lambda s: s[:3] not in ("000", "666") and s[0] != "9" and s[4:6] != "00" and s[7:] != "0000")
        if kind == "aws_key":
            return value[:4] + self.string(value[4:], ["ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"] * 16, kind, value[:4], attempt)
        if kind == "hex_key" or kind == "secret" and _HEX.fullmatch(value):
            mixed = lambda s: any(c.isdigit() for c in s) and any(not c.isdigit() for c in s)
            return self.string(value, ["0123456789abcdef"] * len(value), kind, attempt, fits=mixed)
        if kind == "first_name":
            return self._name(value, attempt)
        if kind == "last_name":
            return self._family(value, attempt)
        # a secret of another form stays off the hex strings, which have a permutation of their own
        return self._classes(value, kind, attempt, fits=lambda s: _HEX.fullmatch(s) is not None)

    def form(self, kind: str, value: str) -> str:
        """The format of a value: surrogates stay in it, and one attempt permutes all its strings."""
        value = fold(value)
        if kind == "aws_key":
            return value[:4]
        if kind == "hex_key" or kind == "secret" and _HEX.fullmatch(value):
            return f"hex {len(value)}"
        if kind == "ipv6":
            return re.sub("[0-9A-Fa-f]", "x", value)
        if kind == "iban":
            return value[:2] + re.sub("[A-Z]", "A", re.sub("[0-9]", "0", value[4:]))
        if kind == "last_name":
            stem, end = _stem(value)
            if end:
                return f"{self.form(kind, stem)} {end}"
            low = [_lower(c) for c in value]
            return "".join(f"{'A' if c != v else 'a'}{self._like(c)[0]}" for c, v in zip(low, value, strict=True))
        cut = 0
        if kind == "phone" and (head := re.match(r"\+\d{1,3}", value)):
            cut = head.end()
        if kind == "card":
            digits = re.sub(r"\D", "", value)
            return f"{digits[0]} {luhn(digits)} " + re.sub(r"\d", "0", value)
        end = value.rindex(".") if kind == "email" else len(value)
        body = re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "0", value[cut:end])))
        return f"{value[:cut]} {body} {value[end:]}"

    def _name(self, value: str, attempt: int) -> str:
        """A keyed permutation of the list without fixed points: the names in keyed order, each to the next."""
        names = sorted(NAMES[_GENDER[value]], key=lambda n: self._word("first_name", n))
        return names[(names.index(value) + 1 + attempt % (len(names) - 1)) % len(names)]

    def _like(self, c: str) -> str:
        if c not in self.letters:
            self.letters[c] = _letters(c)
        return self.letters[c]

    def _family(self, value: str, attempt: int) -> str:
        stem, end = _stem(value)
        low = [_lower(c) for c in stem]
        kinds = [self._like(c) for c in low]
        # the mark of a class: v and c for plain vowels and consonants, else its first letter
        pattern = "".join("v" if k in VOWELS.values() else "c" if k in CONSONANTS.values() else k[0] for k in kinds)
        # names without an ending stay without, so both kinds keep apart
        made = self.string("".join(low), kinds, "stem" if end else "last_name", pattern, attempt, fits=lambda s: bool(end) or not _stem(s)[1])
        return "".join(o.upper() if v != c else o for o, v, c in zip(made, stem, low, strict=True)) + end


def _stem(name: str) -> tuple[str, str]:
    """A family name's stem of two letters or more and its ending, which is empty if it has none of the list."""
    end = next((e for e in ENDINGS if name.endswith(e) and len(name) >= len(e) + 2), "")
    return name[: len(name) - len(end)], end


def _lower(c: str) -> str:
    """The small letter of a capital that has one; others as they are."""
    low = c.lower()
    return low if low != c and len(low) == 1 and low.upper() == c else c


def _letters(c: str) -> str:
    """The class of a letter that is small if it can be: its vowels or consonants, or what is like it in its own script."""
    for script in VOWELS:
        for k in (VOWELS[script], CONSONANTS[script]):
            if c in k:
                return k

    def like(x: str) -> tuple:
        plain = unicodedata.normalize("NFD", x)[0]
        return unicodedata.category(x), unicodedata.name(x, "?").split(" ")[0].split("-")[0], len(x.upper()) == 1 and x.upper() != x and _lower(x.upper()) == x, _lower(x) == x, plain in VOWELS["latin"], bool(re.match(r"[^\W\d_]", x))

    first, last = next(((a, b) for a, b in BLOCKS if a <= ord(c) <= b), (ord(c) & ~0xFF, ord(c) | 0xFF))
    plain = {x for k in (*VOWELS.values(), *CONSONANTS.values()) for x in k}
    return "".join(x for x in map(chr, range(first, last + 1)) if x == c or x not in plain and like(x) == like(c))


def _entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = {(kind, value) for text in b.column(0).to_pylist() for _, _, kind, value in find(text)}
        if got:
            kinds, values = zip(*sorted(got), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], names=["kind", "value"])


def _draw(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Surrogates(key)
        for b in batches:
            made = [s.of(k, v, n) for k, v, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(made, pa.string())], names=["kind", "value", "attempt", "made"])

    return run


def _formats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    s = Surrogates(b"formats need none")
    for b in batches:
        forms = [s.form(k, v) for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(forms, pa.string())], names=["kind", "value", "form"])


def redrawn(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """(kind, value, attempt) of the entities whose first surrogate collides; first names are told apart by their list alone.

    Each round draws ``DRAWS`` attempts for what is left and settles at least one entity, or else ends the search: the
    formats of the entities left then take one attempt for all their entities, the one that leaves fewest unchanged.
    """
    spark = docs.sparkSession
    made = "kind string, value string, attempt int, made string"
    found = Stored(docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_entities, "kind string, value string").distinct()).df
    # permuting is slow work: it is dealt by the number of entities, not by the few files that they fit in
    dealt = lambda df: df.repartition(max(1, -(-df.count() // DRAW_ROWS), min(shuffle_partitions(spark), df.count() // 500)))
    checked = dealt(found.where("kind <> 'first_name'"))
    taken = checked.select("kind", F.col("value").alias("made"))

    def draw(df: DataFrame, first: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(first), F.lit(first + DRAWS - 1)))
        return df.select("kind", "value", every.alias("attempt")).mapInArrow(_draw(key), made)

    drawn = Stored(checked.withColumn("attempt", F.lit(0)).mapInArrow(_draw(key), made)).df
    # first surrogates are distinct by construction, but may equal an entity
    left = Stored(drawn.join(taken, ["kind", "made"], "left_semi").select("kind", "value")).df
    settled = drawn.join(left, ["kind", "value"], "left_anti").select("kind", "value", "attempt", "made")
    moved = drawn.where("false").select("kind", "value", "attempt", "made")
    first = 1
    while left.limit(1).count():
        free = draw(left, first).join(taken, ["kind", "made"], "left_anti").join(settled.unionByName(moved).select("kind", "made"), ["kind", "made"], "left_anti")
        # of those that draw one string the least has it, and each keeps its first
        one = free.groupBy("kind", "made").agg(F.min(F.struct("value", "attempt")).alias("x")).select("kind", "made", "x.value", "x.attempt")
        won = Stored(one.groupBy("kind", "value").agg(F.min(F.struct("attempt", "made")).alias("x")).select("kind", "value", "x.attempt", "x.made")).df
        if not won.limit(1).count():
            break
        moved = Stored(moved.unionByName(won)).df
        left = Stored(left.join(won, ["kind", "value"], "left_anti")).df
        first += DRAWS
    else:
        return moved.select("kind", "value", "attempt")
    formats = "kind string, value string, form string"
    full = left.mapInArrow(_formats, formats).select("kind", "form").distinct()
    whole = Stored(checked.mapInArrow(_formats, formats).join(full, ["kind", "form"], "left_semi")).df
    same = draw(whole, 0).join(whole, ["kind", "value"]).groupBy("kind", "form", "attempt").agg(F.sum((F.col("made") == F.col("value")).cast("long")).alias("same"))
    best = same.groupBy("kind", "form").agg(F.min(F.struct("same", "attempt")).alias("x")).select("kind", "form", F.col("x.attempt").alias("attempt"))
    all_of = Stored(whole.join(best, ["kind", "form"]).select("kind", "value", "attempt")).df
    return moved.select("kind", "value", "attempt").join(all_of, ["kind", "value"], "left_anti").unionByName(all_of.where("attempt > 0"))


OUT = "text string, n_entities int, entities array<struct<kind:string,start:int,surrogate:string>>"
ENTITY = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("surrogate", pa.string())]))


def _replace(key: bytes, sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, known = Surrogates(key), sent.value if sent is not None else {}
        for b in batches:
            texts, counts, lists = [], [], []
            own = b.column(2).to_pylist()
            for text, mine in zip(b.column(1).to_pylist(), own, strict=True):
                at, out, entities, size = 0, [], [], 0
                extra = {(x["kind"], x["value"]): x["attempt"] for x in mine or ()}
                for start, end, kind, value in find(text):
                    made = s.of(kind, value, extra.get((kind, value), known.get((kind, value), 0)))
                    out += [text[at:start], made]
                    size += start - at
                    entities.append({"kind": kind, "start": size, "surrogate": made})
                    size += len(made)
                    at = end
                texts.append("".join([*out, text[at:]]) if entities else text)
                counts.append(len(entities))
                lists.append(entities)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int32()), pa.array(lists, ENTITY)], names=["doc_id", "text", "n_entities", "entities"])

    return run


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = {(h, kind, value) for h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for _, _, kind, value in find(text)}
        h, kind, value = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(kind, pa.string()), pa.array(value, pa.string())], names=["h", "kind", "value"])


def surrogates(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", broadcast_entities: int = BROADCAST_ENTITIES) -> DataFrame:
    """``(doc_id, text, n_entities, entities)`` for every row, entities replaced; ``entities`` gives kind, new place and surrogate.

    ``key`` is secret: whoever has it can undo the surrogates. Text without entities stays as it is, null stays null. Repeated rows get the same surrogates. No rows give none.
    Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    moved = Stored(redrawn(rows, key)).df
    none = F.lit(None).cast("array<struct<kind:string,value:string,attempt:int>>")
    sent = None
    if (n := moved.count()) <= broadcast_entities:
        sent = spark.sparkContext.broadcast({(r["kind"], r["value"]): r["attempt"] for r in moved.collect()}) if n else None
        ready = rows.withColumn("own", none)
    else:
        keyed = rows.withColumn("h", F.xxhash64("text"))
        seen = keyed.select("h", "text").mapInArrow(_occurrences, "h long, kind string, value string").distinct()
        own = seen.join(moved, ["kind", "value"]).groupBy("h").agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("own"))
        ready = keyed.join(own, "h", "left").select("doc_id", "text", "own")
    return ready.mapInArrow(_replace(key, sent), f"doc_id long, {OUT}")


def op9(spark, sf_dir):
    return surrogates(table(spark, sf_dir, "documents"), DEMO_KEY)
