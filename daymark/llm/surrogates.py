"""Personal data replaced by keyed surrogates of the same type and format.

An entity is a type and a canonical form (digits of a phone number, lower-case
e-mail address, …). Its surrogate comes from a keyed hash of both, so one entity
gets one surrogate wherever and however it is written, and nobody without the key can
tell which. Surrogates keep what the type is known by: separators, letter case and
script, a card's check digit, a title's gender, private or public addresses.

Two entities might meet in one surrogate, or a surrogate be another entity of the
corpus. The distinct entities are therefore checked against each other; those that
lose get another try, from the third on in a larger space, so that tries end however
many entities there are. Only these exceptions travel to the documents.
"""

from __future__ import annotations

import hmac
import ipaddress
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.batches import extend, map_arrow
from daymark.session import stage

KEY = b"daymark test key"
# Added to the attempt of an entity that would be its own surrogate.
_REDRAWN = 1 << 20
# Exceptions one broadcast may hold; more are applied in several passes.
BLOCK = 100_000


class Entity(NamedTuple):
    start: int
    end: int
    kind: str
    canonical: str


# Scripts without spaces (Thai to Khmer, kana, Han): next to an address, their letters are not part of it.
_SOLID = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_LABEL = "(?:[^\\W_]|-)+"
_EMAIL = re.compile(
    rf"[\w\u0300-\u036f.%+-]+@(?:[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?![^\W_{_SOLID}])|{_LABEL}(?:\.{_LABEL})+)"
)
_TO_SOLID = re.compile(rf".*[{_SOLID}](?=[^@])")
_IPV6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,8}(?![\w:]|\.\d)")
_SECRET = re.compile(
    r"""(?:[=:]\s*["']?|["'])([A-Za-z0-9_+/-]{16,}={0,2})(?![A-Za-z0-9_+/-])|\b((?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36})\b"""
)
_NUMBER = re.compile(
    r"""(?<![\w.])(?:
    (?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?!\w|\.\d)
    |(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])
    |(?P<card>\d(?:[ -]?\d){12,18})(?!\w)
    |(?P<phone>(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]\d{3,4}|\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5}
        |(?:\+\d{1,3}[ .-]?\(?\d\)?|0[1-9])(?:[ .-]\d\d){4}(?![ .-]?\d)|0[1-9]\d{1,3}[ /.-]\d\d(?:[ .-]\d\d){2,3}(?![ .-]?\d)
        |(?:0[1-9]\d|[2-9]\d\d[2-9])\d{6,7}(?<=(?<!\d)\d{10})(?![.,]\d))(?!\w)
    )""",
    re.X,
)
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
# Forms of address and the gender they state.
TITLES = {
    **dict.fromkeys(("Mr", "Sir", "Herr", "Herrn", "Señor", "Sr", "Don", "Monsieur", "Господин", "Κύριος"), "m"),
    **dict.fromkeys(
        ("Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Sra", "Doña", "Madame", "Mme", "Mademoiselle", "Госпожа", "Κυρία"), "f"
    ),
    **dict.fromkeys(("Dr", "Prof"), "n"),
}
_UPPER = "A-ZÀ-ÖØ-ÞΑ-ΩА-Я"
_NAME = rf"((?!(?:Dr|Prof)\b)[{_UPPER}][\w'’-]+)"
_TITLED = re.compile(rf"\b({'|'.join(TITLES)})\b\.?(?: (?:Dr|Prof)\b\.?)* {_NAME}(?: {_NAME})?")
_LETTERS = {"CYRILLIC": "абвгдежзиклмнопрстуфхцчшщэюя", "GREEK": "αβγδεζηθικλμνξοπρστυφχψω"}
_POSSESSIVE = re.compile(r"(?:['’]s)?['’-]*$")


def luhn_sum(digits: str) -> int:
    """Zero (mod 10) for digits whose last is the right check digit."""
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _numbers(text: str) -> Iterator[Entity]:
    for m in _NUMBER.finditer(text):
        kind, found = m.lastgroup, m.group()
        digits = re.sub(r"\D", "", found)
        if kind == "ip" and all(int(x) < 256 for x in found.split(".")):
            yield Entity(*m.span(), kind, ".".join(str(int(x)) for x in found.split(".")))
        elif kind == "ssn" or kind == "card" and (luhn_sum(digits) == 0 or len(digits) == 16):
            yield Entity(*m.span(), kind, digits)
        elif kind == "phone" and 7 <= len(digits) <= 15:
            # The country code stays, so that a number is the same with and without it.
            code = re.match(r"\+\d{1,3}(?=[ .(-])[ .-]?|\+\d\d|", found).end()
            yield Entity(m.start() + code, m.end(), kind, re.sub(r"\D", "", found[code:]))


def _emails(text: str) -> Iterator[Entity]:
    for m in _EMAIL.finditer(text):
        before = _TO_SOLID.match(m.group().partition("@")[0] + " ")
        start = m.start() + (before.end() if before and before.end() < m.group().index("@") else 0)
        yield Entity(start, m.end(), "email", text[start : m.end()].lower())


def _ipv6(text: str) -> Iterator[Entity]:
    """Addresses of three groups or a first one of four digits; `1::2` is rather a slice, `::1` nobody's."""
    for m in _IPV6.finditer(text):
        found = m.group()
        if found.endswith(":") and not found.endswith("::"):
            found = found[:-1]
        groups = [g for g in found.split(":") if g]
        if not any(c.isdigit() for c in found) or len(groups) < 3 and found.find(":") < 4:
            continue
        try:
            canonical = ipaddress.IPv6Address(found).exploded
        except ValueError:
            continue
        yield Entity(m.start(), m.start() + len(found), "ipv6", canonical)


def _names(text: str) -> Iterator[Entity]:
    """Names behind a form of address, then further mentions of these names in the text, capitalised."""
    titled = []
    for m in _TITLED.finditer(text):
        kinds = [f"given-{TITLES[m[1]]}", "surname"] if m[3] else ["surname"]
        for k, kind in enumerate(kinds, 2):
            name = _POSSESSIVE.sub("", m[k])
            titled.append(Entity(m.start(k), m.start(k) + len(name), kind, name.lower()))
    if not titled:
        return
    yield from titled
    kinds = {}
    for e in sorted(titled, key=lambda e: e.kind == "surname"):
        kinds.setdefault(e.canonical, e.kind)
    seen, lower = Counter(e.canonical for e in titled), text.lower()
    again = [c for c in kinds if len(c) > 1 and lower.count(c) > seen[c]]
    if again:
        either = "|".join(map(re.escape, sorted(again, key=len, reverse=True)))
        for m in re.finditer(rf"(?<!\w)(?:{either})(?!\w)", text, re.I):
            if m.group()[0].isupper() and (kind := kinds.get(m.group().lower())):
                yield Entity(*m.span(), kind, m.group().lower())


def detect(text: str | None) -> list[Entity]:
    """Entities of the text in order; of two that overlap, the one that starts first (or is longer)."""
    if not text:
        return []
    found: list[Entity] = []
    if "@" in text:
        found += _emails(text)
    for m in _SECRET.finditer(text):
        k = 1 if m[1] else 2
        if any(c.isdigit() for c in m[k]) and any(c.isalpha() for c in m[k]):
            found.append(Entity(*m.span(k), "secret", m[k]))
    found += _numbers(text)
    if text.count(":") > 1:
        found += _ipv6(text)
    for m in _IBAN.finditer(text):
        plain = m.group().replace(" ", "")
        if 15 <= len(plain) <= 34 and _mod97(plain) == 1:
            found.append(Entity(*m.span(), "iban", plain))
    found += _names(text)
    kept, end = [], 0
    for entity in sorted(found, key=lambda e: (e.start, -e.end)):
        if entity.start >= end:
            kept.append(entity)
            end = entity.end
    return kept


class Surrogates:
    """Keyed surrogates of canonical forms."""

    def __init__(self, key: bytes):
        self.key = key

    def _stream(self, kind: str, canonical: str, attempt: int) -> Iterator[int]:
        """Endless numbers below 2**16 from the key and the entity."""
        block = 0
        while True:
            seed = f"{kind}\0{canonical}\0{attempt}\0{block}".encode()
            digest = hmac.digest(self.key, seed, "sha256")
            for k in range(0, 32, 2):
                yield digest[k] << 8 | digest[k + 1]
            block += 1

    def _alike(self, text: str, draw: Iterator[int], hexed: bool = False) -> str:
        """Letters for letters, digits for digits, the rest as it stands."""
        out = []
        for c in text:
            if hexed and c in "0123456789abcdef":
                out.append("0123456789abcdef"[next(draw) % 16])
            elif c.isdigit():
                out.append(str(next(draw) % 10))
            elif c.isalpha() and c.isascii():
                letter = chr(97 + next(draw) % 26)
                out.append(letter.upper() if c.isupper() else letter)
            elif c.isalpha():
                letters = _LETTERS.get(unicodedata.name(c, "").split(" ")[0], "abcdefghijklmnopqrstuvwxyz")
                letter = letters[next(draw) % len(letters)]
                out.append(letter.upper() if c.isupper() else letter)
            else:
                out.append(c)
        return "".join(out)

    def make(self, kind: str, canonical: str, attempt: int = 0) -> str:
        """The canonical form of the surrogate, never the entity itself."""
        while True:
            found = self._make(kind, canonical, attempt)
            if found != canonical:
                return found
            attempt += _REDRAWN

    def _make(self, kind: str, canonical: str, attempt: int) -> str:
        draw = self._stream(kind, canonical, attempt)
        # Letters, digits or syllables more than the original has.
        more = max(0, attempt % _REDRAWN - 1)
        if kind == "email":
            local, _, domain = canonical.partition("@")
            host, _, top = domain.rpartition(".")
            # One domain stays one domain, whatever the address.
            own = self._stream("domain", domain, 0)
            name = "".join(chr(97 + next(own) % 26) for _ in range(8))
            local = self._alike(local + "x" * more, draw)
            return f"{local}@{name}.example.{top}" if host else f"{local}@{name}.example"
        if kind == "ip":
            first, second, *_ = map(int, canonical.split("."))
            private = first == 10 or (first, second) == (192, 168) or first == 172 and 16 <= second < 32
            if more > 4:
                # More addresses than there are: dotted numbers that are none.
                return ".".join(str(256 + next(draw)) for _ in range(more - 1))
            if more > 2 or more and not private:
                first, second = 1, 1
            elif more:
                first, second = 10, 0
            fixed = [first, second] if (first, second) == (192, 168) else [first] if first in (0, 10, 127) or first >= 224 else []
            if first == 172 and 16 <= second < 32:
                fixed = [172, 16 + next(draw) % 16]
            while not fixed:
                a = 1 + next(draw) % 223
                if a not in (10, 127, 172, 192):
                    fixed = [a]
            return ".".join(map(str, [*fixed, *(next(draw) % 256 for _ in range(4 - len(fixed)))]))
        if kind == "ipv6":
            first, *rest = (int(g, 16) for g in canonical.split(":"))
            # The kind of address is in the leading bits.
            free = 0x1FFF if first >> 13 == 1 else 0x1FF if first >> 9 == 0xFC00 >> 9 else 0
            drawn = [first & ~free | next(draw) & free, *(1 + next(draw) % 0xFFFF if g else 0 for g in rest[:-1]), 1 + next(draw) % 0xFFFF]
            if more:
                drawn[1:] = [next(draw) for _ in rest]
            # Beyond all addresses of the kind: any global one.
            drawn[0] = 0x2000 | next(draw) & 0x1FFF if more > 2 else drawn[0]
            return ":".join(f"{g:04x}" for g in drawn)
        if kind == "card":
            body = canonical[0] + "".join(str(next(draw) % 10) for _ in canonical[2:] + "0" * more)
            check = (10 - luhn_sum(body + "0")) % 10
            sound = luhn_sum(canonical) == 0
            return body + str(check if sound else (check + 1 + next(draw) % 9) % 10)
        if kind in ("phone", "ssn"):
            # No leading zero where there was none.
            first = canonical[0] if canonical[0] == "0" else str(1 + next(draw) % 9)
            return first + "".join(str(next(draw) % 10) for _ in canonical[1:] + "0" * more)
        if kind == "iban":
            body = self._alike(canonical[4:] + "0" * more, draw)
            return f"{canonical[:2]}{98 - _mod97(canonical[:2] + '00' + body):02d}{body}"
        if kind == "secret":
            return self._alike(canonical + "0" * more, draw, hexed=not set(canonical) - set("0123456789abcdef"))
        return self._name(kind, canonical, draw, more)

    def _name(self, kind: str, canonical: str, draw: Iterator[int], more: int) -> str:
        """A name of syllables in the script of the original, ending as its gender does."""
        script = unicodedata.name(canonical[0], "LATIN").split()[0]
        consonants, vowels, female, male = {
            "CYRILLIC": ("бвгдзклмнпрст", "аеиоу", "на", "н"),
            "GREEK": ("βγδκλμνπρστ", "αειου", "να", "νος"),
        }.get(script, ("bdfghklmnprstvz", "aeiou", "na", "n"))
        syllables = 2 + len(canonical) // 6 + more
        name = "".join(
            consonants[next(draw) % len(consonants)] + vowels[next(draw) % len(vowels)] for _ in range(syllables)
        )
        return name + {"given-f": female, "given-m": male}.get(kind, consonants[next(draw) % len(consonants)])


def render(original: str, kind: str, surrogate: str) -> str:
    """The surrogate written as the original was: its separators, its letter case."""
    if kind in ("card", "phone", "ssn", "iban"):
        left = iter(surrogate)
        return "".join(next(left, "") if c.isalnum() else c for c in original) + "".join(left)
    if kind == "ipv6":
        address = ipaddress.IPv6Address(surrogate)
        plain = ":".join(f"{int(g, 16):x}" for g in surrogate.split(":"))
        text = address.compressed if "::" in original else surrogate if len(original) == 39 else plain
        return text.upper() if original.isupper() else text
    if kind == "email" and original.isupper():
        return surrogate.upper()
    if kind == "surname" or kind.startswith("given"):
        return surrogate.upper() if original.isupper() and len(original) > 1 else surrogate.capitalize()
    return surrogate


def entities(docs: DataFrame) -> DataFrame:
    """The distinct (kind, canonical) of all texts."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sorted({(e.kind, e.canonical) for t in batch.column(0) for e in detect(t.as_py())})
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.string()), pa.array([c for _, c in found], pa.string())], ["kind", "canonical"]
            )

    return map_arrow(docs.select("text"), find, "kind string, canonical string").distinct()


def exceptions(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, attempt) of the entities whose first surrogate is not theirs alone.

    Of entities that share a surrogate the smallest keeps it; one that is itself an entity of
    the corpus nobody may have. The others try again until all are distinct; each space grows
    with the attempts at least tenfold (addresses: by stages), so the rounds are as many as the logarithm of the entities.
    """
    tried = found.withColumn("attempt", F.lit(0))
    while True:

        def start() -> Callable:
            make = Surrogates(key).make

            def compute(rows: pa.StructArray):
                columns = (rows.field(c).to_pylist() for c in ("kind", "canonical", "attempt"))
                return [pa.array([make(*row) for row in zip(*columns)], pa.string())]

            return compute

        given = stage(extend(tried, start, "surrogate string").select("row.*", "surrogate"), "surrogates")
        shared = given.groupBy("kind", "surrogate").agg(F.count("*").alias("n"), F.min("canonical").alias("first")).where("n > 1")
        losing = given.join(shared, ["kind", "surrogate"]).where("canonical <> first").select("kind", "canonical")
        real = given.join(found.select("kind", F.col("canonical").alias("surrogate")), ["kind", "surrogate"]).select("kind", "canonical")
        again = stage(losing.union(real).distinct().withColumn("again", F.lit(1)), "again")
        if again.isEmpty():
            return given.where("attempt > 0").select("kind", "canonical", "attempt")
        tried = given.join(again, ["kind", "canonical"], "left").select(
            "kind", "canonical", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt")
        )


def replace_personal_data(docs: DataFrame, key: bytes = KEY, keep: list[str] | None = None, block: int = BLOCK) -> DataFrame:
    """`row` (the `keep` columns), `new_text` and `kinds` (of every replaced entity, in order) of every document.

    A text without entities stays as it is to the byte; null stays null. Repeated rows
    get the same text. Empty tables give no rows.
    """
    odd = stage(exceptions(stage(entities(docs), "entities"), key), "exceptions")
    blocks = max(1, -(-odd.count() // block))
    part = F.pmod(F.crc32(F.col("canonical").cast("binary")), F.lit(blocks))
    kept = list(docs.columns if keep is None else keep)
    needed = list(dict.fromkeys([*kept, "text"]))
    edits = "array<struct<start:int,end:int,kind:string,value:string>>"
    done = docs.select(*needed, F.array().cast(edits).alias("_edits"))
    for k in range(blocks):
        attempts = {(r.kind, r.canonical): r.attempt for r in odd.where(part == k).collect()}  # about `block` rows
        shared, last = docs.sparkSession.sparkContext.broadcast(attempts), k == blocks - 1

        def start(shared=shared, k=k, last=last) -> Callable:
            import zlib

            attempts, make = shared.value, Surrogates(key).make
            kind = pa.list_(
                pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())])
            )

            def compute(rows: pa.StructArray):
                texts, all_edits = [], []
                for text, before in zip(rows.field("text"), rows.field("_edits").to_pylist()):
                    text, own = text.as_py(), before
                    for e in detect(text):
                        if zlib.crc32(e.canonical.encode()) % blocks == k:
                            value = make(e.kind, e.canonical, attempts.get((e.kind, e.canonical), 0))
                            own.append({"start": e.start, "end": e.end, "kind": e.kind, "value": render(text[e.start : e.end], e.kind, value)})
                    own.sort(key=lambda e: e["start"])
                    all_edits.append(own)
                    if last and own:
                        parts, at = [], 0
                        for e in own:
                            parts += [text[at : e["start"]], e["value"]]
                            at = e["end"]
                        text = "".join([*parts, text[at:]])
                    texts.append(text if last else None)
                return [pa.array(texts, pa.string()), pa.array(all_edits, kind)]

            return compute

        names = kept if last else [*needed]
        done = extend(done, start, f"new_text string, edits {edits}", names)
        if not last:
            done = done.select("row.*", F.col("edits").alias("_edits"))
    return done.select("row", "new_text", F.transform("edits", lambda e: e["kind"]).alias("kinds"))


def surrogate_report(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    found = replace_personal_data(docs, key, ["doc_id"])
    return found.select(
        "row.doc_id",
        F.col("new_text").alias("text"),
        F.size("kinds").cast("long").alias("n_entities"),
        F.concat_ws(",", F.array_sort(F.array_distinct("kinds"))).alias("kinds"),
    )


def with_surrogates(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """The documents in their own columns, with surrogates in `text` (and `n_chars` counted anew if present)."""
    found = replace_personal_data(docs, key)
    new = {"text": F.col("new_text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.size("kinds") > 0, F.length("new_text").cast(kind)).otherwise(F.col("row.n_chars"))
    return found.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
