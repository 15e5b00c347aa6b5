"""PII: detected entities get keyed surrogates of the same type, gender, script and format.

Entities: e-mail addresses, phone numbers, IPv4 addresses, card numbers, IBANs, US social security
numbers, access keys, assigned secrets, and person names after a form of address. Each has a canonical
form (digits of a phone number, lower-cased name, ...). The surrogate of a canonical form comes from a
keyed hash, so all mentions in the corpus, however they are written, get one surrogate, written in the
layout of each mention. Card numbers keep first digit, length and the validity of their check digit;
phone numbers keep the country code; names keep form of address, gender, script and number of words.

Persons. Surrogates are drawn by name part, a surname apart from its bearer's gender, so a shared surname
stays shared in the whole corpus. Within a text, mentions are linked: a name of unknown gender takes the
known gender of the same name, a single name after a title the part it has in the fullest titled name, and
words of titled names are replaced where they stand without a title too (not initials, titles or the
commonest words on their own). A person never named after a title isn't found.

Collision check. Over all distinct canonical forms, a surrogate must differ from every other surrogate
of its type and from every real entity of its type; where two meet, the smaller form keeps it and the
other draws again, until no two meet. Later draws may be longer than the real form (a given name alone
gets an invented second half), so that no type runs out of surrogates, however many of its forms are taken.
Redrawn forms are rare; documents that hold one get its draw number through a join on doc_id (Spark
broadcasts that table only while it is measured small).

A secret's letters and digits are drawn within their script; one that has none is drawn from signs.

Defined results: null and empty texts come back unchanged with no entity; rows that repeat an id are
treated one by one; null ids are allowed; other columns pass through.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from sensorqc.llm.base import arrow_map, materialise
from sensorqc.llm.quality import COMMON_WORDS

# Forms of address by gender, and given names by gender.
MALE_TITLES = "Mr Sir Herr Señor Sr Monsieur Господин".split()
FEMALE_TITLES = "Mrs Ms Miss Madam Frau Señora Sra Señorita Madame Mme Mademoiselle Госпожа".split()
OPEN_TITLES = "Dr Prof Doctor Professor Доктор".split()
MALE_NAMES = "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Paul Steven Andrew Kenneth George Edward Peter Walter Henry Carl Arthur Hans Karl Jürgen Pierre Jean Michel Luc Juan Carlos José Luis Pedro Diego".split()
FEMALE_NAMES = "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Betty Margaret Sandra Ashley Emily Donna Michelle Carol Amanda Helen Anna Ruth Julia Petra Ursula Monika Marie Claire Sophie Camille Carmen Lucía Elena Isabel Rosa Teresa".split()
MALE_CYRILLIC = "Иван Пётр Сергей Алексей Дмитрий Николай Андрей Михаил Павел Виктор".split()
FEMALE_CYRILLIC = "Анна Мария Ольга Елена Наталья Татьяна Ирина Светлана Юлия Вера".split()
LATIN_SYLLABLES = "ba den cor mil ran sel tor ven wick ham ley ford mar lin gar ros pen hal dor bri cal fen gil hur jen kel lor mon nor".split()
CYRILLIC_SYLLABLES = "ба ве го ди ка ле ми но па ра се ту ши бор вол гор дан кир лов мар".split()
GREEK_SYLLABLES = "πα κο λι μα νο ρε στα θε δη γα βα φι".split()

SIGNS = "-_.~^!+?/"

#: So many draws keep the length of the real form; each later one is a character longer.
SAME_LENGTH = 3

_TITLES = sorted({*MALE_TITLES, *FEMALE_TITLES, *OPEN_TITLES}, key=len, reverse=True)
KNOWN_NAMES = {x.lower() for x in [*MALE_NAMES, *FEMALE_NAMES, *MALE_CYRILLIC, *FEMALE_CYRILLIC]}
#: No name on their own, though a titled name may have caught them.
_NO_NAMES = {x.lower() for x in _TITLES} | {w for words in COMMON_WORDS.values() for w in words}
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

#: Type and pattern, in order of preference where two overlap; the group ``v``, if any, is the entity.
PATTERNS = [
    ("secret", re.compile(r"""(?i)(?<![a-z])(?:api[_-]?key|access[_-]?key|secret(?:[_-]?key)?|auth[_-]?token|token|password|passwd|pwd)["']?\s*[:=]\s*["']?(?P<v>[^\s"'<>,;#*$%&|]{6,})""")),
    ("access_key", re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{12,}(?![a-z])")),
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("card", re.compile(r"(?<![\d.+-])\d(?:[ -]?\d){12,18}(?![\d])")),
    ("phone", re.compile(r"(?<![\w.])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}(?!\d)|(?<![\w.])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d.-])")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("ip", re.compile(rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\d]|\.\d)")),
]
_NAME = r"[^\W\d_a-zа-яёα-ω][^\W\d_]*(?:[-'’][^\W\d_]+)?"
PERSON = re.compile(rf"(?<!\w)(?:{'|'.join(_TITLES)})\.? (?P<v>{_NAME}(?: {_NAME}){{0,2}})")
_DIGIT = re.compile(r"[0-9@]")
_ASSIGNED = re.compile(r"(?i)key|secret|token|passw|pwd")


def canonical(kind: str, surface: str) -> str:
    if kind in ("card", "phone", "ssn"):
        return re.sub(r"\D", "", surface)
    if kind in ("email", "person"):
        return surface.lower()
    return surface.replace(" ", "") if kind == "iban" else surface


def gender_of(title: str, name: str) -> str:
    first = name.split(" ")[0].capitalize()
    if title in MALE_TITLES or title not in FEMALE_TITLES and first in {*MALE_NAMES, *MALE_CYRILLIC}:
        return "m"
    return "f" if title in FEMALE_TITLES or first in {*FEMALE_NAMES, *FEMALE_CYRILLIC} else "x"


Part = tuple[str, str]


def find_entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical) of the entities, in order, not overlapping. The type of a person holds the gender."""
    return [m[:4] for m in find_mentions(text)]


def find_mentions(text: str) -> list[tuple[int, int, str, str, tuple[Part, ...]]]:
    """The entities, each with the (type, canonical) of the parts that get a surrogate: name words of a person, else itself."""
    out: list[tuple[int, int, str, str, tuple[Part, ...]]] = []
    starts, ends = [], []

    def free(start: int, end: int) -> bool:
        at = bisect_right(starts, start)
        if at and ends[at - 1] > start or at < len(starts) and starts[at] < end:
            return False
        starts.insert(at, start)
        ends.insert(at, end)
        return True

    digits = bool(_DIGIT.search(text))
    for kind, pattern in PATTERNS:
        if digits or kind == "secret" and "=" in text or kind == "secret" and ":" in text and _ASSIGNED.search(text):
            for m in pattern.finditer(text):
                start, end = m.span("v") if "v" in pattern.groupindex else m.span()
                if free(start, end):
                    form = canonical(kind, text[start:end])
                    out.append((start, end, kind, form, ((kind, form),)))
    if any(t in text for t in _TITLES):
        named = []
        for m in PERSON.finditer(text):
            if free(*m.span("v")):
                named.append((*m.span("v"), gender_of(text[m.start() : m.start("v")].rstrip(" ."), m["v"])))
        out += _people(text, named, free)
    return sorted(out)


def _people(text: str, named: list[tuple[int, int, str]], free) -> Iterator[tuple[int, int, str, str, tuple[Part, ...]]]:
    """Linked mentions: the titled names (start, end, gender), and their words elsewhere in the text."""
    genders: dict[str, str] = {}
    for start, end, g in named:
        form = canonical("person", text[start:end])
        if genders.get(form, "x") == "x":
            genders[form] = g
    part_of: dict[str, str] = {}  # type of a word on its own, by the fullest name that has it
    sexes: dict[str, str] = {}
    for form in sorted(genders, key=lambda f: (-f.count(" "), f)):
        words, g = form.split(" "), genders[form]
        for i, w in enumerate(words):
            surname = i == len(words) - 1 and (i > 0 or w not in KNOWN_NAMES)
            part_of.setdefault(w, "person_s" if surname else f"person_{g}")
            if sexes.get(w, "x") == "x":
                sexes[w] = g

    def mention(start: int, end: int, g: str) -> tuple[int, int, str, str, tuple[Part, ...]]:
        form = canonical("person", text[start:end])
        words = form.split(" ")
        g = g if g != "x" else genders.get(form, sexes[words[-1]])
        kinds = [part_of[words[0]]] if len(words) == 1 else [f"person_{g}"] * (len(words) - 1) + ["person_s"]
        return start, end, f"person_{g}", form, tuple(zip(kinds, words, strict=True))

    for start, end, g in named:
        yield mention(start, end, g)
    spelled = {w for start, end, _ in named for w in text[start:end].split(" ")}
    spelled |= {w.upper() for w in spelled if w.upper().lower() == w.lower()}
    if spelled:
        word = "|".join(re.escape(w) for w in sorted(spelled, key=lambda w: (-len(w), w)))
        for m in re.finditer(rf"(?<!\w)(?:{word})(?!\w)(?: (?:{word})(?!\w)){{0,2}}", text):
            telling = any(len(w) > 1 and w not in _NO_NAMES for w in canonical("person", m[0]).split(" "))
            if telling and free(*m.span()):
                yield mention(*m.span(), "x")


def _stream(key: bytes, *parts: str) -> Iterator[int]:
    """Endless keyed pseudo-random bytes."""
    seed, block = "\x1f".join(parts).encode("utf-8", "replace"), 0
    while True:
        yield from blake2b(seed + block.to_bytes(4, "big"), key=key, digest_size=64).digest()
        block += 1


def _pick(stream: Iterator[int], n: int) -> int:
    return (next(stream) << 16 | next(stream) << 8 | next(stream)) % n


@lru_cache(maxsize=4096)
def _alphabet(ch: str) -> str:
    """Letters or digits of the script and case of a character that is not ASCII; nothing for other characters."""
    sort = unicodedata.category(ch)
    if ch.isascii() or sort[0] not in "LN":
        return ""
    script, start = unicodedata.name(ch, "").split(" ")[0], ord(ch) & ~0x7F
    near = "".join(c for c in map(chr, range(start, start + 128)) if unicodedata.category(c) == sort and unicodedata.name(c, "").split(" ")[0] == script)
    return near if len(near) > 1 else "abcdefghijklmnopqrstuvwxyz"


def _like(ch: str, stream: Iterator[int], hexadecimal: bool = False) -> str:
    if ch.isdigit() and ch.isascii():
        return str(_pick(stream, 10))
    if hexadecimal and ch.isalpha():
        c = "abcdef"[_pick(stream, 6)]
        return c.upper() if ch.isupper() else c
    if ch.isascii() and ch.isalpha():
        c = chr(97 + _pick(stream, 26))
        return c.upper() if ch.isupper() else c
    near = _alphabet(ch)
    return near[_pick(stream, len(near))] if near else ch


def _secret(form: str, extra: int, s: Iterator[int]) -> str:
    is_hex = all(c in "0123456789abcdefABCDEF" for c in form)
    signs = not any(c.isascii() and c.isalnum() or _alphabet(c) for c in form)
    drawn = form
    while drawn == form:
        drawn = "".join(SIGNS[_pick(s, len(SIGNS))] if signs else _like(c, s, is_hex) for c in form)
    more = SIGNS if signs else "0123456789" if form.isdigit() else "abcdef" if is_hex else "abcdefghijklmnopqrstuvwxyz"
    return drawn + "".join(more[_pick(s, len(more))] for _ in range(extra))


def luhn_valid(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def surrogate(kind: str, form: str, attempt: int, key: bytes) -> str:
    """The canonical form of the surrogate; equal inputs give equal surrogates."""
    s = _stream(key, kind, form, str(attempt))
    extra = max(0, attempt - SAME_LENGTH + 1)
    digits = lambda n: "".join(str(_pick(s, 10)) for _ in range(n))
    if kind == "card":
        body = form[0] + digits(len(form) - 2 + extra)
        checks = {c: luhn_valid(body + c) for c in "0123456789"}
        wanted = [c for c in checks if checks[c] == luhn_valid(form)]
        return body + wanted[_pick(s, len(wanted))]
    if kind == "phone":
        keep = 1 if form[0] in "17" or len(form) <= 10 else 2
        return form[:keep] + digits(len(form) - keep + extra)
    if kind == "ssn":
        return f"{900 + _pick(s, 100)}" + digits(len(form) - 3 + extra)
    if kind == "ip":
        first = form.split(".")[0]
        first = first if first in ("10", "127", "192", "172") else str(1 + _pick(s, 223))
        if extra:  # octets over 255: no address at all, so never a real one
            return ".".join([first, *(str(256 + _pick(s, 744 * 10 ** min(extra - 1, 3))) for _ in range(3))])
        return ".".join([first, *(str(_pick(s, 256)) for _ in range(2)), str(1 + _pick(s, 254))])
    if kind == "email":
        local, _, domain = form.partition("@")
        host, _, top = domain.rpartition(".")
        d = _stream(key, "domain", domain)  # one surrogate per domain keeps who belongs together
        grown = "".join(chr(97 + _pick(s, 26)) for _ in range(attempt))
        return "".join(_like(c, s) for c in local) + grown + "@" + "".join(_like(c, d) for c in host) + "." + top
    if kind == "access_key":
        return form[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[_pick(s, 32)] for _ in range(len(form) - 4 + extra))
    if kind == "iban":
        return form[:2] + "".join(_like(c, s) for c in form[2:]) + digits(extra)
    if kind.startswith("person_"):
        return _person(kind[-1], form, attempt, s)
    return _secret(form, extra, s)


def _person(gender: str, form: str, attempt: int, s: Iterator[int]) -> str:
    cyrillic, greek = (any(a <= c <= b for c in form) for a, b in (("а", "ё"), ("α", "ω")))
    syllables = CYRILLIC_SYLLABLES if cyrillic else GREEK_SYLLABLES if greek else LATIN_SYLLABLES
    males, females = (MALE_CYRILLIC, FEMALE_CYRILLIC) if cyrillic else (MALE_NAMES, FEMALE_NAMES)
    given = {"m": males, "f": females}.get(gender)
    words = form.split(" ")
    alone = len(words) == 1
    invented = lambda n: "".join(syllables[_pick(s, len(syllables))] for _ in range(n))
    out = []
    for i, word in enumerate(words):
        last = i == len(words) - 1
        listed = bool(given) and (alone or not last) or word in KNOWN_NAMES and (alone or not (attempt and last))
        if listed and gender != "s" and not greek:
            names = given or males + females
            name = names[_pick(s, len(names))].lower()
            out.append(name + "-" + invented(attempt - 1) if alone and attempt >= SAME_LENGTH else name)
        else:
            out.append(invented(3 + attempt))
    return " ".join(out)


def render(kind: str, surface: str, form: str) -> str:
    """A surrogate written in the layout of a mention."""
    if kind in ("card", "phone", "ssn", "iban"):
        chars = iter(form)
        return "".join([*(next(chars) if c.isalnum() else c for c in surface), *chars])
    if kind.startswith("person_"):
        shape = surface.split(" ")
        return " ".join(w.upper() if a.isupper() and len(a) > 1 else "-".join(x.capitalize() for x in w.split("-")) for a, w in zip(shape, form.split(" "), strict=True))
    return form


def replace_entities(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, int]:
    found = find_mentions(text)
    parts, at = [], 0
    for start, end, kind, _, of in found:
        form = " ".join(surrogate(*part, attempts.get(part, 0), key) for part in of)
        parts += [text[at:start], render(kind, text[start:end], form)]
        at = end
    return "".join([*parts, text[at:]]), len(found)


def mentions(docs: DataFrame) -> DataFrame:
    """doc_id, kind, form: the distinct entities of each document, persons by name part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, *e) for i, t in enumerate(b.column("_pi_text").to_pylist()) if t for e in sorted({part for x in find_mentions(t) for part in x[4]})]
            take = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(take), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], ["doc_id", "kind", "form"])

    rows = docs.select("doc_id", F.col("text").alias("_pi_text"))
    return arrow_map(rows, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, kind string, form string")


def settle(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, form, attempt, sub for the distinct entities (kind, form): surrogates that no two share and that are no entity."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            subs = [surrogate(k, f, a, key) for k, f, a in zip(*(b.column(c).to_pylist() for c in ("kind", "form", "attempt")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("kind", "form", "attempt")), pa.array(subs, pa.string())], ["kind", "form", "attempt", "sub"])

    schema = "kind string, form string, attempt int, sub string"
    now = materialise(arrow_map(entities.select("kind", "form", F.lit(0).alias("attempt")), draw, schema), "surrogates")
    family = F.substring_index("kind", "_", 1)  # persons of all genders share one space
    while True:  # later draws are longer, so the number of clashes falls to none
        order = Window.partitionBy("family", "sub").orderBy("attempt", "kind", "form")
        taken = entities.select(family.alias("family"), F.col("form").alias("sub")).distinct().withColumn("real", F.lit(True))
        ranked = now.withColumn("family", family).withColumn("place", F.row_number().over(order)).join(taken, ["family", "sub"], "left")
        ranked = materialise(ranked.withColumn("clash", (F.col("place") > 1) | F.col("real").isNotNull()), "surrogate-clashes")
        if ranked.filter("clash").isEmpty():
            return now
        again = arrow_map(ranked.filter("clash").select("kind", "form", (F.col("attempt") + 1).alias("attempt")), draw, schema)
        now = materialise(ranked.filter("not clash").select("kind", "form", "attempt", "sub").unionByName(again), "surrogates")


def anonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with surrogates in ``text``, plus ``_pi_entities`` (number of mentions replaced)."""
    said = materialise(mentions(docs), "mentions")
    entities = said.groupBy("kind", "form").agg(F.count(F.lit(1)).alias("documents")).drop("documents")
    redrawn = settle(materialise(entities, "entities"), key).filter("attempt > 0")
    by_doc = said.join(redrawn, ["kind", "form"]).groupBy(F.col("doc_id").alias("_pi_id")).agg(F.collect_list(F.struct("kind", "form", "attempt")).alias("_pi_redrawn"))
    by_doc = materialise(by_doc, "redrawn")
    rows = docs.join(by_doc, docs["doc_id"].eqNullSafe(by_doc["_pi_id"]), "left").drop("_pi_id")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts = [], []
            for text, drawn in zip(b.column(at).to_pylist(), b.column("_pi_redrawn").to_pylist(), strict=True):
                new, n = replace_entities(text, key, {(d["kind"], d["form"]): d["attempt"] for d in drawn or ()}) if text else (text, 0)
                texts.append(new)
                counts.append(n)
            cols = list(b.columns[:-1])
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64())], [*b.schema.names[:-1], "_pi_entities"])

    return arrow_map(rows, run, T.StructType([*docs.schema.fields, T.StructField("_pi_entities", T.LongType())]))
