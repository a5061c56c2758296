"""PII surrogates: detected entities get keyed replacements of the same kind, format, script and gender.

Kinds: e-mail addresses, IPv4 addresses, phone numbers, payment cards, IBANs, secrets
(long hexadecimal strings, values after token/secret/password/key) and names after a
gendered title. A replacement is a keyed permutation of all strings of the same shape
(format-preserving Feistel network, walked until it is in the domain), so in one shape two
entities never meet: digits stay digits, letters keep case and script, an address's octets
keep their width, a card keeps its first digit and whether its checksum holds. Names are
built from syllables by keyed hash with endings by gender, word by word: a family name has
one surrogate for both genders, alone, with a first name and in capitals.

The same entity has the same surrogate everywhere (coreference). Over the distinct
entities of all documents (of names: their words), collisions are looked for: two entities with one
surrogate, or a surrogate that is itself an entity of the corpus. Such entities try again with the next
counter until none is left. Names grow with the counter, other kinds of small shapes from the counter
``ROOMY`` on, so that there is always room.

Null texts stay null, others without entities stay as they are. Input columns with the name
of an output column are replaced.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import add_columns, field, quoted, written

#: Most second tries that are sent to all tasks at once; beyond it they are joined to the documents that need them.
SHARED_TRIES = 50_000
#: Letters that are permuted as one number; longer strings go piece by piece, each depending on those before it.
PIECE = 512
#: From this try on, surrogates may leave a shape that has too few strings.
ROOMY = 8

_EMAIL = re.compile(r"(?<![\w.+%-])[\w+%-](?:[\w.+%-]*[\w+%-])?@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+")
_IP = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\d]|\.\d)")
_CARD = re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w]|[.-]\d)")
_PHONE = re.compile(
    r"(?<![\w.])\+[1-9]\d{0,14}(?:[ .-]?\(\d{1,5}\)(?:[ .-]?\d{1,10})?)?(?:[ .-]\d{1,10}){0,14}(?!\w|[.-]\d)"  # with a country code
    r"|(?<![\w.])0\d{1,5}[ .-](?:\d{5,10}|\d{1,10}(?:[ .-]\d{1,10}){1,14})(?!\w|[.-]\d)"  # with a trunk 0
    r"|(?<![\w.])(?:1[ .-])?(?:\(\d{2,5}\)[ .-]?(?:\d{6,10}|\d{1,10}(?:[ .-]\d{1,10}){1,14})|\d{2,4}[ .-]\d{2,10}(?:[ .-]\d{2,10}){1,14})(?!\w|[.-]\d)"
)
_DATE = re.compile(r"(?:\d{4}[ .-]\d{2}[ .-]\d{2}|\d{2}[ .-]\d{2}[ .-]\d{4})\b")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_HEX = re.compile(r"(?<!\w)(?=[0-9a-fA-F]*[a-fA-F])(?=[0-9a-fA-F]*\d)[0-9a-fA-F]{32,}(?!\w)")
_SECRET = re.compile(r"\b(?:api[_-]?key|access[_-]?key|secret(?:[_-]?key)?|token|passw(?:or)?d|pwd)\b[\"']?\s*[:=]\s*[\"']?([^\s\"',;]{8,})", re.IGNORECASE)
_SECRET_HINT = re.compile(r"key|secret|token|pass|pwd", re.IGNORECASE)
# Titles by gender.
TITLES = {"m": "Mr Sir Herr Monsieur Señor Sr Don г-н господин", "f": "Mrs Ms Miss Madam Frau Madame Mme Mlle Señora Señorita Sra Doña г-жа госпожа"}
_GENDER = {t: g for g, names in TITLES.items() for t in names.split()}
_NAME = re.compile(r"\b(" + "|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True)) + r")\.? +([^\W\d_a-z][^\W\d_]+(?:[ -][^\W\d_a-z][^\W\d_]+){0,2})")


def _luhn(digits: str) -> int:
    """What the digits (with the check digit last) leave, 0 where the checksum holds."""
    return sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(map(int, reversed(digits)))) % 10


def _phones(text: str) -> Iterator[tuple[int, int]]:
    """Spans of 7 to 15 digits; of a longer row of groups the first ones that are no more than 15."""
    at = 0
    while m := _PHONE.search(text, at):
        a, at = m.span()
        digits = 0
        for g in re.finditer(r"\d+", m[0]):
            if (digits := digits + len(g[0])) > 15:
                at = a + g.start()
                break
        b = a + len(text[a:at].rstrip(" .-("))
        at = max(at, a + 1)
        if 7 <= sum(c.isdigit() for c in text[a:b]) and not _DATE.match(text, a, b):
            yield a, b


def find_entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities of a text, not overlapping, in order."""
    found: list[tuple[int, int, int, str]] = []

    def add(rank: int, kind: str, spans) -> None:
        found.extend((a, rank, b, kind) for a, b in spans)

    if "@" in text:
        add(0, "email", (m.span() for m in _EMAIL.finditer(text)))
    if _SECRET_HINT.search(text):
        add(1, "secret", (m.span(1) for m in _SECRET.finditer(text) if any(map(str.isalnum, m[1]))))
    if re.search(r"\d", text):
        add(1, "hex", (m.span() for m in _HEX.finditer(text)))
        add(2, "ip", (m.span() for m in _IP.finditer(text)))
        add(3, "iban", (m.span() for m in _IBAN.finditer(text) if sum(c.isdigit() for c in m[0]) >= 10))
        add(4, "card", (m.span() for m in _CARD.finditer(text)))
        add(5, "phone", _phones(text))
    add(6, "name", [])
    for m in _NAME.finditer(text):
        if not m[2][0].islower():  # scripts without case count too
            found.append((m.start(2), 6, m.end(2), "name_" + _GENDER[m[1]]))
    out: list[tuple[int, int, str]] = []
    taken: list[tuple[int, int]] = []
    for a, rank, b, kind in sorted(found, key=lambda x: (x[1], x[0])):
        if all(b <= s or a >= e for s, e in taken):
            taken.append((a, b))
            out.append((a, b, kind))
    return sorted(out)


# ---------------------------------------------------------------- surrogates

_RANGES = [(0x61, 0x7A), (0x41, 0x5A), (0x30, 0x39), (0x3B1, 0x3C1), (0x391, 0x3A1), (0x430, 0x44F), (0x410, 0x42F), (0x5D0, 0x5EA), (0x627, 0x63A), (0x3041, 0x3093), (0x30A1, 0x30F3), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0xDF, 0xF6), (0xC0, 0xD6), (0xF8, 0xFF), (0xD8, 0xDE), (0x905, 0x939)]


@functools.cache
def _alphabet(c: str) -> range | list[int] | None:
    """The code points that c may become: its range, else letters or digits of its category and neighbourhood."""
    n = ord(c)
    for a, b in _RANGES:
        if a <= n <= b:
            return range(a, b + 1)
    near = [m for m in range(n & ~127, (n | 127) + 1) if unicodedata.category(chr(m)) == unicodedata.category(c) and not any(a <= m <= b for a, b in _RANGES)]
    return near if c.isalnum() and len(near) > 1 else None


def _permute(value: int, size: int, key: bytes, tweak: bytes) -> int:
    """A keyed permutation of range(size): a balanced Feistel network, walked until it is below size."""
    if size <= 1:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for turn in range(8):
            data = bytes([turn]) + tweak + b"\0" + right.to_bytes(width, "big")
            mixed = int.from_bytes(hashlib.blake2b(data, key=key, digest_size=min(64, max(8, width))).digest(), "big")
            if width > 64:
                mixed = int.from_bytes(hashlib.shake_256(key + data).digest(width), "big")
            left, right = right, left ^ (mixed & mask)
        value = (left << half) | right
        if value < size:
            return value


def _by_ranges(text: str, ranges: list[range | list[int] | None], key: bytes, tweak: bytes) -> str:
    """text with each character of a range moved in its range, by one permutation of all strings of this shape."""
    if len(text) > PIECE:
        seen, out = hashlib.blake2b(str(len(text)).encode(), digest_size=16), []
        for k in range(0, len(text), PIECE):
            out.append(_by_ranges(text[k : k + PIECE], ranges[k : k + PIECE], key, tweak + seen.digest()))
            seen.update(text[k : k + PIECE].encode())
        return "".join(out)
    size, value = 1, 0
    for c, r in zip(text, ranges, strict=True):
        if r:
            size *= len(r)
            value = value * len(r) + r.index(ord(c))
    value = _permute(value, size, key, tweak + "".join(c if not r else chr(r[0]) for c, r in zip(text, ranges, strict=True)).encode())
    out = []
    for c, r in zip(reversed(text), reversed(ranges), strict=True):
        if r:
            value, k = divmod(value, len(r))
            c = chr(r[k])
        out.append(c)
    return "".join(reversed(out))


def _longer(text: str, more: int) -> str:
    """text with so many more letters that can be replaced."""
    return text + next((c for c in text if _alphabet(c)), "a") * more


def _word_name(word: str, role: str, key: bytes, attempt: int) -> str:
    """A made-up name for one lower-case word: syllables by keyed hash, an ending by role, in the word's script; longer with each attempt."""
    tweak = f"{role}:{attempt}:".encode()
    if not word.isascii() and not ("a" <= word[-1] <= "z" or "\xdf" <= word[-1] <= "\xf6"):
        word = _longer(word, attempt)
        return _by_ranges(word, [_alphabet(c) for c in word], key, tweak)
    syllables = max(2, min(4, (len(word) - 1) // 2)) + attempt
    n = int.from_bytes(hashlib.shake_256(len(key).to_bytes(4, "big") + key + tweak + word.encode()).digest(16 + syllables), "big")
    out = ""
    for _ in range(syllables):
        n, k = divmod(n, 17 * 5)
        out += "bcdfghjklmnprstvz"[k // 5] + "aeiou"[k % 5]
    if role == "family":
        return out + ["n", "r", "s", "ll", "ck"][n % 5]
    return out + (["a", "ia", "na", "ta"][n % 4] if role == "given_f" else ["n", "rd", "s", "k"][n % 4])


def _upper(text: str) -> str:
    return "".join(u if len(u := c.upper()) == 1 else c for c in text)


def _words(kind: str, entity: str) -> list[tuple[str, str]]:
    """(role, word) of a name with ("", separator) between; the last word (with its hyphens) is the family name."""
    first = entity.rfind(" ") + 1
    return [("" if m[0] in " -" else "family" if m.start() >= first else f"given_{kind[-1]}", m[0]) for m in re.finditer("[ -]|[^ -]+", entity)]


def units(kind: str, entity: str) -> list[tuple[str, str]]:
    """(kind, entity) of what is replaced by itself: the lower-case words of a name, else the entity."""
    return [(role, w.lower()) for role, w in _words(kind, entity) if role] if kind.startswith("name_") else [(kind, entity)]


def replacement(kind: str, entity: str, key: bytes, attempts: tuple[int, ...]) -> str:
    """The replacement of one entity, with the attempts of its parts."""
    if not kind.startswith("name_"):
        return surrogate(kind, entity, key, attempts[0])
    out, left = "", iter(attempts)
    for role, word in _words(kind, entity):
        new = _word_name(word.lower(), role, key, next(left)) if role else word
        out += _upper(new) if word.isupper() else _upper(new[:1]) + new[1:]
    return out


def surrogate(kind: str, entity: str, key: bytes, attempt: int = 0) -> str:
    """The replacement of one entity (or of a lower-case word of a name); another attempt gives another one."""
    tweak = f"{kind}:{attempt}:".encode()
    if kind.startswith("name_"):
        return replacement(kind, entity, key, (attempt,) * len(units(kind, entity)))
    if kind in ("given_m", "given_f", "family"):
        return _word_name(entity, kind, key, attempt)
    if kind == "ip" and attempt >= ROOMY:
        value = int.from_bytes(bytes(map(int, entity.split("."))), "big")
        return ".".join(map(str, _permute(value, 1 << 32, key, tweak).to_bytes(4, "big")))
    if kind == "ip":
        widths = [len(o) for o in entity.split(".")]
        lows, sizes = {1: 0, 2: 10, 3: 100}, {1: 10, 2: 90, 3: 156}
        value = size = 0
        size = 1
        for o, w in zip(entity.split("."), widths, strict=True):
            value, size = value * sizes[w] + int(o) - lows[w], size * sizes[w]
        value = _permute(value, size, key, tweak + bytes(widths))
        out = []
        for w in reversed(widths):
            value, k = divmod(value, sizes[w])
            out.append(str(lows[w] + k))
        return ".".join(reversed(out))
    if kind == "card":
        digits = re.sub(r"\D", "", entity)
        body = digits[0] + _by_ranges(digits[1:-1], [_alphabet("0")] * (len(digits) - 2), key, tweak + digits[:1].encode())
        rest = _luhn(digits)
        check = next(str(c) for c in range(10) if _luhn(body + str(c)) == rest)
        new = iter(body + check)
        return "".join(next(new) if c.isdigit() else c for c in entity)
    if kind == "phone":
        keep = re.match(r"\+\d{1,3}(?=[ .(-])|", entity).end() if attempt < ROOMY else 0
        return entity[:keep] + _by_ranges(entity[keep:], [_alphabet(c) for c in entity[keep:]], key, tweak + entity[:keep].encode())
    if kind == "hex" or kind == "secret" and re.fullmatch("[0-9a-f]+|[0-9A-F]+", entity):
        low, high = re.search("[a-f]", entity), re.search("[A-F]", entity)
        if not (low and high):
            value = _permute(int(entity, 16), 16 ** len(entity), key, tweak + bytes([len(entity) % 256]))
            return f"{value:0{len(entity)}{'X' if high else 'x'}}"
    if kind == "email":
        cut = entity.rindex(".")  # the last label of the domain stays
        body = _longer(entity[:cut], max(0, attempt - ROOMY + 1))
        return _by_ranges(body, [_alphabet(c) for c in body], key, tweak + entity[cut:].encode()) + entity[cut:]
    if kind == "iban":
        return entity[:2] + _by_ranges(entity[2:], [_alphabet(c) for c in entity[2:]], key, tweak + entity[:2].encode())
    if attempt >= ROOMY:
        entity = _longer(entity, attempt - ROOMY + 1)
    return _by_ranges(entity, [_alphabet(c) for c in entity], key, tweak)


def _found(docs: DataFrame, text: str) -> DataFrame:
    """docs with the parts of the entities of each text as e instead of the text."""

    def make():
        return lambda texts: [[[{"kind": k, "entity": e} for a, b, kind in find_entities(t) for k, e in units(kind, t[a:b])] for t in texts.to_pylist()]]

    return add_columns(docs, text, [field("e", "array<struct<kind:string,entity:string>>")], make, drop_text=True)


def _entities(docs: DataFrame, text: str) -> DataFrame:
    """(kind, entity): the distinct parts of the entities of all documents."""
    return _found(docs.select(F.col(quoted(text))), text).select(F.explode("e").alias("e")).select("e.kind", "e.entity").distinct()


def _tried(entities: DataFrame, key: bytes) -> DataFrame:
    def make():
        def step(texts: pa.Array):
            return [[surrogate(*x.split("\0", 2)[1:], key, int(x.split("\0", 1)[0])) for x in texts.to_pylist()]]

        return step

    packed = entities.withColumn("__x", F.concat_ws("\0", F.col("attempt").cast("string"), "kind", "entity"))
    return add_columns(packed, "__x", [field("surrogate", "string")], make, drop_text=True)


def surrogate_table(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """(kind, entity, attempt, surrogate) for every distinct entity (of names: each word, as given_m, given_f or family), free of collisions."""
    table = written(_tried(_entities(docs, text).withColumn("attempt", F.lit(0)), key), "surrogates")
    while True:
        # of the entities with one surrogate the first keeps it; none keeps one that is an entity itself
        owner = table.groupBy("surrogate").agg(F.min(F.struct("attempt", "kind", "entity")).alias("first"))
        checked = table.join(owner, "surrogate").join(table.select(F.col("entity").alias("surrogate")).distinct().withColumn("real", F.lit(True)), "surrogate", "left")
        again = (F.struct("attempt", "kind", "entity") != F.col("first")) | F.col("real").isNotNull()
        checked = checked.withColumn("attempt", F.col("attempt") + F.when(again, 1).otherwise(0)).select("kind", "entity", "attempt", again.alias("again"), F.col("surrogate").alias("old"))
        if not checked.filter("again").head(1):
            return table
        good = checked.filter("not again").select("kind", "entity", "attempt", F.col("old").alias("surrogate"))
        table = written(good.unionByName(_tried(checked.filter("again").select("kind", "entity", "attempt"), key)), "surrogates")


def replace_pii(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """docs with entities replaced in the text, and ``n_entities`` (long)."""
    table = surrogate_table(docs, key, text)
    later = table.filter("attempt > 0")
    n = later.count()
    # the other columns travel as one struct with fields of its own names, so that no name of theirs clashes
    others = [c for c in docs.columns if c.lower() != text.lower()]
    held = docs.select(F.struct(*[F.col(quoted(c)).alias(f"c{k}") for k, c in enumerate(others)], F.col(quoted(text)).isNotNull().alias("known")).alias("row"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("body"))
    if n <= SHARED_TRIES:
        shared = docs.sparkSession.sparkContext.broadcast({(r["kind"], r["entity"]): r["attempt"] for r in later.collect()})
        done = _replaced(held, key, lambda: (lambda kind, entity, own: shared.value.get((kind, entity), 0)), None)
    else:
        # many second tries: each document gets its own, by a join on its entities
        numbered = written(held.withColumn("at", F.monotonically_increasing_id()), "numbered")
        found = _found(numbered.select("at", "body"), "body")
        pairs = found.select("at", F.explode("e").alias("e")).select("at", "e.kind", "e.entity").distinct().join(later.select("kind", "entity", "attempt"), ["kind", "entity"])
        own = pairs.groupBy("at").agg(F.to_json(F.collect_list(F.array("kind", "entity", F.col("attempt").cast("string")))).alias("own"))
        done = _replaced(numbered.join(own, "at", "left").drop("at"), key, lambda: (lambda kind, entity, own: own.get((kind, entity), 0)), "own")
    back = {c: F.col(f"row.c{k}").alias(c) for k, c in enumerate(others) if c.lower() != "n_entities"} | {c: F.when(F.col("row.known"), F.col("new")).alias(c) for c in docs.columns if c.lower() == text.lower()}
    return done.select(*[back[c] for c in docs.columns if c in back], "n_entities")


def _replaced(held: DataFrame, key: bytes, make_attempt, own: str | None) -> DataFrame:
    """(row, new, n_entities) of (row, body[, own]); own lists the tries of a document's entities."""
    import json

    def make():
        attempt, known = make_attempt(), {}

        def one(t: str, tries: dict) -> tuple[str, int]:
            parts, at = [], 0
            entities = find_entities(t)
            for a, b, kind in entities:
                k = (kind, t[a:b], tuple(attempt(*part, tries) for part in units(kind, t[a:b])))
                if k not in known:
                    if len(known) > 100_000:
                        known.clear()
                    known[k] = replacement(k[0], k[1], key, k[2])
                parts += [t[at:a], known[k]]
                at = b
            return ("".join([*parts, t[at:]]) if entities else t), len(entities)

        def step(texts: pa.Array):
            done = []
            for t in texts.to_pylist():
                listed, _, body = t.partition("\0") if own else ("", "", t)
                done.append(one(body, {(k, e): int(n) for k, e, n in json.loads(listed)} if listed else {}))
            return [t for t, _ in done], [n for _, n in done]

        return step

    body = F.concat(F.coalesce(F.col(own), F.lit("")), F.lit("\0"), F.col("body")) if own else F.col("body")
    return add_columns(held.select("row", body.alias("body")), "body", [field("new", "string"), field("n_entities", "bigint")], make, drop_text=True)
