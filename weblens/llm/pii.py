"""Personal data replaced by surrogates that keep type, format, script and gender.

A surrogate is drawn from a keyed hash of the entity's type and canonical value: the same entity gets the same
one in every document, whoever computes it, and without the key nothing leads back. All distinct entities of
the corpus are then checked: where two would share a surrogate, or one would get another's real value, all but the
first try again with a higher attempt, from the fifth on in wider formats where the narrow one may be used up. Only
entities that had to try again are needed when texts are rewritten.

A person is found after a title. Given and family names have surrogates of their own, so that the full name and the
family name by itself, with or without a title, stay one person through the document and through the corpus.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from weblens.llm.common import bounded_batches, fresh, released, staged

KEY = b"weblens"
MOST_BROADCAST = 100_000
WIDE = 5  # attempts from which formats widen

# Names to draw from, by gender and script: fixed values of this library.
GIVEN = {
    ("f", "latin"): "Anna Clara Elena Greta Helen Irene Julia Laura Maria Nora Olivia Paula Rosa Sarah Vera Wanda".split(),
    ("m", "latin"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leo Martin Oscar Paul Simon".split(),
    ("f", "greek"): "Άννα Ελένη Ειρήνη Ζωή Κατερίνα Μαρία Σοφία Χαρά".split(),
    ("m", "greek"): "Αλέξης Γιώργος Δημήτρης Ηλίας Κώστας Νίκος Πέτρος Σπύρος".split(),
    ("f", "cyrillic"): "Анна Вера Елена Ирина Мария Нина Ольга София".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Иван Максим Олег Павел Семён".split(),
}
FAMILY = {
    "latin": "Adler Becker Carver Dalton Ellis Fischer Garner Holm Irving Jensen Keller Larsen Moreau Nolan Ortega Porter".split(),
    "greek": "Βασιλείου Γεωργίου Δήμου Ιωάννου Λάμπρου Νικολάου Παππά Χρήστου".split(),
    "cyrillic": "Белов Громов Зимин Ильин Крылов Лапин Морозов Орлов".split(),
}
SYLLABLES = {
    "latin": "ba den for gal hin kel lor mar nis ros tal ver".split(),
    "greek": "βα δη κα λο μα νι ρο τα".split(),
    "cyrillic": "ба ве гор до ли ма но ра".split(),
}
TITLES = {
    "f": "Mrs Ms Miss Frau Mme Madame Sra Señora Κυρία Госпожа".split(),
    "m": "Mr Mister Herr Monsieur Sr Señor Κύριος Господин".split(),
}
NEUTRAL = "Dr Prof Professor Δρ Доктор".split()
# Characters of an IBAN by country: fixed values.
IBAN_LENGTHS = dict(AD=24, AE=23, AL=28, AT=20, BA=20, BE=16, BG=22, CH=21, CY=28, CZ=24, DE=22, DK=18, EE=20, ES=24, FI=18, FR=27,
                    GB=22, GE=22, GI=23, GR=27, HR=21, HU=28, IE=22, IL=23, IS=26, IT=27, KW=30, LI=21, LT=20, LU=20, LV=21, MC=27, MD=24,
                    ME=22, MK=19, MT=31, NL=18, NO=15, PL=28, PT=25, RO=24, RS=22, SA=24, SE=24, SI=19, SK=24, SM=27, TN=24, TR=26, UA=29)
_GENDER = {t: g for g, titles in TITLES.items() for t in titles}
_NAME = r"[^\W\d_a-z][^\W\d_]+"

_TITLE = "|".join(sorted((t for ts in (*TITLES.values(), NEUTRAL) for t in ts), key=len, reverse=True))

# (kind, texts of which one has to be there in lower case, pattern). A look behind comes after the first character it goes
# with, so that the search skips to that character.
PATTERNS = [
    ("email", ("@",), re.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")),
    ("secret", ("akia", "asia"), re.compile(r"A(?<![A-Za-z0-9]A)(?:KIA|SIA)[A-Z0-9]{16}(?![A-Za-z0-9])")),
    ("secret", ("passw", "pwd", "token", "secret", "api"),
     re.compile(r"""(?i:\b(?:password|passwd|pwd|token|secret|api_key|apikey)\s*[=:]\s*["']?)([^\s"',;]{8,})""")),
    ("iban", (), re.compile(r"[A-Z](?<![A-Za-z0-9][A-Z])[A-Z]\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("card", (), re.compile(r"\d(?<![\w.-]\d)(?:[ -]?\d){12,18}(?![\w-])")),
    ("ssn", (), re.compile(r"\d(?<![\w-]\d)\d{2}-\d{2}-\d{4}(?![\w-])")),
    ("phone", (), re.compile(r"\+(?<![\w.]\+)\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\w-])")),
    ("phone", (), re.compile(r"[\d(](?<![\w.][\d(])(?:(?<=\()\d{3}\) ?|(?<=\d)\d{2}[-.])\d{3}[-.]\d{4}(?![\w-])")),
    ("ip", (), re.compile(r"\d(?<![\w.]\d)\d{0,2}(?:\.\d{1,3}){3}(?![\w]|\.\d)")),
    ("ip", ("::", ":"), re.compile(r"[0-9a-fA-F](?<![\w:.][0-9a-fA-F])[0-9a-fA-F]{0,3}(?::[0-9a-fA-F]{0,4}){2,7}(?![\w:])")),
    ("name", tuple(t.lower() for t in _TITLE.split("|")), re.compile(rf"\b(?:{_TITLE})\b\.? ({_NAME}(?:[ -]{_NAME})*)")),
]
_NUMBERED = {"iban", "card", "ssn", "phone", "ip"}
_DIGIT = re.compile("[0-9]")
_VERSION = re.compile(r"(?i:\b(?:version|ver\.?|v\.?|release|section|chapter)\s?)$")


def luhn(digits: str) -> bool:
    total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, digits[::-1])))
    return total % 10 == 0


def iban_remainder(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def canonical(kind: str, value: str) -> str:
    """What is the same for two ways of writing an entity."""
    if kind in ("card", "phone", "ssn"):
        return value[:1].replace("(", "").strip("0123456789") + re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "email" or kind == "ip":
        return value.lower()
    return value


def _valid(kind: str, value: str) -> bool:
    if kind == "card":
        return luhn(re.sub(r"\D", "", value))
    if kind == "ip" and ":" in value:
        try:
            return bool(ipaddress.IPv6Address(value)) and len(value) > 6
        except ValueError:
            return False
    if kind == "ip":
        return all(int(x) < 256 and (x == "0" or x[0] != "0") for x in value.split("."))
    if kind == "iban":
        return 15 <= len(canonical(kind, value)) <= 34 and iban_remainder(canonical(kind, value)) == 1
    if kind == "phone":
        return 7 <= len(canonical(kind, value).lstrip("+")) <= 15
    return True


def _shorter(kind: str, text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Spans inside a match that failed its check: for a card runs of its groups, for an IBAN its country's length."""
    if kind == "card":
        groups = [(start + m.start(), start + m.end()) for m in re.finditer(r"\d+", text[start:end])]
        for i in range(len(groups)):
            for j in range(len(groups), i, -1):
                if (i, j) != (0, len(groups)) and 13 <= sum(b - a for a, b in groups[i:j]) <= 19:
                    yield groups[i][0], groups[j - 1][1]
    elif kind == "iban":
        left = IBAN_LENGTHS.get(text[start:start + 2], 0)
        for at in range(start, end):
            left -= text[at] != " "
            if left == 0:
                if not text[at + 1:at + 2].isalnum():
                    yield start, at + 1
                return


def _mentions(text: str, taken: list[tuple[int, int]], named: list[tuple[str, str]]) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, gender, name): further mentions of the named persons, of the full name or the family name alone."""
    known: dict[str, str] = {}
    for gender, name in named:
        known.setdefault(name, gender)
        family = family_of(name)
        if len(family) > 2:
            known.setdefault(family, gender)
    if known:
        pattern = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(known, key=len, reverse=True)))})(?!\w)")
        for m in pattern.finditer(text):
            if not any(s < m.end() and m.start() < e for s, e in taken):
                yield m.start(), m.end(), known[m[0]], m[0]


def family_of(name: str) -> str:
    return name.rpartition(" ")[2]


def detect(text: str | None) -> list[tuple[int, int, str, str, str]]:
    """(start, end, kind, canonical value, gender) in order, without overlaps: the earlier pattern wins."""
    if not text:
        return []
    found, taken, named = [], [], []
    lowered, digits = text.lower(), bool(_DIGIT.search(text))
    for kind, needed, pattern in PATTERNS:
        if needed and not any(word in lowered for word in needed) or kind in _NUMBERED and not digits:
            continue
        for match in pattern.finditer(text):
            start, end = match.span(match.lastindex or 0)
            spans = [(start, end)] if _valid(kind, text[start:end]) else _shorter(kind, text, start, end)
            for start, end in spans:
                value = text[start:end]
                if not _valid(kind, value) or any(s < end and start < e for s, e in taken):
                    continue
                if kind == "ip" and _VERSION.search(text[max(0, start - 10):start]):
                    continue
                gender = _GENDER.get(match.group().split(" ")[0].rstrip("."), "") if kind == "name" else ""
                if kind == "name":
                    named.append((gender, value))
                taken.append((start, end))
                found.append((start, end, kind, (gender + ":" if gender else "") + canonical(kind, value), gender))
    for start, end, gender, value in _mentions(text, taken, named):
        found.append((start, end, "name", (gender + ":" if gender else "") + value, gender))
    return sorted(found)


def parts_of(kind: str, value: str) -> list[tuple[str, str]]:
    """The entities with surrogates of their own in a detected one: given names and family name of a person."""
    if kind != "name":
        return [(kind, value)]
    gender, _, name = value.rpartition(":")
    given, _, family = name.rpartition(" ")
    return [("given", f"{gender}:{given}")] * bool(given) + [("family", family)]


class Draw:
    """An endless stream of numbers from a keyed hash."""

    def __init__(self, key: bytes, *parts: object):
        self.seed, self.block, self.pool, self.left = "\x1f".join(map(str, parts)).encode(), 0, 0, 0
        self.key = key

    def below(self, n: int) -> int:
        if self.left < n * n * 1000:
            digest = hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.pool, self.left, self.block = int.from_bytes(digest, "big"), 1 << 256, self.block + 1
        self.pool, out = divmod(self.pool, n)
        self.left //= n
        return out

    def like_hex(self, text: str) -> str:
        """Hexadecimal digits for all of ``text``, none of them a leading zero."""
        return "".join("123456789abcdef"[self.below(15)] if k == 0 else "0123456789abcdef"[self.below(16)] for k in range(len(text)))

    def like(self, text: str) -> str:
        """Letters for letters and digits for digits, in the same case; hex stays hex."""
        hexadecimal = re.fullmatch(r"[0-9a-f]+", text) and re.search("[a-f]", text) and re.search("[0-9]", text)
        out = []
        for c in text:
            if hexadecimal:
                out.append("0123456789abcdef"[self.below(16)])
            elif "0" <= c <= "9":
                out.append(str(self.below(10)))
            elif "a" <= c <= "z":
                out.append(chr(97 + self.below(26)))
            elif "A" <= c <= "Z":
                out.append(chr(65 + self.below(26)))
            else:
                out.append(c)
        return "".join(out)


def script_of(name: str) -> str:
    c = ord(name[0])
    return "greek" if 0x370 <= c < 0x400 or 0x1F00 <= c < 0x2000 else "cyrillic" if 0x400 <= c < 0x530 else "latin"


def surrogate(kind: str, value: str, attempt: int, key: bytes = KEY) -> str:
    """The canonical surrogate of a canonical entity."""
    draw = Draw(key, kind, value, attempt)
    if kind == "email":
        local, domain = value.split("@")
        host, _, top = domain.rpartition(".")
        # One domain stays one domain: it does not depend on the rest of the address, nor on the attempt.
        wide = draw.like("0" * (attempt - WIDE + 2)) if attempt >= WIDE else ""
        return f"{draw.like(local)}{wide}@{Draw(key, 'domain', domain).like(host)}.{top}"
    if kind == "ip" and ":" in value:
        return ":".join(draw.like_hex(group) for group in value.split(":"))
    if kind == "ip" and attempt >= WIDE:
        return ".".join(map(str, [1 + draw.below(223), draw.below(256), draw.below(256), 1 + draw.below(254)]))
    if kind == "ip":
        return ".".join(str((1 + draw.below(9), 10 + draw.below(90), 100 + draw.below(155))[len(x) - 1]) for x in value.split("."))
    if kind == "card":
        body = value[0] + "".join(str(draw.below(10)) for _ in value[2:])
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    if kind == "ssn":
        return f"{100 + draw.below(800):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}"
    if kind == "phone":
        plus = value.startswith("+")
        keep = max(2 * plus, len(value) - 10)  # what goes before ten digits is a country's code
        return value[:keep] + str(2 + draw.below(8)) + "".join(str(draw.below(10)) for _ in value[keep + 1:])
    if kind == "iban":
        body = "".join(str(draw.below(10)) if c.isdigit() else draw.like(c) for c in value[4:])
        return f"{value[:2]}{98 - iban_remainder(value[:2] + '00' + body):02d}{body}"
    if kind == "secret":
        head = value[:4] if value[:4] in ("AKIA", "ASIA") else ""
        body = value[len(head):]
        return head + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[draw.below(32)] for _ in body) if head else draw.like(body)
    if kind == "family":
        return _name(draw, [value], FAMILY[script_of(value)], attempt)
    gender, _, name = value.rpartition(":")
    if kind == "given":
        gender = gender or "fm"[Draw(key, "gender", name).below(2)]
        return _name(draw, re.split(r"([ -])", name), GIVEN[gender, script_of(name)], attempt)
    # A whole person as one entity.
    given, _, family = name.rpartition(" ")
    new = _name(draw, [family], FAMILY[script_of(family)], attempt)
    if given:
        new = f"{_name(draw, re.split(r'([ -])', given), GIVEN[gender or 'm', script_of(given)], 0)} {new}"
    return (gender + ":" if gender else "") + new


def _name(draw: Draw, parts: list[str], pool: list[str], attempt: int) -> str:
    """Names of the pool for the parts (every second one is what stands between); the last one grows by a syllable an
    attempt, as there are more names than the lists hold."""
    out = []
    for i, part in enumerate(parts):
        new = part if i % 2 else pool[draw.below(len(pool))]
        if i == len(parts) - 1:
            syllables = SYLLABLES[script_of(part)]
            new += "".join(syllables[draw.below(len(syllables))] for _ in range(attempt))
        out.append(new.upper() if not i % 2 and part.isupper() and len(part) > 1 else new)
    return "".join(out)


def written(kind: str, original: str, value: str) -> str:
    """The surrogate in the format of the text it replaces."""
    if kind in ("card", "phone", "ssn", "iban"):
        rest = iter(value.lstrip("+"))
        return "".join(next(rest) if c.isalnum() else c for c in original)
    if kind == "email":
        if original.isupper():
            return value.upper()
        return value
    return value.rpartition(":")[2] if kind == "name" else value


@dataclass(frozen=True)
class Replaced:
    text: str | None
    kinds: list[str]
    spans: list[int]


def replace(text: str | None, attempts: dict[tuple[str, str], int], key: bytes) -> Replaced:
    found = detect(text)
    if not found:
        return Replaced(text, [], [])
    out, at = [], 0
    for start, end, kind, value, _ in found:
        new = " ".join(written(k, text[start:end], surrogate(k, v, attempts.get((k, v), 0), key)) for k, v in parts_of(kind, value))
        out += [text[at:start], new]
        at = end
    return Replaced("".join(out) + text[at:], [f[2] for f in found], [x for f in found for x in f[:2]])


def settled(entities: DataFrame, key: bytes) -> DataFrame:
    """``entities`` (kind, value: distinct) with attempt and surrogate; no surrogate twice, none a real value.

    Of entities with one surrogate the first by (attempt, value) keeps it, the others try again, as long as there are
    any: later attempts draw from wider formats and longer names, of which there always are more than entities.
    """
    @F.pandas_udf("string")
    def draw(kind, value, attempt):
        import pandas as pd
        return pd.Series([surrogate(k, v, int(a), key) for k, v, a in zip(kind, value, attempt)], dtype=object)

    real = entities.select(F.col("kind").alias("_kind"), F.col("value").alias("_real"))
    now = staged(entities.withColumn("attempt", F.lit(0)).withColumn("surrogate", draw("kind", "value", F.lit(0))), "surrogates")
    rival = Window.partitionBy("kind", "surrogate").orderBy("attempt", "value")
    while True:
        checked = (now.withColumn("_place", F.row_number().over(rival))
                   .join(real, (F.col("kind") == F.col("_kind")) & (F.col("surrogate") == F.col("_real")), "left")
                   .withColumn("_again", (F.col("_place") > 1) | F.col("_real").isNotNull())
                   .select("kind", "value", "attempt", "surrogate", "_again"))
        checked = staged(checked, "checked")
        if checked.filter("_again").isEmpty():
            return now
        tried = (checked.filter("_again").withColumn("attempt", F.col("attempt") + 1)
                 .withColumn("surrogate", draw("kind", "value", "attempt")))
        before, now = now, staged(checked.filter("NOT _again").unionByName(tried).drop("_again"), "surrogates")
        released(before, checked)


def entities(docs: DataFrame) -> DataFrame:
    """The distinct (kind, value) in all whole texts."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {part for text in batch.column(0).to_pylist() for _, _, kind, value, _ in detect(text) for part in parts_of(kind, value)}
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen], pa.string()), pa.array([v for _, v in seen], pa.string())],
                                             names=["kind", "value"])

    return docs.select("text").mapInArrow(find, "kind STRING, value STRING").distinct()


def surrogate_pii(docs: DataFrame, key: bytes = KEY, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``pii_kinds`` and ``pii_spans`` (start and end of each entity in the
    text as it was) added; columns of these two names are replaced, all others stay.

    A text without entities, NULL or empty comes out as it was. Every row is rewritten by itself; equal rows come
    out equal. Entities that share a first choice are broadcast up to ``most_broadcast``, counted; beyond it
    each row gets its own through a join.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kept = docs.drop("pii_kinds", "pii_spans")
    found = staged(entities(kept), "entities")
    again = staged(settled(found, key).filter("attempt > 0").select("kind", "value", "attempt"), "again")
    added = StructType([StructField("pii_kinds", ArrayType(StringType())), StructField("pii_spans", ArrayType(LongType()))])
    names, at = kept.columns, kept.columns.index("text")

    def result(batch: pa.RecordBatch, done: list[Replaced], columns: int) -> pa.RecordBatch:
        arrays = [pa.array([d.text for d in done], pa.string()) if k == at else batch.column(k) for k in range(columns)]
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array([d.kinds for d in done], pa.list_(pa.string())), pa.array([d.spans for d in done], pa.list_(pa.int64()))],
            names=[*names, *added.fieldNames()])

    schema = StructType(kept.schema.fields + added.fields)
    if again.limit(most_broadcast + 1).count() <= most_broadcast:
        attempts = {(r[0], r[1]): r[2] for r in again.collect()}
        shared = spark.sparkContext.broadcast(attempts)

        def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield result(batch, [replace(t, shared.value, key) for t in batch.column(at).to_pylist()], len(names))

        return kept.mapInArrow(rewrite, schema)

    row = fresh(kept, "_row")
    numbered = staged(kept.withColumn(row, F.monotonically_increasing_id()), "numbered")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = sorted({(row, *part) for row, text in zip(*(c.to_pylist() for c in batch.columns))
                           for _, _, kind, value, _ in detect(text) for part in parts_of(kind, value)})
            yield pa.RecordBatch.from_arrays([pa.array([s[0] for s in seen], pa.int64()), pa.array([s[1] for s in seen], pa.string()),
                                              pa.array([s[2] for s in seen], pa.string())], names=["_of", "_kind", "_value"])

    # A row's list is bounded by its own text.
    own = (numbered.select(row, "text").mapInArrow(find, "_of BIGINT, _kind STRING, _value STRING")
           .join(again, (F.col("_kind") == F.col("kind")) & (F.col("_value") == F.col("value")))
           .groupBy("_of").agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("own"))
           .select(F.col("_of").alias(fresh(kept, "_of")), F.col("own").alias(fresh(kept, "_own"))))
    joined = (numbered.join(own, F.col(row) == F.col(own.columns[0]), "left")
              .select(*[F.col(f"`{n}`") for n in names], own.columns[1]))

    def rewrite_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [{(a["kind"], a["value"]): a["attempt"] for a in o or []} for o in batch.column(len(names)).to_pylist()]
            yield result(batch, [replace(t, o, key) for t, o in zip(batch.column(at).to_pylist(), own)], len(names))

    return joined.mapInArrow(rewrite_own, schema)
