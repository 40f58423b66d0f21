"""Personal data replaced by surrogates of the same kind.

Detected entities get keyed replacements that keep kind, format and, for names, script, gender and letter case. One entity
has one surrogate wherever it occurs, so references stay together. Distinct entities keep distinct surrogates: all entities
of the corpus are compared in a table, and of those that would clash all but the first draw again.

A name is found behind a form of address or where a known given name begins it, and then in all of its document wherever one
of its words stands alone, written large. Not found: names that no form of address and no known given name introduces in
their document, a given name that is met only alone, and single letters away from the name. A capitalised common word that is
also a name of its document is replaced with it.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.common import bounded, table, text_or_empty
from riskweave.session import materialize

# Forms of address and the gender they show, common given names, syllables.
TITLES = {"mr": "m", "mister": "m", "sir": "m", "herr": "m", "herrn": "m", "señor": "m", "sr": "m", "don": "m", "monsieur": "m",
          "mrs": "f", "ms": "f", "miss": "f", "madam": "f", "frau": "f", "señora": "f", "señorita": "f", "sra": "f", "srta": "f",
          "doña": "f", "madame": "f", "mme": "f", "mademoiselle": "f", "mlle": "f", "dr": "n", "prof": "n", "professor": "n",
          "doctor": "n", "г-н": "m", "господин": "m", "г-жа": "f", "госпожа": "f", "κύριος": "m", "κυρία": "f"}
GIVEN = {"f": {"anna", "maria", "mary", "sarah", "emma", "laura", "julia", "elena", "sofia", "marie", "claire", "susan", "linda",
               "carmen", "lucia", "sabine", "ursula", "jane", "alice", "isabel", "мария", "анна", "елена", "ольга", "μαρία", "ελένη"},
         "m": {"john", "james", "peter", "paul", "michael", "david", "hans", "karl", "thomas", "robert", "carlos", "juan", "jose",
               "miguel", "pierre", "jean", "louis", "antonio", "george", "henri", "иван", "пётр", "сергей", "николай", "γιώργος",
               "νίκος"}}
SYLLABLES = {
    "latin": ("bcdfglmnprstv", "aeiou", {"f": "a", "m": "n", "n": "s"}),
    "cyrillic": ("бвгдклмнпрст", "аеиоу", {"f": "а", "m": "н", "n": "с"}),
    "greek": ("βγδκλμνπρστ", "αειου", {"f": "α", "m": "ν", "n": "ς"}),
}
KINDS = ("email", "phone", "ip", "card", "secret", "name")

_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
_DIGITS = re.compile(
    r"(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?|\d{1,4}[ .-]?)\d{2,4}(?:[ .-]?\d{2,4}){1,3}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w))"
    r"|(?P<card>(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]))")
_SECRET = re.compile(
    r"(?i:\b(?:api[_-]?key|access[_-]?key|secret[_-]?key|secret|token|password|passwd|pwd|auth)\b)\s*[:=]\s*"
    r"(?:\"([^\"\s]{6,})\"|'([^'\s]{6,})'|((?=[\w+/=.-]*\d)[\w+/=.-]{12,}))")
_TITLE = re.compile(
    r"\b(?=[" + "".join(sorted({f(t[0]) for t in TITLES for f in (str.lower, str.upper)})) + r"])("
    + "|".join(sorted(map(re.escape, TITLES), key=len, reverse=True)) + r")\b\.?[ \u00a0](?=[^\W\d_])", re.IGNORECASE)
_GIVEN = re.compile("(?=[" + "".join(sorted({w[0].upper() for known in GIVEN.values() for w in known})) + r"])(?<![\w'’-])(?:" + "|".join(
    sorted((re.escape(f(w)) for known in GIVEN.values() for w in known for f in (str.title, str.upper)), key=len, reverse=True))
    + r")(?=[ \u00a0][^\W\d_])")
_WORD = re.compile(r"[^\W\d_](?:[\w'’-]*\w)?")
_SPOTS = re.compile(r"[(+\d][\d .()+-]{5,}\d")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def script_of(word: str) -> str:
    name = unicodedata.name(next((c for c in word if c.isalpha()), "a"), "")
    return "cyrillic" if name.startswith("CYRILLIC") else "greek" if name.startswith("GREEK") else "latin"


def _name_words(text: str, at: int) -> list[tuple[int, int]]:
    """The up to three words of a name that begins at a place; it goes on as long as its words are written large."""
    kept: list[tuple[int, int]] = []
    while len(kept) < 3:
        w = _WORD.match(text, at)
        if not w or not w[0][0].isupper() or w[0].lower() in TITLES:
            break
        owned = len(w[0]) > 3 and w[0][-2:].lower() in ("'s", "’s")
        kept.append((w.start(), w.end() - 2 * owned))
        if owned or text[w.end():w.end() + 1] not in (" ", "\u00a0"):
            break
        at = w.end() + 1
    return kept


def _named(text: str, words: list[tuple[int, int]], gender: str) -> Iterator[tuple[int, int, str, str]]:
    """The words of a name as entities: given names with their gender, and the surname."""
    for i, (start, end) in enumerate(words):
        low = text[start:end].lower()
        if i < len(words) - 1:
            shown = gender if gender != "n" else next((g for g in "fm" if low in GIVEN[g]), "n")
            yield start, end, "name", f"{shown}:{low}"
        else:
            yield start, end, "name", f"s:{low}"


def _names(text: str) -> list[tuple[int, int, str, str]]:
    """Names behind forms of address, names that a known given name begins, and their words wherever else they stand."""
    found: list[tuple[int, int, str, str]] = []
    title = _TITLE.search(text)
    while title:
        words = _name_words(text, title.end())
        found += _named(text, words, TITLES[title[1].lower()])
        title = _TITLE.search(text, words[-1][1] if words else title.end())
    for m in _GIVEN.finditer(text):
        words = _name_words(text, m.start())
        if len(words) > 1:
            found += _named(text, words, "n")
    if found:
        known: dict[str, str] = {}
        forms: set[str] = set()
        for start, end, _, canonical in found:
            word = text[start:end]
            if len(word) > 1:
                low = word.lower()
                if low not in known or canonical[0] == "s" != known[low][0]:
                    known[low] = canonical
                forms |= {word, word.upper(), word[0] + word[1:].lower()}
        if forms:
            bare = re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, forms), key=len, reverse=True)) + r")(?!\w)")
            found += [(m.start(), m.end(), "name", known[m[0].lower()]) for m in bare.finditer(text) if m[0].lower() in known]
    return found


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """Entities as (start, end, kind, canonical form), in order and without overlap.

    The canonical form is the same for all spellings of an entity: digits of phones and cards, lower case of addresses and
    names. Given names bear their gender and surnames stand alone, so that a name with and without the given name agree.
    """
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in _EMAIL.finditer(text)]
    if any(c in text for c in "=:"):
        for m in _SECRET.finditer(text):
            group = next(g for g in (1, 2, 3) if m[g] is not None)
            found.append((m.start(group), m.end(group), "secret", m[group]))
    for spot in _SPOTS.finditer(text):
        for m in _DIGITS.finditer(text, spot.start(), spot.end() + 2):
            kind, value = m.lastgroup, m[0]
            digits = re.sub(r"\D", "", value)
            if kind == "ip":
                if all(int(p) <= 255 for p in value.split(".")):
                    found.append((m.start(), m.end(), kind, value))
            elif kind == "phone":
                if 8 <= len(digits) <= 15:
                    found.append((m.start(), m.end(), kind, ("+" if value[0] == "+" else "") + digits))
            elif 13 <= len(digits) <= 19 and digits[0] != "0" and luhn(digits):
                found.append((m.start(), m.end(), kind, digits))
    found += _names(text)
    found.sort(key=lambda e: (e[0], -e[1]))
    out: list[tuple[int, int, str, str]] = []
    for e in found:
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


class _Draws:
    """Numbers that follow from the key, the entity and the attempt alone."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int):
        self.key, self.seed, self.round = key, f"{kind}\0{canonical}\0{attempt}".encode(), 0
        self.left = b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.new(self.key, self.seed + b"\0" + str(self.round).encode(), hashlib.sha256).digest()
            self.round += 1
        number, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return number * n >> 32


def _like(text: str, draws: _Draws) -> str:
    """Letters for letters and digits for digits; hexadecimal digits stay such where the text has no others."""
    hexadecimal = re.fullmatch(r"[0-9a-f]{16,}", text) is not None and not text.isdigit()
    out = []
    for c in text:
        if hexadecimal:
            out.append("0123456789abcdef"[draws.below(16)])
        elif c.isdigit():
            out.append(str(draws.below(10)))
        elif c.isalpha():
            letter = chr(97 + draws.below(26))
            out.append(letter.upper() if c.isupper() else letter)
        else:
            out.append(c)
    return "".join(out)


#: Attempts after which a surrogate gets another letter or digit.
LENGTHEN = 6


def surrogate(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """The replacement of an entity, in canonical form, never the entity itself.

    Later attempts are longer: where all short values occur in the corpus, none of them is free.
    """
    more = attempt // LENGTHEN
    for turn in range(1000):
        draws = _Draws(key, kind, canonical, attempt * 1000 + turn)
        if kind == "email":
            local, _, domain = canonical.partition("@")
            labels = domain.split(".")
            made = _like(local + "x" * more, draws) + "@" + ".".join([*(_like(x, draws) for x in labels[:-1]), labels[-1]])
        elif kind == "ip":
            made = ".".join(str(1 + draws.below(254)) for _ in range(4))
            if more:  # the range for documentation of the longer addresses
                made = "2001:db8:" + ":".join(f"{draws.below(1 << 16):x}" for _ in range(6))
        elif kind == "phone":
            keep = 2 if canonical[0] == "+" else 0  # the first digit of the country
            made = canonical[:keep] + str(2 + draws.below(8)) + _like(canonical[keep + 1:] + "0" * more, draws)
        elif kind == "card":
            body = canonical[0] + _like(canonical[1:-1] + "0" * more, draws)
            made = next(body + str(d) for d in range(10) if luhn(body + str(d)))
        elif kind == "name":
            role, _, word = canonical.partition(":")
            consonants, vowels, endings = SYLLABLES[script_of(word)]
            size = min(6, max(2, len(word) // 2)) + attempt // 8  # longer ones where short ones are taken
            made = role + ":" + "".join(
                consonants[draws.below(len(consonants))] + vowels[draws.below(len(vowels))] for _ in range(size)
            ) + (endings[role] if role in endings and role != "f" else "")
            if role == "f":
                made = made[:-1] + endings["f"]
        else:
            made = _like(canonical + "0" * more, draws)
        if made != canonical:
            return made
    # nothing in the entity can be drawn anew
    return hmac.new(key, canonical.encode(), hashlib.sha256).hexdigest()[:12]


def written(kind: str, original: str, made: str) -> str:
    """A surrogate in the format of the occurrence: separators, and the letter case of names and addresses."""
    if kind in ("phone", "card"):
        digits = iter(made.lstrip("+"))
        return "".join(next(digits) if c.isdigit() else c for c in original) + "".join(digits)
    if kind == "name":
        made = made.partition(":")[2]
        return made.upper() if original.isupper() and len(original) > 1 else made[0].upper() + made[1:]
    if kind == "email" and len(original) == len(made):
        return "".join(m.upper() if o.isupper() else m for o, m in zip(original, made))
    return made


def replaced(text: str, key: bytes, attempts: dict[tuple[str, str], int], memo: dict) -> tuple[str, list[str]]:
    """The text with surrogates, and the kinds replaced."""
    parts, kinds, at = [], [], 0
    for start, end, kind, canonical in detect(text):
        attempt = attempts.get((kind, canonical), 0)
        made = memo.get((kind, canonical, attempt))
        if made is None:
            if len(memo) >= 200_000:
                memo.clear()
            made = memo[kind, canonical, attempt] = surrogate(key, kind, canonical, attempt)
        parts += [text[at:start], written(kind, text[start:end], made)]
        kinds.append(kind)
        at = end
    parts.append(text[at:])
    return "".join(parts), kinds


_ENTITY = "kind string, canonical string"


def _entities(with_doc: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows += [(key, *e) for e in {(kind, canonical) for _, _, kind, canonical in detect(value.as_py())}]
            if not with_doc:
                rows = [(0, *e) for e in {r[1:] for r in rows}]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.string())], ["row", "kind", "canonical"])

    return run


def _with_surrogate(key: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [surrogate(key, *e) for e in zip(*[c.to_pylist() for c in batch.columns])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())],
                                             ["kind", "canonical", "attempt", "made"])

    return run


def settle(entities: DataFrame, key: bytes, make: Callable = _with_surrogate) -> DataFrame | None:
    """The distinct entities that need a later attempt (kind, canonical, attempt), or None if none does.

    A surrogate clashes if another entity has it too, or if it is itself an entity of the corpus. As later attempts
    are longer, the rounds come to an end.
    """
    shape = f"{_ENTITY}, attempt int, made string"
    drawn = materialize(entities.withColumn("attempt", F.lit(0)).mapInArrow(make(key), shape), "surrogates")
    originals = drawn.select("kind", F.col("canonical").alias("made"))
    clashed = False
    while True:
        shared = drawn.groupBy("kind", "made").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("attempt", "canonical")).alias("first")).filter("n > 1")
        real = drawn.select("kind", "made").join(originals, ["kind", "made"], "left_semi").distinct()
        taken = shared.select("kind", "made", "first").unionByName(
            real.withColumn("first", F.lit(None).cast(shared.schema["first"].dataType)))
        # one row per clashing surrogate; a real entity's value is free for none
        taken = materialize(taken.groupBy("kind", "made").agg(
            F.max("first").alias("first"), F.max(F.col("first").isNull()).alias("real")), "clashes")
        if taken.isEmpty():
            break
        clashed = True
        judged = drawn.join(taken, ["kind", "made"], "left")
        loses = F.coalesce(F.col("real") | (F.struct("attempt", "canonical") != F.col("first")), F.lit(False))
        judged = judged.withColumn("loses", loses)
        again = judged.filter("loses").select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))
        drawn = materialize(judged.filter(~F.col("loses")).select(drawn.columns).unionByName(
            again.mapInArrow(make(key), shape)), "surrogates")
    return drawn.filter("attempt > 0").select("kind", "canonical", "attempt") if clashed else None


def replace_private(df: DataFrame, key: bytes, doc_key: str = "doc_id", text: str = "text",
                    make: Callable = _with_surrogate) -> DataFrame:
    """``df`` with surrogates in the text column, and a last column ``private_kinds``, the kinds replaced, in order.

    All other columns, of whatever name, stay as they are; null texts stay null, and rows may repeat. A column named
    ``private_kinds`` is replaced. The key is secret: with another one all surrogates change.
    """
    rows = bounded(df).select(F.xxhash64(doc_key).alias("row"), text_or_empty(text).alias("text"))
    entities = rows.mapInArrow(_entities(False), f"row long, {_ENTITY}").select("kind", "canonical").distinct()
    late = settle(entities, key, make)
    base = df.drop("private_kinds")
    names = base.columns
    place = names.index(text)
    longest = "_" * (1 + max(map(len, names)))  # no column's name
    late_name, row_name = longest + "late", longest + "row"
    held_back = "array<struct<kind:string,canonical:string,attempt:int>>"
    if late is None:
        joined = base.select(*[F.col(f"`{c}`") for c in names], F.lit(None).cast(held_back).alias(late_name))
    else:
        per_row = rows.mapInArrow(_entities(True), f"row long, {_ENTITY}").join(late, ["kind", "canonical"]).groupBy("row").agg(
            F.collect_set(F.struct("kind", "canonical", "attempt")).alias(late_name)).withColumnRenamed("row", row_name)
        joined = base.withColumn(row_name, F.xxhash64(doc_key)).join(per_row, row_name, "left").drop(row_name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in batches:
            texts, kinds = [], []
            for value, late_rows in zip(batch.column(place), batch.column(len(names)).to_pylist()):
                value = value.as_py()
                attempts = {(x["kind"], x["canonical"]): x["attempt"] for x in late_rows or []}
                new, found = replaced(value, key, attempts, memo) if value is not None else (None, [])
                texts.append(new)
                kinds.append(found)
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            columns[-1] = pa.array(kinds, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*names, "private_kinds"])

    shape = base.schema.add("private_kinds", T.ArrayType(T.StringType()))
    return joined.mapInArrow(run, shape)


def op10_pii_surrogates(spark: SparkSession, sf_dir: str, key: bytes = b"check key") -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_private(docs, key).select(
        "doc_id", "text", F.size("private_kinds").alias("n_replaced"), F.array_join("private_kinds", ",").alias("kinds"))
