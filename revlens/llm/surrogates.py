"""Personal data replaced by keyed surrogates of the same type, format, script and gender.

Entities are found by pattern, and each is known by its canonical form (letter case and separators aside), so that one
person's number is one entity however it is written: phones, social security numbers and bare digits are of one kind.
Names follow a title: all capitalised words up to the first that is none, lower-case particles between them ("van der")
aside. Each word of a name is an entity, so that full name, title with surname and bare surname get the same surrogates.
Where a document has a titled name, its words (initials aside) are names in the whole document, and so are known given
names and initials right before them. Words in lower case are no names, nor are the function words of `NOT_NAMES`.

A keyed hash of type and canonical form draws the surrogate:
digits for digits, letters for letters of the same script, case and kind; given names that tell a gender become names
of that gender. A title tells the gender of the given name behind it (the first of several words) where no list does or the list says
otherwise: "Mrs Robin Keller" and "Mr Robin Moss" have two given names, an untitled "Robin" is the one of its document if there is only one, else
a third. Such names are made of syllables with an ending of their gender. All distinct entities of the corpus then go through a collision check: surrogates that two entities
share, or that are real entities themselves, are drawn again until all are distinct. Every occurrence gets its entity's
surrogate in its own format. Only documents with entities are shuffled.

Null texts stay null, empty texts empty. Repeated rows get the same replacements. Overlapping finds keep the earlier,
then the longer. Everything but the text is passed through, whatever the columns are named. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import one_by_one, staged

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
PATTERNS = (
    ("email", re.compile(r"(?<![\w.%+-])[\w.%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")),
    ("secret", re.compile(r"(?i)\b(?:password|passwd|secret|token|api_?key)\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9+/_-]{8,})")),
    ("secret", re.compile(r"(?<!\w)(?:(?:AKIA|sk-|gh[pousr]_)([A-Za-z0-9]{16,}+)|([0-9A-Fa-f]{32,}+))(?!\w)")),
    ("ip", re.compile(rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\w]|\.\d)")),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]){9,30}(?!\w)")),
    ("phone", re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]\d{2,4}){2,5}(?!\w)|(?<![\w+-])\d{3}[ .-]\d{3}[ .-]\d{4}(?!\w)")),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("number", re.compile(r"(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)|(?<!\w)\d{7,}(?!\w)")),
)
TITLES = "Mr Mrs Ms Miss Mme Mlle Dr Prof Doctor Professor Herr Frau Señor Señora Monsieur Madame Господин Госпожа".split()
MALE_TITLES = frozenset("Mr Herr Señor Monsieur Господин".split())
FEMALE_TITLES = frozenset("Mrs Ms Miss Mme Mlle Frau Señora Madame Госпожа".split())
_BREAK = r"(?:[^\S\n]{0,8}\n)?[^\S\n]{0,8}"
_TITLE = re.compile(rf"\b(?:(?:{'|'.join(TITLES)})(?:\.|(?=\s)){_BREAK})+")
_NAME_WORD = re.compile(r"(?<!\w)(?:[^\W\d_]{1,2}['’])?[^\W\d_]+(?!\w)")
_GAP = re.compile(r"[ \xa0]{1,2}|-")
_INITIAL_GAP = re.compile(r"\.?[ \xa0]{0,2}-?")
_HINT = re.compile(r"[@0-9]|(?i:password|passwd|secret|token|api_?key)|Mr|Ms|Miss|Mme|Mlle|Dr|Prof|Doctor|Herr|Frau|Señor|Monsieur|Madame|Госп|AKIA|sk-|gh[pousr]_|[A-Fa-f]{32}")

# Given names that tell a gender.
MALE = ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Louis", "Marco", "Noah", "Oscar", "Paul", "Robert", "Simon", "Thomas", "Victor")
FEMALE = ("Alice", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Irene", "Julia", "Klara", "Laura", "Maria", "Nora", "Olga", "Paula", "Rosa", "Sofia", "Teresa", "Vera")

# Lower-case words inside a name, capitalised words that end one, and those that stand in names too but are not sought elsewhere.
PARTICLES = frozenset("van von der den de la le di da dos del du el bin ibn ter ten zu zur".split())
NOT_NAMES = frozenset(
    "a after all also although and any are as at because been before both but by can could did does each every for from had has have he here his how i if in is it its jr "
    "my nor not of on once or our she should since some sr such than that the their them then there these they this those though to until was we were what when where which "
    "while whose why with would yes you your ii iii iv "
    "aber als am auch auf aus bei das dem der die doch ein eine er es für hat ich ihr im in ist mit nach nicht nun oder seit sie sind und vom von vor war warum was wenn wer wie wir wo zu zum zur "
    "après avec ce cette dans des elle elles en est et il ils je les leur lui mais nous ou où par pour qui sans ses son sur un une vous "
    "con cuando del ella ellos en es esta este fue ha las los no para pero por que se si sin su sus un una y "
    "в и из к на не но о он она они от по с это".split()
) | {t.casefold() for t in TITLES}
EITHER = frozenset("an do few her many may more most no now one so who will yet ambassador chairman director judge justice mayor minister president secretary senator speaker".split())

GIVEN = frozenset(n.casefold() for n in MALE + FEMALE)
GENDERS = {n.casefold(): g for g, some in (("m", MALE), ("f", FEMALE)) for n in some}
MARK = "\x01"  # between a name and the gender that a title told; no name holds it
_SCRIPTS = (("aeiou", "bcdfghjklmnprstvwxyz"), ("аеиоу", "бвгдзклмнпрстфхц"), ("αεηιου", "βγδζκλμνπρστφχ"))
# Endings of made-up given names, by script as above.
_ENDINGS = {
    "m": (("an", "el", "en", "er", "in", "on", "or", "us"), ("ан", "ей", "ин", "ир", "ор"), ("ας", "ης", "ος")),
    "f": (("a", "ia", "ina", "ela", "ora", "ana", "isa"), ("а", "ия", "ина", "ана", "ора"), ("α", "η", "ια")),
}


def _name(text: str, at: int) -> list[tuple[int, int]]:
    """The places of the words of a name that begins there; none if the first word is no name."""
    out: list[tuple[int, int]] = []
    first = at
    while m := _NAME_WORD.match(text, at):
        word = m[0]
        if not (word in PARTICLES and (out or word not in ("der", "den", "zur") or at > first)):
            if _low(word) or word.casefold() in NOT_NAMES and not (len(word) == 1 and text[m.end() : m.end() + 1] == "."):
                break
            out.append(m.span())
        gap = (_INITIAL_GAP if len(word) == 1 else _GAP).match(text, m.end())
        if not gap or gap.end() == m.end():
            break
        at = gap.end()
    return out


def names(text: str) -> list[tuple[int, int]]:
    """(start, stop) of the titled names and of the other places where words of these names stand."""
    titled = {m.end(): words for m in _TITLE.finditer(text) if (words := _name(text, m.end()))}
    if not titled:
        return []
    known = {_folded(text[a:b]) for words in titled.values() for a, b in words} - EITHER
    out: list[tuple[int, int]] = []
    lead: tuple[int, int] | None = None  # given names and initials that a known word may follow
    at = 0
    while m := _NAME_WORD.search(text, at):
        start, at = m.span()
        if start in titled:
            at = titled[start][-1][1]
            out.append((titled[start][0][0], at))
            lead = None
            continue
        word, low = m[0], _folded(m[0])
        if lead and not _joined(text, lead[1], start):
            lead = None
        if len(word) > 1 and not _low(word) and low in known:
            start = lead[0] if lead else start
            if out and _joined(text, out[-1][1], start):
                start = out.pop()[0]
            out.append((start, at))
            lead = None
        elif not _low(word) and (low in GIVEN or len(word) == 1 and text[at : at + 1] == "."):
            lead = (lead[0] if lead else start, at)
        else:
            lead = None
    return out


def _joined(text: str, stop: int, start: int) -> bool:
    """Whether a word that ends and one that starts there are one name: one gap lies between them."""
    gap = _INITIAL_GAP if stop < 2 or not text[stop - 2].isalpha() else _GAP
    return stop < start and gap.fullmatch(text, stop, start) is not None


def _low(word: str) -> bool:
    """Whether a word is written small; d'Angelo is not."""
    return word[0].islower() and not re.match(r"\w\w?['’](?=\w)", word[:4]) or word.islower()


def _folded(word: str) -> str:
    return word.casefold().replace("’", "'")


def told_genders(text: str) -> tuple[dict[int, str], dict[str, str]]:
    """By place, the gender that a title tells of each word of a titled name ("" for none), and by given name the only one told in the text."""
    places: dict[int, str] = {}
    words: dict[str, set[str]] = {}
    for m in _TITLE.finditer(text):
        titles = set(re.findall(r"\w+", m[0]))
        male, female = bool(titles & MALE_TITLES), bool(titles & FEMALE_TITLES)
        name = [(a, b) for a, b in _name(text, m.end()) if text[a:b] not in PARTICLES]
        places |= dict.fromkeys((a for a, _ in name), "")
        if male != female and len(name) > 1 and name[0][1] - name[0][0] > 1:
            places[name[0][0]] = gender = "m" if male else "f"
            words.setdefault(_folded(text[slice(*name[0])]), set()).add(gender)
    return places, {word: min(some) for word, some in words.items() if len(some) == 1}


def entities(kind: str, text: str, start: int, stop: int, told: tuple[dict[int, str], dict[str, str]] = ({}, {})) -> list[dict]:
    """The entities of a place: the words of a name, or the one that it is; the first is marked. `told` are the text's `told_genders`."""

    def known(a: int, word: str) -> str:
        gender = told[0][a] if a in told[0] else told[1].get(word, "")
        return word + MARK + gender if gender and GENDERS.get(word) != gender else word

    if kind != "name":
        return [{"kind": "number" if kind in ("phone", "ssn") else kind, "start": start, "stop": stop, "value": canonical(kind, text[start:stop]), "first": True}]
    places = [m.span() for m in _NAME_WORD.finditer(text, start, stop) if text[m.start() : m.end()] not in PARTICLES]
    return [{"kind": kind, "start": a, "stop": b, "value": known(a, _folded(text[a:b])), "first": n == 0} for n, (a, b) in enumerate(places)]


def find(text: str | None) -> list[tuple[str, int, int]]:
    """(type, start, stop) of the entities, in order, none overlapping."""
    if not text or not _HINT.search(text):
        return []
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            group = m.lastindex or 0
            found.append((m.start(group), -m.end(group), order, kind))
    found += [(start, -stop, len(PATTERNS), "name") for start, stop in names(text)]
    out, at = [], 0
    for start, stop, _, kind in sorted(found):
        if start >= at:
            out.append((kind, start, -stop))
            at = -stop
    return out


def canonical(kind: str, value: str) -> str:
    """The form that all spellings of an entity share."""
    if kind in ("phone", "number", "ssn"):
        return re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    return value if kind == "secret" else value.casefold()


class Draw:
    """Numbers drawn from a keyed hash of an entity and an attempt, one after another."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.seed, self.key, self.block, self.left = f"{kind}\0{value}\0{attempt}".encode(), key, 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hashlib.blake2b(self.seed + self.block.to_bytes(4, "little"), key=self.key[:64]).digest()
            self.block += 1
        number, self.left = int.from_bytes(self.left[:4], "little"), self.left[4:]
        return number % n

    def like(self, c: str) -> str:
        """A character of the same kind: digit, vowel or consonant of the script in the same case; others stay."""
        if c.isascii() and c.isdigit():
            return str(self.below(10))
        low = c.lower()
        for vowels, consonants in _SCRIPTS:
            if low in vowels or low in consonants:
                new = (pool := vowels if low in vowels else consonants)[self.below(len(pool))]
                return new if c == low else new.upper()
        if c.isalpha():
            vowels, consonants = _SCRIPTS[1] if "Ѐ" <= c <= "ӿ" else _SCRIPTS[2] if "Ͱ" <= c <= "Ͽ" else _SCRIPTS[0]
            new = (vowels + consonants)[self.below(len(vowels + consonants))]
            return new if c == low else new.upper()
        return c


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """A surrogate for a canonical form. From the eighth attempt on it grows, so that narrow formats never run out."""
    draw, longer = Draw(key, kind, value, attempt), max(0, attempt - 7)
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4 + longer))
    if kind == "email":
        local, _, domain = value.partition("@")
        head, dot, top = domain.rpartition(".")
        return "".join(map(draw.like, local + "a" * longer)) + "@" + "".join(map(draw.like, head)) + dot + top
    if kind == "iban":
        return value[:2] + "".join(map(draw.like, value[2:] + "0" * longer))
    if kind == "name" and MARK in value:
        value, _, gender = value.partition(MARK)
        script = 1 if "Ѐ" <= value[0] <= "ӿ" else 2 if "Ͱ" <= value[0] <= "Ͽ" else 0
        vowels, consonants = _SCRIPTS[script]
        heads = [consonants[draw.below(len(consonants))] + vowels[draw.below(len(vowels))] for _ in range(max(1, len(value) // 3 - 1) + attempt // 4)]
        endings = _ENDINGS[gender][script]
        return "".join(heads) + consonants[draw.below(len(consonants))] + endings[draw.below(len(endings))]
    if kind == "name":
        longer = attempt if len(value) == 1 else longer
        parts = re.split(r"([ -])", value)
        for pool in (MALE, FEMALE):
            if parts[0] in {n.casefold() for n in pool}:
                parts[0] = "-".join(pool[draw.below(len(pool))].casefold() for _ in range(1 if attempt < 3 else 2))  # double names when single ones run out
                rest = range(2, len(parts), 2)
                break
        else:
            rest = range(0, len(parts), 2)
        for i in rest:
            keep = 1 if parts[i][-1:] in ("a", "а", "я") else 0  # an ending that tells the gender
            parts[i] = "".join(map(draw.like, parts[i][: len(parts[i]) - keep] + "n" * longer)) + parts[i][len(parts[i]) - keep :]
        return "".join(parts)
    if kind in ("phone", "number", "ssn"):
        return "".join(str((1 if i == 0 else 0) + draw.below(9 if i == 0 else 10)) for i in range(len(value) + longer))
    for digits in ("0123456789abcdef", "0123456789ABCDEF", "0123456789abcdefABCDEF"):
        if set(value) <= set(digits):
            return "".join(digits[draw.below(len(digits))] for _ in range(len(value) + longer))
    return "".join(map(draw.like, value + "0" * longer))


def rendered(kind: str, value: str, replacement: str) -> str:
    """The surrogate in the format of an occurrence: its separators, or its capitals."""
    if kind in ("phone", "number", "ssn", "iban"):
        left, out = iter(replacement), []
        for c in value:
            out.append(next(left, "") if c.isalnum() else c)
        return "".join(out) + "".join(left)
    if kind == "name":
        if value.isupper() and len(value) > 1:
            return replacement.upper()
        return re.sub(r"(^|[ '-])(\w)", lambda m: m[1] + m[2].upper(), replacement) if value[:1].isupper() else replacement
    if kind == "email" and value.isupper():
        return replacement.upper()
    return replacement


SPANS = "array<struct<kind:string,start:int,stop:int,value:string,first:boolean>>"


def _detected(docs: DataFrame, text: str, with_entities: bool) -> DataFrame:
    """(doc, spans) of the documents with entities, or (doc) of those without."""
    inner = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("value", pa.string()), ("first", pa.bool_())]))
        for batch in one_by_one(batches):
            rows, spans = [], []
            for row, value in enumerate(batch.column(0).field(text)):
                value = value.as_py()
                found = find(value)
                if bool(found) == with_entities:
                    rows.append(row)
                    told = told_genders(value) if any(k == "name" for k, _, _ in found) else ({}, {})
                    spans.append([e for k, a, b in found for e in entities(k, value, a, b, told)])
            if rows:
                doc = batch.column(0).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([doc, pa.array(spans, kind)] if with_entities else [doc], names=["doc", "spans"] if with_entities else ["doc"])

    doc = f"doc {inner.schema['doc'].dataType.simpleString()}"
    return inner.mapInArrow(run, f"{doc}, spans {SPANS}" if with_entities else doc)


def mapping(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, surrogate) of the distinct entities (kind, value); no two of a kind share a surrogate, and none is an entity.

    Each round draws for the entities that have none yet and keeps those that collide with nothing, the smallest of
    those that collide with each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            kinds, values, attempts = (batch.column(i).to_pylist() for i in range(3))
            drawn = [surrogate(key, k, v, n) for k, v, n in zip(kinds, values, attempts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(drawn, pa.string())], names=["kind", "value", "attempt", "surrogate"])

    pending = staged(entities.distinct(), "entities")
    real = pending.select("kind", F.substring_index("value", MARK, 1).alias("surrogate")).distinct()
    pending, done, attempt = pending.withColumn("attempt", F.lit(0)), None, 0
    while True:
        drawn = staged(pending.mapInArrow(run, "kind string, value string, attempt int, surrogate string"), "drawn")
        taken = real if done is None else real.union(done.select("kind", "surrogate"))
        first = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("value"))
        kept = staged(drawn.join(taken, ["kind", "surrogate"], "left_anti").withColumn("_n", first).where("_n = 1").select("kind", "value", "surrogate"), "surrogates")
        done, attempt = kept if done is None else done.union(kept), attempt + 1
        rest = drawn.join(kept, ["kind", "value"], "left_anti").select("kind", "value", F.lit(attempt).alias("attempt"))
        pending = staged(rest, "colliding")
        if pending.isEmpty():
            return done


def replace_pii(docs: DataFrame, key: bytes, text: str = "text", count: str | None = None) -> DataFrame:
    """The documents with every entity in the text replaced; `count` names a further column, how many were.

    A key must not be empty; without it the surrogates cannot be drawn again or linked to the entities.
    """
    if not key:
        raise ValueError("a key is needed")
    found = staged(_detected(docs, text, True).withColumn("row", F.monotonically_increasing_id()), "pii")
    spans = found.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    drawn = mapping(spans.select("kind", "value"), key)
    named = spans.join(drawn, ["kind", "value"]).groupBy("row").agg(F.collect_list(F.struct("start", "stop", "kind", "surrogate", "first")).alias("changes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            out, n = [], []
            for value, changes in zip(batch.column(0).field(text), batch.column(1), strict=True):
                value, changes, parts, at = value.as_py(), changes.as_py(), [], 0
                for c in sorted(changes, key=lambda c: c["start"]):
                    parts += [value[at : c["start"]], rendered(c["kind"], value[c["start"] : c["stop"]], c["surrogate"])]
                    at = c["stop"]
                out.append("".join([*parts, value[at:]]))
                n.append(sum(c["first"] for c in changes))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), pa.array(n, pa.int64())], names=["doc", "body", "n"])

    doc = f"doc {found.schema['doc'].dataType.simpleString()}"
    changed = found.select("row", "doc").join(named, "row").select("doc", "changes").mapInArrow(run, f"{doc}, body string, n long")
    plain = _detected(docs, text, False).select("doc", F.col("doc").getField(text).alias("body"), F.lit(0).cast("long").alias("n"))
    both = changed.union(plain)
    columns = [F.col("body").alias(c) if c == text else F.col("doc").getField(c).alias(c) for c in docs.columns if c != count]
    return both.select(*columns, *([F.col("n").alias(count)] if count else []))
