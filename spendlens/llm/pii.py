"""Surrogates for personal data: keyed, of the same type and format, distinct and coreferent.

Detection: e-mail and IP addresses, payment cards (Luhn), phone numbers, social security and bank account
numbers, access keys and other secrets, and names after a title or a listed given name.

Surrogates: an entity's value decides its surrogate through a keyed permutation (a Feistel network over the
letters and digits, each kept in its class: digit, hex digit, capital, small letter, letter of the same script and block of
any other script; signs only where there is nothing else), so one entity has one surrogate in all documents (coreference)
and two entities of one format have two (distinctness). Cards keep a valid check digit, addresses stay in range, phone numbers keep their country code
and punctuation, and e-mail domains keep the reserved ending they have. A name's words are replaced each by itself, with or
without a title or other words beside them: listed given names inside the list of their gender and script, all others
letter by letter; so "Mrs Anna Smith", "Anna Smith" and "Mr Smith" share what they have in common.

Key: whoever knows it can turn the surrogates back, so it is a parameter (``key``) or the setting
``spark.spendlens.surrogateKey`` (hex); without either one is drawn for the application and forgotten with it, so
surrogates then agree inside one application only.

Collision check: over the distinct entities of the corpus (of names the words, without listed given names), a surrogate that another entity shares or that is
itself an entity of the corpus is drawn anew with the next tweak, until none is left. A format may hold no free value
(two letters of a corpus with all such names): from GROW_AFTER attempts on, names, addresses of mail and secrets get one letter
more each time, and beyond MAX_ATTEMPTS the job stops and names the type. A value without any character that could
change gets a numbered surrogate. Only these exceptions are kept as a table; it is joined to the documents by the entities they hold.

Edge cases: null text stays null, empty text empty; a text without entities is unchanged; repeated rows get
equal results; entities are found in whole texts; the input's own columns are kept whatever their names, the result's are in
one struct, ``private`` (with ``_`` after it where the input has that column); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import secrets
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ship, table, written

ROUNDS = 8
GROW_AFTER, MAX_ATTEMPTS = 8, 64
KEY_SETTING = "spark.spendlens.surrogateKey"
_DRAWN: dict[str, bytes] = {}

# fixed values: given names by script and gender
GIVEN = {
    ("latin", "f"): "Alice Anna Carla Clara Elena Emma Eva Greta Ines Julia Laura Lucia Maria Marie Nina Olga Paula Rosa Sara Sofia".split(),
    ("latin", "m"): "Adam Albert Bruno Carlos David Emil Felix George Hugo James John Jorge Lucas Mark Oscar Paul Peter Robert Simon Thomas".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга Софья Татьяна".split(),
    ("cyrillic", "m"): "Андрей Борис Виктор Дмитрий Иван Максим Николай Олег Павел Сергей".split(),
}
TITLES = {"f": "Mrs Ms Miss Frau Mme Madame Mlle Señora Sra Doña".split(), "m": "Mr Herr Monsieur Señor Sr Don".split(), "": "Dr Prof".split()}

_GIVEN = {name: kind for kind, names in GIVEN.items() for name in names}
_GENDER = {t: g for g, titles in TITLES.items() for t in titles}
_CAP = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+(?:[-'][A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+)?"
PATTERNS = [
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+"),
    ("secret", r"(?:(?<![A-Za-z])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?)(?P<secret_value>[^\s\"'<>]{6,})"),
    ("key", r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\b(?:ghp|gho|ghs|glpat|xox[abp])[_-][A-Za-z0-9_-]{16,}|\bsk[_-](?:live[_-]|test[_-])?[A-Za-z0-9]{16,}|\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    ("hex", r"\b(?=[0-9a-f]*[a-f])(?=[0-9a-f]*\d)[0-9a-f]{32,}\b"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b"),
    ("card", r"(?<![\d.])\d(?:[ -]?\d){12,18}(?![\d])"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("phone", r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}(?:[ .-]?\d{2,4}){1,2}(?![\w-]|\.\d)|(?<![\w.])\+\d(?:[ .-]?\d){7,14}(?!\d)"),
    ("name", rf"\b(?:(?:{'|'.join(t for ts in TITLES.values() for t in ts)})\.? (?P<titled>{_CAP}(?: {_CAP}){{0,2}})|(?P<listed>(?:{'|'.join(_GIVEN)}) {_CAP}(?: {_CAP})?))\b"),
]
FIND = re.compile("|".join(f"(?P<{kind}>{p})" for kind, p in PATTERNS))
# what every match holds: a digit, a sign of an address or secret, a title or a listed name; most texts' parts have none
MAYBE = re.compile(r"[\d@=:]|\b(?:" + "|".join([t for ts in TITLES.values() for t in ts] + list(_GIVEN)) + r")\b")


def luhn(digits: str) -> bool:
    total = sum(d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for k, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, value) of each entity, in order, without overlap."""
    out = []
    if not MAYBE.search(text):
        return out
    for m in FIND.finditer(text):
        kind, (a, b) = m.lastgroup, m.span()
        if kind not in _KINDS:
            kind = next(k for k in _KINDS if m.group(k) is not None)
        if kind == "secret":
            a, b = m.span("secret_value")
        elif kind == "name":
            a, b = m.span("titled") if m.group("titled") else m.span("listed")
        value = text[a:b]
        if kind == "card":
            digits = re.sub(r"\D", "", value)
            if not luhn(digits) and (len(digits) != 16 or len(set(digits)) < 4):
                continue
        if kind == "name" and m.group("titled"):
            kind = "name_" + _GENDER[text[m.start():a].rstrip(" .")] if _GENDER[text[m.start():a].rstrip(" .")] else "name"
        out.append((a, b, kind, value))
    return out


_KINDS = [k for k, _ in PATTERNS]
_CLASSES = ["0123456789", UPPER, LOWER, "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
            "àáâãäåæçèéêëìíîïñòóôõöøùúûüý", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"]
_CLASS = {c: s for s in _CLASSES for c in s}
_HEX = {c: "0123456789abcdef" for c in "0123456789abcdef"}


_SIGNS = "!#$%&()*+,-./:;=?@[]^_{|}~"


@lru_cache(maxsize=4096)
def _block(first: int, category: str, script: str) -> str:
    """Characters of one category and script (the first word of their names) among the 256 from ``first`` on."""
    found = [chr(x) for x in range(first, first + 256)]
    return "".join(c for c in found if unicodedata.category(c) == category and unicodedata.name(c, "").split(" ")[0] == script)


def class_of(c: str, signs: bool = False) -> str:
    """The characters ``c`` may become, itself included; empty where it stays. ``signs``: signs may change, too."""
    if c in _CLASS:
        return _CLASS[c]
    if c < "\x80":
        return _SIGNS if signs and c in _SIGNS else ""
    category = unicodedata.category(c)
    if category[0] in "LN" or signs and category[0] in "PSM":
        found = _block(ord(c) & ~255, category, unicodedata.name(c, "").split(" ")[0])
        # the letters that have a class of their own are in no other
        found = "".join(x for x in found if x not in _CLASS)
        return found if len(found) > 1 else ""
    return ""


def application_key(spark) -> bytes:
    """The key of the session's setting, else one drawn for the application."""
    given = spark.conf.get(KEY_SETTING, None)
    if given:
        return bytes.fromhex(given)
    return _DRAWN.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


class Surrogates:
    """The keyed replacements; the same key gives the same ones."""

    def __init__(self, key: bytes):
        if len(key) < 8:
            raise ValueError("the key of the surrogates has to be 8 bytes long at least")
        self.key = key
        self._next: dict[tuple[str, str], dict[str, str]] = {}

    def _word(self, tag: str) -> int:
        return int.from_bytes(hmac.new(self.key, tag.encode("utf-8", "surrogatepass"), hashlib.sha256).digest()[:16])

    def permute(self, value: str, tweak: str, classes: dict[str, str] | None = None) -> str:
        """Another string of the same format: an alternating Feistel network, so different values stay different."""
        sets = [classes.get(c, "") for c in value] if classes else [class_of(c) for c in value]
        if not classes and not any(sets):
            sets = [class_of(c, True) for c in value]
        at = [k for k, s in enumerate(sets) if s]
        sets = [sets[k] for k in at]
        d = [s.index(value[k]) for k, s in zip(at, sets)]
        if len(d) < 2:
            if d:
                d[0] = (d[0] + 1 + self._word(f"{tweak}|{sets[0]}") % (len(sets[0]) - 1)) % len(sets[0])
        else:
            half = len(d) // 2
            shape = "".join(s[0] for s in sets)
            for r in range(ROUNDS):
                left, right = (range(half), range(half, len(d))) if r % 2 else (range(half, len(d)), range(half))
                w = self._word(f"{tweak}|{shape}|{r}|{','.join(str(d[k]) for k in right)}")
                for n, k in enumerate(left):
                    if n % 16 == 15:
                        w = self._word(f"{w}")
                    d[k] = (d[k] + w) % len(sets[k])
                    w //= len(sets[k])
        out = list(value)
        for k, s, x in zip(at, sets, d):
            out[k] = s[x]
        return "".join(out)

    def _given(self, word: str) -> str:
        """The given name after ``word`` in a keyed round of its list: a bijection, of which one pair tells no other."""
        kind = _GIVEN[word]
        if kind not in self._next:
            names = sorted(GIVEN[kind], key=lambda n: self._word(f"given|{n}"))
            self._next[kind] = dict(zip(names, names[1:] + names[:1]))
        return self._next[kind][word]

    def name(self, word: str, attempt: int) -> str:
        """A word of a name by itself: a listed given name in the list of its gender and script, any other letter by letter."""
        if word in _GIVEN:
            return self._given(word)
        grown = _grown("name", word, attempt)
        for extra in range(1000):
            out = self.permute(grown, f"name|{attempt}|{extra}")
            if out != word and out not in _GIVEN:
                return out
        return self.numbered("name", word, attempt)

    def numbered(self, kind: str, value: str, attempt: int) -> str:
        """The last resort, for a value none of whose characters can change."""
        return f"{kind}-{self._word(f'numbered|{kind}|{attempt}|{value}') % 10 ** 16:016d}"

    def surrogate(self, kind: str, value: str, attempt: int = 0) -> str:
        """The replacement of an entity; ``attempt`` is its tweak. It differs from the value."""
        if kind.startswith("name"):
            return " ".join(self.name(w, attempt) for w in value.split(" "))
        old, value = value, _grown(kind, value, attempt)
        for extra in range(1000):
            out = self._drawn(kind, value, f"{kind}|{attempt}|{extra}")
            # cycle walking: outside the type's range the permutation is applied again
            if out != old and (kind != "ip" or out.split(".")[0] not in ("0", "127", "255")):
                return out
        return self.numbered(kind, old, attempt)

    def _drawn(self, kind: str, value: str, tweak: str) -> str:
        if kind == "email":
            local, _, domain = value.partition("@")
            labels = domain.split(".")
            keep = 2 if labels[-2] == "example" or len(labels) == 2 and len(labels[0]) < 3 else 1
            # the whole address is permuted at once, but for the domain's kept ending
            moved = self.permute(local + "@" + ".".join(labels[:-keep]), tweak)
            return (moved if labels[:-keep] else moved.rstrip("@") + "@") + ("." if labels[:-keep] else "") + ".".join(labels[-keep:])
        if kind == "ip":
            n = 0
            for x in value.split("."):
                n = n * 256 + int(x)
            n = int(self.permute(format(n, "08x"), tweak, _HEX), 16)
            return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
        if kind == "card":
            digits = re.sub(r"\D", "", value)
            body = digits[0] + self.permute(digits[1:-1], f"{tweak}|{digits[0]}{digits[-1] if not luhn(digits) else ''}")
            check = next(c for c in "0123456789" if luhn(body + c)) if luhn(digits) else digits[-1]
            at = iter(body + check)
            return "".join(next(at) if c.isdigit() else c for c in value)
        cut = 0
        if kind == "phone":
            lead = re.match(r"\+\d{1,3}(?=\D)", value)
            cut = lead.end() if lead else 0
        elif kind == "key":
            cut = (re.match(r"AKIA|ASIA|[a-z]+[_-](?:live[_-]|test[_-])?|eyJ", value) or re.match("", value)).end()
        elif kind == "iban":
            cut = 2
        elif kind in ("hex", "secret") and all(c in _HEX for c in value):
            return self.permute(value, tweak, _HEX)
        else:
            return self.permute(value, tweak)
        return value[:cut] + self.permute(value[cut:], f"{tweak}|{value[:cut]}")


def _grown(kind: str, value: str, attempt: int) -> str:
    """``value`` with a letter more for each attempt from GROW_AFTER on, where its type allows any length."""
    more = attempt - GROW_AFTER + 1
    if more <= 0 or kind not in ("name", "email", "secret", "key", "hex"):
        return value
    head, at, tail = value.partition("@") if kind == "email" else (value, "", "")
    last = next((c for c in reversed(head) if class_of(c)), "x")
    return head + last * more + at + tail


def parts(kind: str, value: str) -> list[tuple[str, str]]:
    """The (type, value) that the collision check knows an entity by: a name's words but for listed given names, whose
    permutation has no collisions; all others whole."""
    return [("name", w) for w in value.split(" ") if w not in _GIVEN] if kind.startswith("name") else [(kind, value)]


class NoFreeSurrogate(RuntimeError):
    """Every surrogate of some entities is taken; the message names their types."""


def held_entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """(h, kind, value): the distinct entities, of names the words, of every different text; ``h`` is the text's hash."""
    ship(docs.sparkSession)

    @F.pandas_udf("array<struct<kind:string,value:string>>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted({x for _, _, k, v in find(t) for x in parts(k, v)}) if isinstance(t, str) else [] for t in texts])

    t = F.col(f"`{text}`")
    return docs.select(F.xxhash64(t).alias("h"), F.explode(found(t)).alias("e")).select("h", "e.*").distinct()


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """The distinct (type, value) of the corpus, of names the words."""
    return held_entities(docs, text).select("kind", "value").distinct()


def exceptions(distinct: DataFrame, key: bytes) -> DataFrame | None:
    """(kind, value, attempt) of the entities whose first surrogates collide; None if there are none."""
    @F.pandas_udf("string")
    def drawn(kind: pd.Series, value: pd.Series, attempt: pd.Series) -> pd.Series:
        keyed = Surrogates(key)
        return pd.Series([keyed.surrogate(k, v, int(a)) for k, v, a in zip(kind, value, attempt)])

    family = F.split_part(F.col("kind"), F.lit("_"), F.lit(1))
    now = written(distinct.withColumn("attempt", F.lit(0)).withColumn("new", drawn("kind", "value", "attempt")), "pii-entities")
    real = distinct.select(family.alias("family"), F.col("value").alias("new")).distinct()
    for attempt in range(MAX_ATTEMPTS + 1):
        shared = now.groupBy(family.alias("family"), "new").agg(F.count("*").alias("n"), F.min(F.struct("kind", "value")).alias("first"))
        clash = (now.withColumn("family", family).join(shared.where("n > 1"), ["family", "new"])
                 .where(F.struct("kind", "value") != F.col("first")).select("kind", "value"))
        is_real = now.withColumn("family", family).join(real, ["family", "new"], "left_semi").select("kind", "value")
        again = written(clash.unionByName(is_real).distinct(), "pii-again")
        if again.isEmpty():
            return now.where("attempt > 0").select("kind", "value", "attempt") if attempt else None
        redrawn = now.join(again, ["kind", "value"], "left_semi").withColumn("attempt", F.col("attempt") + 1)
        redrawn = redrawn.withColumn("new", drawn("kind", "value", "attempt"))
        now = written(now.join(again, ["kind", "value"], "left_anti").unionByName(redrawn), "pii-entities")
    kinds = sorted(r["kind"] for r in again.select("kind").distinct().collect())
    raise NoFreeSurrogate(f"no free surrogate after {MAX_ATTEMPTS} attempts for entities of type {', '.join(kinds)}")


def replace_private(docs: DataFrame, text: str = "text", key: bytes | None = None, into: str | None = "private") -> DataFrame:
    """``docs`` with the text replaced, plus the struct ``into`` (None: without): n (entities), kinds, spans in the old text."""
    key = key or application_key(docs.sparkSession)
    held = written(held_entities(docs, text), "pii-held")   # read by the collision check and for the texts with exceptions
    odd = exceptions(held.select("kind", "value").distinct(), key)
    schema = "text string, n long, kinds array<string>, spans array<struct<start:int,end:int>>"

    def replaced(texts: pd.Series, attempts) -> pd.DataFrame:
        rows, keyed = [], Surrogates(key)
        for t, tries in zip(texts, attempts):
            if not isinstance(t, str):
                rows.append((None, 0, [], []))
                continue
            tries = {(x["kind"], x["value"]): x["attempt"] for x in tries} if tries is not None and len(tries) else {}
            out, last, spans = [], 0, find(t)
            for a, b, kind, value in spans:
                if kind.startswith("name"):
                    out += [t[last:a], " ".join(keyed.name(w, tries.get(("name", w), 0)) for w in value.split(" "))]
                else:
                    out += [t[last:a], keyed.surrogate(kind, value, tries.get((kind, value), 0))]
                last = b
            rows.append(("".join(out) + t[last:], len(spans), sorted({k for _, _, k, _ in spans}), [(a, b) for a, b, _, _ in spans]))
        return pd.DataFrame(rows, columns=["text", "n", "kinds", "spans"])

    columns = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").alias("text"))   # apart from the helpers' names
    if odd is None:
        @F.pandas_udf(schema)
        def redraw(texts: pd.Series) -> pd.DataFrame:
            return replaced(texts, [None] * len(texts))

        out = rows.withColumn("found", redraw("text"))
    else:
        @F.pandas_udf(schema)
        def redraw_but(texts: pd.Series, attempts: pd.Series) -> pd.DataFrame:
            return replaced(texts, attempts)

        # the exceptions, by the hash of the text they stand in: only (hash, exceptions) meets the documents
        odd_texts = held.join(odd, ["kind", "value"]).groupBy("h").agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("odd"))
        odd_texts = written(odd_texts, "pii-odd-texts")
        out = rows.withColumn("h", F.xxhash64("text")).join(odd_texts, "h", "left").withColumn("found", redraw_but("text", "odd"))
    result = [F.col("found.text").alias(c) if c == text else F.col(f"row.`{c}`") for c in columns]
    if into is None:
        return out.select(*result)
    while into in columns:
        into += "_"
    return out.select(*result, F.struct("found.n", "found.kinds", "found.spans").alias(into))


def op5_surrogates(spark, sf_dir: str) -> DataFrame:
    out = replace_private(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", F.col("private.n").alias("n_entities"), F.array_join("private.kinds", ",").alias("kinds"))
