"""Personal data replaced by surrogates of its own kind.

Found: e-mail addresses, IPv4 and IPv6 addresses, MAC addresses, phone numbers, payment card numbers (Luhn), IBANs (mod 97), US
social security numbers, secrets after a name like ``token =``, and names of persons after a title or a known first name.

A surrogate comes from a keyed permutation of all strings of the entity's format, so it needs no table that grows with the
corpus: the same entity gets the same surrogate in every document (coreference), two entities never get the same one
(distinctness), and none stays as it is. The permutation walks a cycle by one step in a keyed Feistel order: encrypt, add one,
decrypt. Letters stay vowels or consonants of their script and case, digits stay digits, punctuation stays; check digits are
computed anew; first names of the lists stay within their list, so gender and script are kept; other names never become listed
ones. ``collisions`` gathers the distinct entities of a corpus and reports any two of a kind that share a surrogate, which would
be a defect. ``redact`` reads every text once: it writes texts with surrogates beside digests of what they stand for, checks the digests, and
only then gives the texts out.

Defined results: a null text stays null, an empty one empty; overlapping finds are taken from the left, the longer first; repeated
rows get equal results; an empty table gives an empty result. Texts are handled in place; only distinct entities are shuffled.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import Scratch

ROUNDS = 8
FIRST_NAMES = {
    ("LATIN", "f"): "Abigail Alejandra Amelia Angelika Anneliese Barbara Beatriz Birgit Brigitte Camille Carmen Caroline Catherine Charlotte Chloé Claudia Cristina Deborah Dolores Dorothy Eleanor Elisabeth Elizabeth Emily Emma Evelyn Florence Francisca Gabriele Gisela Guadalupe Hannah Heike Helga Isabella Isabelle Jacqueline Jennifer Jessica Josefina Julia Karin Katharina Kimberly Laura Lucía Madeleine Margaret Margarita Maria Marie Martina Melissa Mercedes Michelle Monika Natalie Nathalie Olivia Patricia Pilar Rebecca Renate Rosario Sabine Samantha Sandrine Sarah Sophia Sophie Stephanie Susan Sylvie Teresa Ursula Valérie Véronique Victoria Virginia".split(),
    ("LATIN", "m"): "Alejandro Alexander Andrew Anthony Antoine Benjamin Bernd Charles Christian Christopher Daniel David Diego Dieter Dominique Edward Emmanuel Enrique Étienne Fernando Francisco Frédéric Friedrich George Gérard Guillaume Günter Gustavo Heinrich Helmut Henry Ignacio Jacques James Javier Jérôme Joachim Johannes John Jonathan Jorge José Joseph Joshua Jürgen Kenneth Klaus Laurent Lorenzo Manfred Manuel Marcel Matthew Matthias Michael Miguel Nicholas Nicolas Olivier Pascal Patrick Pedro Philippe Pierre Rafael Raymond Ricardo Richard Robert Roberto Rodrigo Roger Ronald Rüdiger Sebastian Steven Thierry Thomas Timothy Ulrich Vicente Walter William Wolfgang Xavier".split(),
    ("CYRILLIC", "f"): "Александра Анастасия Анна Валентина Вера Галина Дарья Екатерина Елена Ирина Ксения Людмила Марина Мария Надежда Наталья Ольга Светлана Татьяна Юлия".split(),
    ("CYRILLIC", "m"): "Александр Алексей Андрей Борис Василий Виктор Владимир Дмитрий Евгений Иван Игорь Константин Максим Михаил Николай Олег Павел Пётр Сергей Юрий".split(),
}
TITLES = {"f": "Mrs Ms Miss Frau Señora Sra Madame Mme Mademoiselle Doña Г-жа Госпожа".split(), "m": "Mr Herr Señor Sr Monsieur Don Г-н Господин".split(), "": "Dr Prof".split()}
_LISTED = {n: k for k, names in FIRST_NAMES.items() for n in names}
_LOWER = {n.lower(): n for n in _LISTED}
#: Country codes of one and two digits; all others have three.
_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())

_V, _C = "aeiou", "bcdfghjklmnpqrstvwxyz"
_ALPHABETS = [
    "0123456789", _V, _C, _V.upper(), _C.upper(), "áéíóúàèùâêîôûäëïöü", "ÁÉÍÓÚÀÈÙÂÊÎÔÛÄËÏÖÜ", "çñ", "ÇÑ",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ", "ьъ",
    "αεηιουω", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ", "άέήίόύώ",
    "".join(map(chr, range(0x3042, 0x3094))), "".join(map(chr, range(0x30A2, 0x30F4))), "".join(map(chr, range(0x4E00, 0x8000))), "".join(map(chr, range(0xAC00, 0xD7A4))),
]
_OF = {c: a for a in _ALPHABETS for c in a}
_AT = {c: i for a in _ALPHABETS for i, c in enumerate(a)}


class Keyed:
    """Keyed permutations of digit strings of mixed radix."""

    def __init__(self, key: str):
        self.key = hashlib.sha256(key.encode()).digest()

    def _stream(self, tweak: str, r: int, side: list[int], n: int) -> list[int]:
        data, out, k = f"{tweak}|{r}|{','.join(map(str, side))}".encode(), [], 0
        while len(out) < n:
            d = hashlib.blake2b(data, digest_size=64, key=self.key, salt=k.to_bytes(8, "big")).digest()
            out += [int.from_bytes(d[i : i + 8], "big") for i in range(0, 64, 8)]
            k += 1
        return out[:n]

    def _pass(self, tweak: str, x: list[int], radix: list[int], sign: int) -> list[int]:
        half = len(x) // 2
        sides = [x[:half], x[half:]]
        radii = [radix[:half], radix[half:]]
        for r in range(ROUNDS) if sign > 0 else reversed(range(ROUNDS)):
            s = r % 2
            add = self._stream(tweak, r, sides[1 - s], len(sides[s]))
            sides[s] = [(v + sign * a) % n for v, a, n in zip(sides[s], add, radii[s], strict=True)]
        return sides[0] + sides[1]

    def step(self, tweak: str, x: list[int], radix: list[int]) -> list[int]:
        """The next string in the keyed order: a permutation without fixed points wherever there are two strings or more."""
        tweak = f"{tweak}|{radix}"
        y = self._pass(tweak, x, radix, 1)
        for i in range(len(y)):
            y[i] = (y[i] + 1) % radix[i]
            if y[i]:
                break
        return self._pass(tweak, y, radix, -1)

    def like(self, tweak: str, s: str, fixed: str = "") -> str:
        """A string of the same format; characters of no alphabet, and of ``fixed``, stay."""
        at = [i for i, c in enumerate(s) if c in _OF and c not in fixed]
        new = self.step(tweak, [_AT[s[i]] for i in at], [len(_OF[s[i]]) for i in at])
        out = list(s)
        for i, v in zip(at, new, strict=True):
            out[i] = _OF[s[i]][v]
        return "".join(out)


def luhn(digits: str) -> bool:
    d = [int(c) for c in digits[::-1]]
    return sum(d[::2] + [2 * x - 9 * (x > 4) for x in d[1::2]]) % 10 == 0


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _refill(pattern: str, digits: str, test=str.isdigit) -> str:
    it = iter(digits)
    return "".join(next(it) if test(c) else c for c in pattern)


def _block(o: list[int]) -> tuple[int, ...]:
    """What stays of an IPv4 address outside the public range: its block."""
    if o[0] in (0, 10, 127) or o[0] >= 224:
        return (o[0],)
    if (o[0], o[1]) == (192, 168) or (o[0] == 172 and 16 <= o[1] <= 31) or (o[0], o[1]) == (169, 254):
        return o[0], o[1]
    return ()


def _recase(like: str, s: str) -> str:
    return "".join(c.upper() if p.isupper() and len(c.upper()) == 1 else c for p, c in zip(like, s, strict=True))


_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"[^\W\d_]+(?:[-'’][^\W\d_]+)?"
_ALL_TITLES = {t: g for g, ts in TITLES.items() for t in ts}
_FINDERS = re.compile(
    rf"""(?P<email>[\w.%+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{{2,}})
    |(?P<secret>(?i:\b(?:api[_-]?key|access[_-]?key|secret|token|passw(?:or)?d|pwd|bearer)\b["']?\s{{0,3}}[:=]\s{{0,3}}["']?)(?P<value>[A-Za-z0-9_\-+/=]{{12,}}))
    |(?P<aws>\bAKIA[0-9A-Z]{{16}}\b)
    |(?P<mac>\b(?:[0-9A-Fa-f]{{2}}[:-]){{5}}[0-9A-Fa-f]{{2}}\b)
    |(?P<ipv6>(?<![\w:.])(?:[0-9A-Fa-f]{{0,4}}:){{2,7}}[0-9A-Fa-f]{{0,4}}(?![\w:]))
    |(?P<iban>\b[A-Z]{{2}}\d{{2}}(?:[ ]?[A-Z0-9]{{4}}){{2,7}}(?:[ ]?[A-Z0-9]{{1,3}})?\b)
    |(?P<ipv4>(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d))
    |(?P<card>(?<![\w.-])\d(?:[ -]?\d){{12,18}}(?![\w-]))
    |(?P<phone>(?<![\w+])(?:\+\d{{1,3}}[ .-]?)?\(\d{{2,4}}\)[ .-]?\d{{3,4}}[ .-]?\d{{3,4}}(?!\w)|(?<![\w+])\+\d{{1,3}}(?:[ .-]?\d{{2,4}}){{2,5}}(?!\w)|(?<![\w.-])\d{{3}}[.-]\d{{3}}[.-]\d{{4}}(?![\w-]))
    |(?P<ssn>(?<![\w-])\d{{3}}-\d{{2}}-\d{{4}}(?![\w-]))""",
    re.X,
)
_PERSON = re.compile(
    rf"(?P<title>\b(?:{'|'.join(map(re.escape, _ALL_TITLES))})\b\.?[ ]+)(?P<a>{_NAME})(?:[ ](?P<b>{_NAME}))?|\b(?P<c>{'|'.join(map(re.escape, sorted(_LISTED, key=len, reverse=True)))})\b(?:[ ](?P<d>{_NAME}))?"
)


@lru_cache(maxsize=1)
def _name_scanner() -> ahocorasick.Automaton:
    """Finds any title or listed name anywhere; few texts have one, and only those are searched for persons."""
    a = ahocorasick.Automaton()
    for w in (*_ALL_TITLES, *_LISTED):
        a.add_word(w, len(w))
    a.make_automaton()
    return a


def _found(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, gender) of entities, from the left."""
    out = []
    if re.search(r"[\d@]|::", text) or "=" in text or ": " in text:
        for m in _FINDERS.finditer(text):
            kind, s = m.lastgroup, m[0]
            if m["secret"]:
                kind = "secret"
                if re.search(r"\d", m["value"]):
                    out.append((*m.span("value"), kind, ""))
                continue
            if kind == "card" and not luhn(re.sub(r"\D", "", s)):
                continue
            if kind == "iban" and (mod97(s.replace(" ", "")) != 1 or not 15 <= len(s.replace(" ", "")) <= 34):
                continue
            if kind == "ipv6":
                try:
                    ipaddress.IPv6Address(s)
                except ValueError:
                    continue
                if s.count(":") < 2 or not re.search(r"[0-9A-Fa-f]{2}", s):
                    continue
            out.append((*m.span(), kind, ""))
    for m in _PERSON.finditer(text) if next(_name_scanner().iter(text), None) else ():
        gender = _ALL_TITLES[m["title"].strip().rstrip(".")] if m["title"] else _LISTED[m["c"]][1]
        first, last = ("a", "b") if m["title"] else ("c", "d")
        for g in (first, last):
            if m[g] and m[g][0].isupper() and not m[g].isupper() and m[g] not in _ALL_TITLES:
                out.append((*m.span(g), "name", gender))
            elif g == first:
                break
    out.sort(key=lambda x: (x[0], -x[1]))
    kept, at = [], 0
    for x in out:
        if x[0] >= at:
            kept.append(x)
            at = x[1]
    return kept


def _compared(kind: str, surrogate: str) -> str:
    """A surrogate without what may be written in several ways."""
    if kind in ("card", "phone", "ssn", "iban", "mac"):
        return re.sub(r"[^\w+]", "", surrogate).lower()
    return surrogate.lower() if kind in ("email", "name") else surrogate


class Surrogates:
    def __init__(self, key: str):
        self.keyed = Keyed(key)
        self.known = lru_cache(maxsize=50_000)(self._make)

    def _make(self, kind: str, s: str) -> tuple[str, str]:
        """(entity in its canonical form, surrogate in the format of what was found)."""
        k = self.keyed
        if kind == "email":
            low = s.lower()
            if len(low) != len(s):
                low = s
            local, _, domain = low.rpartition("@")
            labels, _, top = domain.rpartition(".")
            return low, _recase(s, f"{k.like('local', local)}@{k.like('domain', labels)}.{top}")
        if kind == "ipv4":
            o = [int(x) for x in s.split(".")]
            block = _block(o)
            keep = len(block) if block else 0
            y = list(o)
            while True:  # a public address stays public: the walk goes on over the others
                y = [*o[:keep], *k.step(f"ipv4|{o[:keep]}", y[keep:], [256] * (4 - keep))]
                if _block(y) == block:
                    return s, ".".join(map(str, y))
        if kind == "ipv6":
            a = ipaddress.IPv6Address(s).exploded.replace(":", "")
            y = k.step("ipv6", [int(c, 16) for c in a[4:]], [16] * 28)
            full = a[:4] + "".join(f"{v:x}" for v in y)
            return a, str(ipaddress.IPv6Address(":".join(full[i : i + 4] for i in range(0, 32, 4))))
        if kind in ("mac", "secret", "aws"):
            if kind == "mac" or re.fullmatch(r"[0-9A-F]+|[0-9a-f]+", s):
                new = k.step(kind, [int(c, 16) for c in s if c not in ":-"], [16] * sum(c not in ":-" for c in s))
                low = _refill(s, "".join(f"{v:x}" for v in new), lambda c: c not in ":-")
                return (re.sub("[:-]", "", s.lower()) if kind == "mac" else s), low.upper() if re.search("[A-F]", s) else low
            return s, k.like(kind, s) if kind != "aws" else "AKIA" + k.like(kind, s[4:])
        if kind == "card":
            d = re.sub(r"\D", "", s)
            body = k.like("card", d[:-1])
            return d, _refill(s, body + next(c for c in "0123456789" if luhn(body + c)))
        if kind == "iban":
            d = s.replace(" ", "")
            body = k.like("iban", d[4:])
            check = 98 - mod97(d[:2] + "00" + body)
            return d, _refill(s, f"{d[:2]}{check:02d}{body}", lambda c: c != " ")
        if kind == "name":
            low = s.lower() if len(s.lower()) == len(s) else s
            if listed := _LOWER.get(low):
                pool = FIRST_NAMES[_LISTED[listed]]
                return low, pool[k.step(f"first|{_LISTED[listed]}", [pool.index(listed)], [len(pool)])[0]]
            new = k.like("name", low)
            while new in _LOWER:  # the walk goes on until it has left the lists
                new = k.like("name", new)
            return low, _recase(s, new)
        d = re.sub(r"\D", "", s)
        abroad = s.startswith("+")
        n = next((j for j in (1, 2) if d[:j] in _CODES), 3) if abroad else 0
        return "+" * abroad + d, _refill(s, d[:n] + k.like(f"{kind}{'+' * abroad}{d[:n]}", d[n:]))

    def entities(self, text: str | None) -> list[tuple[int, int, str, str, str, str]]:
        """(start, end, kind, gender, entity, surrogate) of a text."""
        t = text or ""
        return [(a, b, kind, g, *self.known(kind, t[a:b])) for a, b, kind, g in _found(t)]

    def digests(self, found: list[tuple[int, int, str, str, str, str]]) -> list[dict]:
        """Kind, surrogate as it is compared, and keyed digest of each distinct entity."""
        return [
            {"kind": kind, "surrogate": new, "entity": hashlib.blake2b(e.encode(), digest_size=16, key=self.keyed.key).digest()}
            for kind, e, new in sorted({(kind, e, _compared(kind, new)) for _, _, kind, _, e, new in found})
        ]

    def redact(self, text: str | None) -> tuple[str | None, int]:
        text, found = self.replaced(text)
        return text, len(found)

    def replaced(self, text: str | None) -> tuple[str | None, list[tuple[int, int, str, str, str, str]]]:
        found = self.entities(text)
        if not found:
            return text, found
        out, at = [], 0
        for a, b, _, _, _, new in found:
            out += [text[at:a], new]
            at = b
        return "".join([*out, text[at:]]), found


_made: dict[str, Surrogates] = {}


def _surrogates(key: str) -> Surrogates:
    if key not in _made:
        _made.clear()
        _made[key] = Surrogates(key)
    return _made[key]


def script(s: str) -> str:
    """Script of the first letter."""
    return next((unicodedata.name(c, "OTHER").split(" ")[0] for c in s if c.isalpha()), "NONE")


def redact_column(text: Column, key: str) -> Column:
    """struct<text, n_entities, found> as a column; ``found`` has each distinct entity once, as a keyed digest, never in clear."""

    @F.pandas_udf("text string, n_entities long, found array<struct<kind: string, surrogate: string, entity: binary>>")
    def run(t: pd.Series) -> pd.DataFrame:
        s = _surrogates(key)
        return pd.DataFrame([(new, len(found), s.digests(found)) for new, found in map(s.replaced, t)], columns=["text", "n_entities", "found"])

    return run(text)


def collisions(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(kind, surrogate, n): surrogates shared by ``n`` different entities of a kind. Entities travel as keyed digests, never in clear."""
    return shared(docs.select(F.explode(redact_column(F.col(text_col), key)["found"]).alias("f")).select("f.*"))


def shared(found: DataFrame) -> DataFrame:
    pairs = found.groupBy("kind", "surrogate", "entity").count()
    return pairs.groupBy("kind", "surrogate").agg(F.count("*").alias("n")).where("n > 1")


def redact(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, text with surrogates, number of entities replaced. Fails if two entities share a surrogate."""
    scratch = Scratch(docs.sparkSession, "pii")
    done = docs.select(F.col(id_col).alias("id"), redact_column(F.col(text_col), key).alias("r")).select("id", "r.*")
    done = scratch.save(done, "redacted", compression="zstd")
    if bad := shared(done.select(F.explode("found").alias("f")).select("f.*")).take(3):
        raise ValueError(f"entities share a surrogate: {bad}")
    return done.select(F.col("id").alias(id_col), "text", "n_entities")
