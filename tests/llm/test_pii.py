import ipaddress
import random
import re

import pytest

from textloom.llm import pii, queries

from .common import clashing, documents

S = pii.Surrogates("test key")


def valid_card(rng):
    body = "4" + "".join(rng.choices("0123456789", k=14))
    return body + next(c for c in "0123456789" if pii.luhn(body + c))


def test_kinds_keep_their_format():
    rng = random.Random(2)
    for _ in range(60):
        card = valid_card(rng)
        ip = ".".join(str(rng.randint(11, 99)) for _ in range(4))
        text = f"Mail jane.doe{rng.randint(1, 99)}@mail.example.org, call +49 30 1234 {rng.randint(1000, 9999)}, card {card[:4]}-{card[4:8]}-{card[8:12]}-{card[12:]} or {card}, host {ip}, ssn 123-45-{rng.randint(1000, 9999)}, token = \"a{rng.getrandbits(64):x}9\""
        new, n = S.redact(text)
        found = [(k, text[a:b], y) for a, b, k, _, _, y in S.entities(text)]
        assert n == len(found) == 7 and {k for k, *_ in found} == {"email", "phone", "card", "ipv4", "ssn", "secret"}
        for kind, old, sub in found:
            assert old not in new and sub in new and sub != old and len(old) == len(sub) or kind == "ipv4"
            if kind == "card":
                assert pii.luhn(re.sub(r"\D", "", sub)) and re.sub(r"\d", "9", old) == re.sub(r"\d", "9", sub)
            if kind == "ipv4":
                ipaddress.IPv4Address(sub)
            if kind == "phone":
                assert sub.startswith("+49 ")
        both = [re.sub(r"\D", "", y) for k, _, y in found if k == "card"]
        assert both[0] == both[1], "one number, two formats, one surrogate"


def test_decoys_stay():
    for text in ["Version 3.0", "order 1234567890123456", "GPL-3.0", "at 12:30:45", "1.2.3", "999.1.1.1", "a::b", "pi = 3.14159", "2024-01-31", "", "no entity here", "token = unknownwordonly"]:
        assert S.redact(text) == (text, 0)


def test_names_keep_gender_and_script():
    for text, pool in [("Dear Mrs Julia Okonkwo,", ("LATIN", "f")), ("Herr Klaus Brandt kam", ("LATIN", "m")), ("г-н Г-жа Ольга Петрова", ("CYRILLIC", "f"))]:
        first, last = [(e, y) for _, _, k, _, e, y in S.entities(text) if k == "name"]
        assert first[1] in pii.FIRST_NAMES[pool] and first[1].lower() != first[0]
        assert pii.script(last[1]) == pii.script(last[0]) and last[1][0].isupper() and last[1].lower() != last[0]


@pytest.mark.parametrize("kind,make", [("email", lambda i: f"u{i}@ex.org"), ("ssn", lambda i: f"123-{i // 10000 % 100:02d}-{i % 10000:04d}"), ("phone", lambda i: f"+1 (555) {i // 10000:03d}-{i % 10000:04d}"), ("name", lambda i: "Xa" + "".join("bcdfghjkl"[int(c)] for c in f"{i % 6561:04d}" if c != "9"))])
def test_surrogates_are_distinct(kind, make):
    olds = {make(i) for i in range(4000)}
    new = {o: S.known(kind, o)[1] for o in olds}
    assert len(set(new.values())) == len(olds) and all(a != b for a, b in new.items())


def test_first_names_permute():
    for key, names in pii.FIRST_NAMES.items():
        assert len(set(names)) == len(names)
        assert sorted(S.known("name", n)[1] for n in names) == sorted(names)


def test_keys_differ_and_runs_agree():
    t = "write to jane.doe@mail.example.org"
    assert S.redact(t) == pii.Surrogates("test key").redact(t) != pii.Surrogates("other").redact(t)


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    mine = pii.Surrogates(queries.PII_KEY)
    got = {r.doc_id: (r.text, r.n_entities) for r in queries.op3_pii(spark, "/root/testdata/sf0.01").collect()}
    assert got == {d: mine.redact(t) for d, t in docs.items()}
    assert sum(n for _, n in got.values()) > 50
    for d, (t, n) in got.items():
        if n == 0:
            assert t == docs[d]
    left = [e for t in docs.values() for *_, e, _ in mine.entities(t)]
    now = {e for t, _ in got.values() for *_, e, _ in mine.entities(t)}
    assert not now & {e for e in left if "@" in e or len(e) > 14}


def test_against_plain_patterns(spark):
    """Independent of the finder: words stay as many, changed ones replace one another one to one over the whole corpus, keep their
    shape of letters and digits, and no plain address or dotted quad of the input is left anywhere."""
    import re

    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r.text or "" for r in queries.op3_pii(spark, sf).collect()}
    to, back, changed = {}, {}, 0
    plain = re.compile(r"[a-z0-9._]+@[a-z0-9-]+\.[a-z]+|\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b")
    gone = set()
    for d, t in docs.items():
        a, b = t.split(), got[d].split()
        assert len(a) == len(b)
        gone |= set(plain.findall(t))
        for x, y in zip(a, b):
            if x != y:
                changed += 1
                if "@" in x:
                    e, f = plain.search(x.lower())[0], plain.search(y.lower())[0]
                    assert to.setdefault(e, f) == f and back.setdefault(f, e) == e
                    assert [c.isdigit() for c in e] == [c.isdigit() for c in f]
    left = {e for t in got.values() for e in plain.findall(t)}
    assert changed > 50 and gone and not gone & left


def test_collisions_are_seen(spark, monkeypatch):
    df = documents(spark, [(1, "a1@ex.org"), (2, "b2@ex.org"), (3, "a1@ex.org")])
    assert pii.collisions(df, "k").collect() == []
    import textloom.llm.pii as module

    pairs = spark.createDataFrame([("email", "x@y.z", b"1"), ("email", "x@y.z", b"1"), ("email", "x@y.z", b"2")], "kind string, surrogate string, entity binary")
    assert [tuple(r) for r in module.shared(pairs).collect()] == [("email", "x@y.z", 2)]


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "a1@ex.org"), (3, "a1@ex.org a1@ex.org"), (3, "a1@ex.org a1@ex.org"), (4, "z a1@ex.org " * 20_000)]
    df = clashing(documents(spark, rows), "r", "n_entities", "kind", "surrogate", "entity", "t")
    out = sorted(((r.doc_id, r.n_entities, (r.text or "")[:22]) for r in pii.redact(df, "k").collect()), key=repr)
    new = pii.Surrogates("k").redact("a1@ex.org")[0]
    assert out == sorted([(1, 0, ""), (2, 0, ""), (None, 1, new), (3, 2, f"{new} {new}"), (3, 2, f"{new} {new}"), (4, 20_000, f"z {new} z {new}"[:22])], key=repr)
    assert pii.redact(documents(spark, []), "k").collect() == []
