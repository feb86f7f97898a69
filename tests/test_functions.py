import ast
import json
import re
import time
from urllib.parse import urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import harden, json_text, markdown, text, urls
from textloom.plans import cases

ONCE = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def host(u):
    """The rule in plain Python."""
    if not u:
        return None, None
    try:
        p = urlparse(u if u.startswith(("http://", "https://", "ftp://", "ftps://")) else "http://" + u)
        d = p.netloc.lower()
    except ValueError:
        return None, None
    d = d.split(":")[0] if ":" in d else d
    parts = d.split(".")
    return p.scheme, ".".join(parts[1:]) if len(parts) > 1 and parts[0] == "www" else d


piece = st.sampled_from(["http://", "https://", "ftp://", "HTTP://", "www.", "a.com", "b-c.org", ":80", "/p", "?q", "#f", "user:pw@", " ", "\t", "\n", "é", "//", ".", ":", "\\", "x"])


@ONCE
@given(st.lists(st.lists(piece, max_size=6).map("".join), min_size=200, max_size=200))
def test_urls(spark, found):
    df = spark.createDataFrame([(u,) for u in found], "u string")
    got = df.select("u", urls.protocol(F.col("u")).alias("p"), urls.domain(F.col("u")).alias("d")).collect()
    assert [(r.p, r.d) for r in got] == [host(r.u) for r in got]


def test_ipv6():
    ok = ["::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "fe80::1%eth0", "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "1::4:5"]
    bad = ["", "1", ":::", "1:2", "1::2::3", "1:2:3:4:5:6:7:8:9", "g::", "::1.2.3", "12345::", "1.2.3.4", "1:2:3:4:5:6:7:8::", ":1:2:3:4:5:6:7", "::ffff:256.1.1.1"]
    assert all(re.fullmatch(urls.IPV6, x) for x in ok) and not any(re.fullmatch(urls.IPV6, x) for x in bad)


def first_by_search(s):
    for m in re.finditer(r"[OoΘθΩω]\(", s, re.IGNORECASE):
        depth = 0
        for i in range(m.start(), len(s)):
            depth += (s[i] == "(") - (s[i] == ")")
            if s[i] == ")" and depth == 0:
                return s[m.start() : i + 1]
    return None


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="oOθϑΩ( )nx", max_size=30))
def test_first_balanced(s):
    assert text.first_balanced(s) == first_by_search(s)


@ONCE
@given(st.lists(st.text(alphabet="oOθω()n log*^+²\u3000\x1c\t", max_size=14), min_size=100, max_size=100))
def test_normalised_notation(spark, found):
    def plain(s):
        if not s:
            return ""
        x = s.strip().lower()
        for letter in "θωo":
            x = re.sub(letter + r"\(([^)]+)\)", r"O(\1)", x)
        x += ")" if x.startswith("o(") and not x.endswith(")") else ""
        for a, b in ((r"\s*\*\s*", "*"), (r"\s*\+\s*", "+"), (r"\s*\^\s*", "^"), (r"log\s*\(\s*n\s*\)", "log n"), (r"logn\b", "log n"), (r"n\s*\*\s*log\s+n", "n log n"), ("²", "^2"), (r"\*\*", "^")):
            x = re.sub(a, b, x)
        if not x.startswith("o("):
            x = re.sub(r"^([^o].*)", r"O(\1)", x)
            x += "" if x.endswith(")") else ")"
        return x

    df = spark.createDataFrame([(s,) for s in found], "s string")
    got = df.select("s", text.normalize_complexity(F.col("s")).alias("x")).collect()
    assert [r.x for r in got] == [plain(r.s) for r in got]


def test_templates(spark):
    df = spark.createDataFrame([("{b} {{x}}", None)], "a string, b string")
    r = df.select(text.render("{{json}} {a}|{b}.", a=F.col("a"), b=F.col("b")).alias("t")).first()
    assert r.t == "{json} {b} {{x}}|None."
    with pytest.raises(KeyError):
        text.render("{missing}", a=F.col("a"))


def test_first_filled(spark):
    df = spark.createDataFrame([("", None, "c"), (None, "b", "c"), ("", "", None)], "a string, b string, c string")
    assert [r[0] for r in df.select(text.first_filled(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["c", "b", ""]


@pytest.mark.parametrize("raw,want", cases.JSON_REPLIES)
def test_find_json(raw, want):
    got = json_text.find_json(raw)
    assert (None if got is None else json.dumps(got, ensure_ascii=False)) == want


def test_markdown_never_fails():
    for page in ["", "<", "<p", "</b></p>", "<table><td>x", "<pre>", "<li>x", "<a href=x>", "<code>", "&#xZ;", "<ul><li><p>a<p>b", "<b>" * 500, "<blockquote>" * 50 + "x"]:
        assert isinstance(markdown.to_markdown(page), str)


@pytest.mark.parametrize("page, out", [("<table><tr><td>x<tr>y<td>z</table>", "y\n\n| x |\n| --- |\n| z |"), ("y<s><s>z", "y~~~~z~~~~"), ("<b>x<p>y</p></b>", "**x\n\ny"), ("a</i>b", "ab")])
def test_markdown_of_broken_pages(page, out):
    assert markdown.to_markdown(page) == out


@pytest.mark.parametrize("page", ["<div>{0}</section>{0}", "<i><p><b>{0}</i>{0}", "<div><b>{0}<p></p>{0}"])
def test_markdown_takes_time_in_proportion(page):
    first, second, _ = page.split("{0}")
    head, last = first[: first.rindex("<")], first[first.rindex("<") :]
    began = time.process_time()
    markdown.to_markdown(head + last * 20_000 + second * 20_000)
    assert time.process_time() - began < 5


def test_markdown_of_pages(spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        if r.html:
            out = markdown.to_markdown(r.html)
            assert "<p>" not in out and "track(" not in out and "margin:0" not in out and "\n# " in "\n" + out


def test_main_guards():
    source = "x = 1\nif __name__ == '__main__':\n    x = 2\nelse:\n    y = 3\ndef f():\n    if '__main__' == __name__:\n        return 1\nif __name__ != '__main__':\n    z = 4\nif x:\n    pass\nelif __name__ == '__main__':\n    w = 5\n"
    out = harden.strip_main_guard(source)
    assert ast.unparse(ast.parse(out)) == out.strip() or out
    space = {}
    exec(out, space)
    assert space["x"] == 1 and space["y"] == 3 and space["f"]() is None and "w" not in space and "z" in space


@pytest.mark.parametrize(
    "loop,n",
    [("range(5)", 5), ("range(2, 9, 3)", 3), ("range(9, 2, -3)", 3), ("range(-2)", 0), ("range(1, +4)", 3), ("enumerate([1, 2], 5)", 2), ("(1, 2, 3)", 3), ("{1: 2}", 1), ("{1, 2}", 2), ("range(1, 5, 0)", None), ("range(n)", None), ("xs", None), ("'abc'", None), ("range(True)", 1), ("range()", None), ("[x for x in y]", None)],
)
def test_static_lengths(loop, n):
    assert harden.static_length(ast.parse(loop, mode="eval").body) == n


def test_asserts_are_counted():
    source = "assert 1\nfor i in range(3):\n    assert i < 3\n    for j in (1, 2):\n        assert j\n    else:\n        assert True\nif True:\n    assert 1\nelse:\n    assert 0\ntry:\n    assert 1\nexcept ValueError:\n    assert 0\nfinally:\n    assert 1\nwith open('/dev/null'):\n    assert 1\nmatch 1:\n    case 1:\n        assert 1\n"
    code, n = harden.count_asserts(source)
    assert n == 1 + 3 + 6 + 3 + 2 + 3 + 1 + 1
    assert code.count(harden.COUNTED + "()") == source.count("assert ")
    for bad in ("for i in xs:\n    assert i", "async def f():\n    async for i in [1]:\n        assert i"):
        with pytest.raises(ValueError):
            harden.count_asserts(bad)
