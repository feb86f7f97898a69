"""Inline cases that queries and tests share, with what must come out."""

from __future__ import annotations

#: url, protocol, domain, valid
URLS = [
    ("http://www.A.com:80/x", "http", "a.com", True),
    ("http://a_b.c.com/p", "http", "a_b.c.com", True),
    ("http://user:pw@host.com/x", "http", "user", True),
    ("http://[::1]:80/", "http", "[", True),
    ("www.com", "http", "com", True),
    ("/rel", "http", "", False),
    ("HTTP://X.com/", "http", "http", True),
    ("https://a.com?x", "https", "a.com", True),
    ("ftp://a b.com/", "ftp", "a b.com", True),
    ("http://www./", "http", "", False),
    ("x", "http", "x", True),
    ("www", "http", "www", True),
    ("http://www.www.q.org", "http", "www.q.org", True),
    ("http://a\nb.com/", "http", "ab.com", True),
    ("mailto:a@b", "http", "mailto", True),
    ("u@host.com/p", "http", "u@host.com", True),
    ("http://a.com#f", "http", "a.com", True),
    (None, None, None, False),
    ("", None, None, False),
    ("http://[abc", None, None, False),
    ("http://[abc]/", None, None, False),
    ("http://x]/", None, None, False),
    ("https://[fe80::1%25eth0]/", "https", "[fe80", True),
    ("http://[::ffff:1.2.3.4]/", "http", "[", True),
]
PLAIN_URLS = [u for u, *_ in URLS if u and "[" not in u and "]" not in u]

#: Fixed values, which must come out equal for right results: solution, truth, score. The judge below stands in for a model.
COMPLEXITY = [
    ("O(n)", "O(n)", 1.0),
    ("The time complexity is O(log n)", "O(log n)", 1.0),
    ("Answer: O(n^2)", "O(n^2)", 1.0),
    ("O(n*log(n))", "O(n log n)", 1.0),
    ("O(N)", "O(n)", 1.0),
    ("o(1)", "O(1)", 1.0),
    ("The algorithm has O(n) time complexity because it iterates through the array once.", "O(n)", 1.0),
    ("Time complexity: O(log n) due to binary search", "O(log n)", 1.0),
    ("O(n)", "O(log n)", 0.0),
    ("O(n^2)", "O(n)", 0.0),
    ("The algorithm is very fast", "O(1)", 0.0),
    ("Linear time complexity", "O(n)", 1.0),
    ("", "O(n)", 0.0),
    ("   ", "O(n)", 0.0),
    ("Time: O(n), Space: O(1)", "O(n)", 1.0),
    ("Space: O(n), Time: O(log n)", "O(log n)", 0.0),
    ("The complexity is O(2^n) exponential", "O(2^n)", 1.0),
    ("O(n!) factorial time", "O(n!)", 1.0),
    ("Θ(n log n)", "O(n log n)", 1.0),
    ("O(n²)", "O(n^2)", 1.0),
    ("O(n**2)", "O(n^2)", 1.0),
    ("O(logn)", "O(log n)", 1.0),
    ("The time complexity is quadratic", "O(n^2)", 1.0),
    ("This runs in linear time", "O(n)", 1.0),
    ("Constant time operation", "O(1)", 1.0),
    ("The algorithm's complexity is O(n) where n is the input size", "O(n)", 1.0),
]
_WORDS = {"linear": "O(n)", "quadratic": "O(n^2)", "constant": "O(1)"}


def judge(prompts: list[str]) -> list[str]:
    """YES where the response has the word for the expected notation."""
    out = []
    for p in prompts:
        response = p.split('Response: "')[1].split('"\nExpected: "')[0].lower()
        truth = p.split('"\nExpected: "')[1].split('"\n')[0]
        out.append(" yes\n" if any(w in response and truth == t for w, t in _WORDS.items()) else "NO")
    return out


#: score, method, extracted
SCORED = [
    (1.0, "rule_based", "O(n)"),
    (1.0, "rule_based", "O(log n)"),
    (1.0, "rule_based", "O(n^2)"),
    (1.0, "rule_based", "O(n*log(n))"),
    (1.0, "rule_based", "O(N)"),
    (1.0, "rule_based", "o(1)"),
    (1.0, "rule_based", "O(n)"),
    (1.0, "rule_based", "O(log n)"),
    (0.0, "hybrid_rule_extract_llm_judge", "O(n)"),
    (0.0, "hybrid_rule_extract_llm_judge", "O(n^2)"),
    (0.0, "extraction_failed", None),
    (1.0, "llm_judgment", "LLM_DETERMINED"),
    (0.0, None, None),
    (0.0, None, None),
    (1.0, "rule_based", "O(n)"),
    (0.0, "hybrid_rule_extract_llm_judge", "O(n)"),
    (1.0, "rule_based", "O(2^n)"),
    (1.0, "rule_based", "O(n!)"),
    (1.0, "rule_based", "Θ(n log n)"),
    (1.0, "rule_based", "O(n²)"),
    (1.0, "rule_based", "O(n**2)"),
    (1.0, "rule_based", "O(logn)"),
    (1.0, "llm_judgment", "LLM_DETERMINED"),
    (1.0, "llm_judgment", "LLM_DETERMINED"),
    (1.0, "llm_judgment", "LLM_DETERMINED"),
    (1.0, "rule_based", "O(n)"),
]

NOTATIONS = [None, "", "O(n)", "o(n)", "n", "O(n", " Θ( n ) ", "O(n * log(n))", "O(n log n)", "Ω(n + m)", "O(n ^ 2)", "O(2**n)", "n²", "O(logn)", "O(log(m))", "o()", "often", "O( n )", "O(1) and O(n)", "n log n", "lognx", "O(n³)", "   ", "O(n * logn)"]

#: a, b, equal
PAIRS = [
    ("O(n)", "O(N)", True),
    ("O(n*log(n))", "O(n log n)", True),
    ("Θ(n)", "O(n)", True),
    ("n", "O(n)", False),
    ("n", "N", True),
    ("O(n", "O(n)", False),
    ("O( n )", "O(n)", False),
    ("O(n²)", "O(n**2)", True),
    ("", "", False),
    (None, "O(n)", False),
    ("O(log(m))", "O(log m)", False),
]


def _block(*lines: str) -> str:
    return "===QUERY_START===\n" + "\n".join(lines) + "\n===QUERY_END===\n"


def _reply(*blocks: str) -> str:
    return "Sure.\n===QUERIES_START===\n" + "".join(blocks) + "===QUERIES_END===\n"


REPLY = _reply(
    _block("QUERY_ID: 1", "COMPLEXITY_TYPE: TIME", "QUERY: How long?", "GROUND_TRUTH: O(n)"),
    _block("COMPLEXITY_TYPE: SPACE", "QUERY: How much", "room?", "GROUND_TRUTH:", "O(1)"),
)
REPLIES = [
    REPLY,
    _reply(_block("QUERY_ID: 7", "COMPLEXITY_TYPE: [TIME]", "QUERY: q", "GROUND_TRUTH: O(n)"), _block("QUERY_ID: 8", "COMPLEXITY_TYPE: SPACE", "QUERY: kept", "GROUND_TRUTH: O(1)  ")),
    _block("QUERY_ID: 1", "COMPLEXITY_TYPE: TIME", "QUERY: no outer marks", "GROUND_TRUTH: O(n)"),
    "",
    None,
    _reply(_block("QUERY_ID: x", "COMPLEXITY_TYPE: TIME", "QUERY:", "GROUND_TRUTH: O(n)"), _block("QUERY_ID: 3", "COMPLEXITY_TYPE: TIME", "QUERY: no truth")),
    REPLY + _reply(_block("QUERY_ID: 9", "COMPLEXITY_TYPE: TIME", "QUERY: a second section is not read", "GROUND_TRUTH: O(n)")),
]

#: raw, JSON text found
JSON_REPLIES = [
    ('```json\n{"a": 1}\n```', '{"a": 1}'),
    ('text ```\n[1, 2]\n``` more', "[1, 2]"),
    ('```json\n{broken\n``` but {"a": 1}', None),
    ('```json\n{"a": 1}', '{"a": 1}'),
    ('say {"a": {"b": "é"}} done', '{"a": {"b": "é"}}'),
    ('say {"a": "}"} done', None),
    ("{'a': 1}", None),
    ('{"a": 1, "a": 2}', '{"a": 2}'),
    ('{ {"b": 2}', '{"b": 2}'),
    ("no braces", None),
    ("", None),
    (None, None),
    ('{"a": 1} trailing {"b": 2}', '{"a": 1}'),
]

_ADD = "def add(a, b):\n    return a + b\n"
_TESTS = "assert add(1, 2) == 3\nassert add(-1, 1) == 0\nassert add(0, 0) == 0\nfor i in range(5):\n    assert add(i, i) == 2 * i\n"
_IMPORTS = "import math\nimport re\nfrom collections import Counter, defaultdict\nfrom typing import *\n"
#: solution, imports, tests, score, valid_code
CODE = [
    (_ADD, "", _TESTS, 1.0, 1),
    ("def add(a, b):\n    return a - b\n", "", _TESTS, 0.0, 1),
    ("", "", _TESTS, 0.0, 0),
    ("import sys\nsys.exit(0)\n" + _ADD, "", _TESTS, 0.0, 1),
    ("import os\nos._exit(0)\n" + _ADD, "", _TESTS, 0.0, 1),
    ("print('ALL TESTS PASSED')\ndef add(a, b):\n    return 0\n", "", _TESTS, 0.0, 1),
    (_ADD, "", "\n".join(f"assert add({i}, 1) == {i + 1}" for i in range(5)), 1.0, 1),
    (_ADD, "", "\n".join(f"assert add({i}, 1) == {i + 1}" for i in range(5)) + "\nassert add(1, 1) == 3", 0.0, 1),
    (_ADD + "if __name__ == '__main__':\n    raise SystemExit('not here')\n", "", _TESTS, 1.0, 1),
    ("class Solution:\n    def twice(self, x: List[int]) -> List[int]:\n        return [2 * v for v in x]\n", _IMPORTS, "def check(candidate):\n    assert candidate([1, 2]) == [2, 4]\n    assert candidate([]) == []\n\ncheck(Solution().twice)\n", 1.0, 1),
    ("def add(a, b)\n    return a + b", "", _TESTS, 0.0, 1),
    (_ADD, "", "import sys\nprint('noise', file=sys.stderr)\nassert add(1, 1) == 2\n", 0.0, 1),
    (_ADD, "", "n = 3\nfor i in range(n):\n    assert add(i, 0) == i\n", 0.0, 1),
    ("def add(a, b):\n    while True:\n        pass\n", "", "assert add(1, 1) == 2\n", 0.0, 1),
    (_ADD, "", "for a, b in [(1, 2), (3, 4)]:\n    for i, c in enumerate((0, 1, 2)):\n        assert add(a, b) == a + b\nelse:\n    assert add(2, 2) == 4\n", 1.0, 1),
    (_ADD, "", "def test():\n    assert add(1, 1) == 2\n", 0.0, 1),
]

_OK = '{"task_id": "t", "question": "q", "reward": {"ground_truth": "g", "style": "rule"}, "data_source": "d", "repo_name": "r", "extra_info": {}}'
#: line, errors (None: the line is skipped), warnings
RECORDS = [
    (_OK, 0, 0),
    (_OK.replace('"repo_name": "r"', '"repo_name": ""'), 1, 0),
    (_OK.replace('"question": "q", ', ""), 1, 0),
    (_OK.replace('{"ground_truth": "g", "style": "rule"}', '"r"'), 1, 0),
    (_OK.replace('"rule"', '"other"'), 1, 0),
    (_OK.replace('{"ground_truth": "g", "style": "rule"}', "{}"), 2, 0),
    (_OK.replace('"g"', '"  "'), 1, 0),
    ("{}", 6, 0),
    ("[1]", 1, 0),
    ("{broken", 1, 0),
    (_OK[:-1] + ', "a": 1, "b": null}', 0, 1),
    ("  ", None, None),
    (_OK.replace('"t"', "1").replace('"d"', '"\\u3000"'), 2, 0),
    (_OK.replace('"style": "rule"', '"style": 1'), 1, 0),
    (_OK + " x", 1, 0),
    (_OK.replace('"extra_info": {}', '"extra_info": []'), 1, 0),
    ("null", 1, 0),
    (_OK[:-1] + ', "task_id": " "}', 1, 0),
]

#: html, Markdown
MARKDOWN = [
    ("<h1>Head</h1><p>One <b>bold</b> and <i>slanted</i>.</p><p>Two</p>", "# Head\n\nOne **bold** and *slanted*.\n\nTwo"),
    ("<ul><li>a<li>b<ul><li>c</li></ul></li></ul><ol><li>x</li><li>y</li></ol>", "- a\n\n- b\n\n  - c\n\n1. x\n\n2. y"),
    ('<pre><code class="language-python">def f(x):\n    return x &lt; 1\n</code></pre>', "```python\ndef f(x):\n    return x < 1\n```"),
    ("<p>Use <code>a*b</code> &amp; <code>`</code></p>", "Use `a*b` & `` ` ``"),
    ('<p><a href="/x">link</a><br>next <img src="i.png" alt="pic"></p>', "[link](/x)  \nnext ![pic](i.png)"),
    ("<nav>menu</nav><script>var t='</p>'</script><style>p{}</style><p>kept<!-- not --></p><footer>f</footer><aside>a</aside>", "kept"),
    ("<table><tr><th>A<th>B</tr><tr><td>1<td>2|3</tr></table>", "| A | B |\n| --- | --- |\n| 1 | 2\\|3 |"),
    ("<blockquote><p>quoted</p><p>twice</p></blockquote>after", "> quoted\n\n> twice\n\nafter"),
    ("<p>open <b>never closed", "open **never closed**"),
    ("plain &lt; text", "plain < text"),
    ("<title>t</title><p>  spaces \n and\tlines </p>", "t\n\nspaces and lines"),
]
