"""HTML to Markdown with the standard library's parser: a page becomes blocks, code keeps its white space and language."""

from __future__ import annotations

import re
from collections import defaultdict
from html.parser import HTMLParser

SKIPPED = frozenset("head script style noscript template nav footer aside svg iframe button select textarea".split())
BLOCKS = frozenset("html body address article blockquote center dd details div dl dt fieldset figcaption figure form h1 h2 h3 h4 h5 h6 header hr li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "del": "~~", "s": "~~", "strike": "~~"}
#: What a start tag ends, and the tags that shield it; others are ended by their own kind within any block.
_ENDS = {"li": (("li",), ("ul", "ol")), "tr": (("tr",), ("table",))} | {t: (("td", "th"), ("tr", "table")) for t in ("td", "th")} | {t: (("dt", "dd"), ("dl",)) for t in ("dt", "dd")}
_LANGUAGE = re.compile(r"(?:^|\s)(?:language|lang|highlight-source|brush:)[-\s]*([\w+#.-]+)")


def _language(attrs: dict[str, str | None]) -> str:
    m = _LANGUAGE.search(attrs.get("class") or "")
    return m[1] if m else (attrs.get("data-lang") or "")


def _fence(text: str, tick: str = "`", least: int = 3) -> str:
    longest = max(map(len, re.findall(f"{tick}+", text)), default=0)
    return tick * max(least, longest + 1)


class _Page(HTMLParser):
    """Where the open elements of each tag lie in the stack is kept, so a tag costs no walk through it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []  # finished blocks
        self.text: list[str] = []  # of the block being read
        self.marks: list[int] = []  # where emphasis opens in the text
        self.stack: list[str] = []
        self.open: dict[str, list[int]] = defaultdict(list)  # places in the stack by tag
        self.solid, self.walls = [-1], [-1]  # places of blocks; of blocks but paragraphs
        self.skip = 0
        self.lists: list[int | None] = []  # running number of an ordered list, None for a bullet list
        self.lead = ""  # what the next block begins with
        self.quotes = 0
        self.pre: list[str] | None = None
        self.language = ""
        self.links: list[tuple[str, int]] = []
        self.code_at: int | None = None
        self.rows: list[list[str]] | None = None
        self.cell = False

    # -- blocks
    def _emit(self, block: str) -> None:
        if block:
            quote = "> " * self.quotes
            self.out.append("\n".join(quote + line if line or quote else line for line in block.split("\n")))

    def flush(self) -> None:
        raw, self.text, self.marks = "".join(self.text), [], []
        lines = [re.sub(r"[^\S\n]+", " ", x).strip() for x in raw.split("\n")]
        body = "  \n".join(x for x in lines if x)
        if self.rows is not None:
            if self.cell and body and self.rows:
                row = self.rows[-1]
                row[-1] = " ".join(filter(None, [row[-1], body.replace("  \n", " ").replace("|", "\\|")]))
            elif body:
                self._emit(body)
            return
        if body:
            pad = " " * len(self.lead) if self.lists else ""
            self._emit(self.lead + body.replace("\n", "\n" + pad))
            self.lead = " " * len(self.lead) if self.lists else ""

    def _table(self) -> None:
        rows, self.rows = [r for r in self.rows or [] if any(r)], None
        if rows:
            width = max(map(len, rows))
            rows = [r + [""] * (width - len(r)) for r in rows]
            lines = ["| " + " | ".join(r) + " |" for r in rows]
            self._emit("\n".join([lines[0], "|" + " --- |" * width, *lines[1:]]))

    # -- the stack
    def _push(self, tag: str) -> None:
        k = len(self.stack)
        self.stack.append(tag)
        self.open[tag].append(k)
        if tag in BLOCKS:
            self.solid.append(k)
            if tag != "p":
                self.walls.append(k)

    def _pop(self) -> str:
        t = self.stack.pop()
        self.open[t].pop()
        for places in (self.solid, self.walls):
            if places[-1] == len(self.stack):
                places.pop()
        return t

    def _last(self, *tags: str) -> int:
        return max((p[-1] for t in tags if (p := self.open.get(t))), default=-1)

    # -- events
    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = dict(attrs)
        if tag in SKIPPED or self.skip:
            if tag not in VOID:
                self._push(tag)
                self.skip += tag in SKIPPED
            return
        if self.pre is not None:
            if tag == "code":
                self.language = self.language or _language(a)
            elif tag == "br":
                self.pre.append("\n")
            if tag not in VOID:
                self._push(tag)
            return
        if tag in BLOCKS:
            self.flush()
            if tag in ("p", "li", "td", "th", "tr", "dt", "dd"):
                self._close_open(tag)
        if tag == "br":
            self.text.append("\n")
        elif tag == "hr":
            self._emit("---")
        elif tag == "img":
            if a.get("src"):
                self.text.append(f"![{' '.join((a.get('alt') or '').split())}]({a['src']})")
        elif tag == "pre":
            self.pre, self.language = [], _language(a)
        elif tag in ("ul", "ol"):
            start = a.get("start") or "1"
            self.lists.append((int(start) if start.isdigit() else 1) if tag == "ol" else None)
        elif tag == "li" and self.lists:
            indent = "  " * (len(self.lists) - 1)
            n = self.lists[-1]
            self.lead = f"{indent}{n}. " if n is not None else f"{indent}- "
            if n is not None:
                self.lists[-1] = n + 1
        elif tag == "blockquote":
            self.quotes += 1
        elif tag == "table":
            if self.rows is None:
                self.rows = []
        elif tag == "tr" and self.rows is not None:
            self.rows.append([])
            self.cell = False
        elif tag in ("td", "th") and self.rows is not None:
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append("")
            self.cell = True
        elif re.fullmatch("h[1-6]", tag):
            self.lead = "#" * int(tag[1]) + " "
        elif tag in MARKS:
            self.marks.append(len(self.text))
            self.text.append(MARKS[tag])
        elif tag == "code":
            self.code_at = len(self.text)
        elif tag == "a":
            self.links.append((a.get("href") or "", len(self.text)))
        if tag not in VOID:
            self._push(tag)

    def _close_open(self, tag: str) -> None:
        """A start tag that ends an open element of its kind."""
        close, stop = _ENDS.get(tag, ((tag,), ()))
        at = self._last(*close)
        if at > (self._last(*stop) if stop else self.walls[-1]):
            self.handle_endtag(self.stack[at])

    def handle_endtag(self, tag: str) -> None:
        at = self._last(tag)
        if at < 0 or (not self.skip and tag not in BLOCKS and at < self.solid[-1]):  # an inline end tag does not end blocks
            return
        while len(self.stack) > at:
            self._ended(self._pop())

    def _ended(self, t: str) -> None:
        if t in SKIPPED:
            self.skip -= 1
            return
        if self.skip:
            return
        if self.pre is not None:
            if t == "pre":
                body, self.pre = "".join(self.pre), None
                body = body.removeprefix("\n").removesuffix("\n")
                fence = _fence(body)
                if body:
                    self._emit(f"{fence}{self.language}\n{body}\n{fence}")
            return
        if t == "code" and self.code_at is not None:
            body = "".join(self.text[self.code_at :])
            tick = _fence(body, least=1)
            pad = " " if body.startswith("`") or body.endswith("`") else ""
            self.text[self.code_at :] = [f"{tick}{pad}{body}{pad}{tick}"] if body else []
            self.code_at = None
        elif t in MARKS:
            self._unmark(MARKS[t])
        elif t == "a" and self.links:
            href, at = self.links.pop()
            body = "".join(self.text[at:]).strip()
            if at <= len(self.text) and body and href:
                self.text[at:] = [f"[{body}]({href})"]
        elif t in BLOCKS:
            self.flush()
            if t in ("td", "th"):
                self.cell = False
            elif t == "table":
                self._table()
            elif t in ("ul", "ol") and self.lists:
                self.lists.pop()
                self.lead = ""
            elif t == "blockquote":
                self.quotes -= 1
            elif t == "li" or re.fullmatch("h[1-6]", t):
                self.lead = ""

    def _unmark(self, mark: str) -> None:
        """Closes emphasis: no space inside its marks, none at all if there is nothing between."""
        if not self.marks:  # a block within has ended what it was opened in
            return
        at = self.marks.pop()
        body = "".join(self.text[at + 1 :])
        if body.strip():
            front, back = body[: len(body) - len(body.lstrip())], body[len(body.rstrip()) :]
            body = front + mark + body.strip() + mark + (" " if back else "")
        self.text[at:] = [body]

    def handle_data(self, data: str) -> None:
        if self.skip:
            return
        if self.pre is not None:
            self.pre.append(data)
        else:
            self.text.append(data.replace("\n", " ").replace("\r", " "))


def to_markdown(page: str) -> str:
    """Markdown of a page. Broken markup never fails; what is open at the end is closed."""
    p = _Page()
    p.feed(page)
    p.close()
    while p.stack:
        p._ended(p._pop())
    p.flush()
    return "\n\n".join(x for x in p.out if x.strip()).strip()
