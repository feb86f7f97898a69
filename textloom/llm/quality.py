"""Quality rules: base counts of words and lines, then tokeniser fertility against a public vocabulary.

Every word is encoded by itself with a byte-fallback SentencePiece vocabulary, so one table of words already met serves
all documents of a worker. Per document that gives characters per token, the share of byte-fallback tokens and the entropy
of its token distribution in bits, which grows with a text's length and so has a floor that does; a document outside the band
of its language, or of its main script where the language has no band, is rejected.

Defined results: null and empty texts have no words and fail the base rules; a null or unknown language falls to the
script's band; repeated rows are judged each by itself; an empty table gives an empty result. Documents are judged whole,
one at a time, so nothing is shuffled and a hot source or a long text costs no more than its own length.
"""

from __future__ import annotations

import math
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import slices, words

SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"
SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, chars_per_token double, byte_share double, entropy double, band string, kept boolean"


@dataclass(frozen=True)
class Band:
    """Limits outside which a document is rejected. Entropy: at least ``min_bits`` at 128 tokens, ``per_doubling`` more for each
    doubling from 64 up to 4,096 tokens, beyond which the vocabulary of a text hardly widens its distribution."""

    min_chars: float
    max_chars: float
    max_bytes: float
    min_bits: float
    per_doubling: float = 0.0

    def floor(self, tokens: int) -> float:
        return self.min_bits + self.per_doubling * math.log2(min(max(tokens, 64), 4096) / 128)


#: By language code, then by script. Fixed numbers. Those of the four languages were fitted on the labelled documents of sf0.1 that pass
#: the base rules (3,243 clean, 291 not): the slope of the floor is the one that rejects most junk with the floor 0.04 bits under the
#: least clean document; characters a token begin 0.03 under the least clean document, which lies above random letters (1.49 to 1.64).
#: The upper limit stays wide, for text whose words the vocabulary knows whole. Scripts have no labelled documents and stay wide.
BANDS = {
    "en": Band(1.82, 6.5, 0.04, 5.53, 0.26), "de": Band(2.01, 6.5, 0.04, 5.66, 0.2), "fr": Band(1.62, 6.5, 0.04, 5.45, 0.22), "es": Band(1.76, 6.5, 0.04, 5.58, 0.2),
    "LATIN": Band(1.1, 7.5, 0.10, 4.8, 0.2), "CYRILLIC": Band(0.9, 6.0, 0.15, 4.6, 0.15), "GREEK": Band(0.6, 4.0, 0.50, 3.6), "CJK": Band(0.3, 2.5, 0.95, 4.0), "OTHER": Band(0.25, 8.0, 1.0, 3.2),
}


@dataclass(frozen=True)
class Rules:
    """Production parameters. ``cache_words`` bounds the table of words in a worker; it changes the speed, never a result."""

    vocabulary: str
    min_words: int = 50
    max_repeat_percent: int = 50
    bands: dict[str, Band] = field(default_factory=lambda: dict(BANDS))
    cache_words: int = 250_000


def repeat_words(a: np.ndarray) -> int:
    """Words inside 3-word windows found at least twice, the first included."""
    if len(a) < 4:
        return 0
    top = int(a.max()) + 1
    if top < 1 << 21:
        w = (a[:-2] * top + a[1:-1]) * top + a[2:]
    else:
        _, w = np.unique(np.stack([a[:-2], a[1:-1], a[2:]], 1), axis=0, return_inverse=True)
    order = np.argsort(w, kind="stable")
    same = w[order[1:]] == w[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(len(a), dtype=bool)
    at = np.concatenate([order[1:][same], order[:-1][same]])
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


def main_script(text: str) -> str:
    """Script of most of the letters of the whole text, each distinct letter looked up once."""
    found: dict[str, int] = {}
    chars, n = np.unique(np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32), return_counts=True)
    for c, k in zip(chars.tolist(), n.tolist(), strict=True):
        if (ch := chr(c)).isalpha():
            name = unicodedata.name(ch, "OTHER").split(" ")[0]
            name = "CJK" if name in ("CJK", "HIRAGANA", "KATAKANA", "HANGUL") else name
            found[name] = found.get(name, 0) + k
    return max(sorted(found), key=found.get) if found else "OTHER"


class Meter:
    """Token figures of words, kept by word."""

    def __init__(self, rules: Rules):
        import sentencepiece

        self.rules, self.model = rules, sentencepiece.SentencePieceProcessor(model_file=rules.vocabulary)
        self.of_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.known: dict[bytes, bytes] = {}
        self.missed = 0

    def table(self, ws: set[bytes]) -> dict[bytes, bytes]:
        """Token ids of words. A full table stays as it is, since common words come early, until it misses too often."""
        new = [w for w in ws if w not in self.known]
        if not new:
            return self.known
        found = self.known
        if len(found) + len(new) > self.rules.cache_words:
            self.missed += len(new)
            if self.missed > 4 * self.rules.cache_words:
                self.known, self.missed = {}, 0
            found = {w: x for w in ws if (x := self.known.get(w)) is not None}
            new = [w for w in ws if w not in found]
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            for w, ids in zip(part, self.model.encode([w.decode("utf-8") for w in part], num_threads=1), strict=True):
                found[w] = array("H", ids).tobytes()
        return found


def judge_all(texts: list[str | None], langs: list[str | None], meter: Meter) -> list[tuple]:
    """A row of figures per text. Words of several texts are looked up together, at most some MB of text at a time."""
    out, held, size = [], [], 0
    for text, lang in zip(texts, langs, strict=True):
        text = text or ""
        ids: dict[bytes, int] = {}
        number = ids.setdefault
        held.append((text, lang, ids, np.array([number(w, len(ids)) for w in words(text)], dtype=np.int64)))
        size += len(text)
        if size > 4_000_000:
            out += _rows(held, meter)
            held, size = [], 0
    return out + _rows(held, meter)


def _rows(held: list[tuple], meter: Meter) -> list[tuple]:
    table = meter.table(set().union(*(ids for _, _, ids, _ in held)))
    return [_row(*x, table, meter) for x in held]


def _row(text: str, lang: str | None, ids: dict[bytes, int], seq: np.ndarray, table: dict[bytes, bytes], meter: Meter) -> tuple:
    rules, n = meter.rules, len(seq)
    n_repeat = repeat_words(seq)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen, dup = set(), 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                dup += 1
            elif line.encode("utf-8", "replace").strip():
                seen.add(line)
    failed = n < rules.min_words or 100 * n_repeat > rules.max_repeat_percent * n
    per, share, entropy, name, kept = None, None, None, None, False
    if n:
        got = [table[w] for w in ids]
        t = np.frombuffer(b"".join(got), dtype=np.uint16)
        times = np.repeat(np.bincount(seq), np.fromiter(map(len, got), dtype=np.int64, count=len(got)) // 2)
        total = int(times.sum())
        counts = np.bincount(t, weights=times)
        p = counts[counts > 0] / total
        per, share = chars / total, float(times[meter.of_byte[t]].sum()) / total
        entropy = float(-(p * np.log2(p)).sum())
        name = lang if lang in rules.bands else main_script(text)
        band = rules.bands.get(name) or rules.bands["OTHER"]
        kept = not failed and band.min_chars <= per <= band.max_chars and share <= band.max_bytes and entropy >= band.floor(total)
    return n, chars, symbols, dup, n_repeat, failed, per, share, entropy, name, kept


_meters: dict[str, Meter] = {}


def _meter(rules: Rules) -> Meter:
    key = repr(rules)
    if key not in _meters:
        _meters.clear()
        _meters[key] = Meter(rules)
    return _meters[key]


def _frame(texts: pd.Series, langs: pd.Series, rules: Rules) -> pd.DataFrame:
    m, names = _meter(rules), [x.split(" ")[0] for x in SCHEMA.split(", ")]
    return pd.DataFrame(judge_all(texts.tolist(), langs.tolist(), m), columns=names)


def quality_table(docs: DataFrame, rules: Rules, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: its id, the base counts, the fertility figures and the verdict."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in slices(batches):
            out = _frame(b["t"], b["g"], rules)
            out.insert(0, "id", b["id"].array)
            yield out

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.col(lang_col).alias("g"))
    return src.mapInPandas(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)


def kept_column(rules: Rules, text: Column, lang: Column) -> Column:
    """The verdict as a column, for a filter that passes all columns on."""

    @F.pandas_udf("boolean")
    def verdict(t: pd.Series, g: pd.Series) -> pd.Series:
        return _frame(t, g, rules)["kept"]

    return verdict(text, lang)
