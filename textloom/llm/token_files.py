"""Token ids in binary files: one zstandard frame per document, a trailing seek table, a checksum per frame.

File layout (the seekable format of the zstandard project): frames, each the little-endian unsigned 32-bit ids of one
document, then a skippable frame 0x184D2A5E whose table has compressed size, raw size and the low 32 bits of XXH64 of the raw
bytes for every frame, closed by the number of frames, a descriptor byte and the magic number 0x8F92EAB1. Before it stands a
skippable frame 0x184D2A50 with the documents' ids, so a file says by itself which frame is whose. A reader fetches the table
from the file's end and then only the frames it was asked for.

Documents are dealt by range of id (hash of text where ids are equal, so that a hot id is cut too), a file for each range;
file numbers follow the ranges, so files in order hold documents in ascending id order, null ids first. A task that is run
again writes a file of another name; the manifest, written once all are done, names those that count.

Tokenising goes by pieces cut before single spaces between visible characters, where a byte-level pre-tokeniser always
cuts, so pieces already met come from a table of bounded size; a token that begins with a space marks where a piece begins. A vocabulary
file that states another normaliser or pre-tokeniser, or whose ids of some probes differ by pieces, gets its texts whole, and so does a text that holds
the string of an added token: such a string is that token, as the library has it, or plain text with ``special_as_text``.

Defined results: null and empty texts are the end id alone; equal ids follow each other; an empty table gives no rows and no files.
"""

from __future__ import annotations

import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._util import Scratch, file_system, make_dir, slices

END_ID = 2
_SKIP, _IDS, _MAGIC = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
#: Signs that end words; no apostrophe, which the pre-tokeniser may keep with what follows. Letters below this one are old ones, on
#: which Python and the tokeniser agree.
_TAIL, _LETTERS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", "ɐ"

#: The pre-tokeniser under which texts may be cut into pieces, and texts on which that is tried.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_PROBES = ["One two, three; don't (stop) 12 a.b!", " lead and  run \n\n tail ", "l'été où 3% — 漢字 😀", "x\ny \n z\tq", "Größe: [ok] {a} <b> 'c' \"d\"", "", "word"]


@dataclass(frozen=True)
class Vocabulary:
    """``cache_pieces`` bounds a worker's table of pieces; it changes the speed, never a result."""

    path: str
    end_id: int = END_ID
    special_as_text: bool = False
    cache_pieces: int = 800_000


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(vocabulary.path)
        self.tok.encode_special_tokens = vocabulary.special_as_text
        added = self.tok.get_added_tokens_decoder().values()
        self.added = [a.content for a in added if not (a.special and vocabulary.special_as_text)]
        self.limit, self.end = vocabulary.cache_pieces, np.array([vocabulary.end_id], dtype="<u4").tobytes()
        names = [self.tok.id_to_token(i) or "" for i in range(self.tok.get_vocab_size())]
        self.begins = {" ": np.array([x.startswith("Ġ") for x in names]), "\n": np.array([x.startswith("Ċ") for x in names])}
        self.known: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.missed = 0
        with open(vocabulary.path, encoding="utf-8") as f:
            made = json.load(f)
        self.by_pieces = made["normalizer"] is None and made["pre_tokenizer"] == _BYTE_LEVEL and not any(re.search(r"\s", a) for a in self.added)
        self.by_pieces = self.by_pieces and made["model"]["type"] == "BPE" and not made["model"].get("dropout") and self._by_pieces(_PROBES) == self._whole(_PROBES)
        self.known, self.tails, self.missed = {}, {}, 0

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes() + self.end for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text with the end id, as little-endian bytes."""
        texts = [t or "" for t in texts]
        if not self.by_pieces:
            return [x for k in range(0, len(texts), 64) for x in self._whole(texts[k : k + 64])]
        odd = [k for k, t in enumerate(texts) if any(a in t for a in self.added)]
        if not odd:
            return self._by_pieces(texts)
        out = self._by_pieces(["" if k in set(odd) else t for k, t in enumerate(texts)])
        for k in odd:
            out[k] = self._whole([texts[k]])[0]
        return out

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces. Those that begin with a line feed are encoded as they are, all others after one space, many in a string. A word
        with a tail of signs is cut before the tail, as this vocabulary's pre-tokeniser cuts, so the word may be known already."""
        lines, words, odd, tailed = [], [], [], []
        for p in pieces:
            if p[0] == "\n":
                lines.append(p)
            elif " " in p:
                odd.append(p)
            elif p.isalpha():
                words.append(p)
            elif (q := p.rstrip(_TAIL)) != p and q.isalpha() and max(q) < _LETTERS:
                tailed.append((p, q))
            else:
                words.append(p)
        known, got = self.known, {}
        words += {q for _, q in tailed if q not in known and q not in pieces}
        for lead, group in (("", lines), (" ", words)):
            sep = lead or "\n"
            for k in range(0, len(group), 4000):
                part = group[k : k + 4000]
                joined = [lead + lead.join(part[j : j + 200]) for j in range(0, len(part), 200)]
                ids = np.fromiter(chain.from_iterable(e.ids for e in self.tok.encode_batch_fast(joined, add_special_tokens=False)), dtype="<u4")
                starts = np.flatnonzero(self.begins[sep][ids])
                if len(starts) != len(part):  # white space inside a piece: one by one
                    odd += part
                    continue
                raw, cuts = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
                got.update(zip(part, map(raw.__getitem__, map(slice, cuts, cuts[1:])), strict=True))
        got.update((p, self._ids(p if p[0] == "\n" else " " + p).tobytes()) for p in odd)
        for p, q in tailed:
            got[p] = (got.get(q) or known[q]) + self._tail(p[len(q) :])
        return got

    def _tail(self, signs: str) -> bytes:
        raw = self.tails.get(signs)
        if raw is None:
            if len(self.tails) > 100_000:
                self.tails.clear()
            raw = self.tails[signs] = self._ids(signs).tobytes()
        return raw

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        """At most some MB of text at a time."""
        out, heads, rests, size = [], [], [], 0
        for t in texts:
            if len(" ".join(t.split())) == len(t):  # white space stands alone between visible characters
                parts = t.replace("\n", " \n").split(" ")
                head, rest = parts[0], parts[1:]
            else:
                head, rest = _runs(t.split(" "))
            heads.append(head)
            rests.append(rest)
            size += len(t)
            if size > 4_000_000:
                out += self._join(heads, rests)
                heads, rests, size = [], [], 0
        return out + self._join(heads, rests)

    def _join(self, heads: list[str], rests: list[list[str]]) -> list[bytes]:
        """A full table stays as it is, since common pieces come early, until it misses too often."""
        found = [list(map(self.known.get, rest)) for rest in rests]
        missing: set[str] = set()
        gaps: list[list[int]] = []
        for rest, ids in zip(rests, found, strict=True):
            k, at = -1, []
            for _ in range(ids.count(None)):
                k = ids.index(None, k + 1)
                at.append(k)
            missing.update(map(rest.__getitem__, at))
            gaps.append(at)
        got = self._learn(missing) if missing else {}
        for rest, ids, at in zip(rests, found, gaps, strict=True):
            for k in at:
                ids[k] = got[rest[k]]
        if len(self.known) + len(got) <= self.limit:
            self.known.update(got)
        else:
            self.missed += len(got)
            if self.missed > 8 * self.limit:
                self.known, self.missed = {}, 0
        first = self.tok.encode_batch_fast(heads, add_special_tokens=False)
        return [np.asarray(h.ids, dtype="<u4").tobytes() + b"".join(ids) + self.end for h, ids in zip(first, found, strict=True)]


def _runs(parts: list[str]) -> tuple[str, list[str]]:
    """Puts words back together across white space that isn't a single space between visible characters; only single ones remain cuts."""
    out, open_ = [parts[0]], not parts[0] or parts[0][-1].isspace()
    for w in parts[1:]:
        if open_ or not w or w[0].isspace():
            out[-1] += " " + w
        else:
            out.append(w)
        open_ = not w or w[-1].isspace()
    return out[0], out[1:]


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: Vocabulary) -> Encoder:
    key = repr(vocabulary)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


class FrameWriter:
    """Appends documents to a stream; ``close`` writes the ids and the seek table."""

    def __init__(self, out):
        self.out, self.z = out, zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
        self.table, self.ids = [], []

    def add(self, doc_id: int | None, raw: bytes) -> None:
        frame = self.z.compress(raw)
        self.out.write(frame)
        self.table.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.ids.append(doc_id)

    def close(self) -> None:
        ids = self.z.compress("\n".join("" if i is None else str(i) for i in self.ids).encode())
        self.out.write(struct.pack("<II", _IDS, len(ids)) + ids)
        entries = b"".join(struct.pack("<III", *e) for e in self.table)
        foot = struct.pack("<IBI", len(self.table), 0x80, _MAGIC)
        self.out.write(struct.pack("<II", _SKIP, len(entries) + len(foot)) + entries + foot)


class FrameReader:
    """Random access to a file of frames through any seekable stream."""

    def __init__(self, stream):
        self.f = stream
        stream.seek(-9, io.SEEK_END)
        n, descriptor, magic = struct.unpack("<IBI", stream.read(9))
        if magic != _MAGIC or descriptor != 0x80:
            raise ValueError("no seek table at the end of the file")
        stream.seek(-(9 + 12 * n + 8), io.SEEK_END)
        head, _ = struct.unpack("<II", stream.read(8))
        if head != _SKIP:
            raise ValueError("the seek table has no frame of its own")
        t = np.frombuffer(stream.read(12 * n), dtype="<u4").reshape(n, 3)
        self.sizes, self.raw, self.sums = t[:, 0].astype(np.int64), t[:, 1].astype(np.int64), t[:, 2]
        self.at = np.concatenate([[0], np.cumsum(self.sizes)])

    def __len__(self) -> int:
        return len(self.sizes)

    def ids(self) -> list[int | None]:
        self.f.seek(int(self.at[-1]))
        kind, n = struct.unpack("<II", self.f.read(8))
        if kind != _IDS:
            raise ValueError("the documents' ids are missing")
        lines = zstandard.ZstdDecompressor().decompress(self.f.read(n)).decode().split("\n") if len(self) else []
        return [int(x) if x else None for x in lines]

    def read(self, k: int) -> bytes:
        """Document ``k`` of the file, checked."""
        self.f.seek(int(self.at[k]))
        raw = zstandard.ZstdDecompressor().decompress(self.f.read(int(self.sizes[k])), max_output_size=int(self.raw[k]))
        if len(raw) != self.raw[k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k} is damaged")
        return raw


def write_tokens(docs: DataFrame, vocabulary: Vocabulary, folder: str, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files; returns the manifest: a row per file with its number, path, documents, ids (all of them), first and last document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, part = encoder(vocabulary), TaskContext.get().partitionId()
        fs, top = file_system(folder)
        path, writer, n = f"{top}/part-{part:06d}-{uuid.uuid4().hex[:8]}.tok.zst", None, 0
        stream = None
        for b in slices(batches):
            if not len(b):
                continue
            if writer is None:
                stream = fs.open_output_stream(path, compression=None)
                writer = FrameWriter(stream)
            for i, raw in zip(b["id"].tolist(), enc.encode(b["t"].tolist()), strict=True):
                writer.add(None if pd.isna(i) else int(i), raw)
                n += len(raw) // 4
        if writer is not None:
            writer.close()
            stream.close()
            ends = pd.array([writer.ids[0], writer.ids[-1]], dtype="Int64")
            yield pd.DataFrame({"part": [part], "path": [path], "n_docs": [len(writer.ids)], "n_ids": [n], "first": ends[:1], "last": ends[1:]})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    rows = rows.repartitionByRange("id", F.xxhash64("t")).sortWithinPartitions("id", F.xxhash64("t"))
    rows = rows.select(F.col("id").cast("string").alias("id"), "t")  # longs with nulls would become floats in Python, which round
    return scratch.save(rows.mapInPandas(run, "part int, path string, n_docs long, n_ids long, first long, last long"), "manifest")


def read_tokens(manifest: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Reads every file back: id, ``start`` (ids before the document), ``n_tokens``, ``ids_crc32``.

    Starts of files are a running sum over the manifest, which has a row per file.
    """
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_ids").over(w), F.lit(0)).cast("long").alias("base"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = file_system(folder)
        for b in batches:
            for path, base in zip(b["path"], b["base"], strict=True):
                with fs.open_input_file(path) as f:
                    r = FrameReader(f)
                    ids = r.ids()
                    n = r.raw // 4
                    starts = base + np.concatenate([[0], np.cumsum(n)])
                    for k in range(0, len(r), 4096):
                        span = range(k, min(k + 4096, len(r)))
                        yield pd.DataFrame({"id": pd.array([ids[j] for j in span], dtype="Int64"), "start": starts[span.start : span.stop], "n_tokens": n[span.start : span.stop], "ids_crc32": [zlib.crc32(r.read(j)) for j in span]})

    n = max(1, manifest.count())  # a task a file: rows are few and small here, what they name is not
    return files.repartition(n, "path").mapInPandas(run, "id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)


def fetch(manifest: DataFrame, folder: str, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, ids array<long>) of the wanted documents: only the seek tables of their files and their own frames are read.

    A wanted id goes to every file whose range holds it (two where equal ids straddle a cut); repeated ones are fetched once, null
    and unknown ones not at all. What is sent to the executors is two numbers a file.
    """
    rows = manifest.where("last is not null").select("part", "path", F.coalesce("first", F.lit(-(1 << 63))).alias("first"), "last").orderBy("part").toPandas()
    held = manifest.sparkSession.sparkContext.broadcast((rows["first"].to_numpy(), rows["last"].to_numpy(), rows["path"].tolist()))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, last, paths = held.value
        for b in batches:
            ids = b["id"].to_numpy()
            lo, hi = np.searchsorted(last, ids, "left"), np.searchsorted(first, ids, "right")
            yield pd.DataFrame([(paths[k], i) for i, x, y in zip(ids.tolist(), lo.tolist(), hi.tolist(), strict=True) for k in range(x, y)], columns=["path", "id"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = file_system(folder)
        for b in batches:
            for path, g in b.groupby("path", sort=False):
                with fs.open_input_file(path) as f:
                    r, ask = FrameReader(f), set(g["id"].tolist())
                    for k, i in enumerate(r.ids()):
                        if i in ask:
                            yield pd.DataFrame({"id": [i], "ids": [np.frombuffer(r.read(k), dtype="<u4").astype(np.int64)]})

    ids = wanted.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct()
    placed = ids.mapInPandas(place, "path string, id long")
    return placed.repartition("path").sortWithinPartitions("path").mapInPandas(read, "id long, ids array<long>").withColumnRenamed("id", id_col)


def token_table(docs: DataFrame, vocabulary: Vocabulary, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the documents' ids to ``folder`` (one of its own in the shared folder by default) and returns what the files say."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    folder = folder or make_dir(spark, "tokenfiles")
    return read_tokens(write_tokens(docs, vocabulary, folder, scratch, id_col, text_col), folder, id_col)
