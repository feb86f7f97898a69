"""WARC archives, index first: records are written with an index of offset, length, URL and digest; readers take byte ranges from it.

Records are WARC/1.1, each a gzip member of its own. Of records with equal payloads of at least 100 bytes the one with the
smallest page id is a ``response``, the others are ``revisit`` records that name it and carry no payload, only its digest and
length. Smaller payloads are always written in full. The index is a table; a selection of it is read by sorting its ranges
within each archive, joining ranges that lie close together and cutting the bytes read into records.

Digests and the smallest id of each are found on narrow rows. Digests that repeat are entered in a bitmap of fixed size, which every
task gets: payloads outside it are written where they are read, and only what lies in it (repeats, and a few by chance) is shuffled to meet
its partner, by a join whose skew handling splits a digest that holds many rows. Reading back has a task for every 16 MB selected. Tasks that run again write archives of another name; the index, written
once, names those that count.

Defined results: a null html is empty; rows that share digest and smallest id are all responses; a null page id never is
referred to while another id has the payload, and if all are null all are responses; a null url has no target header;
an empty table gives no rows and no archives. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import Scratch, file_system, make_dir, marked, slices

LEAST = 100
DATE = "2000-01-01T00:00:00Z"
INDEX = "page_id long, archive string, offset long, length long, url string, digest string, record_type string, refers_to long"
#: Ranges that lie at most so far apart are read as one, up to so many bytes at once.
GAP, MOST = 64 << 10, 16 << 20
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:pages")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}:{digest}')}>"


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, length: int, refers_to: int | None) -> bytes:
    """One gzip member. A revisit keeps the length and digest of the full payload in its headers."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]", errors="replace"))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {length}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return _gzip("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, payload) of a record; checks the lengths it states, and the digest of a response."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    n = int(fields["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    _, _, payload = rest[:n].partition(b"\r\n\r\n")
    if fields["warc-type"] == "response" and "sha256:" + hashlib.sha256(payload).hexdigest() != fields["warc-payload-digest"]:
        raise ValueError("a payload's digest is wrong")
    return fields, payload


def referred(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(i, u, h, d, n, ref): id, URL, payload, digest, length, and the page that a revisit refers to."""
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    id_ = F.col(id_col).cast("long")
    rows = pages.select(id_.alias("i"), F.col(url_col).alias("u"), html.alias("h"), F.sha2(html, 256).alias("d"), F.octet_length(html).cast("long").alias("n"))
    twins = rows.where(F.col("n") >= LEAST).groupBy("d").agg(F.count("*").alias("k"), F.min("i").alias("first")).where("k > 1 and first is not null").select("d", "first")
    rows = marked(rows, F.xxhash64("d"), twins, F.xxhash64("d"), "again")
    alone = rows.where(~F.col("again")).select("i", "u", "h", "d", "n", F.lit(None).cast("long").alias("ref"))
    met = rows.where("again").select("i", "u", "h", "d", "n").join(twins, "d", "left")
    return alone.unionByName(met.withColumn("ref", F.when(~F.col("i").eqNullSafe(F.col("first")), F.col("first"))).drop("first"))


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes an archive per task and returns the index, a row per record."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, top = file_system(folder)
        path, out, at = f"{top}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}.warc.gz", None, 0
        for b in slices(batches):
            rows = []
            for i, url, html, digest, n, ref in b.itertuples(index=False):
                i, ref = (None if pd.isna(x) else int(x) for x in (i, ref))
                if out is None:
                    out = fs.open_output_stream(path, compression=None)
                data = record(i, url, html or b"", digest, n, ref)
                out.write(data)
                rows.append((i, path, at, len(data), url, digest, "response" if ref is None else "revisit", ref))
                at += len(data)
            yield pd.DataFrame(rows, columns=[x.split(" ")[0] for x in INDEX.split(", ")], dtype=object).astype({"page_id": "Int64", "offset": "int64", "length": "int64", "refers_to": "Int64"})
        if out is not None:
            out.close()

    # A revisit carries no payload, so Python does not get it. Ids go as strings: longs with nulls would become floats, which round.
    payload = F.when(F.col("ref").isNull(), F.col("h")).alias("h")
    rows = referred(pages, id_col, url_col, html_col).select(F.col("i").cast("string").alias("i"), "u", payload, "d", "n", F.col("ref").cast("string").alias("ref"))
    return scratch.save(rows.mapInPandas(run, INDEX), "index")


def ranges(records: list[tuple[int, int]], gap: int = GAP, most: int = MOST) -> list[tuple[int, int, list[int]]]:
    """(offset, length, records in it) of the reads that cover sorted (offset, length) records; only a single record is longer than ``most``."""
    out: list[tuple[int, int, list[int]]] = []
    for k, (at, n) in enumerate(records):
        if out and at - (out[-1][0] + out[-1][1]) <= gap and at + n - out[-1][0] <= most:
            begin, have, held = out[-1]
            out[-1] = (begin, max(have, at + n - begin), [*held, k]) if held[-1] != k else out[-1]
        else:
            out.append((at, n, [k]))
    return out


def read_records(selected: DataFrame, folder: str) -> DataFrame:
    """Reads the records of an index or of any part of it: headers and payloads.

    Archives are cut into stretches of some MB, so a large archive is read by several tasks; within a stretch records are in
    the order of their offsets and close ones are read together. Returns page_id, record_type, refers_to, payload_bytes,
    payload_digest, payload (null for a revisit, whose payload is its ``refers_to`` record's).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = file_system(folder)
        held: dict[str, object] = {}
        for b in batches:
            for path, g in b.groupby("archive", sort=False):
                if path not in held:
                    for f in held.values():
                        f.close()
                    held = {path: fs.open_input_file(path)}
                spots = list(zip(g["offset"].tolist(), g["length"].tolist(), strict=True))
                for begin, n, members in ranges(spots):
                    held[path].seek(begin)
                    data, rows = held[path].read(n), []
                    for k in members:
                        at, size = spots[k]
                        h, payload = parse(data[at - begin : at - begin + size])
                        i, ref = h.get("x-page-id"), h.get("x-refers-to-page")
                        digest = re.sub("^sha256:", "", h["warc-payload-digest"])
                        full = h["warc-type"] == "response"
                        rows.append((None if i is None else int(i), h["warc-type"], None if ref is None else int(ref), len(payload) if full else int(h["x-payload-length"]), digest, payload if full else None))
                    yield pd.DataFrame(rows, columns=["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"], dtype=object).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})

    where = selected.select("archive", "offset", "length", F.floor(F.col("offset") / MOST).alias("stretch"))
    tasks = max(1, -(-(selected.agg(F.sum("length")).first()[0] or 0) // MOST))  # rows are few and narrow, what they name is not
    where = where.repartition(tasks, "archive", "stretch").sortWithinPartitions("archive", "offset")
    return where.mapInPandas(run, "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")


def warc_table(pages: DataFrame, folder: str | None = None, id_col: str = "page_id") -> DataFrame:
    """Writes archives of all pages, reads all of them back by the index, and returns what the records say."""
    spark = pages.sparkSession
    folder = folder or make_dir(spark, "warcfiles")
    index = write_archives(pages, folder, Scratch(spark, "warc"), id_col)
    return read_records(index, folder).select(F.col("page_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
