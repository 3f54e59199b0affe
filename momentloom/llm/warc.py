"""WARC archives of pages, with a two-level capture index.

``write_archives`` writes one record per page, each a gzip member of its own, to files of bounded size. Of pages with
equal payloads the one with the largest id is a response, the others are revisits that refer to it and hold no
body. Every task writes files of new names and reports the captures in them; the table of captures is committed by
Spark, so files of lost or repeated attempts are in no index and do no harm.

``write_index`` sorts the captures by key: the host's labels in reverse, the rest of the URL, the
page's id. Runs of sorted captures become compressed blocks; the directory holds the first and last key of each block.
Blocks grow with the number of captures, so that the directory has at most ``DIRECTORY`` entries and a half as many
again at partition ends, and fits every task.

``look_up`` finds captures: a binary search in the directory, another in the block, and a range read of the record.

The payload is the html in UTF-8, null being empty. A null URL has the empty key; each line break or blank in a
URL becomes %20 in the record and in its key. Pages that repeat an id and a payload are all responses if that id is the
largest. A null id is smaller than any other; if all ids of a payload are null, all its records are responses, and a null
id in the result stands for one. Every row gives a record, so repeated rows do too. Tables without rows give empty archives.
Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from base64 import b32encode
from bisect import bisect_left, bisect_right
from gzip import compress
from hashlib import sha1
from math import ceil
from uuid import uuid4

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from momentloom.llm.common import splittable
from momentloom.llm.graph import whole_groups

#: Captures in a block at least, and entries of the directory at most.
BLOCK = 1_000
DIRECTORY = 200_000
#: Bytes from which on a task begins another file.
FILE_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"  # pages bear no time of their own
MARK = "WARC/1.0"
BLANK = r"[\x00-\x20]"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HEX_DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def digest(payload: Column) -> Column:
    """Bare base32 SHA-1: each five hexadecimal digits are four digits to the base of 32."""
    code = F.upper(F.sha1(payload))
    parts = [F.lpad(F.conv(F.substring(code, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), HEX_DIGITS, BASE32)


def url_key(url: Column) -> Column:
    """The URL with its host's labels in reverse and without scheme, login, default port and fragment."""
    whole = F.coalesce(url, F.lit(""))
    rest = F.regexp_replace(F.regexp_replace(whole, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"#.*$", "")
    host = F.lower(F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*", 0), r"^.*@", ""), r":(80|443)$", ""))
    path = F.regexp_replace(rest, r"^[^/?]*", "")
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(path == "", "/").otherwise(path))
    return F.when(whole == "", "").otherwise(F.regexp_replace(key, BLANK, "%20"))


def capture_key(url: Column, page_id: Column) -> Column:
    """The sort key of one capture: the URL's key, then the page's id."""
    number = F.coalesce(F.concat(F.when(page_id < 0, "-").otherwise("0"), F.lpad(F.abs(page_id).cast("string"), 19, "0")), F.lit(""))
    return F.concat(url_key(url), F.lit(" "), number)


def _pages(df: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = df.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    return rows.withColumns({"digest": digest(F.col("payload")), "size": F.octet_length("payload").cast("long")})


def _typed(pages: DataFrame, least: int) -> DataFrame:
    """The pages with ``head``, the id that a revisit refers to; null for a response."""
    groups = pages.where(F.col("size") >= least).groupBy("digest", "size").agg(F.max("page_id").alias("head"), F.count("*").alias("n"))
    heads = splittable(groups.where("n > 1").select("digest", "size", "head"))
    rows = pages.join(heads, ["digest", "size"], "left")
    return rows.withColumn("head", F.when(~F.col("page_id").eqNullSafe(F.col("head")), F.col("head")))


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path, of any kind that Arrow knows, and the place in it."""
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str, payload: bytes, digest: str, head: int | None) -> bytes:
    """One record: a response with its body, or a revisit of the page ``head`` without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if head is None else b"")
    fields = {
        "WARC-Type": "response" if head is None else "revisit",
        "WARC-Record-ID": _urn(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha1:{digest}",
    }
    if head is not None:
        fields |= {"WARC-Refers-To": _urn(head), "WARC-Profile": PROFILE}
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return f"{MARK}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _written(folder: str, most: int):
    """Write the records of a task and tell the place of each."""

    def write(batches):
        file, path, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                columns = [batch["page_id"].astype("Int64"), batch["url"], batch["payload"], batch["digest"], batch["head"].astype("Int64")]
                for page_id, url, payload, code, head in zip(*columns):
                    page_id, head = (None if pd.isna(x) else int(x) for x in (page_id, head))
                    if file is None or at >= most:
                        if file is not None:
                            file.close()
                        path, at = f"{folder}/{uuid4().hex}.warc.gz", 0
                        store, place = _store(path)
                        store.create_dir(place.rpartition("/")[0], recursive=True)
                        file = store.open_output_stream(place, compression=None)
                    member = compress(record(page_id, url, bytes(payload), code, head), mtime=0)
                    file.write(member)
                    rows.append((page_id, path, at, len(member)))
                    at += len(member)
                out = pd.DataFrame(rows, columns=["page_id", "file", "offset", "length"]).assign(url=batch["url"].to_numpy())
                yield out.astype({"page_id": "Int64"})
        finally:
            if file is not None:
                file.close()

    return write


def write_archives(df: DataFrame, page_id: str, url: str, html: str, folder: str, least: int = 0, most: int = FILE_BYTES) -> None:
    """Write a record for each row to files under ``folder``, and the table of their captures beside them.

    Payloads under ``least`` bytes are never revisits. ``folder`` must be new and reachable from all executors.
    """
    pages = _typed(_pages(df, page_id, url, html), least)
    pages = pages.withColumn("url", F.regexp_replace(F.coalesce("url", F.lit("")), BLANK, "%20"))
    written = pages.select("page_id", "url", "payload", "digest", "head").mapInPandas(_written(f"{folder}/archives", most), "page_id long, file string, offset long, length long, url string")
    keyed = written.select(capture_key(F.col("url"), F.col("page_id")).alias("key"), "file", "offset", "length")
    keyed.write.mode("error").parquet(f"{folder}/captures")


def _header(raw: bytes) -> tuple[dict[str, str], int]:
    """Fields of a header and its length with the empty line. Raises on bytes that are no record."""
    end = raw.index(b"\r\n\r\n")
    first, *lines = raw[:end].decode().split("\r\n")
    if first != MARK and not first.startswith("HTTP/"):
        raise ValueError(f"not a record: {first[:40]!r}")
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines), end + 4


def _number(urn: str | None) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">") if urn else ""
    return int(digits) if digits else None


def _blocks(size: int):
    def pack(batches):
        held: list[tuple] = []

        def packed(rows):
            text = "\n".join("\t".join(map(str, r)) for r in rows)
            return {"first": rows[0][0], "last": rows[-1][0], "n": len(rows), "data": zlib.compress(text.encode())}

        for batch in batches:
            held += list(batch[["key", "file", "offset", "length"]].itertuples(index=False, name=None))
            full = len(held) // size * size
            if full:
                yield pd.DataFrame([packed(held[i : i + size]) for i in range(0, full, size)])
                held = held[full:]
        if held:
            yield pd.DataFrame([packed(held)])

    return pack


def write_index(spark: SparkSession, folder: str, block: int = BLOCK) -> None:
    """Index the captures under ``folder``: one row for each block of sorted captures."""
    captures = spark.read.parquet(f"{folder}/captures")
    size = max(block, ceil(captures.count() / DIRECTORY))
    ordered = captures.repartitionByRange("key").sortWithinPartitions("key", "file", "offset")
    ordered.mapInPandas(_blocks(size), "first string, last string, n long, data binary").write.mode("error").parquet(f"{folder}/index")


def _placed(firsts: list[str], lasts: list[str]):
    """For each key the blocks that may hold it, by binary search in the directory."""

    def place(batches):
        for batch in batches:
            rows = []
            for key in batch["key"]:
                for i in range(bisect_left(lasts, key), bisect_right(firsts, key)):
                    rows.append((firsts[i], key))
            yield pd.DataFrame(rows, columns=["first", "key"])

    return place


def _searched(batches):
    """Captures of the keys that follow each block, by binary search among its lines."""
    keys: list[str] = []
    lines: list[list[str]] = []
    first = None
    for batch in batches:
        rows = []
        for start, key, data in zip(batch["first"], batch["key"], batch["data"]):
            if data is not None:
                read = [x.split("\t") for x in zlib.decompress(data).decode().split("\n")]
                if start != first:
                    keys, lines, first = [], [], start
                lines += read  # blocks that begin with one key are searched together
                lines.sort(key=lambda x: x[0])
                keys = [x[0] for x in lines]
                continue
            for i in range(bisect_left(keys, key), bisect_right(keys, key)):
                rows.append((key, lines[i][1], int(lines[i][2]), int(lines[i][3])))
        yield pd.DataFrame(rows, columns=["key", "file", "offset", "length"])


def _read(batches):
    """The records of captures that are sorted by file."""
    for group in whole_groups(batches, ["file"]):
        rows = []
        store, place = _store(group["file"].iloc[0])
        with store.open_input_file(place) as file:
            for offset, length in zip(group["offset"], group["length"]):
                try:
                    raw = zlib.decompress(file.read_at(int(length), int(offset)), wbits=31)
                except zlib.error as error:
                    raise ValueError(f"damaged record at {offset} of {place}") from error
                fields, size = _header(raw)
                http, inner = _header(raw[size:])
                payload = raw[size + inner : -4]
                kind = fields["WARC-Type"]
                told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                n = int(http["Content-Length"])
                if kind == "response" and (len(payload) != n or b32encode(sha1(payload).digest()).decode() != told):
                    raise ValueError(f"damaged record at {offset} of {place}")
                rows.append((_number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], n, told, kind, _number(fields.get("WARC-Refers-To")), payload))
                if sum(len(r[-1]) for r in rows[-64:]) > 1 << 25 or len(rows) >= 512:
                    yield _framed(rows)
                    rows = []
        yield _framed(rows)


def _framed(rows: list[tuple]) -> pd.DataFrame:
    names = [f.split(" ")[0] for f in RECORD.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})


def look_up(spark: SparkSession, folder: str, keys: DataFrame, key: str = "key") -> DataFrame:
    """The records whose capture key is in ``keys``: columns as in ``RECORD``. Keys that were not captured give none."""
    blocks = spark.read.parquet(f"{folder}/index")
    directory = sorted((r["first"], r["last"]) for r in blocks.select("first", "last").collect())
    wanted = keys.select(F.col(key).alias("key")).where("key is not null").distinct()
    placed = wanted.mapInPandas(_placed([f for f, _ in directory], [x for _, x in directory]), "first string, key string").distinct()
    both = blocks.select("first", F.lit(0).alias("turn"), F.lit(None).cast("string").alias("key"), "data")
    both = both.union(placed.select("first", F.lit(1), "key", F.lit(None).cast("binary")))
    found = both.repartition("first").sortWithinPartitions("first", "turn").drop("turn").mapInPandas(_searched, "key string, file string, offset long, length long")
    return found.repartition("file").sortWithinPartitions("file", "offset").mapInPandas(_read, RECORD)
