"""WARC archives: writing captures, reading records, assembling transactions.

Every capture is a request, a response (or a revisit of an equal payload) and a metadata
record that name each other by WARC-Concurrent-To. Archives are files of one gzip member
per record, each file named anew by the task that writes it; a staged manifest lists those
of the attempts that counted.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pulseloom.llm import common

REVISIT_FROM = 1000  # bytes of the smallest payload that is stored once
FILE_BYTES = 32 << 20
_DATE = "2024-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(kind: str, name: str, uri: str, block: bytes, **more) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", _DATE),
            ("WARC-Target-URI", uri), *((k.replace("_", "-"), v) for k, v in more.items() if v),
            ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return gzip.compress(text.encode() + block + b"\r\n\r\n", 6, mtime=0)


def _clean(url) -> str:
    """Header values are one line."""
    return " ".join(str(url).split()) if url is not None else ""


def capture(page_id, url, payload: bytes, length: int, digest: str, refers_to, name: str) -> bytes:
    """The three records of one page; a revisit carries headers only."""
    uri, target = _clean(url) or "urn:none", f"<urn:uuid:{name}>"
    http = {"Content_Type": "application/http;msgtype=response", "WARC_Payload_Digest": digest}
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    if refers_to is None:
        main = _record("response", name, uri, head + payload, **http)
    else:
        main = _record("revisit", name, uri, head, WARC_Profile=_REVISIT, WARC_Refers_To=refers_to, **http)
    ask = f"GET {uri} HTTP/1.1\r\n\r\n".encode()
    fields = f"page-id: {'' if page_id is None else int(page_id)}\r\n".encode()
    return main + _record("request", str(uuid.uuid4()), uri, ask, WARC_Concurrent_To=target,
                          Content_Type="application/http;msgtype=request") + _record(
        "metadata", str(uuid.uuid4()), uri, fields, WARC_Concurrent_To=target, Content_Type="application/warc-fields")


def name_of(page_id, digest: str) -> str:
    """Record id of the response for a payload, known to all that revisit it."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}/{digest}"))


def write(pages: DataFrame, folder: str, least: int = REVISIT_FROM) -> DataFrame:
    """Write the archives; returns the manifest (path, records), staged.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest id
    is the response; rows that repeat id and payload are captured once each, all alike, and
    one of them, chosen before any is written, has the name the revisits know. A null html is the empty payload; a null id counts as smallest; a null url is ``urn:none``.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), F.octet_length(html).alias("length"), F.sha1(html.cast("binary")).alias("sha"))
    # one small row per payload that occurs twice; partial counts keep a hot payload apart
    first = common.staged(rows.filter(F.col("length") >= least).groupBy("sha", "page_id").agg(
        F.count("*").alias("rows")).groupBy("sha").agg(
        F.max("page_id").alias("first"), F.max_by("rows", "page_id").alias("alike"),
        F.sum("rows").alias("n")).filter("n > 1").drop("n"), f"{folder}/first")
    large = rows.filter(F.col("length") >= least).join(first, "sha", "left")
    repeat = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    large = large.withColumn("revisit", repeat).withColumn("html", F.when(~repeat, F.col("html")))
    large = large.withColumn("referable", F.col("first").isNotNull() & ~repeat)
    if not first.filter("alike > 1").isEmpty():
        # rows alike may lie in different tasks: numbered and staged, the least number takes the name
        alike = F.col("referable") & (F.col("alike") > 1)
        numbered = common.staged(large.filter(alike).withColumn("number", F.monotonically_increasing_id()),
                                 f"{folder}/alike")
        named = numbered.groupBy("sha").agg(F.min("number").alias("named"))
        numbered = numbered.join(named, "sha").withColumn("referable", F.col("number") == F.col("named"))
        large = large.filter(~alike).unionByName(numbered.select(large.columns))
    small = rows.filter(F.col("length") < least).withColumns(
        {"first": F.lit(None).cast("long"), "revisit": F.lit(False), "referable": F.lit(False)})

    def put(frames):
        out, size, records = io.BytesIO(), 0, 0
        for frame in frames:
            for page, url, html, length, sha, first, revisit, referable in zip(
                    frame["page_id"].to_numpy(dtype=object), frame["url"], frame["html"], frame["length"],
                    frame["sha"], frame["first"].to_numpy(dtype=object), frame["revisit"], frame["referable"]):
                page, first = (None if pd.isna(x) else int(x) for x in (page, first))
                payload = b"" if html is None else html.encode("utf-8", "surrogatepass")
                digest = "sha1:" + base64.b32encode(bytes.fromhex(sha)).decode()
                name = name_of(page, sha) if referable else str(uuid.uuid4())
                target = f"<urn:uuid:{name_of(first, sha)}>" if revisit else None
                size += out.write(capture(page, url, payload, int(length), digest, target, name))
                records += 3
                if size >= FILE_BYTES:
                    yield _file(folder, out, records)
                    out, size, records = io.BytesIO(), 0, 0
        if records:
            yield _file(folder, out, records)

    columns = ["page_id", "url", "html", "length", "sha", "first", "revisit", "referable"]
    files = large.select(columns).unionByName(small.select(columns)).mapInPandas(put, "path string, records long")
    return common.staged(files, f"{folder}/manifest")


def _file(folder: str, out: io.BytesIO, records: int) -> pd.DataFrame:
    path = f"{folder}/archives/{uuid.uuid4().hex}.warc.gz"
    common.write_file(path, out.getvalue())
    return pd.DataFrame({"path": [path], "records": [records]})


_FIELDS = {"WARC-Type": "record_type", "WARC-Record-ID": "record_id", "WARC-Target-URI": "uri",
           "WARC-Concurrent-To": "concurrent_to", "WARC-Refers-To": "refers_to", "WARC-Payload-Digest": "digest"}
RECORDS = ("record_type string, record_id string, uri string, concurrent_to string, refers_to string, "
           "digest string, digest_sha1 string, http_length long, page_id long, payload binary, payload_bytes long, payload_sha1 string")


def parse(source):
    """Records of one archive as dictionaries of the columns of ``RECORDS``."""
    while True:
        line = source.readline()
        if not line:
            return
        if not line.strip():
            continue
        head = {}
        while (line := source.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip()] = value.strip()
        block = source.read(int(head.get("Content-Length", 0)))
        row = {into: head.get(name) for name, into in _FIELDS.items()}
        if row["record_type"] in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            lengths = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            row |= {"digest_sha1": base64.b32decode(row["digest"][5:]).hex() if row["digest"] else None, "http_length": int(lengths[0]) if lengths else None, "payload": payload,
                    "payload_bytes": len(payload), "payload_sha1": hashlib.sha1(payload).hexdigest()}
        elif row["record_type"] == "metadata":
            for field in block.decode("utf-8", "replace").split("\r\n"):
                name, _, value = field.partition(":")
                if name == "page-id" and value.strip():
                    row["page_id"] = int(value)
        yield row


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the archives; ``payloads=False`` leaves only their digests."""
    names = [x.split()[0] for x in RECORDS.split(", ")]
    whole = {"http_length", "page_id", "payload_bytes"}

    def load(frames):
        def frame_of(rows):
            frame = pd.DataFrame(rows, columns=names, dtype=object)
            for name in whole:
                frame[name] = frame[name].astype("Int64")
            if not payloads:
                frame["payload"] = None
            return frame

        for frame in frames:
            for path in frame["path"]:
                rows, size = [], 0
                with common.open_file(path) as raw, gzip.GzipFile(fileobj=raw) as source:
                    for row in parse(source):
                        rows.append(row)
                        size += 500 + len(row.get("payload") or b"")
                        if size > 8 << 20:
                            yield frame_of(rows)
                            rows, size = [], 0
                if rows:
                    yield frame_of(rows)

    spread = common.partitions(manifest.sparkSession)
    return manifest.select("path").repartition(spread).mapInPandas(load, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture, joined through the concurrent-to identifiers.

    A capture is a response or revisit; requests and metadata join the record they name.
    Where several name the same one, the smallest record id is kept beside their number. Records that name
    nothing known, such as a response without a request, leave the other parts null.
    """
    main = records.filter(F.col("record_type").isin("response", "revisit")).select(
        F.col("record_id").alias("_id"), F.struct(
            "record_type", "record_id", "uri", "refers_to", "digest", "digest_sha1", "http_length", "payload", "payload_bytes",
            "payload_sha1").alias("response"))

    def named(kind, *columns):
        # a partial minimum, so a record that many others name gathers nowhere
        return records.filter((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull()).groupBy(
            F.col("concurrent_to").alias("_id")).agg(
            F.min(F.struct(*columns)).alias(kind), F.count("*").alias(f"{kind}_records"))

    whole = main.join(named("request", "record_id", "uri"), "_id", "left").join(
        named("metadata", "record_id", "page_id"), "_id", "left")
    return whole.select("response", "request", "request_records", "metadata", "metadata_records")


def report(pages: DataFrame) -> DataFrame:
    """Write archives of the pages, read them back and tell what each capture holds.

    A null html is an empty payload; ids may be null or repeat, and rows alike share one
    record that others refer to. Other columns are ignored; an empty table gives no rows.
    """
    folder = common.run_dir(pages.sparkSession, "warc")
    # the archives are read once; requests, responses and metadata are then columns of a table
    records = common.staged(read(write(pages, folder), payloads=False).drop("payload"), f"{folder}/records")
    captures = common.staged(assemble(records.withColumn("payload", F.lit(None).cast("binary"))), f"{folder}/captures")
    r = F.col("response")
    known = captures.filter(r["record_type"] == "response").select(
        r["record_id"].alias("_to"), F.col("metadata.page_id").alias("_page"))
    revisit = r["record_type"] == "revisit"
    rows = captures.select(
        F.col("metadata.page_id").alias("page_id"),
        F.when(revisit, r["http_length"]).otherwise(r["payload_bytes"]).alias("payload_bytes"),
        F.when(revisit, r["digest_sha1"]).otherwise(r["payload_sha1"]).alias("payload_digest"),
        r["record_type"].alias("record_type"), r["refers_to"].alias("_to"))
    told = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    # only records that refer to one take part in the join, so a hot null key moves nowhere
    plain = rows.filter(F.col("_to").isNull()).select(*told, F.lit(None).cast("long").alias("refers_to"))
    return plain.unionByName(rows.filter(F.col("_to").isNotNull()).join(known, "_to", "left").select(
        *told, F.col("_page").alias("refers_to")))
