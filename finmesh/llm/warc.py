"""Deterministic sharded WARC writer and reader (operator 5).

Writer: rows are range-sorted by id, so that each task writes one run of records; it rolls
to a new ``.warc.gz`` file when the compressed size passes ``roll_bytes`` (one gzip member
per record).  Headers and digests are made anew from the row, nothing depends on time or
place: the same rows in the same ranges give the same bytes.  A file is written under a name of its
task attempt and moved to its final name when complete; the rows a task returns (file,
records, bytes, SHA-256) make up the manifest, and only files of the manifest are read.
A task that runs again writes the same file again, so a lost executor does no harm.

Equal payloads of ``min_revisit`` bytes or more: the greatest id is the response, others
are revisits that refer to it.  Which rows are revisits is known from (digest, id) pairs;
those markers are sorted into the same ranges as the records, so the payloads are
shuffled once.

Reader: the manifest's files as binary rows, one record per gzip member.

Null payloads are empty, a null URL has no target header.  Characters of a URL that a header cannot hold are
percent-encoded; then one more header keeps the URL itself (its % encoded too), so every URL comes back as it was.
Null ids sort first.  Of rows that repeat an id and a payload, one is the response.
"""
from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmesh.llm.common import stored
from finmesh.session import scratch_path

WARC_DATE = "1970-01-01T00:00:00Z"      # archives are regenerated, not captured
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, records long, bytes long, sha256 string"
RECORD = "id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def header_block(first: str, fields: list[tuple[str, str]]) -> bytes:
    return "".join([first, "\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode()


def record_id(row_id: int | None, digest: str, copy: int) -> str:
    import uuid
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record/{row_id}/{digest}/{copy}')}>"


def warc_record(row_id: int | None, url: str | None, payload: bytes, refers_to: int | None, copy: int, revisit: bool) -> bytes:
    """One record, not compressed.  The block is an HTTP response, a revisit's without its payload."""
    import hashlib
    from urllib.parse import quote
    digest = hashlib.sha1(payload).hexdigest()
    block = header_block("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))])
    if not revisit:
        block += payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(row_id, digest, copy)),
              ("WARC-Date", WARC_DATE)]
    if url is not None:
        target = quote(url, safe="".join(map(chr, range(33, 127))))
        fields.append(("WARC-Target-URI", target))
        if target != url:
            fields.append(("X-Row-URL", quote(url, safe="")))
    if row_id is not None:
        fields.append(("X-Row-ID", str(row_id)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("X-Refers-To-Row-ID", str(refers_to)), ("WARC-Refers-To", record_id(refers_to, digest, 0))]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return header_block("WARC/1.1", fields) + block + b"\r\n\r\n"


def parse_record(data: bytes):
    """(id, payload_bytes, payload_digest, type, refers_to, url, payload); digests are verified."""
    import hashlib
    from urllib.parse import unquote
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    if fields["WARC-Type"] == "warcinfo":
        return None
    block = rest[:int(fields["Content-Length"])]
    if f"sha1:{hashlib.sha1(block).hexdigest()}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest differs in {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2])
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload digest differs in {fields['WARC-Record-ID']}")
    own, other, url = fields.get("X-Row-ID"), fields.get("X-Refers-To-Row-ID"), fields.get("WARC-Target-URI")
    if "X-Row-URL" in fields:
        url = unquote(fields["X-Row-URL"])
    return (None if own is None else int(own), length, digest, fields["WARC-Type"],
            None if other in (None, "None") else int(other), url, None if revisit else payload)


def write(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_revisit: int = 1000, roll_bytes: int = 16 << 20) -> DataFrame:
    """Write ``df`` as archives below ``folder``; returns the manifest, which is also stored there."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    digests = stored(rows.where(F.octet_length("payload") >= min_revisit).select("id", F.unhex(F.sha1("payload")).alias("digest")), "warc-digests")
    groups = digests.groupBy("digest").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1")
    marks = digests.join(groups, "digest").select("id", "digest", "keep").distinct()
    both = marks.select("id", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "keep").unionByName(
        rows.select("id", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("keep")))
    # ties of an id are ordered by content, so that the archives do not depend on the order of arrival
    ordered = both.repartitionByRange("id").sortWithinPartitions("id", "kind", F.xxhash64("payload", "url"))
    manifest = ordered.mapInArrow(_writer(folder, roll_bytes), MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return df.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _writer(folder: str, roll_bytes: int):
    def run(batches: Iterator) -> Iterator:
        import gzip
        import hashlib
        import re

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        context = TaskContext.get()
        store, root = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))
        member = lambda data: gzip.compress(data, 6, mtime=0)
        attempt, part, done = f"{root}/.attempt-{context.taskAttemptId()}", context.partitionId(), []
        store.create_dir(root, recursive=True)
        out, size, records, sha = None, 0, 0, None

        def close():
            nonlocal out
            if out is not None:
                out.close()
                name = f"part-{part:06d}-{len(done):04d}.warc.gz"
                store.move(attempt, f"{root}/{name}")       # complete files only get their name
                done.append((f"{folder}/{name}", records, size, sha.hexdigest()))
                out = None

        def put(data):
            nonlocal out, size, records, sha
            if out is None:
                out, size, records, sha = store.open_output_stream(attempt), 0, 0, hashlib.sha256()
                put(member(header_block("WARC/1.1", [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(part, "info", len(done))), ("WARC-Date", WARC_DATE),
                                                     ("Content-Type", "application/warc-fields"), ("Content-Length", "0")]) + b"\r\n\r\n"))
                records = 0
            out.write(data)
            sha.update(data)
            size, records = size + len(data), records + 1

        marks, copies, now = {}, {}, object()
        for batch in batches:
            for row_id, kind, url, payload, digest, keep in zip(*(c.to_pylist() for c in batch.columns)):
                if row_id != now:
                    marks, copies, now = {}, {}, row_id
                if kind == 0:
                    marks[digest] = keep
                    continue
                own = hashlib.sha1(payload).digest()
                copy = copies[own] = copies.get(own, -1) + 1
                revisit = own in marks and (marks[own] != row_id or copy > 0)
                put(member(warc_record(row_id, url, payload, marks.get(own), copy, revisit)))
                if size >= roll_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                         names=["file", "records", "bytes", "sha256"])
    return run


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the archives that the manifest of ``folder`` lists."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    listed = files.withColumn("name", name).join(
        manifest.select(F.element_at(F.split("file", "/"), -1).alias("name"), "sha256"), "name")
    return listed.select("name", "content", "sha256").mapInArrow(_reader, RECORD)


def _reader(batches: Iterator) -> Iterator:
    import hashlib
    import zlib

    import pyarrow as pa

    schema = pa.schema([("id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])
    for batch in batches:
        for name, content, sha in zip(batch.column(0), batch.column(1), batch.column(2)):
            data = memoryview(content.as_buffer())
            if hashlib.sha256(data).hexdigest() != sha.as_py():
                raise ValueError(f"{name} differs from its manifest")
            rows, held, at = [], 0, 0
            while at < len(data):
                member, record = zlib.decompressobj(wbits=31), bytearray()
                while not member.eof and at < len(data):
                    piece = data[at:at + 65536]
                    record += member.decompress(piece)
                    at += len(piece) - len(member.unused_data)
                if (row := parse_record(bytes(record))) is not None:
                    rows.append(row)
                    held += len(record)
                if held > 8 << 20 or at >= len(data) and rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
                    rows, held = [], 0
