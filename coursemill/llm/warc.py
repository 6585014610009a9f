"""WARC archives of pages, and a reader that finds record boundaries in parallel.

Writing: one record for each row, in text files of whole records whose separator is the record end of the format. Rows with equal
payloads of at least ``least_bytes`` bytes are told by digest; the one with the smallest id is a ``response``, the others are
``revisit`` records without a body that refer to it. Equal smallest ids are each a response. A null payload is empty; a
null id is no candidate for the smallest, so such a row revisits a row with an id if there is one.

Reading: a file is cut at every occurrence of the version line, in splits that need not begin at a record. Each piece that
starts with a well-formed header is a candidate, and its successor is where its declared length ends. Each task follows
successors inside its own split and emits where the chain leaves it. Pointer jumping over the splits, from the file's start, doubles
the distance covered each round and keeps what is reachable; inside splits that were entered, the chain from the entry marks
the records. What looks like a record inside a payload is never reached. Payloads that hold the version line are put together from their pieces.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coursemill.llm.common import Scratch, shuffle_files_removed

# fixed values of the format
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 20_000
_LENGTH = re.compile(rb"^Content-Length: *([0-9]{1,18})\r?$", re.M)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(kind: str, page, url: str | None, digest: str, refers, length: int, date: str) -> str:
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {length}"]
    return MAGIC + "\r\n".join(lines) + END


def _records(date: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                out = []
                for page, url, html, least in zip(*(c.to_pylist() for c in batch.slice(begin, 256).columns), strict=True):
                    raw = html.encode()
                    body = html if least is None else ""
                    kind = "response" if least is None else "revisit"
                    out.append(_header(kind, page, url, _digest(raw), least, len(raw) if least is None else 0, date) + body)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    return rows


def write_archives(pages: DataFrame, path: str, scratch: Scratch, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", records_per_file: int = RECORDS_PER_FILE) -> None:
    """Archives of ``page_id, url, html`` as files of at most ``records_per_file`` records below ``path``."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", html.alias("html"), F.unhex(F.sha1(html)).alias("sha"))
    equal = rows.filter(F.octet_length("html") >= least_bytes).groupBy("sha").agg(F.min("page_id").alias("least"), F.count("*").alias("n"))
    # a written table has a known size: it is broadcast when small and shuffled otherwise
    equal = scratch.keep(equal.filter("n > 1 and least is not null").select("sha", "least"), "equal")
    rows = rows.join(equal, "sha", "left").select("page_id", "url", "html", F.expr("if(page_id <=> least, null, least)").alias("least"))
    with shuffle_files_removed(pages.sparkSession):
        rows.mapInArrow(_records(date), "value string").write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces between version lines with their file and the begin of their split, in order within each split."""
    pieces = spark.read.option("lineSep", MAGIC).text(path)
    return pieces.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    last, k = None, 0
    for batch in batches:
        for file, block, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            k = 0 if (file, block) != last else k + 1
            last = file, block
            yield file, block, k, value


_MARGIN = len(MAGIC)


def _parse(value: bytes) -> tuple[int, int] | None:
    """Length of the header and of the payload it declares."""
    at = value.find(b"\r\n\r\n")
    found = _LENGTH.search(value[:at]) if at >= 0 and value.startswith(b"WARC-Type: ") else None
    return (at + 4, int(found[1])) if found else None


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each piece; offsets are counted from the first piece of its split."""
    rows: list[list] = []
    own: tuple | None = None

    def leave() -> pa.RecordBatch:
        # chains lead forward, so the last candidates know first where they leave
        place = {r[3]: i for i, r in enumerate(rows)}
        for r in reversed(rows):
            if r[5] is not None:
                r[6] = rows[place[r[5]]][6] if r[5] in place and rows[place[r[5]]][6] is not None else r[5]
        names = ["file", "block", "k", "at", "size", "succ", "leave", "kind", "page", "refers", "bytes", "digest"]
        kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    at = 0
    for file, block, k, value in _splits(batches):
        if (file, block) != own:
            if rows:
                yield leave()
            rows, own = [], (file, block)
            at = 0 if block else -_MARGIN  # a file's first piece has no version line before it
        row = [file, block, k, at, len(value) + _MARGIN, None, None, None, None, None, None, None]
        if (found := _parse(value)) and not (block == 0 and k == 0):
            head, length = found
            row[5] = at + _MARGIN + head + length + 4
            row[7:10] = _facts(value[:head])
            if head + length + 4 == len(value):
                row[10], row[11] = length, _digest(value[head : head + length])
        rows.append(row)
        at += row[4]
    if rows:
        yield leave()


def _facts(head: bytes) -> list:
    said = dict(x.split(": ", 1) for x in head.decode().split("\r\n") if ": " in x)
    number = lambda k: int(m[1]) if (m := re.search(r"urn:page:(-?\d+)", said.get(k, ""))) else None
    return [said["WARC-Type"], number("WARC-Record-ID"), number("WARC-Refers-To")]


CANDIDATES = "file string, block long, k long, at long, size long, succ long, leave long, kind string, page long, refers long, bytes long, digest string"


def _chain(group: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one split that the chain from its entry passes."""
    place = {a: i for i, a in enumerate(group["at"])}
    succ, passed, here = group["succ"].to_numpy(), [], place.get(group["entry"].iloc[0])
    while here is not None:
        passed.append(here)
        here = place.get(succ[here])
    return group.iloc[passed][["file", "block", "k"]]


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file, block, k, value in _splits(batches):
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (file, block, k, value)], names=["file", "block", "k", "value"])


def _joined(group: pd.DataFrame) -> pd.DataFrame:
    """The payload of one record from its pieces."""
    group = group.sort_values("at")
    raw = MAGIC.encode().join(group["value"])
    head, length = _parse(raw)
    return pd.DataFrame({"file": group["file"].iloc[:1], "owner": group["owner"].iloc[:1], "bytes": [length], "digest": [_digest(raw[head : head + length])]})


def read_archives(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """``file, at, kind, page, refers, bytes, digest`` of every record; bytes and digest are those of its own payload."""
    pieces = scratch.keep(_pieces(spark, path).mapInArrow(_candidates, CANDIDATES), "pieces")
    splits = pieces.groupBy("file", "block").agg(F.sum("size").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # the first split of a file counts from the file's start, whose first piece is the empty one before the first record
    base = splits.select("file", "block", (before - F.when(F.col("block") > 0, _MARGIN).otherwise(0)).alias("base"))
    base = scratch.keep(base, "bases")
    placed = pieces.join(base, ["file", "block"])
    placed = placed.withColumns({c: F.col(c) + F.col("base") for c in ("at", "succ", "leave")}).drop("base")
    placed = scratch.keep(placed, "placed")
    jump = placed.filter("succ is not null").select("file", "at", F.col("leave").alias("to"))
    reached = scratch.keep(jump.filter("at = 0").select("file", "at"), "reached-0")
    known, n = 0, 0
    while (now := reached.count()) > known:
        known, n = now, n + 1
        jump = scratch.keep(jump, f"jump-{n}")
        step = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        step = step.join(placed.filter("succ is not null").select("file", "at"), ["file", "at"])
        reached = scratch.keep(reached.unionByName(step).distinct(), f"reached-{n}")
        on = jump.select("file", F.col("at").alias("to"), F.col("to").alias("further"))
        jump = jump.join(on, ["file", "to"]).select("file", "at", F.col("further").alias("to"))
    entry = placed.join(reached, ["file", "at"]).select("file", "block", F.col("at").alias("entry"))
    chains = placed.select("file", "block", "k", "at", "succ").join(entry, ["file", "block"])
    on_chain = chains.groupBy("file", "block").applyInPandas(_chain, "file string, block long, k long")
    marked = placed.join(on_chain.withColumn("passed", F.lit(True)), ["file", "block", "k"], "left")
    within = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = marked.withColumn("owner", F.last(F.when(F.col("passed"), F.col("at")), ignorenulls=True).over(within))
    owned = scratch.keep(owned, "owned")
    broken = owned.filter("passed and digest is null").select("file", "owner")
    keys = scratch.keep(owned.join(broken, ["file", "owner"]).select("file", "block", "k", "at", "owner"), "broken")
    texts = _pieces(spark, path).mapInArrow(_keyed, "file string, block long, k long, value binary").join(keys, ["file", "block", "k"])
    whole = texts.groupBy("file", "owner").applyInPandas(_joined, "file string, owner long, bytes long, digest string")
    alone = owned.filter("passed and digest is not null").select("file", "at", "kind", "page", "refers", "bytes", "digest")
    rest = owned.filter("passed and digest is null").drop("bytes", "digest", "owner").join(whole.withColumnRenamed("owner", "at"), ["file", "at"])
    return alone.unionByName(rest.select(*alone.columns))


def archive_pages(pages: DataFrame, least_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """Writes the archives, reads them back and resolves revisits: one row for each page."""
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession, "warc")
    path = f"{scratch.base}/archives"
    write_archives(pages, path, scratch, least_bytes, records_per_file=records_per_file)
    records = scratch.keep(read_archives(spark, path, scratch), "records")
    full = records.filter("kind = 'response'").select(F.col("page").alias("refers"), F.col("bytes").alias("full"), F.col("digest").alias("sum"))
    full = scratch.keep(full.dropDuplicates(["refers"]), "responses")  # written, so that the join can split a hot response
    out = records.join(full, "refers", "left")
    return out.select(
        F.col("page").alias("page_id"),
        F.when(F.col("kind") == "revisit", F.col("full")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(F.col("kind") == "revisit", F.col("sum")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers").alias("refers_to"),
    )
