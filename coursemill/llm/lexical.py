"""Ranked lexical search over bit-sliced Bloom signatures.

A document's signature holds a key for each of its terms and each step that the term's part of the score, before its weight, reaches there. Signatures of a
block of documents are stored by bit: one bitmap with a bit for every document. A term's bitmaps, combined, show at least all documents
where it reaches a step, so the weighted sums of these bitmaps, in bit slices, are upper bounds of the scores. Documents
whose bound is below a score that ``k`` others are known to reach are excluded; all others are scored exactly. That score comes from the block's ``k`` best bounds, and before
from one block of each size of documents, scored first.

A block holds documents with like numbers of terms, so short ones do not pay for the signatures of long ones. Widths are bounded: a very long document
gets looser bounds, never a wrong score. Terms are told apart by 64-bit hashes.

Defined results: null texts and texts without terms are in no ranking and are not counted; null ids rank like others, after equal scores with ids;
each repeated document is a document; equal items get equal rankings, and items of one id and different texts one each; an item without terms, or with none that
occurs, gives none; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coursemill.llm.common import Scratch, chunks, flat, lists, mix, signed, span_hashes, word_spans
from coursemill.llm.sliced import add, pack, positions, select, size

DOCS = 2048  # documents of one block, fewer where they have many terms
POSTINGS = 1 << 18  # terms of all documents of one block, about
WIDEST = 1 << 17  # bits of a signature
HASHES, ROOM = 3, 4  # bits of a key, and width for each bit set
STEPS = (0.25, 0.5, 0.75, 0.9, 0.97, 1.0)  # shares of a block's term parts up to each step
UNITS = 1 << 13  # a bound is counted in so many parts of the most that an item can score
ITEMS = 512  # items that meet a block together
BROADCAST_TERMS = 1 << 20  # terms of all items, 16 bytes each, that may go to every task

_SOLID = np.zeros(256, bool)
_SOLID[0x80:] = True
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    _SOLID[_a:_b] = True


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's number of terms, its distinct terms in the order of their hashes, and how often each occurs."""
    seen = 0
    for batch in chunks(batches):
        data, offsets = flat(batch.column("text"))
        data = np.where((data >= 0x41) & (data <= 0x5A), data + 32, data).astype(np.uint8)
        begin, end, first = word_spans(data, offsets, _SOLID[data])
        n = np.diff(first)
        h, doc = signed(span_hashes(data, begin, end, 12)), np.repeat(np.arange(batch.num_rows), n)
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        at = np.nonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])][: len(h)])[0]
        each = np.bincount(doc[at], minlength=batch.num_rows)
        columns = [batch.column("id"), pa.array(np.arange(seen, seen + batch.num_rows)), pa.array(n.astype(np.int64)), lists(h[at], each, pa.int64()), lists(np.diff(np.r_[at, len(h)]), each, pa.int32())]
        seen += batch.num_rows
        yield pa.RecordBatch.from_arrays(columns, names=["id", "place", "n", "terms", "tf"])


def terms_of(df: DataFrame, ident: str) -> DataFrame:
    """``id, place, n, terms, tf`` of every row of ``df`` (``ident, text``); ``place`` tells equal rows of a task apart."""
    kind = df.schema[ident].dataType.simpleString()
    return df.select(F.col(ident).alias("id"), "text").mapInArrow(_terms, f"id {kind}, place long, n long, terms array<long>, tf array<int>")


def _bits(terms: np.ndarray, steps: int, width: int) -> np.ndarray:
    """The bits of every term at every step."""
    key = terms.view(np.uint64)[:, None, None] + np.arange(1, steps + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    return (mix(key + np.arange(HASHES, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) % np.uint64(width)).astype(np.int64)


def _shares(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The part of a term's score before its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _built(documents: int, words: int):
    """One block of the index, given the corpus's numbers of documents and terms."""

    def block(key: tuple, rows: pa.Table) -> pa.Table:
        ids, lengths = rows["id"].combine_chunks(), np.array(rows["n"])
        each, terms = np.array(pa.compute.list_value_length(rows["terms"])), np.array(rows["terms"].combine_chunks().flatten())
        tf = np.array(rows["tf"].combine_chunks().flatten(), np.int64)
        m = 50 + 50 * lengths * documents // words
        doc = np.repeat(np.arange(len(lengths)), each)
        share = _shares(tf, m[doc])
        tops = np.unique(np.quantile(share, STEPS, method="higher"))
        step = np.searchsorted(tops, share)
        vocabulary, code = np.unique(terms, return_inverse=True)
        keys = np.bincount(doc, step + 1, len(lengths)).max()
        width = int(min(max(64, ROOM * HASHES * keys), WIDEST))
        at = _bits(vocabulary, len(tops), width)
        held = np.zeros((width, len(lengths)), bool)
        for s in range(len(tops)):
            some = step >= s
            for b in range(HASHES):
                held[at[code[some], s, b], doc[some]] = True
        bytes_of = lambda x, kind: pa.array([x.astype(kind).tobytes()], pa.binary())
        narrow = lambda x: pa.array([x.astype(np.min_scalar_type(int(x.max()))).tobytes()], pa.binary())  # noqa: E731  as many bytes as the largest needs
        columns = {
            "level": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()), "ids": pa.array([ids.to_pylist()], pa.list_(pa.int64())),
            "m": bytes_of(m, np.int64), "each": bytes_of(each, np.int32), "code": narrow(code), "tf": narrow(tf), "terms": bytes_of(vocabulary, np.int64), "df": narrow(np.bincount(code)),
            "tops": bytes_of(tops, np.int64), "signatures": pa.array([pack(held).tobytes()], pa.binary()),
        }
        return pa.table(columns)

    return block


_BLOCK = "level int, part int, ids array<long>, m binary, each binary, code binary, tf binary, terms binary, df binary, tops binary, signatures binary"


def _narrow(batch: pa.RecordBatch, column: str, r: int, count: int) -> np.ndarray:
    """Numbers that were written with as many bytes as the largest of them needs."""
    raw = batch.column(column)[r].as_py()
    return np.frombuffer(raw, f"<u{len(raw) // count}")


class Block:
    """A block of the index as read back."""

    def __init__(self, batch: pa.RecordBatch, r: int) -> None:
        value = lambda c, kind: np.frombuffer(batch.column(c)[r].as_py(), kind)
        ids = batch.column("ids")[r].values
        self.unnamed = np.array(ids.is_null())
        self.ids = np.array(ids.fill_null(0))
        self.each, self.terms, self.tops = value("each", np.int32).astype(np.int64), value("terms", np.int64), value("tops", np.int64)
        postings = int(self.each.sum())
        self.code = _narrow(batch, "code", r, postings)
        self.start = np.cumsum(self.each) - self.each
        self.share = _shares(_narrow(batch, "tf", r, postings).astype(np.int64), np.repeat(value("m", np.int64), self.each))
        self.live = pack(np.ones(len(self.ids), bool))
        self.signatures = value("signatures", np.uint64).reshape(-1, len(self.live))

    def known(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and weights of those terms that occur here."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        here = self.terms[at] == terms
        return at[here], weights[here]

    def bounds(self, codes: np.ndarray, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Upper bounds of all documents' scores in bit slices, and the unit they are counted in."""
        reach = np.bitwise_and.reduce(self.signatures[_bits(self.terms[codes], len(self.tops), len(self.signatures))], axis=2)
        reach = np.bitwise_and.accumulate(reach, axis=1).reshape(-1, reach.shape[-1])  # who reaches a step has reached those below
        worth = (weights[:, None] * np.diff(self.tops, prepend=0)).reshape(-1)
        unit = max(1, int(worth.sum()) // UNITS)
        parts = -(-worth // unit)
        columns = [reach[parts >> b & 1 == 1] for b in range(int(parts.max()).bit_length())]
        return add(columns), unit

    def scores(self, docs: np.ndarray, codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of some documents."""
        each = self.each[docs]
        begin = np.cumsum(each) - each
        at = np.arange(each.sum()) + np.repeat(self.start[docs] - begin, each)
        weight = np.zeros(len(self.terms), np.int64)
        weight[codes] = weights
        return np.add.reduceat(weight[self.code[at]] * self.share[at], begin)

    def best(self, codes: np.ndarray, weights: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The documents that can be among the ``k`` best and reach ``least``, with their scores; and how many were scored."""
        sums, unit = self.bounds(codes, weights)
        open_ = at_least(sums, -(-least // unit), self.live)
        docs = positions(open_)
        if len(docs) > 2 * k:
            sure, edge = select(sums, open_, k)
            first = np.concatenate([sure, edge[: max(0, k - len(sure))]])
            score = self.scores(first, codes, weights)
            least = max(least, int(np.partition(score, len(score) - k)[len(score) - k]))
            docs = positions(at_least(sums, -(-least // unit), open_))
        if not len(docs):
            return docs, docs, 0
        score = self.scores(docs, codes, weights)
        order = np.lexsort([self.ids[docs], self.unnamed[docs], -score])[:k]
        order = order[score[order] >= least]
        return docs[order], score[order], len(docs)


def at_least(sums: list[np.ndarray], least: int, live: np.ndarray) -> np.ndarray:
    """Rows of ``live`` whose sum in bit slices is ``least`` or more."""
    if least.bit_length() > len(sums):
        return np.zeros_like(live)
    over, even = np.zeros_like(live), live
    for p in reversed(range(len(sums))):
        if least >> p & 1:
            even = even & sums[p]
        else:
            over, even = over | (even & sums[p]), even & ~sums[p]
    return over | even


def _meet(k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block, keys = Block(batch, r), batch.column("keys")[r].values.to_pylist()
                out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64))]
                for key, terms, weights, least in zip(keys, batch.column("wanted")[r].values, batch.column("weights")[r].values, batch.column("least")[r].values, strict=True):
                    codes, w = block.known(np.array(terms.values), np.array(weights.values))
                    if len(codes) and w.any():
                        docs, score, scored = block.best(codes, w, max(1, least.as_py()), k)
                        out.append((np.full(len(docs), key), block.ids[docs], block.unnamed[docs], score, np.full(len(docs), scored)))
                key, ids, unnamed, score, scored = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids, mask=unnamed), pa.array(score), pa.array(scored)], names=["key", "doc_id", "score", "scored"])

    return rows


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of each block a term occurs."""
    for batch in batches:
        for r in range(batch.num_rows):
            terms = np.frombuffer(batch.column("terms")[r].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(_narrow(batch, "df", r, len(terms)).astype(np.int64))], names=["t", "df"])


def index_documents(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, int, dict[int, int]]:
    """The blocks of the index, the number of documents and the number of blocks by size of document.

    Texts are read twice, once for their sizes: that takes less room than their terms, written down.
    """
    spark = docs.sparkSession
    terms = terms_of(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "doc_id").filter("n > 0")
    level = F.ceil(F.log2(F.size("terms"))).cast("int")
    sizes = terms.groupBy(level.alias("level")).agg(F.count("*").alias("docs"), F.sum("n").alias("words")).collect()  # a row for each power of two
    if not sizes:
        return spark.createDataFrame([], _BLOCK), 0, {}
    documents, words = sum(r["docs"] for r in sizes), sum(r["words"] for r in sizes)
    parts = {r["level"]: -(-r["docs"] // max(1, min(DOCS, POSTINGS >> r["level"]))) for r in sizes}
    deal = F.get(F.array(*[F.lit(parts.get(i, 1)) for i in range(max(parts) + 1)]), level)
    dealt = terms.select("id", "n", "terms", "tf", level.alias("level"), F.pmod(F.xxhash64("id", "place", "n"), deal).cast("int").alias("part"))
    blocks = scratch.keep(dealt.groupBy("level", "part").applyInArrow(_built(documents, words), _BLOCK), "blocks")
    return blocks, documents, parts


def _met(blocks: DataFrame, items: DataFrame, parts: dict[int, int]) -> DataFrame:
    """Blocks of the index beside groups of items. Few items go to every task; groups of many are sent to each block."""
    count, held = items.agg(F.count("*"), F.sum(F.size("wanted"))).first()
    groups = max(1, -(-count // ITEMS))
    group = items.groupBy(F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int").alias("g")).agg(F.collect_list(F.struct("key", "wanted", "weights", "least")).alias("e"))
    group = group.select("g", *[F.col(f"e.{c}").alias(c) for c in ("key", "wanted", "weights", "least")]).withColumnRenamed("key", "keys")
    if (held or 0) <= BROADCAST_TERMS:
        return blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).join(F.broadcast(group), "g")
    every = F.map_from_arrays(F.array(*[F.lit(i) for i in parts]), F.array(*[F.lit(n) for n in parts.values()]))
    each = group.select("*", F.explode(every).alias("level", "_n")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return blocks.join(each.hint("merge"), ["level", "part"])


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents (``doc_id, text``) for each of ``items`` (``item_id, text``)."""
    scratch = Scratch(docs.sparkSession, "lexical")
    blocks, documents, parts = index_documents(docs, scratch)
    asked = items.select("item_id", "text", F.xxhash64("text").alias("key")).filter("text is not null")
    if not documents:
        return asked.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).limit(0)
    wanted = terms_of(asked.select("key", "text").dropDuplicates(["key"]), "key").select(F.col("id").alias("key"), F.explode("terms").alias("t"))
    seen = blocks.select("terms", "df").mapInArrow(_frequencies, "t long, df long").groupBy("t").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weighed = scratch.keep(wanted.join(seen, "t").select("key", "t", weight.alias("w")), "weights")
    each = F.sort_array(F.collect_list(F.struct("t", "w")))
    known = weighed.groupBy("key").agg(each.alias("e")).select("key", F.col("e.t").alias("wanted"), F.col("e.w").alias("weights"))
    known = scratch.keep(known, "known")
    best = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    of_block = [F.col(c) for c in ("ids", "m", "each", "code", "tf", "terms", "tops", "signatures", "keys", "wanted", "weights", "least")]

    def meet(some: DataFrame, asking: DataFrame, where: dict[int, int]) -> DataFrame:
        met = _met(some, asking, where).select(*of_block)
        found = met.mapInArrow(_meet(k), "key long, doc_id long, score long, scored long")
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    first = meet(blocks.filter("part = 0"), known.withColumn("least", F.lit(0).cast("bigint")), dict.fromkeys(parts, 1))
    reached = first.filter(F.col("rank") == k).select("key", F.col("score").alias("least"))
    known = scratch.keep(known.join(reached, "key", "left").withColumn("least", F.coalesce("least", F.lit(0).cast("bigint"))), "items")
    found = scratch.keep(meet(blocks, known, parts), "found")
    return asked.join(found, "key").select("item_id", "rank", "doc_id", "score")
