"""Masked pseudo-likelihood: a small network guesses every word from the words on both sides of it.

Words are counted over the whole corpus; the ``OWN`` most frequent have ids of their own, all others share ``RARE`` hashed ids in the network. A
rare word's probability is that of its id times the word's share of all words with this id; the counts of all words stay a Spark table, joined on
the word, but for those of the next most frequent words, which tasks hold. Texts are written once as ids of two bytes a word, which training and scoring read. The ``2 * SIDE`` words around a place are embedded and
feed one hidden layer; the softmax goes over a word's class first, then over the words of that class, so a place costs two short sums. Each round,
every task trains a copy of the network, in numpy, on masked places of its own documents, and Spark averages the copies by the number of places. A
hash deals the places to the rounds, so that each is a target once. Then each document's score is the sum of the log-probabilities of all its words,
none left out, given their neighbours.

Defined results: a null or word-less text has no words, score 0 and a null mean; a one-word text is scored from its borders; repeated
rows get equal scores; equal counts take ids by hash; an empty table gives none. Averages are summed in any order, so scores may differ in the last digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import Scratch, chunks, flat, lists, mix, signed, span_hashes, word_spans

CLASSES, EACH = 64, 64
RARE = 512
OWN = CLASSES * EACH - RARE
SIDE = 2
EMBEDDED, HIDDEN = 16, 32
ROUNDS = 2
BATCH, STEP = 4096, 0.01
_HELD = 2_000_000
_BITS = 18
KNOWN = 1 << 16  # at most so many of the most frequent words have their counts brought to the tasks; all others are joined
_BLOCK = 256
_RUN = 1 << 18  # ids worked on at once, beyond the last whole document
_ONES = np.ones(EACH, np.float32)  # of a class or of the classes: there are as many
_SHAPES = {
    "embed": (CLASSES * EACH + 1, EMBEDDED), "w": (2 * SIDE * EMBEDDED, HIDDEN), "b": (HIDDEN,),
    "kinds": (HIDDEN + 1, CLASSES), "members": (CLASSES, HIDDEN + 1, EACH),  # the last row of each matrix has its biases
}
_PLAIN = 60.0  # logits within this bound go into exp as they are: no sum of 64 such values leaves single precision


class Network:
    def __init__(self, flat_parameters: np.ndarray) -> None:
        self.flat = np.ascontiguousarray(flat_parameters, np.float32)
        at = 0
        for name, shape in _SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + size].reshape(shape))
            at += size
        self.wc, self.bc, self.ww, self.bw = self.kinds[:HIDDEN], self.kinds[HIDDEN], self.members[:, :HIDDEN], self.members[:, HIDDEN]

    @classmethod
    def first(cls, counts: np.ndarray) -> Network:
        """Small random weights; the output starts at the words' own frequencies."""
        random = np.random.default_rng(11)
        sizes = {k: _SHAPES[k] for k in ("embed", "w", "b")} | {"wc": (HIDDEN, CLASSES), "bc": (CLASSES,), "ww": (CLASSES, HIDDEN, EACH)}
        parts = {k: random.normal(0, 0.1, size) for k, size in sizes.items()}
        share = (counts + 1.0).reshape(CLASSES, EACH)
        out = cls(np.zeros(sum(int(np.prod(size)) for size in _SHAPES.values())))
        out.embed[:], out.w[:], out.wc[:], out.ww[:] = parts["embed"], parts["w"], parts["wc"], parts["ww"]
        out.bc[:] = np.log(share.sum(1) / share.sum())
        out.bw[:] = np.log(share / share.sum(1, keepdims=True))
        return out

    def __reduce__(self):
        return Network, (self.flat,)

    def _hidden(self, context: np.ndarray, room: Room) -> tuple[np.ndarray, np.ndarray]:
        """The embedded neighbours and the hidden layer, whose last column is 1, for the biases of what it feeds."""
        x = room("x", context.size, EMBEDDED)
        x = self.embed.take(context.reshape(-1), 0, out=x, mode="clip").reshape(len(context), -1)
        sums = np.matmul(x, self.w, out=room("sums", len(x), HIDDEN))
        sums += self.b
        h = room("h", len(x), HIDDEN + 1)
        np.tanh(sums, out=h[:, :HIDDEN])
        h[:, HIDDEN] = 1
        return x, h

    def _logits(self, h: np.ndarray, room: Room) -> tuple[np.ndarray, bool]:
        """Logits of the classes, and whether all of them are within ``_PLAIN``, as far as the weights tell."""
        return np.matmul(h, self.kinds, out=room("kinds", len(h), CLASSES)), _within(self.kinds)

    def _own_logits(self, h: np.ndarray, cuts: np.ndarray, room: Room) -> tuple[np.ndarray, bool]:
        """The same of each row's word within its class; the rows come by class, class ``c`` from ``cuts[c]`` on."""
        out = room("members", len(h), EACH)
        for c in np.nonzero(np.diff(cuts))[0]:
            rows = slice(cuts[c], cuts[c + 1])
            np.matmul(h[rows], self.members[c], out=out[rows])
        return out, _within(self.members)

    def log_probabilities(self, context: np.ndarray, target: np.ndarray, room: Room | None = None) -> np.ndarray:
        room = room or Room()
        order, kind, member, cuts = _by_class(target)
        h = self._hidden(context[order], room)[1]
        out = np.empty(len(target))
        out[order] = _log_share(*self._logits(h, room), kind) + _log_share(*self._own_logits(h, cuts, room), member)
        return out

    def gradient(self, context: np.ndarray, target: np.ndarray, room: Room | None = None) -> np.ndarray:
        """Of the mean negative log-probability, in an array of ``room``. Rows are put in order of their classes, so a class is a slice."""
        n, room = len(target), room or Room()
        out = Network(room("gradient", len(self.flat)))
        order, kind, member, cuts = _by_class(target)
        context, every, ones = context[order], np.arange(n), np.ones(n, np.float32)
        x, h = self._hidden(context, room)
        d = _softmax(*self._logits(h, room), 1 / n)
        d[every, kind] -= np.float32(1 / n)
        own = _softmax(*self._own_logits(h, cuts, room), 1 / n)
        own[every, member] -= np.float32(1 / n)
        back, turned = room("back", n, HIDDEN), np.ascontiguousarray(self.ww.transpose(0, 2, 1))
        cuts = cuts.tolist()
        for c, (begin, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if begin == end:
                out.members[c] = 0
                continue
            part = own[begin:end]
            np.matmul(h[begin:end].T, part, out=out.members[c])
            np.matmul(part, turned[c], out=back[begin:end])
        out.kinds[:] = _across(h, d)
        dh = np.matmul(d, np.ascontiguousarray(self.wc.T), out=room("dh", n, HIDDEN))
        dh += back
        slope = np.square(h[:, :HIDDEN], out=back)
        np.subtract(1, slope, out=slope)
        dh *= slope
        out.w[:] = _across(x, dh)
        np.matmul(ones, dh, out=out.b)
        dx = np.matmul(self.w, dh.T, out=room("dx", 2 * SIDE * EMBEDDED, n))
        ids = context.T.reshape(-1).astype(np.intp)
        for k in range(EMBEDDED):
            out.embed[:, k] = np.bincount(ids, dx[k::EMBEDDED].reshape(-1), len(self.embed))
        return out.flat


class Room:
    """Arrays that are used again from batch to batch, as getting fresh memory costs as much as the sums done in it."""

    def __init__(self) -> None:
        self.arrays: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        size = int(np.prod(shape))
        if name not in self.arrays or len(self.arrays[name]) < size:
            self.arrays[name] = np.empty(size, np.float32)
        return self.arrays[name][:size].reshape(shape)


class Descent:
    """Steps against the gradient by its running mean over the root of its running square (Adam), in place."""

    def __init__(self, net: Network) -> None:
        self.net, self.steps, self.room = net, 0, Room()
        self.one, self.two = np.zeros_like(net.flat), np.zeros_like(net.flat)

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        g = self.net.gradient(context, target, self.room)
        by = self.room("by", len(g))
        self.steps += 1
        # the running values are kept without their constant factors 0.1 and 0.001, which come in at the end
        self.one *= 0.9
        self.one += g
        g *= g
        self.two *= 0.999
        self.two += g
        square = np.sqrt(0.001 / (1 - 0.999**self.steps))
        np.sqrt(self.two, out=by)
        by += np.float32(1e-8 / square)
        np.divide(self.one, by, out=by)
        by *= np.float32(STEP * 0.1 / (1 - 0.9**self.steps) / square)
        self.net.flat -= by


def _by_class(target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows by class, their classes and their numbers within them in that order, and where each class begins."""
    order = np.argsort((target // EACH).astype(np.int16), kind="stable")
    kind, member = np.divmod(target[order].astype(np.int64), EACH)
    return order, kind, member, np.searchsorted(kind, np.arange(CLASSES + 1))


def _across(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` by blocks of rows, which is faster than one product over so many rows of so few columns."""
    n = len(a) // _BLOCK * _BLOCK
    parts = [x[:n].reshape(-1, _BLOCK, x.shape[1]) for x in (a, b)]
    return np.matmul(parts[0].transpose(0, 2, 1), parts[1]).sum(0) + a[n:].T @ b[n:]


def _within(weights: np.ndarray) -> bool:
    """No sum of these weights, each times a number of -1 to 1, is beyond ``_PLAIN``."""
    return bool(np.abs(weights).sum(-2).max() <= _PLAIN)


def _softmax(logits: np.ndarray, plain: bool, whole: float = 1.0) -> np.ndarray:
    """In place; each row comes to ``whole``. Without ``plain``, a row's largest value is taken off first."""
    if not plain:
        logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    logits *= (np.float32(whole) / (logits @ _ONES))[:, None]
    return logits


def _log_share(logits: np.ndarray, plain: bool, pick: np.ndarray) -> np.ndarray:
    if not plain:
        logits -= logits.max(1, keepdims=True)
    taken = logits[np.arange(len(pick)), pick].astype(np.float64)
    np.exp(logits, out=logits)
    return taken - np.log((logits @ _ONES).astype(np.float64))


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(batch.column("text"))
    begin, end, first = word_spans(data, offsets)
    return span_hashes(data, begin, end, 5), first


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's distinct words with their counts."""
    words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(signed(words)), pa.array(counts)], names=["word", "n"])

    for batch in chunks(batches):
        new, n = np.unique(_hashes(batch)[0], return_counts=True)
        both, where = np.unique(np.concatenate([words, new]), return_inverse=True)
        words, counts = both, np.bincount(where, np.concatenate([counts, n]), len(both)).astype(np.int64)
        if len(words) > _HELD:
            yield rows()
            words, counts = words[:0], counts[:0]
    yield rows()


class Lookup:
    """Places of words in a list of them."""

    def __init__(self, words: np.ndarray) -> None:
        order = np.argsort(words)
        self.words, self.places = words[order], order
        # where words with the same leading bits begin, and how many there are at most
        self.begin = np.searchsorted(self.words, np.arange(-1 << _BITS - 1, 1 << _BITS - 1) << 64 - _BITS).astype(np.int32)
        self.most = int(np.diff(self.begin, append=len(words)).max())

    def __reduce__(self):
        listed = np.empty_like(self.words)
        listed[self.places] = self.words
        return Lookup, (listed,)  # the words alone go to the tasks

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """-1 for words that are not in the list."""
        out = np.full(len(h), -1)
        at = self.begin[(h >> 64 - _BITS) + (1 << _BITS - 1)]
        for k in range(self.most):
            here = np.minimum(at + k, len(self.words) - 1)
            hit = np.nonzero(self.words[here] == h)[0]
            out[hit] = self.places[here[hit]]
        return out


class Vocabulary:
    """Ids of the most frequent words; a fixed number of entries. ``counted`` is the table of all words, where there is one.

    ``known`` are the most frequent rare words, ``shares`` the logs of their counts by the counts of their ids.
    """

    counted: DataFrame | None = None

    def __init__(self, words: np.ndarray, counts: np.ndarray) -> None:
        self.own = Lookup(words)
        self.counts = np.concatenate([counts, np.zeros(OWN - len(counts)), np.zeros(RARE)])
        self.known, self.shares = Lookup(np.zeros(0, np.int64)), np.zeros(0)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "counted"}

    def know(self, words: np.ndarray, counts: np.ndarray) -> None:
        """``words`` that have no ids of their own; the counts of all ids are there."""
        self.known, self.shares = Lookup(words), np.log(counts / self.counts[self.look(words.view(np.uint64))])

    def look(self, hashes: np.ndarray) -> np.ndarray:
        ids = self.own(signed(hashes))
        rare = np.nonzero(ids < 0)[0]
        ids[rare] = OWN + (mix(hashes[rare]) % np.uint64(RARE)).astype(np.int64)
        return ids


def vocabulary(docs: DataFrame, scratch: Scratch) -> Vocabulary:
    counted = docs.select("text").mapInArrow(_counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = scratch.keep(counted, "words")
    top = counted.orderBy(F.desc("n"), "word").limit(OWN).toPandas()
    out = Vocabulary(top["word"].to_numpy(np.int64), top["n"].to_numpy(np.int64))
    rest = counted.mapInArrow(_rare_sums(out), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out.counts[rest["id"].to_numpy(np.int64)] = rest["n"].to_numpy(np.int64)
    known = frequent(counted, KNOWN).toPandas()
    word, n = known["word"].to_numpy(np.int64), known["n"].to_numpy(np.int64)
    rare = out.own(word) < 0
    out.know(word[rare], n[rare])
    out.counted = counted
    return out


def frequent(counted: DataFrame, most: int) -> DataFrame:
    """The words above the least of a row of steps in ``n`` that no more than ``most`` words reach; unlike a sort's, its tasks hand on no rows but these."""
    step = F.floor(16 * F.log2("n"))
    sizes = sorted(counted.groupBy(step.alias("step")).count().collect(), reverse=True)  # a thousand steps go to 2**63
    reach = np.cumsum([r["count"] for r in sizes]) <= most
    return counted.filter(step >= sizes[reach.sum() - 1].step) if reach.any() else counted.limit(0)


def _rare_sums(words: Vocabulary):
    """Counts of the shared ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(CLASSES * EACH, np.int64)
        for batch in batches:
            ids = words.look(np.array(batch.column("word")).view(np.uint64))
            np.add.at(sums, ids, np.array(batch.column("n")))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(OWN, OWN + RARE)), pa.array(sums[OWN:])], names=["id", "n"])

    return rows


def _rare_shares(words: Vocabulary):
    """``share``: log of a rare word's count by the count of its id, for words whose tasks do not know it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, n = np.array(batch.column("word")), np.array(batch.column("n"))
            ids = words.look(word.view(np.uint64))
            rare = (ids >= OWN) & (words.known(word) < 0)
            share = np.log(n[rare] / words.counts[ids[rare]])
            yield pa.RecordBatch.from_arrays([pa.array(word[rare]), pa.array(share)], names=["word", "share"])

    return rows


def _rare_words(words: Vocabulary):
    """Each text's rare words with their numbers, and one row, with its key as the word and 1 in ``copies``, for the ``part`` of those whose shares are known here.

    Equal texts of a batch come once.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            key, at = np.unique(np.array(batch.column("key")), return_index=True)
            hashes, first = _hashes(batch.take(pa.array(at)))
            doc, word = np.repeat(np.arange(len(at)), np.diff(first)), signed(hashes)
            rare = np.nonzero(words.own(word) < 0)[0]
            doc, word = doc[rare], word[rare]
            place = words.known(word)
            here = place >= 0
            part, some = np.bincount(doc[here], words.shares[place[here]], len(at)), np.bincount(doc, minlength=len(at)) > 0
            doc, word = doc[~here], word[~here]
            order = np.lexsort((word, doc))
            doc, word = doc[order], word[order]
            begin = np.nonzero(np.r_[True, (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])][: len(doc)])[0]
            n = np.diff(np.r_[begin, len(doc)])
            columns = [np.r_[key[doc[begin]], key[some]], np.r_[word[begin], key[some]], np.r_[n, np.zeros(some.sum(), np.int64)].astype(np.int32)]
            own = np.r_[np.zeros(len(n), bool), np.ones(some.sum(), bool)]
            part = pa.array(np.r_[np.zeros(len(n)), part[some]], mask=~own)
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), part, pa.array(own.astype(np.int32))], names=["key", "word", "n", "part", "copies"])

    return rows


def _identified(words: Vocabulary):
    """``ids``: the texts as ids of two bytes a word, written once and read by every round of training and by scoring."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            hashes, first = _hashes(batch)
            ids = lists(words.look(hashes).astype(np.int16), np.diff(first), pa.int16())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), ids], names=["doc_id", "key", "ids"])

    return rows


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of whole documents, of texts by their bytes and of ids by their number."""
    for batch in batches:
        if "ids" not in batch.schema.names:
            yield from chunks(iter([batch]))
        elif batch.num_rows:
            part = np.array(batch.column("ids").offsets)[:-1] // _RUN
            cuts = [0, *(np.nonzero(np.diff(part))[0] + 1), batch.num_rows]
            yield from (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False))


def _places(batch: pa.RecordBatch, words: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every word with its neighbours, of texts or of their ids; beyond a document's ends there is a border word."""
    if "ids" in batch.schema.names:
        ids = batch.column("ids")
        first, target = np.array(ids.offsets), np.array(ids.flatten())
    else:
        hashes, first = _hashes(batch)
        target = words.look(hashes).astype(np.int16)
    doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
    at = np.arange(len(target)) + SIDE * (doc + 1)
    line = np.full(len(target) + SIDE * (batch.num_rows + 1), CLASSES * EACH, np.int16)
    line[at] = target
    around = np.stack([line[at + k] for k in range(-SIDE, SIDE + 1) if k], 1) if len(at) else np.zeros((0, 2 * SIDE), np.int16)
    return around, target, doc


def _trained(words: Vocabulary, start: Network, turn: int, rounds: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, seen = Network(start.flat.copy()), 0
        descent = Descent(net)
        for batch in _runs(batches):
            around, target, doc = _places(batch, words)
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            key = mix(ids[doc].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(len(doc), dtype=np.uint64) - np.searchsorted(doc, doc).astype(np.uint64))
            masked = np.nonzero(key % np.uint64(rounds) == np.uint64(turn))[0]
            masked = masked[np.argsort(key[masked], kind="stable")]  # neighbours in a batch come from all its documents
            for k in range(0, len(masked), BATCH):
                pick = masked[k : k + BATCH]
                descent.step(around[pick], target[pick])
                seen += len(pick)
        if seen:
            i = np.arange(len(net.flat) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(np.r_[net.flat.astype(np.float64) * seen, float(seen)])], names=["i", "v"])

    return rows


def train(docs: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> Network:
    net = Network.first(words.counts)
    for turn in range(rounds):
        sums = docs.mapInArrow(_trained(words, net, turn, rounds), "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
        if not len(sums):
            continue
        values = np.zeros(len(net.flat) + 1)  # as long as the network, whatever the corpus
        values[sums["i"].to_numpy()] = sums["v"].to_numpy()
        net = Network(values[:-1] / values[-1])
    return net


def _scored(words: Vocabulary, net: Network):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = Room()
        for batch in _runs(batches):
            around, target, doc = _places(batch, words)
            total = np.zeros(batch.num_rows)
            for k in range(0, len(target), 1 << 14):
                part = slice(k, k + (1 << 14))
                total += np.bincount(doc[part], net.log_probabilities(around[part], target[part], room), batch.num_rows)
            n = np.bincount(doc, minlength=batch.num_rows)
            mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
            columns = {"doc_id": batch.column("doc_id"), "n_words": pa.array(n.astype(np.int64)), "log_likelihood": pa.array(total), "mean_log_likelihood": mean}
            if "key" in batch.schema.names:
                columns["key"] = batch.column("key")
            yield pa.RecordBatch.from_pydict(columns)

    return rows


def rare_scores(texts: DataFrame, words: Vocabulary, scratch: Scratch) -> DataFrame:
    """``key, rare``: what the rare words of the texts with this key add to the score of their ids."""
    return scratch.keep(_rare_totals(texts, words), "rare")


def _rare_totals(texts: DataFrame, words: Vocabulary) -> DataFrame:
    shares = words.counted.mapInArrow(_rare_shares(words), "word long, share double")
    found = texts.select("key", "text").mapInArrow(_rare_words(words), "key long, word long, n int, part double, copies int")
    part = F.coalesce("part", F.col("n") * F.col("share"))
    # equal texts of other batches have equal sums: all are added up, without telling their words apart, and shared out
    return found.join(shares, "word", "left").groupBy("key").agg((F.sum(part) / F.sum("copies")).alias("rare"))


def pseudo_likelihood(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, n_words, log_likelihood, mean_log_likelihood`` of every row."""
    scratch = Scratch(docs.sparkSession, "likelihood")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    words = vocabulary(texts, scratch)
    texts = texts.withColumn("key", F.xxhash64("text"))
    ids = scratch.keep(texts.mapInArrow(_identified(words), "doc_id long, key long, ids array<short>"), "ids")
    net = train(ids, words, rounds)
    rare = rare_scores(texts, words, scratch)
    scored = ids.mapInArrow(_scored(words, net), "doc_id long, n_words long, log_likelihood double, mean_log_likelihood double, key long")
    scored = scratch.keep(scored, "scored")  # a written side leaves the join plain, so adaptive execution can split hot texts
    # one score for equal texts: sums in single precision hang on what else is in a block
    total = F.col("least") + F.coalesce("rare", F.lit(0.0))
    totals = scored.groupBy("key").agg(F.min("log_likelihood").alias("least")).join(rare, "key", "left").select("key", total.alias("log_likelihood"))
    out = scored.select("doc_id", "n_words", "key").join(scratch.keep(totals, "totals"), "key").select("doc_id", "n_words", "log_likelihood")
    return out.withColumn("mean_log_likelihood", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))
