"""Document probabilities by a subword lattice: all segmentations count, not the best one alone.

The pieces of an existing vocabulary, its end symbol among them, are drawn independently of each other;
a blank stands at the head of each word. Weights start from the vocabulary's own scores, which rank the
pieces, and are fitted to the distinct training words, which new words resemble, by expected counts
over all segmentations. Pieces don't cross words, so the forward recursion, in logarithms, runs once for
each distinct word of the corpus.

Words of the training texts are arcs of the lattice as well: over a whole word lie its own arc, weighted
by its count, and below it, with the weight that counts leave to new words, all its segmentations. Texts
come from `COMPONENTS` sources (languages, styles) with counts of their own, which fall back to those of
all. A text's probability is the sum over sources, and over all paths of each one's lattice.

Documents look up the `HOT` most frequent words in a table sent to all tasks; their other words meet the
complete table in a join, as rows of (document, word, number), so no task holds all words or all
documents of a word. Sources are found in all training documents, by the expectation maximisation of a
mixture of distributions of the most frequent words; it starts from contexts of words that are least alike,
and each pass sums whole numbers, so no order of rows changes it.

Defined results: null and empty texts have their end as only token; words of any length are taken whole;
any byte string has a probability, since single bytes are pieces; a row without an id is not learned from;
repeated rows have repeated results; without training documents the start weights stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillstream.llm.segments import NOT_SPACE, chunks, gather, lowered, mix, span_hashes, words
from tillstream.session import stage

# Words whose values all tasks hold: about 16 MB.
HOT = 200_000
# Sources; the most frequent words by which they are told apart, and those whose contexts they start from.
COMPONENTS, MARKERS, LEADS = 8, 2_000, 256
# Passes over all training documents at most; the share of words that changes sources below which they end.
PASSES, SETTLED = 12, 1e-3
ROUNDS = 3
# Logarithms and shares are whole multiples of its inverse where sums must be exact.
_UNIT = 1 << 20
# The start weights count as so many observations.
PRIOR = 1000.0
END = b"</s>"
_MULTIPLIER = 0x9E3779B97F4A7C15
_GROUP = 1 << 19


def vocabulary(path: str) -> list[tuple[bytes, float]]:
    """(piece, start weight) of a sentencepiece file, the end symbol first, weights summing to one.

    The scores are negative ranks; a piece weighs the inverse of its rank. Pieces with an inner word
    break can't occur. A byte piece that equals a character adds to it.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weights: dict[bytes, float] = {END: 1e-3}
    for i in range(model.vocab_size()):
        if model.is_unknown(i) or model.is_control(i):
            continue
        if model.is_byte(i):
            piece, rank = bytes([int(model.id_to_piece(i)[1:-1], 16)]), model.vocab_size()
        else:
            piece, rank = model.id_to_piece(i).replace("▁", " ").encode(), -model.get_score(i)
        if b" " not in piece[1:] and piece:
            weights[piece] = weights.get(piece, 0.0) + 1 / (rank + 10)
    total = sum(weights.values())
    return [(p, w / total) for p, w in weights.items()]


class Lattice:
    """Forward and backward recursions over all segmentations of many words at once."""

    def __init__(self, pieces: list[bytes], weights: np.ndarray):
        """The first piece is the end symbol, which no word contains."""
        data = np.frombuffer(b"".join(pieces[1:]), np.uint8)
        sizes = np.fromiter(map(len, pieces[1:]), np.int64, len(pieces) - 1)
        ends = np.cumsum(sizes)
        hashes = span_hashes(data, ends - sizes, ends)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        self.order = self.order + 1
        self.longest = int(sizes.max())
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.sorted >> np.uint64(44)] = True
        with np.errstate(divide="ignore"):
            self.log = np.log(weights)

    def _arcs(self, letters: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(from, to, rows, pieces) of all pieces in words of one length, by their last place."""
        n, length = letters.shape
        base = np.uint64(_MULTIPLIER)
        powers = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(length, base))))
        back = np.uint64(pow(_MULTIPLIER, -1, 1 << 64))
        inverses = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(length, back))))
        sums = np.zeros((length + 1, n), np.uint64)
        np.cumsum((letters.T.astype(np.uint64) + np.uint64(1)) * powers[:length, None], axis=0, out=sums[1:])
        for end in range(1, length + 1):
            for start in range(max(0, end - self.longest), end):
                keys = mix((sums[end] - sums[start]) * inverses[start] + np.uint64(end - start))
                maybe = np.flatnonzero(self.seen[keys >> np.uint64(44)])
                if len(maybe):
                    at = np.minimum(np.searchsorted(self.sorted, keys[maybe]), len(self.sorted) - 1)
                    hit = self.sorted[at] == keys[maybe]
                    if hit.any():
                        yield start, end, maybe[hit], self.order[at[hit]]

    def _forward(self, arcs: list, n: int, length: int) -> np.ndarray:
        reached = np.full((length + 1, n), -np.inf)
        reached[0] = 0.0
        for start, end, rows, piece in arcs:
            reached[end, rows] = np.logaddexp(reached[end, rows], reached[start, rows] + self.log[piece])
        return reached

    def log_probability(self, letters: np.ndarray) -> np.ndarray:
        """Natural logarithm of the summed weight of all segmentations, for words of one length."""
        return self._forward(self._arcs(letters), *letters.shape)[-1]

    def expected(self, letters: np.ndarray, counts: np.ndarray, into: np.ndarray) -> None:
        """Adds the expected number of uses of each piece in the counted words to `into`."""
        n, length = letters.shape
        arcs = list(self._arcs(letters))
        forward = self._forward(arcs, n, length)
        backward = np.full((length + 1, n), -np.inf)
        backward[length] = 0.0
        for start, end, rows, piece in reversed(arcs):
            backward[start, rows] = np.logaddexp(backward[start, rows], backward[end, rows] + self.log[piece])
        for start, end, rows, piece in arcs:
            share = np.exp(forward[start, rows] + self.log[piece] + backward[end, rows] - forward[length, rows])
            into += np.bincount(piece, share * counts[rows], len(into))


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, letters with the blank at the head) of words of the same length, in groups of bounded size."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    sizes = np.diff(at)
    order = np.argsort(sizes, kind="stable")
    edges = np.flatnonzero(np.diff(sizes[order], prepend=-1)).tolist()
    for a, b in zip(edges, edges[1:] + [len(order)]):
        size = int(sizes[order[a]])
        step = max(1, _GROUP // (size + 1))
        for c in range(a, b, step):
            rows = order[c:min(c + step, b)]
            letters = np.full((len(rows), size + 1), 32, np.uint8)
            letters[:, 1:] = data[at[rows][:, None] + np.arange(size)]
            yield rows, letters


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 100_000) -> Iterator[pa.Table]:
    """Batches joined into tables of some `rows` rows, so that each length has many words."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learned from; a row without an id is one."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(True))


def _distinct_words(data: np.ndarray, bounds: np.ndarray):
    """Of a chunk: lower-cased bytes, starts and ends of words, the rows' words, and their distinct numbering."""
    starts, ends, rows = words(data, bounds, NOT_SPACE)
    small = lowered(data)
    keys = span_hashes(small, starts, ends)
    distinct, first, number = np.unique(keys, return_index=True, return_inverse=True)
    return small, starts, ends, rows, distinct, first, number


def _spelled(small: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words between starts and ends as a binary array."""
    sizes = ends - starts
    flat = small[gather(starts, sizes)]
    at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(flat))]).cast(pa.binary())


def word_hashes(spelled: pa.Array) -> np.ndarray:
    spelled = spelled.cast(pa.large_binary())
    at = np.frombuffer(spelled.buffers()[1], np.int64)[spelled.offset:spelled.offset + len(spelled) + 1]
    data = np.frombuffer(spelled.buffers()[2] or b"", np.uint8)
    return span_hashes(data, at[:-1], at[1:])


class WordTable:
    """Numbers of some words by their hashes."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes)
        self.keys = hashes[self.order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each word, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], -1)


class Sources:
    """Which source a text most likely comes from, by its counts of the marker words."""

    def __init__(self, markers: np.ndarray, words: np.ndarray, weight: np.ndarray):
        """`markers`: hashes of the marker words; `words`: a row of their shares for each source; `weight`: the sources' shares."""
        self.markers, self.table = markers, WordTable(markers)
        # Whole numbers, whose sums are exact in any order.
        self.words, self.weight = np.rint(np.log(words) * _UNIT), np.rint(np.log(weight) * _UNIT)

    def fit(self, owner: np.ndarray, marker: np.ndarray, n: np.ndarray | int, rows: int) -> np.ndarray:
        """Logarithms, in units, of the joint probability of each row and source."""
        return np.stack([np.bincount(owner, w[marker] * n, rows) + p for w, p in zip(self.words, self.weight)], 1)

    def of(self, owner: np.ndarray, keys: np.ndarray, number: np.ndarray, rows: int) -> np.ndarray:
        """The source of each row, from the distinct words' `keys` and the words' `number` among them."""
        marker = self.table.find(keys)[number]
        known = marker >= 0
        return self.fit(owner[known], marker[known], 1, rows).argmax(1)


def _marker_words(train: DataFrame) -> np.ndarray:
    """Hashes of the most frequent words of all training texts, the most frequent first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, bounds in chunks(batch.column(0), 1 << 20):
                _, _, _, _, distinct, _, number = _distinct_words(data, bounds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct.view(np.int64)), pa.array(np.bincount(number, minlength=len(distinct)))], names=["word", "n"])

    counts = train.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(MARKERS).select("word").toArrow()["word"].to_numpy().view(np.uint64)


def _marker_counts(train: DataFrame, markers: np.ndarray) -> DataFrame:
    """(marker, n) of every training text: numbers of its marker words, rising, and how often each occurs."""
    shared = train.sparkSession.sparkContext.broadcast(markers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, size = WordTable(shared.value), max(len(shared.value), 1)
        for batch in batches:
            for first, last, data, bounds in chunks(batch.column(0)):
                _, _, _, rows, distinct, _, number = _distinct_words(data, bounds)
                place = table.find(distinct)[number]
                owner = np.repeat(np.arange(last - first), np.diff(rows))
                cells, n = np.unique((owner * size + place)[place >= 0], return_counts=True)
                owner, marker = np.divmod(cells, size)
                at = pa.array(np.searchsorted(owner, np.arange(last - first + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(at, pa.array(v.astype(np.int32))) for v in (marker, n)], names=["marker", "n"])

    return train.mapInArrow(run, "marker array<int>, n array<int>")


def _cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, markers and counts of a batch of `_marker_counts`."""
    sizes = batch.column(0).value_lengths().to_numpy()
    return (np.repeat(np.arange(batch.num_rows), sizes), *(c.flatten().to_numpy() for c in batch.columns))


def _summed(counts: DataFrame, shape: tuple[int, ...], add) -> np.ndarray:
    """The sum of what `add(batch, into)` adds over all batches: whole numbers, one row a cell and task."""
    size = int(np.prod(shape))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        into = np.zeros(size)
        for batch in batches:
            add(batch, into.reshape(shape))
        used = np.flatnonzero(into)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(into[used].astype(np.int64))], names=["cell", "n"])

    out = np.zeros(size)
    found = counts.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(shape)


def _contexts(counts: DataFrame, leads: int) -> np.ndarray:
    """For each of the most frequent words, the summed shares of these words in all texts that have it."""
    def add(batch: pa.RecordBatch, into: np.ndarray) -> None:
        owner, marker, n = _cells(batch)
        some = marker < leads
        owner, marker, n = owner[some], marker[some], n[some]
        for a in range(0, batch.num_rows, 1024):
            span = slice(*np.searchsorted(owner, (a, a + 1024)))
            times = np.zeros((1024, leads), np.float32)
            times[owner[span] - a, marker[span]] = n[span]
            shares = np.rint(times / np.maximum(times.sum(1, keepdims=True), 1) * 1024)
            into += (times > 0).astype(np.float32).T @ shares

    return _summed(counts, (leads, leads), add)


def _seeds(contexts: np.ndarray, size: int) -> np.ndarray:
    """Start distributions of `size` markers: contexts far from each other, next the one least like all seeds so far."""
    rows = contexts[contexts.sum(1) > 0]
    unit = np.sqrt(rows / np.maximum(rows.sum(1, keepdims=True), 1))
    like, seeds = np.zeros(len(rows)), []
    for _ in range(min(COMPONENTS, len(rows))):
        seeds.append(int(like.argmin()) if seeds else int((unit @ unit.sum(0)).argmax()))
        like = np.maximum(like, unit @ unit[seeds[-1]])
    words = np.full((max(len(seeds), 1), size), 1e-4)
    words[:len(seeds), :contexts.shape[1]] += unit[seeds] ** 2
    return words


def _owned(counts: DataFrame, sources: Sources) -> tuple[np.ndarray, np.ndarray]:
    """Expected uses of each marker by each source, and expected documents of each source, over all training texts."""
    shared, size = counts.sparkSession.sparkContext.broadcast(sources), len(sources.markers)

    def add(batch: pa.RecordBatch, into: np.ndarray) -> None:
        own, (owner, marker, n) = shared.value, _cells(batch)
        fit = own.fit(owner, marker, n, batch.num_rows) / _UNIT
        share = np.exp(fit - fit.max(1, keepdims=True))
        share = np.rint(share / share.sum(1, keepdims=True) * _UNIT)
        into[:, size] += share.sum(0)
        for k, part in enumerate(share.T):
            into[k, :size] += np.bincount(marker, part[owner] * n, size)

    made = _summed(counts, (len(sources.words), size + 1), add) / _UNIT
    return made[:, :size], made[:, size]


def find_sources(docs: DataFrame) -> tuple[Sources, DataFrame]:
    """Sources of all training documents, and these as counts of the marker words."""
    train = docs.where("NOT held_out").select("text")
    markers = _marker_words(train)
    counts = stage(_marker_counts(train, markers), "marker-counts")
    words = _seeds(_contexts(counts, min(LEADS, len(markers))), len(markers))
    sources, uses = Sources(markers, words, np.full(len(words), 1 / len(words))), None
    for _ in range(PASSES if len(words) > 1 else 0):
        before, (uses, documents) = uses, _owned(counts, sources)
        smooth = uses + 0.05
        sources = Sources(markers, smooth / smooth.sum(1, keepdims=True), (documents + 1) / (documents.sum() + len(words)))
        if before is not None and abs(uses - before).sum() <= SETTLED * uses.sum():
            break
    return sources, counts


def word_counts(docs: DataFrame, sources: Sources) -> DataFrame:
    """(word, n_all, n_train, n_0, n_1 ...) of every distinct word: in all documents, in training ones, and
    in those of each source. `docs` has text and held_out."""
    shared = docs.sparkSession.sparkContext.broadcast(sources)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            train = ~np.array(batch.column(1).to_pylist(), bool)
            for first, last, data, bounds in chunks(batch.column(0), 1 << 20):
                small, starts, ends, rows, distinct, at, number = _distinct_words(data, bounds)
                owner = np.repeat(np.arange(last - first), np.diff(rows))
                learned = train[first + owner]
                source = own.of(owner, distinct, number, last - first)[owner]
                cell, where = np.unique(source * len(distinct) + number, return_inverse=True)
                kind, word = np.divmod(cell, max(len(distinct), 1))
                yield pa.RecordBatch.from_arrays([
                    _spelled(small, starts[at[word]], ends[at[word]]), pa.array(kind.astype(np.int32)),
                    pa.array(np.bincount(where, minlength=len(cell))),
                    pa.array(np.bincount(where, learned, len(cell)).astype(np.int64)),
                ], names=["word", "source", "n_all", "n_train"])

    found = docs.select("text", "held_out").mapInArrow(run, "word binary, source int, n_all long, n_train long")
    each = [F.sum(F.when(F.col("source") == k, F.col("n_train")).otherwise(0)).alias(f"n_{k}")
            for k in range(len(sources.weight))]
    return found.groupBy("word").agg(F.sum("n_all").alias("n_all"), F.sum("n_train").alias("n_train"), *each)


def document_counts(counts: DataFrame, sources: Sources) -> np.ndarray:
    """Training documents of each source, from their counts of marker words."""
    shared = counts.sparkSession.sparkContext.broadcast(sources)

    def add(batch: pa.RecordBatch, into: np.ndarray) -> None:
        owner, marker, n = _cells(batch)
        into += np.bincount(shared.value.fit(owner, marker, n, batch.num_rows).argmax(1), minlength=len(into))

    return _summed(counts, (len(sources.weight),), add)


def fitted(counts: DataFrame, path: str, rounds: int = ROUNDS) -> tuple[list[bytes], np.ndarray]:
    """The pieces and their weights after `rounds` of expected counts over all distinct training words."""
    spark = counts.sparkSession
    pieces, start = map(list, zip(*vocabulary(path)))
    start = np.array(start)
    weights = start
    training = counts.where("n_train > 0").select("word")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((pieces, weights))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = Lattice(*shared.value)
            into = np.zeros(len(own.log))
            for table in _gathered(batches):
                for rows, letters in by_length(table["word"].combine_chunks()):
                    own.expected(letters, np.ones(len(rows)), into)
            used = np.flatnonzero(into)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(into[used])], names=["piece", "uses"])

        # One number for each piece of the vocabulary.
        uses = np.zeros(len(pieces))
        for row in training.mapInArrow(run, "piece long, uses double").groupBy("piece").agg(
                F.sum("uses").alias("uses")).collect():
            uses[row.piece] = row.uses
        uses[0] = 1
        weights = (uses + PRIOR * start) / (uses.sum() + PRIOR)
    return pieces, weights


def word_values(counts: DataFrame, pieces: list[bytes], weights: np.ndarray) -> DataFrame:
    """`counts` with `lattice`, the natural logarithm of the summed weight of each word's segmentations."""
    shared = counts.sparkSession.sparkContext.broadcast((pieces, weights))
    schema = T.StructType([*counts.schema.fields, T.StructField("lattice", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for table in _gathered(batches):
            own = own or Lattice(*shared.value)
            made = np.zeros(table.num_rows)
            for rows, letters in by_length(table["word"].combine_chunks()):
                made[rows] = own.log_probability(letters)
            yield pa.RecordBatch.from_arrays(
                [*(c.combine_chunks() for c in table.columns), pa.array(made)], names=[*table.column_names, "lattice"])

    return counts.mapInArrow(run, schema)


def _backed_off(count, total: float, kinds: float, below):
    """Probability from a count, with as many observations as there are kinds left to what lies below."""
    return (count + kinds * below) / (total + kinds) if total + kinds else below


class Totals:
    """Tokens, distinct tokens and documents of the training texts, over all and of each source."""

    def __init__(self, values: DataFrame, documents: np.ndarray, end: float):
        """`end`: the lattice's weight of the end symbol."""
        n = len(documents)
        sums = values.agg(
            F.sum("n_train"), F.count_if(F.col("n_train") > 0),
            *[F.sum(f"n_{k}") for k in range(n)], *[F.count_if(F.col(f"n_{k}") > 0) for k in range(n)]).first()
        sums = [float(x or 0) for x in sums]
        self.documents, every = documents, documents.sum()
        self.all, self.kinds = sums[0] + every, sums[1] + (every > 0)
        self.each = np.array(sums[2:2 + n]) + documents
        self.each_kinds = np.array(sums[2 + n:]) + (documents > 0)
        end = _backed_off(every, self.all, self.kinds, end)
        self.end = np.log10([_backed_off(d, t, v, end) for d, t, v in zip(documents, self.each, self.each_kinds)])
        self.weight = np.log10((documents + 1) / (every + n))


def with_logs(values: DataFrame, totals: Totals) -> DataFrame:
    """`values` with l_0, l_1 ...: the base-10 logarithm of each word's probability in each source."""
    below = F.exp("lattice")
    every = _backed_off(F.col("n_train"), float(totals.all), float(totals.kinds), below)
    # Far below the smallest double the logarithm of the last term is the whole.
    floor = (F.col("lattice") + float(np.log(max(totals.kinds, 1) / max(totals.all + totals.kinds, 1)))) / float(np.log(10))
    logs = []
    for k, (total, kinds) in enumerate(zip(totals.each.tolist(), totals.each_kinds.tolist())):
        p = _backed_off(F.col(f"n_{k}"), float(total), float(kinds), every)
        own = float(np.log10(kinds / (total + kinds))) if total + kinds else 0.0
        if total + kinds and not kinds:
            own = 0.0
        logs.append(F.when(p > 1e-280, F.log10(p)).otherwise(floor + own).alias(f"l_{k}"))
    return values.select("word", "n_all", "n_train", *logs)


class HotWords:
    """Values of the most frequent words."""

    def __init__(self, rows: pa.Table, n: int):
        self.table = WordTable(word_hashes(rows["word"].combine_chunks()))
        self.n_train = rows["n_train"].to_numpy()
        self.logs = [rows[f"l_{k}"].to_numpy() for k in range(n)]


def _parts(docs: DataFrame, hot: HotWords) -> DataFrame:
    """Of each document one row with the sums over its hot words, and one for each other distinct word.

    The row of sums has a word of its own that no text contains.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)
    logs = [f"l_{k}" for k in range(len(hot.logs))]
    schema = "doc_id long, text_hash long, word binary, n long, copies int, n_known long, n_log double" + "".join(
        f", {k} double" for k in logs)
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        gain = np.log10(own.n_train + 1.0)
        for batch in batches:
            for first, last, data, bounds in chunks(batch.column(2)):
                small, starts, ends, rows, distinct, at, number = _distinct_words(data, bounds)
                n = last - first
                owner = np.repeat(np.arange(n), np.diff(rows))
                place = own.table.find(distinct)[number]
                known = place >= 0
                of, which = owner[known], place[known]
                sums = [np.bincount(of, v, n).astype(float) for v in (
                    np.ones(len(of)), own.n_train[which] > 0, gain[which], *(g[which] for g in own.logs))]
                # The other words, once for each document.
                pairs, spot, times = np.unique(
                    owner[~known] * len(distinct) + number[~known], return_index=True, return_counts=True)
                whose = pairs // max(len(distinct), 1)
                spot = np.flatnonzero(~known)[spot]
                ids = [batch.column(k).slice(first, n) for k in (0, 1)]
                take = pa.array(whose)
                marks = pa.array([b" %d" % i for i in range(n)], pa.binary())
                for columns in (
                    [*ids, marks, pa.array(sums[0].astype(np.int64)), pa.array(np.ones(n, np.int32)),
                     pa.array(sums[1].astype(np.int64)), *map(pa.array, sums[2:])],
                    [*(c.take(take) for c in ids), _spelled(small, starts[spot], ends[spot]), pa.array(times),
                     pa.array(np.zeros(len(spot), np.int32)), pa.nulls(len(spot), pa.int64()),
                     *(pa.nulls(len(spot), pa.float64()) for _ in sums[2:])],
                ):
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text_hash", "text").mapInArrow(run, schema)


def probabilities(docs: DataFrame, path: str, rounds: int = ROUNDS, hot: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    rows = docs.select("doc_id", "text", held_out().alias("held_out"), F.xxhash64("text").alias("text_hash"))
    sources, markers = find_sources(rows)
    documents = document_counts(markers, sources)
    counts = stage(word_counts(rows, sources), "word-counts")
    pieces, weights = fitted(counts, path, rounds)
    values = word_values(counts, pieces, weights)
    totals = Totals(counts, documents, float(weights[0]))
    values = stage(with_logs(values, totals), "word-values")
    n = len(documents)
    logs = [f"l_{k}" for k in range(n)]
    frequent = values.orderBy(F.desc("n_all"), "word").limit(hot).select("word", "n_train", *logs).toArrow()

    looked_up = _parts(rows, HotWords(frequent, n)).join(
        values.select("word", F.col("n_train").alias("c"), *[F.col(k).alias(f"word_{k}") for k in logs]), "word", "left")
    times = F.col("n")
    of_row = {
        "n": times,
        "copies": F.col("copies"),
        "n_known": F.coalesce("n_known", F.when(F.col("c") > 0, times).otherwise(0)),
        "n_log": F.coalesce("n_log", times * F.log10(F.col("c") + 1.0)),
    } | {k: F.coalesce(k, times * F.col(f"word_{k}")) for k in logs}
    summed = looked_up.groupBy("doc_id", "text_hash").agg(*[F.sum(v).alias(k) for k, v in of_row.items()])
    # Repeated rows were added up.
    copies = F.col("copies")
    each = F.explode(F.sequence(F.lit(1), copies.cast("int")))
    tokens = (times / copies).cast("long") + 1
    paths = [F.col(k) / copies + float(e + w) for k, e, w in zip(logs, totals.end, totals.weight)]
    best = F.greatest(*paths) if n > 1 else paths[0]
    over = sum((F.pow(F.lit(10.0), F.greatest(p - best, F.lit(-300.0))) for p in paths), F.lit(0.0))
    known_end, scale = int(documents.sum() > 0), float(np.log10(totals.all + totals.kinds + 1))
    return summed.withColumn("copy", each).select(
        "doc_id", held_out().alias("held_out"), tokens.alias("n_tokens"),
        ((F.col("n_known") / copies).cast("long") + known_end).alias("n_known"),
        F.lit(int(totals.all)).cast("long").alias("train_tokens"),
        (F.col("n_log") / copies + float(np.log10(documents.sum() + 1)) - tokens * scale).alias("base_score"),
        (best + F.log10(over)).alias("score"),
    )
