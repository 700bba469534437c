"""Toxicity of texts by their nearest labelled examples.

1. A bounded sample of the labelled rows (`EXAMPLES`, drawn by a hash of the id) becomes the examples.
2. Words, and the first bytes of words, are terms. All terms of the examples count: every example becomes
   a unit vector of log-count times inverse document frequency, in an inverted index. Like examples stand
   in blocks that hold their weights of common terms and the largest of each; other terms have postings.
3. A text visits blocks in the order of their upper bounds and stops where no block left can hold one
   of the nearest: the nearest examples by exact cosine. Many texts visit a block at once. Their votes are weighted by the inverse of the
   distance and drawn to the overall share.
4. A second vote is that of the nearest examples over the leaning terms alone, those that occur in toxic
   examples more often than chance allows. Documents are counted first; then, for the terms left, distinct
   contexts (word before, word after), so that copies of one toxic text don't make its words lean.
5. A logistic curve of both votes is fitted to the examples' own leave-one-out votes.

Index and curve are fitted on the sample alone; every text is read whole, and every text that shares a
word with an example is searched. Words that no example has are in no vector.

Defined results: null and empty texts and those without a word of the examples get the share of toxic rows
among examples without a leaning term; without labelled rows of both sorts every score is 0; equal cosines
go by example id; equal texts get equal scores; several labels of a document count as toxic if one does.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.columns import fields, unused, with_arrow
from tillstream.llm.segments import ALPHANUMERIC, chunks, gather, lowered, mix, span_hashes, words
from tillstream.session import stage

# Bounds of the fit: labelled rows (on average), and leaning terms.
EXAMPLES, TERMS = 20_000, 5_000
# Twice the log-likelihood ratio from which a term leans: chance alone exceeds it 4 times in a million.
EVIDENCE = 20.0
NEIGHBOURS, PRIOR, NEARNESS = 15, 1.0, 0.05
_PREFIX = 6
# Examples a block and groups of like ones; terms in more than one example of _COMMON are common; queries that are
# searched together; error that products of single precision may have.
_BLOCK, _GROUPS, _COMMON, _TOGETHER, _MARGIN = 128, 48, 24, 256, 2e-5
_POSTING = np.dtype([("place", "<i4"), ("weight", "<f8")])
# Bytes that are cut into words at once: their arrays stay in the processor's cache.
_AT_ONCE = 1 << 16
# Tasks that find the examples' own votes.
VOTERS = 48
_PREFIX_SALT, _SIDE = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def terms(column: pa.Array, contexts: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row bounds, term hashes, context hashes if wanted): each word's two terms stand side by side."""
    lower = pc.utf8_lower(column.cast(pa.large_string()))
    for first, _, data, bounds in chunks(lower, _AT_ONCE):
        starts, ends, rows = words(data, bounds, ALPHANUMERIC)
        data = lowered(data)
        whole = span_hashes(data, starts, ends)
        head = mix(span_hashes(data, starts, np.minimum(ends, starts + _PREFIX)) ^ _PREFIX_SALT)
        both = np.stack([whole, head], 1).ravel()
        if not contexts:
            yield first, rows * 2, both, None
            continue
        before, after = np.zeros_like(whole), np.zeros_like(whole)
        before[1:], after[:-1] = whole[:-1], whole[1:]
        edge = rows[:-1][np.diff(rows) > 0]
        before[edge] = 0
        after[rows[1:][np.diff(rows) > 0] - 1] = 0
        context = mix(mix(before) * _SIDE + after)
        yield first, rows * 2, both, np.repeat(context, 2)


class TermTable:
    """Looks terms up: the number of each known one, in any order of hashes."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        # Where the terms with each value of the first 20 bits begin.
        self.first = np.zeros((1 << 20) + 1, np.int32)
        np.cumsum(np.bincount((hashes >> np.uint64(44)).astype(np.int64), minlength=1 << 20), out=self.first[1:])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known terms and their numbers."""
        group = (hashes >> np.uint64(44)).astype(np.int64)
        at, end = self.first[group], self.first[group + 1]
        open_ = np.flatnonzero(at < end)
        at, end, own = at[open_], end[open_], hashes[open_]
        number = np.full(len(hashes), -1)
        while len(open_):
            hit = self.sorted[at] == own
            number[open_[hit]] = self.order[at[hit]]
            left = np.flatnonzero(~hit & (at + 1 < end))
            open_, at, end, own = open_[left], at[left] + 1, end[left], own[left]
        known = np.flatnonzero(number >= 0)
        return known, number[known]


def counted_terms(column: pa.Array, table: TermTable, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The (numbers, counts) of each text's terms that the table of `size` terms knows, in rising order."""
    for _, rows, hashes, _ in terms(column, contexts=False):
        place, number = table.find(hashes)
        owner = np.searchsorted(rows, place, "right") - 1
        keys, counts = np.unique(owner * size + number, return_counts=True)
        owner, number = np.divmod(keys, max(size, 1))
        at = np.searchsorted(owner, np.arange(len(rows))).tolist()
        for a, b in zip(at, at[1:]):
            yield number[a:b], counts[a:b]


def unit(weight: np.ndarray) -> np.ndarray:
    return weight / np.sqrt((weight ** 2).sum()) if len(weight) else weight


class BlockMaxIndex:
    """Unit vectors by term, their examples in blocks of like ones.

    Terms of few examples have postings, summed one by one. Terms of many have a dense matrix a block, and
    the block's largest weight of each: queries are multiplied, many at once, only with blocks whose bound
    reaches the least of the nearest found so far. Products are of single precision and only choose
    candidates, with a margin above their error; the cosines of those are summed in double precision.
    """

    def __init__(self, examples: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self._build(np.concatenate(([0], np.cumsum([len(t) for t, _ in examples], dtype=np.int64))),
                    np.concatenate([t.astype(np.int32) for t, _ in examples] + [np.zeros(0, np.int32)]),
                    np.concatenate([w for _, w in examples] + [np.zeros(0)]), n_terms)

    @classmethod
    def of(cls, at: np.ndarray, term: np.ndarray, weight: np.ndarray, n_terms: int) -> BlockMaxIndex:
        """The index of examples whose terms and weights stand from at[i] to at[i + 1]."""
        index = cls.__new__(cls)
        index._build(at, term, weight, n_terms)
        return index

    def _build(self, at: np.ndarray, term: np.ndarray, weight: np.ndarray, n_terms: int) -> None:
        self.n = len(at) - 1
        self.blocks = -(-self.n // _BLOCK)
        often = np.flatnonzero(np.bincount(term, minlength=n_terms) > max(self.n // _COMMON, 2 * _BLOCK))
        self.common = np.full(n_terms, -1, np.int32)
        self.common[often] = np.arange(len(often))
        owner = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(at))
        is_heavy = self.common[term] >= 0
        of_heavy = owner[is_heavy]
        self.heavy_at = np.searchsorted(of_heavy, np.arange(self.n + 1))
        self.heavy_number, self.heavy_weight = self.common[term[is_heavy]], weight[is_heavy]
        self.order = self._alike(of_heavy, len(often))
        self.place = np.empty(self.n, np.int32)
        self.place[self.order] = np.arange(self.n)
        self._add_postings(np.flatnonzero(~is_heavy).astype(np.int32), owner, term, weight, n_terms)
        del owner, is_heavy
        self._add_blocks(self.place[of_heavy], len(often))

    def _add_postings(self, rare: np.ndarray, owner: np.ndarray, term: np.ndarray, weight: np.ndarray, n_terms: int) -> None:
        rare = rare[np.argsort(term[rare], kind="stable")]
        self.at = np.concatenate(([0], np.cumsum(np.bincount(term[rare], minlength=n_terms))))
        postings = np.empty(len(rare), _POSTING)
        postings["place"], postings["weight"] = self.place[owner[rare]], weight[rare]
        self.rare = postings.view(np.uint8)  # slices of bytes are joined fastest

    def _add_blocks(self, where: np.ndarray, n_common: int) -> None:
        by = np.argsort(where // _BLOCK, kind="stable").astype(np.int32)
        edges = np.searchsorted(where[by] // _BLOCK, np.arange(self.blocks + 1))
        self.most = np.zeros((n_common, self.blocks), np.float32)
        self.dense = []
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            local, row = np.unique(self.heavy_number[by[a:b]], return_inverse=True)
            cells = np.zeros((len(local), _BLOCK), np.float32)
            cells[row, where[by[a:b]] - i * _BLOCK] = self.heavy_weight[by[a:b]]
            if len(local):
                self.most[local, i] = cells.max(1)
            self.dense.append((local, cells))

    def _alike(self, owner: np.ndarray, n_common: int) -> np.ndarray:
        """The examples in an order that puts those with like common terms side by side (rounds of k-means)."""
        if not n_common or self.blocks < 2:
            return np.arange(self.n)
        groups = min(_GROUPS, self.blocks)
        member = np.full(self.n, groups)
        member[np.arange(groups) * self.n // groups] = np.arange(groups)
        for _ in range(4):
            key = self.heavy_number.astype(np.int64) * (groups + 1) + member[owner]
            centre = np.bincount(key, self.heavy_weight, n_common * (groups + 1)).reshape(n_common, -1)[:, :groups]
            centre = (centre / np.maximum(np.sqrt((centre ** 2).sum(0)), 1e-9)).astype(np.float32)
            for a in range(0, self.n, 1024):
                b = min(a + 1024, self.n)
                span = slice(self.heavy_at[a], self.heavy_at[b])
                rows = np.zeros((b - a, n_common), np.float32)
                rows[owner[span] - a, self.heavy_number[span]] = self.heavy_weight[span]
                member[a:b] = (rows @ centre).argmax(1)
        return np.argsort(member, kind="stable")

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, without: int | np.ndarray = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples and their cosines, nearest first, equal ones by number."""
        return self.nearest_of([(term, weight)], k, [without])[0]

    def nearest_of(self, queries: list[tuple], k: int, without: list | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """`nearest` of many queries; what comes out for one doesn't depend on the others."""
        if not self.n:
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        found = []
        for a in range(0, len(queries), _TOGETHER):
            found += self._together(queries[a:a + _TOGETHER], k, without[a:a + _TOGETHER] if without else None)
        return found

    def _rare_sums(self, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What the terms without a common number add to each place."""
        if not len(term):
            return np.zeros(self.blocks * _BLOCK)
        starts, ends, size = self.at[term], self.at[term + 1], _POSTING.itemsize
        postings = np.concatenate([self.rare[a:b] for a, b in zip((starts * size).tolist(), (ends * size).tolist())]).view(_POSTING)
        return np.bincount(postings["place"], np.repeat(weight, ends - starts) * postings["weight"], self.blocks * _BLOCK)

    def _together(self, queries: list[tuple], k: int, without: list | None) -> list[tuple[np.ndarray, np.ndarray]]:
        count, shape = len(queries), (len(queries), self.blocks, _BLOCK)
        sums = np.empty((count, self.blocks * _BLOCK))
        heavy = np.zeros((count, len(self.most)))
        for i, (term, weight) in enumerate(queries):
            number = self.common[term]
            often = number >= 0
            heavy[i, number[often]] = weight[often]
            sums[i] = self._rare_sums(term[~often], weight[~often])
        single = heavy.astype(np.float32)
        bound = sums.reshape(shape).max(2) + single @ self.most
        rank = np.argsort(np.argsort(-bound, 1, kind="stable"), 1)
        near = np.zeros(shape, np.float32)
        least, tops = np.zeros(count), [np.zeros(0, np.float32)] * count
        a, step = 0, 2
        while a < self.blocks:
            want = (rank >= a) & (rank < a + step) & (bound > 0) & (bound >= least[:, None] - _MARGIN)
            for block in np.flatnonzero(want.any(0)).tolist():
                who = np.flatnonzero(want[:, block])
                local, cells = self.dense[block]
                near[who, block] = single.take(who, 0).take(local, 1) @ cells + sums.reshape(shape)[who, block]
            for i in np.flatnonzero(want.any(1)).tolist():
                if without is not None:
                    gone = np.atleast_1d(without[i])
                    near[i].reshape(-1)[self.place[gone[gone >= 0]]] = 0
                values = near[i, want[i]].ravel()
                tops[i] = np.append(tops[i], values[values > least[i]])
                if len(tops[i]) >= k:
                    tops[i] = np.partition(tops[i], len(tops[i]) - k)[-k:]
                    least[i] = tops[i].min()
            a, step = a + step, step * 4
        found = []
        for i in range(count):
            row = near[i].reshape(-1)
            at = np.flatnonzero((row > 0) & (row >= least[i] - _MARGIN))
            ids = self.order[at]
            sizes = self.heavy_at[ids + 1] - self.heavy_at[ids]
            of = gather(self.heavy_at[ids], sizes)
            cosines = sums[i, at] + np.bincount(np.repeat(np.arange(len(ids)), sizes),
                                                heavy[i, self.heavy_number[of]] * self.heavy_weight[of], len(ids))
            best = np.lexsort((ids, -np.round(cosines, 9)))[:k]
            found.append((ids[best], np.minimum(cosines[best], 1.0)))
        return found


def _packed(terms: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising terms as steps, and their counts, in few bytes: like bytes side by side, compressed."""
    numbers = np.concatenate((np.diff(terms, prepend=0), counts)).astype(np.int32)
    return pa.compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def _unpacked(size: int, data: bytes) -> np.ndarray:
    """Terms and counts, `size` of each."""
    flat = np.frombuffer(pa.decompress(data, 8 * size, "zstd", asbytes=True), np.uint8)
    made = np.array(flat.reshape(4, -1).T, order="C").ravel().view(np.int32).reshape(2, size)
    np.cumsum(made[0], out=made[0])
    return made


class Search:
    """The examples, by all terms and by the leaning ones.

    It travels as the examples' packed terms and counts, which the driver never unpacks; each process builds the
    indexes when it first needs them.
    """

    def __init__(self, hashes: np.ndarray, found: np.ndarray, lean: np.ndarray, ids: np.ndarray, toxic: np.ndarray,
                 plain: np.ndarray, sizes: np.ndarray, packed: pa.Array):
        """`found`: examples with each term; `lean`: whether it leans. Example i, by rising id, has sizes[i]
        terms in packed[i]; `plain`: none of them leans."""
        self.hashes, self.found, self.lean, self.ids, self.toxic = hashes, found, lean, ids, toxic
        self.plain, self.sizes, self.packed = plain, sizes, packed
        self.idf = np.log1p(len(ids) / found)
        self.share = float(toxic.mean()) if len(ids) else 0.0
        self.free = float((toxic[plain].sum() + self.share) / (plain.sum() + 1))

    def __reduce__(self):
        return Search, (self.hashes, self.found, self.lean, self.ids, self.toxic, self.plain, self.sizes, self.packed)

    @property
    def at(self) -> np.ndarray:
        """Example i has the terms and counts from at[i] to at[i + 1]."""
        return np.concatenate(([0], np.cumsum(self.sizes, dtype=np.int64)))

    @property
    def terms(self) -> np.ndarray:
        return self._vectors()[0]

    @property
    def counts(self) -> np.ndarray:
        return self._vectors()[1]

    def _vectors(self) -> tuple[np.ndarray, np.ndarray]:
        """Terms and counts of all examples."""
        at = self.at.tolist()
        terms, counts = np.empty(at[-1], np.int32), np.empty(at[-1], np.int32)
        for a, b, one in zip(at, at[1:], self.packed):
            terms[a:b], counts[a:b] = _unpacked(b - a, one.as_py())
        return terms, counts

    @cached_property
    def table(self) -> TermTable:
        return TermTable(self.hashes)

    @property
    def all(self) -> BlockMaxIndex:
        return self._indexes[0]

    @property
    def leaning(self) -> BlockMaxIndex:
        return self._indexes[1]

    @cached_property
    def _indexes(self) -> tuple[BlockMaxIndex, BlockMaxIndex]:
        at, (terms, counts) = self.at, self._vectors()
        leans = np.flatnonzero(self.lean[terms])
        few = self._index(np.searchsorted(leans, at), terms[leans], np.log1p(counts[leans], dtype=float))
        weight = np.log1p(counts, dtype=float)
        del counts
        return self._index(at, terms, weight), few

    def _index(self, at: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> BlockMaxIndex:
        """From logarithms of counts, which become weights."""
        for a in range(0, len(terms), 1 << 20):
            weight[a:a + (1 << 20)] *= self.idf[terms[a:a + (1 << 20)]]
        for a in range(0, len(at) - 1, 256):  # lengths to one, a few hundred examples at once
            edges = at[a:a + 257]
            part = weight[edges[0]:edges[-1]]
            owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
            part /= np.sqrt(np.bincount(owner, part ** 2, len(edges) - 1))[owner]
        return BlockMaxIndex.of(at, terms, weight, len(self.hashes))

    def _weights(self, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        return unit(np.log1p(count.astype(float)) * self.idf[term])

    def _votes(self, index: BlockMaxIndex, texts: list[tuple], without: list | None) -> list[tuple]:
        found = index.nearest_of([(t, self._weights(t, n)) for t, n in texts], NEIGHBOURS, without)
        pulls = [1 / (NEARNESS + 1 - cosines) for _, cosines in found]
        return [((pull @ self.toxic[ids] + PRIOR * self.share) / (pull.sum() + PRIOR), ids, cosines)
                for pull, (ids, cosines) in zip(pulls, found)]

    def votes(self, texts: list[tuple], without: list | None = None) -> list[tuple]:
        """Of each (terms, counts): the vote over all terms, the vote over leaning ones, and the nearest examples
        with their cosines. `without` names examples that have no vote on it."""
        leans = [self.lean[t] for t, _ in texts]
        some = [i for i, lean in enumerate(leans) if lean.any()]
        second = np.full(len(texts), self.free)
        second[some] = [v for v, _, _ in self._votes(
            self.leaning, [(texts[i][0][leans[i]], texts[i][1][leans[i]]) for i in some],
            without and [without[i] for i in some])]
        return [(vote, other, ids, cosines)
                for (vote, ids, cosines), other in zip(self._votes(self.all, texts, without), second.tolist())]


class Model:
    """The search, which tasks get as a broadcast, and its calibration."""

    def __init__(self, search: Search, shared):
        self.shared, self.free, self.both = shared, search.free, 0 < search.toxic.sum() < len(search.ids)
        self.free = self.free if self.both else 0.0
        # Slopes of the two votes, and offset.
        self.curve = np.array([0.1, 1.0, 0.0])
        self._memory: dict[bytes, tuple] = {}

    def fit(self, first: np.ndarray, second: np.ndarray, toxic: np.ndarray) -> None:
        """Logistic regression of the labels on the votes' log-odds, slightly ridged (Newton steps)."""
        x = np.stack([_log_odds(first), _log_odds(second), np.ones(len(first))], 1)
        start = b = self.curve
        for _ in range(25):
            p = 1 / (1 + np.exp(-x @ b))
            gradient = x.T @ (toxic - p) - (b - start)
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(3), gradient)
            b = b + step
            if abs(step).max() < 1e-9:
                break
        self.curve = np.array([max(b[0], 0.1), max(b[1], 0.1), b[2]])

    def scores(self, texts: list[tuple]) -> list[tuple[float, list[int], list[float]]]:
        """Of each (terms, counts): probability of toxicity, and the nearest examples with their cosines."""
        if not self.both:
            return [(self.free, [], [])] * len(texts)
        if len(self._memory) > 2_000:
            self._memory.clear()
        search = self.shared.value
        keys = [t.tobytes() + n.tobytes() for t, n in texts]
        new = {key: text for key, text in zip(keys, texts) if len(text[0]) and key not in self._memory}
        known = {key: self._memory[key] for key in keys if key in self._memory} | {b"": (self.free, [], [])}
        for key, (first, second, ids, cosines) in zip(new, search.votes(list(new.values()))):
            odds = self.curve @ [_log_odds(first), _log_odds(second), 1.0]
            known[key] = float(1 / (1 + np.exp(-odds))), search.ids[ids].tolist(), cosines.tolist()
        self._memory.update(known)
        return [known[key] for key in keys]

    def scores_of(self, column: pa.Array) -> list[tuple[float, list[int], list[float]]]:
        """`scores` of texts, null as empty."""
        search, made = self.shared.value, []
        counted = counted_terms(pc.fill_null(column, ""), search.table, len(search.idf))
        while some := list(islice(counted, _TOGETHER)):
            made += self.scores(some)
        return made


def _log_odds(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _evidence(toxic: Column, clean: Column, share: Column) -> Column:
    """Twice the log-likelihood ratio of a term's toxic share against the overall one; 0 if not above it."""
    n = toxic + clean
    part = lambda k, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    return F.when(toxic / n > share, 2 * (part(toxic, share) + part(clean, 1 - share))).otherwise(0.0)


def _counted(rows: DataFrame) -> DataFrame:
    """(term, toxic, clean): documents with each term, summed batch by batch before they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for first, at, hashes, _ in terms(batch.column(0), contexts=False):
                owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
                order = np.lexsort((owner, hashes))
                h, o = hashes[order], owner[order]
                new = np.concatenate(([True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])))[:len(h)]
                h, y = h[new], label[first + o[new]]
                found, where = np.unique(h, return_inverse=True)
                toxic = np.bincount(where, y, len(found)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(toxic),
                     pa.array(np.bincount(where, minlength=len(found)) - toxic)], names=["term", "toxic", "clean"])

    summed = rows.select("text", "toxic").mapInArrow(run, "term long, toxic long, clean long")
    return summed.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _strongest(counts: DataFrame, share: float) -> DataFrame:
    """The terms that are toxic clearly more often than the overall share."""
    if not 0 < share < 1:
        return counts.limit(0)
    return counts.withColumn("evidence", _evidence(F.col("toxic"), F.col("clean"), F.lit(share))).where(
        F.col("evidence") >= EVIDENCE).orderBy(F.desc("evidence"), "term").limit(TERMS)


def _contexts(rows: DataFrame, chosen: np.ndarray) -> DataFrame:
    """(term, toxic, clean) of the chosen terms: their distinct contexts, toxic if one occurrence is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TermTable(chosen)
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for first, at, hashes, context in terms(batch.column(0)):
                place, _ = table.find(hashes)
                owner = np.searchsorted(at, place, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[place].view(np.int64)), pa.array(context[place].view(np.int64)),
                     pa.array(label[first + owner].astype(np.int32))], names=["term", "context", "toxic"])

    each = rows.select("text", "toxic").mapInArrow(run, "term long, context long, toxic int")
    distinct = each.groupBy("term", "context").agg(F.max("toxic").alias("toxic"))
    return distinct.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from `docs` (doc_id, text) and the `labels` (doc_id, toxic) to learn from."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.least(F.col("toxic"), F.lit(1))).cast("int").alias("toxic"))
    rows = known.count()
    rate = min(1.0, EXAMPLES / max(rows, 1))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("examples")), F.lit(1 << 30)) / float(1 << 30)
    # About EXAMPLES rows of two numbers, whatever the number of labels.
    sample = F.broadcast(known.where(draw < rate))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, "doc_id")
    examples = stage(texts.withColumn("__hash", F.xxhash64("text")).dropDuplicates(["__hash"]).drop("__hash"),
                     "examples")
    counts = stage(_counted(examples), "term-counts")
    share = counts.agg(F.sum("toxic") / F.sum(F.col("toxic") + F.col("clean"))).first()[0] or 0.0
    first = np.array([r.term for r in _strongest(counts, share).select("term").collect()], np.int64).view(np.uint64)
    chosen = _strongest(stage(_contexts(examples, first), "term-contexts"), share) if len(first) else counts.limit(0)
    leaning = np.array([r.term for r in chosen.select("term").collect()], np.int64)
    # All terms of the sample, as two numbers each.
    every = counts.select("term", (F.col("toxic") + F.col("clean")).cast("int").alias("n")).toArrow().sort_by("term")
    known_terms = every["term"].to_numpy()
    hashes, lean = known_terms.view(np.uint64), np.isin(known_terms, leaning)

    def counting():
        table = TermTable(hashes)

        def work(column: pa.Array) -> list[pa.Array]:
            made = list(counted_terms(column, table, len(hashes)))
            return [pa.array([not lean[t].any() for t, _ in made], pa.bool_()),
                    pa.array([len(t) for t, _ in made], pa.int32()), pa.array([_packed(*v) for v in made], pa.binary())]

        return work

    # No more than the sample: ids, labels, and packed numbers of terms.
    made = with_arrow(examples, ["text"], fields(plain="boolean", size="int", packed="binary"), counting).select(
        "doc_id", "toxic", F.xxhash64("text").alias("h"), "plain", "size", "packed").toArrow().sort_by(
        [("doc_id", "ascending"), ("h", "ascending")]).combine_chunks()
    packed = made["packed"].chunk(0) if len(made) else pa.array([], pa.binary())
    search = Search(hashes, every["n"].to_numpy(), lean, made["doc_id"].to_numpy(), made["toxic"].to_numpy().astype(float),
                    made["plain"].to_numpy(), made["size"].to_numpy(), packed)
    del made, every, packed
    shared = docs.sparkSession.sparkContext.broadcast(search)
    model = Model(search, shared)
    if not model.both:
        return model
    size = len(hashes)

    def voting():
        own = shared.value

        def work(texts: pa.Array, doc_ids: pa.Array) -> list[pa.Array]:
            numbers = doc_ids.to_numpy()
            spans = zip(np.searchsorted(own.ids, numbers), np.searchsorted(own.ids, numbers, "right"))
            # Nobody votes on an example that has its own id.
            made, each = [], zip(counted_terms(texts, own.table, size), spans)
            while some := list(islice(each, _TOGETHER)):
                voted = own.votes([v for v, _ in some], [np.arange(*span) for _, span in some])
                made += [m[:2] if len(v[0]) else (own.share, own.free) for m, (v, _) in zip(voted, some)]
            return [pa.array([m[i] for m in made], pa.float64()) for i in (0, 1)]

        return work

    # Two votes and a label for each example.
    made = with_arrow(examples.repartition(VOTERS, "doc_id"), ["text", "doc_id"], fields(first="double", second="double"),
                      voting).select("doc_id", "first", "second", "toxic").toArrow().sort_by("doc_id")
    model.fit(*(made[c].to_numpy() for c in ("first", "second", "toxic")))
    return model


def scored(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`df` with score (0 to 1), predicted (0 or 1) and evidence, the nearest examples and their cosines."""
    def prepare():
        def work(column: pa.Array) -> list[pa.Array]:
            made = model.scores_of(column)
            near = [[{"example": i, "cosine": c} for i, c in zip(ids, cosines)] for _, ids, cosines in made]
            return [pa.array([m[0] for m in made], pa.float64()),
                    pa.array([int(m[0] >= 0.5) for m in made], pa.int32()),
                    pa.array(near, pa.list_(pa.struct([("example", pa.int64()), ("cosine", pa.float64())])))]

        return work

    outputs = fields(score="double", predicted="int", evidence="array<struct<example: bigint, cosine: double>>")
    return with_arrow(df, [text], outputs, prepare)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no label is learned from; a row without an id is one."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of every document."""
    model = fit(docs, labels.where(~held_out()))
    own = docs.select("doc_id", held_out().alias("held_out"), "text")
    return scored(own, model).drop("text")


def not_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted to be toxic; all columns pass through, whatever their names."""
    model = fit(docs, labels.where(~held_out()))
    flag = unused(docs, "is_toxic")

    def prepare():
        def work(column: pa.Array) -> list[pa.Array]:
            return [pa.array([score >= 0.5 for score, _, _ in model.scores_of(column)], pa.bool_())]

        return work

    return with_arrow(docs, ["text"], fields(**{flag: "boolean"}), prepare).where(~F.col(flag)).select(docs.columns)
