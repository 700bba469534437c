"""Language of texts by error-correcting output codes.

Each language has a codeword of bits, and for each bit a binary classifier over byte n-grams says which
half of the languages a text belongs to. Codewords differ in many bits, so a few wrong bits do no harm: a
language is charged the logistic loss of each bit's margin against its codeword, weighted by how well the
bit did in training, and the least loss wins. Where the two best are close, the answer is flagged.

The classifiers' weights come from n-gram counts of a bounded sample, drawn by a hash of the id with about
`EXAMPLES` rows a language; prediction reads every text whole.

Defined results: null texts and texts without a letter are `und` with score 0, and all are where there is
nothing to learn from; with one language learned, every other text is that with score 1; equal losses go
to the language first in alphabetical order; copies of a text count once in training.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.columns import fields, with_arrow
from tillstream.llm.segments import chunks, mix
from tillstream.session import stage

EXAMPLES = 4_000
BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
UNDECIDED = "und"
# Margins of short texts are drawn towards zero as if so many neutral n-grams followed.
NEUTRAL = 20.0
# Probability of the best language below which a text is flagged.
CLEAR = 0.7
_LETTER = np.zeros(256, np.uint8)
for _b in [*range(97, 123), *range(128, 256)]:
    _LETTER[_b] = _b


def grams(column: pa.Array) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """(first row, row bounds, bucket of the n-gram that begins at each byte, for each order) of chunks.

    Anything but letters counts as a blank, and so many stand between rows that no n-gram reaches the next.
    """
    lower = pc.utf8_lower(column.cast(pa.large_string()))
    for first, _, data, bounds in chunks(lower):
        gap = max(ORDERS) - 1
        place = np.arange(len(data)) + np.repeat(np.arange(len(bounds) - 1) * gap, np.diff(bounds))
        padded = np.zeros(len(data) + (len(bounds) - 1) * gap, np.uint64)
        padded[place] = _LETTER[data]
        code, found = np.zeros(len(data), np.uint64), []
        for n in range(max(ORDERS)):
            code = code << np.uint64(8) | padded[place + n]
            if n + 1 in ORDERS:
                found.append((mix(code + np.uint64((n + 1) << 40)) % np.uint64(BUCKETS)).astype(np.int64))
        yield first, bounds, found


def codewords(languages: int) -> np.ndarray:
    """A row of -1 and 1 for each language, any two of which differ in many places.

    Up to seven languages: all ways to part them in two. More: of 64 codes by a hash, the one whose
    nearest rows are farthest apart.
    """
    if languages <= 7:
        ways = np.arange(1, 1 << max(languages - 1, 0))
        return np.array([[1 if w >> y & 1 else -1 for w in ways] for y in range(languages)], int).reshape(languages, len(ways))
    bits = 10 * int(np.ceil(np.log2(languages)))

    def drawn(seed: int) -> np.ndarray:
        cell = mix(np.arange(languages * bits, dtype=np.uint64) + np.uint64(seed << 32))
        return np.where(cell & np.uint64(1), 1, -1).reshape(languages, bits)

    def nearest(code: np.ndarray) -> int:
        apart = (bits - code @ code.T) // 2
        return int((apart + bits * np.eye(languages, dtype=int)).min())

    return max(map(drawn, range(64)), key=nearest)


class Model:
    """Languages, their codewords, and each bit's n-gram weights, scale and reliability."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        """`counts`: n-grams of each language's sample by bucket."""
        self.languages, self.code = languages, codewords(len(languages))
        bits = self.code.shape[1]
        share = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True) if len(languages) else counts
        self.weights = np.zeros((BUCKETS, bits), np.float32)
        for b in range(bits):
            yes, no = share[self.code[:, b] > 0], share[self.code[:, b] < 0]
            self.weights[:, b] = np.log(yes.mean(0)) - np.log(no.mean(0))
        self.scale, self.trust = np.full(bits, 10.0), np.ones(bits)

    def margins(self, column: pa.Array) -> np.ndarray:
        """Mean n-gram weight of each text for each bit."""
        out = np.zeros((len(column), self.code.shape[1]))
        for first, bounds, found in grams(column):
            n = np.diff(bounds)
            some = np.flatnonzero(n)
            if not len(some):
                continue
            for buckets in found:
                out[first + some] += np.add.reduceat(self.weights[buckets], bounds[:-1][some], axis=0)
            out[first:first + len(n)] /= (len(found) * n + NEUTRAL)[:, None]
        return out

    def calibrate(self, margins: np.ndarray, language: np.ndarray) -> None:
        """Fits each bit's scale (logistic, by Newton steps) and weighs bits by the odds of being right."""
        for b in range(self.code.shape[1]):
            x = margins[:, b] * self.code[language, b]
            scale = 10.0
            for _ in range(30):
                p = 1 / (1 + np.exp(np.clip(scale * x, -30, 30)))
                slope, bend = (p * x).sum() - 0.01 * scale, (p * (1 - p) * x * x).sum() + 0.01
                scale = float(np.clip(scale + slope / bend, 0.1, 1000.0))
            wrong = ((x <= 0).sum() + 1) / (len(x) + 2)
            self.scale[b], self.trust[b] = scale, max(np.log((1 - wrong) / wrong), 0.0)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, probability) of each row of margins."""
        bits = np.clip(margins * self.scale, -50, 50)
        loss = np.zeros((len(margins), len(self.languages)))
        weight = self.trust / max(self.trust.sum(), 1e-9)
        for y, row in enumerate(self.code):
            loss[:, y] = np.log1p(np.exp(-bits * row)) @ weight if len(row) else 0.0
        # Two codewords differ in about half the bits.
        odds = np.exp(-2 * (loss - loss.min(1, keepdims=True)))
        return loss.argmin(1), odds.max(1) / odds.sum(1)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learned from; a row without an id is one."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def fit(docs: DataFrame) -> Model:
    """A model from rows of doc_id, text and lang."""
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", "lang")
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, BUCKETS)))
    rate = F.element_at(F.create_map(*[F.lit(v) for k in languages for v in (k, min(1.0, EXAMPLES / sizes[k]))]),
                        F.col("lang"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("examples")), F.lit(1 << 30)) / float(1 << 30)
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("int") - 1
    examples = stage(
        rows.where(draw < rate).select("text", number.alias("language"), F.xxhash64("text").alias("h"))
        .dropDuplicates(["h", "language"]).drop("h"), "language-examples")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        into = np.zeros(len(languages) * BUCKETS)
        for batch in batches:
            label = batch.column(1).to_numpy()
            for first, bounds, found in grams(batch.column(0)):
                owner = np.repeat(label[first:first + len(bounds) - 1], np.diff(bounds)).astype(np.int64)
                for buckets in found:
                    into += np.bincount(owner * BUCKETS + buckets, minlength=len(into))
        cell = np.flatnonzero(into)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(into[cell])], names=["cell", "n"])

    # No more than one number for each language and bucket.
    counts = np.zeros(len(languages) * BUCKETS)
    for row in examples.mapInArrow(count, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[row.cell] = row.n
    model = Model(languages, counts.reshape(len(languages), BUCKETS))
    if len(languages) > 1:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def prepare():
            return lambda column: [pa.array(list(shared.value.margins(column)), pa.list_(pa.float64()))]

        made = with_arrow(examples, ["text"], fields(margins="array<double>"), prepare).drop("text").collect()
        made = [r for r in made if r.margins]
        model.calibrate(np.array([r.margins for r in made]), np.array([r.language for r in made]))
    return model


def identified(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`df` with lang_pred, score (0 to 1) and ambiguous."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def prepare():
        model = shared.value

        def work(column: pa.Array) -> list[pa.Array]:
            known = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            if not model.languages:
                known = np.zeros(len(column), bool)
                best, score = np.zeros(len(column), np.int64), np.zeros(len(column))
            else:
                best, score = model.decode(model.margins(pc.fill_null(column, "")))
            names = [model.languages[y] if k else UNDECIDED for y, k in zip(best.tolist(), known.tolist())]
            score = np.where(known, score, 0.0)
            return [pa.array(names, pa.string()), pa.array(score), pa.array(score < CLEAR)]

        return work

    return with_arrow(df, [text], fields(lang_pred="string", score="double", ambiguous="boolean"), prepare)


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of every document."""
    model = fit(docs.where(~held_out()))
    return identified(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
