"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point. An n-gram is bound by multiplying its
letters' vectors, each rotated by its place; a text is the sum (bundle) of its n-grams' vectors. A language's
prototype is the sum of its texts' bundles at length 1. What all languages share, their mean prototype, is taken off
the prototypes, and a text goes to the language whose prototype has the greatest cosine with its bundle.

Texts are lower-cased; what is not a letter is one blank. In a worker a slice of texts is a matrix of n-gram counts times
the matrix of the n-grams' vectors, so bundling is one product; the blocks of both are bounded.

Prototypes are summed in whole numbers, so their values don't depend on the order of rows. Learning reads
about ``TRAIN_DOCS`` labelled rows, drawn by a hash of the id, and of each language about ``LANGUAGE_DOCS`` at least, or all it has
(documented bounds), so that no language is left out for being rare; predictions cover all rows. The
prototypes on the driver are one vector for each language; more than ``MOST_LANGUAGES`` is an error.

Defined results: a text that is NULL or has no letter is ``und`` with score 0; ties go to the lesser name; repeated rows get the
same answer each; rows without a language or an id teach nothing; if nothing can be learned all
rows are ``und``; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import slices

DIMENSIONS = 1024
GRAM = 3
TRAIN_DOCS = 30_000
LANGUAGE_DOCS = 1_000
MOST_LANGUAGES = 1_000
UNKNOWN = "und"
_UNIT = 1 << 20  # whole numbers for one unit of length
_CELLS = 4_000_000  # of a block of counts
_GRAMS = 8_192  # vectors of a block
_STRETCH = 1 << 20  # letters that are counted at once
_LETTERS = np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x10000)])
_VECTORS: dict[tuple[int, int], np.ndarray] = {}


def letter_vector(code: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """+1 or -1 in each place, fixed by the letter."""
    key = (code, dimensions)
    if key not in _VECTORS:
        if len(_VECTORS) > 20_000:
            _VECTORS.clear()
        bits = np.random.Generator(np.random.Philox(key=code)).integers(0, 2, dimensions, dtype=np.int8)
        _VECTORS[key] = (2 * bits - 1).astype(np.float32)
    return _VECTORS[key]


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text, 0x20 for each run of other characters, with a blank at both ends; empty without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _LETTERS[np.minimum(codes, 0xFFFF)] & (codes < 0x10000)
    high = np.flatnonzero(codes >= 0x10000)
    if len(high):
        letter[high] = [chr(c).isalpha() for c in codes[high]]
    if not letter.any():
        return np.zeros(0, np.uint32)
    before = np.concatenate([[False], letter[:-1]])
    keep = letter | before  # a letter, or the first of a run of others
    return np.concatenate([[32], np.where(letter, codes, 32)[keep], [32][: int(letter[-1])]]).astype(np.uint32)


def bundles(texts: list[str | None], dimensions: int = DIMENSIONS, gram: int = GRAM) -> np.ndarray:
    """A row for each text: the sum of its n-grams' vectors, zero without a letter."""
    out = np.zeros((len(texts), dimensions), np.float64)
    rows, pieces, size = [], [], 0

    def add() -> None:
        np.add.at(out, rows, _bundles(pieces, dimensions, gram))

    for row, text in enumerate(texts):
        codes = letters(text)
        for low in range(0, max(0, len(codes) - gram + 1), _STRETCH):  # a very long text goes in stretches
            rows.append(row)
            pieces.append(codes[low : low + _STRETCH + gram - 1])
            size += len(pieces[-1])
            if size >= _STRETCH:
                add()
                rows, pieces, size = [], [], 0
    if pieces:
        add()
    return out.astype(np.float32)


def _bundles(done: list[np.ndarray], dimensions: int, gram: int) -> np.ndarray:
    """The same of runs of letters that have an n-gram each."""
    out = np.zeros((len(done), dimensions), np.float32)
    sizes = np.array([len(d) - gram + 1 for d in done])
    whole = np.concatenate(done)
    alphabet, at = _numbered(whole, 0x110000)
    starts = np.cumsum([0, *[len(d) for d in done]])[:-1]
    codes = at[: len(whole) - gram + 1].astype(np.int64)
    for k in range(1, gram):
        codes = codes * len(alphabet) + at[k : len(whole) - gram + 1 + k]
    rows = np.repeat(np.arange(len(done)), sizes)
    first = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    grams, column = _numbered(codes[first], len(alphabet) ** gram)
    for low in range(0, len(grams), _GRAMS):
        some = grams[low : low + _GRAMS]
        vectors = np.ones((len(some), dimensions), np.float32)
        rest = some
        for place in range(gram):  # the last letter is not rotated
            table = np.stack([np.roll(letter_vector(int(c), dimensions), place) for c in alphabet])
            vectors *= table[rest % len(alphabet)]
            rest = rest // len(alphabet)
        inside = (column >= low) & (column < low + len(some)) if len(grams) > _GRAMS else slice(None)
        cells = rows[inside] * len(some) + column[inside] - low
        step = max(1, _CELLS // len(some))
        for top in range(0, len(done), step):
            n = min(step, len(done) - top)
            if len(done) > step:
                part = cells[(cells >= top * len(some)) & (cells < (top + n) * len(some))] - top * len(some)
            else:
                part = cells
            counts = np.bincount(part, minlength=n * len(some)).reshape(n, len(some)).astype(np.float32)
            out[top : top + n] += counts @ vectors
    return out


def _numbered(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The different values, ascending, and the number of each row's value; by a table while that is small."""
    if limit > _CELLS:
        return np.unique(values, return_inverse=True)
    present = np.zeros(limit, bool)
    present[values] = True
    number = np.cumsum(present) - 1
    return np.flatnonzero(present), number[values]


def _units(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS, gram: int = GRAM,
               most: int = MOST_LANGUAGES) -> dict[str, np.ndarray]:
    """The sum of the texts' bundles at length 1 for each language, from all rows given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part in slices(batches, rows=128):
            units = np.rint(_units(bundles(part.column("text").to_pylist(), dimensions, gram)) * _UNIT).astype(np.int64)
            langs = np.array(part.column("lang").to_pylist())
            for lang in np.unique(langs):
                sums[str(lang)] = sums.get(str(lang), 0) + units[langs == lang].sum(axis=0)
            if len(sums) > most:
                raise ValueError(f"more than {most} languages")
        yield pa.record_batch([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], ["lang", "sums"])

    taught = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("lang is not null")
    found = taught.mapInArrow(run, "lang string, sums array<long>").select("lang", F.posexplode("sums").alias("place", "value"))
    summed = found.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    whole = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("all")).select("lang", F.col("all.value").alias("all"))
    rows = whole.orderBy("lang").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} languages")
    return {r["lang"]: np.array(r["all"], np.float64) / _UNIT for r in rows}


class Model:
    """Prototypes made ready: centred and at length 1, in order of name."""

    def __init__(self, found: dict[str, np.ndarray], dimensions: int = DIMENSIONS, gram: int = GRAM):
        self.dimensions, self.gram = dimensions, gram
        self.names = sorted(k for k, v in found.items() if np.any(v))
        if self.names:
            units = _units(np.stack([found[k] for k in self.names]))
            self.mean = units.mean(axis=0) if len(self.names) > 1 else np.zeros(dimensions)
            self.rows = _units(units - self.mean).astype(np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        found = bundles(texts, self.dimensions, self.gram)
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cosine = (_units(found) @ self.rows.T).astype(np.float64)
        best = cosine.argmax(axis=1)
        known = found.any(axis=1)
        score = np.where(known, np.clip((1 + cosine[np.arange(len(texts)), best]) / 2, 0, 1), 0.0)
        return [self.names[b] if k else UNKNOWN for b, k in zip(best, known)], score


def _draw(*keys: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit("drawn")), 11).cast("double") / F.lit(float(1 << 53))


def bounded(rows: DataFrame, bound: int, *keys: Column) -> DataFrame:
    """About ``bound`` of the rows, drawn by a hash of the keys; all if there are no more."""
    n = rows.count()
    if n <= bound:
        return rows
    return rows.filter(_draw(*keys) < bound / n)


def sample(rows: DataFrame, bound: int, least: int, id_col: str, lang_col: str, most: int = MOST_LANGUAGES) -> DataFrame:
    """About ``bound`` of the rows, but of each language about ``least`` or all it has; all rows if there are no more than ``bound``."""
    lang = F.col(lang_col).cast("string")
    counts = {r["lang"]: r["n"] for r in rows.groupBy(lang.alias("lang")).agg(F.count("*").alias("n")).limit(most + 1).collect()}
    if len(counts) > most:
        raise ValueError(f"more than {most} languages")
    n = sum(counts.values())
    if n <= bound:
        return rows
    raised = {name: least / own for name, own in counts.items() if least / own > bound / n}
    rate = F.lit(bound / n)
    if raised:
        rates = F.create_map(*[F.lit(x) for pair in sorted(raised.items()) for x in pair])
        rate = F.coalesce(F.try_element_at(rates, lang), rate)
    return rows.filter(_draw(F.col(id_col)) < rate)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bound: int = TRAIN_DOCS,
          least: int = LANGUAGE_DOCS) -> Model:
    known = docs.filter(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull())
    return Model(prototypes(sample(known, bound, least, id_col, lang_col), text_col, lang_col))


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` with ``lang_pred`` and ``score``, which is the cosine moved to 0..1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows=256, size=2 << 20):
            names, score = model.predict(part.column("_text").to_pylist())
            yield pa.record_batch([*[part.column(c) for c in keep], pa.array(names), pa.array(score)], [*keep, "lang_pred", "score"])

    sent = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    return sent.mapInArrow(run, f"{fields}, lang_pred string, score double")
